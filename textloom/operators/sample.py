"""Reproducible samples by domain: first of files, then of rows, in the order of an md5 of seed and key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED, SIZE, FILES = 42, 100, 10


def draw(seed: int, *keys: Column) -> Column:
    """A random order that every engine with md5 repeats."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys]).cast("binary"))


def sample_rows(rows: DataFrame, key: str, n: int = SIZE, seed: int = SEED, by: str = "domain") -> DataFrame:
    """``n`` rows of each group without replacement. The limit is applied in each partition before the shuffle."""
    w = Window.partitionBy(by).orderBy(draw(seed, F.col(key)), key)
    return rows.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)


def choose_files(rows: DataFrame, file_column: str, max_files: int = FILES, seed: int = SEED, by: str = "domain") -> DataFrame:
    """(domain, file, file_rows) of up to ``max_files`` files of each group; 0 takes all. Files are counted before they are ranked."""
    files = rows.groupBy(by, file_column).agg(F.count("*").alias("file_rows"))
    w = Window.partitionBy(by).orderBy(draw(seed, F.col(by), F.col(file_column)), file_column)
    return files.withColumn("_r", F.row_number().over(w)).where(F.lit(max_files == 0) | (F.col("_r") <= max_files)).drop("_r")


def cluster_sample(rows: DataFrame, key: str, file_column: str, n: int = SIZE, max_files: int = FILES, seed: int = SEED, by: str = "domain") -> DataFrame:
    """``n`` rows of each group from up to ``max_files`` of its files."""
    chosen = choose_files(rows, file_column, max_files, seed, by).select(by, file_column)
    return sample_rows(rows.join(chosen, [by, file_column], "left_semi"), key, n, seed, by)


def sampling_report(rows: DataFrame, file_column: str, n: int = SIZE, max_files: int = FILES, seed: int = SEED, by: str = "domain", domains: DataFrame | None = None) -> DataFrame:
    """(domain, total_files, selected_files, valid_data, sampled). With ``domains``, those without rows are there too, ``sampled`` null: failures."""
    total = rows.groupBy(by).agg(F.count_distinct(file_column).alias("total_files"))
    got = choose_files(rows, file_column, max_files, seed, by).groupBy(by).agg(F.count("*").alias("selected_files"), F.sum("file_rows").alias("valid_data"))
    out = total.join(got, by).withColumn("sampled", F.least("valid_data", F.lit(n).cast("long")))
    if domains is not None:
        out = domains.select(by).join(out, by, "left")
    return out.select(by, "total_files", "selected_files", "valid_data", "sampled")


def sampling_totals(report: DataFrame) -> DataFrame:
    """(total_domains, successful_samples, failed_samples, total_sampled)."""
    ok = F.col("sampled").isNotNull()
    return report.agg(F.count("*").alias("total_domains"), F.count_if(ok).alias("successful_samples"), F.count_if(~ok).alias("failed_samples"), F.coalesce(F.sum("sampled"), F.lit(0)).alias("total_sampled"))
