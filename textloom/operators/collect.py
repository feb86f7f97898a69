"""Collection of pages of frequent domains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import domain, domain_dir
from .stats import TOP, top_domains


def target_domains(pages: DataFrame, min_frequency: int = 100, max_domains: int = TOP, url: str = "url") -> DataFrame:
    """(domain, n): of the ``max_domains`` most frequent domains those with at least ``min_frequency`` pages."""
    return top_domains(pages, max_domains, url).where(F.col("n") >= min_frequency)


def with_domain(pages: DataFrame, url: str = "url", file_column: str | None = None) -> DataFrame:
    """Pages with ``domain``, and ``file_source`` if a file column is named; columns of these names that are there already stay."""
    made = {"domain": domain(F.col(url))} | ({"file_source": F.col(file_column)} if file_column else {})
    return pages.withColumns({k: v for k, v in made.items() if k not in pages.columns})


def collect(pages: DataFrame, targets: DataFrame, url: str = "url", file_column: str | None = None) -> DataFrame:
    """Pages of the target domains, all columns, with ``domain``. ``targets`` has as many rows as domains are collected; the
    planner broadcasts it while its size allows and shuffles by domain beyond."""
    from_url = domain(F.col(url))
    keep = targets.select(F.col("domain").alias("_target"))
    found = pages.where(F.col(url).isNotNull() & (F.col(url) != "")).withColumn("_domain", from_url)
    found = found.join(keep, F.col("_domain") == F.col("_target"), "left_semi")
    if "domain" not in pages.columns:
        found = found.withColumn("domain", F.col("_domain"))
    if file_column and "file_source" not in pages.columns:
        found = found.withColumn("file_source", F.col(file_column))
    return found.drop("_domain")


def with_folder(collected: DataFrame) -> DataFrame:
    return collected.withColumn("domain_dir", domain_dir(F.col("domain")))


def by_file_and_domain(collected: DataFrame, file_column: str = "file_source") -> DataFrame:
    """Counts of (file, domain), file, domain and all in one aggregation; ``level`` names the grain."""
    f, d = F.col(file_column), F.col("domain")
    n = collected.groupBy(f.alias("file"), d.alias("domain")).agg(F.count("*").alias("n"))
    cube = n.cube("file", "domain").agg(F.sum("n").alias("n"), F.count_distinct("domain").alias("n_domains"), F.grouping_id().alias("g"))
    level = F.element_at(F.array(*map(F.lit, ("file_domain", "file", "domain", "total"))), (F.col("g") + 1).cast("int"))
    return cube.select(level.alias("level"), "file", "domain", "n", "n_domains")


def domain_totals(collected: DataFrame) -> DataFrame:
    return collected.groupBy("domain").agg(F.count("*").alias("n"))


def file_totals(pages: DataFrame, collected: DataFrame, file_column: str) -> DataFrame:
    """(file, processed, collected, saved): rows read, rows collected, distinct domains written."""
    read = pages.groupBy(F.col(file_column).alias("file")).agg(F.count("*").alias("processed"))
    got = collected.groupBy(F.col(file_column).alias("file")).agg(F.count("*").alias("collected"), F.count_distinct("domain").alias("saved"))
    zero = F.lit(0).cast("long")
    return read.join(got, "file", "left").select("file", "processed", F.coalesce("collected", zero).alias("collected"), F.coalesce("saved", zero).alias("saved"))


def collection_rate(pages: DataFrame, targets: DataFrame, url: str = "url") -> DataFrame:
    """(processed, collected, rate in percent): one scan, counted by domain before the join; 0 for no pages."""
    n = pages.select(domain(F.col(url)).alias("domain")).groupBy("domain").agg(F.count("*").alias("n"))
    hit = n.join(targets.select("domain", F.lit(1).alias("t")), "domain", "left")
    sums = hit.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("processed"), F.coalesce(F.sum(F.when(F.col("t") == 1, F.col("n"))), F.lit(0)).alias("collected"))
    return sums.select("processed", "collected", F.coalesce(F.round(F.try_divide(F.col("collected") * F.lit(100.0), F.col("processed")), 2), F.lit(0.0)).alias("rate"))


def consolidated(collected: DataFrame, file_column: str = "file_source") -> DataFrame:
    """(domain, total_urls, source_files) of a collection whose files are merged by domain."""
    return collected.groupBy("domain").agg(F.count("*").alias("total_urls"), F.count_distinct(file_column).alias("source_files"))
