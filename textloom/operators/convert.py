"""HTML to Markdown over tables and folders, with a status for each row and folder."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.markdown import to_markdown

SUFFIX = "_markdown"


def convert(rows: DataFrame, content: str = "content", converter: Callable[[str], str] = to_markdown) -> DataFrame:
    """Rows with ``content`` as Markdown and ``content_format``: ``markdown``; ``raw`` where there is no text to convert; ``error``
    where the converter fails, content as it was. Without a content column rows stay as they are, format null. All rows are kept."""
    if content not in rows.columns:
        return rows.withColumn("content_format", F.lit(None).cast("string"))

    @F.pandas_udf("content string, content_format string")
    def run(t: pd.Series) -> pd.DataFrame:
        out = []
        for x in t:
            if not isinstance(x, str) or not x:
                out.append((x, "raw"))
                continue
            try:
                out.append((converter(x), "markdown"))
            except Exception:  # a page that can't be converted is a result, not a failure of the run
                out.append((x, "error"))
        return pd.DataFrame(out, columns=["content", "content_format"])

    done = rows.withColumn("__textloom_done", run(F.col(content)))
    return done.withColumns({content: F.col("__textloom_done.content"), "content_format": F.col("__textloom_done.content_format")}).drop("__textloom_done")


def status(converted: DataFrame, by: str = "folder", file_column: str = "source_file") -> DataFrame:
    """(folder, source_files, total_items, processed_items, error_items, success)."""
    fmt = F.col("content_format")
    return converted.groupBy(by).agg(
        F.count_distinct(file_column).alias("source_files"),
        F.count("*").alias("total_items"),
        F.count_if(fmt == "markdown").alias("processed_items"),
        F.count_if(fmt == "error").alias("error_items"),
    ).withColumn("success", F.lit(True))


def folder_status(folders: DataFrame, converted: DataFrame, by: str = "folder", file_column: str = "source_file") -> DataFrame:
    """The status of every folder; one without rows has failed."""
    zero = F.lit(0).cast("long")
    out = folders.select(by).distinct().join(status(converted, by, file_column), by, "left")
    counts = {c: F.coalesce(c, zero) for c in ("source_files", "total_items", "processed_items", "error_items")}
    return out.withColumns(counts | {"success": F.coalesce("success", F.lit(False))})


def totals(statuses: DataFrame) -> DataFrame:
    """One row over all folders: sums of the successful ones, rate of converted items in percent."""
    ok = F.col("success")
    part = lambda c: F.coalesce(F.sum(F.when(ok, F.col(c))), F.lit(0)).cast("long").alias(c)
    out = statuses.agg(F.count_if(ok).alias("successful"), F.count_if(~ok).alias("failed"), *[part(c) for c in ("total_items", "processed_items", "error_items")])
    rate = F.coalesce(F.round(F.try_divide(F.col("processed_items") * F.lit(100.0), F.col("total_items")), 1), F.lit(0.0))
    return out.withColumn("rate", rate)


def first_files(rows: DataFrame, max_files: int, by: str = "folder", file_column: str = "source_file") -> DataFrame:
    """Rows of the first ``max_files`` files of each folder by name; 0 takes all. Files are ranked, not rows."""
    if max_files <= 0:
        return rows
    w = Window.partitionBy(by).orderBy(file_column)
    files = rows.select(by, file_column).distinct().withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= max_files)
    return rows.join(files.drop("_r"), [by, file_column], "left_semi")


def first_folders(rows: DataFrame, n: int = 3, by: str = "folder") -> DataFrame:
    """For trial runs: rows of the first ``n`` folders by name."""
    return rows.join(rows.select(by).distinct().orderBy(by).limit(n), by, "left_semi")


def pending(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Items that have no result yet."""
    return items.join(done.select(key), key, "left_anti")


def convert_folders(rows: DataFrame, done: DataFrame | None = None, max_files: int = 0, converter: Callable[[str], str] = to_markdown, by: str = "folder") -> DataFrame:
    """Converted rows of folders: all of them, or with ``done`` only those that have no result yet."""
    todo = rows if done is None else pending(rows, done, by)
    return convert(first_files(todo, max_files, by), converter=converter)


def write_converted(converted: DataFrame, path: str, by: str = "folder", incremental: bool = False) -> None:
    """JSON lines in a folder for each source folder. ``incremental`` replaces only the folders that are written."""
    out = converted.write.mode("overwrite").option("ignoreNullFields", "false").option("maxRecordsPerFile", 200_000).partitionBy(by)
    (out.option("partitionOverwriteMode", "dynamic") if incremental else out).json(path)
