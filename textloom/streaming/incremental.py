"""Structured Streaming forms of what runs in increments: new files only, exactly once, with a checkpoint."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.markdown import to_markdown
from ..functions.urls import domain, has_url
from ..operators.convert import convert
from ..sources.sinks import replace_text


def page_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1000, pattern: str | None = None) -> DataFrame:
    """Parquet pages as they arrive."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).parquet(path)


def convert_new_files(pages: DataFrame, out: str, checkpoint: str, content: str = "content", url: str = "url", converter: Callable[[str], str] = to_markdown) -> StreamingQuery:
    """Converts what has arrived since the last run into folders by domain, then stops."""
    rows = convert(pages.withColumn("domain", F.coalesce(domain(F.col(url)), F.lit(""))), content, converter)
    return rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).partitionBy("domain").outputMode("append").trigger(availableNow=True).start(out)


def domain_counts(pages: DataFrame, url: str = "url") -> DataFrame:
    """Running (domain, n): state is a row a domain."""
    u = F.col(url)
    d = pages.where(has_url(u)).select(domain(u).alias("domain")).where(F.coalesce(F.col("domain"), F.lit("")) != "")
    return d.groupBy("domain").agg(F.count("*").alias("n"))


def windowed_counts(events: DataFrame, time: str = "ts", kind: str = "event_type", value: str = "value", width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(window_start, kind, n, total) of tumbling windows; a window is final once the watermark has passed it."""
    w = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(F.window(time, width).alias("w"), kind)
    return w.agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("window_start"), kind, "n", "total")


def upsert_by_key(results: DataFrame, table: str, checkpoint: str, key: str = "question_id", order: str | None = None, buckets: int = 64) -> StreamingQuery:
    """Keeps one row a key in a folder of Parquet buckets: each batch replaces rows of equal key, of those in a batch the last one by
    ``order`` counts (without it the last in the order of files and lines).

    A batch rewrites only the buckets of its keys, under a name of its own, and then replaces ``table/current``, which names each bucket's
    folder. So a batch that runs again finds its rows there already and changes nothing, and readers never see half of one.
    """
    spark, top = results.sparkSession, table.rstrip("/")
    names = results.columns

    def merge(batch: DataFrame, number: int) -> None:
        at = F.col(order) if order else F.monotonically_increasing_id()
        new = batch.select(key, F.struct(*names).alias("__row"), at.alias("__at")).groupBy(key).agg(F.max_by("__row", "__at").alias("__row")).select("__row.*")
        bucket = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")
        held = _current(spark, top) or {}
        touched = sorted(r[0] for r in new.select(bucket).distinct().collect())  # at most ``buckets`` numbers
        old = [held[str(b)] for b in touched if str(b) in held]
        if old:
            new = spark.read.schema(results.schema).parquet(*old).join(new.select(key), key, "left_anti").select(*names).unionByName(new)
        target = f"{top}/batch-{number:012d}-{uuid.uuid4().hex[:8]}"
        new.withColumn("__bucket", bucket).write.partitionBy("__bucket").parquet(target)
        replace_text(spark, json.dumps(held | {str(b): f"{target}/__bucket={b}" for b in touched}), f"{top}/current")

    return results.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _current(spark: SparkSession, table: str) -> dict[str, str] | None:
    from pyspark.errors import AnalysisException

    try:
        row = spark.read.text(f"{table}/current", wholetext=True).first()
    except AnalysisException:
        return None
    return json.loads(row.value)


def snapshot(spark: SparkSession, table: str) -> DataFrame | None:
    """The table that ``upsert_by_key`` keeps; None before the first row."""
    held = _current(spark, table.rstrip("/"))
    return spark.read.parquet(*held.values()) if held else None
