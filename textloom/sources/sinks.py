"""Writers: reports, folders by domain, JSON lines, keyed JSON; and removal of earlier outputs."""

from __future__ import annotations

import json
import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """One small file through Hadoop's file systems."""
    p, fs = _path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def replace_text(spark: SparkSession, text: str, path: str) -> None:
    """A small file that readers see whole, as it was or as it is: written beside its place, then renamed over it."""
    beside = f"{path}.{uuid.uuid4().hex[:8]}.new"
    write_text(spark, text, beside)
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    source, fs = _path(spark, beside)
    how = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(source, _path(spark, path)[0], how)


def write_report(spark: SparkSession, report: dict, path: str, stamp: str | None = None) -> None:
    """A report as indented JSON, with the time under the name ``stamp`` if one is given. Reports are small by construction: totals and top lists."""
    if stamp:
        report = {stamp: datetime.now(UTC).isoformat(timespec="seconds")} | report
    write_text(spark, json.dumps(report, ensure_ascii=False, indent=2), path)


def write_by_domain(df: DataFrame, path: str, domain: str = "domain", fmt: str = "json", rows_per_file: int = 500_000, salt_by: str = "url", salts: int = 8) -> None:
    """A folder per domain, named by the domain itself; its rows are dealt to at most ``salts`` tasks, so a large domain is no single task's."""
    dealt = df.repartition(F.col(domain), F.pmod(F.xxhash64(salt_by), F.lit(salts)))
    dealt.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).option("ignoreNullFields", "false").partitionBy(domain).format(fmt).save(path)


def write_records(df: DataFrame, path: str, single_file: bool = False, array_chars: int = 8 << 20) -> bool:
    """By the path's end: ``.jsonl`` JSON lines, anything else JSON arrays; nothing is written for no rows. A folder of files, each with
    one array of about ``array_chars`` at most, or one file if ``single_file`` (for deliverables that fit a task)."""
    spark = df.sparkSession
    if df.isEmpty():
        return False
    lines = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    target = f"{path}.parts" if single_file else path
    packed = lines.coalesce(1) if single_file else lines
    if path.lower().endswith(".jsonl"):
        packed.write.mode("overwrite").text(target)
    else:
        arrays = packed.mapInArrow(_arrays(array_chars, single_file), "value string")
        arrays.write.mode("overwrite").option("lineSep", "\n").option("maxRecordsPerFile", 0 if single_file else 1).text(target)
    if single_file:
        _join_parts(spark, target, path)
    return True


def _arrays(chars: int, joined: bool):
    """Rows as texts of JSON arrays, each closed once it has so many characters; if ``joined``, as pieces of one array. A task holds one text."""

    def run(batches):
        import pyarrow as pa

        text = lambda begin, rows, end: pa.RecordBatch.from_arrays([pa.array([begin + ",\n".join(rows) + end], pa.string())], ["value"])
        begin, rows, size = "[\n", [], 0
        for batch in batches:
            for row in batch.column(0):
                if size >= chars:
                    yield text(begin, rows, "," if joined else "\n]")
                    begin, rows, size = "" if joined else "[\n", [], 0
                rows.append(row.as_py())
                size += len(rows[-1])
        if rows:
            yield text(begin, rows, "\n]")

    return run


def _join_parts(spark: SparkSession, folder: str, path: str) -> None:
    p, fs = _path(spark, folder)
    target, _ = _path(spark, path)
    parts = [s.getPath() for s in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/part-*")) if s.getLen()]
    fs.delete(target, True)
    if len(parts) != 1:
        raise ValueError(f"{len(parts)} parts for one file")
    fs.rename(parts[0], target)
    fs.delete(p, True)


def write_keyed(df: DataFrame, path: str, key: str = "question_id") -> None:
    """By the path's end: ``.json`` one object {key: record} (rows without key go, the last of a key counts in the order of ``_order``
    if there is such a column), else all rows as JSON lines. The object is one value and must fit a task; lines have no such bound."""
    if not path.lower().endswith(".json"):
        df.drop("_order").write.mode("overwrite").option("ignoreNullFields", "false").json(path)
        return
    rows = df.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "")
    names = [c for c in df.columns if c != "_order"]
    order = F.col("_order") if "_order" in df.columns else F.lit(0)
    last = rows.groupBy(F.col(key).cast("string").alias("_key")).agg(F.max_by(F.struct(*names), order).alias("row"))
    entry = F.concat(F.to_json(F.array("_key")).substr(F.lit(2), F.length(F.to_json(F.array("_key"))) - 2), F.lit(": "), F.to_json("row", {"ignoreNullFields": "false"}))
    whole = last.agg(F.concat(F.lit("{\n"), F.array_join(F.array_sort(F.collect_list(entry)), ",\n"), F.lit("\n}")).alias("value"))
    whole.coalesce(1).write.mode("overwrite").text(f"{path}.parts")
    _join_parts(df.sparkSession, f"{path}.parts", path)


def remove_outputs(spark: SparkSession, path: str, suffix: str) -> int:
    """Deletes ``*{suffix}.json`` one folder down; returns how many there were."""
    p, fs = _path(spark, f"{path.rstrip('/')}/*/*{suffix}.json")
    found = list(fs.globStatus(p) or [])
    return sum(bool(fs.delete(s.getPath(), True)) for s in found)
