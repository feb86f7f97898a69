"""Readers: parquet pages, JSON arrays, keyed JSON objects, JSON lines with line numbers, folders, templates and configuration."""

from __future__ import annotations

import os
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE = "_metadata.file_name"


def read_pages(spark: SparkSession, path: str, pattern: str | None = None, file_column: str | None = None, skip_bad_files: bool = False) -> DataFrame:
    """Parquet pages: only the columns that a plan uses are read. ``pattern`` picks files by name (``part-*``)."""
    reader = spark.read.option("ignoreCorruptFiles", str(skip_bad_files).lower())
    df = (reader.option("pathGlobFilter", pattern) if pattern else reader).parquet(path)
    return df.withColumn(file_column, F.col(FILE)) if file_column else df


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> list[str]:
    """Paths of files in order. ``pattern`` is a Hadoop glob below ``path``; only names are listed, on the driver."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{pattern}")
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return sorted(str(s.getPath()) for s in found or [] if s.isFile())


def first_files(spark: SparkSession, path: str, n: int, pattern: str = "part-*") -> list[str]:
    """For trial runs: the first ``n`` files by name."""
    return list_files(spark, path, pattern)[:n]


def _whole(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"), F.col(FILE).alias("source_file"))


def _schema(schema: str | T.DataType) -> T.DataType:
    return T._parse_datatype_string(schema) if isinstance(schema, str) else schema


def read_json_arrays(spark: SparkSession, path: str | list[str], schema: str | T.StructType) -> DataFrame:
    """Rows of files that each hold one JSON array, with ``source_file``. Files that hold anything else, or don't parse, are skipped."""
    kind = T.ArrayType(_schema(schema))
    rows = _whole(spark, path).where(F.col("value").rlike(r"^\s*\["))
    return rows.select("source_file", F.explode(F.from_json("value", kind)).alias("row")).select("row.*", "source_file")


def read_keyed_json(spark: SparkSession, path: str, schema: str | T.StructType, key: str = "question_id") -> DataFrame:
    """Rows of a JSON object {key: record}. The key comes from the object, a field of that name in the record is not used."""
    kind = T.MapType(T.StringType(), _schema(schema))
    rows = _whole(spark, path).select(F.explode(F.from_json("value", kind)).alias("key", "row"))
    return rows.select(F.col("key").alias(key), *[F.col("row")[f].alias(f) for f in kind.valueType.names if f != key])


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, line_num, value) of text files; numbers start at 1 in each file.

    Blocks of a file are numbered apart, then shifted by the lines of the blocks before them: only a count per block is gathered.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    inside = Window.partitionBy("path", "block").orderBy("at")
    lines = lines.withColumn("n", F.row_number().over(inside))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shift = lines.groupBy("path", "block").agg(F.max("n").alias("n")).select("path", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    return lines.join(shift, ["path", "block"]).select("path", (F.col("shift") + F.col("n")).alias("line_num"), "value")


def read_json_lines(spark: SparkSession, path: str, schema: str | T.StructType, strict: bool = False) -> DataFrame:
    """JSON lines; bad ones are left out, or end the run if ``strict``."""
    return spark.read.schema(_schema(schema)).json(path, mode="FAILFAST" if strict else "DROPMALFORMED")


def last_by_key(rows: DataFrame, key: str, order: str | Column) -> DataFrame:
    """For each key its last row in ``order``; rows without a key go."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc() if isinstance(order, str) else order.desc())
    kept = rows.where(F.col(key).isNotNull() & (F.col(key) != ""))
    return kept.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def read_problems(spark: SparkSession, path: str, schema: str | T.StructType, key: str = "question_id") -> DataFrame:
    """JSON lines by key as string; the last line of a key counts, one bad line ends the run."""
    kind = _schema(schema)
    row = F.from_json("value", kind, {"mode": "FAILFAST"})
    rows = numbered_lines(spark, path).where(F.trim("value") != "").select("line_num", row.alias("row")).select("line_num", "row.*")
    rows = rows.withColumn(key, F.coalesce(F.col(key).cast("string"), F.lit("None")))
    return last_by_key(rows, key, "line_num").drop("line_num")


def read_domain_counts(spark: SparkSession, path: str) -> DataFrame:
    """(domain, n) from a saved statistics report."""
    report = _whole(spark, path).select(F.from_json("value", "domain_distribution map<string, bigint>").alias("r"))
    return report.select(F.explode("r.domain_distribution").alias("domain", "n"))


def read_domain_folders(spark: SparkSession, path: str, schema: str | T.StructType, leave_out_suffix: str | None = None) -> DataFrame:
    """JSON arrays of ``path/<folder>/*.json`` with ``folder`` and ``source_file``; hidden folders, and files that end in the suffix, are left out."""
    rows = _whole(spark, f"{path.rstrip('/')}/*/*.json").withColumn("folder", F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1))
    rows = rows.where(~F.col("folder").startswith(".") & F.col("value").rlike(r"^\s*\["))
    if leave_out_suffix:
        rows = rows.where(~F.col("source_file").endswith(f"{leave_out_suffix}.json"))
    kind = T.ArrayType(_schema(schema))
    return rows.select("folder", "source_file", F.explode(F.from_json("value", kind)).alias("row")).select("row.*", "folder", "source_file")


# -- settings, read on the driver
def read_settings(path: str) -> dict:
    """A flat YAML file: ``key: value`` lines and ``key: |`` blocks; in full where a YAML library is installed."""
    text = Path(path).read_text(encoding="utf-8")
    try:
        import yaml
    except ImportError:
        return _flat_yaml(text)
    try:
        return yaml.safe_load(text) or {}
    except yaml.YAMLError as e:
        raise ValueError(f"{path}: {e}") from e


def _scalar(s: str):
    s = s.strip()
    if s[:1] in "'\"" and s[-1:] == s[:1] and len(s) > 1:
        return s[1:-1]
    if re.fullmatch(r"[-+]?\d+", s):
        return int(s)
    return {"true": True, "false": False, "null": None, "": None}.get(s.lower(), s)


def _flat_yaml(text: str) -> dict:
    out: dict = {}
    lines = text.split("\n")
    k = 0
    while k < len(lines):
        line = lines[k]
        k += 1
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        m = re.match(r"([\w.-]+):(.*)$", line)
        if not m:
            raise ValueError(f"not a flat setting: {line!r}")
        if m[2].strip() in ("|", "|-"):
            block = []
            while k < len(lines) and (not lines[k].strip() or lines[k][0] == " "):
                block.append(lines[k])
                k += 1
            indent = min((len(x) - len(x.lstrip()) for x in block if x.strip()), default=0)
            body = "\n".join(x[indent:] for x in block).rstrip("\n")
            out[m[1]] = body + ("\n" if m[2].strip() == "|" and body and k < len(lines) else "")
        else:
            out[m[1]] = _scalar(m[2].split(" #")[0])
    return out


#: What a missing template reads as.
NO_TEMPLATE = {"prompt_template": "No template found"}


def read_template(*paths: str) -> dict:
    """Settings of the first path that can be read; ``NO_TEMPLATE`` if none can."""
    for p in paths:
        try:
            return read_settings(p)
        except (OSError, ValueError):
            continue
    return dict(NO_TEMPLATE)


def endpoint_settings(env: dict[str, str] | None = None) -> dict:
    """Where models and sandboxes are, from the environment; nothing is built in."""
    e = os.environ if env is None else env
    return {
        "endpoint": e.get("LLM_ENDPOINT"),
        "key": e.get("LLM_API_KEY"),
        "model": e.get("LLM_MODEL"),
        "max_tokens": int(e.get("LLM_MAX_TOKENS", 16_000)),
        "system_prompt": e.get("LLM_SYSTEM_PROMPT", ""),
        "sandbox": e.get("SANDBOX_ENDPOINT"),
    }
