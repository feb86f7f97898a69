"""What several operators share: words, scratch tables and files that every executor can reach."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but space, tab, LF, VT, FF and CR. ``bytes.split()`` splits in the same places.
WORD = r"[^\x20\x09-\x0D]+"
#: Pieces of a bitmap of fixed size, 4 KB each, 4 MB in all.
PIECES, PIECE_BITS = 1_024, 32_768
_own: dict[str, str] = {}


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").split()


class _Words(dict):
    """Hashes of words already met."""

    def __missing__(self, w: bytes) -> int:
        if len(self) >= 400_000:
            self.clear()
        h = self[w] = xxhash.xxh64_intdigest(w, 42)
        return h


_words = _Words()
STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def hashed_shingles(ws: list[bytes], width: int) -> np.ndarray:
    """64-bit hashes of every ``width`` words in a row; of the whole sequence when it is shorter."""
    if not ws:
        return np.empty(0, dtype=np.uint64)
    a = np.fromiter(map(_words.__getitem__, ws), dtype=np.uint64, count=len(ws))
    width = min(width, len(ws))
    n = len(ws) - width + 1
    h = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        h = mixed(h * STEP + a[k : k + n])
    return h


def word_count(text: Column) -> Column:
    """Words of a string column; 0 for null. JVM-side."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``. Where it is unset and all runs in one process (tests), a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set: driver and executors need a folder that all of them reach")
    if "dir" not in _own:
        _own["dir"] = "file://" + tempfile.mkdtemp(prefix="textloom-")
    return _own["dir"]


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def make_dir(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/textloom-{name}-{uuid.uuid4().hex[:12]}"
    p, fs = _fs(spark, path)
    fs.mkdirs(p)
    return path


class Scratch:
    """Tables written in the shared folder to cut lineage: an executor lost later costs no recomputation of what came before."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths, self._root = spark, name, {}, None

    @property
    def root(self) -> str:
        if self._root is None:
            self._root = make_dir(self.spark, self.name)
            atexit.register(self._remove, self._root)
        return self._root

    def save(self, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path, compression=compression)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for n in names:
            if path := self.paths.pop(n, None):
                self._remove(path)

    def _remove(self, path: str) -> None:
        try:
            p, fs = _fs(self.spark, path)
            fs.delete(p, True)
        except Exception:  # the session has ended: what is left is the cluster's to sweep
            pass


def marked(rows: DataFrame, key: Column, listed: DataFrame, listed_key: Column, name: str) -> DataFrame:
    """rows with a boolean ``name``: true wherever the long ``key`` is a ``listed_key`` of ``listed``, and for a few others.

    It tells which rows need not be shuffled to meet a list that is too long to broadcast. The bitmap has 2^25 bits at any size of
    the list, so the longer the list the more others are true (all of them far beyond 2^25 keys): join what is true with the list.
    """
    spot = lambda k: F.pmod(k, F.lit(PIECES * PIECE_BITS))
    piece = F.floor(F.col("__mark_spot") / PIECE_BITS).cast("int")
    bit = F.pmod("__mark_spot", F.lit(PIECE_BITS)).cast("int")
    bitmap = listed.select(spot(listed_key).alias("__mark_spot")).groupBy(piece.alias("__mark_piece")).agg(F.bitmap_construct_agg(bit).alias("__mark_bits"))
    found = rows.withColumn("__mark_spot", spot(key)).withColumn("__mark_piece", piece).join(F.broadcast(bitmap), "__mark_piece", "left")
    byte = F.conv(F.hex(F.substring("__mark_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.call_function("shiftright", byte, F.pmod(bit, F.lit(8)).cast("int")).bitwiseAND(F.lit(1)) == 1
    return found.withColumn(name, F.coalesce(hit, F.lit(False))).drop("__mark_spot", "__mark_piece", "__mark_bits")


def slices(batches, rows: int = 512):
    """Batches in slices of so many rows, for what holds several times its input. Spark itself bounds the bytes of a batch."""
    for b in batches:
        for k in range(0, len(b), rows):
            yield b.iloc[k : k + rows]


def file_system(uri: str):
    """(pyarrow file system, path in it) of a URI that executors and driver share."""
    from pyarrow import fs

    if re.match(r"file:/[^/]", uri):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)

