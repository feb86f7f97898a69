"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked where few bits differ, grouped by reachability.

Equal fingerprints are grouped first (partial aggregation, so a third of all rows being one text costs one row a task).
Distinct fingerprints meet in cells: the 64 bits are cut into 5 blocks, a pair within 3 bits agrees on at least 2 of them,
so the 10 choices of 2 blocks reach every link. A cell is compared exactly, tile against tile, with exclusive-or and bit
counts; rows lie in the order of their bit counts and tile pairs whose counts differ beyond the radius are skipped. A cell
too large for one task is cut by bit count and hash into tiles, and each tile pair within reach becomes a task of its own.
A cell gives a spanning forest of its links, never all pairs, and alternating star rounds join the forests.

Defined results: null and empty texts have fingerprint zero and link like any other; a null id never is a component's
name unless all its ids are null; equal ids are rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import Scratch, marked
from .components import connected

BLOCKS, RADIUS, SEED = 5, 3, 42
#: Rows of a cell that one task compares; larger cells are cut.
CELL, TILE = 32_768, 1_024
_LANES = np.uint64(0x0101010101010101)
_SHIFTS = np.arange(8, dtype=np.uint64)[:, None]


def shingle_hashes(ws: list[bytes], width: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every shingle of ``width`` words joined by a space; of the whole sequence when it is shorter."""
    if not ws:
        return np.empty(0, dtype=np.uint64)
    joined, h = b" ".join(ws), xxhash.xxh64_intdigest
    if len(ws) <= width:
        return np.array([h(joined, seed)], dtype=np.uint64)
    size = np.fromiter(map(len, ws), dtype=np.int64, count=len(ws))
    end = np.cumsum(size + 1) - 1
    begin = end - size
    n = len(ws) - width + 1
    return np.fromiter((h(joined[a:b], seed) for a, b in zip(begin[:n].tolist(), end[width - 1 :].tolist(), strict=True)), dtype=np.uint64, count=n)


def majority(h: np.ndarray) -> int:
    """Bits set in over half of the hashes: eight lane counters in a word, folded before a lane can overflow."""
    n, total = len(h), np.zeros((8, 8), dtype=np.int64)
    for k in range(0, n, 255 * 1024):
        part = h[k : k + 255 * 1024]
        rows = -(-len(part) // 255)
        padded = np.zeros(rows * 255, dtype=np.uint64)
        padded[: len(part)] = part
        lanes = ((padded[None, :] >> _SHIFTS) & _LANES).reshape(8, rows, 255).sum(axis=2, dtype=np.uint64)
        total += lanes.view(np.uint8).reshape(8, rows, 8).sum(axis=1, dtype=np.int64)
    bits = (2 * total > n).T  # [byte, bit]
    return int(np.packbits(bits, axis=1, bitorder="little").reshape(8).view("<u8")[0])


def fingerprint(text: str | None, width: int = 3) -> int:
    ws = (text or "").encode("utf-8", "replace").lower().split()
    return majority(shingle_hashes(ws, width)) if ws else 0


def fingerprint_column(text: Column, width: int = 3) -> Column:
    """The fingerprint as a signed long."""

    @F.pandas_udf("long")
    def run(t: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(x, width) for x in t], dtype=np.uint64).view(np.int64))

    return run(text)


def masks() -> list[int]:
    edges = [round(64 * k / BLOCKS) for k in range(BLOCKS + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    both = [sum(c) for c in combinations(block, BLOCKS - RADIUS)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in both]


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def cell_forest(fp: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Edges that join what is linked within a cell, one fewer than rows in each group. Tiles whose bit counts differ beyond the radius are skipped."""
    order = np.argsort(np.bitwise_count(fp), kind="stable")
    x = fp[order]
    count = np.bitwise_count(x).astype(np.int64)
    forest, edges, label = _Forest(len(x)), [], np.arange(len(x))
    for i in range(0, len(x), TILE):
        a = slice(i, min(i + TILE, len(x)))
        for j in range(i, len(x), TILE):
            b = slice(j, min(j + TILE, len(x)))
            if count[b.start] - count[a.stop - 1] > radius:
                break
            near = np.bitwise_count(x[a][:, None] ^ x[b][None, :]) <= radius
            while True:
                apart = near & (label[a][:, None] != label[b][None, :])
                rows = np.flatnonzero(apart.any(axis=1))
                if not len(rows):
                    break
                for r, c in zip((rows + i).tolist(), (apart[rows].argmax(axis=1) + j).tolist(), strict=True):
                    if forest.join(r, c):
                        edges.append((int(fp[order[r]]), int(fp[order[c]])))
                label = np.array([forest.find(k) for k in range(len(x))]) if len(x) <= 4 * TILE else _relabel(forest.up)
    return edges


def _relabel(up: list[int]) -> np.ndarray:
    u = np.asarray(up)
    while not np.array_equal(v := u[u], u):
        u = v
    return u


def _links(key: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of whole cells that lie in order: small cells all at once by shifting, larger ones tile by tile."""
    out_a, out_b = [], []
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.append(starts, len(key)))
    small = np.repeat(sizes <= 8, sizes)
    for d in range(1, 8):
        if len(fp) <= d:
            break
        hit = small[d:] & (key[d:] == key[:-d]) & (np.bitwise_count(fp[d:] ^ fp[:-d]) <= radius)
        out_a.append(fp[d:][hit])
        out_b.append(fp[:-d][hit])
    for s, n in zip(starts[sizes > 8].tolist(), sizes[sizes > 8].tolist(), strict=True):
        if e := cell_forest(fp[s : s + n], radius):
            e = np.array(e, dtype=np.uint64)
            out_a.append(e[:, 0])
            out_b.append(e[:, 1])
    empty = np.empty(0, dtype=np.uint64)
    return np.concatenate([empty, *out_a]), np.concatenate([empty, *out_b])


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held_k, held_f = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)

    def frame(k: np.ndarray, f: np.ndarray) -> pd.DataFrame:
        a, b = _links(k, f, RADIUS)
        return pd.DataFrame({"u": a.view(np.int64), "v": b.view(np.int64)})

    for b in batches:
        k = np.concatenate([held_k, b["cell"].to_numpy()])
        f = np.concatenate([held_f, b["fp"].to_numpy().view(np.uint64)])
        if not len(k):
            continue
        cut = int(np.searchsorted(k, k[-1]))  # the last cell may go on in the next batch
        if cut:
            yield frame(k[:cut], f[:cut])
        held_k, held_f = k[cut:], f[cut:]
    if len(held_k):
        yield frame(held_k, held_f)


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """(u, v) of distinct fingerprints ``fp``: enough links within the radius to connect whatever is connected."""
    rows = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for t, m in enumerate(masks())])).alias("c")).select("fp", F.xxhash64("c.t", "c.k").alias("key"))
    counts = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = rows.join(counts, "key")
    few = met.where(F.col("n") <= CELL).select(F.col("key").alias("cell"), "fp")
    sub = F.ceil(F.col("n") / F.lit(4 * CELL)).cast("int")
    pc = F.bit_count("fp").cast("int")
    tile = F.pmod(F.hash("fp"), F.col("sub"))
    mine = F.struct(F.col("pc").alias("p"), F.col("tile").alias("s"))
    many = met.where(F.col("n") > CELL).withColumn("sub", sub).withColumn("pc", pc).withColumn("tile", tile)
    many = many.withColumn("p2", F.explode(F.sequence(F.col("pc") - RADIUS, F.col("pc") + RADIUS))).withColumn("s2", F.explode(F.sequence(F.lit(0), F.col("sub") - 1)))
    other = F.struct(F.col("p2").alias("p"), F.col("s2").alias("s"))
    many = many.select(F.xxhash64("key", F.least(mine, other), F.greatest(mine, other)).alias("cell"), "fp")
    cells = few.unionByName(many)
    return cells.repartition("cell").sortWithinPartitions("cell").mapInPandas(_compare, "u long, v long").distinct()


def simhash_groups(fps: DataFrame, scratch: Scratch) -> DataFrame:
    """(fp, root) of the fingerprints that link to another one, given the distinct ones."""
    links = scratch.save(fingerprint_links(fps), "links")
    return connected(links, scratch)


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 lowercase hex digits), ``component_id`` (smallest id reachable)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "simhash")
    mine = scratch.save(docs.select(F.col(id_col).alias("id"), fingerprint_column(F.col(text_col), width).alias("fp")), "fingerprints")
    fps = scratch.save(mine.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    groups = simhash_groups(fps.select("fp"), scratch)
    named = groups.join(fps, "fp")
    names = named.groupBy("root").agg(F.min("least").alias("name"))
    by_fp = scratch.save(fps.join(groups, "fp", "left").join(names, "root", "left").select("fp", F.coalesce("name", "least").alias("component_id")), "named")
    return mine.join(by_fp, "fp", "left").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """The documents, all columns, without near-copies: of each group the row with the smallest id (null last), then hash of its text, stays."""
    scratch = Scratch(docs.sparkSession, "keepone")
    # The fingerprint reads the text once; ids and hashes stand for the row from here on.
    mine = scratch.save(docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), fingerprint_column(F.col(text_col), width).alias("node")), "fingerprints")
    fps = scratch.save(mine.select(F.col("node").alias("fp")).distinct(), "distinct")
    groups = simhash_groups(fps, scratch)
    return keep_first(docs, mine, groups.select(F.col("fp").alias("node"), "root"), scratch, id_col, text_col)


def keep_first(docs: DataFrame, rows: DataFrame, roots: DataFrame, scratch: Scratch, id_col: str, text_col: str) -> DataFrame:
    """The rows of docs that stay, given ``rows(id, th, node)`` of all of them and ``roots(node, root)`` of the nodes in groups of several.

    Decided on ids and hashes. Of the texts, those that a bitmap of the list of what goes knows nothing of stay in place; the
    others are shuffled to meet the list, by the same join at any size of it. Rows equal in id and text, of which one stays, are looked for and only then treated apart.
    """
    rooted = scratch.save(rows.join(roots, "node", "left").select("id", "th", F.coalesce("root", "node").alias("root")), "rooted")
    least = F.min(F.struct(F.col("id").isNull().alias("z"), "id", "th")).alias("least")
    firsts = scratch.save(rooted.groupBy("root").agg(least), "firsts")
    same = F.col("id").eqNullSafe(F.col("least.id")) & (F.col("th") == F.col("least.th"))
    gone = rooted.join(firsts, "root").where(~same).select(F.col("id").alias("__gone_id"), F.col("th").alias("__gone_th")).distinct()
    gone = scratch.save(gone, "gone")
    twice = rooted.groupBy("id", "th").agg(F.count("*").alias("n")).where("n > 1").select(F.col("id").alias("__gone_id"), F.col("th").alias("__gone_th"))
    twice = scratch.save(twice, "twice")
    on = F.col(id_col).eqNullSafe(F.col("__gone_id")) & (F.xxhash64(text_col) == F.col("__gone_th"))
    maybe = marked(docs, F.xxhash64(id_col, F.xxhash64(text_col)), gone, F.xxhash64("__gone_id", "__gone_th"), "__gone_maybe")
    held = maybe.where("__gone_maybe").drop("__gone_maybe").join(gone.hint("merge"), on, "left_anti")
    kept = maybe.where("not __gone_maybe").drop("__gone_maybe").unionByName(held)
    if twice.isEmpty():
        return kept
    again = kept.join(twice, on, "left_semi").withColumn("__gone_hash", F.xxhash64(text_col)).dropDuplicates([id_col, "__gone_hash"]).drop("__gone_hash")
    return kept.join(twice, on, "left_anti").unionByName(again)
