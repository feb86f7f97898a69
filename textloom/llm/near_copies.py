"""Operator 7 by similarity: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, grouped by reachability.

Documents of equal sets are one row from the start. Sets meet in cells: 32 bands of 5 minhashes, which a pair of similarity 0.8
misses three times in a million (1 - 0.8^5)^32. The sets themselves travel to the cells, each once a cell, so nothing is ever
written per pair: a cell is compared in tiles by exclusive-or and bit counts of SimHashes (tiles whose bit counts differ beyond the
radius are skipped; 23 bits, where a pair of similarity 0.8 lies 10 apart in the mean), and what is near and not yet in one group is verified
by the exact similarity of the two sets. A cell gives a spanning forest of its verified links.

A cell too large for a task is first cut into tiles by hash, each compared by itself; bands cut the same group in other places, so
alike sets join nearly at once. Then only members outside a cell's largest group are held against all of it, tile by tile, so
that every pair of a cell is verified, refuted or within one group; a group of n alike sets costs n comparisons, not their square.

Words are lower-cased (A-Z). Defined results: a text of fewer than five words is one shingle; null and empty texts have the empty set
and are one group; an empty table gives an empty result. Equality of shingles rests on 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import STEP, Scratch, hashed_shingles, marked, mixed
from .components import connected
from .simhash import TILE, _Forest, keep_first, majority

WIDTH, THRESHOLD, BANDS, ROWS, RADIUS = 5, 0.8, 32, 5, 23
#: What one task compares at once: sets, and shingles in them. Larger cells are cut.
CELL, SHINGLES = 2_048, 4_000_000
_DRAW = np.random.default_rng(42)
_MULTIPLY = (_DRAW.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_MIX = _DRAW.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)[:, None]


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    return np.unique(hashed_shingles((text or "").encode("utf-8", "replace").lower().split(), WIDTH))


def band_keys(h: np.ndarray) -> np.ndarray:
    """A key for each band of minhashes of a set; none of the empty set."""
    if not len(h):
        return np.empty(0, dtype=np.uint64)
    x = (h >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, (1 << 32) - 1, dtype=np.uint32)
    for k in range(0, len(x), 2048):
        y = x[None, k : k + 2048] ^ _MIX
        y *= _MULTIPLY
        np.minimum(least, y.min(axis=1), out=least)
    key = np.arange(BANDS, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        key = mixed(key * STEP + row)
    return key


def set_name(h: np.ndarray) -> int:
    """A hash of a set."""
    return int(mixed(np.array([mixed(h).sum(dtype=np.uint64) + np.uint64(len(h))], dtype=np.uint64))[0]) if len(h) else 0


def cell_links(name: np.ndarray, root: np.ndarray, fp: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the verified links between members of unequal roots."""
    label = np.unique(root, return_inverse=True)[1]
    if not label.any():
        return []
    count = np.bitwise_count(fp).astype(np.int64)
    order = np.argsort(count, kind="stable")
    name, fp, count, label = name[order], fp[order], count[order], label[order]
    sets = [sets[k] for k in order.tolist()]
    size = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    start = np.cumsum(size) - size
    held, ids = np.unique(np.concatenate(sets), return_inverse=True)  # shingles as numbers of the cell
    mine = np.zeros(len(held), dtype=bool)
    forest, edges = _Forest(int(label.max()) + 1), []
    for i in range(0, len(fp), TILE):
        a = slice(i, min(i + TILE, len(fp)))
        for j in range(i, len(fp), TILE):
            b = slice(j, min(j + TILE, len(fp)))
            if count[b.start] - count[a.stop - 1] > RADIUS:
                break
            near = np.bitwise_count(fp[a][:, None] ^ fp[b][None, :]) <= RADIUS
            near &= np.minimum(size[a][:, None], size[b][None, :]) >= THRESHOLD * np.maximum(size[a][:, None], size[b][None, :])
            near &= label[a][:, None] != label[b][None, :]
            if i == j:
                near = np.triu(near, 1)
            for r in np.flatnonzero(near.any(axis=1)).tolist():
                p = i + r
                q = np.flatnonzero(near[r] & (label[b] != label[p])) + j
                if not len(q):
                    continue
                mine[ids[start[p] : start[p] + size[p]]] = True
                ends = np.cumsum(size[q])
                both = np.add.reduceat(mine[np.concatenate([ids[start[k] : start[k] + size[k]] for k in q.tolist()])], ends - size[q], dtype=np.int64)
                mine[ids[start[p] : start[p] + size[p]]] = False
                for k in q[both >= THRESHOLD * (size[p] + size[q] - both)].tolist():
                    if forest.join(int(label[p]), int(label[k])):
                        edges.append((int(name[p]), int(name[k])))
                        x, y = label[p], label[k]
                        label[label == max(x, y)] = min(x, y)
    return edges


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of whole cells, in order."""

    def frame(b: pd.DataFrame) -> pd.DataFrame:
        cell = b["cell"].to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        name, root, fp, h = b["name"].to_numpy(), b["root"].to_numpy(), b["fp"].to_numpy().view(np.uint64), b["h"].tolist()
        out = [e for s, z in zip(starts.tolist(), [*starts[1:].tolist(), len(cell)], strict=True) for e in cell_links(name[s:z], root[s:z], fp[s:z], h[s:z])]
        return pd.DataFrame(out, columns=["u", "v"]).astype("int64")

    held: list[pd.DataFrame] = []  # the last cell may go on in the next batch
    for b in batches:
        if not len(b):
            continue
        cell = b["cell"].to_numpy()
        cut = int(np.searchsorted(cell, cell[-1]))
        if cut or (held and held[0]["cell"].iloc[0] != cell[0]):
            yield frame(pd.concat([*held, b.iloc[:cut]], ignore_index=True))
            held = []
        held.append(b.iloc[cut:])
    if held:
        yield frame(pd.concat(held, ignore_index=True))


def _pieces(n: Column, shingles: Column) -> Column:
    """Into how many tiles so many sets with so many shingles are cut."""
    return F.greatest(F.ceil(n / F.lit(CELL)), F.ceil(shingles / F.lit(SHINGLES)), F.lit(1)).cast("int")


def _links(rows: DataFrame, held: DataFrame) -> DataFrame:
    """(u, v) from rows(cell, name, root, fp) and held(name, h)."""
    full = rows.join(held, "name").select("cell", "name", "root", "fp", "h")
    return full.repartition("cell").sortWithinPartitions("cell").mapInPandas(_compare, "u long, v long").distinct()


def _met(sets: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(name, fp, n, key) of sets that share a band with another, and (key, sub) of those bands; bands with the same members are one."""
    rows = sets.select("name", "fp", "n", F.explode("keys").alias("key"))
    mark = F.sum(F.xxhash64("name").cast("decimal(20,0)")).alias("s")
    counts = rows.groupBy("key").agg(F.count("*").alias("c"), F.sum("n").alias("w"), F.min("name").alias("a"), F.max("name").alias("b"), mark).where("c > 1")
    bands = counts.groupBy("c", "w", "a", "b", "s").agg(F.min("key").alias("key")).select("key", _pieces(F.col("c"), F.col("w")).alias("sub"))
    bands = scratch.save(bands, "bands")
    return scratch.save(rows.join(bands, "key"), "met"), bands


def _rest(met: DataFrame, groups: DataFrame) -> DataFrame:
    """rows(cell, name, root, fp) of cut cells that hold several groups: members outside the largest group against each other and against it."""
    of = groups.select(F.col("fp").alias("name"), "root")
    rows = met.where("sub > 1").join(of, "name", "left").withColumn("root", F.coalesce("root", "name"))
    per = rows.groupBy("key", "root").agg(F.count("*").alias("c"), F.sum("n").alias("w"))
    cells = per.groupBy("key").agg(F.max(F.struct("c", "w", "root")).alias("x"), F.sum("c").alias("c"), F.sum("w").alias("w")).where(F.col("c") > F.col("x.c"))
    few = _pieces(F.col("c") - F.col("x.c"), F.col("w") - F.col("x.w"))
    cells = cells.select("key", F.col("x.root").alias("main"), _pieces(F.col("x.c"), F.col("x.w")).alias("many"), few.alias("few"))
    both = rows.join(cells, "key").withColumn("in", F.col("root") == F.col("main"))
    both = both.withColumn("t", F.pmod(F.xxhash64("name", "key"), F.when(F.col("in"), F.col("many")).otherwise(F.col("few"))).cast("int"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    unit = lambda kind, a, b: F.struct(F.lit(kind).alias("k"), a.alias("a"), b.alias("b"))
    units = F.when(F.col("in"), F.transform(upto("few"), lambda x: unit(0, F.col("t"), x))).otherwise(
        F.concat(F.transform(upto("many"), lambda x: unit(0, x, F.col("t"))), F.transform(upto("few"), lambda x: unit(1, F.least(F.col("t"), x), F.greatest(F.col("t"), x))))
    )
    return both.select("key", "name", "root", "fp", F.explode(units).alias("u")).select(F.xxhash64("key", "u.k", "u.a", "u.b").alias("cell"), "name", "root", "fp")


def near_groups(met: DataFrame, bands: DataFrame, held: DataFrame, scratch: Scratch) -> DataFrame:
    """(fp, root) of names of sets that are linked to others."""
    tile = F.pmod(F.xxhash64("name", "key"), F.col("sub")).cast("int")
    links = scratch.save(_links(met.select(F.xxhash64("key", tile).alias("cell"), "name", F.col("name").alias("root"), "fp"), held), "links")
    groups = scratch.save(connected(links, scratch), "groups")
    if bands.where("sub > 1").isEmpty():
        return groups
    more = scratch.save(_links(_rest(met, groups), held), "more")
    return scratch.save(connected(links.unionByName(more), scratch), "all")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, without near-copies: of each group the row with the smallest id (null last), then hash of its text, stays."""
    scratch = Scratch(docs.sparkSession, "nearcopies")

    def sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(set_name(h), majority(h) if len(h) else 0, len(h), band_keys(h).view(np.int64)) for h in map(shingle_set, b["t"])]
            name, fp = (np.array([r[k] for r in rows], dtype=np.uint64).view(np.int64) for k in (0, 1))
            yield pd.DataFrame({"id": b["id"].array, "th": b["th"], "name": name, "fp": fp, "n": [r[2] for r in rows], "keys": [r[3] for r in rows]})

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            h = [shingle_set(t) for t in b["t"]]
            yield pd.DataFrame({"name": np.array([set_name(x) for x in h], dtype=np.uint64).view(np.int64), "h": [x.view(np.int64) for x in h]})

    src = docs.select(F.col(id_col).cast("string").alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("t"))
    mine = src.mapInPandas(sketches, "id string, th long, name long, fp long, n long, keys array<long>")
    mine = scratch.save(mine.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType)), "sketches")
    sets = mine.groupBy("name").agg(F.min(F.struct("id", "th")).alias("x"), F.first("fp").alias("fp"), F.first("n").alias("n"), F.first("keys").alias("keys"))
    sets = scratch.save(sets, "distinct")
    met, bands = _met(sets, scratch)
    # One text of each set that meets another is read again for its shingles; all others travel no further than their sketch, but for
    # a few that the bitmap takes for one of these. Merged, never broadcast, so that the stage's shuffle is in proportion to its input at every size.
    one = sets.join(met.select("name").distinct(), "name", "left_semi").select(F.col("x.id").alias("i2"), F.col("x.th").alias("th2"))
    one = scratch.save(one, "asked")
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("t"))
    texts = marked(texts, F.xxhash64("id", "th"), one, F.xxhash64("i2", "th2"), "maybe").where("maybe")
    texts = texts.join(one.hint("merge"), F.col("id").eqNullSafe(F.col("i2")) & (F.col("th") == F.col("th2")), "left_semi").select("t")
    held = texts.mapInPandas(hashes, "name long, h array<long>").groupBy("name").agg(F.first("h").alias("h"))
    groups = near_groups(met, bands, scratch.save(held, "sets"), scratch)
    return keep_first(docs, mine.select("id", "th", F.col("name").alias("node")), groups.select(F.col("fp").alias("node"), "root"), scratch, id_col, text_col)
