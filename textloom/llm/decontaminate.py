"""Benchmark decontamination: passages of documents that repeat a benchmark item.

An item of n words is held against the windows of n words of every document. Windows and items get 64-bit SimHashes of
their five-word shingles. The fingerprints of items lie in four tables by block of 16 bits; a window meets those items that have
a block within 5 bits of its own, so every item within 4 * 6 - 1 = 23 bits (beyond it lies about one in 10^6 pairs of similarity 0.8). Those
met are verified by the exact weighted Jaccard similarity of the shingle multisets, 0.8 or more.
A window without one shingle of the item has similarity 0, so only windows around shared shingles are fingerprinted.

Words are lower-cased; they are runs of anything but ASCII white space. Items shorter than five words are one shingle. Equality of
shingles rests on 64-bit hashes.

Defined results: null and empty texts and items match nothing; equal items are reported each; repeated rows are judged each
by itself; an empty table or benchmark gives no match. Text is read once, in place: nothing of it is shuffled. The index, arrays of
some 40 bytes a word of the benchmark, is sent to the executors while it stays under ``index_bytes``; a larger benchmark is dealt into
parts of that size, one pass each, and driver and executors hold one part at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import Scratch, hashed_shingles, words
from .simhash import majority

WIDTH, THRESHOLD, BLOCKS, BLOCK_RADIUS = 5, 0.8, 4, 5
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
#: Windows times values of a block that are compared at once.
_AT_ONCE = 1 << 22


def lowered(text: str | None) -> list[bytes]:
    return words(text.lower()) if text else []


def _spread(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers from each ``at`` on, ``n`` of them, one after another."""
    return np.arange(n.sum()) + np.repeat(at - (np.cumsum(n) - n), n)


class Index:
    """Items of a benchmark in arrays: sizes, fingerprints by block, shingles with their counts by item and items by shingle."""

    def __init__(self, items: list[tuple[int, str | None]]):
        self.ids, size, mark, bags, times = [], [], [], [], []
        self.short: dict[int, dict[int, list[int]]] = {}
        for item_id, text in items:
            if not (ws := lowered(text)):
                continue
            h = hashed_shingles(ws, WIDTH)
            if len(ws) < WIDTH:
                self.short.setdefault(len(ws), {}).setdefault(int(h[0]), []).append(len(self.ids))
                h = h[:0]
            bag, n = np.unique(h, return_counts=True)
            self.ids.append(item_id)
            size.append(len(ws))
            mark.append(majority(h) if len(h) else 0)
            bags.append(bag)
            times.append(n)
        self.size, self.mark = np.array(size, dtype=np.int64), np.array(mark, dtype=np.uint64)
        long = np.flatnonzero(self.size >= WIDTH)
        n = np.fromiter(map(len, bags), dtype=np.int64, count=len(bags))
        self.bag_at = np.concatenate([[0], np.cumsum(n)])
        self.bag = np.concatenate([np.empty(0, np.uint64), *bags])
        self.times = np.concatenate([np.empty(0, np.int64), *times]).astype(np.int32)
        order = np.argsort(self.bag, kind="stable")
        self.who = np.repeat(np.arange(len(bags)), n)[order].astype(np.int32)
        self.keys, first = np.unique(self.bag[order], return_index=True)
        self.key_at = np.append(first, len(order))
        self.maybe = np.zeros(1 << 20, dtype=bool)  # by the leading 20 bits: settles most shingles of a text at once
        self.maybe[(self.keys >> np.uint64(44)).astype(np.int64)] = True
        #: For each block: the values that occur, and the items of each.
        self.blocks = []
        for b in range(BLOCKS):
            value = (self.mark[long] >> np.uint64(16 * b)).astype(np.uint16)
            order = np.argsort(value, kind="stable")
            values, first = np.unique(value[order], return_index=True)
            self.blocks.append((values, np.append(first, len(order)), long[order]))

    def near(self, marks: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item): every item of ``size`` words within ``RADIUS`` bits of a window's fingerprint."""
        met = []
        for b, (values, at, items) in enumerate(self.blocks):
            mine = (marks >> np.uint64(16 * b)).astype(np.uint16)
            step = max(1, _AT_ONCE // max(1, len(values)))
            for k in range(0, len(marks), step):
                w, v = np.nonzero(np.bitwise_count(values[None, :] ^ mine[k : k + step, None]) <= BLOCK_RADIUS)
                n = at[v + 1] - at[v]
                w, item = np.repeat(w + k, n), items[_spread(at[v], n)]
                ok = (self.size[item] == size) & (np.bitwise_count(self.mark[item] ^ marks[w]) <= RADIUS)
                met.append(w[ok] * len(self.ids) + item[ok])
        both = np.unique(np.concatenate(met))
        return both // len(self.ids), both % len(self.ids)

    def similarity(self, item: int, bag: np.ndarray, times: np.ndarray) -> float:
        """Weighted Jaccard similarity of an item and a multiset of shingles."""
        a, b = int(self.bag_at[item]), int(self.bag_at[item + 1])
        mine, n = self.bag[a:b], self.times[a:b]
        at = np.minimum(np.searchsorted(mine, bag), len(mine) - 1)
        low = int(np.where(mine[at] == bag, np.minimum(n[at], times), 0).sum())
        return low / (int(n.sum()) + int(times.sum()) - low)

    def matches(self, text: str | None) -> list[tuple[int, int, int, float]]:
        """(item id, first word, words, similarity) of the best window of each item that the text repeats; ties go to the first window."""
        ws = lowered(text)
        if not ws or not self.ids:
            return []
        best: dict[int, tuple[float, int]] = {}
        for size, table in self.short.items():
            for p, h in enumerate(hashed_shingles(ws, size).tolist() if len(ws) >= size else ()):
                for k in table.get(h, ()):
                    best.setdefault(k, (1.0, p))
        if len(ws) >= WIDTH and len(self.keys):
            h = hashed_shingles(ws, WIDTH)
            p = np.flatnonzero(self.maybe[(h >> np.uint64(44)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.keys, h[p]), len(self.keys) - 1)
            ok = self.keys[at] == h[p]
            p, at = p[ok], at[ok]
            n = self.key_at[at + 1] - self.key_at[at]
            size = self.size[self.who[_spread(self.key_at[at], n)]]
            p = np.repeat(p, n)
            for s in np.unique(size).tolist():
                here = np.unique(p[size == s])
                lo, hi = np.maximum(0, here + WIDTH - s), np.minimum(here, len(ws) - s) + 1
                lo, hi = lo[hi > lo], hi[hi > lo]
                if len(lo):
                    edge = np.zeros(len(ws) + 1, dtype=np.int64)
                    np.add.at(edge, lo, 1)
                    np.add.at(edge, hi, -1)
                    self._windows(h, s, np.flatnonzero(np.cumsum(edge) > 0), best)
        return [(self.ids[k], p, int(self.size[k]), s) for k, (s, p) in sorted(best.items())]

    def _windows(self, h: np.ndarray, size: int, firsts: np.ndarray, best: dict[int, tuple[float, int]]) -> None:
        """Fingerprints windows that lie side by side from running sums of their bits."""
        width = size - WIDTH + 1
        for g in np.split(firsts, np.flatnonzero(np.diff(firsts) > width) + 1):
            for at in range(0, len(g), 4096):  # bounds the sums kept for a long run
                self._run(h, size, width, g[at : at + 4096], best)

    def _run(self, h: np.ndarray, size: int, width: int, firsts: np.ndarray, best: dict[int, tuple[float, int]]) -> None:
        lo, hi = int(firsts[0]), int(firsts[-1]) + width
        bits = np.unpackbits(h[lo:hi].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])
        at = firsts - lo
        marks = np.packbits(2 * (sums[at + width] - sums[at]) > width, axis=1, bitorder="little").view("<u8").ravel()
        seen, bag = -1, None
        for w, k in zip(*(x.tolist() for x in self.near(marks, size)), strict=True):
            first = int(firsts[w])
            if w != seen:
                seen, bag = w, np.unique(h[first : first + width], return_counts=True)
            s = self.similarity(k, *bag)
            if s >= THRESHOLD and (k not in best or (s, -first) > (best[k][0], -best[k][1])):
                best[k] = (s, first)


def parts(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", index_bytes: int = 64 << 20) -> Iterator[list[tuple[int, str | None]]]:
    """The items of a benchmark in parts whose index stays under ``index_bytes``, one at a time: 48 bytes a word, 200 an item."""
    part, size = [], 2 << 20
    for r in benchmark.select(id_col, text_col).orderBy(id_col, text_col).toLocalIterator():
        cost = 200 + 48 * len((r[1] or "").split())
        if part and size + cost > index_bytes:
            yield part
            part, size = [], 2 << 20
        part.append((r[0], r[1]))
        size += cost
    if part:
        yield part


def _leaks(src: DataFrame, items: list[tuple[int, str | None]], schema: str) -> DataFrame:
    """A row per row of ``src(id, th, t)`` and item that it repeats."""
    held = src.sparkSession.sparkContext.broadcast(Index(items))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [(i, th, *m) for i, th, t in zip(b["id"], b["th"], b["t"], strict=True) for m in held.value.matches(t)]
            if found:
                yield pd.DataFrame(found, columns=["id", "th", "item", "first_word", "n_words", "similarity"], dtype=object)

    return src.mapInPandas(run, schema)


def _found(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, index_bytes: int) -> DataFrame:
    """(id, th, item, first_word, n_words, similarity); ids travel as strings, as longs with nulls would become floats in Python."""
    spark = docs.sparkSession
    kind, item_kind = docs.schema[id_col].dataType, benchmark.schema[item_col].dataType.simpleString()
    schema = f"id string, th long, item {item_kind}, first_word long, n_words long, similarity double"
    src = docs.select(F.col(id_col).cast("string").alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("t"))
    scratch, out, k = Scratch(spark, "leaks"), None, 0
    todo = parts(benchmark, item_col, item_text_col, index_bytes)
    items, after = next(todo, None), next(todo, None)
    while items is not None:
        one = _leaks(src, items, schema)
        if k or after is not None:  # several parts: each is done and let go before the next is built
            one = scratch.save(one, f"part{k}")
        out = one if out is None else out.unionByName(one)
        items, after, k = after, next(todo, None), k + 1
    out = spark.createDataFrame([], schema) if out is None else out
    return out.withColumn("id", F.col("id").cast(kind))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", index_bytes: int = 64 << 20) -> DataFrame:
    """A row per document and item that it repeats: ids, first word and words of the best window, its similarity."""
    out = _found(docs, benchmark, id_col, text_col, item_col, item_text_col, index_bytes).drop("th")
    return out.withColumnsRenamed({"id": id_col, "item": item_col})


def is_leaked(index: Index, docs: DataFrame, text: Column) -> Column:
    """Whether a text repeats an item, as a column, for a filter that passes all columns on."""
    held = docs.sparkSession.sparkContext.broadcast(index)

    @F.pandas_udf("boolean")
    def run(t: pd.Series) -> pd.Series:
        return pd.Series([bool(held.value.matches(x)) for x in t], dtype=bool)

    return run(text)


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", index_bytes: int = 64 << 20) -> DataFrame:
    """The documents, all columns, that repeat no item. One part of the benchmark is a filter; several are looked for one after another,
    and what they find, by id and hash of text, is taken away by one join."""
    todo = parts(benchmark, index_bytes=index_bytes)
    items, more = next(todo, None), next(todo, None)
    if items is None:
        return docs
    if more is None:
        return docs.where(~is_leaked(Index(items), docs, F.col(text_col)))
    found = _found(docs, benchmark, id_col, text_col, "item_id", "text", index_bytes)
    found = found.select(F.col("id").alias("__leak_id"), F.col("th").alias("__leak_th")).distinct()
    return docs.join(found, F.col(id_col).eqNullSafe(F.col("__leak_id")) & (F.xxhash64(text_col) == F.col("__leak_th")), "left_anti")
