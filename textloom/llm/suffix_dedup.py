"""Exact repeats of long byte strings over a whole corpus, and their removal.

A byte goes if a string of 400 bytes that covers it also starts anywhere else (``keep="none"``), or started anywhere before, in
order of id and position (``keep="first"``: longest-previous-factor semantics, a position whose longest previous factor has 400
bytes or more begins a later copy). ``lpf`` below builds those arrays from a suffix array with previous and next smaller
positions; it is what tests hold the rest against. A suffix array of a corpus fits no executor, and hot passages gather in one
place of it, so over tables the same question is put to hashes, exactly in the same positions:

1. Anchors. In every 400-byte window the 64-byte string of least hash (the leftmost) is its anchor, so equal windows have equal
   anchors in equal places. One in some 170 bytes is an anchor; those whose string occurs once in the corpus need no more.
2. The windows of a repeated anchor are cut by their distance to it into groups of 64, then 8, then 1, the same in all documents.
   A group is settled by two hashes: of all bytes its windows touch (occurs elsewhere: all its windows repeat) and of the bytes
   they share (occurs nowhere else: none does). Only groups that hold the edge of a repeat are cut further, one or two an edge,
   and as partners for them the first of each set of equal groups.

All of that is counting by hash with partial aggregation and joins that split hot keys: a passage in a third of all documents
costs as much as the bytes it covers. Repeats within a document are found in place and compared byte by byte. Equal texts are one
text from the start. Groups are equal if two hashes of their bytes are, a 64-bit polynomial and an XXH3 of 64 bits, and only at the same distance
from the same anchor; candidates and what to cut further rest on one, where a chance meeting costs work but changes nothing.

Besides, ``n_passages`` counts what a document shares with others in words, whatever its bytes: of every 51 words in a row the 32
adjoining words of least hash are drawn, and those counted that a document elsewhere draws too. Documents that have 51 words or more in
common, however spaced, have at least one; nothing is removed for it.

Defined results: texts are UTF-8, null is empty; texts under 400 bytes keep all; rows of equal id and text are copies of each
other, with ``keep="first"`` all of them count as the first; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import Scratch

LENGTH, GRAM, WIDE, NARROW = 400, 64, 64, 8
PASSAGE, DRAWN = 51, 32
_IS_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_rng = np.random.default_rng(20_240_501)
_TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_R = int(_rng.integers(1 << 40, 1 << 62)) * 8 + 5
_R_INV = pow(_R, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 16, 2 * len(_powers[0]))
        for k, base in ((0, _R), (1, _R_INV)):
            x = np.full(size, base % (1 << 64), np.uint64)
            x[0] = 1
            _powers[k] = np.cumprod(x, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashed:
    """Hashes of any spans of a byte string from one pass over it; equal bytes give equal hashes wherever they stand."""

    def __init__(self, data: bytes):
        self.data, self.n = data, len(data)
        pw, self.inv = _grown(self.n + 1)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(_TABLE[np.frombuffer(data, np.uint8)] * pw[: self.n], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inv[start] + (end - start).astype(np.uint64))


def _least(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every window of ``w``."""
    n = len(x) - w + 1
    rows = -(-len(x) // w)
    p = np.full(rows * w, np.iinfo(np.uint64).max, np.uint64)
    p[: len(x)] = x
    p = p.reshape(rows, w)
    before = np.minimum.accumulate(p, axis=1).ravel()
    after = np.minimum.accumulate(p[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[w - 1 : w - 1 + n])


class Anchored:
    """A document's windows by anchor: ``at`` the anchors, ``gram`` their strings' hashes (even), ``lo`` and ``hi`` their first and last window."""

    def __init__(self, h: Hashed):
        self.h = h
        self.windows = self.h.n - LENGTH + 1
        i = np.arange(self.h.n - GRAM + 1)
        g = self.h.spans(i, i + GRAM)
        low = np.uint64(0xFFFFFFFF)
        at = (_least((g & ~low) | i.astype(np.uint64), LENGTH - GRAM + 1) & low).astype(np.int64)
        self.lo = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        self.hi = np.append(self.lo[1:], self.windows) - 1
        self.at = at[self.lo]
        self.gram = g[self.at] & ~np.uint64(1)

    def within(self, bits: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(windows that repeat within the document, those of them that are the first)."""
        again, first = np.zeros(self.windows, bool), np.zeros(self.windows, bool)
        if len(np.unique(self.gram)) < len(self.gram):
            i = np.arange(self.windows)
            w = self.h.spans(i, i + LENGTH).view(np.int64) & bits
            order = np.argsort(w, kind="stable")
            same = w[order[1:]] == w[order[:-1]]
            data = self.h.data
            if any(data[x : x + LENGTH] != data[y : y + LENGTH] for x, y in zip(order[1:][same].tolist(), order[:-1][same].tolist(), strict=True)):
                number: dict[bytes, int] = {}  # hashes have met by chance: the bytes themselves decide
                w = np.array([number.setdefault(data[x : x + LENGTH], x) for x in range(self.windows)])
                order = np.argsort(w, kind="stable")
                same = w[order[1:]] == w[order[:-1]]
            again[order[1:][same]] = again[order[:-1][same]] = True
            start = order[np.concatenate([[True], ~same])]
            first[start] = again[start]
        return again, first


def drawn(h: Hashed) -> np.ndarray:
    """Hashes (odd) of the strings of words drawn from a document's passages."""
    space = np.concatenate([[True], _IS_SPACE[np.frombuffer(h.data, np.uint8)], [True]])
    start, end = np.flatnonzero(space[:-1] & ~space[1:]), np.flatnonzero(~space[:-1] & space[1:])
    if len(start) < PASSAGE:
        return np.empty(0, np.uint64)
    w = h.spans(start, end)
    pw, inv = _grown(len(w) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w * pw[: len(w)], dtype=np.uint64)])
    i = np.arange(len(w) - DRAWN + 1)
    return np.unique(_least(mix((sums[i + DRAWN] - sums[i]) * inv[i]), PASSAGE - DRAWN + 1) | np.uint64(1))


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of true values."""
    d = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1) - 1


def _groups(at: np.ndarray, lo: np.ndarray, hi: np.ndarray, live: np.ndarray, windows: int) -> pd.DataFrame:
    """Groups of 64 of the windows of anchors that have a live window: anchor, number, first and last window, and a bit for each window
    that is live and this anchor's."""
    first, last = (at - hi) // WIDE, (at - lo) // WIDE
    n = last - first + 1
    k = np.repeat(np.arange(len(at)), n)
    j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[k]
    p = at[k]
    a, b = np.maximum(0, p - WIDE * j - WIDE + 1), np.minimum(windows - 1, p - WIDE * j)
    i = a[:, None] + np.arange(WIDE)
    bits = (i >= lo[k][:, None]) & (i <= np.minimum(b, hi[k])[:, None]) & live[np.minimum(i, windows - 1)]
    g = pd.DataFrame({"p": p, "j": j, "a": a, "b": b, "live": np.packbits(bits, axis=1, bitorder="little").view("<i8").ravel()})
    return g[g["live"] != 0]


def _hashes(h: Hashed, base: np.ndarray | int, p: np.ndarray, o: np.ndarray, size: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(of all bytes, of shared bytes) of groups of windows at distances o to o + size - 1 from p; ``base`` places a document in ``h``."""
    label = mix((o + 1).astype(np.uint64))
    every = h.spans(base + a, base + b + LENGTH) ^ mix((p - a).astype(np.uint64))  # the distance too: a document's ends clip groups
    shared = h.spans(base + p - o, base + p - o - size + 1 + LENGTH)
    return mix(every ^ label).view(np.int64), mix(shared ^ label).view(np.int64)


def _second(data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of another kind of the bytes of groups, from start up to end."""
    h, view = xxhash.xxh3_64_intdigest, memoryview(data)
    return np.fromiter((h(view[a:b]) for a, b in zip(start.tolist(), end.tolist(), strict=True)), dtype=np.uint64, count=len(start)).view(np.int64)


_KEY = "k1 long, k2 long"


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace")


def _anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row per text: its distinct anchors (0 if one of them stands twice in it) and drawn strings of words."""
    for b in batches:
        rows = []
        for t in b["t"]:
            h = Hashed(_bytes(t))
            words, grams = drawn(h), np.empty(0, np.uint64)
            if h.n >= LENGTH:
                all_ = Anchored(h).gram
                grams = np.unique(all_)
                if len(grams) < len(all_):
                    grams = np.append(grams, np.uint64(0))
            rows.append((np.concatenate([grams, words]).view(np.int64), len(words)))
        yield pd.DataFrame({"k1": b["k1"], "k2": b["k2"], "k3": b["k3"], "grams": [r[0] for r in rows], "words": [r[1] for r in rows]})


def _first_groups(keep: str, bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k1, k2, t, grams in zip(b["k1"], b["k2"], b["t"], b["grams"], strict=True):
                x = Anchored(Hashed(_bytes(t)))
                again, first = x.within(bits)
                s, e = runs(again if keep == "none" else again & ~first)
                if len(s):
                    yield pd.DataFrame({"k1": k1, "k2": k2, "p": -1, "j": 0, "a": s, "b": e, "live": 0, "every": 0, "second": 0, "shared": 0})
                met = np.isin(x.gram.view(np.int64), grams)
                g = _groups(x.at[met], x.lo[met], x.hi[met], ~again | first, x.windows)
                if len(g):
                    p, j, a, z = (g[c].to_numpy() for c in "pjab")
                    every, shared = _hashes(x.h, 0, p, WIDE * j, WIDE, a, z)
                    second = _second(x.h.data, a, z + LENGTH)
                    yield pd.DataFrame({"k1": k1, "k2": k2, "p": p, "j": j, "a": a, "b": z, "live": g["live"].to_numpy(), "every": every & bits, "second": second, "shared": shared})

    return run


def _cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Groups to be cut, with their bytes."""
    for b in batches:
        rows = []
        for k1, k2, t, cells in zip(b["k1"], b["k2"], b["t"], b["cells"], strict=True):
            data = _bytes(t)
            rows += [(k1, k2, c["p"], c["j"], c["a"], c["b"], c["live"], data[c["a"] : c["b"] + LENGTH]) for c in cells]
        yield pd.DataFrame(rows, columns=["k1", "k2", "p", "j", "a", "b", "live", "seg"])


def _unpacked(b: pd.DataFrame) -> tuple[Hashed, np.ndarray, np.ndarray]:
    """(hashes over all segments of a batch, what places each group's document in them, live bits by row and window)."""
    h = Hashed(b"".join(b["seg"]))
    size = b["seg"].map(len).to_numpy()
    base = np.cumsum(size) - size - b["a"].to_numpy()
    return h, base, np.unpackbits(b["live"].to_numpy(dtype="<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)


def _parts(b: pd.DataFrame, size: int, live: np.ndarray, chosen: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """Parts of ``size`` windows of each group that hold a live window: row, number, distance, first and last window."""
    p, j, a, z = (b[c].to_numpy() for c in "pjab")
    m = np.arange(WIDE // size)
    o = (WIDE * j)[:, None] + size * m[None, :]
    lo, hi = np.maximum(a[:, None], p[:, None] - o - size + 1), np.minimum(z[:, None], p[:, None] - o)
    count = np.concatenate([np.zeros((len(b), 1), np.int64), np.cumsum(live, axis=1)], axis=1)
    ok = lo <= hi
    row = np.arange(len(b))[:, None]
    ok &= np.where(ok, count[row, np.clip(hi - a[:, None] + 1, 0, WIDE)] > count[row, np.clip(lo - a[:, None], 0, WIDE)], False)
    if chosen is not None:
        ok &= chosen
    r, k = np.nonzero(ok)
    return r, k, o[r, k], lo[r, k], hi[r, k]


def _narrow_groups(bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            h, base, live = _unpacked(b)
            r, m, o, lo, hi = _parts(b, NARROW, live, None)
            p = b["p"].to_numpy()[r]
            every, shared = _hashes(h, base[r], p, o, NARROW, lo, hi)
            second = _second(h.data, base[r] + lo, base[r] + hi + LENGTH)
            yield pd.DataFrame({"k1": b["k1"].to_numpy()[r], "k2": b["k2"].to_numpy()[r], "p": p, "j": b["j"].to_numpy()[r], "m": m, "a": lo, "b": hi, "every": every & bits, "second": second, "shared": shared})

    return run


def _single(bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            h, base, live = _unpacked(b)
            chosen = np.repeat((b["parts"].to_numpy()[:, None] >> np.arange(WIDE // NARROW)) & 1, NARROW, axis=1).astype(bool)
            r, _, o, lo, _ = _parts(b, 1, live, chosen)
            every, _ = _hashes(h, base[r], b["p"].to_numpy()[r], o, 1, lo, lo)
            second = _second(h.data, base[r] + lo, base[r] + lo + LENGTH)
            yield pd.DataFrame({"k1": b["k1"].to_numpy()[r], "k2": b["k2"].to_numpy()[r], "a": lo, "b": lo, "every": every & bits, "second": second})

    return run


def _removal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for k1, k2, t, marks in zip(b["k1"], b["k2"], b["t"], b["marks"], strict=True):
            data = _bytes(t)
            edge = np.zeros(len(data) + 1, np.int64)
            np.add.at(edge, [m["a"] for m in marks], 1)
            np.add.at(edge, [m["b"] + LENGTH for m in marks], -1)
            gone = np.cumsum(edge[:-1]) > 0
            s, e = runs(gone)
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            rows.append((k1, k2, int(gone.sum()), len(s), hashlib.sha256(kept).hexdigest(), [{"start": int(x), "end": int(y) + 1} for x, y in zip(s, e, strict=True)]))
        yield pd.DataFrame(rows, columns=["k1", "k2", "n_removed", "n_spans", "kept_sha256", "spans"])


def _settled(groups: DataFrame, keep: str, scratch: Scratch, name: str) -> DataFrame:
    """``groups`` with ``hit``: the same bytes also stand elsewhere, or earlier; and ``lead``: this is the first group with these bytes.

    What is counted is written first: a join of two written tables can split a hash that holds a large part of the rows.
    """
    me = F.struct("k1", "k2", "a")
    met = groups.groupBy("every", "second").agg(F.count("*").alias("n"), F.min(me).alias("first")).where("n > 1").drop("n")
    met = scratch.save(met, f"{name}met")
    lead = F.coalesce(F.col("first") == me, F.lit(False))
    met_ = F.col("first").isNotNull()
    both = groups.join(met, ["every", "second"], "left").withColumns({"hit": met_ & ~lead if keep == "first" else met_, "lead": lead})
    done = scratch.save(both.drop("first", "every", "second"), f"{name}hit")
    scratch.drop(f"{name}met", name)
    return done


def _to_cut(groups: DataFrame, keep: str, scratch: Scratch, name: str) -> DataFrame:
    """Settled groups to be cut: those not hit whose shared bytes stand elsewhere too, and as their partners the first of each set of equal ones."""
    left = F.count_if(~F.col("hit"))
    met = groups.groupBy("shared").agg(F.count("*").alias("n"), left.alias("left")).where("n > 1").where(F.col("left") > int(keep == "first"))
    met = scratch.save(met.select("shared"), f"{name}open")
    return groups.where("not hit or lead").join(met, "shared", "left_semi")


def _keys(id_: Column, text: Column) -> tuple[Column, Column, Column]:
    """Id and two hashes of the text."""
    text = F.coalesce(text, F.lit(""))
    return F.coalesce(id_.cast("long"), F.lit(-(1 << 63))).alias("k1"), F.xxhash64(text).alias("k2"), F.xxhash64(F.lit(1), text).alias("k3")


def repeats(docs: DataFrame, scratch: Scratch, keep: str, id_col: str, text_col: str, bits: int = -1) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(texts that share an anchor, windows to remove as (k1, k2, a, b) with both ends, texts of several rows, shared strings of words by text).

    Of equal texts only the row of the smallest id is looked at. ``bits`` masks the first hash, for tests of what happens when it meets by chance.
    """
    rows = docs.select(*_keys(F.col(id_col), F.col(text_col)), F.col(text_col).alias("t")).where(F.octet_length("t") >= 2 * PASSAGE - 1)
    every = scratch.save(rows.mapInPandas(_anchors, f"{_KEY}, k3 long, grams array<long>, words int"), "every")
    reps = scratch.save(every.groupBy("k2", "k3").agg(F.min("k1").alias("k1"), F.count("*").alias("n"), F.max("words").alias("words")), "reps")
    anchors = every.join(reps.select("k1", "k2", "k3"), ["k1", "k2", "k3"], "left_semi").select("k1", "k2", F.explode("grams").alias("gram"))
    anchors = scratch.save(anchors, "anchors")
    common = scratch.save(anchors.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1 or gram = 0").select("gram"), "common")
    odd = F.col("gram").bitwiseAND(F.lit(1)) == 1
    met = anchors.join(common, "gram", "left_semi").groupBy("k1", "k2").agg(F.collect_set(F.when(~odd, F.col("gram"))).alias("grams"), F.count_if(odd).alias("n_passages"))
    met = scratch.save(met, "met")
    scratch.drop("every", "anchors", "common")
    texts = rows.where(F.octet_length("t") >= LENGTH).join(met.where(F.size("grams") > 0).select("k1", "k2", "grams"), ["k1", "k2"])
    texts = scratch.save(texts, "texts")
    wide = scratch.save(texts.mapInPandas(_first_groups(keep, bits), f"{_KEY}, p long, j int, a long, b long, live long, every long, second long, shared long"), "wide")
    own = scratch.save(wide.where("p < 0").select("k1", "k2", "a", "b"), "own")
    wide_hit = _settled(wide.where("p >= 0"), keep, scratch, "wide")
    cells = _to_cut(wide_hit, keep, scratch, "wide").groupBy("k1", "k2").agg(F.collect_set(F.struct("p", "j", "a", "b", "live")).alias("cells"))
    cut = texts.drop("grams").join(cells, ["k1", "k2"]).mapInPandas(_cut_out, f"{_KEY}, p long, j int, a long, b long, live long, seg binary")
    segs = scratch.save(cut, "segs")
    narrow = scratch.save(segs.mapInPandas(_narrow_groups(bits), f"{_KEY}, p long, j int, m int, a long, b long, every long, second long, shared long"), "narrow")
    narrow_hit = _settled(narrow, keep, scratch, "narrow")
    parts = _to_cut(narrow_hit, keep, scratch, "narrow").groupBy("k1", "k2", "p", "j").agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("m"))).cast("int").alias("parts"))
    single = scratch.save(segs.join(parts, ["k1", "k2", "p", "j"]).mapInPandas(_single(bits), f"{_KEY}, a long, b long, every long, second long"), "single")
    single_hit = _settled(single, keep, scratch, "single")
    scratch.drop("segs")
    marks = [own, *(g.where("hit").select("k1", "k2", "a", "b") for g in (wide_hit, narrow_hit, single_hit))]
    out = marks[0]
    for m in marks[1:]:
        out = out.unionByName(m)
    return texts.drop("grams"), out, reps.where("n > 1"), met.where("n_passages > 0").select("k1", "k2", "n_passages")


def removals(docs: DataFrame, keep: str = "none", id_col: str = "doc_id", text_col: str = "text", bits: int = -1) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256 of what is left, the removed spans of bytes, and n_passages."""
    if keep not in ("none", "first"):
        raise ValueError(f"keep: {keep}")
    scratch = Scratch(docs.sparkSession, "repeats")
    texts, marks, copies, passages = repeats(docs, scratch, keep, id_col, text_col, bits)
    marks = marks.groupBy("k1", "k2").agg(F.collect_set(F.struct("a", "b")).alias("marks"))
    span = "array<struct<start:bigint,end:bigint>>"
    cut = texts.join(marks, ["k1", "k2"]).mapInPandas(_removal, f"{_KEY}, n_removed long, n_spans long, kept_sha256 string, spans {span}")
    cut = scratch.save(cut.dropDuplicates(["k1", "k2"]), "removals")
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = docs.select(F.col(id_col).alias("id"), *_keys(F.col(id_col), F.col(text_col)), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text.cast("binary"), 256).alias("sha"))
    copies = copies.select("k2", "k3", F.col("k1").alias("first"), F.col("words").cast("long").alias("words"))
    both = whole.join(copies, ["k2", "k3"], "left").join(cut, ["k1", "k2"], "left").join(passages, ["k1", "k2"], "left")
    copy = F.col("first").isNotNull() & (F.col("n_bytes") >= LENGTH)
    if keep == "first":
        copy &= F.col("first") != F.col("k1")
    zero = F.lit(0).cast("long")
    at = lambda all_, found, none: F.when(copy, all_).otherwise(F.coalesce(found, none))
    return both.select(
        F.col("id").alias(id_col),
        "n_bytes",
        at(F.col("n_bytes"), F.col("n_removed"), zero).alias("n_removed"),
        at(zero + 1, F.col("n_spans"), zero).alias("n_spans"),
        at(F.lit(hashlib.sha256().hexdigest()), F.col("kept_sha256"), F.col("sha")).alias("kept_sha256"),
        at(F.array(F.struct(zero.alias("start"), F.col("n_bytes").alias("end"))), F.col("spans"), F.array().cast(span)).alias("spans"),
        F.coalesce("words", "n_passages", zero).alias("n_passages"),
    )


def suffix_array(data: bytes | np.ndarray) -> np.ndarray:
    """Suffix array of bytes, or of whole numbers, by prefix doubling."""
    rank = (np.frombuffer(data, np.uint8) if isinstance(data, bytes) else data).astype(np.int64)
    n, k = len(rank), 1
    while True:
        second = np.full(n, -1, np.int64)
        second[: max(0, n - k)] = rank[k:]
        order = np.lexsort((second, rank))
        a, b = rank[order], second[order]
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.concatenate([[0], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        rank, k = new, 2 * k
        if n == 0 or rank.max() == n - 1:
            return order


def lpf(data: bytes | np.ndarray) -> np.ndarray:
    """Longest previous factor of each position: the longest string that begins there and also at an earlier position.

    In suffix order the earlier positions that share most are the nearest smaller position before and after (Crochemore and
    Ilie, 2008). In memory; the check of small corpora.
    """
    sa, n = suffix_array(data).tolist(), len(data)
    prev, nxt = [-1] * n, [-1] * n
    stack: list[int] = []
    for p in sa:
        while stack and stack[-1] > p:
            nxt[stack.pop()] = p
        prev[p] = stack[-1] if stack else -1
        stack.append(p)

    def common(i: int, j: int, known: int) -> int:
        while max(i, j) + known < n and data[i + known] == data[j + known]:
            known += 1
        return known

    out, a, b = np.zeros(n, np.int64), 0, 0
    for i in range(n):  # what two positions share shrinks by one at most from one position to the next
        a = common(i, prev[i], max(0, a - 1)) if prev[i] >= 0 else 0
        b = common(i, nxt[i], max(0, b - 1)) if nxt[i] >= 0 else 0
        out[i] = max(a, b)
    return out
