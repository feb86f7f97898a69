import random
import re

import numpy as np
import pytest
import xxhash

from textloom.llm import simhash

from .common import clashing, documents

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def plain_fingerprint(text):
    ws = WORD.findall((text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))))
    sh = [b" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] if len(ws) >= 3 else [b" ".join(ws)] if ws else []
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(fps, ids):
    x = np.array(fps, dtype=np.uint64)
    up = list(range(len(x)))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for i in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x[i + 1 :] ^ x[i]) <= 3) + i + 1:
            a, b = find(i), find(int(j))
            up[max(a, b)] = min(a, b)
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        least[r] = min(x for x in (least.get(r), d) if x is not None) if (least.get(r), d) != (None, None) else None
    return [least[find(i)] for i in range(len(x))]


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = df.orderBy("doc_id").collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    comp = plain_components(fps, [r.doc_id for r in rows])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_components(df).collect()}
    assert got == {r.doc_id: (f"{f:016x}", c) for r, f, c in zip(rows, fps, comp)}


def test_fingerprint():
    rng = random.Random(3)
    for n in (0, 1, 2, 3, 4, 50, 255, 256, 257, 700):
        t = " ".join(rng.choice(["The", "É", "\x1c", "a b", "Wort", "x"]) for _ in range(n))
        assert simhash.fingerprint(t) == plain_fingerprint(t)
    h = np.random.default_rng(1).integers(0, 1 << 64, 300_000, dtype=np.uint64)
    assert simhash.majority(h) == sum(1 << b for b in range(64) if 2 * int((h >> np.uint64(b) & np.uint64(1)).sum()) > len(h))


@pytest.mark.parametrize("cell", [simhash.CELL, 40])
def test_crowded_cells(spark, cell, monkeypatch):
    """Chains and stars of fingerprints a few bits apart, with cells cut small as well."""
    monkeypatch.setattr(simhash, "CELL", cell)
    monkeypatch.setattr(simhash, "TILE", 32)
    rng = random.Random(9)
    fps = set()
    for _ in range(12):
        f = rng.getrandbits(64)
        for _ in range(60):
            fps.add(f)
            for _ in range(rng.randint(1, 3)):
                f ^= 1 << rng.randrange(64) if rng.random() < 0.7 else 1 << rng.randrange(6)
    fps = sorted(fps)
    from textloom.llm._util import Scratch

    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    got = {r.fp: r.root for r in simhash.simhash_groups(df, Scratch(spark, "t")).collect()}
    want = plain_components(fps, list(range(len(fps))))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    groups, mine = {}, {}
    for f, w in zip(signed, want):
        groups.setdefault(w, set()).add(f)
    for f in signed:
        mine.setdefault(got.get(f, f), set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_tiles():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 64, 40, dtype=np.uint64)
    x = np.unique(np.concatenate([base ^ (np.uint64(1) << np.uint64(k)) for k in range(0, 64, 2)]))
    roots = simhash._Forest(len(x))
    at = {int(f): i for i, f in enumerate(x)}
    edges = simhash.cell_forest(x)
    for a, b in edges:
        assert (a ^ b).bit_count() <= 3 and roots.join(at[a], at[b])
    want = plain_components(x.tolist(), list(range(len(x))))
    assert len({roots.find(i) for i in range(len(x))}) == len(set(want))


def test_edges_and_keep_one(spark):
    a = " ".join(f"wort{i}" for i in range(200))
    rows = [(5, a), (3, a + " "), (3, a + " "), (7, None), (8, ""), (9, " \n"), (None, "one"), (None, "one"), (10, "two words"), (11, "x " * 100_000)]
    df = clashing(documents(spark, rows), "fp", "id", "th", "least", "root", "component_id", "fingerprint")
    out = simhash.simhash_components(df).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, set()).add((r.fingerprint, r.component_id))
    assert {c for _, c in by[5]} == {c for _, c in by[3]} == {3}
    assert by[7] == by[8] == by[9] == {("0" * 16, 7)}
    assert {c for _, c in by[None]} == {None}
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, 7, None, 10, 11], key=str)
    assert simhash.simhash_components(documents(spark, [])).collect() == [] == simhash.keep_one(documents(spark, [])).collect()
