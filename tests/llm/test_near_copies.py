import random
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from textloom.llm import near_copies
from textloom.llm._util import marked

from .common import clashing, documents


def plain_set(text):
    ws = (text or "").lower().encode().split()
    return {xxhash.xxh64_intdigest(b" ".join(ws[i : i + 5]), 42) for i in range(max(1, len(ws) - 4))} if ws else set()


def plain_kept(rows):
    """Ids that stay, every pair with a shingle in common compared."""
    rows = sorted(rows)
    sets, up, held = [plain_set(t) for _, t in rows], list(range(len(rows))), {}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for i, s in enumerate(sets):
        for j, n in Counter(k for x in s for k in held.get(x, ())).items():
            if n / (len(s) + len(sets[j]) - n) >= 0.8:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
        for x in s:
            held.setdefault(x, []).append(i)
    empty = [i for i, s in enumerate(sets) if not s]
    return sorted(rows[i][0] for i in range(len(rows)) if find(i) == i and i not in empty[1:])


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = plain_kept([(r.doc_id, r.text) for r in df.collect()])
    assert sorted(r.doc_id for r in corpus_pipeline.dedup_stage(spark, df, "").collect()) == want


def test_similarity_of_eight_tenths_is_a_copy(spark):
    """Texts of 204 words, 200 shingles; a changed word within costs five, so 4 leave 180 of 220 (0.818) and 5 leave 175 of 225 (0.778)."""
    rows = []
    for g in range(8):
        base = [f"wort{g}x{i}" for i in range(204)]
        for k, changed in enumerate((0, 4, 5)):
            rows.append((10 * g + k, " ".join(f"neu{k}" if changed and i in range(10, 10 + 30 * changed, 30) else w for i, w in enumerate(base))))
    assert sorted(r.doc_id for r in corpus_pipeline.dedup_stage(spark, documents(spark, rows), "").collect()) == sorted(10 * g + k for g in range(8) for k in (0, 2)) == plain_kept(rows)


def test_crowds(spark, monkeypatch):
    """Many variants of one text on both sides of the threshold, so that forests hold pairs that are refuted; with cells cut small as well."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = [(k, " ".join(f"v{rng.randrange(10**6)}" if rng.random() < 0.02 else w for w in base)) for k in range(120)]
    want = plain_kept(rows)
    assert 5 < len(want) < 100
    for cell, tile in ((near_copies.CELL, near_copies.TILE), (20, 16)):  # cells of 20 are cut, so the second round has work
        monkeypatch.setattr(near_copies, "CELL", cell)
        monkeypatch.setattr(near_copies, "TILE", tile)
        assert sorted(r.doc_id for r in near_copies.keep_one(documents(spark, rows)).collect()) == want


def test_cell_links():
    base = np.arange(100, dtype=np.int64)
    sets = [base, base[:95], base[10:], base + 1000, np.concatenate([base[:60], base[:40] + 500])]
    name, fp = np.arange(5), np.zeros(5, dtype=np.uint64)
    forest = {tuple(sorted(e)) for e in near_copies.cell_links(name, name, fp, sets)}
    assert forest == {(0, 1), (0, 2)}
    assert near_copies.cell_links(name, np.array([0, 0, 0, 3, 4]), fp, sets) == []
    far = np.array([0, (1 << 64) - 1, 0, 0, 0], dtype=np.uint64)  # beyond the radius nothing is compared
    assert {tuple(sorted(e)) for e in near_copies.cell_links(name, name, far, sets)} == {(0, 2)}


def test_edges(spark):
    a = " ".join(f"wort{i}" for i in range(200))
    rows = [((1 << 60) + 1, a), ((1 << 60) + 2, a.upper() + " "), (3, "one"), (3, "one"), (7, None), (8, ""), (9, " \n"), (None, "two"), (None, "two"), (10, "x " * 100_000)]
    df = clashing(documents(spark, rows), "id", "th", "t", "name", "fp", "keys", "least", "root", "cell", "node", "n", "h")
    kept = near_copies.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([(1 << 60) + 1, 3, 7, None, 10], key=str)
    assert near_copies.keep_one(documents(spark, [])).collect() == []


def test_bitmap_knows_all_listed_rows_and_few_others(spark):
    rows = spark.range(20_000).withColumn("piece", F.lit("x")).withColumn("maybe", F.lit(1))
    listed = spark.range(0, 20_000, 7)
    out = marked(rows, F.xxhash64("id"), listed, F.xxhash64("id"), "hit")
    assert out.columns == ["id", "piece", "maybe", "hit"]
    hits = {r["id"] for r in out.where("hit").collect()}
    assert out.count() == 20_000 and hits >= set(range(0, 20_000, 7)) and len(hits) < 2_900
    assert marked(rows, F.xxhash64("id"), listed.limit(0), F.xxhash64("id"), "hit").where("hit").count() == 0
