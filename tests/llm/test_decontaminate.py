import random
from collections import Counter

import numpy as np
import pytest

from textloom.llm import decontaminate as dc

from .common import clashing, documents

ITEMS = "item_id long, text string"


def shingles(ws):
    return [tuple(ws[k : k + 5]) for k in range(max(1, len(ws) - 4))]


def alike(a, b):
    low = sum((a & b).values())
    return low / (sum(a.values()) + sum(b.values()) - low)


def plain(text, items):
    """Every window of every item's size, by exact similarity."""
    ws = (text or "").lower().encode().split()
    out = {}
    for item, t in items:
        q = (t or "").lower().encode().split()
        if not q:
            continue
        bag = Counter(shingles(q))
        for p in range(len(ws) - len(q) + 1):
            s = alike(bag, Counter(shingles(ws[p : p + len(q)])))
            if s >= 0.8 and s > out.get(item, (0, 0))[0]:
                out[item] = (s, p, len(q))
    return {(i, p, n, round(s, 9)) for i, (s, p, n) in out.items()}


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    want = {(r.doc_id, *m) for r in docs.collect() for m in plain(r.text, items)}
    got = {(r.doc_id, r.item_id, r.first_word, r.n_words, round(r.similarity, 9)) for r in dc.leaks(docs, bench).collect()}
    assert got == want and want


def test_altered_passages():
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(500)]
    items = [(k, " ".join(rng.choices(vocab, k=rng.choice([1, 3, 5, 6, 12, 40, 80])))) for k in range(40)]
    index = dc.Index(items)
    hits = 0
    for _ in range(300):
        k = rng.randrange(40)
        ws = items[k][1].split()
        for _ in range(rng.randint(0, 2)):
            ws[rng.randrange(len(ws))] = rng.choice(vocab)
        text = " ".join(rng.choices(vocab, k=rng.randint(0, 60)) + ws + rng.choices(vocab, k=rng.randint(0, 60)))
        text = text.upper() if rng.random() < 0.3 else text.replace(" ", "\n", 3)
        got = {(i, p, n, round(s, 9)) for i, p, n, s in index.matches(text)}
        assert got == plain(text, items)
        hits += bool(got)
    assert hits > 150


def test_blocks_reach_the_radius():
    rng = random.Random(3)
    items = [(k, " ".join(f"x{rng.random()}" for _ in range(30))) for k in range(50)]
    index = dc.Index(items)
    for _ in range(400):
        k = rng.randrange(50)
        mark = int(index.mark[k])
        for b in rng.sample(range(64), rng.randint(0, dc.RADIUS + 4)):
            mark ^= 1 << b
        marks = np.array([mark, 0], dtype=np.uint64)
        want = {(w, j) for w in (0, 1) for j in range(50) if (int(index.mark[j]) ^ int(marks[w])).bit_count() <= dc.RADIUS}
        assert set(zip(*(x.tolist() for x in index.near(marks, 30)))) == want
        assert not len(index.near(marks, 31)[0])


def test_parts_of_the_index(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    least = (2 << 20) + 60_000
    assert 1 < len(list(dc.parts(bench, index_bytes=least))) < 40
    whole = sorted(map(tuple, dc.leaks(docs, bench).collect()))
    assert sorted(map(tuple, dc.leaks(docs, bench, index_bytes=least).collect())) == whole
    for size in (64 << 20, least):
        left = dc.clean(docs, bench, index_bytes=size)
        assert left.columns == docs.columns
        assert {r.doc_id for r in left.collect()} == {r.doc_id for r in docs.collect()} - {r[0] for r in whole}


def test_a_large_benchmark():
    """20,000 items in one part: an index of some MB, and an altered item is found among them."""
    rng = random.Random(6)
    items = [(k, " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randint(20, 60)))) for k in range(20_000)]
    index = dc.Index(items)
    size = sum(x.nbytes for x in (index.bag, index.times, index.who, index.keys, index.key_at, index.bag_at, index.mark, index.size, *(x for b in index.blocks for x in b)))
    assert size < 48 * sum(len(t.split()) for _, t in items) + 200 * len(items) + (2 << 20)
    for k in rng.sample(range(20_000), 20):
        ws = items[k][1].split()
        ws[0] = "other"
        text = "before " + " ".join(ws) + " after"
        assert {(i, p, n, round(s, 9)) for i, p, n, s in index.matches(text)} == plain(text, [items[k]]) != set()


@pytest.mark.parametrize("bench", [[], [(1, None), (2, ""), (None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (4, "solo")]])
def test_edges(spark, bench):
    b = clashing(spark.createDataFrame(bench, ITEMS), "id", "extra")
    rows = [(1, None), (2, ""), (None, "x A B c d\te f y"), (3, "solo"), (3, "solo"), (5, "a b c d e f " * 20_000), (6, "nothing")]
    df = clashing(documents(spark, rows), "id", "t", "item", "item_id", "first_word", "similarity")
    out = sorted(((r.doc_id, r.item_id, r.first_word, r.n_words, r.similarity) for r in dc.leaks(df, b).collect()), key=repr)
    want = [] if not bench else sorted([(d, i, p, 6, 1.0) for d, p in ((None, 1), (5, 0)) for i in (None, 3, 3)] + [(3, 4, 0, 1, 1.0)] * 2, key=repr)
    assert out == want
    assert dc.leaks(documents(spark, []), b).collect() == []
    assert sorted((r.doc_id for r in dc.clean(df, b).collect()), key=repr) == sorted([1, 2, 6] if bench else [r[0] for r in rows], key=repr)
