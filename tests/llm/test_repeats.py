import hashlib
import random

import numpy as np
import pytest

from textloom.llm import suffix_dedup as sd

from .common import clashing, documents

L = sd.LENGTH


def brute(texts, keep="none"):
    """By slices of every document; ``texts`` in the order that counts for keep="first"."""
    raw = [(t or "").encode() for t in texts]
    where = {}
    for d, x in enumerate(raw):
        for i in range(len(x) - L + 1):
            where.setdefault(x[i : i + L], []).append((d, i))
    gone = [np.zeros(len(x), bool) for x in raw]
    for at in where.values():
        for d, i in (at if len(at) > 1 else [])[keep == "first" :]:
            gone[d][i : i + L] = True
    out = []
    for x, g in zip(raw, gone):
        s, _ = sd.runs(g)
        out.append((len(x), int(g.sum()), len(s), hashlib.sha256(bytes(b for b, y in zip(x, g) if not y)).hexdigest()))
    return out


def by_lpf(texts):
    """keep="first" through the longest-previous-factor array of the documents joined by unequal separators."""
    raw = [(t or "").encode() for t in texts]
    data = np.concatenate([np.concatenate([np.frombuffer(x, np.uint8).astype(np.int64) + 1000, [k]]) for k, x in enumerate(raw)]) if raw else np.empty(0, np.int64)
    far = sd.lpf(data)
    out, at = [], 0
    for x in raw:
        gone = np.zeros(len(x), bool)
        for i in np.flatnonzero(far[at : at + len(x)] >= L):
            gone[i : i + L] = True
        s, _ = sd.runs(gone)
        out.append((len(x), int(gone.sum()), len(s), hashlib.sha256(bytes(b for b, y in zip(x, gone) if not y)).hexdigest()))
        at += len(x) + 1
    return out


def planted(seed, n=40):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeéü漢 ", k=rng.randint(1, 9)))
    text = lambda k: " ".join(word() for _ in range(k))
    shared = [text(rng.randint(40, 200)) for _ in range(6)]
    docs = []
    for _ in range(n):
        parts = [text(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            cut = rng.randint(0, len(s) // 2)
            parts += [s[cut : rng.randint(cut, len(s))] if rng.random() < 0.6 else s, text(rng.randint(0, 20))]
        docs.append("".join(parts))
    docs += [docs[0], docs[1], "x" * 1500, "x" * 450, "ab" * 700, "x" * 399, "", None, "y" * 400, "y" * 400, "z" * 401]
    return docs


def got(df, keep="none"):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.removals(df, keep).collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("keep", ["none", "first"])
def test_planted(spark, seed, keep):
    texts = planted(seed)
    df = documents(spark, list(enumerate(texts))).repartition(4)
    want = brute(texts, keep)
    if keep == "first":
        assert by_lpf(texts) == want
    assert got(df, keep) == dict(enumerate(want))


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = df.orderBy("doc_id").collect()
    assert got(df) == dict(zip([r.doc_id for r in rows], brute([r.text for r in rows])))


def test_edges(spark):
    a = "".join(random.Random(5).choices("abcdefgh", k=900))
    rows = [(1, a), (1, a), (None, a[100:700]), (None, None), (3, "short"), (3, None)]
    out = sd.removals(clashing(documents(spark, rows), "k1", "k2", "t", "gram", "id")).collect()
    assert len(out) == len(rows)
    assert sorted((r.n_bytes, r.n_removed) for r in out) == [(0, 0), (0, 0), (5, 0), (600, 600), (900, 900), (900, 900)]
    assert sd.removals(documents(spark, [])).collect() == []


def test_many_copies(spark):
    a = "".join(random.Random(6).choices("abcdefgh ", k=3000))
    rows = [(k, f"{k} " + a[:2000] + f" {k}") for k in range(500)] + [(1000 + k, a) for k in range(300)]
    out = got(documents(spark, rows))
    want = brute([t for _, t in rows])
    assert out == {k: w for (k, _), w in zip(rows, want)}


def test_first_hash_meets_by_chance(spark):
    """With two bits left of the first hash nearly all groups meet in it; the second one, and the bytes within a document, still decide."""
    texts = [t if t != "x" * 1500 else "xy" * 300 + "z" * 900 for t in planted(4)]
    df = documents(spark, list(enumerate(texts)))
    out = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.removals(df, bits=3).collect()}
    assert out == dict(enumerate(brute(texts)))


def test_shared_passages(spark):
    """Whatever its bytes and spaces, a passage of 51 words in two documents is counted in both, and 31 words never are."""
    rng = random.Random(8)
    text = lambda n: ["".join(rng.choices("abcdefghij", k=rng.randint(1, 4))) + str(rng.randrange(10**6)) for _ in range(n)]
    rows, want = [], set()
    for g in range(30):
        n = (31, 51, 60)[g % 3]
        shared = text(n)
        for k in range(2):
            rows.append((2 * g + k, " ".join(text(rng.randint(0, 40))) + " " + (" ", "\n ")[k].join(shared) + " " + " ".join(text(rng.randint(20, 40)))))
            if n >= 51:
                want.add(2 * g + k)
    rows += [(100, " ".join(text(60))), (101, None), (102, " ".join(["a"] * 51)), (103, " ".join(["a"] * 51))]
    out = {r.doc_id: r.n_passages for r in sd.removals(documents(spark, rows)).collect()}
    assert {k for k, n in out.items() if n} == want | {102, 103}
