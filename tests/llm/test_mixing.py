import pytest
from pyspark.sql import functions as F

from textloom.llm import mixing, queries

from .common import clashing, documents, same_as_sql


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, sf):
    d = f"/root/testdata/{sf}"
    same_as_sql(queries.ORACLE["op2_mixing"], queries.op2_mixing(spark, d), documents=f"{d}/documents.parquet")


def by_hand(sizes, total=1.5, most=2.0):
    """Targets by resharing again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, open_, target = total * sum(sizes.values()), set(names), {}
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] >= most * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
        if not open_:
            return target


@pytest.mark.parametrize("sizes", [{"a": 1000, "b": 50, None: 300, "c": 10}, {"a": 5}, {"a": 0, "b": 100}, {"a": 10, "b": 10, "c": 10, "d": 10_000}])
def test_targets_and_fill(spark, sizes):
    rows, i = [], 0
    for s, n in sizes.items():
        done = 0
        while done < n or not n and done == 0:
            k = min(n - done, 1 + (7 * i) % 5)
            rows.append((i, "w " * k, "en", s))
            done += max(k, 1)
            i += 1
    out = mixing.mix_table(documents(spark, rows)).collect()
    assert len(out) == len(rows)
    src = {r[0]: r[3] for r in rows}
    want = by_hand(sizes)
    for s in sizes:
        mine = [r for r in out if src[r.doc_id] == s]
        assert all(r.target == pytest.approx(want[s]) and r.source_size == sizes[s] for r in mine)
        assert abs(sum(r.taken for r in mine) - want[s]) <= 5
        assert all(r.taken <= 2 * r.size for r in mine)


def test_mix_repeats_rows_as_planned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = {r.doc_id: (r.size, r.taken) for r in mixing.mix_table(docs).collect()}
    got = {r.doc_id: r["count"] for r in mixing.mixed(docs).groupBy("doc_id").count().collect()}
    assert mixing.mixed(docs).columns == docs.columns
    assert got == {d: t // s for d, (s, t) in plan.items() if s and t}
    assert plan == {r.doc_id: (r.size, r.taken) for r in mixing.mix_table(docs.repartition(7)).collect()}


def test_edges(spark):
    rows = [(1, None), (1, "a b"), (1, "a b"), (None, "c d e"), (None, "c d e"), (2, ""), (3, "x " * 50_000, "en", None)]
    df = clashing(documents(spark, rows), "s", "p", "fill", "u", "size", "target", "copies", "row", "n", "at")
    out = mixing.mix_table(df).collect()
    assert len(out) == len(rows)
    assert {r.taken for r in out if r.size == 0} == {0}
    assert len({r.taken for r in out if r.doc_id is None}) == 1
    assert mixing.mix_table(documents(spark, [])).collect() == [] == mixing.mixed(documents(spark, [])).collect()
    assert mixing.mixed(df).columns == df.columns


def test_words_are_ascii_white_space_runs(spark):
    texts = ["", None, "a b c", "\x1c\x1f", "a\x0bb\x0cc\r\nd", "　"]
    df = documents(spark, list(enumerate(texts)))
    from textloom.llm._util import word_count, words

    assert [r[0] for r in df.orderBy("doc_id").select(word_count(F.col("text"))).collect()] == [len(words(t)) for t in texts]


def test_no_python_in_the_plan(spark):
    plan = queries.op2_mixing(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
