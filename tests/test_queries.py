"""Every query of the library against its SQL, and the plans that matter at scale."""

import duckdb
import pytest

from textloom.plans import cases, queries
from tools.compare import norm

SF = "/root/testdata/sf0.001"
EMPTY_TABLES = ("url_summary", "domain_distribution", "collect_by_domain", "collection_rate", "sampling_totals", "enrichment_totals", "validate_event_props", "markdown_totals")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("pages", "documents", "labels", "events"):
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_matches_sql(spark, con, name):
    rel = con.execute(queries.ORACLE[name])
    names = [d[0] for d in rel.description]
    df = queries.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    got = sorted((tuple(map(norm, r)) for r in df.select(*names).collect()), key=repr)
    assert got == sorted((tuple(map(norm, r)) for r in rel.fetchall()), key=repr)
    assert got


def test_every_query_is_listed():
    assert set(queries.QUERIES) - set(queries.ORACLE) == {"html_to_markdown"}


@pytest.mark.parametrize("name", EMPTY_TABLES)
def test_empty_tables(spark, tmp_path, name):
    for t in ("pages", "documents", "labels", "events"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    rows = queries.QUERIES[name](spark, str(tmp_path)).collect()
    assert all(v in (0, 0.0, None, True, False, 2) for r in rows for v in r)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_statistics_read_only_urls(spark):
    for name in ("url_summary", "domain_distribution", "protocol_distribution", "collection_rate"):
        p = plan(queries.QUERIES[name](spark, SF))
        assert "ReadSchema: struct<url:string>" in p and "html" not in p, name
    assert "Not(EqualTo(url,))" in plan(queries.QUERIES["domain_distribution"](spark, SF))


def test_top_k_and_samples_are_cut_before_the_shuffle(spark):
    assert "TakeOrderedAndProject" in plan(queries.QUERIES["domain_distribution"](spark, SF))
    assert plan(queries.QUERIES["domain_sample"](spark, SF)).count("WindowGroupLimit") == 2


def test_collection_is_a_semi_join(spark):
    p = plan(queries.QUERIES["collect_by_domain"](spark, SF))
    assert "LeftSemi" in p and "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_no_python_where_expressions_do(spark):
    for name in ("parse_model_replies", "qa_pairs_basic", "normalize_complexities", "compare_complexities", "cluster_sample", "resume_upsert"):
        assert "Python" not in plan(queries.QUERIES[name](spark, SF)), name


def test_sample_is_a_sample(spark):
    rows = queries.QUERIES["domain_sample"](spark, SF).collect()
    again = queries.QUERIES["domain_sample"](spark, SF).collect()
    assert sorted(rows) == sorted(again)
    per = {}
    for r in rows:
        per[r.domain] = per.get(r.domain, 0) + 1
    assert all(n <= 3 for n in per.values())
    assert {r.page_id for r in rows} <= {r.page_id for r in queries.QUERIES["collect_by_domain"](spark, SF).collect()}


def test_cases_hold_together():
    assert len(cases.COMPLEXITY) == len(cases.SCORED) == 26
    assert [s for *_, s in cases.COMPLEXITY] == [s for s, *_ in cases.SCORED]
