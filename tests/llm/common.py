"""Small inputs that several tests share, and the comparison with a query's SQL."""

from pathlib import Path

import duckdb

from tools.compare import norm

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(r[0], r[1], *(r[2:] or ("en", "src1")), len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def clashing(df, *names):
    """The same rows with more columns, named like those that an operator makes for itself."""
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit("other") for n in names if n not in df.columns})


def same_as_sql(sql, got, **tables):
    con = duckdb.connect()
    for name, at in tables.items():
        con.execute(f"create view {name} as select * from read_parquet('{at}{'/*.parquet' if Path(at).is_dir() else ''}')")
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    assert sorted(names) == sorted(got.columns)
    want = sorted((tuple(map(norm, r)) for r in rel.fetchall()), key=repr)
    have = sorted((tuple(map(norm, r)) for r in got.select(*names).collect()), key=repr)
    assert have == want
