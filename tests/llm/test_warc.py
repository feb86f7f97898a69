import hashlib
import io

import pytest
from pyspark.sql import functions as F

from textloom.llm import queries, warc
from textloom.llm._util import Scratch, make_dir

from .common import clashing, same_as_sql

SCHEMA = "page_id long, url string, html string"


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, sf):
    d = f"/root/testdata/{sf}"
    same_as_sql(queries.ORACLE["op8_warc"], queries.op8_warc(spark, d), pages=f"{d}/pages.parquet")


def test_selected_records_come_back_whole(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    folder = make_dir(spark, "warctest")
    index = warc.write_archives(pages, folder, Scratch(spark, "warctest"))
    wanted = index.where(F.col("page_id") % 3 == 0)
    want = {r.page_id: (r.html or "") for r in pages.collect()}
    got = warc.read_records(wanted, folder).collect()
    assert {r.page_id for r in got} == {p for p in want if p % 3 == 0}
    for r in got:
        assert r.payload_digest == hashlib.sha256(want[r.page_id].encode()).hexdigest()
        if r.record_type == "response":
            assert r.payload.decode() == want[r.page_id]
        else:
            assert want[r.refers_to] == want[r.page_id]


def test_archives_are_plain_gzip(spark):
    """A reader that knows nothing of the index finds the same records."""
    import gzip

    from textloom.llm._util import file_system

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    folder = make_dir(spark, "warctest")
    index = warc.write_archives(pages, folder, Scratch(spark, "warctest"))
    n = 0
    fs, _ = file_system(folder)
    for path in {r.archive for r in index.collect()}:
        with fs.open_input_file(path) as f:
            data = gzip.GzipFile(fileobj=io.BytesIO(f.read())).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            size = int(dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])[b"Content-Length"])
            assert rest[size : size + 4] == b"\r\n\r\n"
            data, n = rest[size + 4 :], n + 1
    assert n == pages.count()


def test_edges(spark):
    big = "ü" * 60
    rows = [(5, "http://a/ b", big), (3, None, big), (None, "u", big), (3, "again", big), (1, "x", "y" * 99), (2, "x", "y" * 99), (4, "x", "z" * 100), (6, "x\r\nEvil: 1", "z" * 100), (7, "n", None), (8, "n", ""), (None, None, "q" * 200), (None, None, "q" * 200), (9, "long", "w" * 2_000_000)]
    df = clashing(spark.createDataFrame(rows, SCHEMA), "i", "d", "n", "k", "first", "digest", "ref")
    out = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.warc_table(df).collect()), key=repr)
    assert out == sorted(
        [(5, "revisit", 3, 120), (3, "response", None, 120), (None, "revisit", 3, 120), (3, "response", None, 120), (1, "response", None, 99), (2, "response", None, 99), (4, "response", None, 100), (6, "revisit", 4, 100), (7, "response", None, 0), (8, "response", None, 0), (None, "response", None, 200), (None, "response", None, 200), (9, "response", None, 2_000_000)],
        key=repr,
    )
    assert warc.warc_table(spark.createDataFrame([], SCHEMA)).collect() == []


def test_ranges_are_joined():
    spots = [(0, 10), (10, 10), (25, 5), (100_000, 10), (100_010, 10)]
    assert warc.ranges(spots, gap=8, most=1000) == [(0, 30, [0, 1, 2]), (100_000, 20, [3, 4])]
    assert [r[2] for r in warc.ranges(spots, gap=8, most=20)] == [[0, 1], [2], [3, 4]]


def test_damage_is_noticed():
    data = bytearray(warc.record(1, "http://a/", b"payload" * 50, hashlib.sha256(b"payload" * 50).hexdigest(), 350, None))
    assert warc.parse(bytes(data))[1] == b"payload" * 50
    data[len(data) // 2] ^= 0xFF
    with pytest.raises(Exception):
        warc.parse(bytes(data))


def test_large_ids_are_exact(spark, tmp_path):
    """Odd ids above 2^53 are no floats; nulls in a batch must not make them such."""
    from textloom.llm._util import Scratch

    big, text = (1 << 53) + 1, "<p>" + "x" * 200
    rows = [(big, "u", text), (big + 2, "u", text), (big + 4, "u", "short"), (None, "u", text)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    index = warc.write_archives(df, f"file://{tmp_path}", Scratch(spark, "t"))
    want = sorted([(big, None), (big + 2, big), (big + 4, None), (None, big)], key=repr)
    assert sorted(((r.page_id, r.refers_to) for r in index.collect()), key=repr) == want
    assert sorted(((r.page_id, r.refers_to) for r in warc.read_records(index, f"file://{tmp_path}").collect()), key=repr) == want
    r = index.where("record_type = 'revisit' and page_id is not null").first()
    data = open(r.archive.removeprefix("file://"), "rb").read()[r.offset : r.offset + r.length]
    assert warc.parse(data)[0]["warc-refers-to"] == warc.record_id(big, r.digest)
