import json

import pytest
from pyspark.sql import functions as F

from textloom import boundary, cli, registry
from textloom.streaming import incremental


def write_pages(spark, path, rows, mode="overwrite"):
    spark.createDataFrame(rows, "url string, content string").coalesce(1).write.mode(mode).parquet(str(path))


ROWS = [(f"http://a.com/{i}", f"<h1>T{i}</h1><p>x</p>") for i in range(6)] + [("http://b.com", "<p>y</p>"), (None, "z")]


def test_corpus_commands(spark, tmp_path, capsys):
    write_pages(spark, tmp_path / "in", ROWS)
    assert cli.main(["stats", str(tmp_path / "in"), str(tmp_path / "stats.json")]) == 0
    report = json.loads((tmp_path / "stats.json").read_text())
    assert report["summary"]["valid_urls"] == 7 and report["domain_distribution"] == {"a.com": 6, "b.com": 1}
    assert cli.main(["collect", str(tmp_path / "in"), str(tmp_path / "c"), "--stats", str(tmp_path / "stats.json"), "--min-frequency", "2"]) == 0
    assert json.loads((tmp_path / "c" / "target_domains.json").read_text()) == {"total_domains": 1, "min_frequency": 2, "domains": {"a.com": 6}}
    report = json.loads((tmp_path / "c" / "collection_report.json").read_text())
    assert report.pop("collection_time") > "2020" and report == {"total_urls_processed": 8, "total_urls_collected": 6, "collection_rate": 75.0}
    assert cli.main(["sample", str(tmp_path / "c" / "domains"), str(tmp_path / "s"), "--sample-size", "4"]) == 0
    assert spark.read.json(str(tmp_path / "s")).count() == 4
    assert cli.main(["convert", str(tmp_path / "s"), str(tmp_path / "m")]) == 0
    out = spark.read.json(str(tmp_path / "m"))
    assert out.count() == 4 and all(r.content.startswith("# T") and r.content_format == "markdown" for r in out.collect())
    assert cli.main(["convert", str(tmp_path / "s"), str(tmp_path / "m"), "--keep"]) == 0
    assert cli.main(["stats", str(tmp_path / "in"), str(tmp_path / "t.json"), "--test"]) == 0


def test_generation_commands(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text("\n".join(json.dumps({"question_id": i, "task_id": f"t{i}", "problem_description": "d", "python": "c"}) for i in range(3)))
    (tmp_path / "k.json").write_text(json.dumps({str(i): {"complexity_data": {"time_complexity": "O(n)"}} for i in range(2)}))
    (tmp_path / "c.yaml").write_text(f"forward: algo_complexity_pred\ncomplexity_data: {tmp_path}/k.json\ninput_path: {tmp_path}/p.jsonl\noutput_path: {tmp_path}/out.jsonl\nlimit: 5\nllm: false\n")
    assert cli.main(["run", str(tmp_path / "c.yaml")]) == 0
    assert cli.main(["run", str(tmp_path / "none.yaml")]) == 1
    assert spark.read.json(str(tmp_path / "out.jsonl")).count() == 2
    assert cli.main(["validate", str(tmp_path / "out.jsonl")]) == 1
    assert cli.main(["validate", str(tmp_path / "out.jsonl"), "--allow-empty-repo-name"]) == 0
    assert cli.main(["enrich", str(tmp_path / "p.jsonl"), str(tmp_path / "e.json"), "--existing", str(tmp_path / "k.json")]) == 0
    got = json.loads((tmp_path / "e.json").read_text())
    assert set(got) == {"0", "1", "2"} and json.loads(got["1"]["complexity_data"])["time_complexity"] == "O(n)" and got["2"]["complexity_data"] is None


def test_new_files_are_converted_once(spark, tmp_path):
    schema, src, out = "url string, content string", tmp_path / "in", str(tmp_path / "out")
    write_pages(spark, src, ROWS[:3])
    for _ in range(2):
        incremental.convert_new_files(incremental.page_stream(spark, str(src), schema), out, str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(out).count() == 3
    write_pages(spark, src, ROWS[3:], mode="append")
    incremental.convert_new_files(incremental.page_stream(spark, str(src), schema), out, str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 8 and got.where("domain = 'a.com' and content_format = 'markdown'").count() == 6


def test_counts_in_a_stream(spark, tmp_path):
    write_pages(spark, tmp_path / "in", ROWS)
    q = incremental.domain_counts(incremental.page_stream(spark, str(tmp_path / "in"), "url string, content string")).writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.domain: r.n for r in spark.table("counted").collect()} == {"a.com": 6, "b.com": 1}


def test_windows(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = incremental.windowed_counts(stream).writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    want = events.groupBy(F.window(F.col("ts").cast("timestamp"), "1 hour").start.alias("s"), "event_type").count()
    assert sorted((r.window_start, r.event_type, r.n) for r in spark.table("windows").collect()) == sorted((r.s, r.event_type, r["count"]) for r in want.collect())


def test_upserts(spark, tmp_path):
    src, table = tmp_path / "in", str(tmp_path / "t")
    for rows in ([("1", "a"), ("2", "b")], [("2", "c"), ("3", "d")]):
        spark.createDataFrame(rows, "question_id string, v string").coalesce(1).write.mode("append").parquet(str(src))
        incremental.upsert_by_key(spark.readStream.schema("question_id string, v string").parquet(str(src)), table, str(tmp_path / "cp")).awaitTermination()
    assert sorted(map(tuple, incremental.snapshot(spark, table).collect())) == [("1", "a"), ("2", "c"), ("3", "d")]
    assert incremental.snapshot(spark, str(tmp_path / "none")) is None


def test_upserts_take_the_last_row_and_may_run_again(spark, tmp_path):
    src, table = tmp_path / "in", str(tmp_path / "t")
    schema = "question_id string, v string, at long"
    for k, rows in enumerate(([("1", "a", 1), ("1", "late", 9), ("1", "b", 2)], [("1", "c", 3), ("2", "d", 1)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(src))
        for again in range(2):  # a second checkpoint hands the same rows over once more
            incremental.upsert_by_key(spark.readStream.schema(schema).parquet(str(src)), table, str(tmp_path / f"cp{k}{again}"), order="at", buckets=4).awaitTermination()
    assert sorted(map(tuple, incremental.snapshot(spark, table).collect())) == [("1", "late", 9), ("2", "d", 1)]


def test_a_model_is_asked_for_on_the_driver(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cli, "_model", lambda a: None)
    for name in ("p.jsonl", "k.json"):
        (tmp_path / name).write_text("{}\n")
    with pytest.raises(ValueError, match="needs a model"):
        cli.forward(spark, {"llm": True, "input_path": str(tmp_path / "p.jsonl"), "complexity_data": str(tmp_path / "k.json"), "output_path": str(tmp_path / "o.jsonl")})


def test_sandbox_service_prefix_and_discovery(tmp_path, monkeypatch):
    import threading

    server = boundary.sandbox_server(boundary.LocalSandbox(prefix=("env", "-u", "LANG")))
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        client = boundary.HttpSandbox(f"http://127.0.0.1:{server.server_address[1]}/run", attempts=1)
        good, bad = client([("print(input())", "hi"), ("raise SystemExit(3)", "")])
        assert good.ok and good.stdout == "hi\n" and not bad.ok
    finally:
        server.shutdown()
    (tmp_path / "found_tasks" / "deep").mkdir(parents=True)
    for p, text in (("__init__.py", ""), ("deep/__init__.py", ""), ("deep/one.py", "from textloom.registry import register_forward\n\n\n@register_forward('deep_one')\ndef f(spark, settings):\n    return None\n")):
        (tmp_path / "found_tasks" / p).write_text(text)
    monkeypatch.syspath_prepend(str(tmp_path))
    assert registry.discover("found_tasks") == ["found_tasks", "found_tasks.deep", "found_tasks.deep.one"]
    assert "deep_one" in registry.FORWARDS
