import json
import os

import pytest

from textloom.sources import files, sinks


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_json_arrays_skip_what_is_none(spark, tmp_path):
    put(tmp_path / "a.json", '[{"url": "u1"}, {"url": "u2", "more": 1}]')
    put(tmp_path / "b.json", '{"url": "object"}')
    put(tmp_path / "c.json", "[broken")
    put(tmp_path / "d.json", "[]")
    rows = files.read_json_arrays(spark, str(tmp_path), "url string").collect()
    assert sorted((r.url, r.source_file) for r in rows) == [("u1", "a.json"), ("u2", "a.json")]


def test_keyed_json(spark, tmp_path):
    p = put(tmp_path / "k.json", '{"1": {"response": "r", "complexity_data": {"time_complexity": "O(n)"}}, "2": {"complexity_data": null}}')
    rows = files.read_keyed_json(spark, p, "response string, complexity_data struct<time_complexity:string>").orderBy("question_id").collect()
    assert [(r.question_id, r.response, r.complexity_data and r.complexity_data.time_complexity) for r in rows] == [("1", "r", "O(n)"), ("2", None, None)]


def test_line_numbers(spark, tmp_path):
    lines = [f"line {i}" if i % 7 else "" for i in range(1, 5001)]
    put(tmp_path / "a.txt", "\n".join(lines) + "\n")
    put(tmp_path / "b.txt", "x\r\ny\rz")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        rows = files.numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = {(os.path.basename(r.path), r.line_num): r.value for r in rows}
    assert got == {("a.txt", i + 1): x for i, x in enumerate(lines)} | {("b.txt", 1): "x", ("b.txt", 2): "y", ("b.txt", 3): "z"}


def test_problems_keep_the_last_line(spark, tmp_path):
    p = put(tmp_path / "p.jsonl", '{"question_id": 1, "task_id": "old"}\n\n{"question_id": "1", "task_id": "new"}\n{"question_id": "", "task_id": "x"}\n{"task_id": "none"}\n')
    rows = files.read_problems(spark, p, "question_id string, task_id string").collect()
    assert sorted((r.question_id, r.task_id) for r in rows) == [("1", "new"), ("None", "none")]
    put(tmp_path / "p.jsonl", '{"question_id": 1}\n{broken\n')
    with pytest.raises(Exception):
        files.read_problems(spark, p, "question_id string, task_id string").collect()
    assert files.read_json_lines(spark, p, "question_id string").count() == 1


def test_folders(spark, tmp_path):
    put(tmp_path / "a.com" / "1.json", '[{"url": "u"}]')
    put(tmp_path / "a.com" / "a.com_markdown.json", '[{"url": "out"}]')
    put(tmp_path / ".hidden" / "1.json", '[{"url": "no"}]')
    rows = files.read_domain_folders(spark, str(tmp_path), "url string", "_markdown").collect()
    assert [(r.url, r.folder, r.source_file) for r in rows] == [("u", "a.com", "1.json")]
    assert sinks.remove_outputs(spark, str(tmp_path), "_markdown") == 1
    assert not (tmp_path / "a.com" / "a.com_markdown.json").exists() and (tmp_path / "a.com" / "1.json").exists()


def test_pages_by_pattern(spark, tmp_path):
    df = spark.createDataFrame([("u",)], "url string")
    df.coalesce(1).write.parquet(str(tmp_path / "d"))
    part = next(p for p in (tmp_path / "d").iterdir() if p.name.startswith("part-") and p.suffix == ".parquet")
    part.rename(tmp_path / "d" / "part-00000")
    df.coalesce(1).write.mode("append").parquet(str(tmp_path / "d"))
    other = next(p for p in (tmp_path / "d").iterdir() if p.name.startswith("part-") and p.suffix == ".parquet")
    other.rename(tmp_path / "d" / "other.parquet")
    rows = files.read_pages(spark, str(tmp_path / "d"), "part-*", "file").collect()
    assert [(r.url, r.file) for r in rows] == [("u", "part-00000")]
    assert [os.path.basename(x) for x in files.first_files(spark, str(tmp_path / "d"), 2)] == ["part-00000"]


def test_settings(tmp_path):
    p = put(tmp_path / "c.yaml", "# note\nforward: task\nlimit: 50\nllm: true\nprompt_template: |\n  one {a}\n\n  two\nname: 'x y'\nempty:\n")
    want = {"forward": "task", "limit": 50, "llm": True, "prompt_template": "one {a}\n\ntwo\n", "name": "x y", "empty": None}
    assert files.read_settings(p) == want == files._flat_yaml((tmp_path / "c.yaml").read_text())
    bad = put(tmp_path / "bad.yaml", "- a\n- b: [")
    assert files.read_template(str(tmp_path / "none.yaml"), bad, p)["forward"] == "task"
    assert files.read_template(str(tmp_path / "none.yaml")) == files.NO_TEMPLATE
    e = files.endpoint_settings({"LLM_ENDPOINT": "http://x"})
    assert e["endpoint"] == "http://x" and e["key"] is None and e["max_tokens"] == 16_000


def test_reports_and_counts(spark, tmp_path):
    p = str(tmp_path / "r" / "stats.json")
    sinks.write_report(spark, {"domain_distribution": {"é.com": 3, "b.com": 1}}, p)
    assert "é.com" in open(p, encoding="utf-8").read()
    assert sorted(map(tuple, files.read_domain_counts(spark, p).collect())) == [("b.com", 1), ("é.com", 3)]


def test_by_domain(spark, tmp_path):
    df = spark.createDataFrame([("a.b_c", "u1"), ("a_b.c", "u2"), ("a.b_c", "u3")], "domain string, url string")
    sinks.write_by_domain(df, str(tmp_path / "o"))
    back = spark.read.json(str(tmp_path / "o"))
    assert sorted((r.domain, r.url) for r in back.collect()) == [("a.b_c", "u1"), ("a.b_c", "u3"), ("a_b.c", "u2")]


def test_records(spark, tmp_path):
    df = spark.createDataFrame([("1", "é"), ("2", None)], "question_id string, t string")
    for name in ("x.jsonl", "x.json"):
        assert sinks.write_records(df, str(tmp_path / name), single_file=True)
        text = (tmp_path / name).read_text(encoding="utf-8")
        rows = json.loads(text) if name == "x.json" else [json.loads(x) for x in text.splitlines()]
        assert sorted(rows, key=str) == [{"question_id": "1", "t": "é"}, {"question_id": "2", "t": None}]
        assert sinks.write_records(df, str(tmp_path / ("many" + name)))
    assert not sinks.write_records(df.limit(0), str(tmp_path / "no.jsonl")) and not (tmp_path / "no.jsonl").exists()


def test_each_file_holds_one_array(spark, tmp_path):
    """Also where there are more tasks than shuffle partitions, and where a task has more rows than an array takes."""
    df = spark.range(2_000).repartition(20)
    for name, cut in (("tasks", {}), ("cut", {"array_chars": 300})):
        assert sinks.write_records(df, str(tmp_path / name), **cut)
        found = [json.loads(p.read_text()) for p in (tmp_path / name).glob("part-*") if p.stat().st_size]
        assert sorted(r["id"] for rows in found for r in rows) == list(range(2_000))
        assert len(found) == 20 if name == "tasks" else len(found) > 60
        assert files.read_json_arrays(spark, str(tmp_path / name), "id bigint").count() == 2_000
    assert sinks.write_records(df, str(tmp_path / "one.json"), single_file=True, array_chars=300)
    assert sorted(r["id"] for r in json.loads((tmp_path / "one.json").read_text())) == list(range(2_000))


def test_keyed_output(spark, tmp_path):
    df = spark.createDataFrame([("1", "old", 1), ("1", "new", 2), ("", "x", 3), (None, "y", 4), ('q"', "z", 5)], "question_id string, t string, _order int")
    sinks.write_keyed(df, str(tmp_path / "k.json"))
    got = json.loads((tmp_path / "k.json").read_text())
    assert {k: v["t"] for k, v in got.items()} == {"1": "new", 'q"': "z"}
    sinks.write_keyed(df, str(tmp_path / "k.jsonl"))
    assert spark.read.json(str(tmp_path / "k.jsonl")).count() == 5
