import json

import pytest
from pyspark.sql import functions as F

from textloom import boundary, registry
from textloom.operators import collect, convert, enrich, qa, sample, scoring, stats, validate
from textloom.plans import cases


def test_report(spark):
    pages = spark.createDataFrame([("http://a.com/1",), ("http://a.com/2",), ("https://b.com",), (None,), ("",), ("/x",)], "url string")
    r = stats.report(pages, 2)
    assert r["summary"] == {"total_records": 6, "valid_urls": 3, "invalid_urls": 3, "unique_domains_total": 2, "unique_domains_filtered": 1, "min_frequency_threshold": 2}
    assert r["protocol_distribution"] == {"http": 2, "https": 1} and list(r["domain_distribution"].items()) == [("a.com", 2), ("b.com", 1)]
    none = stats.url_summary(spark.createDataFrame([(1,)], "x int"), 2).first()
    assert (none.total_records, none.valid_urls, none.invalid_urls) == (1, 0, 0)


def test_pruning_of_many_domains(spark, monkeypatch):
    pages = spark.createDataFrame([(f"http://d{i % 50}.com",) for i in range(60)], "url string")
    assert stats.domain_counts(pages, prune_many=True).count() == 50
    monkeypatch.setattr(stats, "MANY", 10)
    assert stats.domain_counts(pages, prune_many=True).count() == 10


def test_columns_that_are_there_stay(spark):
    pages = spark.createDataFrame([("http://a.com", "mine", "f1")], "url string, domain string, part string")
    assert collect.with_domain(pages, file_column="part").first().asDict() == {"url": "http://a.com", "domain": "mine", "part": "f1", "file_source": "f1"}
    got = collect.collect(pages, spark.createDataFrame([("a.com", 1)], "domain string, n long"), file_column="part").first()
    assert got.domain == "mine" and got.file_source == "f1"


def test_failed_samples(spark):
    rows = spark.createDataFrame([("a", "f1", i) for i in range(5)] + [("a", "f2", 9)], "domain string, file_source string, k long")
    domains = spark.createDataFrame([("a",), ("b",)], "domain string")
    t = sample.sampling_totals(sample.sampling_report(rows, "file_source", 3, 1, domains=domains)).first()
    assert (t.total_domains, t.successful_samples, t.failed_samples) == (2, 1, 1)
    assert len({r.file_source for r in sample.cluster_sample(rows, "k", "file_source", 10, 1).collect()}) == 1
    assert sample.cluster_sample(rows, "k", "file_source", 10, 0).count() == 6


def test_conversion_states(spark):
    def converter(t):
        if t == "bad":
            raise ValueError(t)
        return t.upper()

    rows = spark.createDataFrame([("a", "f", "x"), ("a", "f", ""), ("a", "g", None), ("b", "f", "bad")], "folder string, source_file string, content string")
    out = convert.convert(rows, converter=converter)
    assert sorted((r.folder, r.content, r.content_format) for r in out.collect() if r.content is not None) == [("a", "", "raw"), ("a", "X", "markdown"), ("b", "bad", "error")]
    folders = spark.createDataFrame([("a",), ("b",), ("c",)], "folder string")
    st = convert.folder_status(folders, out)
    got = {r.folder: (r.source_files, r.total_items, r.processed_items, r.error_items, r.success) for r in st.collect()}
    assert got == {"a": (2, 3, 1, 0, True), "b": (1, 1, 0, 1, True), "c": (0, 0, 0, 0, False)}
    t = convert.totals(st).first()
    assert (t.successful, t.failed, t.total_items, t.rate) == (2, 1, 4, 25.0)
    assert convert.convert(rows.drop("content")).first().content_format is None
    assert {r.folder for r in convert.convert_folders(rows, done=folders.where("folder = 'a'"), converter=converter).collect()} == {"b"}
    assert convert.first_files(rows, 1).count() == 3 and convert.first_folders(rows, 1).count() == 3


def test_incremental_output(spark, tmp_path):
    rows = spark.createDataFrame([("a", "f", "<p>x</p>"), ("b", "f", "<p>y</p>")], "folder string, source_file string, content string")
    convert.write_converted(convert.convert(rows), str(tmp_path / "o"))
    more = spark.createDataFrame([("b", "f", "<p>z</p>")], "folder string, source_file string, content string")
    convert.write_converted(convert.convert(more), str(tmp_path / "o"), incremental=True)
    assert sorted((r.folder, r.content) for r in spark.read.json(str(tmp_path / "o")).collect()) == [("a", "x"), ("b", "z")]


PROBLEM = "question_id string, task_id string, problem_description string, completion string, python_code_only string, python string, difficulty string, tags array<string>"


def problems(spark):
    return spark.createDataFrame([("10", "t10", "d", "", None, "code {x}", "Easy", ["a"]), ("9", "t9", "d", "c9", "n", "n", "Hard", None), ("8", "t8", "d", "", "", "", "Hard", []), ("7", None, None, "c7", None, None, None, None)], PROBLEM)


def facts(spark):
    return spark.createDataFrame([("10", ("O(n)", "O(1)", "why")), ("9", (None, "O(n)", None)), ("8", ("O(1)", "O(1)", "x")), ("7", None), ("6", ("a", "b", "c"))], "question_id string, complexity_data struct<time_complexity:string, space_complexity:string, explanation:string>")


def test_basic_records(spark):
    rows = {r.extra_info.question_id: r for r in qa.basic_records(problems(spark), facts(spark)).collect()}
    assert set(rows) == {9, 10}
    r = rows[10]
    assert (r.task_id, r.data_source, r.repo_name, r.reward.style) == ("algo_complexity_pred", "oc_leetcode", "", "model")
    assert r.reward.ground_truth == "**Time Complexity**: O(n)\n**Space Complexity**: O(1)\n\n**Explanation**: why"
    assert "```python\ncode {x}\n```" in r.question and r.extra_info.tags == ["a"] and r.extra_info.id == "complexity_10_basic" and len(r.extra_info) == 12
    assert rows[9].extra_info.code == "c9" and rows[9].extra_info.time_complexity == ""
    assert [r.extra_info.question_id for r in qa.basic_records(problems(spark), facts(spark), limit=1).collect()] == [9]
    bad = problems(spark).withColumn("question_id", F.lit("x"))
    with pytest.raises(Exception):
        qa.basic_records(bad, facts(spark).withColumn("question_id", F.lit("x"))).collect()


def test_records_fail_validation_only_by_their_empty_name(spark):
    recs = qa.basic_records(problems(spark), facts(spark)).select(F.to_json(F.struct("*")).alias("value"))
    assert validate.summary(validate.validate(recs)).first().total_errors == 2
    assert validate.summary(validate.validate(recs, allow_empty_repo_name=True)).first().passed


def test_model_records(spark):
    model = boundary.canned({"code {x}": cases.REPLY})
    rows = qa.model_records(problems(spark), facts(spark), model, calls=2).collect()
    assert sorted((r.extra_info.id, r.extra_info.complexity_type, r.reward.ground_truth) for r in rows) == [("complexity_10_1", "TIME", "O(n)"), ("complexity_10_unknown", "SPACE", "O(1)")]
    d = {(r.kind, r.key): r.n for r in qa.distributions(qa.model_records(problems(spark), facts(spark), model)).collect()}
    assert d == {("difficulty", "Easy"): 2, ("complexity_type", "TIME"): 1, ("complexity_type", "SPACE"): 1, ("time_complexity", "O(n)"): 1, ("space_complexity", "O(1)"): 1}


def test_rounds_ask_only_for_failures(spark, tmp_path):
    log = tmp_path / "asked"
    log.mkdir()

    def model(prompts):
        import os
        import uuid

        out = []
        for p in prompts:
            key = p.split("|")[0]
            seen = sum(f.startswith(key + "-") for f in os.listdir(log))
            (log / f"{key}-{uuid.uuid4().hex}").touch()
            out.append({"good": '{"a": 1}', "late": '{"a": 2}' if seen else None}.get(key, "never"))
        return out

    p = spark.createDataFrame([("1", "good"), ("2", "late"), ("3", "bad"), ("4", "kept"), ("5", "good")], "question_id string, python string")
    old = spark.createDataFrame([("4", "t", "r", "{}"), ("5", "t5", "r", None)], "question_id string, task_id string, response string, complexity_data string")
    out = enrich.enrich(p, model, old, prompt="{code}|", calls=2)
    got = {r.question_id: (r.task_id, r.response, r.complexity_data) for r in out.collect()}
    assert got == {"1": ("", '{"a": 1}', '{"a": 1}'), "2": ("", '{"a": 2}', '{"a": 2}'), "3": ("", "never", None), "4": ("t", "r", "{}"), "5": ("t5", '{"a": 1}', '{"a": 1}')}
    asked = [f.name.split("-")[0] for f in log.iterdir()]
    assert {k: asked.count(k) for k in set(asked)} == {"good": 2, "late": 2, "bad": 3}
    t = enrich.with_results(out).first()
    assert (t.total, t.total_with_complexity) == (5, 3)
    assert enrich.enrich(p, None, old).where("complexity_data is not null").count() == 1


def test_a_model_gets_a_batch_in_parts(spark):
    """Of a batch only so many prompts are Python objects; replies and what is read from them stay with their rows."""
    df = spark.range(1_000).coalesce(1).select("id", F.when(F.col("id") % 10 > 0, F.col("id").cast("string")).alias("p"))
    model = lambda prompts: [f'{{"of": {p}, "at_once": {len(prompts)}}}' if int(p) % 7 else None for p in prompts]
    plain = {r.id: r.a for r in df.select("id", boundary.ask(F.col("p"), model).alias("a")).collect()}
    assert all((plain[k] is None) == (k % 10 == 0 or k % 7 == 0) for k in range(1_000))
    found = {k: json.loads(a) for k, a in plain.items() if a}
    assert all(v["of"] == k and v["at_once"] <= boundary.AT_ONCE for k, v in found.items())
    both = df.select("id", boundary.ask(F.col("p"), model, lambda reply: reply and reply[:6]).alias("a")).collect()
    assert all(r.a.reply == plain[r.id] and r.a.read == (r.a.reply and '{"of":') for r in both)
    with pytest.raises(Exception, match="1 replies to 230 prompts"):
        df.select(boundary.ask(F.col("p"), lambda prompts: ["x"])).collect()


def test_prompt_fields(spark):
    only = spark.createDataFrame([("c", "", "text")], "python_code_only string, problem_description string, content string")
    f = enrich.prompt_fields(only)
    assert tuple(only.select(f["code"], f["problem_description"]).first()) == ("c", "text")
    null = spark.createDataFrame([(None, "c")], "python string, python_code_only string")
    assert null.select(enrich.prompt_fields(null)["code"]).first()[0] is None


def test_judge_gets_only_what_the_rule_leaves(spark):
    df = spark.createDataFrame(cases.COMPLEXITY, "solution_str string, ground_truth string, expected double")

    def judge(prompts):
        assert len(prompts) <= 8 and all("Expected" in p for p in prompts)
        return cases.judge(prompts)

    rows = scoring.score_complexity(df.coalesce(1), judge).collect()
    assert [r.score for r in rows] == [r.expected for r in rows]
    alone = scoring.score_complexity(df).where("score = expected").count()
    assert alone == 22
    long = spark.createDataFrame([("x" * 3000 + " O(n)", " O(n) "), ("O(n)", "  "), (None, "O(n)")], "solution_str string, ground_truth string")
    a, b, c = scoring.score_complexity(long.coalesce(1)).collect()
    assert len(a.response) == 2048 and a.response_length == 3005 and a.score == 1.0 and a.ground_truth_complexity == "O(n)"
    assert (b.score, b.valid_response, b.error) == (0.0, 1, "Empty ground truth") and (c.score, c.valid_response) == (0.0, 0)


def test_strict_code_scores(spark):
    df = spark.createDataFrame([("def f(", "", "assert 1")], "solution_str string, import_code string, test_code string")
    assert scoring.score_code(df, boundary.LocalSandbox()).first().error.startswith("SyntaxError")
    with pytest.raises(Exception):
        scoring.score_code(df, boundary.LocalSandbox(), strict=True).collect()


def test_sandbox_limits():
    box = boundary.LocalSandbox(timeout=5.0, memory_mb=256)
    ok, echo, slow, big, env = box([("print(1)", ""), ("print(input() + '!')", "hi"), ("import time\ntime.sleep(60)", ""), ("x = bytearray(1 << 30)", ""), ("import os\nprint(sorted(os.environ))", "")])
    assert ok.ok and ok.stdout == "1\n" and echo.stdout == "hi!\n"
    assert slow.status == "timeout" and big.status == "runtime_error" and "MemoryError" in big.stderr
    assert "JAVA_HOME" not in env.stdout


def test_http_model():
    calls = []

    def post(url, body, headers, timeout):
        calls.append(body["messages"][-1]["content"])
        if calls[-1] == "bad":
            return 500, "oops"
        if calls[-1] == "stop":
            return 400, json.dumps({"error": {"code": "-4003"}})
        return 200, json.dumps({"choices": [{"message": {"content": calls[-1].upper()}}]})

    m = boundary.HttpModel("http://x", "m", pause=0.0, post=post)
    assert m(["a", "bad", "stop"]) == ["A", None, None]
    assert calls.count("bad") == 3 and calls.count("stop") == 1


def test_http_sandbox():
    seen = []

    def post(url, body, headers, timeout):
        seen.append(body)
        if body["code"] == "down":
            raise OSError("down")
        return 200, json.dumps({"status": "success", "run_result": {"stdout": "o"}})

    box = boundary.HttpSandbox("http://x", post=post)
    a, b = box([("c", "in"), ("down", "")])
    assert (a.ok, a.stdout, a.stderr) == (True, "o", "") and b.status == "runtime_error" and seen[0]["run_timeout"] == 3.0
    with pytest.raises(ValueError):
        boundary.HttpSandbox("http://x", language="c")


def test_async_batches():
    import asyncio

    now, most = [0], [0]

    async def call(p):
        now[0] += 1
        most[0] = max(most[0], now[0])
        await asyncio.sleep(0.001)
        now[0] -= 1
        if p == "x":
            raise ValueError
        return p * 2

    out = asyncio.run(boundary.in_batches(["a", "x", "b"] * 10, call, batch_size=7, concurrency=3))
    assert out == ["aa", None, "bb"] * 10 and most[0] <= 3
    assert asyncio.run(boundary.in_batches([], call)) == []


def test_registry(spark):
    @registry.register_reward_score(["len", "size"])
    def score(solution, truth, extra):
        return {"score": len(solution) / 10, "extra_info": {"t": truth}}

    df = spark.createDataFrame([("abc", "t", None)], "s string, t string, e string")
    r = df.select(registry.scorer_column("size")("s", "t", "e").alias("r")).first().r
    assert (r.score, json.loads(r.extra_info)) == (0.3, {"t": "t"})
    for bad in ([], [1], ["a", None]):
        with pytest.raises(ValueError):
            registry.register_forward(bad)
    registry.register_forward("")(len)
    assert registry.FORWARDS.pop("") is len


def test_validate_file(spark, tmp_path):
    p = tmp_path / "r.jsonl"
    p.write_text("\n".join(t for t, *_ in cases.RECORDS), encoding="utf-8")
    ok, totals = validate.validate_file(spark, str(p))
    assert not ok and totals["total_lines"] == 17 and totals["valid_lines"] == 2
    p.write_text("", encoding="utf-8")
    assert validate.validate_file(spark, str(p))[0]
    assert validate.validate_file(spark, str(tmp_path / "none.jsonl")) == (False, None)
    p.write_bytes(b'{"task_id": "\xff"}\n')
    assert validate.validate_file(spark, str(p))[0] is False
