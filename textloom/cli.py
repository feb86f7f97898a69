"""Command line: python -m textloom.cli stats|collect|sample|convert|validate|enrich|run ..."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .boundary import HttpModel
from .operators import collect, convert, enrich, qa, sample, stats, validate
from .registry import FORWARDS, discover, register_forward
from .sources import files, sinks

PAGE = "url string, content string, domain string, file_source string"
PROBLEM = "question_id string, task_id string, problem_description string, content string, completion string, python_code_only string, python string, difficulty string, tags array<string>"
FACTS = "task_id string, response string, complexity_data struct<time_complexity:string, space_complexity:string, explanation:string>"


def _pages(spark: SparkSession, a: argparse.Namespace):
    path = files.first_files(spark, a.data_dir, a.test_files) if a.test else a.data_dir
    if a.test:
        return spark.read.parquet(*path).withColumn("_file", F.col(files.FILE))
    return files.read_pages(spark, path, "part-*", "_file", skip_bad_files=True)


def cmd_stats(spark: SparkSession, a: argparse.Namespace) -> int:
    pages = _pages(spark, a)
    report = stats.report(pages, a.min_frequency)
    sinks.write_report(spark, report, a.output)
    stats.domain_counts(pages, a.min_frequency, prune_many=True).write.mode("overwrite").json(f"{a.output}.domains")
    print(report["summary"])
    stats.protocol_counts(pages).orderBy(F.desc("n"), "protocol").show(truncate=False)
    stats.top_shares(pages, 20).show(truncate=False)
    return 0


def cmd_collect(spark: SparkSession, a: argparse.Namespace) -> int:
    pages = _pages(spark, a)
    counts = files.read_domain_counts(spark, a.stats) if a.stats else stats.top_domains(pages, a.max_domains)
    targets = counts.where(F.col("n") >= a.min_frequency)
    found = {r.domain: r.n for r in targets.orderBy(F.desc("n"), "domain").limit(a.max_domains).collect()}
    sinks.write_report(spark, {"total_domains": len(found), "min_frequency": a.min_frequency, "domains": found}, f"{a.output_dir}/target_domains.json")
    rows = collect.collect(pages, targets, file_column="_file").drop("_file")
    sinks.write_by_domain(rows, f"{a.output_dir}/domains")
    collect.by_file_and_domain(spark.read.json(f"{a.output_dir}/domains")).write.mode("overwrite").json(f"{a.output_dir}/collection_summary")
    rate = collect.collection_rate(pages, targets)
    rate.show()
    totals = rate.first().asDict()
    sinks.write_report(spark, {"total_urls_processed": totals["processed"], "total_urls_collected": totals["collected"], "collection_rate": totals["rate"]}, f"{a.output_dir}/collection_report.json", "collection_time")
    return 0


def cmd_sample(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = spark.read.json(a.input_dir)
    sinks.write_by_domain(sample.cluster_sample(rows, "url", "file_source", a.sample_size, a.max_files, a.seed).drop("rn"), a.output_dir)
    report = sample.sampling_report(rows, "file_source", a.sample_size, a.max_files, a.seed)
    report.write.mode("overwrite").json(f"{a.output_dir.rstrip('/')}_summary")
    sample.sampling_totals(report).show()
    return 0


def cmd_convert(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = spark.read.json(a.input_dir).withColumns({"source_file": F.col(files.FILE), "folder": F.col("domain")})
    if a.test:
        rows = convert.first_folders(rows, 3)
    done = None
    if a.keep:
        try:
            done = spark.read.json(a.output_dir).select("folder").distinct()
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
    out = convert.convert_folders(rows, done, a.max_files)
    convert.write_converted(out, a.output_dir, incremental=a.keep)
    convert.totals(convert.status(spark.read.json(a.output_dir))).show()
    return 0


def cmd_validate(spark: SparkSession, a: argparse.Namespace) -> int:
    ok, totals = validate.validate_file(spark, a.path, a.allow_empty_repo_name)
    print(totals if totals is not None else f"not found: {a.path}")
    return 0 if ok else 1


def _model(a) -> HttpModel | None:
    e = files.endpoint_settings()
    return HttpModel(e["endpoint"], e["model"] or "", e["key"] or "", e["system_prompt"], max_tokens=e["max_tokens"], concurrency=15) if e["endpoint"] else None


def cmd_enrich(spark: SparkSession, a: argparse.Namespace) -> int:
    problems = files.read_json_lines(spark, a.input, PROBLEM)
    old = None
    if a.existing:
        old = files.read_keyed_json(spark, a.existing, FACTS).withColumn("complexity_data", F.to_json("complexity_data"))
    prompt = files.read_template(a.template)["prompt_template"] if a.template else enrich.PROMPT
    out = enrich.enrich(problems, _model(a), old, a.max_retries, a.limit, prompt)
    sinks.write_keyed(out, a.output)
    enrich.with_results(out).show()
    return 0


@register_forward("algo_complexity_pred")
def forward(spark: SparkSession, settings: dict):
    """Question/answer records of a settings file, written to its output path."""
    problems = files.read_problems(spark, settings["input_path"], PROBLEM)
    facts = files.read_keyed_json(spark, settings["complexity_data"], FACTS)
    limit, model = int(settings.get("limit") or 0), settings.get("model")
    if settings.get("llm"):
        if model is None and (model := _model(None)) is None:
            raise ValueError("llm: true needs a model: neither settings nor the environment name an endpoint")
        records = qa.model_records(problems, facts, model, limit, settings.get("prompt_template", qa.PROMPT))
    else:
        records = qa.basic_records(problems, facts, limit)
    sinks.write_records(records, settings["output_path"])
    qa.distributions(records).orderBy("kind", "key").show(100, truncate=False)
    return records


def cmd_run(spark: SparkSession, a: argparse.Namespace) -> int:
    try:
        settings = files.read_settings(a.config)
    except OSError:
        print(f"not found: {a.config}")
        return 1
    for package in settings.get("packages", "").split():
        discover(package)
    FORWARDS[settings["forward"]](spark, settings)
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="textloom")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, f, *args: tuple) -> None:
        c = sub.add_parser(name)
        for flag, kw in args:
            c.add_argument(flag, **kw)
        c.set_defaults(f=f)

    data, test = ("data_dir", {}), ("--test", {"action": "store_true"})
    number = lambda d: {"type": int, "default": d}
    command("stats", cmd_stats, data, ("output", {}), ("--min-frequency", number(2)), test, ("--test-files", number(2)))
    command("collect", cmd_collect, data, ("output_dir", {}), ("--stats", {}), ("--min-frequency", number(100)), ("--max-domains", number(100)), test, ("--test-files", number(25)))
    command("sample", cmd_sample, ("input_dir", {}), ("output_dir", {}), ("--sample-size", number(100)), ("--max-files", number(10)), ("--seed", number(42)))
    command("convert", cmd_convert, ("input_dir", {}), ("output_dir", {}), ("--max-files", number(0)), ("--keep", {"action": "store_true"}), test)
    command("validate", cmd_validate, ("path", {}), ("--allow-empty-repo-name", {"action": "store_true"}))
    command("enrich", cmd_enrich, ("input", {}), ("output", {}), ("--existing", {}), ("--template", {}), ("--limit", number(0)), ("--max-retries", number(3)))
    command("run", cmd_run, ("config", {}))
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    return a.f(SparkSession.builder.appName("textloom").getOrCreate(), a)


if __name__ == "__main__":
    sys.exit(main())
