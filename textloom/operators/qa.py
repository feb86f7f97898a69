"""Question/answer records from problems and their complexity: by template, or from a model's replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..boundary import Model, ask
from ..functions.text import first_filled, parse_queries, render

# What the records say.
TASK, STYLE, SOURCE, TYPE = "algo_complexity_pred", "model", "oc_leetcode", "algorithm_complexity_prediction"
QUESTION = "Analyze the time and space complexity of the following algorithm solution for: {task_id}.\n\nProblem: {problem_description}\n\nCode:\n```python\n{code}\n```\n\nWhat are the time complexity and space complexity of this solution? Please provide a detailed explanation."
ANSWER = "**Time Complexity**: {time_complexity}\n**Space Complexity**: {space_complexity}\n\n**Explanation**: {explanation}"

#: Asks a model for queries; ``parse_queries`` reads what comes back. Deployments pass their own.
PROMPT = """Write one to three hard, self-contained questions on the complexity of the solution below, each with its short answer.

Problem: {problem_description}

Code:
{code}

Known: time {time_complexity}, space {space_complexity}. {explanation}

Reply in this form, TIME or SPACE being what a question asks for:
===QUERIES_START===
===QUERY_START===
QUERY_ID: 1
COMPLEXITY_TYPE: TIME
QUERY: the question, with problem and code
GROUND_TRUTH: the notation alone
===QUERY_END===
===QUERIES_END==="""

PROBLEM_FIELDS = ("task_id", "problem_description", "completion", "python_code_only", "python", "difficulty")
FACTS = ("time_complexity", "space_complexity", "explanation")


def _text(df: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in df.columns else F.lit("")


def join_problems(problems: DataFrame, complexity: DataFrame, key: str = "question_id") -> DataFrame:
    """Problems with code, joined with what is known of their complexity (columns of ``FACTS``, flat or within ``complexity_data``)."""
    nested = "complexity_data" in complexity.columns
    c = complexity.where(F.col("complexity_data").isNotNull()) if nested else complexity
    facts = [F.coalesce(F.col(f"complexity_data.{f}" if nested else f).cast("string"), F.lit("")).alias(f) for f in FACTS if nested or f in c.columns]
    c = c.select(F.col(key).cast("string").alias("question_id"), *facts)
    code = first_filled(*[F.col(n) for n in ("completion", "python_code_only", "python") if n in problems.columns] or [F.lit("")])
    tags = F.coalesce(F.col("tags"), F.array().cast("array<string>")) if "tags" in problems.columns else F.array().cast("array<string>")
    p = problems.select(F.col(key).cast("string").alias("question_id"), *[_text(problems, n).alias(n) for n in ("task_id", "problem_description", "difficulty")], tags.alias("tags"), code.alias("code"))
    both = c.join(p.where(F.col("code") != ""), "question_id")
    return both.withColumns({f: F.lit("") for f in FACTS if f not in both.columns})


def _limited(joined: DataFrame, limit: int) -> DataFrame:
    """The first rows by key, numbers as numbers: a limit that reruns repeat."""
    return joined.orderBy(F.try_to_number("question_id", F.lit("9999999999999999999")).asc_nulls_last(), "question_id").limit(limit) if limit > 0 else joined


def _record(question: Column, truth: Column, extra: list[Column]) -> list[Column]:
    reward = F.struct(truth.alias("ground_truth"), F.lit(STYLE).alias("style"))
    return [F.lit(TASK).alias("task_id"), question.alias("question"), reward.alias("reward"), F.lit(SOURCE).alias("data_source"), F.lit("").alias("repo_name"), F.struct(*extra).alias("extra_info")]


def _shared(kind: Column) -> list[Column]:
    q = F.col("question_id")
    return [F.concat(F.lit("complexity_"), q, F.lit("_"), kind).alias("id"), q.cast("long").alias("question_id"), F.col("task_id").alias("leetcode_task_id"), F.col("difficulty"), F.col("tags"), F.lit(TYPE).alias("type")]


def basic_records(problems: DataFrame, complexity: DataFrame, limit: int = 0, key: str = "question_id") -> DataFrame:
    """One record a problem, from templates; a question id that is no number ends the run."""
    j = _limited(join_problems(problems, complexity, key), limit)
    fields = {c: F.col(c) for c in (*FACTS, "task_id", "problem_description", "code")}
    extra = [*_shared(F.lit("basic")), F.lit("basic").alias("pair_id"), F.col("problem_description"), F.col("code"), F.col("time_complexity"), F.col("space_complexity"), F.lit(False).alias("llm_generated")]
    return j.select(*_record(render(QUESTION, **fields), render(ANSWER, **fields), extra))


def model_records(problems: DataFrame, complexity: DataFrame, model: Model, limit: int = 0, prompt: str = PROMPT, calls: int | None = None, key: str = "question_id") -> DataFrame:
    """A record for each query that a model's reply holds. ``calls`` is the number of tasks that call the model at the same time."""
    j = _limited(join_problems(problems, complexity, key), limit)
    fields = {c: F.col(c) for c in (*FACTS, "problem_description", "code")}
    j = j.withColumn("_prompt", render(prompt, **fields))
    if calls:
        j = j.repartition(calls)
    rows = j.withColumn("_reply", ask(F.col("_prompt"), model)).withColumn("_q", F.explode(parse_queries(F.col("_reply"))))
    extra = [*_shared(F.col("_q.query_id")), F.col("_q.query_id").alias("query_id"), F.col("_q.complexity_type").alias("complexity_type"), F.col("problem_description"), F.col("code"), F.col("time_complexity").alias("original_time_complexity"), F.col("space_complexity").alias("original_space_complexity"), F.lit(True).alias("llm_generated")]
    return rows.select(*_record(F.col("_q.query"), F.col("_q.ground_truth"), extra))


def distributions(records: DataFrame) -> DataFrame:
    """(kind, key, n): counts of difficulty, complexity type, time and space complexity, for either kind of record, in one pass."""
    e = records.schema["extra_info"].dataType.names
    x = lambda name: F.col(f"extra_info.{name}") if name in e else F.lit(None).cast("string")
    truth = F.col("reward.ground_truth")
    kind = x("complexity_type")
    pairs = F.array(
        F.struct(F.lit("difficulty").alias("kind"), x("difficulty").alias("key")),
        F.struct(F.lit("complexity_type").alias("kind"), kind.alias("key")),
        F.struct(F.lit("time_complexity").alias("kind"), F.when(kind.isNull(), x("time_complexity")).when(kind == "TIME", truth).alias("key")),
        F.struct(F.lit("space_complexity").alias("kind"), F.when(kind.isNull(), x("space_complexity")).when(kind == "SPACE", truth).alias("key")),
    )
    rows = records.select(F.explode(pairs).alias("p")).select("p.*")
    # Each record has a difficulty, empty or not; the others count only where there is something.
    return rows.where(F.col("key").isNotNull() & ((F.col("kind") == "difficulty") | (F.col("key") != ""))).groupBy("kind", "key").agg(F.count("*").alias("n"))
