"""Enrichment of problems by a model, with results kept between runs and failures asked again.

Everything is joined by key, so new and repeated rows may mix; each round is written before the next begins, so a lost executor
sends no prompt of an earlier round again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..boundary import Model, ask
from ..functions.json_text import json_text
from ..functions.text import render

NO_CODE = "# No code available"
ROUNDS = 3
PROMPT = """Give the time and the space complexity of the code below in Big O notation, as tight as you can, in plain ASCII (n^2, not superscripts).

Problem: {problem_description}

Code:
{code}

Reply with a JSON object:
```json
{{"time_complexity": "O(...)", "space_complexity": "O(...)", "explanation": "..."}}
```"""


def prompt_fields(problems: DataFrame) -> dict[str, Column]:
    """``python``, or ``python_code_only`` where the table has no such column; the description, or ``content`` where it is empty."""
    has = lambda c: c in problems.columns
    code = F.col("python") if has("python") else F.col("python_code_only") if has("python_code_only") else F.lit(NO_CODE)
    text = F.coalesce(F.col("problem_description"), F.lit("")) if has("problem_description") else F.lit("")
    if has("content"):
        text = F.when(text == "", F.coalesce(F.col("content"), F.lit(""))).otherwise(text)
    return {"problem_description": text, "code": code}


def resume(problems: DataFrame, existing: DataFrame | None, key: str = "question_id") -> DataFrame:
    """(question_id, task_id, response, complexity_data, needs_call): a row that has a result is taken as it is; one whose result
    is null, and a new one, needs a call."""
    base = problems.select(F.col(key).cast("string").alias("question_id"), (F.coalesce(F.col("task_id"), F.lit("")) if "task_id" in problems.columns else F.lit("")).alias("task_id"))
    if existing is None:
        none = F.lit(None).cast("string")
        return base.select("question_id", "task_id", none.alias("response"), none.alias("complexity_data"), F.lit(True).alias("needs_call"))
    old = existing.select(F.col(key).cast("string").alias("question_id"), F.struct(*[F.col(c) for c in ("task_id", "response", "complexity_data")]).alias("old"))
    both = base.join(old, "question_id", "left")
    task = F.when(F.col("old").isNotNull(), F.col("old.task_id")).otherwise(F.col("task_id"))
    return both.select("question_id", task.alias("task_id"), F.col("old.response").alias("response"), F.col("old.complexity_data").alias("complexity_data"), F.col("old.complexity_data").isNull().alias("needs_call"))


def _folder(spark, name: str) -> str:
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: driver and executors need a folder that all of them reach")
        import tempfile

        top = "file://" + tempfile.mkdtemp(prefix="textloom-")
    return f"{top.rstrip('/')}/textloom-{name}-{uuid.uuid4().hex[:12]}"


def enrich(problems: DataFrame, model: Model | None, existing: DataFrame | None = None, rounds: int = ROUNDS, limit: int = 0, prompt: str = PROMPT, calls: int | None = None, key: str = "question_id") -> DataFrame:
    """(question_id, task_id, response, complexity_data) of all problems; ``complexity_data`` is JSON text. Up to ``rounds`` calls a
    row; the last reply is kept, whether it could be read or not. Without a model, only what exists is put together."""
    spark = problems.sparkSession
    if limit > 0:
        problems = problems.orderBy(key).limit(limit)
    state = resume(problems, existing, key)
    cols = ["question_id", "task_id", "response", "complexity_data"]
    if model is None:
        return state.select(*cols)
    folder = _folder(spark, "enrich")
    prompts = problems.select(F.col(key).cast("string").alias("question_id"), render(prompt, **prompt_fields(problems)).alias("_prompt"))
    done = []
    for k in range(rounds):
        todo = state.where("needs_call")
        asked = todo.select("question_id", "task_id").join(prompts, "question_id")
        if calls:
            asked = asked.repartition(calls)
        got = asked.withColumn("_got", ask(F.col("_prompt"), model, json_text)).withColumns({"response": F.col("_got.reply"), "complexity_data": F.col("_got.read")})
        got = got.select(*cols, (F.col("complexity_data").isNull() & F.lit(k < rounds - 1)).alias("needs_call"))
        got.write.mode("overwrite").parquet(f"{folder}/round{k}")
        got = spark.read.parquet(f"{folder}/round{k}")
        done.append(state.where("not needs_call"))
        state = got
        if got.where("needs_call").isEmpty():
            break
    done.append(state)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select(*cols)


def with_results(enriched: DataFrame) -> DataFrame:
    """(total, total_with_complexity): an empty object or list is no result."""
    there = F.col("complexity_data").isNotNull() & ~F.col("complexity_data").isin("{}", "[]", '""', "0", "false")
    return enriched.agg(F.count("*").alias("total"), F.count_if(there).alias("total_with_complexity"))
