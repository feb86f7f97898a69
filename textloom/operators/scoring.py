"""Scores of answers: complexity notation by rule, then by a judge where the rule finds nothing; code by running its tests."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..boundary import Model, Sandbox, ask
from ..functions.harden import program
from ..functions.text import compare_complexity, extract_complexity, has_notation, is_blank, render, strip

#: Characters of a response that a score keeps.
SHOWN = 2048
JUDGE_PROMPT = """Does the response below give the expected answer to a question on the complexity of an algorithm?

Response: "{response}"
Expected: "{ground_truth}"

Notation that means the same counts (O(n^2), O(n²), O(n**2)), and so do words (linear for O(n), constant for O(1)).
Answer with YES or NO only."""


def no_judge(prompts: list[str]) -> list[str | None]:
    return [None] * len(prompts)


def is_yes(reply: Column) -> Column:
    return F.coalesce(F.upper(strip(reply)) == "YES", F.lit(False))


def score_complexity(answers: DataFrame, judge: Model = no_judge, solution: str = "solution_str", truth: str = "ground_truth", prompt: str = JUDGE_PROMPT) -> DataFrame:
    """The answers with a score and what it rests on. One pass: the judge's prompt is null for rows that the rule settles, and null
    prompts are not sent."""
    s, given = F.coalesce(F.col(solution), F.lit("")), strip(F.coalesce(F.col(truth), F.lit("")))
    blank, no_truth = is_blank(s), given == ""
    df = answers.withColumn("__textloom_found", extract_complexity(F.col(solution))).withColumn("__textloom_truth", given)
    rule = F.coalesce(compare_complexity(F.col("__textloom_found"), F.col("__textloom_truth")), F.lit(False))
    df = df.withColumn("__textloom_rule", rule)
    needs = ~blank & ~no_truth & ~F.col("__textloom_rule")
    df = df.withColumn("__textloom_yes", is_yes(ask(F.when(needs, render(prompt, response=s, ground_truth=F.col("__textloom_truth"))), judge)))
    live = ~blank & ~no_truth
    found = F.col("__textloom_found").isNotNull()
    right = F.col("__textloom_rule") | F.col("__textloom_yes")
    method = F.when(F.col("__textloom_rule"), "rule_based").when(found, "hybrid_rule_extract_llm_judge").when(F.col("__textloom_yes"), "llm_judgment").otherwise("extraction_failed")
    out = df.withColumns({
        "score": F.when(live & right, 1.0).otherwise(0.0),
        "valid_response": F.when(blank, 0).otherwise(1),
        "extracted_complexity": F.when(live, F.when(found, F.col("__textloom_found")).when(F.col("__textloom_yes"), F.lit("LLM_DETERMINED"))),
        "ground_truth_complexity": F.when(live, F.col("__textloom_truth")),
        "is_correct": F.when(live, right),
        "method_used": F.when(live, method),
        "has_clear_notation": F.when(live, has_notation(s)),
        "response_length": F.when(live, F.length(s)),
        "response": F.when(live, F.substring(s, 1, SHOWN)),
        "error": F.when(~blank & no_truth, "Empty ground truth"),
    })
    return out.drop("__textloom_found", "__textloom_truth", "__textloom_rule", "__textloom_yes")


def score_code(answers: DataFrame, sandbox: Sandbox, solution: str = "solution_str", imports: str = "import_code", tests: str = "test_code", strict: bool = False) -> DataFrame:
    """The answers with ``score`` (1 if all assertions ran and held, and nothing was written to stderr), ``valid_code`` and ``error``.
    Code that doesn't parse, and tests that can't be counted, score 0 with an error, or end the run if ``strict``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made: list[tuple[str | None, str | None]] = []
            for s, i, t in zip(b[solution], b[imports], b[tests], strict=True):
                try:
                    made.append((program(s, i or "", t or "") if s else None, None))
                except (SyntaxError, ValueError) as e:
                    if strict:
                        raise
                    made.append((None, f"{type(e).__name__}: {e}"))
            ran = iter(sandbox([(code, "") for code, _ in made if code is not None]))
            score, error = [], []
            for code, why in made:
                r = next(ran) if code is not None else None
                score.append(float(r is not None and r.ok and not r.stderr))
                error.append(why if r is None else (None if r.ok and not r.stderr else (r.stderr.strip().split("\n")[-1] or r.status)))
            yield b.assign(score=score, valid_code=[int(bool(s)) for s in b[solution]], error=pd.Series(error, dtype=object, index=b.index))

    from pyspark.sql import types as T

    schema = T.StructType([*answers.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("valid_code", T.IntegerType()), T.StructField("error", T.StringType())])
    return answers.mapInPandas(run, schema)


def pass_rate(scored: DataFrame, expected: str = "expected_score") -> DataFrame:
    """(n, passed, rate) of scored cases against what they should score."""
    hit = F.abs(F.col("score") - F.col(expected)) < 1e-6
    return scored.agg(F.count("*").alias("n"), F.count_if(hit).alias("passed"), F.round(F.avg(hit.cast("double")), 4).alias("rate"))
