"""Validation of training records: six fields of fixed types, a reward of fixed form, no blank strings, no more fields.

Lines are parsed once, strictly, in an Arrow UDF that returns the kinds of their fields; the rules are expressions over these.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json_text import record_facts
from ..functions.text import is_blank
from ..sources.files import numbered_lines

# The record's form.
REQUIRED = {"task_id": "str", "question": "str", "reward": "dict", "data_source": "str", "repo_name": "str", "extra_info": "dict"}
REWARD = {"ground_truth": "str", "style": "str"}
STYLES = ("rule", "model", "interpreter")
NOT_BLANK = ("task_id", "question", "data_source", "repo_name")


def _kind_errors(cells: Column, wanted: dict[str, str], where: str) -> list[Column]:
    out = []
    for name, kind in wanted.items():
        have = F.try_element_at(cells, F.lit(name))["kind"]
        out.append(F.when(~F.map_contains_key(cells, name), F.lit(f"{where}'{name}' is missing")).when(have != kind, F.concat(F.lit(f"{where}'{name}' should be {kind}, is "), have)))
    return out


def validate(lines: DataFrame, value: str = "value", allow_empty_repo_name: bool = False) -> DataFrame:
    """Lines that are not blank, with ``errors`` and ``warnings`` (arrays of messages)."""
    v = F.col(value)
    df = lines.where(~is_blank(v)).withColumn("_f", record_facts(F.make_valid_utf8(v)))
    f, r = F.col("_f.fields"), F.col("_f.reward")
    text = lambda cells, name: F.try_element_at(cells, F.lit(name))["text"]
    style = text(r, "style")
    names = [n for n in NOT_BLANK if not (allow_empty_repo_name and n == "repo_name")]
    is_reward = F.try_element_at(f, F.lit("reward"))["kind"] == "dict"
    reward = [F.when(is_reward, e) for e in _kind_errors(r, REWARD, "reward.")] + [F.when(~style.isin(*STYLES), F.concat(F.lit("reward.style is none of " + ", ".join(STYLES) + ": "), style))]
    blank = [F.when(is_blank(text(f, n)), F.lit(f"'{n}' is blank")) for n in names] + [F.when(is_blank(text(r, "ground_truth")), F.lit("reward.'ground_truth' is blank"))]
    rules = F.filter(F.array(*_kind_errors(f, REQUIRED, ""), *reward, *blank), lambda x: x.isNotNull())
    errors = F.when(F.col("_f.error").isNotNull(), F.array(F.concat(F.lit("no JSON: "), F.col("_f.error")))).when(F.col("_f.kind") != "dict", F.array(F.concat(F.lit("no object but "), F.col("_f.kind")))).otherwise(rules)
    extra = F.array_sort(F.array_except(F.map_keys(f), F.array(*map(F.lit, REQUIRED))))
    warnings = F.when(F.size(extra) > 0, F.array(F.concat(F.lit("more fields: "), F.array_join(extra, ", ")))).otherwise(F.array().cast("array<string>"))
    return df.withColumns({"errors": errors, "warnings": warnings}).drop("_f")


def summary(validated: DataFrame) -> DataFrame:
    """One row: lines, valid ones, errors, warnings, success rate in percent (0 for no lines), whether all passed (no lines: yes)."""
    n = F.count("*")
    ok = F.count_if(F.size("errors") == 0)
    total = lambda c: F.coalesce(F.sum(F.size(c)), F.lit(0)).cast("long")
    out = validated.agg(n.alias("total_lines"), ok.alias("valid_lines"), total("errors").alias("total_errors"), total("warnings").alias("total_warnings"))
    rate = F.coalesce(F.round(F.try_divide(F.col("valid_lines") * F.lit(100.0), F.col("total_lines")), 1), F.lit(0.0))
    return out.withColumns({"success_rate": rate, "passed": F.col("total_errors") == 0})


def validate_file(spark: SparkSession, path: str, allow_empty_repo_name: bool = False) -> tuple[bool, dict | None]:
    """(passed, totals) of JSON lines in a file or folder; (False, None) where there is none or it is no UTF-8."""
    from pyspark.errors import AnalysisException

    try:
        lines = numbered_lines(spark, path)
    except AnalysisException:
        return False, None
    checked = validate(lines, allow_empty_repo_name=allow_empty_repo_name)
    damaged = F.count_if(~F.is_valid_utf8("value")) > 0
    if lines.agg(damaged).first()[0]:
        return False, None
    totals = summary(checked).first().asDict()
    return totals["passed"], totals
