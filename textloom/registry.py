"""Registries of tasks (settings in, DataFrame out) and of scorers, by name."""

from __future__ import annotations

import importlib
import json
import pkgutil
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import functions as F

FORWARDS: dict[str, Callable] = {}
SCORERS: dict[str, Callable] = {}


def _names(name: str | Iterable[str]) -> list[str]:
    names = [name] if isinstance(name, str) else list(name)
    if not names or not all(isinstance(n, str) for n in names):
        raise ValueError("a name, or names, are needed")
    return names


def _register(table: dict[str, Callable], name: str | Iterable[str]) -> Callable[[Callable], Callable]:
    names = _names(name)

    def add(f: Callable) -> Callable:
        table.update(dict.fromkeys(names, f))
        return f

    return add


def register_forward(name: str | Iterable[str]):
    """A task: ``f(spark, settings) -> DataFrame | None``. The last one of a name counts."""
    return _register(FORWARDS, name)


def discover(package: str) -> list[str]:
    """Imports a package and all modules below it, so that what they register is known; returns their names."""
    top = importlib.import_module(package)
    below = sorted(m.name for m in pkgutil.walk_packages(getattr(top, "__path__", []), f"{package}."))
    for name in below:
        importlib.import_module(name)
    return [package, *below]


def register_reward_score(name: str | Iterable[str]):
    """A scorer: ``f(solution_str, ground_truth, extra_info) -> {"score": float, "extra_info": dict}``."""
    return _register(SCORERS, name)


def scorer_column(name: str):
    """A registered scorer as a function of columns: struct<score, extra_info (JSON text)>, a batch at a time."""
    f = SCORERS[name]

    @F.pandas_udf("score double, extra_info string")
    def run(solution: pd.Series, truth: pd.Series, extra: pd.Series) -> pd.DataFrame:
        rows = [f(*x) for x in zip(solution, truth, extra, strict=True)]
        return pd.DataFrame([(float(r["score"]), json.dumps(r.get("extra_info", {}), ensure_ascii=False)) for r in rows], columns=["score", "extra_info"])

    return run
