"""Registry of named jobs, each with the SQL that states the same result for the check on another engine."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidegrain.sources.tables import Tables

JOBS: dict[str, "Job"] = {}
VIEWS: dict[str, str] = {}


@dataclass(frozen=True)
class Job:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, root: str) -> DataFrame:
        return self.build(Tables(spark, root))


def job(name: str, sql: str | None = None):
    """Register ``build(tables)`` under ``name``; ``sql`` may use any view of ``VIEWS``."""

    def register(build):
        if name in JOBS:
            raise ValueError(f"job {name} is registered twice")
        JOBS[name] = Job(name, build, sql)
        return build

    return register


def view(name: str, sql: str) -> None:
    """Register a shared sub-query for the SQL side."""
    VIEWS[name] = sql


def _used(sql: str, done: list[str]) -> list[str]:
    for name in VIEWS:
        if name not in done and re.search(rf"\b{name}\b", sql):
            _used(VIEWS[name], done)
            done.append(name)
    return done


def full_sql(sql: str) -> str:
    """Prefix the shared sub-queries a statement uses."""
    names = _used(sql, [])
    heads = [f"{n} AS ({VIEWS[n]})" for n in names]
    body = sql.strip()
    match = re.match(r"WITH\s+(RECURSIVE\s+)?", body, re.I)
    recursive = bool(match and match.group(1))
    if match:
        rest = body[match.end():]
        joined = ",\n".join([*heads, rest])
    elif heads:
        joined = ",\n".join(heads) + "\n" + body
    else:
        return body
    return ("WITH RECURSIVE " if recursive else "WITH ") + joined


def half_up_sql(expr: str, digits: int = 2) -> str:
    """SQL twin of ``half_up``."""
    e, f = f"CAST({expr} AS DOUBLE)", 10**digits
    return f"(sign({e}) * floor(abs({e}) * {f} + 0.5) / {f})"


def half_even_sql(expr: str, digits: int) -> str:
    """SQL twin of ``half_even``."""
    return f"(round_even(CAST({expr} AS DOUBLE) * {10**digits}.0, 0) / {10**digits}.0)"
