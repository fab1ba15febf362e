"""Named queries: the Spark transform and, where SQL can say it, its check."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.oracle.ctes import build
from tidemark.plans.pipeline import Pipeline


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[Pipeline], DataFrame]
    sql: str | None = None


QUERIES: dict[str, Query] = {}
_PIPELINES: dict[tuple[str, str], Pipeline] = {}


def pipeline(spark: SparkSession, folder: str) -> Pipeline:
    """One pipeline per application and folder, so its written stages are shared."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _PIPELINES:
        _PIPELINES[key] = Pipeline(spark, folder)
    return _PIPELINES[key]


def register(name: str, run: Callable[[Pipeline], DataFrame], sql: str | None = None,
             extra: dict[str, str] | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} is already registered")
    QUERIES[name] = Query(name, run, build(sql, extra) if sql else None)


def stage(name: str, run: Callable[[Pipeline], DataFrame], cte: str, columns: list[str],
          rounded: dict[str, int] | None = None) -> None:
    """Register columns of a pipeline stage against the SQL of the same stage."""
    from pyspark.sql import functions as F

    from tidemark.functions.numeric import rnd
    from tidemark.oracle.ctes import r

    rounded = rounded or {}

    def select(p: Pipeline) -> DataFrame:
        return run(p).select(*[rnd(c, rounded[c]).alias(c) if c in rounded else F.col(c) for c in columns])

    listed = ", ".join(f"{r(c, rounded[c])} AS {c}" if c in rounded else c for c in columns)
    register(name, select, f"SELECT {listed} FROM {cte}")
