"""Builds with a stored state: decide the mode, write aside, pass the gates, publish."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.incremental import Policy, build_mode, coverage_gate, lineage_gate
from tidemark.sources.versions import Published


@dataclass(frozen=True)
class Result:
    mode: str
    version: int
    published: bool


def build_state(table: Published, keys: DataFrame, model_version: str, time: str, updated: str, force: bool = False) -> DataFrame:
    """One row with what ``build_mode`` asks for, from the stored manifest row, the stored rows and the input's keys and times.

    ``input_at`` is the newest input time of the dates already processed, so a late correction of an old date shows.
    """
    row = table.current()
    through = row["processed_through"] if row else None
    stored = F.lit(through).cast("date")
    old = F.col(time) <= stored
    found = keys.agg(
        F.max(time).alias("input_last"), F.count(F.lit(1)).alias("expected_rows"), F.max(F.when(old, F.col(updated))).alias("input_at"))
    counted = table.read(row).agg(F.count(F.lit(1)).alias("stored_rows")) if row else found.select(F.lit(0).cast("long").alias("stored_rows"))
    facts = {
        "force": F.lit(force), "state_exists": F.lit(row is not None),
        "model_matches": F.lit(bool(row) and row["model_version"] == model_version), "stored_last": stored,
        "state_rows": F.lit(row["rows"] if row else None).cast("long"), "stored_at": F.lit(row["input_updated_at"] if row else None).cast("timestamp"),
    }
    return found.join(counted, how="cross").withColumns(facts)


def run_build(table: Published, policy: Policy, keys: DataFrame, model_version: str, full: Callable[[], DataFrame],
              fresh: Callable[[date], DataFrame] | None = None, time: str = "trading_date", updated: str = "updated_at",
              lineage: tuple[DataFrame, ...] = (), force: bool = False) -> Result:
    """Bring a published table up to its input.

    ``keys`` holds a row with ``time`` and ``updated`` for every row the table shall have; ``full`` makes all rows, ``fresh`` those after a date.
    Rows are written aside, then checked: as many rows as ``keys`` and up to its last date, and one universe date among
    the models of ``lineage``. Only then does the manifest switch. A failing gate raises and leaves the old version readable.
    """
    row = table.current()
    state = build_state(table, keys, model_version, time, updated, force)
    decided = state.select(build_mode(policy).alias("mode"), "input_last", "expected_rows").first()
    mode = decided["mode"]
    if mode == "UP_TO_DATE":
        return Result(mode, row["version"], False)
    lineage_gate(*lineage) if lineage else None
    step = mode == "INCREMENTAL" and fresh is not None
    segment = table.stage(fresh(row["processed_through"]) if step else full())
    segments = [*row["segments"], segment] if step else [segment]
    written = table.spark.read.parquet(*segments)
    coverage_gate(written, time, decided["expected_rows"], decided["input_last"])
    newest = keys.agg(F.max(updated).alias("at")).first()["at"]
    out = table.publish(segments, mode, model_version, decided["input_last"], decided["expected_rows"], newest, row)
    return Result(mode, out["version"], True)
