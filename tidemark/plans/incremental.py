"""Build modes, bounded history slices and incremental rebuilds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import universe_date
from tidemark.operators.windows import bounded_history
from tidemark.plans import breadth, screener
from tidemark.session import Workspace


@dataclass(frozen=True)
class Policy:
    """Which checks a dataset's rebuild decision uses.

    ``counts`` compares the latest group's size, ``signature`` and ``updated``
    the upstream fingerprint and timestamp, ``state`` the build-state row, and
    ``refresh`` rewrites in full whenever anything moved.
    """

    counts: bool = False
    signature: bool = False
    updated: bool = False
    state: bool = False
    refresh: bool = False


MARKET_BREADTH = Policy()
SECTOR_ROTATION = OWNERSHIP_TREND = SECTOR_OWNERSHIP = Policy(counts=True)
INTEGRATED_SECTOR = Policy(counts=True, signature=True)
STOCK_SCREENER = Policy(counts=True, updated=True)
TRADE_SETUP = Policy(state=True)
SIGNAL_OUTCOME = CALIBRATION = EXECUTION = Policy(state=True, refresh=True)


def build_mode(policy: Policy, ahead_is_error: bool = True) -> Column:
    """FULL, INCREMENTAL, REFRESH or UP_TO_DATE from a one-row state.

    Columns: force, stored_rows, stored_last, input_last, and as the policy
    needs them stored_count/expected_count, stored_signature/input_signature,
    stored_at/input_at, state_exists/model_matches/state_rows/expected_rows.
    A stored date after the input date is an error.
    """
    stored, wanted = F.col("stored_last"), F.col("input_last")
    same_time = F.col("stored_at").eqNullSafe(F.col("input_at")) if policy.updated or policy.state else F.lit(True)
    ahead = F.raise_error(F.lit("stored data is ahead of its input")) if ahead_is_error else F.lit("AHEAD")
    out = F.when(F.col("force"), "FULL")
    if policy.state:
        out = out.when(~F.col("state_exists"), "FULL").when(~F.col("model_matches"), "FULL")
        if policy.refresh:
            out = out.when(F.col("stored_rows") != F.col("expected_rows"), "FULL")
        out = out.when(stored.isNull(), "FULL").when(stored > wanted, ahead)
        if policy.refresh:
            return out.when((stored == wanted) & same_time, "UP_TO_DATE").otherwise("REFRESH")
        out = out.when(F.col("stored_rows") != F.col("state_rows"), "FULL")
        out = out.when((stored == wanted) & (F.col("stored_rows") != F.col("expected_rows")), "FULL").when(~same_time, "FULL")
        return out.when(stored == wanted, "UP_TO_DATE").otherwise("INCREMENTAL")
    if policy == MARKET_BREADTH:
        out = out.when(F.col("stored_rows") <= 0, "FULL").when(
            stored.isNull(), F.raise_error(F.lit("rows exist but the last date is NULL")) if ahead_is_error else F.lit("INCONSISTENT"))
    out = out.when(stored.isNull(), "FULL").when(stored > wanted, ahead)
    if policy.counts:
        out = out.when(F.col("stored_count") != F.col("expected_count"), "FULL")
    if policy.signature:
        out = out.when(~F.col("stored_signature").eqNullSafe(F.col("input_signature")), "FULL")
    if policy.updated:
        out = out.when(~same_time, "FULL")
    return out.when(stored == wanted, "UP_TO_DATE").otherwise("INCREMENTAL")


def breadth_after(bars: DataFrame, features: DataFrame, after: Column, universe_code: str) -> DataFrame:
    """Breadth rows after a date from stored features and a bounded bar slice."""
    ranges = [f"prior_{n}_{s}" for n in (20, 252) for s in ("count", "high", "low")]
    sliced = breadth.prior_close_range(bounded_history(bars, after, 252)).filter(F.col("trading_date") > after)
    fresh = features.drop(*ranges).filter(F.col("trading_date") > after).join(
        sliced.select("instrument_id", "trading_date", *ranges), ["instrument_id", "trading_date"])
    return breadth.market_breadth(fresh, universe_code)


def rotation_after(features: DataFrame, index_features: DataFrame, stored: DataFrame, after: Column,
                   model_version: str) -> DataFrame:
    """Rotation rows after a date, the score change seeded from stored scores."""
    history = breadth.prior_score_history(stored, after)
    return breadth.sector_rotation(
        features.filter(F.col("trading_date") > after), index_features.filter(F.col("trading_date") > after), model_version, history)


def screener_after(features: DataFrame, bars: DataFrame, sectors: DataFrame, regimes: DataFrame, trends: DataFrame,
                   after: Column, model_version: str, ws: Workspace) -> DataFrame:
    """Screener rows after a date: bounded inputs, scored and ranked within the new dates only."""
    inputs = screener.screener_inputs_after(features, bars, sectors, regimes, trends, after, ws)
    return screener.ranked(screener.screener_scores(inputs, model_version), ws)


def coverage_gate(df: DataFrame, date: str, expected_rows: int, expected_last) -> None:
    """Raise unless the result has the expected size and last date."""
    found = df.agg(F.count(F.lit(1)).alias("n"), F.max(date).alias("d")).first()
    if found["n"] != expected_rows or found["d"] != expected_last:
        raise ValueError(f"coverage mismatch: {found['n']} rows to {found['d']}, expected {expected_rows} to {expected_last}")


def lineage_versions(*tables: DataFrame) -> DataFrame:
    """Distinct model versions of several inputs with the universe date inside each."""
    out = None
    for t in tables:
        one = t.select("model_version").distinct()
        out = one if out is None else out.unionByName(one)
    return out.distinct().withColumn("universe_date", universe_date("model_version"))


def lineage_gate(*tables: DataFrame) -> None:
    """Raise unless all inputs were built for the same universe date."""
    rows = lineage_versions(*tables).agg(
        F.count_distinct("universe_date").alias("n"), F.count_if(F.col("universe_date").isNull()).alias("undated")).first()
    if rows["n"] != 1 or rows["undated"]:
        raise ValueError(f"inputs carry {rows['n']} universe dates and {rows['undated']} versions without one")
