"""Calibration rows, chronological splits and the backtest summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import at_least, mean, profit_factor, reasons, rnd
from tidemark.operators.ordering import medians
from tidemark.session import Workspace

# Readiness thresholds and caveats of the calibration set.
MIN_MATURE, MIN_VALIDATION, MIN_TEST = 200, 50, 50
CALIBRATION_WARNINGS = [
    "RESEARCH_CALIBRATION_DATASET_ONLY", "DO_NOT_PUBLISH_CALIBRATED_PROBABILITY_YET",
    "CURRENT_UNIVERSE_HISTORY_IS_SURVIVORSHIP_BIASED",
    "HISTORICAL_KSEI_AS_OF_DATE_IS_NOT_PUBLICATION_TIME_SAFE",
    "TRANSACTION_COSTS_NOT_MODELED", "INTRADAY_SEQUENCE_NOT_AVAILABLE",
]
SCORES = ["overall_score", "market_score", "sector_score", "technical_score", "liquidity_score",
          "ownership_score", "risk_score", "data_completeness"]


def sample_status() -> Column:
    label = F.col("outcome_label")
    return (
        F.when(label.isin("TARGET", "STOP", "EXPIRED"), "MATURE_TRADE")
        .when(label.isin("NO_FILL", "CANCELLED"), "UNFILLED_COMPLETE")
        .when(label.isin("OPEN", "PENDING"), "UNRESOLVED")
    )


def sample_errors() -> Column:
    """First inconsistency between label, fill flag, completeness and result."""
    label = F.col("outcome_label")
    mature, unfilled = label.isin("TARGET", "STOP", "EXPIRED"), label.isin("NO_FILL", "CANCELLED")
    return (
        F.when(mature & ~F.col("entry_filled"), "terminal trade without entry")
        .when(mature & ~F.col("horizon_complete"), "terminal trade not complete")
        .when(mature & F.col("realized_r").isNull(), "terminal trade without realized_r")
        .when(unfilled & F.col("entry_filled"), "unfilled outcome with entry")
        .when(unfilled & ~F.col("horizon_complete"), "unfilled outcome not complete")
        .when(~mature & ~unfilled & ~label.isin("OPEN", "PENDING"), "unsupported outcome label")
    )


def score_bucket(score: Column) -> Column:
    return at_least(score, [(70.0, "GE_70"), (67.0, "67_TO_70"), (65.0, "65_TO_67")], "LT_65")


def scores_from_evidence(evidence: str) -> list[Column]:
    """Screening scores out of a setup's JSON document, blanks as NULL."""
    text = [F.get_json_object(evidence, f"$.screening_input.{c}") for c in SCORES]
    return [F.nullif(t, F.lit("")).try_cast("double").alias(c) for t, c in zip(text, SCORES)]


def date_splits(dates: DataFrame, date: str) -> DataFrame:
    """70/15/15 by distinct date; one row per trading day, so the list is short.

    The shares are taken in double precision before the floor.
    """
    one = dates.select(date).distinct()
    w = Window.orderBy(date)
    n = F.count(F.lit(1)).over(Window.partitionBy())
    placed = one.withColumns({"_i": F.row_number().over(w) - 1, "_n": n})
    train = F.greatest(F.lit(1), F.least(F.floor(F.col("_n") * F.lit(0.70)), F.col("_n") - 2))
    placed = placed.withColumn("_train", train)
    check = F.greatest(F.lit(1), F.least(F.floor(F.col("_n") * F.lit(0.15)), F.col("_n") - F.col("_train") - 1))
    placed = placed.withColumn("_check", check)
    label = (
        F.when(F.col("_n") == 1, "TRAIN")
        .when((F.col("_n") == 2) & (F.col("_i") == 0), "TRAIN").when(F.col("_n") == 2, "TEST")
        .when(F.col("_i") < F.col("_train"), "TRAIN")
        .when(F.col("_i") < F.col("_train") + F.col("_check"), "VALIDATION").otherwise("TEST")
    )
    return placed.select(date, label.alias("_split"))


def calibration_rows(outcomes: DataFrame, setups: DataFrame, dataset_version: str) -> DataFrame:
    """Outcomes joined to their setups, with sample status and split."""
    signals = setups.filter("setup_decision = 'ACCEPT'").select(
        "instrument_id", "trading_date", F.col("expected_rr").alias("setup_expected_rr"),
        F.col("risk_pct_price").alias("setup_risk_pct"), "horizon_days", *SCORES,
    )
    rows = outcomes.join(signals, ["instrument_id", "trading_date"]).withColumn("_error", sample_errors())
    rows = rows.filter(F.when(F.col("_error").isNull(), F.lit(True)).otherwise(
        F.raise_error(F.col("_error")).cast("boolean")))
    rows = rows.withColumn("sample_status", sample_status())
    mature = F.col("sample_status") == "MATURE_TRADE"
    splits = date_splits(rows.filter(mature), "trading_date")
    return rows.join(splits, "trading_date", "left").select(
        "signal_id", F.lit(dataset_version).alias("dataset_version"), "instrument_id", "symbol",
        F.col("trading_date").alias("signal_date"), "sector_code", "sample_status",
        F.when(mature, F.col("_split")).otherwise("EXCLUDED").alias("split_label"),
        mature.alias("calibration_eligible"), "outcome_label", "entry_filled", "horizon_complete",
        "entry_date", "exit_date", "entry_price", "exit_price", "stop_price",
        "realized_return", "realized_r", "mfe_r", "mae_r", "target_hit", "stop_hit",
        F.when(mature, F.col("target_hit")).alias("tp_before_sl_label"),
        F.when(mature, F.col("realized_r") > 0).alias("positive_r_label"),
        "setup_expected_rr", "setup_risk_pct", "horizon_days", *SCORES,
        score_bucket(F.col("overall_score")).alias("score_bucket"),
        F.array(*[F.lit(w) for w in CALIBRATION_WARNINGS]).alias("warnings"),
    )


def backtest_summary(rows: DataFrame, ws: Workspace, point_in_time_ready: bool = False,
                     costs_modeled: bool = False, intraday_available: bool = False) -> DataFrame:
    """One row of counts, rates, averages, exact median and readiness."""
    mature = F.col("sample_status") == "MATURE_TRADE"
    r = F.when(mature, F.col("realized_r"))

    def split(name: str) -> Column:
        return F.count_if(mature & (F.col("split_label") == name))

    def label(name: str) -> Column:
        return F.count_if(mature & (F.col("outcome_label") == name))

    base = rows.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(mature).alias("mature_trades"),
        F.count_if(F.col("sample_status") == "UNFILLED_COMPLETE").alias("unfilled_complete"),
        F.count_if(F.col("sample_status") == "UNRESOLVED").alias("unresolved"),
        split("TRAIN").alias("train_trades"), split("VALIDATION").alias("validation_trades"),
        split("TEST").alias("test_trades"),
        F.count_if(F.col("entry_filled") | (F.col("sample_status") == "UNFILLED_COMPLETE")).alias("entry_decided"),
        F.count_if("entry_filled").alias("filled_signals"),
        label("TARGET").alias("target_trades"), label("STOP").alias("stop_trades"), label("EXPIRED").alias("expired_trades"),
        F.count_if(r > 0).alias("positive_r_trades"), F.count_if(r < 0).alias("negative_r_trades"),
        F.count_if(r == 0).alias("flat_r_trades"),
        rnd(mean(r), 8).alias("average_r"),
        rnd(mean(F.when(mature, F.col("mfe_r"))), 8).alias("average_mfe_r"),
        rnd(mean(F.when(mature, F.col("mae_r"))), 8).alias("average_mae_r"),
        profit_factor(r).alias("profit_factor"),
    )

    def rate(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, rnd(F.col(part) / F.col(whole), 8))

    ready = reasons(
        (f"MATURE_TRADES_BELOW_{MIN_MATURE}", F.col("mature_trades") < MIN_MATURE),
        (f"VALIDATION_TRADES_BELOW_{MIN_VALIDATION}", F.col("validation_trades") < MIN_VALIDATION),
        (f"TEST_TRADES_BELOW_{MIN_TEST}", F.col("test_trades") < MIN_TEST),
        ("STRICT_POINT_IN_TIME_DATA_NOT_READY", F.lit(not point_in_time_ready)),
        ("TRANSACTION_COSTS_NOT_MODELED", F.lit(not costs_modeled)),
        ("INTRADAY_SEQUENCE_NOT_AVAILABLE", F.lit(not intraday_available)),
    )
    middle = medians(
        rows.filter(mature).select(F.lit(1).alias("_one"), "realized_r"), ws, ["_one"], ["realized_r"]
    )
    return (
        base.withColumn("_one", F.lit(1)).join(middle, "_one", "left").drop("_one")
        .withColumnRenamed("median_realized_r", "median_r")
        .withColumns({
            "fill_rate": rate("filled_signals", "entry_decided"),
            "target_rate": rate("target_trades", "mature_trades"), "stop_rate": rate("stop_trades", "mature_trades"),
            "expired_rate": rate("expired_trades", "mature_trades"), "win_rate": rate("positive_r_trades", "mature_trades"),
            "readiness_reasons": ready,
        })
        .withColumn("calibration_ready", F.size("readiness_reasons") == 0)
    )


def sector_summary(rows: DataFrame) -> DataFrame:
    """Mature trades, mean R and target rate per sector that has any."""
    mature = F.col("sample_status") == "MATURE_TRADE"
    return rows.groupBy("sector_code").agg(
        F.count_if(mature).alias("mature_trades"),
        rnd(mean(F.when(mature, F.col("realized_r"))), 8).alias("average_r"),
        rnd(mean(F.when(mature, F.col("target_hit").cast("double"))), 8).alias("target_rate"),
    ).filter("mature_trades > 0")
