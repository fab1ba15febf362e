"""Evidence documents: for every published row, what it was computed from, under which rules, with which caveats.

A document is a typed struct, so wrong columns fail when the plan is made; ``as_json`` stores it as text without
NULL fields, ``read`` takes paths out of the stored text through one VARIANT per row. All expressions are row-wise:
a document never needs a shuffle, only ``outcome_inputs`` joins by key.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import rnd
from tidemark.plans.execution import BASELINE, BUY_FEE, SELL_FEE
from tidemark.plans.outcomes import ENTRY_WINDOW, outcome_warnings
from tidemark.plans.screener import OVERALL_WEIGHTS, screener_warnings
from tidemark.plans.setups import RULES, SetupRules

# Caveats of every setup and execution row, and parts of the model that are not used.
SETUP_WARNINGS = [
    "PHASE3H_BUY_SETUP_IS_SCREENING_INPUT_ONLY", "YAHOO_EOD_IS_THIRD_PARTY_MARKET_DATA", "HISTORICAL_KSEI_AS_OF_DATE_IS_NOT_PUBLICATION_TIME_SAFE",
    "CURRENT_UNIVERSE_HISTORY_IS_SURVIVORSHIP_BIASED", "IDX_PRICE_TICK_LADDER_NOT_MODELED_IN_V1", "IDX_DAILY_PRICE_LIMITS_NOT_MODELED_IN_V1",
    "POSITION_SIZING_IS_NORMALIZED_NOT_ACCOUNT_SPECIFIC", "PROBABILITY_AND_EXPECTED_VALUE_ARE_NOT_CALIBRATED"]
EXECUTION_WARNINGS = ["RESEARCH_EXECUTION_REALISM_LAYER_ONLY", "BROKER_SPECIFIC_FEE_NOT_INCLUDED", "ORDER_BOOK_AND_INTRADAY_SEQUENCE_NOT_AVAILABLE"]
UNUSED_COMPONENTS = ["fundamental", "valuation", "daily_foreign_flow", "catalyst"]


def _texts(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _constants(values: Mapping[str, object]) -> Column:
    return F.struct(*[F.lit(v).alias(k) for k, v in values.items()])


def _flag(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False)).alias(name)


def _versions(versions: Mapping[str, str] | None) -> list[Column]:
    return [_constants(versions).alias("source_versions")] if versions else []


def screener_document(versions: Mapping[str, str] | None = None) -> Column:
    """Market, sector, technical, liquidity and ownership inputs of a screener row with weights, fallbacks and warnings."""
    volume = F.col("volume_z20").isNotNull()
    return F.struct(
        F.lit("stock_screener_v1").alias("scope"), F.lit("candidate_screening_only").alias("status_semantics"), "symbol", "sector_code", "status",
        F.struct(F.col("market_regime").alias("regime"), rnd("market_confidence", 6).alias("confidence"), "market_score").alias("market"),
        F.struct(F.col("sector_score").alias("integrated_score"), F.col("sector_integrated_label").alias("integrated_label"),
                 F.col("sector_alignment_label").alias("alignment_label"), F.col("sector_ownership_stale_flag").alias("ownership_stale")).alias("sector"),
        F.struct("close", "return_20d", "ema20", "ema50", "ema200", "rsi14", "atr14", "atr_pct", "volume_z20", "rs_ihsg_20d",
                 F.lit(False).alias("rs_sector_available"), F.lit("IHSG_ONLY").alias("relative_strength_source"),
                 volume.alias("volume_available"), _flag("breakout_flag"), _flag("failed_breakout_flag")).alias("technical"),
        F.struct(*[F.col(f"{c}_score").alias(c) for c in ("trend", "momentum", "relative_strength", "volume", "breakout")]).alias("technical_components"),
        F.struct("avg_turnover_20d", rnd("liquidity_percentile", 6).alias("percentile")).alias("liquidity"),
        F.struct(F.col("ownership_as_of_date").alias("as_of_date"), F.col("ownership_trend_label").alias("trend_label"),
                 rnd("ownership_signal_strength", 4).alias("signal_strength"), F.col("ownership_age_days").alias("age_days"),
                 F.col("ownership_stale_flag").alias("stale"),
                 F.coalesce("ownership_corporate_action_risk", F.lit(False)).alias("corporate_action_risk")).alias("ownership"),
        _constants({name.removesuffix("_score"): weight for name, weight in OVERALL_WEIGHTS.items()}).alias("weights"),
        F.struct(F.when(volume, "ACTUAL").otherwise("NEUTRAL_50").alias("volume_z20"), F.lit("IHSG_ONLY").alias("rs_sector_20d")).alias("optional_fallbacks"),
        _texts(UNUSED_COMPONENTS).alias("unused_v1_components"), screener_warnings().alias("warnings"), *_versions(versions))


def setup_document(rules: SetupRules = RULES, versions: Mapping[str, str] | None = None) -> Column:
    """Screening scores, price structure, plan, sizing and rules of a trade setup; a WATCH adds its own warning."""
    scores = ["overall_score", "market_score", "sector_score", "technical_score", "liquidity_score", "ownership_score", "risk_score", "data_completeness"]
    watch = F.array_append(_texts(SETUP_WARNINGS), F.lit("WAIT_FOR_PULLBACK_CONFIRMATION"))
    return F.struct(
        F.lit("trade_setup_v1").alias("scope"), F.lit("deterministic_research_trade_setup").alias("semantics"), "symbol", "sector_code",
        F.struct(*scores).alias("screening_input"),
        F.struct(F.col("setup_close").alias("close"), "ema20", "ema50", "rsi14", "atr14", "prior_low_10d", "prior_high_20d", "prior_high_55d",
                 "prior_count_10d", "extension_atr", "structure_risk_atr", "nearest_resistance").alias("price_structure"),
        F.struct(F.col("setup_decision").alias("decision"), "entry_low", "entry_high", "entry_mid", "invalidation_price", "stop_price", "target_primary",
                 "expected_rr", "risk_per_share", "risk_pct_price", "horizon_days", "decision_reasons").alias("setup"),
        F.struct(F.lit(rules.capital).alias("reference_capital"), F.lit(rules.risk_budget).alias("risk_budget_pct"), F.lit(rules.lot_size).alias("lot_size"),
                 "position_size_shares", "position_size_lots", "capital_required", "planned_risk_amount",
                 F.lit(True).alias("normalization_only")).alias("position_sizing"),
        _constants({
            "entry_pullback_atr": rules.pullback_atr, "stop_buffer_atr": rules.stop_buffer_atr, "max_extension_atr": rules.max_extension_atr,
            "max_structure_risk_atr": rules.max_structure_atr, "max_price_risk_pct": rules.max_risk_pct, "target_rr": rules.target_rr,
            "minimum_rr": rules.minimum_rr}).alias("rules"),
        F.when(F.col("setup_decision") == "WATCH", watch).otherwise(_texts(SETUP_WARNINGS)).alias("warnings"), *_versions(versions))


def outcome_inputs(outcomes: DataFrame, setups: DataFrame) -> DataFrame:
    """Outcomes with the entry zone, target and horizon of their setups, joined by (instrument, date)."""
    plan = ["entry_low", "entry_high", "target_primary", "horizon_days"]
    return outcomes.join(setups.select("instrument_id", "trading_date", *plan), ["instrument_id", "trading_date"], "left")


def outcome_document(versions: Mapping[str, str] | None = None) -> Column:
    """Signal, entry, exit and returns of an outcome from ``outcome_inputs``."""
    return F.struct(
        F.lit("signal_outcome_v1").alias("scope"),
        F.struct("signal_id", "symbol", "sector_code", F.col("trading_date").alias("signal_date")).alias("source_signal"),
        F.struct(F.lit(ENTRY_WINDOW).alias("window_trading_days"), "entry_low", "entry_high", "fill_method", "bars_to_entry").alias("entry_model"),
        F.struct("stop_price", "target_primary", "horizon_days", F.lit("STOP_FIRST").alias("same_bar_rule"), "sequence_ambiguous").alias("exit_model"),
        F.struct(F.lit("mark_to_market_close_return_n_sessions_after_entry").alias("semantics"),
                 "realized_return", "realized_r", "mfe", "mae", "mfe_r", "mae_r").alias("returns"),
        outcome_warnings().alias("warnings"), *_versions(versions))


def calibration_document(versions: Mapping[str, str] | None = None) -> Column:
    """Status, labels, split and caveats of a calibration row."""
    return F.struct(
        F.lit("backtest_calibration_v1").alias("scope"), "sample_status",
        F.struct("outcome_label", "tp_before_sl_label", "positive_r_label").alias("labels"),
        F.struct(F.col("split_label").alias("label"), F.lit(True).alias("chronological"), F.lit(True).alias("same_signal_date_grouped")).alias("split"),
        "warnings", *_versions(versions))


def execution_document(actions_complete: bool = False, commission_included: bool = False, auto_rejection_modeled: bool = False,
                       versions: Mapping[str, str] | None = None) -> Column:
    """Cost assumptions, data quality and blocking reasons of an execution row."""
    return F.struct(
        F.lit("execution_realism_v1").alias("scope"),
        _constants({
            "price_fraction": "IDX regular/cash market fraction ladder", "fraction_reference": "previous_close for the execution day",
            "entry_slippage_ticks": BASELINE.entry_ticks, "target_exit_slippage_ticks": BASELINE.target_ticks,
            "stop_exit_slippage_ticks": BASELINE.stop_ticks, "expired_exit_slippage_ticks": BASELINE.expired_ticks,
            "buy_infrastructure_fee_rate": BUY_FEE, "sell_infrastructure_fee_rate": SELL_FEE,
            "broker_commission_included": commission_included}).alias("execution_assumptions"),
        F.struct("point_in_time_safe", "survivorship_safe", F.lit(actions_complete).alias("corporate_action_history_complete"),
                 _flag("corporate_action_overlap_detected"),
                 F.lit(auto_rejection_modeled).alias("board_specific_auto_rejection_modeled")).alias("data_quality"),
        "blocking_reasons", _texts(EXECUTION_WARNINGS).alias("warnings"), *_versions(versions))


def as_json(document: Column) -> Column:
    return F.to_json(document)


def read(rows: DataFrame, document: str, keys: list[str], paths: Mapping[str, str]) -> DataFrame:
    """``keys`` and one typed column per path of a stored document; ``paths`` maps a path to its type.

    The text is parsed once per row. A column is named by its path with underscores. Absent paths, values of another
    type and unreadable documents give NULL; lists of texts come joined by ``|``.
    """
    parsed = rows.withColumn("_v", F.try_parse_json(document))
    out = []
    for path, kind in paths.items():
        name = path.replace(".", "_")
        if kind == "list":
            out.append(F.array_join(F.try_variant_get("_v", f"$.{path}", "array<string>"), "|").alias(name))
        else:
            out.append(F.try_variant_get("_v", f"$.{path}", kind).alias(name))
    return parsed.select(*keys, *out)
