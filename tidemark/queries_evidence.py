"""Registered queries of the evidence documents: each is stored as text and its fields are read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from tidemark.catalog import register
from tidemark.functions.numeric import rnd
from tidemark.oracle.ctes import r
from tidemark.plans import evidence
from tidemark.plans.pipeline import Pipeline

KEY = ["instrument_id", "trading_date"]


def _document(name: str, rows: Callable[[Pipeline], DataFrame], document: Callable[[], Column], keys: list[str], paths: dict[str, str],
              sql: str, rounded: dict[str, int] | None = None) -> None:
    rounded = rounded or {}

    def run(p: Pipeline) -> DataFrame:
        got = evidence.read(rows(p).withColumn("evidence", evidence.as_json(document())), "evidence", keys, paths)
        return got.withColumns({c: rnd(c, digits) for c, digits in rounded.items()})

    register(name, run, sql)


_SMOOTHED = {"technical_ema20": 4, "technical_ema50": 4, "technical_ema200": 4, "technical_rsi14": 4, "technical_atr14": 4, "technical_volume_z20": 4}
_document("screener_documents", lambda p: p.screened, lambda: evidence.screener_document({"screener": "stock_screener_v1"}), KEY, {
    "symbol": "string", "status": "string", "market.regime": "string", "market.confidence": "double", "market.market_score": "double",
    "sector.integrated_score": "double", "sector.integrated_label": "string", "sector.alignment_label": "string", "sector.ownership_stale": "boolean",
    "technical.close": "double", "technical.ema20": "double", "technical.ema50": "double", "technical.ema200": "double", "technical.rsi14": "double",
    "technical.atr14": "double", "technical.atr_pct": "double", "technical.volume_z20": "double", "technical.volume_available": "boolean",
    "technical.breakout_flag": "boolean", "technical.failed_breakout_flag": "boolean", "technical_components.trend": "double",
    "technical_components.momentum": "double", "technical_components.relative_strength": "double", "technical_components.volume": "double",
    "technical_components.breakout": "double", "liquidity.percentile": "double", "ownership.as_of_date": "date", "ownership.trend_label": "string",
    "ownership.signal_strength": "double", "ownership.age_days": "int", "ownership.stale": "boolean", "ownership.corporate_action_risk": "boolean",
    "weights.sector": "double", "optional_fallbacks.volume_z20": "string", "unused_v1_components": "list", "source_versions.screener": "string"}, f"""
SELECT s.instrument_id, s.trading_date, s.symbol, s.status, market_regime, {r("market_confidence", 6)} AS market_confidence, s.market_score AS market_market_score,
  s.sector_score AS sector_integrated_score, g.integrated_label AS sector_integrated_label, g.alignment_label AS sector_alignment_label,
  s.sector_ownership_stale_flag AS sector_ownership_stale, s.close AS technical_close,
  {", ".join(f"{r(f's.{c}', 4)} AS technical_{c}" for c in ("ema20", "ema50", "ema200", "rsi14", "atr14", "volume_z20"))}, atr_pct AS technical_atr_pct,
  volume_z20 IS NOT NULL AS technical_volume_available, breakout_flag AS technical_breakout_flag, failed_breakout_flag AS technical_failed_breakout_flag,
  {", ".join(f"s.{c}_score AS technical_components_{c}" for c in ("trend", "momentum", "relative_strength", "volume", "breakout"))},
  {r("liquidity_percentile", 6)} AS liquidity_percentile, s.ownership_as_of_date, s.ownership_trend_label, {r("s.ownership_signal_strength", 4)} AS ownership_signal_strength,
  s.ownership_age_days, s.ownership_stale_flag AS ownership_stale, coalesce(t.corporate_action_risk, false) AS ownership_corporate_action_risk, 0.2::DOUBLE AS weights_sector,
  CASE WHEN volume_z20 IS NULL THEN 'NEUTRAL_50' ELSE 'ACTUAL' END AS optional_fallbacks_volume_z20,
  'fundamental|valuation|daily_foreign_flow|catalyst' AS unused_v1_components, 'stock_screener_v1' AS source_versions_screener
FROM screened s JOIN integrated g ON g.trading_date = s.trading_date AND g.sector_code = s.sector_code
LEFT JOIN trends t ON t.instrument_id = s.instrument_id AND t.as_of_date = s.ownership_as_of_date""", _SMOOTHED)

_PLAN = ["entry_low", "entry_high", "entry_mid", "invalidation_price", "stop_price", "target_primary", "expected_rr", "risk_per_share", "risk_pct_price"]
_SIZE = ["position_size_shares", "position_size_lots"]
_MONEY = ["capital_required", "planned_risk_amount"]
_SHAPE = ["extension_atr", "structure_risk_atr", "nearest_resistance"]
_document("setup_documents", lambda p: p.setups, evidence.setup_document, KEY, {
    "screening_input.overall_score": "double", "setup.decision": "string", "setup.decision_reasons": "list", "setup.horizon_days": "int",
    **{f"setup.{c}": "double" for c in _PLAN}, **{f"price_structure.{c}": "double" for c in _SHAPE},
    **{f"position_sizing.{c}": "long" for c in _SIZE}, **{f"position_sizing.{c}": "double" for c in _MONEY},
    "position_sizing.lot_size": "int", "rules.max_price_risk_pct": "double", "rules.minimum_rr": "double", "warnings": "list"}, f"""
SELECT instrument_id, trading_date, overall_score AS screening_input_overall_score, setup_decision, decision_reasons AS setup_decision_reasons,
  CAST(horizon_days AS INTEGER) AS setup_horizon_days, {", ".join(f"{c} AS setup_{c}" for c in _PLAN)}, {", ".join(f"{c} AS price_structure_{c}" for c in _SHAPE)},
  {", ".join(f"{c} AS position_sizing_{c}" for c in _SIZE + _MONEY)}, 100 AS position_sizing_lot_size, 0.1::DOUBLE AS rules_max_price_risk_pct,
  1.5::DOUBLE AS rules_minimum_rr, 'PHASE3H_BUY_SETUP_IS_SCREENING_INPUT_ONLY|YAHOO_EOD_IS_THIRD_PARTY_MARKET_DATA|'
  || 'HISTORICAL_KSEI_AS_OF_DATE_IS_NOT_PUBLICATION_TIME_SAFE|CURRENT_UNIVERSE_HISTORY_IS_SURVIVORSHIP_BIASED|IDX_PRICE_TICK_LADDER_NOT_MODELED_IN_V1|'
  || 'IDX_DAILY_PRICE_LIMITS_NOT_MODELED_IN_V1|POSITION_SIZING_IS_NORMALIZED_NOT_ACCOUNT_SPECIFIC|PROBABILITY_AND_EXPECTED_VALUE_ARE_NOT_CALIBRATED'
  || CASE WHEN setup_decision = 'WATCH' THEN '|WAIT_FOR_PULLBACK_CONFIRMATION' ELSE '' END AS warnings FROM setups""")

_RETURNS = ["realized_return", "realized_r", "mfe", "mae", "mfe_r", "mae_r"]
_document("outcome_documents", lambda p: evidence.outcome_inputs(p.outcomes, p.setups), evidence.outcome_document, ["signal_id"], {
    "source_signal.symbol": "string", "source_signal.signal_date": "date", "entry_model.window_trading_days": "int", "entry_model.entry_low": "double",
    "entry_model.entry_high": "double", "entry_model.fill_method": "string", "entry_model.bars_to_entry": "int", "exit_model.stop_price": "double",
    "exit_model.target_primary": "double", "exit_model.horizon_days": "int", "exit_model.same_bar_rule": "string", "exit_model.sequence_ambiguous": "boolean",
    **{f"returns.{c}": "double" for c in _RETURNS}}, f"""
SELECT o.signal_id, o.symbol AS source_signal_symbol, o.trading_date AS source_signal_signal_date, 5 AS entry_model_window_trading_days,
  s.entry_low AS entry_model_entry_low, s.entry_high AS entry_model_entry_high, o.fill_method AS entry_model_fill_method, o.bars_to_entry AS entry_model_bars_to_entry,
  s.stop_price AS exit_model_stop_price, s.target_primary AS exit_model_target_primary, 10 AS exit_model_horizon_days, 'STOP_FIRST' AS exit_model_same_bar_rule,
  o.sequence_ambiguous AS exit_model_sequence_ambiguous, {", ".join(f"o.{c} AS returns_{c}" for c in _RETURNS)}
FROM outcomes o JOIN signals s ON s.signal_id = o.signal_id""")

_document("execution_documents", lambda p: p.execution, evidence.execution_document, ["signal_id"], {
    "scope": "string", "execution_assumptions.entry_slippage_ticks": "int", "execution_assumptions.target_exit_slippage_ticks": "int",
    "execution_assumptions.sell_infrastructure_fee_rate": "double", "execution_assumptions.broker_commission_included": "boolean",
    "data_quality.point_in_time_safe": "boolean", "data_quality.survivorship_safe": "boolean", "data_quality.corporate_action_history_complete": "boolean",
    "data_quality.corporate_action_overlap_detected": "boolean", "blocking_reasons": "list", "warnings": "list"}, """
SELECT signal_id, 'execution_realism_v1' AS scope, 1 AS execution_assumptions_entry_slippage_ticks, 0 AS execution_assumptions_target_exit_slippage_ticks,
  0.001433::DOUBLE AS execution_assumptions_sell_infrastructure_fee_rate, false AS execution_assumptions_broker_commission_included,
  blocking_reasons NOT LIKE '%POINT_IN_TIME_KSEI_NOT_SAFE%' AS data_quality_point_in_time_safe,
  blocking_reasons NOT LIKE '%CURRENT_UNIVERSE_SURVIVORSHIP_BIAS%' AS data_quality_survivorship_safe, false AS data_quality_corporate_action_history_complete,
  corporate_action_overlap_detected AS data_quality_corporate_action_overlap_detected, blocking_reasons,
  'RESEARCH_EXECUTION_REALISM_LAYER_ONLY|BROKER_SPECIFIC_FEE_NOT_INCLUDED|ORDER_BOOK_AND_INTRADAY_SEQUENCE_NOT_AVAILABLE' AS warnings FROM execution""")
