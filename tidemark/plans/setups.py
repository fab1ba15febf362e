"""Trade setups: entry zone, structural stop, target, gates and sizing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import newest_input, when_updated
from tidemark.functions.numeric import reasons, rnd
from tidemark.operators.windows import prior, series, trailing


@dataclass(frozen=True)
class SetupRules:
    """Fixed values of the setup model."""

    capital: float = 100_000_000.0
    risk_budget: float = 0.01
    lot_size: int = 100
    pullback_atr: float = 0.50
    extended_low_atr: float = 1.00
    extended_high_atr: float = 0.50
    stop_buffer_atr: float = 0.25
    max_extension_atr: float = 2.00
    max_structure_atr: float = 2.50
    max_risk_pct: float = 0.10
    target_rr: float = 2.00
    minimum_rr: float = 1.50
    horizon_days: int = 10


RULES = SetupRules()


def price_structure(bars: DataFrame, first: Column, last: Column) -> DataFrame:
    """Prior lows and highs over bars from 90 days before the first screened date."""
    w = series()
    sliced = bars.filter(F.col("trading_date").between(F.date_sub(first, 90), last))
    return sliced.select(
        "instrument_id", "trading_date", F.col("close").alias("setup_close"),
        F.min("low").over(prior(w, 10)).alias("prior_low_10d"),
        F.max("high").over(prior(w, 20)).alias("prior_high_20d"),
        F.max("high").over(prior(w, 55)).alias("prior_high_55d"),
        F.count("low").over(prior(w, 10)).alias("prior_count_10d"),
        *([F.max("ingested_at").over(trailing(w, 56)).alias("price_updated_at")] if when_updated(bars, column="ingested_at") else []),
    )


def entry_zone(rules: SetupRules = RULES) -> dict[str, Column]:
    close, ema, atr = F.col("setup_close"), F.col("ema20"), F.col("atr14")
    far = (close - ema) / atr > rules.max_extension_atr
    low = F.greatest(ema, F.when(far, close - rules.extended_low_atr * atr).otherwise(close - rules.pullback_atr * atr))
    high = F.greatest(F.when(far, close - rules.extended_high_atr * atr).otherwise(close), low)
    return {
        "entry_low": rnd(low, 6), "entry_high": rnd(high, 6), "entry_mid": rnd((low + high) / 2.0, 6),
        "extension_atr": (close - ema) / atr,
    }


def nearest_resistance() -> Column:
    above = [F.when(F.col(c) > F.col("setup_close"), F.col(c)) for c in ("prior_high_20d", "prior_high_55d")]
    return rnd(F.least(*above), 6)


def position_lots(rules: SetupRules = RULES) -> Column:
    by_risk = F.floor(F.lit(rules.capital * rules.risk_budget) / (F.col("risk_per_share") * rules.lot_size))
    by_cash = F.floor(F.lit(rules.capital) / (F.col("entry_mid") * rules.lot_size))
    return F.greatest(F.lit(0), F.least(by_risk, by_cash)).cast("long")


def trade_setups(candidates: DataFrame, model_version: str, rules: SetupRules = RULES) -> DataFrame:
    """Setup of each candidate row; rows with missing or invalid inputs are bare REJECTs."""
    close, ema, atr = F.col("setup_close"), F.col("ema20"), F.col("atr14")
    low, count = F.col("prior_low_10d"), F.col("prior_count_10d")
    missing = reasons(
        ("MISSING_CLOSE", close.isNull()), ("MISSING_EMA20", ema.isNull()), ("MISSING_ATR14", atr.isNull()),
        ("MISSING_PRIOR_LOW_10D", low.isNull()), ("MISSING_PRIOR_HISTORY_COUNT", count.isNull()),
    )
    invalid = reasons(
        ("INVALID_CLOSE", close <= 0), ("INVALID_EMA20", ema <= 0), ("INVALID_ATR14", atr <= 0),
        ("INVALID_PRIOR_LOW_10D", low <= 0), ("INSUFFICIENT_PRIOR_HISTORY", count < 10),
    )
    df = candidates.withColumn("_missing", missing).withColumn(
        "_early", F.when(F.size("_missing") > 0, F.col("_missing")).otherwise(invalid)
    ).withColumn("_ok", F.size("_early") == 0)

    def live(c) -> Column:
        return F.when(F.col("_ok"), c)

    df = df.withColumns({k: live(v) for k, v in entry_zone(rules).items()})
    df = df.withColumns({
        "invalidation_price": live(rnd(low, 6)),
        "stop_price": live(rnd(low - rules.stop_buffer_atr * atr, 6)),
        "nearest_resistance": live(nearest_resistance()),
    })
    risk = F.col("entry_mid") - F.col("stop_price")
    df = df.withColumn("_risky", risk > 0).withColumn("risk_per_share", F.when(risk > 0, rnd(risk, 6)))
    df = df.withColumns({
        "_risk_pct": F.col("risk_per_share") / F.col("entry_mid"),
        "_structure": F.col("risk_per_share") / atr,
        "target_primary": rnd(F.when(F.col("_risky"), F.least(
            F.col("entry_mid") + rules.target_rr * F.col("risk_per_share"), F.col("nearest_resistance"))), 6),
        "_lots": F.when(F.col("_risky"), position_lots(rules)),
    })
    reachable = F.col("target_primary") > F.col("entry_high")
    df = df.withColumn("_rr", F.when(
        reachable, (F.col("target_primary") - F.col("entry_mid")) / F.col("risk_per_share")
    ))
    gates = reasons(
        ("CLOSE_NOT_ABOVE_EMA20", close <= ema),
        ("INVALID_STOP_PRICE", F.col("stop_price") <= 0),
        ("STOP_NOT_BELOW_ENTRY_ZONE", F.col("stop_price") >= F.col("entry_low")),
        ("NON_POSITIVE_RISK_PER_SHARE", ~F.col("_risky")),
        ("STRUCTURE_STOP_TOO_WIDE_ATR", F.col("_structure") > rules.max_structure_atr),
        ("STRUCTURE_STOP_TOO_WIDE_PCT", F.col("_risk_pct") > rules.max_risk_pct),
        ("TARGET_NOT_ABOVE_ENTRY_ZONE", ~reachable),
        ("INSUFFICIENT_REWARD_RISK", F.col("_rr") < rules.minimum_rr),
        ("REFERENCE_CAPITAL_CANNOT_SIZE_ONE_LOT", F.col("_lots") < 1),
    )
    df = df.withColumn("_extended", F.col("_ok") & (rnd("extension_atr", 6) > rules.max_extension_atr))
    df = df.withColumn("_gates", F.when(F.col("_ok"), gates).otherwise(F.col("_early")))
    df = df.withColumn("setup_decision", F.when(F.size("_gates") > 0, "REJECT")
                       .when(F.col("_extended"), "WATCH").otherwise("ACCEPT"))
    decision = F.col("setup_decision")
    listed = F.when(decision == "WATCH", F.array(F.lit("PRICE_EXTENDED_FROM_EMA20"))).otherwise(F.col("_gates"))
    shares = F.col("_lots") * rules.lot_size
    return df.withColumns({
        "decision_reasons": listed,
        "status": F.when(decision == "REJECT", "AVOID").when(decision == "WATCH", "WATCH").otherwise("BUY_SETUP"),
        "expected_rr": rnd("_rr", 6),
        "risk_pct_price": rnd("_risk_pct", 8),
        "structure_risk_atr": rnd("_structure", 6),
        "extension_atr": rnd("extension_atr", 6),
        "position_size_lots": F.col("_lots"),
        "position_size_shares": shares,
        "capital_required": rnd(shares * F.col("entry_mid"), 2),
        "planned_risk_amount": rnd(shares * F.col("risk_per_share"), 2),
        "horizon_days": F.lit(rules.horizon_days),
        "model_version": F.lit(model_version),
    }).drop("_missing", "_early", "_ok", "_risky", "_risk_pct", "_structure", "_lots", "_rr", "_extended", "_gates")


def setup_candidates(screened: DataFrame, features: DataFrame, bars: DataFrame) -> DataFrame:
    """BUY_SETUP rows with the price structure of their date."""
    span = screened.agg(F.min("trading_date").alias("a"), F.max("trading_date").alias("b"))
    structure = price_structure(bars, span.select("a").scalar(), span.select("b").scalar())
    chosen = screened.filter("status = 'BUY_SETUP'").select(
        "instrument_id", "symbol", "sector_code", "trading_date", "overall_score", "market_score",
        "sector_score", "technical_score", "liquidity_score", "ownership_score", "risk_score", "data_completeness",
        *(["input_updated_at"] if when_updated(screened, column="input_updated_at") else []),
    )
    return candidate_inputs(chosen, features, structure)


def candidate_inputs(chosen: DataFrame, features: DataFrame, structure: DataFrame) -> DataFrame:
    """Chosen rows with averages and price structure; ``input_updated_at`` takes in theirs, where all carry one."""
    keys, averages = ["instrument_id", "trading_date"], ["ema20", "ema50", "rsi14", "atr14"]
    timed = when_updated(chosen, column="input_updated_at") and when_updated(features) and when_updated(structure, column="price_updated_at")
    wanted = features.select(*keys, *averages, *([F.col("updated_at").alias("_feature_updated")] if timed else []))
    out = chosen.join(wanted, keys, "left").join(structure, keys, "left")
    if not timed:
        return out
    newest = newest_input(["input_updated_at"], ["_feature_updated", "price_updated_at"])
    return out.withColumn("input_updated_at", newest).drop("_feature_updated", "price_updated_at")


def setup_thesis() -> Column:
    """The decision with its reason codes; a rejection without any says so."""
    missing = F.when(F.col("setup_decision") == "ACCEPT", "ALL_GATES_PASSED").otherwise("UNSPECIFIED_REJECTION")
    listed = F.when(F.size("decision_reasons") > 0, F.array_join("decision_reasons", ", ")).otherwise(missing)
    return F.concat("setup_decision", F.lit(": "), listed)
