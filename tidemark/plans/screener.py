"""Stock screener: component scores, status and ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import newest_input, when_updated
from tidemark.functions.numeric import clamp, piecewise, rnd, with_rounded
from tidemark.operators.joins import asof_backward
from tidemark.operators.ordering import percent_rank, positions
from tidemark.operators.windows import bounded_history, series, trailing
from tidemark.plans.ownership import STALE_DAYS
from tidemark.session import Workspace

# Base score of each market regime.
REGIME_BASE = {
    "STRONG_BULL": 90.0, "BULL": 80.0, "SIDEWAYS_BULL": 65.0, "SIDEWAYS": 50.0,
    "SIDEWAYS_BEAR": 40.0, "BEAR": 30.0, "STRONG_BEAR": 15.0,
}
# Knots of the momentum and risk curves.
MOMENTUM_KNOTS = [(30.0, 20.0), (40.0, 50.0), (50.0, 70.0), (65.0, 100.0), (75.0, 80.0), (85.0, 50.0), (100.0, 20.0)]
RISK_KNOTS = [(1.0, 95.0), (2.5, 85.0), (4.0, 70.0), (6.0, 50.0), (8.0, 30.0), (12.0, 10.0)]
# Columns a bar needs to be screened.
REQUIRED = [
    "return_20d", "ema20", "ema50", "ema200", "rsi14", "atr14", "rs_ihsg_20d",
    "breakout_flag", "failed_breakout_flag", "avg_turnover_20d",
]
# Component weights of the overall score.
OVERALL_WEIGHTS = {
    "market_score": 0.15, "sector_score": 0.20, "technical_score": 0.35,
    "liquidity_score": 0.10, "ownership_score": 0.10, "risk_score": 0.10,
}


def market_score(regime: Column, confidence: Column) -> Column:
    base = F.lit(None).cast("double")
    for name, value in REGIME_BASE.items():
        base = F.when(regime == name, F.lit(value)).otherwise(base)
    return clamp(F.lit(50.0) + (base - 50.0) * F.coalesce(clamp(confidence, 0.0, 1.0), F.lit(0.0)))


def trend_score() -> Column:
    tests = [
        F.col("close") > F.col("ema20"), F.col("ema20") > F.col("ema50"),
        F.col("ema50") > F.col("ema200"), F.col("return_20d") > 0,
    ]
    points = [F.when(t, F.lit(25.0)).otherwise(F.lit(0.0)) for t in tests]
    return points[0] + points[1] + points[2] + points[3]


def strength_score(index: Column, sector: Column) -> Column:
    one = clamp(F.lit(50.0) + index / 0.20 * 50.0)
    two = clamp(F.lit(50.0) + sector / 0.20 * 50.0)
    return F.when(sector.isNull(), one).otherwise((one + two) / 2.0)


def breakout_score() -> Column:
    return F.when(F.col("failed_breakout_flag"), 0.0).when(F.col("breakout_flag"), 100.0).otherwise(50.0)


def ownership_score() -> Column:
    strength = clamp("ownership_signal_strength") * 0.50
    label = F.col("ownership_trend_label")
    moved = F.when(label == "ACCUMULATING", F.lit(50.0) + strength).when(
        label == "DISTRIBUTING", F.lit(50.0) - strength
    ).otherwise(F.lit(50.0))
    return F.when(
        ~F.col("_owned") | F.col("ownership_stale_flag"), F.lit(50.0)
    ).otherwise(clamp(moved))


def screening_status() -> Column:
    score = {c: F.col(f"{c}_score") for c in ("overall", "market", "sector", "technical", "liquidity", "risk")}

    def reaches(**floors: float) -> Column:
        test = F.lit(True)
        for name, floor in floors.items():
            test = test & (score[name] >= floor)
        return test

    avoid = (
        F.col("failed_breakout_flag") | (score["risk"] < 20) | (score["liquidity"] < 5)
        | (score["sector"] < 30) | (score["market"] < 25)
    )
    trigger = F.col("breakout_flag") | (
        (F.col("rs_ihsg_20d") >= 0.03) & F.col("rsi14").between(50, 75) & (F.col("close") > F.col("ema20"))
    )
    return (
        F.when(avoid, "AVOID")
        .when(reaches(overall=65, market=40, sector=55, technical=65, liquidity=25, risk=35) & trigger, "BUY_SETUP")
        .when(reaches(overall=55, market=35, sector=45, technical=55, liquidity=20, risk=30), "WATCH")
        .when(reaches(overall=45, technical=40), "WAIT")
        .otherwise("AVOID")
    )


def turnover_window(bars: DataFrame, first: Column, last: Column, minimum_rows: int = 1) -> DataFrame:
    """20-row mean of close x volume over bars from 45 days before the first scored date.

    The slice start is part of the definition: near it the mean covers fewer rows.
    """
    sliced = bars.filter(
        (F.col("close") > 0) & F.col("volume").isNotNull()
        & F.col("trading_date").between(F.date_sub(first, 45), last)
    )
    frame = trailing(series(), 20)
    mean = F.avg(F.col("close") * F.col("volume")).over(frame)
    times = [F.max("ingested_at").over(frame).alias("turnover_updated_at")] if when_updated(bars, column="ingested_at") else []
    return sliced.select(
        "instrument_id", "trading_date",
        F.when(F.count(F.lit(1)).over(frame) >= minimum_rows, mean).alias("avg_turnover_20d"), *times,
    )


def screener_inputs(features: DataFrame, bars: DataFrame, sectors: DataFrame,
                    regimes: DataFrame, trends: DataFrame, ws: Workspace) -> DataFrame:
    """Everything a screened row needs, with the turnover percentile of its date.

    ``features`` carries symbol and sector of the current universe.
    """
    span = sectors.agg(F.min("trading_date").alias("a"), F.max("trading_date").alias("b"))
    window = turnover_window(bars, span.select("a").scalar(), span.select("b").scalar())
    return joined_inputs(features, window, sectors, regimes, trends, ws)


def screener_inputs_after(features: DataFrame, bars: DataFrame, sectors: DataFrame, regimes: DataFrame,
                          trends: DataFrame, after: Column, ws: Workspace) -> DataFrame:
    """The same rows for dates after ``after`` only, from bounded slices of the stored tables.

    Older rows are read only as carried-in state: the 19 turnover bars and the one ownership trend of each
    instrument that reach over the cut. Percentiles are within a date, so new dates need no older ones.
    """
    first = sectors.agg(F.min("trading_date").alias("a")).select("a").scalar()
    last = sectors.agg(F.max("trading_date").alias("b")).select("b").scalar()
    usable = bars.filter((F.col("close") > 0) & F.col("volume").isNotNull() & (F.col("trading_date") >= F.date_sub(first, 45)))
    window = turnover_window(bounded_history(usable, after, 19), first, last).filter(F.col("trading_date") > after)

    def fresh(df: DataFrame) -> DataFrame:
        return df.filter(F.col("trading_date") > after)

    carried = bounded_history(trends, after, 1, date="as_of_date")
    return joined_inputs(fresh(features), window, fresh(sectors), fresh(regimes), carried, ws)


def joined_inputs(features: DataFrame, window: DataFrame, sectors: DataFrame, regimes: DataFrame,
                  trends: DataFrame, ws: Workspace) -> DataFrame:
    """Features with turnover, sector view, regime and the latest ownership trend; ``input_updated_at`` is the newest of them.

    What is joined by key is narrow and, in one bucket, small: it is hashed, so the wide rows are not sorted for it.
    """
    timed = when_updated(features, sectors, regimes, trends) and when_updated(window, column="turnover_updated_at")

    def time(name: str) -> list[Column]:
        return [F.col("updated_at").alias(name)] if timed else []

    base = (
        features.filter("sector_code is not null")
        .join(window.hint("shuffle_hash"), ["instrument_id", "trading_date"])
        .join(sectors.select(
            "trading_date", "sector_code", F.col("integrated_score").alias("sector_input_score"),
            F.col("integrated_label").alias("sector_integrated_label"),
            F.col("alignment_label").alias("sector_alignment_label"),
            F.col("ownership_stale_flag").alias("sector_ownership_stale_flag"), *time("_sector_updated"),
        ), ["trading_date", "sector_code"])
        .join(regimes.select(
            "trading_date", F.col("regime").alias("market_regime"), F.col("confidence").alias("market_confidence"),
            *time("_regime_updated"),
        ), "trading_date")
        .dropna(subset=REQUIRED)
    )
    owned = trends.select(
        "instrument_id", F.col("as_of_date").alias("ownership_as_of_date"),
        F.col("trend_label").alias("ownership_trend_label"),
        F.col("signal_strength").alias("ownership_signal_strength"),
        F.col("corporate_action_risk").alias("ownership_corporate_action_risk"), *time("_owned_updated"),
    )
    # only keys are stacked with the trends; the wide rows stay where they lie
    keys = ["instrument_id", "trading_date"]
    held = asof_backward(
        features.select(*keys).distinct(), owned, ["instrument_id"], "trading_date", "ownership_as_of_date",
        ["ownership_trend_label", "ownership_signal_strength", "ownership_corporate_action_risk", *(["_owned_updated"] if timed else [])],
        how="left",
    )
    matched = base.join(ws.keyed(held, "instrument_id").hint("shuffle_hash"), keys)
    if timed:
        required = ["updated_at", "turnover_updated_at", "_sector_updated", "_regime_updated"]
        newest = newest_input(required, ["_owned_updated"])
        matched = matched.withColumn("input_updated_at", newest).drop(*required, "_owned_updated")
    matched = ws.write_keyed(matched, "screener-inputs", "instrument_id")
    # only keys and turnover are ranked; a key has one turnover, however many rows it has
    ranks = percent_rank(matched.select(*keys, "avg_turnover_20d"), ws, ["trading_date"], "avg_turnover_20d", "liquidity_percentile")
    ranks = ws.keyed(ranks, "instrument_id").groupBy(*keys).agg(F.first("liquidity_percentile").alias("liquidity_percentile"))
    return matched.join(ranks.hint("shuffle_hash"), keys)


def screener_scores(inputs: DataFrame, model_version: str) -> DataFrame:
    no_sector_rs = F.lit(None).cast("double")
    rows = inputs.withColumns({
        "_owned": F.col("ownership_as_of_date").isNotNull() & F.col("ownership_trend_label").isNotNull()
        & F.col("ownership_signal_strength").isNotNull(),
        "_atr_pct": F.col("atr14") / F.col("close") * 100.0, "_rsi": clamp("rsi14"),
    })
    rows = rows.withColumn(
        "ownership_age_days", F.when(F.col("_owned"), F.datediff("trading_date", "ownership_as_of_date"))
    ).withColumn("ownership_stale_flag", F.coalesce(F.col("ownership_age_days") > STALE_DAYS, F.lit(False)))
    rows = rows.withColumns({
        "trend_score": trend_score(), "breakout_score": breakout_score(), "_sector_raw": F.col("sector_input_score"),
    })
    rows = with_rounded(rows, {
        "market_score": (market_score(F.col("market_regime"), F.col("market_confidence")), 4),
        "momentum_score": (piecewise("_rsi", MOMENTUM_KNOTS), 4),
        "relative_strength_score": (strength_score(F.col("rs_ihsg_20d"), no_sector_rs), 4),
        "volume_score": (F.coalesce(clamp(F.lit(50.0) + F.col("volume_z20") * 15.0), F.lit(50.0)), 4),
        "liquidity_score": (clamp("liquidity_percentile", 0.0, 1.0) * 100.0, 4),
        "ownership_score": (ownership_score(), 4),
        "risk_score": (piecewise("_atr_pct", RISK_KNOTS), 4),
        "atr_pct": (F.col("_atr_pct"), 4),
    })
    rows = with_rounded(rows, {"technical_score": (clamp(
        0.35 * F.col("trend_score") + 0.20 * F.col("momentum_score") + 0.30 * F.col("relative_strength_score")
        + 0.10 * F.col("volume_score") + 0.05 * F.col("breakout_score")
    ), 4)}).withColumn("sector_score", F.col("_sector_raw"))
    weighted = None
    for name, weight in OVERALL_WEIGHTS.items():
        term = F.lit(weight) * F.col(name)
        weighted = term if weighted is None else weighted + term
    rows = with_rounded(rows, {"overall_score": (clamp(weighted), 4)})
    completeness = (
        F.lit(100.0)
        - F.when(~F.col("_owned"), 10.0).when(F.col("ownership_stale_flag"), 5.0).otherwise(0.0)
        - F.when(F.col("sector_ownership_stale_flag"), 5.0).otherwise(0.0)
        - F.when(F.col("volume_z20").isNull(), 5.0).otherwise(0.0)
        - F.lit(5.0)
    )
    rows = rows.withColumn("data_completeness", completeness).withColumn("status", screening_status())
    return with_rounded(rows, {"sector_score": (clamp("_sector_raw"), 4)}).withColumn(
        "model_version", F.lit(model_version)
    ).drop("_owned", "_atr_pct", "_rsi", "_sector_raw", "sector_input_score")


def screener_warnings() -> Column:
    """Fixed caveats followed by the row's own."""
    notes = [
        ("SCREENING_ONLY_NOT_EXECUTABLE_SIGNAL", F.lit(True)),
        ("YAHOO_EOD_IS_THIRD_PARTY_MARKET_DATA", F.lit(True)),
        ("HISTORICAL_KSEI_AS_OF_DATE_IS_NOT_PUBLICATION_TIME_SAFE", F.lit(True)),
        ("RS_SECTOR_20D_UNAVAILABLE_USING_IHSG_ONLY", F.lit(True)),
        ("VOLUME_Z20_UNAVAILABLE_NEUTRAL_FALLBACK", F.col("volume_z20").isNull()),
        ("STOCK_OWNERSHIP_UNAVAILABLE", F.col("ownership_as_of_date").isNull()),
        ("STOCK_OWNERSHIP_STALE", F.col("ownership_stale_flag")),
        ("SECTOR_OWNERSHIP_STALE", F.col("sector_ownership_stale_flag")),
        ("OWNERSHIP_CORPORATE_ACTION_RISK", F.col("ownership_corporate_action_risk")),
        ("FAILED_BREAKOUT", F.col("failed_breakout_flag")),
    ]
    return F.array_compact(F.array(*[F.when(test, F.lit(code)) for code, test in notes]))


def ranked(rows: DataFrame, ws: Workspace) -> DataFrame:
    """Rank in the date and in the date's sector: best overall, then technical, then symbol.

    The scored rows are written once, by instrument; only the ordering columns are sorted, and
    the ranks, written the same way, are joined back by key where they lie.
    """
    rows = ws.write_keyed(rows, "scored", "instrument_id")
    keys = ["instrument_id", "trading_date"]
    order = [F.col("overall_score").desc(), F.col("technical_score").desc(), F.col("symbol").asc()]
    placed = positions(
        rows.select(*keys, "sector_code", "overall_score", "technical_score", "symbol"), ws,
        ["trading_date"], order, "universe_rank", {"sector_rank": ["sector_code"]})
    ranks = ws.keyed(placed.select(*keys, "universe_rank", "sector_rank"), "instrument_id")
    return rows.join(ws.write_keyed(ranks, "ranks", "instrument_id").hint("shuffle_hash"), keys)
