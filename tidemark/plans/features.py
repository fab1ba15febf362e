"""Technical features for every instrument in one pass, and the index regime."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import when_updated
from tidemark.functions.numeric import clamp, rnd
from tidemark.operators.recursive import smooth, span, wilder
from tidemark.operators.windows import guarded, prior, series, share_not_above, simple_return, trailing, zscore

FEATURE_COLUMNS = [
    "return_1d", "return_5d", "return_20d", "return_60d",
    "ema20", "ema50", "ema100", "ema200", "rsi14", "atr14",
    "volume_z20", "breakout_flag", "failed_breakout_flag",
]


def relative_strength_index(gain, loss):
    """RSI from smoothed gain and loss, with the degenerate cases spelled out."""
    gain, loss = F.col(gain), F.col(loss)
    return (
        F.when(gain.isNull() | loss.isNull(), F.lit(None))
        .when((loss == 0) & (gain > 0), F.lit(100.0))
        .when((loss == 0) & (gain == 0), F.lit(50.0))
        .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + gain / loss))
    )


def technical_features(bars: DataFrame, with_volume: bool = True) -> DataFrame:
    """One row per bar with returns, averages, oscillators and breakout flags.

    Needs one bar per (instrument, date); everything runs in the instrument's
    partition, so the whole set costs one shuffle. Stored precision follows the
    published column scales: 6 decimals for prices and oscillators, 8 for returns. Where bars
    carry ``ingested_at``, ``updated_at`` is the latest of the bars up to the row, which the averages all depend on.
    """
    w = series()
    before = F.lag("close").over(w)
    change = F.col("close") - before
    true_range = F.greatest(
        F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before)
    )
    timed = when_updated(bars, column="ingested_at")
    # windows are projected before they are rounded or compared, so each is evaluated once
    df = bars.withColumns({
        **({"updated_at": F.max("ingested_at").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))} if timed else {}),
        "_pos": F.row_number().over(w),
        "_gain": F.greatest(change, F.lit(0.0)),
        "_loss": F.greatest(-change, F.lit(0.0)),
        "_range": true_range,
        **{f"_return_{n}d": simple_return("close", n, w) for n in (1, 5, 20, 60)},
        "_z20": zscore("volume", 20, w) if with_volume else F.lit(None).cast("double"),
        "_prior_high": guarded(F.max("high"), "high", prior(w, 20), 20),
    })
    # greatest() skips NULL, but the first bar has no change at all
    df = df.withColumns({
        "_gain": F.when(F.col("_pos") > 1, F.col("_gain")),
        "_loss": F.when(F.col("_pos") > 1, F.col("_loss")),
        **{f"return_{n}d": rnd(f"_return_{n}d", 8) for n in (1, 5, 20, 60)},
        "volume_z20": rnd("_z20", 6),
        "breakout_flag": F.col("close") > F.col("_prior_high"),
        "failed_breakout_flag": (F.col("high") > F.col("_prior_high")) & (F.col("close") <= F.col("_prior_high")),
    })
    df = smooth(
        df,
        [
            span("ema20", "close", 20), span("ema50", "close", 50),
            span("ema100", "close", 100), span("ema200", "close", 200),
            wilder("_avg_gain", "_gain", lead=1), wilder("_avg_loss", "_loss", lead=1), wilder("atr14", "_range"),
        ],
        ["instrument_id"], "trading_date", "_pos",
    )
    df = df.withColumn("_rsi", relative_strength_index("_avg_gain", "_avg_loss")).withColumns({
        "rsi14": rnd("_rsi", 6),
        **{c: rnd(c, 6) for c in ("ema20", "ema50", "ema100", "ema200", "atr14")},
    })
    return df.select(*bars.columns, *FEATURE_COLUMNS, *(["updated_at"] if timed else []))


def with_index_strength(features: DataFrame, index_features: DataFrame) -> DataFrame:
    """20-row return minus the index's on the same date; no index bar gives NULL."""
    timed = when_updated(features, index_features)
    index = index_features.select(
        "trading_date", F.col("return_20d").alias("_index_return"), *([F.col("updated_at").alias("_index_updated")] if timed else []))
    out = features.join(index, "trading_date", "left").withColumn("_excess", F.col("return_20d") - F.col("_index_return"))
    if timed:
        out = out.withColumn("updated_at", F.greatest("updated_at", "_index_updated"))
    return out.withColumn("rs_ihsg_20d", rnd("_excess", 8)).drop("_index_return", "_index_updated", "_excess")


def enough_history(bars: DataFrame, minimum: int) -> DataFrame:
    """Instruments with at least ``minimum`` bars."""
    counts = bars.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("_bars"))
    return bars.join(counts.filter(F.col("_bars") >= minimum).select("instrument_id"), "instrument_id", "left_semi")


# Regime names stored for each direction.
REGIME_NAMES = {"BULLISH": "BULL", "NEUTRAL": "SIDEWAYS", "BEARISH": "BEAR"}


def index_regimes(index_features: DataFrame) -> DataFrame:
    """Trend, volatility and composite score per index row, scored rows only."""

    def vote(condition, points: float):
        return F.when(condition, F.lit(points)).otherwise(F.lit(-points))

    needed = ["close", "return_20d", "return_60d", "ema20", "ema50", "ema200", "rsi14", "atr14"]
    complete = F.lit(True)
    for c in needed:
        complete = complete & F.col(c).isNotNull()
    momentum = F.when(F.col("rsi14") >= 55, 3.0).when(F.col("rsi14") <= 45, -3.0).otherwise(0.0)
    trend = (
        F.lit(50.0)
        + vote(F.col("close") > F.col("ema20"), 5.0) + vote(F.col("close") > F.col("ema50"), 7.0)
        + vote(F.col("close") > F.col("ema200"), 10.0) + vote(F.col("ema20") > F.col("ema50"), 7.0)
        + vote(F.col("ema50") > F.col("ema200"), 8.0) + vote(F.col("return_20d") > 0, 5.0)
        + vote(F.col("return_60d") > 0, 5.0) + momentum
    )
    w = series()
    year = trailing(w, 252)
    scored = index_features.withColumn("_atr_share", F.col("atr14") / F.col("close")).withColumns({
        "trend_score": F.when(complete, clamp(trend)),
        "_rank": share_not_above("_atr_share", 252, 60, w),
        "_top": guarded(F.max("close"), "close", year, 60),
    })
    drawdown = F.col("close") / F.col("_top") - 1.0
    calm = F.lit(100.0) - F.col("_rank") * 100.0
    volatility = 0.70 * calm + 0.30 * clamp(F.lit(100.0) + drawdown * 333.333333)
    scored = scored.withColumn("volatility_score", volatility).withColumn(
        "composite_score", 0.75 * F.col("trend_score") + 0.25 * F.col("volatility_score")
    ).filter("composite_score is not null")
    direction = (
        F.when(F.col("composite_score") >= 60, "BULLISH")
        .when(F.col("composite_score") <= 40, "BEARISH").otherwise("NEUTRAL")
    )
    regime = F.when(F.col("direction") == "BULLISH", REGIME_NAMES["BULLISH"])
    for name in ("NEUTRAL", "BEARISH"):
        regime = regime.when(F.col("direction") == name, REGIME_NAMES[name])
    confidence = clamp(F.lit(0.25) + F.abs(F.col("composite_score") - 50.0) / 50.0 * 0.30, 0.25, 0.55)
    return scored.withColumn("direction", direction).select(
        "instrument_id", "trading_date", "close", rnd("trend_score", 4).alias("trend_score"),
        rnd("volatility_score", 4).alias("volatility_score"),
        rnd("composite_score", 4).alias("composite_score"),
        "direction", regime.alias("regime"), rnd(confidence, 4).alias("confidence"),
        *(["updated_at"] if when_updated(index_features) else []),
    )
