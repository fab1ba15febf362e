"""Market breadth per date and sector rotation per (date, sector)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import when_updated
from tidemark.functions.numeric import balance, clamp, mean, rnd
from tidemark.operators.windows import prior, series


def prior_close_range(bars: DataFrame) -> DataFrame:
    """Count, highest and lowest close of the 20 and 252 rows before each bar.

    Runs over valid bars only, so full and incremental builds see the same rows.
    """
    w = series()
    out = {}
    for n in (20, 252):
        frame = prior(w, n)
        out[f"prior_{n}_count"] = F.count("close").over(frame)
        out[f"prior_{n}_high"] = F.max("close").over(frame)
        out[f"prior_{n}_low"] = F.min("close").over(frame)
    return bars.withColumns(out)


def _movement() -> dict[str, Column]:
    close, before = F.col("close"), F.col("previous_close")
    return {"up": close > before, "down": close < before, "flat": close == before}


def _direction_aggregates() -> list[Column]:
    move = _movement()

    def above(c: str) -> Column:
        share = F.sum(F.when(F.col("close") > F.col(c), 1).otherwise(0))
        return (F.lit(100.0) * share / F.count(F.lit(1))).alias(f"pct_above_{c}")

    def volume(key: str, name: str) -> Column:
        return F.coalesce(F.sum(F.when(move[key], F.col("volume"))), F.lit(0.0)).alias(name)

    return [
        F.count(F.lit(1)).alias("eligible_count"),
        F.count_if(move["up"]).alias("advances"),
        F.count_if(move["down"]).alias("declines"),
        F.count_if(move["flat"]).alias("unchanged"),
        above("ema20"), above("ema50"), above("ema200"),
        volume("up", "up_volume"), volume("down", "down_volume"),
    ]


def breadth_inputs(bars: DataFrame) -> DataFrame:
    """Daily counts over bars that have a 200-row average.

    ``bars`` carries features, previous_close and the prior close ranges.
    """

    def broke(n: int, compare: Column) -> Column:
        return F.count_if((F.col(f"prior_{n}_count") == n) & compare)

    close = F.col("close")
    return bars.filter("ema200 is not null").groupBy("trading_date").agg(
        *_direction_aggregates(),
        broke(20, close > F.col("prior_20_high")).alias("new_high_20d"),
        broke(20, close < F.col("prior_20_low")).alias("new_low_20d"),
        broke(252, close > F.col("prior_252_high")).alias("new_high_52w"),
        broke(252, close < F.col("prior_252_low")).alias("new_low_52w"),
    )


def breadth_score() -> Column:
    """Weighted trend, advance/decline, new-high and volume balance on 0..100."""
    total = F.col("advances") + F.col("declines") + F.col("unchanged")

    def tilt(c: str) -> Column:
        return clamp((F.col(c) - 50.0) / 50.0, -1.0, 1.0)

    trend = (tilt("pct_above_ema20") + tilt("pct_above_ema50") + tilt("pct_above_ema200")) / 3.0
    mix = (
        0.40 * trend
        + 0.25 * balance("advances", "declines", total)
        + 0.15 * balance("new_high_52w", "new_low_52w", total)
        + 0.10 * balance("new_high_20d", "new_low_20d", total)
        + 0.10 * balance("up_volume", "down_volume")
    )
    return F.when(total <= 0, F.lit(50.0)).otherwise(rnd(clamp((mix + 1.0) * 50.0), 4))


def population_check(name: str) -> Column:
    """Fails the job when advances, declines and unchanged miss a row."""
    total = F.col("advances") + F.col("declines") + F.col("unchanged")
    return F.when(total == F.col("eligible_count"), F.col("eligible_count")).otherwise(
        F.raise_error(F.concat(F.lit(f"{name} population mismatch on "), F.col("trading_date").cast("string"))).cast("long")
    )


def market_breadth(bars: DataFrame, universe_code: str) -> DataFrame:
    daily = breadth_inputs(bars)
    return daily.select(
        "trading_date", F.lit(universe_code).alias("universe_code"),
        population_check("Breadth").alias("eligible_count"),
        "advances", "declines", "unchanged",
        "new_high_20d", "new_low_20d", "new_high_52w", "new_low_52w",
        *[rnd(c, 4).alias(c) for c in ("pct_above_ema20", "pct_above_ema50", "pct_above_ema200")],
        "up_volume", "down_volume", breadth_score().alias("breadth_score"),
    )


ROTATION_LOOKBACK = 20


def sector_inputs(bars: DataFrame, index_features: DataFrame) -> DataFrame:
    """Sector-day aggregate on dates for which the index has both returns."""
    timed = when_updated(bars, index_features)
    index = index_features.select(
        "trading_date", F.col("return_20d").alias("index_return_20d"), F.col("return_60d").alias("index_return_60d"),
        *([F.col("updated_at").alias("_index_updated")] if timed else []),
    ).dropna(subset=["trading_date", "index_return_20d", "index_return_60d"])
    daily = bars.filter("ema200 is not null").groupBy("trading_date", "sector_code").agg(
        mean("return_20d").alias("sector_return_20d"),
        mean("return_60d").alias("sector_return_60d"),
        *_direction_aggregates(),
        *([F.max("updated_at").alias("updated_at")] if timed else []),
    )
    joined = daily.join(index, "trading_date")
    return joined.withColumn("updated_at", F.greatest("updated_at", "_index_updated")).drop("_index_updated") if timed else joined


def rotation_label(score: Column, change: Column) -> Column:
    return (
        F.when(change.isNull() & (score >= 60), "LEADING")
        .when(change.isNull() & (score <= 40), "LAGGING")
        .when(change.isNull(), "NEUTRAL")
        .when((score >= 60) & (change >= 0), "LEADING")
        .when((score <= 40) & (change <= 0), "LAGGING")
        .when(change >= 5, "IMPROVING")
        .when(change <= -5, "WEAKENING")
        .otherwise("NEUTRAL")
    )


def sector_component_scores(daily: DataFrame) -> DataFrame:
    total = F.col("advances") + F.col("declines") + F.col("unchanged")
    excess = (
        0.65 * (F.col("sector_return_20d") - F.col("index_return_20d"))
        + 0.35 * (F.col("sector_return_60d") - F.col("index_return_60d"))
    )
    above = (F.col("pct_above_ema20") + F.col("pct_above_ema50") + F.col("pct_above_ema200")) / 3.0
    direction = F.lit(50.0) + 50.0 * balance("advances", "declines", total)
    return daily.withColumns({
        "relative_strength_score": rnd(clamp(F.lit(50.0) + 200.0 * excess), 4),
        "breadth_score": F.when(total <= 0, F.lit(50.0)).otherwise(rnd(clamp(0.70 * above + 0.30 * direction), 4)),
        "volume_score": rnd(clamp(F.lit(50.0) + 50.0 * balance("up_volume", "down_volume")), 4),
    }).withColumn("score", rnd(clamp(
        0.45 * F.col("relative_strength_score") + 0.35 * F.col("breadth_score") + 0.20 * F.col("volume_score")
    ), 4))


def rotate(scored: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Score change over 20 observations and the rotation label.

    ``history`` holds (sector_code, trading_date, score) rows from an earlier
    build; they seed the lag and are not returned.
    """
    rows = scored.withColumn("_old", F.lit(False))
    if history is not None:
        rows = rows.unionByName(
            history.select("sector_code", "trading_date", "score").withColumn("_old", F.lit(True)),
            allowMissingColumns=True,
        )
    w = series("sector_code")
    change = F.col("score") - F.lag("score", ROTATION_LOOKBACK).over(w)
    return (
        rows.withColumn("score_change_20d", rnd(change, 4)).filter(~F.col("_old")).drop("_old")
        .withColumn("rotation_label", rotation_label(F.col("score"), F.col("score_change_20d")))
    )


def sector_rotation(bars: DataFrame, index_features: DataFrame, model_version: str,
                    history: DataFrame | None = None) -> DataFrame:
    daily = sector_inputs(bars, index_features).withColumn("eligible_count", population_check("Sector"))
    rotated = rotate(sector_component_scores(daily), history)
    return rotated.select(
        "trading_date", "sector_code", "eligible_count", "rotation_label", "score",
        "relative_strength_score", "breadth_score", "volume_score", "score_change_20d",
        F.lit(model_version).alias("model_version"), *(["updated_at"] if when_updated(rotated) else []),
    )


def prior_score_history(stored: DataFrame, through: Column, rows: int = ROTATION_LOOKBACK) -> DataFrame:
    """The last ``rows`` stored scores of each sector up to a date."""
    w = series("sector_code")
    newest = w.orderBy(F.col("trading_date").desc())
    return (
        stored.filter(F.col("trading_date") <= through)
        .withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= rows)
        .select("sector_code", "trading_date", "score")
    )
