"""Ownership trends, sector ownership signals and the integrated sector view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import when_updated
from tidemark.functions.numeric import balance, clamp, mean, rnd
from tidemark.operators.joins import asof_backward
from tidemark.operators.windows import series

STALE_DAYS = 45


def snapshot_pairs(snapshots: DataFrame) -> DataFrame:
    """Each snapshot with the one before it; the first of a key is dropped."""
    w = series(order="as_of_date")
    fields = ["as_of_date", "foreign_ownership_pct", "foreign_shares", "security_number"]
    return snapshots.withColumns(
        {f"previous_{c}": F.lag(c).over(w) for c in fields}
    ).filter("previous_as_of_date is not null")


def trend_label(delta: Column) -> Column:
    return F.when(delta >= 0.10, "ACCUMULATING").when(delta <= -0.10, "DISTRIBUTING").otherwise("STABLE")


def signal_strength(delta: Column, risky: Column, gap: Column) -> Column:
    """Move relative to half a point, halved for share-count jumps, cut by a quarter for gaps."""
    strength = clamp(F.abs(delta) / 0.50 * 100.0)
    strength = strength * F.when(risky, 0.50).otherwise(1.0)
    return rnd(clamp(strength * F.when(gap, 0.75).otherwise(1.0)), 4)


def input_errors() -> Column:
    """Names of the range rules a snapshot pair breaks."""
    def outside(c: str) -> Column:
        return ~F.col(c).between(0.0, 100.0)

    rules = [
        ("AS_OF_NOT_AFTER_PREVIOUS", F.col("as_of_date") <= F.col("previous_as_of_date")),
        ("PCT_OUT_OF_RANGE", outside("foreign_ownership_pct")),
        ("PREVIOUS_PCT_OUT_OF_RANGE", outside("previous_foreign_ownership_pct")),
        ("NEGATIVE_SHARES", F.col("foreign_shares") < 0),
        ("NEGATIVE_PREVIOUS_SHARES", F.col("previous_foreign_shares") < 0),
        ("SECURITY_NUMBER_NOT_POSITIVE", F.col("security_number") <= 0),
        ("PREVIOUS_SECURITY_NUMBER_NOT_POSITIVE", F.col("previous_security_number") <= 0),
    ]
    return F.array_compact(F.array(*[F.when(test, F.lit(code)) for code, test in rules]))


def ownership_trends(snapshots: DataFrame, model_version: str) -> DataFrame:
    pairs = snapshot_pairs(snapshots)
    pairs = pairs.withColumn("_errors", input_errors())
    pairs = pairs.filter(F.when(F.size("_errors") == 0, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("Ownership input: "), F.array_join("_errors", ","))).cast("boolean")
    )).drop("_errors")
    pct = F.col("foreign_ownership_pct") - F.col("previous_foreign_ownership_pct")
    shares = F.col("foreign_shares") - F.col("previous_foreign_shares")
    before = F.col("previous_security_number")
    count_pct = (F.col("security_number") - before) / before * 100.0
    days = F.datediff("as_of_date", "previous_as_of_date")
    risky, gap = F.abs(count_pct) >= 1.0, days > STALE_DAYS
    return pairs.select(
        "instrument_id", "as_of_date", "previous_as_of_date",
        rnd("foreign_ownership_pct", 8).alias("foreign_ownership_pct"),
        rnd("previous_foreign_ownership_pct", 8).alias("previous_foreign_ownership_pct"),
        rnd(pct, 8).alias("delta_foreign_ownership_pp"),
        "foreign_shares", "previous_foreign_shares", shares.alias("delta_foreign_shares"),
        "security_number", "previous_security_number",
        rnd(count_pct, 8).alias("delta_security_number_pct"),
        rnd(shares / before * 100.0, 8).alias("normalized_foreign_share_change_pct"),
        days.alias("days_between_snapshots"),
        trend_label(pct).alias("trend_label"),
        signal_strength(pct, risky, gap).alias("signal_strength"),
        risky.alias("corporate_action_risk"), gap.alias("snapshot_gap_flag"),
        F.lit(model_version).alias("model_version"), *(["updated_at"] if when_updated(pairs) else []),
    )


def sector_ownership_inputs(trends: DataFrame, instruments: DataFrame,
                            clip: float = 0.50, extreme: float = 5.0) -> DataFrame:
    """Counts and mean moves per (snapshot date, sector).

    ``instruments`` is the current universe; its sector sizes are the coverage base.
    """
    members = instruments.filter("sector_code is not null")
    sizes = members.groupBy("sector_code").agg(F.count(F.lit(1)).alias("current_universe_count"))
    clean = ~F.col("corporate_action_risk") & ~F.col("snapshot_gap_flag")
    delta = F.col("delta_foreign_ownership_pp")
    clipped = F.least(F.lit(clip), F.greatest(F.lit(-clip), delta))

    def labelled(label: str) -> Column:
        return F.count_if(clean & (F.col("trend_label") == label))

    grouped = trends.join(members.select("instrument_id", "sector_code"), "instrument_id").groupBy(
        "as_of_date", "sector_code"
    ).agg(
        F.count(F.lit(1)).alias("eligible_count"),
        F.count_if(clean).alias("clean_count"),
        labelled("ACCUMULATING").alias("accumulating_count"),
        labelled("STABLE").alias("stable_count"),
        labelled("DISTRIBUTING").alias("distributing_count"),
        F.count_if("corporate_action_risk").alias("corporate_action_risk_count"),
        F.count_if("snapshot_gap_flag").alias("snapshot_gap_count"),
        F.count_if(F.abs(delta) >= extreme).alias("extreme_move_count"),
        mean(delta).alias("avg_delta_foreign_ownership_pp"),
        mean(F.when(clean, clipped)).alias("avg_clean_clipped_delta_pp"),
        *([F.max("updated_at").alias("updated_at")] if when_updated(trends) else []),
    )
    return grouped.join(sizes, "sector_code")


# Labels and lower/upper bounds of the five signal classes.
def signal_label(score: Column, strong_high: str, high: str, low: str, strong_low: str) -> Column:
    return (
        F.when(score >= 65, strong_high).when(score >= 55, high)
        .when(score <= 35, strong_low).when(score <= 45, low).otherwise("NEUTRAL")
    )


def sector_ownership(inputs: DataFrame, model_version: str) -> DataFrame:
    mean_move = F.coalesce(F.col("avg_clean_clipped_delta_pp"), F.lit(0.0))
    coverage = rnd(clamp(F.col("eligible_count") / F.col("current_universe_count") * 100.0), 6)
    counted = inputs.withColumns({
        "coverage_pct": coverage,
        "breadth_score": rnd(clamp(F.lit(50.0) + 50.0 * balance("accumulating_count", "distributing_count", "clean_count")), 6),
        "intensity_score": rnd(clamp(F.lit(50.0) + mean_move / 0.25 * 50.0), 6),
    })
    raw = 0.65 * F.col("breadth_score") + 0.35 * F.col("intensity_score")
    thin = F.col("coverage_pct") < 80.0
    score = rnd(clamp(F.when(thin, F.lit(50.0) + (raw - 50.0) * 0.50).otherwise(raw)), 6)
    return counted.withColumn("score", score).select(
        "as_of_date", "sector_code", "eligible_count", "current_universe_count", "coverage_pct",
        "clean_count", "accumulating_count", "stable_count", "distributing_count",
        "corporate_action_risk_count", "snapshot_gap_count", "extreme_move_count",
        rnd("avg_delta_foreign_ownership_pp", 8).alias("avg_delta_foreign_ownership_pp"),
        rnd(mean_move, 8).alias("avg_clean_clipped_delta_pp"),
        "breadth_score", "intensity_score", "score",
        signal_label(F.col("score"), "STRONG_ACCUMULATION", "ACCUMULATION",
                     "DISTRIBUTION", "STRONG_DISTRIBUTION").alias("signal_label"),
        thin.alias("low_coverage_flag"),
        F.lit(model_version).alias("model_version"), *(["updated_at"] if when_updated(inputs) else []),
    )


def direction(score: Column) -> Column:
    return F.when(score >= 55, 1).when(score <= 45, -1).otherwise(0)


def alignment(technical: Column, ownership: Column, stale: Column) -> Column:
    t, o = direction(technical), direction(ownership)
    return (
        F.when(stale, "OWNERSHIP_STALE")
        .when((t == 1) & (o == 1), "CONFIRMED_BULLISH")
        .when((t == -1) & (o == -1), "CONFIRMED_BEARISH")
        .when((t == 0) & (o == 0), "NEUTRAL")
        .when(o == 0, "TECHNICAL_LEAD")
        .when(t == 0, "OWNERSHIP_LEAD")
        .otherwise("DIVERGENCE")
    )


def integrated_inputs(rotation: DataFrame, signals: DataFrame) -> DataFrame:
    """Sector scores with the latest ownership signal on or before the date."""
    timed = when_updated(rotation, signals)
    technical = rotation.select(
        "sector_code", "trading_date", F.col("score").alias("technical_score"),
        F.col("rotation_label").alias("technical_rotation_label"), *(["updated_at"] if timed else []),
    ).filter("technical_score is not null")
    owned = signals.select(
        "sector_code", F.col("as_of_date").alias("ownership_as_of_date"),
        F.col("score").alias("ownership_score"), F.col("signal_label").alias("ownership_signal_label"),
        F.col("low_coverage_flag").alias("ownership_low_coverage_flag"),
        *([F.col("updated_at").alias("_owned_updated")] if timed else []),
    )
    out = asof_backward(
        technical, owned, ["sector_code"], "trading_date", "ownership_as_of_date",
        ["ownership_score", "ownership_signal_label", "ownership_low_coverage_flag", *(["_owned_updated"] if timed else [])],
    )
    return out.withColumn("updated_at", F.greatest("updated_at", "_owned_updated")).drop("_owned_updated") if timed else out


def integrated_sector(inputs: DataFrame, model_version: str) -> DataFrame:
    age = F.datediff("trading_date", "ownership_as_of_date")
    aged = inputs.withColumn("ownership_age_days", age).withColumn(
        "ownership_stale_flag", F.col("ownership_age_days") > STALE_DAYS
    )
    stale = F.col("ownership_stale_flag")
    aged = aged.withColumns({
        "technical_weight": F.when(stale, 1.0).otherwise(0.80),
        "ownership_weight": F.when(stale, 0.0).otherwise(0.20),
    })
    score = rnd(clamp(
        F.col("technical_score") * F.col("technical_weight") + F.col("ownership_score") * F.col("ownership_weight")
    ), 6)
    return aged.withColumn("integrated_score", score).select(
        "trading_date", "sector_code", rnd("technical_score", 6).alias("technical_score"),
        "technical_rotation_label", "ownership_as_of_date",
        rnd("ownership_score", 6).alias("ownership_score"), "ownership_signal_label",
        "ownership_age_days", "ownership_low_coverage_flag", "ownership_stale_flag",
        "technical_weight", "ownership_weight", "integrated_score",
        signal_label(F.col("integrated_score"), "STRONG_BULLISH", "BULLISH", "BEARISH",
                     "STRONG_BEARISH").alias("integrated_label"),
        alignment(F.col("technical_score"), F.col("ownership_score"), stale).alias("alignment_label"),
        F.lit(model_version).alias("model_version"), *(["updated_at"] if when_updated(inputs) else []),
    )
