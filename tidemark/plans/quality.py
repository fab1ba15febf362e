"""Data-quality audits: rule counts, coverage, orphans and recompute-and-compare."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import when_updated
from tidemark.operators.joins import compared, overlapping
from tidemark.operators.windows import series


def _null(*columns: str) -> str:
    return "(" + " OR ".join(f"{c} IS NULL" for c in columns) + ")"


def _outside(low: float, high: float, *columns: str) -> str:
    return "(" + " OR ".join(f"{c} < {low} OR {c} > {high}" for c in columns) + ")"


# Each rule is a predicate that is true for a bad row.
RULES: dict[str, dict[str, str]] = {
    "setups": {
        "invalid_decision": "setup_decision IS NULL OR setup_decision NOT IN ('ACCEPT', 'WATCH', 'REJECT')",
        "invalid_accept": "setup_decision = 'ACCEPT' AND (status <> 'BUY_SETUP' OR " + _null(
            "entry_low", "entry_high", "stop_price", "target_primary", "expected_rr", "position_size_lots")
        + " OR expected_rr < 1.5 OR position_size_lots < 1 OR reason_count <> 0)",
        "invalid_watch": "setup_decision = 'WATCH' AND (status <> 'WATCH' OR reason_count = 0)",
        "invalid_reject": "setup_decision = 'REJECT' AND (status <> 'AVOID' OR reason_count = 0)",
    },
    "outcomes": {
        "invalid_label": "outcome_label IS NULL OR outcome_label NOT IN ('PENDING', 'NO_FILL', 'CANCELLED', 'OPEN', 'TARGET', 'STOP', 'EXPIRED')",
        "invalid_filled": "entry_filled AND " + _null("entry_date", "entry_price", "bars_to_entry"),
        "invalid_unfilled": "NOT entry_filled AND (entry_date IS NOT NULL OR entry_price IS NOT NULL OR bars_to_entry IS NOT NULL)",
        "invalid_target": "outcome_label = 'TARGET' AND (NOT target_hit OR stop_hit OR " + _null("exit_date", "exit_price", "realized_r") + " OR realized_r <= 0)",
        "invalid_stop": "outcome_label = 'STOP' AND (NOT stop_hit OR target_hit OR " + _null("exit_date", "exit_price", "realized_r") + " OR realized_r > 0)",
        "invalid_incomplete": "outcome_label IN ('PENDING', 'OPEN') AND horizon_complete",
        "invalid_available_bars": "available_bars < 0",
    },
    "calibration": {
        "invalid_eligible_sample": "calibration_eligible AND sample_status <> 'MATURE_TRADE'",
        "eligible_excluded": "calibration_eligible AND split_label = 'EXCLUDED'",
        "excluded_with_split": "NOT calibration_eligible AND split_label <> 'EXCLUDED'",
        "invalid_mature": "sample_status = 'MATURE_TRADE' AND (NOT entry_filled OR NOT horizon_complete OR "
        + _null("realized_r", "tp_before_sl_label", "positive_r_label") + ")",
        "invalid_unfilled": "sample_status = 'UNFILLED_COMPLETE' AND (entry_filled OR NOT horizon_complete OR realized_r IS NOT NULL)",
        "invalid_entry_date": "entry_date IS NOT NULL AND entry_date <= signal_date",
        "invalid_exit_date": "exit_date IS NOT NULL AND entry_date IS NOT NULL AND exit_date < entry_date",
    },
    "execution": {
        "invalid_available_execution": "sample_status = 'MATURE_TRADE' AND execution_metrics_available AND " + _null(
            "modeled_entry_price", "modeled_exit_price", "modeled_stop_price", "entry_tick_size", "exit_tick_size", "net_realized_r"),
        "execution_on_non_mature": "sample_status <> 'MATURE_TRADE' AND execution_metrics_available",
        "strict_with_blockers": "strict_calibration_eligible AND blocker_count <> 0",
        "strict_without_execution": "strict_calibration_eligible AND NOT execution_metrics_available",
        "invalid_entry_tick": "entry_tick_size <= 0", "invalid_exit_tick": "exit_tick_size <= 0",
        "invalid_blockers": "blocker_count IS NULL",
    },
    "breadth": {
        "null_metrics": _null("advances", "declines", "unchanged", "new_high_20d", "new_low_20d", "new_high_52w", "new_low_52w",
                              "pct_above_ema20", "pct_above_ema50", "pct_above_ema200", "up_volume", "down_volume", "breadth_score"),
        "negative_counts": "least(advances, declines, unchanged, new_high_20d, new_low_20d, new_high_52w, new_low_52w) < 0",
        "invalid_percentages": _outside(0, 100, "pct_above_ema20", "pct_above_ema50", "pct_above_ema200"),
        "invalid_score": _outside(0, 100, "breadth_score"), "invalid_volume": "up_volume < 0 OR down_volume < 0",
        "invalid_population": "advances + declines + unchanged <= 0",
    },
    "rotation": {
        "null_core": _null("rotation_label", "score", "relative_strength_score", "breadth_score", "volume_score"),
        "invalid_scores": _outside(0, 100, "score", "relative_strength_score", "breadth_score", "volume_score"),
        "invalid_labels": "rotation_label NOT IN ('LEADING', 'IMPROVING', 'NEUTRAL', 'WEAKENING', 'LAGGING')",
    },
    "snapshots": {
        "null_foreign_pct": "foreign_ownership_pct IS NULL",
        "invalid_foreign_pct": "foreign_ownership_pct IS NOT NULL AND NOT foreign_ownership_pct BETWEEN 0 AND 100",
        "incomplete_details": _null("security_number", "local_shares", "foreign_shares"),
        "foreign_pct_mismatch": "abs(foreign_ownership_pct - CAST(foreign_shares AS DOUBLE) / nullif(security_number, 0) * 100) > 0.0001",
        "scripless_exceeds_securities": "local_shares + foreign_shares > security_number",
    },
    "trends": {
        "invalid_labels": "trend_label NOT IN ('ACCUMULATING', 'STABLE', 'DISTRIBUTING')",
        "invalid_strength": "signal_strength NOT BETWEEN 0 AND 100",
        "invalid_dates": "previous_as_of_date >= as_of_date", "invalid_days": "days_between_snapshots <= 0",
        "delta_pct_mismatch": "abs(delta_foreign_ownership_pp - (foreign_ownership_pct - previous_foreign_ownership_pct)) > 0.0001",
        "delta_shares_mismatch": "delta_foreign_shares <> foreign_shares - previous_foreign_shares",
        "security_delta_mismatch": "abs(delta_security_number_pct - CAST(security_number - previous_security_number AS DOUBLE) / previous_security_number * 100) > 0.0001",
        "normalized_change_mismatch": "abs(normalized_foreign_share_change_pct - CAST(delta_foreign_shares AS DOUBLE) / previous_security_number * 100) > 0.0001",
        "corporate_flag_mismatch": "corporate_action_risk IS DISTINCT FROM (abs(delta_security_number_pct) >= 1.0)",
        "gap_flag_mismatch": "snapshot_gap_flag IS DISTINCT FROM (days_between_snapshots > 45)",
    },
    "features": {
        "invalid_rsi": _outside(0, 100, "rsi14"), "invalid_atr": "atr14 < 0",
        "ema_without_history": "ema200 IS NOT NULL AND ema20 IS NULL",
    },
    "prices": {
        "invalid_ohlc": "least(open, high, low, close) <= 0 OR high < low OR high < open OR high < close OR low > open OR low > close",
        "weekend_rows": "is_weekend", "before_listing": "trading_date < listed_date", "negative_volume": "volume < 0",
    },
    "sensitivity": {
        "baseline_mismatch": "scenario = 'BASELINE_CONSERVATIVE' AND (abs(gross_r - stored_baseline_gross_r) > 0.0001 "
                             "OR abs(net_r - stored_baseline_net_r) > 0.0001 OR abs(total_drag_r - stored_baseline_drag_r) > 0.0001)",
        "invalid_risk_ticks": "raw_risk_ticks IS NULL OR raw_risk_ticks <= 0",
        "invalid_bucket": "price_bucket IS NULL OR risk_tick_bucket IS NULL",
    },
    "availability": {
        "unsafe_marked_safe": "point_in_time_safe AND availability_status <> 'KNOWN'",
        "known_without_time": "point_in_time_safe AND available_at IS NULL",
    },
}


def rule_counts(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """All rules in one pass: one row per rule with the number of bad rows."""
    counted = df.agg(*[F.count_if(F.expr(test)).alias(name) for name, test in rules.items()])
    pairs = F.array(*[F.struct(F.lit(name).alias("check_name"), F.col(name).alias("bad_rows")) for name in rules])
    return counted.select(F.explode(pairs).alias("p")).select("p.check_name", "p.bad_rows")


def coverage(df: DataFrame, key: str, date: str, after: Column | None = None) -> DataFrame:
    """Rows, distinct keys and dates, first and last date, optionally after a date."""
    rows = df if after is None else df.filter(F.col(date) > after)
    return rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("keys"), F.count_distinct(date).alias("dates"),
        F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def latest_state(df: DataFrame, date: str, key: str, group: str) -> DataFrame:
    """Last date with its row and distinct group counts, from one aggregate per date; with input times also the newest."""
    timed = when_updated(df, column="input_updated_at")
    times = [F.max("input_updated_at").alias("updated")] if timed else []
    daily = df.groupBy(date).agg(F.count(key).alias("rows"), F.count_distinct(group).alias("groups"), *times)
    out = daily.agg(F.max(F.struct(date, "rows", "groups")).alias("s"), *[F.max("updated").alias("newest_input_at") for _ in times])
    return out.select(
        F.col(f"s.{date}").alias("latest_date"), F.col("s.rows").alias("latest_rows"), F.col("s.groups").alias("latest_groups"),
        *["newest_input_at" for _ in times])


def latest_model(df: DataFrame, prefix: str, date: str) -> DataFrame:
    """Model version with the newest date among those with a prefix."""
    return df.filter(F.col("model_version").startswith(prefix)).groupBy("model_version").agg(
        F.max(date).alias("latest_date"), F.count(F.lit(1)).alias("rows")
    ).orderBy(F.col("latest_date").desc(), F.col("model_version").desc()).limit(1)


def signature(df: DataFrame, date: str, sector: str, as_of: str) -> DataFrame:
    """'sector:as-of date' of the latest date, by sector: changes when any input snapshot does."""
    latest = df.agg(F.max(date).alias("d")).select("d").scalar()
    part = F.concat_ws(":", sector, F.col(as_of).cast("string"))
    return df.filter(F.col(date) == latest).groupBy(date).agg(
        F.array_join(F.array_sort(F.collect_set(part)), ",").alias("signature"))


def distribution(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))


def orphans(df: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """Number of rows whose key the parent does not have."""
    return df.join(parent.select(*keys).distinct(), keys, "left_anti").agg(F.count(F.lit(1)).alias("orphan_rows"))


def missing_previous_close(bars: DataFrame) -> DataFrame:
    """Rows other than the first of an instrument without a previous close."""
    w = series()
    return bars.withColumn("_rn", F.row_number().over(w)).filter("_rn > 1 and previous_close is null").agg(
        F.count(F.lit(1)).alias("missing_previous"))


def gap_audit(bars: DataFrame, limit_days: int = 10) -> DataFrame:
    """Per series: median gap, long gaps, weekend rows, zero volume and previous-close mismatches."""
    w = series()
    rows = bars.withColumns({
        "_gap": F.datediff("trading_date", F.lag("trading_date").over(w)), "_before": F.lag("close").over(w),
        "_rn": F.row_number().over(w)})
    return rows.groupBy("instrument_id").agg(
        F.count(F.lit(1)).alias("bars"), F.median("_gap").alias("median_gap"),
        F.count_if(F.col("_gap") > limit_days).alias("long_gaps"), F.max("_gap").alias("longest_gap"),
        F.count_if(F.weekday("trading_date") >= 5).alias("weekend_rows"), F.count_if(F.col("volume") == 0).alias("zero_volume"),
        F.count_if((F.col("_rn") > 1) & ~F.col("previous_close").eqNullSafe(F.col("_before"))).alias("previous_mismatch"))


def technical_coverage(bars: DataFrame, features: DataFrame, build_bars: int = 15, screen_bars: int = 200) -> DataFrame:
    """How many instruments have features for every bar, too little history, or stale features."""
    both = bar_feature_coverage(bars, features)
    rows, fresh = F.col("price_rows"), F.col("up_to_date")
    return both.agg(
        F.count_if(rows >= build_bars).alias("eligible_instruments"), F.count_if(rows >= screen_bars).alias("screen_eligible"),
        F.count_if(rows < build_bars).alias("insufficient_history"), F.count("feature_rows").alias("feature_instruments"),
        F.count_if((rows >= build_bars) & fresh).alias("up_to_date"), F.count_if((rows >= build_bars) & ~fresh).alias("stale_or_missing"))


def bar_feature_coverage(bars: DataFrame, features: DataFrame) -> DataFrame:
    price = bars.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("price_rows"), F.max("trading_date").alias("last_price_date"))
    feature = features.groupBy("instrument_id").agg(
        F.count(F.lit(1)).alias("feature_rows"), F.max("trading_date").alias("last_feature_date"))
    same = (F.col("price_rows") == F.col("feature_rows")) & (F.col("last_price_date") == F.col("last_feature_date"))
    return price.join(feature, "instrument_id", "left").withColumn("up_to_date", F.coalesce(same, F.lit(False)))


def history_report(bars: DataFrame, instruments: DataFrame, target: Column) -> DataFrame:
    """Per instrument: bars, range and days short of the target end date."""
    counted = bars.groupBy("instrument_id").agg(
        F.count(F.lit(1)).alias("rows"), F.min("trading_date").alias("first_date"), F.max("trading_date").alias("last_date"))
    return instruments.select("instrument_id", "symbol").join(counted, "instrument_id", "left").select(
        "symbol", F.coalesce("rows", F.lit(0)).alias("rows"), "first_date", "last_date", F.datediff(target, "last_date").alias("gap_days"))


def reference_closes(bars: DataFrame, references: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Stored closes against official ones: PASS, FAIL or MISSING."""
    return references.join(bars.select("trading_date", "close"), "trading_date", "left").select(
        "trading_date", "official_close", "close",
        F.when(F.col("close").isNull(), "MISSING").when(F.abs(F.col("close") - F.col("official_close")) <= tolerance, "PASS")
        .otherwise("FAIL").alias("verdict"))


def scenario_coverage(rows: DataFrame, scenarios: list[str]) -> DataFrame:
    """Signals that do not have exactly one row for each scenario."""
    counted = rows.groupBy("signal_id").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("scenario").alias("scenarios"))
    return counted.filter((F.col("rows") != len(scenarios)) | (F.col("scenarios") != len(scenarios)))


def compare_counts(generated: DataFrame, stored: DataFrame, keys: list[str], exact: list[str], close: list[str]) -> DataFrame:
    """One row: how many generated rows, and how many keys are missing, unexpected or different."""
    found = compared(generated, stored, keys, exact, close)
    return found.agg(
        F.count_if("generated").alias("generated_rows"),
        *[F.count_if(F.col("issue") == i).alias(f"{i.lower()}_keys") for i in ("MISSING", "UNEXPECTED", "MISMATCH")])


def readiness(catalog: DataFrame, log: DataFrame, families: list[str]) -> DataFrame:
    """Latest probe per source; ready when every required family has a success."""
    last = latest_per_key(log, ["source_key"], "probed_at")
    joined = catalog.join(last.select("source_key", "success"), "source_key", "left")
    ok = F.coalesce("success", F.lit(False))
    out = joined.agg(
        F.count(F.lit(1)).alias("source_total"), F.count("success").alias("probes_present"), F.count_if(ok).alias("successful_probes"),
        *[F.coalesce(F.max(ok & (F.col("dataset_family") == f)), F.lit(False)).alias(f"{f.lower()}_reachable") for f in families])
    ready = F.lit(True)
    for f in families:
        ready = ready & F.col(f"{f.lower()}_reachable")
    return out.withColumn("ready_for_parser_work", ready)


def latest_per_key(log: DataFrame, keys: list[str], time: str) -> DataFrame:
    """Newest row of each key of an append-only log."""
    rest = [c for c in log.columns if c not in keys]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(time, *[c for c in rest if c != time])).alias("r")).select(*keys, "r.*")


def recent_dates(df: DataFrame, date: str, n: int) -> DataFrame:
    """The n most recent distinct dates."""
    return df.select(date).distinct().orderBy(F.col(date).desc()).limit(n)


def last_rows(df: DataFrame, n: int, keys="instrument_id", date="trading_date") -> DataFrame:
    """The last n rows of each key."""
    newest = Window.partitionBy(keys).orderBy(F.col(date).desc())
    return df.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= n).drop("_rn")


def bounded_validation(rows: DataFrame) -> DataFrame:
    """Row counts of a bounded lifecycle load, and what must be zero: safe, known, overlapping."""
    counts = rows.agg(
        F.count(F.lit(1)).alias("lifecycle_rows"), F.count_if(F.col("membership_status") == "ACTIVE").alias("active_rows"),
        F.count_if(F.col("membership_status") == "INACTIVE").alias("inactive_rows"), F.count_if("point_in_time_safe").alias("point_in_time_true"),
        F.count_if(F.col("availability_status") != "UNKNOWN").alias("availability_known"))
    crossed = overlapping(rows, ["symbol"], "effective_from", "effective_to", "lifecycle_status").agg(
        F.count(F.lit(1)).alias("overlapping_rows"))
    return counts.withColumn("_k", F.lit(1)).join(crossed.withColumn("_k", F.lit(1)), "_k").drop("_k")
