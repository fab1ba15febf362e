"""Point-in-time availability, current membership, boards and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import rnd, written_as

# Board names as they are written, by board.
BOARD_NAMES = {
    "MAIN": ["utama", "papan utama", "main", "main board"],
    "DEVELOPMENT": ["pengembangan", "papan pengembangan", "development", "development board"],
    "NEW_ECONOMY": ["ekonomi baru", "papan ekonomi baru", "new economy", "new economy board"],
    "ACCELERATION": ["akselerasi", "papan akselerasi", "acceleration", "acceleration board"],
    "WATCHLIST": ["pemantauan khusus", "papan pemantauan khusus", "watchlist", "watchlist board"],
}
AVAILABILITY_RANK = {"KNOWN": 3, "ESTIMATED": 2, "UNKNOWN": 1}


def observation_key(*parts) -> Column:
    """Non-blank trimmed parts joined by a bar; NULL when nothing is left."""
    kept = [F.nullif(F.trim(F.col(p).cast("string") if isinstance(p, str) else p.cast("string")), F.lit("")) for p in parts]
    return F.nullif(F.concat_ws("|", *kept), F.lit(""))


def availability(df: DataFrame) -> DataFrame:
    """Decision per row from availability_status, published_at and available_at."""
    status, at = F.col("availability_status"), F.col("available_at")
    reason = (
        F.when(F.col("available_at") < F.col("published_at"), F.raise_error(F.lit("available_at cannot be before published_at")))
        .when(status == "UNKNOWN", "AVAILABILITY_UNKNOWN").when(at.isNull(), "AVAILABLE_AT_MISSING")
        .when(status == "ESTIMATED", "AVAILABILITY_ESTIMATED").otherwise("KNOWN_AVAILABLE_AT"))
    return df.withColumn("reason", reason).withColumn("point_in_time_safe", F.col("reason") == "KNOWN_AVAILABLE_AT")


def available_on(signal_date: str) -> Column:
    return F.coalesce(F.col("point_in_time_safe") & (F.to_date("available_at") <= F.col(signal_date)), F.lit(False))


def membership_active(signal_date: str) -> Column:
    day = F.col(signal_date)
    return (
        F.col("point_in_time_safe") & (F.col("membership_status") == "ACTIVE") & (day >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (day <= F.col("valid_to"))))


def pit_coverage(rows: DataFrame, groups: list[str] = ()) -> DataFrame:
    def status(name: str) -> Column:
        return F.count_if(F.col("availability_status") == name).alias(name.lower())

    safe, total = F.count_if("point_in_time_safe"), F.count(F.lit(1))
    return rows.groupBy(*groups).agg(
        total.alias("total"), status("KNOWN"), status("UNKNOWN"), status("ESTIMATED"), safe.alias("safe"),
        F.when(total > 0, rnd(safe / total, 8)).alias("coverage_ratio"))


def ownership_observations(snapshots: DataFrame) -> DataFrame:
    """Rows, ingest range and distinct archives per snapshot date."""
    return snapshots.groupBy("as_of_date").agg(
        F.count(F.lit(1)).alias("rows"), F.min("ingested_at").alias("first_ingested_at"),
        F.max("ingested_at").alias("last_ingested_at"),
        F.array_join(F.array_sort(F.collect_set(F.col("holder_details.archive_name"))), ",").alias("archives"))


def unknown_availability(observations: DataFrame, dataset: str, source: str) -> DataFrame:
    """Ledger rows without any timestamp: none is made up."""
    return availability(observations.select(
        F.lit(dataset).alias("dataset_code"), observation_key(F.lit(source), F.col("as_of_date")).alias("observation_key"),
        F.col("as_of_date").alias("observation_date"), F.lit(None).cast("timestamp").alias("published_at"),
        F.lit(None).cast("timestamp").alias("available_at"), F.lit("UNKNOWN").alias("availability_status"),
        F.lit(source).alias("source_code"), F.col("archives").alias("source_reference")))


def known_availability(observations: DataFrame, dataset: str, source: str, date: str, seen_at: str) -> DataFrame:
    """Ledger rows available from the time the system saw them."""
    return availability(observations.select(
        F.lit(dataset).alias("dataset_code"), observation_key(F.lit(source), F.col(date)).alias("observation_key"),
        F.col(date).alias("observation_date"), F.lit(None).cast("timestamp").alias("published_at"),
        F.col(seen_at).alias("available_at"), F.lit("KNOWN").alias("availability_status"),
        F.lit(source).alias("source_code"), F.lit(None).cast("string").alias("source_reference"),
    )).withColumn("reason", F.lit("SYSTEM_OBSERVED_AT"))


def current_membership(snapshot: DataFrame, universe: str, source: str) -> DataFrame:
    """Members from the snapshot date on, never earlier."""
    seen = F.col("ingested_at").isNotNull()
    return snapshot.select(
        "instrument_id", "symbol", F.lit(universe).alias("universe_code"), F.col("snapshot_date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"), F.lit("ACTIVE").alias("membership_status"), F.lit(source).alias("source_code"),
        F.col("ingested_at").alias("available_at"), F.when(seen, "KNOWN").otherwise("UNKNOWN").alias("availability_status"),
        seen.alias("point_in_time_safe"))


def current_lifecycle(snapshot: DataFrame, source: str) -> DataFrame:
    gone = F.coalesce(F.col("delisted_date") <= F.col("snapshot_date"), F.lit(False))
    return snapshot.select(
        "instrument_id", "symbol", F.col("snapshot_date").alias("effective_from"), F.lit(None).cast("date").alias("effective_to"),
        F.when(gone, "DELISTED").otherwise("LISTED").alias("lifecycle_status"), F.col("listed_date").alias("listing_date"),
        F.col("delisted_date").alias("delisting_date"), F.lit(source).alias("source_code"), F.col("ingested_at").alias("available_at"),
        F.when(F.col("ingested_at").isNotNull(), "KNOWN").otherwise("UNKNOWN").alias("availability_status"), F.lit("VALID").alias("quality"))


def board_code(raw: str) -> Column:
    """Board of a written name, whatever its case, spacing, dashes or underscores."""
    clean = F.trim(F.regexp_replace(F.translate(F.lower(F.trim(raw)), "_-", "  "), r"\s+", " "))
    return F.coalesce(written_as(clean, BOARD_NAMES), F.lit("UNKNOWN"))


def board_group(code: Column) -> Column:
    return (
        F.when(code.isin("MAIN", "DEVELOPMENT", "NEW_ECONOMY"), "MAIN_DEV_NEW")
        .when(code.isin("ACCELERATION", "WATCHLIST"), "ACCEL_WATCH").otherwise("UNKNOWN"))


def current_boards(snapshot: DataFrame, source: str) -> DataFrame:
    """Board rows from the snapshot date; safe only if seen and recognised."""
    rows = snapshot.withColumn("board_code", board_code("listing_board"))
    seen = F.col("ingested_at").isNotNull()
    return rows.select(
        "instrument_id", "symbol", F.col("snapshot_date").alias("effective_from"), F.lit(None).cast("date").alias("effective_to"),
        "board_code", board_group(F.col("board_code")).alias("board_group"), F.col("listing_board").alias("raw_board_name"),
        F.lit(source).alias("source_code"), F.col("ingested_at").alias("available_at"),
        F.when(seen, "KNOWN").otherwise("UNKNOWN").alias("availability_status"),
        (seen & (F.col("board_code") != "UNKNOWN")).alias("point_in_time_safe"))


def dataset_coverage(rows: DataFrame, dataset: str, dates: list[str], complete: bool, blocking: str | None) -> DataFrame:
    """Coverage state of one dataset: row count and range of the first known date of each row."""
    first = F.coalesce(*dates) if len(dates) > 1 else F.col(dates[0])
    return rows.agg(
        F.lit(dataset).alias("dataset_code"), F.count(F.lit(1)).alias("total_rows"), F.count(first).alias("dated_rows"),
        F.min(first).alias("first_date"), F.max(first).alias("last_date"),
    ).withColumns({"history_complete": F.lit(complete), "blocking_reason": F.lit(blocking).cast("string")})


def trading_calendar(observed: DataFrame, spark) -> DataFrame:
    """Every day from the first to the last observed one: observed, weekend or unverified weekday."""
    start, end = (observed.agg(f("trading_date").alias("d")).select("d").scalar() for f in (F.min, F.max))
    days = spark.range(1).select(F.explode(F.sequence(start, end)).alias("trading_date"))
    seen = observed.select("trading_date").distinct().withColumn("_seen", F.lit(True))
    kind = (
        F.when(F.col("_seen"), "OBSERVED_TRADING").when(F.weekday("trading_date") >= 5, "WEEKEND").otherwise("UNVERIFIED_NON_TRADING"))
    return days.join(seen, "trading_date", "left").select(
        "trading_date", F.col("_seen").isNotNull().alias("is_trading_day"), kind.alias("day_type"), F.lit(False).alias("verified"))
