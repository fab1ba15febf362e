"""Dated price-band rules: lot, tick and auto-rejection lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RULE_SCHEMA = (
    "rule_key string, rule_type string, board_group string, effective_from date, effective_to date, "
    "price_min double, price_min_inclusive boolean, price_max double, price_max_inclusive boolean, "
    "lot_size int, tick_size double, ara_pct double, arb_pct double, ara_absolute double, arb_absolute double"
)

# A rule table is a small dimension; a longer one is refused, never cut.
MOST_RULES = 10_000

#: The seeded lot, tick and auto-rejection rules, in the order of RULE_SCHEMA.
SEEDED = [
    ("LOT_REGULAR_CASH_20140106_100", "LOT_SIZE", "ALL", "2014-01-06", None, None, None, None, None, 100, None, None, None, None, None),
    ("TICK_LT_200_20160502", "TICK_SIZE", "ALL", "2016-05-02", None, None, None, 200.0, False, None, 1.0, None, None, None, None),
    ("TICK_200_TO_LT_500_20160502", "TICK_SIZE", "ALL", "2016-05-02", None, 200.0, True, 500.0, False, None, 2.0, None, None, None, None),
    ("TICK_500_TO_LT_2000_20160502", "TICK_SIZE", "ALL", "2016-05-02", None, 500.0, True, 2000.0, False, None, 5.0, None, None, None, None),
    ("TICK_2000_TO_LT_5000_20160502", "TICK_SIZE", "ALL", "2016-05-02", None, 2000.0, True, 5000.0, False, None, 10.0, None, None, None, None),
    ("TICK_GE_5000_20160502", "TICK_SIZE", "ALL", "2016-05-02", None, 5000.0, True, None, None, None, 25.0, None, None, None, None),
    ("AR_MAIN_DEV_NEW_50_TO_200_20250408", "AUTO_REJECTION", "MAIN_DEV_NEW", "2025-04-08", None, 50.0, True, 200.0, True, None, None, 0.35, 0.15, None, None),
    ("AR_MAIN_DEV_NEW_GT_200_TO_5000_20250408", "AUTO_REJECTION", "MAIN_DEV_NEW", "2025-04-08", None, 200.0, False, 5000.0, True, None, None, 0.25, 0.15, None, None),
    ("AR_MAIN_DEV_NEW_GT_5000_20250408", "AUTO_REJECTION", "MAIN_DEV_NEW", "2025-04-08", None, 5000.0, False, None, None, None, None, 0.20, 0.15, None, None),
    ("AR_ACCEL_WATCH_1_TO_10_20250408", "AUTO_REJECTION", "ACCEL_WATCH", "2025-04-08", None, 1.0, True, 10.0, True, None, None, None, None, 1.0, 1.0),
    ("AR_ACCEL_WATCH_GT_10_20250408", "AUTO_REJECTION", "ACCEL_WATCH", "2025-04-08", None, 10.0, False, None, None, None, None, 0.10, 0.10, None, None),
]


def seed_rules(spark: SparkSession) -> DataFrame:
    return inline_table(spark, SEEDED, RULE_SCHEMA)


def inline_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few fixed rows as an inline SQL table, so the planner knows their exact size."""
    fields = [f.strip().split() for f in schema.split(",")]

    def literal(value, kind: str) -> str:
        if value is None:
            return f"CAST(NULL AS {kind})"
        return f"CAST('{value}' AS {kind})" if isinstance(value, str) else f"CAST({value} AS {kind})"

    listed = ", ".join("(" + ", ".join(literal(v, kind) for v, (_, kind) in zip(row, fields)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {listed} AS t({', '.join(name for name, _ in fields)})")


def applies(rule, date: Column, price: Column | None, group: Column | None) -> Column:
    """Active on the date, inside the band (each bound with its own inclusiveness), for the group."""
    ok = (rule["effective_from"] <= date) & (rule["effective_to"].isNull() | (date <= rule["effective_to"]))
    if price is not None:
        above = F.when(rule["price_min_inclusive"], price >= rule["price_min"]).otherwise(price > rule["price_min"])
        below = F.when(rule["price_max_inclusive"], price <= rule["price_max"]).otherwise(price < rule["price_max"])
        ok = ok & (rule["price_min"].isNull() | above) & (rule["price_max"].isNull() | below)
    if group is not None:
        ok = ok & (rule["board_group"] == group)
    return ok


def lookup(df: DataFrame, rules: DataFrame, rule_type: str, keys: list[str], date: str,
           price: str | None = None, group: str | None = None, values: list[str] = ("rule_key",)) -> DataFrame:
    """Rows with the values of the newest rule that applies, NULL where none does.

    The rules of the type are one array, evaluated inside the projection: no join, no shuffle, no job while the
    plan is made, and a row that repeats its keys is a row of its own. Of several rules with the newest date
    the first by ``rule_key`` gives the values and ``rule_conflict`` is true. More than ``MOST_RULES`` rules of a type stop the query.
    """
    when, at, of = F.col(date), F.col(price) if price else None, F.col(group) if group else None
    fields = [c.strip().split()[0] for c in RULE_SCHEMA.split(",")]
    listed = F.array_sort(F.collect_list(F.struct(*fields)))  # by rule_key
    checked = F.when(F.count(F.lit(1)) > MOST_RULES, F.raise_error(F.lit(f"more than {MOST_RULES} rules")).cast("string"))
    packed = rules.filter(F.col("rule_type") == rule_type).limit(MOST_RULES + 1).agg(
        listed.alias("_rules"), checked.alias("_checked")).filter("_checked is null").select("_rules").scalar()
    out = df.withColumn("_rules", packed)
    out = out.withColumn("_found", F.filter("_rules", lambda r: applies(r, when, at, of)))
    newest = F.array_max(F.transform("_found", lambda r: r["effective_from"]))
    out = out.withColumn("_newest", newest)
    out = out.withColumn("_same", F.filter("_found", lambda r: r["effective_from"] == F.col("_newest")))
    return out.withColumns({v: F.try_element_at("_same", F.lit(1))[v] for v in values}).withColumn(
        "rule_conflict", F.size("_same") > 1).drop("_rules", "_found", "_newest", "_same")


def require_unambiguous(df: DataFrame) -> DataFrame:
    """Stop the job at the first row with conflicting rules."""
    ok = F.when(F.col("rule_conflict"), F.raise_error(F.lit("Ambiguous rules")).cast("boolean")).otherwise(F.lit(True))
    return df.filter(ok).drop("rule_conflict")
