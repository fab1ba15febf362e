"""Bar validation, landed bar payloads and previous-close rebuild."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import none_of, reasons
from tidemark.operators.keyed import first_per_key
from tidemark.operators.windows import series
from tidemark.session import Workspace
from tidemark.sources.sinks import merge_table


def is_weekend(date_column: str):
    return F.weekday(date_column) >= 5


def validate_index_bars(bars: DataFrame) -> DataFrame:
    """Add the list of reasons and the VALID / REJECTED status."""
    prices = [F.col(c) for c in ("open", "high", "low", "close")]
    checked = reasons(
        ("Trading date falls on a weekend.", is_weekend("trading_date")),
        ("OHLC contains zero or negative price.", F.least(*prices) <= 0),
        ("High is lower than another OHLC value.", F.col("high") < F.greatest(*prices)),
        ("Low is higher than another OHLC value.", F.col("low") > F.least(*prices)),
        ("Adjusted close is zero or negative.", F.col("adjusted_close") <= 0),
        ("Volume is negative.", F.col("volume") < 0),
    )
    return bars.withColumn("reasons", checked).withColumn(
        "quality", F.when(F.size("reasons") == 0, "VALID").otherwise("REJECTED")
    )


def _equity_checks(listed_date: str | None, target_end: str | None) -> list[tuple[str, Column]]:
    o, h, l, c = (F.col(x) for x in ("open", "high", "low", "close"))
    day = F.col("trading_date")
    checks = [("WEEKEND_BAR", is_weekend("trading_date"))]
    if listed_date:
        checks.append(("BEFORE_LISTING_DATE", day < F.col(listed_date)))
    if target_end:
        checks.append(("AFTER_TARGET_END_DATE", day > F.col(target_end)))
    return checks + [
        ("NON_POSITIVE_OPEN", o <= 0), ("NON_POSITIVE_HIGH", h <= 0),
        ("NON_POSITIVE_LOW", l <= 0), ("NON_POSITIVE_CLOSE", c <= 0),
        ("HIGH_BELOW_LOW", h < l), ("HIGH_BELOW_OPEN", h < o), ("HIGH_BELOW_CLOSE", h < c),
        ("LOW_ABOVE_OPEN", l > o), ("LOW_ABOVE_CLOSE", l > c),
        ("NEGATIVE_VOLUME", F.col("volume") < 0),
    ]


def validate_equity_bars(bars: DataFrame, listed_date: str | None = None,
                         target_end: str | None = None) -> DataFrame:
    """Add ``reasons``; an empty list marks a valid bar."""
    return bars.withColumn("reasons", reasons(*_equity_checks(listed_date, target_end)))


def valid_equity_bars(bars: DataFrame, listed_date: str | None = None, target_end: str | None = None) -> DataFrame:
    """The bars whose ``reasons`` are empty."""
    return bars.filter(none_of(*_equity_checks(listed_date, target_end)))


def accepted_bars(bars: DataFrame, keys: list[str], order: list, listed_date: str | None = None,
                  target_end: str | None = None) -> DataFrame:
    """First bar per key if it is valid; a rejected first bar hides its copies."""
    first = first_per_key(bars, keys, order)
    return valid_equity_bars(first, listed_date, target_end)


def rejection_counts(bars: DataFrame, keys: list[str], order: list, listed_date: str | None = None,
                     target_end: str | None = None) -> DataFrame:
    """Rejected bars by reason, later copies of a key as DUPLICATE_DATE."""
    sizes = bars.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    copies = sizes.agg(
        F.lit("DUPLICATE_DATE").alias("reason"), F.sum(F.col("_n") - 1).alias("bars")
    ).filter("bars > 0")
    checked = validate_equity_bars(first_per_key(bars, keys, order), listed_date, target_end)
    by_reason = checked.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(
        F.count(F.lit(1)).alias("bars")
    )
    return by_reason.unionByName(copies)


def with_previous_close(bars: DataFrame, keys: list[str] = ("instrument_id",)) -> DataFrame:
    return bars.withColumn("previous_close", F.lag("close").over(series(list(keys))))


def previous_close_changes(stored: DataFrame, incoming: DataFrame, keys: list[str] = ("instrument_id",), time: str = "trading_date") -> DataFrame:
    """Incoming bars with their previous close, and the stored bars whose previous close they change, whole.

    Only series that incoming bars touch are ordered, and only by key and close; a late or corrected bar changes itself and the
    bar after it.
    """
    keys, names = list(keys), incoming.columns
    new = incoming.select(*keys, time, F.col("close").alias("_close"))
    old = stored.join(new.select(*keys).distinct(), keys, "left_semi").select(*keys, time, "close", F.col("previous_close").alias("_before"), F.lit(True).alias("_old"))
    both = old.join(new, [*keys, time], "full_outer")
    now = F.lag(F.coalesce("_close", "close")).over(series(keys, time))
    moved = both.withColumn("_now", now).filter(F.col("_close").isNotNull() | ~F.col("_now").eqNullSafe(F.col("_before")))
    moved = moved.select(*keys, time, F.col("_now").alias("previous_close"), F.col("_close").isNotNull().alias("_new"))
    own = incoming.drop("previous_close").join(moved.filter("_new").drop("_new"), [*keys, time])
    after = stored.drop("previous_close").join(moved.filter("not _new").drop("_new"), [*keys, time])
    out = [*[c for c in names if c != "previous_close"], "previous_close"]
    return own.select(*out).unionByName(after.select(*out))


def load_bars(spark: SparkSession, ws: Workspace, path: str, payloads: DataFrame, instruments: DataFrame, partitions: list[str],
              partition_values: dict[str, Column], target_end: Column) -> DataFrame:
    """Load landed payloads into a table of bars partitioned by ``partitions``; returns rejected bars by reason.

    Payloads are parsed to bars (the position in the payload is the order of arrival), bars without a price are left out, and the instrument of the
    symbol is looked up (unknown ones are left out). The first bar of an instrument and date counts, if it is valid and between
    the listing date of ``instruments`` (instrument_id, symbol, listed_date) and ``target_end``. Accepted bars replace stored
    ones, previous closes are repaired, and only partitions that hold a changed bar are rewritten.
    """
    keys = ["instrument_id", "trading_date"]
    parsed = complete_bars(parse_bar_payloads(payloads)).join(instruments, "symbol").withColumn("target_end", target_end)
    landed = ws.write(parsed, "landed")
    order = [F.col("bar_index")]
    columns = [*keys, "open", "high", "low", "close", "volume"]
    accepted = accepted_bars(landed, keys, order, "listed_date", "target_end").select(*columns).withColumns(partition_values)
    accepted = ws.write(accepted, "accepted")
    stored = spark.read.parquet(path)
    merge_table(spark, ws, path, previous_close_changes(stored, accepted), [*keys, *partitions], partitions)
    return rejection_counts(landed, keys, order, "listed_date", "target_end")


BAR_PAYLOAD = (
    "struct<symbol:string,granularity:string,timestamp:array<bigint>,"
    "open:array<double>,high:array<double>,low:array<double>,close:array<double>,"
    "volume:array<double>,adjclose:array<double>>"
)


def parse_bar_payloads(payloads: DataFrame, body: str = "body", index: bool = False,
                       zone: str = "Asia/Jakarta") -> DataFrame:
    """Parallel arrays to one row per bar.

    Index payloads take the date in the market's zone and fall back to the
    close when the adjusted close is absent; equity payloads use the UTC date.
    """
    parsed = payloads.withColumn("_p", F.from_json(body, BAR_PAYLOAD))
    zipped = F.arrays_zip(*[F.col(f"_p.{c}").alias(c) for c in (
        "timestamp", "open", "high", "low", "close", "volume", "adjclose")])
    rows = parsed.select(
        F.col("_p.symbol").alias("symbol"), F.col("_p.granularity").alias("granularity"),
        F.posexplode(zipped).alias("bar_index", "b"),
    )
    # zone-less arithmetic, so the session's own time zone plays no part
    utc = F.expr("timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, b.timestamp)")
    when = F.convert_timezone(F.lit("UTC"), F.lit(zone), utc) if index else utc
    adjusted = F.coalesce(F.col("b.adjclose"), F.col("b.close")) if index else F.col("b.adjclose")
    return rows.select(
        "symbol", "granularity", "bar_index", F.to_date(when).alias("trading_date"),
        "b.open", "b.high", "b.low", "b.close", "b.volume", adjusted.alias("adjusted_close"),
    )


def complete_bars(rows: DataFrame) -> DataFrame:
    return rows.dropna(subset=["open", "high", "low", "close"])


def payload_summary(rows: DataFrame) -> DataFrame:
    """Per symbol: bars, bars dropped for a missing price, and the granularity guard."""
    missing = F.greatest(*[F.col(c).isNull().cast("int") for c in ("open", "high", "low", "close")])
    w = Window.partitionBy("symbol").orderBy("trading_date", "bar_index")
    gaps = rows.withColumn("gap", F.datediff("trading_date", F.lag("trading_date").over(w)))
    summary = gaps.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("bars"),
        F.sum(missing).alias("dropped_bars"),
        F.median("gap").alias("median_gap_days"),
        F.min(F.col("granularity") == "1d").alias("daily_declared"),
    )
    daily = F.col("daily_declared") & (F.coalesce(F.col("median_gap_days"), F.lit(0.0)) <= 7)
    return summary.withColumn("accepted", daily)
