"""Registered queries of loads, published builds and deletes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.catalog import register
from tidemark.functions.numeric import rnd
from tidemark.oracle.ctes import r
from tidemark.plans import features, incremental, quality
from tidemark.plans.builds import run_build
from tidemark.sources import bars as bar_ops
from tidemark.sources import sinks
from tidemark.sources.versions import Published

KEY = ["instrument_id", "trading_date"]
BAR = [*KEY, "open", "high", "low", "close", "volume", "previous_close"]
_LATE = "(instrument_id + day(trading_date)) % 11 = 0"
_WRONG = "(instrument_id + day(trading_date)) % 13 = 0"


def _year() -> dict:
    return {"year": F.year("trading_date")}


def _folder(p, name: str) -> str:
    return f"{p.ws.root}/{name}-{uuid.uuid4().hex[:8]}"


def _payloads(p) -> DataFrame:
    """One landed document per instrument: late and corrected bars, then a repeat of the first, an unlisted, a future and an unpriced bar."""
    wanted = p.bars.filter(f"{_LATE} OR {_WRONG}").join(p.instruments.select("instrument_id", "symbol"), "instrument_id")
    fields = ["timestamp", "open", "high", "low", "close", "volume"]
    rows = wanted.select("symbol", F.struct(
        (F.unix_date("trading_date") * 86400 + 7200).cast("long").alias("timestamp"), "open", "high", "low", "close", "volume").alias("b"))
    listed = rows.groupBy("symbol").agg(F.sort_array(F.collect_list("b")).alias("b"))  # at most one calendar of bars

    def bar(day: str, **changes: float | None):
        values = {"open": 10.0, "high": 12.0, "low": 9.0, "close": 11.0, "volume": 5.0} | changes
        return F.struct(F.lit(_seconds(day)).alias("timestamp"), *[F.lit(values[c]).cast("double").alias(c) for c in fields[1:]])

    first = F.element_at("b", 1).withField("close", F.element_at("b", 1)["close"] * 2.0)
    added = F.concat("b", F.array(first, bar("1994-06-01"), bar("2002-06-03", high=1.0), bar("2002-06-04", close=None)))
    documents = listed.select("symbol", F.lit("1d").alias("granularity"), added.alias("b"))
    arrays = [F.col(f"b.{c}").alias(c) for c in fields]  # a field of an array of rows is the array of the field
    return documents.select(F.to_json(F.struct("symbol", "granularity", *arrays, F.col("b.close").alias("adjclose"))).alias("body"))


def _seconds(day: str) -> int:
    from datetime import datetime, timezone

    return int(datetime.fromisoformat(day).replace(tzinfo=timezone.utc).timestamp())


def _loaded(p) -> tuple[DataFrame, DataFrame]:
    """A table without the late bars and with wrong closes, after the payloads are loaded; and what was rejected."""
    path = _folder(p, "bars-table")
    before = p.bars.filter(f"NOT {_LATE}").withColumn("close", F.when(F.expr(_WRONG), F.col("close") + 1.0).otherwise(F.col("close")))
    before = bar_ops.with_previous_close(before.drop("previous_close")).select(*BAR).withColumns(_year())
    before.write.partitionBy("year").parquet(path)
    names = p.instruments.select("instrument_id", "symbol", F.lit("1995-01-01").cast("date").alias("listed_date"))
    last = p.bars.agg(F.max("trading_date").alias("d")).first()["d"]
    rejected = bar_ops.load_bars(p.spark, p.ws, path, _payloads(p), names, ["year"], _year(), F.lit(last))
    return p.spark.read.parquet(path).select(*BAR), rejected


register("bar_load", lambda p: _loaded(p)[0], f"SELECT {', '.join(BAR)} FROM bars")
register("bar_load_rejections", lambda p: _loaded(p)[1], f"""
SELECT reason, CAST(n * times AS BIGINT) AS bars FROM (SELECT count(DISTINCT instrument_id) AS n FROM bars WHERE {_LATE} OR {_WRONG}),
  (VALUES ('DUPLICATE_DATE', 1), ('BEFORE_LISTING_DATE', 1), ('AFTER_TARGET_END_DATE', 1), ('HIGH_BELOW_LOW', 1), ('HIGH_BELOW_OPEN', 1), ('HIGH_BELOW_CLOSE', 1)) v(reason, times)""")


def _builds(p) -> DataFrame:
    """A rotation table brought up step by step; after each step, what a reader finds."""
    table = Published(p.spark, _folder(p, "rotation"))
    cut = p.bars.agg(F.date_sub(F.max("trading_date"), 120).alias("d")).first()["d"]
    model = p.rotation.select("model_version").first()["model_version"]
    part, full = p.rotation.filter(F.col("trading_date") <= F.lit(cut)), p.rotation
    late = full.withColumn("updated_at", F.when(F.col("trading_date") <= F.lit(cut), F.col("updated_at") + F.expr("interval 200 days")).otherwise(F.col("updated_at")))

    def fresh(after):
        return incremental.rotation_after(p.features, p.index_features, table.read(), F.lit(after), model)

    def thin(after):
        return fresh(after).filter("sector_code <> 'ASIA'")

    steps = [("first", part, lambda: part, None), ("again", part, lambda: part, None), ("thin", full, lambda: full, thin),
             ("grown", full, lambda: full, fresh), ("late", late, lambda: late, fresh), ("settled", late, lambda: late, fresh)]
    out = None
    for number, (name, keys, all_rows, rows_after) in enumerate(steps, 1):
        try:
            mode = run_build(table, incremental.TRADE_SETUP, keys.select("trading_date", "updated_at"), model, all_rows, rows_after, lineage=(keys,)).mode
        except ValueError:
            mode = "REJECTED"
        found = table.read().agg(
            F.count(F.lit(1)).alias("rows"), F.max("trading_date").alias("last_date"), F.sum("eligible_count").alias("eligible"),
            F.count("score_change_20d").alias("changes"))
        row = found.select(F.lit(number).alias("step"), F.lit(name).alias("name"), F.lit(mode).alias("mode"),
                           F.lit(table.current()["version"]).cast("long").alias("version"), "*")
        out = row if out is None else out.unionByName(row)
    return out


register("build_state", _builds, """
SELECT CAST(step AS INTEGER) AS step, name, mode, CAST(version AS BIGINT) AS version, count(*) AS rows, max(trading_date) AS last_date,
  CAST(sum(eligible_count) AS BIGINT) AS eligible, count(score_change_20d) AS changes
FROM (VALUES (1, 'first', 'FULL', 1, 120), (2, 'again', 'UP_TO_DATE', 1, 120), (3, 'thin', 'REJECTED', 1, 120), (4, 'grown', 'INCREMENTAL', 2, 0),
             (5, 'late', 'FULL', 3, 0), (6, 'settled', 'UP_TO_DATE', 3, 0)) v(step, name, mode, version, days)
CROSS JOIN rotation WHERE trading_date <= (SELECT max(trading_date) FROM bars) - days GROUP BY ALL""")


_REBUILT = ["instrument_id", "trading_date", "close", "return_20d", "ema200", "rsi14"]
_BUCKETS = 16


def _rebuilt(p) -> DataFrame:
    """A features table that lost the newest rows of three instruments, after those are found and rebuilt; whether a row's file is a new one."""
    path = _folder(p, "features-table")
    bucket = {"bucket": F.pmod("instrument_id", F.lit(_BUCKETS))}
    cut = p.bars.agg(F.date_sub(F.max("trading_date"), 120).alias("d")).select("d").scalar()
    third = p.bars.select("instrument_id").distinct().orderBy("instrument_id").limit(3).agg(F.max("instrument_id").alias("i")).select("i").scalar()
    whole = p.features.select(*_REBUILT).withColumns(bucket)
    whole.filter((F.col("instrument_id") > third) | (F.col("trading_date") <= cut)).write.partitionBy("bucket").parquet(path)
    before = p.ws.write(p.spark.read.parquet(path).select(F.col("_metadata.file_name").alias("file")).distinct(), "files")
    coverage = quality.bar_feature_coverage(p.bars, p.spark.read.parquet(path))
    stale = p.ws.write(coverage.filter("not up_to_date").select("instrument_id").withColumns(bucket), "stale-instruments")
    fresh = features.technical_features(p.bars.join(stale.select("instrument_id"), "instrument_id", "left_semi"))
    sinks.rebuild_keys(p.spark, p.ws, path, stale, fresh.withColumns(bucket), "instrument_id", "bucket")
    now = p.spark.read.parquet(path).select(*_REBUILT[:4], rnd("ema200", 4).alias("ema200"), rnd("rsi14", 4).alias("rsi14"), F.col("_metadata.file_name").alias("file"))
    return now.join(before.withColumn("_old", F.lit(True)), "file", "left").withColumn("rewritten", F.col("_old").isNull()).drop("file", "_old")


register("stale_rebuild", _rebuilt, f"""
SELECT instrument_id, trading_date, close, return_20d, {r("ema200", 4)} AS ema200, {r("rsi14", 4)} AS rsi14, instrument_id % {_BUCKETS} IN (
  SELECT instrument_id % {_BUCKETS} FROM bars WHERE instrument_id <= (SELECT max(instrument_id) FROM (SELECT DISTINCT instrument_id FROM bars ORDER BY 1 LIMIT 3))
    AND trading_date > (SELECT max(trading_date) - 120 FROM bars)) AS rewritten FROM features""")


def _exported(p) -> DataFrame:
    path = _folder(p, "rotation-json")
    rows = p.rotation.select("trading_date", "sector_code", "score", "rotation_label", "score_change_20d")
    sinks.export_json(rows, path)
    return p.spark.read.schema(rows.schema).json(path)


register("rotation_export", _exported, "SELECT trading_date, sector_code, score, rotation_label, score_change_20d FROM rotation")


def _days_without_bars(p) -> DataFrame:
    """Trading days between an instrument's first and last bar on which it has none, from positions in the calendar."""
    days = p.index_bars.select("trading_date").withColumn("at", F.row_number().over(Window.orderBy("trading_date")))  # as long as the calendar
    spans = p.bars.groupBy("instrument_id").agg(F.min("trading_date").alias("first"), F.max("trading_date").alias("last"), F.count(F.lit(1)).alias("bars"))
    placed = spans.join(days.toDF("first", "a"), "first").join(days.toDF("last", "b"), "last")
    return placed.select("instrument_id", "bars", (F.col("b") - F.col("a") + 1 - F.col("bars")).alias("missing_days"))


register("days_without_bars", _days_without_bars, """
SELECT instrument_id, bars, (SELECT count(*) FROM index_bars c WHERE c.trading_date BETWEEN s.a AND s.b) - bars AS missing_days
FROM (SELECT instrument_id, min(trading_date) AS a, max(trading_date) AS b, count(*) AS bars FROM bars GROUP BY 1) s""")


def _deleted(p) -> DataFrame:
    """Rows of each model after one of three is dropped, and how many of its files are those written before."""
    path = _folder(p, "models")
    model = F.concat(F.lit("rotation_v"), (F.dayofmonth("trading_date") % 3 + 1).cast("string"))
    p.rotation.withColumn("model_version", model).write.partitionBy("model_version").parquet(path)

    def files():
        return p.spark.read.parquet(path).groupBy("model_version", F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("n"))

    before = p.ws.write(files(), "files")
    sinks.delete_partitions(p.spark, path, F.col("model_version") == "rotation_v2", ["model_version"])
    after = files().join(before.select("model_version", "file", F.col("n").alias("_before")), ["model_version", "file"], "left")
    return after.groupBy("model_version").agg(F.sum("n").alias("rows"), F.min(F.col("n").eqNullSafe(F.col("_before"))).alias("files_untouched"))


register("model_delete", _deleted, """
SELECT 'rotation_v' || (day(trading_date) % 3 + 1) AS model_version, count(*) AS rows, true AS files_untouched FROM rotation WHERE day(trading_date) % 3 <> 1 GROUP BY 1""")
