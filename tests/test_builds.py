"""Bar loads, published versions, gates, bounded rebuilds and partition deletes on literal cases."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.plans import incremental, screener
from tidemark.plans.builds import run_build
from tidemark.sources import bars, sinks
from tidemark.sources.versions import Published, PublishConflict

DAY = [dt.date(2024, 1, d) for d in (1, 2, 3, 4, 5)]
ROW = "trading_date date, v long, updated_at timestamp, model_version string"


def table(spark, days, at=1, extra=0):
    rows = [(DAY[d], d + extra, dt.datetime(2024, 2, at), "m_current_20240105") for d in days]
    return spark.createDataFrame(rows, ROW)


def build(table_, keys, full, fresh=None, lineage=()):
    return run_build(table_, incremental.TRADE_SETUP, keys, "m", lambda: full, fresh, lineage=lineage)


def values(published):
    return sorted(r["v"] for r in published.read().collect())


def test_build_goes_from_full_to_incremental_and_stops_when_current(spark, tmp_path):
    out = Published(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError, match="nothing is published"):
        out.read()
    one, two = table(spark, [0, 1]), table(spark, [0, 1, 2, 3])
    assert build(out, one, one).mode == "FULL" and values(out) == [0, 1]
    again = build(out, one, one)
    assert (again.mode, again.version, again.published) == ("UP_TO_DATE", 1, False)
    seen = []

    def fresh(after):
        seen.append(after)
        return two.filter(F.col("trading_date") > F.lit(after))

    assert build(out, two, two, fresh).mode == "INCREMENTAL" and seen == [DAY[1]] and values(out) == [0, 1, 2, 3]
    row = out.current()
    assert row["version"] == 2 and len(row["segments"]) == 2 and row["rows"] == 4 and row["processed_through"] == DAY[3]


def test_failing_gates_leave_the_old_version(spark, tmp_path):
    out = Published(spark, str(tmp_path / "t"))
    one, two = table(spark, [0, 1]), table(spark, [0, 1, 2])
    build(out, one, one)
    with pytest.raises(ValueError, match="coverage mismatch"):
        build(out, two, two, lambda after: two.filter("false"))
    other = two.withColumn("model_version", F.lit("m_current_20240106"))
    with pytest.raises(ValueError, match="universe dates"):
        build(out, two, two, lineage=(two, other))
    assert out.current()["version"] == 1 and values(out) == [0, 1]
    assert build(out, two, two).mode == "INCREMENTAL" and values(out) == [0, 1, 2]


def test_late_input_and_new_model_rebuild_in_full(spark, tmp_path):
    out = Published(spark, str(tmp_path / "t"))
    one, late = table(spark, [0, 1]), table(spark, [0, 1], at=3, extra=10)
    build(out, one, one)
    assert build(out, late, late, lambda after: late.filter("false")).mode == "FULL" and values(out) == [10, 11]
    assert run_build(out, incremental.TRADE_SETUP, late, "other", lambda: late).mode == "FULL" and out.current()["version"] == 3


def test_two_writers_of_one_version_conflict(spark, tmp_path):
    out = Published(spark, str(tmp_path / "t"))
    one = table(spark, [0])
    build(out, one, one)
    base = out.current()
    out.publish([out.stage(one)], "FULL", "m", DAY[0], 1, None, base)
    with pytest.raises(PublishConflict):
        out.publish([out.stage(one)], "FULL", "m", DAY[0], 1, None, base)
    assert out.current()["version"] == 2


BARS = "instrument_id long, trading_date date, open double, high double, low double, close double, volume double, previous_close double, month int"


def payload(symbol, rows):
    names = ("timestamp", "open", "high", "low", "close", "volume", "adjclose")
    stamp = [int(dt.datetime(d.year, d.month, d.day, 2, tzinfo=dt.timezone.utc).timestamp()) for d, _ in rows]
    closes = [c for _, c in rows]
    lists = [stamp, closes, [None if c is None else c + 1 for c in closes], [None if c is None else c - 1 for c in closes], closes, [5.0] * len(rows), closes]
    return json.dumps({"symbol": symbol, "granularity": "1d", **dict(zip(names, lists))})


def test_late_bar_repairs_its_successor_in_touched_partitions_only(spark, ws, tmp_path):
    path = str(tmp_path / "bars")

    def bar(i, month, day, close, before):
        return (i, dt.date(2024, month, day), close, close + 1, close - 1, close, 5.0, before, month)

    stored = [bar(1, 1, 2, 10.0, None), bar(1, 2, 1, 12.0, 10.0), bar(1, 3, 1, 13.0, 12.0), bar(2, 1, 2, 20.0, None), bar(2, 3, 4, 21.0, 20.0)]
    spark.createDataFrame(stored, BARS).coalesce(1).write.partitionBy("month").parquet(path)

    def names():
        return {r["n"] for r in spark.read.parquet(path).filter("month = 3").select(F.col("_metadata.file_name").alias("n")).distinct().collect()}

    before = names()
    docs = [payload("A", [(dt.date(2024, 1, 31), 11.0), (dt.date(2024, 1, 31), 99.0), (dt.date(2024, 1, 30), None), (dt.date(2023, 12, 29), 9.0), (dt.date(2024, 4, 1), 9.0)]),
            payload("NOBODY", [(dt.date(2024, 1, 31), 1.0)])]
    members = spark.createDataFrame([(1, "A", dt.date(2024, 1, 1)), (2, "B", None)], "instrument_id long, symbol string, listed_date date")
    rejected = bars.load_bars(spark, ws, path, spark.createDataFrame([(d,) for d in docs], "body string"), members, ["month"],
                              {"month": F.month("trading_date")}, F.lit("2024-03-31").cast("date"))
    assert {r["reason"]: r["bars"] for r in rejected.collect()} == {"DUPLICATE_DATE": 1, "BEFORE_LISTING_DATE": 1, "AFTER_TARGET_END_DATE": 1}
    got = {(r["instrument_id"], r["trading_date"]): (r["close"], r["previous_close"]) for r in spark.read.parquet(path).collect()}
    want = {(i, d): (c, b) for i, d, *_, c, _, b, _ in stored}
    want[1, dt.date(2024, 1, 31)] = (11.0, 10.0)
    want[1, dt.date(2024, 2, 1)] = (12.0, 11.0)
    assert got == want and names() == before


def test_partition_delete_touches_no_other_file(spark, ws, tmp_path):
    path = str(tmp_path / "models")
    df = spark.createDataFrame([("a b", 1, 1), ("a b", 2, 2), ("c", 1, 3), (None, 1, 4)], "model string, source int, v long")
    df.write.partitionBy("model", "source").parquet(path)
    assert sinks.delete_partitions(spark, path, (F.col("model") == "a b") & (F.col("source") == 1), ["model", "source"]) == 1
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [2, 3, 4]
    assert sinks.delete_partitions(spark, path, F.col("model") == "nothing", ["model"]) == 0


def test_a_lost_carry_in_shows(spark, ws):
    """Turnover of new dates needs the bars before the cut; without them the mean differs."""
    days = [dt.date(2024, 1, 1) + dt.timedelta(d) for d in range(40)]
    rows = [(1, d, float(n + 1), 10.0, dt.datetime(2024, 3, 1 + n % 20)) for n, d in enumerate(days)]
    df = spark.createDataFrame(rows, "instrument_id long, trading_date date, close double, volume double, ingested_at timestamp")
    whole = {r["trading_date"]: (r["avg_turnover_20d"], r["turnover_updated_at"]) for r in screener.turnover_window(df, F.lit(days[0]), F.lit(days[-1])).collect()}
    after = F.lit(days[29])

    def sliced(rows_before):
        part = incremental.bounded_history(df, after, rows_before)
        found = screener.turnover_window(part, F.lit(days[0]), F.lit(days[-1])).filter(F.col("trading_date") > after).collect()
        return {r["trading_date"]: (r["avg_turnover_20d"], r["turnover_updated_at"]) for r in found}

    assert sliced(19) == {d: whole[d] for d in days[30:]}
    assert sliced(18) != {d: whole[d] for d in days[30:]}
    assert whole[days[25]][1] == max(dt.datetime(2024, 3, 1 + n % 20) for n in range(6, 26))


def test_rebuild_of_keys_rewrites_their_buckets_only(spark, ws, tmp_path):
    path = str(tmp_path / "keyed")
    rows = [(k, v, k % 4) for k in range(8) for v in (1, 2)]
    spark.createDataFrame(rows, "k long, v long, bucket int").coalesce(1).write.partitionBy("bucket").parquet(path)

    def files():
        found = spark.read.parquet(path).select("bucket", F.col("_metadata.file_name").alias("n")).distinct().collect()
        return {r["bucket"]: r["n"] for r in found}

    before = files()
    stale = spark.createDataFrame([(1, 1), (5, 1), (6, 2)], "k long, bucket int")
    fresh = spark.createDataFrame([(1, 9, 1), (5, 8, 1), (7, 7, 3)], "k long, v long, bucket int")  # 6 has no rows any more, 7 was not asked for
    sinks.rebuild_keys(spark, ws, path, stale, fresh, "k", "bucket")
    got = sorted((r["k"], r["v"]) for r in spark.read.parquet(path).collect())
    assert got == sorted([(k, v) for k, v, _ in rows if k not in (1, 5, 6)] + [(1, 9), (5, 8)])
    after = files()
    assert before[0] == after[0] and before[3] == after[3] and before[1] != after[1] and before[2] != after[2]
