"""How stages are stored and laid out: values come back as they were, and wide rows are neither dealt out again nor computed twice."""

import math
import os
import re

from pyspark.sql import functions as F

from tidemark.functions.numeric import none_of, reasons, rnd, with_rounded
from tidemark.operators.joins import next_rows
from tidemark.plans import screener
from tidemark.session import PLANNING, STORED, WRITING, Workspace, packed, unpacked
from tidemark.sources.tables import Source


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_packed_doubles_come_back_value_for_value(spark, tmp_path):
    values = [0.0, 1.25, -3.1, 0.1 + 0.2, 1e300, -1e300, math.inf, -math.inf, math.nan, 2.0**53, 123456.789012, None]
    df = spark.createDataFrame([(i, v, v) for i, v in enumerate(values)], "i int, six double, none double")
    stored = packed(df, {"six": 6})
    assert dict(stored.dtypes)["six"] == "bigint"
    got = {r.i: r.six for r in unpacked(stored, {"six": 6}).collect()}
    assert all(repr(got[i]) == repr(v) for i, v in enumerate(values))
    assert unpacked(stored, {"six": 6}).dtypes == df.dtypes

    # averages of a series take under half the room
    ws = Workspace(spark, 2, WRITING, STORED, {"six": 6})
    series = spark.range(0, 20000, 1, 1).select(rnd(F.lit(1000.0) + F.sin(F.col("id") / 300.0) * 50, 6).alias("six"))

    def size(folder: str) -> int:
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder.removeprefix("file:")) for f in names)

    before = {k: spark.conf.get(k, None) for k in WRITING}
    back = ws.write(series, "series")
    assert {k: spark.conf.get(k, None) for k in WRITING} == before
    assert back.exceptAll(series).count() == 0 and series.exceptAll(back).count() == 0
    series.write.parquet(str(tmp_path / "plain"))
    assert size(ws.root) < size(str(tmp_path / "plain")) / 2


def test_a_filter_on_reasons_makes_no_list(spark):
    checks = [("A", F.col("x") > 1), ("B", F.col("y") < 0)]
    df = spark.createDataFrame([(0, 1.0), (2, 1.0), (0, -1.0), (None, 1.0), (None, -1.0), (None, None)], "x int, y double")
    got = df.filter(none_of(*checks))
    assert sorted(map(str, got.collect())) == sorted(map(str, df.filter(F.size(reasons(*checks)) == 0).collect()))
    assert "lambda" not in plan(got)


def test_rounded_values_are_computed_once(spark):
    df = spark.createDataFrame([(1.00005,), (2.5,), (None,)], "x double")
    twice = with_rounded(df, {"y": (F.sqrt("x") * 100.0, 4)})
    assert twice.columns == ["x", "y"] and twice.collect() == df.withColumn("y", rnd(F.sqrt("x") * 100.0, 4)).collect()
    assert plan(twice).count("SQRT") == 1


def test_the_walk_is_summed_once(spark):
    totals = spark.createDataFrame(
        [(1, "2001-01-02", 5, 3.0, 1000, 1), (1, "2001-01-03", -7, 2.0, 900, 2)],
        "instrument_id long, trading_date string, step long, volume double, value_cents long, arrival_days int",
    ).withColumn("trading_date", F.to_date("trading_date"))
    walk = Source(spark, "").bars_walk(totals)
    assert [(r.open, r.close) for r in walk.orderBy("trading_date").collect()] == [(1000.0, 1000.5), (1000.5, 999.8)]
    assert len(re.findall(r"sum\(step#\d+L?\) windowspec", plan(walk))) == 1


def test_only_bars_of_keys_with_events_are_ordered(spark):
    events = spark.createDataFrame([(1, 2), (None, 2), (7, 1)], "k int, t int")
    bars = spark.createDataFrame([(k, d, float(d)) for k in (1, 2, 3, None) for d in range(5)], "k int, d int, c double")
    got = next_rows(events, bars, ["k"], "t", "d", 2, ["c"])
    assert sorted((str(r.k), r.t, r.bar_no, r.c) for r in got.collect() if r.bar_no) == [("1", 2, 1, 3.0), ("1", 2, 2, 4.0)]
    assert got.filter("bar_no is null").count() == 2
    assert "LeftSemi" in plan(got)


def test_ranks_meet_the_scores_where_they_lie(spark, ws):
    for k, v in PLANNING.items():
        spark.conf.set(k, v)
    df = spark.createDataFrame(
        [(i, f"2001-01-0{d}", f"S{i}", "ABC"[i % 3], float((i * 7 + d) % 5), float(i % 2)) for i in range(12) for d in (1, 2)],
        "instrument_id long, trading_date string, symbol string, sector_code string, overall_score double, technical_score double")
    got = screener.ranked(df, ws)
    for day in ("2001-01-01", "2001-01-02"):
        rows = sorted((r for r in df.collect() if r.trading_date == day), key=lambda r: (-r.overall_score, -r.technical_score, r.symbol))
        found = {r.instrument_id: r.universe_rank for r in got.collect() if r.trading_date == day}
        assert [found[r.instrument_id] for r in rows] == list(range(1, 13))
    assert "hashpartitioning" not in plan(got)
