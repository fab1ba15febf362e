import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions.numeric import rnd
from tidemark.operators import keyed, ordering, rules, sets
from tidemark.operators.joins import asof_backward, next_rows, overlapping, points_in_ranges, table_diff
from tidemark.operators.recursive import Smoother, smooth, span, wilder
from tidemark.operators.windows import series, share_not_above, zscore

D0 = dt.date(2020, 1, 1)


def day(n):
    return D0 + dt.timedelta(days=int(n))


def test_recursive_filter_equals_ewm_across_chunks(spark):
    rng = np.random.default_rng(3)
    frames = [pd.DataFrame({"k": k, "t": range(n), "x": rng.normal(100, 5, n)}) for k, n in (("a", 950), ("b", 400), ("c", 7))]
    pdf = pd.concat(frames)
    df = spark.createDataFrame(pdf).withColumn("pos", F.col("t") + 1)
    got = smooth(df, [span("e20", "x", 20), wilder("w14", "x")], ["k"], "t", "pos", chunk_rows=450).toPandas()
    for k, g in got.sort_values("t").groupby("k"):
        want = pdf[pdf.k == k].x.reset_index(drop=True)
        np.testing.assert_allclose(g.e20, want.ewm(span=20, adjust=False, min_periods=20).mean(), rtol=1e-11)
        np.testing.assert_allclose(g.w14, want.ewm(alpha=1 / 14, adjust=False, min_periods=14).mean(), rtol=1e-11)


def test_recursive_filter_with_leading_gap_and_long_chunk(spark):
    x = pd.Series(np.random.default_rng(5).normal(50, 3, 9000))
    pdf = pd.DataFrame({"k": "a", "t": range(len(x)), "x": x, "d": x.diff()})
    df = spark.createDataFrame(pdf).withColumn("d", F.when(F.col("t") > 0, F.col("d"))).withColumn("pos", F.col("t") + 1)
    got = smooth(df, [span("e200", "x", 200), Smoother("d14", "d", 1 / 14, 14, lead=1)], ["k"], "t", "pos").toPandas().sort_values("t")
    np.testing.assert_allclose(got.e200, x.ewm(span=200, adjust=False, min_periods=200).mean(), rtol=1e-10)
    want = x.diff().ewm(alpha=1 / 14, adjust=False, min_periods=14).mean()
    np.testing.assert_allclose(got.d14, want, atol=1e-12)


@pytest.fixture(params=["true", "false"])
def coalesced(spark, request):
    """With and without small partitions being merged, so ranks cross partition borders."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", request.param)
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_ordered_rows_span_partitions(spark, ws):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(4000).select(F.lit("one").alias("g"), "id")
        placed = ordering._spread(df, ws, ["g"], [F.col("id").asc()], "t")
        assert placed.select("_part").distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_positions_percent_rank_and_median_with_a_hot_group(spark, ws, coalesced):
    rng = random.Random(1)
    rows = [("hot" if i % 3 else f"g{i % 5}", i, float(rng.choice([1, 1, 1, 2, 3, 5, 8])), "s" + str(i % 4)) for i in range(1200)]
    df = spark.createDataFrame(rows, "g string, id int, v double, s string")
    pdf = df.toPandas()
    got = ordering.positions(df.repartition(7), ws, ["g"], [F.col("v").desc(), F.col("id").asc()], "pos", {"spos": ["s"]}).toPandas()
    pdf = pdf.sort_values(["g", "v", "id"], ascending=[True, False, True])
    pdf["pos"] = pdf.groupby("g").cumcount() + 1
    pdf["spos"] = pdf.groupby(["g", "s"]).cumcount() + 1
    both = got.merge(pdf, on="id", suffixes=("", "_w"))
    assert len(both) == 1200 and (both.pos == both.pos_w).all() and (both.spos == both.spos_w).all()
    ranks = ordering.percent_rank(df, ws, ["g"], "v", "pr").toPandas().merge(pdf[["id"]], on="id")
    for g, part in ranks.groupby("g"):
        n = len(part)
        want = (part.v.rank(method="min") - 1) / (n - 1)
        np.testing.assert_allclose(part.pr, want)
    med = ordering.medians(df, ws, ["g"], ["v", "id"]).toPandas().set_index("g")
    want = pdf.groupby("g")[["v", "id"]].median()
    np.testing.assert_allclose(med.loc[want.index, "median_v"], want.v)
    np.testing.assert_allclose(med.loc[want.index, "median_id"], want.id)


def test_percent_rank_of_single_row_is_zero(spark, ws):
    df = spark.createDataFrame([("a", 5.0)], "g string, v double")
    assert ordering.percent_rank(df, ws, ["g"], "v", "r").first()["r"] == 0.0


def test_asof_inner_drops_and_left_keeps(spark):
    left = spark.createDataFrame([("a", day(i), i) for i in (0, 5, 9)], "k string, t date, n int")
    right = spark.createDataFrame([("a", day(5), "x"), ("a", day(7), "y"), ("b", day(0), "z")], "k string, r date, p string")
    inner = {row["n"]: row["p"] for row in asof_backward(left, right, ["k"], "t", "r", ["p"]).collect()}
    assert inner == {5: "x", 9: "y"}
    outer = {row["n"]: row["p"] for row in asof_backward(left, right, ["k"], "t", "r", ["p"], "left").collect()}
    assert outer == {0: None, 5: "x", 9: "y"}


def test_next_rows_keeps_events_without_bars(spark):
    bars = spark.createDataFrame([("a", day(i * 2), float(i)) for i in range(6)], "k string, d date, c double")
    events = spark.createDataFrame([("e1", "a", day(-1)), ("e2", "a", day(7)), ("e3", "a", day(10)), ("e4", "b", day(0))], "id string, k string, t date")
    got = {}
    for row in next_rows(events, bars, ["k"], "t", "d", 3, ["c"]).collect():
        got.setdefault(row["id"], []).append((row["bar_no"], row["c"]))
    assert sorted(got["e1"]) == [(1, 0.0), (2, 1.0), (3, 2.0)]
    assert sorted(got["e2"]) == [(1, 4.0), (2, 5.0)]
    assert got["e3"] == [(None, None)] and got["e4"] == [(None, None)]


def test_points_in_ranges_against_brute_force(spark):
    rng = random.Random(7)
    ranges = [(f"r{i}", rng.choice("ab"), day(s := rng.randint(0, 60)), day(s + rng.randint(0, 6))) for i in range(80)]
    points = [(rng.choice("ab"), day(rng.randint(0, 70)) if rng.random() > 0.1 else None) for _ in range(25)]
    got = {r["id"] for r in points_in_ranges(
        spark.createDataFrame(ranges, "id string, k string, s date, e date"), spark.createDataFrame(points, "k string, p date"),
        ["k"], "id", "s", "e", "p").collect()}
    assert got == {i for i, k, s, e in ranges if any(pk == k and p and s <= p <= e for pk, p in points)}


def test_overlap_window_equals_pairwise(spark):
    rng = random.Random(11)
    rows = [(k, i, day(s := rng.randint(0, 300)), None if rng.random() < 0.02 else day(s + rng.randint(0, 9))) for k in "abcdefgh" for i in range(6)]
    got = {r["k"] for r in overlapping(spark.createDataFrame(rows, "k string, i int, s date, e date"), ["k"], "s", "e", "i").collect()}
    far = day(99999)
    want = {a[0] for a in rows for b in rows if a[0] == b[0] and a[1] < b[1] and a[2] <= (b[3] or far) and b[2] <= (a[3] or far)}
    assert got == want


def test_table_diff_reports_each_kind(spark):
    gen = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0), (3, None, 3.0), (5, "a", None)], "k int, s string, v double")
    old = spark.createDataFrame([(2, "b", 2.00001), (3, None, 3.1), (4, "a", 4.0), (5, "a", None)], "k int, s string, v double")
    got = {r["k"]: (r["issue"], r["fields"]) for r in table_diff(gen, old, ["k"], ["s"], ["v"]).collect()}
    assert got == {1: ("MISSING", None), 2: ("MISMATCH", "s"), 3: ("MISMATCH", "v"), 4: ("UNEXPECTED", None)}


def test_zscore_and_rolling_share(spark):
    vals = [float(v) for v in np.random.default_rng(2).integers(1, 50, 90)] + [7.0] * 25
    pdf = pd.DataFrame({"instrument_id": 1, "trading_date": [day(i) for i in range(len(vals))], "v": vals})
    w = series()
    got = spark.createDataFrame(pdf).withColumns({"z": zscore("v", 20, w), "s": share_not_above("v", 30, 10, w)}).toPandas().sort_values("trading_date")
    s = pd.Series(vals)
    sd = s.rolling(20).std(ddof=0).where(lambda x: x > 1e-12)
    np.testing.assert_allclose(got.z.astype(float), (s - s.rolling(20).mean()) / sd, atol=1e-9)
    want = s.rolling(30, min_periods=10).apply(lambda a: float(np.mean(a <= a[-1])), raw=True)
    np.testing.assert_allclose(got.s.astype(float), want)


def test_merges(spark):
    old = spark.createDataFrame([("a", "x", {"p": "1", "q": "1"}), ("b", "y", None)], "k string, v string, m map<string,string>")
    new = spark.createDataFrame([("a", None, {"q": "2"}), ("c", "z", {"r": "3"})], "k string, v string, m map<string,string>")
    got = {r["k"]: (r["v"], r["m"]) for r in keyed.merge_keep_known(old, new, ["k"], ["m"]).collect()}
    assert got == {"a": ("x", {"p": "1", "q": "2"}), "b": ("y", None), "c": ("z", {"r": "3"})}
    ranked = spark.createDataFrame([("a", 2, "old"), ("b", 1, "old")], "k string, r int, v string")
    fresh = spark.createDataFrame([("a", 2, "new"), ("b", 3, "new")], "k string, r int, v string")
    kept = {r["k"]: r["v"] for r in keyed.replace_if_better(ranked, fresh, ["k"], F.col("r")).collect()}
    assert kept == {"a": "old", "b": "new"}


def test_fingerprints_separate_sets_by_one_rule(spark):
    import hashlib

    rows = [("m1", s) for s in "abc"] + [("m2", s) for s in "cbaa"] + [("m3", s) for s in "abd"]
    df = spark.createDataFrame(rows, "m string, s string")
    got = {r["m"]: r["fingerprint"] for r in sets.fingerprints(df, ["m"], "s").collect()}
    digests = [hashlib.sha256(s.encode()).hexdigest() for s in "abc"]
    lanes = [str(sum(int(d[15 * i : 15 * i + 15], 16) for d in digests)) for i in range(4)]
    assert got["m1"] == hashlib.sha256("|".join(lanes).encode()).hexdigest() == got["m2"] != got["m3"]


def test_rounding_is_that_of_the_exact_value(spark):
    import random

    rng = random.Random(3)
    literal = [(55.645, 2, 55.65), (19.50065, 4, 19.5007), (58.3772715, 6, 58.377271), (-55.645, 2, -55.65), (0.125, 2, 0.12), (0.375, 2, 0.38), (-0.125, 2, -0.12), (2.5, 0, 2.0)]
    for value, digits, want in literal:
        assert round(value, digits) == want
    rows = [(v, d) for v, d, _ in literal] + [
        (rng.choice([1, -1]) * rng.randrange(10**8) / 10 ** (d + 1), d) for d in (0, 2, 4, 6, 8) for _ in range(800)] + [
        (rng.uniform(-1e6, 1e6), d) for d in (2, 8) for _ in range(300)] + [(1e300, 2), (1e17 + 2, 2), (0.0, 4), (-0.0, 4)]
    for digits in {d for _, d in rows}:
        df = spark.createDataFrame([(v,) for v, d in rows if d == digits], "v double").withColumn("r", rnd("v", digits))
        assert [r.r for r in df.collect()] == [round(v, digits) + 0.0 for v, d in rows if d == digits]


def test_one_rule_path_with_ties_and_repeated_keys(spark):
    seeded = [r for r in rules.SEEDED if r[1] == "TICK_SIZE"]
    twin = ("A_TWIN", *seeded[0][1:10], 3.0, *seeded[0][11:])
    table = rules.inline_table(spark, [*seeded, twin], rules.RULE_SCHEMA)
    df = spark.sql("SELECT * FROM VALUES (1, DATE '2026-08-06', 100D), (1, DATE '2026-08-06', 300D), (2, DATE '2013-12-31', 100D) AS t(i, d, p)")
    got = sorted((r.i, r.p, r.rule_key, r.tick_size, r.rule_conflict) for r in rules.lookup(df, table, "TICK_SIZE", ["i"], "d", "p", values=["rule_key", "tick_size"]).collect())
    assert got == [(1, 100.0, "A_TWIN", 3.0, True), (1, 300.0, "TICK_200_TO_LT_500_20160502", 2.0, False), (2, 100.0, None, None, False)]


def test_no_row_is_lost_to_nulls(spark, ws):
    df = spark.createDataFrame([(1, None, 1.0), (2, None, None), (3, "a", None), (4, "a", 2.0), (5, "a", None)], "id int, g string, v double")
    ranks = {r.id: r.r for r in ordering.percent_rank(df, ws, ["g"], "v", "r").collect()}
    assert ranks == {1: 0.0, 2: 1.0, 3: 0.5, 4: 0.0, 5: 0.5}
    places = {r.id: r.p for r in ordering.positions(df, ws, ["g"], [F.col("id").asc()], "p").collect()}
    assert places == {1: 1, 2: 2, 3: 1, 4: 2, 5: 3}
    assert {r.g: r.median_v for r in ordering.medians(df, ws, ["g"], ["v"]).collect()} == {None: 1.0, "a": 2.0}
    left = spark.createDataFrame([("x", 1), ("x", 5), (None, 5), ("x", None)], "k string, t int")
    right = spark.createDataFrame([("x", None, "bad"), (None, 1, "bad"), ("x", 2, "good")], "k string, rt int, v string")
    got = {(r.k, r.t, r.v) for r in asof_backward(left, right, ["k"], "t", "rt", ["v"], "left").collect()}
    assert got == {("x", 1, None), ("x", 5, "good"), (None, 5, None), ("x", None, None)}


def test_repeated_keys_have_one_answer(spark):
    old = spark.createDataFrame([("k", "a"), ("k", "b")], "k string, v string")
    new = spark.createDataFrame([("k", "z", 1), ("k", "c", 2)], "k string, v string, at int")
    assert [tuple(r) for r in keyed.upsert(old, new, ["k"], "at").collect()] == [("k", "c")]
    assert [tuple(r) for r in keyed.upsert(old, new.drop("at"), ["k"]).collect()] == [("k", "z")]
    assert [tuple(r) for r in keyed.merge_keep_known(old, new.drop("at"), ["k"]).collect()] == [("k", "z")]


def test_missing_shared_folder_is_refused():
    from types import SimpleNamespace

    from tidemark.session import Workspace

    settings = {"spark.sql.shuffle.partitions": "4"}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        Workspace(session)


def test_medians_select_inside_one_bin(spark, ws):
    rng = np.random.default_rng(5)
    heavy = np.exp(rng.normal(0, 12, 4001))
    shapes = {
        "heavy": heavy, "even": rng.normal(size=4000), "one": [3.5], "two": [1.0, 2.0], "tied": [7.0] * 900 + [8.0] * 900, "signs": [-1e300, -1.0, 1.0, 1e300],
        "infinite": [-np.inf, -np.inf, 4.0, np.inf, np.inf], "wide": [-1.7e308, 0.25, 1.7e308]}
    rows = [(g, float(v)) for g, vs in shapes.items() for v in vs] + [("empty", None), ("even", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = {r.g: r.median_v for r in ordering.medians(df, ws, ["g"], ["v"], 12).collect()}
    assert set(got) == set(shapes)
    for g, vs in shapes.items():
        np.testing.assert_allclose(got[g], np.median(vs), rtol=1e-11, atol=1e-12, err_msg=g)


def test_medians_do_not_trust_the_edges(spark, ws, monkeypatch):
    monkeypatch.setattr(ordering, "BINS", 3)
    values = [float(v * v) for v in range(-50, 51)] + [-1000.0] * 40
    df = spark.createDataFrame([(1, v) for v in values], "g int, v double")
    real = ordering.F.percentile_approx
    for low, high in ((0.0, 0.01), (0.97, 0.99)):  # edges far from the middle
        monkeypatch.setattr(ordering.F, "percentile_approx", lambda c, p, a, low=low, high=high: real(c, [low, high], a))
        assert ordering.medians(df, ws, ["g"], ["v"]).first()["median_v"] == np.median(values)
