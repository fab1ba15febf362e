import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.plans import breadth, calibration, execution, features, outcomes, ownership, screener, setups

D0 = dt.date(2020, 1, 1)


def day(n):
    return D0 + dt.timedelta(days=int(n))


def bars_frame(spark, close, high=None, low=None, volume=None, key=1):
    n = len(close)
    close = np.asarray(close, dtype=float)
    pdf = pd.DataFrame({
        "instrument_id": key, "trading_date": [day(i) for i in range(n)], "open": close,
        "high": close + 1 if high is None else np.asarray(high, float), "low": close - 1 if low is None else np.asarray(low, float),
        "close": close, "volume": np.arange(n) * 1000.0 + 1e6 if volume is None else np.asarray(volume, float)})
    return spark.createDataFrame(pdf)


def run(spark, *args, **kw):
    return features.technical_features(bars_frame(spark, *args, **kw)).toPandas().sort_values("trading_date").reset_index(drop=True)


def test_indicators_start_where_they_should(spark):
    got = run(spark, [100.0 + i for i in range(260)])
    assert got.atr14.first_valid_index() == 13 and got.rsi14.first_valid_index() == 14
    for n in (20, 50, 100, 200):
        assert got[f"ema{n}"].first_valid_index() == n - 1
    assert got.return_60d.first_valid_index() == 60 and got.volume_z20.first_valid_index() == 19
    assert (got.rsi14.dropna() == 100).all()
    assert got.breakout_flag.first_valid_index() == 20 and (got.breakout_flag.dropna() == (got.close > got.close.shift(1) + 1)[20:]).all()


def test_falling_and_flat_rsi(spark):
    assert (run(spark, [500.0 - i for i in range(40)]).rsi14.dropna() == 0).all()
    assert (run(spark, [100.0] * 40).rsi14.dropna() == 50).all()


def test_rsi_and_atr_equal_pandas(spark):
    rng = np.random.default_rng(4)
    close = 1000 + np.cumsum(rng.normal(0, 9, 400))
    high, low = close + rng.uniform(0, 8, 400), close - rng.uniform(0, 8, 400)
    got = run(spark, close, high, low)
    c, h, l = pd.Series(close), pd.Series(high), pd.Series(low)
    up = c.diff().clip(lower=0).ewm(alpha=1 / 14, adjust=False, min_periods=14).mean()
    down = (-c.diff().clip(upper=0)).ewm(alpha=1 / 14, adjust=False, min_periods=14).mean()
    np.testing.assert_allclose(got.rsi14.astype(float), 100 - 100 / (1 + up / down), atol=2e-6)
    tr = pd.concat([h - l, (h - c.shift()).abs(), (l - c.shift()).abs()], axis=1).max(axis=1)
    np.testing.assert_allclose(got.atr14.astype(float), tr.ewm(alpha=1 / 14, adjust=False, min_periods=14).mean(), atol=2e-6)


def test_failed_breakout(spark):
    close = [100.0] * 25
    high = [101.0] * 24 + [110.0]
    got = run(spark, close, high).iloc[-1]
    assert not got.breakout_flag and got.failed_breakout_flag


def test_linear_trend_is_bullish(spark):
    rows = bars_frame(spark, [1000.0 + 2 * i for i in range(320)])
    got = features.index_regimes(features.technical_features(rows, with_volume=False)).toPandas()
    assert len(got) > 0 and set(got.direction) == {"BULLISH"} and set(got.regime) == {"BULL"}
    assert got.confidence.between(0.25, 0.55).all()


@pytest.mark.parametrize("counts, score", [
    (dict(advances=10, declines=0, unchanged=0, pct=100.0, hi=10, lo=0, up=5.0, down=0.0), 100.0),
    (dict(advances=0, declines=10, unchanged=0, pct=0.0, hi=0, lo=10, up=0.0, down=5.0), 0.0),
    (dict(advances=5, declines=5, unchanged=0, pct=50.0, hi=0, lo=0, up=0.0, down=0.0), 50.0)])
def test_breadth_score(spark, counts, score):
    row = {"advances": counts["advances"], "declines": counts["declines"], "unchanged": counts["unchanged"],
           **{f"pct_above_ema{n}": counts["pct"] for n in (20, 50, 200)}, "new_high_20d": counts["hi"], "new_low_20d": counts["lo"],
           "new_high_52w": counts["hi"], "new_low_52w": counts["lo"], "up_volume": counts["up"], "down_volume": counts["down"]}
    assert spark.createDataFrame([row]).select(breadth.breadth_score().alias("s")).first()["s"] == score


def test_population_mismatch_stops(spark):
    df = spark.createDataFrame([(day(0), 3, 1, 1, 0)], "trading_date date, eligible_count long, advances long, declines long, unchanged long")
    with pytest.raises(Exception, match="population mismatch"):
        df.select(breadth.population_check("Breadth")).collect()


def test_rotation_history_changes_label(spark):
    rows = [("A", day(100), 50.0)]
    now = spark.createDataFrame(rows, "sector_code string, trading_date date, score double")
    assert breadth.rotate(now).first()["rotation_label"] == "NEUTRAL"
    past = spark.createDataFrame([("A", day(i), 40.0) for i in range(20)], "sector_code string, trading_date date, score double")
    got = breadth.rotate(now, past).first()
    assert got["rotation_label"] == "IMPROVING" and got["score_change_20d"] == 10.0


def test_ownership_trend_cases(spark):
    rows = [(1, day(0), 10.0, 100, 1000), (1, day(30), 10.6, 106, 1000), (1, day(90), 10.1, 101, 1000), (1, day(120), 10.15, 152, 1500)]
    df = spark.createDataFrame(rows, "instrument_id long, as_of_date date, foreign_ownership_pct double, foreign_shares long, security_number long")
    got = [(r.trend_label, r.signal_strength, r.corporate_action_risk, r.snapshot_gap_flag) for r in ownership.ownership_trends(df, "m").orderBy("as_of_date").collect()]
    assert got[0] == ("ACCUMULATING", 100.0, False, False)
    assert got[1] == ("DISTRIBUTING", 75.0, False, True)
    assert got[2][0] == "STABLE" and got[2][2] and abs(got[2][1] - 5.0) < 1e-9
    bad = df.withColumn("foreign_ownership_pct", F.lit(101.0))
    with pytest.raises(Exception, match="PCT_OUT_OF_RANGE"):
        ownership.ownership_trends(bad, "m").collect()


def test_alignment_table(spark):
    cases = [(60.0, 60.0, "CONFIRMED_BULLISH"), (40.0, 40.0, "CONFIRMED_BEARISH"), (50.0, 50.0, "NEUTRAL"), (60.0, 50.0, "TECHNICAL_LEAD"),
             (50.0, 40.0, "OWNERSHIP_LEAD"), (60.0, 40.0, "DIVERGENCE")]
    df = spark.createDataFrame(cases, "t double, o double, want string")
    for r in df.select("want", ownership.alignment(F.col("t"), F.col("o"), F.lit(False)).alias("got")).collect():
        assert r["got"] == r["want"]


@pytest.mark.parametrize("rsi, score", [(30, 20), (35, 35), (50, 70), (65, 100), (75, 80), (85, 50), (100, 20), (120, 20)])
def test_momentum_knots(spark, rsi, score):
    from tidemark.functions.numeric import clamp, piecewise
    got = spark.range(1).select(piecewise(clamp(F.lit(float(rsi))), screener.MOMENTUM_KNOTS).alias("s")).first()["s"]
    assert got == pytest.approx(score)


def test_rank_tie_break(spark, ws):
    rows = [(1, day(0), "X", 70.0, 60.0, "BBB"), (2, day(0), "X", 70.0, 60.0, "AAA"), (3, day(0), "Y", 70.0, 65.0, "CCC"), (4, day(0), "Y", 80.0, 1.0, "DDD")]
    df = spark.createDataFrame(rows, "instrument_id long, trading_date date, sector_code string, overall_score double, technical_score double, symbol string")
    got = {r["symbol"]: (r["universe_rank"], r["sector_rank"]) for r in screener.ranked(df, ws).collect()}
    assert got == {"DDD": (1, 1), "CCC": (2, 2), "AAA": (3, 1), "BBB": (4, 2)}


SETUP = dict(setup_close=102.0, ema20=100.0, atr14=2.0, prior_low_10d=99.0, prior_high_20d=None, prior_high_55d=None, prior_count_10d=10)


def setup(spark, **changes):
    kinds = "setup_close double, ema20 double, atr14 double, prior_low_10d double, prior_high_20d double, prior_high_55d double, prior_count_10d long"
    row = {**SETUP, **changes}
    names = [k.split()[0] for k in kinds.split(", ")]
    return setups.trade_setups(spark.createDataFrame([tuple(row[n] for n in names)], kinds), "m").first()


def test_setup_accept_and_levels(spark):
    got = setup(spark)
    assert got["setup_decision"] == "ACCEPT" and got["decision_reasons"] == []
    assert (got["entry_low"], got["entry_high"], got["stop_price"]) == (101.0, 102.0, 98.5)
    assert got["target_primary"] == 107.5 and got["expected_rr"] == 2.0
    assert got["position_size_lots"] == min(math.floor(1e6 / 300), math.floor(1e8 / 10150))


def test_setup_gates(spark):
    assert setup(spark, setup_close=105.0, prior_low_10d=103.0)["setup_decision"] == "WATCH"
    assert setup(spark, prior_count_10d=9)["decision_reasons"] == ["INSUFFICIENT_PRIOR_HISTORY"]
    missing = setup(spark, setup_close=None, prior_low_10d=None)
    assert missing["decision_reasons"] == ["MISSING_CLOSE", "MISSING_PRIOR_LOW_10D"] and missing["entry_low"] is None
    assert "INSUFFICIENT_REWARD_RISK" in setup(spark, prior_high_20d=103.0)["decision_reasons"]
    wide = setup(spark, prior_low_10d=90.0)["decision_reasons"]
    assert wide == ["STRUCTURE_STOP_TOO_WIDE_ATR", "STRUCTURE_STOP_TOO_WIDE_PCT"]
    assert "STOP_NOT_BELOW_ENTRY_ZONE" in setup(spark, prior_low_10d=103.0)["decision_reasons"]


def sequential(levels, bars):
    """Bar-by-bar evaluator used as the check."""
    lo, hi, stop, target, horizon = levels
    fill = None
    for i, (o, h, l, c) in enumerate(bars[:5]):
        if h >= lo and l <= hi:
            fill, price = i, (o if lo <= o <= hi else hi if o > hi else lo)
            break
        if l <= stop:
            return "CANCELLED", None, None, None
    if fill is None:
        return ("NO_FILL" if len(bars) >= 5 else "PENDING"), None, None, None
    held = bars[fill:fill + horizon]
    for n, (o, h, l, c) in enumerate(held):
        if l <= stop:
            return "STOP", price, n + 1, (stop - price) / (price - stop)
        if h >= target:
            return "TARGET", price, n + 1, (target - price) / (price - stop)
    if len(held) >= horizon:
        return "EXPIRED", price, len(held), (held[-1][3] - price) / (price - stop)
    return "OPEN", price, len(held), None


def test_outcomes_equal_sequential_walk(spark):
    rng = random.Random(9)
    signals, bars, want = [], [], {}
    for i in range(400):
        levels = (99.0, 101.0, 95.0, 110.0, 10)
        path, last = [], rng.uniform(97, 106)
        for _ in range(rng.randint(0, 25)):
            o = last + rng.gauss(0, 1.0)
            c = o + rng.gauss(0, 2.0)
            path.append((round(o, 2), round(max(o, c) + rng.uniform(0, 2), 2), round(min(o, c) - rng.uniform(0, 2), 2), round(c, 2)))
            last = c
        signals.append((str(i), i, "S", "X", day(0), *levels))
        bars += [(i, day(n + 1), *bar) for n, bar in enumerate(path)]
        want[str(i)] = sequential(levels, path)
    s = spark.createDataFrame(signals, "signal_id string, instrument_id long, symbol string, sector_code string, trading_date date, entry_low double, "
                              "entry_high double, stop_price double, target_primary double, horizon_days int")
    b = spark.createDataFrame(bars, "instrument_id long, trading_date date, open double, high double, low double, close double")
    got = outcomes.signal_outcomes(outcomes.signal_bars(s, b), "m").collect()
    assert len(got) == 400 and {w[0] for w in want.values()} >= {"STOP", "TARGET", "EXPIRED", "OPEN", "NO_FILL", "PENDING"}
    for r in got:
        label, price, held, result = want[r["signal_id"]]
        assert (r["outcome_label"], r["bars_held"]) == (label, held)
        assert r["entry_price"] == (None if price is None else pytest.approx(price))
        assert r["realized_r"] == (None if result is None else pytest.approx(result, abs=1e-7))


def one_outcome(spark, *path):
    s = spark.createDataFrame([("1", 1, "S", "X", day(0), 99.0, 101.0, 95.0, 110.0, 10)],
                              "signal_id string, instrument_id long, symbol string, sector_code string, trading_date date, entry_low double, "
                              "entry_high double, stop_price double, target_primary double, horizon_days int")
    b = spark.createDataFrame([(1, day(n + 1), *bar) for n, bar in enumerate(path)],
                              "instrument_id long, trading_date date, open double, high double, low double, close double")
    return outcomes.signal_outcomes(outcomes.signal_bars(s, b), "m").first()


def test_outcome_edge_cases(spark):
    same_bar = one_outcome(spark, (102.0, 103.0, 94.0, 96.0))
    assert same_bar["outcome_label"] == "STOP" and same_bar["fill_method"] == "PULLBACK_TOUCH" and same_bar["realized_r"] == -1.0
    assert one_outcome(spark, (96.0, 98.0, 94.0, 95.0))["outcome_label"] == "CANCELLED"
    both = one_outcome(spark, (100.0, 112.0, 94.0, 100.0))
    assert both["outcome_label"] == "STOP" and both["sequence_ambiguous"]
    assert one_outcome(spark, (98.0, 98.5, 96.0, 98.0), (98.0, 99.5, 97.0, 99.0))["fill_method"] == "RECOVERY_TOUCH"


@pytest.mark.parametrize("n", [1, 2, 3, 7, 90, 170])
def test_chronological_split_sizes(spark, n):
    got = calibration.date_splits(spark.createDataFrame([(day(i),) for i in range(n)], "d date"), "d").toPandas().sort_values("d")
    if n == 1:
        want = ["TRAIN"]
    elif n == 2:
        want = ["TRAIN", "TEST"]
    else:
        train = max(1, min(math.floor(n * 0.70), n - 2))
        val = max(1, min(math.floor(n * 0.15), n - train - 1))
        want = ["TRAIN"] * train + ["VALIDATION"] * val + ["TEST"] * (n - train - val)
    assert list(got._split) == want


@pytest.mark.parametrize("price, tick", [(199, 1), (200, 2), (499.9, 2), (500, 5), (1999, 5), (2000, 10), (4999, 10), (5000, 25)])
def test_price_fraction(spark, price, tick):
    assert spark.range(1).select(execution.price_fraction(F.lit(float(price))).alias("t")).first()["t"] == tick


def test_tick_rounding_and_modeled_trade(spark):
    row = spark.range(1).select(
        execution.to_tick(F.lit(1003.2), F.lit(5.0), True).alias("up"), execution.to_tick(F.lit(1003.2), F.lit(5.0), False).alias("down"),
        execution.to_tick(F.lit(1005.0), F.lit(5.0), True).alias("same")).first()
    assert (row["up"], row["down"], row["same"]) == (1005.0, 1000.0, 1005.0)
    df = spark.createDataFrame([("STOP", 1003.2, 950.7, 951.0, 1000.0, 980.0, -1.0)],
                               "outcome_label string, raw_entry_price double, raw_exit_price double, raw_stop_price double, entry_reference_price double, exit_reference_price double, raw_realized_r double")
    got = execution.modeled_trade(df, F.lit(1), F.lit(1), F.lit(0.0), F.lit(0.0)).first()
    assert (got["modeled_entry_price"], got["modeled_exit_price"], got["modeled_stop_price"]) == (1010.0, 945.0, 950.0)
    assert got["gross_modeled_r"] == pytest.approx(-65 / 60, abs=1e-8)


def test_fragility_ladder(spark):
    rows = [("STRESS_2T", -0.1, 0.9), ("BASELINE_CONSERVATIVE", 0.1, 1.2), ("MIN_COST_ZERO_SLIPPAGE", 0.2, 1.3), ("TICK_ONLY", 0.2, 1.4)]
    df = spark.createDataFrame(rows, "scenario string, average_r double, profit_factor double")
    assert execution.fragility(df).first()["fragility"] == "ROBUST_TO_BASELINE"
    assert execution.fragility(df.withColumn("average_r", F.lit(-1.0))).first()["fragility"] == "NEGATIVE_AFTER_TICK_ROUNDING_ONLY"
