import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.plans import incremental, lifecycle

START, END = dt.date(2023, 1, 1), dt.date(2025, 12, 31)


def lit(d):
    return F.lit(d.isoformat()).cast("date")


def month(d):
    return d.year * 12 + d.month - 1


def events_frame(spark, events):
    return spark.createDataFrame(events, "symbol string, effective_date date, event_type string").withColumn("quality", F.lit("VALID"))


def random_events(seed):
    rng = random.Random(seed)
    out = set()
    for s in "ABCDEFGH":
        for _ in range(rng.randint(0, 5)):
            out.add((s, START + dt.timedelta(days=rng.randint(0, 1090)), rng.choice(["LISTED", "RELISTED", "DELISTED"])))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_intervals_equal_sequential_replay(spark, seed):
    events, baseline = random_events(seed), ["A", "B", "C", "Z"]
    starts, want = {s: (START, "WINDOW_BASELINE") for s in baseline}, []
    for s, d, kind in sorted(events, key=lambda e: (e[1], e[2], e[0])):
        if kind != "DELISTED":
            starts[s] = (d, kind)
        elif s in starts:
            a, why = starts.pop(s)
            want.append((s, a, d, why))
    want += [(s, a, None, why) for s, (a, why) in starts.items()]
    base = spark.createDataFrame([(s,) for s in baseline], "symbol string")
    got = [(r["symbol"], r["valid_from"], r["valid_to"], r["start_reason"]) for r in lifecycle.intervals(base, events_frame(spark, events), lit(START)).collect()]
    key = lambda r: (r[0], r[1], str(r[2]))
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("seed", [4, 5])
def test_replay_equals_sequential_replay(spark, seed):
    events, baseline = random_events(seed), ["A", "B", "Z"]
    rng = random.Random(seed)
    active, seen, want = set(baseline), {}, {}
    for m in range(month(START), month(END) + 1):
        now = set(active)
        todays = [e for e in sorted(events, key=lambda e: (e[1], e[0], e[2])) if month(e[1]) == m]
        for s, _, kind in sorted(todays, key=lambda e: (e[1], e[2])):
            now.add(s)
            active.discard(s) if kind == "DELISTED" else active.add(s)
        seen[m] = {s for s in now | {"Q"} if rng.random() > 0.1} or {"Q"}
        gone = {s for s, _, k in todays if k == "DELISTED"}
        extra = now - seen[m]
        want[m] = (len(seen[m]), len(now), len(seen[m] - now), len(extra - gone), len(extra & gone))
    observed = spark.createDataFrame([(s, m) for m, ss in seen.items() for s in ss], "symbol string, month int")
    base = spark.createDataFrame([(s,) for s in baseline], "symbol string")
    got = {r["month"]: tuple(r)[1:6] for r in lifecycle.replay(observed, base, events_frame(spark, events), lit(START), F.lit(month(END))).collect()}
    assert got == want


def test_votes(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    rows = [("x", "CONF", d1), ("y", "CONF", d1), ("x", "RES", d1), ("y", "RES", d1), ("z", "RES", d2), ("x", "ONE", d1), ("x", "TIE", d1), ("y", "TIE", d2),
            ("x", "TIE4", d1), ("y", "TIE4", d1), ("z", "TIE4", d2), ("w", "TIE4", d2)]
    df = spark.createDataFrame(rows, "source string, symbol string, listing_date date").withColumn("a", F.lit(True))
    got = {r["symbol"]: (r["status"], r["listing_date"]) for r in lifecycle.canonical_dates(df, ["symbol"]).collect()}
    assert got == {"CONF": ("CONFIRMED_MULTI_SOURCE", d1), "RES": ("CONFLICT_RESOLVED_BY_CONSENSUS", d1), "ONE": ("SINGLE_SOURCE", d1),
                   "TIE": ("UNRESOLVED_CONFLICT", None), "TIE4": ("UNRESOLVED_CONFLICT", None)}
    anchored = {r["symbol"]: (r["status"], r["quality"]) for r in lifecycle.anchored_dates(df, ["symbol"], "a").collect()}
    assert anchored["ONE"] == ("COUNT_ANCHORED_SINGLE_SOURCE", "WARNING") and anchored["RES"] == ("CONFIRMED_MULTI_SOURCE", "VALID")
    loose = {r["symbol"]: r["quality"] for r in lifecycle.anchored_dates(df.withColumn("a", F.lit(False)), ["symbol"], "a").collect()}
    assert loose["ONE"] == "REJECTED"


def test_membership_gap_is_not_a_delta(spark):
    rows = [("A", 1), ("B", 1), ("A", 2), ("C", 2), ("A", 4), ("B", 4)]
    df = spark.createDataFrame(rows, "symbol string, month int")
    got = {(r["symbol"], r["month"], r["change"]) for r in lifecycle.membership_changes(df).collect()}
    assert got == {("B", 2, "REMOVED"), ("C", 2, "ADDED")}
    again = lifecycle.removal_candidates(df).first()
    assert again["later_reappearance"] and again["classification"] == "TEMPORARY_ABSENCE_OR_DATA_GAP"


@pytest.mark.parametrize("removed, before, now, want", [
    (0, 1, 1, "NOT_APPLICABLE"), (2, 2, 2, "BOTH"), (2, 2, 0, "PREVIOUS_MONTH"), (2, None, 2, "CURRENT_MONTH"), (2, None, None, "UNKNOWN"), (2, 1, None, "NO_MATCH")])
def test_alignment(spark, removed, before, now, want):
    df = spark.createDataFrame([(removed, before, now)], "r long, b long, n long")
    assert df.select(lifecycle.alignment(F.col("r"), F.col("b"), F.col("n")).alias("a")).first()["a"] == want


STATE = dict(force=False, stored_rows=10, stored_last=END, input_last=END, stored_count=5, expected_count=5, stored_signature="a", input_signature="a",
             stored_at=1, input_at=1, state_exists=True, model_matches=True, state_rows=10, expected_rows=10)


def mode(spark, policy, **changes):
    kinds = ("force boolean, stored_rows long, stored_last date, input_last date, stored_count long, expected_count long, stored_signature string, "
             "input_signature string, stored_at long, input_at long, state_exists boolean, model_matches boolean, state_rows long, expected_rows long")
    row = {**STATE, **changes}
    names = [k.split()[0] for k in kinds.split(", ")]
    return spark.createDataFrame([tuple(row[n] for n in names)], kinds).select(incremental.build_mode(policy).alias("m")).first()["m"]


def test_build_modes(spark):
    early = dt.date(2025, 1, 1)
    assert mode(spark, incremental.MARKET_BREADTH) == "UP_TO_DATE"
    assert mode(spark, incremental.MARKET_BREADTH, stored_last=early) == "INCREMENTAL"
    assert mode(spark, incremental.MARKET_BREADTH, stored_rows=0, stored_last=None) == "FULL"
    assert mode(spark, incremental.MARKET_BREADTH, force=True) == "FULL"
    assert mode(spark, incremental.SECTOR_ROTATION, stored_count=4) == "FULL"
    assert mode(spark, incremental.INTEGRATED_SECTOR, stored_signature=None) == "FULL"
    assert mode(spark, incremental.STOCK_SCREENER, input_at=2) == "FULL"
    assert mode(spark, incremental.TRADE_SETUP, state_rows=9) == "FULL"
    assert mode(spark, incremental.TRADE_SETUP, stored_last=early) == "INCREMENTAL"
    assert mode(spark, incremental.SIGNAL_OUTCOME, stored_last=early) == "REFRESH"
    assert mode(spark, incremental.SIGNAL_OUTCOME, model_matches=False) == "FULL"
    with pytest.raises(Exception, match="ahead of its input"):
        mode(spark, incremental.MARKET_BREADTH, input_last=early)


def test_gates(spark):
    df = spark.createDataFrame([(START,), (END,)], "d date")
    incremental.coverage_gate(df, "d", 2, END)
    with pytest.raises(ValueError, match="coverage mismatch"):
        incremental.coverage_gate(df, "d", 3, END)
    a = spark.createDataFrame([("x_current_20240101",)], "model_version string")
    incremental.lineage_gate(a, a)
    with pytest.raises(ValueError, match="universe dates"):
        incremental.lineage_gate(a, spark.createDataFrame([("y_current_20240102",)], "model_version string"))
