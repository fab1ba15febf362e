import datetime as dt
import json

from pyspark.sql import functions as F

from tidemark.plans import evidence, setups


def setup_rows(spark, **changes):
    row = {f.split(" ")[0]: None for f in SETUP.split(", ")} | {"symbol": "ABCD", "setup_decision": "WATCH", "decision_reasons": ["A", "B"], "entry_low": 0.1, "ema20": 1e-7} | changes
    return spark.createDataFrame([row], SETUP)


SETUP = ", ".join(
    [f"{c} double" for c in ("overall_score market_score sector_score technical_score liquidity_score ownership_score risk_score data_completeness setup_close ema20 ema50 "
                             "rsi14 atr14 prior_low_10d prior_high_20d prior_high_55d extension_atr structure_risk_atr nearest_resistance entry_low entry_high entry_mid "
                             "invalidation_price stop_price target_primary expected_rr risk_per_share risk_pct_price capital_required planned_risk_amount").split()]
    + ["symbol string", "sector_code string", "setup_decision string", "decision_reasons array<string>", "prior_count_10d long", "horizon_days int",
       "position_size_shares long", "position_size_lots long"])


def test_setup_document_as_text(spark):
    text = setup_rows(spark).select(evidence.as_json(evidence.setup_document(versions={"screener": "v1"}))).first()[0]
    got = json.loads(text)
    assert got["setup"] == {"decision": "WATCH", "entry_low": 0.1, "decision_reasons": ["A", "B"]}  # NULL fields are left out
    assert got["price_structure"] == {"ema20": 1e-7} and got["source_versions"] == {"screener": "v1"}
    assert got["rules"]["max_price_risk_pct"] == setups.RULES.max_risk_pct and got["position_sizing"]["reference_capital"] == setups.RULES.capital
    assert got["warnings"] == [*evidence.SETUP_WARNINGS, "WAIT_FOR_PULLBACK_CONFIRMATION"]
    plain = json.loads(setup_rows(spark, setup_decision="ACCEPT").select(evidence.as_json(evidence.setup_document())).first()[0])
    assert plain["warnings"] == evidence.SETUP_WARNINGS and "source_versions" not in plain


def test_read_is_typed_and_forgiving(spark):
    texts = ['{"a":{"x":1.5,"d":"2001-02-03"},"l":["p","q"]}', '{"a":{"x":"word"}}', "{broken", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, e string")
    got = evidence.read(df, "e", ["id"], {"a.x": "double", "a.d": "date", "l": "list", "no.such": "string"}).orderBy("id").collect()
    assert tuple(got[0]) == (0, 1.5, dt.date(2001, 2, 3), "p|q", None)
    assert all(tuple(r)[1:] == (None,) * 4 for r in got[1:])


def test_a_document_needs_no_shuffle(spark):
    df = setup_rows(spark).withColumn("e", evidence.as_json(evidence.setup_document()))
    plan = evidence.read(df, "e", ["symbol"], {"setup.entry_low": "double"})._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_outcome_inputs_keep_outcomes_without_a_setup(spark):
    outcomes = spark.createDataFrame([(1, dt.date(2001, 1, 1), "s1"), (2, dt.date(2001, 1, 1), "s2")], "instrument_id long, trading_date date, signal_id string")
    plans = spark.createDataFrame([(1, dt.date(2001, 1, 1), 1.0, 2.0, 3.0, 10)], "instrument_id long, trading_date date, entry_low double, entry_high double, target_primary double, horizon_days int")
    got = evidence.outcome_inputs(outcomes, plans).orderBy("signal_id").select("signal_id", "target_primary", F.col("horizon_days")).collect()
    assert [tuple(r) for r in got] == [("s1", 3.0, 10), ("s2", None, None)]
