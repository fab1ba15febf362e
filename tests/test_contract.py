"""A cross-section of the registered queries against DuckDB on the smallest sample."""

import os
import sys
from pathlib import Path

import pytest

FOLDER = "/root/testdata/sf0.001"
LLM_TESTS = Path(__file__).parent / "llm"
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
NAMES = ["equity_features", "index_regimes", "market_breadth", "sector_rotation", "integrated_sector", "stock_screener", "trade_setups",
         "signal_outcomes", "execution_sensitivity", "scenario_summary", "presence_replay", "canonical_listing_dates", "market_rules",
         "page_contracts", "incremental_screener", "bar_load", "build_state", "model_delete"]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables are not here")


@pytest.fixture(scope="module")
def duck():
    import duckdb
    from check import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    import __spark_entry__ as contract
    from check import rows

    got = contract.queries()[name](spark, FOLDER).toPandas()
    want = duck.execute(contract.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_query_has_a_check():
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert {name for name in contract.queries() if name not in contract.LLM_QUERIES} <= set(contract.oracle_sql())
    for name in set(contract.queries()) - set(contract.oracle_sql()):  # beyond SQL: a test names the query
        assert any(name in file.read_text() for file in LLM_TESTS.glob("test_*.py")), name


def test_entry_is_lazy_frame(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).limit(1).count() == 1
