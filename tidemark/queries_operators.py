"""Registered queries of single operators, audits, merges and rebuilds."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import register, stage
from tidemark.functions.numeric import rnd
from tidemark.operators import keyed
from tidemark.operators.joins import asof_backward, table_diff
from tidemark.operators.ordering import medians, percent_rank
from tidemark.oracle.ctes import CTES, mean, r
from tidemark.functions import dates as date_functions
from tidemark.plans import breadth, calibration, evidence, incremental, ownership, quality, screener, setups
from tidemark.plans import features as feature_plans
from tidemark.sources import bars as bar_ops

KEY = ["instrument_id", "trading_date"]


def _lit_date(text: str):
    return F.lit(text).cast("date")


def _last(df, date="trading_date"):
    return df.agg(F.max(date).alias("d")).select("d").scalar()


# --- window kernels ---------------------------------------------------------------

_RANGE = [f"prior_{n}_{s}" for n in (20, 252) for s in ("count", "high", "low")]
stage("prior_close_ranges", lambda p: breadth.prior_close_range(p.bars), "features", KEY + _RANGE)
stage("turnover_window", lambda p: screener.turnover_window(
    p.bars, p.integrated.agg(F.min("trading_date").alias("a")).select("a").scalar(), _last(p.integrated)),
    "turnover", KEY + ["avg_turnover_20d"], {"avg_turnover_20d": 4})
stage("price_structure", lambda p: setups.price_structure(
    p.bars, p.screened.agg(F.min("trading_date").alias("a")).select("a").scalar(), _last(p.screened)),
    "structure", KEY + ["prior_low_10d", "prior_high_20d", "prior_high_55d", "prior_count_10d"])
stage("ownership_pairs", lambda p: ownership.snapshot_pairs(p.snapshots), "pairs", [
    "instrument_id", "as_of_date", "previous_as_of_date", "foreign_shares", "previous_foreign_shares", "security_number", "previous_security_number"])
register("prior_score_history", lambda p: breadth.prior_score_history(p.rotation, F.date_sub(_last(p.rotation), 10)), """
SELECT sector_code, trading_date, score FROM rotation WHERE trading_date <= (SELECT max(trading_date) - 10 FROM rotation)
QUALIFY row_number() OVER (PARTITION BY sector_code ORDER BY trading_date DESC) <= 20""")
register("turnover_percent_rank", lambda p: percent_rank(
    p.bars.select(*KEY, "volume"), p.ws, ["trading_date"], "volume", "volume_rank").select(*KEY, rnd("volume_rank", 8).alias("volume_rank")), f"""
SELECT instrument_id, trading_date, {r("percent_rank() OVER (PARTITION BY trading_date ORDER BY volume)", 8)} AS volume_rank FROM bars""")
_GAPPED = "CASE WHEN l_linenumber <> 3 THEN l_returnflag END AS g, CASE WHEN l_quantity <> 7 THEN l_discount END AS v"
register("percent_rank_with_nulls", lambda p: percent_rank(
    p.source.table("lineitem").selectExpr("l_orderkey", "l_linenumber", *_GAPPED.split(", ")), p.ws, ["g"], "v", "r").select(
    "l_orderkey", "l_linenumber", "g", "v", rnd("r", 8).alias("r")), f"""
SELECT l_orderkey, l_linenumber, g, v, {r("percent_rank() OVER (PARTITION BY g ORDER BY v NULLS LAST)", 8)} AS r FROM (SELECT l_orderkey, l_linenumber, {_GAPPED} FROM lineitem)""")
register("exact_medians", lambda p: medians(p.source.table("lineitem"), p.ws, ["l_returnflag", "l_linestatus"], ["l_quantity", "l_extendedprice"], 4), f"""
SELECT l_returnflag, l_linestatus, {r("median(l_quantity)", 4)} AS median_l_quantity, {r("median(l_extendedprice)", 4)} AS median_l_extendedprice FROM lineitem GROUP BY 1, 2""")
register("gap_audit", lambda p: quality.gap_audit(p.bars), """
SELECT instrument_id, count(*) AS bars, median(gap)::DOUBLE AS median_gap, count(*) FILTER (WHERE gap > 10) AS long_gaps, CAST(max(gap) AS INTEGER) AS longest_gap,
  count(*) FILTER (WHERE isodow(trading_date) >= 6) AS weekend_rows, count(*) FILTER (WHERE volume = 0) AS zero_volume,
  count(*) FILTER (WHERE rn > 1 AND previous_close IS DISTINCT FROM b4) AS previous_mismatch
FROM (SELECT *, trading_date - lag(trading_date) OVER w AS gap, lag(close) OVER w AS b4, row_number() OVER w AS rn FROM bars
      WINDOW w AS (PARTITION BY instrument_id ORDER BY trading_date)) GROUP BY 1""")
register("missing_previous_close", lambda p: quality.missing_previous_close(
    p.bars.withColumn("previous_close", F.when(F.col("volume") > 5, F.col("previous_close")))), """
SELECT count(*) AS missing_previous FROM (SELECT CASE WHEN volume > 5 THEN previous_close END AS pc, row_number() OVER (PARTITION BY instrument_id ORDER BY trading_date) AS rn FROM bars)
WHERE rn > 1 AND pc IS NULL""")
register("latest_features", lambda p: quality.last_rows(p.features.select(*KEY, "symbol", "close", "return_20d", rnd("ema200", 4).alias("ema200")), 1), f"""
SELECT instrument_id, trading_date, symbol, close, return_20d, {r("ema200", 4)} AS ema200 FROM features
QUALIFY row_number() OVER (PARTITION BY instrument_id ORDER BY trading_date DESC) = 1""")
register("enough_history", lambda p: feature_plans.enough_history(p.bars, 390).groupBy("instrument_id").agg(F.count(F.lit(1)).alias("bars")),
         "SELECT instrument_id, count(*) AS bars FROM bars GROUP BY 1 HAVING count(*) >= 390")

# --- joins ------------------------------------------------------------------------

_SEEN = "CASE WHEN l_suppkey % 7 <> 0 THEN l_suppkey END AS k, CASE WHEN l_linenumber <> 2 THEN CAST(l_shipdate AS DATE) END AS t"
_KNOWN = "CASE WHEN ps % 5 <> 0 THEN ps END AS k, CASE WHEN day(d) <> 1 THEN d END AS at"
register("asof_with_nulls", lambda p: asof_backward(
    p.source.table("lineitem").selectExpr("l_orderkey", "l_linenumber", *_SEEN.split(", ")),
    p.source.table("lineitem").filter("l_quantity > 45").selectExpr("l_suppkey AS ps", "CAST(l_shipdate AS DATE) AS d").distinct().selectExpr(*_KNOWN.split(", ")),
    ["k"], "t", "at", [], "left"), f"""
SELECT l_orderkey, l_linenumber, s.k, t, known AS "at" FROM (SELECT l_orderkey, l_linenumber, {_SEEN} FROM lineitem) s
ASOF LEFT JOIN (SELECT k, "at" AS known FROM (SELECT {_KNOWN.replace("AS at", 'AS "at"')} FROM (
  SELECT DISTINCT l_suppkey AS ps, CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE l_quantity > 45))) e
ON s.k = e.k AND s.t >= e.known""")
register("asof_left_ownership", lambda p: asof_backward(
    p.bars.select(*KEY, "close"), p.trends.select("instrument_id", "as_of_date", "trend_label", "signal_strength"), ["instrument_id"],
    "trading_date", "as_of_date", ["trend_label", "signal_strength"], "left"), """
SELECT b.instrument_id, b.trading_date, b.close, t.as_of_date, t.trend_label, t.signal_strength
FROM bars b ASOF LEFT JOIN trends t ON t.instrument_id = b.instrument_id AND b.trading_date >= t.as_of_date""")
register("integrated_inputs", lambda p: ownership.integrated_inputs(p.rotation, p.sector_ownership).drop("updated_at"), """
SELECT s.sector_code, s.trading_date, s.score AS technical_score, s.rotation_label AS technical_rotation_label, o.as_of_date AS ownership_as_of_date,
  o.score AS ownership_score, o.signal_label AS ownership_signal_label, o.low_coverage_flag AS ownership_low_coverage_flag
FROM rotation s ASOF JOIN sector_ownership o ON s.sector_code = o.sector_code AND s.trading_date >= o.as_of_date""")
_DAMAGE = {
    "overall_score": "CASE WHEN universe_rank % 10 = 0 THEN overall_score + 0.01 ELSE overall_score + 0.00001 END",
    "status": "CASE WHEN universe_rank % 17 = 0 THEN 'WAIT' ELSE status END"}
register("screener_diff", lambda p: table_diff(
    p.screened.filter("liquidity_score >= 10"),
    p.screened.filter("risk_score >= 72").withColumns({c: F.expr(e) for c, e in _DAMAGE.items()}),
    KEY, ["status"], ["overall_score", "technical_score"]), f"""
SELECT instrument_id, trading_date, CASE WHEN risk_score < 72 THEN 'MISSING' WHEN liquidity_score < 10 THEN 'UNEXPECTED' ELSE 'MISMATCH' END AS issue,
  CASE WHEN risk_score < 72 OR liquidity_score < 10 THEN NULL ELSE concat_ws(',', CASE WHEN s2 <> status THEN 'status' END, CASE WHEN o2 - overall_score > 0.001 THEN 'overall_score' END) END AS fields
FROM (SELECT *, {_DAMAGE["overall_score"]} AS o2, {_DAMAGE["status"]} AS s2 FROM screened)
WHERE NOT (risk_score < 72 AND liquidity_score < 10) AND (risk_score < 72 OR liquidity_score < 10 OR s2 <> status OR o2 - overall_score > 0.001)""")
register("calendar_gaps", lambda p: quality.orphans(p.raw_bars, p.index_bars, ["trading_date"]), """
SELECT count(*) AS orphan_rows FROM bars_walk WHERE trading_date NOT IN (SELECT trading_date FROM index_bars)""")
register("orphan_features", lambda p: quality.orphans(p.features, p.bars.filter("volume > 3"), KEY), "SELECT count(*) AS orphan_rows FROM bars WHERE NOT volume > 3")
register("symbol_lookup_unmapped", lambda p: p.source.table("lineitem").select(F.col("l_suppkey").alias("instrument_id")).join(
    p.instruments.filter("sector_code <> 'ASIA'").select("instrument_id"), "instrument_id", "left_anti").distinct(),
    "SELECT DISTINCT l_suppkey AS instrument_id FROM lineitem WHERE l_suppkey NOT IN (SELECT instrument_id FROM instruments WHERE sector_code <> 'ASIA')")

# --- aggregates and states --------------------------------------------------------

_BREADTH_IN = ["trading_date", "eligible_count", "advances", "declines", "unchanged", "pct_above_ema20", "pct_above_ema50", "pct_above_ema200",
               "up_volume", "down_volume", "new_high_20d", "new_low_20d", "new_high_52w", "new_low_52w"]
stage("breadth_inputs", lambda p: breadth.breadth_inputs(p.ranged), "breadth_daily", _BREADTH_IN)
stage("sector_inputs", lambda p: breadth.sector_inputs(p.features, p.index_features), "sector_daily", [
    "trading_date", "sector_code", "eligible_count", "advances", "declines", "unchanged", "sector_return_20d", "sector_return_60d",
    "index_return_20d", "index_return_60d", "up_volume", "down_volume"], {"sector_return_20d": 8, "sector_return_60d": 8})
register("screener_coverage", lambda p: quality.coverage(p.screened, "instrument_id", "trading_date"), """
SELECT count(*) AS rows, count(DISTINCT instrument_id) AS keys, count(DISTINCT trading_date) AS dates, min(trading_date) AS first_date, max(trading_date) AS last_date FROM screened""")
register("screener_coverage_after", lambda p: quality.coverage(p.screened, "instrument_id", "trading_date", _lit_date("2000-06-30")), """
SELECT count(*) AS rows, count(DISTINCT instrument_id) AS keys, count(DISTINCT trading_date) AS dates, min(trading_date) AS first_date, max(trading_date) AS last_date
FROM screened WHERE trading_date > DATE '2000-06-30'""")
register("screener_latest_state", lambda p: quality.latest_state(p.screened, "trading_date", "instrument_id", "sector_code").select(
    "latest_date", "latest_rows", "latest_groups", F.to_date("newest_input_at").alias("newest_input_on")), """
SELECT trading_date AS latest_date, count(*) AS latest_rows, count(DISTINCT sector_code) AS latest_groups,
  (SELECT max(input_updated_at) FROM screened) AS newest_input_on FROM screened WHERE trading_date = (SELECT max(trading_date) FROM screened) GROUP BY 1""")
register("integrated_signature", lambda p: quality.signature(p.integrated, "trading_date", "sector_code", "ownership_as_of_date"), """
SELECT trading_date, string_agg(DISTINCT sector_code || ':' || ownership_as_of_date, ',' ORDER BY sector_code || ':' || ownership_as_of_date) AS signature
FROM integrated WHERE trading_date = (SELECT max(trading_date) FROM integrated) GROUP BY 1""")
register("latest_model", lambda p: quality.latest_model(p.screened.withColumn(
    "model_version", F.when(F.col("status") == "AVOID", F.col("model_version")).otherwise("stock_screener_v0_current_19990101")).filter(
    "model_version not like '%v0%' or trading_date < '2001-01-01'"), "stock_screener", "trading_date"), """
SELECT model_version, max(trading_date) AS latest_date, count(*) AS rows FROM screened WHERE status = 'AVOID' GROUP BY 1""")
register("status_distribution", lambda p: quality.distribution(p.screened, "status"), "SELECT status, count(*) AS rows FROM screened GROUP BY 1")
register("outcome_distribution", lambda p: quality.distribution(p.outcomes, "outcome_label", "entry_filled"),
         "SELECT outcome_label, entry_filled, count(*) AS rows FROM outcomes GROUP BY 1, 2")
register("decision_distribution", lambda p: quality.distribution(p.setups, "setup_decision", "status"),
         "SELECT setup_decision, status, count(*) AS rows FROM setups GROUP BY 1, 2")
register("regime_distribution", lambda p: quality.distribution(p.regimes, "direction", "regime"), "SELECT direction, regime, count(*) AS rows FROM regimes GROUP BY 1, 2")
register("duplicate_lines", lambda p: keyed.duplicate_keys(p.source.table("lineitem"), ["l_orderkey", "l_linenumber"]),
         "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) <> 1")
_REPORT = "SELECT symbol, count(trading_date) AS rows, min(trading_date) AS first_date, max(trading_date) AS last_date, CAST(DATE '2001-11-04' - max(trading_date) AS INTEGER) AS gap_days FROM instruments n LEFT JOIN bars b ON b.instrument_id = n.instrument_id GROUP BY 1"


def _report(p):
    return quality.history_report(p.bars, p.instruments, _lit_date("2001-11-04"))


register("history_report", _report, _REPORT)
register("sparse_histories", lambda p: _report(p).filter("rows < 375"), f"SELECT * FROM ({_REPORT}) WHERE rows < 375")
register("largest_histories", lambda p: _report(p).orderBy(F.col("rows").desc(), "symbol").limit(20), f"SELECT * FROM ({_REPORT}) ORDER BY rows DESC, symbol LIMIT 20")
register("stale_histories", lambda p: _report(p).filter("gap_days > 0").orderBy(F.col("gap_days").desc(), "symbol").limit(20),
         f"SELECT * FROM ({_REPORT}) WHERE gap_days > 0 ORDER BY gap_days DESC, symbol LIMIT 20")

# --- rankings -----------------------------------------------------------------------

register("latest_screener_ranking", lambda p: p.screened.filter(F.col("trading_date") == _last(p.screened)).select(
    "symbol", "sector_code", "overall_score", "universe_rank", "sector_rank", "status").orderBy("universe_rank"), """
SELECT symbol, sector_code, overall_score, universe_rank, sector_rank, status FROM screened WHERE trading_date = (SELECT max(trading_date) FROM screened)""")
register("latest_sector_ranking", lambda p: p.integrated.filter(F.col("trading_date") == _last(p.integrated)).select(
    "sector_code", "integrated_score", "integrated_label", "alignment_label").orderBy(F.col("integrated_score").desc()), """
SELECT sector_code, integrated_score, integrated_label, alignment_label FROM integrated WHERE trading_date = (SELECT max(trading_date) FROM integrated)""")
_SETUP_COLUMNS = ["instrument_id", "symbol", "trading_date", "setup_decision", "status", "entry_low", "entry_high", "stop_price", "expected_rr"]
register("setup_list", lambda p: p.setups.filter(F.col("trading_date") == _last(p.setups)).select(*_SETUP_COLUMNS).orderBy(
    F.when(F.col("setup_decision") == "ACCEPT", 1).when(F.col("setup_decision") == "WATCH", 2).otherwise(3),
    F.col("expected_rr").desc_nulls_last(), "symbol"), f"""
SELECT {", ".join(_SETUP_COLUMNS)} FROM setups WHERE trading_date = (SELECT max(trading_date) FROM setups)""")
register("recent_screener_dates", lambda p: quality.recent_dates(p.screened, "trading_date", 20),
         "SELECT DISTINCT trading_date FROM screened ORDER BY trading_date DESC LIMIT 20")
register("top_candidates", lambda p: p.screened.filter(F.col("trading_date") == _last(p.screened)).filter("status <> 'AVOID'").orderBy("universe_rank").select(
    "symbol", "overall_score", "status", "universe_rank").limit(30), """
SELECT symbol, overall_score, status, universe_rank FROM screened WHERE trading_date = (SELECT max(trading_date) FROM screened) AND status <> 'AVOID' ORDER BY universe_rank LIMIT 30""")
register("recent_outcomes", lambda p: p.outcomes.orderBy(F.col("trading_date").desc(), "symbol").select(
    "signal_id", "symbol", "trading_date", "outcome_label", "realized_r").limit(20), """
SELECT signal_id, symbol, trading_date, outcome_label, realized_r FROM outcomes ORDER BY trading_date DESC, symbol LIMIT 20""")
_LEADER_COLUMNS = ["instrument_id", "foreign_ownership_pct", "delta_foreign_ownership_pp", "delta_foreign_shares", "trend_label"]
register("ownership_leaders", lambda p: p.trends.filter(F.col("as_of_date") == _last(p.trends, "as_of_date")).join(
    p.instruments.select("instrument_id", "symbol", "sector_code"), "instrument_id").select("symbol", "sector_code", *_LEADER_COLUMNS).orderBy(
    F.col("delta_foreign_ownership_pp").desc(), "instrument_id"), f"""
SELECT i.symbol, i.sector_code, {", ".join("t." + c for c in _LEADER_COLUMNS)} FROM trends t JOIN instruments i ON i.instrument_id = t.instrument_id
WHERE t.as_of_date = (SELECT max(as_of_date) FROM trends)""")

# --- validation, deduplication, merges ----------------------------------------------


def _index_candidates(p):
    return p.source.index_bars(p.raw_bars).withColumn("adjusted_close", F.when(F.day("trading_date") % 9 == 0, F.lit(0.0)).otherwise(F.col("close")))


register("index_bar_validation", lambda p: bar_ops.validate_index_bars(_index_candidates(p)).select(
    "trading_date", "quality", F.array_join("reasons", "|").alias("reasons")), """
SELECT trading_date, CASE WHEN reasons = '' THEN 'VALID' ELSE 'REJECTED' END AS quality, reasons FROM (
SELECT DISTINCT trading_date, concat_ws('|', CASE WHEN isodow(trading_date) >= 6 THEN 'Trading date falls on a weekend.' END,
  CASE WHEN day(trading_date) % 9 = 0 THEN 'Adjusted close is zero or negative.' END) AS reasons FROM bars_walk)""")
register("index_quality_summary", lambda p: bar_ops.validate_index_bars(_index_candidates(p)).agg(
    F.count(F.lit(1)).alias("total_rows"), F.min("trading_date").alias("first_date"), F.max("trading_date").alias("last_date"),
    F.count_if(F.col("quality") == "VALID").alias("valid_rows"), F.count_if(F.col("quality") == "REJECTED").alias("rejected_rows")), """
SELECT count(*) AS total_rows, min(trading_date) AS first_date, max(trading_date) AS last_date, count(*) FILTER (WHERE ok) AS valid_rows, count(*) FILTER (WHERE NOT ok) AS rejected_rows
FROM (SELECT DISTINCT trading_date, isodow(trading_date) < 6 AND day(trading_date) % 9 <> 0 AS ok FROM bars_walk)""")


def _arrivals(p):
    """Daily bars as they arrive, some twice and some broken."""
    rows = p.raw_bars.select(*KEY, "open", "high", "low", "close", "volume", F.lit(0).alias("arrival"))
    again = rows.filter("volume > 30").withColumns({"arrival": F.lit(1), "close": F.col("close") + 1})
    broken = F.pmod(F.col("instrument_id") + F.unix_date("trading_date"), F.lit(40)) == 0
    return rows.unionByName(again).withColumns({
        "low": F.when(broken, -F.col("low")).otherwise(F.col("low")), "volume": F.when(broken, -F.col("volume")).otherwise(F.col("volume")),
        "listed": F.date_add(_lit_date("1995-01-02"), (F.col("instrument_id") % 50).cast("int")), "target": _lit_date("2001-06-30")})


CTES["arrivals"] = """
SELECT *, isodow(trading_date) >= 6 AS e1, trading_date < DATE '1995-01-02' + CAST(instrument_id % 50 AS INTEGER) AS e2, trading_date > DATE '2001-06-30' AS e3, broken AS e4
FROM (SELECT *, (instrument_id + (trading_date - DATE '1970-01-01')) % 40 = 0 AS broken FROM bars_walk)"""
register("bar_rejections", lambda p: bar_ops.rejection_counts(_arrivals(p), KEY, [F.col("arrival")], "listed", "target"), """
SELECT * FROM (SELECT 'DUPLICATE_DATE' AS reason, count(*) AS bars FROM arrivals WHERE volume > 30
UNION ALL SELECT 'WEEKEND_BAR', count(*) FROM arrivals WHERE e1 UNION ALL SELECT 'BEFORE_LISTING_DATE', count(*) FROM arrivals WHERE e2
UNION ALL SELECT 'AFTER_TARGET_END_DATE', count(*) FROM arrivals WHERE e3 UNION ALL SELECT 'NON_POSITIVE_LOW', count(*) FROM arrivals WHERE e4
UNION ALL SELECT 'NEGATIVE_VOLUME', count(*) FROM arrivals WHERE e4) WHERE bars > 0""")
register("accepted_bars", lambda p: bar_ops.accepted_bars(_arrivals(p), KEY, [F.col("arrival")], "listed", "target").select(*KEY, "close"),
         "SELECT instrument_id, trading_date, close FROM arrivals WHERE NOT e1 AND NOT e2 AND NOT e3 AND NOT e4")
def _repeated(p, parity: int):
    return p.source.table("lineitem").filter(F.pmod("l_linenumber", F.lit(2)) == parity).select(
        F.col("l_partkey").alias("part"), F.col("l_orderkey").alias("arrival"), F.col("l_linenumber").alias("line"), F.col("l_extendedprice").alias("price"))


register("upsert_repeated_keys", lambda p: keyed.upsert(_repeated(p, 0), _repeated(p, 1), ["part"], "arrival"), """
SELECT part, arrival, line, price FROM (SELECT l_partkey AS part, l_orderkey AS arrival, l_linenumber AS line, l_extendedprice AS price,
  row_number() OVER (PARTITION BY l_partkey ORDER BY l_linenumber % 2 DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) AS i FROM lineitem) WHERE i = 1""")
register("price_upsert", lambda p: keyed.upsert(
    p.bars.filter("volume < 40").select(*KEY, "close"), p.bars.filter("volume > 20").select(*KEY, (F.col("close") * 2).alias("close")), KEY), """
SELECT instrument_id, trading_date, CASE WHEN volume > 20 THEN close * 2 ELSE close END AS close FROM bars WHERE volume < 40 OR volume > 20""")
register("instrument_merge", lambda p: keyed.merge_keep_known(
    p.instruments.select("symbol", "sector_code", F.create_map(F.lit("a"), F.lit("old"), F.lit("b"), F.lit("old")).alias("metadata")),
    p.instruments.filter("sector_code <> 'ASIA'").select(
        "symbol", F.when(F.col("sector_code") == "EUROPE", "NEW").alias("sector_code"), F.create_map(F.lit("b"), F.lit("new"), F.lit("c"), F.lit("new")).alias("metadata")),
    ["symbol"], ["metadata"]).select("symbol", "sector_code", *[F.element_at("metadata", k).alias(f"meta_{k}") for k in "abc"]), """
SELECT symbol, CASE WHEN sector_code = 'EUROPE' THEN 'NEW' ELSE sector_code END AS sector_code, 'old' AS meta_a, CASE WHEN sector_code <> 'ASIA' THEN 'new' ELSE 'old' END AS meta_b,
  CASE WHEN sector_code <> 'ASIA' THEN 'new' END AS meta_c FROM instruments""")


def _availability(p, shift: int):
    rank = (F.col("o_orderkey") + F.col("o_custkey") * shift) % 3
    return p.source.table("orders").select(
        "o_orderkey", F.when(rank == 0, "UNKNOWN").when(rank == 1, "ESTIMATED").otherwise("KNOWN").alias("availability_status"), F.lit(shift).alias("batch"))


def _rank():
    s = F.col("availability_status")
    return F.when(s == "KNOWN", 3).when(s == "ESTIMATED", 2).otherwise(1)


register("availability_upsert", lambda p: keyed.replace_if_better(_availability(p, 1), _availability(p, 2), ["o_orderkey"], _rank()), """
SELECT o_orderkey, CASE WHEN b > a THEN n[b + 1] ELSE n[a + 1] END AS availability_status, CASE WHEN b > a THEN 2 ELSE 1 END AS batch
FROM (SELECT o_orderkey, (o_orderkey + o_custkey) % 3 AS a, (o_orderkey + o_custkey * 2) % 3 AS b, ['UNKNOWN', 'ESTIMATED', 'KNOWN'] AS n FROM orders)""")


def _probes(p):
    return p.source.table("events").select(
        F.concat(F.lit("SRC"), F.col("user_id").cast("string")).alias("source_key"), F.col("ts").alias("probed_at"), "event_id", "event_type",
        (F.col("value") > 5).alias("success"))


register("latest_probes", lambda p: quality.latest_per_key(_probes(p), ["source_key"], "probed_at").select("source_key", "event_id", "success"), """
SELECT 'SRC' || user_id AS source_key, event_id, value > 5 AS success FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
FAMILIES = ["LIFECYCLE", "BOARD_HISTORY", "CORPORATE_ACTION"]


def _catalog(p):
    keys = p.source.table("events").select("user_id").distinct()
    return keys.select(F.concat(F.lit("SRC"), F.col("user_id").cast("string")).alias("source_key"), F.get(
        F.array(*[F.lit(f) for f in FAMILIES]), (F.col("user_id") % 3).cast("int")).alias("dataset_family"))


register("source_readiness", lambda p: quality.readiness(_catalog(p), _probes(p).filter("success or event_type = 'error'"), FAMILIES), """
SELECT *, lifecycle_reachable AND board_history_reachable AND corporate_action_reachable AS ready_for_parser_work FROM (
SELECT count(*) AS source_total, count(ok) AS probes_present, count(*) FILTER (WHERE ok) AS successful_probes, coalesce(bool_or(ok AND user_id % 3 = 0), false) AS lifecycle_reachable,
  coalesce(bool_or(ok AND user_id % 3 = 1), false) AS board_history_reachable, coalesce(bool_or(ok AND user_id % 3 = 2), false) AS corporate_action_reachable
FROM (SELECT DISTINCT user_id FROM events) LEFT JOIN (SELECT user_id, value > 5 AS ok FROM events WHERE value > 5 OR event_type = 'error'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) USING (user_id))""")
register("source_families", lambda p: quality.distribution(_catalog(p), "dataset_family"), """
SELECT ['LIFECYCLE', 'BOARD_HISTORY', 'CORPORATE_ACTION'][user_id % 3 + 1] AS dataset_family, count(DISTINCT user_id) AS rows FROM events GROUP BY 1""")

# --- audits: each table as built, and with known damage --------------------------------


def audit(name: str, rule_set: str, run, cte: str, damage: dict[str, str], prepare: dict[str, tuple[str, str]] | None = None) -> None:
    """Count rule violations of a damaged copy; ``prepare`` adds (spark, sql) helper columns."""
    prepare = prepare or {}
    rules = quality.RULES[rule_set]

    def spark_side(p):
        df = run(p).withColumns({c: F.expr(e) for c, (e, _) in prepare.items()}) if prepare else run(p)
        return quality.rule_counts(df.withColumns({c: F.expr(e) for c, e in damage.items()}), rules)

    extra = "".join(f", {e} AS {c}" for c, (_, e) in prepare.items())
    counts = ", ".join(f"count(*) FILTER (WHERE {test}) AS {n}" for n, test in rules.items())
    replaced = ", ".join(f"{e} AS {c}" for c, e in damage.items())
    register(name, spark_side, f"""
SELECT check_name, bad_rows FROM (UNPIVOT (SELECT {counts} FROM (SELECT * REPLACE ({replaced}) FROM (SELECT *{extra} FROM {cte}))) ON COLUMNS(*) INTO NAME check_name VALUE bad_rows)""")


_REASONS = {"reason_count": ("size(decision_reasons)", "CASE WHEN decision_reasons = '' THEN 0 ELSE len(string_split(decision_reasons, '|')) END")}
audit("audit_setups", "setups", lambda p: p.setups, "setups", {
    "setup_decision": "CASE WHEN instrument_id % 9 = 0 THEN NULL WHEN instrument_id % 9 = 1 THEN 'ACCEPT' ELSE setup_decision END",
    "status": "CASE WHEN instrument_id % 7 = 0 THEN 'WATCH' ELSE status END"}, _REASONS)
audit("audit_outcomes", "outcomes", lambda p: p.outcomes, "outcomes", {
    "outcome_label": "CASE WHEN instrument_id % 5 = 0 THEN 'TARGET' WHEN instrument_id % 5 = 1 THEN 'OTHER' WHEN instrument_id % 5 = 2 THEN 'OPEN' ELSE outcome_label END",
    "entry_price": "CASE WHEN instrument_id % 4 = 0 THEN NULL ELSE coalesce(entry_price, 1.0) END"})
audit("audit_calibration", "calibration", lambda p: p.calibration, "calibration", {
    "split_label": "CASE WHEN instrument_id % 6 = 0 THEN 'EXCLUDED' ELSE split_label END",
    "sample_status": "CASE WHEN instrument_id % 5 = 0 THEN 'UNFILLED_COMPLETE' ELSE sample_status END",
    "exit_date": "CASE WHEN instrument_id % 4 = 0 THEN signal_date ELSE exit_date END"})
audit("audit_execution", "execution", lambda p: p.execution, "execution", {
    "modeled_exit_price": "CASE WHEN instrument_id % 4 = 0 THEN NULL ELSE modeled_exit_price END",
    "entry_tick_size": "CASE WHEN instrument_id % 5 = 0 THEN -1.0 ELSE entry_tick_size END",
    "strict_calibration_eligible": "instrument_id % 7 = 0"},
    {"blocker_count": ("size(blocking_reasons)", "len(string_split(blocking_reasons, '|'))")})
audit("audit_breadth", "breadth", lambda p: p.breadth, "breadth", {
    "advances": "CASE WHEN advances > declines THEN -advances ELSE advances END", "breadth_score": "breadth_score * 1.5",
    "pct_above_ema50": "CASE WHEN unchanged > 0 THEN NULL ELSE pct_above_ema50 + 20 END"})
audit("audit_rotation", "rotation", lambda p: p.rotation, "rotation", {
    "score": "score * 1.6", "rotation_label": "CASE WHEN eligible_count % 5 = 0 THEN 'UP' ELSE rotation_label END"})
audit("audit_snapshots", "snapshots", lambda p: p.snapshots, "snapshots", {
    "foreign_ownership_pct": "CASE WHEN instrument_id % 8 = 0 THEN NULL WHEN instrument_id % 8 = 1 THEN 120.0 ELSE foreign_ownership_pct END",
    "local_shares": "CASE WHEN instrument_id % 6 = 0 THEN local_shares + 1 ELSE local_shares END"})
audit("audit_trends", "trends", lambda p: p.trends, "trends", {
    "delta_foreign_shares": "CASE WHEN instrument_id % 5 = 0 THEN delta_foreign_shares + 7 ELSE delta_foreign_shares END",
    "trend_label": "CASE WHEN instrument_id % 6 = 0 THEN 'FLAT' ELSE trend_label END", "snapshot_gap_flag": "NOT snapshot_gap_flag"})
audit("audit_features", "features", lambda p: p.features, "features", {
    "rsi14": "CASE WHEN instrument_id % 5 = 0 THEN rsi14 + 60 ELSE rsi14 END", "atr14": "CASE WHEN instrument_id % 6 = 0 THEN -atr14 ELSE atr14 END"})
audit("audit_prices", "prices", lambda p: p.raw_bars, "bars_walk", {"low": "CASE WHEN instrument_id % 5 = 0 THEN close + 1 ELSE low END"}, {
    "is_weekend": ("weekday(trading_date) >= 5", "isodow(trading_date) >= 6"),
    "listed_date": ("date_add(date'1995-01-01', cast(instrument_id % 400 as int))", "DATE '1995-01-01' + CAST(instrument_id % 400 AS INTEGER)")})
audit("audit_sensitivity", "sensitivity", lambda p: p.sensitivity, "sensitivity", {
    "stored_baseline_net_r": "CASE WHEN split_label = 'TEST' THEN stored_baseline_net_r + 1 ELSE stored_baseline_net_r END",
    "risk_tick_bucket": "CASE WHEN split_label = 'TRAIN' THEN NULL ELSE risk_tick_bucket END"})
register("screener_warnings", lambda p: p.screened.join(
    p.trends.select("instrument_id", F.col("as_of_date").alias("ownership_as_of_date"), F.col("corporate_action_risk").alias("_risk")),
    ["instrument_id", "ownership_as_of_date"], "left").select(
    *KEY, F.array_join(screener.screener_warnings(), "|").alias("warnings")), """
SELECT s.instrument_id, s.trading_date, concat_ws('|', 'SCREENING_ONLY_NOT_EXECUTABLE_SIGNAL', 'YAHOO_EOD_IS_THIRD_PARTY_MARKET_DATA',
  'HISTORICAL_KSEI_AS_OF_DATE_IS_NOT_PUBLICATION_TIME_SAFE', 'RS_SECTOR_20D_UNAVAILABLE_USING_IHSG_ONLY',
  CASE WHEN volume_z20 IS NULL THEN 'VOLUME_Z20_UNAVAILABLE_NEUTRAL_FALLBACK' END, CASE WHEN ownership_as_of_date IS NULL THEN 'STOCK_OWNERSHIP_UNAVAILABLE' END,
  CASE WHEN ownership_stale_flag THEN 'STOCK_OWNERSHIP_STALE' END, CASE WHEN sector_ownership_stale_flag THEN 'SECTOR_OWNERSHIP_STALE' END,
  CASE WHEN t.corporate_action_risk THEN 'OWNERSHIP_CORPORATE_ACTION_RISK' END, CASE WHEN failed_breakout_flag THEN 'FAILED_BREAKOUT' END) AS warnings
FROM screened s LEFT JOIN trends t ON t.instrument_id = s.instrument_id AND t.as_of_date = s.ownership_as_of_date""")
register("outcome_evidence", lambda p: evidence.outcome_inputs(p.outcomes, p.setups).withColumn("e", evidence.as_json(evidence.outcome_document())).select(
    "signal_id", F.get_json_object("e", "$.entry_model.fill_method").alias("fill_method"),
    F.get_json_object("e", "$.returns.realized_r").try_cast("double").alias("realized_r"),
    F.size(F.from_json(F.get_json_object("e", "$.warnings"), "array<string>")).alias("warning_count")), """
SELECT signal_id, fill_method, realized_r, CAST(CASE WHEN sequence_ambiguous THEN 9 ELSE 8 END AS INTEGER) AS warning_count FROM outcomes""")
register("calibration_evidence", lambda p: p.calibration.withColumn("e", evidence.as_json(evidence.calibration_document())).select(
    "signal_id", F.get_json_object("e", "$.split.label").alias("split_label"), F.get_json_object("e", "$.labels.outcome_label").alias("outcome_label"),
    F.get_json_object("e", "$.labels.positive_r_label").alias("positive_r_label")), """
SELECT signal_id, split_label, outcome_label, CAST(positive_r_label AS VARCHAR) AS positive_r_label FROM calibration""")
register("newest_inputs", lambda p: p.source.table("orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("a"), F.when(
    F.col("o_orderstatus") == "F", F.date_add(F.to_date("o_orderdate"), 2).cast("timestamp")).alias("b")).select(
    "o_orderkey", F.to_date(date_functions.newest_input(["a"], ["b"])).alias("input_updated_on")), """
SELECT o_orderkey, CAST(o_orderdate AS DATE) + CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 0 END AS input_updated_on FROM orders""")
register("audit_scenario_coverage", lambda p: quality.scenario_coverage(
    p.sensitivity.filter("scenario <> 'STRESS_2T' or raw_risk_ticks > 8"), ["TICK_ONLY", "MIN_COST_ZERO_SLIPPAGE", "BASELINE_CONSERVATIVE", "STRESS_2T"]), """
SELECT signal_id, count(*) AS rows, count(DISTINCT scenario) AS scenarios FROM sensitivity WHERE scenario <> 'STRESS_2T' OR raw_risk_ticks > 8 GROUP BY 1 HAVING count(*) <> 4""")
register("technical_coverage", lambda p: quality.technical_coverage(
    p.bars, p.features.filter("sector_code <> 'AFRICA' and (sector_code <> 'ASIA' or trading_date < '2001-06-01')")), """
SELECT count(*) FILTER (WHERE n >= 15) AS eligible_instruments, count(*) FILTER (WHERE n >= 200) AS screen_eligible, count(*) FILTER (WHERE n < 15) AS insufficient_history,
  count(f) AS feature_instruments, count(*) FILTER (WHERE n >= 15 AND coalesce(f = n AND fl = l, false)) AS up_to_date, count(*) FILTER (WHERE n >= 15 AND NOT coalesce(f = n AND fl = l, false)) AS stale_or_missing
FROM (SELECT instrument_id, count(*) AS n, max(trading_date) AS l FROM bars GROUP BY 1)
LEFT JOIN (SELECT instrument_id, count(*) AS f, max(trading_date) AS fl FROM bars JOIN instruments USING (instrument_id) WHERE sector_code <> 'AFRICA' AND (sector_code <> 'ASIA' OR trading_date < DATE '2001-06-01') GROUP BY 1) USING (instrument_id)""")
register("stale_instruments", lambda p: quality.bar_feature_coverage(
    p.bars, p.features.filter("sector_code <> 'ASIA' or trading_date < '2001-06-01'")).filter("not up_to_date").select("instrument_id", "price_rows", "feature_rows"), """
SELECT instrument_id, n AS price_rows, f AS feature_rows FROM (SELECT instrument_id, count(*) AS n, count(*) FILTER (WHERE trading_date < DATE '2001-06-01') AS f,
  max(trading_date) AS l FROM bars JOIN instruments USING (instrument_id) WHERE sector_code = 'ASIA' GROUP BY 1) WHERE l >= DATE '2001-06-01'""")
register("reference_closes", lambda p: quality.reference_closes(p.index_bars, p.source.table("orders").filter("o_orderpriority = '1-URGENT'").groupBy(
    F.to_date("o_orderdate").alias("trading_date")).agg(rnd(F.lit(1000.0) + F.min("o_custkey") % 7, 2).alias("official_close")), 3.0), """
SELECT o.trading_date, official_close, close, CASE WHEN close IS NULL THEN 'MISSING' WHEN abs(close - official_close) <= 3.0 THEN 'PASS' ELSE 'FAIL' END AS verdict
FROM (SELECT CAST(o_orderdate AS DATE) AS trading_date, (1000 + min(o_custkey) % 7)::DOUBLE AS official_close FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) o
LEFT JOIN index_bars b ON b.trading_date = o.trading_date""")
register("instrument_summary", lambda p: p.instruments.agg(
    F.count(F.lit(1)).alias("equities"), F.count_if(F.col("sector_code") != "ASIA").alias("active"), F.count_if(F.col("sector_code").isNull()).alias("missing_sector"),
    F.count_distinct("sector_code").alias("sectors")), """
SELECT count(*) AS equities, count(*) FILTER (WHERE sector_code <> 'ASIA') AS active, count(*) FILTER (WHERE sector_code IS NULL) AS missing_sector, count(DISTINCT sector_code) AS sectors FROM instruments""")
register("index_summary", lambda p: p.regimes.agg(
    F.count(F.lit(1)).alias("rows"), F.min("trading_date").alias("first_date"), F.max("trading_date").alias("last_date"),
    F.max_by("regime", "trading_date").alias("latest_regime"), F.max_by("composite_score", "trading_date").alias("latest_score")), """
SELECT count(*) AS rows, min(trading_date) AS first_date, max(trading_date) AS last_date, arg_max(regime, trading_date) AS latest_regime, arg_max(composite_score, trading_date) AS latest_score FROM regimes""")
register("ownership_latest_coverage", lambda p: p.instruments.select("instrument_id").join(
    p.snapshots.filter(F.col("as_of_date") == _last(p.snapshots, "as_of_date")).select("instrument_id", F.lit(1).alias("s")), "instrument_id", "left").agg(
    F.count(F.lit(1)).alias("expected_current"), F.count("s").alias("stored_current"), F.count_if(F.col("s").isNull()).alias("missing_current")), """
SELECT count(*) AS expected_current, count(s) AS stored_current, count(*) - count(s) AS missing_current FROM instruments LEFT JOIN (SELECT instrument_id, 1 AS s FROM snapshots
WHERE as_of_date = (SELECT max(as_of_date) FROM snapshots)) USING (instrument_id)""")

# --- rebuilds: incremental equals full -------------------------------------------------

AFTER = "(SELECT max(trading_date) - 120 FROM bars)"
_NONE = "0::BIGINT AS missing_keys, 0::BIGINT AS unexpected_keys, 0::BIGINT AS mismatch_keys"


def _cut(p):
    """The date that incremental builds start after: 120 days before the last bar."""
    return F.date_sub(_last(p.bars), 120)


def _after(p, df, date="trading_date"):
    return df.filter(F.col(date) > _cut(p))


register("incremental_breadth", lambda p: quality.compare_counts(
    incremental.breadth_after(p.bars, p.features, _cut(p), "u"), _after(p, p.breadth), ["trading_date"],
    [c for c in _BREADTH_IN if c not in ("trading_date",) and "pct" not in c and "volume" not in c], ["pct_above_ema20", "breadth_score", "up_volume"]),
    f"SELECT count(*) AS generated_rows, {_NONE} FROM breadth WHERE trading_date > {AFTER}")
register("incremental_rotation", lambda p: quality.compare_counts(
    incremental.rotation_after(p.features, p.index_features, p.rotation, _cut(p), "m"), _after(p, p.rotation), ["trading_date", "sector_code"],
    ["rotation_label", "eligible_count"], ["score", "score_change_20d"]),
    f"SELECT count(*) AS generated_rows, {_NONE} FROM rotation WHERE trading_date > {AFTER}")
register("incremental_trends", lambda p: quality.compare_counts(
    _after(p, ownership.ownership_trends(incremental.bounded_history(p.snapshots, _cut(p), 1, date="as_of_date"), "m"), "as_of_date"),
    _after(p, p.trends, "as_of_date"), ["instrument_id", "as_of_date"], ["trend_label", "snapshot_gap_flag"], ["delta_foreign_ownership_pp", "signal_strength"]),
    f"SELECT count(*) AS generated_rows, {_NONE} FROM trends WHERE as_of_date > {AFTER}")
register("incremental_sector_ownership", lambda p: quality.compare_counts(
    ownership.sector_ownership(ownership.sector_ownership_inputs(_after(p, p.trends, "as_of_date"), p.instruments), "m"),
    _after(p, p.sector_ownership, "as_of_date"), ["as_of_date", "sector_code"], ["signal_label", "clean_count"], ["score", "breadth_score"]),
    f"SELECT count(*) AS generated_rows, {_NONE} FROM sector_ownership WHERE as_of_date > {AFTER}")
register("incremental_integrated", lambda p: quality.compare_counts(
    ownership.integrated_sector(ownership.integrated_inputs(_after(p, p.rotation), p.sector_ownership), "m"), _after(p, p.integrated),
    ["trading_date", "sector_code"], ["integrated_label", "alignment_label", "ownership_as_of_date"], ["integrated_score"]),
    f"SELECT count(*) AS generated_rows, {_NONE} FROM integrated WHERE trading_date > {AFTER}")
_SCORES = ["overall_score", "technical_score", "liquidity_score", "ownership_score", "risk_score"]
register("incremental_screener", lambda p: quality.compare_counts(
    p.screened_after(_cut(p)), _after(p, p.screened), KEY, ["status", "universe_rank", "sector_rank", "input_updated_at", "ownership_as_of_date"], _SCORES),
    f"SELECT count(*) AS generated_rows, {_NONE} FROM screened WHERE trading_date > {AFTER}")


def _setups_after(p):
    structure = setups.price_structure(incremental.bounded_history(p.bars, _cut(p), 56), _lit_date("1900-04-01"), _lit_date("2100-01-01"))
    chosen = _after(p, p.screened).filter("status = 'BUY_SETUP'").select(
        "instrument_id", "symbol", "sector_code", "trading_date", "overall_score", "market_score", "sector_score", "technical_score",
        "liquidity_score", "ownership_score", "risk_score", "data_completeness", "input_updated_at")
    return setups.trade_setups(setups.candidate_inputs(chosen, p.features, structure), "m")


register("incremental_setups", lambda p: quality.compare_counts(
    _setups_after(p), _after(p, p.setups), KEY, ["setup_decision", "status", "input_updated_at"], ["entry_low", "stop_price", "target_primary", "expected_rr"]),
    f"SELECT count(*) AS generated_rows, {_NONE} FROM setups WHERE trading_date > {AFTER}")
register("rebuilt_outcomes", lambda p: quality.compare_counts(
    _rebuilt_outcomes(p), p.outcomes, ["signal_id"], ["outcome_label", "entry_date", "exit_date"], ["realized_r", "mfe_r", "mae_r"]),
    f"SELECT count(*) AS generated_rows, {_NONE} FROM outcomes")


def _rebuilt_outcomes(p):
    from tidemark.plans import outcomes

    return outcomes.signal_outcomes(outcomes.signal_bars(outcomes.accepted_signals(p.setups), p.bars), "m")


def _states(p):
    """One state row per sector: rotation as stored up to a date against its input."""
    full = p.rotation.groupBy("sector_code").agg(F.max("trading_date").alias("input_last"), F.count(F.lit(1)).alias("expected_rows"))
    cut = F.date_sub(_last(p.rotation), F.when(F.col("sector_code") < "ASIA", 200).otherwise(0))
    corrected = F.date_add(F.to_date("updated_at"), F.when(F.col("sector_code") == "AMERICA", 1).otherwise(0))  # since the build
    kept = p.rotation.filter(F.col("trading_date") <= cut).groupBy("sector_code").agg(
        F.max("trading_date").alias("stored_last"), F.count(F.lit(1)).alias("stored_rows"),
        F.max(F.to_date("updated_at")).alias("stored_at"), F.max(corrected).alias("input_at"))
    return full.join(kept, "sector_code", "left").withColumns({
        "force": F.col("sector_code") == "EUROPE", "stored_count": F.col("stored_rows"), "expected_count": F.when(
            F.col("sector_code") == "ASIA", F.col("expected_rows") + 1).otherwise(F.col("stored_rows")),
        "stored_signature": F.lit("a"), "input_signature": F.when(F.col("sector_code") == "MIDDLE EAST", "b").otherwise("a"),
        "state_exists": F.lit(True),
        "model_matches": F.col("sector_code") != "AFRICA", "state_rows": F.col("stored_rows")})


_POLICIES = {"breadth": incremental.MARKET_BREADTH, "rotation": incremental.SECTOR_ROTATION, "integrated": incremental.INTEGRATED_SECTOR,
             "screener": incremental.STOCK_SCREENER, "setup": incremental.TRADE_SETUP, "outcome": incremental.SIGNAL_OUTCOME}
register("build_modes", lambda p: _states(p).select("sector_code", *[incremental.build_mode(q).alias(f"{n}_mode") for n, q in _POLICIES.items()]), """
SELECT sector_code, CASE WHEN f THEN 'FULL' ELSE base END AS breadth_mode, CASE WHEN f OR cnt THEN 'FULL' ELSE base END AS rotation_mode,
  CASE WHEN f OR cnt OR sig THEN 'FULL' ELSE base END AS integrated_mode, CASE WHEN f OR cnt OR ts THEN 'FULL' ELSE base END AS screener_mode,
  CASE WHEN f OR mm OR ts OR (sl = il AND sn <> n) THEN 'FULL' ELSE base END AS setup_mode,
  CASE WHEN f OR mm OR sn <> n THEN 'FULL' WHEN sl = il AND NOT ts THEN 'UP_TO_DATE' ELSE 'REFRESH' END AS outcome_mode
FROM (SELECT sector_code, sector_code = 'EUROPE' AS f, sector_code = 'ASIA' AS cnt, sector_code = 'MIDDLE EAST' AS sig, sector_code = 'AMERICA' AS ts, sector_code = 'AFRICA' AS mm,
        max(trading_date) AS il, count(*) AS n, max(trading_date) FILTER (WHERE trading_date <= cut) AS sl, count(*) FILTER (WHERE trading_date <= cut) AS sn,
        CASE WHEN max(trading_date) FILTER (WHERE trading_date <= cut) = max(trading_date) THEN 'UP_TO_DATE' ELSE 'INCREMENTAL' END AS base
      FROM (SELECT *, (SELECT max(trading_date) FROM rotation) - CASE WHEN sector_code < 'ASIA' THEN 200 ELSE 0 END AS cut FROM rotation) GROUP BY 1)""")
register("lineage_versions", lambda p: incremental.lineage_versions(p.rotation, p.sector_ownership, p.integrated), """
SELECT DISTINCT model_version, DATE '2001-11-04' AS universe_date FROM (SELECT model_version FROM rotation UNION SELECT model_version FROM sector_ownership UNION SELECT model_version FROM integrated)""")
