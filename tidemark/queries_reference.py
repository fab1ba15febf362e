"""Registered queries over feeds, intervals, availability, rules and landed text."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import register
from tidemark.functions import dates
from tidemark.operators import rules as rule_ops
from tidemark.operators import sets
from tidemark.operators.joins import overlapping
from tidemark.oracle.ctes import CTES, r
from tidemark.plans import lifecycle, pit, quality
from tidemark.sources import bars as bar_ops
from tidemark.sources import feeds, holdings, pages, profiles

# the window of the lifecycle queries: the years that have observations
FIRST_DAY = "(SELECT CAST(date_trunc('year', min(first_seen)) AS DATE) FROM presence)"
LAST_DAY = "(SELECT make_date(CAST(max(month) // 12 AS INTEGER), 12, 31) FROM presence)"
SNAPSHOT_DAY = "2001-11-04"
SOURCES = ["LISTING_ACTIVITY", "DIGITAL_STATISTIC", "NEWLY_LISTED_PERFORMANCE"]
MONTH = "(year({d}) * 12 + month({d}) - 1)"


def _lit_date(text: str):
    return F.lit(text).cast("date")


# --- lifecycle feeds -----------------------------------------------------------

CTES["presence"] = f"""
SELECT s_name AS symbol, CAST({MONTH.format(d="l_shipdate")} AS BIGINT) AS month, min(CAST(l_shipdate AS DATE)) AS first_seen
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2"""
_LANES = "|| '|' ||".join(f"CAST(sum(CAST('0x' || substr(sha256(symbol), {1 + 15 * i}, 15) AS HUGEINT)) AS VARCHAR)" for i in range(4))
CTES["presence_gaps"] = """
SELECT *, lag(month) OVER w AS pm, lead(month) OVER w AS nm, min(month) OVER () AS lo, max(month) OVER () AS hi
FROM presence WINDOW w AS (PARTITION BY symbol ORDER BY month)"""
CTES["life_events"] = """
SELECT symbol, first_seen AS effective_date, CASE WHEN pm IS NULL THEN 'LISTED' ELSE 'RELISTED' END AS event_type, 'VALID' AS quality
FROM presence_gaps WHERE (pm IS NULL AND month > lo) OR month - pm > 1
UNION ALL
SELECT symbol, make_date((month + 1) // 12, (month + 1) % 12 + 1, 1), 'DELISTED', 'WARNING'
FROM presence_gaps WHERE (nm IS NULL AND month < hi) OR nm - month > 1"""
CTES["life_baseline"] = "SELECT symbol FROM presence_gaps WHERE month = lo"

register("monthly_presence", lambda p: _present(p).select("symbol", F.col("month").cast("long").alias("month"), "first_seen"), "SELECT * FROM presence")
register("lifecycle_events", lambda p: _events(p), "SELECT * FROM life_events")


def _present(p):
    return p.presence


def _first_day(p):
    return _present(p).agg(F.trunc(F.min("first_seen"), "year").alias("d")).select("d").scalar()


def _last_day(p):
    year = F.floor(F.max("month") / 12).cast("int")
    return _present(p).agg(F.make_date(year, F.lit(12), F.lit(31)).alias("d")).select("d").scalar()


def _events(p):
    return p.life_events


def _baseline(p):
    first = _present(p).agg(F.min("month").alias("a")).select("a").scalar()
    return _present(p).filter(F.col("month") == first).select("symbol")


def _intervals(p):
    return lifecycle.intervals(_baseline(p), _events(p), _first_day(p))


CTES["life_ordered"] = f"""
SELECT *, coalesce(sum(CASE WHEN event_type = 'DELISTED' THEN 1 ELSE 0 END) OVER (PARTITION BY symbol ORDER BY o, effective_date, event_type
   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g,
   lead(effective_date) OVER (PARTITION BY symbol ORDER BY o, effective_date, event_type) AS nxt
FROM (SELECT symbol, {FIRST_DAY} AS effective_date, 'WINDOW_BASELINE' AS event_type, 0 AS o FROM life_baseline
      UNION ALL SELECT symbol, effective_date, event_type, 1 FROM life_events)"""
CTES["life_intervals"] = """
SELECT symbol, start_at AS valid_from, valid_to, start_reason, CASE WHEN valid_to IS NOT NULL THEN 'DELISTED' END AS end_reason
FROM (SELECT symbol, g, arg_max(effective_date, (o, effective_date, event_type)) FILTER (WHERE event_type <> 'DELISTED') AS start_at,
             arg_max(event_type, (o, effective_date, event_type)) FILTER (WHERE event_type <> 'DELISTED') AS start_reason,
             max(effective_date) FILTER (WHERE event_type = 'DELISTED') AS valid_to FROM life_ordered GROUP BY 1, 2)
WHERE start_at IS NOT NULL"""
register("lifecycle_intervals", lambda p: _intervals(p).select("symbol", "valid_from", "valid_to", "start_reason", "end_reason"),
         "SELECT * FROM life_intervals")
register("interval_overlaps", lambda p: _listed_spans(p).transform(
    lambda d: overlapping(d, ["symbol"], "valid_from", "valid_to", "valid_from")).select("symbol").distinct(), """
SELECT DISTINCT a.symbol FROM listed_spans a JOIN listed_spans b ON a.symbol = b.symbol AND a.valid_from < b.valid_from
  AND b.valid_from <= a.valid_to AND a.valid_from <= b.valid_to""", {"listed_spans": f"""
SELECT symbol, first_seen AS valid_from, CAST(first_seen + 16 + CAST(month % 5 AS INTEGER) AS DATE) AS valid_to FROM presence"""})


def _listed_spans(p):
    # each month's presence as a span that may reach into the next month's
    return _present(p).select(
        "symbol", F.col("first_seen").alias("valid_from"), F.date_add("first_seen", (F.lit(16) + F.col("month") % 5).cast("int")).alias("valid_to"))


register("bounded_lifecycle_rows", lambda p: lifecycle.bounded_rows(_intervals(p), _events(p), _last_day(p)), f"""
SELECT symbol, effective_from, effective_to, lifecycle_status, membership_status, listing_date, delisting_date, quality,
       'UNKNOWN' AS availability_status, false AS point_in_time_safe FROM (
  SELECT symbol, valid_from AS effective_from, CASE WHEN valid_to IS NOT NULL THEN valid_to - 1 ELSE {LAST_DAY} END AS effective_to,
         'LISTED' AS lifecycle_status, 'ACTIVE' AS membership_status, CASE WHEN start_reason <> 'WINDOW_BASELINE' THEN first_listing END AS listing_date,
         valid_to AS delisting_date, CASE WHEN valid_to IS NOT NULL OR start_reason = 'WINDOW_BASELINE' THEN 'WARNING' ELSE 'VALID' END AS quality
  FROM life_intervals LEFT JOIN (SELECT symbol, min(effective_date) AS first_listing FROM life_events WHERE event_type <> 'DELISTED' GROUP BY 1) USING (symbol)
  UNION ALL
  SELECT symbol, valid_to, {LAST_DAY}, 'DELISTED', 'INACTIVE', NULL, valid_to, 'WARNING' FROM life_intervals WHERE valid_to IS NOT NULL)""")

register("bounded_lifecycle_validation", lambda p: quality.bounded_validation(
    lifecycle.bounded_rows(_intervals(p), _events(p), _last_day(p))), """
SELECT count(*) AS lifecycle_rows, count(*) FILTER (WHERE st = 'LISTED') AS active_rows, count(*) FILTER (WHERE st = 'DELISTED') AS inactive_rows,
  0::BIGINT AS point_in_time_true, 0::BIGINT AS availability_known, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM bounded_spans b
    WHERE b.symbol = a.symbol AND (b.f, b.st) < (a.f, a.st) AND b.t >= a.f)) AS overlapping_rows FROM bounded_spans a""", {"bounded_spans": f"""
SELECT symbol, valid_from AS f, coalesce(valid_to - 1, {LAST_DAY}) AS t, 'LISTED' AS st FROM life_intervals
UNION ALL SELECT symbol, valid_to, {LAST_DAY}, 'DELISTED' FROM life_intervals WHERE valid_to IS NOT NULL"""})
CTES["life_replayed"] = f"""
SELECT DISTINCT symbol, unnest(range(m, greatest(m, e) + 1)) AS month FROM (
  SELECT symbol, {MONTH.format(d="effective_date")} AS m, CASE WHEN event_type = 'DELISTED' THEN {MONTH.format(d="effective_date")}
         ELSE coalesce({MONTH.format(d="nxt")}, (SELECT max(month) FROM presence)) END AS e FROM life_ordered)"""
register("presence_replay", lambda p: lifecycle.replay(
    _present(p), _baseline(p), _events(p), _first_day(p), _present(p).agg(F.max("month").alias("b")).select("b").scalar()
).withColumn("month", F.col("month").cast("long")), f"""
SELECT month, count(o) AS observed_symbols, count(r) AS replayed_symbols, count(*) FILTER (WHERE r IS NULL) AS missing_from_replay,
       count(*) FILTER (WHERE o IS NULL AND d IS NULL) AS extra_in_replay, count(*) FILTER (WHERE o IS NULL AND d IS NOT NULL) AS tolerated_same_month_delisting,
       count(*) FILTER (WHERE r IS NULL) = 0 AND count(*) FILTER (WHERE o IS NULL AND d IS NULL) = 0 AS passed
FROM (SELECT symbol, CAST(month AS BIGINT) AS month, 1 AS o FROM presence) a
FULL JOIN (SELECT symbol, CAST(month AS BIGINT) AS month, 1 AS r FROM life_replayed) b USING (symbol, month)
LEFT JOIN (SELECT DISTINCT symbol, CAST({MONTH.format(d="effective_date")} AS BIGINT) AS month, 1 AS d FROM life_events WHERE event_type = 'DELISTED') c USING (symbol, month)
GROUP BY 1""")


def _highlights(p):
    present = _present(p)
    counts = _events(p).groupBy(feeds.month_index(F.col("effective_date")).alias("month")).agg(
        F.count_if(F.col("event_type") == "DELISTED").alias("n"))
    months = present.select("month").distinct()
    return months.join(counts, "month", "left").select(
        "month", F.when(F.col("month") % 4 != 0, F.coalesce("n", F.lit(0)) + (F.col("month") % 5 == 0).cast("int")).alias("issuer_count"))


CTES["highlights"] = f"""
SELECT month, CASE WHEN month % 4 <> 0 THEN coalesce(n, 0) + CASE WHEN month % 5 = 0 THEN 1 ELSE 0 END END AS issuer_count
FROM (SELECT DISTINCT month FROM presence) LEFT JOIN (SELECT CAST({MONTH.format(d="effective_date")} AS BIGINT) AS month,
  count(*) FILTER (WHERE event_type = 'DELISTED') AS n FROM life_events GROUP BY 1) USING (month)"""
CTES["changes"] = """
SELECT symbol, month, 'REMOVED' AS change FROM (SELECT symbol, month + 1 AS month FROM presence EXCEPT SELECT symbol, month FROM presence)
WHERE month IN (SELECT month FROM presence)
UNION ALL
SELECT symbol, month, 'ADDED' FROM (SELECT symbol, month FROM presence EXCEPT SELECT symbol, month + 1 FROM presence)
WHERE month - 1 IN (SELECT month FROM presence)"""
register("membership_changes", lambda p: lifecycle.membership_changes(_present(p)).withColumn("month", F.col("month").cast("long")),
         "SELECT * FROM changes")
_DELTA = ["month", "removed", "added", "ipo_explained", "relisting_explained", "unexplained_additions", "highlight_previous_count",
          "highlight_current_count", "highlight_alignment"]
register("membership_deltas", lambda p: lifecycle.membership_deltas(_present(p), _events(p), _highlights(p)).select(
    *_DELTA).withColumn("month", F.col("month").cast("long")), f"""
SELECT *, CASE WHEN removed = 0 THEN 'NOT_APPLICABLE' WHEN removed = highlight_previous_count AND removed = highlight_current_count THEN 'BOTH'
   WHEN removed = highlight_previous_count THEN 'PREVIOUS_MONTH' WHEN removed = highlight_current_count THEN 'CURRENT_MONTH'
   WHEN highlight_previous_count IS NULL AND highlight_current_count IS NULL THEN 'UNKNOWN' ELSE 'NO_MATCH' END AS highlight_alignment
FROM (SELECT m.month, count(*) FILTER (WHERE change = 'REMOVED') AS removed, count(*) FILTER (WHERE change = 'ADDED') AS added,
        count(*) FILTER (WHERE change = 'ADDED' AND e.ipo) AS ipo_explained, count(*) FILTER (WHERE change = 'ADDED' AND e.re) AS relisting_explained,
        count(*) FILTER (WHERE change = 'ADDED' AND coalesce(NOT e.ipo AND NOT e.re, true)) AS unexplained_additions,
        max(hp.issuer_count) AS highlight_previous_count, max(hc.issuer_count) AS highlight_current_count
      FROM (SELECT DISTINCT month FROM presence WHERE month - 1 IN (SELECT month FROM presence)) m LEFT JOIN changes c USING (month)
      LEFT JOIN (SELECT symbol, {MONTH.format(d="effective_date")} AS month, bool_or(event_type = 'LISTED') AS ipo, bool_or(event_type = 'RELISTED') AS re
                 FROM life_events WHERE event_type <> 'DELISTED' GROUP BY 1, 2) e ON e.symbol = c.symbol AND e.month = c.month
      LEFT JOIN highlights hp ON hp.month = m.month - 1 LEFT JOIN highlights hc ON hc.month = m.month GROUP BY 1)""")
register("removal_candidates", lambda p: lifecycle.removal_candidates(_present(p)).withColumns(
    {c: F.col(c).cast("long") for c in ("last_present_month", "first_absent_month")}), """
SELECT c.symbol, month - 1 AS last_present_month, month AS first_absent_month, last_month > month AS later_reappearance,
       CASE WHEN last_month > month THEN 'TEMPORARY_ABSENCE_OR_DATA_GAP' ELSE 'PERSISTENT_REMOVAL_CANDIDATE' END AS classification
FROM changes c JOIN (SELECT symbol, max(month) AS last_month FROM presence GROUP BY 1) l ON l.symbol = c.symbol WHERE change = 'REMOVED'""")
register("membership_fingerprints", lambda p: sets.fingerprints(_present(p), ["month"], "symbol").withColumn("month", F.col("month").cast("long")), f"""
SELECT month, count(*) AS members, sha256({_LANES}) AS fingerprint FROM presence GROUP BY 1""")
register("distinct_fingerprints", lambda p: sets.fingerprints(_present(p), ["month"], "symbol").agg(
    F.count_distinct("fingerprint").alias("distinct_sets"), F.count(F.lit(1)).alias("months")), """
SELECT count(DISTINCT f) AS distinct_sets, count(*) AS months FROM (SELECT month, string_agg(symbol, chr(10) ORDER BY symbol) AS f FROM presence GROUP BY 1)""")
register("lifecycle_preflight", lambda p: lifecycle.preflight(
    _intervals(p), p.source.table("supplier").filter("s_acctbal >= 1000").select(F.col("s_name").alias("symbol")),
    p.source.table("supplier").filter("s_acctbal < 0").select(F.col("s_name").alias("symbol")), _events(p)), """
SELECT *, unsupported_missing = 0 AS gate_passed FROM (
SELECT count(*) AS unique_symbols, count(*) FILTER (WHERE known) AS matched_existing, count(*) FILTER (WHERE NOT known) AS missing_symbols,
  count(*) FILTER (WHERE NOT known AND NOT special AND gone) AS eligible_missing_delisted, count(*) FILTER (WHERE NOT known AND special) AS eligible_missing_special,
  count(*) FILTER (WHERE NOT known AND NOT special AND NOT gone) AS unsupported_missing
FROM (SELECT DISTINCT i.symbol, s_acctbal >= 1000 AS known, s_acctbal < 0 AS special,
        i.symbol IN (SELECT symbol FROM life_events WHERE event_type = 'DELISTED') AS gone
      FROM life_intervals i JOIN supplier ON s_name = i.symbol))""")

# --- votes and reconciliation --------------------------------------------------

CTES["feeds"] = """
SELECT source, year, s_name AS symbol, date_trunc('month', min(d))::DATE AS listing_date FROM (
  SELECT 'LISTING_ACTIVITY' AS source, l_suppkey, year(l_shipdate) AS year, CAST(l_shipdate AS DATE) AS d FROM lineitem
  UNION ALL SELECT 'DIGITAL_STATISTIC', l_suppkey, year(l_shipdate), CAST(l_shipdate AS DATE) FROM lineitem WHERE l_returnflag = 'A' AND l_linenumber >= 6
  UNION ALL SELECT 'NEWLY_LISTED_PERFORMANCE', l_suppkey, year(l_shipdate), CAST(l_shipdate AS DATE) FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 46)
JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2, 3"""
CTES["ballot"] = "SELECT year, symbol, listing_date, count(DISTINCT source) AS n, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM feeds GROUP BY 1, 2, 3"
CTES["tally"] = """
SELECT b.year, b.symbol, count(*) AS dates, max(n) AS best_votes, count(*) FILTER (WHERE n = best) AS tied,
       min(listing_date) FILTER (WHERE n = best) AS lead_date, arg_min(sources, listing_date) FILTER (WHERE n = best) AS lead_sources
FROM (SELECT *, max(n) OVER (PARTITION BY year, symbol) AS best FROM ballot) b GROUP BY 1, 2"""
CTES["canonical"] = """
SELECT year, symbol, status, CASE WHEN status <> 'UNRESOLVED_CONFLICT' THEN lead_date END AS listing_date,
       CASE WHEN status <> 'UNRESOLVED_CONFLICT' THEN lead_sources ELSE '' END AS supporting_sources, CAST(dates AS BIGINT) AS dates, CAST(best_votes AS INTEGER) AS best_votes
FROM (SELECT *, CASE WHEN best_votes >= 2 AND tied = 1 AND dates > 1 THEN 'CONFLICT_RESOLVED_BY_CONSENSUS' WHEN best_votes >= 2 AND tied = 1 THEN 'CONFIRMED_MULTI_SOURCE'
        WHEN best_votes = 1 AND dates = 1 THEN 'SINGLE_SOURCE' ELSE 'UNRESOLVED_CONFLICT' END AS status FROM tally)"""


def _feeds(p):
    return p.listing_feeds


register("listing_votes", lambda p: sets.votes(_feeds(p), ["year", "symbol", "listing_date"]).withColumn("sources", F.array_join("sources", ",")),
         "SELECT year, symbol, listing_date, sources, CAST(n AS INTEGER) AS votes FROM ballot")
register("canonical_listing_dates", lambda p: lifecycle.canonical_dates(_feeds(p), ["year", "symbol"]), "SELECT * FROM canonical")
_COUNTS = """count(*) FILTER (WHERE a) AS listing_activity_count, count(*) FILTER (WHERE b) AS digital_statistic_count,
  count(*) FILTER (WHERE c) AS newly_listed_performance_count"""
CTES["per_symbol"] = """
SELECT year, symbol, bool_or(source = 'LISTING_ACTIVITY') AS a, bool_or(source = 'DIGITAL_STATISTIC') AS b,
       bool_or(source = 'NEWLY_LISTED_PERFORMANCE') AS c, count(DISTINCT source) AS k FROM feeds GROUP BY 1, 2"""
CTES["strict_years"] = f"""
SELECT *, newly_listed_performance_count = symbol_union_count AS anchor_complete,
   newly_listed_performance_count = symbol_union_count AND canonical_count = symbol_union_count AND single_source_count = 0 AND unresolved_count = 0 AS strict_ready
FROM (SELECT year, {_COUNTS}, count(*) AS symbol_union_count, count(listing_date) AS canonical_count,
   count(*) FILTER (WHERE status = 'CONFIRMED_MULTI_SOURCE') AS confirmed_count, count(*) FILTER (WHERE status = 'CONFLICT_RESOLVED_BY_CONSENSUS') AS resolved_conflict_count,
   count(*) FILTER (WHERE status = 'SINGLE_SOURCE') AS single_source_count, count(*) FILTER (WHERE status = 'UNRESOLVED_CONFLICT') AS unresolved_count,
   count(*) FILTER (WHERE k < 3) AS incomplete_source_count FROM per_symbol JOIN canonical USING (year, symbol) GROUP BY 1)"""
register("listing_strict_years", lambda p: lifecycle.strict_years(_feeds(p), SOURCES, SOURCES[2]), "SELECT * FROM strict_years")


def _published(p):
    # published counts: the supplier count, one short in 1996
    total = p.source.table("supplier").agg(F.count(F.lit(1)).alias("n"))
    return total.select(F.explode(F.array(F.lit(1995), F.lit(1996), F.lit(1997))).alias("year"), "n").select(
        "year", (F.col("n") - F.when(F.col("year") == 1996, 1).otherwise(0)).alias("expected_count"))


CTES["published"] = "SELECT y AS year, n - CASE WHEN y = 1996 THEN 1 ELSE 0 END AS expected_count FROM (SELECT count(*) AS n FROM supplier), (VALUES (1995), (1996), (1997)) t(y)"
CTES["pair_ballot"] = """
SELECT year, symbol, count(*) AS dates, max(n) AS best, count(*) FILTER (WHERE n = mx) AS tied FROM (
  SELECT *, max(n) OVER (PARTITION BY year, symbol) AS mx FROM (
    SELECT year, symbol, listing_date, count(DISTINCT source) AS n FROM feeds WHERE source <> 'NEWLY_LISTED_PERFORMANCE' GROUP BY 1, 2, 3)) GROUP BY 1, 2"""
CTES["anchored_rows"] = """
SELECT b.*, u = expected_count AS anchored, expected_count, u,
  CASE WHEN dates > 1 AND tied <> 1 THEN 'UNRESOLVED' WHEN best >= 2 THEN 'CONFIRMED_MULTI_SOURCE' WHEN dates = 1 AND u = expected_count THEN 'COUNT_ANCHORED_SINGLE_SOURCE'
       ELSE 'UNRESOLVED' END AS status
FROM pair_ballot b JOIN published USING (year) JOIN (SELECT year, count(DISTINCT symbol) AS u FROM feeds WHERE source <> 'NEWLY_LISTED_PERFORMANCE' GROUP BY 1) USING (year)"""
register("listing_evidence_years", lambda p: lifecycle.evidence_years(_feeds(p), SOURCES, SOURCES[2], 2001, _published(p)), f"""
SELECT a.year, 'BOUNDED_COUNT_ANCHORED' AS mode, max(expected_count) AS expected_count, max(s.listing_activity_count) AS listing_activity_count,
  max(s.digital_statistic_count) AS digital_statistic_count, 0::BIGINT AS newly_listed_performance_count, max(u) AS union_count,
  count(*) FILTER (WHERE status <> 'UNRESOLVED') AS canonical_count, count(*) FILTER (WHERE status = 'UNRESOLVED') AS unresolved_count,
  count(*) FILTER (WHERE status = 'COUNT_ANCHORED_SINGLE_SOURCE') AS single_source_count, bool_or(anchored) AS coverage_anchor_match,
  bool_or(anchored) AND count(*) FILTER (WHERE status <> 'UNRESOLVED') = max(expected_count) AND count(*) FILTER (WHERE status = 'UNRESOLVED') = 0 AS event_date_ready
FROM anchored_rows a JOIN strict_years s ON s.year = a.year GROUP BY 1
UNION ALL
SELECT year, 'STRICT_THREE_SOURCE', symbol_union_count, listing_activity_count, digital_statistic_count, newly_listed_performance_count, symbol_union_count,
  canonical_count, unresolved_count, single_source_count, anchor_complete, strict_ready FROM strict_years WHERE year NOT IN (1995, 1996, 1997, 2001)
UNION ALL
SELECT year, 'CURRENT_YEAR_PROVISIONAL', NULL, count(*), 0, 0, count(*), count(*), 0, count(*), NULL, false FROM feeds
WHERE source = 'LISTING_ACTIVITY' AND year = 2001 GROUP BY 1""")

CTES["activity"] = """
SELECT s_name AS symbol, year(l_shipdate) AS year, CAST(l_shipdate AS DATE) AS listing_date, l_linenumber, l_returnflag, l_quantity
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey"""
CTES["pairs_lr"] = """
SELECT year, symbol, listing_date, count(*) FILTER (WHERE l_linenumber IN (1, 2, 3, 4, 6, 7)) AS l, count(*) FILTER (WHERE l_linenumber IN (1, 2, 3, 5, 7)) AS r
FROM activity GROUP BY 1, 2, 3"""
register("source_reconciliation", lambda p: sets.reconcile(
    feeds.activity_rows(p.source, 1, 2, 3, 4, 6, 7), feeds.activity_rows(p.source, 1, 2, 3, 5, 7), ["year"], "symbol", "listing_date"), """
SELECT *, CASE WHEN left_only = 0 AND right_only = 0 AND date_disagreements = 0 AND left_duplicates = 0 AND right_duplicates = 0 THEN 'PASS' ELSE 'MISMATCH' END AS verdict
FROM (SELECT year, CAST(sum(a) AS BIGINT) AS left_count, CAST(sum(b) AS BIGINT) AS right_count, CAST(sum(ab) AS BIGINT) AS exact_matches,
        CAST(sum(a - ab) AS BIGINT) AS left_only, CAST(sum(b - ab) AS BIGINT) AS right_only,
        count(*) FILTER (WHERE a > 0 AND b > 0 AND (ab < a OR ab < b)) AS date_disagreements, CAST(sum(dl) AS BIGINT) AS left_duplicates, CAST(sum(dr) AS BIGINT) AS right_duplicates
      FROM (SELECT year, symbol, count(*) FILTER (WHERE l > 0) AS a, count(*) FILTER (WHERE r > 0) AS b, count(*) FILTER (WHERE l > 0 AND r > 0) AS ab,
              sum(greatest(l - 1, 0)) AS dl, sum(greatest(r - 1, 0)) AS dr FROM pairs_lr GROUP BY 1, 2) GROUP BY 1)""")
register("source_disagreements", lambda p: sets.disagreements(
    feeds.activity_rows(p.source, 1, 2, 3, 4, 6, 7), feeds.activity_rows(p.source, 1, 2, 3, 5, 7), ["year"], "symbol", "listing_date"), """
SELECT * FROM (SELECT year, symbol, string_agg(CAST(listing_date AS VARCHAR), ',' ORDER BY listing_date) FILTER (WHERE l > 0) AS left_dates,
   string_agg(CAST(listing_date AS VARCHAR), ',' ORDER BY listing_date) FILTER (WHERE r > 0) AS right_dates FROM pairs_lr GROUP BY 1, 2)
WHERE left_dates <> '' AND right_dates <> '' AND left_dates <> right_dates""")
register("repeated_records", lambda p: sets.repeated_across(
    feeds.activity_rows(p.source, 1, 2, 3, 4, 5, 6, 7), ["symbol", "listing_date"], "l_linenumber"), """
SELECT symbol, listing_date, string_agg(DISTINCT CAST(l_linenumber AS VARCHAR), ',' ORDER BY CAST(l_linenumber AS VARCHAR)) AS buckets, count(*) AS observations,
       CAST(count(DISTINCT l_linenumber) - 1 AS INTEGER) AS surplus FROM activity GROUP BY 1, 2 HAVING count(DISTINCT l_linenumber) > 1""")
register("feed_completeness", lambda p: sets.feed_completeness(
    feeds.activity_rows(p.source, 1, 2, 3, 4, 5, 6, 7), "year", ["symbol", "listing_date", "l_returnflag", "l_linenumber"], "symbol", "listing_date"), """
SELECT *, total_rows - unique_rows AS duplicate_rows, total_rows = unique_rows AS coverage_valid FROM (
SELECT year, count(*) AS total_rows, count(DISTINCT (symbol, listing_date, l_returnflag, l_linenumber)) AS unique_rows, count(DISTINCT symbol) AS symbols,
       min(listing_date) AS first_date, max(listing_date) AS last_date FROM activity GROUP BY 1)""")


def _delisting_rows(p):
    page = _events(p).filter("event_type = 'DELISTED'").select(
        "symbol", F.col("effective_date").alias("delisting_date"), F.lit("HTML").alias("origin"), F.lit(1).alias("copy"))
    sheet = page.filter(F.month("delisting_date") % 3 == 0).withColumns({"origin": F.lit("XLSX"), "copy": F.lit(2)})
    return page.unionByName(sheet)


register("delisting_records", lambda p: lifecycle.delisting_records(_delisting_rows(p), "copy"), """
SELECT symbol, effective_date AS delisting_date, CASE WHEN month(effective_date) % 3 = 0 THEN 'XLSX' ELSE 'HTML' END AS origin,
       CASE WHEN month(effective_date) % 3 = 0 THEN 2 ELSE 1 END AS copy FROM life_events WHERE event_type = 'DELISTED'""")
register("delisting_months", lambda p: lifecycle.delisting_months(_highlights(p), lifecycle.delisting_records(_delisting_rows(p), "copy")).withColumns(
    {"month": F.col("month").cast("long"), "resolved_rows": F.col("resolved_rows").cast("long")}), f"""
SELECT month, issuer_count, CASE WHEN issuer_count > 0 THEN k ELSE 0 END AS resolved_rows,
  CASE WHEN issuer_count IS NULL THEN 'COUNT_UNKNOWN' WHEN issuer_count <= 0 THEN 'NO_POSITIVE_COUNT' WHEN issuer_count = k THEN 'RESOLVED' WHEN k > 0 THEN 'PARTIAL'
       ELSE 'POSITIVE_COUNT_NO_ROWS' END AS resolution_status
FROM (SELECT h.*, (SELECT count(*) FROM life_events e WHERE event_type = 'DELISTED' AND {MONTH.format(d="effective_date")} = h.month) AS k FROM highlights h)""")

# --- calendar, availability, boards, rules --------------------------------------

register("trading_calendar", lambda p: pit.trading_calendar(p.index_bars, p.spark), """
SELECT d AS trading_date, t IS NOT NULL AS is_trading_day, CASE WHEN t IS NOT NULL THEN 'OBSERVED_TRADING' WHEN isodow(d) >= 6 THEN 'WEEKEND'
  ELSE 'UNVERIFIED_NON_TRADING' END AS day_type, false AS verified
FROM (SELECT CAST(unnest(generate_series((SELECT min(trading_date) FROM index_bars), (SELECT max(trading_date) FROM index_bars), INTERVAL 1 DAY)) AS DATE) AS d)
LEFT JOIN (SELECT DISTINCT trading_date AS t FROM index_bars) ON t = d""")


def _ledger(p):
    o = p.source.table("orders")
    day = F.to_date("o_orderdate")
    rows = o.select(
        F.col("o_orderkey"), day.alias("observation_date"),
        pit.observation_key(F.lit("ORDERS"), F.col("o_orderkey"), F.when(F.col("o_orderkey") % 3 == 0, " ").otherwise(F.col("o_orderpriority"))).alias("observation_key"),
        F.when(F.col("o_orderstatus") == "F", "KNOWN").when(F.col("o_orderstatus") == "P", "ESTIMATED").otherwise("UNKNOWN").alias("availability_status"),
        F.when(F.col("o_orderkey") % 4 != 0, F.date_add(day, (F.col("o_custkey") % 9).cast("int")).cast("timestamp")).alias("available_at"),
        F.lit(None).cast("timestamp").alias("published_at"), F.date_add(day, 3).alias("signal_date"),
        F.date_sub(day, (F.col("o_orderkey") % 5).cast("int")).alias("valid_from"),
        F.when(F.col("o_orderkey") % 2 == 0, F.date_add(day, (F.col("o_orderkey") % 6).cast("int"))).alias("valid_to"),
        F.when(F.col("o_orderkey") % 7 == 0, "INACTIVE").otherwise("ACTIVE").alias("membership_status"))
    return pit.availability(rows).withColumns({
        "available": pit.available_on("signal_date"), "member": pit.membership_active("signal_date")})


CTES["ledger"] = """
SELECT *, reason = 'KNOWN_AVAILABLE_AT' AS point_in_time_safe, coalesce(reason = 'KNOWN_AVAILABLE_AT' AND available_at <= signal_date, false) AS available,
   reason = 'KNOWN_AVAILABLE_AT' AND membership_status = 'ACTIVE' AND signal_date >= valid_from AND (valid_to IS NULL OR signal_date <= valid_to) AS member
FROM (SELECT *, CASE WHEN availability_status = 'UNKNOWN' THEN 'AVAILABILITY_UNKNOWN' WHEN available_at IS NULL THEN 'AVAILABLE_AT_MISSING'
        WHEN availability_status = 'ESTIMATED' THEN 'AVAILABILITY_ESTIMATED' ELSE 'KNOWN_AVAILABLE_AT' END AS reason
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS observation_date,
   'ORDERS|' || o_orderkey || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE '|' || o_orderpriority END AS observation_key,
   CASE o_orderstatus WHEN 'F' THEN 'KNOWN' WHEN 'P' THEN 'ESTIMATED' ELSE 'UNKNOWN' END AS availability_status,
   CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_custkey % 9 AS INTEGER) END AS available_at, CAST(o_orderdate AS DATE) + 3 AS signal_date,
   CAST(o_orderdate AS DATE) - CAST(o_orderkey % 5 AS INTEGER) AS valid_from,
   CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 6 AS INTEGER) END AS valid_to,
   CASE WHEN o_orderkey % 7 = 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS membership_status FROM orders))"""
register("availability_decisions", lambda p: _ledger(p).select(
    "o_orderkey", "observation_key", "availability_status", "reason", "point_in_time_safe", "available", "member"),
    "SELECT o_orderkey, observation_key, availability_status, reason, point_in_time_safe, available, member FROM ledger")
register("pit_coverage", lambda p: pit.pit_coverage(_ledger(p)), f"""
SELECT count(*) AS total, count(*) FILTER (WHERE availability_status = 'KNOWN') AS known, count(*) FILTER (WHERE availability_status = 'UNKNOWN') AS unknown,
  count(*) FILTER (WHERE availability_status = 'ESTIMATED') AS estimated, count(*) FILTER (WHERE point_in_time_safe) AS safe,
  {r("count(*) FILTER (WHERE point_in_time_safe) / count(*)::DOUBLE", 8)} AS coverage_ratio FROM ledger""")


_UNSAFE = {"point_in_time_safe": "point_in_time_safe OR o_orderstatus = 'P'"}
register("audit_availability", lambda p: quality.rule_counts(
    _ledger(p).join(p.source.table("orders").select("o_orderkey", "o_orderstatus"), "o_orderkey").withColumns(
        {c: F.expr(e) for c, e in _UNSAFE.items()}), quality.RULES["availability"]), """
SELECT 'unsafe_marked_safe' AS check_name, count(*) FILTER (WHERE o_orderstatus = 'P') AS bad_rows FROM orders
UNION ALL SELECT 'known_without_time', count(*) FILTER (WHERE o_orderstatus = 'P' AND available_at IS NULL) FROM ledger JOIN orders USING (o_orderkey)""")


def _universe(p):
    i = F.col("instrument_id")
    return p.instruments.select(
        "instrument_id", "symbol", _lit_date(SNAPSHOT_DAY).alias("snapshot_date"),
        F.when(i % 10 != 0, F.lit("2001-11-04 18:00:00").cast("timestamp")).alias("ingested_at"),
        F.date_add(F.lit("1990-01-01").cast("date"), (i % 3000).cast("int")).alias("listed_date"),
        F.when(i % 8 == 0, F.date_add(_lit_date(SNAPSHOT_DAY), (i % 5 - 2).cast("int"))).alias("delisted_date"),
        F.get(F.array(*[F.lit(b) for b in feeds.BOARD_TEXTS]), (i % len(feeds.BOARD_TEXTS)).cast("int")).alias("listing_board"))


CTES["universe"] = """
SELECT *, s_suppkey % 10 <> 0 AS seen, CASE WHEN s_suppkey % 10 <> 0 THEN 'KNOWN' ELSE 'UNKNOWN' END AS st,
   CASE WHEN s_suppkey % 8 = 0 THEN DATE '2001-11-04' + CAST(s_suppkey % 5 - 2 AS INTEGER) END AS delisted_date FROM supplier"""
register("current_membership", lambda p: pit.current_membership(_universe(p), "ALL_CURRENT", "OFFICIAL").drop("available_at"), """
SELECT s_suppkey AS instrument_id, s_name AS symbol, 'ALL_CURRENT' AS universe_code, DATE '2001-11-04' AS valid_from, NULL::DATE AS valid_to, 'ACTIVE' AS membership_status,
  'OFFICIAL' AS source_code, st AS availability_status, seen AS point_in_time_safe FROM universe""")
register("current_lifecycle", lambda p: pit.current_lifecycle(_universe(p), "OFFICIAL").drop("available_at"), """
SELECT s_suppkey AS instrument_id, s_name AS symbol, DATE '2001-11-04' AS effective_from, NULL::DATE AS effective_to,
  CASE WHEN delisted_date <= DATE '2001-11-04' THEN 'DELISTED' ELSE 'LISTED' END AS lifecycle_status, DATE '1990-01-01' + CAST(s_suppkey % 3000 AS INTEGER) AS listing_date,
  delisted_date AS delisting_date, 'OFFICIAL' AS source_code, st AS availability_status, 'VALID' AS quality FROM universe""")
CTES["boards"] = """
SELECT s_suppkey AS instrument_id, s_name AS symbol, DATE '2001-11-04' AS effective_from, NULL::DATE AS effective_to, b AS board_code,
  CASE WHEN b IN ('MAIN', 'DEVELOPMENT', 'NEW_ECONOMY') THEN 'MAIN_DEV_NEW' WHEN b IN ('ACCELERATION', 'WATCHLIST') THEN 'ACCEL_WATCH' ELSE 'UNKNOWN' END AS board_group,
  ['Papan Utama', 'pengembangan', 'New-Economy_Board', '  AKSELERASI ', 'Watchlist', 'Second Board'][s_suppkey % 6 + 1] AS raw_board_name,
  'PROFILE' AS source_code, st AS availability_status, seen AND b <> 'UNKNOWN' AS point_in_time_safe
FROM (SELECT *, ['MAIN', 'DEVELOPMENT', 'NEW_ECONOMY', 'ACCELERATION', 'WATCHLIST', 'UNKNOWN'][s_suppkey % 6 + 1] AS b FROM universe)"""
register("current_boards", lambda p: pit.current_boards(_universe(p), "PROFILE").drop("available_at"), "SELECT * FROM boards")
register("ownership_availability", lambda p: pit.unknown_availability(pit.ownership_observations(
    p.snapshots.withColumns({"ingested_at": F.lit("2001-12-01").cast("timestamp"), "holder_details": F.struct(
        F.concat(F.lit("F"), F.date_format("as_of_date", "yyyyMMdd"), F.lit("-"), (F.col("instrument_id") % 2).cast("string")).alias("archive_name"))})),
    "OWNERSHIP", "HOLDINGS").drop("published_at", "available_at"), """
SELECT 'OWNERSHIP' AS dataset_code, 'HOLDINGS|' || as_of_date AS observation_key, as_of_date AS observation_date, 'UNKNOWN' AS availability_status, 'HOLDINGS' AS source_code,
  string_agg(DISTINCT 'F' || strftime(as_of_date, '%Y%m%d') || '-' || (instrument_id % 2), ',' ORDER BY 'F' || strftime(as_of_date, '%Y%m%d') || '-' || (instrument_id % 2)) AS source_reference,
  'AVAILABILITY_UNKNOWN' AS reason, false AS point_in_time_safe FROM snapshots GROUP BY as_of_date""")
register("universe_availability", lambda p: pit.known_availability(
    _universe(p).groupBy("snapshot_date").agg(F.max("ingested_at").alias("seen_at")), "UNIVERSE", "OFFICIAL", "snapshot_date", "seen_at"
).select("dataset_code", "observation_key", "observation_date", F.to_date("available_at").alias("available_on"), "availability_status", "reason", "point_in_time_safe"), """
SELECT 'UNIVERSE' AS dataset_code, 'OFFICIAL|2001-11-04' AS observation_key, DATE '2001-11-04' AS observation_date, DATE '2001-11-04' AS available_on, 'KNOWN' AS availability_status,
  'SYSTEM_OBSERVED_AT' AS reason, true AS point_in_time_safe FROM supplier HAVING count(*) > 0""")
register("dataset_coverage", lambda p: pit.dataset_coverage(
    p.source.corporate_actions(), "CORPORATE_ACTIONS", ["ex_date", "cum_date", "record_date"], False, "CORPORATE_ACTION_HISTORY_NOT_COMPLETE"
).unionByName(pit.dataset_coverage(_universe(p), "UNIVERSE", ["snapshot_date"], False, "CURRENT_ONLY")).unionByName(
    pit.dataset_coverage(pit.current_boards(_universe(p), "PROFILE"), "BOARDS", ["effective_from"], False, "CURRENT_ONLY")), """
SELECT 'CORPORATE_ACTIONS' AS dataset_code, count(*) AS total_rows, count(ex_date) AS dated_rows, min(ex_date) AS first_date, max(ex_date) AS last_date,
  false AS history_complete, 'CORPORATE_ACTION_HISTORY_NOT_COMPLETE' AS blocking_reason FROM actions
UNION ALL SELECT 'UNIVERSE', count(*), count(*), DATE '2001-11-04', DATE '2001-11-04', false, 'CURRENT_ONLY' FROM supplier
UNION ALL SELECT 'BOARDS', count(*), count(*), DATE '2001-11-04', DATE '2001-11-04', false, 'CURRENT_ONLY' FROM supplier""")


def _ruled(p):
    rules = rule_ops.seed_rules(p.spark)
    board = pit.board_group(pit.board_code("listing_board"))
    rows = p.bars.join(_universe(p).select("instrument_id", board.alias("board_group")), "instrument_id").select(
        "instrument_id", "trading_date", (F.col("close") / 10).alias("price"), F.add_months("trading_date", 300).alias("rule_date"), "board_group")
    keys = ["instrument_id", "trading_date"]
    rows = rule_ops.require_unambiguous(rule_ops.lookup(rows, rules, "LOT_SIZE", keys, "rule_date", values=["lot_size"]))
    rows = rule_ops.require_unambiguous(rule_ops.lookup(rows, rules, "TICK_SIZE", keys, "rule_date", "price", values=["tick_size"]))
    return rule_ops.require_unambiguous(rule_ops.lookup(
        rows, rules, "AUTO_REJECTION", keys, "rule_date", "price", "board_group", ["rule_key", "ara_pct", "arb_pct", "ara_absolute"]))


register("market_rules", lambda p: _ruled(p), """
SELECT * EXCLUDE (ar), CASE WHEN rule_date >= DATE '2014-01-06' THEN 100 END AS lot_size,
  CASE WHEN rule_date < DATE '2016-05-02' THEN NULL WHEN price < 200 THEN 1.0::DOUBLE WHEN price < 500 THEN 2.0::DOUBLE WHEN price < 2000 THEN 5.0::DOUBLE
       WHEN price < 5000 THEN 10.0::DOUBLE ELSE 25.0::DOUBLE END AS tick_size,
  CASE WHEN ar = 'M1' THEN 'AR_MAIN_DEV_NEW_50_TO_200_20250408' WHEN ar = 'M2' THEN 'AR_MAIN_DEV_NEW_GT_200_TO_5000_20250408' WHEN ar = 'M3' THEN 'AR_MAIN_DEV_NEW_GT_5000_20250408'
       WHEN ar = 'A1' THEN 'AR_ACCEL_WATCH_1_TO_10_20250408' WHEN ar = 'A2' THEN 'AR_ACCEL_WATCH_GT_10_20250408' END AS rule_key,
  CASE ar WHEN 'M1' THEN 0.35 WHEN 'M2' THEN 0.25 WHEN 'M3' THEN 0.20 WHEN 'A2' THEN 0.10 END::DOUBLE AS ara_pct,
  CASE WHEN ar LIKE 'M%' THEN 0.15 WHEN ar = 'A2' THEN 0.10 END::DOUBLE AS arb_pct, CASE WHEN ar = 'A1' THEN 1.0 END::DOUBLE AS ara_absolute
FROM (SELECT b.instrument_id, trading_date, close / 10 AS price, CAST(trading_date + INTERVAL 300 MONTH AS DATE) AS rule_date, board_group,
  CASE WHEN CAST(trading_date + INTERVAL 300 MONTH AS DATE) < DATE '2025-04-08' THEN NULL
       WHEN board_group = 'MAIN_DEV_NEW' THEN CASE WHEN close / 10 < 50 THEN NULL WHEN close / 10 <= 200 THEN 'M1' WHEN close / 10 <= 5000 THEN 'M2' ELSE 'M3' END
       WHEN board_group = 'ACCEL_WATCH' THEN CASE WHEN close / 10 < 1 THEN NULL WHEN close / 10 <= 10 THEN 'A1' ELSE 'A2' END END AS ar
  FROM bars b JOIN boards USING (instrument_id))""")
register("seeded_rule_bands", lambda p: rule_ops.lookup(
    p.source.table("part").select("p_partkey", F.col("p_retailprice").alias("price"), F.lit("2020-01-01").cast("date").alias("d")),
    rule_ops.seed_rules(p.spark), "TICK_SIZE", ["p_partkey"], "d", "price", values=["rule_key"]).drop("d"), """
SELECT p_partkey, p_retailprice AS price, CASE WHEN p_retailprice < 200 THEN 'TICK_LT_200_20160502' WHEN p_retailprice < 500 THEN 'TICK_200_TO_LT_500_20160502'
  WHEN p_retailprice < 2000 THEN 'TICK_500_TO_LT_2000_20160502' WHEN p_retailprice < 5000 THEN 'TICK_2000_TO_LT_5000_20160502' ELSE 'TICK_GE_5000_20160502' END AS rule_key,
  false AS rule_conflict FROM part""")

# --- landed documents -----------------------------------------------------------


def _payload_rows(p, index=False):
    named = p.bars.join(p.instruments.select("instrument_id", "symbol"), "instrument_id")
    return bar_ops.parse_bar_payloads(feeds.bar_payloads(named), index=index)


CTES["payload_rows"] = """
SELECT s_name AS symbol, b.trading_date, b.open, CASE WHEN (b.instrument_id + (b.trading_date - DATE '1970-01-01')) % 50 <> 0 THEN b.high END AS high, b.low, b.close, b.volume,
  CASE WHEN (b.trading_date - DATE '1970-01-01') % 3 <> 0 THEN b.close END AS adj, CASE WHEN b.instrument_id % 11 = 0 THEN '1h' ELSE '1d' END AS granularity
FROM bars b JOIN supplier ON s_suppkey = b.instrument_id"""
_BAR = ["symbol", "trading_date", "open", "high", "low", "close", "volume", "adjusted_close"]
register("equity_bar_payloads", lambda p: bar_ops.complete_bars(_payload_rows(p)).select(*_BAR),
         "SELECT symbol, trading_date, open, high, low, close, volume, adj AS adjusted_close FROM payload_rows WHERE high IS NOT NULL")
register("index_bar_payloads", lambda p: bar_ops.complete_bars(_payload_rows(p, True)).select(*_BAR),
         "SELECT symbol, trading_date, open, high, low, close, volume, coalesce(adj, close) AS adjusted_close FROM payload_rows WHERE high IS NOT NULL")
register("bar_payload_guard", lambda p: bar_ops.payload_summary(_payload_rows(p)), """
SELECT *, daily_declared AND coalesce(median_gap_days, 0) <= 7 AS accepted FROM (
SELECT symbol, count(*) AS bars, count(*) FILTER (WHERE high IS NULL) AS dropped_bars, median(gap)::DOUBLE AS median_gap_days, bool_and(granularity = '1d') AS daily_declared
FROM (SELECT *, trading_date - lag(trading_date) OVER (PARTITION BY symbol ORDER BY trading_date) AS gap FROM payload_rows) GROUP BY 1)""")

CTES["profiles"] = """
SELECT instrument_id, upper(trim(code)) AS symbol, trim(nullif(name, '')) AS name,
  CASE WHEN instrument_id % 5 = 4 OR instrument_id % 3 = 2 THEN NULL ELSE DATE '1995-01-01' + CAST(instrument_id % 2000 AS INTEGER) END AS listed_date,
  CASE sector_code WHEN 'AFRICA' THEN 'IDXENERGY' WHEN 'AMERICA' THEN 'IDXBASIC' WHEN 'ASIA' THEN 'IDXFINANCE' WHEN 'EUROPE' THEN 'IDXTECHNO' END AS sector_code,
  ['Papan Utama', 'pengembangan', 'New-Economy_Board', '  AKSELERASI ', 'Watchlist', 'Second Board'][instrument_id % 6 + 1] AS listing_board
FROM (SELECT *, CASE WHEN instrument_id % 13 = 0 THEN 'bad-' ELSE ' t' END || instrument_id AS code,
        CASE WHEN instrument_id % 17 = 0 THEN '' ELSE ' ' || symbol || ' ' END AS name FROM instruments)"""
_PROFILE = ["instrument_id", "symbol", "name", "listed_date", "sector_code", "listing_board"]
register("company_profiles", lambda p: profiles.normalize_profiles(feeds.profile_payloads(p.source)).select(*_PROFILE), "SELECT * FROM profiles")
register("profile_validation", lambda p: profiles.validate_profiles(
    profiles.normalize_profiles(feeds.profile_payloads(p.source)), _lit_date("1998-01-01")).select(
    "instrument_id", "symbol", F.array_join("reasons", "|").alias("reasons")), """
SELECT instrument_id, symbol, concat_ws('|', CASE WHEN NOT regexp_full_match(symbol, '[A-Z0-9]{1,12}') THEN 'Invalid symbol format.' END,
  CASE WHEN name IS NULL THEN 'Company name is empty.' END, CASE WHEN listed_date > DATE '1998-01-01' THEN 'Listing date is after snapshot date.' END) AS reasons FROM profiles""")


def _refreshed(p, part):
    accepted = profiles.accepted_profiles(
        profiles.normalize_profiles(feeds.profile_payloads(p.source)).withColumn(
            "symbol", F.when(F.col("instrument_id") % 10 == 9, F.concat(F.lit("T"), (F.col("instrument_id") - 1).cast("string"))).otherwise(F.col("symbol"))),
        _lit_date("1998-01-01"), "instrument_id")
    stored = p.instruments.filter("sector_code <> 'ASIA'").select(
        F.concat(F.lit("T"), F.col("instrument_id").cast("string")).alias("symbol"), F.concat(F.lit("old "), "symbol").alias("name"),
        F.lit("IDXTRANS").alias("sector_code"), F.lit("1980-01-01").cast("date").alias("listed_date"), F.lit(True).alias("is_active"),
        F.create_map(F.lit("listing_board"), F.lit("old"), F.lit("origin"), F.lit("stored")).alias("metadata"))
    return profiles.refresh_universe(stored, accepted, _lit_date(SNAPSHOT_DAY), 1)[part]


CTES["refreshed_new"] = """
SELECT * FROM (SELECT instrument_id, CASE WHEN instrument_id % 10 = 9 THEN 'T' || (instrument_id - 1) ELSE symbol END AS symbol, name, listed_date, sector_code, listing_board FROM profiles)
WHERE regexp_full_match(symbol, '[A-Z0-9]{1,12}') AND name IS NOT NULL AND NOT coalesce(listed_date > DATE '1998-01-01', false)
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY instrument_id DESC) = 1"""
register("universe_refresh", lambda p: _refreshed(p, 0).select(
    "symbol", "name", "sector_code", "listed_date", "is_active", F.element_at("metadata", "listing_board").alias("listing_board"), F.element_at("metadata", "origin").alias("origin")), """
SELECT coalesce(n.symbol, o.symbol) AS symbol, coalesce(n.name, o.name) AS name, coalesce(n.sector_code, o.sector_code) AS sector_code,
  coalesce(n.listed_date, o.listed_date) AS listed_date, true AS is_active, coalesce(n.listing_board, 'old') AS listing_board, o.origin
FROM refreshed_new n FULL JOIN (SELECT 'T' || s_suppkey AS symbol, 'old ' || s_name AS name, 'IDXTRANS' AS sector_code, DATE '1980-01-01' AS listed_date, 'stored' AS origin
  FROM supplier JOIN instruments ON instrument_id = s_suppkey WHERE instruments.sector_code <> 'ASIA') o ON o.symbol = n.symbol""")
register("universe_snapshot", lambda p: _refreshed(p, 1),
         "SELECT symbol, name, sector_code, listing_board, listed_date, DATE '2001-11-04' AS snapshot_date, true AS is_member FROM refreshed_new")

CTES["new_listings"] = """
SELECT i, 2023 + (i % 36) // 12 AS year, (i % 36) % 12 + 1 AS month, 'N' || CASE WHEN i % 31 = 0 THEN 0 ELSE i END AS symbol,
  concat_ws('|', CASE WHEN i % 29 = 0 THEN 'OUTSIDE_REQUESTED_MONTH' END, CASE WHEN i % 23 = 0 THEN 'INVALID_NUMOFSHARES' END, CASE WHEN i % 19 = 0 THEN 'INVALID_OFFERING' END) AS errors,
  make_date(2023 + (i % 36) // 12, CASE WHEN i % 29 = 0 THEN ((i % 36) % 12 + 1) % 12 + 1 ELSE (i % 36) % 12 + 1 END, i % 28 + 1) AS listing_date
FROM (SELECT s_suppkey AS i, * FROM supplier)"""
register("new_listing_rows", lambda p: profiles.parse_new_listings(feeds.listing_pages(p.source)).select(
    F.col("year").cast("long"), F.col("month").cast("long"), "symbol", "listing_date", F.col("listed_shares").cast("long").alias("listed_shares"),
    F.array_join("errors", "|").alias("errors")),
    "SELECT year, month, symbol, listing_date, i * 1000 AS listed_shares, errors FROM new_listings")
register("new_listing_coverage", lambda p: profiles.listing_coverage(profiles.parse_new_listings(feeds.listing_pages(p.source))), """
SELECT *, collected_rows = total_items AND bad_rows = 0 AND duplicate_symbols = 0 AS complete FROM (
SELECT year, month, CAST(sum(n) AS BIGINT) AS collected_rows, CAST(sum(n) AS BIGINT) + CASE WHEN month = 5 THEN 1 ELSE 0 END AS total_items,
  CAST(sum(bad) AS BIGINT) AS bad_rows, count(*) FILTER (WHERE n > 1) AS duplicate_symbols
FROM (SELECT year, month, symbol, count(*) AS n, count(*) FILTER (WHERE errors <> '') AS bad FROM new_listings GROUP BY 1, 2, 3) GROUP BY 1, 2)""")


def _holdings(p):
    return holdings.parse_lines(feeds.holding_lines(p.snapshots, p.instruments))


CTES["holdings"] = f"""
SELECT *, CASE WHEN instrument_id % 16 = 0 THEN 'Unreadable field.' ELSE concat_ws('|',
   CASE WHEN instrument_id % 7 = 0 THEN 'Local category sum does not match Local Total.' END,
   CASE WHEN instrument_id % 7 = 0 THEN 'Local + foreign holdings exceed total securities.' END,
   CASE WHEN instrument_id % 7 = 0 AND (local_shares + 1)::DOUBLE / security_number * 100.0 > 100.0001 THEN 'local_ownership_pct outside 0-100.' END,
   CASE WHEN instrument_id % 7 = 0 AND (security_number + 1)::DOUBLE / security_number * 100.0 > 100.0001 THEN 'scripless_pct outside 0-100.' END) END AS errors
FROM snapshots WHERE instrument_id % 9 <> 0"""
register("holding_lines", lambda p: _holdings(p).select("archive", "line_no", "code", F.array_join("errors", "|").alias("errors")), """
SELECT 'BalanceposEfek' || strftime(as_of_date, '%Y%m%d') || '.zip' AS archive, CAST(instrument_id + 2 AS INTEGER) AS line_no, 'C' || instrument_id AS code, errors FROM holdings""")
register("holding_snapshots", lambda p: holdings.snapshot_rows(_holdings(p), p.instruments.filter("sector_code <> 'ASIA'").withColumn(
    "symbol", F.concat(F.lit("C"), F.col("instrument_id").cast("string"))))[0].select(
    "instrument_id", "as_of_date", "local_ownership_pct", "foreign_ownership_pct", "scripless_pct",
    F.col("holder_details.foreign.total").alias("foreign_total"), F.col("holder_details.local.IS").alias("local_is")), f"""
SELECT instrument_id, as_of_date, {r("local_shares::DOUBLE / security_number * 100.0", 8)} AS local_ownership_pct, foreign_ownership_pct,
  {r("(local_shares + foreign_shares)::DOUBLE / security_number * 100.0", 8)} AS scripless_pct, foreign_shares AS foreign_total, local_shares - local_shares // 9 * 8 AS local_is
FROM holdings JOIN instruments USING (instrument_id) WHERE errors = '' AND sector_code <> 'ASIA'""")
register("holding_unmapped", lambda p: holdings.snapshot_rows(_holdings(p), p.instruments.filter("sector_code <> 'ASIA'").withColumn(
    "symbol", F.concat(F.lit("C"), F.col("instrument_id").cast("string"))))[1],
    "SELECT DISTINCT 'C' || instrument_id AS code FROM holdings JOIN instruments USING (instrument_id) WHERE errors = '' AND sector_code = 'ASIA'")
register("archive_identity", lambda p: holdings.archive_identity(_holdings(p)), """
SELECT 'BalanceposEfek' || strftime(as_of_date, '%Y%m%d') || '.zip' AS archive,
  'Balancepos' || strftime(CASE WHEN month(as_of_date) = 2 THEN as_of_date + 1 ELSE as_of_date END, '%Y%m%d') || '.txt' AS member, count(*) AS rows,
  min(as_of_date) FILTER (WHERE errors = '') AS record_date, CASE WHEN count(*) FILTER (WHERE errors = '') = 0 THEN 'no valid records'
  WHEN month(as_of_date) = 2 THEN 'file name and member dates differ' END AS problem FROM holdings GROUP BY as_of_date""")

# pages: short words as keywords, so that the sample's links are candidates
WORDS = ["api", "json", "list", "the", "and", "ion"]
DOMAINS = ["therha.example.com"]
_SITE = "regexp_extract(url, '^(https?://[^/?#]+)', 1)"
_CLEAN = r"regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?is)(<script\b[^>]*>).*?</script\s*>', '\1', 'g'), '(?is)(<style\b[^>]*>).*?</style\s*>', '\1', 'g')"
_WORD_TEST = " OR ".join(f"contains(lower(candidate), '{w}')" for w in WORDS)
_EXT_TEST = " OR ".join(f"ends_with(lower(candidate), '{e}')" for e in pages.EXTENSIONS)
CTES["page_refs"] = r"""
SELECT page_id, url, replace(unnest(regexp_extract_all(""" + _CLEAN + r""", '(?is)<a\b[^>]*?[\s"'']href\s*=\s*"([^"]+)"', 1)), '&amp;', '&') AS ref FROM pages
UNION ALL SELECT page_id, url, unnest(regexp_extract_all(html, '(?i)https?://[^\s"''<>]+')) FROM pages
UNION ALL SELECT page_id, url, unnest(regexp_extract_all(html, '["''](/[^"''<>]{2,300})["'']', 1)) FROM pages"""
CTES["page_links"] = f"""
SELECT DISTINCT page_id, url, candidate FROM (SELECT *, CASE WHEN ref LIKE 'http%' THEN ref ELSE {_SITE} || ref END AS candidate
  FROM (SELECT page_id, url, regexp_replace(trim(ref), '[),.;]+$', '') AS ref FROM page_refs)) WHERE {_EXT_TEST} OR {_WORD_TEST}"""
register("page_candidate_links", lambda p: pages.candidate_links(p.source.table("pages"), WORDS), "SELECT * FROM page_links")
register("page_contracts", lambda p: pages.page_contracts(p.source.table("pages"), DOMAINS, WORDS), f"""
SELECT *, CASE WHEN download_like + api_like + primary_like > 0 THEN 'CANDIDATE' ELSE 'DISCOVERY' END AS parser_status FROM (
SELECT p.page_id, max(len(regexp_extract_all({_CLEAN}, '(?i)<a\\b'))) AS anchor_count, max(len(regexp_extract_all({_CLEAN}, '(?i)<script\\b'))) AS script_count,
  max(len(regexp_extract_all({_CLEAN}, '(?i)<form\\b'))) AS form_count, sha256(any_value(html)) AS body_sha256, max(strlen(html)) AS body_length, count(candidate) AS candidate_url_count,
  count(*) FILTER (WHERE {" OR ".join(f"contains(lower(candidate), '{e}')" for e in pages.EXTENSIONS)}) AS download_like,
  count(*) FILTER (WHERE contains(lower(candidate), '/api/') OR contains(lower(candidate), 'api.') OR contains(lower(candidate), 'json')) AS api_like,
  count(*) FILTER (WHERE contains(lower(candidate), '/primary/')) AS primary_like,
  count(*) FILTER (WHERE regexp_extract(lower(candidate), '^https?://([^/?#:]+)', 1) = 'therha.example.com') AS source_domain
FROM pages p LEFT JOIN page_links l ON l.page_id = p.page_id GROUP BY 1)""")
MARKERS = ["Cookie", "article", "und der", "nicht auLICH", "the of"]
register("page_markers", lambda p: pages.marker_hits(p.source.table("pages"), MARKERS, 2).drop("url"), f"""
SELECT page_id, array_to_string(m, '|') AS matched, CAST(len(m) AS INTEGER) AS marker_hits, len(m) >= 2 AS success FROM (
  SELECT page_id, list_filter({MARKERS}, lambda x: contains(lower(trim(regexp_replace(html, '\\s+', ' ', 'g'))), lower(x))) AS m FROM pages)""")
register("json_row_counts", lambda p: pages.json_rows(
    feeds.listing_pages(p.source), "body").groupBy("year", "month").agg(F.sum("json_rows").alias("json_rows"), F.min("success").alias("success")),
    "SELECT year, month, count(*) AS json_rows, true AS success FROM new_listings GROUP BY 1, 2")
register("delisting_table_rows", lambda p: pages.delisting_table(feeds.delisting_pages(_events(p))).select("symbol", "company_name", "listing_date", "delisting_date"), """
SELECT upper(symbol) AS symbol, 'Co & ' || symbol AS company_name, NULL::DATE AS listing_date, effective_date AS delisting_date FROM life_events WHERE event_type = 'DELISTED'""")
register("performance_table_rows", lambda p: pages.performance_table(feeds.performance_pages(p.source)).select("level", "symbol", "company_name", "listing_date"), """
SELECT CASE WHEN layout THEN 1 ELSE 0 END AS level, symbol, company_name, listing_date FROM (
  SELECT false AS layout, upper(symbol) AS symbol, CASE WHEN (instrument_id // 50) % 2 = 0 THEN 'PT & ' || symbol END AS company_name,
    DATE '1995-01-01' + CAST(instrument_id % 2000 AS INTEGER) AS listing_date FROM instruments
  WHERE instrument_id % 11 <> 0 AND NOT ((instrument_id // 50) % 2 = 0 AND instrument_id % 7 = 0)
  UNION ALL SELECT true, 'MENU', 'x', DATE '2001-01-01' FROM (SELECT DISTINCT instrument_id // 50 FROM instruments))""")
register("highlight_counts", lambda p: feeds.highlight_pages(_events(p)).select(
    F.col("month").cast("long").alias("month"), *[c.alias(n) for n, c in pages.section_count("html").items()]), f"""
SELECT month, CASE month % 5 WHEN 0 THEN 'SECTION_NOT_FOUND' WHEN 1 THEN 'EMPTY_FIELD' WHEN 2 THEN 'COUNT_NOT_PARSED' ELSE 'COUNT_PARSED' END AS status,
  CASE WHEN month % 5 >= 3 THEN n * 1000 + month % 7 END AS issuer_count
FROM (SELECT CAST({MONTH.format(d="effective_date")} AS BIGINT) AS month, count(*) FILTER (WHERE event_type = 'DELISTED') AS n FROM life_events GROUP BY 1)""")

# --- normalisers over written text ----------------------------------------------

register("event_symbol_dates", lambda p: p.source.table("orders").select("o_orderkey", dates.event_symbol(
    F.when(F.col("o_orderkey") % 11 == 0, "  ").otherwise(F.concat(F.lit(" k"), F.col("o_custkey").cast("string"), F.lit(" ")))).alias("symbol"),
    dates.event_date(F.when(F.col("o_orderkey") % 6 == 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).when(F.col("o_orderkey") % 6 == 1, F.date_format("o_orderdate", "dd/MM/yyyy"))
                     .when(F.col("o_orderkey") % 6 == 2, F.date_format("o_orderdate", "dd-MM-yyyy")).when(F.col("o_orderkey") % 6 == 3, F.date_format("o_orderdate", " dd MMM yyyy"))
                     .when(F.col("o_orderkey") % 6 == 4, F.lit("0001-01-01")).otherwise(F.lit("31/02/1999"))).alias("event_date")), """
SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN 'K' || o_custkey END AS symbol, CASE WHEN o_orderkey % 6 <= 3 THEN CAST(o_orderdate AS DATE) END AS event_date FROM orders""")
register("universe_version_dates", lambda p: p.source.table("orders").select("o_orderkey", dates.universe_date(
    F.when(F.col("o_orderkey") % 5 == 0, "stock_screener_v1").otherwise(dates.model_version("stock_screener_v1", F.to_date("o_orderdate"), "_eod"))).alias("universe_date")),
    "SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS universe_date FROM orders")
register("event_json_fields", lambda p: p.source.table("events").select("event_id", F.nullif(
    F.get_json_object("props", "$.k"), F.lit("")).try_cast("double").alias("k")), "SELECT event_id, TRY_CAST(nullif(props ->> '$.k', '') AS DOUBLE) AS k FROM events")
