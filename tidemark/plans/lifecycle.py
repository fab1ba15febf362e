"""Listing lifecycle: canonical dates, intervals, replay and membership deltas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.keyed import last_per_key
from tidemark.operators.sets import votes
from tidemark.sources.feeds import month_index

OPENING = ["LISTED", "RELISTED"]


# --- canonical dates by vote --------------------------------------------------

def _leading_date(feeds: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: most voted date (earliest among equals), its votes, ties and date count."""
    ballot = votes(feeds, [*keys, "listing_date"])
    tally = ballot.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("dates"), F.max("votes").alias("best_votes"),
        F.max_by(F.struct("listing_date", "sources"), F.struct("votes", -F.unix_date("listing_date"))).alias("_lead"),
    )
    ties = ballot.join(tally.select(*keys, "best_votes"), keys).filter("votes = best_votes").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("tied"))
    return tally.join(ties, keys).select(
        *keys, "dates", "best_votes", "tied", F.col("_lead.listing_date").alias("_date"), F.col("_lead.sources").alias("_sources"))


def canonical_dates(feeds: DataFrame, keys: list[str]) -> DataFrame:
    """Two or more votes with a unique maximum decide; one vote on one date stands alone."""
    lead = _leading_date(feeds, keys)
    decided = (F.col("best_votes") >= 2) & (F.col("tied") == 1)
    status = (
        F.when(decided & (F.col("dates") > 1), "CONFLICT_RESOLVED_BY_CONSENSUS").when(decided, "CONFIRMED_MULTI_SOURCE")
        .when((F.col("best_votes") == 1) & (F.col("dates") == 1), "SINGLE_SOURCE").otherwise("UNRESOLVED_CONFLICT")
    )
    return lead.withColumn("status", status).select(
        *keys, "status", F.when(F.col("status") != "UNRESOLVED_CONFLICT", F.col("_date")).alias("listing_date"),
        F.when(F.col("status") != "UNRESOLVED_CONFLICT", F.array_join("_sources", ",")).otherwise("").alias("supporting_sources"),
        "dates", "best_votes")


def anchored_dates(feeds: DataFrame, keys: list[str], anchored: str) -> DataFrame:
    """Variant for years with a published count: one vote stands only if the count matches.

    ``anchored`` is a boolean column of the feeds, constant per key.
    """
    lead = _leading_date(feeds, keys).join(feeds.groupBy(*keys).agg(F.max(anchored).alias("_anchor")), keys)
    many = F.col("dates") > 1
    status = (
        F.when(many & (F.col("tied") != 1), "UNRESOLVED").when(F.col("best_votes") >= 2, "CONFIRMED_MULTI_SOURCE")
        .when(~many & F.col("_anchor"), "COUNT_ANCHORED_SINGLE_SOURCE").otherwise("UNRESOLVED")
    )
    quality = F.when(F.col("status") == "CONFIRMED_MULTI_SOURCE", "VALID").when(F.col("status") == "COUNT_ANCHORED_SINGLE_SOURCE", "WARNING").otherwise("REJECTED")
    return lead.withColumn("status", status).select(
        *keys, "status", F.when(F.col("status") != "UNRESOLVED", F.col("_date")).alias("listing_date"),
        quality.alias("quality"), F.col("_anchor").alias("coverage_anchor_match"))


def strict_years(feeds: DataFrame, sources: list[str], anchor: str) -> DataFrame:
    """Per year: source sizes, status counts and the strict-ready gate."""
    per_symbol = feeds.groupBy("year", "symbol").agg(
        *[F.max(F.col("source") == s).alias(s) for s in sources],
        F.count_distinct("source").alias("_sources"))
    rows = per_symbol.join(canonical_dates(feeds, ["year", "symbol"]).drop("dates", "best_votes"), ["year", "symbol"])

    def status(name: str) -> Column:
        return F.count_if(F.col("status") == name)

    out = rows.groupBy("year").agg(
        *[F.count_if(s).alias(f"{s.lower()}_count") for s in sources],
        F.count(F.lit(1)).alias("symbol_union_count"), F.count("listing_date").alias("canonical_count"),
        status("CONFIRMED_MULTI_SOURCE").alias("confirmed_count"), status("CONFLICT_RESOLVED_BY_CONSENSUS").alias("resolved_conflict_count"),
        status("SINGLE_SOURCE").alias("single_source_count"), status("UNRESOLVED_CONFLICT").alias("unresolved_count"),
        F.count_if(F.col("_sources") < len(sources)).alias("incomplete_source_count"))
    complete = F.col(f"{anchor.lower()}_count") == F.col("symbol_union_count")
    ready = (
        complete & (F.col("canonical_count") == F.col("symbol_union_count"))
        & (F.col("single_source_count") == 0) & (F.col("unresolved_count") == 0))
    return out.withColumns({"anchor_complete": complete, "strict_ready": ready})


def evidence_years(feeds: DataFrame, sources: list[str], anchor: str, current_year: int,
                   published: DataFrame) -> DataFrame:
    """One row per year under the mode that fits it.

    ``published`` (year, expected_count) lists the years anchored on a published
    count; the current year is provisional; the rest need three sources.
    """
    pair = feeds.filter(F.col("source") != anchor)
    union = pair.groupBy("year").agg(F.count_distinct("symbol").alias("union_count"))
    matched = union.join(published, "year").withColumn("anchored", F.col("union_count") == F.col("expected_count"))
    older = pair.filter(F.col("year") != current_year).join(matched.select("year", "anchored"), "year")
    counted = pair.groupBy("year").agg(*[
        F.count_distinct(F.when(F.col("source") == s, F.col("symbol"))).alias(f"{s.lower()}_count") for s in sources if s != anchor])
    older_rows = anchored_dates(older, ["year", "symbol"], "anchored").groupBy("year").agg(
        F.count("listing_date").alias("canonical_count"), F.count_if(F.col("status") == "UNRESOLVED").alias("unresolved_count"),
        F.count_if(F.col("status") == "COUNT_ANCHORED_SINGLE_SOURCE").alias("single_source_count"))
    bounded = older_rows.join(matched, "year").join(counted, "year").withColumns({
        "mode": F.lit("BOUNDED_COUNT_ANCHORED"), f"{anchor.lower()}_count": F.lit(0).cast("long"),
        "event_date_ready": F.col("anchored") & (F.col("canonical_count") == F.col("expected_count")) & (F.col("unresolved_count") == 0),
        "coverage_anchor_match": F.col("anchored")})
    strict = strict_years(feeds, sources, anchor).join(published, "year", "left_anti").filter(F.col("year") != current_year).withColumns({
        "mode": F.lit("STRICT_THREE_SOURCE"), "expected_count": F.col("symbol_union_count"), "union_count": F.col("symbol_union_count"),
        "coverage_anchor_match": F.col("anchor_complete"), "event_date_ready": F.col("strict_ready")})
    first = sources[0]
    current = feeds.filter((F.col("source") == first) & (F.col("year") == current_year)).select(
        "year", "symbol", "listing_date").distinct().groupBy("year").agg(F.count(F.lit(1)).alias("union_count"))
    provisional = current.withColumns({
        "mode": F.lit("CURRENT_YEAR_PROVISIONAL"), "expected_count": F.lit(None).cast("long"),
        **{f"{s.lower()}_count": F.col("union_count") if s == first else F.lit(0).cast("long") for s in sources},
        "canonical_count": F.col("union_count"), "unresolved_count": F.lit(0).cast("long"),
        "single_source_count": F.col("union_count"), "coverage_anchor_match": F.lit(None).cast("boolean"),
        "event_date_ready": F.lit(False)})
    columns = ["year", "mode", "expected_count", *[f"{s.lower()}_count" for s in sources], "union_count", "canonical_count",
               "unresolved_count", "single_source_count", "coverage_anchor_match", "event_date_ready"]
    return bounded.select(*columns).unionByName(strict.select(*columns)).unionByName(provisional.select(*columns))


# --- delisting evidence -------------------------------------------------------

def delisting_records(rows: DataFrame, arrival: str) -> DataFrame:
    """One record per (symbol, date); the spreadsheet wins over the page, then the last to arrive."""
    return last_per_key(rows, ["symbol", "delisting_date"], [F.col("origin") == "XLSX", F.col(arrival)])


def delisting_months(counts: DataFrame, records: DataFrame) -> DataFrame:
    """Published count against resolved records of each month."""
    found = records.groupBy(month_index(F.col("delisting_date")).alias("month")).agg(F.count(F.lit(1)).alias("resolved_rows"))
    n, rows = F.col("issuer_count"), F.coalesce(F.col("resolved_rows"), F.lit(0))
    rows = F.when(n > 0, rows).otherwise(0)
    return counts.join(found, "month", "left").select(
        "month", "issuer_count", rows.alias("resolved_rows"),
        F.when(n.isNull(), "COUNT_UNKNOWN").when(n <= 0, "NO_POSITIVE_COUNT").when(n == rows, "RESOLVED")
        .when(rows > 0, "PARTIAL").otherwise("POSITIVE_COUNT_NO_ROWS").alias("resolution_status"))


# --- intervals ----------------------------------------------------------------

def event_stream(*feeds: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Union of event feeds with clean symbols, inside the window if one is given."""
    out = feeds[0]
    for feed in feeds[1:]:
        out = out.unionByName(feed)
    out = out.withColumn("symbol", F.upper(F.trim("symbol")))
    if start is not None:
        out = out.filter(F.col("effective_date") >= start)
    return out if end is None else out.filter(F.col("effective_date") <= end)


def _ordered(baseline: DataFrame, events: DataFrame, start: Column) -> DataFrame:
    opening = baseline.select("symbol", start.alias("effective_date"), F.lit("WINDOW_BASELINE").alias("event_type"))
    return opening.withColumn("_o", F.lit(0)).unionByName(
        events.select("symbol", "effective_date", "event_type").withColumn("_o", F.lit(1)))


def intervals(baseline: DataFrame, events: DataFrame, start: Column) -> DataFrame:
    """Active intervals: opened by the baseline or a listing, closed by the next delisting.

    Rows between two delistings form one group; its last opening event is the
    start and the delisting after it the end. A delisting with nothing open is
    ignored, a later opening replaces an earlier one.
    """
    order = [F.col("_o"), F.col("effective_date"), F.col("event_type")]
    before = Window.partitionBy("symbol").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    closing = F.col("event_type") == "DELISTED"
    grouped = _ordered(baseline, events, start).withColumn(
        "_g", F.coalesce(F.sum(closing.cast("int")).over(before), F.lit(0)))
    opened = F.when(~closing, F.struct("_o", "effective_date", "event_type"))
    return grouped.groupBy("symbol", "_g").agg(
        F.max(opened).alias("_s"), F.max(F.when(closing, F.col("effective_date"))).alias("valid_to")
    ).filter("_s is not null").select(
        "symbol", F.col("_s.effective_date").alias("valid_from"), "valid_to",
        F.col("_s.event_type").alias("start_reason"),
        F.when(F.col("valid_to").isNotNull(), "DELISTED").alias("end_reason"),
        F.lit(False).alias("point_in_time_safe"), F.lit("UNKNOWN").alias("availability_status"))


def replayed_months(baseline: DataFrame, events: DataFrame, start: Column, last_month: Column) -> DataFrame:
    """(symbol, month) pairs the events imply; a delisting month still counts."""
    order = [F.col("_o"), F.col("effective_date"), F.col("event_type")]
    w = Window.partitionBy("symbol").orderBy(*order)
    rows = _ordered(baseline, events, start).withColumn("_next", F.lead("effective_date").over(w))
    begin = month_index(F.col("effective_date"))
    end = F.when(F.col("event_type") == "DELISTED", begin).otherwise(
        F.coalesce(month_index(F.col("_next")), last_month))
    return rows.select("symbol", F.explode(F.sequence(begin, F.greatest(begin, end))).alias("month")).distinct()


def replay(observed: DataFrame, baseline: DataFrame, events: DataFrame, start: Column, last_month: Column) -> DataFrame:
    """Month by month: observed against replayed symbols; same-month delistings are tolerated."""
    implied = replayed_months(baseline, events, start, last_month).withColumn("_r", F.lit(True))
    gone = events.filter("event_type = 'DELISTED'").select(
        "symbol", month_index(F.col("effective_date")).alias("month"), F.lit(True).alias("_d")).distinct()
    both = observed.select("symbol", "month", F.lit(True).alias("_o")).join(implied, ["symbol", "month"], "full_outer").join(
        gone, ["symbol", "month"], "left")
    extra = F.col("_o").isNull()
    return both.groupBy("month").agg(
        F.count("_o").alias("observed_symbols"), F.count("_r").alias("replayed_symbols"),
        F.count_if(F.col("_r").isNull()).alias("missing_from_replay"),
        F.count_if(extra & F.col("_d").isNull()).alias("extra_in_replay"),
        F.count_if(extra & F.col("_d").isNotNull()).alias("tolerated_same_month_delisting"),
    ).withColumn("passed", (F.col("missing_from_replay") == 0) & (F.col("extra_in_replay") == 0))


def bounded_rows(active: DataFrame, events: DataFrame, window_end: Column) -> DataFrame:
    """Lifecycle and membership rows of each interval, active part and delisted part."""
    quality = events.groupBy("symbol", "event_type").agg(F.max_by("quality", "effective_date").alias("_q"))
    first_listing = events.filter(F.col("event_type").isin(OPENING)).groupBy("symbol").agg(
        F.min("effective_date").alias("_listed"))
    ended = F.col("end_reason") == "DELISTED"
    graded = active.join(
        quality.select("symbol", F.col("event_type").alias("start_reason"), "_q"), ["symbol", "start_reason"], "left"
    ).join(first_listing, "symbol", "left").withColumns({
        "_until": F.when(ended, F.date_sub("valid_to", 1)).otherwise(window_end),
        "_quality": F.when(ended | (F.col("start_reason") == "WINDOW_BASELINE"), "WARNING")
        .when(F.col("_q").isin("VALID", "WARNING"), F.col("_q")).otherwise("WARNING"),
    })
    graded = graded.filter(F.when(F.coalesce(F.col("_until") >= F.col("valid_from"), F.lit(True)), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("Invalid bounded interval for "), F.col("symbol"))).cast("boolean")))
    listed = F.when(F.col("start_reason") != "WINDOW_BASELINE", F.col("_listed"))
    live = F.struct(
        F.col("valid_from").alias("effective_from"), F.col("_until").alias("effective_to"), F.lit("LISTED").alias("lifecycle_status"),
        F.lit("ACTIVE").alias("membership_status"), listed.alias("listing_date"), F.col("valid_to").alias("delisting_date"),
        F.col("_quality").alias("quality"))
    dead = F.struct(
        F.col("valid_to").alias("effective_from"), window_end.alias("effective_to"), F.lit("DELISTED").alias("lifecycle_status"),
        F.lit("INACTIVE").alias("membership_status"), F.lit(None).cast("date").alias("listing_date"),
        F.col("valid_to").alias("delisting_date"), F.lit("WARNING").alias("quality"))
    parts = F.array_compact(F.array(live, F.when(ended, dead)))
    return graded.select("symbol", F.explode(parts).alias("_p")).select(
        "symbol", "_p.*", F.lit("UNKNOWN").alias("availability_status"), F.lit(False).alias("point_in_time_safe"))


def preflight(active: DataFrame, instruments: DataFrame, special: DataFrame, events: DataFrame) -> DataFrame:
    """Counts of interval symbols that are known, missing but delisted, special, or unsupported."""
    known = instruments.select("symbol").distinct().withColumn("_known", F.lit(True))
    marked = special.select("symbol").distinct().withColumn("_special", F.lit(True))
    gone = events.filter("event_type = 'DELISTED'").select("symbol").distinct().withColumn("_gone", F.lit(True))
    rows = active.select("symbol").distinct().join(known, "symbol", "left").join(marked, "symbol", "left").join(gone, "symbol", "left")
    missing = F.col("_known").isNull()
    is_special = missing & F.col("_special").isNotNull()
    delisted = missing & F.col("_special").isNull() & F.col("_gone").isNotNull()
    return rows.agg(
        F.count(F.lit(1)).alias("unique_symbols"), F.count_if(~missing).alias("matched_existing"),
        F.count_if(missing).alias("missing_symbols"), F.count_if(delisted).alias("eligible_missing_delisted"),
        F.count_if(is_special).alias("eligible_missing_special"),
        F.count_if(missing & ~is_special & ~delisted).alias("unsupported_missing"),
    ).withColumn("gate_passed", F.col("unsupported_missing") == 0)


# --- monthly membership -------------------------------------------------------

def valid_months(present: DataFrame, minimum: int) -> DataFrame:
    return present.groupBy("month").agg(F.count_distinct("symbol").alias("symbols")).filter(F.col("symbols") >= minimum)


def membership_changes(present: DataFrame, minimum: int = 1) -> DataFrame:
    """(symbol, month, REMOVED or ADDED) between adjacent valid months."""
    months = valid_months(present, minimum).select("month")
    kept = present.select("symbol", "month").distinct().join(months, "month", "left_semi")
    adjacent = months.join(months.select((F.col("month") + 1).alias("month")), "month", "left_semi")
    now = kept.withColumn("_now", F.lit(True))
    before = kept.select("symbol", (F.col("month") + 1).alias("month"), F.lit(True).alias("_before"))
    return now.join(before, ["symbol", "month"], "full_outer").filter(
        F.col("_now").isNull() | F.col("_before").isNull()
    ).join(adjacent, "month", "left_semi").select(
        "symbol", "month", F.when(F.col("_now").isNull(), "REMOVED").otherwise("ADDED").alias("change"))


def alignment(removed: Column, previous: Column, current: Column) -> Column:
    before, now = F.coalesce(previous == removed, F.lit(False)), F.coalesce(current == removed, F.lit(False))
    return (
        F.when(removed == 0, "NOT_APPLICABLE").when(before & now, "BOTH").when(before, "PREVIOUS_MONTH")
        .when(now, "CURRENT_MONTH").when(previous.isNull() & current.isNull(), "UNKNOWN").otherwise("NO_MATCH"))


def membership_deltas(present: DataFrame, events: DataFrame, highlights: DataFrame, minimum: int = 1) -> DataFrame:
    """Per adjacent month: removed, added, explained additions, and agreement with published counts."""
    months = valid_months(present, minimum).select("month")
    adjacent = months.join(months.select((F.col("month") + 1).alias("month")), "month", "left_semi")
    opened = events.filter(F.col("event_type").isin(OPENING)).groupBy(
        "symbol", month_index(F.col("effective_date")).alias("month")
    ).agg(F.max(F.col("event_type") == "LISTED").alias("_ipo"), F.max(F.col("event_type") == "RELISTED").alias("_re"))
    changes = membership_changes(present, minimum).join(opened, ["symbol", "month"], "left")
    added = F.col("change") == "ADDED"
    ipo, re = F.coalesce("_ipo", F.lit(False)), F.coalesce("_re", F.lit(False))
    counts = changes.groupBy("month").agg(
        F.count_if(~added).alias("removed"), F.count_if(added).alias("added"), F.count_if(added & ipo).alias("ipo_explained"),
        F.count_if(added & re).alias("relisting_explained"), F.count_if(added & ~ipo & ~re).alias("unexplained_additions"))
    names = ["removed", "added", "ipo_explained", "relisting_explained", "unexplained_additions"]
    now = highlights.select("month", F.col("issuer_count").alias("highlight_current_count"))
    before = highlights.select((F.col("month") + 1).alias("month"), F.col("issuer_count").alias("highlight_previous_count"))
    return (
        adjacent.join(counts, "month", "left").na.fill(0, names).join(before, "month", "left").join(now, "month", "left")
        .withColumn("highlight_alignment", alignment(
            F.col("removed"), F.col("highlight_previous_count"), F.col("highlight_current_count"))))


def removal_candidates(present: DataFrame, minimum: int = 1) -> DataFrame:
    """Removed symbols, split by whether any later valid month shows them again."""
    months = valid_months(present, minimum).select("month")
    last = present.join(months, "month", "left_semi").groupBy("symbol").agg(F.max("month").alias("_last"))
    back = F.col("_last") > F.col("month")
    return membership_changes(present, minimum).filter("change = 'REMOVED'").join(last, "symbol").select(
        "symbol", (F.col("month") - 1).alias("last_present_month"), F.col("month").alias("first_absent_month"),
        back.alias("later_reappearance"),
        F.when(back, "TEMPORARY_ABSENCE_OR_DATA_GAP").otherwise("PERSISTENT_REMOVAL_CANDIDATE").alias("classification"))
