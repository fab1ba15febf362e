"""Two-source reconciliation, votes and set fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def sided_pairs(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys with how often each side has them."""
    both = left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r")))
    return both.groupBy(*keys).agg(F.sum("l").alias("left_rows"), F.sum("r").alias("right_rows"))


def reconcile(left: DataFrame, right: DataFrame, groups: list[str], symbol: str, date: str) -> DataFrame:
    """Per group: exact matches, one-sided records, disagreeing symbols, duplicates, verdict."""
    pairs = sided_pairs(left, right, [*groups, symbol, date])
    in_left, in_right = F.col("left_rows") > 0, F.col("right_rows") > 0
    by_symbol = pairs.groupBy(*groups, symbol).agg(
        F.count_if(in_left).alias("_l"), F.count_if(in_right).alias("_r"),
        F.count_if(in_left & in_right).alias("_both"),
        F.sum(F.greatest(F.col("left_rows") - 1, F.lit(0))).alias("_dl"),
        F.sum(F.greatest(F.col("right_rows") - 1, F.lit(0))).alias("_dr"),
    )
    shared = (F.col("_l") > 0) & (F.col("_r") > 0)
    differs = shared & ((F.col("_both") < F.col("_l")) | (F.col("_both") < F.col("_r")))
    out = by_symbol.groupBy(*groups).agg(
        F.sum("_l").alias("left_count"), F.sum("_r").alias("right_count"), F.sum("_both").alias("exact_matches"),
        F.sum(F.col("_l") - F.col("_both")).alias("left_only"), F.sum(F.col("_r") - F.col("_both")).alias("right_only"),
        F.count_if(differs).alias("date_disagreements"),
        F.sum("_dl").alias("left_duplicates"), F.sum("_dr").alias("right_duplicates"),
    )
    clean = F.lit(True)
    for c in ("left_only", "right_only", "date_disagreements", "left_duplicates", "right_duplicates"):
        clean = clean & (F.col(c) == 0)
    return out.withColumn("verdict", F.when(clean, "PASS").otherwise("MISMATCH"))


def disagreements(left: DataFrame, right: DataFrame, groups: list[str], symbol: str, date: str) -> DataFrame:
    """Symbols both sides know whose date sets differ, with both date lists."""
    pairs = sided_pairs(left, right, [*groups, symbol, date])

    def dates(side: str) -> Column:
        chosen = F.collect_set(F.when(F.col(f"{side}_rows") > 0, F.col(date)))
        return F.array_join(F.transform(F.array_sort(chosen), lambda d: d.cast("string")), ",").alias(f"{side}_dates")

    return pairs.groupBy(*groups, symbol).agg(dates("left"), dates("right")).filter(
        "left_dates <> '' and right_dates <> '' and left_dates <> right_dates")


def votes(feeds: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct sources per key; the list of sources is short by nature."""
    return feeds.groupBy(*keys).agg(F.array_sort(F.collect_set("source")).alias("sources")).withColumn(
        "votes", F.size("sources"))


def repeated_across(feed: DataFrame, keys: list[str], bucket: str) -> DataFrame:
    """Keys that were seen in more than one bucket, with the bucket list and surplus.

    The list per key is as long as there are distinct buckets (here: line numbers), not rows.
    """
    return feed.groupBy(*keys).agg(
        F.array_sort(F.collect_set(bucket)).alias("_buckets"), F.count(F.lit(1)).alias("observations")
    ).filter(F.size("_buckets") > 1).select(
        *keys, F.array_join(F.transform("_buckets", lambda b: b.cast("string")), ",").alias("buckets"),
        "observations", (F.size("_buckets") - 1).alias("surplus"))


def fingerprints(df: DataFrame, groups: list[str], member: str) -> DataFrame:
    """One digest per group's set of members, equal for equal sets, by one rule at every size.

    The SHA-256 of each member is cut in four lanes of 15 hex digits, the lanes are added up over the set,
    and the SHA-256 of the sums joined by | is the digest. Sums need no order, so no set is gathered.
    """
    members = df.select(*groups, member).distinct()
    digest = F.sha2(F.col(member), 256)

    def lane(i: int) -> Column:
        part = F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")
        return F.sum(part).cast("string")

    return members.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("members"), F.sha2(F.concat_ws("|", *[lane(i) for i in range(4)]), 256).alias("fingerprint"))


def feed_completeness(feed: DataFrame, group: str, fields: list[str], symbol: str, date: str) -> DataFrame:
    """Rows, distinct rows, surplus, symbols and date range of each group; copies void coverage."""
    copies = feed.groupBy(group, *fields).agg(F.count(F.lit(1)).alias("_n"))
    rows = copies.groupBy(group).agg(
        F.sum("_n").alias("total_rows"), F.count(F.lit(1)).alias("unique_rows"),
        F.count_distinct(symbol).alias("symbols"), F.min(date).alias("first_date"), F.max(date).alias("last_date"))
    return rows.withColumn("duplicate_rows", F.col("total_rows") - F.col("unique_rows")).withColumn(
        "coverage_valid", F.col("duplicate_rows") == 0)
