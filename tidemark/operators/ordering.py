"""Ordered positions, running totals, ranks and medians over large groups.

A window partitioned by date puts a whole cross-section into one task. Here
the rows are range-partitioned on (group, order) instead, written once so the
partitions cannot change, counted per partition, and shifted by the counts of
the partitions before. A group of any size is spread over many tasks and
nothing but one row per (partition, group) is added up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import rnd
from tidemark.session import Workspace


def _spread(df: DataFrame, ws: Workspace, groups: list[str], order: list[Column], name: str) -> DataFrame:
    keys = [F.col(g).asc() for g in groups] + list(order)
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_seq", F.monotonically_increasing_id())
    )
    return ws.write(placed, name)


def _join_same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on equal keys, NULL being equal to NULL as in GROUP BY."""
    other = right.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & left[k].eqNullSafe(other[f"_k_{k}"])
    return left.join(other, same).drop(*[f"_k_{k}" for k in keys])


def _offsets(placed: DataFrame, groups: list[str], amount: Column) -> DataFrame:
    heads = placed.groupBy("_part", *groups).agg(
        amount.alias("_amount"), F.min("_seq").alias("_first")
    )
    before = (
        Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    return heads.select(
        "_part", *groups, "_first",
        F.coalesce(F.sum("_amount").over(before), F.lit(0)).alias("_before"),
    )


def positions(df: DataFrame, ws: Workspace, groups: list[str], order: list[Column],
              out: str, nested: dict[str, list[str]] | None = None) -> DataFrame:
    """1-based position in each group; ``order`` must be unique inside it.

    ``nested`` adds positions in finer groups under the same order.
    """
    placed = _spread(df, ws, groups, order, "positions")
    heads = _offsets(placed, groups, F.count(F.lit(1)))
    ranked = _join_same(placed, heads, ["_part", *groups]).withColumn(
        out, F.col("_before") + F.col("_seq") - F.col("_first") + 1
    ).drop("_first", "_before")
    for column, extra in (nested or {}).items():
        finer = [*groups, *extra]
        heads = _offsets(placed, finer, F.count(F.lit(1)))
        inside = Window.partitionBy("_part", *finer).orderBy("_seq")
        ranked = (
            _join_same(ranked.withColumn("_in", F.row_number().over(inside)), heads, ["_part", *finer])
            .withColumn(column, F.col("_before") + F.col("_in"))
            .drop("_in", "_first", "_before")
        )
    return ranked.drop("_part", "_seq")


def running_total(df: DataFrame, ws: Workspace, groups: list[str], order: list[Column],
                  amount: str, out: str) -> DataFrame:
    """Inclusive running sum of ``amount`` in each group."""
    placed = _spread(df, ws, groups, order, "running")
    heads = _offsets(placed, groups, F.sum(amount)).drop("_first")
    inside = (
        Window.partitionBy("_part", *groups).orderBy("_seq")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        _join_same(placed.withColumn("_in", F.sum(amount).over(inside)), heads, ["_part", *groups])
        .withColumn(out, F.col("_before") + F.col("_in"))
        .drop("_part", "_seq", "_in", "_before")
    )


def percent_rank(df: DataFrame, ws: Workspace, groups: list[str], value: str, out: str) -> DataFrame:
    """(rank - 1) / (rows - 1), ties sharing the lowest rank, 0 for one row.

    Equal values are counted first, so a value shared by any number of rows
    travels as one row. NULL values come last and share a rank, NULL groups are a group: no row is lost.
    """
    counted = df.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_n"))
    placed = running_total(counted, ws, groups, [F.col(value).asc_nulls_last()], "_n", "_upto")
    totals = placed.groupBy(*groups).agg(F.max("_upto").alias("_rows"))
    ranks = _join_same(placed, totals, groups).select(
        *groups, value,
        F.when(F.col("_rows") <= 1, F.lit(0.0))
        .otherwise((F.col("_upto") - F.col("_n")) / (F.col("_rows") - 1)).alias(out),
    )
    return _join_same(df, ranks, [*groups, value])


#: Bins of the histogram around the middle, and the accuracy of the sketch that places it.
BINS, ACCURACY = 4096, 10_000


def _bin(value: Column, low: Column, high: Column) -> Column:
    """0 below the edges, 1 to BINS between them, BINS + 1 above; never falls as the value grows, whatever the edges are."""
    width = high - low
    inside = F.least(F.lit(BINS), F.floor((value - low) / width * BINS).cast("int") + 1)
    ranged = (width > 0) & ~F.isnan(width) & (width < float("inf"))
    return F.when(value < low, 0).when(value > high, BINS + 1).when(ranged, inside).otherwise(1)


def _holding(counted: DataFrame, keys: list[str], order: str, before: Column) -> DataFrame:
    """Rows of ``counted`` that hold a middle rank; ``before`` rows of the group come ahead of all of them."""
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = counted.withColumn("_upto", before + F.sum("_n").over(upto))
    low, high = F.floor((F.col("_rows") + 1) / 2), F.floor((F.col("_rows") + 2) / 2)

    def holds(k: Column) -> Column:
        return (F.col("_upto") - F.col("_n") < k) & (k <= F.col("_upto"))

    return summed.filter(holds(low) | holds(high))


def medians(df: DataFrame, ws: Workspace, groups: list[str], values: list[str],
            digits: int = 8) -> DataFrame:
    """Exact median of each value column per group, one row per group.

    Selection, not sorting: a sketch places two edges around the middle, an exact histogram
    between them finds the bin (or two) that holds it, and only the distinct values of that bin are put in order.
    Edges that miss the middle cost time, never the result: what lies outside them is a bin too. Nothing but
    one row of edges and one row of bins per group is written, so that Spark knows their size when it joins them;
    no group is gathered and a value that most rows share is one row. ``df`` is read three times: pass a stored table.
    NULL values take no part, a NULL group is a group, a group without values gives no row, NaN is above all numbers.
    """
    stacked = df.select(
        *groups,
        F.explode(F.array(*[F.struct(F.lit(v).alias("_m"), F.col(v).alias("_v")) for v in values])).alias("_s"),
    ).select(*groups, "_s._m", "_s._v").filter(F.col("_v").isNotNull())
    keys, number = [*groups, "_m"], F.col("_v").cast("double")
    margin = 2 / ACCURACY
    edges = stacked.groupBy(*keys).agg(
        F.percentile_approx(number, [0.5 - margin, 0.5 + margin], ACCURACY).alias("_e"), F.count(F.lit(1)).alias("_rows")
    ).select(*keys, F.col("_e")[0].alias("_low"), F.col("_e")[1].alias("_high"), "_rows")
    edges = ws.write(edges, "median-edges")
    binned = _join_same(stacked, edges, keys).withColumn("_bin", _bin(number, F.col("_low"), F.col("_high")))
    counted = binned.groupBy(*keys, "_bin").agg(F.count(F.lit(1)).alias("_n"), F.max("_rows").alias("_rows"))
    bins = ws.write(_holding(counted, keys, "_bin", F.lit(0)).groupBy(*keys).agg(
        F.min("_bin").alias("_first"), F.max("_bin").alias("_last"), F.min(F.col("_upto") - F.col("_n")).alias("_before")), "median-bins")
    inside = _join_same(binned, bins, keys).filter(F.col("_bin").between(F.col("_first"), F.col("_last")))
    distinct = inside.groupBy(*keys, "_v").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_rows").alias("_rows"), F.max("_before").alias("_before"))
    half = _holding(distinct, keys, "_v", F.col("_before")).groupBy(*keys).agg(
        ((F.min("_v") + F.max("_v")) / 2.0).alias("_median")
    )
    return half.groupBy(*groups).agg(
        *[rnd(F.max(F.when(F.col("_m") == v, F.col("_median"))), digits).alias(f"median_{v}") for v in values]
    )
