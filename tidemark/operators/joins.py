"""Time joins rewritten as windows and equi-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_backward(left: DataFrame, right: DataFrame, keys: list[str], left_time: str,
                  right_time: str, payload: list[str], how: str = "inner") -> DataFrame:
    """Latest right row at or before each left row's time.

    Both sides are stacked and the last right row seen is carried forward, one
    shuffle on the key instead of a range join. ``how='left'`` keeps left rows
    that find nothing; ``inner`` drops them. A NULL key or time matches nothing. The rows of one
    key are one window: right for series that are as long as a calendar, not for raw events of a hot key.
    """
    right = right.dropna(subset=[*keys, right_time])
    kept = [c for c in left.columns if c not in keys]
    carried = F.struct(F.col(right_time).alias(right_time), *[F.col(c) for c in payload])
    body = left.select(
        *keys, F.col(left_time).alias("_t"), F.lit(1).alias("_side"),
        F.struct(*kept).alias("_left"), F.lit(None).cast(right.select(carried.alias("r")).schema["r"].dataType).alias("_right"),
    )
    feed = right.select(
        *keys, F.col(right_time).alias("_t"), F.lit(0).alias("_side"),
        F.lit(None).cast(body.schema["_left"].dataType).alias("_left"), carried.alias("_right"),
    )
    w = (
        Window.partitionBy(*keys).orderBy("_t", "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = (
        body.unionByName(feed)
        .withColumn("_match", F.last("_right", ignorenulls=True).over(w))
        .filter("_side = 1")
    )
    if how == "inner":
        joined = joined.filter(F.col("_match").isNotNull())
    return joined.select(*keys, "_left.*", "_match.*")


def numbered(df: DataFrame, keys: list[str], order: str, out: str = "position") -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(order)))


def next_rows(events: DataFrame, bars: DataFrame, keys: list[str], event_time: str,
              bar_time: str, rows: int, bar_columns: list[str]) -> DataFrame:
    """Each event with its next ``rows`` bars after the event time.

    An event without a later bar is kept with NULL bars. ``bar_no`` counts from 1. Groups as for ``asof_backward``.
    Only bars of keys that have an event are ordered.
    """
    bars = bars.join(events.select(*keys).distinct().hint("shuffle_hash"), keys, "left_semi")
    placed = numbered(bars.select(*keys, bar_time, *bar_columns), keys, bar_time, "_pos")
    based = asof_backward(
        events, placed.select(*keys, F.col(bar_time).alias("_bar_time"), "_pos"),
        keys, event_time, "_bar_time", ["_pos"], how="left",
    )
    wanted = based.withColumn(
        "bar_no", F.explode(F.sequence(F.lit(1), F.lit(rows)))
    ).withColumn("_pos", F.coalesce(F.col("_pos"), F.lit(0)) + F.col("bar_no")).drop("_bar_time")
    found = wanted.join(
        placed.select(*keys, "_pos", F.col(bar_time).alias("bar_date"), *bar_columns),
        [*keys, "_pos"], "left",
    )
    return found.filter(F.col("bar_date").isNotNull() | (F.col("bar_no") == 1)).withColumn(
        "bar_no", F.when(F.col("bar_date").isNotNull(), F.col("bar_no"))
    ).drop("_pos")


def points_in_ranges(ranges: DataFrame, points: DataFrame, keys: list[str], range_id: str,
                     start: str, end: str, point: str) -> DataFrame:
    """Distinct range ids that hold at least one point, as a flag table.

    A range [start, end] holds a point exactly when the first point at or after
    ``start`` is at or before ``end``: a forward as-of on the key instead of a
    range join. A NULL key, start, end or point holds nothing. Groups as for ``asof_backward``.
    """
    ranges, points = ranges.dropna(subset=[*keys, start]), points.dropna(subset=[*keys, point])
    w = (
        Window.partitionBy(*keys).orderBy(F.col("_t").desc(), F.col("_side"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    left = ranges.select(*keys, F.col(start).alias("_t"), F.lit(1).alias("_side"),
                         F.col(range_id), F.col(end).alias("_end"))
    feed = points.select(*keys, F.col(point).alias("_t")).filter("_t is not null").distinct().select(
        *keys, "_t", F.lit(0).alias("_side"),
        F.lit(None).cast(ranges.schema[range_id].dataType).alias(range_id),
        F.lit(None).cast(ranges.schema[end].dataType).alias("_end"),
    )
    nearest = F.last(F.when(F.col("_side") == 0, F.col("_t")), ignorenulls=True).over(w)
    return (
        left.unionByName(feed).withColumn("_next", nearest)
        .filter("_side = 1 and _next <= _end").select(range_id).distinct()
    )


def overlapping(intervals: DataFrame, keys: list[str], start: str, end: str, tie: str) -> DataFrame:
    """Intervals that begin on or before the latest earlier end of their key.

    Non-empty exactly when some pair overlaps. NULL ends are open. Groups as for ``asof_backward``.
    """
    w = (
        Window.partitionBy(*keys).orderBy(F.col(start), F.col(tie))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    open_end = F.coalesce(F.col(end), F.lit("9999-12-31").cast("date"))
    return intervals.withColumn("_reach", F.max(open_end).over(w)).filter(
        F.col("_reach") >= F.col(start)
    ).drop("_reach")


def equal_or_close(a: Column, b: Column, absolute: float = 1e-4, relative: float = 1e-9) -> Column:
    """Same NULL-ness, and within the absolute or the relative tolerance."""
    tolerance = F.greatest(F.lit(absolute), F.lit(relative) * F.greatest(F.abs(a), F.abs(b)))
    return F.coalesce(F.abs(a - b) <= tolerance, a.isNull() & b.isNull())


def compared(generated: DataFrame, stored: DataFrame, keys: list[str],
             exact: list[str] = (), close: list[str] = (), absolute: float = 1e-4) -> DataFrame:
    """All keys of either side: ``generated`` (whether that side has it), ``issue`` and the differing ``fields``.

    ``issue`` is MISSING (only generated), UNEXPECTED (only stored), MISMATCH, or NULL where both agree.
    """
    fields = [*exact, *close]

    def side(df: DataFrame, name: str) -> DataFrame:
        packed = F.struct(F.lit(1).alias("_here"), *[F.col(c) for c in fields])
        return df.select(*keys, packed.alias(name))

    both = side(generated, "_g").join(side(stored, "_s"), keys, "full_outer")
    differs = [F.when(~F.col(f"_g.{c}").eqNullSafe(F.col(f"_s.{c}")), F.lit(c)) for c in exact]
    differs += [
        F.when(~equal_or_close(F.col(f"_g.{c}"), F.col(f"_s.{c}"), absolute), F.lit(c)) for c in close
    ]
    different = F.array_compact(F.array(*differs)) if differs else F.array().cast("array<string>")
    issue = (
        F.when(F.col("_s").isNull(), F.lit("MISSING"))
        .when(F.col("_g").isNull(), F.lit("UNEXPECTED"))
        .when(F.size("_fields") > 0, F.lit("MISMATCH"))
    )
    return both.withColumn("_fields", different).withColumn("issue", issue).select(
        *keys, F.col("_g").isNotNull().alias("generated"), "issue",
        F.when(F.col("issue") == "MISMATCH", F.array_join("_fields", ",")).alias("fields"))


def table_diff(generated: DataFrame, stored: DataFrame, keys: list[str],
               exact: list[str] = (), close: list[str] = (), absolute: float = 1e-4) -> DataFrame:
    """Keys that are missing, unexpected or hold different values, as ``compared`` finds them."""
    return compared(generated, stored, keys, exact, close, absolute).filter(F.col("issue").isNotNull()).drop("generated")
