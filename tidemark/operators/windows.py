"""Rolling row windows with minimum-count guards.

All of them run over one row per (key, date). Daily bars are aggregated or
deduplicated to that key first, so a window group never holds more rows than
the calendar has days, whatever share of the raw rows one key has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.numeric import col


def series(keys="instrument_id", order="trading_date") -> WindowSpec:
    keys = [keys] if isinstance(keys, str) else keys
    return Window.partitionBy(*keys).orderBy(order)


def trailing(w: WindowSpec, rows: int) -> WindowSpec:
    """The last ``rows`` rows, current one included."""
    return w.rowsBetween(-(rows - 1), 0)


def prior(w: WindowSpec, rows: int) -> WindowSpec:
    """The ``rows`` rows before the current one."""
    return w.rowsBetween(-rows, -1)


def bounded_history(df: DataFrame, after: Column, rows: int, keys="instrument_id", date: str = "trading_date") -> DataFrame:
    """Rows after a date plus the last ``rows`` rows of each key up to it.

    Enough for windows that look back ``rows`` rows; older partitions are not read
    again by whatever follows.
    """
    old = df.filter(F.col(date) <= after)
    newest = Window.partitionBy(keys).orderBy(F.col(date).desc())
    kept = old.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= rows).drop("_rn")
    return df.filter(F.col(date) > after).unionByName(kept)


def simple_return(value, rows: int, w: WindowSpec) -> Column:
    value = col(value)
    return value / F.lag(value, rows).over(w) - 1.0


def guarded(aggregate: Column, counted, frame: WindowSpec, minimum: int) -> Column:
    """The windowed aggregate, NULL until ``minimum`` non-NULL rows are in."""
    return F.when(F.count(col(counted)).over(frame) >= minimum, aggregate.over(frame))


def zscore(value, rows: int, w: WindowSpec) -> Column:
    """Distance from the rolling mean in population deviations."""
    value, frame = col(value), trailing(w, rows)
    deviation = guarded(F.stddev_pop(value), value, frame, rows)
    mean = F.avg(value).over(frame)
    return (value - mean) / F.nullif(deviation, F.lit(0.0))


def share_not_above(value, rows: int, minimum: int, w: WindowSpec) -> Column:
    """Fraction of the non-NULL window values that are <= the current value."""
    value, frame = col(value), trailing(w, rows)
    bag = F.collect_list(value).over(frame)
    below = F.size(F.filter(bag, lambda x: x <= value))
    return F.when(value.isNotNull() & (F.size(bag) >= minimum), below / F.size(bag))
