"""Exact recursive filters e[t] = a*x[t] + (1-a)*e[t-1] as window sums.

Inside a chunk of rows the recursion is a running sum of x*(1-a)^-i, scaled
back by (1-a)^p. The chunk is long enough that the state two chunks back has
decayed below double precision and short enough that (1-a)^-i stays finite, so
only the end of the previous chunk is carried over. All filters of one series
share the chunk and therefore share the two windows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK_ROWS = 4020


@dataclass(frozen=True)
class Smoother:
    """Output column, input column, decay, minimum number of inputs, and how many
    leading rows of a series have no input (a first difference has one)."""

    output: str
    source: str
    alpha: float
    minimum: int
    lead: int = 0


def span(output: str, source: str, periods: int) -> Smoother:
    return Smoother(output, source, 2.0 / (periods + 1.0), periods)


def wilder(output: str, source: str, periods: int = 14, lead: int = 0) -> Smoother:
    return Smoother(output, source, 1.0 / periods, periods, lead)


def smooth(df: DataFrame, smoothers: list[Smoother], keys: list[str], order: str, position: str,
           chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add one column per smoother; ``position`` is the 1-based row number in the series.

    Both windows read the rows in (key, chunk, time) order, so one sort serves them.
    """
    chunk = F.floor((F.col(position) - 1) / F.lit(chunk_rows)).cast("long")
    offset = F.pmod(F.col(position) - 1, F.lit(chunk_rows)).cast("double")
    df = df.withColumn("_chunk", chunk).withColumn("_off", offset)
    running = (
        Window.partitionBy(*keys, "_chunk").orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = Window.partitionBy(*keys).orderBy("_chunk", order).rowsBetween(Window.unboundedPreceding, -1)

    local = {}
    for s in smoothers:
        keep = 1.0 - s.alpha
        weight = F.when(F.col(position) == s.lead + 1, F.lit(1.0)).otherwise(F.lit(s.alpha))
        term = weight * F.col(s.source) * F.pow(F.lit(keep), -F.col("_off"))
        local[f"_l_{s.output}"] = F.pow(F.lit(keep), F.col("_off")) * F.sum(term).over(running)
    df = df.withColumns(local)
    final = {}
    for s in smoothers:
        keep = 1.0 - s.alpha
        tail = F.last(
            F.when(F.col("_off") == chunk_rows - 1, F.col(f"_l_{s.output}")), ignorenulls=True
        ).over(before)
        carried = F.coalesce(F.pow(F.lit(keep), F.col("_off") + 1.0) * tail, F.lit(0.0))
        ready = F.col(position) >= s.minimum + s.lead
        final[s.output] = F.when(ready, F.col(f"_l_{s.output}") + carried)
    return df.withColumns(final).drop("_chunk", "_off", *local)
