"""First/last row per key, duplicate keys, and keyed merges.

All are aggregates with a partial step before the shuffle, so the copies of a
hot key are reduced where they lie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType


def _pick(df: DataFrame, keys: list[str], order: list[Column], chooser) -> DataFrame:
    """Rows that tie in ``order`` are settled by their values (maps aside), so every run picks the same."""
    rest = [c for c in df.columns if c not in keys]
    ties = [F.col(c) for c in rest if not isinstance(df.schema[c].dataType, MapType)]
    chosen = chooser(F.struct(*[F.col(c) for c in rest]), F.struct(*order, *ties))
    return df.groupBy(*keys).agg(chosen.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return _pick(df, keys, order, F.min_by)


def last_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return _pick(df, keys, order, F.max_by)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows <> 1")


def upsert(stored: DataFrame, incoming: DataFrame, keys: list[str], arrival: str | None = None) -> DataFrame:
    """Incoming rows replace stored rows of the same key, one row per key.

    Of incoming rows that repeat a key the last by ``arrival`` wins, or without one the largest by its values.
    """
    both = stored.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    order = [F.col("_new"), *([F.col(arrival)] if arrival else [])]
    return last_per_key(both, keys, order).select(*stored.columns)


def merge_keep_known(stored: DataFrame, incoming: DataFrame, keys: list[str],
                     maps: list[str] = ()) -> DataFrame:
    """Incoming values win unless NULL; map columns are merged key by key.

    One row per key: of rows that repeat a key on one side the largest by its values stands for that side.
    """
    stored, incoming = (last_per_key(df, keys, []) for df in (stored, incoming))
    names = [c for c in stored.columns if c not in keys]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.struct(*names).alias(name))

    both = side(stored, "_o").join(side(incoming, "_n"), keys, "full_outer")
    out = []
    for c in names:
        old, new = F.col(f"_o.{c}"), F.col(f"_n.{c}")
        if c in maps:
            kept = F.map_filter(old, lambda k, v: ~F.map_contains_key(new, k))
            merged = F.coalesce(F.map_concat(kept, new), new, old)
        else:
            merged = F.coalesce(new, old)
        out.append(merged.alias(c))
    return both.select(*keys, *out)


def replace_if_better(stored: DataFrame, incoming: DataFrame, keys: list[str], rank: Column) -> DataFrame:
    """Replace a stored row only by one of strictly higher rank."""
    both = stored.withColumn("_old", F.lit(1)).unionByName(incoming.withColumn("_old", F.lit(0)))
    return last_per_key(both, keys, [rank.alias("r"), F.col("_old")]).drop("_old")
