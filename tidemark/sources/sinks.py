"""Partitioned Parquet tables: keyed upserts, deletes, logs and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.keyed import upsert
from tidemark.session import Workspace

# Stored precision by column family; arithmetic stays in double until here.
PRICE, RETURN, SCORE, OSCILLATOR = T.DecimalType(20, 6), T.DecimalType(18, 8), T.DecimalType(8, 4), T.DecimalType(12, 6)


def stored_types(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """Cast columns to their stored precision."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items() if c in df.columns})


def replace_partitions(df: DataFrame, path: str, partitions: list[str]) -> None:
    """Overwrite only the partitions that appear in the data."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def merge_table(spark: SparkSession, ws: Workspace, path: str, incoming: DataFrame, keys: list[str],
                partitions: list[str], merge=upsert) -> None:
    """Merge rows into a table by key, rewriting only the partitions touched.

    The merged partitions are written aside first, so the table is never read
    while it is being overwritten. Partition columns must be part of the key.
    """
    incoming = ws.write(incoming, "incoming")
    touched = incoming.select(*partitions).distinct()
    stored = spark.read.schema(incoming.schema).parquet(path).join(touched, partitions, "left_semi")
    merged = ws.write(merge(stored.select(*incoming.columns), incoming, keys), "merged")
    replace_partitions(merged, path, partitions)


def delete_partitions(spark: SparkSession, path: str, condition: Column, partitions: list[str]) -> int:
    """Drop whole partitions whose partition columns meet the condition; no other file is read or written.

    The condition may name partition columns only. A partition whose values make it NULL stays. Returns how many went.
    """
    stored = spark.read.parquet(path)
    found = stored.select(*partitions, F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("_folder"))
    folders = [r["_folder"] for r in found.filter(condition).select("_folder").distinct().collect()]  # one per partition
    paths = spark._jvm.org.apache.hadoop.fs
    for folder in folders:
        target = paths.Path(spark._jvm.java.net.URI(folder))
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return len(folders)


def delete_rows(spark: SparkSession, ws: Workspace, path: str, condition: Column, partitions: list[str]) -> None:
    """Rewrite a table without the rows that meet the condition; where it names partition columns only, ``delete_partitions`` does less."""
    kept = ws.write(spark.read.parquet(path).filter(~F.coalesce(condition, F.lit(False))), "kept")
    kept.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partitions).parquet(path)


def rebuild_keys(spark: SparkSession, ws: Workspace, path: str, stale: DataFrame, fresh: DataFrame, key: str, bucket: str) -> None:
    """Replace the rows of some keys in a table partitioned by a bucket of the key; only buckets that hold such a key are rewritten.

    ``stale`` lists the keys with their bucket, ``fresh`` holds all their new rows (none drops the key). Rows of other keys in a
    touched bucket are carried over as they are.
    """
    stale = ws.write(stale.select(key, bucket).distinct(), "stale")
    stored = spark.read.parquet(path)
    kept = stored.join(stale.select(bucket).distinct(), bucket, "left_semi").join(stale.select(key), key, "left_anti")
    rows = ws.write(kept.unionByName(fresh.join(stale.select(key), key, "left_semi").select(*stored.columns)), "rebuilt")
    replace_partitions(rows, path, [bucket])


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def export_json(df: DataFrame, path: str) -> None:
    """Snapshot as JSON lines, one file per partition."""
    df.write.mode("overwrite").json(path)
