"""Session settings and the workspace where stages are written."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # joins on (instrument, date) may use tables already laid out by instrument
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

#: What the research pipeline sets on any session it is given: joins on (instrument, date) use the layout by instrument, and code of
#: more bytes than the JVM compiles (8,000 a method) is not made as one method.
PLANNING = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
#: What holds while it writes a stage: shuffle files go when the stage is written, and a task that holds one bucket does not sort for it.
WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}
#: How its stages are stored: whole numbers as differences, compressed.
STORED = {"compression": "zstd", "parquet.writer.version": "v2"}


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g", shared: str | None = None) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own.

    ``shared`` becomes spark.checkpoint.dir; one process on one machine may take any folder.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items() | ({"spark.checkpoint.dir": shared} if shared else {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Rows to a file: of ids and numbers, where a row stands for the shingles of a text or a comparison of two, and of whole texts.
ROWS_A_FILE, SETS_A_FILE, TEXTS_A_FILE = 50_000, 4_000, 1_000


def files(rows: int, each: int = ROWS_A_FILE) -> int:
    """Files that so many rows fill."""
    return max(1, -(-rows // each))


def packed(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Doubles of so many decimals as whole numbers, which take under half the room; what is no such number stays beside it as it is."""
    if not digits:
        return df
    for c, n in digits.items():
        product = F.col(c) * F.lit(10.0**n)
        df = df.withColumn(f"_w_{c}", F.when(F.abs(product) < 2.0**53, F.rint(product).cast("long")))
    rest = {c: F.when(F.col(f"_w_{c}").isNull() | (F.col(f"_w_{c}") / F.lit(10.0**n) != F.col(c)), F.col(c)) for c, n in digits.items()}
    out = []
    for c in df.columns:
        if not c.startswith("_w_"):
            out += [F.col(f"_w_{c}").alias(c), rest[c].alias(f"_rest_{c}")] if c in rest else [F.col(c)]
    return df.select(*out)


def unpacked(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """The table that ``packed`` was given, value for value."""
    if not digits:
        return df
    return df.select(*[
        F.coalesce(F.col(f"_rest_{c}"), F.col(c) / F.lit(10.0**digits[c])).alias(c) if c in digits else F.col(c)
        for c in df.columns if not c.startswith("_rest_")])


class Workspace:
    """Writes a stage as Parquet in the cluster's shared checkpoint folder.

    A written stage cuts lineage, survives lost executors and keeps column
    pruning and filter pushdown for whatever reads it next. The folder comes
    from ``spark.checkpoint.dir``; without that setting it raises, since a folder
    of one machine would lose what other executors write.
    """

    def __init__(self, spark: SparkSession, parts: int | None = None, settings: dict[str, str] | None = None,
                 options: dict[str, str] | None = None, digits: dict[str, int] | None = None):
        """``settings`` of the session hold while it writes, ``options`` are the writer's, ``digits`` the decimals of doubles to pack, by name."""
        self.spark = spark
        self.settings, self.options, self.digits = settings or {}, options or {}, digits or {}
        self.parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        self.root = f"{root.rstrip('/')}/tidemark-{uuid.uuid4().hex}"
        self.tables: list[str] = []

    @contextmanager
    def _writing(self) -> Iterator[None]:
        """The settings hold inside, and are as they were after it."""
        before = {k: self.spark.conf.get(k, None) for k in self.settings}
        for k, v in self.settings.items():
            self.spark.conf.set(k, v)
        try:
            yield
        finally:
            for k, v in before.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)

    def _digits(self, df: DataFrame) -> dict[str, int]:
        return {c: self.digits[c] for c, kind in df.dtypes if kind == "double" and c in self.digits}

    def write_keyed(self, df: DataFrame, name: str, key: str, order: str | None = None) -> DataFrame:
        """Write bucketed by a key, so later windows and joins on it need no shuffle.

        ``keyed`` in front of the caller's windows makes each task hold one bucket. Without ``order`` rows are written as they come.
        """
        digits = self._digits(df)
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        table = f"tidemark_{uuid.uuid4().hex[:12]}_{name.replace('-', '_')}"
        writer = packed(df, digits).write.options(**self.options).bucketBy(self.parts, key)
        if order:
            writer = writer.sortBy(*dict.fromkeys([key, order]))
        with self._writing():
            writer.format("parquet").option("path", path).saveAsTable(table)
        self.tables.append(table)
        return unpacked(self.spark.table(table), digits)

    def close(self) -> None:
        """Forget the catalog entries of the keyed tables; their files stay."""
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.tables.clear()

    def keyed(self, df: DataFrame, key: str) -> DataFrame:
        """Hash-partition by a key into as many parts as the keyed tables have buckets."""
        return df.repartition(self.parts, key)

    def write(self, df: DataFrame, name: str, most: int | None = None) -> DataFrame:
        """Write and read again. ``most``: files at most, so that few rows do not become a tiny file for each shuffle partition.

        On a local disk Hadoop starts a process for every file it makes (``chmod``), which while it starts counts as a
        copy of the executor; in a store a file is a request. The tasks that write are as few, so ``most`` has to grow with their rows.
        """
        if most:
            df = df.coalesce(most)
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        digits = self._digits(df)
        df = packed(df, digits)
        with self._writing():
            df.write.options(**self.options).parquet(path)
        return unpacked(self.spark.read.schema(df.schema).parquet(path), digits)
