"""Tables that are published version by version: written aside, checked, then switched by one manifest row."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

MANIFEST = (
    "version long, segments array<string>, mode string, model_version string, processed_through date, rows long, "
    "input_updated_at timestamp, token string"
)


class PublishConflict(RuntimeError):
    """Another writer has published the same version."""


class Published:
    """A folder of immutable segments and a manifest with one row per version.

    Readers take the segments of the newest manifest row, so they see a whole version or the one before it.
    An incremental version lists the segments of its predecessor and adds its own; nothing is rewritten.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def manifest(self) -> DataFrame:
        try:
            return self.spark.read.schema(MANIFEST).json(f"{self.root}/manifest")
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing.getCondition()):
                raise
            return self.spark.createDataFrame([], MANIFEST)

    def current(self) -> Row | None:
        """The newest version; of rows that claim one version the smallest token counts, for every reader."""
        return self.manifest().orderBy(F.col("version").desc(), "token").limit(1).first()

    def read(self, row: Row | None = None) -> DataFrame:
        """A version's rows, the newest without an argument; raises before the first is published."""
        row = row or self.current()
        if row is None:
            raise ValueError(f"nothing is published in {self.root}")
        return self.spark.read.parquet(*row["segments"])

    def stage(self, df: DataFrame) -> str:
        """Write rows aside; no reader sees them until a manifest row lists them."""
        path = f"{self.root}/data/segment-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return path

    def publish(self, segments: list[str], mode: str, model_version: str, processed_through: date | None, rows: int,
                input_updated_at: datetime | None, after: Row | None) -> Row:
        """Switch readers to the segments. ``after`` is the version the build started from; if another came meanwhile, it raises."""
        version, token = (after["version"] if after else 0) + 1, uuid.uuid4().hex
        newest = self.current()
        if (newest["version"] if newest else 0) != version - 1:
            raise PublishConflict(f"version {version} of {self.root} is already there")
        row = (version, segments, mode, model_version, processed_through, rows, input_updated_at, token)
        self.spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").json(f"{self.root}/manifest")
        won = self.current()
        if won["token"] != token:
            raise PublishConflict(f"version {version} of {self.root} was published by another writer")
        return won
