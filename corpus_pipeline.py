"""Documents to training tokens: toxicity, near copies, personal data, mixture, byte-level BPE."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, jaccard, mixing, pii, toxicity
from tidemark.llm.common import table
from tidemark.session import Workspace

TOXIC_FROM, WORDS, PERCENT = 0.3, 5, 80
#: Bytes of rows that go to a Python worker at once. Of whole texts the default of 10,000 rows is held several times over by both sides.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.reject(docs, model, TOXIC_FROM)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies."""
    return jaccard.one_of_each(docs, Workspace(spark), WORDS, PERCENT)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.mask(docs, pii.fit(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources take them."""
    return mixing.take(docs, Workspace(spark))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids with byte offsets of every document."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    tokens = bpe.encode(docs, path, public_tokenizers.PATTERN)
    return tokens.withColumn("n_tokens", F.size("ids").cast("long"))


def in_small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, in a session that sends texts to Python workers in batches of bounded size."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return run


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", in_small_batches(without_toxic)),
    ("near_copies", in_small_batches(without_copies)),
    ("personal_data", in_small_batches(without_personal_data)),
    ("mixture", in_small_batches(mixed)),
    ("byte_bpe", in_small_batches(encoded)),
]

#: Viterbi decoding, expectation-maximisation and BPE are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage is written to the shared folder and read again."""
    ws = Workspace(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = ws.write(stage(spark, docs, sf_dir), name)
    return docs
