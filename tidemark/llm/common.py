"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MEMO_ENTRIES = 400_000


def documents(docs: DataFrame, *extra: str) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) plus the named columns; every other column is left behind."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *extra)


def remainder(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % modulus


def held_out(doc_id: str, modulus: int, remains: int) -> Column:
    """A null id is never held out and never trained on."""
    return F.coalesce(remainder(doc_id, modulus) == remains, F.lit(False))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: str) -> list[bytes]:
    """Maximal runs without ASCII white space, A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split()


class WordHashes(dict):
    """64-bit hash of a word, remembered; emptied when it holds too many, so memory stays bounded."""

    def __init__(self, most: int = MEMO_ENTRIES):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, text: str) -> np.ndarray:
        found = words(text)
        return np.fromiter(map(self.__getitem__, found), dtype=np.uint64, count=len(found))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: a bijection of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; a shorter text is one run; no words, none."""
    n = len(hashes)
    if n == 0:
        return np.empty(0, dtype=np.uint64)
    width = min(size, n)
    out = np.full(n - width + 1, width, dtype=np.uint64)
    for k in range(width):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : n - width + 1 + k])
    return np.unique(out)


def map_batches(df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str | StructType) -> DataFrame:
    """``mapInPandas`` of a function of one batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield function(batch)

    return df.mapInPandas(run, schema)


def pack(vectors: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in np.ascontiguousarray(vectors)]


def unpack(blobs: pd.Series, dtype=np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), dtype=dtype).reshape(len(blobs), -1)


def usable_vectors(df: DataFrame, id_col: str, vec_col: str, zero_too: bool) -> DataFrame:
    """``vec_id``, ``vec`` as doubles: neither null nor empty, every component finite; rows without an id are left out."""
    vec = F.col(vec_col).cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    keep = F.col(id_col).isNotNull() & (F.size(vec) > 0) & finite
    if not zero_too:
        keep = keep & F.exists(vec, lambda x: x != 0)
    return df.filter(keep).select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec"))


#: Bytes of letters, digits and everything beyond ASCII; A-Z become lower case, all else a space.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    """Maximal runs of ASCII letters, ASCII digits and characters from U+0080 on, A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(TERM_BYTES).split()


def text_ranges(texts: list[str], characters: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts with a bounded number of characters; a longer text is alone."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > characters:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)
