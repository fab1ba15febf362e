"""Quality by nearest-neighbour voting among labelled latent-semantic vectors."""

from __future__ import annotations

import functools
import pickle
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, map_batches
from tidemark.llm.langid import sample

SAMPLE_DOCS, TERMS, WORDS, LATENT, NEIGHBOURS, SHARPNESS, BLOCK = 3000, 2048, 4096, 64, 25, 8, 256
WORD = re.compile(r"\w+")

#: Classes of bytes: one per punctuation mark; lower case, upper case, digits and non-ASCII each share one.
_CLASS = np.arange(256, dtype=np.int64)
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = 1 if "a" <= _c <= "z" else 2 if "A" <= _c <= "Z" else 3 if "0" <= _c <= "9" else 4 if _b > 127 else _b


def shape_terms(text: str, said: list[str], size: int = TERMS) -> np.ndarray:
    """Hashed runs of three byte classes, word-length classes and repeated words of a whole text."""
    out = np.zeros(size, dtype=np.float32)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if len(raw) > 2:
        c = _CLASS[raw]
        out += np.bincount(((c[:-2] * 16411 + c[1:-1]) * 257 + c[2:]) % (size - 64), minlength=size)[:size]
    if said:
        again = sum(map(str.__eq__, said[1:], said)) / len(said)
        distinct = len(set(said)) / len(said) / min(1.0, 30 / len(said) ** 0.5)
        n = len(text)
        out[size - 64 + int(min(again, 0.999) * 16)] += n
        out[size - 48 + int(min(distinct / 4, 0.999) * 16)] += n
        out[size - 32 + min(15, int(np.log2(len(said) + 1)))] += n / 4
        out[size - 16 + min(15, int(np.mean([len(w) for w in said])))] += n / 4
    return out


def word_terms(text: str, size: int = WORDS) -> np.ndarray:
    """Counts of the lower-cased words of a whole text, hashed."""
    out = np.zeros(size, dtype=np.float32)
    for word, n in Counter(WORD.findall(text.lower())).items():
        out[zlib.crc32(word.encode("utf-8", "surrogatepass")) % size] += n
    return out


def terms(text: str) -> np.ndarray:
    """A document's row of the term matrix: its shape terms and its words, each as half of it."""
    shape, words = shape_terms(text, text.split()), word_terms(text)
    return np.concatenate([shape / max(shape.sum(), 1), words / max(words.sum(), 1)])


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of unit length: roots of shares, by rarity of the term; works in place and returns ``counts``."""
    counts /= np.maximum(counts.sum(1, keepdims=True), 1e-12)
    np.sqrt(counts, out=counts)
    counts *= idf.astype(counts.dtype)
    counts /= np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-12)
    return counts


def packed(text: str) -> bytes:
    """The terms that occur, as numbers and amounts: a few kB a document on the way to the driver."""
    row = terms(text)
    at = np.flatnonzero(row)
    return at.astype(np.uint16).tobytes() + row[at].tobytes()


def unpacked(rows: list[bytes]) -> np.ndarray:
    out = np.zeros((len(rows), TERMS + WORDS), dtype=np.float32)
    for i, raw in enumerate(rows):
        n = len(raw) // 6
        out[i, np.frombuffer(raw, dtype=np.uint16, count=n)] = np.frombuffer(raw, dtype=np.float32, offset=2 * n)
    return out


def labelled(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """doc_id, text, label of about ``bound`` labelled documents; several labels of a document are averaged.

    Only the bounded sample of labels is broadcast, and only its texts are shuffled.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    known = known.groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    found = documents(docs).join(F.broadcast(sample(known, bound, "label")), "doc_id")
    # of the texts of a repeated id one, so the bound holds for them too
    return found.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def axes(x: np.ndarray, latent: int) -> np.ndarray:
    """The leading right singular vectors of the term matrix, from the smaller of its two Gram matrices."""
    wide = x.shape[1] > x.shape[0]
    values, vectors = np.linalg.eigh(x @ x.T if wide else x.T @ x)
    kept = vectors[:, ::-1][:, : min(latent, len(x))]
    strength = np.sqrt(np.maximum(values[::-1][: kept.shape[1]], 0))
    if not wide:
        return kept
    sound = strength > 1e-6 * max(strength[0], 1e-12)
    return (x.T @ kept[:, sound]) / strength[sound] if sound.any() else np.zeros((x.shape[1], 1))


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, latent: int = LATENT) -> bytes:
    """Latent-semantic space and labelled vectors of about ``sample_docs`` documents (the bound of the model).

    Documents without a label, and labels without a document, teach nothing.
    """
    known = map_batches(
        labelled(docs, labels, "quality", sample_docs),
        lambda b: pd.DataFrame({"doc_id": b["doc_id"], "label": b["label"], "terms": [packed(t) for t in b["text"]]}),
        "doc_id long, label int, terms binary",
    ).collect()
    known.sort(key=lambda r: (r.doc_id, bytes(r.terms)))
    if not known:
        return pickle.dumps((np.ones(TERMS + WORDS), np.zeros((TERMS + WORDS, 1)), np.zeros((0, 1)), np.zeros(0)))
    x = unpacked([bytes(r.terms) for r in known])
    idf = np.log((1 + len(x)) / (1 + np.count_nonzero(x, axis=0))) + 1
    x = weigh(x, idf)  # one matrix of 4-byte numbers, 74 MB at the bound
    basis = axes(x, latent)
    z = (x @ basis).astype(float)
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
    return pickle.dumps((idf, basis, z, np.array([r.label for r in known], dtype=float)))


@functools.lru_cache(maxsize=1)
def _space(model: bytes):
    return pickle.loads(model)  # noqa: S301  our own bytes


def vote(texts: list[str], model: bytes, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Similarity-weighted share of label 1 among the nearest labelled vectors, by exact cosine in blocks."""
    idf, basis, z, y = _space(model)
    if not len(y):
        return np.full(len(texts), 0.5)
    out = []
    k = min(neighbours, len(y))
    for a in range(0, len(texts), BLOCK):
        x = weigh(np.stack([terms(t) for t in texts[a : a + BLOCK]]).astype(float), idf) @ basis
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        cosine = x @ z.T
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        w = np.maximum(np.take_along_axis(cosine, near, 1), 0) ** SHARPNESS
        total = w.sum(1)
        out.append(np.where(total > 0, (w * y[near]).sum(1) / np.maximum(total, 1e-300), y.mean()))
    return np.clip(np.concatenate(out), 0, 1)


def score(docs: DataFrame, model: bytes, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, score (0 to 1) of every whole text, plus the named columns.

    A null or empty text resembles nothing and gets the share of label 1 among the labelled; without labels every
    score is 0.5. Repeated rows give repeated rows; other columns are left behind; an empty table gives none.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([f"doc_id {fields['doc_id']}", *[f"`{c}` {fields[c]}" for c in extra], "score double"])
    return map_batches(
        documents(docs, *extra), lambda b: b.drop(columns="text").assign(score=vote(list(b["text"]), sent.value)), schema
    )
