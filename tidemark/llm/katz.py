"""Katz backoff language model: counting, discounting and scoring by chunks of documents."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WordHashes, map_batches, mix
from tidemark.session import Workspace

CHUNK_TOKENS, LARGEST_DISCOUNTED, HOT_SHARE = 2_000_000, 5, 1000
#: No word is empty or white space, so these never meet one.
END, START = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (b"", b"\n"))


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob; bytes of equal weight stand together."""
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes = a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes()
        packed = zstandard.ZstdCompressor(level=1).compress(planes)
        parts.append(struct.pack("<2sqq", a.dtype.str[1:].encode(), len(a), len(packed)) + packed)
    return b"".join(parts)


def unsqueeze(blob: bytes) -> list[np.ndarray]:
    out, at, head = [], 0, struct.calcsize("<2sqq")
    while at < len(blob):
        kind, n, size = struct.unpack_from("<2sqq", blob, at)
        planes = zstandard.ZstdDecompressor().decompress(blob[at + head : at + head + size])
        dtype = np.dtype("<" + kind.decode())
        out.append(np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(dtype.itemsize, n).T).view(dtype).reshape(n))
        at += head + size
    return out


def discounts(n: list[int], top: int = LARGEST_DISCOUNTED) -> np.ndarray:
    """Katz's Good-Turing factors d[0..top] from the numbers of n-grams that occur 1, 2, ... top + 1 times.

    Where the counts of counts give no factor between 0 and 1, half a count is taken off.
    """
    d = np.ones(top + 1)
    cut = (top + 1) * n[top] / n[0] if n[0] else 1.0
    for r in range(1, top + 1):
        value = -1.0
        if n[r - 1] and cut < 1:
            value = ((r + 1) * n[r] / n[r - 1] / r - cut) / (1 - cut)
        d[r] = value if 0 < value < 1 else (r - 0.5) / r
    return d


def backoff(total, kinds, low_sum, seen, d: np.ndarray, n_all: int, vocabulary: int):
    """(denominator, log10 backoff weight) of contexts: what the seen words leave, over what the lower order leaves.

    ``total`` occurrences, ``kinds[:, r-1]`` seen words with count r, ``low_sum`` their summed
    word counts, ``seen`` their number. A context all of whose counts are too large to be discounted has nothing
    to leave; one more count in the denominator leaves it.
    """
    r = np.arange(1, len(d))
    kept = total - kinds @ ((1 - d[1:]) * r)
    denominator = np.where(kept < total, total, total + 1.0)
    low = (low_sum + 0.5 * seen) / (n_all + 0.5 * (vocabulary + 1))
    with np.errstate(divide="ignore", invalid="ignore"):
        weight = np.log10((1 - kept / denominator) / (1 - low))
    return denominator, np.where(total > 0, weight, 0.0)


def _deal(buckets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, positions in order) of each bucket that has any."""
    order = np.argsort(buckets, kind="stable")
    dealt = buckets[order]
    starts = np.flatnonzero(np.r_[True, dealt[1:] != dealt[:-1]]) if len(dealt) else []
    ends = np.r_[starts[1:], len(dealt)] if len(dealt) else []
    for a, b in zip(starts, ends, strict=True):
        yield int(dealt[a]), order[a:b]


def _chunks(docs: DataFrame, chunk_tokens: int) -> DataFrame:
    """Documents as local word numbers, many in one row: ids, training flags, lengths, numbers, words, training counts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordHashes()
        task, made = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        size = 0

        def flush() -> pd.DataFrame:
            nonlocal held, size, made
            vocabulary, numbers = np.unique(np.concatenate([h for _, _, h in held]), return_inverse=True)
            lengths = np.array([len(h) for _, _, h in held], dtype=np.int64)
            train = np.array([t for _, t, _ in held], dtype=bool)
            counts = np.bincount(numbers[np.repeat(train, lengths)], minlength=len(vocabulary))
            row = ((task << 24) + made, [i for i, _, _ in held], squeeze(train.view(np.uint8), lengths, numbers.astype(np.uint32)), squeeze(vocabulary, counts.astype(np.uint32)))
            held, size, made = [], 0, made + 1
            return pd.DataFrame([row], columns=["chunk", "doc_ids", "text", "words"])

        for batch in batches:
            for doc_id, text, train in zip(batch["doc_id"], batch["text"], batch["train"], strict=True):
                found = np.append(words.of(text), END)
                held.append((None if pd.isna(doc_id) else int(doc_id), bool(train), found))
                size += len(found)
                if size >= chunk_tokens:
                    yield flush()
        if held:
            yield flush()

    return docs.mapInPandas(run, "chunk long, doc_ids array<long>, text binary, words binary")


def _word_requests(chunks: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk, blob in zip(batch["chunk"], batch["words"], strict=True):
                words, counts = unsqueeze(blob)
                rows = [(b, chunk, squeeze(words[at], counts[at])) for b, at in _deal((mix(words) % np.uint64(buckets)).astype(np.int64))]
                yield pd.DataFrame(rows, columns=["bucket", "chunk", "blob"])

    return chunks.select("chunk", "words").mapInPandas(run, "bucket int, chunk long, blob binary")


def _count_words(group: pd.DataFrame) -> pd.DataFrame:
    """Training counts of all words of a bucket, given back to each chunk in the order it asked."""
    group = group.sort_values("chunk")
    parts = [unsqueeze(b) for b in group["blob"]]
    words = np.concatenate([p[0] for p in parts])
    _, place = np.unique(words, return_inverse=True)
    total = np.bincount(place, weights=np.concatenate([p[1] for p in parts])).astype(np.uint32)
    ends = np.cumsum([len(p[0]) for p in parts])
    told = np.split(total[place], ends[:-1])
    types, tokens = np.zeros(len(group), dtype=np.int64), np.zeros(len(group), dtype=np.int64)
    types[0], tokens[0] = int((total > 0).sum()), int(total.sum(dtype=np.int64))
    return pd.DataFrame({"kind": 0, "chunk": group["chunk"].to_numpy(), "bucket": group["bucket"].to_numpy(), "blob": [squeeze(t) for t in told], "types": types, "tokens": tokens})


class Chunk:
    """One chunk with the word counts told to it: its pairs of neighbours, dealt to buckets in a fixed order."""

    def __init__(self, text: bytes, words: bytes, told: dict[int, bytes], buckets: int, n_all: int, n_docs: int):
        self.train, self.lengths, numbers = unsqueeze(text)
        self.numbers = numbers.astype(np.int64)
        self.words, _ = unsqueeze(words)
        size = len(self.words)
        self.counts = np.zeros(size + 1, dtype=np.int64)  # the last is the start of a text
        for bucket, at in _deal((mix(self.words) % np.uint64(buckets)).astype(np.int64)):
            self.counts[at] = unsqueeze(told[bucket])[0]
        self.counts[size] = n_docs
        self.hashes = np.append(self.words, START)
        before = np.roll(self.numbers, 1)
        first = np.r_[0, np.cumsum(self.lengths)[:-1]]
        before[first] = size
        self.keys, self.place = np.unique(before * (size + 1) + self.numbers, return_inverse=True)
        self.prev, self.word = self.keys // (size + 1), self.keys % (size + 1)
        self.before = before
        inside = np.repeat(self.train.astype(bool), self.lengths)
        self.trained = np.bincount(self.place[inside], minlength=len(self.keys))
        self.hot = self.counts * HOT_SHARE > n_all
        self.hot[size] = True
        by_context = mix(self.hashes)[self.prev]
        spread = mix(by_context + self.hashes[self.word] * np.uint64(0x9E3779B97F4A7C15))
        self.pair = spread
        self.bucket = (np.where(self.hot[self.prev], spread, by_context) % np.uint64(buckets)).astype(np.int64)

    def deal(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """bucket, positions of its pairs, their contexts, and how many pairs each context has."""
        for bucket, at in _deal(self.bucket):
            contexts, sizes = np.unique(self.prev[at], return_counts=True)  # pairs are in order of their contexts
            yield bucket, at, contexts, sizes


def _count_pairs(group: pd.DataFrame) -> pd.DataFrame:
    """Training counts of all pairs of a bucket, told to each chunk in its order, with what is seen after each context."""
    group = group.sort_values("chunk")
    parts = [unsqueeze(b) for b in group["blob"]]  # contexts, sizes, pair hashes, training counts, word counts, hot
    context = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
    pair = np.concatenate([p[2] for p in parts])
    _, first, place = np.unique(pair, return_index=True, return_inverse=True)
    total = np.bincount(place, weights=np.concatenate([p[3] for p in parts])).astype(np.int64)
    low = np.concatenate([p[4] for p in parts])[first].astype(np.int64)
    names, at = np.unique(context, return_inverse=True)
    owner, seen = at[first], total > 0
    stats = np.zeros((len(names), LARGEST_DISCOUNTED + 2), dtype=np.int64)
    for r in range(1, LARGEST_DISCOUNTED + 1):
        stats[:, r - 1] = np.bincount(owner[total == r], minlength=len(names))
    stats[:, -2] = np.bincount(owner[seen], weights=low[seen], minlength=len(names))
    stats[:, -1] = np.bincount(owner[seen], minlength=len(names))
    told, counts = [], total[place].astype(np.uint32)
    at_row = 0
    hot: dict[int, np.ndarray] = {}
    for p in parts:
        rows = np.searchsorted(names, p[0])
        told.append(squeeze(counts[at_row : at_row + len(p[2])], *[stats[rows, k] for k in range(stats.shape[1])]))
        at_row += len(p[2])
        hot.update({int(i): stats[i] for i in rows[p[5].astype(bool)]})
    numbers = [[0] * (LARGEST_DISCOUNTED + 1) for _ in told]
    numbers[0] = [int((total == r).sum()) for r in range(1, LARGEST_DISCOUNTED + 2)]
    shared: list[list] = [[] for _ in told]
    shared[0] = [[int(np.uint64(names[i]).view(np.int64)), *map(int, s)] for i, s in sorted(hot.items())]
    return pd.DataFrame({"kind": 1, "chunk": group["chunk"].to_numpy(), "bucket": group["bucket"].to_numpy(), "blob": told, "numbers": numbers, "hot": shared})


def score(docs: DataFrame, train: str, ws: Workspace, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every whole text; ``train`` is a boolean column.

    A bigram Katz model of words (runs without ASCII white space, A-Z lower-cased) and one end per text:
    p(w | h) = d(c) c(h, w) / c(h) where the pair was seen in training, else alpha(h) p(w), down to
    p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)), in which one unknown word has the place V + 1. d are Good-Turing
    discounts of counts up to 5; alpha makes each context sum to one exactly. A context never seen hands over to p(w).

    Documents are cut in chunks that hold word numbers, a table bucketed by chunk. Each chunk asks the tables of
    words and of pairs, dealt by hash over as many buckets as there are chunks, for its distinct entries once;
    the answers come back in the order of the questions, so neither carries keys. Pairs of contexts that hold over a
    thousandth of all tokens (under a thousand contexts) are dealt by pair. Words and pairs are told apart by 64-bit hashes.

    A null text is empty: only its end is scored. Rows whose flag is false or null are scored, not learned from; without any to
    learn from, N and V are 0 and every base score is 0. Repeated rows count and are scored each. Extra columns are left behind.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col(train), F.lit(False)).alias("train"))
    chunks = ws.write_keyed(_chunks(rows, chunk_tokens), "chunks", "chunk", "chunk")
    buckets = max(8, chunks.count())
    asked = _word_requests(chunks, buckets)
    told = ws.write(asked.groupBy("bucket").applyInPandas(_count_words, "kind int, chunk long, bucket int, blob binary, types long, tokens long"), "words")
    seen = told.agg(F.sum("types"), F.sum("tokens")).first()
    vocabulary, n_all = int(seen[0] or 0), int(seen[1] or 0)

    def trained(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"n": [int(unsqueeze(b)[0].sum()) for b in batch["text"]]})

    n_docs = int(map_batches(chunks.select("text"), trained, "n long").agg(F.sum("n")).first()[0] or 0)

    def load(one: pd.DataFrame, answers: pd.DataFrame) -> Chunk:
        words = answers[answers["kind"] == 0]
        return Chunk(one["text"].iloc[0], one["words"].iloc[0], dict(zip(words["bucket"], words["blob"], strict=True)), buckets, n_all, n_docs)

    def ask(one: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(one):
            return pd.DataFrame(columns=["bucket", "chunk", "blob"])
        c = load(one, answers)
        out = []
        for bucket, at, contexts, sizes in c.deal():
            blob = squeeze(
                c.hashes[contexts], sizes.astype(np.uint32), c.pair[at], c.trained[at].astype(np.uint32),
                c.counts[c.word[at]].astype(np.uint32), c.hot[contexts].view(np.uint8),
            )
            out.append((bucket, one["chunk"].iloc[0], blob))
        return pd.DataFrame(out, columns=["bucket", "chunk", "blob"])

    words_told = told.select("kind", "chunk", "bucket", "blob")
    pairs = chunks.groupBy("chunk").cogroup(words_told.groupBy("chunk")).applyInPandas(ask, "bucket int, chunk long, blob binary")
    counted = ws.write(
        pairs.groupBy("bucket").applyInPandas(_count_pairs, "kind int, chunk long, bucket int, blob binary, numbers array<long>, hot array<array<long>>"), "pairs"
    )
    of_counts = counted.agg(*[F.sum(F.col("numbers")[r]) for r in range(LARGEST_DISCOUNTED + 1)]).first()
    d = discounts([int(x or 0) for x in of_counts])
    parts = counted.select(F.explode("hot").alias("h"))
    shared = {  # under HOT_SHARE contexts
        np.int64(r[0]).view(np.uint64): np.array(r[1:], dtype=np.int64)
        for r in parts.groupBy(F.col("h")[0]).agg(*[F.sum(F.col("h")[k]) for k in range(1, LARGEST_DISCOUNTED + 3)]).collect()
    }

    def finish(one: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        columns = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        if not len(one):
            return pd.DataFrame(columns=columns)
        c = load(one, answers)
        replies = answers[answers["kind"] == 1]
        blobs = dict(zip(replies["bucket"], replies["blob"], strict=True))
        total = np.zeros(len(c.keys), dtype=np.int64)
        stats = np.zeros((len(c.hashes), LARGEST_DISCOUNTED + 2), dtype=np.int64)
        for bucket, at, contexts, _ in c.deal():
            got = unsqueeze(blobs[bucket])
            total[at] = got[0]
            stats[contexts] = np.stack(got[1:], 1)
        for i in np.flatnonzero(c.hot):
            if c.hashes[i] in shared:
                stats[i] = shared[c.hashes[i]]
        denominator, alpha = backoff(c.counts.astype(float), stats[:, :-2].astype(float), stats[:, -2], stats[:, -1], d, n_all, vocabulary)
        base = np.log10((c.counts[:-1] + 0.5) / (n_all + 0.5 * (vocabulary + 1)))
        factor = d[np.minimum(total, LARGEST_DISCOUNTED)] if LARGEST_DISCOUNTED else np.ones(len(total))
        factor = np.where(total > LARGEST_DISCOUNTED, 1.0, factor)
        with np.errstate(divide="ignore"):
            direct = np.log10(factor * total / np.maximum(denominator[c.prev], 1))
        log_p = np.where(total > 0, direct, alpha[c.prev] + base[c.word])[c.place]
        first = np.r_[0, np.cumsum(c.lengths)[:-1]]
        return pd.DataFrame({
            "doc_id": pd.array(list(one["doc_ids"].iloc[0]), dtype="Int64"), "n_tokens": c.lengths,
            "n_known": np.add.reduceat((c.counts[c.numbers] > 0).astype(np.int64), first), "train_tokens": n_all,
            "base_score": np.add.reduceat(base[c.numbers], first), "score": np.add.reduceat(log_p, first),
        })[columns]

    answers = words_told.unionByName(counted.select("kind", "chunk", "bucket", "blob"))
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        finish, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
