"""Exact ranked lexical search over inverted lists cut into blocks of similar documents with maximum summaries."""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import terms, text_ranges
from tidemark.session import Workspace

#: Words of the items that are searched for together: bounds the broadcast vocabulary.
ITEM_WORDS = 1_000_000
#: Documents of a part of the index, rows of a block, and item terms from which a document is scored without blocks.
PART, BLOCK, MANY_TERMS = 4_096, 256, 300
#: A list of so few documents has no summary: scoring them costs no more than bounding them.
FEW = 24
#: Impacts stay under a million; summaries keep them in 255 steps, rounded up.
STEP, AXES = 3_922, 16
#: About one document in so many, but at most so many parts of them, is searched first to learn a floor of every item's scores.
SEED_ONE_IN, SEED_PARTS = 16, 64
NO_ID = np.iinfo(np.int64).max


@dataclass
class Query:
    """An item: its terms by number and their weights times their repeats."""

    number: int
    terms: np.ndarray
    weights: np.ndarray


def counted_terms(docs: DataFrame, sent) -> DataFrame:
    """Rows with at least one term: doc_id, n (all terms), terms (numbers of the item terms), tfs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = sent.value
        size = max(1, len(vocabulary))
        for batch in batches:
            texts, doc_ids = list(batch["text"]), batch["doc_id"].tolist()
            for a, b in text_ranges(texts, 2_000_000):
                found = [terms(t) for t in texts[a:b]]
                n = np.array([len(w) for w in found], dtype=np.int64)
                known = map(vocabulary.get, itertools.chain.from_iterable(found), itertools.repeat(-1))
                ids = np.fromiter(known, dtype=np.int64, count=int(n.sum()))
                keys = (np.repeat(np.arange(len(n)), n) * size + ids)[ids >= 0]
                keys, tfs = np.unique(keys, return_counts=True)
                cut = np.searchsorted(keys, np.arange(1, len(n)) * size)
                rows = np.flatnonzero(n > 0)
                if not len(rows):
                    continue
                by_doc, times = np.split((keys % size).astype(np.int32), cut), np.split(tfs.astype(np.int64), cut)
                yield pd.DataFrame({
                    "doc_id": pd.Series([doc_ids[a + i] for i in rows], dtype="Int64"), "n": n[rows],
                    "terms": [by_doc[i] for i in rows], "tfs": [times[i] for i in rows],
                })

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(run, "doc_id long, n long, terms array<int>, tfs array<long>")


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def lengths(n: np.ndarray, documents: int, words: int) -> np.ndarray:
    """Document length against the mean, a quarter of it counted, in hundredths."""
    return 75 + (25 * n * documents) // words


@dataclass
class Part:
    """A part of the index. Documents hold terms and impacts; each term's list is blocks of similar documents with a summary."""

    ids: np.ndarray  # doc ids, NO_ID for null
    at: np.ndarray  # where a document's terms start
    terms: np.ndarray
    impacts: np.ndarray
    many: np.ndarray  # documents in no list, because they hold very many terms
    list_terms: np.ndarray  # terms that have a list, ascending
    list_most: np.ndarray  # highest impact in the list
    list_at: np.ndarray  # first block of each list
    summed: np.ndarray  # whether a list has summaries
    block_at: np.ndarray  # where a block's documents start
    block_docs: np.ndarray
    sum_at: np.ndarray  # where a block's summary starts
    sum_terms: np.ndarray
    sum_levels: np.ndarray

    def pack(self) -> list[bytes]:
        press = zstandard.ZstdCompressor(level=1)
        return [press.compress(x.dtype.str.encode().ljust(8) + x.tobytes()) for x in vars(self).values()]

    @staticmethod
    def unpack(packed: list[bytes]) -> Part:
        press = zstandard.ZstdDecompressor()
        raw = [press.decompress(x) for x in packed]
        return Part(*[np.frombuffer(x[8:], dtype=x[:8].decode().strip()) for x in raw])

    def entries(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the terms of some documents, and how many each has."""
        size = self.at[docs + 1] - self.at[docs]
        before = np.cumsum(size) - size
        return np.repeat(self.at[docs] - before, size) + np.arange(int(size.sum())), size

    def scores(self, docs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        places, size = self.entries(docs)
        upto = np.r_[0, np.cumsum(weight[self.terms[places]] * self.impacts[places])]
        ends = np.cumsum(size)
        return upto[ends] - upto[ends - size]


def clusters(sketch: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows and starts of blocks: rows go to the nearest of evenly drawn pivots, large clusters are cut."""
    count = -(-len(sketch) // block)
    if count == 1:
        return np.arange(len(sketch)), np.zeros(1, dtype=np.int64)
    pivots = sketch[np.linspace(0, len(sketch) - 1, count).astype(np.int64)]
    label = np.argmax(sketch @ pivots.T, axis=1)
    order = np.argsort(label, kind="stable")
    label = label[order]
    first = np.flatnonzero(np.r_[True, label[1:] != label[:-1]])
    place = np.arange(len(label)) - np.repeat(first, np.diff(np.r_[first, len(label)]))
    return order, np.flatnonzero(place % block == 0)


def build_part(ids: np.ndarray, sizes: np.ndarray, term: np.ndarray, impact: np.ndarray, weight: np.ndarray, block: int, many_terms: int) -> Part:
    """Index documents given end to end: the number of terms of each, their terms and impacts."""
    vocabulary = len(weight)
    at = np.r_[0, np.cumsum(sizes)]
    many = np.flatnonzero(sizes > many_terms)
    axes = np.random.default_rng(17).standard_normal((vocabulary, AXES)).astype(np.float32)
    sketch = np.zeros((len(ids), AXES), dtype=np.float32)
    filled = np.flatnonzero(sizes > 0)
    if len(filled):
        for column in range(AXES):
            values = axes[term, column] * (impact * weight[term]).astype(np.float32)
            sketch[filled, column] = np.add.reduceat(values, at[filled])
    sketch /= np.maximum(np.sqrt((sketch * sketch).sum(1, keepdims=True)), 1e-9)
    owner = np.repeat(np.arange(len(ids)), sizes)
    listed = np.flatnonzero(np.repeat(sizes <= many_terms, sizes))
    listed = listed[np.argsort(term[listed], kind="stable")]
    in_term = term[listed]
    first = np.flatnonzero(np.r_[True, in_term[1:] != in_term[:-1]]) if len(in_term) else np.zeros(0, dtype=np.int64)
    part = Part(ids, at, term, impact, many, in_term[first], np.maximum.reduceat(impact[listed], first) if len(first) else impact[:0], *[at[:0]] * 7)
    level = (-(-impact // STEP)).astype(np.uint8)
    list_at, block_at, block_docs, sum_at, sum_terms, sum_levels = [0], [np.zeros(1, dtype=np.int64)], [], [np.zeros(1, dtype=np.int64)], [], []
    together = min(max(1, 4_000_000 // vocabulary), -(-len(ids) // block) * 2 + 1)  # blocks that share one table of maxima
    table = np.zeros(together * vocabulary, dtype=np.uint8)
    part.summed = np.diff(np.r_[first, len(listed)]) > FEW
    for a, b in zip(first, np.r_[first[1:], len(listed)], strict=True):
        docs = owner[listed[a:b]]
        order, starts = clusters(sketch[docs], block)
        docs = docs[order]
        block_docs.append(docs)
        ends = np.r_[starts[1:], len(docs)]
        block_at.append(block_at[-1][-1] + ends)
        list_at.append(list_at[-1] + len(starts))
        if len(docs) <= FEW:
            sum_at.append(np.full(len(starts), sum_at[-1][-1]))
            continue
        for k in range(0, len(starts), together):
            chosen = docs[starts[k] : ends[min(len(starts), k + together) - 1]]
            places, size = part.entries(chosen)
            number = np.repeat(np.arange(len(starts[k : k + together])) * vocabulary, (ends - starts)[k : k + together])
            np.maximum.at(table, np.repeat(number, size) + term[places], level[places])
            filled = np.flatnonzero(table != 0)
            sum_terms.append((filled % vocabulary).astype(np.int32))
            sum_levels.append(table[filled])
            sum_at.append(sum_at[-1][-1] + np.searchsorted(filled, np.arange(1, len(starts[k : k + together]) + 1) * vocabulary))
            table[filled] = 0
    part.list_at, part.block_at, part.sum_at = np.array(list_at), np.concatenate(block_at), np.concatenate(sum_at)
    part.block_docs = np.concatenate(block_docs).astype(np.int32) if block_docs else np.zeros(0, dtype=np.int32)
    part.sum_terms = np.concatenate(sum_terms) if sum_terms else np.zeros(0, dtype=np.int32)
    part.sum_levels = np.concatenate(sum_levels) if sum_levels else np.zeros(0, dtype=np.uint8)
    return part


class Best:
    """The k best of one item so far, and the least score that can still enter."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor = k, max(1, floor)
        self.ids, self.scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        fit = scores >= self.floor
        if not fit.any():
            return
        ids, scores = np.r_[self.ids, ids[fit]], np.r_[self.scores, scores[fit]]
        best = np.lexsort((ids, -scores))[: self.k]
        self.ids, self.scores = ids[best], scores[best]
        if len(best) == self.k:
            self.floor = int(self.scores[-1])  # equal scores may enter by a smaller id


def search_part(part: Part, query: Query, best: Best, weight: np.ndarray) -> tuple[int, int]:
    """Offer the part's documents that can be among the best; returns blocks looked at and blocks entered.

    ``weight`` is zero everywhere and is left so. A document of no list that is opened holds only terms whose highest contributions
    add up to less than the floor; a block is passed over when its summary's score is less.
    """
    weight[query.terms] = query.weights
    if len(part.many):
        best.add(part.ids[part.many], part.scores(part.many, weight))
    lists = np.searchsorted(part.list_terms, query.terms)
    lists = lists[np.r_[part.list_terms, -1][lists] == query.terms]
    most = part.list_most[lists] * weight[part.list_terms[lists]]
    order = np.argsort(-most, kind="stable")
    lists, rest = lists[order], np.cumsum(most[order][::-1])[::-1]  # what this list and all later ones can give
    seen = np.zeros(len(part.ids), dtype=bool)
    looked = entered = 0
    for i, left in zip(lists, rest, strict=True):
        if left < best.floor:
            break
        blocks = np.arange(part.list_at[i], part.list_at[i + 1])
        open_ = blocks
        if part.summed[i]:
            start, end = part.sum_at[blocks[0]], part.sum_at[blocks[-1] + 1]
            upto = np.r_[0, np.cumsum(weight[part.sum_terms[start:end]] * (part.sum_levels[start:end].astype(np.int64) * STEP))]
            open_ = blocks[upto[part.sum_at[blocks + 1] - start] - upto[part.sum_at[blocks] - start] >= best.floor]
        looked, entered = looked + len(blocks), entered + len(open_)
        if len(open_):
            size = part.block_at[open_ + 1] - part.block_at[open_]
            places = np.repeat(part.block_at[open_] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            docs = part.block_docs[places]
            docs = docs[~seen[docs]]
            seen[docs] = True
            if len(docs):
                best.add(part.ids[docs], part.scores(docs, weight))
    weight[query.terms] = 0
    return looked, entered


def parts(batches: Iterator[pd.DataFrame], documents: int, words: int, weight: np.ndarray, part_docs: int, block: int, many_terms: int) -> Iterator[Part]:
    """Indexes of ``part_docs`` documents each, one after the other: a task holds one of them, however many documents it reads."""
    held: list[pd.DataFrame] = []

    def close() -> Part:
        rows = pd.concat(held)
        held.clear()
        ids = rows["doc_id"].astype("Int64").fillna(NO_ID).to_numpy(dtype=np.int64)
        sizes = np.array([len(t) for t in rows["terms"]], dtype=np.int64)
        m = np.repeat(lengths(rows["n"].to_numpy(dtype=np.int64), documents, words), sizes)
        term = np.concatenate([*rows["terms"], np.zeros(0, dtype=np.int32)]).astype(np.int32)
        tf = np.concatenate([*rows["tfs"], np.zeros(0, dtype=np.int64)]).astype(np.int64)
        return build_part(ids, sizes, term, impacts(tf, m), weight, block, many_terms)

    for batch in batches:
        at = 0
        while at < len(batch):
            held.append(batch.iloc[at : at + part_docs - sum(map(len, held))])
            at += len(held[-1])
            if sum(map(len, held)) == part_docs:
                yield close()
    if held:
        yield close()


def _search(vectors: DataFrame, index, queries: list[Query], vocabulary: int, k: int, floors: dict[int, int]) -> DataFrame:
    """The k best of every item: each task indexes its documents part by part (``index``) and asks every item of a part before the next."""
    sent = vectors.sparkSession.sparkContext.broadcast((queries, floors))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queries, floors = sent.value
        weight = np.zeros(vocabulary, dtype=np.int64)
        found = [Best(k, floors.get(q.number, 1)) for q in queries]  # carried from part to part of a task
        for part in index(batches):
            for query, best in zip(queries, found, strict=True):
                search_part(part, query, best, weight)
        for query, best in zip(queries, found, strict=True):
            if len(best.ids):
                yield pd.DataFrame({
                    "item": query.number, "doc_id": pd.Series(best.ids, dtype="Int64").where(pd.Series(best.ids != NO_ID)), "score": best.scores,
                })

    rows = vectors.filter(F.size("terms") > 0)
    found = rows.mapInPandas(run, "item int, doc_id long, score long")
    place = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)


def rank(docs: DataFrame, items: DataFrame, ws: Workspace, k: int = 20, item_words: int = ITEM_WORDS,
         part_docs: int = PART, block: int = BLOCK, many_terms: int = MANY_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k documents of highest score above 0, equal scores by smaller doc_id.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased. Score and weights are whole numbers:
    floor(1000 ln((2N + 2) / (2df + 1))) times (1e9 tf) div (1000 tf + 12 m), m = 75 + (25 n N) div L, summed over the item's terms, repeats included.

    1. One pass counts the item terms of every document; N, L and df come from what it writes.
    2. Parts of ``part_docs`` documents are indexed: each term's list is cut into blocks of similar documents, with the coordinatewise
       maxima of their impacts, rounded up. Lists of up to 24 documents have no
       maxima. Documents with over ``many_terms`` item terms are in no list; every item scores them.
    3. Each part is searched for every item as soon as it stands, best lists first, with a floor learned from some documents. A block is passed over only
       when the exact bound of its summary is under the k-th score so far, so the result is that of scoring everything.

    Items are taken in groups of at most about ``item_words`` words. A null or empty text has no terms, in either table: such a document counts nowhere,
    such an item has no rows. Each row is a document, and each row an item, repeated ones too; documents without an id
    come last among equal scores. Extra columns are left behind; empty tables give no rows.
    """
    named = items.select(F.col("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = named.agg(F.sum(F.length("text"))).first()[0] or 0  # at least two characters a word and its space
    groups = max(1, -(-total // (2 * item_words)))
    out = None
    for group in range(groups):
        mine = named.filter(F.pmod(F.xxhash64("text"), F.lit(groups)) == group) if groups > 1 else named
        found = _rank_group(docs, mine, ws, k, part_docs, block, many_terms)
        out = found if out is None else out.unionByName(found)
    return out


def _rank_group(docs: DataFrame, items: DataFrame, ws: Workspace, k: int, part_docs: int, block: int, many_terms: int) -> DataFrame:
    spark = docs.sparkSession
    rows = items.collect()  # bounded by item_words
    counts = [dict(zip(*np.unique(np.array(terms(r.text), dtype=object), return_counts=True), strict=True)) if r.text else {} for r in rows]
    vocabulary = {term: i for i, term in enumerate(sorted(set().union(*counts)))}
    vectors = ws.write(counted_terms(docs, spark.sparkContext.broadcast(vocabulary)), "terms")
    totals = vectors.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("words")).first()
    df = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # at most one row an item term
    weight = np.zeros(max(1, len(vocabulary)), dtype=np.int64)
    for r in df:
        weight[r.term] = math.floor(1000 * math.log((2 * totals.documents + 2) / (2 * r["count"] + 1)))
    index = functools.partial(
        parts, documents=totals.documents, words=totals.words or 1, weight=weight, part_docs=part_docs, block=block, many_terms=many_terms)
    queries = []
    for i, count in enumerate(counts):
        number = np.array(sorted(vocabulary[t] for t in count), dtype=np.int64)
        repeats = np.array([count[t] for t in sorted(count)], dtype=np.int64)
        kept = weight[number] > 0 if len(number) else np.zeros(0, dtype=bool)
        if kept.any():
            queries.append(Query(i, number[kept], (weight[number] * repeats)[kept]))
    share = max(SEED_ONE_IN, -(-totals.documents // (SEED_PARTS * part_docs)))
    seeds = _search(vectors.filter(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0), index, queries, len(weight), k, {})
    # the k-th score among some documents: no document below it is among the k best of all
    floors = {r["item"]: r.score for r in seeds.filter(F.col("rank") == k).select("item", "score").collect()}
    found = ws.write(_search(vectors, index, queries, len(weight), k, floors), "found")
    names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
    return found.join(names, "item").select("item_id", "rank", "doc_id", "score")
