"""Alignment of two tokenizations of the same bytes: merge-path pieces, groups, and corpus counts of linked ids."""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.bpe import byte_characters
from tidemark.llm.common import text_ranges
from tidemark.session import Workspace

#: Equal work of a piece of the merge, in token ends of both sides.
PIECE = 1 << 16
#: Remembered units of a worker, and their characters.
UNITS, UNIT_CHARACTERS = 400_000, 16_000_000
#: Characters of texts merged at once; distinct links of documents, and documents, that share one chunk of answers.
CHARACTERS, CHUNK_LINKS, CHUNK_DOCS = 600_000, 2_000_000, 50_000
#: A group with more links than this is counted by distinct ids.
WIDE = 4_096
SPACED = ("  ", " \n", "\n ", " \t", "\t ", " \r", "\r ")
RARE = re.compile(r"[^\S \n\t\r]")
ALONE = re.compile(r"(?<=\S) (?=\S)")


def units(text: str) -> list[str]:
    """The text cut at each single space between two characters that are no white space; the space goes.

    Neither tokenizer has a token across such a place: the byte-level pattern starts a match at the space, and
    no piece of the other holds a space after another character. So units are encoded one by one.
    """
    if text[:1] == " " or text[-1:] == " " or any(pair in text for pair in SPACED) or RARE.search(text):
        parts = ALONE.split(" " + text)
        parts[0] = parts[0][1:]
        return parts
    return text.split(" ")


class Sides:
    """Both tokenizers, the bytes of their ids, and the tokens of a bounded number of units."""

    def __init__(self, model_a: str, model_b: bytes):
        self.a = Tokenizer.from_str(model_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        back = {c: i for i, c in enumerate(byte_characters())}
        size = self.a.get_vocab_size(with_added_tokens=True)
        self.bytes_a = [bytes(back[c] for c in shown) if all(c in back for c in shown) else shown.encode() for shown in map(self.a.id_to_token, range(size))]
        pieces = [(i, self.b.id_to_piece(i)) for i in range(self.b.vocab_size())]
        if any("\u2581" in piece.lstrip("\u2581") for _, piece in pieces):
            raise ValueError("the piece model has pieces that hold a space after another character")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("\u2581", " ").encode() for i, p in pieces]
        self.space = [self.b.piece_to_id("\u2581")]
        self.len_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        self.digits = Digits(len(self.bytes_a), len(self.bytes_b))
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.held = 0
        self.fits = np.zeros(0, dtype=bool)
        self.at = [np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)]
        self.ids = [np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32)]

    def learn(self, new: list[str]) -> None:
        shown = [" " + unit for unit in new]
        ids_a = [e.ids for e in self.a.encode_batch_fast(shown, add_special_tokens=False)]
        ids_b = [ids if unit else self.space for unit, ids in zip(new, self.b.encode(new, num_threads=1), strict=True)]
        fits = []
        for unit, a, b in zip(shown, ids_a, ids_b, strict=True):
            raw = unit.encode("utf-8", "surrogatepass")
            fits.append(b"".join([self.bytes_a[i] for i in a]) == raw == b"".join([self.bytes_b[i] for i in b]))
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
        self.held += sum(map(len, new))
        self.fits = np.r_[self.fits, np.array(fits, dtype=bool)]
        for side, ids in enumerate((ids_a, ids_b)):
            sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
            self.at[side] = np.r_[self.at[side], self.at[side][-1] + np.cumsum(sizes)]
            flat = np.fromiter(itertools.chain.from_iterable(ids), dtype=np.int32, count=int(sizes.sum()))
            self.ids[side] = np.r_[self.ids[side], flat]

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Whether each text has tokens, and for both sides the ids of those that have, end to end, and the tokens of each text."""
        cuts = [units(t) if t else [] for t in texts]
        flat = list(itertools.chain.from_iterable(cuts))
        if len(self.number) > UNITS or self.held > UNIT_CHARACTERS:
            self.forget()
        new = set(flat).difference(self.number)
        if new:
            self.learn(sorted(new))
        unit = np.fromiter(map(self.number.__getitem__, flat), dtype=np.int64, count=len(flat))
        text = np.repeat(np.arange(len(texts)), [len(c) for c in cuts])
        usable = np.array([len(c) > 0 for c in cuts], dtype=bool)
        usable[text[~self.fits[unit]]] = False
        unit, text = unit[usable[text]], text[usable[text]]
        ids, counts = [], []
        for side in (0, 1):
            start, size = self.at[side][unit], self.at[side][unit + 1] - self.at[side][unit]
            before = np.cumsum(size) - size
            ids.append(self.ids[side][np.repeat(start - before, size) + np.arange(int(size.sum()))])
            counts.append(np.bincount(text, weights=size, minlength=len(texts)).astype(np.int64))
        return usable, ids, counts


class Digits:
    """Decimal ids with the sign that follows them, as rows of bytes padded by zeros."""

    def __init__(self, size_a: int, size_b: int):
        shown = [f"{i}{sign}" for i in range(size_a) for sign in ",|"] + [f"{i}{sign}" for i in range(size_b) for sign in (",", ";", "")]
        self.first_b = 2 * size_a
        self.rows = np.array(shown, dtype="S").view(np.uint8).reshape(len(shown), -1)
        self.sizes = np.array([len(s) for s in shown], dtype=np.int64)


def diagonals(a: np.ndarray, b: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of each side are among the first 0, piece, 2 * piece, ... ends of the merge, equal ends of ``a`` first.

    Binary search along all diagonals of the merge grid at once.
    """
    d = np.r_[np.arange(0, len(a) + len(b), piece), len(a) + len(b)]
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (low < high).any():
        mid = (low + high) // 2
        more = (low < high) & (a[np.minimum(mid, max(len(a) - 1, 0))] <= b[np.clip(d - 1 - mid, 0, max(len(b) - 1, 0))])
        low, high = np.where(more, mid + 1, low), np.where(more | (low >= high), high, mid)
    return low, d - low


@dataclass
class Overlaps:
    """Of one piece: pairs of tokens that share bytes, which of them end a group, and whether the first end closes the piece before."""

    a: np.ndarray
    b: np.ndarray
    closes: np.ndarray
    closes_before: bool


def merge_piece(a: np.ndarray, b: np.ndarray, before: int) -> Overlaps:
    """Merge the ends of one piece; ``before`` is the last end in front of it. Token numbers count from the piece's start."""
    at = np.empty(len(a) + len(b), dtype=np.int64)
    from_a = np.zeros(len(at), dtype=bool)
    from_a[np.arange(len(a)) + np.searchsorted(b, a, side="left")] = True
    at[from_a], at[~from_a] = a, b
    shares = np.diff(at, prepend=before) > 0  # else the same end of the other side came just before
    i = np.cumsum(from_a) - from_a
    j = np.arange(len(at)) - i
    closes = np.r_[~shares[1:], False]
    return Overlaps(i[shares], j[shares], closes[shares], bool(len(at)) and not shares[0])


def groups_of(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, int]:
    """For ends of tokens over the same bytes: the group of each token of both sides, and the number of overlaps.

    The merge is cut into independent pieces of equal work. Their overlaps are chained: where a group goes on over the
    border of two pieces its parts become one.
    """
    at_a, at_b = diagonals(a, b, piece)
    parts = []
    for i, j, k, m in zip(at_a[:-1], at_b[:-1], at_a[1:], at_b[1:], strict=True):
        before = max(int(a[i - 1]) if i else 0, int(b[j - 1]) if j else 0)
        parts.append(merge_piece(a[i:k], b[j:m], before))
    group_a, group_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
    closed, overlaps, open_before = 0, 0, False
    for part, i, j in zip(parts, at_a, at_b, strict=False):
        if part.closes_before:  # the border ran between two equal ends
            closed += 1
        number = closed + np.cumsum(part.closes) - part.closes
        group_a[part.a + i] = number
        group_b[part.b + j] = number
        closed += int(part.closes.sum())
        overlaps += len(part.a)
    return group_a, group_b, overlaps


def links_of(ids_a: np.ndarray, ids_b: np.ndarray, p: np.ndarray, q: np.ndarray, text: np.ndarray, size_b: int, most: int = WIDE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct (text << 32 | id pair) and how often each is linked, of groups of p and q tokens that lie one after another.

    All pairs of a group are linked. A wide group's pairs are those of its distinct ids, counted by products, so repeated tokens cost nothing.
    """
    start_a, start_b = np.cumsum(p) - p, np.cumsum(q) - q
    wide = p * q > most
    keys, counts = [], []
    if not len(wide) or not wide.all():
        pn, qn = np.where(wide, 0, p), np.where(wide, 0, q)
        repeats = np.repeat(qn, pn)  # of each token of a narrow group
        first = np.repeat(start_a - (np.cumsum(pn) - pn), pn) + np.arange(len(repeats))
        of = np.repeat(np.arange(len(p)), pn)
        left = np.repeat(ids_a[first].astype(np.int64) * size_b + (text[of] << 32), repeats)
        right = np.repeat(start_b[of] - (np.cumsum(repeats) - repeats), repeats) + np.arange(len(left))
        found = np.sort(left + ids_b[right])
        starts = np.flatnonzero(np.r_[True, found[1:] != found[:-1]]) if len(found) else np.zeros(0, dtype=np.int64)
        keys.append(found[starts])
        counts.append(np.diff(np.r_[starts, len(found)]))
    for g in np.flatnonzero(wide):
        a, times_a = np.unique(ids_a[start_a[g] : start_a[g] + p[g]], return_counts=True)
        b, times_b = np.unique(ids_b[start_b[g] : start_b[g] + q[g]], return_counts=True)
        keys.append(((a.astype(np.int64) * size_b)[:, None] + b[None]).ravel() + (text[g] << 32))
        counts.append(np.multiply.outer(times_a, times_b).ravel())
    if len(keys) == 1:
        return keys[0], counts[0]
    merged, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return merged, np.bincount(inverse, weights=np.concatenate(counts), minlength=len(merged)).astype(np.int64)


@functools.lru_cache(maxsize=1)
def _sides(model_a: str, model_b: bytes) -> Sides:
    return Sides(model_a, model_b)


def _sent(docs: DataFrame, path_a: str, path_b: str):
    """The two models travel by a broadcast whose size is that of the vocabulary files, whatever the data."""
    with open(path_a, encoding="utf-8") as a, open(path_b, "rb") as b:
        return docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))


@dataclass
class Merged:
    """Of a run of texts: tokens, their groups, and per text the counts."""

    usable: np.ndarray
    ids: list[np.ndarray]
    counts: list[np.ndarray]
    ends: list[np.ndarray]
    group: list[np.ndarray]
    sizes: list[np.ndarray]
    text: np.ndarray
    overlaps: int


def merge(sides: Sides, texts: list[str]) -> Merged:
    """Tokens of texts laid end to end on one axis of bytes, and their groups; a text's end always ends a group."""
    usable, ids, counts = sides.tokens(texts)
    ends = [np.cumsum(length[i]) for length, i in zip((sides.len_a, sides.len_b), ids, strict=True)]
    group_a, group_b, overlaps = groups_of(*ends)
    n = int(group_a[-1]) + 1 if len(group_a) else 0
    sizes = [np.bincount(g, minlength=n) for g in (group_a, group_b)]
    of_token = np.repeat(np.arange(len(texts)), counts[0])
    text = of_token[np.cumsum(sizes[0]) - 1] if n else np.zeros(0, dtype=np.int64)
    return Merged(usable, ids, counts, ends, [group_a, group_b], sizes, text, overlaps)


def digests(sides: Sides, m: Merged) -> list[str]:
    """SHA-256 of each text's groups, `a1,a2|b1;a3|b2,b3`; empty without tokens."""
    (ids_a, ids_b), (group_a, group_b), (p, q) = m.ids, m.group, m.sizes
    codes = np.zeros(len(ids_a) + len(ids_b), dtype=np.int64)
    ends_a, ends_b = np.cumsum(p), np.cumsum(q)
    last_a, last_b = np.zeros(len(ids_a), dtype=np.int64), np.zeros(len(ids_b), dtype=np.int64)
    last_a[ends_a - 1] = 1
    last_b[ends_b - 1] = 1
    if len(m.text):
        last_b[ends_b[np.r_[m.text[1:] != m.text[:-1], True]] - 1] = 2
    codes[np.arange(len(ids_a)) + (ends_b - q)[group_a]] = ids_a.astype(np.int64) * 2 + last_a
    codes[np.arange(len(ids_b)) + ends_a[group_b]] = sides.digits.first_b + ids_b.astype(np.int64) * 3 + last_b
    shown = sides.digits.rows[codes].ravel()
    shown = shown[shown != 0].tobytes()
    upto = np.r_[0, np.cumsum(sides.digits.sizes[codes])][np.r_[0, np.cumsum(m.counts[0] + m.counts[1])]]
    return [hashlib.sha256(shown[a:b]).hexdigest() if b > a else "" for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]


DOC_COLUMNS = ["n_a", "n_b", "n_groups", "n_links"]


class Chunk:
    """Documents that ask together for the counts of their links, each distinct pair once."""

    def __init__(self):
        self.doc_ids: list[int | None] = []
        self.shas: list[str] = []
        self.columns: list[np.ndarray] = []
        self.doc, self.pair, self.times, self.links = [], [], [], 0

    def add(self, doc_ids: list, m: Merged, shas: list[str], sides: Sides) -> None:
        n = len(doc_ids)
        p, q = m.sizes
        keys, times = links_of(m.ids[0], m.ids[1], p, q, m.text, len(sides.bytes_b))
        linked = np.bincount(keys >> 32, weights=times, minlength=n).astype(np.int64)
        self.doc.append((keys >> 32) + len(self.doc_ids))
        self.pair.append(keys & 0xFFFFFFFF)
        self.times.append(times)
        self.links += len(keys)
        self.columns.append(np.stack([*m.counts, np.bincount(m.text, minlength=n), linked], 1))
        self.doc_ids += doc_ids
        self.shas += shas

    def rows(self, number: int, size_b: int) -> Iterator[pd.DataFrame]:
        """Rows of distinct pairs with the documents that hold them, then one row with all else, compressed."""
        doc, pair, times = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (self.doc, self.pair, self.times))
        distinct, inverse, held = np.unique(pair, return_inverse=True, return_counts=True)
        order = np.argsort(-held, kind="stable")  # frequent pairs get small numbers, which compress well
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        for at in range(0, len(order), 200_000):
            part = order[at : at + 200_000]
            yield pd.DataFrame({
                "chunk": number, "a": (distinct[part] // size_b).astype(np.int32), "b": (distinct[part] % size_b).astype(np.int32),
                "pos": np.arange(at, at + len(part), dtype=np.int32), "docs": held[part], "packed": None,
            })
        places = place[inverse].astype("<u4")
        planes = [places.view("<u2")[0::2].tobytes(), places.view("<u2")[1::2].tobytes(), np.minimum(times, 255).astype(np.uint8).tobytes()]
        often = np.flatnonzero(times >= 255)
        known = [i is not None and i is not pd.NA and i == i for i in self.doc_ids]
        sizes = np.bincount(doc, minlength=len(self.doc_ids)).astype("<u4")
        packed = [
            np.array([i if k else 0 for i, k in zip(self.doc_ids, known, strict=True)], dtype="<i8").tobytes(), np.array(known, dtype=np.uint8).tobytes(),
            np.concatenate(self.columns).astype("<i8").tobytes(), "\n".join(self.shas).encode(), sizes.tobytes(), *planes,
            often.astype("<i8").tobytes(), times[often].astype("<i8").tobytes(),
        ]
        press = zstandard.ZstdCompressor(level=1)
        yield pd.DataFrame({"chunk": [number], "a": None, "b": None, "pos": None, "docs": None, "packed": [[press.compress(x) for x in packed]]})


def answered(packed: list[bytes], counts: np.ndarray, best: np.ndarray) -> pd.DataFrame:
    """A chunk's documents with the sums over their links; ``counts`` and ``best`` are by the number of the pair in the chunk."""
    press = zstandard.ZstdDecompressor()
    ids, known, columns, shas, sizes, low, high, times, often, many = [press.decompress(x) for x in packed]
    sizes = np.frombuffer(sizes, dtype="<u4")
    place = np.frombuffer(low, dtype="<u2").astype(np.int64) | (np.frombuffer(high, dtype="<u2").astype(np.int64) << 16)
    times = np.frombuffer(times, dtype=np.uint8).astype(np.int64)
    times[np.frombuffer(often, dtype="<i8")] = np.frombuffer(many, dtype="<i8")
    out = pd.DataFrame(np.frombuffer(columns, dtype="<i8").reshape(-1, len(DOC_COLUMNS)), columns=DOC_COLUMNS)
    out.insert(0, "doc_id", pd.Series(np.frombuffer(ids, dtype="<i8")).astype("Int64").where(pd.Series(np.frombuffer(known, dtype=np.uint8) > 0)))
    ends = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
    for name, values in (("n_best", times * best[place]), ("count_sum", times * counts[place])):
        upto = np.r_[0, np.cumsum(values)]
        out[name] = upto[ends[1:]] - upto[ends[:-1]]
    out["groups_sha256"] = shas.decode().split("\n")
    return out


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def align(docs: DataFrame, path_a: str, path_b: str, ws: Workspace, chunk_docs: int = CHUNK_DOCS, characters: int = CHARACTERS) -> DataFrame:
    """Per document the alignment of " " + text in two tokenizations: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A is a byte-level BPE file, B a piece model that puts the space in front itself. Where tokens of both end at
    the same byte, a group ends; all pairs of an A and a B token of a group are linked. The count of a pair of ids is the
    number of documents of the table that hold it linked; ``n_best`` counts the links whose count is the highest of
    their A id, ``count_sum`` adds up the counts of all links.

    1. One pass tokenizes, merges and writes per chunk of documents its distinct pairs, and the links as numbers of those.
    2. Pairs are counted over all chunks; each chunk gets one answer a pair, whatever number of its documents asked.

    A null or empty text, and one whose tokens of a side do not spell it, has no tokens: zeros and ''. Special
    tokens in a text are plain text. Each row counts as a document, repeated ones too; null ids stay null; extra columns are left
    behind; an empty table gives no rows. The length of a text is not bounded, its work is cut into equal pieces.
    """
    sent = _sent(docs, path_a, path_b)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sides = _sides(*sent.value)
        size_b = len(sides.bytes_b)
        number, chunk = TaskContext.get().partitionId() << 32, Chunk()
        for batch in batches:
            texts, doc_ids = list(batch["text"]), batch["doc_id"].tolist()
            for a, b in text_ranges(texts, characters):
                m = merge(sides, texts[a:b])
                chunk.add(doc_ids[a:b], m, digests(sides, m), sides)
                if chunk.links >= CHUNK_LINKS or len(chunk.doc_ids) >= chunk_docs:
                    yield from chunk.rows(number, size_b)
                    number, chunk = number + 1, Chunk()
        if chunk.doc_ids:
            yield from chunk.rows(number, size_b)

    schema = "chunk long, a int, b int, pos int, docs long, packed array<binary>"
    asked = ws.write(_texts(docs).mapInPandas(run, schema), "asked")
    pairs = asked.filter("packed is null").select(F.col("chunk").alias("asker"), "a", "b", "pos", "docs")
    counts = ws.write(pair_counts(pairs), "counts")
    best = counts.groupBy("a").agg(F.max("count").alias("most"))
    rated = counts.join(best, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))
    answers = pairs.join(rated, ["a", "b"]).select("asker", "pos", "count", "best")
    chunks = asked.filter("packed is not null").select("chunk", "packed")

    def answer(mine: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        counts, best = np.zeros(len(found), dtype=np.int64), np.zeros(len(found), dtype=np.int64)
        counts[found["pos"]] = found["count"]
        best[found["pos"]] = found["best"]
        return answered(list(mine["packed"].iloc[0]), counts, best)

    out = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return chunks.groupBy("chunk").cogroup(answers.groupBy("asker")).applyInPandas(answer, out)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """a, b, count: documents that hold the pair of ids linked, from partial counts."""
    return pairs.groupBy("a", "b").agg(F.sum("docs").alias("count"))


def groups(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The groups themselves: doc_id, groups (array of byte start and end in " " + text, ids of A, ids of B); the rules of ``align``."""
    sent = _sent(docs, path_a, path_b)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sides = _sides(*sent.value)
        for batch in batches:
            texts = list(batch["text"])
            for a, b in text_ranges(texts, CHARACTERS):
                m = merge(sides, texts[a:b])
                out: list[list[dict]] = [[] for _ in range(b - a)]
                cut = [np.split(i, np.cumsum(size)[:-1]) if len(size) else [] for i, size in zip(m.ids, m.sizes, strict=True)]
                upto = m.ends[0][np.cumsum(m.sizes[0]) - 1] if len(m.text) else np.zeros(0, dtype=np.int64)
                base, start, of = 0, 0, -1
                for text, end, ids_a, ids_b in zip(m.text.tolist(), upto.tolist(), *cut, strict=True):
                    if text != of:
                        base, of = start, text
                    out[text].append({"start": start - base, "end": end - base, "a": ids_a.tolist(), "b": ids_b.tolist()})
                    start = end
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[a:b].astype("Int64"), "groups": out})

    return _texts(docs).mapInPandas(run, "doc_id long, groups array<struct<start:long,end:long,a:array<int>,b:array<int>>>")
