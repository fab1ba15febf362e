"""Benchmark decontamination: a generalised suffix automaton of the test items reads the training texts."""

from __future__ import annotations

import functools
import itertools
import pickle
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import TERM_BYTES, terms, text_ranges
from tidemark.session import Workspace

WINDOW = 10
#: Words of one piece of an item, and of one automaton: both bound what a task builds and what is broadcast.
PIECE_WORDS, AUTOMATON_WORDS = 10_000, 200_000
CHAINED = 4
PAIR_BITS = 22
SPANS = "array<struct<start:int,end:int>>"


class Automaton:
    """Every run of words within the items, as the paths of a minimal deterministic automaton.

    A state stands for runs that end at the same places; ``length`` is its longest run, ``link`` the state of
    the longest shorter run that ends in more places. ``whole`` gives, for the states that hold a window
    (``window`` words, or a whole item of fewer), the items it occurs in.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes], bool]], window: int):
        """items: (item id, words, whether the words are all of the item)."""
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        runs = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words] for _, words, _ in items]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for run in runs:
            last = 0
            for word in run:
                last = self._extend(last, word)
        self.names = sorted({name for name, _, _ in items if name is not None})
        number = {name: i for i, name in enumerate(self.names)}
        # the state on the chain of links that holds the window words before a place
        self.at_window = [-1] * len(self.next)
        for state in sorted(range(len(self.next)), key=self.length.__getitem__):
            if self.length[state] >= window:
                up = self.link[state]
                self.at_window[state] = state if self.length[up] < window else self.at_window[up]
        self.windows: dict[int, set[int]] = {}
        short: dict[int, dict[int, set[int]]] = {}
        for (name, _, whole), run in zip(items, runs, strict=True):
            mine = set() if name is None else {number[name]}
            state = 0
            for i, word in enumerate(run):
                state = self.next[state][word]
                if i + 1 >= window:
                    self.windows.setdefault(self.at_window[state], set()).update(mine)
            if whole and 0 < len(run) < window:
                while self.length[self.link[state]] >= len(run):
                    state = self.link[state]
                short.setdefault(state, {}).setdefault(len(run), set()).update(mine)
        # short items that end wherever a state's runs end, longest first
        self.short: list[tuple[tuple[int, frozenset[int]], ...]] = [()] * len(self.next)
        if short:
            for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
                own = tuple((n, frozenset(short[state][n])) for n in sorted(short[state], reverse=True)) if state in short else ()
                self.short[state] = own + self.short[self.link[state]]
        lengths = [min(len(run), window) for run, (_, _, whole) in zip(runs, items, strict=True) if len(run) >= window or (whole and run)]
        self.least = min(lengths, default=0)
        self.pairs = np.zeros(1 << PAIR_BITS, dtype=bool)
        for run in runs:
            ids = np.array(run, dtype=np.int64)
            self.pairs[pair_slots(ids[:-1], ids[1:])] = True

    def _extend(self, last: int, word: int) -> int:
        following, length, link = self.next, self.length, self.link
        known = following[last].get(word)
        if known is not None:
            return known if length[known] == length[last] + 1 else self._split(last, word, known)
        new = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state != -1 and word not in following[state]:
            following[state][word] = new
            state = link[state]
        if state != -1:
            known = following[state][word]
            link[new] = known if length[known] == length[state] + 1 else self._split(state, word, known)
        return new

    def _split(self, state: int, word: int, known: int) -> int:
        """Give the runs of ``known`` that pass through ``state`` a state of their own."""
        following, length, link = self.next, self.length, self.link
        copy = len(following)
        following.append(dict(following[known]))
        length.append(length[state] + 1)
        link.append(link[known])
        link[known] = copy
        while state != -1 and following[state].get(word) == known:
            following[state][word] = copy
            state = link[state]
        return copy

    def read(self, run: list[int], spans: list[list[int]], items: set[int], offset: int) -> int:
        """Stream known words; note where windows occur, and in which items. Returns the longest match of a window or more."""
        following, length, link, window, short = self.next, self.length, self.link, self.window, self.short
        state, matched, longest = 0, 0, 0
        for i, word in enumerate(run, offset + 1):
            step = following[state].get(word)
            while step is None and state:
                state = link[state]
                matched = length[state]
                step = following[state].get(word)
            if step is None:
                matched = 0
                continue
            state, matched = step, matched + 1
            if matched >= window:
                items |= self.windows[self.at_window[state]]
                cover(spans, i - window, i)
                longest = max(longest, matched)
            for n, names in short[state]:
                if n <= matched:
                    items |= names
                    cover(spans, i - n, i)
                    longest = max(longest, n)
        return longest


def cover(spans: list[list[int]], start: int, end: int) -> None:
    if spans and spans[-1][0] <= start <= spans[-1][1]:
        spans[-1][1] = max(end, spans[-1][1])
    else:
        spans.append([start, end])


def united(spans: list[list[int]]) -> list[tuple[int, int]]:
    """Disjoint spans in order; touching ones become one."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(end, out[-1][1])
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def pair_slots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a * 0x9E3779B1 + b) * 0x85EBCA6B
    return (x ^ (x >> 15)) & ((1 << PAIR_BITS) - 1)


class Reader:
    """Finds an automaton's windows in a run of texts.

    The longest match over a place where two neighbouring words never follow each other in an item is one
    word long, so such places part the texts; what is left between them and long enough for the shortest window is streamed.
    """

    def __init__(self, automaton: Automaton):
        self.automaton = automaton

    def scan(self, texts: list[str]) -> list[tuple[int, list[list[int]], set[int], int]]:
        """Per text: number of words, spans of words, items, longest match."""
        found = [terms(t) for t in texts]
        sizes = np.array([len(w) for w in found], dtype=np.int64)
        starts = np.r_[0, np.cumsum(sizes)]
        out: list[tuple[int, list[list[int]], set[int], int]] = [(int(n), [], set(), 0) for n in sizes]
        a = self.automaton
        if not a.least or not starts[-1]:
            return out
        known = map(a.vocabulary.get, itertools.chain.from_iterable(found), itertools.repeat(-1))
        ids = np.fromiter(known, dtype=np.int64, count=int(starts[-1]))
        joined = np.zeros(len(ids) + 1, dtype=bool)  # joined[i]: the words before and at i may follow each other
        near = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
        joined[near[a.pairs[pair_slots(ids[near], ids[near + 1])]] + 1] = True
        joined[starts] = False
        first = np.flatnonzero((ids >= 0) & ~joined[:-1])
        last = np.flatnonzero((ids >= 0) & ~joined[1:]) + 1
        long = last - first >= a.least
        first, last = first[long], last[long]
        text = np.searchsorted(starts, first, side="right") - 1
        for k, b, e in zip(text.tolist(), first.tolist(), last.tolist(), strict=True):
            n, spans, items, longest = out[k]
            out[k] = (n, spans, items, max(longest, a.read(ids[b:e].tolist(), spans, items, b - int(starts[k]))))
        return out


@functools.lru_cache(maxsize=1)
def _reader(blob: bytes) -> Reader:
    return Reader(pickle.loads(blob))


def _automata(items: DataFrame, window: int, ws: Workspace, piece_words: int, automaton_words: int) -> tuple[DataFrame, int]:
    """One row (shard, blob) per automaton of a bounded number of words, and how many there are.

    Long items are cut in pieces that overlap by one word less than a window, so each window lies whole in one.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, text in zip(batch["item_id"], batch["text"], strict=True):
                words = terms(text)
                for at in range(0, max(1, len(words) - window + 1), piece_words):
                    piece = words[at : at + piece_words + window - 1]
                    if piece:
                        rows.append((name, b" ".join(piece), len(piece), len(piece) == len(words)))
            yield pd.DataFrame(rows, columns=["item_id", "words", "n", "whole"])

    texts = items.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    pieces = ws.write(texts.mapInPandas(cut, "item_id string, words binary, n int, whole boolean"), "pieces")
    total = pieces.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // automaton_words))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["item_id", "words"])
        names = [None if n is None or pd.isna(n) else n for n in group["item_id"]]
        automaton = Automaton([(n, w.split(), bool(o)) for n, w, o in zip(names, group["words"], group["whole"], strict=True)], window)
        return pd.DataFrame({"shard": [int(group["shard"].iloc[0])], "blob": [pickle.dumps(automaton, protocol=5)]})

    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("words"), F.lit(shards)).cast("int"))
    return ws.write(dealt.groupBy("shard").applyInPandas(build, "shard int, blob binary"), "automata"), shards


def find(docs: DataFrame, items: DataFrame, ws: Workspace, window: int = WINDOW,
         piece_words: int = PIECE_WORDS, automaton_words: int = AUTOMATON_WORDS) -> DataFrame:
    """Where the words of test items occur: doc_id, text, n_words, spans (of words, end exclusive), items, longest.

    Words are runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased. A window is ``window`` consecutive words of
    an item; an item of fewer words, but not none, is one window. ``spans`` unite all occurrences of windows, ``items``
    are the ids (as text) of the items whose windows occur, ``longest`` is the longest match of a window or more
    (an item is seen in pieces of ``piece_words`` words, so no match is longer than a piece).

    Items make automata of at most about ``automaton_words`` words, built in tasks and broadcast one by one; each reads all texts,
    in one pass where one automaton is enough. A null or empty text has no words, in either table. An item without an id marks words but
    is not listed. Rows repeat as the documents do; items that share an id count once. Extra columns of either table are left
    behind; without items nothing is found, and an empty table gives none.
    """
    built, shards = _automata(items, window, ws, piece_words, automaton_words)
    names = "doc_id", "text", "n_words", "spans", "items", "longest"
    schema = f"doc_id long, text string, n_words long, spans {SPANS}, items array<string>, longest int"
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit(0).cast("long").alias("n_words"), F.array().cast(SPANS).alias("spans"),
        F.array().cast("array<string>").alias("items"), F.lit(0).alias("longest"),
    )
    for shard in range(shards):
        kept = built.filter(F.col("shard") == shard).select("blob").collect()
        blob = kept[0].blob if kept else pickle.dumps(Automaton([], window), protocol=5)
        rows = _read(rows, docs.sparkSession.sparkContext.broadcast(bytes(blob)), schema, names)
        if shard % CHAINED == CHAINED - 1 and shard < shards - 1:
            rows = ws.write(rows, "scanned")
    return rows


def _read(rows: DataFrame, sent, schema: str, names: tuple[str, ...]) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = _reader(sent.value)
        every = reader.automaton.names
        for batch in batches:
            texts = ["" if t is None else t for t in batch["text"]]
            out = []
            for a, b in text_ranges(texts, 2_000_000):
                part = batch.iloc[a:b]
                before = zip(part["doc_id"], part["text"], part["spans"], part["items"], part["longest"], strict=True)
                for (n, spans, items, longest), (doc_id, text, known, listed, most) in zip(reader.scan(texts[a:b]), before, strict=True):
                    spans = united([*spans, *[[s["start"], s["end"]] for s in known]])
                    items = sorted({*listed, *[every[i] for i in items]})
                    out.append((doc_id, text, n, [{"start": s, "end": e} for s, e in spans], items, max(longest, most)))
            yield pd.DataFrame(out, columns=list(names)).astype({"doc_id": "Int64"})

    return rows.mapInPandas(run, schema)


def hit_words(spans: Column | str) -> Column:
    """Words that lie in spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])


WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text less the words of the spans and what stands between the words of one span."""
    raw = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in WORD.finditer(raw.translate(TERM_BYTES))]
    out, at = [], 0
    for start, end in spans:
        out.append(raw[at : places[start][0]])
        at = places[end - 1][1]
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")


def remove(docs: DataFrame, items: DataFrame, ws: Workspace, window: int = WINDOW, most_words: int = WINDOW - 1, most_share: float = 0.5) -> DataFrame:
    """doc_id, text, n_hit: documents less the spans of more than ``most_words`` words that lie in windows of test items.

    A document with more than ``most_share`` of its words in such spans goes altogether. Null texts stay null; the
    same rules as in ``find`` for all else.
    """
    found = find(docs, items, ws, window).withColumn("spans", F.filter("spans", lambda s: s["end"] - s["start"] > most_words))
    kept = found.withColumn("n_hit", hit_words("spans")).filter(F.col("n_hit") <= F.col("n_words") * most_share)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spans = [[(s["start"], s["end"]) for s in row] for row in batch["spans"]]
            batch["text"] = [without_spans(t, s) if s else t for t, s in zip(batch["text"], spans, strict=True)]
            yield batch[["doc_id", "text", "n_hit"]]

    return kept.select("doc_id", "text", "n_hit", "spans").mapInPandas(run, "doc_id long, text string, n_hit long")
