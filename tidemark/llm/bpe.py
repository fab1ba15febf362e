"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches."""

from __future__ import annotations

import base64
import functools
import hashlib
import json
import re
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

UNITS = 600_000
# a space beside other white space
SPACED = ("  ", " \n", "\n ", " \t", "\t ", " \r", "\r ")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others follow from U+0100 on, in order.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def tokenizer_json(ranks: dict[bytes, int]) -> str:
    """The ranks as a tokenizers model.

    A pair of tokens merges when its bytes together have a rank, the lowest rank first; so
    every split of a token into two tokens is a merge, ordered by the rank of the whole.
    """
    chars = byte_characters()
    shown = {token: "".join(chars[b] for b in token) for token in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.__getitem__):
        for cut in range(1, len(token)):
            left, right = token[:cut], token[cut:]
            if left in ranks and right in ranks:
                merges.append([shown[left], shown[right]])
    model = {
        "type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None,
        "fuse_unk": False, "byte_fallback": False, "ignore_merges": True,
        "vocab": {shown[t]: r for t, r in ranks.items()}, "merges": merges,
    }
    return json.dumps({
        "version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None, "pre_tokenizer": None,
        "post_processor": None, "decoder": None, "model": model,
    })


class Codec:
    """Encodes texts by units, remembers a bounded number of them, and decodes by the byte table.

    A unit is a run that the pattern cannot match across: where a single space stands between
    two characters that are no white space, no match of the pattern holds the character before the space
    together with the space. A text with other spaces is cut by the pattern itself.
    """

    def __init__(self, model: str, pattern: str):
        self.tokenizer = Tokenizer.from_str(model)
        self.pattern = regex.compile(pattern)
        self.rare = re.compile(r"[^\S \n\t\r]")
        self.chars = byte_characters()
        back = {c: b for b, c in enumerate(self.chars)}
        size = self.tokenizer.get_vocab_size(with_added_tokens=False)
        self.bytes_of = {i: bytes(back[c] for c in self.tokenizer.id_to_token(i)) for i in range(size)}
        self.digits = {i: str(i) for i in range(size)}
        self.units: dict[str, str] = {}  # ids joined by commas
        self.back: dict[str, bytes] = {"": b""}  # and what such ids decode to

    def cut(self, text: str) -> list[str]:
        joined = text[:1] == " " or text[-1:] == " " or any(pair in text for pair in SPACED) or self.rare.search(text)
        if joined or not text:
            return self.pattern.findall(text)
        head, *rest = text.split(" ")
        return [head, *[" " + part for part in rest]]

    def learn(self, units: set[str]) -> None:
        """Encode new units in one batch, each match of the pattern by itself."""
        whole = [unit for unit in units if unit[unit[:1] == " " :].isalpha()]  # one match
        others = {unit: self.pattern.findall(unit) for unit in units.difference(whole)}
        alone = list(set(whole).union(*others.values()))
        table = dict(enumerate(self.chars))
        # byte b as the character chr(b), and from there to the character that stands for it
        shown = [piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(table) for piece in alone]
        known: dict[str, str] = {}
        for piece, encoded in zip(alone, self.tokenizer.encode_batch_fast(shown, add_special_tokens=False), strict=True):
            ids = encoded.ids
            listed = known[piece] = ",".join(map(self.digits.__getitem__, ids))
            self.back[listed] = self.decode(ids)
        self.units.update((unit, known[unit]) for unit in whole)
        for unit, pieces in others.items():
            listed = self.units[unit] = ",".join([known[piece] for piece in pieces])
            self.back[listed] = b"".join([self.back[known[piece]] for piece in pieces])

    def prepare(self, texts: list[str]) -> list[list[str]]:
        """For each text the ids of its units, joined by commas; what they decode to is in ``back`` until the next call."""
        if len(self.units) > UNITS:
            self.units, self.back = {}, {"": b""}
        cuts = [self.cut(text) for text in texts]
        unseen = set().union(*cuts) - self.units.keys()
        if unseen:
            self.learn(unseen)
        return [list(map(self.units.__getitem__, cut)) for cut in cuts]

    def ids(self, texts: list[str]) -> list[list[int]]:
        shown = [",".join(row) for row in self.prepare(texts)]
        return [list(map(int, row.split(","))) if row else [] for row in shown]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@functools.lru_cache(maxsize=1)
def codec_of(model: str, pattern: str) -> Codec:
    """One codec per worker, for as long as a task runs."""
    return Codec(model, pattern)


def batches_of(texts: list[str], characters: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts with a bounded number of characters; a longer text is alone."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > characters:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def _model(spark: SparkSession, path: str):
    """The model travels by a broadcast whose size is the vocabulary file's, whatever the data."""
    return spark.sparkContext.broadcast(tokenizer_json(read_ranks(path)))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Token ids of whole texts: doc_id, ids, starts (byte offset of each token), n_bytes, in the order of the text.

    Each match of the pattern is encoded by itself, without special tokens. A null text
    counts as empty; an empty text has no tokens. Repeated rows give repeated rows,
    extra columns are left behind, an empty table gives none. A token may end within a
    character: offsets are of UTF-8 bytes and only their joined bytes need be text.
    """
    model = _model(docs.sparkSession, path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = codec_of(model.value, pattern)
        try:
            for batch in batches:
                texts = list(batch["text"])
                for a, b in batches_of(texts, 400_000):
                    rows = []
                    for ids, doc_id in zip(codec.ids(texts[a:b]), batch["doc_id"].iloc[a:b], strict=True):
                        starts, at = [], 0
                        for i in ids:
                            starts.append(at)
                            at += len(codec.bytes_of[i])
                        rows.append((doc_id, ids, starts, at))
                    yield pd.DataFrame(rows, columns=["doc_id", "ids", "starts", "n_bytes"]).astype({"doc_id": "Int64"})
        finally:
            codec_of.cache_clear()  # workers are used again by other stages, which need the memory

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(run, "doc_id long, ids array<int>, starts array<long>, n_bytes long")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Bytes and text of token ids: doc_id, decoded (bytes), text.

    Tokens that split a character are joined as bytes first; bytes that are no text
    become U+FFFD in ``text`` only. Null ids count as none; an id outside the vocabulary is an error.
    """
    model = _model(encoded.sparkSession, path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = codec_of(model.value, pattern)
        try:
            for batch in batches:
                joined = [codec.decode([] if ids is None else list(ids)) for ids in batch["ids"]]
                yield pd.DataFrame({"doc_id": batch["doc_id"], "decoded": joined, "text": [b.decode("utf-8", "replace") for b in joined]})
        finally:
            codec_of.cache_clear()

    return encoded.select("doc_id", "ids").mapInPandas(run, "doc_id long, decoded binary, text string")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 (ids joined by commas), decoded_sha256; encoded and decoded in one pass.

    The same rules for nulls, empty and repeated rows as ``encode``.
    """
    model = _model(docs.sparkSession, path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = codec_of(model.value, pattern)
        try:
            for batch in batches:
                texts = list(batch["text"])
                rows = []
                for a, b in batches_of(texts, 2_000_000):
                    for shown, doc_id in zip(codec.prepare(texts[a:b]), batch["doc_id"].iloc[a:b], strict=True):
                        listed = ",".join(shown)
                        n = listed.count(",") + 1 if listed else 0
                        decoded = b"".join(map(codec.back.__getitem__, shown))
                        rows.append((doc_id, n, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()))
                yield pd.DataFrame(rows, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]).astype({"doc_id": "Int64"})
        finally:
            codec_of.cache_clear()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
