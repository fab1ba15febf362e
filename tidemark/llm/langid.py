"""Language identification: words first, then ever shorter character n-grams."""

from __future__ import annotations

import functools
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import MEMO_ENTRIES, documents, map_batches

SAMPLE_DOCS, WORDS_PER_LANGUAGE, GRAMS_PER_LANGUAGE, LONGEST, SMOOTH, BACKOFF = 12_000, 40_000, 20_000, 4, 0.5, 0.4
LEAST_ROWS = 300
LETTERS = regex.compile(r"\p{L}+")


def hash_limit(wanted: int, n: int) -> int:
    """Signed 64-bit hashes below it are about ``wanted`` of ``n``; exact integers, so no share is too small."""
    return min(2**63 - 1, -(2**63) + (2**64 * wanted) // max(n, 1))


def sample(rows: DataFrame, bound: int, by: str, least: int = LEAST_ROWS) -> DataFrame:
    """About ``bound`` rows, or all if there are no more: those whose id hashes below a share of the 64-bit range.

    Every value of ``by`` (a label, a language: few, so their counts are collected) has its share of the rows, but ``least`` where it has as many.
    """
    counts = {r[by]: r["count"] for r in rows.groupBy(by).count().collect()}
    n = sum(counts.values())
    if n <= bound:
        return rows
    limits = [(value, hash_limit(max(bound * c // n, least), c)) for value, c in counts.items()]
    limit = F.element_at(F.create_map(*[F.lit(x) for pair in limits for x in pair]), F.col(by))
    return rows.filter(F.xxhash64("doc_id") < limit)


def grams(word: str, longest: int = LONGEST) -> Iterator[str]:
    marked = f"^{word}$"
    for n in range(1, longest + 1):
        for i in range(len(marked) - n + 1):
            yield marked[i : i + n]


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, words: int = WORDS_PER_LANGUAGE, gram_count: int = GRAMS_PER_LANGUAGE) -> bytes:
    """Log frequencies per language of words and of n-grams up to four characters.

    Fitted on about ``sample_docs`` rows that have a language; the tables keep the ``words`` and
    ``gram_count`` most frequent entries of each language. Both are bounds of the model, not of what it scores.
    Rows without text, id or language teach nothing.
    """

    def count(batch: pd.DataFrame) -> pd.DataFrame:
        found: dict[tuple[str, str, str], int] = {}
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            for word in LETTERS.findall(text.lower()):
                key = (lang, "word", word)
                found[key] = found.get(key, 0) + 1
        spelled: dict[tuple[str, str, str], int] = {}
        for (lang, _, word), n in found.items():
            for gram in grams(word):
                key = (lang, f"gram{len(gram)}", gram)
                spelled[key] = spelled.get(key, 0) + n
        return pd.DataFrame([(*k, n) for k, n in [*found.items(), *spelled.items()]], columns=["lang", "kind", "entry", "n"])

    rows = documents(docs, "lang").filter(F.col("lang").isNotNull() & (F.col("text") != "") & F.col("doc_id").isNotNull())
    counted = map_batches(sample(rows, sample_docs, "lang"), count, "lang string, kind string, entry string, n long")
    totals = counted.groupBy("lang", "kind", "entry").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "entry")
    most = F.when(F.col("kind") == "word", words).otherwise(gram_count)
    kept = totals.withColumn("i", F.row_number().over(order)).filter(F.col("i") <= most).collect()
    langs = sorted({r.lang for r in kept})
    at = {lang: j for j, lang in enumerate(langs)}
    tables: dict[str, dict[str, int]] = {}
    counts: dict[str, list[np.ndarray]] = {}
    for r in sorted(kept, key=lambda r: (r.kind, r.entry, r.lang)):
        index, rows_of = tables.setdefault(r.kind, {}), counts.setdefault(r.kind, [])
        if r.entry not in index:
            index[r.entry] = len(rows_of)
            rows_of.append(np.zeros(len(langs)))
        rows_of[index[r.entry]][at[r.lang]] += r.n
    logs = {}
    for kind, rows_of in counts.items():
        c = np.array(rows_of)
        logs[kind] = np.log((c + SMOOTH) / (c.sum(0) + SMOOTH * (len(c) + 1)))
    return pickle.dumps((langs, tables, logs))


class Scorer:
    """Scores words; remembers a bounded number of them."""

    def __init__(self, model: bytes):
        self.langs, self.tables, self.logs = pickle.loads(model)  # noqa: S301  our own bytes
        self.words = self.tables.get("word", {})
        known = self.logs.get("word", np.zeros((0, len(self.langs))))
        self.rows = [*known]
        self.unseen: dict[str, np.ndarray] = {}

    def spelled(self, word: str) -> np.ndarray:
        """At each place the longest known n-gram, each step down costing the same factor; averaged to one word."""
        marked = f"^{word}$"
        total = np.zeros(len(self.langs))
        i, places = 0, 0
        while i < len(marked):
            for n in range(min(LONGEST, len(marked) - i), 0, -1):
                j = self.tables.get(f"gram{n}", {}).get(marked[i : i + n])
                if j is not None:
                    total = total + self.logs[f"gram{n}"][j]
                    places += 1
                    break
            i += n
        return total * BACKOFF if places else total

    def score(self, text: str) -> np.ndarray | None:
        found = LETTERS.findall(text.lower())
        if not found:
            return None
        if len(self.unseen) > MEMO_ENTRIES // 4:
            self.unseen = {}
        total = np.zeros(len(self.langs))
        known, other = [], []
        get = self.words.get
        for word in found:
            j = get(word)
            if j is not None:
                known.append(j)
            else:
                other.append(word)
        if known:
            total += self.logs["word"][known].sum(0)
        if other:
            memo = self.unseen
            values = []
            for word in other:
                value = memo.get(word)
                if value is None:
                    value = memo[word] = self.spelled(word)
                values.append(value)
            total += np.sum(values, axis=0)
        return total / len(found)


@functools.lru_cache(maxsize=1)
def scorer_of(model: bytes) -> Scorer:
    return Scorer(model)


def predict(docs: DataFrame, model: bytes, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, lang_pred, score for whole texts, plus the named columns.

    ``und`` with score 0 for a null text, one without a letter, or a model without languages. Otherwise the best
    language, ties to the first by name, and its share of the likelihoods per word. Repeated rows give
    repeated rows; other columns are left behind; an empty table gives none.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        scorer = scorer_of(sent.value)
        said, scores = [], []
        for text in batch["text"]:
            each = scorer.score(text) if scorer.langs else None
            if each is None:
                said.append("und")
                scores.append(0.0)
                continue
            share = np.exp(each - each.max())
            best = int(each.argmax())
            said.append(scorer.langs[best])
            scores.append(float(share[best] / share.sum()))
        return batch.drop(columns="text").assign(lang_pred=said, score=scores)

    schema = ", ".join([f"doc_id {fields['doc_id']}", *[f"`{c}` {fields[c]}" for c in extra], "lang_pred string, score double"])
    return map_batches(documents(docs, *extra), run, schema)
