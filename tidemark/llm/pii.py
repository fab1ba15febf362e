"""Personal data: fixed base patterns, and further spans found by weak supervision."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents

KINDS = ("email", "ip", "card", "phone")
CONTEXT, ROUNDS, ACCEPT = 24, 60, 0.5

#: The base patterns. The lookbehind only keeps a run of digits from being tried again from within.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: Wider patterns of the labelers: what a base pattern would swallow, break or not read.
WIDE = {
    "email": re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]| dot |\.) ?[A-Za-z0-9-]{2,63}){1,4}"),
    "ip": re.compile(r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9A-Za-z.])[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{2,4}(?![0-9A-Za-z])"),
    "phone": re.compile(r"(?<![0-9])\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"),
}
#: Gazetteers: mail endings and hosts, issuers' first digits, reserved first parts of addresses, calling codes.
ENDINGS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "info")
ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "36", "60", "62", "65", "35")
CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49", "52", "55", "61", "81", "86", "91")
#: Words beside a span that speak for a kind, or against any.
FOR = {
    "email": ("mail", "contact", "write", "correo", "courriel"), "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "pay", "karte", "carte", "tarjeta"), "phone": ("phone", "call", "tel", "mobile", "fax"),
}
AGAINST = ("token", "password", "secret", "version", "isbn", "sha", "key", "=")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The pattern's matches, found from each @ outwards: linear time, also in very long runs."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            end = domain.end()
        at = text.find("@", max(at + 1, end))


def valid(kind: str, found: str) -> bool:
    digits = "".join([c for c in found if "0" <= c <= "9"])
    if kind == "ip":
        return all(int(p[-4:] if len(p.lstrip("0")) < 4 else "999") <= 255 for p in found.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the base patterns, leftmost and apart per kind; failing matches are dropped."""
    out = [(a, b, 0) for a, b in _emails(text)] if "@" in text else []
    for number, pattern in ((1, IP), (2, CARD), (3, PHONE)):
        out += [(m.start(), m.end(), number) for m in pattern.finditer(text) if valid(KINDS[number], m[0])]
    return sorted(out, key=lambda s: (s[0], s[2]))


def wider_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """What the wider patterns find and no base span of the same kind touches."""
    out = []
    for number, kind in enumerate(KINDS):
        own = [(a, b) for a, b, k in base if k == number]
        for m in WIDE[kind].finditer(text):
            if not any(a < m.end() and m.start() < b for a, b in own):
                out.append((m.start(), m.end(), number))
    return out


def votes(text: str, start: int, end: int, number: int) -> tuple[int, int, int, int]:
    """Each labeler says 1, 0 or abstains (-1): pattern, gazetteer, context, borders."""
    kind, found = KINDS[number], text[start:end]
    digits = "".join([c for c in found if "0" <= c <= "9"])
    if kind == "email":
        spelled = " at " in found and " dot " in found  # a lone " at " is mostly the English word
        pattern = int("@" in found or "(at)" in found or "[at]" in found or spelled)
        gazetteer = int(found.rpartition(".")[2].rpartition(" ")[2].lower() in ENDINGS)
    elif kind == "ip":
        pattern, gazetteer = int(valid(kind, found)), int(0 < int(found.split(".")[0][-4:]) < 240)
    elif kind == "card":
        pattern, gazetteer = int(valid(kind, found)), int(digits.startswith(ISSUERS))
    else:
        pattern, gazetteer = int(valid(kind, found)), int(digits.startswith(CODES))
    before, after = text[max(0, start - CONTEXT) : start].lower(), text[end : end + CONTEXT].lower()
    near = re.split(r"[^\w=]+", before)[-4:] + re.split(r"[^\w=]+", after)[:2]
    context = 0 if any(w in near for w in AGAINST) or before.endswith(("=", '"')) else 1 if any(w in near for w in FOR[kind]) else -1
    clear = lambda c: not c or not (c.isalnum() or c in "_@=/\"")
    return pattern, gazetteer, context, int(clear(text[start - 1 : start]) and clear(text[end : end + 1]))


def estimate(table: dict[tuple, int], rounds: int = ROUNDS) -> tuple[dict[tuple, float], float]:
    """Expectation-maximisation over vote patterns and their counts: posterior of each, and the share of true spans.

    Every labeler has a rate of saying 1 for true and for false spans, whatever the others say. Starts from the majority;
    rates are kept from 0 and 1 by one count each.
    """
    patterns, n = list(table), np.array(list(table.values()), dtype=float)
    v = np.array(patterns)
    said = v >= 0
    p = np.array([np.mean(row[row >= 0]) if (row >= 0).any() else 0.5 for row in v]) * 0.8 + 0.1
    share = 0.5
    for _ in range(rounds):
        share = float((n @ p + 1) / (n.sum() + 2))
        yes = ((n * p) @ (v == 1) + 2) / ((n * p) @ said + 2.5)  # a labeler is taken to be better than chance
        no = ((n * (1 - p)) @ (v == 1) + 0.5) / ((n * (1 - p)) @ said + 2.5)
        for_true = math.log(share) + (np.where(v == 1, np.log(yes), np.log1p(-yes)) * said).sum(1)
        for_false = math.log1p(-share) + (np.where(v == 1, np.log(no), np.log1p(-no)) * said).sum(1)
        p = 1 / (1 + np.exp(np.clip(for_false - for_true, -500, 500)))
    return dict(zip(patterns, p.tolist(), strict=True)), share


def features(number: int, found: str, said: tuple[int, ...]) -> tuple[int, ...]:
    """Votes for and against, and the span's shape in small classes."""
    marks = sum(c in " -.()" for c in found)
    shape = (min(3, marks), min(4, len(found) // 6))
    return (number, *said, *shape)


def train(table: dict[tuple[int, ...], tuple[int, float]], rounds: int = 200) -> dict[int, np.ndarray]:
    """Logistic weights per kind, fitted to posteriors (count, mean posterior) of feature patterns by gradient steps."""
    out = {}
    for number in {f[0] for f in table}:
        rows = [(f, n, p) for f, (n, p) in sorted(table.items()) if f[0] == number]
        x = np.stack([design(f) for f, _, _ in rows])
        n, p = np.array([r[1] for r in rows], dtype=float), np.array([r[2] for r in rows])
        w = np.zeros(x.shape[1])
        for _ in range(rounds):
            q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            curve = (x * (n * q * (1 - q))[:, None]).T @ x + 0.1 * np.eye(len(w))
            step = np.linalg.solve(curve, x.T @ (n * (p - q)) - 0.1 * w)
            w += step
            if np.abs(step).max() < 1e-8:
                break
        out[number] = w
    return out


def design(f: tuple[int, ...]) -> np.ndarray:
    said, (marks, size) = f[1:5], f[5:7]
    return np.array([1.0, *[float(v == 1) for v in said], *[float(v == 0) for v in said], *[float(marks == m) for m in range(4)], *[float(size == s) for s in range(5)]])


def fit(docs: DataFrame) -> dict[int, list[float]]:
    """Reliabilities and the span classifier, from the votes on all candidate spans of all whole texts.

    What reaches the driver is one row per kind, vote pattern and shape class: under 7,000 rows whatever the data.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[tuple[int, ...], int] = {}
            for text in batch["text"]:
                base = base_spans(text)
                for a, b, k in base + wider_spans(text, base):
                    f = features(k, text[a:b], votes(text, a, b, k))
                    seen[f] = seen.get(f, 0) + 1
            yield pd.DataFrame([(list(f), n) for f, n in seen.items()], columns=["f", "n"])

    counted = documents(docs).select("text").mapInPandas(run, "f array<int>, n long").groupBy("f").agg(F.sum("n").alias("n")).collect()
    table = {tuple(r.f): r.n for r in counted}
    goal = {}
    for number in range(len(KINDS)):
        patterns: dict[tuple[int, ...], int] = {}
        for f, n in table.items():
            if f[0] == number:
                patterns[f[1:5]] = patterns.get(f[1:5], 0) + n
        if patterns:
            posterior, _ = estimate(patterns)
            goal |= {f: (n, posterior[f[1:5]]) for f, n in table.items() if f[0] == number}
    return {k: w.tolist() for k, w in train(goal).items()}


def spans_of(text: str, model: dict[int, list[float]]) -> list[tuple[int, int, int, bool]]:
    """(start, end, kind number, base) by start, then kind: the base spans and the wider ones the classifier takes.

    For e-mail the classifier alone decides. A wider address, card or phone must also be valid in itself (parts up to 255,
    checksum, number of digits): what fails that is none, however the other labelers vote.
    """
    base = base_spans(text)
    out = [(a, b, k, True) for a, b, k in base]
    for a, b, k in wider_spans(text, base):
        if k in model:
            f = features(k, text[a:b], votes(text, a, b, k))
            if (f[0] == 0 or f[1] == 1) and 1 / (1 + math.exp(-max(-30.0, min(30.0, float(np.dot(design(f), model[k])))))) > ACCEPT:
                out.append((a, b, k, False))
    return sorted(out, key=lambda s: (s[0], s[2], s[1]))


def find(docs: DataFrame, model: dict[int, list[float]]) -> DataFrame:
    """doc_id and spans (kind, start, end in code points, base) of every whole text.

    Base spans always stay. A null or empty text has none; repeated rows give repeated rows; extra columns are left behind;
    an empty table gives no rows. A model fitted on texts without spans adds none. Spans of different kinds may overlap.
    """
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [[{"kind": KINDS[k], "start": a, "end": b, "base": own} for a, b, k, own in spans_of(t, model)] for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "spans": found})

    return documents(docs).mapInPandas(run, f"doc_id {fields['doc_id']}, spans array<struct<kind:string,start:int,end:int,base:boolean>>")


def mask(docs: DataFrame, model: dict[int, list[float]]) -> DataFrame:
    """The rows with each span of ``text`` replaced by its kind in brackets and, if the column exists, ``n_chars`` set anew.

    Overlapping spans are replaced once, under the kind of the first. Rows without spans, null texts included, are unchanged.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.copy()
            texts = list(batch["text"])
            for i, text in enumerate(texts):
                found = spans_of(text, model) if text else []
                if found:
                    parts, at = [], 0
                    for a, b, k, _ in found:
                        if a >= at:
                            parts += [text[at:a], f"[{KINDS[k]}]"]
                        at = max(at, b)
                    texts[i] = "".join([*parts, text[at:]])
            batch["text"] = texts
            yield batch

    done = docs.mapInPandas(run, docs.schema)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(docs.columns)
