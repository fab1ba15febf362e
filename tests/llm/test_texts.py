"""Text operators against brute force, exact round trips and held-out accuracy."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken

from tidemark.llm import bpe, components, jaccard, katz, langid, mixing, pii, quality, toxicity

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LONG = "wörd und mehr " * 40_000


def sha(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


# --- byte-level BPE -------------------------------------------------------------


def test_bpe_equals_the_reference_library(spark, docs):
    ranks = bpe.read_ranks(PATH)
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [None, "", " ", "  a", "it's  fine\n\n x", "a\u00a0b", "日本語テスト 🙂🙂", "É\u0301cole", "1234 56", "<|endoftext|>", "x" * 5000, LONG, "\t\tif x:\r\n", "don't 'll"]
    random.seed(1)
    texts += ["".join(random.choice("ab é\n'1.-🙂 ") for _ in range(60)) for _ in range(200)]
    df = docs([(i, t) for i, t in enumerate(texts)] + [(None, "a b"), (3, "  a")])
    rows = {r.doc_id: r for r in bpe.encode(df, PATH, public_tokenizers.PATTERN).collect()}
    trips = {r.doc_id: r for r in bpe.round_trip(df, PATH, public_tokenizers.PATTERN).collect()}
    for i, text in enumerate(texts):
        ids = other.encode_ordinary(text or "")
        assert list(rows[i].ids) == ids and rows[i].n_bytes == len((text or "").encode())
        assert list(rows[i].starts) == list(itertools.accumulate([0, *[len(other.decode_single_token_bytes(t)) for t in ids]]))[: len(ids)]
        assert trips[i].n_tokens == len(ids) and trips[i].ids_sha256 == sha(",".join(map(str, ids)).encode())
        assert trips[i].decoded_sha256 == sha((text or "").encode())
    assert bpe.round_trip(df, PATH, public_tokenizers.PATTERN).count() == len(texts) + 2
    assert bpe.encode(df.filter("false"), PATH, public_tokenizers.PATTERN).count() == 0


def test_bpe_decoding_joins_split_characters(spark, docs):
    encoded = bpe.encode(docs([(1, "🙂 ſ ok"), (2, None)]), PATH, public_tokenizers.PATTERN)
    back = {r.doc_id: r for r in bpe.decode(encoded, PATH, public_tokenizers.PATTERN).collect()}
    assert back[1].text == "🙂 ſ ok" and bytes(back[1].decoded) == "🙂 ſ ok".encode() and back[2].text == ""
    cut = encoded.selectExpr("doc_id", "slice(ids, 1, 1) AS ids")  # half a character
    assert "\ufffd" in {r.doc_id: r.text for r in bpe.decode(cut, PATH, public_tokenizers.PATTERN).collect()}[1]


# --- n-gram Jaccard join --------------------------------------------------------


def sets_of(texts, width):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    return out


def brute_groups(ids, texts, width, percent):
    found = sets_of(texts, width)
    root = list(range(len(ids)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(ids)), 2):
        a, b = found[i], found[j]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            root[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i in range(len(ids)):
        least[top(i)] = min(least.get(top(i), ids[i]), ids[i])
    return {ids[i]: (len(found[i]), least[top(i)] if found[i] else ids[i]) for i in range(len(ids))}


@pytest.mark.parametrize("width,percent", [(4, 85), (5, 80)])
def test_jaccard_equals_brute_force(spark, docs, shared, width, percent):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(4000)]
    shared_passage = " ".join(rng.choices(words, k=30))
    texts = []
    for _ in range(12):  # families of near copies at many distances, some on the threshold
        base = rng.choices(words, k=rng.choice([8, 20, 41, 80, 150]))
        for _ in range(14):
            copy = list(base)
            for _ in range(rng.randrange(6)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy[rng.randrange(3) :]))
    texts += [shared_passage + " " + " ".join(rng.choices(words, k=rng.choice([1, 3, 6, 40]))) for _ in range(25)]
    texts += ["", " \n\t", None, "One", "one", "one two", "ONE TWO", "a b c d", "A  B\nC D", "É x y z", "é x y z", "x\u00a0y z w v", texts[0], texts[0].upper()]
    ids = rng.sample(range(1000), len(texts))
    got = jaccard.groups(docs(list(zip(ids, texts, strict=True))), shared, width, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_groups(ids, texts, width, percent)


def test_jaccard_step_two_alone_loses_nothing(spark, docs, shared, monkeypatch):
    """Chains whose ends are unlike and whose links no min-hash need show."""
    monkeypatch.setattr(jaccard, "LIST_BLOCK", 3)
    rng = random.Random(9)
    base = [f"v{i}" for i in range(60)]
    texts = []
    for i in range(40):
        base[rng.randrange(60)] = f"n{i}"
        texts.append(" ".join(base))
    texts += texts[:5]
    ids = list(range(100, 145))
    got = jaccard.groups(docs(list(zip(ids, texts, strict=True))), shared, 4, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_groups(ids, texts, 4, 85)


def test_jaccard_list_pairs_skip_nothing_that_fits():
    rng = np.random.default_rng(2)
    n = np.sort(rng.integers(5, 60, 300))
    pos = rng.integers(0, 5, 300)
    ids, comps = rng.permutation(300), rng.integers(0, 40, 300)
    found = {tuple(p[:2]) for part in jaccard.list_pairs(n, pos, ids, comps, 85) for p in part.tolist()}
    want = set()
    for i, j in itertools.combinations(range(300), 2):
        need = math.ceil(85 * (n[i] + n[j]) / 185 - 1e-9)
        if comps[i] != comps[j] and min(pos[i], pos[j]) + min(n[i] - pos[i], n[j] - pos[j]) >= need and 100 * n[i] >= 85 * n[j]:
            want.add((min(ids[i], ids[j]), max(ids[i], ids[j])))
    assert found == want


def test_jaccard_odd_rows(spark, docs, shared):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (None, "lonely text here now"), (2, None), (3, LONG), (4, LONG)]
    got = sorted(((r.doc_id or 0), r.n_shingles, r.component_id) for r in jaccard.groups(docs(rows), shared, 4, 85).collect())
    assert got == [(0, 1, None), (0, 2, 1), (1, 2, 1), (1, 2, 1), (2, 0, 2), (3, 3, 3), (4, 3, 3)]
    kept = jaccard.one_of_each(docs(rows), shared, 4, 85)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 2, 3]
    assert jaccard.groups(docs(rows).filter("false"), shared, 4, 85).count() == 0


# --- personal data --------------------------------------------------------------

PATTERNS = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def brute_spans(text):
    out = []
    for k, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            good = (True, k == 1 and all(int(x) <= 255 for x in m[0].split(".")), 14 <= len(digits) <= 19 and pii.luhn(digits), 10 <= len(digits) <= 15)
            if good[k]:
                out.append((m.start(), m.end(), k))
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(2)
    for _ in range(20_000):
        text = "".join(rng.choice("a1.@-+ 0()%4é\n25") for _ in range(rng.randrange(40)))
        assert pii.base_spans(text) == brute_spans(text), text


def test_spans_of_fused_values_are_added_and_secrets_are_not(spark, docs):
    plain = [f"call me +1 (269) 555-{i:04d} or 10.0.0.{i % 250} or a{i}@mail.example.com now" for i in range(1000, 1040)]
    fused = "é see +1 (269) 555-3296 4111111111111111 here"
    rows = [(i, t) for i, t in enumerate(plain)] + [(900, fused), (901, 'token = "4111 1111 1111 1112"'), (902, None), (903, ""), (None, "x@y.zz"), (904, "0" * 30_000)]
    df = docs(rows)
    model = pii.fit(df)
    found = {r.doc_id: [(s.kind, s.start, s.end, s.base) for s in r.spans] for r in pii.find(df, model).collect()}
    assert found[900] == [("phone", 6, 23, False), ("card", 24, 40, False)]
    assert found[901] == found[902] == found[903] == found[904] == [] and found[None] == [("email", 0, 6, True)]
    for i, t in enumerate(plain):
        assert [(a, b, pii.KINDS.index(k)) for k, a, b, own in found[i] if own] == brute_spans(t)
    masked = {r.doc_id: r for r in pii.mask(df, model).collect()}
    assert masked[900].text == "é see [phone] [card] here" and masked[900].n_chars == len(masked[900].text)
    assert masked[902].text is None and masked[903].text == "" and len(masked) == len(rows)
    assert pii.find(df.filter("false"), {}).count() == 0 and pii.fit(df.filter("false")) == {}


def test_reliabilities_are_recovered():
    rng = random.Random(4)
    rates = [(0.95, 0.1), (0.8, 0.3), (0.9, 0.2), (0.7, 0.35)]
    votes, truth = Counter(), defaultdict(lambda: [0, 0])
    for _ in range(20_000):
        real = rng.random() < 0.4
        said = tuple(int(rng.random() < (a if real else b)) for a, b in rates)
        votes[said] += 1
        truth[said][real] += 1
    posterior, share = pii.estimate(dict(votes))
    assert share == pytest.approx(0.4, abs=0.05)
    right = sum(truth[s][posterior[s] > 0.5] for s in votes)
    best = sum(max(t) for t in truth.values())
    assert right >= 0.99 * best


# --- language model -------------------------------------------------------------


def brute_katz(train, texts):
    tokens = lambda t: (t or "").encode().lower().split() + ["END"]
    uni = Counter(w for t in train for w in tokens(t))
    total, types = sum(uni.values()), len(uni)
    pairs = defaultdict(Counter)
    for t in train:
        for h, w in itertools.pairwise(["START", *tokens(t)]):
            pairs[h][w] += 1
    counts = Counter(c for h in pairs.values() for c in h.values())
    d = katz.discounts([counts[r] for r in range(1, 7)])
    low = lambda w: (uni[w] + 0.5) / (total + 0.5 * (types + 1))
    cut = lambda c: d[c] if c <= 5 else 1.0

    def p(h, w):
        seen = pairs.get(h)
        if not seen:
            return low(w)
        n = sum(seen.values())
        kept = sum(cut(c) * c for c in seen.values())
        n_or_more = n if kept < n else n + 1
        if w in seen:
            return cut(seen[w]) * seen[w] / n_or_more
        return (1 - kept / n_or_more) / (1 - sum(low(x) for x in seen)) * low(w)

    rows = []
    for t in texts:
        w = tokens(t)
        rows.append((len(w), sum(uni[x] > 0 for x in w), total, sum(math.log10(low(x)) for x in w), sum(math.log10(p(h, x)) for h, x in itertools.pairwise(["START", *w]))))
    sums = [sum(p(h, w) for w in uni) + p(h, "never seen") for h in [*list(pairs)[:20], "unknown"]]
    return rows, sums


@pytest.mark.parametrize("chunk_tokens", [50, 10**6])
def test_katz_equals_brute_force_and_sums_to_one(spark, docs, shared, chunk_tokens):
    rng = random.Random(5)
    vocabulary = [f"x{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    texts = [" ".join(rng.choices(vocabulary, weights, k=rng.randrange(40))) for _ in range(80)]
    texts += [None, "", " \n", "unseen words only", "X0 x0 É", texts[3], "the the " * 300]
    flags = [i % 5 != 1 for i in range(len(texts))]
    df = docs([(i, t, None, str(f)) for i, (t, f) in enumerate(zip(texts, flags, strict=True))]).selectExpr("*", "source = 'True' AS learned")
    got = {r.doc_id: r for r in katz.score(df, "learned", shared, chunk_tokens).collect()}
    want, sums = brute_katz([t for t, f in zip(texts, flags, strict=True) if f], texts)
    assert sums == pytest.approx([1.0] * len(sums), abs=1e-9)
    for i, row in enumerate(want):
        assert tuple(got[i])[1:4] == row[:3] and tuple(got[i])[4:] == pytest.approx(row[3:], abs=1e-8)


def test_katz_without_training_rows(spark, docs, shared):
    df = docs([(1, "a b"), (None, None), (1, "a b")]).selectExpr("*", "CAST(NULL AS boolean) AS learned")
    got = sorted(tuple(r)[1:] for r in katz.score(df, "learned", shared).collect())
    assert got == [(1, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0)]
    assert katz.score(df.filter("false"), "learned", shared).count() == 0


# --- mixture --------------------------------------------------------------------


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        rest = sum(w[s] for s in order if s not in full)
        share = {s: cap * sizes[s] if s in full else left * w[s] / rest for s in order}
        new = {s for s in order if s not in full and share[s] > cap * sizes[s]}
        if not new:
            return share
        full |= new


def test_mixture_meets_targets(spark, docs, shared):
    rng = random.Random(6)
    rows = []
    for i in range(1500):
        source = rng.choices([None, "a", "b", "c", "é", "tiny"], [5, 40, 3, 2, 8, 0.3])[0]
        rows.append((i, " ".join(["w"] * rng.randrange(60)), None, source))
    rows += [(2000, None, None, "empty"), (2001, "", None, "empty"), (5, "again " * 10, None, "a")]
    df = docs(rows)
    got = mixing.mix(df, shared).collect()
    assert len(got) == len(rows)
    source_of = {r[0]: r[3] for r in rows}
    sizes, taken, target, most = Counter(), Counter(), {}, Counter()
    for r in got:
        s = source_of[r.doc_id]
        sizes[s] += r.size
        taken[s] += r.taken
        target[s] = r.target
        most[s] = max(most[s], r.size)
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    want = brute_targets({s: sizes[s] for s in target})
    assert target == pytest.approx(want)
    assert all(abs(taken[s] - target[s]) <= most[s] for s in target)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(df.repartition(5), shared).collect()))
    rows_taken = mixing.take(df, shared).groupBy("doc_id", "text").count().collect()
    copies = {(r.doc_id, r.size): r.taken // r.size for r in got if r.size}
    assert all(copies[(r.doc_id, len(r.text.split()))] == r["count"] for r in rows_taken if r.text and r.text.split())
    assert mixing.mix(df.filter("false"), shared).count() == 0


# --- language, quality, toxicity ------------------------------------------------


def test_language_words_first_then_grams(spark, docs):
    en, de = "the house stands by the river and shines", "das haus steht am fluss und leuchtet"
    rows = [(i, en if i % 2 else de, "en" if i % 2 else "de") for i in range(40)]
    model = langid.fit(docs([*rows, (99, None, "en"), (98, "x", None), (None, "fr fr", "fr")]))
    asked = docs([(1, "the river"), (2, "das Haus"), (3, "leuchten"), (4, "shining"), (5, None), (6, "12 !?"), (7, ""), (8, LONG), (8, LONG), (None, "and")])
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(asked, model).collect()}
    assert [got[i][0] for i in (1, 2, 3, 4, None)] == ["en", "de", "de", "en", "en"]
    assert got[5] == got[6] == got[7] == ("und", 0.0) and got[8][0] == "de" and 0 <= got[8][1] <= 1
    assert langid.predict(asked.filter("false"), model).count() == 0
    nothing = langid.fit(asked.filter("false"))
    assert {r.lang_pred for r in langid.predict(asked, nothing).collect()} == {"und"}


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_on_held_out_documents(spark, docs):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdeinorst", k=rng.randrange(2, 8)))
    rows, marks = [], []
    for i in range(240):
        said = [word() for _ in range(rng.randrange(20, 80))]
        bad = i % 4 == 0
        text = " ".join(w.upper() + "!!" for w in said) if bad and i % 8 else " ".join([said[0]] * 50) if bad else " ".join(said).capitalize() + "."
        rows.append((i, text))
        marks.append((i, int(not bad), 0))
    known = labels(spark, [m for m in marks if m[0] % 5] + [(None, 1, 0), (7, None, None), (9999, 1, 0)])
    df = docs([*rows, (1000, None), (1001, ""), (1002, LONG), (1, rows[1][1]), (None, "x")])
    model = quality.fit(df, known)
    got = quality.score(df, model).collect()
    scores = {r.doc_id: r.score for r in got}
    assert len(got) == 245 and all(0 <= s <= 1 for s in scores.values()) and scores[1000] == scores[1001]
    right = sum((scores[i] >= 0.3) == bool(q) for i, q, _ in marks if i % 5 == 0)
    assert right >= 0.95 * 48
    assert {r.score for r in quality.score(df, quality.fit(df, known.filter("false"))).collect()} == {0.5}
    assert quality.score(df.filter("false"), model).count() == 0


def test_toxicity_restores_disguised_words(spark, docs):
    rng = random.Random(10)
    word = lambda: "".join(rng.choice("bdfgklmnprt") + rng.choice("aeiou") for _ in range(rng.randrange(2, 4)))
    bad = ["idiot", "loser", "moron"]
    rows, marks = [], []
    for i in range(300):
        said = [word() for _ in range(30)]
        if i % 3 == 0:
            said[rng.randrange(30)] = rng.choice(bad)
        rows.append((i, " ".join(said)))
        marks.append((i, 1, int(i % 3 == 0)))
    df = docs(rows)
    model = toxicity.fit(df, labels(spark, [*marks, (None, 1, 1), (5000, 1, 1)]))
    asked = docs([
        (1, "you 1d10t there"), (2, "an i d i o t here"), (3, "looooser!"), (4, "m0r0n"), (5, "l.o.s.e.r"), (6, "a b c d e f"), (7, None), (8, ""),
        (9, "bada kefu 2024 3com $$$ +++"), (10, LONG), (11, "IDIOT"), (11, "IDIOT"), (None, "moron"), (12, "0" * 100_000 + "a" * 100_000),
    ])
    got = {r.doc_id: r.score for r in toxicity.score(asked, model).collect()}
    assert all(got[i] >= 0.3 for i in (1, 2, 3, 4, 5, 11, None)), got
    assert all(got[i] < 0.3 for i in (6, 7, 8, 9, 10, 12)), got
    kept = toxicity.reject(asked, model, 0.3)
    assert kept.columns == asked.columns and sorted(r.doc_id for r in kept.collect()) == [6, 7, 8, 9, 10, 12]
    assert toxicity.score(asked.filter("false"), model).count() == 0
    nothing = toxicity.fit(df, labels(spark, marks).filter("false"))
    assert {r.score for r in toxicity.score(asked, nothing).collect()} == {0.5}


def test_toxic_words_that_stand_beside_others_enter_the_lexicon(spark, docs):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("bdfgklmnprt") + rng.choice("aeiou") for _ in range(rng.randrange(2, 4)))
    rows, marks = [], []
    for i in range(400):
        said = [word() for _ in range(30)]
        if i % 10 == 0:  # "clown" never without "idiot"
            said[:2] = ["idiot", "clown" if i % 20 == 0 else word()]
        rows.append((i, " ".join(said)))
        marks.append((i, 1, int(i % 10 == 0)))
    model = toxicity.fit(docs(rows), labels(spark, marks))
    got = {r.doc_id: r.score for r in toxicity.score(docs([(1, "you clown"), (2, "you idiot"), (3, "bada kefu")]), model).collect()}
    assert got[1] >= 0.3 and got[2] >= 0.3 and got[3] < 0.3, got


def test_toxicity_sees_through_doubling_spacing_and_punctuation(spark, docs):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("bdfgklmnprt") + rng.choice("aeiou") for _ in range(rng.randrange(2, 4)))
    rows, marks = [], []
    for i in range(300):
        said = [word() for _ in range(30)]
        if i % 3 == 0:
            said[rng.randrange(30)] = rng.choice(["idiot", "loser", "moron", "stupid"])
        rows.append((i, " ".join(said)))
        marks.append((i, 1, int(i % 3 == 0)))
    model = toxicity.fit(docs(rows), labels(spark, marks))
    bad = [
        "iddiot", "moronn", "stuppid", "looser", "you are a i d i o t", "s t u p i d i d i o t", "i d i o t 2 go", "i\nd\ni\no\nt", "i   d   i\to  t", "i, d, i, o, t",
        "! d 1 o t", "a 1 d 1 0 t", "i i d d i o t", "bada,idiot", "idiot/kefu", "kefu:m0r0n", "bada-idiot", "bada...moron", "1d10t,bada", "idiot!bada", "!diot",
    ]
    clean = ["a b c d e f", "bada,kefu", "b a d a", "bada/kefu:3com", "a " * 50_000, "i d " * 50_000, "1 " * 50_000, "a,b" * 50_000, "(bada) it's", "x" + " " * 100_000 + "yy"]
    got = {r.doc_id: r.score for r in toxicity.score(docs(list(enumerate([*bad, *clean]))), model).collect()}
    assert [x for i, x in enumerate(bad) if got[i] < 0.3] == []
    assert [x[:20] for i, x in enumerate(clean, len(bad)) if got[i] >= 0.3] == []


def test_decoding_finds_the_best_path():
    model = toxicity.CharacterModel({"idiot": 5, "illi": 1, "sass": 2})
    token = "1d10t"
    options = [[(c, 0.0)] if c.isalpha() else [*[(x, toxicity.READ) for x in toxicity.SIGNS[c]], ("", toxicity.LOSE)] for c in token]

    def value(path):
        state, total = "^^", 0.0
        for x, cost in path:
            total += cost + (model.step(state, x) if x else 0.0)
            state = state[1] + x if x else state
        return total + model.step(state, "$")

    best = max(itertools.product(*options), key=value)
    assert toxicity.decode(token, model) == "".join(x for x, _ in best) == "idiot"


def test_split_by_crc32_is_that_of_the_id_as_text(spark):
    from tidemark.llm.common import held_out

    df = spark.createDataFrame([(7,), (12,), (None,)], "doc_id long").select("doc_id", held_out("doc_id", 5, zlib.crc32(b"7") % 5).alias("h"))
    assert {r.doc_id: r.h for r in df.collect()} == {7: True, 12: zlib.crc32(b"12") % 5 == zlib.crc32(b"7") % 5, None: False}


def test_spelled_mail_is_the_classifiers_choice(spark, docs):
    plain = [f"write to a{i}@mail.example.com or meet at home. We go" for i in range(60)] + [f"they look at trees. Of these {i}" for i in range(60)]
    asked = [(500, "ask john at example dot com today"), (501, "ask jane (at) example.org today"), (502, "look at them. We go"), (503, "id 3627072101032238 here")]
    df = docs([*enumerate(plain), *asked])
    model = pii.fit(df)
    got = {r.doc_id: [(s.kind, s.start, s.end, s.base) for s in r.spans] for r in pii.find(df, model).collect()}
    assert got[500] == [("email", 4, 27, False)] and got[501] == [("email", 4, 25, False)]
    assert got[502] == got[503] == [] and all(got[i] == [] for i in range(60, 120))
    assert next(r.text for r in pii.mask(df, model).collect() if r.doc_id == 500) == "ask [email] today"
    votes = pii.votes("john at example dot com", 0, 23, 0)
    assert votes[:2] == (1, 1) and pii.votes("look at them.We", 0, 15, 0)[0] == 0


def test_lists_of_a_family_under_the_threshold_give_few_pairs():
    # 60 sets of 150 that share 128 (likeness 0.74), with one pair of 0.95 among them, in one list of a common shingle
    rng = np.random.default_rng(3)
    draw = lambda n: rng.integers(0, 2**64, n, dtype=np.uint64)
    common = draw(128)
    sets = [np.unique(np.r_[common, draw(22)]) for _ in range(60)]
    sets.append(np.unique(np.r_[sets[0][4:], draw(4)]))
    ids, n = np.arange(61), np.array([len(s) for s in sets])
    parts = np.stack([jaccard.parities(s) for s in sets])
    pairs = np.concatenate(jaccard.list_pairs(n, np.zeros(61, dtype=np.int64), ids, ids, 85, parts))
    assert [0, 60] in pairs[:, :2].tolist() and len(pairs) <= 20  # 1,830 with sixteenths


def test_parities_never_hide_common_shingles():
    rng = np.random.default_rng(4)
    for _ in range(500):
        a = np.unique(rng.integers(0, 2**64, rng.integers(1, 500), dtype=np.uint64))
        b = np.unique(np.r_[a[rng.integers(0, len(a) + 1) :], rng.integers(0, 2**64, rng.integers(1, 60), dtype=np.uint64)])
        most = jaccard.most_common(jaccard.parities(a)[None], jaccard.parities(b)[None], np.array([len(a) + len(b)]))
        assert len(np.intersect1d(a, b)) <= most[0]


def test_workers_keep_no_codec_between_stages(spark, docs):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    assert bpe.encode(docs([(i, f"some text {i}") for i in range(20)]).repartition(4), path, public_tokenizers.PATTERN).count() == 20

    def held(batches):
        for batch in batches:
            yield pd.DataFrame({"held": [bpe.codec_of.cache_info().currsize]})

    assert {r.held for r in spark.range(100).repartition(4).mapInPandas(held, "held long").collect()} == {0}


def test_doubled_letters_are_decided_as_by_the_decoder_without_its_lattice():
    rng = random.Random(8)
    words = ["".join(rng.choice("aeost") * rng.choice([1, 1, 2]) for _ in range(rng.randrange(1, 8))) for _ in range(3000)]
    model = toxicity.CharacterModel(Counter(words[:300]))
    words = [w for w in words if not toxicity.RUN.search(w)]
    assert [toxicity.undoubled(w, model) for w in words] == [toxicity.decode(w, model) for w in words]
    assert len({toxicity.undoubled(w, model) == w for w in words}) == 2


def test_plain_tokens_are_restored_without_the_lattice_and_texts_scanned_for_letters_apart_only_where_some_are(monkeypatch):
    def never(*_):
        raise AssertionError("decoded")

    monkeypatch.setattr(toxicity, "decode", never)
    restorer = toxicity.Restorer(toxicity.CharacterModel({"letters": 3, "leters": 1}))
    assert restorer.words("Letters, and more) tokens. A b") >= {"letters", "and", "more", "tokens", "a", "b"}
    found = {"a b c": {"abc"}, "x_y-z": {"xyz"}, "_a b c d": {"bcd"}, "\u00e9 t \u00e9": {"\u00e9t\u00e9"}, "\u201ca\u2014b\u2014c\u201d": {"abc"}, "a b cd": set(), "1, 2;\n3": {"123"}}
    assert {t: restorer.apart(t) for t in found} == found


def test_words_counted_in_parts_of_a_task_give_the_same_model(spark, docs, monkeypatch):
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("bdfgklmnprt") + rng.choice("aeiou") for _ in range(rng.randrange(2, 4)))
    rows = [(i, " ".join([word() for _ in range(20)] + ["idiot!"] * (i % 3 == 0))) for i in range(120)]
    marks = [(i, 1, int(i % 3 == 0)) for i in range(120)]
    whole = toxicity.fit(docs(rows).repartition(2), labels(spark, marks))
    monkeypatch.setattr(toxicity, "WORDS_COUNTED", 50)
    parts = toxicity.fit(docs(rows).repartition(2), labels(spark, marks))
    assert [toxicity._loaded(m)[1:3] for m in (whole,)] == [toxicity._loaded(m)[1:3] for m in (parts,)]
    assert "idiot" in toxicity._loaded(whole)[2]


def test_pairs_of_a_family_come_from_few_lists_each():
    # 40 sets of 200 with 170 in common (likeness 0.74 to 0.9): each pair meets in every list of the 170
    rng = np.random.default_rng(6)
    draw = lambda n: rng.integers(0, 2**64, n, dtype=np.uint64)
    common = draw(190)
    sets = [np.unique(np.r_[rng.permutation(common)[: rng.integers(170, 190)], draw(14)]) for _ in range(40)]
    prefix = [s[: jaccard.prefix_length(len(s), 85)] for s in sets]
    lists = {}
    for i, first in enumerate(prefix):
        for pos, token in enumerate(first.tolist()):
            before = [first[pos - k - 1].view(np.int64) if pos > k else i for k in range(jaccard.LASTS)]
            lists.setdefault(token, []).append((len(sets[i]), pos, i, *before))
    made, links = [], set()
    for rows in lists.values():
        n, pos, ids, *last = np.array(sorted(rows)).T
        made += [tuple(p[:2]) for part in jaccard.list_pairs(n, pos, ids, ids, 85, None, np.stack(last, 1)) for p in part.tolist()]
    for a, b in itertools.combinations(range(40), 2):
        if jaccard.linked(sets[a], sets[b], 85):
            links.add((a, b))
    assert links and links <= set(made) and len(made) <= 4 * len(set(made))  # in every common list: some 20 times


def test_shingle_sets_equal_those_of_words():
    rng = random.Random(14)
    pool = ["a", "B", "b", "\u00e9", "\u00c9", "x\u00a0y", "w" * 24, "w" * 25, "w" * 26, "long" * 400, "-", "0"]
    texts = ["", " \t\r\n\x0b\x0c", "one", "One two", *("  ".join(rng.choices(pool, k=rng.randrange(30))) for _ in range(200)), "\x1ca \x85b"]
    for width in (1, 4, 5):
        runs = {}
        for text, found in zip(texts, jaccard.shingle_sets(texts, width), strict=True):
            w = text.encode().lower().split()
            want = {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()
            assert len(found) == len(want) and (found[1:] > found[:-1]).all()
            runs.setdefault(frozenset(want), set()).add(found.tobytes())
        assert all(len(same) == 1 for same in runs.values()) and len(set.union(*runs.values())) == len(runs)


def test_groups_take_few_jobs_and_rows_that_repeat_are_linked_once(spark, docs, shared):
    """With many partitions each job costs a task a partition, however little it reads."""
    rng = random.Random(15)
    texts = []
    for _ in range(6):
        base = rng.choices([f"w{i}" for i in range(900)], k=60)
        for k in range(5):
            texts.append(" ".join([*base[:-1], f"end{k}"]))
    rows = [*enumerate(texts), *enumerate(texts[:9])]
    spark.sparkContext.setJobGroup("few", "groups")
    try:
        got = jaccard.groups(docs(rows), shared, 4, 85).collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    want = brute_groups(list(range(len(texts))), texts, 4, 85)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted((i, *want[i]) for i, _ in rows)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("few"))
    assert jobs < 120, jobs


def test_stars_equal_a_walk_over_the_edges(spark, shared):
    rng = random.Random(16)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [tuple(rng.sample(range(300, 420), 2)) for _ in range(90)]
    edges += [(5, 5), *edges[:40], *((b, a) for a, b in edges[20:90])]
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    want = {}
    for start in sorted(near):
        reached = [start]
        for node in reached:
            for other in near[node] if start not in want else ():
                if other not in want and other != start:
                    want[other] = start
                    reached.append(other)
    got = components.stars(spark.createDataFrame(edges, "a long, b long"), shared).collect()
    assert sorted((r.node, r.root) for r in got) == sorted(want.items())
    assert components.stars(spark.createDataFrame([], "a long, b long"), shared).count() == 0
