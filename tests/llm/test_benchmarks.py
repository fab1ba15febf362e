"""Decontamination, ranked search and tokenizer alignment against brute force."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import align, decontaminate, search

ITEM = "item_id string, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words_of(text):
    return WORD.findall(lower(text))


@pytest.fixture(scope="session")
def items(spark):
    def build(rows):
        return spark.createDataFrame(rows, ITEM).selectExpr("*", "'clash' AS doc_id", "'clash' AS words", "'clash' AS shard")

    return build


# --- decontamination ------------------------------------------------------------


def brute_hits(texts, benchmark, window):
    runs = []
    for name, text in benchmark:
        w = words_of(text)
        n = min(window, len(w))
        runs += [(name, tuple(w[i : i + n])) for i in range(len(w) - n + 1) if n]
    out = []
    for text in texts:
        w = words_of(text)
        hit, names = set(), set()
        for name, run in set(runs):
            for i in range(len(w) - len(run) + 1):
                if tuple(w[i : i + len(run)]) == run:
                    hit |= set(range(i, i + len(run)))
                    names |= {name} - {None}
        out.append((len(w), len(hit), sorted(names)))
    return out


@pytest.mark.parametrize("limits", [{}, {"piece_words": 3, "automaton_words": 12}])
def test_decontamination_equals_brute_force(spark, shared, docs, items, limits):
    random.seed(5)
    letters = ["a", "b", "C", "é", "7"]
    benchmark = [(str(i), " ".join(random.choices(letters, k=random.choice([0, 1, 2, 3, 5, 9])))) for i in range(14)]
    benchmark += [("x", "aa bb cc dd ee ff"), ("x", "qq rr ss"), (None, "un named words here"), ("long", "k1 k2 k3 k4 k5 k1 k2 k3 k9 k8 k7 k6"), ("null", None), ("dots", "...")]
    texts = [None, "", "...", "aa-bb,CC dd", "xx aa bb cc dd ee ff yy qq rr ss", "un named words here", "k5 k1 k2 k3 k4 k1 k2 k3 k9 k8", "bb cc dd zz dd ee ff"]
    texts += ["  ".join(random.choices([*letters, "zz"], k=random.choice([1, 4, 30]))) for _ in range(60)] + ["aa bb cc dd zz " * 5000]
    df = docs([*enumerate(texts), (4, texts[4]), (None, texts[4])])
    for window in (4, 1):
        found = decontaminate.find(df, items(benchmark), shared, window, **limits).withColumn("n_hit", decontaminate.hit_words("spans")).collect()
        assert len(found) == len(texts) + 2
        of = {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in found}
        want = brute_hits(texts, benchmark, window)
        assert [of[i] for i in range(len(texts))] == want and of[None] == want[4]


def test_decontamination_without_rows(spark, shared, docs, items):
    rows = [(1, "a b c"), (2, None)]
    assert [r.n_words for r in decontaminate.find(docs(rows), items([]), shared).orderBy("doc_id").collect()] == [3, 0]
    assert decontaminate.find(docs(rows).filter("false"), items([("1", "a")]), shared).count() == 0


def test_decontamination_removes_spans(spark, shared, docs, items):
    item = " ".join(f"w{i}" for i in range(12))
    texts = {1: f"Before it: {item}! After all of it stand many other plain words that no item holds, so it stays.", 2: f"{item} end", 3: "nothing", 4: None}
    left = {r.doc_id: r for r in decontaminate.remove(docs(list(texts.items())), items([("1", item)]), shared).collect()}
    assert set(left) == {1, 3, 4} and left[4].text is None and left[3].n_hit == 0
    assert left[1].n_hit == 12 and left[1].text == texts[1].replace(item, "")


def test_longest_match(spark, shared, docs, items):
    row = decontaminate.find(docs([(1, "zz a b c d e f zz")]), items([("1", "a b c d e f g h")]), shared, 4).first()
    assert row.longest == 6 and [(s.start, s.end) for s in row.spans] == [(1, 7)]


# --- cross-tokenizer alignment --------------------------------------------------

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute_alignment(texts):
    """Whole texts through the libraries, groups by a plain merge, links by loops."""
    one = Tokenizer.from_file(PATHS[0])
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    table = {c: b for b, c in enumerate(align.byte_characters())}
    shown = []
    for text in texts:
        whole = (" " + text).encode() if text else b""
        a = one.encode(" " + text, add_special_tokens=False).ids if text else []
        b = two.encode(text) if text else []
        raw_a = [bytes(table[c] for c in one.id_to_token(i)) for i in a]
        raw_b = [bytes([int(p[3:5], 16)]) if two.is_byte(i) else p.replace("\u2581", " ").encode() for i, p in zip(b, map(two.id_to_piece, b), strict=True)]
        if not text or b"".join(raw_a) != whole or b"".join(raw_b) != whole:
            shown.append([])
            continue
        ends_a, ends_b = list(itertools.accumulate(map(len, raw_a))), list(itertools.accumulate(map(len, raw_b)))
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            k, m = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append((tuple(a[i:k]), tuple(b[j:m])))
            i, j = k, m
        shown.append(groups)
    counts = Counter(pair for groups in shown for pair in {(x, y) for g, h in groups for x in g for y in h})
    most = Counter()
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = []
    for groups in shown:
        links = [(x, y) for g, h in groups for x in g for y in h]
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((sum(len(g) for g, _ in groups), sum(len(h) for _, h in groups), len(groups), len(links), sum(counts[x] == most[x[0]] for x in links),
                    sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


ODD = [None, "", " ", "  ", "a", " a", "a ", "a  b", "it's  fine\n\n x", "a\u00a0b c", "日本語テスト 🙂🙂", "É\u0301cole \u2581 x", "\u2581", "<s> </s> <unk>", "<|endoftext|> x",
       "<0x41> \u3000 y", "x" * 3000, "ab" * 900 + " 🙂" * 300, "\t\tif x:\r\n", "don't 'll", "ﬁ Ａ\x00\x1c z", "wörd und mehr " * 2000]


@pytest.mark.parametrize("chunk", [50_000, 7])
def test_alignment_equals_brute_force(spark, shared, docs, chunk):
    random.seed(3)
    texts = ODD + ["".join(random.choices("ab thé\n'1.-🙂\u2581 \u00a0", k=60)) for _ in range(60)] + [" ".join(random.choices(["the", "token", "Zürich", "x1", "(a)"], k=20)) for _ in range(60)]
    df = docs([*enumerate(texts), (None, texts[-1])])
    rows = align.align(df, *PATHS, shared, chunk_docs=chunk, characters=500).collect()
    want = brute_alignment([*texts, texts[-1]])
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows}
    assert len(rows) == len(texts) + 1 and got[None] == want[-1]
    for i, text in enumerate(texts):
        assert got[i] == want[i], (i, text)
    assert align.align(df.filter("false"), *PATHS, shared).count() == 0


def test_pieces_of_the_merge_do_not_change_groups():
    random.seed(4)
    for _ in range(200):
        end = random.randint(1, 60)
        a, b = (np.array(sorted({*random.sample(range(1, end + 1), random.randint(0, end)), end})) for _ in range(2))
        want = [[sum(e < x for e in set(a) & set(b)) for x in side] for side in (a, b)]
        for piece in (1, 2, 3, 7, 1000):
            left, right, overlaps = align.groups_of(a, b, piece)
            assert [left.tolist(), right.tolist()] == want and overlaps == len(set(a) | set(b))


def test_wide_groups_count_as_narrow_ones():
    random.seed(6)
    p, q = (np.array(random.choices(range(1, 9), k=40)) for _ in range(2))
    a, b = (np.array(random.choices(range(5), k=int(x.sum())), dtype=np.int32) for x in (p, q))
    text = np.sort(np.array(random.choices(range(4), k=40)))
    found = [align.links_of(a, b, p, q, text, 7, most) for most in (0, 10, 1000)]
    for keys, times in found:
        assert keys.tolist() == found[0][0].tolist() and times.tolist() == found[0][1].tolist() and times.sum() == (p * q).sum()


def test_groups_cover_the_text(spark, docs):
    text = "Zwei Wörter\n 🙂 end"
    rows = {r.doc_id: r.groups for r in align.groups(docs([(1, text), (2, None), (3, "a b")]), *PATHS).collect()}
    assert rows[2] == [] and [g.start for g in rows[1]] == [0, *[g.end for g in rows[1][:-1]]] and rows[1][-1].end == len((" " + text).encode())
    assert rows[3][0].start == 0 and rows[3][-1].end == 4


# --- ranked lexical search ------------------------------------------------------


def brute_ranks(rows, benchmark, k):
    found = [(i, words_of(t)) for i, t in rows]
    found = [(i, w, Counter(w)) for i, w in found if w]
    n, total = len(found), sum(len(w) for _, w, _ in found)
    df = Counter(t for _, _, c in found for t in c)
    out = []
    for name, text in benchmark:
        scored = []
        for i, w, c in found:
            m = 100 - 25 + (25 * len(w) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t in words_of(text) if c[t])
            scored.append((-score, i is None, i or 0, i))
        out += [(name, r, x[3], -x[0]) for r, x in enumerate(sorted(x for x in scored if x[0])[:k], 1)]
    return out


@pytest.mark.parametrize("limits", [{}, {"part_docs": 16, "block": 3, "many_terms": 5}, {"part_docs": 7, "block": 1, "item_words": 20}])
def test_search_equals_brute_force(spark, shared, docs, items, limits):
    random.seed(8)
    vocabulary = [f"t{i}" for i in range(40)] + ["the", "É", "Z\u00fc9"]
    share = [1 / (i + 1) for i in range(43)]
    texts = [" ".join(random.choices(vocabulary, share, k=random.choice([1, 3, 12, 40]))) for _ in range(150)]
    rows = [*enumerate(texts), (150, None), (151, ""), (152, "-- !"), (3, texts[3]), (None, texts[5]), (153, " ".join(vocabulary) * 50)]
    benchmark = [(str(i), " ".join(random.choices(vocabulary, k=random.choice([1, 2, 6, 12])))) for i in range(12)]
    benchmark += [("twice", "t30 T30, t31"), ("null", None), ("none", "?"), ("unknown", "nowhere"), ("2", "the t1"), (None, "t9 t8")]
    got = [(r.item_id, r["rank"], r.doc_id, r.score) for r in search.rank(docs(rows), items(benchmark), shared, 7, **limits).collect()]
    key = lambda x: [(v is None, v or 0 if not isinstance(v, str) else 0, str(v)) for v in x]
    assert sorted(got, key=key) == sorted(brute_ranks(rows, benchmark, 7), key=key)


def test_search_of_empty_tables(spark, shared, docs, items):
    assert search.rank(docs([(1, "a")]).filter("false"), items([("1", "a")]), shared).count() == 0
    assert search.rank(docs([(1, "a"), (2, None)]), items([]), shared).count() == 0


def test_blocks_are_passed_over():
    """Clustered documents: most blocks cannot reach the floor, and what is skipped is never among the best."""
    rng = np.random.default_rng(9)
    sizes = np.full(4000, 12)
    topic = np.arange(4000) % 20
    term = np.concatenate([np.sort(np.r_[rng.choice(30, 4, False), 30 + 40 * t + rng.choice(40, 8, False)]) for t in topic]).astype(np.int32)
    impact = rng.integers(1, 1_000_000, len(term))
    weight = np.r_[np.full(30, 10), np.full(800, 4000)]
    part = search.build_part(np.arange(4000), sizes, term, impact, weight, 32, 300)
    part = search.Part.unpack(part.pack())
    query = search.Query(0, np.r_[0, 1, 2, 31, 32, 33, 35], weight[[0, 1, 2, 31, 32, 33, 35]])
    best, empty = search.Best(10, 1), np.zeros(len(weight), dtype=np.int64)
    looked, entered = search.search_part(part, query, best, empty)
    assert not empty.any() and 0 < entered and looked < len(part.block_at) - 1
    empty[query.terms] = query.weights
    scores = part.scores(np.arange(4000), empty)
    order = np.lexsort((np.arange(4000), -scores))[:10]
    assert best.ids.tolist() == order.tolist() and best.scores.tolist() == scores[order].tolist()


def test_index_is_built_and_searched_part_by_part():
    # a task holds one part of the index, whatever the batches, and no part is stored for another task to read whole
    rows = [(i, 2, [i % 3, 3], [1, 1]) for i in range(25)]
    batches = [pd.DataFrame(rows[a:b], columns=["doc_id", "n", "terms", "tfs"]) for a, b in ((0, 7), (7, 7), (7, 24), (24, 25))]
    found = list(search.parts(iter(batches), 25, 50, np.ones(4, dtype=np.int64), part_docs=10, block=4, many_terms=300))
    assert [len(p.ids) for p in found] == [10, 10, 5] and np.concatenate([p.ids for p in found]).tolist() == list(range(25))


def test_no_index_table_is_written(docs, items, tmp_path, shared):
    search.rank(docs([(i, f"a{i % 5} b") for i in range(50)]), items([("1", "a1 b")]), shared, 7, part_docs=8).collect()
    assert sorted(p.name.split("-")[0] for p in Path(shared.root).iterdir()) == ["found", "terms"]
