"""The registered queries on a small folder, against plain Python, and odd rows through the pipeline's stages."""

import hashlib
import math
import random
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tidemark.llm import bpe, jaccard, langid, pii, quality, toxicity

FOLDER = "/root/testdata/sf0.001"


def held(doc_id, modulus, remains):
    return zlib.crc32(str(doc_id).encode()) % modulus == remains


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def run(spark):
    import __spark_entry__ as contract

    return lambda name: [r.asDict() for r in contract.queries()[name](spark, FOLDER).collect()]


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def vectors(spark):
    return {r.vec_id: np.array(r.embedding, dtype=float) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()}


@pytest.mark.parametrize("name, modulus, remains", [("op3_quality", 5, 0), ("op9_toxicity", 4, 2)])
def test_scores_are_whole_and_held_out_rows_named(run, texts, name, modulus, remains):
    rows = run(name)
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        assert r["held_out"] == held(r["doc_id"], modulus, remains) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_language_query(run, texts):
    rows = run("op6_language")
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        letters = any(c.isalpha() for c in texts[r["doc_id"]] or "")
        assert r["held_out"] == held(r["doc_id"], 4, 2) and 0 <= r["score"] <= 1 and (r["lang_pred"] == "und") == (not letters)


def test_nearest_query_gives_ten_true_distances(run, vectors):
    rows = run("op1_nearest_neighbours")
    found = {}
    for r in rows:
        found.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
        assert math.isclose(r["score"], float(np.linalg.norm(vectors[r["query_id"]] - vectors[r["vec_id"]])), rel_tol=1e-9, abs_tol=1e-9)
    assert set(found) == {i for i in vectors if i % 100 == 0}
    for mine in found.values():
        mine.sort()
        assert [x[0] for x in mine] == list(range(1, 11)) and [x[1:] for x in mine] == sorted(x[1:] for x in mine)


def test_top_products_query(run, vectors):
    whole = {i: np.floor(256 * v).astype(np.int64) for i, v in vectors.items()}
    found = {}
    for r in run("op2_top_products"):
        found.setdefault(r["query_id"], []).append((r["rank"], -r["score"], r["vec_id"]))
    assert set(found) == {i for i in whole if i % 50 == 0}
    for i, mine in found.items():
        want = sorted((-int(whole[i] @ v), j) for j, v in whole.items() if j != i)[:5]
        assert sorted(mine) == [(k, *pair) for k, pair in enumerate(want, 1)]


def test_personal_data_query(run, texts):
    for r in run("op4_personal_data"):
        spans = [(pii.KINDS[k], a, b) for a, b, k in pii.base_spans(texts[r["doc_id"]] or "")]
        assert r["base_sha256"] == sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans))
        counts = Counter(k for k, _, _ in spans)
        assert [r[f"n_{k}"] for k in pii.KINDS] == [counts[k] for k in pii.KINDS]


def test_byte_bpe_query(run, texts):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in run("op5_byte_bpe"):
        ids = other.encode_ordinary(texts[r["doc_id"]] or "")
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(",".join(map(str, ids))), sha(texts[r["doc_id"]] or ""))


def test_language_model_query(run, texts):
    words = {i: (t or "").encode().lower().split() for i, t in texts.items()}
    counts = Counter(w for i, ws in words.items() if not held(i, 5, 1) for w in [*ws, None])
    total, distinct = sum(counts.values()), len(counts)
    for r in run("op10_language_model"):
        tokens = [*words[r["doc_id"]], None]
        base = math.fsum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(r["doc_id"], 5, 1), len(tokens), sum(w in counts for w in tokens), total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and r["score"] <= 0


def test_alignment_query(run, texts):
    """op13_alignment against the libraries over whole texts; the groups themselves are tested in test_benchmarks."""
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = run("op13_alignment")
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        text = texts[r["doc_id"]]
        if r["n_a"]:
            assert (r["n_a"], r["n_b"]) == (len(one.encode(" " + text, add_special_tokens=False).ids), len(two.encode(text)))
        else:
            assert (r["n_b"], r["n_groups"], r["n_links"], r["groups_sha256"]) == (0, 0, 0, "")


# --- plain second versions of the classifiers ------------------------------------


def test_quality_vote_equals_a_plain_vote(spark, docs):
    random.seed(11)
    rows = [(i, " ".join(random.choices(["alpha", "Beta", "###", "1.", "ok"], k=random.randint(1, 30)))) for i in range(60)] + [(60, None)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, quality int")
    model = quality.fit(docs(rows), labels)
    idf, basis, z, y = quality._space(model)
    for r in quality.score(docs(rows), model).collect():
        text = dict(rows)[r.doc_id] or ""
        x = quality.weigh(quality.terms(text).astype(float)[None], idf)[0] @ basis
        size = np.linalg.norm(x)
        cosine = [float(x @ v) / size if size else 0.0 for v in z]
        k = min(quality.NEIGHBOURS, len(y))
        cut = sorted(cosine, reverse=True)[k - 1]
        low = high = None
        sure = [i for i, c in enumerate(cosine) if c > cut + 1e-9]
        ties = [i for i, c in enumerate(cosine) if abs(c - cut) <= 1e-9]
        if len(sure) + len(ties) == k:  # otherwise any of the ties may vote
            w = {i: max(cosine[i], 0.0) ** quality.SHARPNESS for i in [*sure, *ties]}
            total = sum(w.values())
            low = sum(w[i] * y[i] for i in w) / total if total else float(y.mean())
            high = low
        if low is not None:
            assert low - 1e-6 <= r.score <= high + 1e-6


def test_language_backs_off_from_words_to_grams(spark, docs):
    english, german = "the house and the garden are green", "das haus und der garten sind grün"
    learned = docs([(i, english, "en") for i in range(4)] + [(10 + i, german, "de") for i in range(4)], extra=False)
    model = langid.fit(learned)
    asked = {1: ("the house", "en"), 2: ("das haus", "de"), 3: ("grünes gartenhaus", "de"), 4: ("green gardening", "en"), 5: ("123 !", "und"), 6: (None, "und")}
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs([(i, t) for i, (t, _) in asked.items()]), model).collect()}
    assert got == {i: want for i, (_, want) in asked.items()}


def test_toxic_score_is_the_sum_of_its_words(spark, docs):
    rows = [(i, f"you are an idiot number {i}") for i in range(40)] + [(100 + i, f"have a nice day number {i}") for i in range(160)]
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs(rows), labels)
    _, base, weights, _ = toxicity._loaded(model)
    assert "idiot" in weights
    asked = {1: ("such an idiot", {"idiot"}), 2: ("an 1d10t here", {"idiot"}), 3: ("a nice day", set()), 4: (None, set())}
    for r in toxicity.score(docs([(i, t) for i, (t, _) in asked.items()]), model).collect():
        words = asked[r.doc_id][1] | ({w for w in (asked[r.doc_id][0] or "").split() if w in weights})
        assert math.isclose(r.score, 1 / (1 + math.exp(-(base + sum(weights[w] for w in words)))), rel_tol=1e-9)


def test_toxic_words_count_in_every_labelled_document(spark):
    # eight words of five toxic documents each, dealt over more documents than any bounded sample would hold
    clean = spark.range(30_000).selectExpr("id AS doc_id", "'a nice day to you all' AS text", "0 AS toxic")
    bad = ["idiot", "loser", "moron", "jerk", "clown", "twerp", "dunce", "prick"]
    rows = [(40_000 + i, f"you {bad[i % 8]}", 1) for i in range(40)]
    known = clean.unionByName(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    _, _, weights, _ = toxicity._loaded(toxicity.fit(known.select("doc_id", "text"), known.select("doc_id", "toxic")))
    assert set(bad) <= set(weights)
    assert len({weights[w] for w in bad}) == 1 and "nice" not in weights


# --- samples, copies and empty evidence -----------------------------------------


def test_samples_are_never_empty(spark):
    for n in (10**6, 20 * 10**9, 10**14):
        share = (langid.hash_limit(3_000, n) + 2**63) / 2**64
        assert math.isclose(share, 3_000 / n, rel_tol=1e-6)
    rows = spark.range(30_000).selectExpr("id AS doc_id", "if(id % 1000 = 0, 'rare', 'common') AS lang")
    kept = {r.lang: r["count"] for r in langid.sample(rows, 3_000, "lang", 25).groupBy("lang").count().collect()}
    assert 10 <= kept["rare"] <= 30 and 2_700 <= kept["common"] <= 3_300
    assert langid.sample(rows, 30_000, "lang").count() == 30_000 and langid.sample(rows.filter("false"), 10, "lang").count() == 0


def test_one_of_each_tells_texts_of_an_id_apart(spark, shared, docs):
    one, two = "a b c d e f g h i j k l", "m n o p q r s t u v w x"
    rows = [(5, one), (7, one), (7, two), (7, two), (8, None), (8, ""), (8, "words here"), (None, one), (9, one + " y")]
    for parts in (1, 3):
        kept = jaccard.one_of_each(docs(rows).repartition(parts), shared, 5, 80)
        assert kept.columns == docs(rows).columns
        got = sorted(((r.doc_id, r.text or "") for r in kept.collect()), key=str)
        assert got == sorted([(5, one), (7, two), (8, ""), (8, "words here"), (None, one)], key=str)
    assert jaccard.one_of_each(docs(rows).filter("false"), shared, 5, 80).count() == 0


def test_without_labels_the_pipeline_keeps_every_document(spark, docs, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = [(1, "plain words"), (2, None), (2, "twice"), (None, "no id")]
    assert corpus_pipeline.without_toxic(spark, docs(rows), str(tmp_path)).count() == 4


def test_stages_take_odd_rows(spark, docs):
    """Null and empty texts, repeated rows, null ids, long texts and clashing columns through all stages."""
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "Mail me: a@b.co " * 3000, "en", None), (3, "Mail me: a@b.co " * 3000, "en", None),
            (4, "some words that stand alone in here", None, "b"), (None, "no id but words", "de", "b")]
    now = docs(rows)
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, FOLDER)
        assert now.columns == docs(rows).columns or name == "byte_bpe"
        now = spark.createDataFrame(now.collect(), now.schema)
    assert {r.doc_id for r in now.collect()} <= {1, 2, 3, 4, None} and now.count() >= 1


def test_quality_that_shows_in_words_alone_is_learned(spark, docs):
    random.seed(12)
    good, bad = (["".join(random.choices("abcdefgh", k=5)) for _ in range(60)] for _ in range(2))
    rows = [(i, " ".join(random.choices(good if i % 2 else bad, k=30))) for i in range(300)]  # same letters, lengths and shapes
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality.score(docs(rows), quality.fit(docs(rows), labels)).collect()}
    assert sum((got[i] >= 0.5) == bool(i % 2) for i in range(200, 300)) >= 95
    assert not np.array_equal(quality.terms("the cat sat"), quality.terms("you dog ran"))


def test_axes_are_the_same_from_either_side():
    rng = np.random.default_rng(3)
    tall = rng.normal(size=(40, 12))
    a, b = quality.axes(tall, 4), quality.axes(np.vstack([tall[:8], tall[:3]]), 4)
    assert a.shape == (12, 4) and b.shape == (12, 4)
    for x, basis in ((tall, a), (np.vstack([tall[:8], tall[:3]]), b)):
        np.testing.assert_allclose(basis.T @ basis, np.eye(4), atol=1e-8)
        np.testing.assert_allclose(abs(np.linalg.svd(x, full_matrices=False)[2][:4] @ basis).diagonal(), 1, atol=1e-6)
    assert quality.axes(np.zeros((3, 5)), 2).shape[0] == 5


def test_terms_survive_the_way_to_the_driver():
    said = ["", "a", "Some words, some MORE words!", "é" * 500, "x " * 3000]
    np.testing.assert_array_equal(quality.unpacked([quality.packed(t) for t in said]), np.stack([quality.terms(t) for t in said]))
