"""Vector searches against brute force."""

import math

import numpy as np
import pytest

from tidemark.llm import ann, topk

SCHEMA = "vec_id long, embedding array<float>, score string, cell string"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, "x", "y") for i, v in zip(ids, vectors, strict=True)], SCHEMA)


def odd_rows():
    return [None, [], [0.0, 0.0], [1.0, None], [math.nan, 1.0], [math.inf, 1.0]]


def brute_products(vectors, ids, queries, k):
    out = {}
    whole = [[math.floor(256 * float(np.float32(x))) for x in v] for v in vectors]
    for q, vec in zip(ids, whole, strict=True):
        if q in queries:
            scored = sorted((-sum(a * b for a, b in zip(vec, w, strict=True)), i) for i, w in zip(ids, whole, strict=True) if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_products_equal_brute_force(spark, hot):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(160, 5)).astype(np.float32)
    if hot:
        vectors[:70] = vectors[0]  # ties, and one group that holds almost half of all
    df = table(spark, vectors.tolist())
    asked = [i for i in range(160) if i % 7 == 0]
    found = topk.largest_products(df, df.filter("vec_id % 7 = 0"), 5, pivots=4, query_rows=6, data_rows=20)
    assert got(found) == brute_products(vectors.tolist(), list(range(160)), asked, 5)


def test_products_far_groups_are_not_replicated_wrongly(spark):
    rng = np.random.default_rng(4)
    vectors = np.concatenate([rng.normal(size=(60, 3)) * 0.01 + c for c in ([9, 0, 0], [0, 9, 0], [0, 0, -9])]).astype(np.float32)
    df = table(spark, vectors.tolist())
    found = topk.largest_products(df, df, 3, pivots=6, query_rows=10, data_rows=16)
    assert got(found) == brute_products(vectors.tolist(), list(range(180)), range(180), 3)


def test_products_odd_rows(spark):
    df = table(spark, [*odd_rows(), [1.0, 2.0], [1.0, 2.0], [3.0, 1.0], [1.0, 2.0, 3.0]], [*range(6), 6, 7, None, 9])
    found = got(topk.largest_products(df, df, 5))
    assert found == {2: [(6, 0), (7, 0)], 6: [(7, 327680), (2, 0)], 7: [(6, 327680), (2, 0)]}
    assert got(topk.largest_products(df.filter("false"), df, 5)) == {}
    assert got(topk.largest_products(df, df.filter("false"), 5)) == {}


def test_products_repeated_rows_and_large_values(spark):
    df = table(spark, [[1.0], [2.0], [2.0], [3e18]], [1, 2, 2, 3])
    found = got(topk.largest_products(df, df.filter("vec_id = 1"), 5))
    assert [i for i, _ in found[1]] == [3, 2]
    assert topk.products(np.array([[2**62]]), np.array([[2**62], [-(2**62)]])).tolist() == [[2**63 - 1, -(2**63)]]


def test_nearest_recall_and_exact_scores(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(1500, 16)).astype(np.float32)
    vectors[:300] = vectors[0] + rng.normal(size=(300, 16)).astype(np.float32) * 0.001  # a hot bucket
    df = table(spark, vectors.tolist())
    found = got(ann.nearest(df, df.filter("vec_id % 50 = 0"), 10, block_rows=64))
    hit = 0
    for q, rows in found.items():
        far = np.sqrt(((vectors.astype(float) - vectors[q].astype(float)) ** 2).sum(1))
        best = [i for i in np.lexsort((np.arange(1500), far)) if i != q][:10]
        hit += len(set(best) & {i for i, _ in rows})
        assert all(far[i] == pytest.approx(s, abs=1e-12) for i, s in rows)
        assert rows == sorted(rows, key=lambda r: (r[1], r[0]))
    assert hit >= 0.9 * 10 * len(found)
    assert len(found) == 30


def test_nearest_odd_rows(spark):
    df = table(spark, [*odd_rows(), [1.0, 2.0], [1.0, 2.0], [1.0, 2.0], [3.0, 1.0], [1.0, 2.0, 3.0]], [*range(6), 6, 7, 7, None, 9])
    assert got(ann.nearest(df, df, 3)) == {6: [(7, 0.0)], 7: [(6, 0.0)]}
    assert got(ann.nearest(df.filter("false"), df, 3)) == {}
    assert got(ann.nearest(df, df.filter("false"), 3)) == {}


def test_probes_come_in_order_of_estimated_success():
    offsets = np.array([0.1, 0.6, 0.45])
    sets = ann.perturbations(offsets, 20)

    def cost(chosen):
        return sum((offsets[i] if step < 0 else 1 - offsets[i]) ** 2 for i, step in chosen)

    assert sets[0] == () and len(sets) == len(set(sets)) == 20
    assert [cost(s) for s in sets] == sorted(cost(s) for s in sets)


def test_nearest_serves_queries_far_from_all_others(spark):
    rng = np.random.default_rng(12)
    vectors = rng.normal(size=(600, 16))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    clusters = rng.normal(size=(300, 16)) * 0.01 + rng.normal(size=(3, 16)).repeat(100, 0) * 4
    vectors = np.concatenate([vectors, clusters])
    vectors[::90] *= np.array([1, 3, 5, 10, 50, 1, 1, 1, 1, 100])[:, None]
    rows = vectors.astype(np.float32)
    df = table(spark, rows.tolist())
    found = got(ann.nearest(df, df.filter("vec_id % 30 = 0"), 10))
    assert set(found) == {i for i in range(900) if i % 30 == 0} and all(len(f) == 10 for f in found.values())
    hits = 0
    for q, mine in found.items():
        far = np.sqrt(((rows.astype(float) - rows[q].astype(float)) ** 2).sum(1))
        want = [i for i in np.lexsort((np.arange(900), far)) if i != q][:10]
        hits += len(set(want) & {i for i, _ in mine})
        if q % 90 == 0 and np.linalg.norm(rows[q]) > 30:  # met nobody in its buckets, so it was compared with all
            assert [i for i, _ in mine] == want
    assert hits >= 0.9 * 10 * len(found)


def test_nearest_of_few_candidates_gives_all(spark):
    df = table(spark, [[1.0, 0.0], [0.0, 1.0], [5.0, 5.0], [1.0, 2.0, 3.0]])
    found = got(ann.nearest(df, df, 10))
    assert {q: len(f) for q, f in found.items()} == {0: 2, 1: 2, 2: 2} and [i for i, _ in found[2]] == [0, 1]
