"""The queries of this subpackage and the SQL of those that SQL can say."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import align, ann, bpe, decontaminate, jaccard, katz, langid, mixing, pii, quality, search, topk, toxicity
from tidemark.llm.common import held_out, remainder, table
from tidemark.session import Workspace

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return ann.nearest(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


def op2_top_products(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return topk.largest_products(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").filter(remainder("doc_id", 5) != 0)
    scored = quality.score(docs, quality.fit(docs, labels))
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = pii.find(docs, pii.fit(docs))
    own = F.filter("spans", lambda s: s["base"])
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    kinds = F.transform(own, lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, k)).alias(k) for k in pii.KINDS]
    counts = [(F.size(kinds) - n).cast("long").alias(f"n_{kind}") for n, kind in zip(counts, pii.KINDS, strict=True)]
    return found.select("doc_id", *counts, F.sha2(shown(own), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = langid.fit(docs.filter(remainder("doc_id", 4) != 2))
    return langid.predict(docs, model).select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def op7_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.groups(table(spark, folder, "documents"), Workspace(spark), width=4, percent=85)


def op8_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"), Workspace(spark))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").filter(remainder("doc_id", 4) != 2)
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_language_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = held_out("doc_id", 5, 1)
    learning = docs.select("doc_id", "text", (F.col("doc_id").isNotNull() & ~held).alias("learned"))
    return katz.score(learning, "learned", Workspace(spark)).withColumn("held_out", held)


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.rank(table(spark, folder, "documents"), table(spark, folder, "benchmark"), Workspace(spark), k=20)


def op12_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find(table(spark, folder, "documents"), table(spark, folder, "benchmark"), Workspace(spark))
    hit = decontaminate.hit_words("spans")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    sides = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align.align(table(spark, folder, "documents"), *sides, Workspace(spark))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


TOP_PRODUCTS_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256.0 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.w, d.w), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id AND len(q.w) = len(d.w) WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

MIXTURE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5.0, 2.0, 1.0][1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER)] AS w
  FROM d GROUP BY source
), fill AS (  -- the excess over a cap is reshared by weight until no source is above its cap
  SELECT 0 AS step, source, source_size, w, false AS full_,
         (SELECT sum(source_size) FROM s) * w / (SELECT sum(w) FROM s) AS share FROM s
  UNION ALL
  SELECT step + 1, source, source_size, w, full_ OR share >= 3 * source_size,
         CASE WHEN full_ OR share >= 3 * source_size THEN 3.0 * source_size
              ELSE (sum(source_size) OVER () - sum(CASE WHEN full_ OR share >= 3 * source_size THEN 3.0 * source_size ELSE 0 END) OVER ())
                   * w / sum(CASE WHEN full_ OR share >= 3 * source_size THEN 0 ELSE w END) OVER () END
  FROM fill WHERE step < (SELECT count(*) FROM s)
), t AS (
  SELECT source, source_size, CAST(share AS DOUBLE) AS target,
         CASE WHEN source_size > 0 THEN floor(share / source_size) ELSE 0 END AS rounds
  FROM fill WHERE step = (SELECT max(step) FROM fill)
), b AS (
  SELECT source, h, sum(size) AS n, sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS upto FROM d GROUP BY source, h
)
SELECT d.doc_id, d.size, t.source_size, t.target,
       CAST(d.size * (t.rounds + CASE
         WHEN b.upto <= t.target - t.rounds * t.source_size THEN 1
         WHEN b.upto - b.n > t.target - t.rounds * t.source_size THEN 0
         WHEN b.upto - (t.target - t.rounds * t.source_size) < (t.target - t.rounds * t.source_size) - (b.upto - b.n) THEN 1
         ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
JOIN b ON d.source IS NOT DISTINCT FROM b.source AND d.h = b.h
"""

JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS shingles FROM w
), k AS (
  SELECT min(doc_id) AS doc_id, shingles, len(shingles) AS n FROM s WHERE len(shingles) > 0 GROUP BY shingles, len(shingles)
), e AS (
  SELECT doc_id, n, unnest(shingles) AS shingle FROM k
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c
  FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
), l AS (
  SELECT a, b FROM common WHERE 100 * c >= 85 * (na + nb - c)
  UNION ALL SELECT b, a FROM common WHERE 100 * c >= 85 * (na + nb - c)
  UNION ALL SELECT s.doc_id, k.doc_id FROM s JOIN k ON list_sort(s.shingles) = list_sort(k.shingles) AND s.doc_id <> k.doc_id
  UNION ALL SELECT k.doc_id, s.doc_id FROM s JOIN k ON list_sort(s.shingles) = list_sort(k.shingles) AND s.doc_id <> k.doc_id
), r AS (
  SELECT doc_id, doc_id AS reached FROM s UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.reached = l.a
)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, min(r.reached) AS component_id
FROM s JOIN r ON s.doc_id = r.doc_id GROUP BY s.doc_id, len(s.shingles)
"""

RANKED_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS terms FROM documents
), i AS (
  SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS terms FROM benchmark
), total AS (
  SELECT count(*) AS n, CAST(sum(len(terms)) AS BIGINT) AS l FROM d WHERE len(terms) > 0
), tf AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * n + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total
), q AS (
  SELECT q, item_id, term, count(*) AS repeats FROM (SELECT q, item_id, unnest(terms) AS term FROM i) GROUP BY q, item_id, term
), scored AS (
  SELECT q.q, q.item_id, d.doc_id, CAST(sum(q.repeats * w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * (75 + (25 * len(d.terms) * total.n) // total.l)))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN d USING (r), total GROUP BY q.q, q.item_id, d.r, d.doc_id
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""

DECONTAMINATION_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), w AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n, unnest(list_transform(range(1, greatest(len(words) - 9, 1) + 1),
                                                                             lambda k: array_to_string(words[k:k + 9], ' '))) AS run
  FROM i WHERE len(words) > 0
), sizes AS (
  SELECT DISTINCT n FROM w
), p AS (
  SELECT r, n, unnest(range(1, len(words) - n + 2)) AS k FROM d, sizes WHERE len(words) >= n
), o AS (
  SELECT p.r, p.k, p.n, w.item_id FROM p JOIN d ON p.r = d.r JOIN w ON w.n = p.n AND w.run = array_to_string(d.words[p.k:p.k + p.n - 1], ' ')
), hits AS (
  SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS k FROM (SELECT DISTINCT r, k, n FROM o)) GROUP BY r
), named AS (
  SELECT r, count(DISTINCT item_id) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS listed
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM o) GROUP BY r
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits ON hits.r = d.r LEFT JOIN named ON named.r = d.r
"""

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_nearest_neighbours": (op1_nearest_neighbours, None),
    "op2_top_products": (op2_top_products, TOP_PRODUCTS_SQL),
    "op3_quality": (op3_quality, None),
    "op4_personal_data": (op4_personal_data, None),
    "op5_byte_bpe": (op5_byte_bpe, None),
    "op6_language": (op6_language, None),
    "op7_ngram_jaccard": (op7_ngram_jaccard, JACCARD_SQL),
    "op8_mixture": (op8_mixture, MIXTURE_SQL),
    "op9_toxicity": (op9_toxicity, None),
    "op10_language_model": (op10_language_model, None),
    "op11_ranked_search": (op11_ranked_search, RANKED_SQL),
    "op12_decontamination": (op12_decontamination, DECONTAMINATION_SQL),
    "op13_alignment": (op13_alignment, None),
    "pipeline": (pipeline, None),
}
