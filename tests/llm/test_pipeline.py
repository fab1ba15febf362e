"""The corpus pipeline stage by stage, each on its own input."""

from pathlib import Path
from urllib.parse import urlparse

import corpus_pipeline
import pandas as pd
import tiktoken
import public_tokenizers

from tidemark.llm import bpe, jaccard, pii, toxicity
from tidemark.session import Workspace, files

FOLDER = "/root/testdata/sf0.01"


def test_stages(spark):
    ws = Workspace(spark)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = ws.write(stage(spark, before, FOLDER), name)
        seen[name] = (before, docs)
        if name != "byte_bpe":
            assert docs.columns == columns

    def ids(df):
        return [r.doc_id for r in df.select("doc_id").collect()]

    before, after = seen["toxicity"]
    insults = ("idiot", "moron", "scum", "loser", "worthless", "clown", "trash", "pathetic", "stupid", "disgusting")
    held = {r.doc_id: sum(w in r.text.lower().split() for w in insults) for r in before.collect()}
    kept = set(ids(after))
    insulting, clean = {i for i, n in held.items() if n}, {i for i, n in held.items() if not n}
    assert len(insulting - kept) >= 0.6 * len(insulting) and len(clean & kept) >= 0.99 * len(clean)

    before, after = seen["near_copies"]
    texts = {r.doc_id: r.text.encode().lower().split() for r in before.collect()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in texts.items()}
    kept = set(ids(after))
    alike = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    holders = {}
    for i, found in sets.items():
        for one in found:
            holders.setdefault(one, []).append(i)
    near = {(a, b) for group in holders.values() for a in group for b in group if a < b}
    links = {pair for pair in near if alike(*pair)}
    assert not any(a in kept and b in kept for a, b in links)
    linked = {i for pair in links for i in pair}
    assert set(texts) - kept <= linked

    before, after = seen["personal_data"]
    assert sorted(ids(before)) == sorted(ids(after))
    assert all(not pii.base_spans(r.text) for r in after.collect())

    before, after = seen["mixture"]
    assert set(ids(after)) <= set(ids(before))
    copies = {i: ids(after).count(i) for i in set(ids(after))}
    assert max(copies.values()) <= 3

    before, after = seen["byte_bpe"]
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {r.doc_id: other.encode_ordinary(r.text) for r in before.collect()}
    assert all(list(r.ids) == want[r.doc_id] and r.n_tokens == len(r.ids) for r in after.collect())
    assert after.count() == before.count()


def test_stages_send_texts_in_batches_of_bounded_size(spark):
    """Workers hold one batch of whole texts at a time, of a few MB whatever the length of a text."""

    def sizes(batches):
        for batch in batches:
            yield pd.DataFrame({"size": [int(batch["text"].str.len().sum())]})

    docs = spark.range(0, 3000, 1, 1).selectExpr("id AS doc_id", "repeat('word ', 800) AS text")
    before = spark.conf.get(corpus_pipeline.BATCH_SETTING)
    try:
        stage = corpus_pipeline.in_small_batches(lambda spark, docs, folder: docs.mapInPandas(sizes, "size long"))
        seen = [r["size"] for r in stage(spark, docs, FOLDER).collect()]
    finally:
        spark.conf.set(corpus_pipeline.BATCH_SETTING, before)
    assert sum(seen) == 3000 * 4000 and max(seen) <= 2 * corpus_pipeline.BATCH_BYTES
    assert all(stage.__wrapped__ for _, stage in corpus_pipeline.STAGES)


def test_few_rows_make_few_files(spark, docs):
    """Every file is a process that the executor starts; a table of some hundred rows is no file for each shuffle partition."""

    def written(root):
        return {d.name: sum(1 for _ in d.glob("part-*")) for d in Path(urlparse(str(root)).path).iterdir()}

    settings = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    rows = [(i, " ".join(f"w{i // 3 * 100 + k}" for k in range(60)) + f" end{i % 3}") for i in range(300)]
    table = docs(rows).repartition(6)
    top = Path(urlparse(spark.conf.get("spark.checkpoint.dir")).path)
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        ws = Workspace(spark)
        kept = sorted(r.doc_id for r in jaccard.one_of_each(table, ws, 5, 80).collect())
        known = set(top.iterdir())
        toxicity.fit(table, spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, toxic int"))
        of_fit = [written(d) for d in set(top.iterdir()) - known]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert kept == list(range(0, 300, 3))
    near = written(ws.root)
    assert max(n for name, n in near.items() if not name.startswith("sets")) <= 2 and any(name.startswith("links") for name in near)
    assert [max(d.values()) for d in of_fit] == [1]


def test_files_grow_with_rows():
    assert [files(n, 1000) for n in (0, 1, 1000, 1001, 12_000_000)] == [1, 1, 1, 2, 12_000]
