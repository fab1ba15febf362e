"""Approximate nearest neighbours by multiprobe p-stable hashing."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, mix, pack, unpack, usable_vectors
from tidemark.session import Workspace

TABLES, PROJECTIONS, WIDTH, PROBES, BLOCK_ROWS, SEED = 10, 6, 1.5, 72, 512, 7
#: Queries that meet too little in their buckets and share one pass over all rows.
CHUNK_QUERIES = 20_000


def perturbations(offsets: np.ndarray, probes: int) -> list[tuple[tuple[int, int], ...]]:
    """Sets of (projection, step) in rising order of summed squared distance to the crossed borders.

    That sum orders buckets by the estimated chance that they hold a near vector.
    ``offsets`` is the position within the bucket, 0 to 1, per projection.
    """
    steps = sorted(
        [(float(x) ** 2, i, -1) for i, x in enumerate(offsets)] + [(float(1 - x) ** 2, i, 1) for i, x in enumerate(offsets)]
    )
    found: list[tuple[tuple[int, int], ...]] = [()]
    heap = [(steps[0][0], (0,))]
    while heap and len(found) < probes:
        score, chosen = heapq.heappop(heap)
        if len({steps[j][1] for j in chosen}) == len(chosen):
            found.append(tuple((steps[j][1], steps[j][2]) for j in chosen))
        last = chosen[-1]
        if last + 1 < len(steps):
            heapq.heappush(heap, (score - steps[last][0] + steps[last + 1][0], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (score + steps[last + 1][0], (*chosen, last + 1)))
    return found


class Family:
    """The hash functions of all tables for vectors of one length."""

    def __init__(self, dim: int, scale: float, tables: int, projections: int, width: float, seed: int):
        rng = np.random.default_rng([seed, dim])
        self.tables, self.projections, self.dim = tables, projections, dim
        self.width = width * scale if scale > 0 else 1.0
        self.axes = rng.standard_normal((dim, tables * projections))
        self.shift = rng.uniform(0, 1, tables * projections)
        self.odd = rng.integers(1, 2**62, projections, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def places(self, vectors: np.ndarray) -> np.ndarray:
        """Position in bucket widths: rows x tables x projections."""
        at = np.clip(vectors @ self.axes / self.width + self.shift, -(2.0**52), 2.0**52)
        return at.reshape(len(vectors), self.tables, self.projections)

    def keys(self, cells: np.ndarray) -> np.ndarray:
        """One 64-bit key for whole cell numbers (last axis: projections); a clash only adds candidates."""
        summed = (cells.astype(np.int64).view(np.uint64) * self.odd).sum(axis=-1, dtype=np.uint64)
        return mix(summed + np.uint64(self.dim)).view(np.int64)


def _scales(rows: DataFrame) -> dict[int, float]:
    """Root of the summed variance of the components, per vector length; a row per length reaches the driver."""

    def moments(batch: pd.DataFrame) -> pd.DataFrame:
        out = []
        for dim, group in batch["vec"].groupby(batch["vec"].map(len)):
            x = np.stack(list(group))
            out += [(dim, j, len(x), float(x[:, j].sum()), float((x[:, j] ** 2).sum())) for j in range(dim)]
        return pd.DataFrame(out, columns=["dim", "j", "n", "s", "ss"])

    parts = map_batches(rows.select("vec"), moments, "dim int, j int, n long, s double, ss double")
    axes = parts.groupBy("dim", "j").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"))
    spread = F.greatest(F.col("ss") / F.col("n") - (F.col("s") / F.col("n")) ** 2, F.lit(0.0))
    return {r.dim: float(np.float32(r.v)) ** 0.5 for r in axes.groupBy("dim").agg(F.sum(spread).alias("v")).collect()}


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding", tables: int = TABLES,
    projections: int = PROJECTIONS, width: float = WIDTH, probes: int = PROBES, block_rows: int = BLOCK_ROWS, seed: int = SEED,
) -> DataFrame:
    """The ``k`` nearest found by Euclidean distance: query_id, rank, vec_id, score.

    Every row is put in one bucket of each table. A query visits ``probes`` buckets
    of each table, in order of estimated success; what it meets in any table is
    measured exactly and merged. Buckets are split in blocks of about ``block_rows``
    rows, and a query goes to every block, so no task holds a whole hot bucket.

    Null or empty vectors, vectors that are all zero or hold a null or non-finite
    component, and rows without an id take no part, as query or as candidate. Vectors
    of different lengths never meet. Ties go to the smaller id. Rows that repeat an id
    count once, with the smallest distance; a query's own id is never its candidate.
    A query that meets fewer than ``k`` candidates in its buckets, as one far from all others may, is compared with all rows
    in blocks; so it has fewer rows only where there are fewer candidates. Empty tables give no rows.
    """
    ws = Workspace(vectors.sparkSession)
    base = usable_vectors(vectors, id_col, vec_col, zero_too=False)
    asked = usable_vectors(queries, id_col, vec_col, zero_too=False)
    scales = _scales(base)

    def families() -> dict[int, Family]:
        return {d: Family(d, s, tables, projections, width, seed) for d, s in scales.items()}

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        family = families()
        for batch in batches:
            for dim, group in batch.groupby(batch["vec"].map(len)):
                x = np.stack(list(group["vec"]))
                keys = family[dim].keys(np.floor(family[dim].places(x)))
                yield pd.DataFrame({
                    "t": np.tile(np.arange(tables, dtype=np.int32), len(x)), "bucket": keys.ravel(),
                    "id": np.repeat(group["vec_id"].to_numpy(), tables), "vec": np.repeat(np.array(pack(x), dtype=object), tables),
                })

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        family = families()
        for batch in batches:
            for dim, group in batch.groupby(batch["vec"].map(len)):
                if dim not in family:
                    continue
                x, f = np.stack(list(group["vec"])), family[dim]
                at = f.places(x)
                cells = np.floor(at)
                for i, (vec_id, blob) in enumerate(zip(group["vec_id"], pack(x), strict=True)):
                    seen = []
                    for t in range(tables):
                        moved = []
                        for change in perturbations(at[i, t] - cells[i, t], probes):
                            cell = cells[i, t].copy()
                            for p, step in change:
                                cell[p] += step
                            moved.append(cell)
                        seen.append((np.full(len(moved), t, dtype=np.int32), f.keys(np.array(moved))))
                    t, keys = (np.concatenate(part) for part in zip(*seen, strict=True))
                    yield pd.DataFrame({"t": t, "bucket": keys, "id": vec_id, "vec": [blob] * len(t)})

    schema = "t int, bucket long, id long, vec binary"
    index = base.mapInPandas(place, schema)
    probed = asked.mapInPandas(visit, schema)
    blocks = index.groupBy("t", "bucket").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    stored = index.join(blocks, ["t", "bucket"]).withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    sent = probed.join(blocks, ["t", "bucket"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    columns = ["t", "bucket", "block", "asks", "id", "vec"]
    met = stored.withColumn("asks", F.lit(False)).select(columns).unionByName(sent.withColumn("asks", F.lit(True)).select(columns))
    met = met.repartition("t", "bucket", "block").sortWithinPartitions("t", "bucket", "block", "asks")

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, ids, rows = None, [], []  # the block now held: its key, ids and vectors; queries of it follow in any number
        for batch in batches:
            out = []
            for key, group in batch.groupby(["t", "bucket", "block"], sort=False):
                if key != held:
                    held, ids, rows = key, [], []
                own = group[~group["asks"]]
                if len(own):
                    ids.append(own["id"].to_numpy())
                    rows.append(unpack(own["vec"]))
                asks = group[group["asks"]]
                if not len(asks) or not ids:
                    continue
                ids, rows = [np.concatenate(ids)], [np.concatenate(rows)]
                for q, x in zip(asks["id"], unpack(asks["vec"]), strict=True):
                    far = np.sqrt(((rows[0] - x) ** 2).sum(axis=1))
                    order = np.lexsort((ids[0], far))
                    order = order[ids[0][order] != q]
                    # an id that repeats may fill places, so go on until k ids are met
                    _, first = np.unique(ids[0][order], return_index=True)
                    order = order[np.sort(first)[:k]]
                    out.append((np.full(len(order), q), ids[0][order], far[order]))
            if out:
                q, v, s = (np.concatenate(part) for part in zip(*out, strict=True))
                yield pd.DataFrame({"query_id": q, "vec_id": v, "score": s})

    measured = "query_id long, vec_id long, score double"

    def best(found: DataFrame) -> DataFrame:
        merged = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy("score", "vec_id")
        ranked = merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        return ranked.select("query_id", "rank", "vec_id", "score")

    ranked = ws.write(best(met.mapInPandas(measure, measured)), "nearest")
    served = ranked.groupBy("query_id").count().filter(F.col("count") >= k).select(F.col("query_id").alias("vec_id"))
    short = ws.write(asked.join(served, "vec_id", "left_anti"), "short")
    waiting = short.count()
    if not waiting:
        return ranked
    # each chunk of such queries meets one copy of the table, block by block
    chunks = -(-waiting // CHUNK_QUERIES)
    packed = "id long, bucket long, vec binary"

    def flat(batch: pd.DataFrame) -> pd.DataFrame:
        blobs = [np.asarray(v, dtype=np.float64).tobytes() for v in batch["vec"]]
        return pd.DataFrame({"id": batch["vec_id"], "bucket": [len(v) for v in batch["vec"]], "vec": blobs})

    rows, calls = map_batches(base, flat, packed), map_batches(short, flat, packed)
    blocks = rows.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / (8 * block_rows)).cast("int").alias("blocks"))
    stored = rows.join(blocks, "bucket").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    stored = stored.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).withColumn("asks", F.lit(False))
    sent = calls.join(blocks, "bucket").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sent = sent.withColumn("t", F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int")).withColumn("asks", F.lit(True))
    met = stored.select(columns).unionByName(sent.select(columns))
    met = met.repartition("t", "bucket", "block").sortWithinPartitions("t", "bucket", "block", "asks")
    return best(ranked.select("query_id", "vec_id", "score").unionByName(met.mapInPandas(measure, measured)))
