"""Exact top-k inner-product search as a Voronoi kNN join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, pack, unpack, usable_vectors

PIVOTS, QUERY_ROWS, DATA_ROWS, SLACK = 12, 1024, 2048, 1e-6


def products(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Whole inner products without rounding or overflow; beyond 64 bits they stop at the limits of long."""
    top = max(1, np.abs(queries.astype(float)).max()) * max(1, np.abs(data.astype(float)).max()) * data.shape[1]
    if top < 2.0**53:
        return (queries.astype(float) @ data.astype(float).T).astype(np.int64)
    if top < 2.0**62:
        return queries @ data.T
    exact = queries.astype(object) @ data.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def _distances(x: np.ndarray, lift: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean distances after each row got its lifting component."""
    full = np.hstack([x.astype(float), lift[:, None]])
    square = (full**2).sum(1)[:, None] + (points**2).sum(1)[None] - 2 * full @ points.T
    return np.sqrt(np.maximum(square, 0))


def largest_products(
    vectors: DataFrame, queries: DataFrame, k: int, factor: int = 256, id_col: str = "vec_id", vec_col: str = "embedding",
    pivots: int = PIVOTS, query_rows: int = QUERY_ROWS, data_rows: int = DATA_ROWS,
) -> DataFrame:
    """The ``k`` largest inner products of floor(factor * x): query_id, rank, vec_id, score. Exact.

    A lifting component sqrt(M - |x|^2) makes the largest product the smallest
    distance. Data and queries are grouped by their nearest pivot; a summary of each data
    group (its smallest pivot distances) gives every query group an upper bound of its
    k-th distance; a row is replicated to a query group only if the triangle inequality
    lets it be that near. Each group is solved in blocks of about ``query_rows`` x
    ``data_rows``, so a group that holds most rows is spread over many tasks. The
    ``pivots`` rows (fixed number, lowest hashes) and their summaries reach the driver.

    Null or empty vectors, those with null or non-finite components, and rows without an
    id take no part. Vectors of different lengths never meet. Ties go to the smaller id;
    a repeated id counts once, with its highest score; a query's own id is no candidate.
    Empty tables give no rows. Scores beyond 64 bits stop at the limits of long.
    """

    def whole(df: DataFrame) -> DataFrame:
        ints = F.transform("vec", lambda x: F.floor(x * float(factor)))
        return usable_vectors(df, id_col, vec_col, zero_too=True).select("vec_id", ints.alias("vec"))

    data, asked = whole(vectors), whole(queries)
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    tops = data.groupBy(F.size("vec").alias("dim")).agg(F.max(square).alias("top")).collect()  # a row per vector length
    top = {r.dim: r.top for r in tops}
    lowest = Window.partitionBy("dim").orderBy("h", "vec_id")
    picked = (
        data.select(F.size("vec").alias("dim"), F.xxhash64("vec_id").alias("h"), "vec_id", "vec")
        .withColumn("i", F.row_number().over(lowest)).filter(F.col("i") <= pivots).collect()
    )
    points: dict[int, np.ndarray] = {}
    for dim in top:
        x = np.array(sorted({tuple(r.vec) for r in picked if r.dim == dim}), dtype=float)
        points[dim] = np.hstack([x, np.sqrt(np.maximum(top[dim] - (x**2).sum(1), 0))[:, None]])

    def assign(lifted: bool):
        def run(batch: pd.DataFrame) -> pd.DataFrame:
            out = []
            for dim, group in batch.groupby(batch["vec"].map(len)):
                if dim not in points:
                    continue
                x = np.stack(list(group["vec"])).astype(np.int64)
                rest = top[dim] - (x.astype(float) ** 2).sum(1) if lifted else np.zeros(len(x))
                far = _distances(x, np.sqrt(np.maximum(rest, 0)), points[dim])
                cell = far.argmin(1)
                out.append(pd.DataFrame({
                    "dim": np.int32(dim), "cell": cell.astype(np.int32), "far": far[np.arange(len(x)), cell],
                    "vec_id": group["vec_id"].to_numpy(), "vec": pack(x), "all_far": list(far),
                }))
            return pd.concat(out) if out else pd.DataFrame(columns=["dim", "cell", "far", "vec_id", "vec", "all_far"])

        return run

    schema = "dim int, cell int, far double, vec_id long, vec binary, all_far array<double>"
    placed = map_batches(data, assign(True), schema)
    askers = map_batches(asked, assign(False), schema).drop("all_far")

    near = Window.partitionBy("dim", "cell").orderBy("far")
    summary = (  # distances of the k + 1 rows nearest to each pivot; one of them may be the query itself
        placed.select("dim", "cell", "far", "vec_id").groupBy("dim", "cell", "vec_id").agg(F.min("far").alias("far"))
        .withColumn("i", F.row_number().over(near)).filter(F.col("i") <= k + 1).collect()
    )
    groups = askers.groupBy("dim", "cell").agg(F.max("far").alias("reach"), F.count(F.lit(1)).alias("n")).collect()
    sizes = {r.dim: r.n for r in data.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()}
    bounds: dict[int, list[tuple[int, float, int]]] = {}
    for g in groups:
        between = np.sqrt(((points[g.dim] - points[g.dim][g.cell]) ** 2).sum(1))
        upper = sorted(g.reach + between[s.cell] + s.far for s in summary if s.dim == g.dim)
        kth = upper[k] if len(upper) > k else float("inf")
        limit = (kth + g.reach) * (1 + SLACK) + SLACK
        bounds.setdefault(g.dim, []).append((g.cell, limit, -(-g.n // query_rows)))

    def replicate(batch: pd.DataFrame) -> pd.DataFrame:
        out = []
        for dim, group in batch.groupby("dim"):
            far = np.stack(list(group["all_far"]))
            for cell, limit, parts in bounds.get(dim, []):
                need = group[far[:, cell] <= limit]
                for part in range(parts):
                    out.append(need[["dim", "vec_id", "vec"]].assign(cell=np.int32(cell), part=np.int32(part)))
        columns = ["dim", "cell", "part", "vec_id", "vec"]
        return pd.concat(out)[columns] if out else pd.DataFrame(columns=columns)

    def fixed(values: dict[tuple[int, int], int] | dict[int, int], key) -> F.Column:
        chosen = F.lit(1)
        for at, value in values.items():
            chosen = F.when(key(at), F.lit(value)).otherwise(chosen)
        return chosen

    parts = {(dim, cell): n for dim, cells in bounds.items() for cell, _, n in cells}
    blocks = {dim: -(-n // data_rows) for dim, n in sizes.items()}
    split = fixed(blocks, lambda dim: F.col("dim") == dim)
    copies = map_batches(placed, replicate, "dim int, cell int, part int, vec_id long, vec binary")
    copies = copies.withColumn("block", F.pmod(F.xxhash64("vec_id"), split).cast("int"))
    spread = fixed(parts, lambda at: (F.col("dim") == at[0]) & (F.col("cell") == at[1]))
    sent = (
        askers.withColumn("part", F.pmod(F.xxhash64("vec_id"), spread).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), split - 1)))
    )
    columns = ["dim", "cell", "part", "block", "asks", "vec_id", "vec"]
    met = copies.withColumn("asks", F.lit(False)).select(columns).unionByName(sent.withColumn("asks", F.lit(True)).select(columns))
    met = met.repartition(*columns[:4]).sortWithinPartitions(*columns[:5])

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, ids, rows = None, [], []
        for batch in batches:
            out = []
            for key, group in batch.groupby(columns[:4], sort=False):
                if key != held:
                    held, ids, rows = key, [], []
                own, asks = group[~group["asks"]], group[group["asks"]]
                if len(own):
                    ids.append(own["vec_id"].to_numpy())
                    rows.append(unpack(own["vec"], np.int64))
                if not len(asks) or not ids:
                    continue
                ids, rows = [np.concatenate(ids)], [np.concatenate(rows)]
                scores = products(unpack(asks["vec"], np.int64), rows[0])
                for q, s in zip(asks["vec_id"], scores, strict=True):
                    # all that tie with the last place are ordered by id before the cut; repeated ids take one place
                    spare = min(len(s), k + 1 + int((ids[0] == q).sum()))
                    while True:
                        least = np.partition(s, len(s) - spare)[len(s) - spare]
                        near_by = np.flatnonzero(s >= least)
                        order = near_by[np.lexsort((ids[0][near_by], ~s[near_by]))]
                        order = order[ids[0][order] != q]
                        if spare == len(s) or len(np.unique(ids[0][order])) >= k:
                            break
                        spare = min(len(s), spare * 2)
                    out.append(pd.DataFrame({"query_id": q, "vec_id": ids[0][order], "score": s[order]}).drop_duplicates("vec_id").head(k))
            if out:
                yield pd.concat(out)

    found = met.mapInPandas(solve, "query_id long, vec_id long, score long")
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
