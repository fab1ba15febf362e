"""Mixing sources to target weights with hash-threshold histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import Workspace

WEIGHTS, CAP, LEVELS, LEVEL_BITS = (5, 2, 1), 3, 5, 12
#: A word: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def _hash(column: str) -> Column:
    """60 bits of the id's md5: the same on every run and in every engine."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(column).cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, source_size, target for one row per source.

    Sources in order of code points (null last) weigh ``weights``, repeating. The budget is all sizes.
    Each target is min(cap * size, share * weight) with one share for all: the fixed point of
    resharing what is above a cap. Filling the sources in order of cap * size / weight, the
    share is what is left for the weight that is left, from the first source it does not fill.
    The windows see one row per source, never a document.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    weighed = sizes.withColumn("w", weight).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    filling = Window.orderBy(F.col("most") / F.col("w"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    filled = F.coalesce(F.sum("most").over(before), F.lit(0.0))
    left = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    shared = weighed.withColumn("share", (total - filled) / left)
    # the first source that the share then leaves below its cap fixes the share of all later ones
    fixed = F.min(F.when(F.col("share") * F.col("w") < F.col("most"), F.struct(F.col("most") / F.col("w"), "share"))).over(everything)
    target = F.coalesce(F.least(F.col("most"), fixed["share"] * F.col("w")), F.col("most"))
    return shared.select("source", "source_size", target.alias("target"))


def _copies(h: str) -> Column:
    """How often a row is taken whole, from its hash and its source's rounds and threshold."""
    return F.col("rounds") + (F.shiftright(h, 60 - LEVELS * LEVEL_BITS) < F.col("threshold")).cast("long")


def thresholds(slim: DataFrame, ws: Workspace, weights: tuple[int, ...], cap: int) -> DataFrame:
    """s (source), source_size, target, rounds, threshold: one row per source; ``slim`` has source, size, h."""
    goals = targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    goals = goals.withColumn("rounds", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    rest = F.col("target") - F.col("rounds") * F.col("source_size")
    state = ws.write(goals.withColumn("rest", rest).withColumn("low", F.lit(0).cast("long")).withColumn("border", F.lit(0).cast("long")), "targets")

    for level in range(LEVELS):
        shift = 60 - (level + 1) * LEVEL_BITS
        bucket = F.shiftright("h", shift)
        inside = slim if level == 0 else slim.join(
            state.select(F.col("source").alias("s"), "border"),
            slim["source"].eqNullSafe(F.col("s")) & (F.shiftright(slim["h"], shift + LEVEL_BITS) == F.col("border")),
        ).select(slim["source"], slim["h"], slim["size"])
        counts = inside.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("source").orderBy("bucket"))
        joined = counts.withColumn("upto", upto).withColumnRenamed("source", "s").join(
            state.select("source", "rest"), F.col("s").eqNullSafe(F.col("source"))
        )
        # the border: the first bucket that does not fit; all buckets fit only if the rest is the whole
        over = joined.filter(F.col("upto") > F.col("rest")).groupBy("s").agg(
            F.min(F.struct("bucket", "upto", "n")).alias("b")
        ).select(F.col("s"), F.col("b.bucket").alias("found"), (F.col("b.upto") - F.col("b.n")).alias("below"), F.col("b.n").alias("n"))
        state = ws.write(
            state.join(over, state["source"].eqNullSafe(F.col("s")), "left").select(
                state["source"], "source_size", "target", "rounds",
                (F.col("rest") - F.coalesce("below", F.lit(0))).alias("rest"),
                F.col("found").alias("border"), F.coalesce("n", F.lit(0)).alias("last"),
            ), f"level{level}",
        )
    take_last = (F.col("last") > 0) & (F.col("last") - F.col("rest") < F.col("rest"))
    return state.select(
        F.col("source").alias("s"), "source_size", "target", "rounds",
        F.when(F.col("border").isNull(), F.lit(0)).otherwise(F.col("border") + take_last.cast("long")).alias("threshold"),
    )


def _slim(docs: DataFrame, ws: Workspace) -> DataFrame:
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return ws.write(docs.select("doc_id", "source", words.alias("size"), _hash("doc_id").alias("h")), "sizes")


def mix(docs: DataFrame, ws: Workspace, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """doc_id, size, source_size, target, taken: how many words of each document the mix takes.

    Every document of a source is taken whole floor(target / size) times, and once more where its
    hash is below the source's threshold. Thresholds come from histograms: words are summed by
    source and hash bucket, the buckets below the rest of the budget are taken, and only the
    bucket at the border is refined by the next ``LEVEL_BITS`` bits, ``LEVELS`` times. Nothing is sorted,
    and a bucket row is all that leaves a task for its documents.

    The bucket at the border after the last level (equal hashes up to 60 bits, in practice one
    document or the copies of one id) is taken if that comes nearer to the target. A
    null text has size 0 and is taken 0 words; null sources are one source, the last; a source
    without words has target 0. Repeated rows count and are taken alike. An empty table gives no
    rows.
    """
    slim = _slim(docs, ws)
    final = thresholds(slim, ws, weights, cap)
    return slim.join(final, slim["source"].eqNullSafe(F.col("s"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * _copies("h")).cast("long").alias("taken")
    )


def take(docs: DataFrame, ws: Workspace, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The rows of the mix with all their columns, a row as often as it is taken; the rules of ``mix``."""
    final = thresholds(_slim(docs, ws), ws, weights, cap).select(F.col("s").alias("_s"), "rounds", "threshold")
    held = docs.select(F.struct(*docs.columns).alias("row"), F.col("source").alias("_source"), _hash("doc_id").alias("_h"))
    copies = held.join(final, F.col("_source").eqNullSafe(F.col("_s"))).select("row", _copies("_h").alias("n")).filter("n > 0")
    return copies.select("row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select("row.*")
