"""Exact Jaccard join of word n-gram sets, with skipping by set relations, down to connected groups."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, mix, text_ranges
from tidemark.llm.components import stars
from tidemark.session import SETS_A_FILE, TEXTS_A_FILE, Workspace, files

SLOT_BITS, CHUNKS, MINIMA, RELATIONS, MEMBER_BLOCK, LIST_BLOCK = 22, 64, 16, 3, 256, 64
#: Further minima by which groups meet, and how many of all minima two sets share at least to be compared for it.
SCOUTS, ALIKE = 8, 10
#: Words of 64 parities that a set carries through the inverted lists, and that bound the pairs found there.
PARITIES, FINER = 3, 8
#: Shingles before its own that a row of an inverted list carries.
LASTS = 1
#: Bytes of a word that are hashed by table, words hashed at once, and characters of texts taken together.
LETTERS, WORDS_AT_ONCE, TOGETHER = 24, 1 << 15, 1 << 18
TABLE = np.random.default_rng(5).integers(0, 2**64, (LETTERS, 256), dtype=np.uint64).ravel()
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def word_hashes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text (bytes) start, and their 64-bit hashes: by a random number for each byte at each place; longer words by xxh3."""
    edges = np.flatnonzero(np.diff(np.concatenate([[True], SPACE[text], [True]])))
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    out = np.empty(len(starts), dtype=np.uint64)
    for first in range(0, len(starts), WORDS_AT_ONCE):
        start, size = starts[first : first + WORDS_AT_ONCE], np.minimum(sizes[first : first + WORDS_AT_ONCE], LETTERS)
        before = np.cumsum(size) - size
        at = np.arange(int(size.sum())) - np.repeat(before, size)
        values = TABLE[(at << 8) + text[np.repeat(start, size) + at]]
        out[first : first + WORDS_AT_ONCE] = np.add.reduceat(values, before)
    for i in np.flatnonzero(sizes > LETTERS):
        out[i] = xxhash.xxh3_64_intdigest(text[starts[i] : starts[i] + sizes[i]].tobytes())
    return starts, out


def _runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words."""
    out = np.full(len(hashes) - width + 1, width, dtype=np.uint64)
    for k, factor in enumerate(mix(np.arange(1, width + 1)) | np.uint64(1)):
        out += hashes[k : len(hashes) - width + 1 + k] * factor
    return mix(out)


def shingle_sets(texts: list[str], width: int) -> Iterator[np.ndarray]:
    """Of each text the sorted distinct hashes of its runs of ``width`` words, A-Z lower-cased; a shorter text is one run; no words, none."""
    for first, last in text_ranges(texts, TOGETHER):
        coded = [t.encode("utf-8", "surrogatepass").lower() for t in texts[first:last]]
        starts, hashes = word_hashes(np.frombuffer(b" ".join(coded), dtype=np.uint8))
        ends = np.cumsum([len(c) + 1 for c in coded])
        bounds = [0, *np.searchsorted(starts, ends).tolist()]
        runs = _runs(hashes, width) if len(hashes) >= width else hashes[:0]
        for a, b in zip(bounds, bounds[1:], strict=False):
            found = np.sort(runs[a : b - width + 1]) if b - a >= width else _runs(hashes[a:b], b - a) if b > a else hashes[:0]
            yield found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found


def signature(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def prefix_length(n: int, percent: int) -> int:
    """Sets that reach the threshold share an element among this many first ones of any common order."""
    return n - (percent * n + 99) // 100 + 1


def least_overlap(n, m, percent: int):
    """Smallest common size at which 100 * common >= percent * union."""
    return -((-percent * (n + m)) // (100 + percent))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact test of two sorted sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    at = np.searchsorted(a, b)
    common = int((a[np.minimum(at, len(a) - 1)] == b).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _summaries(docs: DataFrame, width: int, ws: Workspace) -> DataFrame:
    """One pass over the texts: a row per document (kind 0) and per task the counts of hashed shingles (kind 1)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        odd = np.random.default_rng(11).integers(1, 2**62, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        slots = np.zeros(1 << SLOT_BITS, dtype=np.uint32)  # of one task
        columns = ["kind", "doc_id", "of_text", "n", "sig", "minima", "finer"]
        for batch in batches:
            rows = []
            for doc_id, found, of_text in zip(batch["doc_id"], shingle_sets(list(batch["text"]), width), batch["of_text"], strict=True):
                least = np.multiply.outer(odd, found).min(1).view(np.int64) if len(found) else None
                rows.append((0, doc_id, of_text, len(found), signature(found), least, parities(found, FINER) if len(found) else None))
                np.add.at(slots, (found & np.uint64((1 << SLOT_BITS) - 1)).view(np.int64), np.uint32(1))
            yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64", "of_text": "Int64"})
        if slots.any():
            parts = slots.reshape(CHUNKS, -1)
            rows = [(1, None, None, i, zlib.compress(parts[i].tobytes(), 1), None, None) for i in range(CHUNKS)]
            yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64", "of_text": "Int64"})

    rows = documents(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("of_text"))
    schema = "kind int, doc_id long, of_text long, n int, sig binary, minima array<long>, finer array<long>"
    return ws.write(rows.mapInPandas(run, schema), "sets")


def _levels(summaries: DataFrame):
    """How common each slot's shingles are, in quarter powers of two: one byte a slot, a fixed 4 MiB in all."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, blob in zip(batch["n"], batch["sig"], strict=True):
                part = np.frombuffer(zlib.decompress(blob), dtype=np.uint32).astype(np.int64)
                totals[i] = totals[i] + part if i in totals else part
        if totals:
            levels = [(np.log2(t + 1) * 4).astype(np.uint8).tobytes() for t in totals.values()]
            yield pd.DataFrame({"n": list(totals), "sig": levels})

    rows = summaries.filter("kind = 1").select("n", "sig").repartition("n").mapInPandas(add, "n int, sig binary").collect()
    out = np.zeros((CHUNKS, (1 << SLOT_BITS) // CHUNKS), dtype=np.uint8)
    for r in rows:
        out[r.n] = np.frombuffer(r.sig, dtype=np.uint8)
    return out.ravel()


def _relations(sets: DataFrame) -> DataFrame:
    """Pairs (a, b): b has one of its first minima in common with a, the set that shares most other minima with their group.

    The set that most resembles the others is the one whose answers most of them can take over. All minima go through the same
    shuffles, their number in the key.
    """
    spread = F.posexplode(F.slice("minima", 1, RELATIONS)).alias("k", "g")
    named = sets.filter("rep is not null").select("id", spread, "minima")
    shared = named.groupBy("k", "g").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("k", "g")
    grouped = named.join(shared, ["k", "g"]).select("id", "k", "g", F.posexplode("minima").alias("j", "v"))
    common = grouped.groupBy("k", "g", "j", "v").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    likeness = grouped.join(common, ["k", "g", "j", "v"]).groupBy("k", "g", "id").agg(F.sum("c").alias("likeness"))
    heads = likeness.groupBy("k", "g").agg(F.max(F.struct("likeness", (-F.col("id")).alias("least"))).alias("best")).select("k", "g", (-F.col("best.least")).alias("a"))
    return named.join(heads, ["k", "g"]).filter("a <> id").select("a", F.col("id").alias("b")).distinct()


def _scouts(sets: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs (a, b) of different groups that share a further minimum: one set of each group there with one of its largest group.

    Which set stands for its group differs from minimum to minimum. There are at most as many pairs as sets and minima; what they
    link, the inverted lists need not look for.
    """
    mine = sets.join(groups, sets["id"] == groups["node"], "left").select("id", F.coalesce("root", "id").alias("comp"), "n", "minima")
    spread = mine.filter("minima is not null").select(
        "id", "comp", F.posexplode(F.slice("minima", RELATIONS + 1, SCOUTS)).alias("k", "g"))
    standing = spread.groupBy("k", "g", "comp").agg(F.min_by("id", F.xxhash64("id", "k")).alias("id"), F.count(F.lit(1)).alias("size"))
    heads = standing.groupBy("k", "g").agg(
        F.max_by(F.struct("id", "comp"), F.struct("size", "comp")).alias("head"), F.count(F.lit(1)).alias("groups")).filter("groups > 1")
    met = standing.join(heads, ["k", "g"]).filter(F.col("comp") != F.col("head.comp"))
    pairs = met.select(F.col("head.id").alias("a"), F.col("id").alias("b")).distinct()
    side = mine.select("id", "minima")
    both = pairs.join(side.withColumnsRenamed({"id": "a", "minima": "x"}), "a").join(side.withColumnsRenamed({"id": "b", "minima": "y"}), "b")
    same = F.size(F.filter(F.zip_with("x", "y", lambda p, q: p == q), lambda e: e))
    return both.filter(same >= ALIKE).select("a", "b")


def _verify(pairs: DataFrame, sets: DataFrame, docs: DataFrame, width: int, percent: int, ws: Workspace) -> DataFrame:
    """The pairs (a, b) of set ids that reach the threshold, by exact comparison.

    ``pairs`` are written already. The members of ``a`` are dealt in blocks, each with a copy of a's set, so no task holds all of a hot one.
    """
    met_pairs = pairs.count()
    if not met_pairs:
        return pairs
    members = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    wanted = sets.join(members, "id").select("id", "sig", F.col("rep").alias("doc_id"))

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = list(shingle_sets(list(batch["text"]), width))
            yield pd.DataFrame({"id": batch["id"], "same": [signature(f) == s for f, s in zip(found, batch["sig"], strict=True)], "found": [f.tobytes() for f in found]})

    texts = documents(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id").select("id", "sig", "text")
    # an id that repeats with another text is not the set looked for
    arrays = texts.mapInPandas(gather, "id long, same boolean, found binary").filter("same").select("id", "found")
    if (few := files(2 * met_pairs, SETS_A_FILE)) < ws.parts:  # the texts stay where they are, only the sets asked for go to fewer tasks
        arrays = arrays.repartition(few)
    arrays = ws.write(arrays, "shingles")
    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / MEMBER_BLOCK).cast("int").alias("blocks"))
    heads = arrays.join(sizes, F.col("id") == F.col("a")).select("a", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(None).cast("long").alias("b"), "found")
    others = pairs.join(sizes, "a").select("a", F.pmod(F.xxhash64("b"), "blocks").cast("int").alias("block"), "b")
    others = others.join(arrays, F.col("b") == F.col("id")).select("a", "block", "b", "found")
    met = heads.unionByName(others).repartition("a", "block").sortWithinPartitions("a", "block", F.col("b").asc_nulls_first())

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, head, last = None, None, None
        for batch in batches:
            out = []
            for a, b, found in zip(batch["a"], batch["b"], batch["found"], strict=True):
                if pd.isna(b):
                    held, head, last = a, np.frombuffer(found, dtype=np.uint64), None
                elif held == a and last != b:  # a row that repeats has its set twice, one after the other
                    last = b
                    if linked(head, np.frombuffer(found, dtype=np.uint64), percent):
                        out.append((a, b))
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return ws.write(met.mapInPandas(compare, "a long, b long"), "links", files(met_pairs, SETS_A_FILE))


def _united(known: DataFrame | None, links: DataFrame, ws: Workspace) -> DataFrame:
    """node, root of every set that is not the least of its group: the known groups, united by further links."""
    rows = links.count()
    if known is not None:
        if not rows:
            return known
        rows += known.count()
        links = known.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links)
    return stars(links, ws, files(rows))


def parities(found: np.ndarray, words: int = PARITIES) -> np.ndarray:
    """Whether an odd number of shingles falls in each of 64 * words equal parts of the hash range, a bit each."""
    at = (found >> np.uint64(40)).astype(np.int64) * (64 * words) >> 24
    return np.packbits(np.bincount(at, minlength=64 * words).astype(np.uint8) & 1).view(np.int64)


def most_common(x: np.ndarray, y: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Upper bound of the common shingles of pairs from their parities (rows of x and y) and the sum of their sizes.

    Each part whose parity differs holds a shingle of only one of the two.
    """
    return (sizes - np.bitwise_count((x ^ y).view(np.uint64)).sum(1, dtype=np.int64)) >> 1  # of signed numbers it counts the absolute value's


def list_pairs(n: np.ndarray, pos: np.ndarray, ids: np.ndarray, comps: np.ndarray, percent: int, parts: np.ndarray | None = None, last: np.ndarray | None = None) -> list[np.ndarray]:
    """Pairs of one inverted list (rows in order of n) that sizes and positions allow and no answer yet covers: a, b, their sizes.

    A pair that reaches the threshold passes in every list of a common shingle. With ``last``, the shingles just before this one in each
    set's order (rows), it passes in the list of its first common shingle and in few others: where positions leave enough to share
    if nothing before was common, and the shingles before differ (where one is the same, the pair is in its list too).

    A set linked to a highly similar one has that one's answers: pairs within one group are skipped. Blocks of the
    list are skipped whole where their sizes, or the first position in them, leave too little to share. ``parts`` (rows of
    parities) leaves out pairs that cannot have enough in common wherever they meet.
    """
    out = []
    size = len(n)
    for start in range(0, size, LIST_BLOCK):
        rows = slice(start, min(size, start + LIST_BLOCK))
        for other in range(start, size, LIST_BLOCK):
            cols = slice(other, min(size, other + LIST_BLOCK))
            if 100 * int(n[rows][-1]) < percent * int(n[cols][0]):
                break
            rest_rows = int((n[rows] - pos[rows]).max())
            rest_cols = int((n[cols] - pos[cols]).max())
            before = min(int(pos[rows].max()), int(pos[cols].max())) if last is None else 0
            if before + min(rest_rows, rest_cols) < least_overlap(int(n[rows][0]), int(n[cols][0]), percent):
                continue
            x, y = n[rows][:, None], n[cols][None]
            i, j = pos[rows][:, None], pos[cols][None]
            rest = np.minimum(x - i, y - j)
            if last is None:
                rest = rest + np.minimum(i, j)
            fit = (rest >= least_overlap(x, y, percent)) & (100 * x >= percent * y) & (comps[rows][:, None] != comps[cols][None])
            i, j = np.nonzero(np.triu(fit, 1) if other == start else fit)
            if len(i) and last is not None:
                new = (last[rows][i][:, :, None] != last[cols][j][:, None, :]).all((1, 2))
                i, j = i[new], j[new]
            if len(i) and parts is not None:
                na, nb = n[rows][i], n[cols][j]
                enough = most_common(parts[rows][i], parts[cols][j], na + nb) >= least_overlap(na, nb, percent)
                i, j = i[enough], j[enough]
            if len(i):
                a, b, na, nb = ids[rows][i], ids[cols][j], n[rows][i], n[cols][j]
                swap = a > b
                out.append(np.stack([np.where(swap, b, a), np.where(swap, a, b), np.where(swap, nb, na), np.where(swap, na, nb)], 1))
    return out


def _candidates(docs: DataFrame, sets: DataFrame, groups: DataFrame, levels, width: int, percent: int) -> DataFrame:
    """Pairs of sets of different groups that share a shingle among their rarest ones and pass sizes, positions and parities.

    With each pair goes the most that the two can share.
    """
    sent = docs.sparkSession.sparkContext.broadcast(levels)
    odd, lasts = [f"odd{i}" for i in range(PARITIES)], [f"last{i}" for i in range(LASTS)]

    def rarest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, found in zip(batch["doc_id"], shingle_sets(list(batch["text"]), width), strict=True):
                if len(found):
                    level = sent.value[(found & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)]
                    order = np.lexsort((found, level))[: prefix_length(len(found), percent)]
                    rows.append((doc_id, signature(found), found[order].view(np.int64), *parities(found)))
            yield pd.DataFrame(rows, columns=["doc_id", "sig", "first", *odd])

    texts = documents(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.col("doc_id").isNotNull())
    firsts = texts.mapInPandas(rarest, "doc_id long, sig binary, first array<long>, " + ", ".join(f"{c} long" for c in odd))
    mine = sets.join(groups, sets["id"] == groups["node"], "left").select(
        "id", F.coalesce("root", "id").alias("comp"), "n", F.col("rep").alias("doc_id"), F.col("sig").alias("s")
    )
    # where nothing stands before, the id: no other set has it
    before = [F.slice(F.concat(F.array_repeat("id", i + 1), "first"), 1, F.size("first")).alias(c) for i, c in enumerate(lasts)]
    ranked = firsts.join(mine, "doc_id").filter("sig = s").select("n", "id", "comp", *odd, F.posexplode(F.arrays_zip("first", *before)).alias("pos", "one"))
    lists = ranked.select("n", "id", "comp", *odd, "pos", F.col("one.first").alias("token"), *[F.col(f"one.{c}").alias(c) for c in lasts])
    lists = lists.repartition("token").sortWithinPartitions("token", "n", "id")

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["token", "n", "pos", "id", "comp", *odd, *lasts]
        carried = None

        def solve(part: dict[str, np.ndarray]) -> pd.DataFrame:
            token = part["token"]
            starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
            ends = np.r_[starts[1:], len(token)]
            mixed = np.minimum.reduceat(part["comp"], starts) != np.maximum.reduceat(part["comp"], starts)
            out = []
            parts, last = np.stack([part[c] for c in odd], 1), np.stack([part[c] for c in lasts], 1)
            for a, b in zip(starts[mixed], ends[mixed], strict=True):
                out += list_pairs(part["n"][a:b], part["pos"][a:b], part["id"][a:b], part["comp"][a:b], percent, parts[a:b], last[a:b])
            found = np.concatenate(out) if out else np.empty((0, 4), dtype=np.int64)
            return pd.DataFrame(found, columns=["a", "b", "na", "nb"])

        for batch in batches:
            part = {c: batch[c].to_numpy().astype(np.int64) for c in columns}
            if carried is not None:
                part = {c: np.concatenate([carried[c], part[c]]) for c in columns}
            if not len(part["token"]):
                continue
            cut = int(np.flatnonzero(part["token"] != part["token"][-1])[-1]) + 1 if (part["token"] != part["token"][-1]).any() else 0
            carried = {c: v[cut:] for c, v in part.items()}  # the last list may go on
            if cut:
                yield solve({c: v[:cut] for c, v in part.items()})
        if carried is not None:
            yield solve(carried)

    met = lists.select("token", "n", "pos", "id", "comp", *odd, *lasts).mapInPandas(meet, "a long, b long, na int, nb int").distinct()
    side = sets.select("id", "finer")
    both = met.join(side.withColumnsRenamed({"id": "a", "finer": "x"}), "a").join(side.withColumnsRenamed({"id": "b", "finer": "y"}), "b")
    unlike = F.aggregate(F.zip_with("x", "y", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda total, bits: total + bits)
    need = F.ceil(F.lit(percent) * (F.col("na") + F.col("nb")) / (100 + percent))
    bounded = both.select("a", "b", need.alias("need"), F.floor((F.col("na") + F.col("nb") - unlike) / 2).alias("shared"))
    return bounded.filter("shared >= need").select("a", "b", "shared")


def _named(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Candidate pairs with the groups of both sides, if those still differ."""
    known = groups.select("node", "root")
    first = pairs.join(known.withColumnsRenamed({"node": "a", "root": "ra"}), "a", "left")
    both = first.join(known.withColumnsRenamed({"node": "b", "root": "rb"}), "b", "left")
    both = both.withColumn("ga", F.coalesce("ra", "a")).withColumn("gb", F.coalesce("rb", "b")).drop("ra", "rb")
    return both.filter("ga <> gb")


def _likeliest(pairs: DataFrame) -> DataFrame:
    """Of the pairs between a set and a group, the one that can share most."""
    best = F.struct("shared", "a", "b")
    sides = [pairs.groupBy(*keys).agg(F.max(best).alias("best")).select("best.a", "best.b") for keys in (("a", "gb"), ("b", "ga"))]
    return sides[0].unionByName(sides[1]).distinct()


def groups(docs: DataFrame, ws: Workspace, width: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id of every row: the smallest doc_id reachable over links.

    Two documents link when 100 * common >= percent * union of their distinct word shingles (``width`` words, A-Z
    lower-cased; a shorter text is one shingle). Sets are compared as 64-bit shingle hashes.

    1. Equal sets become one; a set's relations are the central sets of the groups it shares a min-hash with.
       They are verified, and what links is one group whose answers its members inherit. Groups that share further min-hashes
       are then compared by one set each and united where those link.
    2. What is left is found exactly: inverted lists of every set's rarest shingles, skipped by blocks, give pairs of
       different groups. The likeliest of each set and group is verified first; what then still lies
       between different groups is verified whole. A link between different texts is lost in neither step; links within a
       group that is already connected are not looked for.

    A null or empty text, or one of white space, has no shingle and is its own group. A row without an id is in the group of
    its equals; where no equal has an id it links with nothing and its component is null. Repeated rows are copies. Extra
    columns are left behind; an empty table gives none.
    """
    return _grouped(docs, ws, width, percent)[0].select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")


def _grouped(docs: DataFrame, ws: Workspace, width: int, percent: int) -> tuple[DataFrame, int]:
    """doc_id, of_text (hash of the text), n, component_id of every row, and how many rows there are."""
    summaries = _summaries(docs, width, ws)
    rows = summaries.filter("kind = 0")
    distinct = rows.filter("n > 0").groupBy("sig").agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.min("minima").alias("minima"), F.min("finer").alias("finer"))
    sets = ws.write(distinct.withColumn("id", F.monotonically_increasing_id()), "distinct", files(total := rows.count()))
    size = sets.count()  # files are counted by the rows that the writing tasks read

    def verified(pairs: DataFrame) -> DataFrame:
        return _verify(pairs, sets, docs, width, percent, ws)

    first = _united(None, verified(ws.write(_relations(sets), "pairs", files(RELATIONS * size))), ws)
    first = _united(first, verified(ws.write(_scouts(sets, first), "pairs", files(SCOUTS * size))), ws)
    met = ws.write(_candidates(docs, sets, first, _levels(summaries), width, percent), "met", files(size, SETS_A_FILE))
    asked = files(2 * met.count() + size)
    likely = ws.write(_likeliest(_named(met, first)), "likeliest", asked)
    second = _united(first, verified(likely), ws)
    left = _named(met, second).select("a", "b").join(likely, ["a", "b"], "left_anti")
    joined = _united(second, verified(ws.write(left, "pairs", asked)), ws)
    of_set = sets.join(joined, sets["id"] == joined["node"], "left").select("sig", "rep", F.coalesce("root", "id").alias("root"))
    least = of_set.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = ws.write(of_set.join(least, "root").select(F.col("sig").alias("s"), "component_id"), "named", files(size))
    out = rows.join(named, (F.col("sig") == F.col("s")) & (F.col("n") > 0), "left")
    return out.select(
        "doc_id", "of_text", "n",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    ), total


def one_of_each(docs: DataFrame, ws: Workspace, width: int, percent: int) -> DataFrame:
    """The rows, unchanged, of one document of each group: its smallest id, and of an id's texts one of the group.

    Rows are told apart by id and text, so of an id with two texts only the copy goes. Repeated rows become one;
    rows without an id all stay, rows without a shingle too, but for repetitions. Null texts count as empty; the rules of ``groups`` for all else.
    """
    found, total = _grouped(docs, ws, width, percent)
    found = found.filter("doc_id is not null")
    chosen = found.filter("n > 0").groupBy("component_id").agg(F.min(F.struct("doc_id", "of_text")).alias("row")).select("row.*")
    keep = ws.write(chosen.unionByName(found.filter("n = 0").select("doc_id", "of_text").distinct()), "kept", files(total))
    keep = keep.select(F.col("doc_id").alias("_id"), F.col("of_text").alias("_text"))
    of_text = F.xxhash64(F.coalesce("text", F.lit("")))
    named = docs.withColumn("_of", of_text).join(keep, (F.col("doc_id").cast("long") == F.col("_id")) & (F.col("_of") == F.col("_text")), "left_semi")
    named = named.dropDuplicates(["doc_id", "_of"]).coalesce(files(keep.count(), TEXTS_A_FILE))
    return named.select(docs.columns).unionByName(docs.filter("doc_id is null"))
