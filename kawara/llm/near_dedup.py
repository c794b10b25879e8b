"""Near duplicates: circulant MinHash, banding, exact Jaccard, components.

**Signatures.** Two permutations of ``Z_D`` make all coordinates: ``sigma`` scatters the shingles,
``pi`` is shifted circularly by ``k`` for coordinate ``k``, whose value is the smallest
``pi[(sigma(x) + k) mod D]`` over the set (Li and Li, "C-MinHash", 2021). The values of one shingle
for all coordinates lie side by side in ``pi``, so a signature is a minimum over rows of a table.

**Recall.** ``BANDS`` bands of ``ROWS`` coordinates: a pair at the threshold of 0.85 shares no band
with probability (1 - 0.85^6)^40 = 6e-9, one at 0.80 with 5e-6, and less above it. Nothing else can lose a link.

**Crowded buckets.** Equal sets are one node. A bucket first pairs its members with its smallest
one only. Where that leaves members in several components, every member outside the largest
component of the bucket (a straggler) is held against the members of the other components; pairs
inside a component need no test, as their link changes no component. In small buckets these are
pairs like the others. In larger ones stragglers and members are dealt to blocks of about
``BLOCK`` rows; a tile of two blocks counts its intersections as a product of two 0/1 matrices and
gives out links only. A pair is counted once, in the first bucket its rows share. A bucket with
more than ``STRAGGLERS`` of them, that is one whose members are mostly not near, is first split
by fresh bands (the next shifts of ``pi``); after ``LEVELS`` splits it is tiled, whatever its size,
so nothing is capped. Families whose members stay together through independent signatures and
yet are not linked cost the square of their stragglers in tiles, but no rows.

**Confirmation.** Candidates' shingle sets are computed anew from whole texts and intersected;
sets are never stored or collected. Components come from star rounds.

Defined results. NULL, empty and blank texts have an empty set and link with nothing. Fewer than
five words: the whole sequence is the one shingle. Rows with equal ids or texts are separate rows
of one component; one row of a component is kept. NULL ids sort last. Empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kawara.llm import shingles
from kawara.llm.common import documents, remaining, same, suspects, with_code
from kawara.operators.components import connected_components
from kawara.session import cut_lineage

PERCENT = 85
BANDS, ROWS = 40, 6
LEVELS = 2
STRAGGLERS = 2_048
FEW_PAIRS = 256
BLOCK = 128
DENSE = 10_000_000  # cells of a tile's matrix; sparser tiles are intersected pair by pair
BITS = 22  # D = 2^BITS
SEED = 20_240_229
_BLOCK = 256


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    """sigma, and the windows of pi: row ``p`` holds ``pi[p], pi[p + 1], ...`` circularly."""
    rng = np.random.Generator(np.random.PCG64(SEED))
    sigma = rng.permutation(1 << BITS).astype(np.uint32)
    pi = rng.permutation(1 << BITS).astype(np.uint32)
    return sigma, np.concatenate([pi, pi[: BANDS * ROWS * (LEVELS + 1)]])


def signature(shingle_set: np.ndarray, level: int = 0) -> np.ndarray:
    """The coordinates of one level: shifts ``level * BANDS * ROWS`` and following."""
    sigma, pi = _permutations()
    size = BANDS * ROWS
    windows = np.lib.stride_tricks.sliding_window_view(pi[level * size :], size)
    at = sigma[(shingle_set >> np.uint64(64 - BITS)).astype(np.int64)]
    low = np.full(size, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(at), _BLOCK):
        np.minimum(low, windows[at[i : i + _BLOCK]].min(axis=0), out=low)
    return low


def band_keys(low: np.ndarray, level: int = 0) -> np.ndarray:
    rows = low.reshape(BANDS, ROWS).astype(np.uint64)
    acc = np.arange(BANDS, dtype=np.uint64) + np.uint64(1 + level * BANDS)
    for j in range(ROWS):
        acc = (acc ^ rows[:, j]) * np.uint64(0xBF58476D1CE4E5B9)
        acc ^= acc >> np.uint64(31)
    return acc.view(np.int64)


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, id, print, n, set_key, bands): one row per document."""
    kind = docs.schema[key].dataType.simpleString()

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = shingles.WordHashes()
        for b in batches:
            sets = [shingles.shingle_set(t, cache) for t in b["text"]]
            yield pd.DataFrame(
                {
                    "row": b["row"],
                    "id": b["id"],
                    "print": b["print"],
                    "n": [len(s) for s in sets],
                    "set_key": [shingles.set_key(s) for s in sets],
                    "bands": [band_keys(signature(s)) if len(s) else np.empty(0, np.int64) for s in sets],
                }
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).cast("string").alias("id"),  # as text: pandas turns integers beside NULLs into floats
        F.xxhash64(text).alias("print"),
        F.col(text).alias("text"),
    )
    signed = with_code(rows).mapInPandas(sign, "row long, id string, print long, n long, set_key binary, bands array<long>")
    return signed.withColumn("id", F.col("id").cast(kind))


def _texts_of(docs: DataFrame, leaf: DataFrame, rows: DataFrame, key: str, text: str) -> DataFrame:
    """(row, set_key, text) of some rows: found again by id and fingerprint, texts stay whole."""
    want = leaf.join(rows, "row").select("row", F.col("id").alias("_id"), F.col("print").alias("_print"), "set_key")
    want = cut_lineage(want)
    have = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("print"))
    have, _ = suspects(have, want.select(F.col("_id").alias("id"), F.col("_print").alias("print")), "id", "print")
    return have.join(want, same(F.col("id"), F.col("_id")) & (F.col("print") == F.col("_print"))).select("row", "set_key", "text")


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cache = shingles.WordHashes()
    for b in batches:
        sets = [shingles.shingle_set(t, cache) for t in b["text"]]
        good = [shingles.set_key(s) == bytes(k) for s, k in zip(sets, b["set_key"])]
        found = pd.DataFrame({"row": b["row"], "shingles": [s.view(np.int64) for s in sets]})
        yield found[np.array(good, bool)]


def confirm(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose whole shingle sets are similar enough."""
    sets = cut_lineage(with_code(texts).mapInPandas(_sets, "row long, shingles array<long>"))
    left = sets.select(F.col("row").alias("a"), F.col("shingles").alias("_a"))
    right = sets.select(F.col("row").alias("b"), F.col("shingles").alias("_b"))
    both = F.size(F.array_intersect("_a", "_b"))
    tested = pairs.join(left, "a").join(right, "b").select("a", "b", both.alias("_n"), F.size("_a").alias("_na"), F.size("_b").alias("_nb"))
    return tested.where(100 * F.col("_n") >= percent * (F.col("_na") + F.col("_nb") - F.col("_n"))).select("a", "b")


def _stars(buckets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of every member with the smallest of its bucket; members of buckets of three or more."""
    shared = cut_lineage(
        buckets.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("a"), F.max("row").alias("b"))
        .where("n > 1")
    )
    crowded = shared.where("n > 2").select("bucket", "a")
    members = cut_lineage(buckets.join(crowded, "bucket"))
    star = members.where("row <> a").select("a", F.col("row").alias("b"))
    pairs = shared.where("n = 2").select("a", "b").unionByName(star).distinct()
    return cut_lineage(pairs), members.drop("a")


def _unsettled(members: DataFrame, comps: DataFrame) -> DataFrame:
    """(bucket, row, comp, top, size, stragglers): members of buckets that hold several components."""
    m = members.join(comps, members["row"] == comps["node"], "left").select(
        "bucket", "row", F.coalesce("root", "row").alias("comp")
    )
    m = cut_lineage(m)
    counts = m.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("k"))
    by_bucket = counts.groupBy("bucket").agg(
        F.sum("k").alias("size"),
        (F.sum("k") - F.max("k")).alias("stragglers"), F.max(F.struct("k", "comp")).getField("comp").alias("top")
    )
    return cut_lineage(m.join(cut_lineage(by_bucket.where("stragglers > 0")), "bucket"))


def _across(rows: DataFrame) -> DataFrame:
    """Pairs of each straggler with the bucket's members of other components."""
    x = rows.where("comp <> top").select("bucket", F.col("row").alias("x"), F.col("comp").alias("cx"))
    y = rows.select("bucket", F.col("row").alias("y"), F.col("comp").alias("cy"), "top")
    met = x.join(y, "bucket").where("cx <> cy AND (cy = top OR x < y)")
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _tile(percent: int):
    def links_of(tile: pd.DataFrame) -> pd.DataFrame:
        """Links between the stragglers and the members of one tile, in other components."""
        bucket = tile["bucket"].iloc[0]
        x, y = tile[tile["straggler"]], tile[~tile["straggler"]]
        sets = [np.asarray(s) for s in tile["shingles"]]
        size = np.array([len(s) for s in sets])
        if not len(x) or not len(y):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        terms, at = np.unique(np.concatenate(sets), return_inverse=True)
        left, right = np.flatnonzero(tile["straggler"]), np.flatnonzero(~tile["straggler"])
        if len(terms) * len(tile) <= DENSE:
            held = np.zeros((len(tile), len(terms)), np.float32)
            held[np.repeat(np.arange(len(tile)), size), at] = 1
            both = held[left] @ held[right].T
        else:
            both = np.array([[len(np.intersect1d(sets[i], sets[j], True)) for j in right] for i in left])
        near = 100 * both >= percent * (size[left][:, None] + size[right][None, :] - both)
        near &= x["comp"].to_numpy()[:, None] != y["comp"].to_numpy()[None, :]
        # both ends may be stragglers: the pair counts once
        near &= (y["comp"] == y["top"]).to_numpy()[None, :] | (x["row"].to_numpy()[:, None] < y["row"].to_numpy()[None, :])
        bands = np.stack(list(tile["bands"]))
        out = []
        for i, j in zip(*np.nonzero(near)):
            shared = bands[left[i]][bands[left[i]] == bands[right[j]]]
            if not len(shared) or bucket not in shared[1:] or shared[0] == bucket:
                out.append(sorted((x["row"].iloc[i], y["row"].iloc[j])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return links_of


def _tiled(rows: DataFrame, texts: DataFrame, leaf: DataFrame, percent: int) -> DataFrame:
    """Links of stragglers with members of other components, found tile by tile."""
    sets = cut_lineage(with_code(texts).mapInPandas(_sets, "row long, shingles array<long>").dropDuplicates(["row"]))
    sets = sets.join(leaf.select("row", "bands"), "row")
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    own = F.xxhash64("row", F.lit("block"))
    at = rows.withColumns({"nx": blocks(F.col("stragglers")), "ny": blocks(F.col("size"))})
    x = at.where("comp <> top").select(
        "bucket", "row", "comp", "top", F.lit(True).alias("straggler"),
        F.pmod(own, "nx").cast("int").alias("bx"), F.explode(F.expr("sequence(0, ny - 1)")).alias("by"),
    )
    y = at.select(
        "bucket", "row", "comp", "top", F.lit(False).alias("straggler"),
        F.explode(F.expr("sequence(0, nx - 1)")).alias("bx"), F.pmod(own, "ny").cast("int").alias("by"),
    )
    tiles = x.unionByName(y).join(sets, "row")
    return tiles.groupBy("bucket", "bx", "by").applyInPandas(_tile(percent), "a long, b long").distinct()


def _split(rows: DataFrame, texts: DataFrame, level: int) -> DataFrame:
    """(bucket, row): the members of crowded buckets under fresh bands, never across buckets."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = shingles.WordHashes()
        for b in batches:
            sets = [shingles.shingle_set(t, cache) for t in b["text"]]
            yield pd.DataFrame({"row": b["row"], "bands": [band_keys(signature(s, level), level) for s in sets]})

    bands = cut_lineage(with_code(texts).mapInPandas(sign, "row long, bands array<long>").dropDuplicates(["row"]))
    fresh = rows.select("bucket", "row").join(bands, "row").select("bucket", "row", F.explode("bands").alias("band"))
    return fresh.select(F.xxhash64("bucket", "band").alias("bucket"), "row")


def links(docs: DataFrame, leaf: DataFrame, nodes: DataFrame, key: str, text: str, percent: int) -> DataFrame | None:
    """Confirmed links that connect the components of the similarity graph; None without any."""

    def texts(rows: DataFrame) -> DataFrame:
        return _texts_of(docs, leaf, cut_lineage(rows.select("row").distinct()), key, text)

    def tested(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.col("a").alias("row")).unionByName(pairs.select(F.col("b").alias("row")))
        return cut_lineage(confirm(pairs, texts(ends), percent))

    found: list[DataFrame] = []
    done: list[DataFrame] = []

    def union(parts: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, parts)

    buckets = nodes.select(F.explode("bands").alias("bucket"), "row")
    for level in range(LEVELS + 1):
        pairs, members = _stars(buckets)
        if level:
            pairs = cut_lineage(pairs.join(union(done), ["a", "b"], "left_anti"))
        done.append(pairs)
        found.append(tested(pairs))
        rest = _unsettled(members, connected_components(union(found)))
        small = F.col("stragglers") * F.col("size") <= FEW_PAIRS
        few = F.lit(True) if level == LEVELS else F.col("stragglers") <= STRAGGLERS
        across = cut_lineage(_across(rest.where(small)).join(union(done), ["a", "b"], "left_anti"))
        if not across.isEmpty():
            done.append(across)
            found.append(tested(across))
        larger = cut_lineage(rest.where(few & ~small))
        if not larger.isEmpty():
            found.append(cut_lineage(_tiled(larger, texts(larger), leaf, percent)))
        crowded = rest.where(~few & ~small)
        if level == LEVELS or crowded.isEmpty():
            return union(found)
        buckets = _split(crowded, texts(crowded), level + 1)
    raise AssertionError


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(row, id, print, n, best): ``best`` is the row of smallest id in the component."""
    leaf = cut_lineage(signatures(docs, key, text))
    sets = leaf.where("n > 0").groupBy("set_key").agg(F.min("row").alias("rep"), F.count(F.lit(1)).alias("k"))
    copies = cut_lineage(sets.where("k > 1").select("set_key", "rep"))
    node_of = cut_lineage(leaf.select("row", "set_key").join(copies, "set_key").select("row", "rep"))
    spare = node_of.where("row <> rep").select("row")
    nodes = leaf.where("n > 0").select("row", "bands").join(spare, "row", "left_anti")
    comps = connected_components(links(docs, leaf, nodes, key, text, percent))

    rows = leaf.select("row", "id", "print", "n").join(node_of, "row", "left")
    rows = rows.withColumn("node", F.coalesce("rep", "row")).drop("rep").join(comps, "node", "left")
    rows = cut_lineage(rows.withColumn("root", F.coalesce("root", "node")).drop("node"))
    own = F.struct(F.col("id").isNull().alias("none"), "id", "row", "print")
    best = rows.groupBy("root").agg(F.min(own).alias("best"), F.count(F.lit(1)).alias("k")).where("k > 1")
    out = rows.join(cut_lineage(best.drop("k")), "root", "left")
    return out.select("row", "id", "print", "n", F.coalesce("best", own).alias("best"))


def assign(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    return groups(docs, key, text, percent).select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        F.col("best.id").alias("component_id"),
        (F.col("row") == F.col("best.row")).alias("kept"),
    )


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, all columns."""
    repeat = same(F.col("id"), F.col("best.id")) & (F.col("print") == F.col("best.print"))
    gone = groups(docs, key, text, percent).where(F.col("row") != F.col("best.row"))
    gone = cut_lineage(gone.select("id", "print", repeat.alias("repeat")))
    return remaining(docs, gone, key, F.xxhash64(text))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(documents(spark, sf_dir))
