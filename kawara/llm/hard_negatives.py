"""Hard negatives for anchor-positive pairs, by Strassen products of integer tiles.

Vectors are quantised to integers and packed into blocks where they lie. Anchors and candidates are
dealt to groups of about ``ANCHORS`` and ``CANDIDATES`` rows; every pair of groups is a tile, so a tile
is bounded whatever the input and their number grows with it. The scores of a tile are one matrix
product by Strassen's seven recursive products, padded with zeros to even sides; they use additions,
subtractions and products only, so int64 gives the exact result even where sums on the way wrap.

Two passes over the tiles. The first keeps a heap of the best ``POSITIVES`` rows of the anchor's label
per tile and anchor; heaps of all tiles are merged. The second knows the positives' scores and keeps,
per tile, anchor and positive, a heap of the best ``NEGATIVES`` rows of another label whose score lies
in the window; these are merged alike. A heap holds rows by score, then id, so merging in any order
gives the same rows.

Defined results. Rows with a NULL id, label or vector, an empty vector, or a NULL or non-finite
component take no part. Rows of repeated ids are rows of their own, as anchors, positives and
negatives; ties beyond the id go by place. Vectors of another length are no candidates. Scores that
could pass 2^55 raise an error, as 100 times a score has to fit a long. No pair, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kawara.llm.common import with_code
from kawara.session import cut_lineage

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # the window, in percent of the positive's score
STRIDE = 100
SCALE = 256
BLOCK = 8_192
ANCHORS, CANDIDATES = 2_048, 16_384
CELLS = 1 << 22  # components of one side of a tile, so that long vectors make smaller tiles
SLICE = 256  # anchors of one product
LEAF = 32
LIMIT = 1 << 55


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two integer matrices."""
    (n, k), m = a.shape, b.shape[1]
    if min(n, k, m) <= LEAF:
        return a @ b
    a = np.pad(a, ((0, n % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, m % 2)))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * i, 2 * l), a.dtype)
    out[:i, :l] = p1 + p4 - p5 + p7
    out[:i, l:] = p3 + p5
    out[i:, :l] = p2 + p4
    out[i:, l:] = p1 - p2 + p3 + p6
    return out[:n, :m]


def fitting(rows: int, dim: int) -> int:
    """At most so many rows, fewer where they are long."""
    return max(1, min(rows, CELLS // max(1, dim)))


def usable(vectors: DataFrame, key: Column, label: Column, vector: Column, asked: Column) -> DataFrame:
    """(id, label, v, asked) of the rows that take part, components as integers."""
    rows = vectors.select(
        key.cast("long").alias("id"), label.cast("long").alias("label"),
        F.transform(vector, lambda x: x.cast("double")).alias("v"), F.coalesce(asked, F.lit(False)).alias("asked"),
    )
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = rows.where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND size(v) > 0").where(~bad)
    return good.withColumn("v", F.transform("v", lambda x: F.floor(x * SCALE).cast("long")))


def _packed(rows: np.ndarray, ids, labels, **more) -> dict:
    kind = next(t for t in ("<i2", "<i4", "<i8") if (rows == rows.astype(t)).all())  # the narrowest that holds all
    own = {"dim": rows.shape[1], "n": len(rows), "kind": kind, "rows": rows.astype(kind).tobytes()}
    return own | {"ids": np.asarray(ids, "<i8").tobytes(), "labels": np.asarray(labels, "<i8").tobytes()} | more


PACKED = "dim int, n long, kind string, rows binary, ids binary, labels binary"


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of a partition in blocks of equal dimension."""
    held: dict[int, list] = {}

    def block(dim: int) -> pd.DataFrame:
        ids, labels, asked, rows = zip(*held.pop(dim))
        m = np.stack(rows).astype("<i8")
        top = float(np.abs(m.astype(float)).max())
        return pd.DataFrame([_packed(m, ids, labels, asked=np.array(asked, bool).tobytes(), n_asked=sum(asked), top=top)])

    for b in batches:
        for i, label, v, asked in zip(b["id"], b["label"], b["v"], b["asked"]):
            own = held.setdefault(len(v), [])
            own.append((i, label, bool(asked), np.asarray(v)))
            if len(own) >= fitting(BLOCK, len(v)):
                yield block(len(v))
    for dim in list(held):
        yield block(dim)


def _asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The anchors of each block, with their places in it."""
    for b in batches:
        for r in b.itertuples(index=False):
            keep = np.flatnonzero(np.frombuffer(r.asked, bool))
            m = np.frombuffer(r.rows, r.kind).reshape(-1, r.dim)[keep]
            ids, labels = (np.frombuffer(x, "<i8")[keep] for x in (r.ids, r.labels))
            yield pd.DataFrame([_packed(m, ids, labels, block=r.block, pos=keep.astype("<i8").tobytes())])


class Side:
    """The rows of one side of a tile: from several blocks, in the order of their ids."""

    def __init__(self, blocks: pd.DataFrame):
        self.dim = int(blocks["dim"].iloc[0])
        parts = list(blocks.itertuples(index=False))
        ids = np.concatenate([np.frombuffer(p.ids, "<i8") for p in parts])
        block = np.repeat([p.block for p in parts], [p.n for p in parts])
        pos = np.concatenate([np.arange(p.n) if p.pos is None else np.frombuffer(p.pos, "<i8") for p in parts])
        order = np.lexsort((pos, block, ids))
        self.ids, self.block, self.pos = ids[order], block[order], pos[order]
        self.labels = np.concatenate([np.frombuffer(p.labels, "<i8") for p in parts])[order]
        self.rows = np.concatenate([np.frombuffer(p.rows, p.kind).reshape(-1, self.dim).astype(np.int64) for p in parts])[order]


def _scores(a: Side, c: Side) -> Iterator[tuple[int, np.ndarray]]:
    """Each anchor's number and its scores with all candidates."""
    turned = np.ascontiguousarray(c.rows.T)
    for i in range(0, len(a.ids), SLICE):
        yield from enumerate(strassen(a.rows[i : i + SLICE], turned), i)


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest scores, largest first; of equal ones the first places."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above, level = np.flatnonzero(scores > least), np.flatnonzero(scores == least)
        at = np.concatenate([above, level[: k - len(above)]])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((at, -scores[at]))]


PAIR = ["a_block", "a_pos", "anchor_id"]
FOUND = ["block", "pos", "id", "score"]


def _rows_of(a: Side, i: int, c: Side, at: np.ndarray, scores: np.ndarray, **more) -> dict:
    own = {"a_block": a.block[i], "a_pos": a.pos[i], "anchor_id": a.ids[i]} | more
    return {k: np.full(len(at), v) for k, v in own.items()} | {"block": c.block[at], "pos": c.pos[at], "id": c.ids[at], "score": scores}


def _table(parts: list[dict], columns: list[str]) -> pd.DataFrame:
    if not parts:
        return pd.DataFrame({c: np.empty(0, np.int64) for c in columns})
    return pd.DataFrame({c: np.concatenate([p[c] for p in parts]) for c in columns})


def _positives(k: int):
    def tile(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(left) and len(right):
            a, c = Side(left), Side(right)
            for i, scores in _scores(a, c):
                at = np.flatnonzero((c.labels == a.labels[i]) & ~((c.block == a.block[i]) & (c.pos == a.pos[i])))
                at = at[best(scores[at], k)]
                parts.append(_rows_of(a, i, c, at, scores[at]))
        return _table(parts, PAIR + FOUND)

    return tile


def _negatives(k: int, low: int, high: int):
    def tile(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(left) and len(right):
            a, c = Side(left), Side(right)
            known = {}
            for block, pairs in zip(left["block"], left["pairs"]):
                for p in pairs:
                    known.setdefault((block, p["a_pos"]), []).append(p)
            for i, scores in _scores(a, c):
                other = np.flatnonzero(c.labels != a.labels[i])
                own = scores[other]
                for p in known.get((a.block[i], a.pos[i]), ()):
                    ps = p["score"]
                    fits = np.flatnonzero((100 * own >= low * ps) & (100 * own <= high * ps))
                    at = fits[best(own[fits], k)]
                    parts.append(_rows_of(a, i, c, other[at], own[at], nth=p["nth"], positive_id=p["id"], positive_score=ps))
        return _table(parts, PAIR + ["nth", "positive_id", "positive_score"] + FOUND)

    return tile


def _dealt(blocks: DataFrame, group: Column, own: str, other: str, n_other: int) -> DataFrame:
    """The blocks of one side under every tile of their group."""
    cols = ["block", "dim", "n", "kind", "pos", "ids", "labels", "rows"]
    cols += [c for c in ("pairs",) if c in blocks.columns]
    return blocks.select(*cols, group.alias(own), F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other))


def mine(
    vectors: DataFrame,
    asked: Column,
    key: str = "vec_id",
    label: Column | str = "label",
    vector: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    tile: tuple[int, int] = (ANCHORS, CANDIDATES),
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the anchors, the rows ``asked`` for."""
    label = F.col(label) if isinstance(label, str) else label
    rows = usable(vectors, F.col(key), label, F.col(vector), asked)
    blocks = cut_lineage(with_code(rows).mapInPandas(_blocks, f"{PACKED}, asked binary, n_asked long, top double"))
    blocks = blocks.withColumn("block", F.monotonically_increasing_id())
    total = blocks.agg(F.sum("n").alias("n"), F.sum("n_asked").alias("n_asked"), F.max("top").alias("top"), F.max("dim").alias("dim")).first()
    if total["n"] and total["top"] ** 2 * total["dim"] >= LIMIT:
        raise ValueError(f"scores of these vectors may pass {LIMIT}")
    n_a, n_c = (max(1, -(-(n or 0) // fitting(t, total["dim"] or 1))) for n, t in zip((total["n_asked"], total["n"]), tile))

    held = cut_lineage(blocks.where("n_asked > 0").mapInPandas(_asked, f"{PACKED}, block long, pos binary"))
    group = lambda n: F.pmod(F.xxhash64("block"), F.lit(n)).cast("int")
    candidates = _dealt(blocks.withColumn("pos", F.lit(None).cast("binary")), group(n_c), "c_group", "a_group", n_a)
    at = ["dim", "a_group", "c_group"]

    def over_tiles(anchors: DataFrame, work, shape: str) -> DataFrame:
        left = _dealt(anchors, group(n_a), "a_group", "c_group", n_c).groupBy(*at)
        return left.cogroup(candidates.groupBy(*at)).applyInPandas(work, shape)

    order = [F.desc("score"), "id", "block", "pos"]
    pair = ", ".join(f"{c} long" for c in PAIR)
    found = ", ".join(f"{c} long" for c in FOUND)
    near = over_tiles(held, _positives(positives), f"{pair}, {found}")
    near = near.withColumn("nth", F.row_number().over(W.partitionBy("a_block", "a_pos").orderBy(*order)).cast("long"))
    near = near.where(F.col("nth") <= positives).groupBy(F.col("a_block").alias("block")).agg(
        F.collect_list(F.struct("a_pos", "nth", "id", "score")).alias("pairs")  # at most a block's anchors times their positives
    )
    known = cut_lineage(held.join(near, "block"))
    shape = f"{pair}, nth long, positive_id long, positive_score long, {found}"
    hard = over_tiles(known, _negatives(negatives, low, high), shape)
    rank = F.row_number().over(W.partitionBy("a_block", "a_pos", "nth").orderBy(*order))
    return hard.withColumn("rank", rank).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors, F.col("vec_id") % STRIDE == 0, label=noisy)


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.v) = len(c.v)
),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS nth FROM s WHERE same)
  WHERE nth <= 5
),
n AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
