"""Exact top-k inner products over a bit-sliced index.

Vectors are quantised to integers and stored in blocks of ``BLOCK`` rows. A block holds, for every
component and every bit, one bitmap over its rows (a slice), with values shifted to be positive.
A query adds up the slices of all components, weighted by its own components, with carry-save
adders on whole bitmaps: negative weights take the complement of a slice, so all terms are positive
and every sum keeps the order of the inner products. The sum is again a set of slices; going from
the most significant one down, rows that must be among the best are separated from rows that still
may be, until ``k`` are found. Rows that tie at the boundary are taken by smaller id. Scores of the
chosen rows are then recomputed as plain inner products.

Blocks are cut from partitions as they stream by, without a shuffle; query blocks are repeated over
one key per index block and joined to it, which is the stated query set against all rows, in
blocks. Each tile gives ``k + 1`` rows per query, and the best of all tiles are kept. Among them a
query's own row, if it is there, is one of the rows with its id and vector, all alike: one is left out.

Defined results. Vectors that are NULL, empty or hold NULL or non-finite components, or whose id is
NULL, take no part. Vectors of another length than the query's are no candidates of it. Repeated
ids are rows of their own, as queries and as candidates. Fewer candidates than ``k`` give fewer rows.
Scores that might pass 2^62 raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kawara.llm.common import with_code
from kawara.session import cut_lineage

K = 5
STRIDE = 50
SCALE = 256
BLOCK = 8_192
QUERY_BLOCK = 128
LIMIT = 1 << 62


def quantised(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): components as integers, for the vectors that take part."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad)
    return good.select(
        F.col(key).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x * SCALE).cast("long")).alias("v")
    )


def _blocks(size: int):
    """Rows of a partition as blocks of equal dimension: ids and integers as bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}

        def block(dim: int) -> pd.DataFrame:
            ids, rows = zip(*held.pop(dim))
            order = np.argsort(ids, kind="stable")
            m = np.stack(rows)[order]
            kind = next(t for t in ("<i2", "<i4", "<i8") if (m == m.astype(t)).all())  # the narrowest that holds all
            top = float(np.abs(m.astype(float)).max())
            own = {"dim": dim, "kind": kind, "top": top, "ids": np.array(ids, "<i8")[order].tobytes(), "rows": m.astype(kind).tobytes()}
            return pd.DataFrame([own])

        for b in batches:
            for i, v in zip(b["id"], b["v"]):
                own = held.setdefault(len(v), [])
                own.append((i, np.asarray(v)))
                if len(own) >= size:
                    yield block(len(v))
        for dim in list(held):
            yield block(dim)

    return run


def slices(m: np.ndarray) -> tuple[np.ndarray, int, int]:
    """(component, bit, word) bitmaps of the values less their minimum; their bits; the minimum."""
    low = int(m.min())
    bits = max(1, (int(m.max()) - low).bit_length())
    n = -(-len(m) // 64) * 64
    up = np.zeros((m.shape[1], n), np.uint64)
    up[:, : len(m)] = (m.T - low).astype(np.uint64)
    packed = [np.packbits(((up >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), axis=1, bitorder="little") for b in range(bits)]
    return np.stack(packed, axis=1).view("<u8"), bits, low


def weighted_sum(sl: np.ndarray, query: np.ndarray) -> list[np.ndarray]:
    """Slices of the sum of all components times the query's, from the least significant one."""
    bits, size = sl.shape[1], np.abs(query)
    planes = np.where((query < 0)[:, None, None], ~sl, sl)
    columns: dict[int, list[np.ndarray]] = {}
    for shift in range(int(size.max()).bit_length()):
        own = planes[(size >> shift & 1).astype(bool)]
        for b in range(bits if len(own) else 0):
            columns.setdefault(shift + b, []).append(own[:, b])
    out, at, empty = [], 0, np.zeros(sl.shape[2], np.uint64)
    while any(k >= at for k in columns):
        held = columns.pop(at, [])
        layer = np.concatenate(held) if held else empty[None]
        while len(layer) > 1:  # full adders on all triples at once, a half adder on a last pair
            n = len(layer) // 3
            if n:
                a, b, c = layer[:n], layer[n : 2 * n], layer[2 * n : 3 * n]
                half = a ^ b
                columns.setdefault(at + 1, []).append((a & b) | (half & c))
                layer = np.concatenate([half ^ c, layer[3 * n :]])
            else:
                columns.setdefault(at + 1, []).append(layer[:1] & layer[1:])
                layer = layer[:1] ^ layer[1:]
        out.append(layer[0])
        at += 1
    return out


def best_rows(total: list[np.ndarray], allowed: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of the ``k`` largest sums among the allowed rows; of equal ones the first rows."""
    sure, maybe = np.zeros_like(allowed), allowed.copy()
    for s in reversed(total):
        both = sure | (maybe & s)
        n = int(np.bitwise_count(both).sum())
        if n > k:
            maybe &= s
        elif n < k:
            sure = both
            maybe &= ~s
        else:
            sure, maybe = both, np.zeros_like(maybe)
            break
    places = lambda m: np.flatnonzero(np.unpackbits(m.view(np.uint8), bitorder="little"))
    taken = places(sure)
    return np.concatenate([taken, places(maybe)[: max(0, k - len(taken))]])


def _search(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, index = None, None
        for b in batches:
            for r in b.itertuples(index=False):
                ids, m = np.frombuffer(r.ids, "<i8"), np.frombuffer(r.rows, r.kind).reshape(-1, r.dim).astype(np.int64)
                if last != r.block:
                    last, index = r.block, slices(m)[0]
                everything = np.packbits(np.arange(index.shape[2] * 64) < len(ids), bitorder="little").view("<u8")
                q_ids, q_rows = np.frombuffer(r.q_ids, "<i8"), np.frombuffer(r.q_rows, r.q_kind).reshape(-1, r.dim).astype(np.int64)
                out = []
                for i, (q, v) in enumerate(zip(q_ids, q_rows)):
                    top = best_rows(weighted_sum(index, v), everything, k)
                    twin = (ids[top] == q) & (m[top] == v).all(axis=1)
                    n = len(top)
                    out += zip([r.q_block] * n, [i] * n, [int(q)] * n, ids[top].tolist(), (m[top] @ v).tolist(), twin.tolist())
                yield pd.DataFrame(out, columns=["q_block", "q_row", "query_id", "vec_id", "score", "twin"])

    return run


def search(
    vectors: DataFrame, queries: DataFrame, k: int = K, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best rows of ``vectors`` for every row of ``queries``."""
    shape = "dim int, kind string, top double, ids binary, rows binary"
    index = cut_lineage(with_code(quantised(vectors, key, vector)).mapInPandas(_blocks(BLOCK), shape))
    index = index.withColumn("block", F.monotonically_increasing_id())
    asked = cut_lineage(quantised(queries, key, vector).mapInPandas(_blocks(QUERY_BLOCK), shape))
    asked = asked.select(
        "dim", "top", F.col("kind").alias("q_kind"), F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"),
        F.monotonically_increasing_id().alias("q_block"),
    )
    size = index.agg(F.count(F.lit(1)).alias("n"), F.max("top").alias("top"), F.max("dim").alias("dim")).first()
    widest = asked.agg(F.max("top")).first()[0] or 0.0
    if size["n"] and size["top"] * widest * size["dim"] >= LIMIT:
        raise ValueError(f"scores of these vectors may pass {LIMIT}")
    keys = max(1, size["n"])
    index = index.withColumn("at", F.pmod(F.xxhash64("block"), F.lit(keys)))
    asked = asked.withColumn("at", F.explode(F.expr(f"sequence(0L, {keys - 1}L)")))
    tiles = index.join(asked, ["dim", "at"]).select("dim", "block", "kind", "ids", "rows", "q_block", "q_kind", "q_ids", "q_rows")
    near = tiles.mapInPandas(_search(k + 1), "q_block long, q_row int, query_id long, vec_id long, score long, twin boolean")
    own = W.partitionBy("q_block", "q_row")
    near = near.withColumn("n", F.row_number().over(own.orderBy(F.desc("score"), "vec_id", F.desc("twin")))).where(F.col("n") <= k + 1)
    itself = F.min(F.when(F.col("twin"), F.col("n"))).over(own)
    near = near.withColumn("itself", itself).where("itself IS NULL OR n <> itself")
    near = near.withColumn("rank", F.when(F.col("n") > F.col("itself"), F.col("n") - 1).otherwise(F.col("n"))).where(F.col("rank") <= k)
    kind = queries.schema[key].dataType
    return near.select(F.col("query_id").cast(kind), "rank", F.col("vec_id").cast(kind), "score")


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(vectors, vectors.where(F.col("vec_id") % STRIDE == 0))


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""
