"""Weighted rendezvous hashing of record keys, and gapless slots inside each shard.

Every (key, shard) pair gets a score from a hash of both; a record goes to the shard with the
smallest ``-ln(u) / weight``. The choice depends on the key and the list of shards alone, so it
needs no shuffle and no state, and one more shard takes records only into itself: the scores of
the old shards do not change.

Slots number the records of a shard from 0. A shard is cut into chunks by a hash of the row; a
chunk is numbered in one task, and the chunks' offsets come from a running sum over chunk counts.
Chunks grow in number with the data, so a task never numbers a whole shard. Identical rows are
counted first and unfolded at the end, so a key that repeats without end never gathers in a task.

Defined results. NULL keys hash as the text "\\0null" and share a shard. NULL text has size 1 and
CRC 0. Repeated keys share a shard and get slots of their own. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kawara.llm.common import documents, row_hash, text_or_empty

SHARDS = 16
CHUNK_ROWS = 16_384
UNFOLD = 4_096


def _key(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("\0null"))


def _score(key: Column, shard: int, weight: float) -> Column:
    """Uniform in (0, 1) from 52 bits of the hash, then exponential with rate ``weight``."""
    bits = F.shiftrightunsigned(F.xxhash64(_key(key), F.lit(shard)), 12)
    u = (bits.cast("double") + 0.5) / float(1 << 52)
    return F.struct((-F.log(u) / float(weight)).alias("score"), F.lit(shard).alias("shard"))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key among ``len(weights)`` shards; ties go to the lower number."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive, one per shard")
    scores = [_score(key, i, w) for i, w in enumerate(weights)]
    best = scores[0] if len(scores) == 1 else F.least(*scores)
    return best.getField("shard")


def with_slots(rows: DataFrame, shard: str, key: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``slot``: gapless from 0 inside each shard, over all columns of narrow ``rows``."""
    cols = rows.columns
    folded = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    total = rows.count()
    chunks = max(1, -(-total // (chunk_rows * SHARDS)))
    # by all columns, so that one key (NULL) with many different rows is split as well
    chunk = F.pmod(row_hash(rows), F.lit(chunks)).alias("_chunk")
    folded = folded.select("*", chunk)
    inside = W.partitionBy(shard, "_chunk").orderBy(key, *[c for c in cols if c != key])
    first = folded.withColumn("_before", F.sum("_n").over(inside) - F.col("_n"))
    along = W.partitionBy(shard).orderBy("_chunk")
    offsets = (
        rows.select(shard, chunk)
        .groupBy(shard, "_chunk")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(shard, "_chunk", (F.sum("_n").over(along) - F.col("_n")).alias("_offset"))
    )
    placed = first.join(offsets, [shard, "_chunk"])
    start = F.col("_offset") + F.col("_before")
    blocks = placed.select(
        *cols, "_n", start.alias("_start"), F.explode(F.expr(f"sequence(0L, (_n - 1) div {UNFOLD})")).alias("_block")
    )
    each = F.explode(F.expr(f"sequence(_block * {UNFOLD}, least((_block + 1) * {UNFOLD}, _n) - 1)"))
    return blocks.select(*cols, "_start", each.alias("_i")).select(
        *cols, (F.col("_start") + F.col("_i")).cast("long").alias("slot")
    )


def assign(
    docs: DataFrame, key: str = "doc_id", text: str = "text", weights: Sequence[float] = (1.0,) * SHARDS
) -> DataFrame:
    """Key, size in bytes plus 1, CRC, shard, slot, and the shard with one more shard."""
    body = F.encode(text_or_empty(text), "UTF-8")
    placed = docs.select(
        F.col(key),
        (F.octet_length(text_or_empty(text)) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        shard_of(F.col(key), weights).alias("shard"),
    )
    out = with_slots(placed, "shard", key)
    grown = shard_of(F.col(key), [*weights, sum(weights) / len(weights)])
    return out.select(key, "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", grown.alias("grown_shard"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(documents(spark, sf_dir))
