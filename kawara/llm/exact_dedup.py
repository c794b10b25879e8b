"""Exact duplicates by a tree of merges over runs of digests.

Every input partition is a run. Inside a run equal digests are merged at once; then runs are
merged ``FAN`` at a time, round by round, until one is left, each round keeping for every digest
its best identifier and its count. A round groups by (digest, run), so the work of one run is
spread over all tasks, and no task sees more than ``FAN`` rows of one digest however many copies
a text has. The answer then travels down the same tree, again ``FAN`` rows per digest at most.

A digest is verified: SHA-256, a second hash of another family and the length in bytes must all
agree. Texts themselves are read once and never shuffled.

Defined results. NULL text counts as empty, so all NULL and empty texts are one group. NULL ids
sort below all others. Rows repeated with the same id and text: exactly one of them is kept. An
empty table gives an empty result. Other columns are ignored by ``groups`` and untouched by
``deduplicate``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kawara.llm.common import ascii_lower, documents, remaining, same, text_or_empty
from kawara.session import cut_lineage

FAN = 8
DIGEST = ["_sha", "_hash", "_bytes"]


def _digests(docs: DataFrame, key: str, text: str) -> DataFrame:
    norm = docs.select(F.col(key).alias("_id"), ascii_lower(text_or_empty(text)).alias("_t"))
    return norm.select(
        "_id",
        F.unhex(F.sha2("_t", 256)).alias("_sha"),
        F.xxhash64("_t").alias("_hash"),
        F.octet_length("_t").alias("_bytes"),
    )


def leaves(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with its digest and the run it is in; written once, read often."""
    rows = _digests(docs, key, text).select(
        F.spark_partition_id().alias("_run"), F.monotonically_increasing_id().alias("_row"), "_id", *DIGEST
    )
    return cut_lineage(rows)


def _merge(rows: DataFrame, best, count) -> DataFrame:
    return rows.groupBy("_run", *DIGEST).agg(best.alias("_best"), count.alias("_n"))


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", largest: bool = True) -> DataFrame:
    """(row, id, digest, best, n): every row with the row that stays and the size of its group."""
    leaf = leaves(docs, key, text)
    pick = F.max if largest else F.min
    runs = 1 + (leaf.agg(F.max("_run")).first()[0] or 0)
    levels = [_merge(leaf, pick(F.struct("_id", "_row")), F.count(F.lit(1)))]
    while runs > 1:
        up = levels[-1].withColumn("_run", F.floor(F.col("_run") / FAN).cast("int"))
        levels.append(_merge(up, pick("_best"), F.sum("_n")))
        runs = -(-runs // FAN)
    # texts that occur once already know their answer: only repeated ones go down again
    known = levels[-1].where("_n > 1")
    for level in reversed(levels[:-1]):
        here = level.select(
            F.col("_run").alias("_child"), F.floor(F.col("_run") / FAN).cast("int").alias("_run"), *DIGEST
        )
        known = here.join(known, ["_run", *DIGEST]).select(
            F.col("_child").alias("_run"), *DIGEST, "_best", "_n"
        )
    out = leaf.join(known, ["_run", *DIGEST], "left")
    own = F.struct("_id", "_row")
    return out.select(
        "_row", "_id", *DIGEST, F.coalesce("_best", own).alias("_best"), F.coalesce("_n", F.lit(1)).alias("_n")
    )


def assign(docs: DataFrame, key: str = "doc_id", text: str = "text", largest: bool = True) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row."""
    return groups(docs, key, text, largest).select(
        F.col("_id").alias(key),
        F.col("_best._id").alias("keep_id"),
        F.col("_n").cast("long").alias("group_size"),
        (F.col("_row") == F.col("_best._row")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", largest: bool = True) -> DataFrame:
    """The rows of ``docs`` that stay, all columns."""
    lost = groups(docs, key, text, largest).where(F.col("_row") != F.col("_best._row"))
    gone = cut_lineage(lost.select(F.col("_id").alias("id"), F.col("_sha").alias("print"), same(F.col("_id"), F.col("_best._id")).alias("repeat")))
    return remaining(docs, gone, key, F.unhex(F.sha2(ascii_lower(text_or_empty(text)), 256)))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(documents(spark, sf_dir))


SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
