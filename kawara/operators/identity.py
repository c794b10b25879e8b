"""Ids for footprints that came without one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kawara.operators import skew

BUCKETS = 256
COPIES = 10_000


def fill_missing_ids(footprints: DataFrame, *, floor: int = skew.HOT_FLOOR) -> DataFrame:
    """``footprints`` with a ``gml_id`` in every row; given ones stay.

    A missing id becomes ``synth_`` and a hash of the edges; where several rows without id share it,
    the second and later ones get ``-2``, ``-3`` and so on. Rows of one hash are put in the order of a
    hash of all their columns, so a rerun gives each row its id again; rows equal in all columns are
    counted, and made again from one of them with a number each.

    Nothing is stored, and of the other columns only those read later are moved. No task numbers a
    whole group: hashes of more than ``floor`` rows are numbered in buckets, many copies made in chunks.
    """
    cols = footprints.columns
    named = footprints.where("gml_id IS NOT NULL")

    def hashable(f):
        unordered = any(t in f.dataType.simpleString() for t in ("map<", "variant"))
        return F.to_json(F.struct(F.col(f"`{f.name}`"))) if unordered else F.col(f"`{f.name}`")

    every = [hashable(f) for f in footprints.schema]
    every += [F.col(f"`{c}`").isNull() for c in cols]
    none = footprints.where("gml_id IS NULL").select(
        "*", F.xxhash64("edges").alias("_h"), F.xxhash64(*every).alias("_r"), F.xxhash64(F.lit(1), *every).alias("_r2")
    )
    rest = [c for c in cols if c != "gml_id"]
    kinds = none.groupBy("_h", "_r", "_r2").agg(F.count(F.lit(1)).alias("_n"), *[F.first(f"`{c}`").alias(c) for c in rest])
    kinds = kinds.withColumn("_b", F.pmod("_r", F.lit(BUCKETS)))
    order = ("_b", "_r", "_r2")

    hot, _ = skew.crowding(none, ["_h"], floor=floor)
    if hot is None:
        before = F.sum("_n").over(W.partitionBy("_h").orderBy(*order)) - F.col("_n")
        kinds = kinds.withColumn("_before", before)
    else:
        # the rows of a hot hash are numbered inside buckets, the buckets by running sums
        kinds = kinds.join(F.broadcast(hot.select("_h", F.lit(True).alias("_hot"))), "_h", "left")
        kinds = kinds.withColumn("_b", F.when(F.col("_hot"), F.col("_b")).otherwise(-1))
        within = F.sum("_n").over(W.partitionBy("_h", "_b").orderBy(F.pmod("_r", F.lit(BUCKETS)), "_r", "_r2"))
        buckets = kinds.where("_hot").groupBy("_h", "_b").agg(F.sum("_n").alias("_n"))
        lower = F.sum("_n").over(W.partitionBy("_h").orderBy("_b")) - F.col("_n")
        buckets = buckets.select("_h", "_b", lower.alias("_lower"))
        kinds = kinds.withColumn("_before", within - F.col("_n")).join(buckets, ["_h", "_b"], "left")
        kinds = kinds.withColumn("_before", F.col("_before") + F.coalesce("_lower", F.lit(0)))

    kinds = kinds.select("_h", "_n", "_before", *[f"`{c}`" for c in rest])
    single = kinds.where(F.col("_n") <= COPIES).withColumn("_k", F.explode(F.expr("sequence(1L, _n)")))
    chunks = kinds.where(F.col("_n") > COPIES).withColumn("_c", F.explode(F.expr(f"sequence(0L, (_n - 1) div {COPIES})")))
    in_chunk = f"sequence(_c * {COPIES} + 1, least((_c + 1) * {COPIES}, _n))"
    many = chunks.repartition("_h", "_n", "_c").withColumn("_k", F.explode(F.expr(in_chunk))).drop("_c")
    both = single.unionByName(many)

    nth = F.col("_before") + F.col("_k")
    suffix = F.when(nth > 1, F.concat(F.lit("-"), nth.cast("string"))).otherwise("")
    made = F.concat(F.lit("synth_"), F.hex("_h"), suffix)
    filled = both.select(*[made.alias(c) if c == "gml_id" else F.col(f"`{c}`") for c in cols])
    return named.unionByName(filled)
