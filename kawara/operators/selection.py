"""Exact percentiles of a column without all its values in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kawara.session import cut_lineage


def exact_percentiles(df: DataFrame, col: str, shares: Sequence[float]) -> DataFrame:
    """(p): one row, the percentiles in the order of ``shares``, linear between neighbours.

    Equal values are counted first. The counts are dealt into ranges of values; running sums over one row
    per range say which ranges hold the wanted ranks, and only those are read on. NULLs don't count; of
    an empty column all percentiles are NULL.
    """
    if not shares or min(shares) < 0 or max(shares) > 1:
        raise ValueError("shares lie between 0 and 1")
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    counts = cut_lineage(counts.repartitionByRange("v").withColumn("part", F.spark_partition_id()))
    # one row per range: as many as shuffle partitions, whatever the data
    ranges = counts.groupBy("part").agg(F.sum("n").alias("n"), F.min("v").alias("least"))
    ranges = ranges.select(
        "part", "n",
        (F.sum("n").over(W.orderBy("least")) - F.col("n")).alias("before"),
        F.sum("n").over(W.partitionBy()).alias("total"),
    )
    place = [(F.col("total") - 1) * F.lit(float(q)) for q in shares]
    ranks = F.array_distinct(F.array(*[f(p).cast("long") for p in place for f in (F.floor, F.ceil)]))
    inside = F.filter(ranks, lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("n")))
    wanted = ranges.select("part", "before", "total", F.explode(inside).alias("rank"))  # two for each share, at most
    along = W.partitionBy("part", "rank").orderBy("v")
    reached = counts.join(F.broadcast(wanted), "part").withColumn("upto", F.col("before") + F.sum("n").over(along))
    found = reached.where(F.col("upto") > F.col("rank")).groupBy("rank").agg(F.min("v").alias("v"), F.max("total").alias("total"))
    one = found.agg(F.max("total").alias("total"), F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at"))

    def between(p):
        low, high = (F.try_element_at("at", f(p).cast("long")) for f in (F.floor, F.ceil))
        return F.when(low == high, low).otherwise(low + (p - F.floor(p)) * (high - low))

    return one.select(F.array(*map(between, place)).alias("p"))
