"""Hot keys: find them, salt them, join around them.

Before a join on grid cells or graph nodes, one map-side-combined count per key finds the keys
with more than ``floor`` rows; the ``1 / share`` largest of them, at most, come back to the
driver. That bound is what makes broadcasting them safe at any scale. Where nothing is hot,
which is the usual case, the join is planned without any salting at all.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kawara.session import cut_lineage

HOT_SHARE = 1e-4
HOT_FLOOR = 1_000_000
ROWS_PER_TASK = 100_000


def crowding(
    df: DataFrame, keys: list[str], share: float = HOT_SHARE, floor: int = HOT_FLOOR
) -> tuple[DataFrame | None, int]:
    """The hot keys (see ``hot_keys``) and how many tasks the rows are to be shuffled to.

    The number grows with the rows, so that no task does.
    """
    spark = df.sparkSession
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    n, most = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_n"), F.lit(0))).first()
    pieces = math.ceil(n / ROWS_PER_TASK)
    if most <= floor:
        return None, pieces
    top = counts.where(F.col("_n") > floor).orderBy(F.desc("_n")).limit(int(1 / share)).collect()
    piece = max(floor, share * sum(r["_n"] for r in top))
    rows = [(*[r[k] for k in keys], math.ceil(r["_n"] / piece)) for r in top]
    ddl = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    return spark.createDataFrame(rows, f"{ddl}, n_salt int").where("n_salt > 1"), pieces


def hot_keys(
    df: DataFrame, keys: list[str], share: float = HOT_SHARE, floor: int = HOT_FLOOR
) -> DataFrame | None:
    """(keys, n_salt): the hot keys and into how many pieces to split each; None if none is.

    At most ``1 / share`` keys, and at most about twice as many pieces in all.
    """
    return crowding(df, keys, share, floor)[0]


def spread_rows(df: DataFrame, *keys: str, rows: int = 250_000) -> DataFrame:
    """``df`` shuffled by keys to tasks of about so many rows, for aggregates whose small rows Spark would
    read by the million in one task: it cuts shuffles by their compressed size. Counts ``df`` first."""
    pieces = math.ceil(df.count() / rows)
    return df.repartition(pieces, *keys) if pieces > df.sparkSession.sparkContext.defaultParallelism else df


def dealt(df: DataFrame, pieces: int, *keys: str) -> DataFrame:
    """``df`` shuffled by keys to ``pieces`` tasks, for aggregates of what a join of so many tasks gave.

    Spark cuts shuffles by their compressed size, and by a fixed number: a task would grow with the rows.
    """
    spark = df.sparkSession
    if pieces <= spark.sparkContext.defaultParallelism:  # Spark's own number will do
        return df
    return df.repartition(max(pieces, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)


def shuffled_join(many: DataFrame, few: DataFrame, keys: list[str], pieces: int) -> DataFrame:
    """Inner join through a shuffle of both sides, never a broadcast.

    For sides that are made by exploding: Spark estimates them by what stood before, and would
    send through the driver a table that is far larger than it seems.
    """
    if pieces > many.sparkSession.sparkContext.defaultParallelism:  # else Spark's own number will do
        many, few = many.repartition(pieces, *keys), few.repartition(pieces, *keys)
    return many.hint("merge").join(few, keys)


def salted(
    many: DataFrame,
    few: DataFrame,
    keys: list[str],
    spread_by: list[str],
    hot: DataFrame | None,
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of a join and its keys, with a ``salt`` key added where keys are hot.

    Rows of a hot key on the ``many`` side are spread over its salts; the ``few`` side is
    repeated once per salt of its key. Other keys keep salt 0 and are not repeated.
    """
    if hot is None:
        return many, few, keys
    hot = F.broadcast(hot)
    m = many.join(hot, keys, "left").withColumn(
        "salt",
        F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("n_salt")), F.lit(0)).cast("int"),
    )
    f = few.join(hot, keys, "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("n_salt"), F.lit(1)) - 1))
    )
    return m.drop("n_salt"), f.drop("n_salt"), [*keys, "salt"]


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    key: str | list[str],
    weight: str,
    share: float = HOT_SHARE,
    floor: int = HOT_FLOOR,
) -> DataFrame:
    """Inner join with a table that has one row per key and knows each key's row count.

    The hot keys (at most ``1 / share``) are joined by broadcast, so that no task receives all
    rows of one key; the rest is a plain join.
    """
    hot = lookup.where(F.col(weight) > floor).orderBy(F.desc(weight)).limit(int(1 / share))
    hot = cut_lineage(hot.drop(weight))
    lookup = lookup.drop(weight)
    if hot.isEmpty():
        return big.join(lookup, key)
    keys = [key] if isinstance(key, str) else key
    around = big.join(F.broadcast(hot.select(*keys)), key, "left_anti")
    return big.join(F.broadcast(hot), key).unionByName(around.join(lookup, key))
