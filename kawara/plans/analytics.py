"""The analytical queries users run over a finished building table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_by_attrs(b: DataFrame) -> DataFrame:
    return b.where("structure = 'wood' AND year_built < 1981").agg(F.count(F.lit(1)).alias("n"))


def decade_histogram(b: DataFrame) -> DataFrame:
    decade = (F.floor(F.col("year_built") / 10) * 10).cast("int")
    return (
        b.where("year_built IS NOT NULL")
        .groupBy(decade.alias("decade"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("decade")
    )


def at_risk_count(b: DataFrame, kind: str = "river_flood", deeper_than: float = 1.0) -> DataFrame:
    return b.where(F.col(f"{kind}_covered") & (F.col(f"{kind}_depth_max") > deeper_than)).agg(
        F.count(F.lit(1)).alias("n")
    )


def centroid_table(b: DataFrame, n: int = 1000) -> DataFrame:
    """First n buildings by id; the order makes a plain LIMIT repeatable."""
    return b.select("building_uid", "centroid_lon", "centroid_lat").orderBy("building_uid").limit(n)


def bbox_count(b: DataFrame, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    return b.where(F.col("centroid_lon").between(x0, x1) & F.col("centroid_lat").between(y0, y1)).agg(
        F.count(F.lit(1)).alias("n")
    )


def honesty_pivot(b: DataFrame, kind: str = "river_flood", deeper_than: float = 0.0) -> DataFrame:
    """Safe means surveyed without any depth: one below ``deeper_than`` is neither safe nor at risk."""
    covered, depth = F.col(f"{kind}_covered"), F.col(f"{kind}_depth_max")
    return b.agg(
        F.count_if(covered & (depth > deeper_than)).alias("at_risk"),
        F.count_if(covered & (depth > 0) & (depth <= deeper_than)).alias("shallow"),
        F.count_if(covered & (F.coalesce(depth, F.lit(0.0)) <= 0)).alias("surveyed_safe"),
        F.count_if(~covered).alias("unknown"),
    )


def deepest(b: DataFrame, kind: str = "river_flood", n: int = 100) -> DataFrame:
    """Covered buildings with a depth, deepest first, ties by id."""
    depth = f"{kind}_depth_max"
    return (
        b.where(F.col(f"{kind}_covered") & F.col(depth).isNotNull())
        .select("building_uid", depth)
        .orderBy(F.desc(depth), "building_uid")
        .limit(n)
    )


def require_rows(df: DataFrame, column: str | None = None) -> DataFrame:
    """The table itself, or an error when the selection or the column is empty."""
    if df.isEmpty():
        raise ValueError("no buildings in the selection")
    if column is not None and df.where(F.col(column).isNotNull()).isEmpty():
        raise ValueError(f"{column} is empty for every building")
    return df
