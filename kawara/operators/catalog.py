"""Latest-per-key picks, listings and index maintenance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kawara.functions import geometry as g
from kawara.operators import selection


def latest_per(df: DataFrame, key: str, *order: str) -> DataFrame:
    """Whole rows with the greatest ``order`` per key, by aggregate (no sort, no window)."""
    rest = [c for c in df.columns if c != key]
    return (
        df.groupBy(key)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
        .select(key, "r.*")
    )


def upsert_index(index: DataFrame, new: DataFrame, keys=("city_code", "dataset_year")) -> DataFrame:
    """Index with the new entries in place of those with the same key, in key order."""
    kept = index.join(new.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(new).orderBy(*keys)


def catalog_listing(entries: DataFrame) -> DataFrame:
    """(city_code, dataset_year, themes): one line per city and year, themes joined."""
    label = F.coalesce(F.col("hazard_kind"), F.col("theme"))
    return (
        entries.groupBy("city_code", "dataset_year")
        .agg(F.array_join(F.array_sort(F.collect_set(label)), ",").alias("themes"))
        .orderBy("city_code", "dataset_year")
    )


def city_rollup(polygons: DataFrame, buildings: DataFrame) -> DataFrame:
    """(city_code, lon, lat, buildings): area-weighted centroid and building count, 0 if none."""
    sums = polygons.select("city_code", g.signed_sums(F.col("parts")).alias("s")).groupBy("city_code").agg(
        F.sum("s.a").alias("a"), F.sum("s.sx").alias("sx"), F.sum("s.sy").alias("sy")
    )
    n = buildings.groupBy("city_code").agg(F.count(F.lit(1)).alias("buildings"))
    return sums.join(n, "city_code", "left").select(
        "city_code",
        (F.col("sx") / (3 * F.col("a"))).alias("lon"),
        (F.col("sy") / (3 * F.col("a"))).alias("lat"),
        F.coalesce("buildings", F.lit(0)).cast("bigint").alias("buildings"),
    )


def top_categories(df: DataFrame, col: str, k: int = 8) -> DataFrame:
    """The k most frequent values; ties go to the smaller value."""
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), col)
        .limit(k)
    )


def spread(df: DataFrame, col: str, *, exact: bool = True, accuracy: int = 10_000) -> DataFrame:
    """Median and the 1 %, 99 % points with linear interpolation.

    ``exact`` selects the ranks in ranges of values; without it one sketch per task does.
    """
    shares = [0.01, 0.5, 0.99]
    found = selection.exact_percentiles(df, col, shares) if exact else df.agg(F.percentile_approx(col, shares, accuracy).alias("p"))
    return found.select(
        F.col("p")[0].alias("p01"), F.col("p")[1].alias("median"), F.col("p")[2].alias("p99")
    )
