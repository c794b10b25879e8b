"""Year-to-year comparison of two building tables.

Everything is counted from one union and one aggregate per key instead of a join, so a key
with many copies costs nothing extra and keys of only one side come for free. Rows with equal
keys count as pairs (each old one with each new one), as an inner join would give.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kawara import model


def match_key(a: DataFrame, b: DataFrame) -> str:
    """``building_uid`` when both sides hold the same single year, else ``gml_id``.

    Reads the distinct years of both tables (two small lists).
    """
    if "dataset_year" not in a.columns or "dataset_year" not in b.columns:
        return "gml_id"

    def year(df):
        r = df.agg(F.min("dataset_year").alias("lo"), F.max("dataset_year").alias("hi")).first()
        return r.lo if r.lo == r.hi else None

    ya, yb = year(a), year(b)
    return "building_uid" if ya is not None and ya == yb else "gml_id"


def _sided(df: DataFrame, side: str, key: str, cols: list[str]) -> DataFrame:
    return df.select(F.col(key).alias("key"), F.lit(side).alias("side"), *cols)


def key_counts(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: n_a, n_b (rows) and n_matched, n_only_in_a, n_only_in_b (distinct keys)."""
    both = _sided(a, "a", key, []).unionByName(_sided(b, "b", key, []))
    per = both.groupBy("key").agg(
        F.count_if(F.col("side") == "a").alias("na"), F.count_if(F.col("side") == "b").alias("nb")
    )
    known = F.col("key").isNotNull()
    return per.agg(
        F.coalesce(F.sum("na"), F.lit(0)).alias("n_a"),
        F.coalesce(F.sum("nb"), F.lit(0)).alias("n_b"),
        F.count_if(known & (F.col("na") > 0) & (F.col("nb") > 0)).alias("n_matched"),
        F.count_if(known & (F.col("na") > 0) & (F.col("nb") == 0)).alias("n_only_in_a"),
        F.count_if(known & (F.col("na") == 0) & (F.col("nb") > 0)).alias("n_only_in_b"),
    )


def _shared_kinds(a: DataFrame, b: DataFrame) -> list[str]:
    return [
        k for k in model.HAZARD_KINDS if f"{k}_covered" in a.columns and f"{k}_covered" in b.columns
    ]


def hazard_deltas(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(kind, newly_covered, newly_hit, no_longer_hit, depth_grew, depth_shrank)."""
    kinds = _shared_kinds(a, b)
    valued = [
        k
        for k in kinds
        if model.hazard_value_column(k) in a.columns and model.hazard_value_column(k) in b.columns
    ]
    cols = [f"{k}_covered" for k in kinds] + [model.hazard_value_column(k) for k in valued]
    both = _sided(a, "a", key, cols).unionByName(_sided(b, "b", key, cols)).where("key IS NOT NULL")

    def hit(k):
        v = F.col(model.hazard_value_column(k))
        return F.coalesce(v if k == model.ZONE_KIND else v > 0, F.lit(False))

    old, new = F.col("side") == "a", F.col("side") == "b"
    aggs = []
    for k in kinds:
        cov = F.coalesce(F.col(f"{k}_covered"), F.lit(False))
        aggs += [F.count_if(old & ~cov).alias(f"{k}_a_unc"), F.count_if(new & cov).alias(f"{k}_b_cov")]
        if k in valued:
            aggs += [
                F.count_if(old & hit(k)).alias(f"{k}_a_hit"),
                F.count_if(old & ~hit(k)).alias(f"{k}_a_not"),
                F.count_if(new & hit(k)).alias(f"{k}_b_hit"),
                F.count_if(new & ~hit(k)).alias(f"{k}_b_not"),
            ]
    per = both.groupBy("key").agg(*aggs)

    def pairs(k, x, y):
        return F.coalesce(F.sum(F.col(f"{k}_{x}") * F.col(f"{k}_{y}")), F.lit(0))

    none = F.lit(None).cast("bigint")
    totals = per.agg(
        *[
            F.struct(
                F.lit(k).alias("kind"),
                pairs(k, "a_unc", "b_cov").alias("newly_covered"),
                (pairs(k, "a_not", "b_hit") if k in valued else none).alias("newly_hit"),
                (pairs(k, "a_hit", "b_not") if k in valued else none).alias("no_longer_hit"),
            ).alias(k)
            for k in kinds
        ]
    ).select(F.explode(F.array(*kinds)).alias("t")).select("t.*")

    depth_kinds = [k for k in valued if k != model.ZONE_KIND]
    if not depth_kinds:
        return totals.select("*", none.alias("depth_grew"), none.alias("depth_shrank"))
    # hits only, equal depths of a key collapsed, then a running count of the other side
    long = (
        both.select(
            "key",
            "side",
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(k).alias("kind"), F.col(f"{k}_depth_max").cast("double").alias("depth"))
                        for k in depth_kinds
                    ]
                )
            ).alias("d"),
        )
        .select("key", "side", "d.*")
        .where("depth > 0")
        .groupBy("key", "kind", "depth")
        .agg(F.count_if(old).alias("na"), F.count_if(new).alias("nb"))
    )
    before = Window.partitionBy("key", "kind").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    moves = (
        long.select(
            "kind",
            (F.col("nb") * F.coalesce(F.sum("na").over(before), F.lit(0))).alias("grew"),
            (F.col("na") * F.coalesce(F.sum("nb").over(before), F.lit(0))).alias("shrank"),
        )
        .groupBy("kind")
        .agg(F.sum("grew").alias("depth_grew"), F.sum("shrank").alias("depth_shrank"))
    )
    is_depth = F.col("kind") != model.ZONE_KIND
    return totals.join(moves, "kind", "left").withColumns(
        {c: F.when(is_depth, F.coalesce(c, F.lit(0))) for c in ("depth_grew", "depth_shrank")}
    )


def diff_buildings(a: DataFrame, b: DataFrame, key: str | None = None) -> tuple[str, DataFrame, DataFrame]:
    """Match key, key counts and hazard deltas of two tables."""
    key = key or match_key(a, b)
    if key not in a.columns or key not in b.columns:
        raise ValueError(f"diff key {key!r} missing in one of the inputs")
    return key, key_counts(a, b, key), hazard_deltas(a, b, key)


def id_sets(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(key, place): every distinct non-null id with ``both``, ``only_a`` or ``only_b``."""
    both = _sided(a, "a", key, []).unionByName(_sided(b, "b", key, [])).where("key IS NOT NULL")
    per = both.groupBy("key").agg(
        F.max(F.col("side") == "a").alias("in_a"), F.max(F.col("side") == "b").alias("in_b")
    )
    return per.select(
        "key",
        F.when(F.col("in_a") & F.col("in_b"), "both").when(F.col("in_a"), "only_a").otherwise("only_b").alias("place"),
    )
