"""Fill rates, coverage statistics and the rules a finished table must pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kawara import model
from kawara.functions import ids


def field_coverage(df: DataFrame, fields=model.COVERAGE_FIELDS, by: list[str] | None = None) -> DataFrame:
    """(by, field, share): share of rows with a value; empty text and arrays count as none.

    A field the table lacks, and any field of an empty table, has share 0. One pass.
    """
    by = by or []
    aggs = []
    for f in fields:
        if f not in df.columns:
            aggs.append(F.lit(0.0).alias(f))
            continue
        c, t = F.col(f), df.schema[f].dataType
        filled = c.isNotNull()
        if isinstance(t, T.StringType):
            filled = filled & (c != "")
        elif isinstance(t, T.ArrayType):
            filled = filled & (F.size(c) > 0)
        elif isinstance(t, (T.DoubleType, T.FloatType)):
            filled = filled & ~F.isnan(c)
        aggs.append(F.coalesce(F.avg(F.when(filled, 1.0).otherwise(0.0)), F.lit(0.0)).alias(f))
    wide = df.groupBy(*by).agg(*aggs)
    return wide.unpivot(by, list(fields), "field", "share")


def coverage_stats(df: DataFrame, kinds=model.HAZARD_KINDS) -> DataFrame:
    """(kind, covered_count, hit_count, n_<confidence>...) in one pass over the table."""
    kinds = [k for k in kinds if f"{k}_covered" in df.columns]
    aggs = []
    for k in kinds:
        value = F.col(model.hazard_value_column(k))
        hit = F.coalesce(value, F.lit(False)) if k == model.ZONE_KIND else F.coalesce(value > 0, F.lit(False))
        conf = F.coalesce(F.col(f"{k}_coverage_confidence"), F.lit("unknown"))
        aggs.append(
            F.struct(
                F.lit(k).alias("kind"),
                F.count_if(F.coalesce(F.col(f"{k}_covered"), F.lit(False))).alias("covered_count"),
                F.count_if(hit).alias("hit_count"),
                *[F.count_if(conf == c).alias(f"n_{c}") for c in model.CONFIDENCE_ORDER],
            ).alias(k)
        )
    return df.agg(F.array(*aggs).alias("s")).select(F.explode("s").alias("s")).select("s.*")


def confidence_breakdown(stats: DataFrame) -> DataFrame:
    """Coverage statistics with the confidence counts as a map without zero entries."""
    entries = F.array(
        *[F.struct(F.lit(c).alias("k"), F.col(f"n_{c}").alias("v")) for c in model.CONFIDENCE_ORDER]
    )
    return stats.select(
        "kind",
        "covered_count",
        "hit_count",
        F.map_from_entries(F.filter(entries, lambda e: e.v > 0)).alias("coverage_confidence_breakdown"),
    )


def duplicate_uids(df: DataFrame, limit: int | None = None) -> DataFrame:
    dup = df.groupBy("building_uid").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return dup if limit is None else dup.orderBy(F.desc("n"), "building_uid").limit(limit)


def distinct_source_ids(df: DataFrame, kinds=model.HAZARD_KINDS) -> DataFrame:
    """(kind, source_id): every id the coverage columns mention."""
    lists = F.array(
        *[
            F.struct(F.lit(k).alias("kind"), F.col(f"{k}_coverage_source_ids").alias("ids"))
            for k in kinds
            if f"{k}_coverage_source_ids" in df.columns
        ]
    )
    # distinct lists first: there are few of them, whatever the number of rows
    csv = df.select(F.explode(lists).alias("l")).select("l.*").where("ids <> ''").distinct()
    one = csv.select("kind", F.explode(F.split("ids", ",")).alias("source_id"))
    return one.where("source_id <> ''").distinct()


def orphan_source_ids(df: DataFrame, known: DataFrame, kinds=model.HAZARD_KINDS) -> DataFrame:
    """Ids whose base form the manifest's sources do not list."""
    used = distinct_source_ids(df, kinds).withColumn("base_id", ids.base_source_id(F.col("source_id")))
    return used.join(known.select(F.col("source_id").alias("base_id")), "base_id", "left_anti")


def missing_columns(df: DataFrame) -> list[str]:
    have = set(df.columns)
    return [c for c in model.REQUIRED_COLUMNS if c not in have]


FINDING = "severity string, code string, message string, n bigint"


def verify_buildings(
    df: DataFrame,
    sources: DataFrame | None = None,
    expected_count: int | None = None,
    stats: DataFrame | None = None,
) -> DataFrame:
    """Findings (severity, code, message, n); a table is publishable when none is an error.

    ``sources`` (source_id) and ``expected_count`` come from the manifest; without them their
    rules are skipped and a missing manifest is reported.
    """
    spark = df.sparkSession
    fixed = [("error", "missing_column", f"column {c} is missing", 1) for c in missing_columns(df)]
    if sources is None:
        fixed.append(("error", "missing_manifest", "no manifest given", 1))
    out = [spark.createDataFrame(fixed, FINDING)]

    def rule(frame, severity, code, message):
        out.append(
            frame.select(
                F.lit(severity).alias("severity"),
                F.lit(code).alias("code"),
                message.alias("message"),
                F.col("n").cast("bigint").alias("n"),
            )
        )

    # row rules: one pass, one row of counts
    counts = [F.count(F.lit(1)).alias("rows")]
    row_rules = []
    for k in model.HAZARD_KINDS:
        cov, value = f"{k}_covered", model.hazard_value_column(k)
        if cov not in df.columns or value not in df.columns:
            continue
        hit = F.col(value) if k == model.ZONE_KIND else F.col(value) > 0
        counts.append(F.count_if(~F.col(cov) & hit).alias(f"bad_{k}"))
        severity = "warn" if k == model.ZONE_KIND else "error"
        row_rules.append((f"bad_{k}", severity, "honesty_violation", f"{value} set where {cov} is false"))
    if "attribution" in df.columns:
        counts.append(F.count_if(F.coalesce(F.col("attribution"), F.lit("")) == "").alias("bad_attr"))
        row_rules.append(("bad_attr", "error", "missing_attribution", "rows without attribution"))
    totals = df.agg(*counts)
    checks = [
        F.struct(
            F.lit(severity).alias("severity"), F.lit(code).alias("code"), F.lit(msg).alias("message"),
            F.col(c).cast("bigint").alias("n"),
        )
        for c, severity, code, msg in row_rules
    ]
    if expected_count is not None:
        checks.append(
            F.struct(
                F.lit("warn").alias("severity"),
                F.lit("manifest_count_mismatch").alias("code"),
                F.lit(f"the manifest counts {expected_count} buildings").alias("message"),
                F.when(F.col("rows") != expected_count, F.col("rows")).otherwise(0).cast("bigint").alias("n"),
            )
        )
    if checks:
        out.append(
            totals.select(F.explode(F.array(*checks)).alias("f")).select("f.*").where("n > 0")
        )

    if "building_uid" in df.columns:
        dup = duplicate_uids(df, limit=None).agg(F.count(F.lit(1)).alias("n"), F.min("building_uid").alias("first"))
        rule(
            dup.where("n > 0"), "error", "uid_not_unique",
            F.concat(F.lit("duplicate building_uid, first: "), F.col("first")),
        )
    if sources is not None:
        orphans = orphan_source_ids(df, sources)
        rule(
            orphans.withColumn("n", F.lit(1)), "warn", "orphan_source_id",
            F.concat(F.col("kind"), F.lit(" coverage names "), F.col("source_id"), F.lit(", not in the manifest")),
        )
        stats = coverage_stats(df) if stats is None else stats
        codes = sources.select(F.substring_index("source_id", "-", -1).alias("_code")).distinct()
        from kawara.functions.attributes import literal_map

        uncovered = stats.where("covered_count = 0").withColumn(
            "_code", F.try_element_at(literal_map(model.HAZARD_DIR_CODE), F.col("kind"))
        )
        present = codes.withColumn("_present", F.lit(True))
        rule(
            uncovered.join(present, "_code", "left").withColumn("n", F.lit(1)),
            "info",
            "no_coverage",
            F.concat(
                F.col("kind"),
                F.when(F.col("_present"), ": dataset present, but no building is covered").otherwise(
                    ": no dataset for this city"
                ),
            ),
        )
    result = out[0]
    for f in out[1:]:
        result = result.unionByName(f)
    return result


def is_publishable(findings: DataFrame, strict: bool = False) -> bool:
    bad = ["error", "warn"] if strict else ["error"]
    return findings.where(F.col("severity").isin(*bad)).isEmpty()
