"""Writing the building table, tile tables, shards, the map export and JSON documents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kawara import model
from kawara.functions import geometry as g
from kawara.functions import wkb
from kawara.operators import coverage, quality, tiles


def with_geometry(df: DataFrame) -> DataFrame:
    """Binary ``geometry`` from ``polygons``, for other tools."""
    return df.withColumn("geometry", wkb.wkb_of(F.col("polygons")))


def with_shape(df: DataFrame) -> DataFrame:
    """``df`` with the bounds of its ``edges``, and ``geometry`` where it has ``polygons`` and no geometry yet."""
    df = df.withColumns(g.bbox(F.col("edges")))
    return with_geometry(df) if "polygons" in df.columns and "geometry" not in df.columns else df


def to_public_schema(df: DataFrame, extra: tuple[str, ...] = (), shape: bool = False) -> DataFrame:
    """Declared columns in declared order and type, then the named extra columns.

    With ``shape`` the edges, parts, bounds and, if there are polygons, the geometry go along, so that the stored
    table can be selected by box, clipped and joined again by polygon.
    """
    if shape:
        df = with_shape(df)
        extra = (*[f.name for f in model.SHAPE_FIELDS], *extra)
    cols = []
    for f in model.BUILDINGS_SCHEMA.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name != "geometry":
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols, *[c for c in extra if c in df.columns])


def write_buildings(df: DataFrame, path: str, *, cell: float = 0.005) -> None:
    """Parquet by city and year, rows of a file near each other on the ground.

    Range partitioning spreads a large city over many files, and sorting by cell lets box
    filters skip row groups.
    """
    cx, cy = F.floor(F.col("centroid_lon") / cell), F.floor(F.col("centroid_lat") / cell)
    (
        df.withColumn("_cx", cx)
        .withColumn("_cy", cy)
        .repartitionByRange("city_code", "dataset_year", "_cx", "_cy")
        .sortWithinPartitions("city_code", "dataset_year", "_cx", "_cy")
        .drop("_cx", "_cy")
        .write.mode("overwrite")
        .partitionBy("city_code", "dataset_year")
        .parquet(path)
    )


def read_buildings(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The stored table; codes in its folder names stay text.

    ``schema``, as from ``model.stored_schema``, spares reading a footer and fixes names and types: declared
    columns that a file lacks are NULL, others are not read.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path).select(*[f.name for f in schema.fields])
    df = spark.read.option("mergeSchema", "false").parquet(path)
    fixed = {f.name: F.col(f.name).cast(f.dataType) for f in model.BUILDINGS_SCHEMA.fields if f.name in ("city_code", "dataset_year") and f.name in df.columns}
    if "city_code" in fixed and df.schema["city_code"].dataType.typeName() != "string":
        # read with type inference on: restore the leading zeros of five-digit codes
        fixed["city_code"] = F.lpad(F.col("city_code").cast("string"), 5, "0")
    return df.withColumns(fixed)


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def replace_buildings(df: DataFrame, path: str, *, cell: float = 0.005) -> None:
    """Overwrite a table the plan itself reads: write beside it, then swap the folders.

    The old table is moved aside first and removed last, so a failure at any point leaves a
    complete table under one of the two names.
    """
    spark, tag = df.sparkSession, uuid.uuid4().hex[:8]
    new, old = f"{path}.new-{tag}", f"{path}.old-{tag}"
    write_buildings(df, new, cell=cell)
    target, fs = _hadoop(spark, path)
    new_p, old_p = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (new, old))
    had = fs.exists(target)
    if had and not fs.rename(target, old_p):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new_p, target):
        if had:
            fs.rename(old_p, target)
        raise OSError(f"cannot move {new} to {path}")
    if had:
        fs.delete(old_p, True)


#: The folder of the table without rows that stands for every empty tile; readers of the whole skip it.
EMPTY_STYLE = "_empty"


def write_style_tables(rows: DataFrame, path: str, block: int = 100_000) -> None:
    """One folder of attribute rows per tile, and one empty table; rows without a tile are dropped.

    ``tile_content_uri`` is the partition column, so the file itself does not repeat it. A tile of more
    than ``block`` features is written by several tasks, a file for each block of feature ids.
    """
    part = F.floor(F.coalesce("tile_feature_id", F.lit(0)) / block)
    (
        rows.where(F.col("tile_content_uri").isNotNull())
        .repartition("tile_content_uri", part)
        .sortWithinPartitions("tile_content_uri", "tile_feature_id")
        .write.mode("overwrite")
        .partitionBy("tile_content_uri")
        .parquet(path)
    )
    rows.drop("tile_content_uri").limit(0).write.mode("overwrite").parquet(f"{path}/{EMPTY_STYLE}")


def stored_tiles(spark: SparkSession, path: str) -> DataFrame:
    """(tile_content_uri, style_path, n_rows) of the tables that ``write_style_tables`` put there.

    Paths are the folders as they are, relative to ``path``; only footers and names are read.
    """
    rows = spark.read.schema("tile_feature_id int, tile_content_uri string").parquet(path)
    folder = F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)/[^/]+$", 1)  # a URI: its own escapes go, those of the name stay
    named = rows.select("tile_content_uri", F.url_decode(F.regexp_replace(folder, r"\+", "%2B")).alias("style_path"))
    return named.groupBy("tile_content_uri", "style_path").agg(F.count(F.lit(1)).alias("n_rows"))


def write_tile_index(contents: DataFrame, rows: DataFrame | None, path: str, style: str | None = None) -> None:
    """uri, style path and row count of every tile, as JSON lines in uri order.

    With ``style``, the folder given to ``write_style_tables``, paths and counts are those of the tables
    stored there and tiles without rows get the path of the empty table; ``rows`` is not read then.
    """
    if style is None:
        index = tiles.tile_index(contents, rows)
    else:
        every = contents.select(F.col("uri").alias("tile_content_uri")).distinct()
        index = every.join(stored_tiles(contents.sparkSession, style), "tile_content_uri", "left").select(
            "tile_content_uri", F.coalesce("style_path", F.lit(EMPTY_STYLE)).alias("style_path"), F.coalesce("n_rows", F.lit(0)).alias("n_rows")
        )
    index.orderBy("tile_content_uri").write.mode("overwrite").json(path)


def write_ward_shards(df: DataFrame, path: str) -> None:
    """One shard per city and ward; ``unassigned`` holds the rest. Needs ``ward_code``."""
    df.repartition("city_code", "ward_code", F.pmod(F.xxhash64("building_uid"), F.lit(64))).write.mode(
        "overwrite"
    ).partitionBy("city_code", "ward_code").parquet(path)


def map_features(df: DataFrame) -> DataFrame:
    """(value): one GeoJSON feature per building with all map properties, NULL where there is none."""
    return df.select(_feature(df).alias("value"))


def _feature(df: DataFrame):
    kinds = {f.name: f.dataType for f in model.BUILDINGS_SCHEMA.fields}
    props = [(F.col(c) if c in df.columns else F.lit(None).cast(kinds[c])).alias(c) for c in model.MAP_PROPERTIES]
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(
            F.lit("MultiPolygon").alias("type"),
            F.expr("transform(polygons, p -> transform(p, r -> transform(r, q -> slice(q, 1, 2))))").alias("coordinates"),
        ).alias("geometry"),
        F.struct(*props).alias("properties"),
    )
    return F.to_json(feature, {"ignoreNullFields": "false"})


def write_map_features(df: DataFrame, path: str) -> None:
    map_features(df).write.mode("overwrite").text(path)


def map_tiles(df: DataFrame, min_zoom: int = 10, max_zoom: int = 16) -> DataFrame:
    """Each building once per zoom with the map tile (z, x, y) of its point."""
    zoomed = df.withColumn("z", F.explode(F.sequence(F.lit(min_zoom), F.lit(max_zoom))))
    return zoomed.withColumn("x", g.tile_x(F.col("centroid_lon"), F.col("z"))).withColumn(
        "y", g.tile_y(F.col("centroid_lat"), F.col("z"))
    )


def map_tile_features(df: DataFrame, min_zoom: int = 10, max_zoom: int = 16) -> DataFrame:
    """(z, x, y, building_uid, value): each building's feature in every tile that its footprint meets."""
    whole = df.withColumn("_feature", _feature(df)).select("building_uid", "edges", "_feature")
    return coverage.map_cover(whole, min_zoom, max_zoom).select("z", "x", "y", "building_uid", F.col("_feature").alias("value"))


def write_map_tiles(df: DataFrame, path: str, min_zoom: int = 10, max_zoom: int = 16) -> None:
    """Parquet, a folder per zoom, rows in the order of their tiles.

    Files hold ranges of tiles, and a reader of one tile skips the others by their statistics; the rows
    of a tile over a whole city are split among several tasks.
    """
    order = ["z", "x", "y", "building_uid"]
    rows = map_tile_features(df, min_zoom, max_zoom).repartitionByRange(*order).sortWithinPartitions(*order)
    rows.write.mode("overwrite").partitionBy("z").parquet(path)


def manifest(
    buildings: DataFrame,
    entries: DataFrame,
    *,
    attribution: str,
    tool_version: str,
    notes: list[str] | None = None,
) -> DataFrame:
    """(value): the manifest as one JSON text.

    ``entries`` are the catalog entries of one city and year. Counts, statistics and fill
    rates are aggregates; only their single rows meet here. Of several entries of one dataset the
    one of the latest year counts, then of the greatest url.
    """
    latest = F.max_by(F.struct("city_code", "city_name", "dataset_year", "year", "url", "coverage_extent_url"), F.struct("year", "url", "coverage_extent_url"))
    entries = entries.groupBy("dataset_id").agg(latest.alias("e")).select("dataset_id", "e.*")
    head = entries.agg(
        F.first("city_code").alias("city_code"),
        F.first("city_name").alias("city_name"),
        F.first("dataset_year").alias("dataset_year"),
        F.array_sort(F.collect_set("dataset_id")).alias("datasets"),
        F.map_from_entries(
            F.array_sort(
                F.collect_set(
                    F.struct(
                        F.col("dataset_id"),
                        F.struct(
                            F.col("dataset_id").alias("source_id"), "dataset_id", "year", "url", "coverage_extent_url"
                        ),
                    )
                )
            )
        ).alias("sources"),
    )
    stats = quality.confidence_breakdown(quality.coverage_stats(buildings)).agg(
        F.collect_list(
            F.struct("kind", "covered_count", "hit_count", "coverage_confidence_breakdown")
        ).alias("coverage_stats")
    )
    fill = quality.field_coverage(buildings).agg(
        F.map_from_entries(F.collect_list(F.struct("field", "share"))).alias("field_coverage")
    )
    doc = head.select(
        F.lit(attribution).alias("attribution"),
        F.lit("kawara").alias("tool"),
        F.lit(tool_version).alias("tool_version"),
        F.current_timestamp().alias("generated_at"),
        "city_code",
        "city_name",
        "dataset_year",
        buildings.agg(F.count(F.lit(1))).scalar().alias("n_buildings"),
        "datasets",
        "sources",
        stats.scalar().alias("coverage_stats"),
        fill.scalar().alias("field_coverage"),
        F.array(*[F.lit(n) for n in notes or []]).cast("array<string>").alias("notes"),
    )
    return doc.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def write_manifest(doc: DataFrame, path: str) -> None:
    doc.coalesce(1).write.mode("overwrite").text(path)
