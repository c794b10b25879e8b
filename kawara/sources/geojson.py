"""GeoJSON features as DataFrames."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kawara import model
from kawara.functions import attributes as at
from kawara.functions import geometry as g
from kawara.operators.coverage import bbox_overlap


#: Pieces between commas in which the first feature of a collection has to begin.
_HEAD_PIECES = 200


def feature_schema(properties: T.StructType) -> T.StructType:
    """Coordinates stay JSON text: their nesting differs between geometry types."""
    return T.StructType(
        [
            T.StructField("id", T.StringType()),
            T.StructField("properties", properties),
            T.StructField(
                "geometry",
                T.StructType(
                    [T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())]
                ),
            ),
        ]
    )


def _flatten(features: DataFrame, properties: T.StructType, keep: list[str]) -> DataFrame:
    named = [n for n in properties.names if n not in ("id", "gml_id")]
    ids = [F.col("f.id")]
    for alias in ("id", "gml_id"):
        if alias in properties.names:
            ids.append(F.col(f"f.properties.{alias}").cast("string"))
    polygons = g.geojson_polygons(F.col("f.geometry.type"), F.col("f.geometry.coordinates"))
    df = features.select(
        *keep,
        F.coalesce(*ids).alias("gml_id"),
        *[F.col("f.properties")[n].alias(n) for n in named],
        polygons.alias("polygons"),
    )
    return df.where(F.size("polygons") > 0)


def with_shape(df: DataFrame) -> DataFrame:
    """``polygons`` (rings of positions) -> parts, edges, bounds, and whether rings close."""
    df = df.withColumn("parts", g.parts_of(F.col("polygons")))
    df = df.withColumn("edges", g.edges_of(F.col("parts")))
    return df.withColumns(
        {**g.bbox(F.col("edges")), "rings_closed": g.all_rings_closed(F.col("polygons"))}
    ).where(F.size("edges") > 0)


def feature_border(spark: SparkSession, path: str | list[str]) -> str | None:
    """The text that begins every feature, spaces and line feeds included, as the first feature has it.

    None where features don't begin with their type, or there are none. Reads the first pieces only.
    """
    head = ",".join(r["value"] for r in spark.read.text(path, lineSep=",").limit(_HEAD_PIECES).collect())
    found = re.search(r'"features"\s*:\s*\[\s*(\{\s*"type"\s*:\s*"Feature"\s*,)', head)
    return found[1] if found else None


def collection_features(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """(f): the features of FeatureCollection files.

    Files are cut where a feature begins, so many tasks read one large file. Every piece has to be a
    whole feature: files written in several ways, or features inside properties, raise an error.
    Where features don't begin with their type, a file is read as one document by one task.
    """
    border = feature_border(spark, path)
    if border is None:
        outer = T.StructType([T.StructField("features", T.ArrayType(schema))])
        return spark.read.schema(outer).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    value = F.regexp_replace("value", "^[\\s\ufeff]+", "")
    pieces = spark.read.text(path, lineSep=border).select(F.col("_metadata.file_path").alias("file"), value.alias("value"))
    # what stands before the first feature is an object that opens the list, or closes it at once
    head = F.col("value").startswith("{")
    opens = F.col("value").rlike(r'(?s)"features"\s*:\s*\[\s*(\]|$)')
    checked = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    text = F.concat(F.lit(border), "value")
    parsed = pieces.select("file", head.alias("head"), opens.alias("opens"), F.from_json(text, checked, {"columnNameOfCorruptRecord": "_bad"}).alias("f"))
    wrong = F.when(F.col("head"), ~F.col("opens")).otherwise(F.col("f").isNull() | F.col("f._bad").isNotNull())
    error = F.raise_error(F.concat(F.lit("not cut at whole features: "), "file")).cast("boolean")
    return parsed.where(F.when(wrong, error).otherwise(~F.col("head"))).select("f")


def read_features(
    spark: SparkSession,
    path: str | list[str],
    properties: T.StructType,
    *,
    collection: bool = False,
    mercator: bool = False,
) -> DataFrame:
    """gml_id, properties, polygons, parts, edges and bounds of every polygon feature.

    One feature per line, or with ``collection=True`` FeatureCollection files (``collection_features``).
    Several paths are one layer. ``mercator`` says that coordinates are Web-Mercator metres; they
    are turned into degrees.
    """
    schema = feature_schema(properties)
    if collection:
        features = collection_features(spark, path, schema)
    else:
        features = spark.read.schema(schema).json(path).select(
            F.struct("id", "properties", "geometry").alias("f")
        )
    df = _flatten(features, properties, [])
    return with_shape(_from_mercator(df) if mercator else df)


def features_of_text(
    lines: DataFrame, properties: T.StructType, text: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """The same for features that are JSON text in a column."""
    parsed = lines.select(*keep, F.from_json(text, feature_schema(properties)).alias("f"))
    return with_shape(_flatten(parsed, properties, list(keep)))


def _from_mercator(df: DataFrame) -> DataFrame:
    """Inverse of the Web-Mercator projection on every position."""
    r = g.num(g.EARTH_RADIUS_M)
    position = f"array(degrees(p[0] / {r}), degrees(2D * atan(exp(p[1] / {r})) - pi() / 2D))"
    text = f"transform(polygons, part -> transform(part, ring -> transform(ring, p -> {position})))"
    return df.withColumn("polygons", F.expr(text))


# --- layers ------------------------------------------------------------------------


def as_hazard_layer(
    features: DataFrame, kind: str, source_id: str, bbox: tuple[float, float, float, float] | None = None
) -> DataFrame:
    """Hazard polygons of one source with depth or zone flag; ``bbox`` keeps those that meet it."""
    df = at.with_depth(features, kind)
    if bbox is not None:
        df = bbox_overlap(df, *bbox)
    depth = F.col("depth_m") if "depth_m" in df.columns else F.lit(None).cast("double")
    zone = F.col("in_zone") if "in_zone" in df.columns else F.lit(False)
    return df.select(
        F.lit(kind).alias("kind"),
        F.lit(source_id).alias("source_id"),
        F.lit(source_id).alias("dataset_id"),
        F.coalesce("gml_id", F.hex(F.xxhash64("edges"))).alias("poly_id"),
        depth.alias("depth_m"),
        zone.alias("in_zone"),
        "edges",
        "minx",
        "miny",
        "maxx",
        "maxy",
    )


# --- fixed values: attribute names a zoning layer may use ---------------------------
ZONING_USE_COLUMNS = ("urf:function", "function", "useDistrict", "用途地域")
ZONING_FAR_COLUMNS = ("urf:floorAreaRatio", "floorAreaRatio", "容積率")


def _first_named(df: DataFrame, names: tuple[str, ...]):
    for n in names:
        if n in df.columns:
            return F.col(f"`{n}`")
    return None


def as_zoning_layer(features: DataFrame) -> DataFrame:
    """zone_seq, zoning_use, far_max, edges; the sequence orders zones by their id."""
    use, far = _first_named(features, ZONING_USE_COLUMNS), _first_named(features, ZONING_FAR_COLUMNS)
    return features.select(
        F.coalesce("gml_id", F.hex(F.xxhash64("edges"))).alias("zone_seq"),
        (use if use is not None else F.lit(None)).cast("string").alias("zoning_use"),
        (at.number(far) if far is not None else F.lit(None)).cast("float").alias("far_max"),
        "edges",
    )


def admin_of(features: DataFrame, city_code: str) -> DataFrame:
    """Polygons of a city itself; ward rows have a parent and are left out."""
    rows = features.where(F.col("city_code") == city_code)
    if "parent_city_code" in features.columns:
        rows = rows.where(F.coalesce("parent_city_code", F.lit("")) == "")
    return rows


def wards_of(features: DataFrame, parent_city_code: str) -> DataFrame:
    rows = features.where(F.col("parent_city_code") == parent_city_code)
    return rows.withColumn("ward_code", F.col("city_code")).withColumn("ward_seq", F.col("city_code"))


def hazard_feature_class(kind: str) -> str:
    return model.HAZARD_FEATURE_CLASS[kind]
