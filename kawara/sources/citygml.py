"""City-model XML: building features, duplicate repair, file checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kawara.functions import geometry as g
from kawara.sources.geojson import with_shape

_S = T.StringType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_RING = _struct(LinearRing=_struct(posList=_S))
_POLYGON = _struct(Polygon=_struct(exterior=_RING, interior=T.ArrayType(_RING)))
_SURFACES = _struct(MultiSurface=_struct(surfaceMember=T.ArrayType(_POLYGON)))
_SOLID = _struct(
    Solid=_struct(exterior=_struct(CompositeSurface=_struct(surfaceMember=T.ArrayType(_POLYGON))))
)
_DETAIL = _struct(
    BuildingDetailAttribute=_struct(buildingStructureType=_S, fireproofStructureType=_S)
)

BUILDING_SCHEMA = _struct(
    _id=_S,
    measuredHeight=_S,
    yearOfConstruction=_S,
    storeysAboveGround=_S,
    storeysBelowGround=_S,
    usage=T.ArrayType(_S),
    buildingDetailAttribute=T.ArrayType(_DETAIL),
    bldgRealEstateIDAttribute=T.ArrayType(
        _struct(RealEstateIDAttribute=_struct(realEstateIDOfBuilding=_S))
    ),
    lod0RoofEdge=_SURFACES,
    lod0FootPrint=_SURFACES,
    lod1Solid=_SOLID,
    lod2Solid=_SOLID,
)

XML_OPTIONS = {"ignoreNamespace": "true", "attributePrefix": "_", "mode": "PERMISSIVE"}


def _positions(pos_list: Column) -> Column:
    """``lat lon height ...`` -> [[lon, lat, height], ...]"""
    v = F.transform(F.split(F.trim(pos_list), r"\s+"), lambda t: t.try_cast("double"))
    return F.transform(
        F.sequence(F.lit(0), F.floor(F.size(v) / 3).cast("int") - 1),
        lambda i: F.array(F.get(v, i * 3 + 1), F.get(v, i * 3), F.get(v, i * 3 + 2)),
    )


def _members(surfaces: Column) -> Column:
    """Surface members -> polygons: exterior ring first, then holes."""
    return F.transform(
        surfaces,
        lambda m: F.transform(
            F.concat(
                F.array(m["Polygon"]["exterior"]["LinearRing"]["posList"]),
                F.coalesce(
                    F.transform(m["Polygon"]["interior"], lambda r: r["LinearRing"]["posList"]),
                    F.array().cast("array<string>"),
                ),
            ),
            _positions,
        ),
    )


def _ground(polygons: Column) -> Column:
    """Of a solid's faces those at the bottom: walls and roofs would cancel it out."""
    top = lambda p: F.array_max(F.transform(F.get(p, F.lit(0)), lambda q: F.get(q, F.lit(2))))
    lowest = F.array_min(F.transform(polygons, top))
    return F.filter(polygons, lambda p: top(p) <= lowest + 1e-6)


def footprint_polygons() -> Column:
    """Polygons of the most detailed level a building has; solids give their ground."""

    def solid(name):
        return F.col(name)["Solid"]["exterior"]["CompositeSurface"]["surfaceMember"]

    def flat(name):
        return F.col(name)["MultiSurface"]["surfaceMember"]

    return F.coalesce(
        _ground(_members(solid("lod2Solid"))),
        _ground(_members(solid("lod1Solid"))),
        _members(flat("lod0FootPrint")),
        _members(flat("lod0RoofEdge")),
    )


def file_table(spark: SparkSession, path: str, pattern: str = "*.gml") -> DataFrame:
    """(file, bytes) below a folder, of a glob, or the file itself; an error when there is none.

    Spark lists the files and reads none of them; the names stay a table, however many there are.
    Spark's reader leaves out files of no bytes.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if not path.endswith(pattern.lstrip("*")):
        listing = listing.option("pathGlobFilter", pattern)
    files = listing.load(path).select(F.col("path").alias("file"), F.col("length").alias("bytes"))
    if files.isEmpty():
        raise FileNotFoundError(f"no {pattern} under {path}")
    return files


def input_files(spark: SparkSession, path: str, pattern: str = "*.gml") -> list[str]:
    """Sorted names in Python, for the files of one city; ``file_table`` keeps those of many as a table."""
    return sorted(r["file"] for r in file_table(spark, path, pattern).select("file").toLocalIterator())


def read_buildings(spark: SparkSession, path: str | list[str], tag: str = "Building") -> DataFrame:
    """One row per building element, straight from the XML (namespaces are dropped first)."""
    return spark.read.format("xml").options(rowTag=tag, **XML_OPTIONS).schema(BUILDING_SCHEMA).load(path)


def buildings_of_text(docs: DataFrame, text: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The same for one building element per row of text."""
    b = F.from_xml(text, BUILDING_SCHEMA, XML_OPTIONS)
    return docs.select(*keep, b.alias("b")).select(*keep, "b.*")


def as_footprints(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Building rows with raw attributes as the normaliser expects them, and their shape.

    Repeated real-estate ids are cut to the first one.
    """
    detail = F.transform("buildingDetailAttribute", lambda d: d["BuildingDetailAttribute"])
    df = raw.select(
        *keep,
        F.col("_id").alias("gml_id"),
        "measuredHeight",
        "yearOfConstruction",
        "storeysAboveGround",
        "storeysBelowGround",
        F.to_json("usage").alias("usage"),
        F.to_json(detail).alias("buildingDetailAttribute"),
        F.try_element_at("bldgRealEstateIDAttribute", F.lit(1))["RealEstateIDAttribute"]["realEstateIDOfBuilding"].alias("real_estate_id"),
        footprint_polygons().alias("polygons"),
    )
    return with_shape(df.where(F.size("polygons") > 0))


def duplicate_children(raw: DataFrame) -> DataFrame:
    """How many repeated real-estate ids were dropped, over all buildings."""
    extra = F.greatest(F.coalesce(F.size("bldgRealEstateIDAttribute"), F.lit(0)) - 1, F.lit(0))
    return raw.agg(F.coalesce(F.sum(extra), F.lit(0)).alias("removed"))


def files_with_marker(spark: SparkSession, path: str | list[str], marker: str) -> DataFrame:
    """(file, has_marker) by a line scan; files of any size are split over tasks."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").contains(marker).alias("hit")
    )
    return lines.groupBy("file").agg(F.bool_or("hit").alias("has_marker"))


def mercator_footprints(df: DataFrame) -> DataFrame:
    return df.withColumn("edges", g.mercator_edges(F.col("edges")))
