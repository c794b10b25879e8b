"""Schemas, enumerations and the fixed values the data model relies on."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: hazard kinds and confidence order -------------------------------

HAZARD_KINDS = ("river_flood", "inland_flood", "tsunami", "storm_surge", "landslide")
DEPTH_KINDS = ("river_flood", "inland_flood", "tsunami", "storm_surge")
ZONE_KIND = "landslide"

# weakest first: the position is the rank
CONFIDENCE_ORDER = ("unknown", "declared_full_admin", "inundation_bounded", "explicit_polygon")

# feature class that carries the polygons of each hazard kind
HAZARD_FEATURE_CLASS = {
    "river_flood": "WaterBody",
    "inland_flood": "WaterBody",
    "tsunami": "WaterBody",
    "storm_surge": "WaterBody",
    "landslide": "SedimentDisasterProneArea",
}

# directory code of each hazard kind, the last dash-separated part of a dataset id
HAZARD_DIR_CODE = {
    "river_flood": "fld",
    "inland_flood": "ifld",
    "tsunami": "tnm",
    "storm_surge": "htd",
    "landslide": "lsld",
}

HEIGHT_SOURCES = ("measured", "geometric", "floors_estimated", "footprint_fallback", "unknown")
STRUCTURES = ("wood", "rc", "steel", "src", "other")
USAGES = ("residential", "commercial", "industrial", "educational", "public", "other")

# --- fixed values: code-list labels ------------------------------------------------

STRUCTURE_LABELS = {
    "木造": "wood",
    "防火木造": "wood",
    "鉄筋コンクリート造": "rc",
    "鉄筋コンクリート(ＲＣ)造": "rc",
    "鉄骨造": "steel",
    "軽量鉄骨造": "steel",
    "鉄骨鉄筋コンクリート造": "src",
    "鉄骨鉄筋コンクリート(ＳＲＣ)造": "src",
    "レンガ造": "other",
    "コンクリートブロック造": "other",
    "石造": "other",
    "その他": "other",
    "不明": "other",
}

USAGE_LABELS = {
    "住宅": "residential",
    "共同住宅": "residential",
    "店舗等併用住宅": "residential",
    "店舗等併用共同住宅": "residential",
    "事務所": "commercial",
    "事務所建築物": "commercial",
    "店舗": "commercial",
    "業務施設": "commercial",
    "商業施設": "commercial",
    "工場": "industrial",
    "作業所": "industrial",
    "学校": "educational",
    "図書館・博物館": "educational",
    "文教厚生施設": "educational",
    "公共施設": "public",
    "官公庁施設": "public",
    "病院": "public",
    "厚生医療施設": "public",
    "神社・寺院": "public",
    "不明": "other",
    "その他": "other",
}

# --- fixed values: depth of a hazard rank, in metres -------------------------------

RANK_LABEL_DEPTH = {
    "0.5m未満": 0.5,
    "0.5m以上3m未満": 3.0,
    "3m以上5m未満": 5.0,
    "5m以上10m未満": 10.0,
    "10m以上20m未満": 20.0,
    "20m以上": 20.0,
}
RANK_NUMBER_DEPTH = {1: 0.5, 2: 3.0, 3: 5.0, 4: 10.0, 5: 15.0}

# --- fixed values: numeric rules ---------------------------------------------------

FLOOR_LIMIT = 200  # storey counts at or above are the 9999-style sentinel
FOOTPRINT_HEIGHT_M = 3.5  # height of a building known only as a footprint
TOUCH_EPS_M = 0.5  # largest gap inside one building complex
CONTAINMENT_THRESHOLD = 0.95  # share of hazard area a mapped extent must contain

# --- fixed values: city identifiers ------------------------------------------------

CITY_SLUGS = {
    "chiyoda": "13101", "chuo": "13102", "minato": "13103", "shinjuku": "13104",
    "bunkyo": "13105", "taito": "13106", "sumida": "13107", "koto": "13108",
    "shinagawa": "13109", "meguro": "13110", "ota": "13111", "setagaya": "13112",
    "shibuya": "13113", "nakano": "13114", "suginami": "13115", "toshima": "13116",
    "kita": "13117", "arakawa": "13118", "itabashi": "13119", "nerima": "13120",
    "adachi": "13121", "katsushika": "13122", "edogawa": "13123",
    "yokohama": "14100", "kamakura": "14204", "nagoya": "23100", "osaka": "27100",
    "fukuoka": "40130", "sapporo": "01100",
}

# --- geometry ----------------------------------------------------------------------

EDGE_TYPE = T.StructType(
    [T.StructField(n, T.DoubleType()) for n in ("x1", "y1", "x2", "y2")]
)
EDGES_TYPE = T.ArrayType(EDGE_TYPE)
PARTS_TYPE = T.ArrayType(T.ArrayType(EDGES_TYPE))  # parts -> rings -> edges


def hazard_value_column(kind: str) -> str:
    return f"{kind}_in_zone" if kind == ZONE_KIND else f"{kind}_depth_max"


def hazard_fields(kind: str) -> list[T.StructField]:
    """The five public columns of one hazard kind."""
    value = T.BooleanType() if kind == ZONE_KIND else T.FloatType()
    return [
        T.StructField(f"{kind}_covered", T.BooleanType()),
        T.StructField(f"{kind}_coverage_source_ids", T.StringType()),
        T.StructField(hazard_value_column(kind), value),
        T.StructField(f"{kind}_hit_source_ids", T.StringType()),
        T.StructField(f"{kind}_coverage_confidence", T.StringType()),
    ]


def hazard_column_names(kinds=HAZARD_KINDS) -> list[str]:
    return [f.name for k in kinds for f in hazard_fields(k)]


CORE_FIELDS = [
    T.StructField("building_uid", T.StringType(), False),
    T.StructField("gml_id", T.StringType()),
    T.StructField("city_code", T.StringType(), False),
    T.StructField("dataset_year", T.IntegerType(), False),
    T.StructField("source_file_id", T.StringType(), False),
    T.StructField("geometry", T.BinaryType(), False),
    T.StructField("centroid_lat", T.DoubleType()),
    T.StructField("centroid_lon", T.DoubleType()),
    T.StructField("year_built", T.IntegerType()),
    T.StructField("structure", T.StringType()),
    T.StructField("usage", T.StringType()),
    T.StructField("height", T.FloatType()),
    T.StructField("floors_above", T.ShortType()),
    T.StructField("floors_below", T.ShortType()),
    T.StructField("fire_resistance", T.StringType()),
    T.StructField("zoning_use", T.StringType()),
    T.StructField("far_max", T.FloatType()),
    T.StructField("tile_content_uri", T.StringType()),
    T.StructField("tile_feature_id", T.IntegerType()),
    T.StructField("source_url", T.StringType()),
    T.StructField("source_dataset_id", T.StringType()),
    T.StructField("attribution", T.StringType()),
]

BUILDINGS_SCHEMA = T.StructType(
    CORE_FIELDS + [f for k in HAZARD_KINDS for f in hazard_fields(k)]
)

# what a stored table carries beside them to be clipped, selected and joined again
SHAPE_FIELDS = [
    T.StructField("edges", EDGES_TYPE),
    T.StructField("parts", PARTS_TYPE),
    *[T.StructField(n, T.DoubleType()) for n in ("minx", "miny", "maxx", "maxy")],
]


def stored_schema(*, shape: bool = False, geometry: bool = False, extra: str = "") -> T.StructType:
    """The declared schema of a stored table; ``extra`` are further columns as DDL."""
    public = [f for f in BUILDINGS_SCHEMA.fields if geometry or f.name != "geometry"]
    return T.StructType(public + (SHAPE_FIELDS if shape else []) + (T.StructType.fromDDL(extra).fields if extra else []))


# columns a finished table must carry (geometry is optional there)
REQUIRED_COLUMNS = [f.name for f in BUILDINGS_SCHEMA.fields if f.name != "geometry"]

# attributes whose fill rate the manifest reports
COVERAGE_FIELDS = (
    "year_built", "structure", "usage", "height", "floors_above", "floors_below",
    "fire_resistance",
)

# columns of a per-tile attribute table
STYLE_COLUMNS = (
    "building_uid", "tile_feature_id", "year_built", "structure", "usage", "height",
    "complex_max_height", "complex_uid", "floors_above", "river_flood_covered",
    "river_flood_depth_max", "tsunami_covered", "tsunami_depth_max", "landslide_covered",
    "landslide_in_zone",
)

# properties of the 2D map export
MAP_PROPERTIES = (
    "building_uid", "year_built", "structure", "usage", "floors_above", "height",
) + tuple(
    name
    for k in HAZARD_KINDS
    for name in (
        f"{k}_covered",
        f"{k}_coverage_confidence",
        f"{k}_coverage_source_ids",
        hazard_value_column(k),
        f"{k}_hit_source_ids",
    )
)
