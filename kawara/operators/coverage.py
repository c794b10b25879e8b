"""Coverage and hazard joins, and the two polygon back-fills (zoning, wards).

The rule everything here serves: a building no survey covered is *unknown*. It carries no
depth, whatever polygons it lies in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kawara import model
from kawara.functions import geometry as g
from kawara.functions import ids as idf
from kawara.operators import skew, spatial

EXTENT, HAZARD = "extent", "hazard"


def with_point(buildings: DataFrame) -> DataFrame:
    """Representative point from ``parts``, as ``centroid_lon`` / ``centroid_lat``."""
    p = g.representative_point("parts")
    return (
        buildings.withColumn("_p", p)
        .withColumn("centroid_lon", F.col("_p.x"))
        .withColumn("centroid_lat", F.col("_p.y"))
        .drop("_p")
    )


def _layer_rows(extents: DataFrame | None, hazards: DataFrame | None) -> DataFrame:
    """Coverage extents and hazard polygons as one polygon table, told apart by ``role``."""
    frames = []
    if extents is not None:
        frames.append(
            extents.select(
                F.lit(EXTENT).alias("role"),
                "kind",
                "source_id",
                "poly_id",
                idf.confidence_rank(F.col("confidence")).alias("rank"),
                F.lit(None).cast("double").alias("depth_m"),
                F.lit(False).alias("in_zone"),
                "edges",
            )
        )
    if hazards is not None:
        zone = F.col("in_zone") if "in_zone" in hazards.columns else F.lit(None).cast("boolean")
        depth = F.col("depth_m") if "depth_m" in hazards.columns else F.lit(None).cast("double")
        frames.append(
            hazards.select(
                F.lit(HAZARD).alias("role"),
                "kind",
                "source_id",
                "poly_id",
                F.lit(0).alias("rank"),
                F.when(~F.isnan(depth), depth).alias("depth_m"),
                F.coalesce(zone, F.col("kind") == model.ZONE_KIND).alias("in_zone"),
                "edges",
            )
        )
    rows = frames[0]
    for f in frames[1:]:
        rows = rows.unionByName(f)
    return rows


def hazard_hits(
    buildings: DataFrame,
    extents: DataFrame | None,
    hazards: DataFrame | None,
    *,
    cell: float,
    mode: str = "point",
    large: bool = True,
    crowd: tuple[DataFrame | None, int] | None = None,
) -> DataFrame:
    """A row per building and polygon that holds it (point mode) or meets it (polygon mode, where some come twice)."""
    layers = _layer_rows(extents, hazards)
    cols = ["role", "kind", "source_id", "rank", "depth_m", "in_zone"]
    if mode == "point":
        points = buildings.select(
            "building_uid", F.col("centroid_lon").alias("px"), F.col("centroid_lat").alias("py")
        )
        return spatial.points_in_polygons(
            points, layers, cell=cell, point_cols=["building_uid"], poly_cols=cols, large=large, crowd=crowd
        )
    if mode == "polygon":
        keyed = layers.withColumn("poly_key", F.concat_ws("|", "role", "kind", "source_id", "poly_id"))
        return spatial.intersecting_pairs(
            buildings.select("building_uid", "edges"),
            keyed,
            cell=cell,
            left_cols=["building_uid"],
            right_cols=["poly_key", *cols],
            left_id="building_uid",
            right_id="poly_key",
            large=large,
            crowd=crowd,
            distinct=False,
        ).drop("poly_key")
    raise ValueError(f"mode must be 'point' or 'polygon', not {mode!r}")


def summarise_hits(hits: DataFrame, kinds=model.HAZARD_KINDS) -> DataFrame:
    """Hits -> one row per building with the five columns of every kind.

    One aggregate for all kinds: sources of any kind go into two sets, all else is a plain maximum. The
    columns of a kind that does not cover the building are null: its hits must not show.
    """
    cov, hit = F.col("role") == EXTENT, F.col("role") == HAZARD
    source = F.struct("kind", "source_id")
    sums = [F.collect_set(F.when(cov, source)).alias("cov_ids"), F.collect_set(F.when(hit, source)).alias("hit_ids")]
    for i, k in enumerate(kinds):
        own = F.col("kind") == k
        value = F.max(F.when(own & hit, F.col("in_zone"))) if k == model.ZONE_KIND else F.max(F.when(own, F.col("depth_m")))
        sums += [F.max(own & cov).alias(f"covered_{i}"), F.max(F.when(own, F.col("rank"))).alias(f"rank_{i}"), value.alias(f"value_{i}")]
    summed = hits.groupBy("building_uid").agg(*sums)

    def ids(name: str, k: str):
        return idf.id_list(F.transform(F.filter(name, lambda s: s.kind == k), lambda s: s.source_id))

    out = []
    for i, k in enumerate(kinds):
        columns = {
            f"{k}_covered": F.lit(True),
            f"{k}_coverage_source_ids": ids("cov_ids", k),
            model.hazard_value_column(k): F.col(f"value_{i}"),
            f"{k}_hit_source_ids": ids("hit_ids", k),
            f"{k}_coverage_confidence": idf.confidence_name(F.col(f"rank_{i}")),
        }
        out += [F.when(F.col(f"covered_{i}"), c).alias(n) for n, c in columns.items()]
    return summed.select("building_uid", *out)


def with_hazard_columns(
    buildings: DataFrame, summary: DataFrame | None, kinds=model.HAZARD_KINDS
) -> DataFrame:
    """Attach the flat hazard columns; buildings without any hit get the unknown values.

    Existing hazard columns of these kinds are replaced, all others are kept.
    """
    base = buildings.drop(*model.hazard_column_names(kinds))
    joined = base if summary is None else base.join(summary, "building_uid", "left")
    defaults = {}
    for k in kinds:
        for f in model.hazard_fields(k):
            if f.name.endswith("_depth_max"):
                default = F.lit(None)
            elif f.dataType.typeName() == "boolean":
                default = F.lit(False)
            elif f.name.endswith("_confidence"):
                default = F.lit("unknown")
            else:
                default = F.lit("")
            have = F.col(f.name) if summary is not None else F.lit(None)
            defaults[f.name] = F.coalesce(have, default).cast(f.dataType)
    return joined.withColumns(defaults)


def apply_hazards(
    buildings: DataFrame,
    extents: DataFrame | None,
    hazards: DataFrame | None,
    *,
    cell: float,
    mode: str = "point",
    kinds=model.HAZARD_KINDS,
    large: bool = True,
) -> DataFrame:
    """Coverage and hazard columns for every building.

    Both polygon sets go through one spatial join and one aggregate; eligibility (hazards
    count only where the kind is covered) is settled after it.
    """
    if extents is None:
        return with_hazard_columns(buildings, None, kinds)

    def only(df):
        return None if df is None else df.where(F.col("kind").isin(*kinds))

    if mode == "point":
        crowd = spatial.point_crowd(buildings, F.col("centroid_lon"), F.col("centroid_lat"), cell)
    else:
        crowd = spatial.polygon_crowd(buildings, cell)
    hits = hazard_hits(
        buildings, only(extents), only(hazards), cell=cell, mode=mode, large=large, crowd=crowd
    )
    hits = skew.dealt(hits, crowd[1], "building_uid")  # serves both aggregates and the join
    return with_hazard_columns(buildings, summarise_hits(hits, kinds), kinds)


def first_zone(
    buildings: DataFrame,
    zones: DataFrame,
    value_cols: list[str],
    *,
    seq: str,
    cell: float,
    large: bool = True,
) -> DataFrame:
    """Values of the first zone (lowest ``seq``) that holds the building's point; NULL if none."""
    points = buildings.select(
        "building_uid", F.col("centroid_lon").alias("px"), F.col("centroid_lat").alias("py")
    )
    crowd = spatial.point_crowd(points, F.col("px"), F.col("py"), cell)
    hits = spatial.points_in_polygons(
        points, zones, cell=cell, point_cols=["building_uid"], poly_cols=[seq, *value_cols],
        poly_id=seq, large=large, crowd=crowd,
    )
    first = skew.dealt(hits, crowd[1], "building_uid").groupBy("building_uid").agg(
        F.min_by(F.struct(*value_cols), F.col(seq)).alias("_z")
    )
    out = buildings.drop(*value_cols).join(first, "building_uid", "left")
    return out.withColumns({c: F.col(f"_z.{c}") for c in value_cols}).drop("_z")


def backfill_zoning(buildings: DataFrame, zoning: DataFrame, *, cell: float, large: bool = True) -> DataFrame:
    return first_zone(
        buildings, zoning, ["zoning_use", "far_max"], seq="zone_seq", cell=cell, large=large
    )


def assign_ward(buildings: DataFrame, wards: DataFrame, *, cell: float, large: bool = True) -> DataFrame:
    """Ward code of each building, ``unassigned`` where no ward holds its point."""
    out = first_zone(buildings, wards, ["ward_code"], seq="ward_seq", cell=cell, large=large)
    return out.withColumn("ward_code", F.coalesce("ward_code", F.lit("unassigned")))


def clip_to_boundary(
    buildings: DataFrame,
    admin: DataFrame,
    *,
    cell: float,
    key: str = "gml_id",
    large: bool = True,
) -> DataFrame:
    """Buildings whose footprint meets a city, once per such city, with its ``city_code``.

    Ids need not be unique: a footprint is known by its id and a hash of its edges.
    """
    shape = F.xxhash64("edges")
    crowd = spatial.polygon_crowd(buildings, cell)
    pairs = spatial.intersecting_pairs(
        buildings.select(key, shape.alias("_shape_of"), "edges"),
        admin.select("city_code", "edges", F.col("city_code").alias("_city")),
        cell=cell,
        left_cols=[key, "_shape_of"],
        right_cols=["city_code"],
        left_id=key,
        right_id="_city",
        large=large,
        crowd=crowd,
        distinct=False,
    )
    pairs = skew.dealt(pairs, crowd[1], key, "_shape_of").distinct()  # serves the join as well
    own = buildings.drop("city_code").withColumn("_shape_of", shape)
    return skew.shuffled_join(own, pairs, [key, "_shape_of"], 0).drop("_shape_of")


def bbox_overlap(df: DataFrame, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    """Rows whose bounds meet a box; plain comparisons, so they reach the parquet scan."""
    return df.where(
        (F.col("minx") <= x1) & (F.col("maxx") >= x0) & (F.col("miny") <= y1) & (F.col("maxy") >= y0)
    )


def meets_box(edges: str, a: str, b: str, c: str, d: str) -> str:
    """Does a polygon meet the box from (a, b) to (c, d), borders included? Numbers or columns, as SQL."""
    sides = ", ".join(g.side("e", x, y) for x in (a, c) for y in (b, d))
    # an edge meets the box if its bounds do and its line does not leave all corners on one side
    meets = (
        f"exists({edges}, e -> least(e.x1, e.x2) <= {c} AND greatest(e.x1, e.x2) >= {a}"
        f" AND least(e.y1, e.y2) <= {d} AND greatest(e.y1, e.y2) >= {b}"
        f" AND least({sides}) <= 0D AND greatest({sides}) >= 0D)"
    )
    return f"({meets} OR {g.inside_parity(edges, a, b)})"


def box_selection(df: DataFrame, x0: float, y0: float, x1: float, y1: float, edges: str = "edges") -> DataFrame:
    """Rows whose polygon meets a box, borders included.

    Stored bounds (``minx`` and so on), where the table has them, thin the scan out; the edges decide.
    """
    if {"minx", "miny", "maxx", "maxy"} <= set(df.columns):
        df = bbox_overlap(df, x0, y0, x1, y1)
    return df.where(F.expr(meets_box(edges, *(g.num(v) for v in (x0, y0, x1, y1)))))


def map_cover(df: DataFrame, min_zoom: int = 10, max_zoom: int = 16, edges: str = "edges") -> DataFrame:
    """Each row once per zoom and map tile (z, x, y) that its polygon meets; coordinates are degrees.

    The bounds give the tiles to ask about; where they are several, the edges decide, so a tile in a hole
    or beside an arm of an L is left out. Rows without edges lie in no tile. No shuffle.
    """
    box = {f"_{k}": v for k, v in g.bbox(F.col(edges)).items()}
    z = df.where(F.size(edges) > 0).withColumns(box).withColumn("z", F.explode(F.sequence(F.lit(min_zoom), F.lit(max_zoom))))
    span = {
        "_xa": g.tile_x(F.col("_minx"), F.col("z")), "_xb": g.tile_x(F.col("_maxx"), F.col("z")),
        "_ya": g.tile_y(F.col("_maxy"), F.col("z")), "_yb": g.tile_y(F.col("_miny"), F.col("z")),
    }
    z = z.withColumns(span).withColumn("x", F.explode(F.sequence("_xa", "_xb"))).withColumn("y", F.explode(F.sequence("_ya", "_yb")))
    tile = {
        "_west": g.tile_lon(F.col("x"), F.col("z")), "_east": g.tile_lon(F.col("x") + 1, F.col("z")),
        "_north": g.tile_lat(F.col("y"), F.col("z")), "_south": g.tile_lat(F.col("y") + 1, F.col("z")),
    }
    met = F.expr(f"(_xa = _xb AND _ya = _yb) OR {meets_box(edges, '_west', '_south', '_east', '_north')}")
    return z.withColumns(tile).where(met).drop(*box, *span, *tile)


def total_bounds(df: DataFrame) -> DataFrame:
    return df.agg(
        F.min("minx").alias("minx"), F.min("miny").alias("miny"),
        F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"),
    )
