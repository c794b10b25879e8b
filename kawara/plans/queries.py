"""Every registered query: a callable (spark, folder) -> DataFrame over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kawara import model
from kawara.functions import attributes as at
from kawara.functions import geometry as g
from kawara.functions import ids
from kawara.operators import (
    catalog,
    components,
    containment,
    coverage,
    diff,
    identity,
    normalise,
    proximity,
    quality,
    resolve,
    selection,
    skew,
    spatial,
    tiles,
)
from kawara.plans import analytics, build
from kawara.plans.inputs import Inputs
from kawara.session import cut_lineage, shared_folder
from kawara.sinks import tables
from kawara.sources import geojson, metadata, registry

CELL = 2.0
EPS = 0.005
BOX = (20.0, 20.0, 60.0, 55.0)
REGISTRY = {}


def query(fn):
    REGISTRY[fn.__name__] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
    return fn


def _dbl(name: str, places: int = 6):
    return F.round(F.col(name).cast("double"), places).alias(name)


# --- shared stages -----------------------------------------------------------------


def located(t: Inputs) -> DataFrame:
    return t.located()


def layers(t: Inputs) -> tuple[DataFrame, DataFrame]:
    h = t.hazards()
    h = h.withColumn("depth_m", at.risk_attribute_depth(F.col("floodingRiskAttribute")))
    return t.extents(), h.withColumn("in_zone", F.col("kind") == model.ZONE_KIND)


def with_hazards(t: Inputs, kinds=model.HAZARD_KINDS) -> DataFrame:
    ext, haz = layers(t)
    return coverage.apply_hazards(located(t), ext, haz, cell=CELL, kinds=kinds, large=False)


def normalised(t: Inputs) -> DataFrame:
    return normalise.normalise(t.attributes())


# --- the six benchmark queries and their relatives ---------------------------------


@query
def filter_by_attrs(t):
    return analytics.filter_by_attrs(normalised(t))


@query
def decade_histogram(t):
    return analytics.decade_histogram(
        t.attributes().select(at.year_built(F.col("yearOfConstruction")).alias("year_built"))
    )


@query
def river_flood_at_risk(t):
    return analytics.at_risk_count(with_hazards(t, ["river_flood"]))


@query
def centroid_table(t):
    return analytics.centroid_table(located(t)).select(
        "building_uid", _dbl("centroid_lon"), _dbl("centroid_lat")
    )


@query
def bbox_count(t):
    return analytics.bbox_count(located(t), 20.001, 30.001, 60.001, 70.001)


@query
def honesty_pivot(t):
    return analytics.honesty_pivot(with_hazards(t, ["river_flood"]))


@query
def honesty_pivot_deep(t):
    return analytics.honesty_pivot(with_hazards(t, ["tsunami"]), "tsunami", deeper_than=1.0)


@query
def top_depth(t):
    b = with_hazards(t, ["river_flood"])
    return (
        b.where("river_flood_covered AND river_flood_depth_max IS NOT NULL")
        .select("building_uid", _dbl("river_flood_depth_max"))
        .orderBy(F.desc("river_flood_depth_max"), "building_uid")
    )


# --- attributes --------------------------------------------------------------------


@query
def normalise_height(t):
    h = at.height(F.col("measuredHeight"))
    return t.attributes().select("gml_id", F.round(h.cast("double"), 3).alias("height"), at.height_source(h).alias("height_source"))


@query
def normalise_floors(t):
    return t.attributes().select(
        "gml_id",
        at.year_built(F.col("yearOfConstruction")).alias("year_built"),
        at.floors_above(F.col("storeysAboveGround")).cast("int").alias("floors_above"),
        at.floors_below(F.col("storeysBelowGround")).cast("int").alias("floors_below"),
    )


@query
def usage_map(t):
    return t.attributes().select("gml_id", at.usage(F.col("usage")).alias("usage"))


@query
def structure_map(t):
    return normalised(t).select("gml_id", "city_code", "structure", "fire_resistance")


@query
def rank_depth(t):
    return t.hazards().select(
        "poly_id", at.risk_attribute_depth(F.col("floodingRiskAttribute")).alias("depth_m")
    )


@query
def uid_parts(t):
    uid = ids.building_uid(F.col("city_code"), F.col("dataset_year"), F.lit("bldg"), F.col("gml_id"))
    return (
        t.attributes()
        .select(uid.alias("uid"))
        .select("uid", ids.uid_parts(F.col("uid")).alias("p"))
        .select("uid", F.col("p.city_code").alias("part_city"), F.col("p.gml_id").alias("part_gml_id"))
    )


@query
def canonical_doc(t):
    """Source-document names made from the parts' names, some dated, some too short."""
    name = F.concat(F.lit("  "), "p_name", F.when(F.col("p_size") % 3 == 0, "水系洪水浸水想定区域図").otherwise("図"))
    doc = F.when(F.col("p_size") % 2 == 0, F.concat(name, F.lit("（平成29年）国土交通省"))).otherwise(name)
    return t.table("part").select(
        "p_partkey",
        ids.document_name(doc).alias("document"),
        ids.is_source_document(F.trim(doc)).alias("is_source"),
    )


@query
def event_props(t):
    """A key plucked from JSON text, as the attribute columns need it."""
    k = at.detail_value(F.col("props"), "k")
    return t.table("events").groupBy(k.cast("int").alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query
def id_forms(t):
    u = F.concat(F.lit("https://example.test/a?x="), "s_name")
    s = F.concat(F.lit("src-"), F.col("s_suppkey").cast("string"), F.lit("+ksj:a,b"))
    return t.table("supplier").select(
        "s_suppkey",
        ids.url_key(u).alias("url_key"),
        ids.base_source_id(s).alias("base_id"),
        ids.encoded_uri(F.col("s_name")).alias("encoded"),
    )


@query
def resolve_city(t):
    slugs = F.array(*[F.lit(s) for s in ("Shibuya", " osaka", "SAPPORO", "13101")])
    ident = F.get(slugs, F.pmod(F.col("c_custkey"), F.lit(4)).cast("int"))
    return t.table("customer").groupBy(ids.resolve_city(ident).alias("city_code")).agg(F.count(F.lit(1)).alias("n"))


@query
def height_bands(t):
    h = at.height(F.col("measuredHeight")).cast("double")
    return t.attributes().groupBy(at.height_band(h).alias("band")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(at.ramp_position(h, 0.0, 60.0)), 6).alias("ramp")
    )


@query
def age_bands(t):
    y = at.year_built(F.col("yearOfConstruction"))
    return t.attributes().groupBy(at.age_band(y).alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query
def decade_bands(t):
    y = at.year_built(F.col("yearOfConstruction"))
    return t.attributes().groupBy(at.decade_band(y).alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query
def height_percentiles(t):
    h = at.height(F.col("measuredHeight")).cast("double")
    return catalog.spread(t.attributes().select(h.alias("h")), "h").select(_dbl("p01"), _dbl("median"), _dbl("p99"))


@query
def price_percentiles(t):
    """Deciles of a column with very many different values."""
    p = selection.exact_percentiles(t.table("lineitem"), "l_extendedprice", [i / 10 for i in range(11)])
    return p.select(F.posexplode("p").alias("decile", "price")).select(F.col("decile").cast("bigint").alias("decile"), _dbl("price", 4))


@query
def missing_ids(t):
    """Footprints of the line items of a part and supplier, most of them without an id: rows and ids of each."""
    rows = t.boxed(
        t.table("lineitem").select(
            F.when(F.col("l_linenumber") == 1, F.concat(F.lit("l"), F.col("l_orderkey").cast("string"))).alias("gml_id"),
            F.col("l_quantity").cast("double").alias("quantity"), F.col("l_partkey").cast("double").alias("x0"),
            F.col("l_suppkey").cast("double").alias("y0"), (F.col("l_partkey") + 1).cast("double").alias("x1"),
            (F.col("l_suppkey") + 1).cast("double").alias("y1"),
        )
    )
    made = F.col("gml_id").startswith("synth_")
    return identity.fill_missing_ids(rows).groupBy("x0", "y0").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(made).alias("n_made"), F.count_distinct(F.when(made, F.col("gml_id"))).alias("n_ids"),
        F.max(F.when(made, F.coalesce(F.regexp_extract("gml_id", "-([0-9]+)$", 1).try_cast("bigint"), F.lit(1)))).alias("last_number"),
    )


@query
def top_usage(t):
    return catalog.top_categories(t.attributes().select(at.usage(F.col("usage")).alias("usage")), "usage")


@query
def field_coverage(t):
    return quality.field_coverage(normalised(t)).select("field", _dbl("share"))


@query
def marker_scan(t):
    """Which pages hold a marker text: the scan behind the file pre-check."""
    return t.table("pages").select("page_id", F.col("html").contains('class="ad"').alias("has_marker"))


# --- geometry ----------------------------------------------------------------------


@query
def mercator_xy(t):
    lon, lat = F.col("x0") - 50.0, (F.col("y0") - 50.0) / 2.0
    near = t.footprints().select("gml_id", (F.pmod(lon, F.lit(100.0))).alias("lon"), F.pmod(lat, F.lit(60.0)).alias("lat"))
    return near.select(
        "gml_id",
        F.round(g.mercator_x(F.col("lon")), 3).alias("mx"),
        F.round(g.mercator_y(F.col("lat")), 3).alias("my"),
    )


@query
def representative_point(t):
    p = t.hazards().withColumn("parts", F.array(F.array("edges")))
    return coverage.with_point(p).select("poly_id", _dbl("centroid_lon"), _dbl("centroid_lat"))


@query
def layer_bounds(t):
    h = t.hazards().withColumns(g.bbox(F.col("edges")))
    return coverage.total_bounds(h).select(*[_dbl(c) for c in ("minx", "miny", "maxx", "maxy")])


@query
def bbox_selection(t):
    b = t.footprints().withColumns(g.bbox(F.col("edges")))
    return coverage.bbox_overlap(b, 10.055, 10.055, 40.055, 40.055).select("gml_id")


@query
def admin_centroid(t):
    b = coverage.assign_ward(located(t), t.wards(), cell=CELL, large=False)
    codes = t.wards().select("ward_code", "city_code")
    per_city = b.select("building_uid", "ward_code").join(codes, "ward_code")
    return catalog.city_rollup(t.cities(), per_city).select("city_code", _dbl("lon"), _dbl("lat"), "buildings")


# --- spatial joins -----------------------------------------------------------------


@query
def coverage_join(t):
    b = coverage.apply_hazards(located(t), t.extents(), None, cell=CELL, large=False)
    cols = [f"{k}_{c}" for k in model.HAZARD_KINDS for c in ("covered", "coverage_source_ids", "coverage_confidence")]
    return b.select("building_uid", *cols)


@query
def hazard_join(t):
    b = with_hazards(t, model.DEPTH_KINDS)
    cols = [c for k in model.DEPTH_KINDS for c in (_dbl(f"{k}_depth_max"), F.col(f"{k}_hit_source_ids"))]
    return b.select("building_uid", *cols)


@query
def landslide_zone(t):
    return with_hazards(t, ["landslide"]).select(
        "building_uid", "landslide_covered", "landslide_in_zone", "landslide_hit_source_ids"
    )


@query
def multi_source_ids(t):
    b = with_hazards(t, ["tsunami"])
    n = F.size(F.split("tsunami_coverage_source_ids", ","))
    return b.where("tsunami_covered").groupBy(n.cast("bigint").alias("n_sources")).agg(F.count(F.lit(1)).alias("n"))


@query
def polygon_mode_join(t):
    ext, haz = layers(t)
    b = coverage.apply_hazards(
        t.footprints(), ext, haz, cell=CELL, mode="polygon", kinds=["river_flood"], large=False
    )
    return b.select("building_uid", "river_flood_covered", _dbl("river_flood_depth_max"))


@query
def stored_polygon_rerun(t):
    """A table stored with its shapes, read back, selected by box and joined again by polygon."""
    folder = f"{shared_folder(t.spark)}/buildings-{uuid.uuid4().hex}"
    p = g.box_point(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
    b = t.footprints().withColumns(
        {"centroid_lon": p["x"], "centroid_lat": p["y"], "city_code": F.lit("01100"), "dataset_year": F.lit(2023), "source_file_id": F.lit("f")}
    )
    tables.write_buildings(tables.to_public_schema(b, shape=True), folder, cell=CELL)
    stored = coverage.box_selection(tables.read_buildings(t.spark, folder, model.stored_schema(shape=True)), *BOX)
    ext, haz = layers(t)
    again = build.recompute_hazards(stored.drop(*model.hazard_column_names()), ext, haz, cell=CELL, mode="polygon", large=True)
    return again.select("building_uid", "city_code", "river_flood_covered", _dbl("river_flood_depth_max"))


def _mega_layers(t):
    h = t.mega().withColumn("depth_m", at.risk_attribute_depth(F.col("floodingRiskAttribute")))
    return t.extents(), h.withColumn("in_zone", F.col("kind") == model.ZONE_KIND)


def _all_kinds(b):
    """Covered, value and sources of the hits of all kinds."""
    cols = []
    for k in model.HAZARD_KINDS:
        value = model.hazard_value_column(k)
        cols += [f"{k}_covered", F.col(value) if k == model.ZONE_KIND else _dbl(value), f"{k}_hit_source_ids"]
    return b.select("building_uid", *cols)


@query
def mega_hazard_join(t):
    ext, haz = _mega_layers(t)
    return _all_kinds(coverage.apply_hazards(located(t), ext, haz, cell=CELL, large=True))


@query
def mega_polygon_mode(t):
    ext, haz = _mega_layers(t)
    return _all_kinds(coverage.apply_hazards(t.footprints(), ext, haz, cell=CELL, mode="polygon", large=True))


@query
def mega_clip(t):
    cities = t.mega().select(F.concat(F.lit("m"), F.col("poly_id").cast("string")).alias("city_code"), "edges")
    return coverage.clip_to_boundary(t.footprints(), cities, cell=CELL, large=True).select("gml_id", "city_code")


@query
def box_selection(t):
    """Triangles, L-shapes and boxes with holes that meet a box; their bounds alone would give more."""
    return coverage.box_selection(t.hazards(), *BOX).select("poly_id", "shape")


@query
def map_tile_cover(t):
    """Map tiles of zooms 10 to 16 and how many triangles, L-shapes and boxes with holes meet each."""
    small = "transform(edges, e -> struct(e.x1 / 1000 AS x1, e.y1 / 1000 AS y1, e.x2 / 1000 AS x2, e.y2 / 1000 AS y2))"
    h = t.hazards().select("poly_id", F.expr(small).alias("edges"))
    return coverage.map_cover(h).groupBy(F.col("z").cast("bigint").alias("z"), "x", "y").agg(F.count(F.lit(1)).alias("n"))


@query
def containment_shapes(t):
    h = t.hazards().withColumn("dataset_id", F.col("poly_id").cast("string"))
    x1 = F.col("cx") + (F.col("poly_id") % 5 * 0.2 + 0.1) * F.col("w")
    box = h.select(
        "dataset_id", "poly_id", (F.col("cx") - 0.7 * F.col("w")).alias("x0"), (F.col("cy") - 0.45 * F.col("w")).alias("y0"),
        x1.alias("x1"), (F.col("cy") + 0.85 * F.col("w")).alias("y1"),
    )
    return containment.containment_ratio(t.boxed(box), h, cell=4.0).select(
        "dataset_id", _dbl("hazard_area"), _dbl("contained_area"), _dbl("ratio")
    )


@query
def clip_to_admin(t):
    return coverage.clip_to_boundary(t.footprints(), t.cities(), cell=CELL, large=False).select("gml_id", "city_code")


@query
def clip_note(t):
    kept = coverage.clip_to_boundary(t.footprints(), t.cities(), cell=CELL, large=False)
    before = t.footprints().agg(F.count(F.lit(1))).scalar()
    return kept.groupBy("city_code").agg(F.count(F.lit(1)).alias("n_after")).withColumn("n_before", before)


@query
def zoning_backfill(t):
    b = coverage.backfill_zoning(located(t), t.zoning(), cell=CELL, large=False)
    return b.select("building_uid", "zoning_use", _dbl("far_max"))


@query
def ward_assign(t):
    return coverage.assign_ward(located(t), t.wards(), cell=CELL, large=False).select("building_uid", "ward_code")


@query
def ward_counts(t):
    b = coverage.assign_ward(located(t), t.wards(), cell=CELL, large=False)
    return b.groupBy("ward_code").agg(F.count(F.lit(1)).alias("n"))


@query
def coverage_stats(t):
    return quality.coverage_stats(with_hazards(t))


@query
def proximity_pairs(t):
    return proximity.proximity_pairs(t.footprints(), EPS, 1.0)


def _with_height(t: Inputs) -> DataFrame:
    h = F.when(F.col("k") % 13 != 0, F.col("k") % 60 + 3).cast("float")
    return t.footprints().withColumn("height", h)


@query
def complexes(t):
    return components.building_complexes(_with_height(t), eps=EPS, cell=1.0, project=False).select(
        "building_uid", "complex_uid", _dbl("complex_max_height")
    )


# --- extents -----------------------------------------------------------------------


def _dataset_boxes(t: Inputs) -> tuple[DataFrame, DataFrame]:
    """Per dataset two hazard boxes and two mapped boxes, overlapping, on a 1/4 lattice."""
    base = t.table("supplier").select(
        F.concat(F.lit("d"), F.col("s_suppkey").cast("string")).alias("dataset_id"),
        (F.col("s_suppkey") * 40).cast("double").alias("ox"),
        (F.pmod(F.col("s_suppkey"), F.lit(7)) / 4.0).alias("u"),
        (F.pmod(F.col("s_nationkey"), F.lit(9)) / 2.0).alias("v"),
    )

    def boxes(*rows):
        return Inputs.boxed(
            base.select(
                "dataset_id",
                F.explode(
                    F.array(
                        *[
                            F.struct(
                                F.lit(i).alias("poly_id"),
                                (F.col("ox") + F.expr(x0)).alias("x0"),
                                F.expr(y0).cast("double").alias("y0"),
                                (F.col("ox") + F.expr(x1)).alias("x1"),
                                F.expr(y1).cast("double").alias("y1"),
                            )
                            for i, (x0, y0, x1, y1) in enumerate(rows)
                        ]
                    )
                ).alias("b"),
            ).select("dataset_id", "b.*")
        )

    hazards = boxes(("0", "0", "8", "6 + u"), ("4 + u", "3", "12", "9"))
    mapped = boxes(("0", "0", "9 + v", "9"), ("6", "-1", "12", "7 + u"))
    return hazards, mapped


@query
def containment_ratio(t):
    hazards, mapped = _dataset_boxes(t)
    return containment.containment_ratio(mapped, hazards, cell=4.0).select(
        "dataset_id", _dbl("hazard_area"), _dbl("contained_area"), _dbl("ratio")
    )


@query
def resolver_choice(t):
    hazards, mapped = _dataset_boxes(t)
    s = t.table("supplier").withColumn("dataset_id", F.concat(F.lit("d"), F.col("s_suppkey").cast("string")))
    entries = s.select(
        "dataset_id",
        F.get(F.array(*[F.lit(k) for k in model.HAZARD_KINDS]), F.pmod("s_suppkey", F.lit(5)).cast("int")).alias("kind"),
        F.lit("c").alias("city_code"),
        (F.col("s_nationkey") % 2 == 0).alias("declared_full_admin"),
    )
    has = s.select("dataset_id", (F.col("s_suppkey") % 4).alias("q"))
    whole = Inputs.boxed(
        t.table("region").select(
            F.lit("c").alias("city_code"), F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"),
            (F.col("r_regionkey") + 1.0).alias("x1"), F.lit(1.0).alias("y1"),
        )
    )
    got = resolve.resolve_extents(
        entries,
        explicit=mapped.join(has.where("q = 0"), "dataset_id", "left_semi"),
        mapped=mapped.join(has.where("q <= 1"), "dataset_id", "left_semi").withColumn("documents", F.array(F.lit("doc"))),
        hazards=hazards.join(has.where("q <= 2"), "dataset_id", "left_semi"),
        admin=whole,
        cell=4.0,
    )
    return got.groupBy("dataset_id", "kind", "confidence", "source_id").agg(F.count(F.lit(1)).alias("n_polygons"))


@query
def documents_to_urls(t):
    """Source documents of datasets (lineitem) against a mapping table (part)."""
    parts = t.table("part")
    name = F.concat(F.col("p_name"), F.col("p_partkey").cast("string"), F.lit("洪水浸水想定区域図"))
    kind = F.get(F.array(*[F.lit(k) for k in model.HAZARD_KINDS]), F.pmod("p_partkey", F.lit(5)).cast("int"))
    mapping = parts.select(
        name.alias("document_name"),
        kind.alias("hazard"),
        F.array(F.concat(F.lit("u"), (F.col("p_partkey") % 97).cast("string")), F.lit("u-all")).alias("urls"),
    )
    docs = (
        skew.spread_rows(t.table("lineitem").select("l_suppkey", "l_partkey"), "l_suppkey", "l_partkey")
        .distinct()
        .join(parts.select(F.col("p_partkey").alias("l_partkey"), name.alias("n")), "l_partkey")
        .select(
            F.concat(F.lit("d"), F.col("l_suppkey").cast("string")).alias("dataset_id"),
            F.col("l_partkey").alias("seq"),
            F.concat("n", F.lit("（令和元年）某局")).alias("document"),
        )
    )
    entries = t.table("supplier").select(
        F.concat(F.lit("d"), F.col("s_suppkey").cast("string")).alias("dataset_id"),
        F.get(F.array(*[F.lit(k) for k in model.HAZARD_KINDS]), F.pmod("s_suppkey", F.lit(5)).cast("int")).alias("kind"),
    )
    return resolve.documents_to_urls(docs, mapping, entries).select(
        "dataset_id", "kind", "url", F.size("documents").cast("bigint").alias("n_documents")
    )


# --- tiles -------------------------------------------------------------------------


@query
def tile_placements(t):
    return t.placements().select("gml_id", "tile_content_uri", F.col("tile_feature_id").cast("bigint").alias("tile_feature_id"))


@query
def canonical_tile_key(t):
    return tiles.attach_tile_keys(t.footprints(), t.placements()).select(
        "gml_id", "tile_content_uri", F.col("tile_feature_id").cast("bigint").alias("tile_feature_id")
    )


@query
def mesh_height(t):
    return tiles.mesh_heights(t.vertices(), t.placements(), t.contents()).select("gml_id", _dbl("mesh_height"))


@query
def height_backfill(t):
    b = t.attributes().withColumn("height", at.height(F.col("measuredHeight")))
    b = b.withColumn("height_source", at.height_source(F.col("height")))
    heights = tiles.mesh_heights(t.vertices(), t.placements(), t.contents())
    return tiles.backfill_heights(b, heights).select("gml_id", _dbl("height", 3), "height_source")


@query
def strict_heights(t):
    b = t.attributes().withColumn("height", at.height(F.col("measuredHeight")))
    b = b.withColumn("height_source", at.height_source(F.col("height")))
    full = tiles.backfill_heights(b, tiles.mesh_heights(t.vertices(), t.placements(), t.contents()))
    return tiles.strict_heights(full).groupBy("height_source").agg(F.count(F.lit(1)).alias("n"))


@query
def style_rows(t):
    rows = tiles.style_rows(t.placements(), _with_height(t))
    return rows.select(
        "tile_content_uri", F.col("tile_feature_id").cast("bigint").alias("tile_feature_id"), "building_uid", _dbl("height")
    )


@query
def tile_index_total(t):
    return tiles.tile_index(t.contents(), t.placements())


@query
def tiles_without_rows(t):
    return tiles.tiles_without_rows(t.contents(), t.placements())


@query
def tile_lookup(t):
    rows = tiles.style_rows(t.placements(), _with_height(t))
    wanted = t.placements().groupBy("tile_content_uri").agg(F.max("tile_feature_id").alias("tile_feature_id"))
    return tiles.lookup_features(rows, wanted).select(
        "tile_content_uri", F.col("tile_feature_id").cast("bigint").alias("tile_feature_id"), "building_uid"
    )


@query
def feature_key_duplicates(t):
    claimed = t.sql(
        f"SELECT {_uri()} AS tile_content_uri, l_linenumber AS tile_feature_id FROM lineitem", "lineitem"
    )
    return tiles.duplicate_feature_keys(claimed)


def _uri() -> str:
    from kawara.plans.inputs import TILE_URI

    return TILE_URI


@query
def tile_zxy_counts(t):
    zoom = F.explode(F.sequence(F.lit(10), F.lit(16)))
    b = located(t).select(
        zoom.alias("z"), (F.col("centroid_lon") / 1000.0).alias("lon"), (F.col("centroid_lat") / 1000.0).alias("lat")
    )
    return b.groupBy(
        F.col("z").cast("bigint").alias("z"), g.tile_x(F.col("lon"), F.col("z")).alias("x"), g.tile_y(F.col("lat"), F.col("z")).alias("y")
    ).agg(F.count(F.lit(1)).alias("n"))


# --- quality, diff, catalog --------------------------------------------------------


@query
def verify_findings(t):
    """The rules over a table with known faults: uncovered depths, missing attribution."""
    b = with_hazards(t).withColumns(
        {
            "river_flood_depth_max": F.when(F.col("k") % 50 == 0, F.lit(1.5)).otherwise(F.col("river_flood_depth_max")).cast("float"),
            "attribution": F.when(F.col("k") % 31 != 0, "made from open data"),
        }
    )
    b = cut_lineage(b)  # the rules read a stored table several times
    found = quality.verify_buildings(b, t.table("supplier").select(F.concat(F.lit("src-"), F.col("s_suppkey").cast("string")).alias("source_id")))
    return found.groupBy("severity", "code").agg(F.sum("n").alias("n"))


@query
def orphan_sources(t):
    b = coverage.apply_hazards(located(t), t.extents(), None, cell=CELL, large=False)
    known = t.table("supplier").where("s_acctbal > 0").select(
        F.concat(F.lit("src-"), F.col("s_suppkey").cast("string")).alias("source_id")
    )
    return quality.orphan_source_ids(b, known).select("kind", "source_id")


@query
def distinct_sources(t):
    b = coverage.apply_hazards(located(t), t.extents(), None, cell=CELL, large=False)
    return quality.distinct_source_ids(b)


@query
def duplicate_uids(t):
    b = t.table("lineitem").select(F.concat(F.lit("b"), F.col("l_orderkey").cast("string")).alias("building_uid"))
    return quality.duplicate_uids(b, limit=None)


@query
def diff_counts(t):
    return diff.key_counts(t.year_a(), t.year_b(), "gml_id")


@query
def diff_hazard_deltas(t):
    return diff.hazard_deltas(t.year_a(), t.year_b(), "gml_id")


@query
def diff_id_sets(t):
    return diff.id_sets(t.year_a(), t.year_b(), "gml_id").groupBy("place").agg(F.count(F.lit(1)).alias("n"))


def _index(t: Inputs) -> DataFrame:
    """Index rows per customer and order year: the later order of a key wins."""
    return t.table("orders").groupBy(
        F.lpad(F.col("o_custkey").cast("string"), 9, "0").alias("city_code"),
        F.year("o_orderdate").alias("dataset_year"),
    ).agg(F.max("o_orderkey").alias("bytes"))


@query
def index_upsert(t):
    new = _index(t).where("bytes % 3 = 0").withColumns(
        {"dataset_year": F.col("dataset_year") + (F.col("bytes") % 2).cast("int"), "bytes": F.lit(-1).cast("bigint")}
    ).distinct()
    return catalog.upsert_index(_index(t), new)


@query
def latest_bundle(t):
    o = t.table("orders").select(
        F.col("o_custkey").alias("city"), F.year("o_orderdate").alias("dataset_year"),
        F.col("o_orderpriority").alias("tool_version"), "o_orderkey",
    )
    return catalog.latest_per(o, "city", "dataset_year", "tool_version", "o_orderkey")


@query
def catalog_listing(t):
    o = t.table("orders").select(
        F.lpad(F.col("o_custkey").cast("string"), 9, "0").alias("city_code"),
        F.year("o_orderdate").alias("dataset_year"),
        F.when(F.col("o_orderstatus") == "F", "hazard").when(F.col("o_orderstatus") == "O", "building").otherwise("zoning").alias("theme"),
        F.when(F.col("o_orderstatus") == "F", F.element_at(F.array(*[F.lit(k) for k in model.HAZARD_KINDS]), (F.col("o_orderkey") % 5 + 1).cast("int"))).alias("hazard_kind"),
    )
    return catalog.catalog_listing(o)


# --- sources, over documents made from the tables ----------------------------------


@query
def geojson_scan(t):
    """Zones written as GeoJSON features and read back; every third ring is left open."""
    z = t.zoning()
    corner = [("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1")]
    ring = F.array(*[F.array(F.col(x), F.col(y), F.lit(7.0)) for x, y in corner])
    closed = F.concat(ring, F.slice(ring, 1, 1))
    feature = F.struct(
        F.concat(F.lit("z"), F.col("zone_seq").cast("string")).alias("id"),
        F.struct(F.col("zoning_use").alias("function"), F.col("far_max").cast("string").alias("floorAreaRatio")).alias("properties"),
        F.struct(
            F.lit("Polygon").alias("type"),
            F.array(F.when(F.col("zone_seq") % 3 == 0, ring).otherwise(closed)).alias("coordinates"),
        ).alias("geometry"),
    )
    props = T.StructType([T.StructField(n, T.StringType()) for n in ("function", "floorAreaRatio")])
    read = geojson.features_of_text(z.select(F.to_json(feature).alias("value")), props)
    layer = geojson.as_zoning_layer(read).withColumnRenamed("zone_seq", "gml_id")
    return read.select("gml_id", "rings_closed", _dbl("minx"), _dbl("maxy"), F.size("edges").cast("bigint").alias("n_edges")).join(
        layer.select("gml_id", "zoning_use", _dbl("far_max")), "gml_id"
    )


@query
def metadata_scan(t):
    """Metadata documents made from suppliers: title, box (a side is missing in some), documents."""
    east = F.when(F.col("s_suppkey") % 4 != 0, F.concat(F.lit("<eastBoundLongitude>"), F.col("s_nationkey").cast("string"), F.lit("</eastBoundLongitude>"))).otherwise("")
    xml = F.concat(
        F.lit("<MD_Metadata><identificationInfo><MD_DataIdentification><citation><title>"), "s_name",
        F.lit("</title></citation><descriptiveKeywords><MD_Keywords><keyword>"), "s_name",
        F.lit("洪水浸水想定区域図（平成29年）</keyword><keyword>LOD1</keyword><type>"),
        F.when(F.col("s_suppkey") % 3 == 0, "002").otherwise("005"),
        F.lit("</type></MD_Keywords></descriptiveKeywords><extent><geographicElement><EX_GeographicBoundingBox><westBoundLongitude>1.5</westBoundLongitude>"),
        east,
        F.lit("<southBoundLatitude>2</southBoundLatitude><northBoundLatitude>3</northBoundLatitude></EX_GeographicBoundingBox></geographicElement></extent></MD_DataIdentification></identificationInfo></MD_Metadata>"),
    )
    m = metadata.metadata_of_text(t.table("supplier").select("s_suppkey", xml.alias("doc")), "doc", ("s_suppkey",))
    return m.select(
        "s_suppkey", "title", F.col("bbox.east").alias("east"),
        F.array_join(F.transform("source_documents", lambda d: ids.document_name(d)), ",").alias("documents"),
    )


@query
def mapping_scan(t):
    """Coverage mapping entries made from parts, some with an unknown hazard or without urls."""
    kinds = F.array(*[F.lit(k) for k in (*model.HAZARD_KINDS, "meteor")])
    kind = F.get(kinds, F.pmod("p_partkey", F.lit(6)).cast("int"))
    url = F.concat(F.lit("u"), F.col("p_size").cast("string"))
    entry = F.struct(
        kind.alias("hazard"),
        F.when(F.col("p_partkey") % 4 == 1, url).alias("ksj_url"),
        F.when(F.col("p_partkey") % 4 >= 2, F.array(url, F.lit("u-all"))).alias("ksj_urls"),
    )
    doc = F.to_json(F.struct(F.create_map(F.col("_name"), entry).alias("entries")))
    named = t.table("part").withColumn("_name", F.concat(F.lit("doc"), F.col("p_partkey").cast("string")))
    got = registry.mapping_of_text(named.select(doc.alias("value")), "value")
    return got.select("document_name", "hazard", F.array_join("urls", ",").alias("urls"))
