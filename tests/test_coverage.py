import pytest
from pyspark.sql import functions as F

from kawara import model
from kawara.operators import coverage
from kawara.plans import build
from tests import shapes

EXT = f"kind string, source_id string, poly_id string, confidence string, edges {shapes.EDGES}"
HAZ = f"kind string, source_id string, poly_id string, depth_m double, in_zone boolean, edges {shapes.EDGES}"


def _square(x, y, s=0.1):
    return shapes.box(x, y, x + s, y + s)


def _buildings(make, rows):
    df = make([(u, e) for u, e in rows], f"building_uid string, edges {shapes.EDGES}")
    return coverage.with_point(df.withColumn("parts", F.array(F.array("edges"))))


def _one(df):
    return {r.building_uid: r for r in df.collect()}


def test_uncovered_building_keeps_no_depth(make):
    b = _buildings(make, [("A", _square(0.2, 0.2)), ("B", _square(5, 5))])
    ext = make([("river_flood", "s", "1", "explicit_polygon", shapes.box(0, 0, 1, 1))], EXT)
    haz = make([("river_flood", "s", "1", 2.5, False, shapes.box(-1, -1, 9, 9))], HAZ)
    got = _one(coverage.apply_hazards(b, ext, haz, cell=1.0))
    assert got["A"].river_flood_covered and got["A"].river_flood_depth_max == 2.5
    assert got["A"].river_flood_coverage_confidence == "explicit_polygon"
    assert not got["B"].river_flood_covered and got["B"].river_flood_depth_max is None
    assert got["B"].river_flood_hit_source_ids == "" and got["B"].river_flood_coverage_confidence == "unknown"
    assert not got["A"].tsunami_covered and got["A"].landslide_in_zone is False


@pytest.mark.parametrize("mode", ["point", "polygon"])
def test_many_sources_merge(make, mode):
    b = _buildings(make, [("A", _square(0.2, 0.2)), ("C", _square(0.7, 0.7))])
    boxes = shapes.box(0, 0, 1, 1)
    ext = make(
        [
            ("tsunami", "c", "1", "declared_full_admin", boxes),
            ("tsunami", "a", "1", "explicit_polygon", boxes),
            ("tsunami", "b", "1", "inundation_bounded", boxes),
            ("landslide", "z", "1", "explicit_polygon", boxes),
        ],
        EXT,
    )
    haz = make(
        [
            ("tsunami", "h2", "1", 1.5, None, shapes.box(0, 0, 0.5, 0.5)),
            ("tsunami", "h1", "1", 3.0, None, shapes.box(0, 0, 0.5, 0.5)),
            ("tsunami", "h3", "1", None, None, boxes),
            ("tsunami", "h4", "1", float("nan"), None, boxes),
            ("landslide", "l2", "1", None, None, boxes),
            ("landslide", "l1", "1", None, True, boxes),
        ],
        HAZ,
    )
    got = _one(coverage.apply_hazards(b, ext, haz, cell=0.3, mode=mode))
    a, c = got["A"], got["C"]
    assert a.tsunami_coverage_source_ids == "a,b,c" and a.tsunami_coverage_confidence == "explicit_polygon"
    assert a.tsunami_depth_max == 3.0 and a.tsunami_hit_source_ids == "h1,h2,h3,h4"
    assert c.tsunami_depth_max is None and c.tsunami_hit_source_ids == "h3,h4"
    assert a.landslide_in_zone and a.landslide_hit_source_ids == "l1,l2"


def test_point_and_polygon_mode_differ_at_the_rim(make):
    b = _buildings(make, [("rim", shapes.box(0.9, 0, 1.5, 0.4))])
    ext = make([("tsunami", "s", "1", "explicit_polygon", shapes.box(0, 0, 1, 1))], EXT)
    covered = {m: _one(coverage.apply_hazards(b, ext, None, cell=1.0, mode=m))["rim"].tsunami_covered for m in ("point", "polygon")}
    assert covered == {"point": False, "polygon": True}
    with pytest.raises(ValueError):
        coverage.apply_hazards(b, ext, None, cell=1.0, mode="other")


def test_point_lies_inside_concave_and_multi_part_footprints(make):
    u = shapes.ring([(0, 0), (9, 0), (9, 9), (8, 9), (8, 1), (1, 1), (1, 9), (0, 9)])
    two = [[shapes.box(0, 0, 1, 1)], [shapes.box(5, 9, 8, 10)]]
    holed = [[shapes.box(0, 0, 10, 10), shapes.box(1, 1, 9, 9)]]
    df = make([("u", [[u]]), ("two", two), ("holed", holed)], f"building_uid string, parts {shapes.PARTS}")
    for r in coverage.with_point(df).collect():
        edges = [tuple(e) for part in r.parts for ring in part for e in ring]
        assert shapes.inside(edges, r.centroid_lon, r.centroid_lat)
    two_row = coverage.with_point(df).where("building_uid = 'two'").first()
    assert (two_row.centroid_lon, two_row.centroid_lat) == (6.5, 9.5)


def test_zoning_takes_the_first_zone_and_keeps_unmatched(make):
    b = _buildings(make, [("A", _square(0.2, 0.2)), ("B", _square(5, 5))])
    zones = make(
        [("z2", "commercial", 400.0, shapes.box(0, 0, 1, 1)), ("z1", "living", 200.0, shapes.box(0, 0, 2, 2))],
        f"zone_seq string, zoning_use string, far_max float, edges {shapes.EDGES}",
    )
    got = _one(coverage.backfill_zoning(b, zones, cell=1.0))
    assert (got["A"].zoning_use, got["A"].far_max) == ("living", 200.0)
    assert got["B"].zoning_use is None
    wards = zones.select(F.col("zone_seq").alias("ward_seq"), F.col("zone_seq").alias("ward_code"), "edges")
    got = _one(coverage.assign_ward(b, wards, cell=1.0))
    assert (got["A"].ward_code, got["B"].ward_code) == ("z1", "unassigned")


def _raw(make):
    rows = [
        ("a", "1990", 12.0, '["住宅"]', '[{"buildingStructureType":"木造"}]', shapes.box(0.1, 0.1, 0.2, 0.2)),
        ("b", None, -9999.0, None, None, shapes.box(0.95, 0.5, 1.05, 0.6)),
        ("out", None, 5.0, None, None, shapes.box(3, 3, 4, 4)),
        (None, None, 5.0, None, None, shapes.box(0.5, 0.5, 0.6, 0.6)),
    ]
    df = make(
        rows,
        "gml_id string, yearOfConstruction string, measuredHeight double, usage string,"
        f" buildingDetailAttribute string, edges {shapes.EDGES}",
    )
    return df.withColumn("parts", F.array(F.array("edges")))


ARGS = dict(dataset_year=2024, source_file_id="bldg", source_url="u", attribution="someone", cell=0.5)


def test_build_clips_identifies_and_marks(make):
    admin = make([("13113", shapes.box(0, 0, 1, 1)), ("13114", shapes.box(1, 0, 2, 1))], f"city_code string, edges {shapes.EDGES}")
    ext = make([("river_flood", "s", "1", "explicit_polygon", shapes.box(0, 0, 0.5, 0.5))], EXT)
    haz = make([("river_flood", "s", "1", 2.5, False, shapes.box(0, 0, 0.5, 0.5))], HAZ)
    got = _one(build.build_buildings(_raw(make), admin=admin, extents=ext, hazards=haz, **ARGS))
    assert "13113/2024/bldg/a" in got and not any(u.endswith("/out") for u in got)
    # a footprint on the border belongs to both cities, under two ids
    assert {"13113/2024/bldg/b", "13114/2024/bldg/b"} <= set(got)
    assert sum("synth_" in u for u in got) == 1
    a = got["13113/2024/bldg/a"]
    assert (a.year_built, a.structure, a.usage, a.river_flood_depth_max) == (1990, "wood", "residential", 2.5)
    assert got["13113/2024/bldg/b"].height is None


def test_build_without_hazards_is_unknown_and_can_be_recomputed(make):
    built = build.build_buildings(_raw(make), city_code="13113", **ARGS)
    rows = built.collect()
    assert len(rows) == 4
    for k in model.HAZARD_KINDS:
        assert all(not r[f"{k}_covered"] and r[f"{k}_coverage_confidence"] == "unknown" for r in rows)
    with pytest.raises(ValueError):
        build.build_buildings(_raw(make), **ARGS)
    ext = make([("tsunami", "s", "1", "explicit_polygon", shapes.box(0, 0, 0.5, 0.5))], EXT)
    again = build.recompute_hazards(built.withColumn("tile_content_uri", F.lit("t")), ext, None, cell=0.5)
    assert sorted(again.columns) == sorted(built.columns)
    got = _one(again)
    assert got["13113/2024/bldg/a"].tsunami_covered and got["13113/2024/bldg/a"].tile_content_uri == "t"
    assert not got["13113/2024/bldg/out"].tsunami_covered


def test_tiles_then_zoning_keep_each_others_columns(make):
    built = build.build_buildings(_raw(make), city_code="13113", **ARGS)
    places = make(
        [("a", "15/x.glb", 0, "1"), ("a", "18/y.glb", 4, "2"), ("b", "18/y.glb", 1, "2")],
        "gml_id string, tile_content_uri string, tile_feature_id int, walk string",
    )
    vertices = make([("18/y.glb", 1.0, 2.0), ("18/y.glb", 1.0, 9.0)], "uri string, feature_id double, y double")
    contents = make([("15/x.glb",), ("18/y.glb",)], "uri string")
    tiled = build.add_tiles(built, places, vertices, contents, eps=0.01, cell=1.0, project=False)
    zones = make([("z", "living", 200.0, shapes.box(0, 0, 1, 1))], f"zone_seq string, zoning_use string, far_max float, edges {shapes.EDGES}")
    got = {r.gml_id: r for r in build.add_zoning(tiled, zones, None, cell=0.5).collect()}
    assert (got["a"].tile_content_uri, got["a"].tile_feature_id, got["a"].height_source) == ("18/y.glb", 4, "measured")
    assert (got["b"].height, got["b"].height_source) == (7.0, "geometric")
    assert got["a"].zoning_use == "living" and got["a"].complex_uid.endswith("/a")


def test_clip_tells_footprints_of_one_id_apart(make):
    city = make([("c1", shapes.box(0, 0, 1, 1))], f"city_code string, edges {shapes.EDGES}")
    rows = [("a", 1, shapes.box(0.2, 0.2, 0.4, 0.4)), ("a", 2, shapes.box(50, 50, 51, 51)), ("b", 3, shapes.box(60, 60, 61, 61))]
    b = make(rows, f"gml_id string, no int, edges {shapes.EDGES}")
    got = coverage.clip_to_boundary(b, city, cell=0.5)
    assert [(r.gml_id, r.no, r.city_code) for r in got.collect()] == [("a", 1, "c1")]
    assert set(got.columns) == {*b.columns, "city_code"}
