import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kawara import model
from kawara.operators import catalog, coverage, diff, identity, quality, selection, tiles
from kawara.plans import analytics
from kawara.sinks import tables
from tests import shapes

PLACES = "gml_id string, tile_content_uri string, tile_feature_id int, walk string"


def test_placements_and_canonical_keys(make):
    lists = make(
        [("15/a.glb", ["bldg-1", "neighbour-1"], "1"), ("17/b.glb", ["bldg-1"], "2"), ("18/c.glb", ["bldg-1", "bldg-2"], "3"), ("18/d.glb", ["x", "bldg-2"], "4")],
        "uri string, ids array<string>, walk string",
    )
    places = tiles.placements_from_id_lists(lists)
    assert places.count() == 7
    got = {r.gml_id: (r.tile_content_uri, r.tile_feature_id) for r in tiles.canonical_tile_keys(places).collect()}
    assert got == {"bldg-1": ("18/c.glb", 0), "bldg-2": ("18/c.glb", 1), "neighbour-1": ("15/a.glb", 1), "x": ("18/d.glb", 0)}
    b = tiles.attach_tile_keys(make([("bldg-1",), ("none",)], "gml_id string"), places)
    assert {r.gml_id: r.tile_content_uri for r in b.collect()} == {"bldg-1": "18/c.glb", "none": None}
    assert tiles.duplicate_feature_keys(b).isEmpty()
    assert tiles.duplicate_feature_keys(b.union(b)).first().n == 2


def test_mesh_heights_use_the_deepest_level(make):
    places = make([("A", "18/a.glb", 0, ""), ("B", "18/a.glb", 1, ""), ("A", "18/b.glb", 0, ""), ("A", "15/c.glb", 0, "")], PLACES)
    v = [("18/a.glb", 0.0001, 0.0), ("18/a.glb", -0.0001, 10.0), ("18/a.glb", 1.0, 5.0), ("18/a.glb", 0.9999, 25.0)]
    v += [("18/b.glb", 0.0, 0.0), ("18/b.glb", 0.0, 12.0), ("15/c.glb", 0.0, 0.0), ("15/c.glb", 0.0, 99.0)]
    v += [("18/a.glb", 7.0, 0.0), ("18/a.glb", 7.0, 50.0), ("18/b.glb", 1.0, 3.0)]
    contents = make([(u,) for u in ("15/c.glb", "18/a.glb", "18/b.glb")], "uri string")
    got = tiles.mesh_heights(make(v, "uri string, feature_id double, y double"), places, contents)
    assert {r.gml_id: r.mesh_height for r in got.collect()} == {"A": 12.0, "B": 20.0}
    b = make([("A", 5.0, "measured"), ("B", None, "unknown"), ("C", None, "unknown")], "gml_id string, height float, height_source string")
    filled = tiles.backfill_heights(b, got)
    assert sorted((r.gml_id, r.height, r.height_source) for r in filled.collect()) == [
        ("A", 5.0, "measured"), ("B", 20.0, "geometric"), ("C", 3.5, "footprint_fallback"),
    ]
    assert tiles.strict_heights(filled).count() == 2


def test_tile_index_lists_every_tile(make):
    contents = make([("15/a.glb",), ("15/empty.glb",)], "uri string")
    rows = tiles.style_rows(make([("A", "15/a.glb", 3, "")], PLACES), make([("A", "u", 9.0)], "gml_id string, building_uid string, height float"))
    assert rows.columns == ["tile_content_uri", "tile_feature_id", "building_uid", "height"]
    got = {r.tile_content_uri: (r.style_path, r.n_rows) for r in tiles.tile_index(contents, rows).collect()}
    assert got == {"15/a.glb": ("style/15%2Fa.glb.arrow", 1), "15/empty.glb": ("style/15%2Fempty.glb.arrow", 0)}
    assert [r.tile_content_uri for r in tiles.tiles_without_rows(contents, rows).collect()] == ["15/empty.glb"]


def _table(spark, rows):
    base = {f.name: None for f in model.BUILDINGS_SCHEMA.fields if f.name != "geometry"}
    base.update(city_code="13113", dataset_year=2024, source_file_id="f", attribution="someone", centroid_lat=0.5, centroid_lon=0.5)
    for k in model.HAZARD_KINDS:
        base.update({f"{k}_covered": False, f"{k}_coverage_source_ids": "", f"{k}_coverage_confidence": "unknown", f"{k}_hit_source_ids": ""})
    base["landslide_in_zone"] = False
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in model.BUILDINGS_SCHEMA.fields if f.name != "geometry"])
    return spark.createDataFrame([tuple({**base, **r}[n] for n in schema.names) for r in rows], schema)


CLEAN = dict(building_uid="u1", gml_id="g1", river_flood_covered=True, river_flood_coverage_source_ids="city-fld+inundation_bounded", river_flood_coverage_confidence="inundation_bounded", river_flood_depth_max=2.5)


def test_verify_rules(spark, make):
    sources = make([("city-fld",), ("city-tnm",)], "source_id string")
    clean = quality.verify_buildings(_table(spark, [CLEAN]), sources, expected_count=1)
    found = {(r.severity, r.code) for r in clean.collect()}
    assert found == {("info", "no_coverage")} and quality.is_publishable(clean, strict=True)
    messages = [r.message for r in clean.collect()]
    assert sum("dataset present" in m for m in messages) == 1 and len(messages) == 4

    bad = _table(
        spark,
        [
            dict(building_uid="u1", gml_id="g", tsunami_depth_max=2.0, attribution=""),
            dict(building_uid="u1", gml_id="g", landslide_in_zone=True),
            dict(building_uid="u2", gml_id="g", tsunami_depth_max=0.0, tsunami_covered=True, tsunami_coverage_source_ids="city-tnm,other"),
        ],
    ).drop("fire_resistance")
    rep = quality.verify_buildings(bad, sources, expected_count=7)
    got = {(r.severity, r.code): r.n for r in rep.collect() if r.severity != "info"}
    assert got == {
        ("error", "missing_column"): 1,
        ("error", "honesty_violation"): 1,
        ("warn", "honesty_violation"): 1,
        ("error", "missing_attribution"): 1,
        ("warn", "manifest_count_mismatch"): 3,
        ("error", "uid_not_unique"): 1,
        ("warn", "orphan_source_id"): 1,
    }
    assert not quality.is_publishable(rep)
    assert [(r.building_uid, r.n) for r in quality.duplicate_uids(bad).collect()] == [("u1", 2)]
    no_manifest = quality.verify_buildings(_table(spark, [CLEAN]))
    assert [r.code for r in no_manifest.collect()] == ["missing_manifest"]


def test_field_coverage_and_stats(spark, make):
    df = make([(1990, "residential"), (None, ""), (2010, "commercial")], "year_built int, usage string")
    got = {r.field: r.share for r in quality.field_coverage(df, ["year_built", "usage", "absent"]).collect()}
    assert got == {"year_built": pytest.approx(2 / 3), "usage": pytest.approx(2 / 3), "absent": 0.0}
    assert all(r.share == 0.0 for r in quality.field_coverage(df.limit(0), ["year_built", "usage"]).collect())
    t = _table(spark, [CLEAN, dict(building_uid="u2", river_flood_coverage_confidence=None), dict(building_uid="u3", river_flood_coverage_confidence="odd")])
    s = {r.kind: r for r in quality.confidence_breakdown(quality.coverage_stats(t)).collect()}["river_flood"]
    assert (s.covered_count, s.hit_count, s.coverage_confidence_breakdown) == (1, 1, {"inundation_bounded": 1, "unknown": 1})


DIFF = "gml_id string, building_uid string, dataset_year int, river_flood_covered boolean, river_flood_depth_max float"


def _delta(df):
    return {r.kind: (r.newly_covered, r.newly_hit, r.no_longer_hit, r.depth_grew, r.depth_shrank) for r in df.collect()}


def test_diff(make):
    a = make([("x", "a/x", 2023, True, 1.0), ("y", "a/y", 2023, False, None), ("gone", "a/g", 2023, True, 2.0), (None, "a/n", 2023, True, 1.0)], DIFF)
    b = make([("x", "b/x", 2024, True, 3.0), ("y", "b/y", 2024, True, 0.5), ("new", "b/n", 2024, True, 2.0)], DIFF)
    key, counts, deltas = diff.diff_buildings(a, b)
    assert key == "gml_id"
    assert tuple(counts.first()) == (4, 3, 2, 1, 1)
    assert _delta(deltas) == {"river_flood": (1, 1, 0, 1, 0)}
    assert diff.match_key(a, a) == "building_uid"
    assert diff.match_key(a, a.drop("dataset_year")) == "gml_id"
    with pytest.raises(ValueError):
        diff.diff_buildings(a.drop("gml_id"), b)
    places = {r.key: r.place for r in diff.id_sets(a, b, "gml_id").collect()}
    assert places == {"x": "both", "y": "both", "gone": "only_a", "new": "only_b"}


def test_diff_counts_pairs_of_repeated_keys_like_a_join(make):
    a_rows = [("k", None, 1, c, d) for c, d in ((True, 1.0), (False, None), (True, 2.0), (True, 2.0))]
    b_rows = [("k", None, 2, c, d) for c, d in ((True, 2.0), (True, 3.0), (False, None), (True, 0.5))]
    a, b = make(a_rows, DIFF), make(b_rows, DIFF)
    pairs = [(x, y) for x in a_rows for y in b_rows]
    hit = lambda r: (r[4] or -1) > 0
    want = (
        sum(not x[3] and y[3] for x, y in pairs),
        sum(not hit(x) and hit(y) for x, y in pairs),
        sum(hit(x) and not hit(y) for x, y in pairs),
        sum(hit(x) and hit(y) and y[4] > x[4] for x, y in pairs),
        sum(hit(x) and hit(y) and y[4] < x[4] for x, y in pairs),
    )
    assert _delta(diff.hazard_deltas(a, b, "gml_id")) == {"river_flood": want}


def test_catalog_helpers(make):
    index = make([("01100", 2020, "old"), ("13113", 2023, "keep")], "city_code string, dataset_year int, v string")
    new = make([("01100", 2020, "new"), ("27100", 2021, "add")], "city_code string, dataset_year int, v string")
    assert [tuple(r) for r in catalog.upsert_index(index, new).collect()] == [
        ("01100", 2020, "new"), ("13113", 2023, "keep"), ("27100", 2021, "add"),
    ]
    v = make([("a", 2020, "0.9"), ("a", 2021, "0.1"), ("a", 2021, "0.10"), ("b", 1, "x")], "c string, y int, t string")
    assert sorted(tuple(r) for r in catalog.latest_per(v, "c", "y", "t").collect()) == [("a", 2021, "0.10"), ("b", 1, "x")]
    square, hole = shapes.box(0, 0, 10, 10), shapes.box(6, 0, 10, 10)
    polys = make([("c1", [[square, list(reversed(hole))]]), ("c2", [[shapes.box(0, 0, 2, 2)], [shapes.box(4, 0, 6, 2)]])], f"city_code string, parts {shapes.PARTS}")
    got = {r.city_code: (r.lon, r.lat, r.buildings) for r in catalog.city_rollup(polys, make([("c1",), ("c1",)], "city_code string")).collect()}
    assert got == {"c1": (pytest.approx(3.0), pytest.approx(5.0), 2), "c2": (pytest.approx(3.0), pytest.approx(1.0), 0)}
    n = make([(float(i),) for i in range(1, 102)], "h double")
    assert tuple(catalog.spread(n, "h").first()) == (2.0, 51.0, 100.0)
    assert catalog.spread(n, "h", exact=False).first().median == 51.0


def test_analytics_on_small_table(spark):
    t = _table(
        spark,
        [
            dict(CLEAN, structure="wood", year_built=1975),
            dict(building_uid="u2", structure="wood", year_built=1990),
            dict(building_uid="u3", river_flood_covered=True, river_flood_depth_max=0.0),
            dict(building_uid="u4", river_flood_covered=True),
        ],
    )
    assert analytics.filter_by_attrs(t).first().n == 1
    assert [tuple(r) for r in analytics.decade_histogram(t).collect()] == [(1970, 1), (1990, 1)]
    assert analytics.at_risk_count(t).first().n == 1
    pivot = {"at_risk": 1, "shallow": 0, "surveyed_safe": 2, "unknown": 1}
    assert analytics.honesty_pivot(t).first().asDict() == pivot
    # a known depth below the limit is not safe
    assert analytics.honesty_pivot(t, deeper_than=100.0).first().asDict() == pivot | {"at_risk": 0, "shallow": 1}
    assert analytics.bbox_count(t, 0.5, 0.5, 1, 1).first().n == 4
    assert [r.building_uid for r in analytics.deepest(t).collect()] == ["u1", "u3"]
    assert len(analytics.centroid_table(t, 2).collect()) == 2
    with pytest.raises(ValueError):
        analytics.require_rows(t.limit(0))
    with pytest.raises(ValueError):
        analytics.require_rows(t, "zoning_use")


def test_written_table_keeps_codes_and_can_be_replaced(spark, tmp_path):
    path = str(tmp_path / "buildings")
    t = _table(spark, [dict(CLEAN, city_code="01100"), dict(building_uid="u2", city_code="13113", dataset_year=2023)])
    tables.write_buildings(t, path)
    back = tables.read_buildings(spark, path)
    assert {r.city_code for r in back.collect()} == {"01100", "13113"}
    assert back.schema["dataset_year"].dataType == T.IntegerType()
    tables.replace_buildings(back.withColumn("height", F.lit(4.0).cast("float")), path)
    again = tables.read_buildings(spark, path)
    assert [r.height for r in again.collect()] == [4.0, 4.0]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["buildings"]


def test_geometry_round_trip(make):
    square = [[[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 0.0]]]
    from kawara.functions import wkb

    rows = [("one", [square]), ("two", [square, [[[5.0, 5.0], [6.0, 5.0], [6.0, 6.0], [5.0, 5.0]]]]), ("none", None)]
    df = tables.with_geometry(make(rows, "n string, polygons array<array<array<array<double>>>>"))
    got = {r.n: r.p for r in df.select("n", wkb.polygons_of(F.col("geometry")).alias("p")).collect()}
    assert got == dict(rows)


def test_tile_tables_shards_and_map(spark, tmp_path, make):
    rows = make([("tiles/a.glb", 1, "u1"), ("tiles/b.glb", 0, "u2"), (None, 5, "u3")], "tile_content_uri string, tile_feature_id int, building_uid string")
    tables.write_style_tables(rows, str(tmp_path / "style"))
    assert sorted(p.name for p in (tmp_path / "style").iterdir() if p.is_dir()) == ["_empty", "tile_content_uri=tiles%2Fa.glb", "tile_content_uri=tiles%2Fb.glb"]
    tables.write_tile_index(make([("tiles/a.glb",), ("tiles/z.glb",)], "uri string"), rows, str(tmp_path / "index"))
    index = spark.read.schema("tile_content_uri string, n_rows bigint").json(str(tmp_path / "index"))
    assert sorted(tuple(r) for r in index.collect()) == [("tiles/a.glb", 1), ("tiles/z.glb", 0)]

    tables.write_tile_index(make([("tiles/a.glb",), ("tiles/z.glb",)], "uri string"), None, str(tmp_path / "stored"), style=str(tmp_path / "style"))
    for r in spark.read.json(str(tmp_path / "stored")).collect():
        table = spark.read.parquet(str(tmp_path / "style" / r.style_path))
        assert (tmp_path / "style" / r.style_path).is_dir() and table.count() == r.n_rows == (r.tile_content_uri == "tiles/a.glb")
        assert table.columns == ["tile_feature_id", "building_uid"]

    b = _table(spark, [dict(CLEAN, centroid_lon=139.7, centroid_lat=35.66)])
    b = b.withColumn("polygons", F.from_json(F.lit("[[[[0,0,7],[1,0,7],[1,1,7],[0,0,7]]]]"), "array<array<array<array<double>>>>"))
    tables.write_ward_shards(b.withColumn("ward_code", F.lit("unassigned")), str(tmp_path / "shards"))
    assert (tmp_path / "shards" / "city_code=13113" / "ward_code=unassigned").is_dir()
    tables.write_map_features(b, str(tmp_path / "map"))
    feature = json.loads(spark.read.text(str(tmp_path / "map")).first().value)
    assert feature["geometry"]["coordinates"] == [[[[0, 0], [1, 0], [1, 1], [0, 0]]]]
    assert feature["properties"]["river_flood_depth_max"] == 2.5 and "city_code" not in feature["properties"]
    assert len(model.MAP_PROPERTIES) == 31
    z = {r.z: (r.x, r.y) for r in tables.map_tiles(b).collect()}
    assert z[10] == (909, 403) and len(z) == 7


def test_manifest(spark, tmp_path, make):
    entries = make([("01100", "Sapporo", 2020, "bldg-01100", 2020, "u", None), ("01100", "Sapporo", 2020, "01100-fld", 2020, "u", "e")], "city_code string, city_name string, dataset_year int, dataset_id string, year int, url string, coverage_extent_url string")
    doc = tables.manifest(_table(spark, [CLEAN]), entries, attribution="someone", tool_version="1", notes=["n1"])
    tables.write_manifest(doc, str(tmp_path / "m"))
    m = json.loads(spark.read.text(str(tmp_path / "m")).first().value)
    assert m["n_buildings"] == 1 and m["city_code"] == "01100" and m["notes"] == ["n1"]
    assert set(m["sources"]) == {"bldg-01100", "01100-fld"} and m["field_coverage"]["height"] == 0.0
    flood = [s for s in m["coverage_stats"] if s["kind"] == "river_flood"][0]
    assert flood["coverage_confidence_breakdown"] == {"inundation_bounded": 1}


def test_manifest_lists_a_repeated_dataset_once(spark, make):
    schema = "city_code string, city_name string, dataset_year int, dataset_id string, year int, url string, coverage_extent_url string"
    entries = make([("01100", "Sapporo", 2020, "01100-fld", y, u, None) for y, u in ((2019, "z"), (2020, "a"), (2020, "b"))], schema)
    m = json.loads(tables.manifest(_table(spark, [CLEAN]), entries, attribution="someone", tool_version="1").first().value)
    assert m["datasets"] == ["01100-fld"] and m["sources"]["01100-fld"]["url"] == "b"


def test_public_schema(spark):
    t = _table(spark, [CLEAN]).withColumn("complex_uid", F.lit("u1")).withColumn("raw", F.lit(1))
    out = tables.to_public_schema(t.drop("zoning_use"), extra=("complex_uid",))
    assert "raw" not in out.columns and out.columns[-1] == "complex_uid"
    assert quality.missing_columns(out) == []
    for f in model.BUILDINGS_SCHEMA.fields:
        if f.name in out.columns:
            assert out.schema[f.name].dataType == f.dataType


def test_each_tileset_has_its_own_deepest_level(make):
    places = make(
        [("x", "A", "18/a.glb", 0, ""), ("x", "A", "15/c.glb", 0, ""), ("y", "A", "16/a.glb", 0, "")], "city_code string, " + PLACES
    )
    v = [("x", "18/a.glb", 0.0, 0.0), ("x", "18/a.glb", 0.0, 9.0), ("x", "15/c.glb", 0.0, 0.0), ("x", "15/c.glb", 0.0, 90.0)]
    v += [("y", "16/a.glb", 0.0, 0.0), ("y", "16/a.glb", 0.0, 7.0)]
    contents = make([("x", "18/a.glb"), ("x", "15/c.glb"), ("y", "16/a.glb")], "city_code string, uri string")
    by = ["city_code"]
    got = tiles.mesh_heights(make(v, "city_code string, uri string, feature_id double, y double"), places, contents, by)
    assert {(r.city_code, r.gml_id): r.mesh_height for r in got.collect()} == {("x", "A"): 9.0, ("y", "A"): 7.0}
    b = make([("x", "A"), ("y", "A"), ("z", "A")], "city_code string, gml_id string")
    keyed = tiles.attach_tile_keys(b, places, by=by)
    assert {r.city_code: r.tile_content_uri for r in keyed.collect()} == {"x": "18/a.glb", "y": "16/a.glb", "z": None}


def test_hot_tile_is_written_in_blocks_and_no_tiles_at_all(spark, tmp_path):
    hot = spark.range(40).select(F.lit("a +b.glb").alias("tile_content_uri"), F.col("id").cast("int").alias("tile_feature_id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # it would put so few rows together again
    try:
        tables.write_style_tables(hot, str(tmp_path / "hot"), block=10)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    (row,) = tables.stored_tiles(spark, str(tmp_path / "hot")).collect()
    assert row.tile_content_uri == "a +b.glb" and row.n_rows == 40
    files = list((tmp_path / "hot" / row.style_path).glob("*.parquet"))
    assert len(files) > 1
    tables.write_style_tables(hot.limit(0), str(tmp_path / "none"))
    assert tables.stored_tiles(spark, str(tmp_path / "none")).count() == 0


def test_exact_percentiles(spark, make):
    rows = [(float(v),) for v in [5, 1, 1, 1, 9, 2, 2, 7]] + [(None,)]
    got = selection.exact_percentiles(make(rows, "h double"), "h", [0.0, 0.25, 0.5, 0.9, 1.0]).first().p
    assert got == pytest.approx([1.0, 1.0, 2.0, 7.6, 9.0])
    assert selection.exact_percentiles(make([], "h double"), "h", [0.5]).first().p == [None]
    # a third of all rows of one value, over many ranges
    many = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 4000).otherwise(F.col("id")).alias("h"))
    expect = many.agg(F.percentile("h", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.99))).alias("p")).first().p
    assert selection.exact_percentiles(many, "h", [0.1, 0.5, 0.99]).first().p == pytest.approx(expect)
    with pytest.raises(ValueError):
        selection.exact_percentiles(many, "h", [1.5])


def test_missing_ids_are_numbered_and_stable(spark, make):
    edge = lambda x: [(x, 0.0, x + 1, 0.0)]
    rows = [("a", edge(0.0), 1), (None, edge(0.0), 2), (None, edge(0.0), 3), (None, edge(0.0), 3), (None, edge(5.0), 4), (None, None, 5), (None, None, 6)]
    df = make(rows, "gml_id string, edges array<struct<x1:double,y1:double,x2:double,y2:double>>, n int")
    got = sorted((r.n, r.gml_id) for r in identity.fill_missing_ids(df).collect())
    assert got == sorted((r.n, r.gml_id) for r in identity.fill_missing_ids(df.repartition(5, "n")).collect())
    made = [i for _, i in got if i != "a"]
    assert len(set(made)) == 6 and all(i.startswith("synth_") for i in made) and sum("-" in i for i in made) == 3
    assert "-" not in dict(got)[4]
    assert identity.fill_missing_ids(df.limit(0)).count() == 0


def test_map_tiles_follow_the_shape_and_keep_nulls(spark, tmp_path, make):
    # an L along two borders of a 2 x 2 block of tiles of zoom 10, a tile inside a hole, no edges
    step = 360 / 1024
    at = lambda i, j: (i * step, j * step)
    ring = lambda ps: [(*a, *b) for a, b in zip(ps, ps[1:] + ps[:1])]
    ell = ring([at(0.1, 0.1), at(1.9, 0.1), at(1.9, 0.2), at(0.2, 0.2), at(0.2, 1.9), at(0.1, 1.9)])
    holed = ring([at(0.5, 0.5), at(3.5, 0.5), at(3.5, 3.5), at(0.5, 3.5)]) + ring([at(0.9, 0.9), at(0.9, 3.1), at(3.1, 3.1), at(3.1, 0.9)])
    df = make([("L", ell), ("O", holed), ("none", None)], "building_uid string, edges array<struct<x1:double,y1:double,x2:double,y2:double>>")
    got = {}
    for r in coverage.map_cover(df, 10, 10).collect():
        got.setdefault(r.building_uid, set()).add((r.x - 512, 511 - r.y))
    assert got["L"] == {(0, 0), (1, 0), (0, 1)}
    assert got["O"] == {(i, j) for i in range(4) for j in range(4)} - {(i, j) for i in (1, 2) for j in (1, 2)}
    assert "none" not in got

    b = _table(spark, [dict(CLEAN, height=None)]).withColumn("edges", F.lit(None).cast(df.schema["edges"].dataType)).drop("usage")
    b = b.withColumn("edges", F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), e)]) for e in ell]))
    b = b.withColumn("polygons", F.lit(None).cast("array<array<array<array<double>>>>"))
    tables.write_map_tiles(b, str(tmp_path / "tiles"), 10, 11)
    rows = spark.read.parquet(str(tmp_path / "tiles"))
    assert rows.where("z = 10").count() == 3 and rows.where("z = 11").count() > 3
    properties = json.loads(rows.first().value)["properties"]
    assert set(properties) == set(model.MAP_PROPERTIES) and properties["height"] is None and properties["usage"] is None


def test_stored_shapes_select_clip_and_join_again(spark, tmp_path, make):
    cells = make([(f"u{i}", 139.0 + i, 35.0, shapes.ring([(i, 0), (i + 0.9, 0), (i, 0.9)])) for i in range(6)], f"building_uid string, centroid_lon double, centroid_lat double, edges {shapes.EDGES}")
    b = cells.withColumns({"city_code": F.lit("01100"), "dataset_year": F.lit(2024), "parts": F.array(F.array("edges")), "source_file_id": F.lit("f")})
    b = b.withColumn("gml_id", F.col("building_uid")).withColumn("polygons", F.expr("array(array(transform(edges, e -> array(e.x1, e.y1))))"))
    path = str(tmp_path / "stored")
    tables.write_buildings(tables.to_public_schema(b, extra=("note",), shape=True), path)
    schema = model.stored_schema(shape=True, geometry=True, extra="complex_uid string")
    back = tables.read_buildings(spark, path, schema)
    assert back.columns == [f.name for f in schema.fields] and back.count() == 6
    assert {(r.city_code, r.dataset_year, r.complex_uid) for r in back.collect()} == {("01100", 2024, None)}
    assert back.where("geometry IS NULL OR minx IS NULL OR maxy <> 0.9").count() == 0
    # the bounds of u2 meet the box, its edges don't
    chosen = coverage.box_selection(back, 2.6, 0.6, 3.2, 0.8)
    assert [r.building_uid for r in chosen.select("building_uid").collect()] == ["u3"]
    assert "PushedFilters: [" in (plan := chosen._jdf.queryExecution().toString()) and "LessThanOrEqual(minx" in plan
    admin = make([("13113", shapes.box(-1, -1, 2.5, 5))], f"city_code string, edges {shapes.EDGES}")
    clipped = coverage.clip_to_boundary(back, admin, cell=0.5)
    assert sorted(r.gml_id for r in clipped.select("gml_id").collect()) == ["u0", "u1", "u2"]


def test_heights_are_filled_where_tiles_matched(make):
    b = make(
        [("c1", "a", None, None, "u", 1), ("c1", "b", None, None, None, None), ("c2", "c", None, None, None, None), ("c1", "d", 7.0, "measured", None, None)],
        "city_code string, gml_id string, height float, height_source string, tile_content_uri string, tile_feature_id int",
    )
    heights = make([("c1", "a", 4.0)], "city_code string, gml_id string, mesh_height float")
    of = lambda df: {r.gml_id: (r.height, r.height_source) for r in df.collect()}
    low, kept = (3.5, "footprint_fallback"), {"c": (None, None), "d": (7.0, "measured")}
    assert of(tiles.fill_where_tiled(b, heights, ("city_code",))) == {"a": (4.0, "geometric"), "b": low, **kept}
    assert of(tiles.fill_where_tiled(b, None)) == {"a": low, "b": low, "c": low, "d": (7.0, "measured")}
    untiled = b.where("tile_content_uri IS NULL")
    assert of(tiles.fill_where_tiled(untiled, None)) == {"b": (None, None), **kept}
