import hashlib
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kawara.sources import citygml, geojson, metadata, registry, tileset

PROPS = T.StructType(
    [
        T.StructField("yearOfConstruction", T.StringType()),
        T.StructField("depth", T.DoubleType()),
        T.StructField("city_code", T.StringType()),
        T.StructField("parent_city_code", T.StringType()),
    ]
)


def _feature(fid, coords, kind="Polygon", **props):
    return {"type": "Feature", "id": fid, "properties": props, "geometry": {"type": kind, "coordinates": coords}}


SQUARE = [[[0, 0, 5], [2, 0, 5], [2, 2, 5], [0, 2, 5], [0, 0, 5]]]


def test_geojson_lines_and_collections_agree(spark, tmp_path):
    feats = [
        _feature("a", SQUARE, yearOfConstruction="1990", city_code="01100"),
        _feature("b", [SQUARE, [[[5, 5], [6, 5], [6, 6]]]], "MultiPolygon", depth=1.5),
        _feature("line", [[0, 0], [1, 1]], "LineString"),
    ]
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(f) for f in feats))
    (tmp_path / "coll.json").write_text(json.dumps({"type": "FeatureCollection", "features": feats}, indent=1))
    for name, coll in (("lines.json", False), ("coll.json", True)):
        rows = {r.gml_id: r for r in geojson.read_features(spark, str(tmp_path / name), PROPS, collection=coll).collect()}
        assert set(rows) == {"a", "b"}
        assert len(rows["a"].edges) == 4 and rows["a"].rings_closed and rows["a"].city_code == "01100"
        assert len(rows["b"].parts) == 2 and len(rows["b"].edges) == 7 and not rows["b"].rings_closed
        assert (rows["b"].minx, rows["b"].maxy) == (0.0, 6.0)


def test_mercator_input_becomes_degrees(spark, tmp_path):
    r = 6378137.0 * 3.141592653589793 / 180
    (tmp_path / "m.json").write_text(json.dumps(_feature("a", [[[0, 0], [r, 0], [r, r], [0, 0]]])))
    row = geojson.read_features(spark, str(tmp_path / "m.json"), PROPS, mercator=True).first()
    assert row.maxx == pytest.approx(1.0) and row.maxy == pytest.approx(0.99995, abs=1e-4)


def test_layers(spark, tmp_path):
    far = [[[50, 50], [51, 50], [51, 51], [50, 50]]]
    feats = [_feature("a", SQUARE, depth=float(2)), _feature("b", far, depth=None)]
    (tmp_path / "h.json").write_text("\n".join(json.dumps(f) for f in feats))
    raw = geojson.read_features(spark, str(tmp_path / "h.json"), PROPS)
    layer = geojson.as_hazard_layer(raw, "tsunami", "src", bbox=(1, 1, 3, 3)).collect()
    assert [(r.poly_id, r.depth_m, r.in_zone) for r in layer] == [("a", 2.0, False)]
    zone = geojson.as_hazard_layer(raw, "landslide", "src").collect()
    assert all(r.in_zone for r in zone) and len(zone) == 2
    assert geojson.hazard_feature_class("landslide") == "SedimentDisasterProneArea"
    named = raw.withColumn("用途地域", F.lit("商業地域")).withColumn("容積率", F.lit("400"))
    z = geojson.as_zoning_layer(named).first()
    assert (z.zoning_use, z.far_max) == ("商業地域", 400.0)


def test_admin_and_wards(make):
    rows = [("27100", None), ("27100", ""), ("27102", "27100"), ("13113", None)]
    df = make(rows, "city_code string, parent_city_code string")
    assert geojson.admin_of(df, "27100").count() == 2
    assert geojson.admin_of(df, "27102").count() == 0
    assert [r.ward_code for r in geojson.wards_of(df, "27100").collect()] == ["27102"]


GML = """<?xml version="1.0" encoding="UTF-8"?>
<core:CityModel xmlns:core="http://www.opengis.net/citygml/2.0" xmlns:bldg="http://www.opengis.net/citygml/building/2.0"
 xmlns:gml="http://www.opengis.net/gml" xmlns:uro="https://example.test/uro">
<core:cityObjectMember><bldg:Building gml:id="b1">
 <bldg:usage>住宅</bldg:usage><bldg:yearOfConstruction>1975</bldg:yearOfConstruction>
 <bldg:measuredHeight uom="m">9.5</bldg:measuredHeight>
 <bldg:lod0RoofEdge><gml:MultiSurface><gml:surfaceMember><gml:Polygon><gml:exterior><gml:LinearRing>
  <gml:posList>35 139 3 35 139.1 3 35.1 139.1 3 35 139 3</gml:posList></gml:LinearRing></gml:exterior></gml:Polygon></gml:surfaceMember></gml:MultiSurface></bldg:lod0RoofEdge>
 <bldg:lod1Solid><gml:Solid><gml:exterior><gml:CompositeSurface>
  <gml:surfaceMember><gml:Polygon><gml:exterior><gml:LinearRing><gml:posList>35 139 0 35.2 139 0 35.2 139.2 0 35 139.2 0 35 139 0</gml:posList></gml:LinearRing></gml:exterior></gml:Polygon></gml:surfaceMember>
  <gml:surfaceMember><gml:Polygon><gml:exterior><gml:LinearRing><gml:posList>35 139 9 35.2 139 9 35.2 139.2 9 35 139 9</gml:posList></gml:LinearRing></gml:exterior></gml:Polygon></gml:surfaceMember>
 </gml:CompositeSurface></gml:exterior></gml:Solid></bldg:lod1Solid>
 <uro:buildingDetailAttribute><uro:BuildingDetailAttribute><uro:buildingStructureType>木造</uro:buildingStructureType></uro:BuildingDetailAttribute></uro:buildingDetailAttribute>
 <uro:bldgRealEstateIDAttribute><uro:RealEstateIDAttribute><uro:realEstateIDOfBuilding>A-1</uro:realEstateIDOfBuilding></uro:RealEstateIDAttribute></uro:bldgRealEstateIDAttribute>
 <uro:bldgRealEstateIDAttribute><uro:RealEstateIDAttribute><uro:realEstateIDOfBuilding>A-2</uro:realEstateIDOfBuilding></uro:RealEstateIDAttribute></uro:bldgRealEstateIDAttribute>
</bldg:Building></core:cityObjectMember>
<core:cityObjectMember><bldg:Building gml:id="b2"><bldg:lod0FootPrint><gml:MultiSurface><gml:surfaceMember><gml:Polygon><gml:exterior><gml:LinearRing>
  <gml:posList>35 139 0 35 139.1 0 35.1 139.1 0 35 139 0</gml:posList></gml:LinearRing></gml:exterior></gml:Polygon></gml:surfaceMember></gml:MultiSurface></bldg:lod0FootPrint></bldg:Building></core:cityObjectMember>
</core:CityModel>
"""


def test_city_model_buildings(spark, tmp_path):
    from kawara.operators.normalise import normalise

    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "x.gml").write_text(GML, encoding="utf-8")
    (tmp_path / "clean.gml").write_text("<a/>\n", encoding="utf-8")
    files = citygml.input_files(spark, str(tmp_path))
    assert [f.rsplit("/", 1)[1] for f in files] == ["clean.gml", "x.gml"]
    with pytest.raises(FileNotFoundError):
        citygml.input_files(spark, str(tmp_path), "*.nothing")
    raw = citygml.read_buildings(spark, [f for f in files if f.endswith("x.gml")])
    assert citygml.duplicate_children(raw).first().removed == 1
    rows = {r.gml_id: r for r in normalise(citygml.as_footprints(raw)).collect()}
    b1, b2 = rows["b1"], rows["b2"]
    assert (b1.year_built, b1.height, b1.usage, b1.structure, b1.real_estate_id) == (1975, 9.5, "residential", "wood", "A-1")
    assert len(b1.parts) == 1 and len(b1.edges) == 4 and (b1.minx, b1.maxy) == (139.0, 35.2)
    assert len(b2.edges) == 3 and b2.height is None and b2.real_estate_id is None
    marked = citygml.files_with_marker(spark, files, "bldgRealEstateIDAttribute")
    assert {r.file.rsplit("/", 1)[1]: r.has_marker for r in marked.collect()} == {"clean.gml": False, "x.gml": True}


META = """<?xml version="1.0" encoding="utf-8"?>
<MD_Metadata xmlns="http://example.test/jmp/"><identificationInfo><MD_DataIdentification>
<citation><title> 洪水モデル_op </title></citation>
<descriptiveKeywords>
 <MD_Keywords><keyword>ある市洪水浸水想定区域図に似た場所</keyword><type>002</type></MD_Keywords>
 <MD_Keywords><keyword>洪水浸水想定区域</keyword><keyword>LOD1</keyword><type>005</type></MD_Keywords>
 <MD_Keywords><keyword>甲川水系甲川洪水浸水想定区域図（平成29年7月20日）某局</keyword>
  <keyword>乙川流域浸水予想区域図 平成26年4月</keyword>
  <keyword>甲川水系甲川洪水浸水想定区域図（平成29年7月20日）某局</keyword><type>005</type></MD_Keywords>
</descriptiveKeywords>
<extent><geographicElement><EX_GeographicBoundingBox><westBoundLongitude>138.75</westBoundLongitude>
<eastBoundLongitude>139.5</eastBoundLongitude><southBoundLatitude>35.5</southBoundLatitude><northBoundLatitude>35.9</northBoundLatitude>
</EX_GeographicBoundingBox></geographicElement></extent>
</MD_DataIdentification></identificationInfo></MD_Metadata>
"""


def test_metadata_documents(spark, tmp_path, make):
    (tmp_path / "metadata").mkdir()
    (tmp_path / "metadata" / "udx_1_fld_op.xml").write_text(META, encoding="utf-8")
    (tmp_path / "metadata" / "udx_2_fld_op.xml").write_text("<MD_Metadata><broken", encoding="utf-8")
    (tmp_path / "metadata" / "other.xml").write_text(META, encoding="utf-8")
    meta = metadata.read_metadata(spark, str(tmp_path / "metadata"))
    rows = meta.collect()
    assert len(rows) == 1
    assert rows[0].title == "洪水モデル_op"
    assert (rows[0].bbox.west, rows[0].bbox.east) == (138.75, 139.5)
    assert rows[0].source_documents == [
        "甲川水系甲川洪水浸水想定区域図（平成29年7月20日）某局",
        "乙川流域浸水予想区域図 平成26年4月",
    ]
    assert [r.document[:2] for r in metadata.documents(meta, "d").orderBy("seq").collect()] == ["甲川", "乙川"]
    no_side = META.replace("<eastBoundLongitude>139.5</eastBoundLongitude>", "")
    text = make([(1, META.split("\n", 1)[1]), (2, no_side.split("\n", 1)[1])], "n int, doc string")
    got = {r.n: r.bbox for r in metadata.metadata_of_text(text, "doc", ("n",)).collect()}
    assert got[1] is not None and got[2] is None


def test_mapping_keeps_only_valid_entries(spark, tmp_path):
    doc = {
        "_status": "x",
        "entries": {
            "A": {"hazard": "river_flood", "ksj_urls": ["u1", "u2"], "published": "2018-03-30"},
            "B": {"hazard": "tsunami", "ksj_url": "u3"},
            "C": {"hazard": "meteor", "ksj_url": "u4"},
            "D": {"hazard": "tsunami"},
            "E": {"hazard": "tsunami", "ksj_urls": [], "ksj_url": "u5"},
        },
    }
    (tmp_path / "m.json").write_text(json.dumps(doc, indent=1))
    rows = {r.document_name: r for r in registry.read_coverage_mapping(spark, str(tmp_path / "m.json")).collect()}
    assert {k: r.urls for k, r in rows.items()} == {"A": ["u1", "u2"], "B": ["u3"], "E": ["u5"]}
    assert rows["A"].published == "2018-03-30" and rows["B"].notes == ""
    (tmp_path / "bad.json").write_text("{not json")
    assert registry.read_coverage_mapping(spark, str(tmp_path / "bad.json")).count() == 0


def test_catalog_latest_and_themes(spark, tmp_path):
    def city(code, year):
        entry = {"theme": "building", "year": year, "url": "u", "dataset_id": f"bldg-{code}"}
        hazards = [{"theme": "hazard", "hazard_kind": "tsunami", "year": year, "url": "u", "dataset_id": f"t{i}"} for i in (1, 2)]
        return {"city_code": code, "city_name": "n", "dataset_year": year, "entries": [entry, *hazards]}

    (tmp_path / "c.json").write_text(json.dumps([city("01100", 2020), city("01100", 2023), city("13113", 2022)]))
    entries = registry.read_catalog(spark, str(tmp_path / "c.json"))
    latest = registry.latest_catalog(entries, "01100")
    assert {r.dataset_year for r in latest.collect()} == {2023}
    assert registry.hazard_entries(latest).count() == 2
    assert registry.of_theme(latest, "building").count() == 1
    assert registry.latest_catalog(entries, "01100", 2020).count() == 3
    with pytest.raises(KeyError):
        registry.latest_catalog(entries, "99999")


def test_index_and_checksums(spark, tmp_path):
    import hashlib

    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.tar").write_bytes(b"abc")
    (tmp_path / "f" / "b.tar").write_bytes(b"changed")
    sha = hashlib.sha256(b"abc").hexdigest()
    cities = [
        {"city_code": "01100", "dataset_year": 2020, "bundle_url": f"http://x/{n}.tar", "sha256": sha, "bytes": 3, "n_buildings": 1, "tool_version": "1"}
        for n in "ab"
    ]
    (tmp_path / "index.json").write_text(json.dumps({"schema": 1, "cities": cities}, indent=1))
    index = registry.read_index(spark, str(tmp_path / "index.json"))
    assert index.first().city_code == "01100"
    got = {r.file: r.ok for r in registry.check_files(spark, str(tmp_path / "f"), index).collect()}
    assert got == {"a.tar": True, "b.tar": False}


def test_tileset_is_walked_in_tree_order(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    root = {
        "root": {
            "children": [
                {"content": {"uri": "15/a.glb"}, "children": [{"content": {"uri": "sub/ext.json"}, "children": [{"content": {"uri": "18/z.glb"}}]}]},
                {"content": {"uri": "15/b.glb"}},
            ]
        }
    }
    ext = {"root": {"content": {"uri": "c.glb"}, "children": [{"content": {"uri": "../d.glb"}}]}}
    (tmp_path / "tileset.json").write_text(json.dumps(root))
    (tmp_path / "sub" / "ext.json").write_text(json.dumps(ext))
    got = tileset.read_tileset(spark, str(tmp_path)).orderBy("walk").collect()
    assert [r.uri for r in got] == ["15/a.glb", "sub/c.glb", "d.glb", "18/z.glb", "15/b.glb"]


def test_large_collection_is_read_by_many_tasks(spark, tmp_path):
    feats = [_feature(f"f{i}", SQUARE, yearOfConstruction="1990", note='{"type":"Feature",') for i in range(300)]
    ways = {"tight.json": {"separators": (",", ":")}, "indented.json": {"indent": 1}, "plain.json": {}}
    for name, how in ways.items():
        (tmp_path / name).write_text(json.dumps({"type": "FeatureCollection", "name": "x, y", "features": feats}, **how))
    (tmp_path / "empty.json").write_text('{"type":"FeatureCollection","features":[]}')
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "8k")
    try:
        for name in ways:
            raw = geojson.collection_features(spark, str(tmp_path / name), geojson.feature_schema(PROPS))
            assert raw.select(F.spark_partition_id()).distinct().count() > 3
            rows = geojson.read_features(spark, str(tmp_path / name), PROPS, collection=True).collect()
            assert sorted(r.gml_id for r in rows) == sorted(f["id"] for f in feats)
            assert all(len(r.edges) == 4 and r.yearOfConstruction == "1990" for r in rows)
        both = [str(tmp_path / n) for n in ("empty.json", "tight.json")]
        assert geojson.read_features(spark, both, PROPS, collection=True).count() == 300
        with pytest.raises(Exception, match="whole features"):
            geojson.read_features(spark, [str(tmp_path / n) for n in ways], PROPS, collection=True).collect()
    finally:
        spark.conf.set(size, before)
    assert geojson.read_features(spark, str(tmp_path / "empty.json"), PROPS, collection=True).count() == 0


def test_file_table_and_streamed_checksums(spark, tmp_path, make):
    data = {"a b.zip": b"x" * 3_000_000, "c.zip": b"c", "d.zip": b"other"}
    for n, body in data.items():
        (tmp_path / n).write_bytes(body)
    (tmp_path / "note.txt").write_text("no bundle")
    files = citygml.file_table(spark, str(tmp_path), "*.zip")
    assert {r.file.rsplit("/", 1)[1]: r.bytes for r in files.collect()} == {n: len(b) for n, b in data.items()}
    sums = {n: hashlib.sha256(b if n != "d.zip" else b"another").hexdigest() for n, b in data.items()}
    index = make([(f"https://host/{n}", s) for n, s in sums.items()], "bundle_url string, sha256 string")
    for limit in (registry.ROW_BYTES, 4, -1):
        got = {r.file: r.ok for r in registry.check_files(spark, str(tmp_path), index, limit).collect()}
        assert got == {"a b.zip": True, "c.zip": True, "d.zip": False}
