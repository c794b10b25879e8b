import pytest
from pyspark.sql import functions as F

from kawara.functions import attributes as at
from kawara.functions import ids
from kawara.operators.normalise import normalise


def _col(make, values, fn, kind="string"):
    return [r.v for r in make([(i, v) for i, v in enumerate(values)], f"i int, x {kind}").orderBy("i").select(fn(F.col("x")).alias("v")).collect()]


def test_risk_attribute_depth(make):
    cases = {
        '[{"rank":"0.5m以上3m未満","adminType":"国"}]': 3.0,
        '[{"rank":"0.5m未満"},{"rank":"5m以上10m未満"},{"rank":"3m以上5m未満"}]': 10.0,
        '{"rank":"20m以上"}': 20.0,
        '[{"rank":2},{"rank":1}]': 3.0,
        '[{"rank":2.9}]': 3.0,
        '[{"rank":"","depthRank":4}]': 10.0,
        '[{"rank":0,"depthRank":"0.5m未満"}]': 0.5,
        '[{"rank":"?"}]': None,
        '[{"rank":9}]': None,
        "0.5m未満": 0.5,
        "not json": None,
        "[not json": None,
        "[]": None,
        "[1,2]": None,
        "": None,
        None: None,
    }
    assert _col(make, list(cases), at.risk_attribute_depth) == list(cases.values())


def test_depth_column_precedence(make):
    df = make([(2, 7.5, 4)], "depth_rank int, depth double, rank int")
    assert at.with_depth(df, "tsunami").first().depth_m == 7.5
    assert at.with_depth(df.drop("depth"), "tsunami").first().depth_m == 3.0
    assert at.with_depth(df.select("rank"), "tsunami").first().depth_m == 10.0
    assert at.with_depth(df.select(F.lit(1).alias("x")), "tsunami").first().depth_m is None
    assert at.with_depth(df, "landslide").first().in_zone is True
    nan = make([(float("nan"),)], "depth double")
    assert at.with_depth(nan, "tsunami").first().depth_m is None


def test_first_text_and_detail(make):
    texts = ["住宅", '["住宅","x"]', '["","店舗"]', '[1,"工場"]', "[]", '{"a":"b"}', "[broken", "", None]
    assert _col(make, texts, at.first_text) == ["住宅", "住宅", "店舗", "工場", None, None, None, None, None]
    key = "buildingStructureType"
    rows = [f'[{{"{key}":""}},{{"{key}":"木造"}}]', f'{{"{key}":"石造"}}', f'[{{"{key}":null}},{{"{key}":5}}]', '[{"other":"x"}]', "x", None]
    assert _col(make, rows, lambda c: at.detail_value(c, key)) == ["木造", "石造", "5", None, None, None]


def test_normalise_sentinels_and_aliases(make):
    df = make(
        [("1990", -9999.0, 9999, "-1"), ("x", 12.5, 0, "40000"), (None, float("nan"), 199, "2")],
        "year_of_construction string, measured_height double, storeys_above_ground int, storeys_below_ground string",
    )
    rows = normalise(df).collect()
    assert [r.year_built for r in rows] == [1990, None, None]
    assert [r.height for r in rows] == [None, 12.5, None]
    assert [r.height_source for r in rows] == ["unknown", "measured", "unknown"]
    assert [r.floors_above for r in rows] == [None, 0, 199]
    assert [r.floors_below for r in rows] == [-1, None, 2]
    assert rows[0].usage is None and rows[0].structure is None


def test_structure_is_null_only_for_datasets_without_any(make):
    df = make(
        [("A", 1, '[{"buildingStructureType":"木造"}]', None), ("A", 1, None, "[]"), ("B", 1, '[{"fireproofStructureType":"耐火"}]', '["住宅"]')],
        "city_code string, dataset_year int, buildingDetailAttribute string, usage string",
    )
    rows = normalise(df).collect()
    got = sorted((r.city_code, str(r.structure), r.usage, str(r.fire_resistance)) for r in rows)
    assert got == [("A", "other", "other", "None"), ("A", "wood", "other", "None"), ("B", "None", "residential", "耐火")]
    alone = df.where("city_code = 'B'").drop("city_code", "dataset_year")
    assert normalise(alone).first().structure is None


def test_uid_round_trip_and_guards(make):
    df = make([("13113", 2024, "shibuya_bldg_2024", "bldg_xyz")], "c string, y int, s string, g string")
    uid = ids.building_uid(F.col("c"), F.col("y"), F.col("s"), F.col("g"))
    row = df.select(uid.alias("u")).select("u", ids.uid_parts(F.col("u")).alias("p")).first()
    assert row.u == "13113/2024/shibuya_bldg_2024/bldg_xyz"
    assert (row.p.city_code, row.p.dataset_year, row.p.gml_id) == ("13113", 2024, "bldg_xyz")
    with pytest.raises(Exception, match="building uid part"):
        df.withColumn("g", F.lit("a/b")).select(uid).collect()
    with pytest.raises(Exception, match="not a building uid"):
        df.select(ids.uid_parts(F.lit("a/b/c"))).collect()


def test_small_identifier_rules(make):
    assert _col(make, ["18/x.glb", "a/b", "7", ""], ids.lod_of) == [18, -1, 7, -1]
    assert _col(make, ["d+ksj:a,b", "d", "d+inundation_bounded"], ids.base_source_id) == ["d", "d", "d"]
    assert _col(make, ["tiles/a.glb", "a b*~é"], ids.encoded_uri) == ["tiles%2Fa.glb", "a%20b%2A~%C3%A9"]
    assert _col(make, ["利根川図（平成29年）国土交通省（x）", " x "], ids.document_name) == ["利根川図", "x"]
    assert _col(make, ["Shibuya", " OSAKA ", "01100"], ids.resolve_city) == ["13113", "27100", "01100"]
    for bad in ("1310", "131011", "nowhere", "1310a"):
        with pytest.raises(Exception, match="unknown city"):
            _col(make, [bad], ids.resolve_city)
    lists = [["b", "a", "b", "", None], []]
    assert _col(make, lists, ids.id_list, "array<string>") == ["a,b", ""]


def test_bands(make):
    h = [None, 4.9, 5.0, 69.9, 70.0, float("nan")]
    assert _col(make, h, at.height_band, "double") == ["unknown", "<5", "5-15", "55-70", ">=70", "unknown"]
    assert _col(make, [None, 1980, 1981, 2000], at.age_band, "int") == ["unknown", "<1981", "1981-1999", ">=2000"]
    assert _col(make, [1949, 1980, 1981, 2020], at.decade_band, "int") == ["<1950", "1970-1980", "1981-1989", ">=2020"]
    assert _col(make, [None, -5.0, 30.0, 99.0], lambda c: at.ramp_position(c, 0, 60), "double") == [None, 0.0, 3.5, 7.0]


def test_rank_columns_take_whole_numbers_only(make):
    df = make([("2", None), ("2.0", None), ("2.7", None), ("x", None), (None, None)], "depth_rank string, x int")
    got = [r.depth_m for r in at.with_depth(df, "river_flood").collect()]
    assert got == [3.0, 3.0, None, None, None]
