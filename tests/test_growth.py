"""What must not grow with the input: the driver's share of a plan, and the data that is moved."""

import random
import re

from kawara.operators import coverage, identity, skew, spatial
from tests import shapes


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_cells_are_not_sent_through_the_driver(make):
    """Two boxes are few bytes, their cells are not: the estimate stands before the cutting."""
    boxes = make([("a", shapes.box(0, 0, 40, 40)), ("b", shapes.box(9, 9, 70, 70))], f"poly_id string, edges {shapes.EDGES}")
    points = make([("p", 10.5, 10.5), ("q", 60.5, 60.5)], "pid string, px double, py double")
    hits = spatial.points_in_polygons(points, boxes, cell=1.0, point_cols=["pid"], poly_cols=["poly_id"], large=False)
    assert "BroadcastExchange" not in _plan(hits)
    assert sorted(map(tuple, hits.collect())) == [("p", "a"), ("p", "b"), ("q", "b")]
    small = make([("x", shapes.box(39.5, 39.5, 41.5, 41.5))], f"lid string, edges {shapes.EDGES}")
    pairs = spatial.intersecting_pairs(
        small, boxes, cell=1.0, left_cols=["lid"], right_cols=["poly_id"], left_id="lid", right_id="poly_id", large=False
    )
    assert "BroadcastExchange" not in _plan(pairs)
    assert sorted(map(tuple, pairs.collect())) == [("x", "a"), ("x", "b")]


def test_tasks_of_a_join_grow_in_number_not_in_size(make, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 10)
    rng = random.Random(5)
    points = make([(i, rng.uniform(0, 30)) for i in range(1000)], "pid int, px double").selectExpr("*", "floor(px) AS cx")
    hot, pieces = skew.crowding(points, ["cx"])
    assert (hot, pieces) == (None, 100)
    joined = skew.shuffled_join(points, points.select("cx").distinct(), ["cx"], pieces)
    assert joined.count() == 1000 and "hashpartitioning(cx" in _plan(joined) and ", 100)" in _plan(joined)
    assert skew.crowding(points.limit(0), ["cx"]) == (None, 0)


def test_large_polygons_are_cut_where_they_are(make):
    """Only cell rows are moved: the blocks of a large polygon are cut without a shuffle, its copies alike."""
    star = shapes.star(0, 0, 9, 700, random.Random(2))
    polys = make([("a", star), ("a", star)], f"poly_id string, edges {shapes.EDGES}")
    cells = spatial._large_cells(polys, ["poly_id"], 1.0, "edges").where("_block >= 0")
    assert "collect_set" not in cells._jdf.queryExecution().optimizedPlan().toString()
    assert cells.count() == 2 * cells.distinct().count()
    assert {(e.x1, e.y1, e.x2, e.y2) for r in cells.collect() for e in r.edges} == set(star)


def test_rings_equal_their_sql_and_are_moved_once(spark):
    from kawara.plans import inputs

    t = inputs.Inputs(spark, "/root/testdata/sf0.001")
    made = t.mega().selectExpr("poly_id", "inline(edges)")
    told = t.sql(inputs.MEGA_EDGES, "supplier", "lineitem").select("poly_id", "x1", "y1", "x2", "y2")
    assert made.count() == told.count() and made.exceptAll(told).isEmpty()
    assert t._mega()._jdf.queryExecution().executedPlan().toString().count("Window") == 0


def test_missing_ids_store_no_rows(make, monkeypatch):
    """Ids are numbered on counts; hot hashes and many copies take other ways to the same ids."""

    def fail(df):
        raise AssertionError("rows are stored")

    monkeypatch.setattr(identity, "cut_lineage", fail, raising=False)
    rng = random.Random(3)
    rows = [(None, shapes.box(0, 0, 1, k % 3 + 1), rng.randrange(12), {"a": k % 2}) for k in range(200)]
    df = make([*rows, ("own", None, 1, None)], f"gml_id string, edges {shapes.EDGES}, n int, m map<string,int>")
    seen = lambda d: sorted((r.gml_id, r.n, (r.m or {}).get("a", 9)) for r in d.collect())
    plain = seen(identity.fill_missing_ids(df))
    assert len({r[0] for r in plain}) == 201
    assert sorted((n, a) for _, n, a in plain) == sorted([*((n, m["a"]) for _, _, n, m in rows), (1, 9)])
    numbers = sorted(int(i.split("-")[1]) if "-" in i else 1 for i, _, _ in plain if i != "own")
    assert numbers == sorted([*range(1, 68), *range(1, 68), *range(1, 67)])
    monkeypatch.setattr(identity, "COPIES", 2)
    assert seen(identity.fill_missing_ids(df.repartition(7), floor=66)) == plain


def test_small_rows_are_spread_by_their_number(spark):
    df = spark.range(1000).selectExpr("id % 300 AS a")
    some = skew.spread_rows(df, "a", rows=20)
    assert some.rdd.getNumPartitions() == 50 and some.distinct().count() == 300
    assert skew.spread_rows(df, "a").rdd.getNumPartitions() == df.rdd.getNumPartitions()


def test_hits_are_summed_up_in_tasks_that_grow_in_number(make, monkeypatch):
    """Spark's own number of tasks is fixed, and the hits of the buildings of one task grew with the input."""
    rng = random.Random(7)
    rows = [(f"b{i}", x := rng.uniform(0, 29), y := rng.uniform(0, 29), shapes.box(x, y, x + 0.1, y + 0.1)) for i in range(1000)]
    b = make(rows, f"building_uid string, centroid_lon double, centroid_lat double, edges {shapes.EDGES}")
    boxes = [(f"e{i}", "river_flood", f"s{i}", "explicit_polygon", shapes.box(3 * i, i, 3 * i + 9, i + 9)) for i in range(9)]
    ext = make(boxes, f"poly_id string, kind string, source_id string, confidence string, edges {shapes.EDGES}")
    zones = ext.selectExpr("poly_id AS zone_seq", "source_id AS zoning_use", "1f AS far_max", "edges")

    def runs():
        for mode in ("point", "polygon"):
            yield coverage.apply_hazards(b, ext, None, cell=2.0, mode=mode, large=False)
        yield coverage.backfill_zoning(b, zones, cell=2.0, large=False)

    few = [sorted(map(str, df.collect())) for df in runs()]
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 10)
    for df, want in zip(runs(), few):
        assert sorted(map(str, df.collect())) == want
        assert re.search(r"hashpartitioning\(building_uid#\d+, 100\)", _plan(df))
        assert not re.search(r"hashpartitioning\(building_uid#\d+, 8\)", _plan(df))


def test_edges_met_by_a_point_are_rows_of_compiled_code(make):
    """Functions on the array of edges are not compiled, and took most of the time of the join."""
    star = shapes.star(0, 0, 9, 700, random.Random(3))
    polys = make([("a", star), ("a", star), ("b", star)], f"poly_id string, edges {shapes.EDGES}")
    rng = random.Random(8)
    rows = [(i, rng.uniform(-9, 9), rng.uniform(-9, 9)) for i in range(300)]
    points = make([*rows, (300, star[5][0], star[5][1])], "pid int, px double, py double")
    hits = spatial.points_in_polygons(points, polys, cell=1.0, point_cols=["pid"], poly_cols=["poly_id"])
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode(_re#" in plan and not re.search(r"(filter|exists)\(_re#", plan)
    want = sorted((i, p) for i, x, y in rows if shapes.inside(star, x, y) for p in "ab")
    assert sorted(map(tuple, hits.collect())) == want
