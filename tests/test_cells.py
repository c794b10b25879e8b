"""Cutting and matching in tasks: the same whatever the size of the batches, and without a row per pair."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from kawara.functions import cells
from kawara.operators import coverage, skew, spatial
from tests import shapes

EDGES = pa.list_(pa.struct([(c, pa.float64()) for c in cells.AXES]))


def _listed(es):
    return [dict(zip(cells.AXES, e)) for e in es]


def _cell_rows(polys, size, batch, vertices=False):
    blocks = []
    for name, es in polys:
        parts = [es[i : i + 64] for i in range(0, len(es), 64)]
        blocks += [{"id": name, "_n": len(parts), "_b": b, "_edges": _listed(p)} for b, p in enumerate(parts)]
    table = pa.Table.from_pylist(blocks, pa.schema([("id", pa.string()), ("_n", pa.int32()), ("_b", pa.int32()), ("_edges", EDGES)]))
    made = cells.cut(size, 1e-7, 64, ["id"], vertices)(iter(table.to_batches(batch)))
    return [{"id": r["id"], "cy": r["cy"], **c} for b in made for r in b.to_pylist() for c in r["_re"]]


def _met(points, boxes, polys, size, batch):
    rows = [
        {"cx": int(x // size), "cy": int(y // size), "_side": cells.POINT, "_l": {"k": k}, "_es": _listed([(x, y, x, y)])} for k, x, y in points
    ]
    for k, es in boxes:
        (x0, y0), (x1, y1) = es[0][:2], es[1][2:]
        for cx in range(int(x0 // size), int(x1 // size) + 1):
            rows += [
                {"cx": cx, "cy": cy, "_side": cells.SHAPE, "_l": {"k": k}, "_es": _listed(es)}
                for cy in range(int(y0 // size), int(y1 // size) + 1)
            ]
    for c in _cell_rows(polys, size, batch, vertices=True):
        side = cells.VERTEX if c["_block"] == -2 else cells.PIECE
        rows.append({"cx": c["cx"], "cy": c["cy"], "_side": side, "_pk": int(c["id"][1:]), "_block": c["_block"], "base": c["base"], "_r": {"id": c["id"]}, "_es": c["edges"]})
    schema = pa.schema(
        [("cx", pa.int64()), ("cy", pa.int64()), ("_side", pa.int32()), ("_pk", pa.int64()), ("_block", pa.int64()), ("base", pa.int32()),
         ("_l", pa.struct([("k", pa.int64())])), ("_r", pa.struct([("id", pa.string())])), ("_es", EDGES)]
    )
    rows = [{"_pk": 0, "_block": 0, "base": 0, **r} for r in rows]
    rows.sort(key=lambda r: tuple(r[c] for c in ("cx", "cy", "_side", "_pk", "_block")))
    table = pa.Table.from_pylist(rows, schema)
    made = cells.meet(size, ["cx", "cy"])(iter(table.to_batches(batch)))
    return sorted({(r["_l"]["k"], r["_r"]["id"]) for b in made for r in b.to_pylist()})


@pytest.mark.parametrize("batch", [3, 10_000])
def test_batches_of_any_size_give_the_same(monkeypatch, batch):
    rng = random.Random(4)
    polys = [(f"p{i}", shapes.star(rng.uniform(0, 9), rng.uniform(0, 9), rng.uniform(1, 6), n, rng)) for i, n in enumerate([3, 70, 300, 4])]
    polys.append(("p9", shapes.box(2.25, 2.25, 2.5, 2.5) + shapes.box(8, 8, 8.1, 8.1)))  # two parts
    polys += [polys[2], polys[3]]  # copies count once
    points = [(i, rng.uniform(-4, 13), rng.uniform(-4, 13)) for i in range(150)] + [(150, *polys[1][1][7][:2])]
    at = [(rng.uniform(0, 9), rng.uniform(0, 9)) for _ in range(40)]
    boxes = [(1000 + i, shapes.box(x, y, x + 0.3, y + 0.3)) for i, (x, y) in enumerate(at)] + [(2000, shapes.box(2, 2, 3, 3)), (2001, shapes.box(7.5, 7.5, 8.5, 8.5))]
    if batch == 3:
        monkeypatch.setattr(cells, "ROWS", 4)
        monkeypatch.setattr(cells, "PAIRS", 30)
    for size in (0.7, 2.0):
        met = _met(points, [], polys, size, batch)
        assert met == sorted({(k, p) for k, x, y in points for p, es in polys if shapes.inside(es, x, y) and not shapes.on_edge(es, x, y)})
        met = _met([], boxes, polys, size, batch)
        assert met == sorted({(k, p) for k, b in boxes for p, es in polys if shapes.distance(b, es) == 0.0})
        assert (2000, "p9") in met and (2001, "p9") in met


def test_cell_rows_of_a_polygon_do_not_depend_on_batches(monkeypatch):
    star = shapes.star(3, 3, 9, 700, random.Random(2))
    polys = [("p1", star), ("p2", star), ("p3", shapes.box(-40, 0, 40, 1))]
    one = _cell_rows(polys, 1.0, 10_000)
    monkeypatch.setattr(cells, "ROWS", 8)
    monkeypatch.setattr(cells, "PAIRS", 50)
    key = lambda r: (r["id"], r["cy"], r["cx"], r["_block"])
    assert sorted(_cell_rows(polys, 1.0, 1), key=key) == sorted(one, key=key)
    assert max(len(r["edges"]) for r in one) <= 64 and len(set(map(key, one))) == len(one)
    mine = [[(r["cx"], r["cy"], r["_block"], r["edges"]) for r in one if r["id"] == p] for p in ("p1", "p2")]
    assert mine[0] == mine[1]
    with np.errstate(all="raise"):  # unknown coordinates are left out, as they meet nothing
        assert _cell_rows([("p4", [*shapes.box(0, 0, 1, 1), (None, 0.0, 1.0, 1.0)])], 1.0, 10) == _cell_rows([("p4", shapes.box(0, 0, 1, 1))], 1.0, 10)


def test_points_and_large_polygons_are_dealt_once_and_not_joined(make):
    """A join made a row per point and edge, in a method too long for Java to compile."""
    star = shapes.star(0, 0, 9, 700, random.Random(3))
    polys = make([("a", star)], f"poly_id string, edges {shapes.EDGES}")
    points = make([(1, 0.1, 0.1), (2, 50.0, 50.0)], "pid int, px double, py double")
    hits = spatial.points_in_polygons(points, polys, cell=1.0, point_cols=["pid"], poly_cols=["poly_id"])
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Join" not in plan and len(re.findall(r"\bExchange\b", plan)) == 1
    assert [tuple(r) for r in hits.collect()] == [(1, "a")]


def test_footprints_and_large_polygons_are_dealt_once_and_not_joined(make):
    """Vertices and footprints had joins of their own, and pairs were made distinct by one more shuffle."""
    star, ring = shapes.star(0, 0, 9, 700, random.Random(3)), shapes.box(20, 20, 30, 30) + shapes.box(22, 22, 28, 28)
    left = [(i, shapes.box(x, x, x + 0.5, y)) for i, (x, y) in enumerate([(0.1, 0.4), (8.5, 9), (21, 21.5), (24, 24.5), (21.8, 22.1)])]
    left += [(5, shapes.box(-0.05, -0.05, 0.05, 0.05)), (6, shapes.box(-20, -20, 20, 20))]
    polys = [("a", star), ("ring", ring)]
    pairs = spatial.intersecting_pairs(
        make(left, f"lid int, edges {shapes.EDGES}"), make(polys, f"rid string, edges {shapes.EDGES}"),
        cell=1.5, left_cols=["lid"], right_cols=["rid"], left_id="lid", right_id="rid", distinct=False,
    )
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Join" not in plan and len(re.findall(r"\bExchange\b", plan)) == 1
    want = {(k, p) for k, le in left for p, es in polys if shapes.distance(le, es) == 0.0}
    assert {tuple(r) for r in pairs.collect()} == want and (3, "ring") not in want


def test_clip_deals_pairs_once_for_all(make):
    """They were dealt to be made distinct and again to be joined, and footprints went through the driver."""
    rng = random.Random(6)
    rows = [(f"b{i}", shapes.box(x, y, x + 0.3, y + 0.3)) for i in range(60) for x, y in [(rng.uniform(-9, 9), rng.uniform(-9, 9))]]
    rows += [("b0", shapes.box(0, 0, 0.1, 0.1)), rows[1], (None, shapes.box(0, 0, 0.1, 0.1))]
    star = shapes.star(0, 0, 9, 300, rng)
    cities = make([("c1", star), ("c2", shapes.box(0, 0, 9, 9))], f"city_code string, edges {shapes.EDGES}")
    clipped = coverage.clip_to_boundary(make(rows, f"gml_id string, edges {shapes.EDGES}"), cities, cell=1.0)
    want = [(k, c) for k, es in rows for c, poly in (("c1", star), ("c2", shapes.box(0, 0, 9, 9))) if k and shapes.distance(es, poly) == 0.0]
    assert sorted((r.gml_id, r.city_code) for r in clipped.collect()) == sorted(want)
    plan = clipped._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan and "BroadcastHashJoin" not in plan


def test_clip_serves_distinct_and_join_by_one_shuffle(make, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 5)
    rows = [(f"b{i}", shapes.box(i / 10, 0, i / 10 + 0.2, 0.2)) for i in range(100)]
    city = make([("c", shapes.star(0, 0, 9, 300, random.Random(6)))], f"city_code string, edges {shapes.EDGES}")
    clipped = coverage.clip_to_boundary(make(rows, f"gml_id string, edges {shapes.EDGES}"), city, cell=1.0)
    plan = clipped._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\([^)]*city_code", plan) and "hashpartitioning(gml_id" in plan


def test_hits_of_all_kinds_are_summed_up_at_once(make):
    """By building and kind, and then by building, were two aggregates of objects, each sorted by text."""
    schema = "building_uid string, role string, kind string, source_id string, rank int, depth_m double, in_zone boolean"
    rows = [
        ("b1", "extent", "river_flood", "s2", 1, None, False), ("b1", "extent", "river_flood", "s1", 3, None, False),
        ("b1", "hazard", "river_flood", "h", 0, 0.5, False), ("b1", "hazard", "river_flood", "h", 0, 2.0, False),
        ("b1", "hazard", "tsunami", "t", 0, 9.0, False),  # not covered: must not show
        ("b2", "extent", "landslide", "s3", 2, None, False), ("b2", "hazard", "landslide", None, 0, None, True),
        ("b3", "hazard", "river_flood", "h", 0, 1.0, False),
    ]
    hits = make(rows, schema)
    summed = coverage.summarise_hits(hits)
    plan = summed._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bExchange\b", plan)) == 1
    got = {r.building_uid: r for r in coverage.with_hazard_columns(make([("b1",), ("b2",), ("b3",)], "building_uid string"), summed).collect()}
    b = got["b1"]
    assert (b.river_flood_covered, b.river_flood_coverage_source_ids, b.river_flood_hit_source_ids, b.river_flood_depth_max) == (True, "s1,s2", "h", 2.0)
    assert (b.tsunami_covered, b.tsunami_hit_source_ids, b.tsunami_depth_max, b.tsunami_coverage_confidence) == (False, "", None, "unknown")
    assert (got["b2"].landslide_covered, got["b2"].landslide_in_zone, got["b2"].landslide_hit_source_ids) == (True, True, "")
    assert not any(v for k, v in got["b3"].asDict().items() if k.endswith("_covered"))
