import math
import random

import pytest
from pyspark.sql import functions as F

from kawara.functions import geometry as g
from kawara.operators import coverage, spatial
from tests import shapes


def _points(rng, n, lo, hi):
    return [(f"p{i}", rng.uniform(lo, hi), rng.uniform(lo, hi)) for i in range(n)]


def _expected(points, polys):
    return {
        (pid, qid)
        for pid, x, y in points
        for qid, es in polys
        if shapes.inside(es, x, y) and not shapes.on_edge(es, x, y)
    }


def _run(make, points, polys, **kw):
    pts = make(points, "pid string, px double, py double")
    pol = make(polys, f"poly_id string, edges {shapes.EDGES}")
    got = spatial.points_in_polygons(pts, pol, point_cols=["pid"], poly_cols=["poly_id"], **kw)
    rows = [(r.pid, r.poly_id) for r in got.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def _mixed_polygons(rng):
    polys = []
    for i in range(12):
        polys.append((f"small{i}", shapes.star(rng.uniform(0, 20), rng.uniform(0, 20), 4, 9, rng)))
    for i in range(4):
        polys.append((f"large{i}", shapes.star(rng.uniform(5, 15), rng.uniform(5, 15), 9, 700, rng)))
    polys.append(("hole", shapes.box(1, 1, 19, 19) + shapes.box(5, 5, 12, 12)))
    polys.append(("parts", shapes.box(-3, -3, -1, -1) + shapes.box(21, 21, 24, 24)))
    return polys


@pytest.mark.parametrize("cell", [0.37, 2.0, 50.0])
def test_agrees_with_plain_parity(make, cell):
    rng = random.Random(7)
    polys = _mixed_polygons(rng)
    points = _points(rng, 3000, -5, 26)
    assert _run(make, points, polys, cell=cell) == _expected(points, polys)


def test_lattice_corners_and_strict_boundary(make):
    """Vertices, edges and points all on the grid: the worst case for half-open rules."""
    rng = random.Random(3)
    polys = []
    for i in range(30):
        pts = [(rng.randint(0, 8), rng.randint(0, 8)) for _ in range(5)]
        polys.append((f"q{i}", shapes.ring(pts)))
    big = [(0, 0)] + [(8 - (k % 2), k) for k in range(0, 9)] + [(0, 8)]
    polys.append(("zigzag", shapes.ring(big)))
    polys.append(("dense", [e for k in range(20) for e in shapes.box(k % 5, k // 5, k % 5 + 1, k // 5 + 1)]))
    points = [(f"{x}_{y}", x / 2, y / 2) for x in range(-2, 19) for y in range(-2, 19)]
    for cell in (1.0, 0.5, 3.0):
        assert _run(make, points, polys, cell=cell) == _expected(points, polys)


def test_hot_cell_is_salted_without_changing_the_result(make):
    rng = random.Random(11)
    polys = _mixed_polygons(rng)
    points = _points(rng, 500, 9.0, 9.9) + _points(rng, 100, -5, 26)
    points = [(f"p{i}", x, y) for i, (_, x, y) in enumerate(points)]
    got = _run(make, points, polys, cell=2.0, share=1e-2, floor=20)
    assert got == _expected(points, polys)


def test_copies_of_a_point_do_not_cancel_out(make):
    polys = [("big", shapes.star(0, 0, 5, 300, random.Random(1))), ("box", shapes.box(-1, -1, 1, 1))]
    pts = make([("a", 0.01, 0.02)] * 4, "pid string, px double, py double")
    pol = make(polys, f"poly_id string, edges {shapes.EDGES}")
    got = spatial.points_in_polygons(pts, pol, cell=1.0, point_cols=["pid"], poly_cols=["poly_id"])
    assert {(r.pid, r.poly_id) for r in got.collect()} == {("a", "big"), ("a", "box")}


def test_large_flag_is_checked(make):
    with pytest.raises(Exception, match="polygon too large"):
        _run(
            make, [("p", 0.0, 0.0)], [("s", shapes.star(0, 0, 5, 100, random.Random(1)))],
            cell=1.0, large=False,
        )


def test_intersecting_pairs_match_brute_force(make):
    rng = random.Random(5)
    left = [
        (f"l{i}", shapes.star(rng.uniform(0, 30), rng.uniform(0, 30), rng.uniform(0.3, 2), 6, rng))
        for i in range(60)
    ]
    left.append(("touch", shapes.box(31, 0, 32, 1)))
    left.append(("huge", shapes.box(-50, -50, 80, 80)))
    left.append(("in_hole", shapes.box(40.4, 40.4, 40.6, 40.6)))
    right = [
        (f"r{i}", shapes.star(rng.uniform(0, 30), rng.uniform(0, 30), 6, 150, rng)) for i in range(5)
    ]
    right.append(("edge", shapes.box(32, 1, 33, 2)))
    right.append(("ring", shapes.box(40, 40, 41, 41) + shapes.box(40.2, 40.2, 40.8, 40.8)))
    got = spatial.intersecting_pairs(
        make(left, f"lid string, edges {shapes.EDGES}"),
        make(right, f"rid string, edges {shapes.EDGES}"),
        cell=1.5, left_cols=["lid"], right_cols=["rid"], left_id="lid", right_id="rid",
    )
    rows = [(r.lid, r.rid) for r in got.collect()]
    want = {(l, r) for l, le in left for r, re_ in right if shapes.distance(le, re_) == 0.0}
    assert ("touch", "edge") in want and ("in_hole", "ring") not in want
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_polygons_of_one_id_count_apart(make):
    """Small and large ones, twice over: equal ids must not cancel each other out."""
    rng = random.Random(11)
    points = _points(rng, 400, 0, 20)
    for n in (9, 300):
        a, b = shapes.star(10, 10, 9, n, rng), shapes.star(10, 10, 9, n, rng)
        pts = make(points, "pid string, px double, py double")
        pol = make([("same", a), ("same", b), ("same", b)], f"poly_id string, edges {shapes.EDGES}")
        got = spatial.points_in_polygons(pts, pol, cell=1.5, point_cols=["pid"], poly_cols=["poly_id"])
        expected = _expected(points, [("same", a), ("same", b)])
        assert {(r.pid, r.poly_id) for r in got.collect()} == expected


@pytest.mark.parametrize("n", [8, 100])
def test_copies_count_once_whatever_their_size(make, n):
    ring = shapes.ring([(math.cos(2 * math.pi * i / n), math.sin(2 * math.pi * i / n)) for i in range(n)])
    polys = make([("p", ring), ("p", ring), ("q", ring)], f"poly_id string, edges {shapes.EDGES}")
    hits = spatial.points_in_polygons(
        make([(1, 0.1, 0.2)], "k long, px double, py double"), polys, cell=0.5, point_cols=["k"], poly_cols=["poly_id"]
    )
    assert sorted(r.poly_id for r in hits.collect()) == ["p", "q"]


def test_box_selection_looks_at_edges(make):
    rng = random.Random(11)
    rows = [(i, shapes.star(rng.uniform(0, 10), rng.uniform(0, 10), rng.uniform(0.2, 2), rng.randint(3, 9), rng)) for i in range(300)]
    rows += [(300, shapes.ring([(2, 8), (2, 2), (8, 2), (2.5, 2.5)])), (301, shapes.box(-50, -50, 50, 50)), (302, shapes.box(6, 1, 7, 4.0)), (303, [])]
    df = make(rows, f"k long, edges {shapes.EDGES}")
    box = (4.0, 4.0, 7.0, 6.5)
    got = {r.k for r in coverage.box_selection(df, *box).collect()}
    assert got == {k for k, es in rows if es and shapes.distance(es, shapes.box(*box)) == 0.0}
    assert 300 not in got and {301, 302} <= got
    bounds = df.withColumns(g.bbox(F.col("edges")))
    assert {r.k for r in coverage.box_selection(bounds, *box).collect()} == got
