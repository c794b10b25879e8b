import math
import random

import pytest

from kawara.operators import containment, resolve
from tests import shapes

POLY = f"dataset_id string, poly_id string, edges {shapes.EDGES}"


def _ratio(make, ext, haz, cell):
    rows = containment.containment_ratio(make(ext, POLY), make(haz, POLY), cell=cell).collect()
    return {r.dataset_id: (r.hazard_area, r.contained_area, r.ratio) for r in rows}


def test_box_areas_are_exact(make):
    ext = [
        ("quarter", "e", shapes.box(0, 0, 2, 10)),
        ("all", "e", shapes.box(0, 0, 8, 8)),
        ("holed", "e", shapes.box(0, 0, 10, 10) + shapes.box(2, 2, 4, 4)),
        ("no_hazard", "e", shapes.box(0, 0, 1, 1)),
    ]
    haz = [
        ("quarter", "h1", shapes.box(0, 0, 8, 10)),
        ("quarter", "h2", shapes.box(1, 1, 3, 3)),
        ("all", "h1", shapes.box(2, 2, 5, 5)),
        ("all", "h2", shapes.box(4, 4, 6, 6)),
        ("holed", "h1", shapes.box(1, 1, 5, 5)),
        ("apart", "h1", shapes.box(1, 1, 5, 5)),
    ]
    for cell in (1.0, 3.0, 64.0):
        got = _ratio(make, ext, haz, cell)
        assert set(got) == {"quarter", "all", "holed", "apart"}
        assert got["quarter"] == pytest.approx((80.0, 20.0, 0.25))
        assert got["all"] == pytest.approx((12.0, 12.0, 1.0))
        assert got["holed"] == pytest.approx((16.0, 12.0, 0.75))
        assert got["apart"] == pytest.approx((16.0, 0.0, 0.0))


def test_crossing_shapes_do_not_depend_on_the_grid(make):
    rng = random.Random(6)
    ext = [("d", f"e{i}", shapes.star(rng.uniform(0, 9), rng.uniform(0, 9), 4, 8, rng)) for i in range(4)]
    haz = [("d", f"h{i}", shapes.star(rng.uniform(0, 9), rng.uniform(0, 9), 4, 12, rng)) for i in range(4)]
    haz.append(("d", "many", shapes.star(5, 5, 3, 90, rng)))
    fine, coarse = _ratio(make, ext, haz, 1.7)["d"], _ratio(make, ext, haz, 40.0)["d"]
    assert fine == pytest.approx(coarse, rel=1e-9)
    n = inside = both = 0
    for i in range(200):
        for j in range(200):
            x, y = -4 + 18 * (i + 0.5) / 200, -4 + 18 * (j + 0.5) / 200
            n += 1
            if any(shapes.inside(e, x, y) for _, _, e in haz):
                inside += 1
                both += any(shapes.inside(e, x, y) for _, _, e in ext)
    assert fine[0] == pytest.approx(inside / n * 18 * 18, rel=0.01)
    assert fine[2] == pytest.approx(both / inside, abs=0.01)


ENTRY = "dataset_id string, kind string, city_code string, declared_full_admin boolean"


def test_resolver_truth_table(make):
    admin_box, hazard_box = shapes.box(0, 0, 10, 10), shapes.box(0, 0, 8, 10)
    entries = make(
        [
            ("pinned", "tsunami", "c", True),
            ("mapped_ok", "river_flood", "c", True),
            ("mapped_short", "river_flood", "c", True),
            ("bounded", "tsunami", "c", True),
            ("declared", "inland_flood", "c", True),
            ("declared_no_city", "inland_flood", "other", True),
            ("nothing", "storm_surge", "c", False),
        ],
        ENTRY,
    )
    explicit = make([("pinned", "p", shapes.box(0, 0, 1, 1))], POLY)
    mapped = make(
        [
            ("pinned", "m", shapes.box(0, 0, 9, 10), ["x"]),
            ("mapped_ok", "m", shapes.box(0, 0, 8, 9.8), ["doc A", "doc B"]),
            ("mapped_short", "m", shapes.box(0, 0, 2, 10), ["doc A"]),
        ],
        POLY + ", documents array<string>",
    )
    hazards = make(
        [(d, "h", hazard_box) for d in ("pinned", "mapped_ok", "mapped_short", "bounded")], POLY
    )
    admin = make([("c", admin_box)], f"city_code string, edges {shapes.EDGES}")
    got = resolve.resolve_extents(
        entries, explicit=explicit, mapped=mapped, hazards=hazards, admin=admin, cell=4.0
    )
    rows = {r.dataset_id: (r.confidence, r.source_id, r.kind) for r in got.collect()}
    assert rows == {
        "pinned": ("explicit_polygon", "pinned", "tsunami"),
        "mapped_ok": ("explicit_polygon", "mapped_ok+ksj:doc A,doc B", "river_flood"),
        "mapped_short": ("inundation_bounded", "mapped_short+inundation_bounded", "river_flood"),
        "bounded": ("inundation_bounded", "bounded+inundation_bounded", "tsunami"),
        "declared": ("declared_full_admin", "declared", "inland_flood"),
    }


def test_documents_map_to_urls_of_the_same_hazard(make):
    docs = make(
        [
            ("d1", 0, "甲川洪水浸水想定区域図（平成29年7月20日）某局"),
            ("d1", 1, "乙川洪水浸水想定区域図"),
            ("d1", 2, "知らない文書"),
            ("d2", 0, "甲川洪水浸水想定区域図"),
        ],
        "dataset_id string, seq int, document string",
    )
    mapping = make(
        [
            ("甲川洪水浸水想定区域図", "river_flood", ["u1", "u2"]),
            ("乙川洪水浸水想定区域図", "river_flood", ["u2"]),
        ],
        "document_name string, hazard string, urls array<string>",
    )
    entries = make([("d1", "river_flood", "c", False), ("d2", "tsunami", "c", False)], ENTRY)
    got = resolve.documents_to_urls(docs, mapping, entries).collect()
    names = ["甲川洪水浸水想定区域図", "乙川洪水浸水想定区域図"]
    assert sorted((r.dataset_id, r.url, r.documents) for r in got) == [
        ("d1", "u1", names),
        ("d1", "u2", names),
    ]


def test_polygons_of_one_id_do_not_cancel_out(make):
    square = shapes.box(0, 0, 4, 4)
    round_ = shapes.ring([(10 + 3 * math.cos(k / 25 * math.pi), 10 + 3 * math.sin(k / 25 * math.pi)) for k in range(50)])
    many = shapes.star(10, 10, 3, 200, random.Random(5))
    for shape in (square, round_, many):
        haz = [("d", "h", shape)] * 2
        ext = [("d", "e", shape), ("d", "e", shapes.box(0, 0, 20, 20)), ("d", "e", shape)]
        for cell in (1.7, 30.0):
            assert _ratio(make, ext, haz, cell)["d"][2] == pytest.approx(1.0)
            assert _ratio(make, ext[:1], haz, cell)["d"][2] == pytest.approx(1.0)


def _teeth(n, x=0.0, w=1.0, h=1.0, ox=0.0, oy=0.0):
    """A comb with n narrow teeth: many edges side by side in one cell."""
    pts = [(x, -0.2)]
    for i in range(n):
        pts += [(x + w * i / n, 0.0), (x + w * (i + 0.5) / n, h * (0.5 + (i * 7 % 11) / 22))]
    pts += [(x + w, 0.0), (x + w, -0.2)]
    return shapes.ring([(a + ox, b + oy) for a, b in pts])


def _area(edges):
    return abs(sum((y2 - y1) * (x1 + x2) / 2 for x1, y1, x2, y2 in edges))


def test_crowded_cells_are_cut_finer(make):
    comb = _teeth(60, ox=0.013, oy=0.31)  # at a cell of 0.1 an edge runs through a corner of the grid
    hole = comb + shapes.box(0.2, 0.15, 0.6, 0.25)
    ext = [("comb", "e", shapes.box(-1, -1, 2, 2)), ("half", "e", shapes.box(-1, -1, 0.513, 2)), ("hole", "e", comb)]
    haz = [("comb", "h", comb), ("half", "h", comb), ("hole", "h", hole)]
    coarse, fine = _ratio(make, ext, haz, 16.0), _ratio(make, ext, haz, 0.1)
    for k in fine:
        assert coarse[k] == pytest.approx(fine[k], rel=1e-9), k
    assert coarse["comb"] == pytest.approx((_area(comb), _area(comb), 1.0))
    assert coarse["hole"][2] == pytest.approx(1.0)


def test_work_of_a_crowded_cell_is_linear(make):
    """Pairs of edges that share a final cell, which is what the work grows with."""

    def pairs(n):
        around = [2 * math.pi * i / n for i in range(n)]
        ring = shapes.ring([(4 + (1 + 0.3 * math.cos(5 * a)) * math.cos(a), 4 + (1 + 0.3 * math.cos(5 * a)) * math.sin(a)) for a in around])
        df = make([("d", "h", "p", ring)], f"dataset_id string, role string, pid string, edges {shapes.EDGES}")
        _, edges = containment._local_edges(df, "dataset_id", 8.0)
        per_cell = edges.groupBy("sz", "cx", "cy").count().collect()
        assert max(r["count"] for r in per_cell) <= containment.CROWDED
        return sum(r["count"] ** 2 for r in per_cell)

    assert pairs(1_920) < 2.5 * pairs(960)
