import random

import pytest

from kawara.operators import components, proximity
from tests import shapes

SCHEMA = f"building_uid string, height float, edges {shapes.EDGES}"


def _by_uid(df):
    return {r.building_uid: (r.complex_uid, r.complex_max_height) for r in df.collect()}


def _expected(rows, eps):
    parent = {r[0]: r[0] for r in rows}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, a in enumerate(rows):
        for b in rows[:i]:
            if shapes.distance(a[2], b[2]) <= eps:
                parent[find(a[0])] = find(b[0])
    groups = {}
    for r in rows:
        groups.setdefault(find(r[0]), []).append(r)
    out = {}
    for members in groups.values():
        uid = min((m[0] for m in members), key=lambda u: (len(u), u))
        known = [m[1] for m in members if m[1] is not None]
        for m in members:
            out[m[0]] = (uid, max(known) if known else None)
    return out


def _run(make, rows, eps=0.5, cell=15.0, **kw):
    return _by_uid(
        components.building_complexes(make(rows, SCHEMA), eps=eps, cell=cell, project=False, **kw)
    )


def test_small_cases(make):
    got = _run(
        make,
        [
            ("a", 30.0, shapes.box(0, 0, 10, 10)),
            ("b", 80.0, shapes.box(10, 0, 20, 10)),
            ("alley", 5.0, shapes.box(21.5, 0, 30, 10)),
            ("podium", 30.0, shapes.box(100, 100, 130, 130)),
            ("tower", 200.0, shapes.box(105, 105, 125, 125)),
            ("row1", 20.0, shapes.box(200, 0, 210, 10)),
            ("row2", 50.0, shapes.box(210, 0, 220, 10)),
            ("row33", None, shapes.box(220, 0, 230, 10)),
            ("lonely", 20.0, shapes.box(500, 500, 510, 510)),
        ],
    )
    assert got["a"] == got["b"] == ("a", 80.0)
    assert got["alley"] == ("alley", 5.0)
    assert got["podium"] == got["tower"] == ("tower", 200.0)
    assert got["row1"] == got["row2"] == got["row33"] == ("row1", 50.0)
    assert got["lonely"] == ("lonely", 20.0)


def _random_rows(rng, n, width, side):
    rows = []
    for i in range(n):
        x, y = rng.uniform(0, width), rng.uniform(0, width)
        w, h = rng.uniform(0.2, side), rng.uniform(0.2, side)
        rows.append((f"u{i}", float(rng.randint(3, 60)), shapes.box(x, y, x + w, y + h)))
    return rows


def test_random_footprints_match_union_find(make):
    rows = _random_rows(random.Random(2), 150, 60, 4)
    assert _run(make, rows) == _expected(rows, 0.5)


@pytest.mark.parametrize("seed", [1, 4])
def test_crowded_cells_and_copies_match_union_find(make, seed):
    """Small groups allowed, so that cutting, covered cells and tiny cells are all used."""
    rng = random.Random(seed)
    rows = _random_rows(rng, 40, 12, 3)
    rows += [(f"copy{i}", float(i), shapes.box(40, 40, 42, 43)) for i in range(12)]
    rows += [
        (f"speck{i}", 1.0, shapes.box(30 + i * 0.011, 30, 30.004 + i * 0.011, 30.004)) for i in range(14)
    ]
    rows.append(("near_copy", 99.0, shapes.box(42.4, 40, 43, 41)))
    rows.append(("far_copy", 7.0, shapes.box(43.6, 40, 44, 41)))
    assert _run(make, rows, max_group=5) == _expected(rows, 0.5)


def test_pairs_are_reported_once(make):
    rows = _random_rows(random.Random(9), 80, 30, 5)
    df = make(rows, SCHEMA)
    got = [(r.a, r.b) for r in proximity.proximity_pairs(df, 0.5, 4.0).collect()]
    want = {
        tuple(sorted((a[0], b[0])))
        for i, a in enumerate(rows)
        for b in rows[:i]
        if shapes.distance(a[2], b[2]) <= 0.5
    }
    assert len(got) == len(set(got)) and set(got) == want


def test_long_chain_settles_in_few_rounds(make):
    links = make([(f"n{i:04d}", f"n{i + 1:04d}") for i in range(300)], "a string, b string")
    got = components.connected_components(links, max_rounds=20).collect()
    assert len(got) == 301 and {r.root for r in got} == {"n0000"}
