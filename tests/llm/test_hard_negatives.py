import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kawara.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows):
    """Every anchor against every other row."""
    good = []
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out = []
    for a in (g for g in good if g[0] % 100 == 0):
        others = [(-sum(x * y for x, y in zip(a[1], g[1])), g[0], g[2]) for g in good if g is not a and len(g[1]) == len(a[1])]
        for ps, pid, _ in sorted(o for o in others if o[2] == a[2])[:5]:
            fits = sorted(o for o in others if o[2] != a[2] and 30 * -ps <= 100 * -o[0] <= 90 * -ps)
            out += [(a[0], pid, r, o[1], -ps, -o[0]) for r, o in enumerate(fits[:10], 1)]
    return sorted(out)


def got(df):
    cols = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in df.select(cols).collect())


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 64, 40), (70, 65, 129), (128, 128, 128), (5, 300, 90)])
def test_strassen_is_the_product(shape):
    n, k, m = shape
    g = np.random.default_rng(3)
    a, b = g.integers(-(10**6), 10**6, (n, k)), g.integers(-(10**6), 10**6, (k, m))
    assert (H.strassen(a, b) == a @ b).all()
    big = np.full((n, k), 1 << 26)  # sums on the way may wrap, results do not
    assert (H.strassen(big, np.full((k, m), -(1 << 26))) == -k * (1 << 52)).all()


@pytest.mark.parametrize("tile", [(2_048, 16_384), (2, 50)])
def test_equals_all_pairs(make, tile):
    r = random.Random(5)
    rows = [(i, [r.gauss(0, 0.3) for _ in range(6)], r.randrange(3)) for i in range(900)]
    rows += [(i, [round(r.gauss(0, 1)) / 4 for _ in range(6)], 1) for i in range(900, 1_100)]  # many ties
    rows += [(400, [0.5] * 6, 2), (400, [0.5] * 6, 2), (401, [0.5] * 6, 0), (401, [0.5] * 6, 0)]
    rows += [(500, [1.0, 2.0], 1), (7, [1.0, 1.0], 1), (8, [0.4, 0.5], 2), (700, None, 1), (800, [None] * 6, 1)]
    rows += [(900, [float("nan")] * 6, 1), (None, [0.1] * 6, 1), (1_000, [0.2] * 6, None), (1_200, [], 1), (1_300, [float("inf")] * 6, 0)]
    df = make(rows, SCHEMA).selectExpr("*", *[f"'x' AS `{c}`" for c in ("id", "v", "asked", "block", "score", "a.b")])
    df = df.repartition(7)
    assert got(H.mine(df, F.col("vec_id") % 100 == 0, tile=tile)) == plain(rows)


def test_none_to_find(make):
    asked = F.col("vec_id") % 100 == 0
    assert got(H.mine(make([], SCHEMA), asked)) == []
    assert got(H.mine(make([(1, [0.5], 1), (2, [0.5], 2)], SCHEMA), asked)) == []  # no anchor
    assert got(H.mine(make([(100, [0.5], 1), (2, [0.5], 2)], SCHEMA), asked)) == []  # no positive


def test_scores_beyond_a_long_are_refused(make):
    with pytest.raises(ValueError, match="pass"):
        H.mine(make([(100, [1e30], 1), (1, [1e30], 1)], SCHEMA), F.col("vec_id") % 100 == 0)
