"""Plain-Python geometry the tests compare with."""

import math
import random


def ring(points):
    pts = list(points)
    return [
        (float(a[0]), float(a[1]), float(b[0]), float(b[1]))
        for a, b in zip(pts, pts[1:] + pts[:1])
    ]


def box(x0, y0, x1, y1):
    return ring([(x0, y0), (x1, y0), (x1, y1), (x0, y1)])


def star(cx, cy, r, n, rng):
    """A star-shaped polygon with n vertices, concave almost everywhere."""
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    return ring(
        (cx + rng.uniform(0.3, 1.0) * r * math.cos(a), cy + rng.uniform(0.3, 1.0) * r * math.sin(a))
        for a in angles
    )


def inside(edges, px, py):
    odd = False
    for x1, y1, x2, y2 in edges:
        if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def on_edge(edges, px, py):
    for x1, y1, x2, y2 in edges:
        if (
            (x2 - x1) * (py - y1) == (px - x1) * (y2 - y1)
            and min(x1, x2) <= px <= max(x1, x2)
            and min(y1, y2) <= py <= max(y1, y2)
        ):
            return True
    return False


def _seg_dist(a, b):
    def pd(px, py, e):
        dx, dy = e[2] - e[0], e[3] - e[1]
        l2 = dx * dx + dy * dy
        t = 0.0 if l2 == 0 else max(0.0, min(1.0, ((px - e[0]) * dx + (py - e[1]) * dy) / l2))
        return math.hypot(px - e[0] - t * dx, py - e[1] - t * dy)

    def o(e, px, py):
        return (e[2] - e[0]) * (py - e[1]) - (px - e[0]) * (e[3] - e[1])

    if o(a, b[0], b[1]) * o(a, b[2], b[3]) < 0 and o(b, a[0], a[1]) * o(b, a[2], a[3]) < 0:
        return 0.0
    return min(pd(a[0], a[1], b), pd(a[2], a[3], b), pd(b[0], b[1], a), pd(b[2], b[3], a))


def distance(ea, eb):
    if any(inside(eb, e[0], e[1]) for e in ea) or any(inside(ea, e[0], e[1]) for e in eb):
        return 0.0
    return min(_seg_dist(a, b) for a in ea for b in eb)


EDGES = "array<struct<x1:double,y1:double,x2:double,y2:double>>"
PARTS = f"array<array<{EDGES}>>"
