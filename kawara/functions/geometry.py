"""Planar geometry as column expressions.

A polygon is ``edges``: the directed segments of all rings of all parts. Even-odd parity
over these edges answers "inside?" for holes, multi-part shapes and harmlessly invalid
rings alike, so no repair step is needed. ``parts`` (parts -> rings -> edges) is kept only
where a result depends on the ring structure.

The predicates on single edges are SQL text, to be used in ``F.expr`` with lambda variables:
they are nested two deep in higher-order functions, and one parsed expression is far quicker
to build than hundreds of column objects.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6378137.0


def edge(x1, y1, x2, y2) -> Column:
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def box_edges(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.array(
        edge(x0, y0, x1, y0), edge(x1, y0, x1, y1), edge(x1, y1, x0, y1), edge(x0, y1, x0, y0)
    )


def ring_edges(ring: Column) -> Column:
    """Edges of one ring of positions, closed when the source left it open."""
    n = F.size(ring)

    def seg(i):
        a, b = F.get(ring, i), F.get(ring, (i + 1) % n)
        return edge(F.get(a, F.lit(0)), F.get(a, F.lit(1)), F.get(b, F.lit(0)), F.get(b, F.lit(1)))

    segs = F.transform(F.sequence(F.lit(0), n - 1), seg)
    return F.when(
        n > 0, F.filter(segs, lambda e: (e.x1 != e.x2) | (e.y1 != e.y2))
    ).otherwise(F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>"))


def ring_is_closed(ring: Column) -> Column:
    first, last = F.get(ring, F.lit(0)), F.element_at(ring, -1)
    return (F.get(first, F.lit(0)) == F.get(last, F.lit(0))) & (
        F.get(first, F.lit(1)) == F.get(last, F.lit(1))
    )


def geojson_polygons(geometry_type: Column, coordinates: Column) -> Column:
    """GeoJSON coordinates (as JSON text) -> parts of rings of positions; Z is ignored later."""
    one = F.from_json(coordinates, "array<array<array<double>>>")
    many = F.from_json(coordinates, "array<array<array<array<double>>>>")
    return F.when(geometry_type == "Polygon", F.array(one)).when(
        geometry_type == "MultiPolygon", many
    )


def parts_of(polygons: Column) -> Column:
    return F.transform(polygons, lambda part: F.transform(part, ring_edges))


def edges_of(parts: Column) -> Column:
    return F.flatten(F.flatten(parts))


def all_rings_closed(polygons: Column) -> Column:
    return F.forall(polygons, lambda part: F.forall(part, ring_is_closed))


def bbox(edges: Column) -> dict[str, Column]:
    """Bounds of the edges; rings are closed, so start points are enough. Compiled, as lambdas are not."""
    xs, ys = edges.getField("x1"), edges.getField("y1")
    return {
        "minx": F.array_min(xs),
        "miny": F.array_min(ys),
        "maxx": F.array_max(xs),
        "maxy": F.array_max(ys),
    }


# --- predicates on an edge ``e``, as SQL text ---------------------------------------


def num(v: float) -> str:
    return f"{float(v)!r}D"


def x_at(e: str, y: str) -> str:
    return f"({e}.x1 + ({y} - {e}.y1) * ({e}.x2 - {e}.x1) / ({e}.y2 - {e}.y1))"


def straddles_y(e: str, y: str) -> str:
    """Half-open rule: a vertex on the line belongs to exactly one of its two edges."""
    return f"(({e}.y1 > {y}) != ({e}.y2 > {y}))"


def straddles_x(e: str, x: str) -> str:
    return f"(({e}.x1 > {x}) != ({e}.x2 > {x}))"


def side(e: str, x: str, y: str) -> str:
    """Which side of the edge's line a point lies on; zero on the line."""
    return f"(({e}.x2 - {e}.x1) * ({y} - {e}.y1) - ({x} - {e}.x1) * ({e}.y2 - {e}.y1))"


def right_of(e: str, x: str, y: str) -> str:
    """Is the point on the negative side of the edge? A point on the line counts as nudged
    up, then right, which is what the half-open straddle rules take for granted."""
    s = side(e, x, y)
    on_line = f"({e}.x2 < {e}.x1 OR ({e}.x2 = {e}.x1 AND {e}.y2 > {e}.y1))"
    return f"({s} < 0 OR ({s} = 0 AND {on_line}))"


def on_segment(e: str, x: str, y: str) -> str:
    return (
        f"({side(e, x, y)} = 0"
        f" AND {x} BETWEEN least({e}.x1, {e}.x2) AND greatest({e}.x1, {e}.x2)"
        f" AND {y} BETWEEN least({e}.y1, {e}.y2) AND greatest({e}.y1, {e}.y2))"
    )


def inside_parity(edges: str, x: str, y: str) -> str:
    """Even-odd test against the whole edge list (for small polygons)."""
    crossed = f"{straddles_y('e', y)} AND ({right_of('e', x, y)} = (e.y2 > e.y1))"
    return f"(size(filter({edges}, e -> {crossed})) % 2 = 1)"


def _cross_properly(a: str, b: str) -> str:
    def apart(e, f):
        return f"(signum({side(e, f + '.x1', f + '.y1')}) * signum({side(e, f + '.x2', f + '.y2')}) < 0)"

    return f"({apart(a, b)} AND {apart(b, a)})"


def segments_touch(a: str, b: str) -> str:
    """Do two closed segments share a point?"""
    ends = [
        on_segment(a, f"{b}.x1", f"{b}.y1"),
        on_segment(a, f"{b}.x2", f"{b}.y2"),
        on_segment(b, f"{a}.x1", f"{a}.y1"),
        on_segment(b, f"{a}.x2", f"{a}.y2"),
    ]
    return f"({_cross_properly(a, b)} OR {' OR '.join(ends)})"


def _point_near_segment(x: str, y: str, e: str, eps: float) -> str:
    """Distance of a point and a segment at most ``eps``.

    The foot point is written out where it is used: binding it with a nested lambda would let
    the optimiser take "a near b" and "b near a" for the same expression.
    """
    dx, dy = f"({e}.x2 - {e}.x1)", f"({e}.y2 - {e}.y1)"
    t = (
        f"coalesce(least(greatest(try_divide(({x} - {e}.x1) * {dx} + ({y} - {e}.y1) * {dy},"
        f" {dx} * {dx} + {dy} * {dy}), 0D), 1D), 0D)"
    )
    ex, ey = f"({x} - {e}.x1 - {t} * {dx})", f"({y} - {e}.y1 - {t} * {dy})"
    return f"({ex} * {ex} + {ey} * {ey} <= {num(eps * eps)})"


def segments_within(a: str, b: str, eps: float) -> str:
    """Is the distance of two segments at most ``eps``?"""
    boxes = " AND ".join(
        f"least({p}.{c}1, {p}.{c}2) <= greatest({q}.{c}1, {q}.{c}2) + {num(eps)}"
        for c in "xy"
        for p, q in ((a, b), (b, a))
    )
    ends = " OR ".join(
        _point_near_segment(f"{p}.{v[0]}", f"{p}.{v[1]}", q, eps)
        for p, q in ((a, b), (b, a))
        for v in (("x1", "y1"), ("x2", "y2"))
    )
    return f"({boxes} AND ({_cross_properly(a, b)} OR {ends}))"


def polygons_within(ea: str, eb: str, eps: float) -> str:
    """Is the distance of two polygons at most ``eps`` (zero when one holds the other)?"""
    near = f"exists({ea}, a -> exists({eb}, b -> {segments_within('a', 'b', eps)}))"

    def holds(outer, inner):
        return f"exists({ring_starts(inner)}, v -> {inside_parity(outer, 'v.x', 'v.y')})"

    return f"({near} OR {holds(ea, eb)} OR {holds(eb, ea)})"


def ring_starts(edges: str) -> str:
    """One vertex per ring: the start of every edge that does not continue the one before."""
    continues = (
        f"coalesce(get({edges}, i - 1).x2 = e.x1 AND get({edges}, i - 1).y2 = e.y1, false)"
    )
    return (
        f"transform(filter({edges}, (e, i) -> NOT {continues}),"
        " e -> struct(e.x1 AS x, e.y1 AS y))"
    )


def box_edges_sql(x0: str, y0: str, x1: str, y1: str) -> str:
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    sides = (
        f"struct({a[0]} AS x1, {a[1]} AS y1, {b[0]} AS x2, {b[1]} AS y2)"
        for a, b in zip(corners, corners[1:] + corners[:1])
    )
    return f"array({', '.join(sides)})"


def representative_point(parts: str) -> Column:
    """A point inside the polygon: middle of the widest inside gap on a mid-height line.

    The line runs halfway between the vertices next above and below the middle of each
    part; the widest gap over all parts wins, the leftmost on ties.
    """
    ys = "transform(es, e -> e.y1)"
    mid = "((m.lo + m.hi) / 2D)"
    line = (
        f"transform(array(struct(array_min({ys}) AS lo, array_max({ys}) AS hi)), m ->"
        f" (array_max(filter({ys}, v -> v <= {mid})) + array_min(filter({ys}, v -> v > {mid}))) / 2D)"
    )
    cuts = f"array_sort(transform(filter(es, e -> {straddles_y('e', 'y')}), e -> {x_at('e', 'y')}))"
    gaps = (
        "transform(filter(transform(xs, (lo, i) -> struct(lo, get(xs, i + 1) AS hi, i)), q -> q.i % 2 = 0),"
        " q -> struct(q.hi - q.lo AS w, -((q.lo + q.hi) / 2D) AS nx, y AS y))"
    )
    widest = (
        f"transform({parts}, rings -> array_max(flatten(transform(array(flatten(rings)), es ->"
        f" flatten(transform({line}, y -> flatten(transform(array({cuts}), xs -> {gaps}))))))))"
    )
    best = F.expr(f"array_max({widest})")
    return F.struct((-best["nx"]).alias("x"), best["y"].alias("y"))


def box_point(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Representative point of an axis-parallel box."""
    return F.struct(((x0 + x1) / 2.0).alias("x"), ((y0 + y1) / 2.0).alias("y"))


def _ring_sums(ring: Column) -> Column:
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("sx"), F.lit(0.0).alias("sy"))

    def add(acc, e):
        c = e.x1 * e.y2 - e.x2 * e.y1
        return F.struct(
            (acc.a + c).alias("a"),
            (acc.sx + (e.x1 + e.x2) * c).alias("sx"),
            (acc.sy + (e.y1 + e.y2) * c).alias("sy"),
        )

    return F.aggregate(ring, zero, add)


def signed_sums(parts: Column) -> Column:
    """Shoelace sums with shells counted positive and holes negative, whatever their winding."""

    def of_ring(ring, i):
        s = _ring_sums(ring)
        sign = F.signum(s["a"]) * F.when(i == 0, 1.0).otherwise(-1.0)
        return F.struct(
            (sign * s["a"]).alias("a"), (sign * s["sx"]).alias("sx"), (sign * s["sy"]).alias("sy")
        )

    rings = F.flatten(F.transform(parts, lambda p: F.transform(p, of_ring)))
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("sx"), F.lit(0.0).alias("sy"))
    return F.aggregate(
        rings,
        zero,
        lambda acc, r: F.struct(
            (acc.a + r.a).alias("a"), (acc.sx + r.sx).alias("sx"), (acc.sy + r.sy).alias("sy")
        ),
    )


def mercator_x(lon: Column) -> Column:
    return F.radians(lon) * EARTH_RADIUS_M


def mercator_y(lat: Column) -> Column:
    return F.log(F.tan(F.radians(lat) / 2.0 + math.pi / 4)) * EARTH_RADIUS_M


def mercator_edges(edges: Column) -> Column:
    return F.transform(
        edges,
        lambda e: edge(mercator_x(e.x1), mercator_y(e.y1), mercator_x(e.x2), mercator_y(e.y2)),
    )


def tile_x(lon: Column, zoom: Column) -> Column:
    n = F.pow(F.lit(2.0), zoom)
    x = F.floor((lon + 180.0) / 360.0 * n)
    return F.greatest(F.least(x, (n - 1).cast("long")), F.lit(0).cast("long"))


def tile_y(lat: Column, zoom: Column) -> Column:
    n = F.pow(F.lit(2.0), zoom)
    r = F.radians(lat)
    y = F.floor((1.0 - F.log(F.tan(r) + 1.0 / F.cos(r)) / math.pi) / 2.0 * n)
    return F.greatest(F.least(y, (n - 1).cast("long")), F.lit(0).cast("long"))


def tile_lon(x: Column, zoom: Column) -> Column:
    """Western border of a map tile."""
    return x / F.pow(F.lit(2.0), zoom) * 360.0 - 180.0


def tile_lat(y: Column, zoom: Column) -> Column:
    """Northern border of a map tile."""
    return F.degrees(F.atan(F.sinh(F.lit(math.pi) * (1.0 - 2.0 * y / F.pow(F.lit(2.0), zoom)))))
