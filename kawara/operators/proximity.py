"""Which footprints lie within ``eps`` of each other, as links of a graph.

Candidates meet in grid cells: two footprints at most ``eps`` apart both reach, grown by
``eps / 2``, the cell that holds the middle of the gap. What keeps crowded places affordable:

* identical footprints are linked to one shared node instead of to each other;
* a cell that lies wholly inside some footprint needs no pairs at all: every footprint within
  ``eps`` of the cell is within ``eps`` of the one that covers it, so all of them are linked
  to a node for the cell;
* any other cell with more than ``max_group`` footprints is cut into 4 x 4 smaller cells, over
  and over, until it is covered or thinly populated. In cells far smaller than ``eps`` the
  footprints that come close enough are within ``eps`` of each other by the cell's size alone
  and share a node as well; only the few in the thin rim around them are compared one by one.

The links are the edges of a graph whose components are those of the full pair list.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kawara.functions import geometry as g
from kawara.operators import skew
from kawara.session import cut_lineage, spread

MAX_GROUP = 256


def _cell_box(size: float) -> str:
    x0, y0 = f"cx * {g.num(size)}", f"cy * {g.num(size)}"
    x1, y1 = f"(cx + 1) * {g.num(size)}", f"(cy + 1) * {g.num(size)}"
    return g.box_edges_sql(x0, y0, x1, y1)


def _near_cell(size: float, dist: float) -> Column:
    """Is the footprint at most ``dist`` away from its cell?"""
    return F.expr(g.polygons_within("edges", _cell_box(size), dist))


def _covers_cell(size: float) -> Column:
    """Does the footprint hold its whole cell? No edge reaches it and its middle is inside."""
    mid_x, mid_y = f"((cx + 0.5D) * {g.num(size)})", f"((cy + 0.5D) * {g.num(size)})"
    reaches = (
        f"exists(edges, a -> exists({_cell_box(size)}, b -> {g.segments_touch('a', 'b')})"
        f" OR (a.x1 BETWEEN cx * {g.num(size)} AND (cx + 1) * {g.num(size)}"
        f" AND a.y1 BETWEEN cy * {g.num(size)} AND (cy + 1) * {g.num(size)}))"
    )
    return F.expr(f"NOT {reaches} AND {g.inside_parity('edges', mid_x, mid_y)}")


def _members(shapes: DataFrame, size: float, eps: float) -> DataFrame:
    def span(lo, hi):
        return F.sequence(
            F.floor((F.col(lo) - eps / 2) / size - 1e-7), F.floor((F.col(hi) + eps / 2) / size + 1e-7)
        )

    return shapes.withColumn("cx", F.explode(span("minx", "maxx"))).withColumn(
        "cy", F.explode(span("miny", "maxy"))
    )


def _pairs(left: DataFrame, right: DataFrame, size: float, eps: float, once: bool) -> DataFrame:
    """Pairs of one cell at most ``eps`` apart.

    ``once`` reports a pair in a single cell, the one with the lower left corner of the grown
    boxes' overlap. That cell must exist on the same grid, so it is off for cut cells.
    """
    cols = ["node", "minx", "miny", "maxx", "maxy", "edges"]
    a = left.select("cx", "cy", *[F.col(c).alias(f"a_{c}") for c in cols])
    b = right.select("cx", "cy", *[F.col(c).alias(f"b_{c}") for c in cols])
    near = (
        (F.col("a_minx") <= F.col("b_maxx") + eps)
        & (F.col("b_minx") <= F.col("a_maxx") + eps)
        & (F.col("a_miny") <= F.col("b_maxy") + eps)
        & (F.col("b_miny") <= F.col("a_maxy") + eps)
    )
    if left is right:
        near = near & (F.col("a_node") < F.col("b_node"))
    else:
        near = near & (F.col("a_node") != F.col("b_node"))
    if once:
        own_x = F.floor((F.greatest("a_minx", "b_minx") - eps / 2) / size)
        own_y = F.floor((F.greatest("a_miny", "b_miny") - eps / 2) / size)
        near = near & (own_x == F.col("cx")) & (own_y == F.col("cy"))
    return (
        a.join(b, ["cx", "cy"])
        .where(near)
        .where(F.expr(g.polygons_within("a_edges", "b_edges", eps)))
        .select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    )


def proximity_pairs(shapes: DataFrame, eps: float, cell: float, node: str = "building_uid") -> DataFrame:
    """All pairs (a < b) at most ``eps`` apart: the literal self-join, for output as pairs."""
    prepared = shapes.select(F.col(node).alias("node"), "edges").withColumns(g.bbox(F.col("edges")))
    members = _members(prepared, cell, eps)
    return _pairs(members, members, cell, eps, once=True)


def _node(prefix: str, *cols) -> Column:
    """Name of a shared node; the control character keeps it apart from building ids."""
    return F.concat_ws(":", F.lit("\u0001" + prefix), *cols)


def _without_copies(shapes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one footprint per distinct outline, links of copies to their shared node).

    Only outlines whose hash occurs twice are compared as a whole; in a table without copies
    no geometry is moved at all.
    """
    hashed = shapes.withColumn("h", F.xxhash64("edges"))
    twice = cut_lineage(
        hashed.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    )
    none = shapes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    if twice.isEmpty():
        return shapes, none
    lone = hashed.join(twice, "h", "left_anti").select("node", "edges")
    same = hashed.join(twice, "h", "left_semi")
    groups = cut_lineage(
        same.groupBy("h", "edges")
        .agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n"))
        .withColumn("rep", F.when(F.col("n") == 1, F.col("first")).otherwise(_node("same", "first")))
        .drop("first")
    )
    tied = skew.lookup_join(same, groups.where("n > 1"), ["h", "edges"], weight="n")
    return (
        lone.unionByName(groups.select(F.col("rep").alias("node"), "edges")),
        tied.select(F.col("node").alias("a"), F.col("rep").alias("b")),
    )


def proximity_links(
    shapes: DataFrame,
    eps: float,
    cell: float,
    node: str = "building_uid",
    max_group: int = MAX_GROUP,
) -> DataFrame:
    """Links (a, b) whose connected components are the building complexes.

    Some nodes stand for a set of identical footprints or for a covered cell; they start with
    a control character and are no buildings.
    """
    prepared, links = _without_copies(spread(shapes.select(F.col(node).alias("node"), "edges"), "node"))
    prepared = cut_lineage(prepared.withColumns(g.bbox(F.col("edges"))))

    size, uncut = cell, True
    members = _members(prepared, size, eps)
    while True:
        counts = members.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("_n"))
        crowded = cut_lineage(counts.where(F.col("_n") > max_group).select("cx", "cy"))
        if crowded.isEmpty():
            return links.unionByName(_pairs(members, members, size, eps, once=uncut))
        thin = members.join(crowded, ["cx", "cy"], "left_anti")
        links = links.unionByName(_pairs(thin, thin, size, eps, once=False))

        dense = members.join(crowded, ["cx", "cy"], "left_semi").where(
            _near_cell(size, eps / 2)
        )
        name = _node("cell", F.lit(repr(size)), "cx", "cy")
        reach = (eps - size * math.sqrt(2)) / 2  # reach + diagonal + reach = eps
        if reach < eps / 4:
            dense = cut_lineage(dense.withColumn("_covers", _covers_cell(size)))
            covered = cut_lineage(dense.where("_covers").select("cx", "cy").distinct())
            tied = dense.join(covered, ["cx", "cy"], "left_semi")
            rest = dense.join(covered, ["cx", "cy"], "left_anti").drop("_covers")
        else:
            dense = cut_lineage(dense.withColumn("_core", _near_cell(size, reach)))
            tied = dense.where("_core")
            rim = dense.where(~F.col("_core"))
            wide = rim.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_group)
            wide = cut_lineage(wide.select("cx", "cy"))
            few = rim if size < eps * 1e-6 else rim.join(wide, ["cx", "cy"], "left_anti")
            links = links.unionByName(_pairs(few, dense, size, eps, once=False))
            rest = dense.join(wide, ["cx", "cy"], "left_semi").drop("_core")
            if size < eps * 1e-6:
                rest = rest.limit(0)
        links = links.unionByName(tied.select(F.col("node").alias("a"), name.alias("b")))
        members = _cut(rest, size, eps)
        size, uncut = size / 4, False


def _cut(members: DataFrame, size: float, eps: float) -> DataFrame:
    """Members of a cell -> members of those of its 4 x 4 parts they reach by their box."""
    part = size / 4
    grown = eps / 2

    def overlap(c, lo, hi):
        start = F.floor((F.col(lo) - grown) / part - 1e-7)
        stop = F.floor((F.col(hi) + grown) / part + 1e-7)
        first, last = F.col(c) * 4, F.col(c) * 4 + 3
        return F.explode(F.filter(F.sequence(first, last), lambda i: (i >= start) & (i <= stop)))

    return (
        members.withColumn("_x", overlap("cx", "minx", "maxx"))
        .withColumn("_y", overlap("cy", "miny", "maxy"))
        .drop("cx", "cy")
        .withColumnsRenamed({"_x": "cx", "_y": "cy"})
    )
