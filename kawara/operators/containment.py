"""How much of one polygon set another one contains, by exact area.

Polygons are cut along a grid first (``spatial.polygon_cells``), so every area is a sum over
cells and all work is local to a cell. A cell wholly inside a polygon of a set is settled for
that set; edges of the set's other polygons in it are dropped. In the remaining cells the
plane is cut into horizontal slabs at every vertex, every crossing, and where an edge meets
the cell's left or right side. Inside a slab no two edges meet, so each region between
neighbouring edges is a trapezoid: width on the slab's middle line times its height.

The work in a cell grows with the square of its edges, so a cell of more than ``CROWDED`` of them is
cut into 4 x 4 smaller ones, again and again: a sub-cell's edges and its base follow from the row of
its cell alone. Cells of several sizes stand side by side, told apart by ``sz``. Where ``DEEPEST``
cuts do not thin the edges out, they lie on one spot and the cell stays as it is. The work is then
linear in the edges of an outline; edges far longer than their spacing still cross each other's cells.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kawara.functions import geometry as g
from kawara.operators import spatial
from kawara.session import cut_lineage

_TAG = ["role", "pid"]
CROWDED = 64
DEEPEST = 6
_MARGIN = g.num(1e-7)


def _enters(e: str = "") -> str:
    """Does an edge cross the line of the cell's left side?"""
    return f"((floor({e}x1 / sz) >= cx) != (floor({e}x2 / sz) >= cx))"


def _above(line: str, e: str = "") -> str:
    """Does an edge that crosses the left side do so above a horizontal line?

    Where it crosses the line too, the cell of that crossing decides, as it does for every count
    along the line: an edge through the corner itself must not be left of it in one and right in the other.
    """
    x = f"({e}x1 + ({line} - {e}y1) * ({e}x2 - {e}x1) / ({e}y2 - {e}y1))"
    y = f"({e}y1 + (cx * sz - {e}x1) * ({e}y2 - {e}y1) / ({e}x2 - {e}x1))"
    return (
        f"(CASE WHEN ({e}y1 > {line}) != ({e}y2 > {line})"
        f" THEN (floor({x} / sz) < cx) = (({e}y2 > {e}y1) = ({e}x2 > {e}x1)) ELSE {y} > {line} END)"
    )


def _settled(rows: DataFrame, at: list[str]) -> DataFrame:
    """``rows`` where a cell wholly inside one polygon of a role is one row of that role, without edges."""
    state = rows.groupBy(*at, *_TAG).agg(
        F.sum("base").alias("base"), F.sum(F.size("edges")).alias("n_edges")
    )
    full = state.where("base % 2 = 1 AND n_edges = 0").select(*at, "role").distinct()
    whole = full.select(
        *at, "role", F.lit("*").alias("pid"), F.lit(1).alias("base"),
        F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>").alias("edges"),
    )
    return rows.join(full, [*at, "role"], "left_anti").select(whole.columns).unionByName(whole)


def _quartered(rows: DataFrame, at: list[str]) -> DataFrame:
    """Each cell as 4 x 4 cells; every row by itself."""
    keep = [c for c in at if c not in ("sz", "cx", "cy")] + _TAG
    sub, mid = "(sz / 4D)", "((cy + 0.5D) * sz)"
    line = "((cy * 4 + j + 0.5D) * sz / 4D)"

    def reaches(axis: str, place: str) -> str:
        a, b = f"e.{axis}1", f"e.{axis}2"
        return (
            f"floor(least({a}, {b}) / {sub} - {_MARGIN}) <= {place}"
            f" AND floor(greatest({a}, {b}) / {sub} + {_MARGIN}) >= {place}"
        )

    # down or up the left side to the row's middle line, then along it: every edge on the way turns the side
    walked = f"size(filter(edges, e -> CASE WHEN {_enters('e.')} THEN {_above(mid, 'e.')} != {_above(line, 'e.')} ELSE false END))"
    crossed = f"transform(filter(edges, e -> {g.straddles_y('e', line)}), e -> floor({g.x_at('e', line)} / {sub}))"
    bands = rows.withColumn("j", F.explode(F.expr("sequence(0L, 3L)"))).select(
        *keep, "sz", "cx", "cy", "j", F.expr(f"base + {walked}").alias("turns"),
        F.expr(crossed).alias("crossed"), F.expr(f"filter(edges, e -> {reaches('y', 'cy * 4 + j')})").alias("edges"),
    )
    cells = bands.withColumn("i", F.explode(F.expr("sequence(0L, 3L)"))).select(
        *keep, F.expr(sub).alias("sz"), F.expr("cx * 4 + i").alias("cx"), F.expr("cy * 4 + j").alias("cy"),
        F.expr("cast((turns + size(filter(crossed, c -> c >= cx * 4 AND c < cx * 4 + i))) % 2 AS int)").alias("base"),
        F.expr(f"filter(edges, e -> {reaches('x', 'cx * 4 + i')})").alias("edges"),
    )
    return cells.where("base = 1 OR size(edges) > 0")


def _local_edges(polys: DataFrame, key: str, cell: float) -> tuple[DataFrame, DataFrame]:
    """(bases, edges) of every polygon and cell, settled cells reduced to one base row."""
    at = [key, "sz", "cx", "cy"]
    rows = spatial.polygon_cells(polys, [key, *_TAG], cell).withColumn("sz", F.lit(float(cell)))
    # copies of a polygon would cancel each other out
    rows = cut_lineage(rows.dropDuplicates([*at, *_TAG, "_block"]).drop("_block"))
    done = []
    for depth in range(DEEPEST + 1):
        rows = cut_lineage(_settled(rows, at))  # used many times below: computed once
        crowded = rows.groupBy(*at).agg(F.sum(F.size("edges")).alias("n")).where(F.col("n") > CROWDED).drop("n")
        crowded = cut_lineage(crowded)
        if depth == DEEPEST or crowded.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(crowded, at, "left_anti"))
        rows = _quartered(rows.join(crowded, at), at)
    rows = reduce(DataFrame.unionByName, done)
    bases = rows.where("base = 1").select(*at, *_TAG)
    edges = rows.select(*at, *_TAG, F.explode("edges").alias("e")).select(*at, *_TAG, "e.*")
    return bases, edges


def containment_ratio(
    extents: DataFrame,
    hazards: DataFrame,
    *,
    key: str = "dataset_id",
    cell: float,
    poly_id: str = "poly_id",
) -> DataFrame:
    """(key, hazard_area, contained_area, ratio) per dataset.

    Both areas are of unions: overlapping polygons count once. A dataset without hazard area
    gets no row. Ids need not be unique: polygons of one id count as separate polygons.
    """

    def tagged(df, role):
        return df.select(
            key,
            F.lit(role).alias("role"),
            F.concat_ws(":", F.col(poly_id).cast("string"), F.xxhash64("edges")).alias("pid"),
            "edges",
        )

    wanted = tagged(hazards, "hazard")
    offered = tagged(extents, "extent").join(wanted.select(key).distinct(), key, "left_semi")
    bases, edges = _local_edges(wanted.unionByName(offered), key, cell)
    at = [key, "sz", "cx", "cy"]

    size = "sz"
    left, right = f"(cx * {size})", f"((cx + 1) * {size})"
    bottom, top = f"(cy * {size})", f"((cy + 1) * {size})"
    mid = f"((cy + 0.5D) * {size})"

    def y_at(x):
        return f"(y1 + ({x} - x1) * (y2 - y1) / (x2 - x1))"

    # slab borders of a cell
    ends = edges.select(
        *at,
        F.explode(
            F.expr(
                "array_compact(array(y1, y2,"
                f" CASE WHEN (x1 >= {left}) != (x2 >= {left}) THEN {y_at(left)} END,"
                f" CASE WHEN (x1 >= {right}) != (x2 >= {right}) THEN {y_at(right)} END))"
            )
        ).alias("y"),
    )
    a = edges.select(*at, F.struct("x1", "y1", "x2", "y2").alias("a"))
    b = edges.select(*at, F.struct("x1", "y1", "x2", "y2").alias("b"))
    turn = "((a.x2 - a.x1) * (b.y2 - b.y1) - (a.y2 - a.y1) * (b.x2 - b.x1))"
    t = f"(((b.x1 - a.x1) * (b.y2 - b.y1) - (b.y1 - a.y1) * (b.x2 - b.x1)) / {turn})"
    crossings = (
        a.join(b, at)
        .where(F.expr(f"a < b AND {turn} != 0D AND {g.segments_touch('a', 'b')}"))
        .select(*at, F.expr(f"a.y1 + {t} * (a.y2 - a.y1)").alias("y"))
    )
    sides = (
        bases.select(*at)
        .unionByName(edges.select(*at))
        .distinct()
        .select(*at, F.explode(F.expr(f"array({bottom}, {top})")).alias("y"))
    )
    w = Window.partitionBy(*at).orderBy("y")
    slabs = (
        ends.unionByName(crossings)
        .where(F.expr(f"y > {bottom} AND y < {top}"))
        .unionByName(sides)
        .distinct()
        .select(*at, F.col("y").alias("lo"), F.lead("y").over(w).alias("hi"))
        .where("hi > lo")
    )
    slabs = cut_lineage(slabs)

    # where edges cut a slab's middle line, and on which side each polygon starts at the left
    line = "((lo + hi) / 2D)"
    # an edge matters to the slabs it passes, and to all where it enters at the left side
    passes = F.expr(f"(hi > least(y1, y2) AND lo < greatest(y1, y2)) OR {_enters()}")
    met = edges.join(slabs, at).where(passes).withColumn(
        "x", F.expr(f"CASE WHEN (y1 > {line}) != (y2 > {line}) THEN x1 + ({line} - y1) * (x2 - x1) / (y2 - y1) END")
    )
    slab = [*at, "lo", "hi"]
    flips = met.where(
        F.expr(f"CASE WHEN {_enters()} THEN {_above(mid)} != {_above(line)} ELSE false END")
    ).select(*slab, *_TAG)
    starts = (
        flips.unionByName(bases.join(slabs, at).select(*slab, *_TAG))
        .groupBy(*slab, *_TAG)
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n % 2 = 1")
        .select(*slab, *_TAG, F.expr(left).alias("x"))
    )
    cuts = met.where(F.expr(f"floor(x / {size}) = cx")).select(*slab, *_TAG, "x")
    own = Window.partitionBy(*slab, *_TAG).orderBy("x")
    closing = slabs.select(
        *slab, F.lit("end").alias("role"), F.lit("").alias("pid"), F.expr(right).alias("x")
    )
    steps = (
        starts.unionByName(cuts)
        .withColumn("d", F.when(F.row_number().over(own) % 2 == 1, 1).otherwise(-1))
        .unionByName(closing.withColumn("d", F.lit(0)))
    )
    sweep = Window.partitionBy(*slab).orderBy("x", "d")
    upto = sweep.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    area = F.col("dx") * (F.col("hi") - F.col("lo"))
    return (
        steps.select(
            *slab,
            F.sum(F.when(F.col("role") == "hazard", F.col("d")).otherwise(0)).over(upto).alias("nh"),
            F.sum(F.when(F.col("role") == "extent", F.col("d")).otherwise(0)).over(upto).alias("ne"),
            (F.lead("x").over(sweep) - F.col("x")).alias("dx"),
        )
        .where("nh > 0")
        .groupBy(key)
        .agg(
            F.sum(area).alias("hazard_area"),
            F.coalesce(F.sum(F.when(F.col("ne") > 0, area)), F.lit(0.0)).alias("contained_area"),
        )
        .where("hazard_area > 0")
        .withColumn("ratio", F.col("contained_area") / F.col("hazard_area"))
    )


def union_area(polys: DataFrame, *, key: str, cell: float, poly_id: str = "poly_id") -> DataFrame:
    """(key, area) of the union of each group of polygons."""
    return containment_ratio(polys.limit(0), polys, key=key, cell=cell, poly_id=poly_id).select(
        key, F.col("hazard_area").alias("area")
    )
