"""Spatial joins as equi-joins on grid cells.

Every polygon is cut along a square grid. A cell row of a polygon holds the edges that pass
through the cell and ``base``: whether the middle of the cell's left side lies inside. A point
then needs only the row of its own cell: start from ``base``, walk to the point (first along
the middle line, then straight up or down), and flip once for every edge crossed on the way.
The cost per point is the number of edges in one cell, whatever the size of the polygon, and
cells wholly inside carry no edges at all.

Where polygons may have many edges, they are cut and matched in numpy (``functions.cells``): Spark
deals points and cell rows by cell and sorts them, tasks read them cell by cell. No cell row holds
more than ``CHUNK`` edges, and only cell rows are moved. Polygons of at most ``CHUNK`` edges among
their like are cut inside their own row and joined by column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kawara.functions import cells
from kawara.functions import geometry as g
from kawara.operators import skew
from kawara.session import ship_code

CHUNK = 64
_MARGIN = 1e-7  # in cells: an extra edge in a cell does no harm, a missing one would


def _cell(v: Column, size: float) -> Column:
    return F.floor(v / F.lit(size))


def _low(v: Column, size: float) -> Column:
    return F.floor(v / F.lit(size) - F.lit(_MARGIN))


def _high(v: Column, size: float) -> Column:
    return F.floor(v / F.lit(size) + F.lit(_MARGIN))


def _mid_sql(size: float) -> str:
    return f"((cy + 0.5D) * {g.num(size)})"


def _touches(axis: str, cell_no: str, size: float) -> str:
    """Does edge ``e`` reach a grid row or column (SQL text)?"""
    a, b = f"e.{axis}1", f"e.{axis}2"
    return (
        f"floor(least({a}, {b}) / {g.num(size)} - {g.num(_MARGIN)}) <= {cell_no}"
        f" AND floor(greatest({a}, {b}) / {g.num(size)} + {g.num(_MARGIN)}) >= {cell_no}"
    )


def _small_cells(polys: DataFrame, ids: list[str], size: float, edges: str) -> DataFrame:
    """Cell rows of polygons with few edges; narrow, no shuffle."""
    b = g.bbox(F.col(edges))
    rows = polys.where(F.size(edges) <= CHUNK).select(
        *ids,
        F.col(edges).alias("_edges"),
        _low(b["minx"], size).alias("_c0"),
        _high(b["maxx"], size).alias("_c1"),
        F.explode(F.sequence(_low(b["miny"], size), _high(b["maxy"], size))).alias("cy"),
    )
    mid = _mid_sql(size)
    rows = rows.select(
        *ids,
        "cy",
        F.expr(f"filter(_edges, e -> {_touches('y', 'cy', size)})").alias("_row"),
        F.expr(
            f"transform(filter(_edges, e -> {g.straddles_y('e', mid)}),"
            f" e -> floor({g.x_at('e', mid)} / {g.num(size)}))"
        ).alias("_cross"),
        F.explode(F.sequence("_c0", "_c1")).alias("cx"),
    )
    cells = rows.select(
        *ids,
        "cx",
        "cy",
        F.expr("size(filter(_cross, c -> c < cx)) % 2").alias("base"),
        F.expr(f"filter(_row, e -> {_touches('x', 'cx', size)})").alias("edges"),
    )
    return cells.where((F.col("base") == 1) | (F.size("edges") > 0))


_EDGES = T.ArrayType(T.StructType([T.StructField(c, T.DoubleType(), False) for c in cells.AXES]), False)

_CELL = T.StructType(
    [T.StructField(n, t, False) for n, t in [("cx", T.LongType()), ("_block", T.LongType()), ("base", T.IntegerType()), ("edges", _EDGES)]]
)


def _cut(polys: DataFrame, ids: list[str], size: float, edges: str, vertices: bool = False) -> DataFrame:
    """Cell rows (ids, _shape, cx, cy, _block, base, edges) of polygons of any size; no shuffle.

    ``_shape``, a hash of the edges, keeps polygons of equal ids apart; copies of a polygon give equal rows.
    Rows of block -1 hold no edges, but tell that the cell's left side lies inside; ``vertices`` adds
    rows of block -2, a vertex of each ring.
    """
    ids = [*ids, "_shape"]
    whole = polys.withColumn("_shape", F.xxhash64(edges)).select(*ids, F.col(edges).alias("_all"))
    # blocks of edges are rows: a batch of so many polygons could be of any size
    blocks = whole.select(
        *ids,
        F.expr(f"(size(_all) - 1) div {CHUNK} + 1").alias("_n"),
        F.expr(
            f"inline(transform(sequence(0L, (size(_all) - 1) div {CHUNK}),"
            f" b -> struct(b AS _b, slice(_all, cast(b * {CHUNK} + 1 AS int), {CHUNK}) AS _edges)))"
        ),
    ).where(F.size("_edges") > 0)
    made = T.StructType([T.StructField("cy", T.LongType(), False), T.StructField("_re", T.ArrayType(_CELL, False), False)])
    schema = T.StructType([*(blocks.schema[c] for c in ids), *made])
    rows = ship_code(blocks).mapInArrow(cells.cut(size, _MARGIN, CHUNK, ids, vertices), schema)
    return rows.select(*ids, "cy", F.posexplode("_re").alias("_i", "c")).select(*ids, "c.cx", "cy", "c._block", "c.base", "c.edges")


def _large_cells(polys: DataFrame, ids: list[str], size: float, edges: str) -> DataFrame:
    """Cell rows of polygons with many edges."""
    return _cut(polys.where(F.size(edges) > CHUNK), ids, size, edges)


def polygon_cells(
    polys: DataFrame, ids: list[str], cell: float, edges: str = "edges"
) -> DataFrame:
    """Grid rows (ids, _block, cx, cy, base, edges) of all polygons, small and large.

    ``_block`` tells the rows of one large polygon and cell apart; it is -2 for small polygons.
    """
    small = _small_cells(polys, ids, cell, edges).withColumn("_block", F.lit(-2).cast("bigint"))
    return small.unionByName(_large_cells(polys, ids, cell, edges).drop("_shape"))


#: Does the box of edge ``e`` meet that of a placed polygon? Others cannot meet it.
_BOXES_MEET = (
    "(least(e.x1, e.x2) <= _maxx AND greatest(e.x1, e.x2) >= _minx"
    " AND least(e.y1, e.y2) <= _maxy AND greatest(e.y1, e.y2) >= _miny)"
)
_NEAR = f"filter(_re, e -> {_BOXES_MEET})"


def _placed(small: DataFrame, ids: list[str], size: float, edges: str) -> DataFrame:
    """Small polygons whole (``_le``, with bounds) on all cells they reach: cutting costs more than it saves."""
    b = g.bbox(F.col(edges))
    rows = small.select(*ids, F.col(edges).alias("_le"), *[c.alias(f"_{n}") for n, c in b.items()])
    return rows.withColumn(
        "cx", F.explode(F.sequence(_low(F.col("_minx"), size), _high(F.col("_maxx"), size)))
    ).withColumn("cy", F.explode(F.sequence(_low(F.col("_miny"), size), _high(F.col("_maxy"), size))))


def _flip(size: float) -> str:
    """Is edge ``e`` crossed on the way from the cell's left side to the point (_px, _py)? SQL text."""
    mid = _mid_sql(size)
    at_mid, at_point = g.right_of("e", "_px", mid), g.right_of("e", "_px", "_py")
    along = (
        f"({g.straddles_y('e', mid)} AND floor({g.x_at('e', mid)} / {g.num(size)}) = cx"
        f" AND ({at_mid} = (e.y2 > e.y1)))"
    )
    up_or_down = f"({g.straddles_x('e', '_px')} AND ({at_mid} != {at_point}))"
    return f"({along} != {up_or_down})"


def _flips(size: float) -> Column:
    """How many of the ``edges`` are crossed."""
    return F.expr(f"size(filter(edges, e -> {_flip(size)}))")


def point_crowd(points: DataFrame, x: Column, y: Column, cell: float) -> tuple[DataFrame | None, int]:
    """The crowded cells of points and how many tasks their rows need (``skew.crowding``)."""
    return skew.crowding(points.select(_cell(x, cell).alias("cx"), _cell(y, cell).alias("cy")), ["cx", "cy"])


def polygon_crowd(polys: DataFrame, cell: float, edges: str = "edges") -> tuple[DataFrame | None, int]:
    """The same for polygons: a crowded cell shows in the first vertices already, which are cheap to count."""
    first = F.get(F.col(edges), F.lit(0))
    return point_crowd(polys, first["x1"], first["y1"], cell)


def points_in_polygons(
    points: DataFrame,
    polys: DataFrame,
    *,
    cell: float,
    point_cols: list[str],
    poly_cols: list[str],
    poly_id: str = "poly_id",
    x: str = "px",
    y: str = "py",
    edges: str = "edges",
    large: bool = True,
    share: float = skew.HOT_SHARE,
    floor: int = skew.HOT_FLOOR,
    crowd: tuple[DataFrame | None, int] | None = None,
) -> DataFrame:
    """(point_cols, poly_cols) for every point strictly inside a polygon.

    ``large=False`` states that no polygon has more than ``CHUNK`` edges; it is checked while
    running. Hot cells are salted, so one crowded cell does not become one task; a caller that
    knows them already hands them in, with the number of tasks (``skew.crowding``).

    Ids need not be unique: polygons of one id count as separate polygons. Of exact copies of a
    polygon one counts, whatever its size.
    """
    ids = list(dict.fromkeys([poly_id, *poly_cols]))
    pts = points.select(
        *point_cols,
        F.col(x).alias("_px"),
        F.col(y).alias("_py"),
        _cell(F.col(x), cell).alias("cx"),
        _cell(F.col(y), cell).alias("cy"),
    )
    hot, pieces = crowd or skew.crowding(pts, ["cx", "cy"], share, floor)
    if large:
        return _met(pts, polys, ids, cell, point_cols, poly_cols, edges, hot, pieces)

    own = [*point_cols, "_px", "_py"]
    flips = _flips(cell)
    inside = (F.col("base") + flips) % 2 == 1
    on_edge = F.expr(f"exists(edges, e -> {g.on_segment('e', '_px', '_py')})")
    es = F.col(edges)
    polys = polys.withColumn(
        edges,
        F.when(F.size(es) > CHUNK, F.raise_error(F.lit("polygon too large for large=False"))).otherwise(es),
    ).where(F.size(edges) > 0)
    cores = polys.sparkSession.sparkContext.defaultParallelism
    shaped = polys.select(*ids, edges, F.xxhash64(edges).alias("_shape"))
    once = shaped.repartition(max(pieces, cores), *ids, "_shape").dropDuplicates([*ids, "_shape"])
    m, f, keys = skew.salted(pts, _small_cells(once, ids, cell, edges), ["cx", "cy"], own, hot)
    return skew.shuffled_join(m, f, keys, pieces).where(inside & ~on_edge).select(*point_cols, *poly_cols)


def _met(
    lefts: DataFrame,
    polys: DataFrame,
    ids: list[str],
    cell: float,
    left_cols: list[str],
    poly_cols: list[str],
    edges: str,
    hot: DataFrame | None,
    pieces: int,
) -> DataFrame:
    """(left_cols, poly_cols) of points (_px, _py) and small polygons (_le) on cells, and the polygons they meet.

    Points and cell rows are dealt and sorted by cell once, and read cell by cell: there is no row per pair.
    """
    shapes = "_le" in lefts.columns
    side = F.when(F.col("_block") == -2, cells.VERTEX).otherwise(cells.PIECE)
    rows = _cut(polys, ids, cell, edges, vertices=shapes)
    own = [*left_cols, "_px", "_py"]
    m, f, keys = skew.salted(lefts.where("cx IS NOT NULL AND cy IS NOT NULL"), rows, ["cx", "cy"], own, hot)
    place = F.array(g.edge(F.col("_px"), F.col("_py"), F.col("_px"), F.col("_py")))  # an edge without length
    kind = F.when(F.col("_le").isNull(), cells.POINT).otherwise(cells.SHAPE) if shapes else F.lit(cells.POINT)
    held = F.coalesce("_le", place) if shapes else place
    m = m.select(*keys, kind.alias("_side"), F.struct(*left_cols).alias("_l"), held.alias("_es"))
    known = F.xxhash64(*[c for i in [*ids, "_shape"] for c in (F.col(i), F.isnull(i))])
    f = f.select(*keys, side.alias("_side"), known.alias("_pk"), "_block", "base", F.struct(*poly_cols).alias("_r"), F.col("edges").alias("_es"))
    # null lists would take time that grows with the square of an Arrow batch; there are none
    both = m.unionByName(f, allowMissingColumns=True).fillna(0, ["_pk", "_block", "base"])
    parts = [pieces] if pieces > both.sparkSession.sparkContext.defaultParallelism else []  # else Spark's own number
    both = both.repartition(*parts, *keys).sortWithinPartitions(*keys, "_side", "_pk", "_block")
    schema = T.StructType([both.schema["_l"], both.schema["_r"]])
    return ship_code(both).mapInArrow(cells.meet(cell, keys), schema).select("_l.*", "_r.*")


def _ring_points(df: DataFrame, ids: list[str], edges: str) -> DataFrame:
    """A vertex (px, py) of each ring."""
    return df.select(*ids, F.expr(f"explode({g.ring_starts(edges)})").alias("v")).select(
        *ids, F.col("v.x").alias("px"), F.col("v.y").alias("py")
    )


def _small_pairs(
    left: DataFrame,
    right: DataFrame,
    cell: float,
    lids: list[str],
    rids: list[str],
    left_edges: str,
    right_edges: str,
    crowd: tuple[DataFrame | None, int],
) -> DataFrame:
    """(lids, rids) of polygons that meet, none of more than ``CHUNK`` edges."""
    hot, pieces = crowd
    left_in_right = points_in_polygons(
        _ring_points(left, lids, left_edges), right, cell=cell, point_cols=lids, poly_cols=rids,
        poly_id=rids[0], edges=right_edges, large=False, crowd=crowd,
    )
    # what a left polygon can meet in a cell: pieces of right polygons, and right vertices
    none = F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>")
    pieces_met = (
        _small_cells(right, rids, cell, right_edges)
        .where(F.size("edges") > 0)
        .select(*rids, "cx", "cy", F.col("edges").alias("_re"))
    )
    vertices_met = _ring_points(right, rids, right_edges).select(
        *rids, _cell(F.col("px"), cell).alias("cx"), _cell(F.col("py"), cell).alias("cy"), none.alias("_re"),
        F.col("px").alias("_vx"), F.col("py").alias("_vy"),
    )
    met = pieces_met.unionByName(vertices_met, allowMissingColumns=True)
    m, f, keys = skew.salted(_placed(left, lids, cell, left_edges), met, ["cx", "cy"], lids, hot)
    touching = f"exists({_NEAR}, b -> exists(_le, a -> {g.segments_touch('a', 'b')}))"
    holding = (
        "(_vx BETWEEN _minx AND _maxx AND _vy BETWEEN _miny AND _maxy"
        f" AND {g.inside_parity('_le', '_vx', '_vy')})"
    )
    touched = skew.shuffled_join(m, f, keys, pieces).where(F.expr(f"coalesce({holding}, false) OR {touching}"))
    return left_in_right.unionByName(touched.select(*lids, *rids))


def intersecting_pairs(
    left: DataFrame,
    right: DataFrame,
    *,
    cell: float,
    left_cols: list[str],
    right_cols: list[str],
    left_id: str,
    right_id: str,
    left_edges: str = "edges",
    right_edges: str = "edges",
    large: bool = True,
    crowd: tuple[DataFrame | None, int] | None = None,
    distinct: bool = True,
) -> DataFrame:
    """Distinct (left_cols, right_cols) of polygons that share at least a boundary point.

    Two polygons intersect when a vertex of one lies in the other, or their edges touch. A caller that
    has the ``polygon_crowd`` of the left already hands it in; one that doesn't mind a pair that comes
    once per cell saves a shuffle with ``distinct=False``.
    """
    lids = list(dict.fromkeys([left_id, *left_cols]))
    rids = list(dict.fromkeys([right_id, *right_cols]))
    out = [*left_cols, *right_cols]
    hot, pieces = crowd = crowd or polygon_crowd(left, cell, left_edges)
    if not large:
        found = _small_pairs(left, right, cell, lids, rids, left_edges, right_edges, crowd).select(*out)
        return found.distinct() if distinct else found

    # small left polygons are held whole against all on their cells, with their vertices
    lefts = _placed(left.where(F.size(left_edges) <= CHUNK), lids, cell, left_edges).select(
        *lids, "cx", "cy", "_le", *[F.lit(None).cast("double").alias(c) for c in ("_px", "_py")]
    )
    some_big = (left.agg(F.max(F.size(left_edges))).first()[0] or 0) > CHUNK
    big = left.where(F.size(left_edges) > CHUNK)
    if some_big:
        points = _ring_points(big, lids, left_edges).select(
            *lids, _cell(F.col("px"), cell).alias("cx"), _cell(F.col("py"), cell).alias("cy"),
            F.col("px").alias("_px"), F.col("py").alias("_py"),
        )
        lefts = lefts.unionByName(points, allowMissingColumns=True)
    found = _met(lefts, right, rids, cell, left_cols, right_cols, right_edges, hot, pieces)
    if some_big:
        right_in_big = points_in_polygons(
            _ring_points(right, rids, right_edges), big, cell=cell, point_cols=rids, poly_cols=lids,
            poly_id=left_id, edges=left_edges,
        ).select(*out)
        cut = _large_cells(big, lids, cell, left_edges).where(F.size("edges") > 0)
        m, f, keys = skew.salted(
            cut.select(*lids, "cx", "cy", F.col("edges").alias("_le")),
            polygon_cells(right, rids, cell, right_edges).where(F.size("edges") > 0).select(*rids, "cx", "cy", F.col("edges").alias("_re")),
            ["cx", "cy"],
            lids,
            hot,
        )
        crossing = (
            skew.shuffled_join(m, f, keys, pieces)
            .where(F.expr(f"exists(_le, a -> exists(_re, b -> {g.segments_touch('a', 'b')}))"))
            .select(*out)
        )
        found = found.unionByName(right_in_big).unionByName(crossing)
    return found.distinct() if distinct or some_big else found
