"""Domain tables derived from the given ones, by SQL that Spark and DuckDB both understand.

The plane is laid out in frames of 100 x 100 units, 128 apart. 15,000 orders, 100 suppliers and
2,000 parts share a frame, so density stays the same at any scale factor: more data means more
frames, not more crowded ones. Coordinates are global; no join may rely on the frame.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kawara import model
from kawara.functions import geometry as g
from kawara.operators import tiles
from kawara.session import cut_lineage

_LAYERS: dict[tuple[str, str, str], DataFrame] = {}

D = "CAST({} AS DOUBLE)".format


def _frame(key: str, per_frame: int) -> str:
    return f"CAST(FLOOR({key} / {D(per_frame)}) AS BIGINT)"


FX = f"({D('frame % 1024')} * {D(128)})"
FY = f"(FLOOR(frame / {D(1024)}) * {D(128)})"


def _scatter(a: int, b: int, mod: int) -> str:
    """Quadratic in the key: a linear term alone would give a lattice."""
    return f"({D(f'(m * m * {a} + m * {b}) % {mod}')} / {D(100)})"


def _pick(index: str, values) -> str:
    """CASE that picks text by a number."""
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index} {whens} END"


KIND_OF = _pick("kind_no", model.HAZARD_KINDS)
RANK_LABELS = list(model.RANK_LABEL_DEPTH)
USAGE_NAMES = [*model.USAGE_LABELS, "未知"]
STRUCTURE_NAMES = [*model.STRUCTURE_LABELS, "未知"]

BUILDINGS = f"""
SELECT k, frame, 'b' || CAST(k AS STRING) AS gml_id,
       '13113/2023/f' || CAST(frame AS STRING) || '/b' || CAST(k AS STRING) AS building_uid,
       x0, y0, x0 + {D(0.1)} AS x1, y0 + {D(0.1)} AS y1,
       o_custkey, o_orderdate, o_totalprice, o_orderstatus
FROM (SELECT *, {FX} + {_scatter(31, 7919, 10007)} AS x0, {FY} + {_scatter(17, 6007, 9973)} AS y0
      FROM (SELECT o_orderkey AS k, {_frame('o_orderkey', 15000)} AS frame,
                   o_orderkey % 1000003 AS m,
                   o_custkey, o_orderdate, o_totalprice, o_orderstatus
            FROM orders) a) b
"""

ATTRIBUTES = f"""
SELECT k, frame, gml_id, building_uid, x0, y0, x1, y1, city_code, 2023 AS dataset_year,
       CASE WHEN k % 11 = 0 THEN NULL WHEN k % 29 = 0 THEN 'n/a'
            ELSE CAST(YEAR(o_orderdate) - o_custkey % 60 AS STRING) END AS yearOfConstruction,
       CASE WHEN k % 13 = 0 THEN {D(-9999)} ELSE o_totalprice / {D(5000)} END AS measuredHeight,
       CASE WHEN k % 17 = 0 THEN 9999 ELSE k % 40 END AS storeysAboveGround,
       CASE WHEN k % 9 = 0 THEN NULL ELSE k % 4 END AS storeysBelowGround,
       usage_label, structure_label,
       CASE o_custkey % 8 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN usage_label
            WHEN 3 THEN '["","' || usage_label || '"]' WHEN 4 THEN 'no label' WHEN 5 THEN '[]'
            WHEN 6 THEN '{{"a":1}}' ELSE '["' || usage_label || '"]' END AS usage,
       CASE k % 6 WHEN 0 THEN NULL WHEN 1 THEN '[]'
            WHEN 2 THEN '[{{"buildingStructureType":"","fireproofStructureType":"準耐火"}},{{"buildingStructureType":"' || structure_label || '"}}]'
            WHEN 3 THEN '{{"buildingStructureType":"' || structure_label || '","fireproofStructureType":"耐火"}}'
            WHEN 4 THEN '[{{"fireproofStructureType":5}}]'
            ELSE '[{{"buildingStructureType":"' || structure_label || '"}}]' END AS buildingDetailAttribute
FROM (SELECT *, {_pick('(o_custkey * 7 + k) % 22', USAGE_NAMES)} AS usage_label,
             CASE WHEN o_orderstatus = 'P' THEN '' ELSE {_pick('(k * 5) % 14', STRUCTURE_NAMES)} END AS structure_label,
             CASE o_orderstatus WHEN 'F' THEN '01100' WHEN 'O' THEN '13113' ELSE '27100' END AS city_code
      FROM ({BUILDINGS}) c) d
"""

# three shapes in units of the half width: L, triangle, box with a hole
SHAPE_VERTICES = {
    0: [[(-1, -1), (1, -1), (1, -0.25), (0, -0.25), (0, 1), (-1, 1)]],
    1: [[(-1, -1), (1, -1), (0.25, 1)]],
    2: [[(-1, -1), (1, -1), (1, 1), (-1, 1)], [(-0.5, -0.5), (-0.5, 0.5), (0.5, 0.5), (0.5, -0.5)]],
}
SHAPE_EDGES = {
    s: [(a, b) for r in rings for a, b in zip(r, r[1:] + r[:1])] for s, rings in SHAPE_VERTICES.items()
}

HAZARDS = f"""
SELECT s_suppkey AS poly_id, frame, {KIND_OF} AS kind,
       'src-' || CAST(s_suppkey AS STRING) AS source_id, s_suppkey % 3 AS shape,
       {FX} + {_scatter(37, 7919, 9001)} + {D(5.003)} AS cx,
       {FY} + {_scatter(23, 6007, 9001)} + {D(5.003)} AS cy,
       {D('8 + s_suppkey % 7')} AS w, variant, n,
       CASE variant
         WHEN 0 THEN '[{{"rank":"' || label || '","adminType":"1"}}]'
         WHEN 1 THEN '[{{"rank":"' || label || '"}},{{"rank":"' || next_label || '"}}]'
         WHEN 2 THEN '{{"rank":' || CAST(n % 7 AS STRING) || '}}'
         ELSE CASE n % 3 WHEN 0 THEN 'not json' WHEN 1 THEN '[]' ELSE label END END AS floodingRiskAttribute
FROM (SELECT s_suppkey, {_frame('s_suppkey', 100)} AS frame, s_suppkey % 1000003 AS m,
             s_suppkey % 5 AS kind_no, s_suppkey % 4 AS variant, s_nationkey AS n,
             {_pick('s_nationkey % 6', RANK_LABELS)} AS label,
             {_pick('(s_nationkey + 1) % 6', RANK_LABELS)} AS next_label
      FROM supplier) a
"""

EXTENTS = f"""
SELECT poly_id, frame, kind, confidence,
       source || CASE WHEN confidence = 'inundation_bounded' THEN '+inundation_bounded' ELSE '' END AS source_id,
       cx - w AS x0, cy - w AS y0, cx + w AS x1, cy + w AS y1
FROM (SELECT s_suppkey AS poly_id, frame, {KIND_OF} AS kind, 'src-' || CAST(s_suppkey AS STRING) AS source,
             {_pick('s_nationkey % 3', model.CONFIDENCE_ORDER[1:])} AS confidence,
             {FX} + {_scatter(41, 6007, 9001)} + {D(5.003)} AS cx,
             {FY} + {_scatter(29, 7919, 9001)} + {D(5.003)} AS cy, {D('6 + s_suppkey % 5')} AS w
      FROM (SELECT s_suppkey, s_nationkey, {_frame('s_suppkey', 100)} AS frame,
                   s_suppkey % 1000003 AS m, (s_suppkey + 2) % 5 AS kind_no FROM supplier) a) b
"""

# rings of some 600 vertices a supplier, one per line item, and the same ring again, smaller, as a hole
_VERTEX = f"""
SELECT h.poly_id, h.frame, v.i, h.cx, h.cy, h.w * v.r AS reach, {D(6.283185307179586)} * v.i / v.n AS turn
FROM ({HAZARDS}) h JOIN (
  SELECT l_suppkey, ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_quantity) - 1 AS i,
         COUNT(*) OVER (PARTITION BY l_suppkey) AS n, {D(0.6)} + l_quantity / {D(125)} AS r
  FROM lineitem) v ON h.poly_id = v.l_suppkey
"""
_NEXT = "COALESCE(LEAD({0}) OVER (PARTITION BY poly_id, ring ORDER BY i), FIRST_VALUE({0}) OVER (PARTITION BY poly_id, ring ORDER BY i))"
MEGA_EDGES = f"""
SELECT poly_id, frame, ring, i, x AS x1, y AS y1, {_NEXT.format('x')} AS x2, {_NEXT.format('y')} AS y2
FROM (SELECT poly_id, frame, 0 AS ring, i, cx + reach * COS(turn) AS x, cy + reach * SIN(turn) AS y FROM ({_VERTEX}) a
      UNION ALL
      SELECT poly_id, frame, 1, i, cx + {D(0.3)} * reach * COS(turn), cy + {D(0.3)} * reach * SIN(turn) FROM ({_VERTEX}) b) c
"""

WARDS = f"""
SELECT ward_seq, frame, LPAD(CAST(ward_seq AS STRING), 9, '0') AS ward_code,
       LPAD(CAST(frame * 5 + CAST(FLOOR(c / {D(2)}) AS BIGINT) AS STRING), 8, '0') AS city_code,
       {FX} + {D('c')} * 10 + {D(0.003)} AS x0, {FY} + r * 10 + {D(0.003)} AS y0,
       {FX} + {D('c')} * 10 + {D(10.003)} AS x1, {FY} + r * 10 + {D(10.003)} AS y1
FROM (SELECT s_suppkey AS ward_seq, {_frame('s_suppkey', 100)} AS frame, s_suppkey % 10 AS c,
             FLOOR((s_suppkey % 100) / {D(10)}) AS r FROM supplier) a
"""

CITIES = f"""
SELECT city_code, MIN(frame) AS frame, MIN(x0) AS x0, MIN(y0) AS y0, MAX(x1) AS x1, MAX(y1) AS y1
FROM ({WARDS}) w GROUP BY city_code
"""

ZONING = f"""
SELECT zone_seq, frame, zoning_use, far_max,
       {FX} + {D('c')} * {D(2.5)} + {D(0.003)} AS x0, {FY} + r * {D(2)} + {D(0.003)} AS y0,
       {FX} + {D('c')} * {D(2.5)} + {D(2.803)} AS x1, {FY} + r * {D(2)} + {D(2.303)} AS y1
FROM (SELECT p_partkey AS zone_seq, {_frame('p_partkey', 2000)} AS frame, p_partkey % 40 AS c,
             FLOOR((p_partkey % 2000) / {D(40)}) AS r, p_type AS zoning_use,
             CAST(p_size * 10 AS FLOAT) AS far_max FROM part) a
"""

TILE_URI = (
    "CAST(15 + l_linenumber % 4 AS STRING) || '/' || CAST("
    + _frame("l_orderkey", 15000)
    + " AS STRING) || '/' || CAST(l_orderkey % 50 AS STRING) || '_' || CAST(l_orderkey % 30 AS STRING) || '.glb'"
)

FEATURES = f"SELECT DISTINCT {TILE_URI} AS uri, l_orderkey, l_linenumber FROM lineitem"

# numbering inside a tile; a tile belongs to one frame, so its size is bounded
VERTICES = f"""
SELECT uri, {D('DENSE_RANK() OVER (PARTITION BY uri ORDER BY l_orderkey, l_linenumber) - 1')} + {D(0.0001)} AS feature_id,
       l_quantity AS y
FROM (SELECT {TILE_URI} AS uri, l_orderkey, l_linenumber, l_quantity FROM lineitem) a
"""

CONTENTS = f"""
SELECT DISTINCT {TILE_URI} AS uri FROM lineitem
UNION ALL SELECT '14/' || CAST(s_suppkey AS STRING) || '/empty tile.glb' AS uri FROM supplier
"""


def _year_table(source: str, shift: int) -> str:
    """Hazard columns of one year: text so that both engines share it."""
    cols = []
    for i, k in enumerate(model.HAZARD_KINDS):
        covered = f"((k + {i + shift}) % 4 <> 0)"
        hit = f"({covered} AND (k * 7 + {i}) % 5 < 3 + {shift} * (k % 2))"
        cols.append(f"{covered} AS {k}_covered")
        if k == model.ZONE_KIND:
            cols.append(f"{hit} AS {k}_in_zone")
        else:
            depth = f"CAST((k + {i}) % 4 + {shift} * (k % 3 - 1) AS FLOAT)"
            cols.append(f"CASE WHEN {hit} THEN {depth} END AS {k}_depth_max")
    return (
        f"SELECT '13113/{2023 + shift}/f/b' || CAST(id AS STRING) AS building_uid,"
        f" 'b' || CAST(id AS STRING) AS gml_id, {2023 + shift} AS dataset_year, {', '.join(cols)} FROM ({source}) s"
    )


YEAR_A = _year_table("SELECT o_orderkey AS k, o_orderkey AS id FROM orders", 0)
YEAR_B = _year_table(
    "SELECT o_orderkey AS k, o_orderkey AS id FROM orders WHERE o_orderkey % 19 <> 0"
    " UNION ALL SELECT o_orderkey AS k, o_orderkey + 1000000000000 AS id FROM orders WHERE o_orderkey % 23 = 0",
    1,
)


class Inputs:
    """The derived tables as DataFrames over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, text: str, *tables: str) -> DataFrame:
        """A derivation with its base tables read straight from their files."""
        for t in tables:
            text = re.sub(rf"\bFROM {t}\b", f"FROM parquet.`{self.sf_dir}/{t}.parquet`", text)
        return self.spark.sql(text)

    @staticmethod
    def boxed(df: DataFrame) -> DataFrame:
        """Box columns -> parts and edges."""
        es = g.box_edges(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
        return df.withColumn("edges", es).withColumn("parts", F.array(F.array("edges")))

    def located(self) -> DataFrame:
        """Buildings with their representative point; boxes need no edges for it."""
        p = g.box_point(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
        return self.sql(BUILDINGS, "orders").select(
            "k", "gml_id", "building_uid", p["x"].alias("centroid_lon"), p["y"].alias("centroid_lat")
        )

    def footprints(self) -> DataFrame:
        return self.boxed(
            self.sql(BUILDINGS, "orders").select("k", "gml_id", "building_uid", "x0", "y0", "x1", "y1")
        )

    def _layer(self, name: str, make, spread: bool = True) -> DataFrame:
        """A polygon layer, written once per session and folder: a stored table, as layers are.

        Layers are far smaller than the buildings, and many queries share them.
        """
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _LAYERS:
            cores = self.spark.sparkContext.defaultParallelism
            _LAYERS[key] = cut_lineage(make().repartition(cores) if spread else make())
        return _LAYERS[key]

    def attributes(self) -> DataFrame:
        return self.sql(ATTRIBUTES, "orders")

    def hazards(self) -> DataFrame:
        return self._layer("hazards", self._hazards)

    def _hazards(self) -> DataFrame:
        rows = self.sql(HAZARDS, "supplier")
        shapes = F.when(F.lit(False), None)
        for s, edges in SHAPE_EDGES.items():
            shapes = shapes.when(
                F.col("shape") == s,
                F.array(*[g.edge(*[F.lit(float(v)) for p in e for v in p]) for e in edges]),
            )
        scaled = (
            "transform(_shape, e -> struct(cx + e.x1 * w AS x1, cy + e.y1 * w AS y1,"
            " cx + e.x2 * w AS x2, cy + e.y2 * w AS y2))"
        )
        return rows.withColumn("_shape", shapes).withColumn("edges", F.expr(scaled)).drop("_shape")

    def mega(self) -> DataFrame:
        """Hazards with rings of very many edges, each with a hole.

        The stored layer holds the vertices, once each; edges are made from them where it is read.
        """

        def ring(x: str, y: str) -> str:
            after = f"(i + 1) % size({x})"
            return f"transform({x}, (x, i) -> struct(x AS x1, get({y}, i) AS y1, get({x}, {after}) AS x2, get({y}, {after}) AS y2))"

        edges = F.expr(f"concat({ring('_x0', '_y0')}, {ring('_x1', '_y1')})")
        stored = self._layer("mega", self._mega, spread=False)
        return stored.withColumn("edges", edges).drop("_x0", "_y0", "_x1", "_y1")

    def _mega(self) -> DataFrame:
        """The rows of ``MEGA_EDGES`` by polygon: each line item is moved once, its polygon is made in place."""
        v = self.table("lineitem").groupBy(F.col("l_suppkey").alias("poly_id")).agg(
            F.sort_array(F.collect_list(F.struct("l_orderkey", "l_linenumber", "l_quantity"))).alias("_v")
        )
        reach = f"(w * ({D(0.6)} + p.l_quantity / {D(125)}))"
        turn = f"({D(6.283185307179586)} * i / size(_v))"

        def along(centre: str, reach: str, wave: str):
            return F.expr(f"transform(_v, (p, i) -> {centre} + {reach} * {wave}({turn}))")

        hole = f"{D(0.3)} * {reach}"
        vertices = {"_x0": along("cx", reach, "cos"), "_y0": along("cy", reach, "sin"), "_x1": along("cx", hole, "cos"), "_y1": along("cy", hole, "sin")}
        return self.sql(HAZARDS, "supplier").join(v, "poly_id").withColumns(vertices).drop("_v")

    def extents(self) -> DataFrame:
        return self._layer("extents", lambda: self.boxed(self.sql(EXTENTS, "supplier")))

    def wards(self) -> DataFrame:
        return self._layer("wards", lambda: self.boxed(self.sql(WARDS, "supplier")))

    def cities(self) -> DataFrame:
        return self._layer("cities", lambda: self.boxed(self.sql(CITIES, "supplier")))

    def zoning(self) -> DataFrame:
        return self._layer("zoning", lambda: self.boxed(self.sql(ZONING, "part")))

    def placements(self) -> DataFrame:
        lists = (
            self.sql(FEATURES, "lineitem")
            .groupBy("uri")
            .agg(F.array_sort(F.collect_list(F.struct("l_orderkey", "l_linenumber"))).alias("f"))
            .select(
                "uri",
                F.col("uri").alias("walk"),
                F.transform("f", lambda r: F.concat(F.lit("b"), r.l_orderkey.cast("string"))).alias("ids"),
            )
        )
        return tiles.placements_from_id_lists(lists)

    def vertices(self) -> DataFrame:
        return self.sql(VERTICES, "lineitem")

    def contents(self) -> DataFrame:
        return self.sql(CONTENTS, "lineitem", "supplier")

    def year_a(self) -> DataFrame:
        return self.sql(YEAR_A, "orders")

    def year_b(self) -> DataFrame:
        return self.sql(YEAR_B, "orders")
