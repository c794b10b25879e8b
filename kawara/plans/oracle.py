"""For every registered query, the same result in plain SQL that DuckDB runs.

The SQL never shares the engine's method: spatial tests are full even-odd tests over edge
tables, unions of boxes are measured on a compressed lattice, components are a recursive query.
"""

from __future__ import annotations

import re

from kawara import model
from kawara.functions.attributes import DECADE_BREAKS
from kawara.plans import inputs as i

D = i.D


def _values(rows) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        return f"'{v}'" if isinstance(v, str) else repr(v)

    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


def _case(subject: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {k!r} THEN {v!r}" for k, v in mapping.items())
    return f"CASE {subject} {whens} END"


SHAPES = [
    (s, float(a[0]), float(a[1]), float(b[0]), float(b[1])) for s, es in i.SHAPE_EDGES.items() for a, b in es
]

# depth of a hazard polygon, from the numbers its JSON text was made of
_LABEL_DEPTH = _case("{}", dict(enumerate(model.RANK_LABEL_DEPTH.values())))
DEPTH = f"""CASE variant WHEN 0 THEN {_LABEL_DEPTH.format('n % 6')}
 WHEN 1 THEN GREATEST({_LABEL_DEPTH.format('n % 6')}, {_LABEL_DEPTH.format('(n + 1) % 6')})
 WHEN 2 THEN {_case('n % 7', model.RANK_NUMBER_DEPTH)}
 ELSE CASE WHEN n % 3 = 2 THEN {_LABEL_DEPTH.format('n % 6')} END END"""



def _edge_meets_box(e: str, x0: str, y0: str, x1: str, y1: str) -> str:
    """Bounds meet, and the corners of the box do not all lie on one side of the edge's line."""
    sides = ", ".join(
        f"({e}.x2 - {e}.x1) * ({y} - {e}.y1) - ({x} - {e}.x1) * ({e}.y2 - {e}.y1)" for x in (x0, x1) for y in (y0, y1)
    )
    return (
        f"(LEAST({e}.x1, {e}.x2) <= {x1} AND GREATEST({e}.x1, {e}.x2) >= {x0} AND LEAST({e}.y1, {e}.y2) <= {y1}"
        f" AND GREATEST({e}.y1, {e}.y2) >= {y0} AND LEAST({sides}) <= 0 AND GREATEST({sides}) >= 0)"
    )


# map tiles: number of a tile from degrees, and degrees of its northern border, at t tiles a side
_X_OF = "CAST(FLOOR(({} + 180) / CAST(360 AS DOUBLE) * t) AS BIGINT)"
_Y_OF = "CAST(FLOOR((1 - LN(TAN(RADIANS({0})) + 1 / COS(RADIANS({0}))) / PI()) / 2 * t) AS BIGINT)"
_LAT_OF = "DEGREES(ATAN((EXP(PI() * (1 - 2 * {0} / t)) - EXP(PI() * (2 * {0} / t - 1))) / 2))"

CTE = {
    "b": f"SELECT *, (x0 + x1) / {D(2)} AS px, (y0 + y1) / {D(2)} AS py FROM ({i.BUILDINGS}) z",
    "attrs": i.ATTRIBUTES,
    "haz": f"SELECT *, CAST({DEPTH} AS DOUBLE) AS depth_m FROM ({i.HAZARDS}) z",
    "ext": i.EXTENTS,
    "wards": i.WARDS,
    "cities": i.CITIES,
    "zoning": i.ZONING,
    "shapes": f"SELECT * FROM (VALUES {_values(SHAPES)}) v(shape, fx1, fy1, fx2, fy2)",
    "haz_edges": "SELECT h.poly_id, h.frame, h.kind, h.source_id, h.depth_m, CAST(cx + fx1 * w AS DOUBLE) AS x1,"
    " CAST(cy + fy1 * w AS DOUBLE) AS y1, CAST(cx + fx2 * w AS DOUBLE) AS x2, CAST(cy + fy2 * w AS DOUBLE) AS y2"
    " FROM haz h JOIN shapes s ON h.shape = s.shape",
    "cov": "SELECT b.building_uid, e.kind, e.source_id, e.confidence FROM b JOIN ext e"
    " ON b.frame = e.frame AND b.px > e.x0 AND b.px < e.x1 AND b.py > e.y0 AND b.py < e.y1",
    "hits": "SELECT b.building_uid, h.kind, h.source_id, h.depth_m FROM b JOIN haz_edges h ON b.frame = h.frame"
    " AND (h.y1 > b.py) <> (h.y2 > b.py) AND b.px < (h.x2 - h.x1) * (b.py - h.y1) / (h.y2 - h.y1) + h.x1"
    " GROUP BY b.building_uid, h.kind, h.source_id, h.depth_m, h.poly_id HAVING COUNT(*) % 2 = 1",
    "mega_edges": f"SELECT e.*, h.kind, h.source_id, h.depth_m, 'm' || CAST(h.poly_id AS STRING) AS city_code"
    f" FROM ({i.MEGA_EDGES}) e JOIN haz h ON e.poly_id = h.poly_id",
    # no vertex lies farther from the middle than w
    "mega_near": "SELECT b.*, h.poly_id FROM b JOIN haz h ON b.frame = h.frame AND b.x1 >= h.cx - h.w AND b.x0 <= h.cx + h.w"
    " AND b.y1 >= h.cy - h.w AND b.y0 <= h.cy + h.w WHERE h.poly_id IN (SELECT poly_id FROM mega_edges)",
    "mega_hits": "SELECT b.building_uid, h.kind, h.source_id, h.depth_m FROM mega_near b JOIN mega_edges h ON b.poly_id = h.poly_id"
    " AND (h.y1 > b.py) <> (h.y2 > b.py) AND b.px < (h.x2 - h.x1) * (b.py - h.y1) / (h.y2 - h.y1) + h.x1"
    " GROUP BY b.building_uid, h.kind, h.source_id, h.depth_m, h.poly_id HAVING COUNT(*) % 2 = 1",
    "mega_met": "SELECT b.building_uid, b.gml_id, h.kind, h.source_id, h.depth_m, h.city_code FROM mega_near b JOIN mega_edges h"
    " ON b.poly_id = h.poly_id GROUP BY ALL HAVING COUNT(*) FILTER ((h.y1 > b.y0) <> (h.y2 > b.y0)"
    " AND b.x0 < (h.x2 - h.x1) * (b.y0 - h.y1) / (h.y2 - h.y1) + h.x1) % 2 = 1 OR BOOL_OR("
    + _edge_meets_box("h", "b.x0", "b.y0", "b.x1", "b.y1")
    + ")",
    "ext_met": "SELECT b.building_uid, e.kind, e.source_id, e.confidence FROM b JOIN ext e"
    " ON b.frame = e.frame AND b.x0 <= e.x1 AND b.x1 >= e.x0 AND b.y0 <= e.y1 AND b.y1 >= e.y0",
    "height_attrs": f"SELECT *, CASE WHEN measuredHeight > 0 THEN CAST(measuredHeight AS FLOAT) END AS height,"
    " TRY_CAST(yearOfConstruction AS INTEGER) AS year_built FROM attrs",
    "usages": "SELECT gml_id, COALESCE(CASE WHEN o IN (2, 3, 7) THEN "
    + _case("usage_label", model.USAGE_LABELS)
    + " END, 'other') AS usage FROM (SELECT a.gml_id, usage_label, o_custkey % 8 AS o FROM attrs a JOIN b ON a.k = b.k) z",
    "structures": "SELECT gml_id, city_code, CASE WHEN city_code = '27100' THEN NULL ELSE COALESCE(CASE WHEN k % 6 IN (2, 3, 5) THEN "
    + _case("structure_label", model.STRUCTURE_LABELS)
    + " END, 'other') END AS structure, CASE k % 6 WHEN 2 THEN '準耐火' WHEN 3 THEN '耐火' WHEN 4 THEN '5' END AS fire_resistance FROM attrs",
    "places": f"SELECT uri, l_orderkey, 'b' || CAST(l_orderkey AS STRING) AS gml_id,"
    f" ROW_NUMBER() OVER (PARTITION BY uri ORDER BY l_orderkey, l_linenumber) - 1 AS fid FROM ({i.FEATURES}) z",
    "contents": i.CONTENTS,
    "canon": "SELECT gml_id, uri, fid FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY gml_id ORDER BY"
    " CAST(SPLIT_PART(uri, '/', 1) AS INTEGER) DESC, uri, fid) AS rn FROM places) z WHERE rn = 1",
    "mesh": "SELECT p.gml_id, MAX(h) AS mesh_height FROM (SELECT uri, CAST(ROUND(feature_id) AS BIGINT) AS fid,"
    f" MAX(y) - MIN(y) AS h FROM ({i.VERTICES}) v GROUP BY 1, 2) s JOIN places p ON s.uri = p.uri AND s.fid = p.fid"
    " WHERE h > 0 AND SPLIT_PART(s.uri, '/', 1) = '18' GROUP BY 1",
    "filled": f"SELECT a.gml_id, COALESCE(a.height, m.mesh_height, {D(3.5)}) AS height,"
    " CASE WHEN a.height IS NOT NULL THEN 'measured' WHEN m.mesh_height IS NOT NULL THEN 'geometric'"
    " ELSE 'footprint_fallback' END AS height_source FROM height_attrs a LEFT JOIN mesh m ON a.gml_id = m.gml_id",
    "ward_of": "SELECT b.building_uid, COALESCE(w.ward_code, 'unassigned') AS ward_code FROM b LEFT JOIN wards w"
    " ON b.frame = w.frame AND px > w.x0 AND px < w.x1 AND py > w.y0 AND py < w.y1",
    "year_a": i.YEAR_A,
    "year_b": i.YEAR_B,
    "pairs": "SELECT a.building_uid AS a, c.building_uid AS b FROM b a JOIN b c ON a.frame = c.frame"
    " AND c.x0 <= a.x1 + 0.01 AND c.x1 >= a.x0 - 0.01 AND c.y0 <= a.y1 + 0.01 AND c.y1 >= a.y0 - 0.01"
    " AND a.building_uid <> c.building_uid WHERE POW(GREATEST(c.x0 - a.x1, a.x0 - c.x1, 0), 2)"
    f" + POW(GREATEST(c.y0 - a.y1, a.y0 - c.y1, 0), 2) <= {D(0.005)} * {D(0.005)}",
    "boxes": "SELECT 'd' || CAST(s_suppkey AS STRING) AS ds, CAST(s_suppkey * 40 AS DOUBLE) AS ox,"
    " (s_suppkey % 7) / CAST(4 AS DOUBLE) AS u, (s_nationkey % 9) / CAST(2 AS DOUBLE) AS v FROM supplier",
    "rects": "SELECT ds, 'h' AS role, ox AS x0, CAST(0 AS DOUBLE) AS y0, ox + 8 AS x1, 6 + u AS y1 FROM boxes"
    " UNION ALL SELECT ds, 'h', ox + 4 + u, 3, ox + 12, 9 FROM boxes"
    " UNION ALL SELECT ds, 'e', ox, 0, ox + 9 + v, 9 FROM boxes"
    " UNION ALL SELECT ds, 'e', ox + 6, -1, ox + 12, 7 + u FROM boxes",
    "xs": "SELECT ds, x AS lo, LEAD(x) OVER (PARTITION BY ds ORDER BY x) AS hi FROM"
    " (SELECT ds, x0 AS x FROM rects UNION SELECT ds, x1 FROM rects) z",
    "ys": "SELECT ds, y AS lo, LEAD(y) OVER (PARTITION BY ds ORDER BY y) AS hi FROM"
    " (SELECT ds, y0 AS y FROM rects UNION SELECT ds, y1 FROM rects) z",
    "lattice": "SELECT xs.ds, (xs.hi - xs.lo) * (ys.hi - ys.lo) AS area, BOOL_OR(r.role = 'h') AS in_h, BOOL_OR(r.role = 'e') AS in_e"
    " FROM xs JOIN ys ON xs.ds = ys.ds JOIN rects r ON r.ds = xs.ds AND r.x0 <= xs.lo AND r.x1 >= xs.hi"
    " AND r.y0 <= ys.lo AND r.y1 >= ys.hi WHERE xs.hi IS NOT NULL AND ys.hi IS NOT NULL"
    " GROUP BY xs.ds, xs.lo, xs.hi, ys.lo, ys.hi",
    "ratios": "SELECT ds, SUM(area) AS hazard_area, COALESCE(SUM(area) FILTER (WHERE in_e), 0) AS contained_area FROM lattice"
    " WHERE in_h GROUP BY ds",
}

_NEEDS = {
    "haz_edges": ["haz", "shapes"],
    "cov": ["b", "ext"],
    "hits": ["b", "haz_edges"],
    "mega_edges": ["haz"],
    "mega_near": ["b", "haz", "mega_edges"],
    "mega_hits": ["mega_near", "mega_edges"],
    "mega_met": ["mega_near", "mega_edges"],
    "ext_met": ["b", "ext"],
    "height_attrs": ["attrs"],
    "usages": ["attrs", "b"],
    "structures": ["attrs"],
    "canon": ["places"],
    "mesh": ["places"],
    "filled": ["height_attrs", "mesh"],
    "ward_of": ["b", "wards"],
    "pairs": ["b"],
    "rects": ["boxes"],
    "xs": ["rects"],
    "ys": ["rects"],
    "lattice": ["xs", "ys", "rects"],
    "ratios": ["lattice"],
}


def _with(body: str, *names: str, extra: dict | None = None) -> str:
    order: list[str] = []

    def add(n):
        for d in _NEEDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = [(n, CTE[n]) for n in order] + list((extra or {}).items())
    if not ctes:
        return body
    recursive = "RECURSIVE " if any("UNION" in t and n == "reach" for n, t in ctes) else ""
    return f"WITH {recursive}" + ",\n".join(f"{n} AS ({t})" for n, t in ctes) + "\n" + body


def _r(expr: str, alias: str, places: int = 6) -> str:
    return f"ROUND(CAST({expr} AS DOUBLE), {places}) AS {alias}"


def _ids(where: str, source: str) -> str:
    return f"COALESCE(STRING_AGG(DISTINCT {source}, ',' ORDER BY {source}) FILTER (WHERE {where}), '')"


CONF_RANK = _case("confidence", {c: n for n, c in enumerate(model.CONFIDENCE_ORDER)})
CONF_NAME = _case("{}", dict(enumerate(model.CONFIDENCE_ORDER)))


def _built(kinds) -> str:
    """One row per building with the flat columns of the given kinds."""
    cov, hit, cols = [], [], ["b.*"]
    for k in kinds:
        cov += [
            f"COUNT(*) FILTER (WHERE kind = '{k}') > 0 AS {k}_covered",
            f"{_ids(f'kind = {k!r}', 'source_id')} AS {k}_cov_ids",
            f"MAX({CONF_RANK}) FILTER (WHERE kind = '{k}') AS {k}_rank",
        ]
        hit += [
            f"MAX(depth_m) FILTER (WHERE kind = '{k}') AS {k}_depth",
            f"COUNT(*) FILTER (WHERE kind = '{k}') > 0 AS {k}_hit",
            f"{_ids(f'kind = {k!r}', 'source_id')} AS {k}_ids",
        ]
        covered = f"COALESCE(c.{k}_covered, false)"
        cols += [
            f"{covered} AS {k}_covered",
            f"COALESCE(c.{k}_cov_ids, '') AS {k}_coverage_source_ids",
            f"{CONF_NAME.format(f'COALESCE(c.{k}_rank, 0)')} AS {k}_coverage_confidence",
            f"CASE WHEN {covered} THEN COALESCE(h.{k}_ids, '') ELSE '' END AS {k}_hit_source_ids",
            (
                f"{covered} AND COALESCE(h.{k}_hit, false) AS {k}_in_zone"
                if k == model.ZONE_KIND
                else f"CASE WHEN {covered} THEN h.{k}_depth END AS {k}_depth_max"
            ),
        ]
    return (
        f"SELECT {', '.join(cols)} FROM b"
        f" LEFT JOIN (SELECT building_uid, {', '.join(cov)} FROM cov GROUP BY building_uid) c ON b.building_uid = c.building_uid"
        f" LEFT JOIN (SELECT building_uid, {', '.join(hit)} FROM hits GROUP BY building_uid) h ON b.building_uid = h.building_uid"
    )


def _from_built(body: str, kinds=model.HAZARD_KINDS) -> str:
    return _with(body, "cov", "hits", extra={"built": _built(kinds)})


KIND5 = _case("{}", dict(enumerate(model.HAZARD_KINDS)))
COV_COLS = ", ".join(
    f"{k}_{c}" for k in model.HAZARD_KINDS for c in ("covered", "coverage_source_ids", "coverage_confidence")
)
HEIGHT60 = f"CASE WHEN k % 13 <> 0 THEN {D('k % 60 + 3')} END"


def _height_band(h: str) -> str:
    text, low = f"CASE WHEN {h} IS NULL THEN 'unknown'", None
    for b in (5, 15, 25, 35, 45, 55, 70):
        text += f" WHEN {h} < {b} THEN '{'<' + str(b) if low is None else f'{low}-{b}'}'"
        low = b
    return text + " ELSE '>=70' END"


def _decade_band(y: str) -> str:
    text = f"CASE WHEN {y} IS NULL THEN 'unknown' WHEN {y} < {DECADE_BREAKS[0]} THEN '<{DECADE_BREAKS[0]}'"
    for lo, hi in zip(DECADE_BREAKS, DECADE_BREAKS[1:]):
        text += f" WHEN {y} < {hi} THEN '{lo}-{hi - 1}'"
    return text + f" ELSE '>={DECADE_BREAKS[-1]}' END"


def _pivot(kind: str, limit: str) -> str:
    c, d = f"{kind}_covered", f"{kind}_depth_max"
    return _from_built(
        f"SELECT COUNT(*) FILTER (WHERE {c} AND {d} > {limit}) AS at_risk,"
        f" COUNT(*) FILTER (WHERE {c} AND {d} > 0 AND {d} <= {limit}) AS shallow,"
        f" COUNT(*) FILTER (WHERE {c} AND COALESCE({d}, 0) <= 0) AS surveyed_safe,"
        f" COUNT(*) FILTER (WHERE NOT {c}) AS unknown FROM built",
        [kind],
    )


def _mega(cov: str, hits: str) -> str:
    cols = []
    for k in model.HAZARD_KINDS:
        value = f"{k}_in_zone" if k == model.ZONE_KIND else _r(f"{k}_depth_max", f"{k}_depth_max")
        cols += [f"{k}_covered", value, f"{k}_hit_source_ids"]
    built = _built(model.HAZARD_KINDS).replace("FROM cov ", f"FROM {cov} ").replace("FROM hits ", f"FROM {hits} ")
    return _with(f"SELECT building_uid, {', '.join(cols)} FROM built", cov, hits, extra={"built": built})


def _shapes_in_boxes() -> str:
    """Area of a polygon inside a box: its edges' x, held within the box, summed along y."""
    x = "(x1 + (y - y1) * (x2 - x1) / (y2 - y1))"
    below = f"(CASE WHEN x <= lo THEN lo * (x - lo) WHEN x <= hi THEN (x * x - lo * lo) / 2 ELSE (hi * hi - lo * lo) / 2 + hi * (x - hi) END)"
    xa, xb = x.replace("(y -", "(ya -"), x.replace("(y -", "(yb -")
    mean = (
        "CASE WHEN xa = xb THEN GREATEST(LEAST(xa, hi), lo) ELSE ("
        + re.sub(r"\bx\b", "xb", below) + " - " + re.sub(r"\bx\b", "xa", below) + ") / (xb - xa) END"
    )
    return _with(
        f"SELECT CAST(poly_id AS STRING) AS dataset_id, {_r('w * w * whole', 'hazard_area')}, {_r('w * w * held', 'contained_area')}, {_r('held / whole', 'ratio')}"
        f" FROM (SELECT poly_id, w, SUM((y2 - y1) * (x1 + x2) / 2) AS whole, SUM(CASE WHEN ya <> yb THEN (yb - ya) * {mean} ELSE 0 END) AS held"
        f" FROM (SELECT *, {xa} AS xa, {xb} AS xb FROM (SELECT poly_id, w, {D(-0.7)} AS lo, (poly_id % 5) * {D(0.2)} + {D(0.1)} AS hi,"
        " fx1 AS x1, fy1 AS y1, fx2 AS x2, fy2 AS y2, GREATEST(LEAST(fy1, 0.85), -0.45) AS ya, GREATEST(LEAST(fy2, 0.85), -0.45) AS yb"
        " FROM haz h JOIN shapes s ON h.shape = s.shape) e) f GROUP BY poly_id, w) g",
        "haz", "shapes",
    )


def _polygon_mode() -> str:
    """Box against polygon: a corner inside, a vertex inside the box, or edges that meet."""
    def turn(ax, ay, bx, by, cx, cy):
        return f"(({bx} - {ax}) * ({cy} - {ay}) - ({cx} - {ax}) * ({by} - {ay}))"

    sides = [("x0", "y0", "x1", "y0"), ("x1", "y0", "x1", "y1"), ("x1", "y1", "x0", "y1"), ("x0", "y1", "x0", "y0")]
    meets = []
    for s in sides:
        a, b, c, d = (f"b.{v}" for v in s)
        meets.append(
            f"({turn(a, b, c, d, 'e.x1', 'e.y1')} * {turn(a, b, c, d, 'e.x2', 'e.y2')} <= 0"
            f" AND {turn('e.x1', 'e.y1', 'e.x2', 'e.y2', a, b)} * {turn('e.x1', 'e.y1', 'e.x2', 'e.y2', c, d)} <= 0)"
        )
    near = (
        "LEAST(e.x1, e.x2) <= b.x1 AND GREATEST(e.x1, e.x2) >= b.x0"
        " AND LEAST(e.y1, e.y2) <= b.y1 AND GREATEST(e.y1, e.y2) >= b.y0"
    )
    corner = (
        "SELECT b.building_uid, h.depth_m FROM b JOIN haz_edges h ON b.frame = h.frame AND h.kind = 'river_flood'"
        " AND (h.y1 > b.y0) <> (h.y2 > b.y0) AND b.x0 < (h.x2 - h.x1) * (b.y0 - h.y1) / (h.y2 - h.y1) + h.x1"
        " GROUP BY b.building_uid, h.depth_m, h.poly_id HAVING COUNT(*) % 2 = 1"
    )
    touch = (
        f"SELECT b.building_uid, e.depth_m FROM b JOIN haz_edges e ON b.frame = e.frame AND e.kind = 'river_flood'"
        f" AND {near} WHERE {' OR '.join(meets)}"
    )
    return _with(
        "SELECT b.building_uid, c.building_uid IS NOT NULL AS river_flood_covered,"
        f" {_r('CASE WHEN c.building_uid IS NOT NULL THEN h.d END', 'river_flood_depth_max')}"
        " FROM b LEFT JOIN (SELECT DISTINCT b.building_uid FROM b JOIN ext e ON b.frame = e.frame AND e.kind = 'river_flood'"
        " AND b.x0 <= e.x1 AND b.x1 >= e.x0 AND b.y0 <= e.y1 AND b.y1 >= e.y0) c ON b.building_uid = c.building_uid"
        f" LEFT JOIN (SELECT building_uid, MAX(depth_m) AS d FROM ({corner} UNION ALL {touch}) z GROUP BY 1) h"
        " ON b.building_uid = h.building_uid",
        "b", "ext", "haz_edges",
    )


def _deltas() -> str:
    parts = []
    for k in model.HAZARD_KINDS:
        v = model.hazard_value_column(k)
        if k == model.ZONE_KIND:
            ah, bh, depth = f"a.{v}", f"c.{v}", "CAST(NULL AS BIGINT) AS depth_grew, CAST(NULL AS BIGINT) AS depth_shrank"
        else:
            ah, bh = f"COALESCE(a.{v}, -1) > 0", f"COALESCE(c.{v}, -1) > 0"
            depth = (
                f"COUNT(*) FILTER (WHERE {ah} AND {bh} AND c.{v} > a.{v}) AS depth_grew,"
                f" COUNT(*) FILTER (WHERE {ah} AND {bh} AND c.{v} < a.{v}) AS depth_shrank"
            )
        parts.append(
            f"SELECT '{k}' AS kind, COUNT(*) FILTER (WHERE NOT a.{k}_covered AND c.{k}_covered) AS newly_covered,"
            f" COUNT(*) FILTER (WHERE NOT ({ah}) AND ({bh})) AS newly_hit,"
            f" COUNT(*) FILTER (WHERE ({ah}) AND NOT ({bh})) AS no_longer_hit, {depth}"
            " FROM year_a a JOIN year_b c ON a.gml_id = c.gml_id"
        )
    return _with(" UNION ALL ".join(parts), "year_a", "year_b")


def _stats() -> str:
    parts = []
    for k in model.HAZARD_KINDS:
        v = model.hazard_value_column(k)
        hit = v if k == model.ZONE_KIND else f"{v} > 0"
        conf = ", ".join(
            f"COUNT(*) FILTER (WHERE {k}_coverage_confidence = '{c}') AS n_{c}" for c in model.CONFIDENCE_ORDER
        )
        parts.append(
            f"SELECT '{k}' AS kind, COUNT(*) FILTER (WHERE {k}_covered) AS covered_count,"
            f" COUNT(*) FILTER (WHERE {hit}) AS hit_count, {conf} FROM built"
        )
    return _from_built(" UNION ALL ".join(parts))


def _verify() -> str:
    produced = {"building_uid", "gml_id", "centroid_lon", "centroid_lat", "attribution"}
    produced |= {f"{k}_{c}" for k in model.HAZARD_KINDS for c in ("covered", "coverage_source_ids", "coverage_confidence", "hit_source_ids")}
    produced |= {model.hazard_value_column(k) for k in model.HAZARD_KINDS}
    n_missing = len([c for c in model.REQUIRED_COLUMNS if c not in produced])
    no_cov = " UNION ALL ".join(
        f"SELECT 'info' AS severity, 'no_coverage' AS code, 1 AS n FROM built HAVING COUNT(*) FILTER (WHERE {k}_covered) = 0"
        for k in model.HAZARD_KINDS
    )
    return _from_built(
        "SELECT severity, code, CAST(SUM(n) AS BIGINT) AS n FROM ("
        f"SELECT 'error' AS severity, 'missing_column' AS code, {n_missing} AS n"
        " UNION ALL SELECT 'error', 'honesty_violation', COUNT(*) FROM built WHERE NOT river_flood_covered AND k % 50 = 0"
        " UNION ALL SELECT 'error', 'missing_attribution', COUNT(*) FROM built WHERE k % 31 = 0"
        f" UNION ALL {no_cov}) z WHERE n > 0 GROUP BY severity, code"
    )


def _resolver() -> str:
    return _with(
        "SELECT e.ds AS dataset_id, e.kind, "
        + _case("c.p", {1: "explicit_polygon", 2: "explicit_polygon", 3: "inundation_bounded", 4: "declared_full_admin"})
        + " AS confidence, CASE c.p WHEN 2 THEN e.ds || '+ksj:doc' WHEN 3 THEN e.ds || '+inundation_bounded' ELSE e.ds END AS source_id,"
        " CASE c.p WHEN 4 THEN (SELECT COUNT(*) FROM region) ELSE 2 END AS n_polygons FROM e JOIN"
        " (SELECT e.ds, CASE WHEN q = 0 THEN 1 WHEN q <= 1 AND contained_area / hazard_area >= 0.95 THEN 2"
        " WHEN q <= 2 THEN 3 WHEN full_admin THEN 4 END AS p FROM e JOIN ratios r ON e.ds = r.ds) c ON e.ds = c.ds WHERE c.p IS NOT NULL",
        "ratios",
        extra={
            "e": "SELECT 'd' || CAST(s_suppkey AS STRING) AS ds, s_suppkey % 4 AS q, s_nationkey % 2 = 0 AS full_admin, "
            + KIND5.format("s_suppkey % 5") + " AS kind FROM supplier"
        },
    )


_INDEX = (
    "SELECT LPAD(CAST(o_custkey AS STRING), 9, '0') AS city_code, CAST(YEAR(o_orderdate) AS INTEGER) AS dataset_year,"
    " MAX(o_orderkey) AS bytes FROM orders GROUP BY 1, 2"
)
_NEW = f"SELECT DISTINCT city_code, CAST(dataset_year + bytes % 2 AS INTEGER) AS dataset_year, CAST(-1 AS BIGINT) AS bytes FROM ({_INDEX}) z WHERE bytes % 3 = 0"
_ENC = "REPLACE(REPLACE(REPLACE(url_encode({}), '+', '%20'), '*', '%2A'), '%7E', '~')"
_DOC = (
    "(CASE WHEN p_size % 3 = 0 THEN '  ' || p_name || '水系洪水浸水想定区域図' ELSE '  ' || p_name || '図' END"
    " || CASE WHEN p_size % 2 = 0 THEN '（平成29年）国土交通省' ELSE '' END)"
)
_LON, _LAT = f"((px / {D(1000)}))", f"((py / {D(1000)}))"
_R = 6378137.0

SQL = {
    "filter_by_attrs": _with(
        "SELECT COUNT(*) AS n FROM structures s JOIN height_attrs a ON s.gml_id = a.gml_id WHERE structure = 'wood' AND year_built < 1981",
        "structures", "height_attrs",
    ),
    "decade_histogram": _with(
        f"SELECT CAST(FLOOR(year_built / {D(10)}) * 10 AS INTEGER) AS decade, COUNT(*) AS n FROM height_attrs WHERE year_built IS NOT NULL GROUP BY 1 ORDER BY 1",
        "height_attrs",
    ),
    "river_flood_at_risk": _from_built(
        "SELECT COUNT(*) AS n FROM built WHERE river_flood_covered AND river_flood_depth_max > 1.0", ["river_flood"]
    ),
    "centroid_table": _with(
        f"SELECT building_uid, {_r('px', 'centroid_lon')}, {_r('py', 'centroid_lat')} FROM b ORDER BY building_uid LIMIT 1000", "b"
    ),
    "bbox_count": _with(
        "SELECT COUNT(*) AS n FROM b WHERE px BETWEEN 20.001 AND 60.001 AND py BETWEEN 30.001 AND 70.001", "b"
    ),
    "honesty_pivot": _pivot("river_flood", "0"),
    "honesty_pivot_deep": _pivot("tsunami", "1"),
    "top_depth": _from_built(
        f"SELECT building_uid, {_r('river_flood_depth_max', 'river_flood_depth_max')} FROM built"
        " WHERE river_flood_covered AND river_flood_depth_max IS NOT NULL ORDER BY 2 DESC, 1",
        ["river_flood"],
    ),
    "normalise_height": _with(
        f"SELECT gml_id, {_r('height', 'height', 3)}, CASE WHEN height IS NULL THEN 'unknown' ELSE 'measured' END AS height_source FROM height_attrs",
        "height_attrs",
    ),
    "normalise_floors": _with(
        "SELECT gml_id, year_built, CAST(CASE WHEN storeysAboveGround BETWEEN 0 AND 199 THEN storeysAboveGround END AS INTEGER) AS floors_above,"
        " CAST(storeysBelowGround AS INTEGER) AS floors_below FROM height_attrs",
        "height_attrs",
    ),
    "usage_map": _with("SELECT gml_id, usage FROM usages", "usages"),
    "structure_map": _with("SELECT gml_id, city_code, structure, fire_resistance FROM structures", "structures"),
    "rank_depth": _with("SELECT poly_id, depth_m FROM haz", "haz"),
    "uid_parts": _with(
        "SELECT city_code || '/2023/bldg/' || gml_id AS uid, city_code AS part_city, gml_id AS part_gml_id FROM attrs", "attrs"
    ),
    "canonical_doc": f"SELECT p_partkey, TRIM(REGEXP_REPLACE({_DOC}, '（[^）]*）.*$', '')) AS document,"
    f" LENGTH(TRIM({_DOC})) > 12 AND (CONTAINS({_DOC}, '想定区域図') OR CONTAINS({_DOC}, '予想区域図') OR CONTAINS({_DOC}, '調査範囲')) AS is_source FROM part",
    "event_props": "SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, COUNT(*) AS n FROM events GROUP BY 1",
    "id_forms": "SELECT s_suppkey, SUBSTR(SHA256('https://example.test/a?x=' || s_name), 1, 16) AS url_key,"
    f" 'src-' || CAST(s_suppkey AS STRING) AS base_id, {_ENC.format('s_name')} AS encoded FROM supplier",
    "resolve_city": "SELECT CASE c_custkey % 4 WHEN 0 THEN '13113' WHEN 1 THEN '27100' WHEN 2 THEN '01100' ELSE '13101' END AS city_code, COUNT(*) AS n FROM customer GROUP BY 1",
    "height_bands": _with(
        f"SELECT {_height_band('h')} AS band, COUNT(*) AS n, {_r(f'AVG(CASE WHEN h IS NOT NULL THEN LEAST(GREATEST(h / {D(60)}, 0), 1) * 7 END)', 'ramp')}"
        " FROM (SELECT CAST(height AS DOUBLE) AS h FROM height_attrs) z GROUP BY 1",
        "height_attrs",
    ),
    "age_bands": _with(
        "SELECT CASE WHEN year_built IS NULL THEN 'unknown' WHEN year_built < 1981 THEN '<1981' WHEN year_built < 2000 THEN '1981-1999' ELSE '>=2000' END AS band, COUNT(*) AS n FROM height_attrs GROUP BY 1",
        "height_attrs",
    ),
    "decade_bands": _with(
        f"SELECT {_decade_band('year_built')} AS band, COUNT(*) AS n FROM height_attrs GROUP BY 1", "height_attrs"
    ),
    "height_percentiles": _with(
        "SELECT " + ", ".join(_r(f"QUANTILE_CONT(CAST(height AS DOUBLE), {q})", a) for q, a in ((0.01, "p01"), (0.5, "median"), (0.99, "p99")))
        + " FROM height_attrs",
        "height_attrs",
    ),
    "price_percentiles": "SELECT d.decile, "
    + _r("(SELECT QUANTILE_CONT(CAST(l_extendedprice AS DOUBLE), [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]) FROM lineitem)[d.decile + 1]", "price", 4)
    + " FROM (SELECT UNNEST(RANGE(11)) AS decile) d",
    "missing_ids": (
        "SELECT CAST(l_partkey AS DOUBLE) AS x0, CAST(l_suppkey AS DOUBLE) AS y0, COUNT(*) AS n_rows,"
        " COUNT(*) FILTER (l_linenumber <> 1) AS n_made, COUNT(*) FILTER (l_linenumber <> 1) AS n_ids,"
        " NULLIF(COUNT(*) FILTER (l_linenumber <> 1), 0) AS last_number FROM lineitem GROUP BY 1, 2"
    ),
    "top_usage": _with("SELECT usage, COUNT(*) AS n FROM usages GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8", "usages"),
    "field_coverage": _with(
        " UNION ALL ".join(
            f"SELECT '{f}' AS field, {_r(f'AVG(CASE WHEN {c} THEN 1.0 ELSE 0.0 END)', 'share')} FROM {t}"
            for f, c, t in (
                ("year_built", "year_built IS NOT NULL", "height_attrs"),
                ("structure", "structure IS NOT NULL", "structures"),
                ("usage", "usage <> ''", "usages"),
                ("height", "height IS NOT NULL", "height_attrs"),
                ("floors_above", "storeysAboveGround < 200", "attrs"),
                ("floors_below", "storeysBelowGround IS NOT NULL", "attrs"),
                ("fire_resistance", "fire_resistance IS NOT NULL", "structures"),
            )
        ),
        "height_attrs", "structures", "usages",
    ),
    "marker_scan": "SELECT page_id, CONTAINS(html, 'class=\"ad\"') AS has_marker FROM pages",
    "mercator_xy": _with(
        f"SELECT gml_id, ROUND(RADIANS(lon) * {_R}, 3) AS mx, ROUND(LN(TAN(RADIANS(lat) / {D(2)} + PI() / 4)) * {_R}, 3) AS my FROM"
        f" (SELECT gml_id, lon - FLOOR(lon / {D(100)}) * {D(100)} AS lon, lat - FLOOR(lat / {D(60)}) * {D(60)} AS lat FROM"
        f" (SELECT gml_id, x0 - {D(50)} AS lon, (y0 - {D(50)}) / {D(2)} AS lat FROM b) z) y",
        "b",
    ),
    "representative_point": _with(
        "SELECT poly_id, "
        + _r("CASE shape WHEN 0 THEN (cx - w + cx) / CAST(2 AS DOUBLE) WHEN 1 THEN (lx + rx) / CAST(2 AS DOUBLE) ELSE (cx - w + (cx - w / 2)) / CAST(2 AS DOUBLE) END", "centroid_lon")
        + ", "
        + _r("CASE shape WHEN 0 THEN (cy - 0.25 * w + cy + w) / CAST(2 AS DOUBLE) ELSE cy END", "centroid_lat")
        + " FROM (SELECT *, cx - w + 0.625 * w AS lx, cx + w - 0.375 * w AS rx FROM haz) z",
        "haz",
    ),
    "layer_bounds": _with(
        f"SELECT {_r('MIN(LEAST(x1, x2))', 'minx')}, {_r('MIN(LEAST(y1, y2))', 'miny')}, {_r('MAX(GREATEST(x1, x2))', 'maxx')}, {_r('MAX(GREATEST(y1, y2))', 'maxy')} FROM haz_edges",
        "haz_edges",
    ),
    "bbox_selection": _with("SELECT gml_id FROM b WHERE x0 <= 40.055 AND x1 >= 10.055 AND y0 <= 40.055 AND y1 >= 10.055", "b"),
    "admin_centroid": _with(
        f"SELECT c.city_code, {_r('(c.x0 + c.x1) / CAST(2 AS DOUBLE)', 'lon')}, {_r('(c.y0 + c.y1) / CAST(2 AS DOUBLE)', 'lat')},"
        " COALESCE(n, 0) AS buildings FROM cities c LEFT JOIN (SELECT w.city_code, COUNT(*) AS n FROM ward_of o JOIN wards w"
        " ON o.ward_code = w.ward_code GROUP BY 1) k ON c.city_code = k.city_code",
        "cities", "ward_of",
    ),
    "coverage_join": _from_built(f"SELECT building_uid, {COV_COLS} FROM built"),
    "hazard_join": _from_built(
        "SELECT building_uid, "
        + ", ".join(f"{_r(f'{k}_depth_max', f'{k}_depth_max')}, {k}_hit_source_ids" for k in model.DEPTH_KINDS)
        + " FROM built",
        model.DEPTH_KINDS,
    ),
    "landslide_zone": _from_built(
        "SELECT building_uid, landslide_covered, landslide_in_zone, landslide_hit_source_ids FROM built", ["landslide"]
    ),
    "multi_source_ids": _with(
        "SELECT n_sources, COUNT(*) AS n FROM (SELECT building_uid, COUNT(DISTINCT source_id) AS n_sources FROM cov WHERE kind = 'tsunami' GROUP BY 1) z GROUP BY 1",
        "cov",
    ),
    "polygon_mode_join": _polygon_mode(),
    "stored_polygon_rerun": f"SELECT p.building_uid, '01100' AS city_code, p.river_flood_covered, p.river_flood_depth_max FROM ({_polygon_mode()}) p"
    f" JOIN ({i.BUILDINGS}) q ON p.building_uid = q.building_uid WHERE q.x0 <= 60 AND q.x1 >= 20 AND q.y0 <= 55 AND q.y1 >= 20",
    "mega_hazard_join": _mega("cov", "mega_hits"),
    "mega_polygon_mode": _mega("ext_met", "mega_met"),
    "mega_clip": _with("SELECT gml_id, city_code FROM mega_met", "mega_met"),
    "box_selection": _with(
        "SELECT e.poly_id, h.shape FROM haz_edges e JOIN haz h ON e.poly_id = h.poly_id GROUP BY ALL HAVING BOOL_OR("
        + _edge_meets_box("e", "20", "20", "60", "55")
        + ") OR COUNT(*) FILTER ((e.y1 > 20) <> (e.y2 > 20) AND 20 < (e.x2 - e.x1) * (20 - e.y1) / (e.y2 - e.y1) + e.x1) % 2 = 1",
        "haz_edges",
    ),
    "map_tile_cover": _with(
        "SELECT z, x, y, COUNT(*) AS n FROM (SELECT q.poly_id, q.z, q.x, q.y FROM ("
        f"SELECT *, x / t * 360 - 180 AS west, (x + 1) / t * 360 - 180 AS east, {_LAT_OF.format('y')} AS north, {_LAT_OF.format('(y + 1)')} AS south"
        " FROM (SELECT poly_id, z, t, x, UNNEST(RANGE(ya, yb + 1)) AS y FROM (SELECT poly_id, z, t, ya, yb, UNNEST(RANGE(xa, xb + 1)) AS x"
        f" FROM (SELECT poly_id, z, t, {_X_OF.format('MIN(LEAST(x1, x2))')} AS xa, {_X_OF.format('MAX(GREATEST(x1, x2))')} AS xb,"
        f" {_Y_OF.format('MAX(GREATEST(y1, y2))')} AS ya, {_Y_OF.format('MIN(LEAST(y1, y2))')} AS yb"
        f" FROM small, (SELECT CAST(z AS BIGINT) AS z, POW({D(2)}, z) AS t FROM (SELECT UNNEST(RANGE(10, 17)) AS z) r) s"
        " GROUP BY poly_id, z, t) a) b) c) q JOIN small e ON e.poly_id = q.poly_id GROUP BY ALL HAVING BOOL_OR("
        + _edge_meets_box("e", "q.west", "q.south", "q.east", "q.north")
        + ") OR COUNT(*) FILTER ((e.y1 > q.south) <> (e.y2 > q.south) AND q.west < (e.x2 - e.x1) * (q.south - e.y1) / (e.y2 - e.y1) + e.x1) % 2 = 1"
        " ) m GROUP BY 1, 2, 3",
        "haz_edges",
        extra={"small": "SELECT poly_id, x1 / 1000 AS x1, y1 / 1000 AS y1, x2 / 1000 AS x2, y2 / 1000 AS y2 FROM haz_edges"},
    ),
    "containment_shapes": _shapes_in_boxes(),
    "clip_to_admin": _with(
        "SELECT gml_id, c.city_code FROM b JOIN cities c ON b.frame = c.frame AND b.x0 <= c.x1 AND b.x1 >= c.x0 AND b.y0 <= c.y1 AND b.y1 >= c.y0",
        "b", "cities",
    ),
    "clip_note": _with(
        "SELECT c.city_code, COUNT(*) AS n_after, (SELECT COUNT(*) FROM orders) AS n_before FROM b JOIN cities c ON b.frame = c.frame"
        " AND b.x0 <= c.x1 AND b.x1 >= c.x0 AND b.y0 <= c.y1 AND b.y1 >= c.y0 GROUP BY 1",
        "b", "cities",
    ),
    "zoning_backfill": _with(
        f"SELECT b.building_uid, z.zoning_use, {_r('z.far_max', 'far_max')} FROM b LEFT JOIN (SELECT building_uid, zoning_use, far_max FROM"
        " (SELECT b.building_uid, z.*, ROW_NUMBER() OVER (PARTITION BY b.building_uid ORDER BY zone_seq) AS rn FROM b JOIN zoning z"
        " ON b.frame = z.frame AND px > z.x0 AND px < z.x1 AND py > z.y0 AND py < z.y1) q WHERE rn = 1) z ON b.building_uid = z.building_uid",
        "b", "zoning",
    ),
    "ward_assign": _with("SELECT building_uid, ward_code FROM ward_of", "ward_of"),
    "ward_counts": _with("SELECT ward_code, COUNT(*) AS n FROM ward_of GROUP BY 1", "ward_of"),
    "coverage_stats": _stats(),
    "proximity_pairs": _with("SELECT a, b FROM pairs WHERE a < b", "pairs"),
    "complexes": _with(
        "SELECT b.building_uid, COALESCE(c.root, b.building_uid) AS complex_uid,"
        f" {_r(f'COALESCE(m.h, {HEIGHT60})', 'complex_max_height')}"
        " FROM b LEFT JOIN named c ON b.building_uid = c.uid LEFT JOIN (SELECT root, MAX(" + HEIGHT60 + ") AS h FROM named JOIN b"
        " ON b.building_uid = named.uid GROUP BY root) m ON c.root = m.root",
        "pairs",
        extra={
            "reach": "SELECT a AS uid, b AS other FROM pairs UNION SELECT r.uid, p.b FROM reach r JOIN pairs p ON r.other = p.a",
            "named": "SELECT uid, FIRST(other ORDER BY LENGTH(other), other) AS root FROM reach GROUP BY uid",
        },
    ),
    "containment_ratio": _with(
        f"SELECT ds AS dataset_id, {_r('hazard_area', 'hazard_area')}, {_r('contained_area', 'contained_area')}, {_r('contained_area / hazard_area', 'ratio')} FROM ratios",
        "ratios",
    ),
    "resolver_choice": _resolver(),
    "documents_to_urls": "WITH hits AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem WHERE l_suppkey % 5 = l_partkey % 5"
    " AND l_suppkey IN (SELECT s_suppkey FROM supplier) AND l_partkey IN (SELECT p_partkey FROM part))"
    " SELECT u.dataset_id, u.kind, u.url, n.n_documents FROM (SELECT DISTINCT l_suppkey, 'd' || CAST(l_suppkey AS STRING) AS dataset_id, "
    + KIND5.format("l_suppkey % 5")
    + " AS kind, UNNEST(['u' || CAST(l_partkey % 97 AS STRING), 'u-all']) AS url FROM hits) u"
    " JOIN (SELECT l_suppkey, COUNT(*) AS n_documents FROM hits GROUP BY 1) n ON u.l_suppkey = n.l_suppkey",
    "tile_placements": _with("SELECT gml_id, uri AS tile_content_uri, fid AS tile_feature_id FROM places", "places"),
    "canonical_tile_key": _with(
        "SELECT b.gml_id, c.uri AS tile_content_uri, c.fid AS tile_feature_id FROM b LEFT JOIN canon c ON b.gml_id = c.gml_id", "b", "canon"
    ),
    "mesh_height": _with(f"SELECT gml_id, {_r('mesh_height', 'mesh_height')} FROM mesh", "mesh"),
    "height_backfill": _with(f"SELECT gml_id, {_r('CAST(height AS FLOAT)', 'height', 3)}, height_source FROM filled", "filled"),
    "strict_heights": _with(
        "SELECT height_source, COUNT(*) AS n FROM filled WHERE height_source IN ('measured', 'geometric') GROUP BY 1", "filled"
    ),
    "style_rows": _with(
        f"SELECT p.uri AS tile_content_uri, p.fid AS tile_feature_id, b.building_uid, {_r(HEIGHT60, 'height')} FROM places p JOIN b ON p.gml_id = b.gml_id",
        "places", "b",
    ),
    "tile_index_total": _with(
        f"SELECT c.uri AS tile_content_uri, 'style/' || {_ENC.format('c.uri')} || '.arrow' AS style_path, COUNT(p.uri) AS n_rows"
        " FROM (SELECT DISTINCT uri FROM contents) c LEFT JOIN places p ON c.uri = p.uri GROUP BY c.uri",
        "contents", "places",
    ),
    "tiles_without_rows": _with(
        "SELECT DISTINCT uri AS tile_content_uri FROM contents WHERE uri NOT IN (SELECT uri FROM places)", "contents", "places"
    ),
    "tile_lookup": _with(
        "SELECT p.uri AS tile_content_uri, p.fid AS tile_feature_id, b.building_uid FROM places p JOIN b ON p.gml_id = b.gml_id"
        " JOIN (SELECT uri, MAX(fid) AS fid FROM places GROUP BY 1) w ON p.uri = w.uri AND p.fid = w.fid",
        "places", "b",
    ),
    "feature_key_duplicates": f"SELECT {i.TILE_URI} AS tile_content_uri, l_linenumber AS tile_feature_id, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1",
    "tile_zxy_counts": _with(
        f"SELECT z, CAST(LEAST(GREATEST(FLOOR(({_LON} + 180) / {D(360)} * t), 0), t - 1) AS BIGINT) AS x,"
        f" CAST(LEAST(GREATEST(FLOOR(({D(1)} - LN(TAN(RADIANS({_LAT})) + {D(1)} / COS(RADIANS({_LAT}))) / PI()) / {D(2)} * t), 0), t - 1) AS BIGINT) AS y, COUNT(*) AS n"
        f" FROM b, (SELECT CAST(z AS BIGINT) AS z, POW({D(2)}, z) AS t FROM (SELECT UNNEST(RANGE(10, 17)) AS z) r) q GROUP BY 1, 2, 3",
        "b",
    ),
    "verify_findings": _verify(),
    "orphan_sources": _with(
        "SELECT DISTINCT kind, source_id FROM cov WHERE SPLIT_PART(source_id, '+', 1) NOT IN"
        " (SELECT 'src-' || CAST(s_suppkey AS STRING) FROM supplier WHERE s_acctbal > 0)",
        "cov",
    ),
    "distinct_sources": _with("SELECT DISTINCT kind, source_id FROM cov", "cov"),
    "duplicate_uids": "SELECT 'b' || CAST(l_orderkey AS STRING) AS building_uid, COUNT(*) AS n FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1",
    "diff_counts": _with(
        "SELECT (SELECT COUNT(*) FROM year_a) AS n_a, (SELECT COUNT(*) FROM year_b) AS n_b,"
        " COUNT(*) FILTER (WHERE a.gml_id IS NOT NULL AND c.gml_id IS NOT NULL) AS n_matched,"
        " COUNT(*) FILTER (WHERE c.gml_id IS NULL) AS n_only_in_a, COUNT(*) FILTER (WHERE a.gml_id IS NULL) AS n_only_in_b"
        " FROM (SELECT DISTINCT gml_id FROM year_a) a FULL JOIN (SELECT DISTINCT gml_id FROM year_b) c ON a.gml_id = c.gml_id",
        "year_a", "year_b",
    ),
    "diff_hazard_deltas": _deltas(),
    "diff_id_sets": _with(
        "SELECT 'both' AS place, COUNT(*) AS n FROM (SELECT gml_id FROM year_a INTERSECT SELECT gml_id FROM year_b) z"
        " UNION ALL SELECT 'only_a', COUNT(*) FROM (SELECT gml_id FROM year_a EXCEPT SELECT gml_id FROM year_b) z"
        " UNION ALL SELECT 'only_b', COUNT(*) FROM (SELECT gml_id FROM year_b EXCEPT SELECT gml_id FROM year_a) z",
        "year_a", "year_b",
    ),
    "index_upsert": f"WITH old AS ({_INDEX}), new AS ({_NEW}) SELECT * FROM new UNION ALL SELECT o.* FROM old o WHERE NOT EXISTS"
    " (SELECT 1 FROM new n WHERE n.city_code = o.city_code AND n.dataset_year = o.dataset_year)",
    "latest_bundle": "SELECT city, dataset_year, tool_version, o_orderkey FROM (SELECT o_custkey AS city, CAST(YEAR(o_orderdate) AS INTEGER) AS dataset_year,"
    " o_orderpriority AS tool_version, o_orderkey, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY YEAR(o_orderdate) DESC,"
    " o_orderpriority DESC, o_orderkey DESC) AS rn FROM orders) z WHERE rn = 1",
    "catalog_listing": "SELECT city_code, dataset_year, STRING_AGG(DISTINCT theme, ',' ORDER BY theme) AS themes FROM"
    " (SELECT LPAD(CAST(o_custkey AS STRING), 9, '0') AS city_code, CAST(YEAR(o_orderdate) AS INTEGER) AS dataset_year,"
    f" CASE o_orderstatus WHEN 'F' THEN {KIND5.format('o_orderkey % 5')} WHEN 'O' THEN 'building' ELSE 'zoning' END AS theme FROM orders) z GROUP BY 1, 2",
    "geojson_scan": _with(
        f"SELECT 'z' || CAST(zone_seq AS STRING) AS gml_id, zone_seq % 3 <> 0 AS rings_closed, {_r('x0', 'minx')}, {_r('y1', 'maxy')},"
        f" 4 AS n_edges, zoning_use, {_r('far_max', 'far_max')} FROM zoning",
        "zoning",
    ),
    "metadata_scan": "SELECT s_suppkey, s_name AS title, CASE WHEN s_suppkey % 4 <> 0 THEN CAST(s_nationkey AS DOUBLE) END AS east,"
    " CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE s_name || '洪水浸水想定区域図' END AS documents FROM supplier",
    "mapping_scan": "SELECT 'doc' || CAST(p_partkey AS STRING) AS document_name, "
    + KIND5.format("p_partkey % 6")
    + " AS hazard, 'u' || CAST(p_size AS STRING) || CASE WHEN p_partkey % 4 >= 2 THEN ',u-all' ELSE '' END AS urls"
    " FROM part WHERE p_partkey % 6 < 5 AND p_partkey % 4 <> 0",
}
