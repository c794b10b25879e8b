"""Connected components and building complexes.

Components come from alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond", SoCC 2014): each step is one aggregate and one join, the
number of rounds grows with the logarithm of the graph, and every round is checkpointed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kawara import model
from kawara.functions import geometry as g
from kawara.operators import proximity, skew
from kawara.session import cut_lineage


def _with_min(pairs: DataFrame, rows: int) -> DataFrame:
    """(u, v, m): each pair with the smallest neighbour of its node ``u``."""
    m = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    if rows <= skew.HOT_FLOOR:  # too few rows for any node to be hot
        return pairs.join(m.drop("n"), "u")
    return skew.lookup_join(pairs, m, "u", weight="n")


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = _with_min(both, 2 * rows).where(F.col("v") > F.col("u"))
    return linked.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    """Edges point from the larger node ``u`` to the smaller ``v``; so do the results."""
    linked = _with_min(edges, rows)
    moved = F.when(F.col("v") != F.col("m"), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
    own = F.struct(F.col("u").alias("u"), F.col("m").alias("v"))
    return (
        linked.select(F.explode(F.array_compact(F.array(moved, own))).alias("e")).select("e.u", "e.v").distinct()
    )


def _state(edges: DataFrame) -> tuple:
    """Row count and order-free checksum: equal before and after a round that changed nothing."""
    return tuple(
        edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    )


def connected_components(links: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """(node, root): every linked node with the smallest node of its component.

    Runs until nothing changes; with ``max_rounds``, fails where that takes more rounds.
    """
    edges = cut_lineage(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    state = _state(edges)
    rounds = 0
    while max_rounds is None or rounds < max_rounds:
        rounds += 1
        edges = cut_lineage(_small_star(_large_star(edges, state[0]), state[0]))
        before, state = state, _state(edges)
        if state == before:
            nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return nodes.unionByName(roots)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _sortable(uid):
    """Text that sorts by length first, so the smallest label is the shortest id."""
    return F.concat(F.lpad(F.length(uid).cast("string"), 6, "0"), F.lit(":"), uid)


def building_complexes(
    buildings: DataFrame,
    *,
    eps: float = model.TOUCH_EPS_M,
    cell: float = 40.0,
    project: bool = True,
    max_group: int = proximity.MAX_GROUP,
) -> DataFrame:
    """Add ``complex_uid`` and ``complex_max_height``.

    A complex is a component of footprints at most ``eps`` apart (Web-Mercator metres when
    ``project``). It is named by its shortest, then smallest, building id. Lone buildings are
    their own complex.
    """
    es = g.mercator_edges(F.col("edges")) if project else F.col("edges")
    shapes = buildings.select(_sortable(F.col("building_uid")).alias("label"), es.alias("edges"))
    links = proximity.proximity_links(shapes, eps, cell, node="label", max_group=max_group)
    # shared nodes must never become a root: "~" sorts after the digits of a label
    shared = F.lit("\u0001")

    def last(c):
        return F.when(F.col(c).startswith(shared), F.concat(F.lit("~"), F.col(c))).otherwise(F.col(c))

    comps = connected_components(links.select(last("a").alias("a"), last("b").alias("b")))
    comps = comps.where(~F.col("node").startswith("~")).select(
        F.substring(F.col("node"), 8, 1 << 30).alias("building_uid"),
        F.substring(F.col("root"), 8, 1 << 30).alias("complex_uid"),
    )
    comps = cut_lineage(comps)
    heights = (
        comps.join(buildings.select("building_uid", "height"), "building_uid")
        .groupBy("complex_uid")
        .agg(F.max("height").alias("_max"), F.count(F.lit(1)).alias("_n"))
    )
    if comps.count() <= skew.HOT_FLOOR:
        named = comps.join(heights.drop("_n"), "complex_uid")
    else:
        named = skew.lookup_join(comps, heights, "complex_uid", weight="_n")
    named = named.withColumn("_linked", F.lit(True))
    out = buildings.drop("complex_uid", "complex_max_height").join(named, "building_uid", "left")
    return (
        out.withColumn("complex_uid", F.coalesce("complex_uid", "building_uid"))
        .withColumn("complex_max_height", F.when(F.col("_linked"), F.col("_max")).otherwise(F.col("height")))
        .drop("_max", "_linked")
    )
