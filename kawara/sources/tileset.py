"""Tileset trees flattened to their content files, level by level."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kawara.session import cut_lineage


def read_tileset(spark: SparkSession, folder: str) -> DataFrame:
    """(uri, walk) of every leaf below ``<folder>/tileset.json``."""
    files = (
        spark.read.option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .text(folder)
        .select(F.col("_metadata.file_path").alias("path"), "value")
    )
    base = folder.rstrip("/") + "/"
    rel = F.substring_index("path", base, -1)
    return flatten_tileset(files.select(rel.alias("path"), "value"))


def _normalised(path) -> F.Column:
    """Path without ``.`` and ``..`` segments."""
    segments = F.filter(F.split(path, "/"), lambda s: (s != ".") & (s != ""))
    return F.array_join(
        F.aggregate(
            segments,
            F.array().cast("array<string>"),
            lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(
                F.array_append(acc, s)
            ),
        ),
        "/",
    )


def flatten_tileset(files: DataFrame, root: str = "tileset.json") -> DataFrame:
    """(uri, walk) from (path, value) of all JSON files; ``walk`` sorts leaves in tree order.

    External tilesets are followed through their file; uris are relative to the root file.
    Each step of the loop takes one level of all trees at once, until none is left. A file that
    leads back to itself is an error.
    """
    trees = cut_lineage(files.select("path", F.try_parse_json("value").alias("doc")))
    roots = trees.select(
        F.col("path").alias("_file"), F.try_variant_get("doc", "$.root", "variant").alias("_root")
    )
    nodes = roots.where(F.col("_file") == root).select(
        F.lit("").alias("base"), F.col("_root").alias("node"), F.array().cast("array<int>").alias("walk"),
        F.array("_file").alias("above"),
    )
    leaves = None
    while True:
        nodes = cut_lineage(nodes)
        if nodes.isEmpty():
            break
        uri = F.try_variant_get("node", "$.content.uri", "string")
        content = nodes.select("base", "walk", "above", uri.alias("u")).where("u IS NOT NULL")
        full = _normalised(F.concat("base", "u"))
        found = content.where(~F.col("u").endswith(".json")).select(full.alias("uri"), "walk")
        leaves = found if leaves is None else leaves.unionByName(found)
        # an external tileset comes before the node's own children
        external = (
            content.where(F.col("u").endswith(".json"))
            .select(full.alias("_file"), F.array_append("walk", F.lit(0)).alias("walk"), "above")
        )
        cyclic = external.where(F.array_contains("above", F.col("_file")))
        if not cyclic.isEmpty():
            raise ValueError(f"a tileset leads back to itself: {cyclic.first()['_file']}")
        external = (
            external.join(roots, "_file")
            .select(
                F.regexp_extract("_file", r"^(.*/)?[^/]*$", 1).alias("base"),
                F.col("_root").alias("node"),
                "walk",
                F.array_append("above", F.col("_file")).alias("above"),
            )
        )
        children = nodes.select(
            "base",
            "walk",
            "above",
            F.posexplode(F.try_variant_get("node", "$.children", "array<variant>")).alias("i", "node"),
        ).select("base", "node", F.array_append("walk", F.col("i") + 1).alias("walk"), "above")
        nodes = external.unionByName(children)
    if leaves is None:
        raise FileNotFoundError(f"no {root} among the files")
    return leaves
