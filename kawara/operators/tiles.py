"""Tile placements, canonical tile keys, heights from meshes and the tile index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kawara import model
from kawara.functions import ids


def placements_from_id_lists(tiles: DataFrame) -> DataFrame:
    """(uri, ids[, walk]) -> one row per feature; the feature id is the place in the list."""
    extra = ["walk"] if "walk" in tiles.columns else []
    return tiles.select(
        F.col("uri").alias("tile_content_uri"),
        *extra,
        F.posexplode("ids").alias("tile_feature_id", "gml_id"),
    )


def canonical_tile_keys(placements: DataFrame, walk: str = "walk", by: Sequence[str] = ()) -> DataFrame:
    """(by, gml_id, tile_content_uri, tile_feature_id): deepest level, first in walk order on ties.

    ``by`` names the columns of a tileset (such as its city) in runs over several of them.
    """
    order = F.struct(-ids.lod_of(F.col("tile_content_uri")), F.col(walk), F.col("tile_feature_id"))
    return (
        placements.groupBy(*by, "gml_id")
        .agg(F.min_by(F.struct("tile_content_uri", "tile_feature_id"), order).alias("k"))
        .select(*by, "gml_id", "k.*")
    )


def attach_tile_keys(
    buildings: DataFrame, placements: DataFrame, walk: str = "walk", by: Sequence[str] = ()
) -> DataFrame:
    """Buildings with their canonical tile key; NULL where no tile shows them."""
    keys = canonical_tile_keys(placements, walk, by)
    return buildings.drop("tile_content_uri", "tile_feature_id").join(keys, [*by, "gml_id"], "left")


def style_rows(placements: DataFrame, buildings: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Attributes on every placement (all levels), restricted to the style columns."""
    cols = [c for c in model.STYLE_COLUMNS if c in buildings.columns and c not in ("tile_feature_id", *by)]
    return placements.select(*by, "gml_id", "tile_content_uri", "tile_feature_id").join(
        buildings.select(*by, "gml_id", *cols), [*by, "gml_id"]
    ).drop("gml_id")


def tile_index(contents: DataFrame, rows: DataFrame) -> DataFrame:
    """Every tile of the tileset with its style path and row count, empty tiles included."""
    n = rows.groupBy("tile_content_uri").agg(F.count(F.lit(1)).alias("n_rows"))
    return (
        contents.select(F.col("uri").alias("tile_content_uri"))
        .distinct()
        .join(n, "tile_content_uri", "left")
        .select(
            "tile_content_uri",
            ids.style_path(F.col("tile_content_uri")).alias("style_path"),
            F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"),
        )
    )


def tiles_without_rows(contents: DataFrame, rows: DataFrame) -> DataFrame:
    return (
        contents.select(F.col("uri").alias("tile_content_uri"))
        .distinct()
        .join(rows.select("tile_content_uri"), "tile_content_uri", "left_anti")
    )


def feature_heights(vertices: DataFrame, placements: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, tile_content_uri, gml_id, height_m) from vertex heights.

    ``vertices``: uri, feature_id (as stored, a float), y. Feature ids are rounded; those
    without an id in the tile's list, and flat features, fall away.
    """
    spans = (
        vertices.select(
            *by,
            F.col("uri").alias("tile_content_uri"),
            F.rint("feature_id").cast("int").alias("tile_feature_id"),
            "y",
        )
        .groupBy(*by, "tile_content_uri", "tile_feature_id")
        .agg((F.max("y") - F.min("y")).alias("h"))
        .where("h > 0")
    )
    return (
        spans.join(
            placements.select(*by, "tile_content_uri", "tile_feature_id", "gml_id"),
            [*by, "tile_content_uri", "tile_feature_id"],
        )
        .groupBy(*by, "tile_content_uri", "gml_id")
        .agg(F.max("h").alias("height_m"))
    )


def mesh_heights(
    vertices: DataFrame, placements: DataFrame, contents: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """(by, gml_id, mesh_height) over the tiles of each tileset's deepest level only."""
    lod = ids.lod_of(F.col("uri"))
    leaf = vertices.where(lod >= 0)
    if by:
        deepest = contents.groupBy(*by).agg(F.max(lod).alias("_deepest"))
        leaf = leaf.join(deepest, [*by]).where(lod == F.col("_deepest")).drop("_deepest")
    else:
        leaf = leaf.where(lod == contents.agg(F.max(lod)).scalar())
    return (
        feature_heights(leaf, placements, by)
        .groupBy(*by, "gml_id")
        .agg(F.max("height_m").cast("float").alias("mesh_height"))
    )


def backfill_heights(buildings: DataFrame, heights: DataFrame | None, by: Sequence[str] = ()) -> DataFrame:
    """Height: measured, else from the mesh, else the footprint default; says which in
    ``height_source``."""
    missing = F.col("height").isNull()
    if heights is None:
        out = buildings.withColumn("mesh_height", F.lit(None).cast("float"))
    else:
        out = buildings.join(heights, [*by, "gml_id"], "left")
    return (
        out.withColumn(
            "height_source",
            F.when(~missing, F.col("height_source"))
            .when(F.col("mesh_height").isNotNull(), "geometric")
            .otherwise("footprint_fallback"),
        )
        .withColumn(
            "height",
            F.coalesce("height", "mesh_height", F.lit(model.FOOTPRINT_HEIGHT_M)).cast("float"),
        )
        .drop("mesh_height")
    )


def fill_where_tiled(buildings: DataFrame, heights: DataFrame | None, by: Sequence[str] = ()) -> DataFrame:
    """``backfill_heights`` in the tilesets (``by``) where some building has a tile key.

    Elsewhere heights stay as they are: a default never stands in for a tileset that is not there.
    """
    has = F.coalesce(F.bool_or(F.col("tile_content_uri").isNotNull()), F.lit(False)).alias("_tiled")
    if by:
        marked = buildings.join(buildings.groupBy(*by).agg(has), [*by], "left")
    else:
        marked = buildings.withColumn("_tiled", buildings.agg(has).scalar())
    was = ("height", "height_source")
    filled = backfill_heights(marked.withColumns({f"_{c}": F.col(c) for c in was}), heights, by)
    return filled.withColumns({c: F.when(F.col("_tiled"), F.col(c)).otherwise(F.col(f"_{c}")) for c in was}).select(*buildings.columns)


def duplicate_feature_keys(buildings: DataFrame) -> DataFrame:
    """Tile keys that more than one building claims (an exact check, not a sample)."""
    return (
        buildings.where(F.col("tile_content_uri").isNotNull())
        .groupBy("tile_content_uri", "tile_feature_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )


def lookup_features(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Attributes of picked features, by tile and feature id."""
    return wanted.join(rows, ["tile_content_uri", "tile_feature_id"])


def strict_heights(buildings: DataFrame) -> DataFrame:
    return buildings.where(F.col("height_source").isin("measured", "geometric"))
