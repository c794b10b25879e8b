"""From footprints and layers to the finished building table.

Each stage is a lazy plan; results are written by the caller (``sinks.tables``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kawara import model
from kawara.functions import ids
from kawara.operators import components, coverage, identity, normalise, tiles


def build_buildings(
    footprints: DataFrame,
    *,
    dataset_year: int,
    source_file_id: str,
    source_url: str,
    attribution: str,
    admin: DataFrame | None = None,
    city_code: str | None = None,
    extents: DataFrame | None = None,
    hazards: DataFrame | None = None,
    cell: float = 0.005,
    mode: str = "point",
    large: bool = True,
) -> DataFrame:
    """Clip, normalise, identify, and join hazards.

    ``footprints``: gml_id, parts, edges and raw attributes. With ``admin`` (city_code, edges)
    buildings are clipped to the cities they meet and carry their codes; otherwise all belong
    to ``city_code``. Without ``extents`` every hazard is unknown.
    """
    df = identity.fill_missing_ids(footprints)
    if admin is not None:
        df = coverage.clip_to_boundary(df, admin, cell=cell, large=large)
    elif city_code is not None:
        df = df.withColumn("city_code", F.lit(city_code))
    else:
        raise ValueError("give either admin polygons or a city_code")
    df = df.withColumn("dataset_year", F.lit(dataset_year).cast("int"))
    df = coverage.with_point(normalise.normalise(df))
    df = df.withColumns(
        {
            "source_file_id": F.lit(source_file_id),
            "source_url": F.lit(source_url),
            "source_dataset_id": F.lit(source_file_id),
            "attribution": F.lit(attribution),
            "zoning_use": F.lit(None).cast("string"),
            "far_max": F.lit(None).cast("float"),
            "tile_content_uri": F.lit(None).cast("string"),
            "tile_feature_id": F.lit(None).cast("int"),
        }
    )
    df = df.withColumn(
        "building_uid",
        ids.building_uid(
            F.col("city_code"), F.col("dataset_year"), F.col("source_file_id"), F.col("gml_id")
        ),
    )
    return coverage.apply_hazards(df, extents, hazards, cell=cell, mode=mode, large=large)


def recompute_hazards(
    buildings: DataFrame,
    extents: DataFrame | None,
    hazards: DataFrame | None,
    *,
    cell: float = 0.005,
    mode: str = "point",
    large: bool = True,
) -> DataFrame:
    """Replace the hazard columns of an existing table and keep every other column."""
    order = buildings.columns
    out = coverage.apply_hazards(buildings, extents, hazards, cell=cell, mode=mode, large=large)
    new = [c for c in model.hazard_column_names() if c not in order]
    return out.select(*order, *new)


def add_tiles(
    buildings: DataFrame,
    placements: DataFrame,
    vertices: DataFrame | None = None,
    contents: DataFrame | None = None,
    *,
    eps: float = model.TOUCH_EPS_M,
    cell: float = 40.0,
    project: bool = True,
    by: Sequence[str] | None = None,
) -> DataFrame:
    """Canonical tile keys, heights for buildings without a measured one, complexes.

    ``by`` names the columns that tell several tilesets apart: ``city_code`` unless given, where all
    tables have it. Heights are back-filled in tilesets that some building has a tile key in.
    """
    meshes = () if vertices is None or contents is None else (vertices, contents)
    if by is None:
        by = ("city_code",) if all("city_code" in x.columns for x in (buildings, placements, *meshes)) else ()
    df = tiles.attach_tile_keys(buildings, placements, by=by)
    df = tiles.fill_where_tiled(df, tiles.mesh_heights(vertices, placements, contents, by) if meshes else None, by)
    return components.building_complexes(df, eps=eps, cell=cell, project=project)


def add_zoning(
    buildings: DataFrame,
    zoning: DataFrame | None,
    wards: DataFrame | None,
    *,
    cell: float = 0.005,
    large: bool = True,
) -> DataFrame:
    """Zoning columns (only where a zoning layer exists) and ward codes."""
    df = buildings
    if zoning is not None:
        df = coverage.backfill_zoning(df, zoning, cell=cell, large=large)
    if wards is not None:
        return coverage.assign_ward(df, wards, cell=cell, large=large)
    return df.withColumn("ward_code", F.col("city_code"))
