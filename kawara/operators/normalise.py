"""Raw building attributes -> the normalised columns of the building table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kawara.functions import attributes as at
from kawara.session import broadcast_if_small


def normalise(df: DataFrame, dataset_keys=("city_code", "dataset_year")) -> DataFrame:
    """Add year_built, height, height_source, floors_above, floors_below, usage, structure and
    fire_resistance.

    Source columns are found by name, each with its alias. Whether unnamed structures are
    ``other`` or NULL depends on the building's whole dataset: NULL when none of its rows
    names a structure.
    """
    year = at.pick_column(df, "yearOfConstruction", "year_of_construction")
    tall = at.pick_column(df, "measuredHeight", "measured_height")
    above = at.pick_column(df, "storeysAboveGround", "storeys_above_ground")
    below = at.pick_column(df, "storeysBelowGround", "storeys_below_ground")
    usage = at.pick_column(df, "usage")
    detail = at.pick_column(df, "buildingDetailAttribute", "building_detail_attribute")
    null = F.lit(None)

    height = at.height(tall) if tall is not None else null.cast("float")
    out = df.withColumns(
        {
            "year_built": at.year_built(year) if year is not None else null.cast("int"),
            "height": height,
            "height_source": at.height_source(height),
            "floors_above": at.floors_above(above) if above is not None else null.cast("smallint"),
            "floors_below": at.floors_below(below) if below is not None else null.cast("smallint"),
            "usage": at.usage(usage) if usage is not None else null.cast("string"),
            "fire_resistance": at.fire_resistance(detail) if detail is not None else null.cast("string"),
        }
    )
    if detail is None:
        return out.withColumn("structure", null.cast("string"))

    keys = [k for k in dataset_keys if k in df.columns]
    labelled = df.where(at.structure_label(detail).isNotNull())
    label = at.structure_label(detail)
    if not keys:
        has = ~F.lit(labelled.isEmpty())
        return out.withColumn("structure", at.structure(label, has))
    datasets = broadcast_if_small(labelled.select(*keys).distinct().withColumn("_labelled", F.lit(True)))
    return (
        out.withColumn("_label", label)
        .join(datasets, keys, "left")
        .withColumn("structure", at.structure(F.col("_label"), F.coalesce("_labelled", F.lit(False))))
        .drop("_label", "_labelled")
    )
