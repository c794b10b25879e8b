"""Attribute normalisation: sentinels, JSON-in-string values, code lists, depth ranks."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kawara import model


def pick_column(df: DataFrame, *names: str) -> Column | None:
    """First of several alias columns the table has (decided when the plan is built)."""
    for n in names:
        if n in df.columns:
            return F.col(n)
    return None


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(v) for v in chain.from_iterable(values.items())])


def number(c: Column) -> Column:
    """Lenient number: text that is no number, and NaN, become NULL."""
    d = c.try_cast("double")
    return F.when(~F.isnan(d), d)


def year_built(c: Column) -> Column:
    return number(c).try_cast("int")


def height(c: Column) -> Column:
    """Measured height; zero and negative values are the missing-height sentinel."""
    h = number(c)
    return F.when(h > 0, h).cast("float")


def height_source(h: Column) -> Column:
    return F.when(h.isNotNull(), F.lit("measured")).otherwise(F.lit("unknown"))


def floors_above(c: Column) -> Column:
    n = number(c)
    return F.when((n >= 0) & (n < model.FLOOR_LIMIT), n).cast("smallint")


def floors_below(c: Column) -> Column:
    return number(c).try_cast("smallint")


def _looks_like_json(c: Column) -> Column:
    return F.substring(c, 1, 1).isin("[", "{")


def _is_text(v: Column) -> Column:
    return F.schema_of_variant(v) == "STRING"


def _entries(c: Column) -> Column:
    """JSON text -> array of its entries; a lone object counts as one entry."""
    v = F.try_parse_json(c)
    return F.when(
        F.substring(c, 1, 1) == "[", F.try_variant_get(v, "$", "array<variant>")
    ).when(F.substring(c, 1, 1) == "{", F.array(v))


def first_text(c: Column) -> Column:
    """A plain string as it is, or the first non-empty string of a JSON array."""
    texts = F.transform(
        F.filter(F.try_variant_get(F.try_parse_json(c), "$", "array<variant>"), _is_text),
        lambda v: F.variant_get(v, "$", "string"),
    )
    from_array = F.get(F.filter(texts, lambda t: t != ""), F.lit(0))
    return F.when(_looks_like_json(c), from_array).when(c != "", c)


def detail_value(c: Column, key: str) -> Column:
    """``key`` of the first entry in a JSON list (or single object) that has a value for it."""
    values = F.transform(_entries(c), lambda e: F.try_variant_get(e, f"$.{key}", "string"))
    return F.get(F.filter(values, lambda t: t.isNotNull() & (t != "")), F.lit(0))


def usage(c: Column) -> Column:
    """Usage class; every row of a dataset with a usage column gets at least ``other``."""
    return F.coalesce(F.try_element_at(literal_map(model.USAGE_LABELS), first_text(c)), F.lit("other"))


def structure_label(c: Column) -> Column:
    return detail_value(c, "buildingStructureType")


def structure(label: Column, dataset_has_labels: Column) -> Column:
    """Structure class; NULL throughout a dataset that never names a structure."""
    mapped = F.try_element_at(literal_map(model.STRUCTURE_LABELS), label)
    return F.when(dataset_has_labels, F.coalesce(mapped, F.lit("other")))


def fire_resistance(c: Column) -> Column:
    return detail_value(c, "fireproofStructureType")


# --- hazard depth ------------------------------------------------------------------


def depth_of_label(label: Column) -> Column:
    return F.try_element_at(literal_map(model.RANK_LABEL_DEPTH), label)


def depth_of_rank(rank: Column) -> Column:
    return F.try_element_at(literal_map(model.RANK_NUMBER_DEPTH), rank.try_cast("int"))


def depth_of_exact_rank(rank: Column) -> Column:
    """Depth of a rank column: 2 and 2.0 are rank 2, 2.7 is no rank."""
    n = number(rank)
    return F.when(n == F.floor(n), depth_of_rank(n))


def _entry_depth(e: Column) -> Column:
    def candidate(key):
        v = F.try_variant_get(e, f"$.{key}", "variant")
        text = F.when(_is_text(v), F.variant_get(v, "$", "string"))
        num = F.when(
            ~F.schema_of_variant(v).isin("STRING", "BOOLEAN", "VOID"),
            F.try_variant_get(v, "$", "double"),
        )
        used = (text != "") | (num != 0)
        return used, F.coalesce(depth_of_label(text), depth_of_rank(num))

    rank_used, rank_depth = candidate("rank")
    _, other_depth = candidate("depthRank")
    return F.when(F.coalesce(rank_used, F.lit(False)), rank_depth).otherwise(other_depth)


def risk_attribute_depth(c: Column) -> Column:
    """Largest depth over the entries of a risk attribute; labels give their upper bound."""
    return F.when(_looks_like_json(c), F.array_max(F.transform(_entries(c), _entry_depth))).otherwise(
        depth_of_label(c)
    )


def with_depth(df: DataFrame, kind: str) -> DataFrame:
    """Add ``depth_m`` (or ``in_zone`` for the zone kind) to one hazard layer.

    The first depth column the layer has decides for the whole layer. Depth is NULL when
    absent, never NaN.
    """
    if kind == model.ZONE_KIND:
        return df.withColumn("in_zone", F.lit(True))
    if "floodingRiskAttribute" in df.columns:
        depth = risk_attribute_depth(F.col("floodingRiskAttribute"))
    elif "depth" in df.columns:
        depth = number(F.col("depth"))
    elif "depth_rank" in df.columns:
        depth = depth_of_exact_rank(F.col("depth_rank"))
    elif "rank" in df.columns:
        depth = depth_of_exact_rank(F.col("rank"))
    else:
        depth = F.lit(None)
    return df.withColumn("depth_m", depth.cast("double"))


# --- bands -------------------------------------------------------------------------


def height_band(h: Column) -> Column:
    band = F.when(h.isNull() | F.isnan(h), "unknown")
    low = None
    for b in (5, 15, 25, 35, 45, 55, 70):
        band = band.when(h < b, f"<{b}" if low is None else f"{low}-{b}")
        low = b
    return band.otherwise(">=70")


def age_band(y: Column) -> Column:
    return F.when(y.isNull(), "unknown").when(y < 1981, "<1981").when(y < 2000, "1981-1999").otherwise(">=2000")


DECADE_BREAKS = (1950, 1960, 1970, 1981, 1990, 2000, 2010, 2020)  # 1981: building-code change


def decade_band(y: Column) -> Column:
    band = F.when(y.isNull(), "unknown").when(y < DECADE_BREAKS[0], f"<{DECADE_BREAKS[0]}")
    for lo, hi in zip(DECADE_BREAKS, DECADE_BREAKS[1:]):
        band = band.when(y < hi, f"{lo}-{hi - 1}")
    return band.otherwise(f">={DECADE_BREAKS[-1]}")


def ramp_position(v: Column, vmin: float, vmax: float, stops: int = 8) -> Column:
    """Place of a value on a linear colour ramp, 0 .. stops-1."""
    t = F.least(F.greatest((v - vmin) / (vmax - vmin), F.lit(0.0)), F.lit(1.0))
    return F.when(v.isNotNull(), t * (stops - 1))


def display_height(complex_max: Column, own: Column) -> Column:
    return F.coalesce(complex_max, own)
