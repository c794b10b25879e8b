"""Identifiers, id lists and document names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kawara import model
from kawara.functions.attributes import literal_map


def building_uid(city_code: Column, year: Column, source_file_id: Column, gml_id: Column) -> Column:
    """``city/year/source/gml`` — a part that holds the separator is an error."""
    parts = [city_code.cast("string"), year.cast("string"), source_file_id, gml_id]
    bad = F.lit(False)
    for p in parts:
        bad = bad | p.contains("/")
    return F.when(
        F.coalesce(bad, F.lit(False)),
        F.raise_error(F.concat(F.lit("'/' in a building uid part: "), F.concat_ws(" | ", *parts))),
    ).otherwise(F.concat_ws("/", *parts))


def uid_parts(uid: Column) -> Column:
    p = F.split(uid, "/")
    return F.when(
        F.size(p) == 4,
        F.struct(
            F.get(p, F.lit(0)).alias("city_code"),
            F.get(p, F.lit(1)).try_cast("int").alias("dataset_year"),
            F.get(p, F.lit(2)).alias("source_file_id"),
            F.get(p, F.lit(3)).alias("gml_id"),
        ),
    ).otherwise(F.raise_error(F.concat(F.lit("not a building uid: "), uid)))


def id_list(ids: Column) -> Column:
    """Array of ids -> sorted, distinct, comma-joined text for the public table."""
    kept = F.filter(ids, lambda i: i.isNotNull() & (i != ""))
    return F.array_join(F.array_sort(F.array_distinct(kept)), ",")


def base_source_id(source_id: Column) -> Column:
    """Source id without the suffix that records how its extent was found."""
    return F.substring_index(source_id, "+", 1)


def encoded_uri(uri: Column) -> Column:
    """Percent-encoding with nothing left safe but letters, digits and ``-._~``."""
    e = F.regexp_replace(F.url_encode(uri), r"\+", "%20")
    return F.regexp_replace(F.regexp_replace(e, r"\*", "%2A"), "%7E", "~")


def style_path(uri: Column) -> Column:
    return F.concat(F.lit("style/"), encoded_uri(uri), F.lit(".arrow"))


def lod_of(uri: Column) -> Column:
    """Level of detail from the head of a tile uri, -1 when it is no number."""
    return F.coalesce(F.substring_index(uri, "/", 1).try_cast("int"), F.lit(-1))


def document_name(s: Column) -> Column:
    """Document name without the ``（date）publisher`` tail."""
    return F.trim(F.regexp_replace(s, "（[^）]*）.*$", ""))


def is_source_document(s: Column) -> Column:
    """Keywords that name a survey document: long, and of one of three kinds."""
    return (F.length(s) > 12) & (
        s.contains("想定区域図") | s.contains("予想区域図") | s.contains("調査範囲")
    )


def source_documents(keywords: Column) -> Column:
    trimmed = F.transform(keywords, lambda k: F.trim(k))
    return F.array_distinct(F.filter(trimmed, is_source_document))


def url_key(url: Column) -> Column:
    return F.substring(F.sha2(url, 256), 1, 16)


def resolve_city(identifier: Column) -> Column:
    """Slug (any case) or five-digit code -> code; anything else is an error."""
    s = F.lower(F.trim(identifier))
    code = F.coalesce(
        F.try_element_at(literal_map(model.CITY_SLUGS), s), F.when(s.rlike("^[0-9]{5}$"), s)
    )
    return F.when(code.isNotNull(), code).otherwise(
        F.raise_error(F.concat(F.lit("unknown city: "), identifier))
    )


def confidence_rank(confidence: Column) -> Column:
    ranks = {c: i for i, c in enumerate(model.CONFIDENCE_ORDER)}
    return F.coalesce(F.try_element_at(literal_map(ranks), confidence), F.lit(0))


def confidence_name(rank: Column) -> Column:
    names = F.array(*[F.lit(c) for c in model.CONFIDENCE_ORDER])
    return F.get(names, F.coalesce(rank, F.lit(0)))
