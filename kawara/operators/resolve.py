"""Which coverage extent a hazard dataset gets, and from where.

Strongest first: a polygon published for the dataset itself; polygons found through its
source documents, unless they miss too much of its hazard polygons; the hazard polygons as
they are; the whole city where the source declares that. A dataset with none of these gets no
extent, so its buildings stay unknown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kawara import model
from kawara.functions import ids
from kawara.operators.containment import containment_ratio

_COLS = ["dataset_id", "kind", "priority", "confidence", "source_id", "poly_id", "edges"]


def documents_to_urls(documents: DataFrame, mapping: DataFrame, entries: DataFrame) -> DataFrame:
    """(dataset_id, kind, documents, url): mapped urls of each dataset's source documents.

    ``documents``: dataset_id, seq, document. A mapping row applies only when its hazard is
    the dataset's kind. ``documents`` in the result lists all matched names in order.
    """
    named = documents.select(
        "dataset_id", "seq", ids.document_name(F.col("document")).alias("document_name")
    ).join(entries.select("dataset_id", "kind"), "dataset_id")
    hits = named.join(
        mapping.select("document_name", F.col("hazard").alias("kind"), "urls"),
        ["document_name", "kind"],
    )
    names = hits.groupBy("dataset_id", "kind").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("seq", "document_name"))), lambda r: r.document_name
        ).alias("documents")
    )
    urls = hits.select("dataset_id", "kind", F.explode("urls").alias("url")).distinct()
    return urls.join(names, ["dataset_id", "kind"])


def mapped_source_id(dataset_id, documents) -> F.Column:
    """Dataset id with all documents that led to its extent."""
    return F.concat(dataset_id, F.lit("+ksj:"), F.array_join(documents, ","))


def resolve_extents(
    entries: DataFrame,
    *,
    explicit: DataFrame | None = None,
    mapped: DataFrame | None = None,
    hazards: DataFrame | None = None,
    admin: DataFrame | None = None,
    cell: float,
    threshold: float = model.CONTAINMENT_THRESHOLD,
) -> DataFrame:
    """Extent polygons (dataset_id, kind, confidence, source_id, poly_id, edges).

    ``entries``: dataset_id, kind, city_code, declared_full_admin. ``explicit``, ``mapped``
    (with ``documents``) and ``hazards`` hold polygons by dataset_id; ``admin`` by city_code.
    """
    base = entries.select("dataset_id", "kind", "city_code", "declared_full_admin")
    found = []

    def candidate(polys, priority, confidence, source_id):
        found.append(
            polys.select(
                "dataset_id",
                "kind",
                F.lit(priority).alias("priority"),
                F.lit(confidence).alias("confidence"),
                source_id.alias("source_id"),
                F.col("poly_id").cast("string").alias("poly_id"),
                "edges",
            ).where(F.size("edges") > 0)
        )

    ident = base.select("dataset_id", "kind")
    if explicit is not None:
        candidate(
            explicit.drop("kind").join(ident, "dataset_id"), 1, "explicit_polygon", F.col("dataset_id")
        )
    if mapped is not None:
        kept = mapped.drop("kind").join(ident, "dataset_id")
        if hazards is not None:
            ratio = containment_ratio(kept, hazards, cell=cell).where(F.col("ratio") < threshold)
            kept = kept.join(ratio.select("dataset_id"), "dataset_id", "left_anti")
        candidate(
            kept, 2, "explicit_polygon", mapped_source_id(F.col("dataset_id"), F.col("documents"))
        )
    if hazards is not None:
        candidate(
            hazards.drop("kind").join(ident, "dataset_id"),
            3,
            "inundation_bounded",
            F.concat(F.col("dataset_id"), F.lit("+inundation_bounded")),
        )
    if admin is not None:
        whole = base.where("declared_full_admin").join(
            admin.select("city_code", F.col("city_code").alias("poly_id"), "edges"), "city_code"
        )
        candidate(whole, 4, "declared_full_admin", F.col("dataset_id"))

    if not found:
        raise ValueError("no candidate polygons given")
    rows = found[0]
    for f in found[1:]:
        rows = rows.unionByName(f)
    best = rows.groupBy("dataset_id").agg(F.min("priority").alias("priority"))
    return rows.join(best, ["dataset_id", "priority"]).select(*[c for c in _COLS if c != "priority"])


def matched_extents(urls: DataFrame, published: DataFrame) -> DataFrame:
    """Polygons of the published files each dataset was mapped to (empty files fall away)."""
    return urls.join(published, "url")
