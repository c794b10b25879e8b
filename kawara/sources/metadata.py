"""Dataset metadata (ISO 19115 profile): title, bounding box, source documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kawara.functions import ids
from kawara.sources.citygml import XML_OPTIONS, _struct

_S = T.StringType()
SIDES = ("west", "east", "south", "north")

METADATA_SCHEMA = _struct(
    identificationInfo=_struct(
        MD_DataIdentification=_struct(
            citation=_struct(title=_S),
            descriptiveKeywords=T.ArrayType(
                _struct(MD_Keywords=T.ArrayType(_struct(keyword=T.ArrayType(_S), type=_S)))
            ),
            extent=T.ArrayType(
                _struct(
                    geographicElement=T.ArrayType(
                        _struct(
                            EX_GeographicBoundingBox=_struct(
                                westBoundLongitude=_S,
                                eastBoundLongitude=_S,
                                southBoundLatitude=_S,
                                northBoundLatitude=_S,
                            )
                        )
                    )
                )
            ),
        )
    )
)


def read_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """(file, title, bbox, source_documents) of every ``udx_*_op.xml``; broken files fall away."""
    raw = (
        spark.read.format("xml")
        .options(rowTag="MD_Metadata", pathGlobFilter="udx_*_op.xml", recursiveFileLookup="true", **XML_OPTIONS)
        .schema(METADATA_SCHEMA)
        .load(folder)
    )
    return _extract(raw.select(F.col("_metadata.file_path").alias("file"), F.struct("*").alias("m")), ["file"])


def metadata_of_text(docs: DataFrame, text: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The same for metadata documents in a text column."""
    return _extract(docs.select(*keep, F.from_xml(text, METADATA_SCHEMA, XML_OPTIONS).alias("m")), list(keep))


def _bounding_box(ident: Column) -> Column:
    """First bounding box; NULL unless all four sides are numbers."""
    boxes = F.flatten(F.transform(ident["extent"], lambda e: e["geographicElement"]))
    first = F.get(
        F.filter(
            F.transform(boxes, lambda b: b["EX_GeographicBoundingBox"]), lambda b: b.isNotNull()
        ),
        F.lit(0),
    )
    names = ("westBoundLongitude", "eastBoundLongitude", "southBoundLatitude", "northBoundLatitude")
    sides = [F.trim(first[n]).try_cast("double") for n in names]
    known = sides[0].isNotNull()
    for s in sides[1:]:
        known = known & s.isNotNull()
    return F.when(known, F.struct(*[s.alias(n) for s, n in zip(sides, SIDES)]))


def _extract(raw: DataFrame, keep: list[str]) -> DataFrame:
    ident = F.col("m.identificationInfo.MD_DataIdentification")
    blocks = F.flatten(F.transform(ident["descriptiveKeywords"], lambda d: d["MD_Keywords"]))
    topic = F.filter(blocks, lambda b: F.trim(b["type"]) == "005")
    keywords = F.flatten(F.transform(topic, lambda b: b["keyword"]))
    title = F.trim(ident["citation"]["title"])
    return raw.where(ident.isNotNull()).select(
        *keep,
        F.when(title != "", title).alias("title"),
        _bounding_box(ident).alias("bbox"),
        F.coalesce(ids.source_documents(keywords), F.array().cast("array<string>")).alias("source_documents"),
    )


def documents(meta: DataFrame, dataset_id: str) -> DataFrame:
    """(dataset_id, seq, document): all source documents of one dataset's metadata, in order."""
    files = meta.select("file", F.posexplode("source_documents").alias("pos", "document"))
    return files.select(
        F.lit(dataset_id).alias("dataset_id"), F.struct("file", "pos").alias("seq"), "document"
    )
