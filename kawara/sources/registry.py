"""Catalog, coverage mapping and distribution index: small JSON files."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kawara import model
from kawara.operators.catalog import latest_per

ENTRY = (
    "dataset_id string, theme string, hazard_kind string, year int, url string, udx_subdir string,"
    " coverage_extent_url string, declared_full_admin boolean"
)
CATALOG_SCHEMA = (
    "city_code string, city_name string, dataset_year int,"
    f" entries array<struct<{ENTRY.replace(' string', ':string').replace(' int', ':int').replace(' boolean', ':boolean')}>>"
)
BUNDLE = (
    "city_code string, city_name string, dataset_year int, bundle_url string, sha256 string,"
    " bytes bigint, n_buildings bigint, tool_version string"
)
MAPPING = "struct<hazard:string,ksj_url:string,ksj_urls:array<string>,published:string,notes:string>"


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """One row per catalog entry with its city and year."""
    cities = spark.read.schema(CATALOG_SCHEMA).option("multiLine", True).json(path)
    return cities.select("city_code", "city_name", "dataset_year", F.explode("entries").alias("e")).select(
        "city_code",
        "city_name",
        "dataset_year",
        "e.*",
    ).withColumn("declared_full_admin", F.coalesce("declared_full_admin", F.lit(False)))


def latest_catalog(entries: DataFrame, city_code: str, year: int | None = None) -> DataFrame:
    """Entries of a city for one year, the latest when none is named; an error if there is none."""
    rows = entries.where(F.col("city_code") == city_code)
    if year is None:
        newest = latest_per(rows.select("city_code", "dataset_year"), "city_code", "dataset_year")
        rows = rows.join(newest, ["city_code", "dataset_year"], "left_semi")
    else:
        rows = rows.where(F.col("dataset_year") == year)
    if rows.isEmpty():
        raise KeyError(f"no catalog entry for city_code={city_code!r}, year={year}")
    return rows


def of_theme(entries: DataFrame, theme: str) -> DataFrame:
    return entries.where(F.col("theme") == theme)


def hazard_entries(entries: DataFrame) -> DataFrame:
    """Hazard datasets; several of one kind are all kept."""
    return of_theme(entries, "hazard").where(F.col("hazard_kind").isNotNull()).withColumn("kind", F.col("hazard_kind"))


def read_coverage_mapping(spark: SparkSession, path: str) -> DataFrame:
    """(document_name, hazard, urls, published, notes); entries without a known hazard or url
    are dropped, and so is a malformed file."""
    text = spark.read.text(path, wholetext=True)
    return mapping_of_text(text, "value")


def mapping_of_text(docs: DataFrame, text: str) -> DataFrame:
    entries = F.from_json(text, f"entries map<string,{MAPPING}>")["entries"]
    rows = docs.select(F.explode(entries).alias("document_name", "m"))
    urls = F.when(F.size("m.ksj_urls") > 0, F.col("m.ksj_urls")).when(
        F.col("m.ksj_url") != "", F.array("m.ksj_url")
    )
    return rows.select(
        "document_name",
        F.col("m.hazard").alias("hazard"),
        urls.alias("urls"),
        F.coalesce("m.published", F.lit("")).alias("published"),
        F.coalesce("m.notes", F.lit("")).alias("notes"),
    ).where(F.col("hazard").isin(*model.HAZARD_KINDS) & (F.size("urls") > 0))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Bundles of a distribution index."""
    fields = ",".join(f.strip().replace(" ", ":", 1) for f in BUNDLE.split(","))
    rows = spark.read.schema(f"cities array<struct<{fields}>>").option("multiLine", True).json(path)
    return rows.select(F.explode("cities").alias("c")).select("c.*")


#: Bytes of a file that Spark may hold in one row; larger files are read as streams.
ROW_BYTES = 256 << 20


def _streamed(files: DataFrame, chunk: int = 8 << 20) -> DataFrame:
    """(path, got): digests of files of any size, each read by one task in pieces of ``chunk`` bytes."""

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for b in batches:
            for path in b["path"]:
                scheme, _, rest = path.partition(":")
                if scheme == "file":
                    store, name = fs.LocalFileSystem(), "/" + rest.lstrip("/")
                else:
                    store, name = fs.FileSystem.from_uri(path)
                h = hashlib.sha256()
                with store.open_input_stream(name) as f:
                    while piece := f.read(chunk):
                        h.update(piece)
                yield pd.DataFrame({"path": [path], "got": [h.hexdigest()]})

    return files.select("path").mapInPandas(digest, "path string, got string")


def check_files(spark: SparkSession, folder: str, index: DataFrame, row_bytes: int = ROW_BYTES) -> DataFrame:
    """(file, bundle_url, ok): bundle files whose checksum the index confirms.

    Files of more than ``row_bytes`` never become a row: a task reads them as a stream, with the
    file systems that Arrow knows (local, HDFS, S3, GCS).
    """
    files = spark.read.format("binaryFile").load(folder)
    small = files.where(F.col("length") <= row_bytes).select("path", F.sha2("content", 256).alias("got"))
    large = files.where(F.col("length") > row_bytes).select("path")
    known = index.select(F.substring_index("bundle_url", "/", -1).alias("file"), "bundle_url", "sha256")
    name = F.substring_index("path", "/", -1).alias("file")
    got = small.union(_streamed(large)).select(name, "got")
    return got.join(known, "file").select("file", "bundle_url", (F.col("got") == F.col("sha256")).alias("ok"))
