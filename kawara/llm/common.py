"""Small helpers shared by the operators: columns, reading, row keys."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kawara.session import ship_code

SHINGLE = 5
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case, every other character as it is.

    ``lower`` would also change other alphabets; it is used where the text has none.
    """
    plain = F.octet_length(c) == F.char_length(c)
    return F.when(plain, F.lower(c)).otherwise(F.translate(c, string.ascii_uppercase, string.ascii_lowercase))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def words_in(c: Column) -> Column:
    """How many runs of characters other than ASCII white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(c, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns (but maps), NULLs told apart by their place."""
    names = [_quoted(f.name) for f in df.schema if f.dataType.typeName() not in ("map", "variant")]
    return F.xxhash64(*names, *[F.col(n).isNull() for n in names])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


#: Bits of the filter below; it has 4 MB whatever it is made from.
FILTER_BITS = 1 << 25
_PAGE = 32_768


def suspects(rows: DataFrame, want: DataFrame, *on: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` that may have a partner in ``want`` by the columns ``on``, and those that surely have none.

    A bitmap of the hashes of ``want`` is broadcast, so that rows without a partner need no shuffle.
    It has a fixed size: with very many rows to look for, more rows go the long way, none is lost.
    """
    h = F.pmod(F.xxhash64(*on), F.lit(FILTER_BITS))
    pages = want.select(h.alias("__h")).groupBy(F.floor(F.col("__h") / _PAGE).alias("__page")).agg(
        F.bitmap_construct_agg(F.col("__h") % _PAGE).alias("__bits")
    )
    at = rows.withColumn("__h", h).join(F.broadcast(pages), F.floor(F.col("__h") / _PAGE) == F.col("__page"), "left")
    byte = F.expr(f"cast(conv(hex(substring(__bits, cast(__h % {_PAGE} div 8 as int) + 1, 1)), 16, 10) as int)")
    known = at.withColumn("__in", F.coalesce(F.getbit(byte, (F.col("__h") % 8).cast("int")) == 1, F.lit(False)))
    return tuple(known.where(c).select(*map(_quoted, rows.columns)) for c in ("__in", "NOT __in"))


def remaining(docs: DataFrame, gone: DataFrame, key: str, mark: Column) -> DataFrame:
    """``docs`` without the rows of ``gone`` (id, print, repeat); ``mark`` is the print of a row.

    Where ``repeat`` holds, one row of the id and print stays. Rows are carried as one column, so no
    name can clash, and only those that may have to go are shuffled.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col(key).alias("id"), mark.alias("print"))
    gone = gone.groupBy("id", "print").agg(F.max("repeat").alias("repeat"))
    maybe, stay = suspects(rows, gone, "id", "print")
    known = gone.select(F.col("id").alias("_i"), F.col("print").alias("_p"), "repeat")
    met = maybe.join(known, same(F.col("id"), F.col("_i")) & (F.col("print") == F.col("_p")), "left")
    once = met.where("repeat").groupBy("id", "print").agg(F.first("row").alias("row"))
    kept = met.where("repeat IS NULL").select("row").unionByName(once.select("row"))
    return stay.select("row.*").unionByName(kept.select("row.*"))


#: Rows of an Arrow batch: whole texts are long, and a worker holds a batch several times over.
BATCH_ROWS = 1_000


def with_code(df: DataFrame) -> DataFrame:
    """``df``, once Spark hands this package to Python workers that don't have it installed.

    Sets the session's Arrow batches to ``BATCH_ROWS`` rows, unless they are smaller.
    """
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(size)) <= BATCH_ROWS:
        df.sparkSession.conf.set(size, BATCH_ROWS)
    return ship_code(df)
