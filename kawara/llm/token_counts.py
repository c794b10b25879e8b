"""Token counts by a two-tier lookup on the map side.

First tier: a broadcast table of at most ``FREQUENT`` frequent pre-tokens (words as cut at single
spaces and line feeds, with or without a space before them, up to ``tokens.LONGEST`` characters) and
their numbers of tokens. They are found by a pass over the whole corpus in which every task keeps a
bounded summary of its own words and hands on its ``FREQUENT`` best; summaries are added up, pre-tokens
themselves are never shuffled. A histogram of the sums says from which count on the words fit into the
table, and only those reach the driver. Second tier: words not in the table are encoded by the worker
that meets them and cached, bounded in entries and, as long words are not kept, in bytes.
Texts with other white space or special strings are encoded whole. Counts do not depend on what
is in the table.

Defined results. NULL counts as empty: 0 bytes, 0 tokens. Repeated rows are counted one by one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kawara.llm import tokens
from kawara.llm.common import documents, with_code
from kawara.session import cut_lineage

LIMIT = 1024
FREQUENT = 8_192
SUMMARY = 100_000
STEPS = 16  # steps of the histogram of counts between a number and its double


def _frequent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The most frequent words of a task, counted in bounded space."""
    seen: tuple[Counter, Counter] = (Counter(), Counter())

    def trim(c: Counter, size: int) -> Counter:
        return Counter(dict(c.most_common(size))) if len(c) > size else c

    for b in batches:
        for t in b["text"]:
            if t and tokens.regular(t):
                lines = t.split("\n")
                for line in lines:
                    first, *rest = line.split(" ")
                    if len(first) <= tokens.LONGEST:
                        seen[0][first] += 1
                    if len(line) > tokens.LONGEST and max(map(len, rest), default=0) > tokens.LONGEST:
                        rest = [w for w in rest if len(w) <= tokens.LONGEST]
                    seen[1].update(rest)
        seen = tuple(trim(c, SUMMARY) if len(c) > 3 * SUMMARY else c for c in seen)
    top = [(w, bool(inner), n) for inner, c in enumerate(seen) for w, n in c.most_common(FREQUENT)]
    yield pd.DataFrame(top, columns=["word", "inner", "n"])


def frequent_lengths(docs: DataFrame, text: str, name: str) -> tuple[dict[str, int], dict[str, int]]:
    """Words at the start of a line and words after a space, with their numbers of tokens."""
    summed = cut_lineage(
        with_code(docs.select(F.col(text).alias("text")))
        .mapInPandas(_frequent, "word string, inner boolean, n long")
        .groupBy("word", "inner")
        .agg(F.sum("n").alias("n"))
    )
    step = F.floor(F.log2("n") * STEPS)
    least, total = None, 0
    for r in summed.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("step")).collect():
        total += r["k"]
        if total > FREQUENT:
            break
        least = r["step"]
    found = [] if least is None else summed.where(step >= least).select("word", "inner").collect()
    encode = tokens.encoder(name).encode_ordinary
    heads = {r["word"]: len(encode(r["word"])) for r in found if not r["inner"]}
    return heads, {r["word"]: len(encode(" " + r["word"])) for r in found if r["inner"]}


def counts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT, name: str = tokens.VOCABULARY
) -> DataFrame:
    """Key, n_bytes, n_tokens and over_limit of every row."""
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, text, name))
    kind = docs.schema[key].dataType.simpleString()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = tokens.encoder(name)
        heads = tokens.Lengths(table.value[0], "", e.encode_ordinary)
        inner = tokens.Lengths(table.value[1], " ", e.encode_ordinary)

        def of(t: str | None) -> int:
            if not t:
                return 0
            if not tokens.regular(t):
                return len(tokens.ids_of(t, name))
            lines = t.split("\n")
            n = len(lines) - 1
            for line in lines:
                words = line.split(" ")
                n += heads[words[0]] + sum(map(inner.__getitem__, words[1:]))
            return n

        for b in batches:
            yield pd.DataFrame({"id": b["id"], "n_bytes": b["n_bytes"], "n_tokens": [of(t) for t in b["text"]]})

    rows = docs.select(
        F.col(key).cast("string").alias("id"),  # as text: pandas turns integers beside NULLs into floats
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text).alias("text"),
    )
    out = with_code(rows).mapInPandas(count, "id string, n_bytes long, n_tokens long")
    return out.select(F.col("id").cast(kind).alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(documents(spark, sf_dir))
