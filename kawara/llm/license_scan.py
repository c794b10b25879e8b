"""License texts and phrases by diagonal voting.

Every run of ``GRAM`` words of a document is hashed; hashes are joined to the positions they have
in the templates. A hit at word ``p`` of the document and word ``t`` of the template votes for the
diagonal ``p - t``. Votes are added up per diagonal; diagonals at most ``SLACK`` apart (a word added
or left out) are merged; a merged group is verified by the share of the template's words that its
hits cover and by the grams that tell its license from others (``TELLING``), which must all be met; of
verified groups that overlap, only those that cover the most words count. A base phrase needs all its grams on one diagonal, that is its words one after the
other. Templates are a fixed list, so their hashes are a table of a proven size: workers drop
hashes that no template has before the join, and the join broadcasts the list.

Defined results. NULL counts as empty: no words, no labels, score 0. No label gives the empty
string. Base places that overlap all count. A score reaches ``COVERED``
only with a label. Rows are scanned one by one, repeated ids included.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kawara.llm import shingles
from kawara.llm.common import documents, with_code

GRAM = 3
SLACK = 2
COVERED = 0.8
REACH = 256  # words; groups that overlap begin within it

#: Base phrases and their labels.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
#: Opening words of public licenses and of common notices, at most 60 words each.
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("released under the mit license", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache-2"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("creative commons attribution 4 0 international license", "cc-by"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
)
#: Grams of the notices that tell a license from a similar one; all must be met.
TELLING = {
    "released under the mit license": ("under the mit",),
    "licensed under the apache license version 2 0": ("license version 2",),
    "this work is licensed under the gnu general public license version 3": ("gnu general public", "license version 3"),
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": ("gnu general public",),
    "gnu lesser general public license": ("gnu lesser general",),
    "gnu affero general public license": ("gnu affero general",),
    "this source code form is subject to the terms of the mozilla public license": ("the mozilla public",),
    "licensed under cc by nc 4 0": ("cc by nc",),
    "creative commons attribution noncommercial 4 0 international license": ("commons attribution noncommercial",),
    "creative commons attribution sharealike 4 0 international license": ("sharealike 4 0",),
    "creative commons attribution 4 0 international license": ("commons attribution 4",),
}
_SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_TO_SPACE = bytes.maketrans(_SEPARATORS, b" " * len(_SEPARATORS))


def words_of(text: str | None) -> list[bytes]:
    """Runs of a-z, 0-9 and characters beyond ASCII, after lower-casing A-Z."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_TO_SPACE).split()


def grams_of(words: list[bytes], cache: shingles.WordHashes) -> np.ndarray:
    return shingles.rolling(shingles.word_hashes(words, cache), GRAM).view(np.int64)


def templates(spark: SparkSession, base=BASE, notices=NOTICES) -> DataFrame:
    """(gram, template, label, base, length, need, at): one row per gram of the fixed list."""
    cache, rows = shingles.WordHashes(), []
    for i, (phrase, label) in enumerate([*base, *notices]):
        words = phrase.encode().split()
        if not GRAM <= len(words) <= 60:
            raise ValueError(f"templates have {GRAM} to 60 words: {phrase}")
        met = [b" ".join(words[t : t + GRAM]).decode() for t in range(len(words) - GRAM + 1)]
        need = sum(1 << met.index(g) for g in TELLING.get(phrase, ()))
        own = (i, label, i < len(base), len(words), need)
        rows += [(int(h), *own, t) for t, h in enumerate(grams_of(words, cache))]
    return spark.createDataFrame(
        rows, "gram long, template int, label string, base boolean, length int, need long, at int"
    )


def hits(docs: DataFrame, known: np.ndarray, key: str, text: str) -> DataFrame:
    """(row, key, n_words, gram, pos): hits of each document; one row without gram if it has none."""
    kind = docs.schema[key].dataType.simpleString()
    known = np.unique(known)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = shingles.WordHashes()
        for b in batches:
            out = []
            for t in b["text"]:
                words = words_of(t)
                grams = grams_of(words, cache)
                pos = np.flatnonzero(known[np.minimum(np.searchsorted(known, grams), len(known) - 1)] == grams)
                out.append((len(words), grams[pos], pos))
            n, grams, pos = zip(*out) if out else ((), (), ())
            yield pd.DataFrame({"row": b["row"], "id": b["id"], "n_words": n, "grams": grams, "places": pos})

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("string").alias("id"), F.col(text).alias("text")
    )
    found = with_code(rows).mapInPandas(scan, "row long, id string, n_words long, grams array<long>, places array<long>")
    return found.select(
        "row", F.col("id").cast(kind).alias("id"), "n_words",
        F.explode_outer(F.arrays_zip(F.col("grams").alias("gram"), F.col("places").alias("pos"))).alias("hit"),
    ).select("row", "id", "n_words", "hit.gram", "hit.pos")


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", base=BASE, notices=NOTICES) -> DataFrame:
    """One row per document: word count, base places, labels and score."""
    spark = docs.sparkSession
    table = templates(spark, base, notices)
    known = np.array([r.gram for r in table.select("gram").collect()], np.int64)
    votes = hits(docs, known, key, text).join(F.broadcast(table), "gram", "left")
    doc = ["row", "id", "n_words"]
    own = ["template", "label", "base", "length", "need"]
    mask = F.expr(f"shiftleft(CAST({(1 << GRAM) - 1} AS BIGINT), at)")
    diagonals = votes.groupBy(*doc, *own, (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.bit_or(mask).alias("mask"), F.count("gram").alias("votes"),
        F.expr("bit_or(shiftleft(1L, at))").alias("met"),
        F.min("pos").alias("begin"), (F.max("pos") + GRAM).alias("end"),
    )
    order = W.partitionBy("row", "template").orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order) > SLACK).cast("int"), F.lit(0))
    groups = diagonals.withColumn("_apart", apart).withColumn("group", F.sum("_apart").over(order))
    place = F.col("base") & (F.bit_count("mask") == F.col("length"))
    spans = groups.groupBy(*doc, *own, "group").agg(
        F.bit_or("mask").alias("mask"),
        F.bit_or("met").alias("met"),
        F.count(F.when(place, 1)).alias("places"),
        F.min(F.when(place, F.col("diagonal"))).alias("first"),
        F.max(F.when(place, F.col("diagonal"))).alias("last"),
        F.min("begin").alias("begin"),
        F.max("end").alias("end"),
    )
    covered = F.bit_count("mask") / F.col("length")
    full = F.when(F.col("base"), F.when(F.col("places") > 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(covered)
    told = F.col("met").bitwiseAND(F.col("need")) == F.col("need")
    # of verified groups that overlap, one that covers fewer words than another does not count
    sure = F.coalesce(~F.col("base") & (covered >= COVERED) & told, F.lit(False))
    spans = spans.withColumns({"_sure": sure, "_words": F.bit_count("mask")})
    near = W.partitionBy("row").orderBy("begin").rangeBetween(-REACH, REACH)
    rivals = F.collect_list(F.when(F.col("_sure"), F.struct("begin", "end", "_words"))).over(near)
    beaten = F.exists(rivals, lambda r: (r["_words"] > F.col("_words")) & (r["begin"] < F.col("end")) & (r["end"] > F.col("begin")))
    counts = F.when(F.col("base"), F.col("places") > 0).otherwise(F.col("_sure") & ~F.col("_beaten"))
    under = (F.ceil(F.col("length") * COVERED) - 1) / F.col("length")  # the most that a group can have without a label
    score = F.when(F.col("base") | F.col("_counts"), full).otherwise(F.least(full, under))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return (
        spans.withColumn("_beaten", beaten)
        .withColumn("_counts", counts)
        .withColumn("_score", F.coalesce(score, F.lit(0.0)))
        .groupBy(*doc)
        .agg(
            F.sum("places").cast("long").alias("n_base"),
            F.min("first").cast("long").alias("first_word"),
            F.max("last").cast("long").alias("last_word"),
            joined(F.when(F.col("base") & (F.col("places") > 0), F.col("label"))).alias("base_labels"),
            joined(F.when(F.col("_counts"), F.col("label"))).alias("labels"),
            F.max("_score").alias("score"),
        )
        .select(F.col("id").alias(key), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    )


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
