"""Repeated passages by sliding spans of sentences and by runs of words.

A span starts at every sentence and takes in the following ones until it has ``MIN_SENTENCES``
sentences and ``MIN_WORDS`` words (or is one sentence of ``LONG_WORDS`` words or more). Spans are hashed
over lower-cased words; hashes are counted over all documents; the first place of a repeated span
is the one in the document of smallest id (rows of equal id in reading order), earliest in its
text. Sentences covered by any other place of a repeated span are removed, with the white space
that follows them; everything else stays to the character.

A run of ``LONG_WORDS`` words that stands at an earlier place, wherever it starts and ends, is removed
too, word by word. Every such run holds a seed at the same word of both places: the smallest hash of
``SEED`` words among all that lie in it. Seeds are counted with the spans; where one repeats beside
words that the spans leave, all runs of words around all its places are hashed and counted in turn.

Only spans, seeds and runs that repeat are joined back to their places; hashes travel, texts do not,
except once to find the runs around seeds and once to be rewritten.

Defined results. NULL and empty texts have no sentences and stay. A span or run repeated inside one
document keeps its first place there, whole. Exact copies of a document lose all sentences that are in
spans or runs. Words are cut at white space and at sentence breaks. Documents without repeats are
unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kawara.llm.common import documents, same, suspects, with_code
from kawara.session import cut_lineage

MIN_SENTENCES = 2
MIN_WORDS = 20
LONG_WORDS = 50
SEED = 12
_BREAK = re.compile(r"[.!?][^\S\n]+|[。！？]|\n\s*")  # every way starts with one of few characters: fast to search
_SLICE = 200_000  # words hashed together
#: White space as Python's patterns see it, without the line feed, for the JVM.
_BLANK = r"\t\x0B\f\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: A sentence break, or the last character of a text that ends without one: as many as there are sentences.
_SENTENCE_END = rf"[.!?][{_BLANK}]+|[。！？]|\n[{_BLANK}\n]*|(?s:.)\z"


def _ends(text: str) -> list[int]:
    """Where each sentence ends, the white space behind it included."""
    ends = [m.end() for m in _BREAK.finditer(text)]
    return ends if not text or ends and ends[-1] == len(text) else [*ends, len(text)]


def sentences(text: str | None) -> list[str]:
    """The text cut after sentence marks and at line feeds; joined again they are the text."""
    ends = _ends(text or "")
    return [text[i:j] for i, j in zip([0, *ends], ends)]


def n_sentences(text: Column) -> Column:
    """The length of ``sentences``, counted in the JVM; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(_SENTENCE_END)), F.lit(0)).cast("long")


def _mixed(h: np.ndarray) -> np.ndarray:
    for by, shift in _MIX:
        h = h * by
        h ^= h >> shift
    return h


_MIX = [(np.uint64(0x9E3779B97F4A7C15), np.uint64(32)), (np.uint64(0xD6E8FEB86659FD93), np.uint64(29))]
_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64))
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_BASE = 0xBF58476D1CE4E5B9
_BLOCK = 1 << 17  # bytes whose words are hashed together


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of ``_BASE`` and of its inverse, modulo 2 ** 64."""
    both = np.array([[_BASE], [pow(_BASE, -1, 1 << 64)]], np.uint64).repeat(n + 1, 1)
    both[:, 0] = 1
    return tuple(np.cumprod(both, axis=1))


_KEPT = _powers(2 * _BLOCK)


def _hashed(values: np.ndarray, begins: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """One hash of ``values[begin:stop]`` for each pair: a polynomial by differences of running sums, mixed."""
    up, down = _KEPT if len(values) < len(_KEPT[0]) else _powers(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return _mixed((sums[stops] - sums[begins]) * down[begins] ^ (stops - begins).astype(np.uint64))


def _runs_hashed(hashes: np.ndarray, k: int) -> np.ndarray:
    """One hash per run of ``k`` words, in order."""
    at = np.arange(max(len(hashes) - k + 1, 0))
    return _hashed(hashes, at, at + k)


def _words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, its sentence, number of sentences of each text, of words): texts after each other.

    Words are those of ``shingles.words_of`` in each sentence; sentences are numbered through all texts.
    """
    raws, ends, size = [], [], 0
    for t in texts:
        raw = (t or "").encode("utf-8", "surrogatepass")
        own = np.array(_ends(t or ""), np.int64)
        if len(raw) != len(t or ""):
            own = np.append(np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80), len(raw))[own]
        raws.append(raw.lower())
        ends.append(own + size)
        size += len(raw)
    counts, ends, buf = np.array(list(map(len, ends)), np.int64), np.concatenate(ends), np.frombuffer(b"".join(raws), np.uint8)
    begins, stops = _word_bounds(_SPACE[buf], ends)
    hashes, i = np.empty(len(begins), np.uint64), 0
    while i < len(begins):
        low = begins[i]
        j = max(i + 1, int(np.searchsorted(begins, low + _BLOCK)))
        hashes[i:j] = _hashed(_BYTE[buf[low : stops[j - 1]]], begins[i:j] - low, stops[i:j] - low)
        i = j
    sentence = np.searchsorted(ends, begins, side="right")
    words = np.diff(np.searchsorted(sentence, np.concatenate([[0], np.cumsum(counts)])))
    return hashes, sentence, counts, words


def _word_bounds(space: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and stop: at white space and at sentence ends."""
    cut = np.ones(len(space) + 1, bool)
    cut[1:-1] = space[1:] | space[:-1]
    cut[ends] = True
    return np.flatnonzero(cut[:-1] & ~space), np.flatnonzero(cut[1:] & ~space) + 1


def spans(hashes: np.ndarray, sentence: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first sentence, last sentence, hash) of every span, from what ``_words`` gives."""
    i = np.arange(counts.sum())
    ends = np.searchsorted(sentence, i, side="right")
    before = np.concatenate([[0], ends])[:-1]
    after = np.repeat(np.cumsum(counts), counts)  # the first sentence of the next text
    reach = np.maximum(i + MIN_SENTENCES - 1, np.searchsorted(ends, before + MIN_WORDS))
    last = np.where(ends - before >= LONG_WORDS, i, reach)
    own = (ends > before) & (last < after)
    i, last = i[own], last[own]
    return i, last, _hashed(hashes, before[i], ends[last])


def _least(runs: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of every ``width`` values, the first one of equals, by doubling the reach."""
    value, at, reach = runs, np.arange(len(runs)), 1
    while reach < width:
        step = min(reach, width - reach)
        later = value[step:] < value[:-step]
        value, at, reach = np.where(later, value[step:], value[:-step]), np.where(later, at[step:], at[:-step]), reach + step
    return at


def seeds(hashes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, word number, hash) of the smallest run of ``SEED`` words of every ``LONG_WORDS`` words.

    ``hashes`` are the words of several documents after each other, ``lengths`` how many each has.
    """
    runs, width = _runs_hashed(hashes, SEED), LONG_WORDS - SEED + 1
    if len(runs) < width:
        return (np.empty(0, np.int64),) * 3
    ends = np.cumsum(lengths)
    least = _least(runs, width)
    of = np.searchsorted(ends, np.arange(len(least)), side="right")
    inside = np.arange(len(least)) + LONG_WORDS <= ends[of]  # the words around it are of one document
    at = least[inside]
    at = at[np.diff(at, prepend=-1) > 0]  # a later stretch never has an earlier least
    of = np.searchsorted(ends, at, side="right")
    return of, at - (ends[of] - lengths[of]), runs[at].view(np.int64)


def _places_of(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of sentences, hashes, places) of each text, together far fewer words than a batch may hold."""
    hashes, sentence, counts, words = _words(texts)
    first, to = np.cumsum(counts) - counts, np.cumsum(words)
    at, last, spanned = spans(hashes, sentence, counts)
    of = np.searchsorted(first + counts, at, side="right")
    # one number, spans even and seeds odd: this table is the largest
    spanning = ((at - first[of]) << 24 | last - at + 1) << 1
    seeded, own, runs = seeds(hashes, words)
    word, low = own + (to - words)[seeded], (to - words)[seeded]
    low = sentence[np.maximum(word - (LONG_WORDS - SEED), low)]
    n = sentence[np.minimum(word + LONG_WORDS, to[seeded]) - 1] - low + 1  # sentences that a run around it meets
    seeding = (own << 32 | (low - first[seeded]) << 8 | n) << 1 | 1
    each = np.concatenate([of, seeded])
    order = np.argsort(each, kind="stable")
    one, packed = np.concatenate([spanned.view(np.int64), runs])[order], np.concatenate([spanning, seeding])[order]
    cuts = np.searchsorted(each[order], np.arange(len(texts) + 1)).tolist()
    for k, i, j in zip(counts.tolist(), cuts, cuts[1:]):
        yield k, one[i:j], packed[i:j]


def _runs_of(rows: list[tuple[str, list[int]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes, places) of the runs of words around the seeds of each text, hashed together like places."""
    hashes, _, _, words = _words([t for t, _ in rows])
    runs = _runs_hashed(hashes, LONG_WORDS).view(np.int64)
    begin = 0
    for n, (_, own) in zip(words.tolist(), rows):
        near = np.zeros(max(n - LONG_WORDS + 1, 0), bool)
        for s in own:
            near[max(0, s - (LONG_WORDS - SEED)) : s + 1] = True
        at = np.flatnonzero(near)
        yield runs[begin + at], at
        begin += n


def places(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(row, id, print, n_sentences, hash, place): all spans and seeds of each document."""
    kind = docs.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out, some, size = [], [], 0
            for t in b["text"]:
                some.append(t)
                size += len(t or "") // 5
                if size >= _SLICE:
                    out += _places_of(some)
                    some, size = [], 0
            out += _places_of(some) if some else []
            n, h, p = zip(*out) if out else ((),) * 3
            yield pd.DataFrame({"row": b["row"], "id": b["id"], "print": b["print"], "n_sentences": n, "hash": h, "place": p})

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("string").alias("id"),
        F.xxhash64(text).alias("print"), F.col(text).alias("text"),
    )
    found = with_code(rows).mapInPandas(
        cut,
        "row long, id string, print long, n_sentences int, hash array<long>, place array<long>",
    )
    return found.withColumn("id", F.col("id").cast(kind))


def _met(leaf: DataFrame) -> DataFrame:
    """(row, id, hash, place) of all hashes that have more than one place."""
    each = leaf.select("row", "id", F.explode(F.arrays_zip("hash", "place")).alias("s")).select("row", "id", "s.hash", "s.place")
    repeated = cut_lineage(each.groupBy("hash").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("hash"))
    maybe, _ = suspects(each, repeated, "hash")
    return cut_lineage(maybe.join(repeated, "hash"))


def _later(met: DataFrame) -> DataFrame:
    """The places of ``met`` but the first one of each hash, which is ``first``.

    First places are written before they are joined: a hash with very many places is then a skewed
    side of a plain join, which Spark deals out over many tasks.
    """
    own = F.struct(F.col("id").isNull().alias("none"), "id", "row", "place")
    first = cut_lineage(met.groupBy("hash").agg(F.min(own).alias("first")))
    return met.join(first, "hash").where((F.col("row") != F.col("first.row")) | (F.col("place") != F.col("first.place")))


def _open(late: DataFrame) -> DataFrame:
    """(hash): seeds that have a later place beside sentences that no span covers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for n, cover, own in zip(b["n_sentences"], b["cover"], b["seeds"]):
                left = np.concatenate([[0], np.cumsum(~_covered(cover, n))])
                for s in own:
                    low = s["place"] >> 9 & (1 << 24) - 1
                    if left[low + (s["place"] >> 1 & 255)] > left[low]:
                        out.append(s["hash"])
            yield pd.DataFrame({"hash": np.unique(np.array(out, np.int64))})

    return with_code(late.where(F.size("seeds") > 0).select("n_sentences", "cover", "seeds")).mapInPandas(run, "hash long").distinct()


def _runs(docs: DataFrame, info: DataFrame, met: DataFrame, seen: DataFrame, key: str, text: str) -> DataFrame:
    """(row, id, hash, place): the runs of words around all places of the seeds."""
    kind = met.schema["id"].dataType.simpleString()
    at = met.where("place % 2 = 1").join(seen, "hash").groupBy("row").agg(F.collect_list(F.shiftright("place", 33)).alias("seeds"))
    both = _with_text(cut_lineage(at.join(info, "row")), docs, key, text)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out, some, size = [], [], 0
            for t, own in zip(b["text"], b["seeds"]):
                some.append((t, own))
                size += len(t or "") // 5
                if size >= _SLICE:
                    out += _runs_of(some)
                    some, size = [], 0
            out += _runs_of(some) if some else []
            h, p = zip(*out) if out else ((),) * 2
            yield b[["row", "id"]].assign(hash=h, place=p)

    rows = both.select("row", F.col("id").cast("string").alias("id"), "seeds", "text")
    found = with_code(rows).mapInPandas(run, "row long, id string, hash array<long>, place array<long>")
    return found.withColumn("id", F.col("id").cast(kind))


def _keyed(rows: DataFrame, key: str, mark) -> DataFrame:
    """``rows`` with their id and print as columns without NULL, so that texts are dealt out once for all joins."""
    return rows.withColumns({"_none": F.col(key).isNull(), "_k": F.coalesce(F.col(key).cast("string"), F.lit("")), "_p": mark})


def _with_text(rows: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """``rows`` with the text of their id and print, which is looked up once for each of them."""
    on, rows = ["_none", "_k", "_p"], _keyed(rows, "id", F.col("print"))
    have = _keyed(docs.select(F.col(key).alias("_key"), F.col(text).alias("text")), "_key", F.xxhash64("text")).drop("_key")
    have, _ = suspects(have, rows, *on)
    have = have.join(rows.select(*on).distinct(), on, "left_semi").dropDuplicates(on)
    return rows.join(have, on)


def removals(docs: DataFrame, leaf: DataFrame, key: str = "doc_id", text: str = "text", runs: bool = True) -> DataFrame:
    """(row, id, print, n_sentences, cover, runs, firsts): what each affected document loses, and to which ones."""
    info, doc = cut_lineage(leaf.select("row", "id", "print", "n_sentences")), ["row", "id", "print", "n_sentences"]
    met = _met(leaf)
    span = F.col("place") % 2 == 0
    cover = F.struct(F.shiftright("place", 25).cast("int").alias("at"), (F.shiftright("place", 1) % (1 << 24)).cast("int").alias("n"))
    late = _later(met).groupBy("row").agg(
        F.collect_list(F.when(span, cover)).alias("cover"), F.collect_list(F.when(~span, F.struct("hash", "place"))).alias("seeds"),
        F.collect_set(F.when(span, F.col("first.id"))).alias("firsts"),
    )
    late = cut_lineage(late.join(info, "row").select(*doc, "cover", "seeds", "firsts"))
    spans_of = late.where(F.size("cover") > 0).drop("seeds")
    if not runs:
        return spans_of.withColumn("runs", F.expr("CAST(array() AS array<struct<at:int,n:int>>)"))
    more = _later(_met(cut_lineage(_runs(docs, info, met, cut_lineage(_open(late)), key, text))))
    # a run that overlaps its own first place leaves that place whole
    begin = F.when(F.col("row") == F.col("first.row"), F.greatest("place", F.col("first.place") + LONG_WORDS)).otherwise(F.col("place"))
    more = more.groupBy("row").agg(
        F.collect_list(F.struct(begin.cast("int").alias("at"), (F.col("place") + LONG_WORDS - begin).cast("int").alias("n"))).alias("runs"),
        F.collect_set("first.id").alias("firsts"),
    ).join(info, "row")
    empty = F.expr("CAST(array() AS array<struct<at:int,n:int>>)")
    both = spans_of.withColumn("runs", empty).select(*doc, "cover", "runs", "firsts").union(
        more.withColumn("cover", empty).select(*doc, "cover", "runs", "firsts")
    )
    return both.groupBy(*doc).agg(
        F.flatten(F.collect_list("cover")).alias("cover"), F.flatten(F.collect_list("runs")).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("firsts")))).alias("firsts"),
    )


def _covered(cover, n: int) -> np.ndarray:
    gone = np.zeros(n, bool)
    for c in cover:
        gone[c["at"] : c["at"] + c["n"]] = True
    return gone


def without(text: str, cover, runs) -> tuple[str, int, int, list[dict]]:
    """What is left of a text, how many sentences and words were removed, and where."""
    ends = np.array(_ends(text), np.int64)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    at, _ = _word_bounds((points == 32) | (points >= 9) & (points <= 13), ends)
    of, at = np.searchsorted(ends, at, side="right"), np.append(at, len(text))
    gone, lost = _covered(cover, len(ends)), _covered(runs, len(of))
    mask = np.repeat(gone, np.diff(ends, prepend=0))
    for i in np.flatnonzero(lost):
        mask[at[i] : at[i + 1]] = True
    lost |= gone[of]
    n, k = np.bincount(of, minlength=len(ends)), np.bincount(of[lost], minlength=len(ends))
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))).tolist()
    removed = [{"start": i, "length": j - i} for i, j in zip(edges[::2], edges[1::2])]
    kept = [text[i:j] for i, j in zip([0, *edges[1::2]], [*edges[::2], len(text)])]
    return "".join(kept), int((gone | (n > 0) & (k == n)).sum()), int(lost.sum()), removed


def _ranked(rows: DataFrame, twice: DataFrame | None, key: str, mark: str, order) -> DataFrame:
    """``rows`` with ``_nth``, their number among rows of equal id and print."""
    if twice is None:
        return rows.withColumn("_nth", F.lit(1))
    again = twice.select(F.col("id").alias("_i"), F.col("print").alias("_q"), F.lit(True).alias("_again"))
    met = rows.join(again, same(F.col(key), F.col("_i")) & (F.col(mark) == F.col("_q")), "left").drop("_i", "_q")
    nth = F.row_number().over(W.partitionBy(key, mark).orderBy(order))
    alone = met.where("_again IS NULL").withColumn("_nth", F.lit(1))
    return alone.unionByName(met.where("_again").withColumn("_nth", nth)).drop("_again")


def everything(docs: DataFrame, key: str = "doc_id", text: str = "text", runs: bool = True) -> DataFrame:
    """(_row, _lost, _cut): every row, whether it loses words, what is left and what was removed.

    Of rows of equal id and text any one may stand for the first: only other columns tell them apart.
    """
    leaf = cut_lineage(places(docs, key, text))
    lost = cut_lineage(removals(docs, leaf, key, text, runs))
    twice = cut_lineage(leaf.groupBy("id", "print").agg(F.count(F.lit(1)).alias("k")).where("k > 1"))
    twice = None if twice.isEmpty() else twice
    own = _ranked(leaf.select("row", "id", "print"), twice, "id", "print", "row") if twice is not None else None
    own = lost.withColumn("_nth", F.lit(1)) if own is None else lost.join(own.select("row", "_nth"), "row")
    own = own.select(F.col("id").alias("_i"), F.col("print").alias("_q"), F.col("_nth").alias("_m"), "cover", "runs", "firsts", "n_sentences")
    have = docs.select(F.struct("*").alias("_row"), F.col(key).alias("_key"), F.xxhash64(text).alias("_p"))
    # most documents lose nothing: they are not dealt out
    maybe, stay = suspects(have, own.select(F.col("_i").alias("_key"), F.col("_q").alias("_p")), "_key", "_p")
    maybe = _ranked(maybe, twice, "_key", "_p", "_key")
    met = maybe.join(own, same(F.col("_key"), F.col("_i")) & (F.col("_p") == F.col("_q")) & (F.col("_nth") == F.col("_m")), "left")
    kind = "struct<text:string,n_sentences:long,n_removed:long,words_removed:long,removed:array<struct<start:long,length:long>>>"

    @F.pandas_udf(kind)
    def cut(text: pd.Series, cover: pd.Series, runs: pd.Series, n: pd.Series) -> pd.DataFrame:
        out = [
            (None, len(_ends(t or "")), 0, 0, []) if c is None else ((w := without(t, c, r))[0], int(k), *w[1:])
            for t, c, r, k in zip(text, cover, runs, n)
        ]
        return pd.DataFrame(out, columns=["text", "n_sentences", "n_removed", "words_removed", "removed"])

    given = F.col("_row").getField(text)
    lost_some = F.col("cover").isNotNull()
    changed = with_code(met).select("_row", lost_some.alias("_lost"), "firsts", cut(given, "cover", "runs", "n_sentences").alias("_cut"))
    none, nothing = F.lit(None), F.expr("CAST(array() AS array<struct<start:long,length:long>>)")
    as_is = F.struct(
        none.cast("string").alias("text"), n_sentences(given).alias("n_sentences"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("words_removed"), nothing.alias("removed"),
    )
    # texts that lose nothing never leave the JVM
    each = changed.union(stay.select("_row", F.lit(False), none.cast(own.schema["firsts"].dataType), as_is))
    return each.select(
        "_row", "_lost",
        F.struct(
            "_cut.n_sentences", "_cut.n_removed", "_cut.words_removed", "_cut.removed",
            F.coalesce("firsts", F.expr(f"CAST(array() AS array<{docs.schema[key].dataType.simpleString()}>)")).alias("first_doc_ids"),
            F.when(F.col("_lost"), F.col("_cut.text")).otherwise(given).alias("text"),
        ).alias("_cut"),
    )


def cleaned(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: what is left of its text, and what was removed, if anything."""
    return everything(docs, key, text).select(F.col("_row").getField(key).alias(key), "_cut.*")


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, with what is left of their texts."""
    left = lambda c: F.col("_cut.text") if c == text else F.col("_row").getField(c)
    return everything(docs, key, text).select(*[left(c).alias(c) for c in docs.columns])


def rewritten(docs: DataFrame, key: str = "doc_id", text: str = "text", runs: bool = False) -> DataFrame:
    """The documents that lose whole sentences (words, with ``runs``): what is left, and what was removed."""
    return everything(docs, key, text, runs).where("_lost").select(F.col("_row").getField(key).alias(key), "_cut.*")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document; one that loses nothing has its text as it is."""
    return cleaned(documents(spark, sf_dir))
