"""Mixing sources to target token counts by entropy balancing.

A document of ``x`` (its size over the mean size of its source) is taken at the rate
``min(cap, exp(lambda_s * x))``: the rates closest in relative entropy to taking every document
once that meet the token target of each source. ``lambda_s`` maximises a concave dual; Newton
steps, safeguarded by a bracket, solve it for all sources at once. Rates depend on source and
size only, so the iterations run over the table of (source, size, count), which is aggregated
once; each of them is one grouped sum. Sums are decimal, hence free of order: reruns agree.

Rates become copies by systematic rounding: documents are laid out by source, size and a hash of
id and row, each as long as its rate, and a document is taken as often as the marks at whole
numbers fall into its stretch. The rounding error of a source is about the size of one document.
Stretches are first summed over cells of (source, size, bucket); only cells are put in order per
source, and documents only within their cell, so no task holds all documents of a source.

Defined results. NULL text has size 0; documents of size 0 are taken once and add nothing. NULL
sources are a source of their own, last in order. An empty table gives an empty result. Repeated
rows are rounded one by one, rows of one id by their own source and size. Only id, source, size and
a hash of the row are moved, never texts, until rows are taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kawara.llm.common import documents, row_hash, same, words_in
from kawara.session import cut_lineage

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2.0
TOLERANCE = 1e-9
CELL_ROWS = 1_024
UNFOLD = 4_096
UNIT = 1 << 24  # rates are rounded to this fraction, so that running sums are exact


def sizes(docs: DataFrame, key: str, source: str, text: str) -> DataFrame:
    """(id, source, size, print, m): rows equal in all columns as one, ``m`` of them."""
    rows = docs.select(
        F.col(key).alias("_id"), F.col(source).alias("_source"), words_in(F.col(text)).alias("_size"), row_hash(docs).alias("_print")
    )
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_m"))


def targets(hist: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, total, target): shares by weight, none above ``cap`` times its source.

    The rounds of resharing end where every source has ``min(cap * total, weight * level)`` for
    one level; the level follows from a running sum over sources ordered by the level at which
    they reach their bound. One row per source is put in order here, nothing else.
    """
    total = hist.groupBy("_source").agg(F.sum(F.col("_size") * F.col("_n")).cast("long").alias("_total"))
    rank = F.row_number().over(W.orderBy(F.col("_source").asc_nulls_last())) - 1
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    rows = total.withColumn("_w", pick).withColumn("_bound", F.col("_total") * cap)
    rows = rows.withColumn("_full_at", F.col("_bound") / F.col("_w"))
    everything = W.partitionBy()
    upto = W.orderBy("_full_at", F.col("_source").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumns(
        {
            "_goal": F.sum("_total").over(everything) * share,
            "_place": F.row_number().over(W.orderBy("_full_at", F.col("_source").asc_nulls_first())),
            "_bounded": F.coalesce(F.sum("_bound").over(upto), F.lit(0.0)),
            "_free": F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(upto), F.lit(0.0)),
        }
    )
    level = (F.col("_goal") - F.col("_bounded")) / F.col("_free")
    fits = F.when(level <= F.col("_full_at"), F.struct("_place", level.alias("level")))  # the first that is not bounded
    rows = rows.withColumn("_level", F.min(fits).over(everything).getField("level"))
    target = F.least(F.col("_bound"), F.col("_w") * F.coalesce(F.col("_level"), F.lit(float("inf"))))
    return rows.select("_source", "_total", target.alias("_target"))


def _exact(c):
    """Doubles as decimals: their sum does not depend on the order of the rows."""
    return F.sum(c.cast("decimal(38,12)")).cast("double")


def tilts(hist: DataFrame, goal: DataFrame, cap: float = CAP, tolerance: float = TOLERANCE) -> DataFrame:
    """(source, total, target, mean, lambda) that meets every target, by Newton steps."""
    mean = hist.groupBy("_source").agg((F.sum(F.col("_size") * F.col("_n")) / F.sum("_n")).alias("_mean"))
    state = goal.where("_total > 0").join(mean, same(goal["_source"], mean["_source"])).select(
        goal["_source"], "_total", "_target", "_mean"
    )
    ratio = F.col("_target") / F.col("_total")
    # rates of 1 lie above every target below the total, and Newton falls to the root from there;
    # above it the root lies between rates of 1 and the rate at which the smallest size is capped
    state = state.withColumns(
        {
            "_lo": F.when(ratio >= 1, F.lit(0.0)).otherwise(F.lit(float("-inf"))),
            "_hi": F.when(ratio >= 1, F.log(F.lit(cap)) * F.col("_mean")).otherwise(F.lit(0.0)),
            "_lambda": F.when(ratio >= cap, F.log(F.lit(cap)) * F.col("_mean"))
            .when(ratio >= 1, F.log(ratio))
            .otherwise(F.lit(0.0)),
            "_done": F.lit(False),
        }
    )
    columns = state.columns
    state = cut_lineage(state)
    while True:
        at = hist.join(state.select(F.col("_source").alias("_s"), "_mean", "_lambda"), same(F.col("_source"), F.col("_s")))
        x = F.col("_size") / F.col("_mean")
        rate = F.least(F.exp(F.col("_lambda") * x), F.lit(cap))
        slope = F.when(rate < cap, rate * x).otherwise(F.lit(0.0))
        sums = at.groupBy("_source").agg(
            _exact(F.col("_n") * F.col("_size") * rate).alias("_value"),
            _exact(F.col("_n") * F.col("_size") * slope).alias("_slope"),
        )
        sums = sums.withColumnRenamed("_source", "_s")
        now = state.join(sums, same(F.col("_source"), F.col("_s")))
        above = F.col("_value") > F.col("_target")
        lo = F.when(above, F.col("_lo")).otherwise(F.col("_lambda"))
        hi = F.when(above, F.col("_lambda")).otherwise(F.col("_hi"))
        # on the logarithm of the sum, which is convex below 0: fast even far from the root
        step = F.col("_lambda") - F.log(F.col("_value") / F.col("_target")) * F.col("_value") / F.col("_slope")
        middle = (lo + hi) / 2
        good = F.col("_slope").isNotNull() & (F.col("_slope") > 0) & (step > lo) & (step < hi)
        after = F.when(good, step).otherwise(middle)
        close = F.abs(F.col("_value") - F.col("_target")) <= F.col("_target") * tolerance
        narrow = (hi - lo) <= F.lit(1e-13) * F.greatest(F.lit(1.0), F.abs(hi))
        done = F.col("_done") | close | narrow
        state = cut_lineage(
            now.select(
                "_source", "_total", "_target", "_mean",
                lo.alias("_lo"), hi.alias("_hi"),
                F.when(done, F.col("_lambda")).otherwise(after).alias("_lambda"),
                done.alias("_done"),
            ).select(*columns)
        )
        if state.where("NOT _done").isEmpty():
            return state.select("_source", "_total", "_target", "_mean", "_lambda")


def laid(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights=WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
) -> DataFrame:
    """(id, source, size, print, m, total, target, rate, begin): where the stretches of equal rows begin."""
    rows = cut_lineage(sizes(docs, key, source, text))
    hist = cut_lineage(rows.groupBy("_source", "_size").agg(F.sum("_m").alias("_n")))
    goal = cut_lineage(targets(hist, weights, share, cap))
    tilt = tilts(hist, goal, cap)
    rate = F.least(F.exp(F.col("_lambda") * F.col("_size") / F.col("_mean")), F.lit(cap))
    t = tilt.select(F.col("_source").alias("_s"), "_mean", "_lambda")
    known = goal.join(t, same(F.col("_source"), F.col("_s")), "left").select(
        F.col("_source").alias("_s"), "_total", "_target", "_mean", "_lambda"
    )
    cells = hist.join(known, same(F.col("_source"), F.col("_s"))).select(
        "_s", F.col("_size").alias("_z"), "_total", "_target",
        F.coalesce(F.round(rate * UNIT), F.lit(UNIT)).cast("long").alias("_rate"),
        F.expr(f"int((_n - 1) div {CELL_ROWS}) + 1").alias("_parts"),
    )
    at = same(F.col("_source"), F.col("_s")) & (F.col("_size") == F.col("_z"))
    dealt = rows.join(cut_lineage(cells), at).select(
        *rows.columns, "_total", "_target", "_rate", F.pmod(F.xxhash64("_id", "_print", F.lit("cell")), F.col("_parts")).alias("_part")
    )
    dealt = cut_lineage(dealt)
    count = dealt.groupBy("_source", "_size", "_part").agg(F.sum("_m").alias("_n"), F.first("_rate").alias("_r"))
    along = W.partitionBy("_source").orderBy("_size", "_part")
    begin = count.select(
        F.col("_source").alias("_s"), F.col("_size").alias("_z"), F.col("_part").alias("_p"),
        (F.sum(F.col("_n") * F.col("_r")).over(along) - F.col("_n") * F.col("_r")).alias("_begin"),
    )
    inside = W.partitionBy("_source", "_size", "_part").orderBy(F.xxhash64("_id", "_print", F.lit("order")), "_id", "_print")
    ranked = dealt.withColumn("_before", F.sum("_m").over(inside) - F.col("_m"))
    joined = ranked.join(
        begin, same(F.col("_source"), F.col("_s")) & (F.col("_size") == F.col("_z")) & (F.col("_part") == F.col("_p"))
    )
    left = F.col("_begin") + F.col("_before") * F.col("_rate") + UNIT // 2
    return joined.select(*rows.columns, "_total", "_target", "_rate", left.alias("_begin"))


def _taken(begin, end):
    """Whole numbers that fall into a stretch."""
    return (F.floor(end / UNIT) - F.floor(begin / UNIT)).cast("long")


def copies(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """(_id, _source, _size, _total, _target, _copies) of every row."""
    each = laid(docs, key, **options)
    # equal rows in blocks, then one by one
    blocks = each.withColumn("_b", F.explode(F.expr(f"sequence(0L, (_m - 1) div {UNFOLD})")))
    rows = blocks.withColumn("_i", F.explode(F.expr(f"sequence(_b * {UNFOLD}, least((_b + 1) * {UNFOLD}, _m) - 1)")))
    begin = F.col("_begin") + F.col("_i") * F.col("_rate")
    return rows.select("_id", "_source", "_size", "_total", "_target", _taken(begin, begin + F.col("_rate")).alias("_copies"))


def mixed(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; rows taken 0 times are absent.

    Rows equal in all columns share their copies. Rows are found again by id and a hash of all columns.
    """
    stretch = laid(docs, key, **options)
    n = stretch.select(
        F.col("_id").alias("_i"), F.col("_print").alias("_p"), "_m", _taken(F.col("_begin"), F.col("_begin") + F.col("_m") * F.col("_rate")).alias("_copies")
    ).where("_copies > 0")
    rows = docs.select(F.struct("*").alias("_row"), F.col(key).alias("_id"), row_hash(docs).alias("_print"))
    met = rows.join(n, same(F.col("_id"), F.col("_i")) & (F.col("_print") == F.col("_p")))
    again = met.where("_m > 1").groupBy("_i", "_p").agg(F.first("_row").alias("_row"), F.first("_copies").alias("_copies"))
    out = met.where("_m = 1").select("_row", "_copies").unionByName(again.select("_row", "_copies"))
    blocks = out.withColumn("_b", F.explode(F.expr(f"sequence(0L, (_copies - 1) div {UNFOLD})")))
    return blocks.select("_row", F.explode(F.expr(f"sequence(_b * {UNFOLD}, least((_b + 1) * {UNFOLD}, _copies) - 1)"))).select("_row.*")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies(documents(spark, sf_dir)).select(
        F.col("_id").alias("doc_id"),
        F.col("_size").alias("size"),
        F.col("_total").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_copies") * F.col("_size")).alias("taken"),
        F.col("_source").alias("source"),
        F.col("_copies").alias("copies"),
    )
