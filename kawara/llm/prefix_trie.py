"""Prefix trie of conversations as balanced parentheses, shard by shard.

**Paths.** A turn becomes a 16-byte digest of its role and text; texts travel no further. Turns are
numbered by one range sort, so a conversation of any length is split like any other rows. A rebuilt
conversation is cut into segments of ``SEGMENT`` turns; a segment hangs under the digest of all turns
before it, so tries of bounded depth are solved level by level, from the deepest up. Equal segments
are counted together before any trie is built.

**Shards.** The distinct paths of a level are range-partitioned and sorted; a task streams through
them and takes runs of about ``RUN`` turns. A run's trie is one string of parentheses, opened and
closed in depth-first order. Blocks of ``BLOCK`` parentheses keep their least excess, and a tree of
minima above them finds the closing parenthesis of a node (its excess moves in steps of one, so minima
alone settle the search). Between the two lies the subtree: the rank of ``()`` pairs counts leaves,
differences of cumulative arrays give members and savings.

**Spines.** Only nodes on the first and the last path of a run can go on in another run. They leave it
as partial rows, are merged by the digest of their path, and add what only then is known (their own
savings, whether they are leaves, distinct children) to themselves and to the spine nodes above.

Defined results. Rows of NULL conv_id take no part. Turns of equal number are ordered by the MD5 of
role and text (``turn_digest``); equal rows follow each other. NULL role or text is empty. ``c % 5``
has the sign of ``c``. Conversations without turns are members of the root alone. An empty table has
no node. Other columns are ignored. The member lists behind ``ends_sha256`` are sorted and hashed as a
stream: a hash of a list has to see it in order, but never holds it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kawara.llm.common import with_code
from kawara.session import cut_lineage

SEGMENT = 512
RUN = 50_000
BLOCK = 64
FEW = 100_000
STRETCH = 8_192  # ids
NOBODY = hashlib.sha256(b"").hexdigest()
DIGEST = 16


class Parentheses:
    """A balanced string with a tree of least excesses over blocks."""

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1))
        n = -(-len(opens) // BLOCK)
        padded = np.full(n * BLOCK, np.iinfo(np.int64).max)
        padded[: len(opens)] = self.excess
        self.rows = padded.reshape(n, BLOCK)
        self.levels = [self.rows.min(axis=1)]
        while len(self.levels[-1]) > 1:
            low = self.levels[-1]
            if len(low) % 2:
                low = np.append(low, np.iinfo(np.int64).max)
            self.levels.append(low.reshape(-1, 2).min(axis=1))
        self.rank = np.cumsum(opens)

    def _first(self, block: np.ndarray, after: np.ndarray, target: np.ndarray) -> np.ndarray:
        """First place in a block, past ``after``, whose excess is at most the target; -1 without one."""
        out = np.empty(len(block), np.int64)
        for i in range(0, len(block), 1 << 15):
            s = slice(i, i + (1 << 15))
            met = (self.rows[block[s]] <= target[s, None]) & (np.arange(BLOCK) > after[s, None])
            out[s] = np.where(met.any(axis=1), met.argmax(axis=1), -1)
        return out

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """The closing parenthesis of each opening one."""
        target, block = self.excess[at] - 1, at // BLOCK
        inside = self._first(block, at % BLOCK, target)
        far = np.flatnonzero(inside < 0)
        node, level, goal = block[far], np.full(len(far), -1), target[far]
        for h, low in enumerate(self.levels):  # up: the first right neighbour that reaches the target
            rest = np.flatnonzero(level < 0)
            right = node[rest] + 1
            ok = (node[rest] % 2 == 0) & (right < len(low))
            ok[ok] = low[right[ok]] <= goal[rest[ok]]
            node[rest] = np.where(ok, right, node[rest] // 2)
            level[rest[ok]] = h
        for h in range(len(self.levels) - 1, 0, -1):  # down: the left half, unless only the right one reaches it
            here = np.flatnonzero(level == h)
            left = 2 * node[here]
            node[here] = left + (self.levels[h - 1][left] > goal[here])
            level[here] = h - 1
        inside[far] = self._first(node, np.full(len(far), -1), goal)
        block[far] = node
        return block * BLOCK + inside


def _common(roots: np.ndarray, starts: np.ndarray, size: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """How many nodes, the root included, each path shares with the one before it."""
    out = np.zeros(len(roots), np.int64)
    act = np.flatnonzero(roots[1:] == roots[:-1]) + 1
    d = 0
    while len(act):
        out[act] = d + 1
        act = act[(size[act] > d) & (size[act - 1] > d)]
        act = act[(tokens[starts[act] + d] == tokens[starts[act - 1] + d]).all(axis=1)]
        d += 1
    return out


def _parents(depth: np.ndarray) -> np.ndarray:
    """The node above each one, from depths in preorder; -1 for roots."""
    out = np.full(len(depth), -1, np.int64)
    order = np.argsort(depth, kind="stable")
    edges = np.searchsorted(depth[order], np.arange(depth.max() + 2))
    for d in range(1, int(depth.max()) + 1):
        upper, own = order[edges[d - 1] : edges[d]], order[edges[d] : edges[d + 1]]
        out[own] = upper[np.searchsorted(upper, own) - 1]
    return out


COLUMNS = (
    "root string, key string, parent string, above array<string>, depth long, conv_id long, parent_conv_id long,"
    " n_convs long, n_children long, n_leaves long, saved long, size long, ends string, settled boolean"
)


def nodes_of_run(run: pd.DataFrame) -> pd.DataFrame:
    """The nodes of sorted distinct paths; those on the first and last path carry a key and are partial.

    In a partial row, members, children, leaves and savings count what other nodes of the run hold.
    """
    roots, paths = run["root"].to_numpy(object), run["path"].to_list()
    size = np.array([len(p) // DIGEST for p in paths])
    starts = np.concatenate([[0], np.cumsum(size)])[:-1]
    tokens = np.frombuffer(b"".join(map(bytes, paths)), ">u8").reshape(-1, 2)
    lengths = np.concatenate([np.asarray(s, np.int64) for s in run["sizes"]])
    common = _common(roots, starts, size, tokens)
    new = size + 1 - common
    closes = np.concatenate([[0], (size + 1)[:-1] - common[1:], [size[-1] + 1]])
    counts = np.empty(2 * len(run) + 1, np.int64)
    counts[0::2], counts[1::2] = closes, new
    tree = Parentheses(np.repeat(np.arange(len(counts)) % 2 == 1, counts))

    at = np.flatnonzero(tree.opens)
    n = len(at)
    depth = tree.excess[at] - 1
    close = tree.findclose(at)
    stop = tree.rank[close]  # the subtree of node i is i .. stop[i] - 1 in preorder
    of = np.repeat(np.arange(len(run)), new)
    tip = np.cumsum(new) - 1
    own_size = np.zeros(n, np.int64)
    deep = depth > 0
    own_size[deep] = lengths[(starts[of] + depth - 1)[deep]]
    parent = _parents(depth)

    def at_tips(values, empty=0) -> np.ndarray:
        out = np.full(n, empty, np.int64)
        out[tip] = values
        return out

    def within(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[stop] - total[np.arange(n)]

    spine = np.zeros(n, bool)
    spine[: size[0] + 1] = True
    i = tip[-1]
    while i >= 0:
        spine[i] = True
        i = parent[i]

    n_convs = within(at_tips(run["m"]))
    big = np.iinfo(np.int64).max
    least = np.append(at_tips(run["lo"], big), big)
    conv = np.minimum.reduceat(least, np.stack([np.arange(n), stop], axis=1).ravel())[::2]
    below = run["below"].to_numpy(bool)  # the path goes on in the next level, whose sums it has
    going = at_tips(below).astype(bool)
    pairs = ~tree.opens[np.minimum(at + 1, len(tree.opens) - 1)]  # "()"
    leaves = within(np.where(going | spine, 0, pairs) + at_tips(run["b_leaves"]))
    saved = within(np.where(spine, 0, (n_convs - 1) * own_size) + at_tips(run["b_saved"]))
    inner = (parent >= 0) & ~spine
    children = np.bincount(parent[inner], minlength=n) + at_tips(run["b_children"])

    ends = np.full(n, None, object)
    ends[tip] = run["ends"].to_numpy(object)
    key, above = np.full(n, None, object), np.full(n, None, object)
    for i in np.flatnonzero(spine):
        p = of[i]
        key[i] = hashlib.md5(roots[p].encode() + b"/" + paths[p][: DIGEST * depth[i]]).hexdigest()
        above[i] = [] if parent[i] < 0 else above[parent[i]] + [key[parent[i]]]
    has = parent >= 0
    return pd.DataFrame(
        {
            "root": np.where(deep, None, roots[of]),
            "key": key,
            "parent": np.where(has, key[parent], None),
            "above": above,
            "depth": depth,
            "conv_id": conv,
            "parent_conv_id": pd.Series(pd.arrays.IntegerArray(np.where(has, conv[parent], 0), ~has)),
            "n_convs": n_convs,
            "n_children": children,
            "n_leaves": leaves,
            "saved": saved,
            "size": own_size,
            "ends": ends,
            "settled": going,
        }
    )


def _runs(run: int):
    def tries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, turns = [], 0
        for b in batches:
            full = (turns + np.cumsum(b["sizes"].map(len).to_numpy(np.int64))) // run  # a run ends where this steps up
            cuts = (np.flatnonzero(np.diff(full, prepend=turns // run)) + 1).tolist()
            for i, j in zip([0, *cuts], cuts):
                yield nodes_of_run(pd.concat([*held, b.iloc[i:j]], ignore_index=True))
                held = []
            held.append(b.iloc[cuts[-1] if cuts else 0 :])
            turns += int(b["sizes"].map(len).sum())
        if sum(map(len, held)):
            yield nodes_of_run(pd.concat(held, ignore_index=True))

    return tries


def turn_digest(role: Column, text: Column) -> Column:
    """MD5 of a turn in hexadecimal; the length of the role keeps the two parts apart."""
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))


def numbered(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(c, part, at, token, size): the turns in order; ``at`` counts on within each ``part`` of the sort."""
    r, t = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in (role, text))
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("c"), F.col(turn).alias("turn"), turn_digest(r, t).alias("token"), F.octet_length(t).cast("long").alias("size")
    )
    rows = cut_lineage(rows).withColumn("row", F.monotonically_increasing_id())  # tells equal rows apart
    order = [F.col("c"), F.col("turn").asc_nulls_first(), F.col("token"), F.col("row")]
    rows = cut_lineage(rows.repartitionByRange(*order).sortWithinPartitions(*order))
    return rows.select("c", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"), "token", "size")


def rebuilt(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The turns (c, length, depth, token, size) and the list (c, length) of the rebuilt conversations."""
    rows = numbered(turns, conv, turn, role, text)
    part = rows.groupBy("c", "part").agg(F.min("at").alias("begin"), F.count(F.lit(1)).alias("k"))
    along = W.partitionBy("c").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    part = cut_lineage(part.withColumn("first", F.coalesce(F.sum("k").over(along), F.lit(0))))
    convs = part.groupBy("c").agg(F.sum("k").alias("n"))
    h = (F.crc32(F.col("c").cast("string").cast("binary")) % 9).alias("h")
    own = convs.select("c", "n", h, (F.col("c") - F.col("c") % 5).alias("base"))
    have = convs.select(F.col("c").alias("base"), F.col("n").alias("n_base"))
    convs = own.join(have, "base", "left").withColumn("k", F.least("h", F.coalesce("n_base", F.lit(0)))).select(
        "c", "base", "h", "k", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")
    )
    convs = cut_lineage(convs)
    placed = rows.join(part.drop("k").join(convs, "c"), ["c", "part"]).withColumn("i", F.col("at") - F.col("begin") + F.col("first"))
    after = placed.where("i >= h").select("c", "length", (F.col("i") - F.col("h") + F.col("k") + 1).alias("depth"), "token", "size")
    heads = placed.where("c % 5 = 0 AND i < 8").select(F.col("c").alias("base"), "i", "token", "size")
    before = heads.join(convs.where("k > 0"), "base").where("i < k").select("c", "length", (F.col("i") + 1).alias("depth"), "token", "size")
    return after.unionByName(before), convs.select("c", "length")


def segments(turns: DataFrame, convs: DataFrame, segment: int) -> tuple[DataFrame, int]:
    """(level, root, path, sizes, c, last) of every conversation, and the deepest level."""
    own = F.struct("depth", "token", "size")
    cut = turns.groupBy("c", "length", F.floor((F.col("depth") - 1) / segment).alias("level")).agg(F.sort_array(F.collect_list(own)).alias("t"))
    cut = cut.select("c", "length", "level", F.unhex(F.array_join("t.token", "")).alias("path"), F.col("t.size").alias("sizes"))
    # one that ends on a border, or has no turn, ends at the root of the next level
    empty = convs.where(F.col("length") % segment == 0).select(
        "c", "length", F.floor(F.col("length") / segment).alias("level"), F.unhex(F.lit("")).alias("path"), F.expr("CAST(array() AS array<long>)").alias("sizes")
    )
    rows = cut_lineage(cut.unionByName(empty))
    deepest = rows.agg(F.max("level")).first()[0]
    if not deepest:
        rows = rows.withColumn("root", F.lit(""))
    else:
        upto = W.partitionBy("c").orderBy("level").rowsBetween(W.unboundedPreceding, -1)
        earlier = F.collect_list(F.md5("path")).over(upto)
        rows = cut_lineage(rows.withColumn("root", F.aggregate(earlier, F.lit(""), lambda a, x: F.md5(F.concat(a, x)))))
    last = F.col("level") == F.floor(F.col("length") / segment)
    return rows.select("level", "root", "path", "sizes", "c", last.alias("last")), deepest or 0


def _lists(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted ids as comma-joined stretches, each with its first id."""
    for b in batches:
        out = []
        for end, ids in b.groupby("end", sort=False)["c"]:
            own = ids.to_numpy()
            out += [(end, own[i], ",".join(map(str, own[i : i + STRETCH].tolist()))) for i in range(0, len(own), STRETCH)]
        yield pd.DataFrame(out, columns=["end", "first", "ids"])


def _hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 over the stretches of each path, read as a stream."""
    path, h = None, None
    for b in batches:
        out = []
        for p, ids in zip(b["end"], b["ids"]):
            if p != path:
                if path is not None:
                    out.append((path, h.hexdigest()))
                path, h = p, hashlib.sha256(ids.encode())
            else:
                h.update(f",{ids}".encode())
        yield pd.DataFrame(out, columns=["end", "sha"])
    if path is not None:
        yield pd.DataFrame([(path, h.hexdigest())], columns=["end", "sha"])


def distinct_paths(rows: DataFrame) -> DataFrame:
    """(level, root, path, sizes, m, lo, ends): equal segments as one, with the hash of those that end there."""
    ended = F.when(F.col("last"), F.col("c"))
    paths = rows.groupBy("level", "root", "path").agg(
        F.first("sizes").alias("sizes"), F.count(F.lit(1)).alias("m"), F.min("c").alias("lo"), F.count(ended).alias("n_ends"), F.min(ended).alias("only")
    )
    paths = cut_lineage(paths.withColumn("end", F.md5(F.concat(F.col("level").cast("string"), F.lit("/"), "root", F.hex("path")))))
    many = paths.where("n_ends > 1").select("level", "root", "path", "end")
    ids = rows.where("last").join(many, ["level", "root", "path"]).select("end", "c")
    # the ids of a path that very many share are put in order by many tasks; one reads what they joined
    lists = with_code(ids.repartitionByRange("end", "c").sortWithinPartitions("end", "c")).mapInPandas(_lists, "end string, first long, ids string")
    shas = lists.repartition("end").sortWithinPartitions("end", "first").mapInPandas(_hashes, "end string, sha string")
    one = F.when(F.col("n_ends") == 1, F.sha2(F.col("only").cast("string"), 256))
    return cut_lineage(paths.join(shas, "end", "left").select("level", "root", "path", "sizes", "m", "lo", F.coalesce("sha", one).alias("ends")))


def _level(paths: DataFrame, below: DataFrame | None, run: int) -> DataFrame:
    """The nodes of one level, whole; depth 0 are its roots."""
    if below is None:
        zero = F.lit(0).cast("long")
        paths = paths.select("*", F.lit(False).alias("below"), zero.alias("b_children"), zero.alias("b_leaves"), zero.alias("b_saved"))
    else:
        paths = paths.withColumn("next", F.md5(F.concat("root", F.md5("path")))).join(below, "next", "left")
        sums = [F.coalesce(c, F.lit(0)).alias(c) for c in ("b_children", "b_leaves", "b_saved")]
        ends = F.coalesce("ends", "b_ends").alias("ends")
        paths = paths.select("root", "path", "sizes", "m", "lo", ends, F.col("b_leaves").isNotNull().alias("below"), *sums)
    shards = paths.select("root", "path", "sizes", "m", "lo", "ends", "below", "b_children", "b_leaves", "b_saved")
    shards = shards.repartitionByRange("root", "path").sortWithinPartitions("root", "path")
    found = cut_lineage(with_code(shards).mapInPandas(_runs(run), COLUMNS))

    spines = found.where("key IS NOT NULL").groupBy("key").agg(
        *[F.first(c).alias(c) for c in ("root", "parent", "above", "depth", "size")],
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
        F.max("ends").alias("ends"), F.max("settled").alias("settled"),
    )
    spines = cut_lineage(spines)
    met = spines.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("more"))
    spines = spines.join(met, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    leaf = ((F.col("n_children") == 0) & ~F.col("settled")).cast("long")
    gives = spines.select(
        F.explode(F.array_append("above", F.col("key"))).alias("key"), leaf.alias("l"), ((F.col("n_convs") - 1) * F.col("size")).alias("s")
    )
    gains = gives.groupBy("key").agg(F.sum("l").alias("l"), F.sum("s").alias("s"))
    spines = spines.join(gains, "key").withColumns({"n_leaves": F.col("n_leaves") + F.col("l"), "saved": F.col("saved") + F.col("s")})
    spines = cut_lineage(spines.drop("more", "l", "s", "above"))

    names = ["root", "parent", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    rows = spines.withColumn("parent_conv_id", F.lit(None).cast("long")).select(names)
    rows = rows.unionByName(found.where("key IS NULL").select(names))
    known, hung = rows.where("parent IS NULL"), rows.where("parent IS NOT NULL").drop("parent_conv_id")
    upper = spines.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    if upper.limit(FEW + 1).count() <= FEW:  # a spine of the trie; its size is counted
        hung = hung.join(F.broadcast(upper), "parent")
    else:  # a root may have most rows under it: they are dealt over copies of it
        deal = upper.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(63))))
        hung = hung.withColumn("salt", F.pmod(F.xxhash64("conv_id"), F.lit(64)).cast("int")).join(deal, ["parent", "salt"]).drop("salt")
    return known.unionByName(hung).drop("parent")


def nodes(turns: DataFrame, segment: int = SEGMENT, run: int = RUN, **columns) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations."""
    rows, deepest = segments(*rebuilt(turns, **columns), segment)
    paths = distinct_paths(rows)
    found, below = [], None
    for level in range(deepest, -1, -1):
        own = _level(paths.where(F.col("level") == level), below, run)
        if level:
            own = cut_lineage(own)
            below = own.where("depth = 0").select(
                F.col("root").alias("next"), F.col("n_children").alias("b_children"), F.col("n_leaves").alias("b_leaves"),
                F.col("saved").alias("b_saved"), F.col("ends").alias("b_ends"),
            )
            own = own.where("depth > 0")
        found.append(own.withColumn("depth", F.col("depth") + level * segment))
    return reduce(DataFrame.unionByName, found).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NOBODY)).alias("ends_sha256"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


SQL = """
WITH t AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
),
l AS (
  SELECT c, list({'k': md5(concat(octet_length(encode(role)), ':', role, text)), 'b': octet_length(encode(text))}
              ORDER BY turn NULLS FIRST, md5(concat(octet_length(encode(role)), ':', role, text))) AS own
  FROM t GROUP BY c
),
h AS (
  SELECT c, own, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) % 9 AS h
  FROM l
),
r AS (
  SELECT h.c, list_concat(coalesce(b.own, [])[1:h.h], h.own[h.h + 1:]) AS path
  FROM h LEFT JOIN l b ON b.c = h.c - h.c % 5
),
p AS (
  SELECT c, len(path) AS n, d, md5(array_to_string(list_transform(path[1:d], lambda x: x.k), '')) AS key,
         CASE WHEN d > 0 THEN md5(array_to_string(list_transform(path[1:d - 1], lambda x: x.k), '')) END AS up,
         CASE WHEN d > 0 THEN path[d].b ELSE 0 END AS b
  FROM (SELECT c, path, unnest(range(0, len(path) + 1)) AS d FROM r)
),
n AS (
  SELECT d, key, any_value(up) AS up, any_value(b) AS b, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (n = d), '')) AS ends
  FROM p GROUP BY d, key
),
k AS (SELECT d - 1 AS d, up AS key, count(*) AS k FROM n WHERE d > 0 GROUP BY ALL),
w AS (SELECT n.*, coalesce(k.k, 0) AS k, q.conv_id AS pc
      FROM n LEFT JOIN k USING (d, key) LEFT JOIN n q ON q.d = n.d - 1 AND q.key = n.up),
s AS (
  SELECT a.d, a.key, count(*) FILTER (w.k = 0) AS leaves, sum((w.n_convs - 1) * w.b) AS saved
  FROM w JOIN p x ON x.c = w.conv_id AND x.d = w.d JOIN p a ON a.c = w.conv_id AND a.d <= w.d
  GROUP BY a.d, a.key
)
SELECT w.conv_id, w.d AS depth, w.pc AS parent_conv_id, w.n_convs, w.k AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, w.ends AS ends_sha256
FROM w JOIN s USING (d, key)
"""
