"""Exact dedup, sharding and mixing against plain Python."""

import hashlib
import struct
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

from kawara.llm import exact_dedup, mixing, sharding


def ascii_lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def test_exact_dedup_on_awkward_rows(spark, docs, awkward):
    df = docs(awkward)
    got = exact_dedup.assign(df.repartition(5)).collect()
    groups = defaultdict(list)
    for i, t, *_ in awkward:
        groups[ascii_lower(t)].append(i)
    best = {t: max(ids, key=lambda i: -1 if i is None else i) for t, ids in groups.items()}
    want = Counter(
        (i, best[ascii_lower(t)], len(groups[ascii_lower(t)]), hashlib.sha256(ascii_lower(t).encode()).hexdigest())
        for i, t, *_ in awkward
    )
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    left = exact_dedup.deduplicate(df)
    assert left.columns == df.columns
    assert Counter(ascii_lower(r.text) for r in left.collect()) == Counter(groups.keys())
    assert {r.doc_id for r in left.collect()} == set(best.values())


def test_exact_dedup_of_many_runs_and_one_hot_group(spark, docs):
    rows = [(i, "Hot" if i % 3 == 0 else f"t{i % 50}") for i in range(600)]
    got = exact_dedup.assign(docs(rows).repartition(40)).collect()
    want = defaultdict(list)
    for i, t in rows:
        want[t].append(i)
    assert all(r.keep_id == max(want[rows[r.doc_id][1]]) and r.group_size == len(want[rows[r.doc_id][1]]) for r in got)
    smallest = exact_dedup.assign(docs(rows).repartition(40), largest=False).collect()
    assert all(r.keep_id == min(want[rows[r.doc_id][1]]) for r in smallest)


@pytest.mark.parametrize("run", [exact_dedup.assign, exact_dedup.deduplicate, sharding.assign, mixing.copies, mixing.mixed])
def test_empty_table(docs, run):
    assert run(docs([])).count() == 0


def rendezvous(key, shards):
    import math

    text = "\0null" if key is None else str(key)
    scores = []
    for s in range(shards):
        h = xxhash.xxh64_intdigest(text.encode(), seed=42)
        h = xxhash.xxh64_intdigest(struct.pack("<i", s), seed=h)
        scores.append((-math.log(((h >> 12) + 0.5) / 2**52), s))
    return min(scores)[1]


def test_sharding_follows_the_key_alone(docs, awkward):
    rows = awkward + [(i, f"t{i}") for i in range(100, 900)] + [(77, "again")] * 300
    got = sharding.assign(docs(rows).repartition(7)).collect()
    assert len(got) == len(rows)
    want = Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), rendezvous(i, 16), rendezvous(i, 17))
        for i, t, *_ in rows
    )
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in got) == want
    assert all(r.grown_shard in (r.shard, 16) and r.law == "key" for r in got)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_slots_over_many_chunks_and_folded_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(sharding, "UNFOLD", 4)
    rows = spark.createDataFrame([(i % 40, i % 2) for i in range(500)], "k long, shard int")
    got = sharding.with_slots(rows, "shard", "k", chunk_rows=2).collect()
    for s in (0, 1):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(250))


def test_sharding_by_weight(spark):
    df = spark.range(20_000).select(sharding.shard_of(sharding.F.col("id"), [1.0, 2.0, 1.0]).alias("s"))
    n = {r.s: r["count"] for r in df.groupBy("s").count().collect()}
    assert abs(n[1] - 10_000) < 400 and abs(n[0] - 5_000) < 400
    with pytest.raises(ValueError):
        sharding.shard_of(sharding.F.col("id"), [1.0, 0.0])


def fill(totals, weights, share=1.5, cap=2.0):
    """Resharing round by round, as the rule is worded."""
    goal, out, free = share * sum(totals), [0.0] * len(totals), set(range(len(totals)))
    while free:
        rest = goal - sum(out[i] for i in range(len(totals)) if i not in free)
        level = rest / sum(weights[i] for i in free)
        over = {i for i in free if weights[i] * level > cap * totals[i]}
        for i in free:
            out[i] = cap * totals[i] if i in over else weights[i] * level
        free -= over
        if not over:
            break
    return out


def test_mixing_meets_targets_and_reruns_agree(docs):
    rows = []
    for s, name in enumerate(["b", "a", "é", None, "zero", "c", "d"]):
        for i in range(120 if s < 6 else 900):
            n = 0 if name == "zero" else 1 + (i * 7919 + s * 31) % (300 if s % 2 else 40)
            rows.append((s * 1000 + i, None if n == 0 else "w " * n, name))
    a = mixing.copies(docs(rows)).collect()
    b = mixing.copies(docs(rows[::-1]).repartition(6)).collect()
    assert Counter((r._id, r._copies) for r in a) == Counter((r._id, r._copies) for r in b)
    by = defaultdict(list)
    for r in a:
        by[r._source].append(r)
    order = sorted((n for n in by if n is not None), key=lambda n: n.encode()) + [None]
    totals = [sum(r._size for r in by[n]) for n in order]
    want = fill(totals, [(5, 2, 1)[i % 3] for i in range(len(order))])
    for n, total, target in zip(order, totals, want):
        assert all(r._total == total and r._target == pytest.approx(target, rel=1e-9) for r in by[n])
        assert all(0 <= r._copies <= 2 for r in by[n])
        assert abs(sum(r._copies * r._size for r in by[n]) - target) <= 400, n


def test_mixing_rates_are_exponential_tilts(docs):
    rows = [(i, "w " * (1 + i % 100), "big" if i % 2 else "tiny") for i in range(4000)]
    df = docs(rows)
    hist = mixing.sizes(df, "doc_id", "source", "text").groupBy("_source", "_size").agg(mixing.F.count("*").alias("_n"))
    goal = mixing.targets(hist)
    for r in mixing.tilts(hist, goal).collect():
        import math

        sizes = [1 + i % 100 for i, _, s in rows if s == r._source]
        met = sum(z * min(2.0, math.exp(r["_lambda"] * z / r._mean)) for z in sizes)
        assert met == pytest.approx(r._target, rel=1e-8)


def test_mixing_awkward_rows(docs, awkward):
    got = mixing.copies(docs(awkward)).collect()
    assert len(got) == len(awkward) and all(r._copies is not None for r in got)
    df = docs(awkward)
    assert mixing.mixed(df).columns == df.columns


def test_mixing_of_one_id_with_many_texts_meets_targets(docs):
    """Rows of one id, NULL included, are taken each by its own size and source."""
    rows = [(None if i % 2 else 7, f"{'w ' * (1 + i % 90)}x{i}", "a") for i in range(600)]
    rows += [(7, f"{'w ' * (1 + i % 30)}y{i}", "b") for i in range(900)] + [(8, "same same same", "c")] * 500 + [(None, "same same", None)] * 300
    df = docs(rows)
    goal = {r._source: r._target for r in mixing.copies(df).select("_source", "_target").distinct().collect()}
    assert mixing.copies(df).count() == len(rows)
    assert {sum(1 for r in rows if r[2] == s) > 0 for s in goal} == {True}
    out = mixing.mixed(df)
    assert out.columns == df.columns
    taken, have = Counter(), Counter((r[0], r[1], r[2]) for r in rows)
    for r in out.collect():
        taken[r.source] += len(r.text.split())
        have[(r.doc_id, r.text, r.source)] -= 0.5
    assert all(n >= 0 for n in have.values())  # none more than twice
    assert all(abs(taken[s] - goal[s]) <= 100 for s in goal), (taken, goal)


CLASHING = ["_id", "_copies", "_sha", "_print", "_gone", "_row", "_copy", "row", "id", "print", "repeat", "a.b", "__h", "__in", "_i", "_p"]


@pytest.mark.parametrize("name", ["exact", "near", "mixed", "spans"])
def test_columns_of_any_name_stay(docs, awkward, name):
    from kawara.llm import near_dedup, substring_dedup

    run = {"exact": exact_dedup.deduplicate, "near": near_dedup.deduplicate, "mixed": mixing.mixed, "spans": substring_dedup.deduplicate}[name]
    long = " ".join(f"word{i} goes here." for i in range(40))
    df = docs(awkward + [(20, long), (21, long), (22, f"{long} more of it")])
    df = df.selectExpr("*", *[f"concat('{n}', doc_id) AS `{n}`" for n in CLASHING if n not in df.columns])
    out = run(df)
    assert out.columns == df.columns
    rows = out.collect()
    assert len(rows) >= 8
    for r in rows:
        if r["doc_id"] is not None:
            assert all(r[n] == f"{n}{r['doc_id']}" for n in CLASHING if n not in ("row",))


def test_one_key_with_many_texts_gets_gapless_slots(spark):
    rows = spark.range(3000).selectExpr("CAST(NULL AS STRING) AS k", "id % 1000 AS size", "0 AS shard")
    got = sharding.with_slots(rows, "shard", "k", chunk_rows=4).collect()
    assert sorted(r.slot for r in got) == list(range(3000))
    # the chunks are cut by all columns: neighbours in one chunk are few of the thousand sizes
    first = [r.size for r in sorted(got, key=lambda r: r.slot)[:300]]
    assert first != sorted(first)
