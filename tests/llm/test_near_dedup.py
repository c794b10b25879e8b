"""Near duplicates against all pairs in plain Python."""

import os
import random
import re

import numpy as np
import pytest

from kawara.llm import near_dedup, shingles
from kawara.llm.common import documents

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def shingle_set(t, k=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute(rows, percent=85):
    sets = [shingle_set(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    root[find(i)] = find(j)
    comp = {}
    for i, r in enumerate(rows):
        comp.setdefault(find(i), []).append(r[0])
    small = {k: min((x for x in v if x is not None), default=None) for k, v in comp.items()}
    return [(r[0], len(sets[i]), small[find(i)]) for i, r in enumerate(rows)], len(comp)


def check(df, rows):
    got = near_dedup.assign(df).collect()
    want, n = brute(rows)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=key) == sorted(want, key=key)
    assert sum(r.kept for r in got) == n
    return got


def variants(rng, words, n, cut):
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(rng.randint(0, cut)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_given_documents(spark):
    df = documents(spark, SF_DIR)
    check(df, [(r.doc_id, r.text) for r in df.collect()])


def test_awkward_rows(docs, awkward):
    got = check(docs(awkward), awkward)
    assert all(r.kept for r in got if r.n_shingles == 0)
    left = near_dedup.deduplicate(docs(awkward))
    assert left.columns == docs(awkward).columns and left.count() == sum(r.kept for r in got)


@pytest.mark.parametrize("stragglers,levels", [(64, 2), (1, 2), (0, 1)])
def test_crowded_buckets_with_and_without_splits(docs, monkeypatch, stragglers, levels):
    """Copies with a few words changed: some pairs are just below the threshold, chains link them."""
    monkeypatch.setattr(near_dedup, "STRAGGLERS", stragglers)
    monkeypatch.setattr(near_dedup, "LEVELS", levels)
    monkeypatch.setattr(near_dedup, "FEW_PAIRS", stragglers)
    monkeypatch.setattr(near_dedup, "DENSE", 30_000_000 if levels == 2 else 0)
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rng = random.Random(stragglers)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    passage = " ".join(f"p{i}" for i in range(60))
    texts = variants(rng, base, 60, 4)
    texts += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(25)) for _ in range(40)]
    texts += ["same again"] * 5
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    check(docs(rows), rows)


def test_circulant_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    for share in (0.3, 0.85):
        both = rng.integers(0, 2**63, int(4000 * share), dtype=np.uint64)
        a, b = (np.unique(np.concatenate([both, rng.integers(0, 2**63, 4000 - len(both), dtype=np.uint64) * np.uint64(2)])) for _ in range(2))
        j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        same = np.mean([np.mean(near_dedup.signature(a, lv) == near_dedup.signature(b, lv)) for lv in range(3)])
        assert abs(same - j) < 0.06
    assert np.array_equal(near_dedup.signature(a), near_dedup.signature(a))


def test_shingle_sets_match_plain_python():
    cache = shingles.WordHashes()
    for t in ("", None, " \t", "one", "A b C d", "a b c d e", "Ä b c d\x0be f g " * 30):
        assert len(shingles.shingle_set(t, cache)) == len(shingle_set(t))


def test_empty_table(docs):
    assert near_dedup.assign(docs([])).count() == 0
    assert near_dedup.deduplicate(docs([])).count() == 0
