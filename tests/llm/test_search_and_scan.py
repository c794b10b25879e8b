"""Top-k search, license scan, quality and passages against plain Python."""

import os
import random
import re
import sys
from collections import Counter

import numpy as np
import pytest

from kawara.llm import license_scan, quality, shingles, substring_dedup, topk_search
from kawara.llm.common import documents

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_topk_with_ties_repeats_and_broken_vectors(make, monkeypatch):
    monkeypatch.setattr(topk_search, "BLOCK", 70)
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 8)], i) for i in range(300)]
    rows += [(300 + i, rows[7][1], 0) for i in range(20)]  # ties
    rows += [(7, rows[9][1], 0), (None, rows[3][1], 0)]  # repeated and missing ids
    rows += [(400, None, 0), (401, [], 0), (402, [None] * 8, 0), (403, [float("nan")] * 8, 0), (404, [float("inf")] * 8, 0)]
    rows += [(450, [1000.0, -1000.0], 0), (451, [0.0] * 8, 0)]
    df = make(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    got = topk_search.search(df, df.where("vec_id % 50 = 0 OR vec_id = 7")).collect()
    good = []
    for i, v, _ in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            good.append((i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)))
    want = []
    for n, (i, q) in enumerate(good):
        if i % 50 == 0 or i == 7:
            all_ = sorted((-int(q @ v), j) for m, (j, v) in enumerate(good) if m != n and len(v) == len(q))
            want += [(i, rank, *x) for rank, x in enumerate(all_[:5], 1)]
    assert sum(w[0] == 7 for w in want) == 10  # both rows of the repeated id ask
    assert sorted((r.query_id, r.rank, -r.score, r.vec_id) for r in got) == sorted(want)


def test_topk_refuses_scores_beyond_a_long(make):
    df = make([(0, [1e30, 0.0]), (1, [-1e30, 1.0])], "vec_id long, embedding array<float>")
    with pytest.raises(ValueError, match="pass"):
        topk_search.search(df, df)


def test_topk_of_few_and_none(make):
    schema = "vec_id long, embedding array<float>, label int"
    two = make([(0, [0.5, -0.5], 0), (1, [0.25, 0.0], 0)], schema)
    assert [(r.vec_id, r.score) for r in topk_search.search(two, two).where("query_id = 0").collect()] == [(1, 128 * 64)]
    assert topk_search.search(make([], schema), make([], schema)).count() == 0


def words_of(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def base_of(t):
    w, found = words_of(t), []
    for phrase, label in license_scan.BASE:
        p = phrase.split()
        found += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    places = [i for i, _ in found]
    return len(w), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))


LICENSED = [
    (30, "Under the MIT license. under the mit-license; Apache License, Version 2.0 and CC BY-NC 4.0"),
    (31, "under the mit under the mit license cc by nc by nc"),
    (32, "Permission is hereby granted, free of charge, to any person who is obtaining a copy of this software and associated documentation files"),
    (33, "This work is licensed under the GNU General Public License, version 3."),
    (34, "the license of mit is under"),
    (35, "äpache license version 2 apache licensé version 2"),
]


def test_license_scan(spark, docs, awkward):
    given = [(r.doc_id, r.text) for r in documents(spark, SF_DIR).collect()]
    for rows, df in ((given, documents(spark, SF_DIR)), (awkward + LICENSED, docs(awkward + LICENSED))):
        got = license_scan.scan(df).collect()
        want = Counter((i, *base_of(t)) for i, t, *_ in rows)
        assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == want
        assert all(set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) for r in got)
        assert all(0 <= r.score <= 1 and (r.score > 0.79 or not r.labels) for r in got)
    labels = {r.doc_id: r.labels for r in got}
    assert labels[32] == "mit" and labels[33] == "gpl-3" and labels[34] == ""
    assert license_scan.scan(docs([])).count() == 0


def test_quality_agrees_with_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("no test tables here")
    got = {r.doc_id: r.kept for r in quality.classify(documents(spark, folder)).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    right = sum(got[r.doc_id] == bool(r.quality) for r in labels)
    assert right >= 0.97 * len(labels)
    assert all(got[r.doc_id] for r in labels if r.quality == 1 and r.toxic == 0)


def test_quality_awkward_rows(docs, awkward):
    df = docs(awkward)
    got = quality.classify(df).collect()
    assert len(got) == len(awkward) and all(0 <= r.score <= 1 for r in got)
    assert all(not r.kept for r in got if r.doc_id in (1, 2, 6))
    assert quality.accepted(df).columns == df.columns
    assert quality.classify(docs([])).count() == 0 and quality.accepted(docs([])).count() == 0


def test_label_model_finds_the_reliable_labellers():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.8
    right = np.array([0.95, 0.9, 0.9, 0.85, 0.8, 0.6, 0.9, 0.9, 0.5])
    seen = np.where(rng.random((4000, 9)) < right, truth[:, None], ~truth[:, None])
    pats = Counter("".join("+" if v else "-" for v in row) for row in seen)
    post = quality.label_model(list(pats), list(pats.values()))
    said = np.array([post["".join("+" if v else "-" for v in row)] >= 0.5 for row in seen])
    assert (said == truth).mean() > 0.97


def brute_passages(rows):
    """Sentences removed per row, by comparing all spans in order of id."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] if rows[i][0] is not None else 0, i))
    seen, out = set(), {}
    for i in order:
        parts = substring_dedup.sentences(rows[i][1])
        assert "".join(parts) == (rows[i][1] or "")
        words = [" ".join(re.findall(r"[^\x20\x09-\x0D]+", p)).encode().lower() for p in parts]
        count = [len(w.split()) for w in words]
        gone = [False] * len(parts)
        for a in range(len(parts)):
            if not count[a]:
                continue
            b = a
            while b < len(parts) and not (count[a] >= 50 or (b - a + 1 >= 2 and sum(count[a : b + 1]) >= 20)):
                b += 1
            if b == len(parts):
                continue
            key = b" ".join(w for w in words[a : b + 1] if w)
            if key in seen:
                gone[a : b + 1] = [True] * (b + 1 - a)
            seen.add(key)
        if any(gone):
            out[i] = "".join(p for p, g in zip(parts, gone) if not g)
    return out


def test_passages(spark, docs, awkward):
    rng = random.Random(5)
    say = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n)).capitalize() + "."
    passage = " ".join(say(14) for _ in range(4))
    rows = [(100 + i, "\n".join([say(9), passage if i % 3 else say(30), say(3), say(12)])) for i in range(30)]
    rows += [(200, passage + " " + say(5) + "\n" + passage), (201, say(60)), (202, say(8) + "\n\n" + say(30))]
    rows += [(203, rows[-2][1] + " " + say(4))]
    given = [(r.doc_id, r.text) for r in documents(spark, SF_DIR).orderBy("doc_id").collect()]
    for rows_, df in ((rows, docs(rows)), (given, documents(spark, SF_DIR))):
        got = {r.doc_id: r.text for r in substring_dedup.rewritten(df).collect()}
        assert got == {rows_[i][0]: t for i, t in brute_passages(rows_).items()}
    odd = substring_dedup.rewritten(docs(awkward)).collect()
    assert all(r.n_removed > 0 for r in odd)
    assert substring_dedup.rewritten(docs([])).count() == 0


def test_a_passage_of_a_third_of_all_documents_keeps_its_first_place(docs):
    passage = " ".join(f"p{i}" for i in range(30)) + ". " + " ".join(f"q{i}" for i in range(30)) + "."
    rows = [(i, f"Own {i} text.\n{passage if i % 3 == 0 else f'Nothing {i} here.'}") for i in range(300)]
    got = substring_dedup.rewritten(docs(rows).repartition(9)).collect()
    assert {r.doc_id for r in got} == {i for i in range(1, 300) if i % 3 == 0}
    assert all(r.first_doc_ids == [0] and r.words_removed == 60 for r in got)
def brute_runs(rows):
    """What the passages keep: the sentence law of brute_passages, and every 50 words met before, in order of id."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] if rows[i][0] is not None else 0, i))
    seen, spans, out = {}, set(), {}
    for i in order:
        parts = substring_dedup.sentences(rows[i][1])
        words = [(s, w.lower()) for s, p in enumerate(parts) for w in re.findall(rb"[^\x20\x09-\x0D]+", p.encode())]
        gone = [False] * len(words)
        for a in range(len(parts)):
            inside = lambda b: [j for j, (s, _) in enumerate(words) if a <= s <= b]  # noqa: B023, E731
            if not inside(a):
                continue
            b = a
            while b < len(parts) and not (len(inside(a)) >= 50 or (b > a and len(inside(b)) >= 20)):
                b += 1
            if b < len(parts):
                span = tuple(words[j][1] for j in inside(b))
                if span in spans:
                    for j in inside(b):
                        gone[j] = True
                spans.add(span)
        for a in range(len(words) - 49):
            f = seen.setdefault(tuple(w for _, w in words[a : a + 50]), (i, a))
            for j in range(a if f[0] != i else max(a, f[1] + 50), a + 50) if f != (i, a) else ():
                gone[j] = True
        if any(gone):
            out[i] = [w for (_, w), g in zip(words, gone) if not g]
    return out


def mid_sentence_rows():
    rng = random.Random(11)
    say = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    p53, p80 = say(53), ", ".join(say(20) for _ in range(4))
    rows = [(i, f"{say(i % 7 + 3)} {p53} {say(4)}. {say(12)}.") for i in range(8)]
    rows += [(20 + i, f"{say(5)} {p80.upper() if i % 2 else p80} {say(i)}") for i in range(6)]  # no sentence marks at all
    rows += [(40, say(30) + " " + p53[: p53.rindex(" ", 0, -40)] + " " + say(30))]  # under 50 words stay
    rows += [(41, "again " * 130 + say(60)), (42, f"{p80} {say(9)} {p80}. {p53}."), (42, rows[1][1]), (42, rows[1][1]), (None, f"{say(2)} {p53}"), (43, p53)]
    return rows


def test_passages_in_mid_sentence_and_without_marks(docs):
    rows = mid_sentence_rows()
    got = sorted((str(r.doc_id), r.text.lower().encode().split()) for r in substring_dedup.rewritten(docs(rows).coalesce(1), runs=True).collect())
    assert got == sorted((str(rows[i][0]), w) for i, w in brute_runs(rows).items())
    assert len(got) >= 18


def test_passages_return_every_row_with_its_columns(docs, awkward):
    rows = mid_sentence_rows() + [(r[0] and r[0] + 500, *r[1:]) for r in awkward] + [(43, mid_sentence_rows()[0][1], "other")]
    df = docs(rows).coalesce(1)
    whole = substring_dedup.deduplicate(df)
    assert whole.columns == df.columns and whole.count() == len(rows)
    want = brute_runs(rows)
    left = lambda i: " ".join(w.decode() for w in want[i]) if i in want else " ".join(rows[i][1].lower().split()) if rows[i][0] != 509 and rows[i][1] else rows[i][1]  # noqa: E501, E731
    cleaned = substring_dedup.cleaned(df).collect()
    for got in (whole.collect(), cleaned):
        flat = Counter((r.doc_id, r.text if r.doc_id == 509 or not r.text else " ".join(re.findall(r"[^\x20\x09-\x0D]+", r.text)).lower()) for r in got if r.doc_id not in (505, 506, 508))
        assert flat == Counter((rows[i][0], left(i)) for i in range(len(rows)) if rows[i][0] not in (505, 506, 508))
    assert Counter(r.source for r in whole.collect()) == Counter(r[2] if len(r) > 2 else "s" for r in rows)
    same = {r.doc_id: r for r in cleaned if r.doc_id in (501, 502, 505, 506, 508, 509)}
    assert {i: r.text for i, r in same.items()} == {r[0]: r[1] for r in rows if r[0] in same}
    assert all((r.n_removed, r.words_removed, r.removed, r.first_doc_ids) == (0, 0, [], []) for r in same.values())
    assert substring_dedup.deduplicate(docs([])).count() == 0 and substring_dedup.cleaned(docs([])).count() == 0


NEAR_MISSES = [
    ("Licensed under the Creative Commons Attribution 4.0 International License.", "cc-by"),
    ("Licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.", "cc-by-sa"),
    ("Licensed under the Creative Commons Attribution-NonCommercial 4.0 International License.", "cc-by-nc"),
    ("Licensed under the Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", "cc-by-nc,cc-by-sa"),
    ("Licensed under the Creative Commons Attribution-NoDerivatives 4.0 International License.", ""),
    ("This work is licensed under the GNU General Public License version 2.", ""),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
    ("This work is licensed under the GNU Lesser General Public License version 3.", "lgpl"),
    ("You can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation", "agpl"),
]


def test_license_notices_that_differ_in_a_word(docs):
    got = {r.doc_id: r for r in license_scan.scan(docs([(i, t) for i, (t, _) in enumerate(NEAR_MISSES)])).collect()}
    assert [got[i].labels for i in range(len(got))] == [x for _, x in NEAR_MISSES]
    assert all((r.score >= license_scan.COVERED) == bool(r.labels) for r in got.values())


def test_words_are_hashed_together_whatever_their_number():
    """The cost of a text was a Python call or more per new word, which took most of the time of the scan."""
    text = " ".join(f"w{k:05d}" + "." * (k % 20 == 19) for k in range(20_000))
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(event) if event in ("call", "c_call") else None)
    try:
        found = list(substring_dedup._places_of([text]))
    finally:
        sys.setprofile(None)
    assert found[0][0] == 1_000 and len(calls) < 3_000
    parts = ["a", "Bc", " ", ". ", "。", "!　", "\xa0", "\n \x85", "\x1c", "é", "\ud800", "\U0001f600", "\t"]
    rng = random.Random(4)
    texts = [None, "", "\n", *("".join(rng.choices(parts, k=rng.randrange(200))) for _ in range(300))]
    hashes, sentence, counts, words = substring_dedup._words(texts)
    cut = [substring_dedup.sentences(t) for t in texts]
    each = [[w for s in own for w in shingles.words_of(s)] for own in cut]
    assert counts.tolist() == [len(own) for own in cut] and words.tolist() == [len(own) for own in each]
    told = [w for own in each for w in own]
    assert len(set(told)) == len(set(hashes.tolist())) == len(set(zip(told, hashes.tolist())))
    numbered = [s for own in cut for s in own]
    assert sentence.tolist() == [k for k, s in enumerate(numbered) for _ in shingles.words_of(s)]
    firsts, lasts, spanned = substring_dedup.spans(hashes, sentence, counts)
    of = [tuple(w for s in numbered[i : j + 1] for w in shingles.words_of(s)) for i, j in zip(firsts, lasts)]
    assert len(set(of)) == len(set(spanned.tolist())) == len(set(zip(of, spanned.tolist())))
