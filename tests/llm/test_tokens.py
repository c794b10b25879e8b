"""Token counts and packing against the tokenizers library."""

import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kawara.llm import packing, token_counts, tokens
from kawara.llm.common import documents

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ODD = [
    (20, "a <|endoftext|> b<|endoftext|>"),
    (21, "two  spaces and\n\nlines "),
    (22, "tab\there don't we'll stop\x1cnow"),
    (23, "it's 1234　你好 'tis"),
    (24, "\n"),
    (25, "x\ny z"),
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_counts_of_given_and_odd_documents(spark, docs, awkward, library):
    given_rows = [(r.doc_id, r.text) for r in documents(spark, SF_DIR).collect()]
    for rows, df in ((given_rows, documents(spark, SF_DIR)), (awkward + ODD, docs(awkward + ODD))):
        want = Counter()
        for i, t, *_ in rows:
            n = len(library.encode(t or "", add_special_tokens=False).ids)
            want[(i, len((t or "").encode()), n, n > 1024)] += 1
        got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.counts(df).collect())
        assert got == want


def test_counts_do_not_depend_on_the_table(docs, awkward, monkeypatch):
    a = sorted(r.n_tokens for r in token_counts.counts(docs(awkward + ODD)).collect())
    monkeypatch.setattr(token_counts, "FREQUENT", 1)
    monkeypatch.setattr(token_counts, "SUMMARY", 1)
    assert sorted(r.n_tokens for r in token_counts.counts(docs(awkward + ODD)).collect()) == a


def test_cache_is_bounded():
    c = tokens.Lengths({"the": 1}, " ", lambda w: [0] * len(w), limit=10)
    for i in range(100):
        assert c[f"w{i}"] == len(f" w{i}")
    assert len(c) <= 11 and c["the"] == 1
    line = "x" * (tokens.LONGEST + 1)
    assert c[line] == len(line) + 1 and line not in c


def test_table_holds_what_fits(docs, monkeypatch):
    text = " ".join(["start", *["often"] * 40, *["some"] * 20, *[f"once{i}" for i in range(50)], "y" * 200])
    rows = docs([(i, text, "en", "a", len(text)) for i in range(4)])
    monkeypatch.setattr(token_counts, "FREQUENT", 2)
    heads, inner = token_counts.frequent_lengths(rows, "text", tokens.VOCABULARY)
    assert not heads and set(inner) == {"often", "some"}
    monkeypatch.setattr(token_counts, "FREQUENT", 100)
    heads, inner = token_counts.frequent_lengths(rows, "text", tokens.VOCABULARY)
    assert set(heads) == {"start"} and len(inner) == 52
    assert token_counts.frequent_lengths(docs([]), "text", tokens.VOCABULARY) == ({}, {})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab' .,\n\t9é你_\x1c <|>"), max_size=30))
def test_ids_and_lengths_of_any_text(text):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")) if not hasattr(test_ids_and_lengths_of_any_text, "lib") else test_ids_and_lengths_of_any_text.lib
    test_ids_and_lengths_of_any_text.lib = lib
    ids = lib.encode(text, add_special_tokens=False).ids
    assert tokens.ids_of(text).tolist() == ids
    if text and tokens.regular(text):
        e = tokens.encoder().encode_ordinary
        lines = [line.split(" ") for line in text.split("\n")]
        assert len(lines) - 1 + sum(len(e(w[0])) + sum(len(e(" " + x)) for x in w[1:]) for w in lines) == len(ids)


def check_packing(got, rows, library):
    pieces, seqs = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        seqs[r.sequence_id].append(r)
    want = defaultdict(list)
    for i, t, *_ in rows:
        want[i].append(library.encode(t or "", add_special_tokens=False).ids + [1])
    assert set(pieces) == set(want)
    for i, docs in want.items():
        assert sum(r.length for r in pieces[i]) == sum(map(len, docs))
        for r in pieces[i]:
            assert any(
                len(d) == r.doc_tokens
                and zlib.crc32(np.array(d[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
                for d in docs
            )
        if len(docs) == 1:
            at = 0
            for r in sorted(pieces[i], key=lambda r: r.start):
                assert r.start == at
                at += r.length
    for s in seqs.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and at & (at - 1) == 0 and all(r.sequence_length == at for r in s)
    return seqs


def test_packing_round_trip(spark, docs, awkward, library):
    rows = [(r.doc_id, r.text) for r in documents(spark, SF_DIR).collect()]
    seqs = check_packing(packing.sequences(documents(spark, SF_DIR)).collect(), rows, library)
    assert len(seqs) < sum(r.length for s in seqs.values() for r in s) / 200
    check_packing(packing.sequences(docs(awkward + ODD).repartition(3)).collect(), awkward + ODD, library)
    small = packing.sequences(docs(awkward + ODD), cell_tokens=40, keep_ids=True).collect()
    check_packing(small, awkward + ODD, library)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in small)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 5000), max_size=40))
def test_pack_any_lengths(lengths):
    windows = packing.pack(lengths)
    seen = Counter()
    for size, pieces in windows:
        assert sum(p[2] for p in pieces) == size
        for d, s, n in pieces:
            for x in (s, s + n):
                seen[(d, x)] += 1 if x == s else -1
    for d, n in enumerate(lengths):
        assert seen[(d, 0)] == 1 and seen[(d, n)] == -1
    assert all(v == 0 or k[1] in (0, lengths[k[0]]) for k, v in seen.items())


def test_step_groups_weigh_about_the_same():
    rng = np.random.default_rng(0)
    windows = packing.pack([int(x) for x in rng.lognormal(6, 1, 3000)])
    groups = packing.step_groups(windows)
    held = defaultdict(lambda: [0, 0])
    for (size, pieces), g in zip(windows, groups):
        if size == 2048:
            held[g][0] += size
            held[g][1] += sum(p[2] ** 2 for p in pieces)
    sizes, costs = zip(*held.values())
    assert max(sizes) - min(sizes) <= 2048 and max(costs) < 1.1 * min(costs)


def test_empty_table(docs):
    assert packing.sequences(docs([])).count() == 0 and token_counts.counts(docs([])).count() == 0
