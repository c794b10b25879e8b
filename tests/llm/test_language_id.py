import random
import zlib

import numpy as np

from kawara.llm import language_id as L
from kawara.llm.common import documents


def fold(text):
    out = "".join(L._low(c) if L._letter(c) else " " for c in text)
    while "  " in out:
        out = out.replace("  ", " ")
    return out.removeprefix(" ")


def n_phrases(text, stretches):
    """Greedy longest matches, found by plain search; none may reach over a stretch or a piece."""
    n = 0
    for j in range(0, len(text), L.PIECE):
        piece, i = text[j : j + L.PIECE], 0
        while i < len(piece):
            k = i
            while k < len(piece) and any(piece[i : k + 1] in s for s in stretches):
                k += 1
            n += 1
            i = max(k, i + 1)
    return n


def words(letters, n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(1, 7))) for _ in range(n))


def test_automaton_knows_all_substrings():
    r = random.Random(2)
    text = [r.randrange(3) for _ in range(60)]
    go = L.automaton(text)
    subs = {tuple(text[i:j]) for i in range(60) for j in range(i + 1, min(61, i + 7))}

    def accepts(s):
        at = 0
        for c in s:
            at = go[at].get(c)
            if at is None:
                return False
        return True

    every = [()]
    for _ in range(6):
        every = [(*e, c) for e in every for c in range(3)] if every else every
        assert all(accepts(e) == (e in subs) for e in every)
    assert len(go) <= 2 * 60


def test_phrases_equal_plain_search():
    learned = tuple((n, tuple(words(a, 25, i * 10 + j) for j in range(3))) for i, (n, a) in enumerate([("a", "abcde"), ("b", "cdefg"), ("c", "ñeé")]))
    model = L.Model(learned)
    texts = [words("abcdefg", 150, 90), words("ñeéa", 80, 91), "Ab, cd! 12 ef", "漢字 abc", "x", words("cdefg", 1, 5), "É" * 300, "á ß İ ŉ"]
    got = model.phrases([model.coded(t) for t in texts])
    stretches = [[L._folded(t) for t in ts] for _, ts in learned]
    want = [[n_phrases(fold(t), s) for s in stretches] for t in texts]
    assert got.tolist() == want
    long = words("abcdefg", 9_000, 92)  # more pieces than go through at once
    alone = model.phrases([model.coded(long)])[0]
    assert alone.tolist() == [sum(n_phrases(p, s) for p in [fold(long)[i : i + L.PIECE] for i in range(0, len(fold(long)), L.PIECE)]) for s in stretches]


def test_small_room_keeps_some_text(monkeypatch):
    monkeypatch.setattr(L, "CELLS", 600)
    model = L.Model((("a", (words("abc", 200, 1),)), ("b", (words("def", 200, 2),))))
    assert len(model.go) <= 900
    assert [n for n, _ in model.judge(["abcab cab", "defed fed"])] == ["a", "b"]


def test_awkward_rows(make, docs, awkward):
    rows = awkward + [(i, words("abcd" if i % 2 else "wxyz", 40, i)) for i in range(20, 60)]
    df = docs([(*r[:2], "s") for r in rows]).selectExpr(
        "*", "CASE WHEN doc_id > 19 THEN if(doc_id % 2 = 1, 'one', 'two') END AS own", "'x' AS h", "'x' AS t", "'x' AS name", "'x' AS `a.b`"
    )
    model = L.learned(df, lang="own")
    assert [n for n, _ in model] == ["one", "two"]
    out = L.identify(df, model).collect()
    assert len(out) == len(rows)
    for r in out:
        assert 0 <= r["score"] is not None
        if r["text"] is None or not any(c.isalpha() for c in r["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["doc_id"] and r["doc_id"] > 19:
            assert r["lang_pred"] == ("one" if r["doc_id"] % 2 else "two")
            assert 0 < r["score"] <= 1.0


def test_nothing_to_learn(make, docs):
    df = docs([(1, "text"), (None, None)])
    none = L.learned(df.where("doc_id < 0"))
    assert none == ()
    assert {(r["lang_pred"], r["score"]) for r in L.identify(df, none).collect()} == {("und", 0.0)}
    one = L.identify(df, (("en", ("text",)),)).where("text IS NOT NULL").first()
    assert (one["lang_pred"], one["score"]) == ("en", 1.0)
    assert L.identify(df.where("doc_id < 0"), (("en", ("text",)),)).collect() == []


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r for r in documents(spark, sf).collect()}
    out = L.op12_language_id(spark, sf).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(docs)
    right = []
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        if r["held_out"] and docs[r["doc_id"]]["lang"]:
            right.append(r["lang_pred"] == docs[r["doc_id"]]["lang"])
    assert np.mean(right) > 0.98
