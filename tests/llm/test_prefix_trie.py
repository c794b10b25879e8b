import hashlib
import random
import zlib

import numpy as np
import pytest

from kawara.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """The trie from dictionaries of whole prefixes."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn, role or "", text or ""))

    def order(t):
        digest = hashlib.md5(f"{len(t[1].encode())}:{t[1]}{t[2]}".encode()).hexdigest()
        return (t[0] is not None, t[0] or 0, digest)

    own = {c: [x[1:] for x in sorted(ts, key=order)] for c, ts in convs.items()}
    members = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        path = own.get(c - c % 5, [])[:h] + own[c][h:]
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append((c, d == len(path)))
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    sums = {}
    for p in sorted(members, key=len, reverse=True):
        below = [sums[k] for k in kids.get(p, [])]
        own_saved = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        sums[p] = (sum(b[0] for b in below) or 1, own_saved + sum(b[1] for b in below))
    out = []
    for p, ms in members.items():
        ends = ",".join(map(str, sorted(c for c, last in ms if last)))
        up = min(c for c, _ in members[p[:-1]]) if p else None
        out.append(
            (min(c for c, _ in ms), len(p), up, len(ms), len(kids.get(p, [])), *sums[p], hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def sample(n, seed=7):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        turns = [(t, r.choice(["user", "assistant", None]), r.choice(["a", "bé", "", None, "long " * 20])) for t in range(r.randint(1, 12))]
        if c % 3 == 0:  # much of the table starts alike, and copies go on alike
            turns[:6] = [(t, "user", "hot") for t in range(min(6, len(turns)))]
        rows += [(c, *t) for t in turns]
    return rows


def test_close_is_found_across_blocks():
    r = random.Random(1)
    text, depth = [], 0
    for _ in range(20_000):
        up = depth == 0 or r.random() < (0.7 if len(text) // 3_000 % 2 == 0 else 0.35)
        text.append(up)
        depth += 1 if up else -1
    text += [False] * depth
    stack, want = [], {}
    for i, up in enumerate(text):
        if up:
            stack.append(i)
        else:
            want[stack.pop()] = i
    tree = T.Parentheses(np.array(text))
    at = np.flatnonzero(text)
    assert tree.findclose(at).tolist() == [want[i] for i in at]


@pytest.mark.parametrize("segment,run", [(512, 50_000), (3, 7), (6, 1)])
def test_equals_prefix_dictionaries(make, segment, run):
    rows = sample(60)
    assert got(T.nodes(make(rows, SCHEMA), segment, run)) == plain(rows)


def test_awkward_rows(make):
    rows = [
        (None, 0, "user", "x"), (3, None, "user", "null first"), (3, 0, None, None), (3, 0, "user", "tie"), (3, 0, "user", "tie"),
        (5, 1, "user", "b"), (5, 1, "user", "a"), (6, 1, "user", "a"), (-7, 0, "user", "minus"), (7, 2, "us", "erx"), (8, 2, "user", "x"),
        (10, 0, "user", "w " * 100_000),
    ]
    df = make(rows, SCHEMA).selectExpr("*", "'x' AS c", "'x' AS token", "1 AS size", "1 AS level", "'x' AS path", "1 AS root", "1 AS `a.b`")
    want = plain([r for r in rows if r[0] != -7] + [r for r in rows if r[0] == -7])
    assert got(T.nodes(df)) == want
    assert got(T.nodes(df, 2, 3)) == want


def test_empty_table_and_turnless(make):
    assert got(T.nodes(make([], SCHEMA))) == []
    # conversations whose base is absent and that are shorter than h lose all turns
    c = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(c, 0, "user", "only")]
    assert got(T.nodes(make(rows, SCHEMA))) == plain(rows)
    assert len(plain(rows)) == 1
