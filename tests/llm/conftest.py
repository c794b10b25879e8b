import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(make):
    """Documents from (doc_id, text) or (doc_id, text, source) rows, with columns that clash."""

    def build(rows, extra=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = make(full, DOCS)
        if not extra:
            return df
        names = ["size", "shard", "slot", "score", "labels", "kept", "row", "n", "word", "value", "pos", "bucket"]
        return df.selectExpr("*", *[f"'x' AS {n}" for n in names])

    return build


AWKWARD = [
    (1, None),
    (2, ""),
    (3, "Same text here, and more of it."),
    (3, "Same text here, and more of it."),
    (4, "same TEXT here, and more of it."),
    (None, "Same text here, and more of it."),
    (5, "ÄÖ bleibt, Äö nicht"),
    (6, " \t\n "),
    (7, "word " * 60_000),
    (8, "ÄÖ bleibt, äö nicht", None),
    (9, "\x00 \U0001f600 null and face"),
]


@pytest.fixture
def awkward():
    return list(AWKWARD)
