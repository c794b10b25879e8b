"""A quality classifier from weak labels.

1. **Labellers.** Overlapping heuristics vote good, bad or nothing on every document.
2. **Label model.** Votes are counted per pattern over all documents (at most 3^LABELLERS patterns,
   whatever the corpus). Expectation-maximisation on these counts estimates the share of good
   documents and how each labeller votes on good and on bad ones; no given labels are used.
3. **Scorer.** The posterior of a document's pattern labels a bounded sample (``SAMPLE`` documents a
   class, those of smallest hash) on which a logistic scorer over hashed word forms is trained. All
   documents are then scored; those under ``THRESHOLD`` are rejected.

The sample bound holds for fitting alone; votes, counts and scores cover all documents and whole
texts. Patterns, sample and weights have fixed bounds, so they may pass through the driver.

Defined results. NULL, empty and blank texts score 0 and are rejected. Equal texts get equal scores.
An empty table, or one without both clear classes, is scored by the label model alone.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kawara.llm import shingles
from kawara.llm.common import documents, same, with_code
from kawara.session import cut_lineage

LABELLERS = 9
SAMPLE = 2_000
BUCKETS = 4_096
CLEAR = 0.9
THRESHOLD = 0.5
ROUNDS = 60
_CACHE = 100_000
_STOP, _MARKS = 1, 2  # flags of a word's code
_ENDS = ".,;:!?"
_LETTERS, _DIGITS = re.compile(r"[^\W\d_]+"), re.compile(r"\d+")

_SYMBOLS = b"!#$%&*@^~<>{}[]=+_\\|"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
#: Frequent function words of four languages.
STOPWORDS = frozenset(
    "the of and to in is that for it was with on as at be by this from or are an "
    "der die das und ist von den mit zu ein eine nicht auf für im "
    "le la les de des et du un une que qui en pour par dans est sur "
    "el los las y por con para una del su al lo".split()
)


def form_of(word: str) -> str:
    """The word's kinds of characters, repeats shortened."""
    body = word.rstrip(_ENDS)
    if body.isalpha():  # most words: no need for the patterns below
        return (("A" if len(body) > 1 and body.isupper() else "a") + word[len(body) :])[:12]
    form = _LETTERS.sub(lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else "a", word)
    return _DIGITS.sub("0", form)[:12]


class Forms(dict):
    """Form -> the bits of its bucket; emptied when full."""

    def __missing__(self, form: str) -> int:
        if len(self) >= _CACHE:
            self.clear()
        bucket = xxhash.xxh32_intdigest(form.encode("utf-8", "surrogatepass")) % (BUCKETS - 2) + 2
        value = self[form] = bucket << 8
        return value


class Codes(dict):
    """Word -> one number: flags, the bucket of the word's form, and a hash of the word.

    Emptied when full, so its size is bounded.
    """

    def __init__(self):
        self.forms = Forms()

    def __missing__(self, word: str) -> int:
        if len(self) >= _CACHE:
            self.clear()
        code = self.forms[form_of(word)]
        if word.strip(_ENDS).lower() in STOPWORDS:
            code |= _STOP
        if not (word[0].isalnum() or any(map(str.isalnum, word))):
            code |= _MARKS
        own = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        value = self[word] = own >> 20 << 20 | code
        return value


def codes_of(words: list[str], codes: Codes) -> np.ndarray:
    return np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))


def repeated_triples(code: np.ndarray) -> int:
    """Runs of three words that occurred before in the text."""
    triples = shingles.rolling(code, 3)
    return len(triples) - len(np.unique(triples))


def _vote(value: float, good: float, bad: float) -> int:
    """1 on the good side of ``good``, -1 on the bad side of ``bad``, 0 between them."""
    if good < bad:
        return 1 if value <= good else -1 if value >= bad else 0
    return 1 if value >= good else -1 if value <= bad else 0


def _alarm(value: float, bad: float) -> int:
    """-1 from ``bad`` on: a detector of one kind of junk says nothing about texts without it."""
    return -1 if value >= bad else 0


def votes(text: str | None, codes: Codes) -> list[int]:
    """One vote per labeller: 1 good, -1 bad, 0 none."""
    words = (text or "").split()
    return votes_of(text, words, codes_of(words, codes))


def votes_of(text: str | None, words: list[str], code: np.ndarray) -> list[int]:
    if not words:
        return [-1] * LABELLERS
    n, raw = len(words), text.encode("utf-8", "surrogatepass")
    count = lambda chars: len(raw) - len(raw.translate(None, chars))
    upper, lower = count(_UPPER), count(_LOWER)
    lines = [x for x in text.split("\n") if x.strip()]
    stop = np.count_nonzero(code & np.uint64(_STOP)) / n
    marks = count(b".,;:?") / n
    return [
        _vote(count(_SYMBOLS) / len(raw), 0.01, 0.04),
        _alarm(upper / max(1, upper + lower), 0.6) if upper + lower >= 20 else 0,
        _alarm(np.count_nonzero(code[1:] == code[:-1]) / n, 0.2) if n >= 10 else 0,
        _alarm(repeated_triples(code) / (n - 2), 0.4) if n >= 30 else 0,
        _alarm(np.count_nonzero(code & np.uint64(_MARKS)) / n, 0.1) if n >= 10 else 0,
        _alarm(abs(sum(map(len, words)) / n - 6), 7) if n >= 10 else 0,
        _vote(marks, 0.04, 0.005) if n >= 20 else 0,
        _vote(stop, 0.12, 0.03) if n >= 20 else 0,
        _alarm(1 - len(set(lines)) / len(lines), 0.3) if len(lines) >= 4 else 0,
    ]


def _pattern(votes: list[int]) -> str:
    return "".join("-0+"[v + 1] for v in votes)


def _patterns(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    codes = Codes()
    for texts in batches:
        yield pd.Series([_pattern(votes(t, codes)) for t in texts], dtype=object)


def vote_pattern(text: str) -> Column:
    """The votes as text, one character per labeller: ``-``, ``0`` or ``+``."""
    return F.pandas_udf(_patterns, "string", F.PandasUDFType.SCALAR_ITER)(F.col(text))


def label_model(patterns: list[str], counts: list[int], rounds: int = ROUNDS) -> dict[str, float]:
    """The posterior probability of "good" for each pattern of votes."""
    if not patterns:
        return {}
    v = np.array([["-0+".index(c) for c in p] for p in patterns])
    n = np.array(counts, float)
    hot = np.eye(3)[v]  # pattern, labeller, outcome
    # to begin with, a bad vote outweighs good ones: detectors of junk are silent on everything else
    good = 1 / (1 + np.exp(3.0 * (v == 0).sum(axis=1) - (v == 2).sum(axis=1) - 1))
    for _ in range(rounds):
        prior = np.clip((good * n).sum() / n.sum(), 1e-3, 1 - 1e-3)
        logs = []
        for p in (good, 1 - good):
            w = (p * n)[:, None, None] * hot
            seen = w.sum(axis=0) + 0.1
            logs.append((hot * np.log(seen / seen.sum(axis=1, keepdims=True))).sum(axis=(1, 2)))
        odds = np.clip(math.log(prior / (1 - prior)) + logs[0] - logs[1], -50, 50)
        good = 1 / (1 + np.exp(-odds))
    return dict(zip(patterns, good.tolist()))


def features(text: str | None, codes: Codes) -> np.ndarray:
    """Hashed counts of word forms, of words that repeat the one before them, and of repeated triples."""
    return features_of(codes_of((text or "").split(), codes))


def features_of(code: np.ndarray) -> np.ndarray:
    if not len(code):
        return np.zeros(BUCKETS, np.float32)
    out = np.bincount((code >> np.uint64(8) & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
    out[0] = np.count_nonzero(code[1:] == code[:-1])
    out[1] = repeated_triples(code)
    return np.sqrt(out / len(code)).astype(np.float32)


def train(rows: np.ndarray, good: np.ndarray, rounds: int = 300, rate: float = 0.5, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression by full gradient steps with momentum; labels are probabilities."""
    w, b, mw, mb = np.zeros(rows.shape[1], np.float32), 0.0, np.zeros(rows.shape[1], np.float32), 0.0
    for _ in range(rounds):
        off = 1 / (1 + np.exp(-(rows @ w + b))) - good
        mw = 0.9 * mw + rows.T @ off / len(rows) + decay * w
        mb = 0.9 * mb + float(off.mean())
        w, b = w - rate * mw, b - rate * mb
    return w, b


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE):
    """A column function that gives (votes, score) of texts; fitted on ``docs``."""
    with_code(docs)
    id_and_print = (F.col(key).alias("id"), F.xxhash64(text).alias("print"))
    marked = cut_lineage(docs.select(*id_and_print, vote_pattern(text).alias("pattern")))
    counted = marked.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    counted = counted.orderBy("pattern").collect()  # at most 3^LABELLERS rows
    posterior = label_model([r.pattern for r in counted], [r.n for r in counted])
    clear = [[(p, float(q)) for p, q in posterior.items() if f(q)] for f in (lambda q: q >= CLEAR, lambda q: q <= 1 - CLEAR)]
    weights = None
    if all(clear):
        parts = []
        for side in clear:
            of = docs.sparkSession.createDataFrame(side, "pattern string, good double")
            # distinct texts of smallest hash: the sample doesn't depend on the order of rows
            own = marked.join(F.broadcast(of), "pattern").groupBy("print").agg(F.min("id").alias("id"), F.max("good").alias("good"))
            taken = cut_lineage(own.orderBy("print").limit(sample))
            found = docs.select(*id_and_print, F.col(text).alias("text")).join(
                F.broadcast(taken.select("print", F.col("id").alias("_id"), "good")), "print"
            )
            found = found.where(same(F.col("id"), F.col("_id")))
            parts.append(found.select("good", F.pandas_udf(_sparse, "at array<int>, value array<float>")("text").alias("x")))
        rows = list(chain.from_iterable(p.collect() for p in parts))  # 2 * SAMPLE rows of at most BUCKETS entries
        x = np.zeros((len(rows), BUCKETS), np.float32)
        for i, r in enumerate(rows):
            x[i, r.x.at] = r.x.value
        weights = train(x, np.array([r.good for r in rows], np.float32))

    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codes = Codes()

        def of(text: str | None) -> tuple[str, float]:
            words = (text or "").split()
            code = codes_of(words, codes)
            pattern = _pattern(votes_of(text, words, code))
            if not words:
                return pattern, 0.0
            if weights is None:
                return pattern, posterior.get(pattern, 0.5)
            odds = float(features_of(code) @ weights[0]) + weights[1]
            return pattern, 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))

        for texts in batches:
            yield pd.DataFrame([of(t) for t in texts], columns=["votes", "score"])

    return F.pandas_udf(judge, "votes string, score double", F.PandasUDFType.SCALAR_ITER)


def _sparse(texts: pd.Series) -> pd.DataFrame:
    codes, at, value = Codes(), [], []
    for t in texts:
        f = features(t, codes)
        at.append(np.flatnonzero(f).astype(np.int32))
        value.append(f[at[-1]])
    return pd.DataFrame({"at": at, "value": value})


def classify(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, votes of the labellers, score and whether the document stays."""
    judged = docs.select(F.col(key), fit(docs, key, text)(text).alias("_j"))
    out = judged.select(F.col(key), F.col("_j.votes").alias("votes"), F.col("_j.score").alias("score"))
    return out.withColumn("kept", F.col("score") >= THRESHOLD)


def accepted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, all columns."""
    return docs.where(fit(docs, key, text)(text)["score"] >= THRESHOLD)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(documents(spark, sf_dir))
