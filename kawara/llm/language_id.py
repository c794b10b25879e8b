"""Language of a text by cross-parsing against suffix automata.

A suffix automaton accepts every substring of the text it was built from. Walking it from its start
gives the longest match at a place; where the walk ends, a phrase ends and the next one begins. The
number of phrases times the logarithm of the learned length, per character, estimates the cross
entropy (Ziv and Merhav); the language with the smallest estimate wins.

Texts are folded to lower-case letters and single blanks and cut into pieces of ``PIECE`` characters;
phrases end at borders of pieces. So all pieces of a batch walk all automata at once, one character
a step, as arrays of states.

**Bounds of the fit** (the only ones): at most ``LANGUAGES`` languages (those with most rows), per
language ``SAMPLES`` stretches of ``STRETCH`` characters of as many documents, chosen by a hash of id
and text, and as many of them as keep the tables of all languages within ``CELLS`` entries. The
learned text is some kilobytes a language, goes to the workers with the job and is built there once.

Defined results. Texts that are NULL or have no letter are ``und`` with score 0. Equal estimates go
to the smaller language name. Without any learned language all texts are ``und``. Rows of NULL id are
never learned from and not held out. One learned language gets score 1; else the score is how far the
second estimate lies above the best one, as a share of the second.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kawara.llm.common import documents, with_code

FOLDS, HELD_OUT = 3, 1
LANGUAGES = 256
SAMPLES, STRETCH = 96, 256
CELLS = 16_000_000
PIECE = 256
LANES = 1 << 15
UNKNOWN = "und"
_BLANK, _OTHER = 1, 0


def automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the start."""
    go, link, length = [{}], [-1], [0]
    last = 0
    for c in codes:
        new = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = new
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:  # q stands for longer strings as well: they part
                twin = len(go)
                go.append(dict(go[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return go


def _letter(c: str) -> bool:
    """Letters, and the marks that scripts set on them."""
    return c.isalpha() or unicodedata.category(c)[0] == "M"


class Model:
    """The automata of all languages in one table of states by characters."""

    def __init__(self, learned: tuple[tuple[str, tuple[str, ...]], ...]):
        self.names = [name for name, _ in learned]
        folded = [[_folded(t) for t in texts] for _, texts in learned]
        known = sorted({c for texts in folded for t in texts for c in t} - {" "})
        code = {c: i for i, c in enumerate(known, 2)} | {" ": _BLANK}
        self.width = len(known) + 2
        # as many stretches a language as the table has room for: an automaton has at most two states a character
        room = CELLS // (2 * self.width * max(1, len(folded)))
        joined = []
        for texts in folded:
            out: list[int] = []
            for t in texts:
                if out and len(out) + len(t) > room:
                    break
                out += [_OTHER, *(code[c] for c in t)][: room - len(out)]
            joined.append(out)
        parts = [automaton(codes) for codes in joined]
        n = sum(map(len, parts)) + 1
        self.dead = n - 1
        self.go = np.full(n * self.width, -1, np.int32)
        self.starts, at = [], 0
        for own in parts:
            self.starts.append(at)
            for s, moves in enumerate(own, at):
                for c, to in moves.items():
                    if c != _OTHER:  # no text matches across stretches
                        self.go[s * self.width + c] = to + at
            at += len(own)
        first = np.array([self.go[s * self.width : (s + 1) * self.width] for s in self.starts]).reshape(-1, self.width)
        self.first = np.where(first < 0, self.dead, first).astype(np.int32)  # where a new phrase stands after its first character
        self.bits = np.array([np.log2(max(2, len(c))) for c in joined])
        self.codes = np.full(0x110000, _BLANK, np.uint16 if self.width < 1 << 16 else np.uint32)
        self.letters = np.zeros(0x110000, bool)
        for i in range(0x110000):
            c = chr(i)
            self.letters[i] = c.isalpha()
            if self.letters[i] or _letter(c):
                self.codes[i] = code.get(_low(c), _OTHER)

    def coded(self, text: str) -> np.ndarray | None:
        """The codes of the folded text; None without letters."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        if not self.letters[points].any():
            return None
        codes = self.codes[points]
        blank = codes == _BLANK
        return codes[~(blank & np.concatenate([[True], blank[:-1]]))]

    def phrases(self, codes: list[np.ndarray]) -> np.ndarray:
        """(text, language): phrases of each text's pieces; a text of no code has none."""
        counts = np.zeros((len(codes), len(self.names)), np.int64)
        pieces = [(i, c[j : j + PIECE]) for i, c in enumerate(codes) for j in range(0, len(c), PIECE)]
        step = max(1, LANES // max(1, len(self.names)))
        for k in range(0, len(pieces), step):
            own = sorted(pieces[k : k + step], key=lambda p: -len(p[1]))
            size = np.array([len(p) for _, p in own])
            table = np.zeros((PIECE, len(own)), np.intp)
            for i, (_, p) in enumerate(own):
                table[: len(p), i] = p
            state = np.full((len(self.names), len(own)), self.dead, np.int32)
            met = np.zeros(state.shape, np.int64)
            for t in range(size[0]):
                n = np.searchsorted(-size, -t, "left")  # the longer pieces come first
                c = table[t, :n]
                to = self.go[state[:, :n] * np.intp(self.width) + c]
                ended = to < 0
                met[:, :n] += ended
                state[:, :n] = np.where(ended, self.first[:, c], to)
            np.add.at(counts, [i for i, _ in own], met.T)
        return counts

    def judge(self, texts: list[str | None]) -> list[tuple[str, float]]:
        found = [self.coded(t) if t and self.names else None for t in texts]
        known = [i for i, c in enumerate(found) if c is not None]
        counts = self.phrases([found[i] for i in known])
        out = [(UNKNOWN, 0.0)] * len(texts)
        for i, own in zip(known, counts):
            cost = own * self.bits / len(found[i])
            best = int(cost.argmin())
            rest = np.delete(cost, best)
            out[i] = (self.names[best], float((rest.min() - cost[best]) / rest.min()) if len(rest) else 1.0)
        return out


def _low(c: str) -> str:
    return c.lower() if len(c.lower()) == 1 else c


def _folded(text: str) -> str:
    return " ".join("".join(_low(c) if _letter(c) else " " for c in text).split())


@lru_cache(maxsize=1)
def _model(learned) -> Model:
    return Model(learned)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def learned(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> tuple[tuple[str, tuple[str, ...]], ...]:
    """The stretches of each language, from rows that are not held out: a bounded sample."""
    teaches = F.col(key).isNotNull() & ~held_out(F.col(key)) & F.col(lang).isNotNull()
    rows = docs.where(teaches & F.col(text).rlike("\\p{L}")).select(
        F.col(lang).alias("name"), F.xxhash64(F.col(key), F.col(text)).alias("h"), F.col(text).alias("t")
    )
    sizes = docs.where(teaches).groupBy(F.col(lang).alias("name")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "name").limit(LANGUAGES)
    # a hash threshold leaves a few hundred rows a language before any are put in order
    share = F.least(F.lit(1.0), F.lit(16.0 * SAMPLES) / F.col("n"))
    drawn = rows.join(F.broadcast(sizes), "name").where((F.pmod("h", F.lit(1 << 30)) / float(1 << 30)) < share)
    start = F.pmod(F.xxhash64("h"), F.greatest(F.lit(1), F.char_length("t") - STRETCH + 1)).cast("int")
    pieces = drawn.select("name", "h", F.substring(F.col("t"), start + 1, F.lit(STRETCH)).alias("t"))
    order = W.partitionBy("name").orderBy("h", "t")
    pieces = pieces.groupBy("name", "t").agg(F.min("h").alias("h")).withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= SAMPLES)
    by_name: dict[str, list[str]] = {}
    for r in pieces.orderBy("name", "nth").collect():  # LANGUAGES x SAMPLES x STRETCH characters at most
        by_name.setdefault(r["name"], []).append(r["t"])
    return tuple((name, tuple(ts)) for name, ts in by_name.items())


def identify(docs: DataFrame, examples: tuple, text: str = "text", into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` and two columns: the language of the whole text, and how clear it is."""

    @F.pandas_udf("lang string, score double")
    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = _model(examples)
        for b in texts:
            out, part, held = [], [], 0
            for t in b:
                part.append(t)
                held += len(t or "")
                if held >= 1 << 20:  # characters coded at once
                    out += model.judge(part)
                    part, held = [], 0
            yield pd.DataFrame(out + model.judge(part), columns=["lang", "score"])

    said = with_code(docs).withColumn("__said", judge(F.col(text)))
    return said.withColumns({into[0]: F.col("__said.lang"), into[1]: F.col("__said.score")}).drop("__said")


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return identify(rows, learned(docs)).drop("text")
