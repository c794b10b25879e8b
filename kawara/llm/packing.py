"""Hierarchical packing of documents into windows of several lengths.

Every task packs its own documents in cells of about ``CELL_TOKENS`` tokens, so texts and ids are
never shuffled and memory is bounded by the cell. Inside a cell:

1. Whole windows of the longest tier are cut off long documents; the rest of a document is routed
   to the shortest tier that holds it (256, 512, 1024 or 2048 tokens).
2. Tiers are packed from long to short. A window opens with the longest rest of its tier; its gap
   is filled with the longest rest that fits, which comes from a shorter tier; where none fits,
   the gap is filled by a cut from the longest rest left, and what remains of that is routed anew.
3. What is left at the end of a cell is cut at powers of two, so no window has any padding.
4. Windows of a tier are dealt to step groups of equal size in tokens, in snake order of their
   attention cost (sum of squared piece lengths), so that groups weigh about the same.

Defined results. NULL text is an empty document of the one closing id. Documents longer than a
cell make a cell of their own. Repeated rows are packed one by one. Sequence ids are unique: task,
cell, and number in the cell.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kawara.llm import tokens
from kawara.llm.common import documents, with_code

TIERS = (256, 512, 1024, 2048)
CLOSING_ID = 1
CELL_TOKENS = 1 << 21
GROUP_TOKENS = 1 << 16

Piece = tuple[int, int, int]  # document in the cell, start, length


class Rests:
    """Rests of documents by length; the longest up to a bound is found by a bit mask."""

    def __init__(self):
        self.by_length: dict[int, list[Piece]] = {}
        self.mask = 0

    def add(self, p: Piece) -> None:
        self.by_length.setdefault(p[2], []).append(p)
        self.mask |= 1 << p[2]

    def longest(self, bound: int) -> int:
        return (self.mask & ((1 << (bound + 1)) - 1)).bit_length() - 1

    def take(self, length: int) -> Piece:
        held = self.by_length[length]
        p = held.pop()
        if not held:
            self.mask &= ~(1 << length)
        return p


def pack(lengths: list[int], tiers=TIERS) -> list[tuple[int, list[Piece]]]:
    """(window length, pieces) that hold every token of the documents once, without padding."""
    top, rests, out = tiers[-1], Rests(), []
    for d, n in enumerate(lengths):
        whole = n // top * top
        out += [(top, [(d, s, top)]) for s in range(0, whole, top)]
        if n > whole:
            rests.add((d, whole, n - whole))
    for i in range(len(tiers) - 1, -1, -1):
        tier, shorter = tiers[i], tiers[i - 1] if i else 0
        while (opener := rests.longest(tier)) > shorter:
            pieces, gap = [rests.take(opener)], tier - opener
            while gap and rests.mask:
                fits = rests.longest(gap)
                if fits > 0:
                    pieces.append(rests.take(fits))
                    gap -= fits
                else:
                    d, s, n = rests.take(rests.mask.bit_length() - 1)
                    pieces.append((d, s, gap))
                    rests.add((d, s + gap, n - gap))
                    gap = 0
            out += [(tier, pieces)] if not gap else at_powers_of_two(pieces)
    return out


def at_powers_of_two(pieces: list[Piece]) -> list[tuple[int, list[Piece]]]:
    """The last, partial window as windows whose lengths are powers of two."""
    left, out = sum(p[2] for p in pieces), []
    todo = list(reversed(pieces))
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        window, gap = [], size
        while gap:
            d, s, n = todo.pop()
            cut = min(n, gap)
            window.append((d, s, cut))
            gap -= cut
            if n > cut:
                todo.append((d, s + cut, n - cut))
        out.append((size, window))
    return out


def step_groups(windows: list[tuple[int, list[Piece]]], group_tokens: int = GROUP_TOKENS) -> list[int]:
    """The group of each window, numbered from 0 over the tiers of the cell."""
    out, base = [0] * len(windows), 0
    by_tier: dict[int, list[int]] = {}
    for i, (tier, _) in enumerate(windows):
        by_tier.setdefault(tier, []).append(i)
    for tier in sorted(by_tier, reverse=True):
        own = sorted(by_tier[tier], key=lambda i: -sum(p[2] ** 2 for p in windows[i][1]))
        n = max(1, -(-len(own) * tier // group_tokens))
        for k, i in enumerate(own):
            lap, at = divmod(k, n)
            out[i] = base + (at if lap % 2 == 0 else n - 1 - at)
        base += n
    return out


def sequences(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    name: str = tokens.VOCABULARY,
    tiers=TIERS,
    cell_tokens: int = CELL_TOKENS,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece; with ``keep_ids`` its ids as well, ready to be written."""
    kind = docs.schema[key].dataType.simpleString()
    schema = (
        "id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
        "offset long, sequence_length int, step_group long" + (", ids array<int>" if keep_ids else "")
    )
    if any(t & (t - 1) for t in tiers):
        raise ValueError("tiers must be powers of two")

    def cell(held: list, number: int) -> pd.DataFrame:
        windows = pack([len(ids) for _, ids in held], tiers)
        rows, base = [], (TaskContext.get().partitionId() << 40) + (number << 22)
        for w, ((size, pieces), group) in enumerate(zip(windows, step_groups(windows))):
            offset = 0
            for d, s, n in pieces:
                own, ids = held[d]
                part = ids[s : s + n]
                row = (own, s, n, zlib.crc32(part.tobytes()), len(ids), base + w, offset, size, base + group)
                rows.append((*row, part.astype(np.int32)) if keep_ids else row)
                offset += n
        return pd.DataFrame(rows, columns=[f.split()[0] for f in schema.split(", ")])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, total, number = [], 0, 0
        close = np.array([CLOSING_ID], "<u4")
        for b in batches:
            for own, t in zip(b["id"], b["text"]):
                ids = np.concatenate([tokens.ids_of(t, name).astype("<u4"), close])
                held.append((own, ids))
                total += len(ids)
                if total >= cell_tokens:
                    yield cell(held, number)
                    held, total, number = [], 0, number + 1
        if held:
            yield cell(held, number)

    # ids as text: pandas turns integers beside NULLs into floats
    rows = docs.select(F.col(key).cast("string").alias("id"), F.col(text).alias("text"))
    out = with_code(rows).mapInPandas(run, schema)
    return out.select(F.col("id").cast(kind).alias(key), *out.columns[1:])


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences(documents(spark, sf_dir))
