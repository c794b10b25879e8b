"""Well-known binary for exchange with other tools: two small Arrow functions.

The engine itself never needs them; they translate at the edge, when a table is read from or
written for software that expects a binary geometry column.
"""

from __future__ import annotations

import json
import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

POLYGONS = "array<array<array<array<double>>>>"


def encode(polygons) -> bytes | None:
    if polygons is None:
        return None
    parts = []
    for rings in polygons:
        body = [struct.pack("<BII", 1, 3, len(rings))]
        for ring in rings:
            pts = np.array([[p[0], p[1]] for p in ring], dtype="<f8")
            body.append(struct.pack("<I", len(pts)) + pts.tobytes())
        parts.append(b"".join(body))
    if len(parts) == 1:
        return parts[0]
    return struct.pack("<BII", 1, 6, len(parts)) + b"".join(parts)


def decode(blob) -> list | None:
    """Polygon or multi-polygon -> parts of rings of [x, y]; any extra dimension is dropped."""
    if blob is None:
        return None
    pos = 0

    def header():
        nonlocal pos
        order = "<" if blob[pos] == 1 else ">"
        code = struct.unpack_from(order + "I", blob, pos + 1)[0]
        pos += 5
        dims = 2
        if code & 0x20000000:  # spatial reference id follows
            pos += 4
        if code & 0x80000000:
            dims += 1
        if code & 0x40000000:
            dims += 1
        code &= 0x0FFFFFFF
        dims += {0: 0, 1: 1, 2: 1, 3: 2}[code // 1000]
        return order, code % 1000, dims

    def polygon(order, dims):
        nonlocal pos
        (n,) = struct.unpack_from(order + "I", blob, pos)
        pos += 4
        rings = []
        for _ in range(n):
            (k,) = struct.unpack_from(order + "I", blob, pos)
            pos += 4
            pts = np.frombuffer(blob, dtype=order + "f8", count=k * dims, offset=pos).reshape(k, dims)
            pos += 8 * k * dims
            rings.append(pts[:, :2].tolist())
        return rings

    order, kind, dims = header()
    if kind == 3:
        return [polygon(order, dims)]
    if kind == 6:
        (n,) = struct.unpack_from(order + "I", blob, pos)
        pos += 4
        parts = []
        for _ in range(n):
            o, _, d = header()
            parts.append(polygon(o, d))
        return parts
    raise ValueError(f"geometry type {kind} is not polygonal")


# both sides cross into Python as flat text or bytes: deeply nested Arrow arrays are slow there
@F.pandas_udf(T.BinaryType())
def _wkb_of_json(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else encode(json.loads(t)))


@F.pandas_udf(T.StringType())
def _json_of_wkb(blob: pd.Series) -> pd.Series:
    return blob.map(lambda b: None if b is None else json.dumps(decode(b)))


def wkb_of(polygons: Column) -> Column:
    return _wkb_of_json(F.to_json(polygons))


def polygons_of(blob: Column) -> Column:
    return F.from_json(_json_of_wkb(blob), POLYGONS)
