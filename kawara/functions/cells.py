"""Grid cells of polygons inside tasks: cutting edges along the grid, and holding points and small
polygons against the pieces. Spark deals and sorts the rows; here they are Arrow batches.

The formulas are those of ``geometry`` on the same doubles, so both give the same answers. What is
held at a time is bounded by one polygon when cutting, and by the points of one cell and the edges
of one polygon in it when matching.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

AXES = ("x1", "y1", "x2", "y2")
ROWS = 1 << 13  # cell rows gathered before they are worked on
PAIRS = 1 << 17  # pairs, or pieces of edges, held at a time
POINT, SHAPE, PIECE, VERTEX = range(4)  # what a row of ``meet`` is, in the order of a cell's rows


def _items(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and place of every item, where owner i has ``n[i]`` of them."""
    owner = np.repeat(np.arange(len(n)), n)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)


def _parts(cost: np.ndarray, groups: np.ndarray | None = None) -> Iterator[slice]:
    """Slices of about ``PAIRS`` in cost; rows of one group (ascending numbers) stay together."""
    number = (np.cumsum(cost) - cost) // PAIRS
    if groups is not None and len(groups):
        first = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
        number = np.repeat(number[first], np.diff(np.r_[first, len(groups)]))
    at = np.r_[np.flatnonzero(np.r_[True, number[1:] != number[:-1]]), len(number)] if len(number) else []
    for a, b in zip(at, at[1:]):
        yield slice(a, b)


def _numbers(table: pa.Table, name: str, missing=None) -> np.ndarray:
    col = table.column(name)
    return (col if missing is None else col.fill_null(missing)).to_numpy()


def _edges(lists: pa.ListArray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Lengths of the lists of edges (null: 0) and the coordinates of all edges; unknown ones are NaN."""
    n = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
    flat = lists.flatten()
    return n, [c.to_numpy(zero_copy_only=False).astype(float) for c in flat.flatten()]


def _x_at(e: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    x1, y1, x2, y2 = e
    with np.errstate(all="ignore"):
        return x1 + (y - y1) * (x2 - x1) / (y2 - y1)


def _side(e: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x1, y1, x2, y2 = e
    return (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)


def _right(e: list[np.ndarray], side: np.ndarray) -> np.ndarray:
    x1, y1, x2, y2 = e
    return (side < 0) | ((side == 0) & ((x2 < x1) | ((x2 == x1) & (y2 > y1))))


def _within(e: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Is the point in the box of the edge?"""
    x1, y1, x2, y2 = e
    return (np.minimum(x1, x2) <= x) & (x <= np.maximum(x1, x2)) & (np.minimum(y1, y2) <= y) & (y <= np.maximum(y1, y2))


# --- cutting ---------------------------------------------------------------------------


def _starts(e: list[np.ndarray], first: np.ndarray) -> np.ndarray:
    """Does an edge begin a ring? True for the first ones, and for all that don't continue the one before."""
    out = first.copy()
    out[1:] |= (e[0][1:] != e[2][:-1]) | (e[1][1:] != e[3][:-1])
    return out


def cut(size: float, margin: float, chunk: int, ids: list[str], vertices: bool = False):
    """A function for ``mapInArrow``: blocks of edges (ids, _n, _b, _edges) -> cell rows of whole polygons.

    The ``_n`` blocks of a polygon follow each other. Cell rows come as lists, ``_re``, of the cells of a
    polygon in a grid row. A cell row holds at most ``chunk`` of the edges that pass the cell, numbered by
    ``_block``; row -1 tells that the cell's left side lies inside (``base``). With ``vertices``, rows of block
    -2 hold a vertex of each ring, as an edge without length.
    """

    def rows(table: pa.Table, poly, cy, cx, block, base, n, e) -> pa.RecordBatch:
        def lists(n, values):
            return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), values)

        edges = lists(n, pa.StructArray.from_arrays([pa.array(c) for c in e], list(AXES)))
        made = pa.StructArray.from_arrays([pa.array(cx), pa.array(block), pa.array(base), edges], ["cx", "_block", "base", "edges"])
        first = np.flatnonzero(np.r_[True, (poly[1:] != poly[:-1]) | (cy[1:] != cy[:-1])])
        columns = [table.column(c).combine_chunks().take(pa.array(poly[first])) for c in ids]
        columns += [pa.array(cy[first]), lists(np.diff(np.r_[first, len(cy)]), made)]
        return pa.RecordBatch.from_arrays(columns, [*ids, "cy", "_re"])

    def band(table, poly, e, low, high):
        """Cell rows of the edges ``e`` of polygons (numbers of their first rows) in grid rows low to high."""
        owner, place = _items(high - low + 1)
        cy = low[owner] + place
        order = np.lexsort((cy, poly[owner]))
        owner, cy = owner[order], cy[order]
        poly, e = poly[owner], [c[owner] for c in e]
        x1, y1, x2, y2 = e
        flat, left, right = y1 == y2, np.minimum(x1, x2), np.maximum(x1, x2)
        bottom = np.maximum(cy * size, np.minimum(y1, y2))
        top = np.minimum((cy + 1) * size, np.maximum(y1, y2))
        a = np.where(flat, x1, np.clip(_x_at(e, bottom), left, right))
        b = np.where(flat, x2, np.clip(_x_at(e, top), left, right))
        c0 = np.floor(np.minimum(a, b) / size - margin).astype(np.int64)
        c1 = np.floor(np.maximum(a, b) / size + margin).astype(np.int64)
        group = np.cumsum(np.r_[True, (poly[1:] != poly[:-1]) | (cy[1:] != cy[:-1])])
        for s in _parts(c1 - c0 + 1, group):
            owner, place = _items(c1[s] - c0[s] + 1)
            cx, owner = c0[s][owner] + place, owner + s.start
            order = np.lexsort((cx, group[owner]))
            cx, owner = cx[order], owner[order]
            new = np.r_[True, (cx[1:] != cx[:-1]) | (group[owner[1:]] != group[owner[:-1]])]
            cell = np.flatnonzero(new)
            place = np.arange(len(cx)) - np.repeat(cell, np.diff(np.r_[cell, len(cx)]))
            first = np.flatnonzero(place % chunk == 0)
            n, o = np.diff(np.r_[first, len(cx)]), owner[first]
            yield rows(table, poly[o], cy[o], cx[first], place[first] // chunk, np.zeros(len(o), np.int32), n, [c[owner] for c in e])

        mid = (cy + 0.5) * size
        crossing = np.flatnonzero((y1 > mid) != (y2 > mid))
        col = np.floor(_x_at([c[crossing] for c in e], mid[crossing]) / size).astype(np.int64)
        order = np.lexsort((col, group[crossing]))
        crossing, col = crossing[order], col[order]
        # inside between the first and the second crossing of a row, the third and the fourth, and so on
        start = np.r_[True, group[crossing[1:]] != group[crossing[:-1]]]
        nth = np.arange(len(col)) - np.maximum.accumulate(np.where(start, np.arange(len(col)), 0)) if len(col) else col
        odd = np.flatnonzero((nth[:-1] % 2 == 0) & ~start[1:]) if len(col) else col
        odd = odd[col[odd + 1] > col[odd]]
        for s in _parts(col[odd + 1] - col[odd]):
            owner, place = _items(col[odd[s] + 1] - col[odd[s]])
            at, cx = crossing[odd[s]][owner], col[odd[s]][owner] + 1 + place
            none, zeros = [np.zeros(0)] * 4, np.zeros(len(cx), np.int64)
            yield rows(table, poly[at], cy[at], cx, zeros - 1, np.ones(len(cx), np.int32), zeros, none)

    def polygons(table: pa.Table):
        n, e = _edges(table.column("_edges").combine_chunks())
        poly = np.repeat(np.maximum.accumulate(np.where(_numbers(table, "_b") == 0, np.arange(table.num_rows), 0)), n)
        if vertices and len(poly):
            at = np.flatnonzero(_starts(e, np.r_[True, poly[1:] != poly[:-1]]) & ~np.isnan(e[0] + e[1]))
            x, y = e[0][at], e[1][at]
            cx, cy = (np.floor(v / size).astype(np.int64) for v in (x, y))
            one = np.ones(len(at), np.int64)
            if len(at):
                yield rows(table, poly[at], cy, cx, -2 * one, np.zeros(len(at), np.int32), one, [x, y, x, y])
        known = ~np.isnan(e[0] + e[1] + e[2] + e[3])
        poly, e = poly[known], [c[known] for c in e]
        low = np.floor(np.minimum(e[1], e[3]) / size - margin).astype(np.int64)
        high = np.floor(np.maximum(e[1], e[3]) / size + margin).astype(np.int64)
        for s in _parts(high - low + 1, poly):
            p, es, lo, hi = poly[s], [c[s] for c in e], low[s], high[s]
            bands = 1 + int((hi - lo + 1).sum()) // PAIRS
            step = -(-int(hi.max() - lo.min() + 1) // bands)
            for at in range(int(lo.min()), int(hi.max()) + 1, step):
                i = np.flatnonzero((lo < at + step) & (hi >= at))
                if len(i):
                    yield from band(table, p[i], [c[i] for c in es], np.maximum(lo[i], at), np.minimum(hi[i], at + step - 1))

    def run(batches):
        held, rest = [], 0
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < max(ROWS // 8, 2 * rest):
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            more = _numbers(table, "_b")[-1] + 1 < _numbers(table, "_n")[-1]
            done = np.flatnonzero(_numbers(table, "_b") == 0)[-1] if more else table.num_rows
            if done:
                yield from polygons(table.slice(0, done).combine_chunks())
            held = table.slice(done).to_batches()
            rest = table.num_rows - done
        if held:
            yield from polygons(pa.Table.from_batches(held).combine_chunks())

    return run


# --- matching --------------------------------------------------------------------------


def meet(size: float, keys: list[str]):
    """A function for ``mapInArrow``: rows sorted by cell, _side, _pk and _block -> (_l, _r) of what meets.

    A cell's rows are its points and small polygons (``_l``), and, polygon by polygon (``_pk``), the cell rows
    of the others (``_r``), then vertices of those; points and vertices are edges without length. A point meets
    a polygon strictly inside, a small polygon one that holds a vertex of its rings, touches its edges or has a
    vertex inside it. Copies of a cell row count once.
    """

    def changes(table: pa.Table, names: list[str]) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[0] = True
        for c in names:
            v = _numbers(table, c)
            new[1:] |= v[1:] != v[:-1]
        return new

    def shares(n, each):
        """Slices of units: runs by the lefts ``n`` of their cells, each worth ``each`` pairs."""
        each = np.maximum(each, 1)
        runs = np.flatnonzero(n)
        pieces = -(-n[runs] * each[runs] // PAIRS)
        step = -(-n[runs] // np.minimum(pieces, n[runs]))
        owner, place = _items(-(-n[runs] // step))
        run, at = runs[owner], place * step[owner]
        count = np.minimum(step[owner], n[run] - at)
        for s in _parts(count * each[run]):
            owner, place = _items(count[s])
            yield run[s][owner], at[s][owner] + place

    def in_points(px, py, e, along, mid, n, first, base, run, point):
        """Which units, a point and a polygon's run each, have the point strictly inside?"""
        unit, place = _items(n[run])
        edge = first[run][unit] + place
        x = px[point][unit]
        near = along[edge] | ((np.minimum(e[0], e[2])[edge] <= x) & (x <= np.maximum(e[0], e[2])[edge]))
        unit, edge, x = unit[near], edge[near], x[near]
        y, es = py[point][unit], [c[edge] for c in e]
        at_mid, side = _right(es, _side(es, x, mid[edge])), _side(es, x, y)
        flip = (along[edge] & (at_mid == (es[3] > es[1]))) != (((es[0] > x) != (es[2] > x)) & (at_mid != _right(es, side)))
        on_edge = (side == 0) & _within(es, x, y)
        odd = (base[run] + np.bincount(unit[flip], minlength=len(run))) % 2 == 1
        return odd & (np.bincount(unit[on_edge], minlength=len(run)) == 0)

    def boxes(n, e):
        """Bounds of the lists of edges."""
        owner = np.repeat(np.arange(len(n)), n)
        out = [np.full(len(n), v) for v in (np.inf, np.inf, -np.inf, -np.inf)]
        for o, c, f in zip(out, (0, 1, 0, 1), (np.minimum, np.minimum, np.maximum, np.maximum)):
            f.at(o, owner, e[c])
        return out

    def touching(box, sn, s0, se, e, n, first, run, shape):
        """Which units, a small polygon and a polygon's run each, have edges that share a point?"""
        unit, place = _items(n[run])
        edge, k = first[run][unit] + place, shape[unit]
        x1, y1, x2, y2 = e
        near = (np.minimum(x1, x2)[edge] <= box[2][k]) & (np.maximum(x1, x2)[edge] >= box[0][k])
        near &= (np.minimum(y1, y2)[edge] <= box[3][k]) & (np.maximum(y1, y2)[edge] >= box[1][k])
        unit, edge, k = unit[near], edge[near], k[near]
        hit = np.zeros(len(run), bool)
        for s in _parts(sn[k]):
            owner, place = _items(sn[k[s]])
            a, b, u = s0[k[s]][owner] + place, edge[s][owner], unit[s][owner]
            ea, eb = [c[a] for c in se], [c[b] for c in e]
            p, q = _side(eb, ea[0], ea[1]), _side(eb, ea[2], ea[3])
            v, w = _within(ea, eb[0], eb[1]), _within(ea, eb[2], eb[3])
            # without these neither the lines cross nor does an end lie on the other edge
            may = np.flatnonzero(~((p > 0) & (q > 0) | (p < 0) & (q < 0)) | v | w)
            ea, eb, p, q, v, w = [c[may] for c in ea], [c[may] for c in eb], p[may], q[may], v[may], w[may]
            f, g = _side(ea, eb[0], eb[1]), _side(ea, eb[2], eb[3])
            touch = (np.sign(p) * np.sign(q) < 0) & (np.sign(f) * np.sign(g) < 0) | (f == 0) & v | (g == 0) & w
            touch |= (p == 0) & _within(eb, ea[0], ea[1]) | (q == 0) & _within(eb, ea[2], ea[3])
            hit[u[may[touch]]] = True
        return hit

    def holding(box, sn, s0, se, x, y, n, first, run, shape):
        """Which units, a small polygon and a run of vertices each, have a vertex inside the small polygon?"""
        unit, place = _items(n[run])
        vertex, k = first[run][unit] + place, shape[unit]
        vx, vy = x[vertex], y[vertex]
        near = (box[0][k] <= vx) & (vx <= box[2][k]) & (box[1][k] <= vy) & (vy <= box[3][k])
        unit, k, vx, vy = unit[near], k[near], vx[near], vy[near]
        hit = np.zeros(len(run), bool)
        for s in _parts(sn[k]):
            owner, place = _items(sn[k[s]])
            es = [c[s0[k[s]][owner] + place] for c in se]
            px, py = vx[s][owner], vy[s][owner]
            crossed = ((es[1] > py) != (es[3] > py)) & (_right(es, _side(es, px, py)) == (es[3] > es[1]))
            odd = np.bincount(owner[crossed], minlength=s.stop - s.start) % 2 == 1
            hit[unit[s][odd]] = True
        return hit

    def matched(table: pa.Table):
        cell = np.cumsum(changes(table, keys)) - 1
        side, pk = _numbers(table, "_side"), _numbers(table, "_pk")
        n_cells = cell[-1] + 1
        length, xs = _edges(table.column("_es").combine_chunks())
        begin = np.cumsum(length) - length
        whole = table.column("_l").combine_chunks(), table.column("_r").combine_chunks()

        def pairs(left, right):
            l, r = (w.take(pa.array(i)) for w, i in zip(whole, (left, right)))
            return pa.RecordBatch.from_arrays([l, r], ["_l", "_r"])

        def spans(rows):
            """Where the rows of each cell begin, and how many they are."""
            n = np.bincount(cell[rows], minlength=n_cells)
            return np.cumsum(n) - n, n

        def runs(rows):
            """Polygon by polygon in a cell: numbers of the runs, the first row and the cell of each."""
            new = np.r_[True, (pk[rows[1:]] != pk[rows[:-1]]) | (cell[rows[1:]] != cell[rows[:-1]])] if len(rows) else np.zeros(0, bool)
            return np.cumsum(new) - 1, rows[new], cell[rows[new]]

        rows = np.flatnonzero(side == PIECE)
        run, head, at = runs(rows)
        block = _numbers(table, "_block")[rows]
        once = np.ones(len(rows), bool)
        once[1:] = (run[1:] != run[:-1]) | (block[1:] != block[:-1])
        rows, run = rows[once], run[once]
        base = np.bincount(run, weights=_numbers(table, "base")[rows], minlength=len(head)).astype(np.int64)
        n = np.bincount(run, weights=length[rows], minlength=len(head)).astype(np.int64)
        first = np.cumsum(n) - n
        owner, place = _items(length[rows])
        e = [c[begin[rows][owner] + place] for c in xs]

        points, shapes = np.flatnonzero(side == POINT), np.flatnonzero(side == SHAPE)
        px, py = xs[0][begin[points]], xs[1][begin[points]]
        columns = [_numbers(table, c) for c in ("cx", "cy")]
        if len(shapes):  # the vertices in the cell are points, too
            k, place = _items(length[shapes])
            es = [c[begin[shapes][k] + place] for c in xs]
            here = _starts(es, place == 0)
            for v, c in zip(es, columns):
                here &= np.floor(v / size) == c[shapes][k]
            points, px, py = (np.r_[a, b[here]] for a, b in ((points, shapes[k]), (px, es[0]), (py, es[1])))
            order = np.argsort(points, kind="stable")
            points, px, py = points[order], px[order], py[order]
        if len(points) and len(rows):
            p0, pn = spans(points)
            cx, cy = (c[rows][owner] for c in columns)
            mid = (cy + 0.5) * size
            along = (e[1] > mid) != (e[3] > mid)
            along[along] = np.floor(_x_at([c[along] for c in e], mid[along]) / size) == cx[along]
            for r, place in shares(pn[at], n):
                p = p0[at[r]] + place
                hit = in_points(px, py, e, along, mid, n, first, base, r, p)
                yield pairs(points[p[hit]], head[r[hit]])

        if not len(shapes):
            return
        s0, sn = spans(shapes)
        m = length[shapes]
        owner, place = _items(m)
        box, m0 = boxes(m, [c[begin[shapes][owner] + place] for c in xs]), begin[shapes]
        for r, place in shares(np.where(n > 0, sn[at], 0), n):
            k = s0[at[r]] + place
            hit = touching(box, m, m0, xs, e, n, first, r, k)
            yield pairs(shapes[k[hit]], head[r[hit]])
        rows = np.flatnonzero(side == VERTEX)
        run, head, at = runs(rows)
        n = np.bincount(run, minlength=len(head))
        for r, place in shares(sn[at], n):
            k = s0[at[r]] + place
            hit = holding(box, m, m0, xs, xs[0][begin[rows]], xs[1][begin[rows]], n, np.cumsum(n) - n, r, k)
            yield pairs(shapes[k[hit]], head[r[hit]])

    def run(batches):
        held, rest = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) < max(ROWS, 2 * rest):
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            cell = np.flatnonzero(changes(table, keys))[-1]
            last = np.flatnonzero(changes(table, [*keys, "_side", "_pk"]))[-1]  # may go on in the next batch
            side = _numbers(table, "_side")
            lefts = np.searchsorted(side[cell:], PIECE)
            if side[last] < PIECE:
                ready, goes_on = table.slice(0, cell), [table.slice(cell)]
            else:  # the rows of this cell's polygons need its points and small polygons again
                ready, goes_on = table.slice(0, last), [table.slice(cell, lefts), table.slice(last)]
            if ready.num_rows:
                yield from matched(ready.combine_chunks())
            held = [b for t in goes_on for b in t.to_batches()]
            rest = sum(b.num_rows for b in held)
        if held:
            yield from matched(pa.Table.from_batches(held).combine_chunks())

    return run
