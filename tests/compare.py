"""Compare registered queries with their SQL on one data folder.

    python tests/compare.py /root/testdata/sf0.01 [query ...]
"""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda c: columns[c])

    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
        if isinstance(v, bool) or v is None or isinstance(v, str):
            return repr(v)
        return repr(int(v)) if float(v).is_integer() else repr(float(v))

    def number(v):
        return repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else cell(v)

    return sorted(tuple(number(r[c]) for c in order) for r in rows)


def compare(spark, con, name, sf_dir):
    """None when equal, else a short description of the first difference."""
    df = entry.queries()[name](spark, sf_dir)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    want = canonical(cols, cur.fetchall())
    if sorted(df.columns) != sorted(cols):
        return f"columns {sorted(df.columns)} != {sorted(cols)}"
    if got == want:
        return None
    gs, ws = set(got), set(want)
    return (
        f"rows {len(got)} vs {len(want)}; only here {sorted(gs - ws)[:2]}, only in SQL {sorted(ws - gs)[:2]}"
    )


if __name__ == "__main__":
    from kawara.session import session

    folder, only = sys.argv[1], sys.argv[2:]
    s = session("local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="12g")
    s.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for q in entry.queries():
        if only and q not in only:
            continue
        t0 = time.time()
        try:
            bad = compare(s, con, q, folder)
        except Exception as e:  # report and go on with the next query
            bad = f"{type(e).__name__}: {str(e)[:500]}"
        print(f"{q:24s} {time.time() - t0:6.2f}s {'ok' if bad is None else 'DIFF ' + bad}", flush=True)
