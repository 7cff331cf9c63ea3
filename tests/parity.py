"""Run registered queries in Spark and their SQL oracles in DuckDB; compare.

    python tests/parity.py [sf_dir] [name ...]

Prints one line per query: rows, column names, and whether the values agree
exactly (order-insensitive) or only within 1e-9 relative.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tessera.sources.tables import TABLES  # noqa: E402


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "toArray"):
        return tuple(float(x) for x in v.toArray())
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def key(row):
    return tuple((x is None, str(type(x)) if x is not None else "", x if not isinstance(x, float) else round(x, 6)) for x in row)


def close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))
    if isinstance(a, float) and isinstance(b, int) or isinstance(a, int) and isinstance(b, float):
        return float(a) == float(b)
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(close(x, y) for x, y in zip(a, b))
    return a == b


def compare(srows, scols, drows, dcols):
    if sorted(scols) != sorted(dcols):
        return f"COLUMNS spark={scols} duck={dcols}"
    if len(srows) != len(drows):
        return f"ROWS spark={len(srows)} duck={len(drows)}"
    order = sorted(scols)
    si = [scols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    s = sorted((tuple(norm(r[i]) for i in si) for r in srows), key=key)
    d = sorted((tuple(norm(r[i]) for i in di) for r in drows), key=key)
    if s == d:
        return "EXACT"
    if all(close(a, b) for a, b in zip(s, d)):
        return "CLOSE"
    for a, b in zip(s, d):
        if not close(a, b):
            return f"VALUES first diff spark={a} duck={b}"
    return "VALUES"


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    from tessera.session import get_spark
    import __spark_entry__ as E

    spark = get_spark("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in (names or list(qs)):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in orc:
            print(f"{name:28s} rows={len(srows):7d} (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(orc[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} DUCK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        res = compare(srows, scols, drows, dcols)
        if res not in ("EXACT", "CLOSE"):
            bad += 1
        print(f"{name:28s} rows={len(srows):7d} {res} {ts:.1f}s")
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
