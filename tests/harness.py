"""Run registered queries on Spark and their oracle SQL on DuckDB, compare.

    python -m tests.harness [sf_dir] [name ...]

Comparison: same column names, same row count, and the same multiset of rows
after column sort.  ``exact`` compares values as returned; ``approx`` pairs
the rows in a sort on coarsely rounded values and then allows a relative
difference of 1e-9 between floats (rounding alone would flip at ties).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, approx):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if v == 0:
            return 0.0
        if approx:
            return float(f"{v:.9g}")
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, bool):
        return int(v)
    return v


def _rows(cols, rows, approx):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], approx) for i in order) for r in rows]
    out.sort(key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))
    return out


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return dict(name=name, rows=len(s_rows), oracle=False, spark_s=round(t1 - t0, 2))
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    out = dict(name=name, rows=len(s_rows), oracle_rows=len(d_rows),
               cols_match=sorted(s_cols) == sorted(d_cols),
               spark_s=round(t1 - t0, 2), duck_s=round(t2 - t1, 2))
    if not out["cols_match"]:
        out["cols"] = (sorted(s_cols), sorted(d_cols))
        return out
    out["exact"] = _rows(s_cols, s_rows, False) == _rows(d_cols, d_rows, False)
    a = _paired(s_cols, s_rows)
    b = _paired(d_cols, d_rows)
    diff = [(x, y) for x, y in zip(a, b) if not _close(x, y)]
    out["approx"] = len(a) == len(b) and not diff
    if diff:
        out["first_diff"] = diff[:2]
    return out


def _paired(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    vals = [tuple(_norm(r[i], False) for i in order) for r in rows]

    def key(t):
        return tuple((x is None, str(type(x)),
                      float(f"{x:.6g}") if isinstance(x, float) else (x if x is not None else 0))
                     for x in t)
    return sorted(vals, key=key)


def _close(x, y):
    for u, v in zip(x, y):
        if isinstance(u, float) and isinstance(v, float):
            if not math.isclose(u, v, rel_tol=1e-9, abs_tol=1e-12):
                return False
        elif u != v:
            return False
    return len(x) == len(y)


def main(argv):
    from spendcast.session import build_session
    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    ok = True
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            r = dict(name=name, error=f"{type(e).__name__}: {str(e)[:400]}")
        good = r.get("approx", not r.get("oracle", True) is False) and "error" not in r
        if "oracle" in r:
            good = "error" not in r
        ok &= bool(good)
        print(("OK  " if good else "BAD ") + str(r), flush=True)
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
