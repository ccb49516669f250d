"""Side-by-side check of a registered query against its DuckDB SQL.

Mirrors the driver's gate: same row count, same column names, same multiset of
rows (columns sorted by name, rows sorted). Usable from pytest and as a script:

    python tests/oracle_check.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, bool):
        return int(v)
    return v


def _key(row):
    return tuple((x is None, "" if x is None else str(type(x).__name__), x if x is not None else 0)
                 for x in row)


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e
    q = e.queries()[name]
    sql = e.oracle_sql().get(name)
    t0 = time.time()
    sdf = q(spark, sf_dir)
    s_cols = sorted(sdf.columns)
    s_rows = [tuple(_norm(r[c]) for c in s_cols) for r in sdf.collect()]
    t1 = time.time()
    out = {"query": name, "spark_rows": len(s_rows), "sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duck(sf_dir)
    rel = con.execute(sql)
    d_names = [d[0] for d in rel.description]
    d_rows_raw = rel.fetchall()
    d_cols = sorted(d_names)
    idx = [d_names.index(c) for c in d_cols]
    d_rows = [tuple(_norm(r[i]) for i in idx) for r in d_rows_raw]
    out["oracle_rows"] = len(d_rows)
    if s_cols != d_cols:
        out["status"] = f"columns differ: spark={s_cols} sql={d_cols}"
        return out
    if len(s_rows) != len(d_rows):
        out["status"] = "row count differs"
        return out
    a = sorted(s_rows, key=_key)
    b = sorted(d_rows, key=_key)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    out["status"] = "match" if not bad else f"{len(bad)} rows differ, e.g. {bad[:2]}"
    return out


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pricewise.session import local_session
    import __spark_entry__ as e
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(e.queries())
    spark = local_session(8)
    con = duck(sf_dir)
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as exc:  # report and continue
            r = {"query": n, "status": f"ERROR {type(exc).__name__}: {str(exc)[:300]}"}
        print(r, flush=True)


if __name__ == "__main__":
    main(sys.argv)
