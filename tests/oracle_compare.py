"""Run a registered query in Spark and its oracle SQL in DuckDB, compare results.

Usage: python -m tests.oracle_compare [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def digest(columns: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return len(rows), cols, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, con, name: str, sf_dir: str, queries, sqls) -> dict:
    t0 = time.time()
    df = queries[name](spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    rel = con.execute(sqls[name])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    t2 = time.time()
    s = digest(df.columns, srows)
    d = digest(dcols, drows)
    out = {"name": name, "rows": (s[0], d[0]), "cols_ok": s[1] == d[1], "hash_ok": s[2] == d[2],
           "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    if not (out["cols_ok"] and out["hash_ok"]):
        out["cols"] = (s[1], d[1])
        sset = {tuple(_norm(x) for x in r) for r in srows}
        dset = {tuple(_norm(x) for x in r) for r in drows}
        out["only_spark"] = sorted(sset - dset, key=repr)[:5]
        out["only_duck"] = sorted(dset - sset, key=repr)[:5]
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from quarry.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            df = qs[name](spark, sf_dir)
            print({"name": name, "rows_only": df.count()}, flush=True)
            continue
        try:
            r = compare(spark, con, name, sf_dir, qs, sqls)
        except Exception as e:  # report and go on
            r = {"name": name, "error": repr(e)[:800]}
        ok = r.get("cols_ok") and r.get("hash_ok")
        bad += not ok
        print(("OK  " if ok else "BAD ") + repr(r), flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
