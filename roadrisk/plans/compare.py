"""Run a registered query on Spark and its SQL twin on DuckDB; compare.

Used by the tests and by ``python -m roadrisk.plans.compare <sf_dir> [names]``.
The comparison is order-insensitive on rows, with columns matched by name:
the same rule the harness applies.
"""

from __future__ import annotations

import math
import os
import sys

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duckdb_con(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True))
    return v


def compare(spark, con, name: str, sf_dir: str, max_diff: int = 5) -> dict:
    from roadrisk.plans.oracle_queries import ORACLE
    from roadrisk.plans.registry import QUERIES
    sdf = QUERIES[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = sdf.collect()
    res = con.execute(ORACLE[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_cols": s_cols, "oracle_cols": d_cols}
    if sorted(s_cols) != sorted(d_cols):
        out["ok"] = False
        out["why"] = "columns differ"
        return out
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    s_set = sorted((tuple(_norm(r[i]) for i in si) for r in s_rows), key=repr)
    d_set = sorted((tuple(_norm(r[i]) for i in di) for r in d_rows), key=repr)
    out["ok"] = s_set == d_set
    if not out["ok"]:
        from collections import Counter
        sc, dc = Counter(s_set), Counter(d_set)
        out["only_spark"] = list((sc - dc).elements())[:max_diff]
        out["only_oracle"] = list((dc - sc).elements())[:max_diff]
        out["columns"] = order
    return out


def main(argv: list[str]) -> int:
    from roadrisk.plans.oracle_queries import ORACLE
    from roadrisk.session import local_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or sorted(ORACLE)
    spark = local_session()
    con = duckdb_con(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, sf_dir)
        except Exception as e:  # report and continue with the next query
            r = {"name": n, "ok": False, "why": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += not r["ok"]
        print(("OK   " if r["ok"] else "FAIL ") + n, {k: v for k, v in r.items() if k not in ("name", "ok")}
              if not r["ok"] else f"rows={r['spark_rows']}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
