"""Run catalog queries against their DuckDB oracles, as the driver does.

    python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import hashlib
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

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
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return [_norm(x) for x in v]
    return v


def fingerprint(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    body = sorted(json.dumps([_norm(r[i]) for i in order], default=str, ensure_ascii=False) for r in rows)
    return cols, len(rows), hashlib.md5("\n".join(body).encode()).hexdigest()


def compare(spark, sf_dir: str, keys=None, con=None):
    from __spark_entry__ import oracle_sql, queries
    con = con or duck(sf_dir)
    qs, sql = queries(), oracle_sql()
    out = {}
    for k in keys or sorted(qs):
        t = time.time()
        try:
            df = qs[k](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            s = fingerprint(df.columns, rows)
            spark_s = time.time() - t
            if k in sql:
                res = con.execute(sql[k])
                o = fingerprint([d[0] for d in res.description], res.fetchall())
                out[k] = {"match": s == o, "rows": s[1], "oracle_rows": o[1], "cols": s[0] == o[0],
                          "spark_s": round(spark_s, 2)}
                if s[0] != o[0]:
                    out[k]["spark_cols"], out[k]["oracle_cols"] = s[0], o[0]
            else:
                out[k] = {"match": None, "rows": s[1]}
        except Exception as e:  # report and keep going
            out[k] = {"match": False, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        print(k, out[k], flush=True)
    return out


if __name__ == "__main__":
    from chatmill.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = local_session(8)
    res = compare(spark, sf, keys)
    bad = [k for k, v in res.items() if v.get("match") is False]
    print("SUMMARY", len(res), "checked,", len(bad), "mismatched:", bad)
