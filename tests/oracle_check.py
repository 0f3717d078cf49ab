"""Local Spark-vs-DuckDB comparison of registered queries (development aid and tests).

Compares row count, column names and an order-insensitive hash of the values
(columns sorted by name; floats normalised to 9 significant digits so the hash
ignores only last-bit noise).  Exact equality is reported separately.
"""

from __future__ import annotations

import hashlib
import math
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits: int = 9):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if v == 0:
            return 0.0
        return float(f"{v:.{digits}g}")
    if hasattr(v, "is_finite") and hasattr(v, "quantize"):  # Decimal
        return float(f"{float(v):.{digits}g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def frame_hash(columns, rows, digits: int = 9) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(_norm(r[i], digits) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, name: str, fn, sql: str | None, sf_dir: str, con=None) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols = list(sdf.columns)
    t1 = time.time()
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        return out
    con = con or duckdb_connection(sf_dir)
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = [tuple(r) for r in res.fetchall()]
    out.update({"oracle_rows": len(d_rows), "oracle_sec": round(time.time() - t1, 2),
                "cols_match": sorted(s_cols) == sorted(d_cols),
                "hash_match": frame_hash(s_cols, s_rows) == frame_hash(d_cols, d_rows),
                "exact_match": frame_hash(s_cols, s_rows, 17) == frame_hash(d_cols, d_rows, 17)})
    if not out["cols_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
    return out


def main(argv=None):
    argv = argv if argv is not None else sys.argv[1:]
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = set(argv[1:])
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from demandcast.session import get_session
    spark = get_session()
    con = duckdb_connection(sf_dir)
    q, o = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in q.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, name, fn, o.get(name), sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": name, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        ok = "error" not in r and (name not in o or (r["cols_match"] and r["hash_match"]
                                                      and r["spark_rows"] == r["oracle_rows"]))
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{bad} bad", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
