"""Run registered Spark queries next to their DuckDB oracle SQL and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Compares row count, column names and an order-insensitive hash of the rows
(values rendered as text; floats to 9 significant digits).
"""

from __future__ import annotations

import decimal
import hashlib
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if v != v:
            return "NaN"
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def rows_digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return h, lines


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            if verbose:
                print(name, results[name], flush=True)
            continue
        if name not in sqls:
            results[name] = f"rows-only {len(srows)}"
            if verbose:
                print(f"{name}: {results[name]} ({time.time()-t0:.1f}s)", flush=True)
            continue
        try:
            tbl = con.execute(sqls[name]).to_arrow_table()
            if hasattr(tbl, "read_all"):
                tbl = tbl.read_all()
            dcols = tbl.column_names
            drows = [tuple(r.values()) for r in tbl.to_pylist()]
            dtypes = {f.name: str(f.type) for f in tbl.schema}
        except Exception as e:  # noqa: BLE001
            results[name] = f"DUCK ERROR {str(e)[:300]}"
            if verbose:
                print(name, results[name], flush=True)
            continue
        ok_cols = sorted(scols) == sorted(dcols)
        from pyspark.sql.pandas.types import to_arrow_type
        stypes = {f.name: str(to_arrow_type(f.dataType)) for f in df.schema.fields}
        bad_types = {c: (stypes.get(c), dtypes.get(c)) for c in stypes
                     if stypes.get(c) != dtypes.get(c)
                     and not (stypes.get(c, "").startswith("timestamp") and dtypes.get(c, "").startswith("timestamp"))}
        hs, ls = rows_digest(scols, srows)
        hd, ld = rows_digest(dcols, drows)
        ok = ok_cols and len(srows) == len(drows) and hs == hd
        results[name] = "OK" if ok else "MISMATCH"
        if verbose:
            print(f"{name}: {results[name]} rows spark={len(srows)} duck={len(drows)} "
                  f"cols_ok={ok_cols} types_ok={not bad_types} ({time.time()-t0:.1f}s)", flush=True)
            if bad_types:
                print("  types (spark, duck):", bad_types)
            if not ok_cols:
                print("  spark-only", sorted(set(scols) - set(dcols)),
                      "duck-only", sorted(set(dcols) - set(scols)))
            elif hs != hd:
                sd = set(ls) - set(ld)
                dd = set(ld) - set(ls)
                print("  cols:", sorted(scols))
                for x in sorted(sd)[:3]:
                    print("  spark:", x)
                for x in sorted(dd)[:3]:
                    print("  duck: ", x)
    return results


if __name__ == "__main__":
    from stratum.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if v != "OK" and not v.startswith("rows-only")}
    print("SUMMARY", len(res) - len(bad), "ok/rows-only of", len(res), "bad:", sorted(bad))
