"""Run registered Spark queries and their DuckDB oracle SQL side by side and
compare row counts, column names and an order-insensitive value hash.

    python tools/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from cropledger.plans.registry import oracle_sql, queries  # noqa: E402
from cropledger.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return repr(round(v, 6))
    if hasattr(v, "item"):
        v = v.item()
        return norm(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()[:12], lines


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"{name:28s} rows={len(srows):7d} (no oracle) {ts:.1f}s")
            continue
        try:
            rel = con.sql(sqls[name])
            dcols = rel.columns
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} DUCKDB ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        hs, ls = digest(scols, srows)
        hd, ld = digest(dcols, drows)
        ok = len(srows) == len(drows) and sorted(scols) == sorted(dcols) and hs == hd
        bad += not ok
        print(f"{name:28s} rows={len(srows):7d}/{len(drows):7d} cols={'ok' if sorted(scols)==sorted(dcols) else (scols, dcols)} "
              f"hash={'OK' if hs == hd else 'MISMATCH'} {ts:.1f}s")
        if not ok and sorted(scols) == sorted(dcols):
            only_s = sorted(set(ls) - set(ld))[:3]
            only_d = sorted(set(ld) - set(ls))[:3]
            print("   spark-only:", only_s)
            print("   duck-only: ", only_d)
    print("FAILED:", bad)


if __name__ == "__main__":
    main()
