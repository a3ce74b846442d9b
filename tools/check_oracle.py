"""Run registered queries and their DuckDB oracles side by side (row count, columns, values).

Usage: python tools/check_oracle.py [sf_dir] [name-substring ...] [-excluded-substring ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from roadpulse.registry import oracle_sql, queries  # noqa: E402
from roadpulse.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (int,)):
        return float(v)
    return str(v)


def rows_of(records):
    return sorted((tuple(norm(x) for x in r) for r in records), key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, name, fn, sql, sf_dir):
    t = time.time()
    sdf = fn(spark, sf_dir)
    cols = sorted(sdf.columns)
    srows = rows_of([tuple(r[c] for c in cols) for r in sdf.collect()])
    ts = time.time() - t
    if sql is None:
        return f"{name}: rows={len(srows)} (no oracle) {ts:.1f}s"
    rel = con.sql(sql)
    ocols = rel.columns
    if sorted(ocols) != cols:
        return f"{name}: COLUMN MISMATCH spark={cols} oracle={sorted(ocols)}"
    orows = rel.fetchall()
    idx = [ocols.index(c) for c in cols]
    orows = rows_of([tuple(r[i] for i in idx) for r in orows])
    if len(orows) != len(srows):
        return f"{name}: ROWCOUNT MISMATCH spark={len(srows)} oracle={len(orows)}"
    bad = [(a, b) for a, b in zip(srows, orows) if a != b]
    if bad:
        return f"{name}: VALUE MISMATCH {len(bad)} rows, e.g. cols={cols}\n  spark ={bad[0][0]}\n  oracle={bad[0][1]}"
    return f"{name}: ok rows={len(srows)} {ts:.1f}s"


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = [a for a in sys.argv[2:] if not a.startswith("-")]
    skip = [a[1:] for a in sys.argv[2:] if a.startswith("-")]
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, orc = queries(), oracle_sql()
    fails = 0
    for name, fn in qs.items():
        if (pats and not any(p in name for p in pats)) or any(x in name for x in skip):
            continue
        try:
            msg = compare(spark, con, name, fn, orc.get(name), sf_dir)
        except Exception as e:  # report and continue
            msg = f"{name}: ERROR {type(e).__name__}: {str(e)[:800]}"
        if " ok " not in msg and "no oracle" not in msg:
            fails += 1
        print(msg, flush=True)
    print(f"done: {fails} failing of {len(qs)}")


if __name__ == "__main__":
    main()
