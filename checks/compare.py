"""Run registered queries beside their SQL on DuckDB: ``python -m checks.compare [sf] [name ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

from checks.oracle import QUERIES, oracle
from checks.queries import REGISTERED
from starmart.session import local_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
         "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None when both engines agree on columns, types and rows; otherwise what differs."""
    df = REGISTERED[name](spark, sf_dir)
    columns = sorted(df.columns)
    types = dict(df.dtypes)
    ours = Counter(tuple(r) for r in df.select(*columns).collect())
    rel = con.sql(oracle(name))
    their_types = dict(zip(rel.columns, map(str, rel.types)))
    if columns != sorted(rel.columns):
        return f"columns {columns} vs {sorted(rel.columns)}"
    for c in columns:
        want = TYPES.get(types[c], types[c].upper())
        if want != their_types[c]:
            return f"type of {c}: {types[c]} vs {their_types[c]}"
    order = ", ".join(f'"{c}"' for c in columns)
    theirs = Counter(con.sql(f"SELECT {order} FROM ({oracle(name)}) q").fetchall())
    if ours != theirs:
        return (f"{sum(ours.values())} vs {sum(theirs.values())} rows; only ours {list((ours - theirs).items())[:2]}; "
                f"only theirs {list((theirs - ours).items())[:2]}")
    print(f"    {sum(ours.values())} rows", end="")
    return None


def main() -> int:
    args = sys.argv[1:]
    sf_dir = f"/root/testdata/{args[0] if args else 'sf0.01'}"
    names = args[1:] or list(REGISTERED)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    bad = [n for n in REGISTERED if n not in QUERIES]
    print("without oracle:", bad)
    failed = 0
    for name in names:
        t = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as e:  # report and go on to the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"  {'ok  ' if problem is None else 'FAIL'} {name} {time.time() - t:.1f}s {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
