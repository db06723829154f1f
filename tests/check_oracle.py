"""Run registered queries next to their SQL in DuckDB and compare rows, columns and values.

    python tests/check_oracle.py [--sf DIR] [name ...]
"""

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402
from logquarry.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()

TYPE_FAMILY = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is not None, type(v).__name__, str(v)) for v in row)


def _normal(v):
    return round(v, 9) if isinstance(v, float) and math.isfinite(v) else v


def compare(df, con, sql):
    """Differences (none when both sides agree) and the number of rows."""
    cols = sorted(df.columns)
    relation = con.sql(sql)
    ducks = dict(zip(relation.columns, [str(t) for t in relation.types]))
    if sorted(ducks) != cols:
        return [f"columns {cols} != {sorted(ducks)}"], -1
    sparks = {f.name: TYPE_FAMILY.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    diffs = [f"type of {c}: {sparks[c]} != {ducks[c]}" for c in cols if sparks[c] != ducks[c]]
    left = sorted(([_normal(r[c]) for c in cols] for r in df.collect()), key=_key)
    position = [relation.columns.index(c) for c in cols]
    right = sorted(([_normal(r[i]) for i in position] for r in relation.fetchall()), key=_key)
    if len(left) != len(right):
        diffs.append(f"rows {len(left)} != {len(right)}")
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        diffs.append(f"{len(wrong)} rows differ, first: {wrong[0]}")
    return diffs, len(left)


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session("check")
    con = connect(args.sf)
    bad = 0
    oracle = entry.oracle_sql()
    for name, query in entry.queries().items():
        if args.names and name not in args.names:
            continue
        start = time.time()
        try:
            df = query(spark, args.sf)
            if name in oracle:
                diffs, rows = compare(df, con, oracle[name])
            else:
                diffs, rows = [], len(df.collect())
        except Exception as e:  # report and go on with the other queries
            diffs, rows = [f"{type(e).__name__}: {str(e)[:600]}"], -1
        bad += bool(diffs)
        mark = "FAIL" if diffs else ("ok  " if name in oracle else "rows")
        print(f"{mark} {name:28s} {rows:7d} rows {time.time() - start:6.2f}s {diffs or ''}", flush=True)
    print(f"{bad} failing")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
