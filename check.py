"""Compare named queries with their SQL counterparts: python check.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from commerce_lens.catalog.oracle import oracle_statements
from commerce_lens.catalog.queries import named_queries
from commerce_lens.session import local_session


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def cell(x):
    """Floats to 12 significant digits, anything else as it is."""
    if isinstance(x, float):
        return "nan" if math.isnan(x) else f"{x + 0.0:.12g}"
    return x


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(r[i]) for i in order) for r in rows)


# DuckDB type for each Spark type.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, con, sf_dir: str, name: str, sql: str) -> tuple[bool, str]:
    """Same column names, compatible types, same rows in any order."""
    df = named_queries()[name](spark, sf_dir)
    got = bag(df.columns, (tuple(r) for r in df.collect()))
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = bag(columns, cur.fetchall())
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} <> {sorted(columns)}"
    types = {d[0]: str(d[1]) for d in cur.description}
    other = [(c, t, types[c]) for c, t in df.dtypes if TYPES.get(t) != types[c]]
    if other:
        return False, f"types {other}"
    if got != want:
        more, less = got - want, want - got
        return False, f"{sum(more.values())} extra e.g. {list(more)[:2]}, {sum(less.values())} missing e.g. {list(less)[:2]}"
    return True, f"{sum(got.values())} rows"


def main(sf_dir: str, names: list[str]) -> int:
    spark, con = local_session(8), duck(sf_dir)
    statements, bad = oracle_statements(), 0
    for name in names or named_queries():
        start = time.time()
        if name not in statements:
            print(f"rows {name}: {named_queries()[name](spark, sf_dir).count()}")
            continue
        try:
            same, note = compare(spark, con, sf_dir, name, statements[name])
        except Exception as e:
            same, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not same
        print(f"{'ok  ' if same else 'FAIL'} {name} {time.time() - start:.1f}s {note[:900]}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    args = sys.argv[1:] or ["/root/testdata/sf0.01"]
    sys.exit(1 if main(args[0], args[1:]) else 0)
