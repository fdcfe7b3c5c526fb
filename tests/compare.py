"""Run registered queries in Spark and their SQL in DuckDB, and compare the results value by value."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value, digits: int):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, (list, tuple)) or hasattr(value, "tolist") and getattr(value, "ndim", 0):
        return tuple(_plain(v, digits) for v in list(value))
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v, digits)) for k, v in value.items()))
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, bool) or type(value).__name__ == "bool":
        return bool(value)
    if hasattr(value, "item"):
        value = value.item()
    if type(value).__name__ == "Decimal":
        value = float(value)
    if isinstance(value, float):
        if value != value:
            return None
        return int(value) if value.is_integer() and abs(value) < 1e15 else round(value, digits)
    return value


def rows_of(columns, rows, digits: int):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i], digits) for i in order) for r in rows), key=repr)


def check(spark, con, query, sql: str, folder: str, digits: int = 9):
    """None when equal, else a short description of the first difference."""
    started = time.time()
    frame = query(spark, folder)
    collected = frame.collect()
    check.seconds = time.time() - started
    mine = rows_of(frame.columns, [tuple(r) for r in collected], digits)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall(), digits)
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        cols = sorted(names)
        a, b = bad[0]
        diff = [(c, x, y) for c, x, y in zip(cols, a, b) if x != y]
        return f"{len(bad)} of {len(mine)} rows differ, first: {diff[:4]}"
    return None


def main() -> None:
    import __spark_entry__ as registry
    from ebbtide.session import local_session

    folder = sys.argv[1]
    only = sys.argv[2:]
    spark, con = local_session(8), connect(folder)
    sql = registry.oracle_sql()
    failed = 0
    for name, query in registry.queries().items():
        if only and not any(name == o or (o.endswith("*") and name.startswith(o[:-1])) for o in only):
            continue
        t = time.time()
        try:
            if name in sql:
                    problem = check(spark, con, query, sql[name], folder)
            else:
                rows = query(spark, folder).collect()
                check.seconds = time.time() - t
                problem = None if rows else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:28s} {getattr(check, 'seconds', 0):6.2f}s of {time.time() - t:6.2f}s {'' if name in sql else '(rows only) '}{problem or ''}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
