"""Run registered queries and their SQL side by side: ``python -m tests.oracle_check [names]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> str | None:
    """``None`` when both give the same columns and rows, else what differs."""
    result = con.execute(sql)
    theirs = _rows([d[0] for d in result.description], result.fetchall())
    mine = _rows(df.columns, [tuple(r) for r in df.collect()])
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows != {len(theirs[1])}"
    for a, b in zip(mine[1], theirs[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} != {b}"
    return None


if __name__ == "__main__":
    from tests.conftest import new_session

    import __spark_entry__ as contract

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark, con = new_session(), duck(sf_dir)
    sqls = contract.oracle_sql()
    failed = 0
    for name, query in contract.queries().items():
        if sys.argv[1:] and name not in sys.argv[1:]:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sqls:
                problem = compare(df, con, sqls[name])
            else:
                problem = f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001 - reported
            problem = f"{type(error).__name__} {str(error)[:600]}"
        failed += problem is not None and not problem.startswith("rows only")
        print(f"{time.time() - start:6.1f}s {name}: {problem or 'ok'}", flush=True)
    print("failed:", failed)
