"""Run a plan and its SQL side by side."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_by_name(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    return sorted((tuple(plain(row[at]) for at in order) for row in rows), key=repr)


def difference(spark, con, plan, sql: str, sf_dir: str) -> str | None:
    """``None`` when both give the same rows, else a short description."""
    df = plan(spark, sf_dir)
    ours = rows_by_name(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows_by_name(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if not theirs:
        return "the SQL gives no rows"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for mine, other in zip(ours, theirs):
        if mine != other or [type(v) for v in mine] != [type(v) for v in other]:
            return f"{mine} != {other}"
    return None


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from tidelight.plans.catalog import all_entries
    from tidelight.session import local_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, con = local_session(8), connect(sf_dir)
    for name, item in all_entries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if item.sql:
                found = difference(spark, con, item.plan, item.sql, sf_dir)
            else:
                found = None if item.plan(spark, sf_dir).count() else "no rows"
        except Exception as failure:  # report and go on
            found = f"{type(failure).__name__}: {str(failure)[:600]}"
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)


if __name__ == "__main__":
    main()
