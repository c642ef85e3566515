"""Run registered queries and their SQL side by side: ``python -m checks.compare [sf_dir] [key ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks import oracles, registry
from statuslight.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return db


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(picked, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, db, sf_dir: str, key: str, sql: str | None, query=None) -> tuple[str, float]:
    start = time.time()
    df = (query or registry.QUERIES[key])(spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    took = time.time() - start
    if sql is None:
        return f"rows only: {len(ours)}", took
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"COLUMNS differ: {sorted(df.columns)} / {sorted(names)}", took
    if ours != theirs:
        at = next((i for i, (a, b) in enumerate(zip(ours, theirs)) if a != b), min(len(ours), len(theirs)))
        shown = [str(side[at])[:700] if at < len(side) else "-" for side in (ours, theirs)]
        return f"DIFFERS ({len(ours)}/{len(theirs)} rows) at {at}:\n    {shown[0]}\n    {shown[1]}", took
    return f"equal: {len(ours)}", took


def main(args: list[str]) -> int:
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    db, sqls, bad = connection(sf_dir), oracles.oracle_sql(), 0
    for key in args[1:] or registry.QUERIES:
        try:
            outcome, took = compare(spark, db, sf_dir, key, sqls.get(key))
        except Exception as problem:  # noqa: BLE001
            outcome, took = f"FAILED {str(problem)[:900]}", 0.0
        bad += not outcome.startswith(("equal", "rows only"))
        print(f"{key:36s} {took:6.2f}s  {outcome}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
