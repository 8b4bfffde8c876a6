"""Runs registered queries beside their SQL in DuckDB and compares columns, rows and values.

`python -m tests.compare [folder] [name or section ...]`
"""

from __future__ import annotations

import math
import sys
import time
import traceback
from importlib import import_module

import duckdb

from lakemill import registry
from lakemill.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def cell(value) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return f"{type(value).__name__}:{value}"


def normal(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    place = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in place], sorted(tuple(cell(row[i]) for i in place) for row in rows)


def difference(spark, con, item: registry.Entry, folder: str) -> str | None:
    """None when both sides agree, else what differs. Without SQL only rows are counted."""
    frame = registry.runner(item)(spark, folder)
    rows = [tuple(r) for r in frame.collect()]
    if item.sql is None:
        return None if rows else "no rows"
    found = con.execute(item.sql)
    columns = [d[0] for d in found.description]
    ours, theirs = normal(frame.columns, rows), normal(columns, found.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} against {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        only = [r for r in ours[1] if r not in set(theirs[1])][:2]
        return f"{len(ours[1])} rows against {len(theirs[1])}; only ours {only}"
    wrong = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    return f"{len(wrong)} rows differ: {ours[0]} {wrong[:2]}" if wrong else None


def main(arguments: list[str]) -> int:
    folder = "/root/testdata/sf0.01"
    if arguments and "/" in arguments[0]:
        folder = arguments.pop(0)
    sections = [a for a in arguments if a in registry.SECTIONS]
    for section in sections or registry.SECTIONS:
        import_module(f"lakemill.registry.{section}")
    names = [a for a in arguments if a not in sections]
    chosen = [registry.ENTRIES[n] for n in names] if names else list(registry.ENTRIES.values())
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(folder), 0
    for item in chosen:
        start = time.time()
        try:
            problem = difference(spark, con, item, folder)
        except Exception:
            problem = "".join(traceback.format_exc()[-1500:])
        bad += problem is not None
        mark = "ok " if item.sql else "row"
        print(f"{item.name} {'BAD' if problem else mark} {time.time() - start:.2f}s {(problem or '')[:1600]}", flush=True)
    print(f"{len(chosen)} queries, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
