"""Runs registered queries against their SQL: ``python tests/oracle_check.py [sf] [name ..]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _rows(table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return [tuple(v + 0.0 if isinstance(v, float) else v for v in row) for row in zip(*columns)]


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def compare(spark_frame, connection, sql: str) -> str | None:
    """None when both sides hold the same rows, else what differs."""
    mine, theirs = spark_frame.toArrow(), connection.sql(sql).to_arrow_table()
    if sorted(mine.column_names) != sorted(theirs.column_names):
        return f"columns {mine.column_names} / {theirs.column_names}"
    for name in mine.column_names:
        a, b = str(mine.schema.field(name).type), str(theirs.schema.field(name).type)
        if a != b and {a, b} != {"string", "large_string"}:
            return f"type of {name}: {a} / {b}"
    left, right = sorted(_rows(mine), key=_key), sorted(_rows(theirs), key=_key)
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}"
    for a, b in zip(left, right):
        if a != b and not all(
            x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y))
            for x, y in zip(a, b)
        ):
            return f"row {str(a)[:300]} / {str(b)[:300]}"
    return None


def main() -> None:
    import __spark_entry__ as spark_entry
    from inkwell.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark = local_session("oracle check", 8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    chosen, sql = spark_entry.queries(), spark_entry.oracle_sql()
    for name in sys.argv[2:] or chosen:
        start = time.time()
        try:
            frame = chosen[name](spark, folder)
            if name in sql:
                found = compare(frame, connection, sql[name]) or "ok"
            else:
                found = f"rows only: {frame.count()}"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            found = "FAILED " + str(error)[:700]
        print(f"{name:24} {time.time() - start:6.1f}s  {found}", flush=True)


if __name__ == "__main__":
    main()
