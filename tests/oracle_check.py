"""Compare named queries with their DuckDB SQL: ``python tests/oracle_check.py <folder> [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def rows(table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns), key=repr)


def compare(spark, con, folder: str, name: str) -> tuple[bool, str]:
    start = time.time()
    ours = entry.queries()[name](spark, folder).toArrow()
    between = time.time()
    theirs = con.execute(entry.oracle_sql()[name]).to_arrow_table()
    end = time.time()
    note = f"{ours.num_rows} rows, {between - start:.1f} s, oracle {end - between:.1f} s"
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return False, f"{note}; columns {ours.column_names} / {theirs.column_names}"
    a, b = rows(ours), rows(theirs)
    if a == b:
        return True, note
    differing = [(x, y) for x, y in zip(a, b) if x != y][:3]
    return False, f"{note}; {len(a)} / {len(b)} rows, e.g. {sorted(ours.column_names)} {differing}"


if __name__ == "__main__":
    from swapbook.session import build_session

    folder = sys.argv[1]
    session = build_session(master="local[8]", shuffle_partitions=8, driver_memory="16g")
    session.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in sys.argv[2:] or list(entry.oracle_sql()):
        good, note = compare(session, con, folder, name)
        failed += not good
        print("ok  " if good else "FAIL", name, note, flush=True)
    sys.exit(failed > 0)
