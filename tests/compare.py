"""Run registered queries in Spark and in DuckDB and compare the row multisets.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _rows(table) -> tuple[list[str], Counter]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, Counter(zip(*columns))


def compare(spark_table, con, sql: str) -> str | None:
    """None when both give the same columns and rows, else what differs."""
    names, rows = _rows(spark_table)
    sql_names, sql_rows = _rows(con.execute(sql).to_arrow_table())
    if names != sql_names:
        return f"columns {names} != {sql_names}"
    if rows != sql_rows:
        only, only_sql = rows - sql_rows, sql_rows - rows
        return (
            f"rows {sum(rows.values())} / {sum(sql_rows.values())}; only Spark {sum(only.values())} "
            f"{list(only)[:2]}; only SQL {sum(only_sql.values())} {list(only_sql)[:2]}"
        )
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from paperloom.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(queries())
    spark, con = local_session(8), connect(sf_dir)
    for name in wanted:
        start = done = time.time()
        try:
            found = queries()[name](spark, sf_dir).toArrow()
            done = time.time()
            problem = compare(found, con, oracle_sql()[name]) if name in oracle_sql() else None
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        seconds = f"Spark {done - start:.1f}s, SQL {time.time() - done:.1f}s"
        print(f"@@ {name}: {seconds}: {'ok' if problem is None else str(problem)[:1800]}", flush=True)
