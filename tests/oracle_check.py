"""Compare registered queries with their SQL: ``python tests/oracle_check.py [sf] [query ...]``."""

from __future__ import annotations

import math
import sys
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, float):
        return (2, repr(value + 0.0))
    return (3, str(value))


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(con, name: str, frame, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    got = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want = _rows(columns, cursor.fetchall())
    if sorted(frame.columns) != sorted(columns):
        return f"{name}: columns {sorted(frame.columns)} != {sorted(columns)}"
    if got != want:
        only_got = [r for r in got if r not in set(want)][:3]
        only_want = [r for r in want if r not in set(got)][:3]
        return f"{name}: {len(got)} vs {len(want)} rows\n  spark {only_got}\n  sql   {only_want}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from activlake.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = get_session(
        "oracle", "local[8]",
        {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
         "spark.ui.showConsoleProgress": "false"}, log_level="ERROR",
    )
    con = connect(sf_dir)
    sqls = oracle_sql()
    for name, query in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        try:
            problem = difference(con, name, query(spark, sf_dir), sqls[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{name}: {type(error).__name__} {str(error)[:1500]}"
        print(problem or f"{name}: equal", flush=True)


if __name__ == "__main__":
    main()
