"""Compare registered queries with their SQL in DuckDB.

Run as a script: ``python tests/oracle.py [sf_dir] [query ...]``.
"""

import os
import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def canonical(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples of plain values, columns by name."""
    frame = frame[sorted(frame.columns)]

    def plain(value):
        if value is None or value is pd.NA or value is pd.NaT or value != value:
            return "<null>"
        if isinstance(value, bool) or type(value).__name__ == "bool_":
            return str(bool(value))
        if isinstance(value, (int, float)) or hasattr(value, "dtype"):
            return f"{float(value):.6f}"
        return str(value)

    return sorted(tuple(map(plain, row)) for row in frame.itertuples(index=False, name=None))


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    left, right = canonical(spark_frame), canonical(sql_frame)
    if left == right:
        return None
    only_left = sorted(set(left) - set(right))[:2]
    only_right = sorted(set(right) - set(left))[:2]
    return f"rows {len(left)} != {len(right)}; only Spark {only_left}; only SQL {only_right}"


def main():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, root)
    from chatnorm.plans.session import build_session
    from chatnorm.queries import all_queries, all_sql

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(all_queries())
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql = connect(sf_dir), all_sql()
    bad = 0
    for name in wanted:
        started = time.time()
        try:
            mine = all_queries()[name](spark, sf_dir).toPandas()
            took = time.time() - started
            problem = differences(mine, connection.execute(sql[name]).df())
        except Exception as error:  # noqa: BLE001
            took, problem = time.time() - started, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        rows = len(mine) if problem is None else "-"
        print(f"{'ok ' if problem is None else 'BAD'} {name} {took:.2f}s rows={rows} {(problem or '')[:1800]}", flush=True)
    print(f"{len(wanted) - bad}/{len(wanted)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
