"""Run queries and their oracles side by side: python -m checks.compare SF_DIR [name ...]"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from checks.oracles import ORACLES
from checks.registry import all_queries
from headway.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, float):
        return value
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return value.item() if hasattr(value, "item") else value


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when both sides hold the same columns and rows."""
    got = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    want = canonical([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        extra = [r for r in got[1] if r not in set(want[1])][:2]
        missing = [r for r in want[1] if r not in set(got[1])][:2]
        return f"{len(got[1])} vs {len(want[1])} rows; extra {extra}; missing {missing}"
    return ""


def main(argv: list[str]) -> int:
    sf_dir, names = argv[0], argv[1:] or list(all_queries())
    spark = build_session(
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.master": "local[8]"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    failed = 0
    for name in names:
        began = time.time()
        try:
            df = all_queries()[name](spark, sf_dir)
            if name in ORACLES:
                problem = difference(df, con, ORACLES[name])
            else:
                problem = f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem) and not problem.startswith("rows only")
        print(f"{name:32s} {time.time() - began:6.2f}s {problem or 'ok'}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
