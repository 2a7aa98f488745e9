"""Run every registered query in Spark and its SQL twin in DuckDB and compare all values.

    python -m verification.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from verification.oracles import ORACLES
from verification.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, con, sf_dir: str, name: str) -> str | None:
    """None when both engines agree, else what differs."""
    result = QUERIES[name](spark, sf_dir)
    mine = _bag(result.columns, result.collect())
    if name not in ORACLES:
        return None
    cursor = con.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    theirs = _bag(columns, cursor.fetchall())
    if sorted(columns) != sorted(result.columns):
        return f"columns differ: {sorted(result.columns)} / {sorted(columns)}"
    if mine != theirs:
        only_mine, only_theirs = mine - theirs, theirs - mine
        return (
            f"{mine.total()} / {theirs.total()} rows, {only_mine.total()} and "
            f"{only_theirs.total()} differ: {list(only_mine)[:2]} / {list(only_theirs)[:2]}"
        )
    return None


def main() -> None:
    from tripmill.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    conf = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    spark = build_session("compare", "local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        started = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        state = "FAIL" if problem else "ok  "
        print(f"{state} {name} {time.time() - started:.2f}s {problem or str()}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")


if __name__ == "__main__":
    main()
