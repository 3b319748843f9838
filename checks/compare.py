"""Run registered queries next to their SQL and report differences.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from checks.registry import QUERIES
from checks.sql import ORACLES
from opinara.session import get_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return db


def rows_of(names: list[str], rows: list[tuple]) -> Counter:
    """Rows as a bag, columns in name order, values exactly as returned."""
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(row[i] for i in order) for row in rows)


def difference(spark_df, db: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """``None`` when both sides give the same rows."""
    result = db.execute(sql)
    names = [column[0] for column in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns differ: {sorted(spark_df.columns)} / {sorted(names)}"
    expected = rows_of(names, result.fetchall())
    actual = rows_of(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    if actual == expected:
        return None
    only_spark, only_sql = list((actual - expected).elements()), list((expected - actual).elements())
    return (
        f"{len(only_spark)} rows only in Spark, {len(only_sql)} only in SQL; "
        f"{str(only_spark[:1])[:400]} / {str(only_sql[:1])[:400]}"
    )


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = get_session("checks", "local[8]", **{"spark.driver.memory": "12g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                found = difference(df, db, ORACLES[name])
                verdict = "same" if found is None else f"DIFFERS {found}"
            else:
                verdict = f"{len(df.collect())} rows, no SQL"
        except Exception as error:  # noqa: BLE001 - the report goes on with the next query
            verdict = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        failed += verdict.startswith(("DIFFERS", "FAILED"))
        print(f"{name:36s} {time.time() - start:6.1f}s  {verdict}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
