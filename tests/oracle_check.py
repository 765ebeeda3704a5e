"""Run registered queries on Spark and their SQL on DuckDB and compare the rows."""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, con, sf_dir: str, run, sql: str) -> str | None:
    """None if both agree, else what differs."""
    df = run(spark, sf_dir)
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want, have = rows_of(columns, result.fetchall()), rows_of(df.columns, df.collect())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if want == have:
        return None if want else "no rows"
    extra = [r for r in have if r not in set(want)][:2]
    missing = [r for r in want if r not in set(have)][:2]
    return f"{len(have)} rows, wanted {len(want)}; only Spark {extra}; only SQL {missing}"


def main(sf_dir: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from matchloom.session import spark_session

    spark = spark_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con, runs, sql = duck(sf_dir), queries(), oracle_sql()
    bad = 0
    for name in names or list(runs):
        if name not in sql:
            print(f"{name}: no SQL, {runs[name](spark, sf_dir).count()} rows")
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, runs[name], sql[name])
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name}: {'ok' if problem is None else problem} ({time.time() - start:.1f}s)", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
