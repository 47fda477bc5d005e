"""Compare catalogue queries with their SQL: python tests/check_oracle.py [folder] [query ...]."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def rows_of(names: list[str], rows: list) -> list:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, connection, folder: str, name: str, query, sql: str | None) -> str | None:
    """None where the results agree, else what differs."""
    frame = query(spark, folder)
    got = rows_of(frame.columns, frame.collect())
    if sql is None:
        return None if got else "no rows"
    result = connection.execute(sql)
    names = [c[0] for c in result.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    want = rows_of(names, result.fetchall())
    if got == want:
        return None
    wrong = [(g, w) for g, w in zip(got, want) if g != w][:2]
    return f"{len(got)} rows against {len(want)}: {str(wrong)[:1500]}"


def main(folder: str = "/root/testdata/sf0.01", *names: str) -> int:
    import __spark_entry__ as entry
    from reelgauge.session import get_session

    spark = get_session(
        "check", "local[8]", spark_sql_shuffle_partitions="8", spark_ui_enabled="false",
        spark_driver_memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql, bad = connect(folder), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            problem = compare(spark, connection, folder, name, query, sql.get(name))
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        kind = "sql" if name in sql else "rows"
        print(f"{name} [{kind}] {time.time() - start:.2f}s {problem or 'ok'}", flush=True)
        bad += problem is not None
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
