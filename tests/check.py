"""Compare registered queries with their SQL answers: python tests/check.py [sf] [names…]"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

DATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None if both give the same columns and the same rows, counting repeats."""
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} instead of {sorted(columns)}"
    want = rows_of(columns, result.fetchall())
    have = rows_of(spark_df.columns, spark_df.collect())
    if want == have:
        return None
    missing, extra = want - have, have - want
    return (
        f"{have.total()} rows, want {want.total()}; missing {missing.total()}: "
        f"{list(missing)[:2]}; extra {extra.total()}: {list(extra)[:2]}"
    )


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).parent.parent))
    from __spark_entry__ import oracle_sql, queries
    from tidemark.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(f"{DATA}/sf{sf}")
    for name, query in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        problem = difference(query(spark, f"{DATA}/sf{sf}"), con, oracle_sql()[name])
        print(f"{name:28} {time.time() - start:6.1f}s  {problem or 'ok'}", flush=True)
