"""Run registered queries on Spark and their SQL on DuckDB and compare the rows."""

from __future__ import annotations

from collections import Counter
from datetime import datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    return value


def bag(rows, columns: list[str]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None when both sides return the same bag of rows under the same column names."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    want, got = bag(cursor.fetchall(), names), bag(spark_df.collect(), spark_df.columns)
    if want == got:
        return None
    return f"{sum(got.values())} rows, {sum(want.values())} expected; extra {list((got - want))[:3]}, missing {list((want - got))[:3]}"
