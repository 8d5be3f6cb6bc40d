"""Runs queries beside their SQL counterparts in DuckDB and compares all rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def sql_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    with duckdb.connect() as db:
        for table in TABLES:
            db.execute(f"CREATE VIEW {table} AS FROM '{sf_dir}/{table}.parquet'")
        result = db.execute(sql)
        return [c[0] for c in result.description], result.fetchall()


def differences(spark: SparkSession, sf_dir: str, query, sql: str) -> list[str]:
    """What differs between a query and its SQL, empty if nothing does."""
    frame = query(spark, sf_dir)
    columns, expected = sql_rows(sf_dir, sql)
    if sorted(columns) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} instead of {sorted(columns)}"]
    order = sorted(columns)
    actual = Counter(tuple(map(_plain, row)) for row in frame.select(*order).collect())
    places = [columns.index(c) for c in order]
    wanted = Counter(tuple(_plain(row[p]) for p in places) for row in expected)
    if not wanted:
        return ["the SQL gives no rows"]
    extra, missing = list((actual - wanted).items()), list((wanted - actual).items())
    return [f"extra {row}" for row in extra[:3]] + [f"missing {row}" for row in missing[:3]]


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value
