"""Compares a Spark result with SQL run by DuckDB over the same Parquet files."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
)


def sql_result(folder: str, sql: str) -> tuple[list[str], list[tuple]]:
    with duckdb.connect() as db:
        for table in TABLES.split():
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{Path(folder) / (table + '.parquet')}'")
        cursor = db.execute(sql)
        return [column[0] for column in cursor.description], cursor.fetchall()


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        if isinstance(value, float) and math.isnan(value):
            return None
        return value

    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def assert_same_rows(df: DataFrame, folder: str, sql: str) -> int:
    columns, expected = sql_result(folder, sql)
    assert sorted(df.columns) == sorted(columns)
    got = canonical(df.columns, [tuple(row) for row in df.collect()])
    want = canonical(columns, expected)
    assert len(got) == len(want), f"{len(got)} rows, expected {len(want)}"
    differing = [(g, w) for g, w in zip(got, want) if g != w or [type(v) for v in g] != [type(v) for v in w]]
    assert not differing, f"{len(differing)} rows differ, first: {differing[:3]}"
    return len(got)
