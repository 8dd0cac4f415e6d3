"""Comparing a Spark result with the same question asked of DuckDB."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(path: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/{t}.parquet'")
    return con


def differences(df, con, sql: str) -> str:
    """Empty when both give the same bag of rows under the same column names and types."""
    names = sorted(df.columns)
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    types = {d[0]: {"BIGINT": "bigint", "VARCHAR": "string", "BOOLEAN": "boolean", "INTEGER": "int"}.get(d[1], d[1]) for d in described}
    if types != dict(df.dtypes):
        return f"types {dict(df.dtypes)} and {types}"
    spark_rows = Counter(tuple(r[n] for n in names) for r in df.collect())
    answer = con.execute(sql)
    columns = [c[0] for c in answer.description]
    if sorted(columns) != names:
        return f"columns {names} and {sorted(columns)}"
    at = [columns.index(n) for n in names]
    duck_rows = Counter(tuple(r[i] for i in at) for r in answer.fetchall())
    only_spark, only_duck = spark_rows - duck_rows, duck_rows - spark_rows
    if not only_spark and not only_duck:
        return ""
    return (
        f"{sum(only_spark.values())} rows only in Spark, {sum(only_duck.values())} only in DuckDB:"
        f" {list(only_spark)[:2]} / {list(only_duck)[:2]}"
    )
