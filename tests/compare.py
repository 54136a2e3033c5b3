"""Compare a Spark result with a DuckDB result: same columns, same rows, any order."""

from __future__ import annotations

import datetime
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def differences(spark_df, con, sql: str) -> list[str]:
    rel = con.sql(sql)
    left, right = sorted(spark_df.columns), sorted(rel.columns)
    if left != right:
        return [f"columns {left} against {right}"]
    types = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
             "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE"}
    spark_types = {k: types.get(v, v) for k, v in spark_df.dtypes}
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    found = [f"type of {c}: {spark_types[c]} against {duck_types[c]}" for c in left if spark_types[c] != duck_types[c]]
    ours = Counter(tuple(_plain(row[c]) for c in left) for row in spark_df.collect())
    index = [rel.columns.index(c) for c in left]
    theirs = Counter(tuple(_plain(row[i]) for i in index) for row in rel.fetchall())
    if ours != theirs:
        found.append(f"{sum(ours.values())} rows against {sum(theirs.values())}")
        found += [f"only Spark: {r}" for r in list((ours - theirs))[:3]]
        found += [f"only SQL: {r}" for r in list((theirs - ours))[:3]]
    return found
