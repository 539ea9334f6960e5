"""A query's result against its SQL: types, row count and values, in no particular order."""

import math
from pathlib import Path

import duckdb
import pandas as pd

DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def duck(folder):
    connection = duckdb.connect()
    for table in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"create view {table.stem} as select * from '{table}'")
    return connection


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return None
    return value.item() if hasattr(value, "item") else value


def rows_of(frame):
    columns = sorted(frame.columns)
    rows = [tuple(plain(v) for v in row) for row in frame[columns].astype(object).itertuples(index=False)]
    return sorted(rows, key=lambda row: tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in row))


def differences(result, sql, folder):
    """Empty if equal, else what differs."""
    relation = duck(folder).sql(sql)
    told = []
    spark_types = {name: DUCK_TYPES.get(kind, kind) for name, kind in result.dtypes}
    duck_types = {name: str(kind) for name, kind in zip(relation.columns, relation.types)}
    if spark_types != duck_types:
        told.append(f"types {spark_types} / {duck_types}")
    got, wanted = rows_of(result.toPandas()), rows_of(relation.df())
    if len(got) != len(wanted):
        told.append(f"rows {len(got)} / {len(wanted)}")
    elif got != wanted:
        wrong = [(g, w) for g, w in zip(got, wanted) if g != w]
        told.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return told
