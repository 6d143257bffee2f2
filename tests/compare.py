"""Run a query on Spark and its SQL twin on DuckDB and compare the rows."""

from __future__ import annotations

import datetime as dt
import glob
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if value != value else (0.0 if value == 0 else value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def spark_rows(frame):
    names = sorted(frame.columns)
    rows = [tuple(_plain(row[c]) for c in names) for row in frame.select(*names).collect()]
    return names, sorted(rows, key=repr), {c: t for c, t in frame.dtypes}


def duck_rows(con, sql):
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    types = {row[0]: row[1] for row in described}
    names = sorted(types)
    columns = ", ".join(f'"{c}"' for c in names)
    rows = con.execute(f"SELECT {columns} FROM ({sql})").fetchall()
    return names, sorted((tuple(map(_plain, row)) for row in rows), key=repr), types


SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def differences(frame, con, sql) -> str | None:
    names, rows, types = spark_rows(frame)
    other_names, other_rows, other_types = duck_rows(con, sql)
    if names != other_names:
        return f"columns {names} against {other_names}"
    wrong = {c: (types[c], other_types[c]) for c in names if SAME_TYPE.get(types[c]) != other_types[c]}
    if wrong:
        return f"types {wrong}"
    if len(rows) != len(other_rows):
        return f"{len(rows)} rows against {len(other_rows)}"
    bad = [(a, b) for a, b in zip(rows, other_rows) if a != b]
    if bad:
        return f"{len(bad)} of {len(rows)} rows differ, first {bad[0]}"
    return None
