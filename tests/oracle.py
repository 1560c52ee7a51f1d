"""Run a registered query and its SQL check, and compare."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def kinds(types):
    names = {"bigint": "int", "int": "int", "integer": "int", "smallint": "int", "tinyint": "int",
             "double": "float", "float": "float", "string": "str", "varchar": "str", "boolean": "bool"}
    return [names.get(str(t).lower(), str(t).lower()) for t in types]


def compare(spark, con, query, sf_dir) -> tuple[str, int]:
    """("" or the difference, number of rows)."""
    df = query.run(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if query.sql is None:
        return "", len(got)
    res = con.execute(query.sql)
    names = [c[0] for c in res.description]
    types = [c[1] for c in res.description]
    want = res.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}", len(got)
    mine = dict(zip(df.columns, kinds([f.dataType.simpleString() for f in df.schema.fields])))
    theirs = dict(zip(names, kinds(types)))
    if mine != theirs:
        return "types " + str({c: (mine[c], theirs[c]) for c in mine if mine[c] != theirs[c]}), len(got)
    a, b = _rows(df.columns, got), _rows(names, want)
    if len(a) != len(b):
        return f"{len(a)} rows vs {len(b)}", len(got)
    for x, y in zip(a, b):
        if x != y:
            return f"{x} vs {y}", len(got)
    return "", len(got)
