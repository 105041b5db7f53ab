"""Run a registered query and its SQL over the same tables and compare rows exactly."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, Decimal):
        return ("num", float(v))
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float)):
        return ("num", float(v))
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None))
    return v


def kind(spark_type: str, duck_type: str) -> tuple[str, str]:
    groups = {
        "int": {"int", "bigint", "smallint", "tinyint", "INTEGER", "BIGINT", "SMALLINT", "TINYINT"},
        "float": {"double", "float", "DOUBLE", "FLOAT"},
        "string": {"string", "VARCHAR"},
        "date": {"date", "DATE"},
        "ts": {"timestamp_ntz", "timestamp", "TIMESTAMP"},
        "bool": {"boolean", "BOOLEAN"},
    }

    def group(t: str) -> str:
        for name, members in groups.items():
            if t in members:
                return name
        return t.lower().replace(" ", "")

    return group(spark_type), group(duck_type)


def mismatch(spark, con, folder, query) -> str | None:
    df = query(spark, folder)
    columns = sorted(df.columns)
    mine = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    result = con.execute(query.sql)
    names = [d[0] for d in result.description]
    types = dict(zip(names, [str(d[1]) for d in result.description]))
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    for f in df.schema.fields:
        a, b = kind(f.dataType.simpleString(), types[f.name])
        if a != b:
            return f"type of {f.name}: {f.dataType.simpleString()} != {types[f.name]}"
    order = [names.index(c) for c in columns]
    theirs = Counter(tuple(plain(r[i]) for i in order) for r in result.fetchall())
    if mine != theirs:
        a, b = list((mine - theirs).items())[:2], list((theirs - mine).items())[:2]
        return f"rows {sum(mine.values())} vs {sum(theirs.values())}\n columns {columns}\n spark {a}\n sql   {b}"
    return None
