"""Run a report and its checking SQL on the same files and compare the rows."""

import math
import os

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def connect(folder: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def difference(df, connection, sql: str) -> str | None:
    """None when names, rows and value types agree, else a short description."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    types = dict(zip(names, (str(d[1]).upper() for d in result.description)))
    known = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
             "date": "DATE"}
    for name, kind in df.dtypes:
        if known.get(kind, kind.upper()) != types[name]:
            return f"type of {name}: {kind} != {types[name]}"
    ours, theirs = _rows(df.columns, df.collect()), _rows(names, result.fetchall())
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{sorted(names)}: {a} != {b}"
    return None
