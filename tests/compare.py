"""Run queries next to their SQL and compare values."""

import glob
import math
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return str(value)


def table_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean", "DATE": "date",
    "HUGEINT": "decimal(38,0)",
}


def type_difference(df, con, sql):
    found = {d[0]: str(d[1]) for d in con.execute(f"DESCRIBE {sql}").fetchall()}
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    return {k: (have.get(k), v) for k, v in found.items() if have.get(k) != TYPES.get(v, v)}


def difference(df, con, sql):
    """None when equal, else a short text."""
    found = con.execute(sql)
    names, expected = table_of([d[0] for d in found.description], found.fetchall())
    got_names, got = table_of(df.columns, [tuple(r) for r in df.collect()])
    if names != got_names:
        return f"columns {got_names} instead of {names}"
    if got != expected:
        extra = [r for r in got if r not in set(expected)][:3]
        missing = [r for r in expected if r not in set(got)][:3]
        return f"{len(got)} rows instead of {len(expected)}; extra {extra}; missing {missing}"
    return None
