"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from chargeline.sources.tables import TABLES, table_path


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def duckdb_for(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def spark_type_name(dt) -> str:
    from pyspark.sql import types as T
    names = {T.StringType: "VARCHAR", T.LongType: "BIGINT", T.IntegerType: "INTEGER",
             T.DoubleType: "DOUBLE", T.BooleanType: "BOOLEAN", T.DateType: "DATE",
             T.TimestampNTZType: "TIMESTAMP"}
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    return names.get(type(dt), dt.simpleString())


def compare(sdf, con, sql) -> list[str]:
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    otypes = {d[0]: str(d[1]) for d in res.description}
    orows = res.fetchall()
    problems = []
    if sorted(scols) != sorted(ocols):
        return [f"columns spark={scols} oracle={ocols}"]
    stypes = {f.name: spark_type_name(f.dataType) for f in sdf.schema.fields}
    tdiff = [(c, stypes[c], otypes[c]) for c in scols if stypes[c] != otypes[c]]
    if tdiff:
        problems.append(f"types {tdiff}")
    if len(srows) != len(orows):
        problems.append(f"rows spark={len(srows)} oracle={len(orows)}")
    order = sorted(range(len(scols)), key=lambda i: scols[i])
    oidx = [ocols.index(scols[i]) for i in order]
    a = sorted(tuple(norm(r[i]) for i in order) for r in srows)
    b = sorted(tuple(norm(r[i]) for i in oidx) for r in orows)
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    if diff:
        problems.append(f"{len(diff)} differing rows, first: {diff[0]}")
    return problems
