"""Registration of queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import duckdb
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queryset.views import GivenTables, check_sql

QUERIES: dict[str, Callable[[GivenTables], DataFrame]] = {}
CHECKS: dict[str, str] = {}

DAY = "1998-06-01"  # test date of most jobs; the given orders run from 1995 to 2001
DAYS = ["1998-05-28", "1998-06-01", "1998-06-08"]  # for jobs that take many dates


def query(name: str, sql: str | None = None, **steps: str):
    """Register a Spark job; ``sql`` (with named steps before it) checks it."""

    def add(fn: Callable[[GivenTables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = check_sql(sql, steps)
        return fn

    return add


def _rounded(c: Column) -> Column:
    """Nine places for small numbers, six for others. Spelled out so that both
    engines carry out the same floating-point steps, ties included."""
    small, large = F.floor(c * 1e9 + 0.5) / 1e9, F.floor(c * 1e6 + 0.5) / 1e6
    return F.when(F.abs(c) < 1000, small).otherwise(large)


def _rounded_sql(col: str) -> str:
    d = f"CAST({col} AS DOUBLE)"
    return (
        f"CASE WHEN abs({d}) < 1000 THEN floor({d} * 1e9 + 0.5) / 1e9 ELSE floor({d} * 1e6 + 0.5) / 1e6 END AS {col}"
    )


def publish(df: DataFrame) -> DataFrame:
    """Types both engines agree on: 64-bit integers, rounded doubles,
    dates and timestamps as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = _rounded(c.cast("double"))
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


# Column types of the given tables that the views read.
_GIVEN_DDL = """
CREATE TABLE region(r_regionkey INTEGER, r_name VARCHAR);
CREATE TABLE nation(n_nationkey INTEGER, n_name VARCHAR, n_regionkey INTEGER);
CREATE TABLE customer(c_custkey BIGINT, c_name VARCHAR, c_nationkey INTEGER, c_acctbal DOUBLE, c_mktsegment VARCHAR);
CREATE TABLE supplier(s_suppkey BIGINT, s_name VARCHAR, s_nationkey INTEGER, s_acctbal DOUBLE);
CREATE TABLE part(p_partkey BIGINT, p_name VARCHAR, p_brand VARCHAR, p_type VARCHAR, p_size INTEGER, p_retailprice DOUBLE);
CREATE TABLE orders(o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus VARCHAR, o_totalprice DOUBLE, o_orderdate TIMESTAMP, o_orderpriority VARCHAR);
CREATE TABLE lineitem(l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INTEGER, l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag VARCHAR, l_linestatus VARCHAR, l_shipdate TIMESTAMP);
CREATE TABLE events(event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR);
"""


def checks_with_types() -> dict[str, str]:
    """The checking SQL with the same output types as :func:`publish`."""
    con = duckdb.connect()
    con.execute(_GIVEN_DDL)
    out = {}
    for name, text in CHECKS.items():
        items = []
        for col, kind, *_ in con.execute(f"DESCRIBE {text}").fetchall():
            quoted = f'"{col}"'
            if kind in ("DOUBLE", "FLOAT") or kind.startswith("DECIMAL"):
                items.append(_rounded_sql(quoted))
            elif kind in ("HUGEINT", "INTEGER", "SMALLINT", "TINYINT", "UBIGINT", "UINTEGER"):
                items.append(f"CAST({quoted} AS BIGINT) AS {quoted}")
            elif kind == "DATE" or kind.startswith("TIMESTAMP"):
                items.append(f"CAST({quoted} AS VARCHAR) AS {quoted}")
            else:
                items.append(quoted)
        out[name] = f"SELECT {', '.join(items)} FROM (\n{text}\n) checked"
    con.close()
    return out


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, sf_dir: publish(fn(GivenTables(spark, sf_dir)))

    return {name: bind(fn) for name, fn in QUERIES.items()}
