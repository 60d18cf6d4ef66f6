"""Readers for a deployment whose operational tables are stored as files or
reachable over JDBC.  Column names follow :data:`starloom.schema.SOURCE_SCHEMAS`."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import DataFrame, SparkSession

from .. import schema as S
from .model import Sources


def read_sources(spark: SparkSession, root: str, fmt: str = "parquet") -> Sources:
    """Read the eleven tables from ``<root>/<table>`` with explicit schemas."""
    tables = {}
    for name, ddl in S.SOURCE_SCHEMAS.items():
        reader = spark.read.format(fmt)
        if fmt != "parquet":
            reader = reader.schema(ddl)
        df = reader.load(f"{root}/{name}")
        tables[name] = df.selectExpr(*[f"CAST({c} AS {t}) AS {c}" for c, t in _cols(ddl)])
    return Sources(**tables)


def read_jdbc_table(spark: SparkSession, url: str, table: str, props: dict,
                    partition_column: str | None = None, lower=None, upper=None, num_partitions: int = 64,
                    where: str | None = None) -> DataFrame:
    """Parallel JDBC read: split on a numeric, date or timestamp column, so that
    many tasks read disjoint ranges instead of one task pulling the whole table.
    ``where`` is evaluated by the database."""
    source = f"(SELECT * FROM {table} WHERE {where}) t" if where else table
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", source)
    for k, v in props.items():
        reader = reader.option(k, v)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower)).option("upperBound", str(upper))
                  .option("numPartitions", num_partitions))
    return reader.load()


#: Tables without a date, and the key by whose hash they are split; a line table
#: also names the dated table its key leads to.
UNDATED = {"soldvia": ("tid", "salestransaction"), "rentvia": ("tid", "rentaltransaction"), "customer": ("customerid", None),
           "store": ("storeid", None), "product": ("productid", None), "rentalproducts": ("productid", None)}


def hash_predicates(key: str, parts: int) -> list[str]:
    """Conditions that deal a table's rows to disjoint parts by a hash of the
    key, evaluated by the database (rows without a key go to the first)."""
    return [f"MOD(CRC32({key}), {parts}) = {i}" + (f" OR {key} IS NULL" if i == 0 else "") for i in range(parts)]


def jdbc_plan(first: _dt.date, last: _dt.date, mark: _dt.date | None = None, num_partitions: int = 64) -> dict[str, dict]:
    """How each table is read: ``table`` (a name or subquery) with either
    ``predicates``, one a task, or a ``column`` with bounds to split by.

    Dated tables are split by date.  Line tables have no date: each task asks for
    the lines of the transactions in one hash part, joined by the database to the
    transactions after the mark, so a daily read doesn't pull the whole history.
    Master data is split by the hash of its key; regions, vendors and categories
    are small."""
    newer = f"tdate > DATE '{mark.isoformat()}'" if mark else None
    plan: dict[str, dict] = {}
    for name in S.SOURCE_SCHEMAS:
        if name in ("salestransaction", "rentaltransaction"):
            plan[name] = {"table": f"(SELECT * FROM {name} WHERE {newer}) t" if newer else name, "column": "tdate", "lower": first, "upper": last,
                          "num_partitions": num_partitions}
        elif name in UNDATED:
            key, dated = UNDATED[name]
            narrowed = f"(SELECT l.* FROM {name} l JOIN {dated} t ON t.{key} = l.{key} WHERE t.{newer}) q"
            plan[name] = {"table": narrowed if dated and newer else name, "predicates": hash_predicates(key, num_partitions)}
        else:
            plan[name] = {"table": name}
    return plan


def jdbc_sources(spark: SparkSession, url: str, props: dict, first: _dt.date, last: _dt.date,
                 mark: _dt.date | None = None, num_partitions: int = 64) -> Sources:
    """The eleven tables of an operational database, read as :func:`jdbc_plan`
    says.  (No database runs in the tests: they check the plan.)"""
    tables = {}
    for name, how in jdbc_plan(first, last, mark, num_partitions).items():
        if "predicates" in how:
            df = spark.read.jdbc(url, how["table"], predicates=how["predicates"], properties=props)
        elif "column" in how:
            df = read_jdbc_table(spark, url, how["table"], props, how["column"], how["lower"], how["upper"], how["num_partitions"])
        else:
            df = read_jdbc_table(spark, url, how["table"], props)
        tables[name] = df.selectExpr(*[f"CAST({c} AS {t}) AS {c}" for c, t in _cols(S.SOURCE_SCHEMAS[name])])
    return Sources(**tables)


def _cols(ddl: str):
    """``name type`` pairs of a DDL string (commas inside types such as
    ``decimal(7,2)`` do not split)."""
    for part in re.split(r",(?![^()]*\))", ddl):
        c, t = part.strip().split(" ", 1)
        yield c, t
