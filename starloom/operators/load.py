"""Publishing between the staging (DS) and warehouse (DW) layers.

Parquet tables have no UPDATE or MERGE here, so flag flips and upserts are
copy-on-write DataFrame transforms; :mod:`starloom.jobs` writes the results
to per-load directories that a rerun overwrites."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dims import ts


def backfill(df: DataFrame, values: dict) -> DataFrame:
    """``ALTER TABLE ADD column`` followed by ``UPDATE … SET`` on every row."""
    for name, value in values.items():
        col = ts(value) if isinstance(value, _dt.datetime) else F.lit(value)
        df = df.withColumn(name, col)
    return df


def publish_unloaded(ds: DataFrame, flag_col: str, dw_cols: list[str]) -> DataFrame:
    """Rows of the staging table not yet published, in the warehouse's columns."""
    return ds.filter(~F.col(flag_col)).select(*dw_cols)


def mark_loaded(ds: DataFrame, flag_col: str) -> DataFrame:
    """Every row flagged as published."""
    return ds.withColumn(flag_col, F.lit(True))


def upsert(target: DataFrame, updates: DataFrame, key: list[str]) -> DataFrame:
    """``REPLACE INTO target SELECT … FROM updates``: rows of ``updates``
    replace target rows with the same key; other target rows stay."""
    cols = updates.columns
    return target.select(*cols).join(updates.select(*key), key, "left_anti").unionByName(updates)
