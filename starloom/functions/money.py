"""Exact money arithmetic on decimal columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S


def money(c: Column) -> Column:
    return c.cast(S.MONEY)


def avg_half_up(total: str, n: str) -> Column:
    """Average ``total / n`` rounded to cents, halves away from zero, exactly,
    for any ``n``; NULL where ``n`` is 0.

    Works in integer cents on the absolute value,
    ``(2·|cents| + n) DIV (2·n)``, so no floating point or decimal rounding is
    involved and the result does not depend on the group size.  ``total`` and
    ``n`` name columns of the aggregated frame."""
    cents = f"CAST({total} * 100 AS BIGINT)"
    return F.expr(f"CASE WHEN {n} > 0 THEN CAST(CAST(sign({cents}) AS INT) * ((2 * abs({cents}) + {n}) DIV (2 * {n})) AS DECIMAL(20,0)) / 100 "
                  f"END").cast(S.AVG_MONEY)


def prefix_equal(a: Column, b: Column, n: int) -> Column:
    return F.left(a, F.lit(n)) == F.left(b, F.lit(n))
