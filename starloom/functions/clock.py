"""Processing-time literals."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts(value: _dt.datetime) -> Column:
    """A processing-time literal (wall clock, no time zone).  Built from text,
    so neither the Python nor the session time zone can shift it."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
