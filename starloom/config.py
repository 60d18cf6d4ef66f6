"""Run parameters.  Every clock the operators use is an explicit argument."""

from __future__ import annotations

import dataclasses
import datetime as _dt

from . import schema as S


@dataclasses.dataclass(frozen=True)
class Params:
    """Parameters of the pipeline and of the test scenario on the fixtures.

    The fixture tables are one static snapshot, so the scenario says when
    each order *arrives* in the operational system:

    * base orders (``tdate <= base_cutoff``) are present at the initial load;
    * orders dated after ``base_cutoff`` arrive for the daily refresh;
    * orders whose key is a multiple of ``late_every`` and dated on or before
      the cutoff arrive after the initial load (late-arriving facts).

    The three sets partition the orders, so the three loads together process
    every row of the tables.
    """

    base_cutoff: _dt.date = _dt.date(2000, 12, 31)
    late_every: int = 97
    dims_loaded_at: _dt.datetime = _dt.datetime(2000, 6, 1, 2, 0, 0)
    # dimension-refresh scenario: the dimensions being refreshed were loaded
    # at ``master_loaded_at`` with the master data that orders dated up to
    # ``master_cutoff`` reference; everything else registers later
    master_cutoff: _dt.date = _dt.date(1995, 3, 31)
    master_loaded_at: _dt.datetime = _dt.datetime(1995, 4, 1, 2, 0, 0)
    initial_as_of: _dt.datetime = _dt.datetime(2000, 12, 31, 2, 0, 0)
    refresh_as_of: _dt.datetime = _dt.datetime(2001, 9, 1, 2, 0, 0)
    scd_as_of: _dt.datetime = _dt.datetime(2000, 7, 1, 2, 0, 0)
    open_dvf: _dt.date = _dt.date(1990, 1, 1)
    open_dvu: _dt.date = S.OPEN_DVU
    tracked_category: str = "PROMO"
    high_value: int = S.HIGH_VALUE_THRESHOLD
    zip_prefix: int = S.ZIP_PREFIX_LEN
    # stores whose number is a multiple of this register after master_cutoff
    held_store_every: int = 5
    # the calendar that the extension scenario starts from covers these years
    calendar_first: _dt.date = _dt.date(1994, 1, 1)
    calendar_last: _dt.date = _dt.date(1996, 12, 31)
    # products whose number leaves this remainder by 50 are in the warehouse only
    dw_only_remainder: int = 7
    # audits run on a fact with planted faults: lines of every 40th product
    # twice, and dimensions without every 89th key
    planted_duplicate_every: int = 40
    planted_orphan_every: int = 89
    # the customer of every second transaction in the scenario of frequent members
    hot_customer: str = "C7"
    # a dimension with a history of more rows than this is carried forward to the
    # lines instead of joined by interval
    carry_above: int = 2_000_000
    # buckets of the loaded-transaction index (fixed when it is first written)
    tid_buckets: int = 64
    # lag of the customer refresh's extraction stamp, in days
    customer_stamp_lag_days: int = 1


DEFAULT = Params()
