"""Run the warehouse procedures end to end on the fixture tables.

    python -m starloom <sf_dir> <warehouse_root>

Initial load (base orders), dimension refresh, daily refresh, late-fact
refresh, one Type 2 round and the snapshot mart, in the order the original
procedures are run; prints one JSON line per step."""

from __future__ import annotations

import json
import sys

from . import jobs
from .plans.scenario import Warehouse
from .session import local_session


def main(argv: list[str]) -> int:
    if len(argv) != 2:
        print(__doc__, file=sys.stderr)
        return 2
    sf_dir, root = argv
    spark = local_session()
    w = Warehouse(spark, sf_dir)
    p = w.p
    steps = [
        ("initial_load", lambda: jobs.run_initial_load(spark, w.base_src, root, p.initial_as_of,
                                                       p.dims_loaded_at, p)),
        ("dimension_refresh", lambda: jobs.run_dimension_refresh(spark, w.src, root, p.refresh_as_of, p)),
        ("daily_refresh", lambda: jobs.run_daily_refresh(spark, w.src, root, p.refresh_as_of,
                                                         f"daily-{p.refresh_as_of:%Y%m%d}")),
        ("late_fact_refresh", lambda: jobs.run_late_fact_refresh(spark, w.src, root, p.refresh_as_of,
                                                                 f"late-{p.refresh_as_of:%Y%m%d}")),
        ("scd2_products", lambda: jobs.run_scd2_products(spark, w.changed_src, root, p.refresh_as_of, p)),
        ("daily_store_snapshot", lambda: {"rows": jobs.run_daily_store_snapshot(spark, root, p).count()}),
    ]
    for name, step in steps:
        print(json.dumps({"step": name, **step()}), flush=True)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
