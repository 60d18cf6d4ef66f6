"""starloom: a retail star-schema warehouse built as Spark DataFrame jobs.

Operational sales/rental tables are staged and published into a star schema:
dimension builds with surrogate keys, incremental fact loads above a
high-water mark, late-arriving-fact recovery, Type 2 product history with an
as-of key lookup, category roll-ups, daily store snapshots and integrity
audits.  Every operator is a pure ``DataFrame -> DataFrame`` function with an
explicit processing time (``as_of``); only :mod:`starloom.jobs` writes.
"""

__version__ = "0.1.0"
