"""Operators of a training-data pipeline over document and embedding tables.

Nothing else in the library imports this package; its queries are added to the
registry by ``__spark_entry__`` where it is present."""
