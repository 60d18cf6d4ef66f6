"""Readers of a deployment's operational tables."""

import tempfile

from conftest import SF_SMALL
from starloom import schema as S
from starloom.sources import fixture_sources, read_sources


def test_read_sources_round_trip(spark):
    src = fixture_sources(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="starloom-oltp-")
    for name, df in src.tables().items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
    back = read_sources(spark, root)
    for name, df in back.tables().items():
        assert df.columns == S.SOURCE_COLUMNS[name]
        assert df.count() == src.tables()[name].count()
    assert back.soldvia.count() == 4030 and back.rentvia.count() == 1921
