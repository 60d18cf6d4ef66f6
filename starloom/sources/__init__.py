"""Source (operational) tables: loaders and the fixture adapter."""

from .model import Sources
from .fixtures import fixture_sources, read_table
from .readers import read_sources

__all__ = ["Sources", "fixture_sources", "read_table", "read_sources"]
