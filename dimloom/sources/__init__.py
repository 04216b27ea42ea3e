"""Sources and sinks: declared schemas, the table registry, the benchmark adapter, writers."""

from .registry import conform, from_rows, load_catalog, load_parquet
from .schemas import SOURCE_NAMES, SOURCE_SCHEMAS

__all__ = ["SOURCE_NAMES", "SOURCE_SCHEMAS", "conform", "from_rows", "load_catalog", "load_parquet"]
