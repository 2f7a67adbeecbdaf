"""Reading raw applications and writing curated tables."""

from creditgrade.sources.readers import read_csv, read_parquet, register_view, row_count
from creditgrade.sources.sinks import write_csv, write_parquet

__all__ = [
    "read_csv",
    "read_parquet",
    "register_view",
    "row_count",
    "write_csv",
    "write_parquet",
]
