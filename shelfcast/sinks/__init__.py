from shelfcast.sinks.parquet import read_table, write_by_month, write_table
from shelfcast.sinks.release import Release

__all__ = ["Release", "read_table", "write_by_month", "write_table"]
