"""Writers for the result table."""

from titlematch.sinks.write import ParquetTarget, TableTarget, write_table

__all__ = ["ParquetTarget", "TableTarget", "write_table"]
