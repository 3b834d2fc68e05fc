"""Table sources and sinks: explicit-schema scans, inline rows, appends, versions, snapshots."""

from govframe.sources.tables import load_table, rows, table_path, view

__all__ = ["load_table", "rows", "table_path", "view"]
