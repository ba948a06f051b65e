"""Sources and sinks: table scans, stand-in views over the test tables, writers."""

from runway.sources.tables import TABLES, read_table, register_views

__all__ = ["TABLES", "read_table", "register_views"]
