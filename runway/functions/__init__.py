"""Column expressions built only from Spark's built-in functions."""

from runway.functions import packed, schema, text, timecols

__all__ = ["packed", "schema", "text", "timecols"]
