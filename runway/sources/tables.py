"""Parquet table scans and temporary views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one Parquet table; filters and projections applied later reach the scan."""
    return spark.read.parquet(table_path(sf_dir, name))


def register_views(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    """Register frames as temporary views so the same plan can be written in SQL."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
