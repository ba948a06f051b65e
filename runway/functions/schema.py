"""Schema-level helpers: prefixing, selection by type, schema comparison, conforming."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def prefix_columns(df: DataFrame, prefix: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Prefix every column name (``time`` -> ``dep_time``), except those in ``keep``."""
    return df.select([F.col(c).alias(c if c in keep else prefix + c) for c in df.columns])


def columns_of_type(df: DataFrame, data_type: type = T.DoubleType) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, data_type)]


def select_by_type(df: DataFrame, data_type: type = T.DoubleType) -> DataFrame:
    """Project the columns whose type is ``data_type`` (schema driven)."""
    return df.select(columns_of_type(df, data_type))


def schema_diff(spark: SparkSession, left: DataFrame, right: DataFrame) -> DataFrame:
    """Column-by-column comparison of two schemas.

    One row per column name in either frame: its position and type on each
    side, and ``same`` when name, position and type all agree.  Both column
    lists equal means every row has ``same = true``.
    """
    def rows(df):
        return [(f.name, i, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]

    schema = "name string, pos int, type string"
    a = spark.createDataFrame(rows(left), schema).alias("a")
    b = spark.createDataFrame(rows(right), schema).alias("b")
    joined = a.join(b, F.col("a.name") == F.col("b.name"), "full_outer")
    return joined.select(
        F.coalesce("a.name", "b.name").alias("name"),
        F.col("a.pos").alias("left_pos"), F.col("b.pos").alias("right_pos"),
        F.col("a.type").alias("left_type"), F.col("b.type").alias("right_type"),
        (F.col("a.pos").eqNullSafe(F.col("b.pos"))
         & F.col("a.type").eqNullSafe(F.col("b.type"))
         & F.col("a.name").isNotNull() & F.col("b.name").isNotNull()).alias("same"),
    )


def same_columns(left: DataFrame, right: DataFrame) -> bool:
    """``left.columns == right.columns`` (names and order)."""
    return left.columns == right.columns


# pandas dtype name -> Spark type, as the reference's typed-ingest table maps them.
DTYPE_TO_SPARK = {
    "datetime64[ns]": T.TimestampType(),
    "int64": T.LongType(),
    "int32": T.IntegerType(),
    "float64": T.FloatType(),
}


def spark_type_for(dtype_name: str) -> T.DataType:
    return DTYPE_TO_SPARK.get(dtype_name, T.StringType())


def conform(df: DataFrame, schema: T.StructType, strict: bool = True, failed: Observation | None = None) -> DataFrame:
    """Cast ``df`` to a declared schema, by column name and in the schema's order.

    A value that does not convert raises (ANSI cast); with ``strict=False`` it
    becomes NULL (``try_cast``).  Missing columns become typed NULLs.

    With ``strict=False``, ``failed`` (an unused ``pyspark.sql.Observation``) counts, in
    the same pass, the values that did not convert: after the first action on
    the result ``failed.get`` holds one number per column that both sides have, and
    ``rows``.  A column of the input that is itself called ``rows`` is counted as ``rows_``.
    """
    present = set(df.columns)
    cast = {f.name: F.col(f"`{f.name}`").cast(f.dataType) if strict else F.col(f"`{f.name}`").try_cast(f.dataType)
            for f in schema.fields if f.name in present}
    if failed is not None:
        if strict:
            raise ValueError("a strict cast raises at the first value that does not convert: there is nothing to count")
        counts = [F.count_if(F.col(f"`{n}`").isNotNull() & c.isNull()).alias("rows_" if n == "rows" else n) for n, c in cast.items()]
        df = df.observe(failed, F.count(F.lit(1)).alias("rows"), *counts)
    return df.select(*[cast.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])
