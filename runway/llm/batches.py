"""Size of the Arrow batches between Spark and Python: these rows hold whole texts, so rows alone are no measure."""

from pyspark.sql import SparkSession

ROWS = 2_000
BYTES = 4 << 20


def limit_batches(spark: SparkSession) -> None:
    """Send at most ROWS rows, and no more than BYTES and one row, at once in this session (smaller settings stay).

    The settings are read when a plan runs, which is after a query has returned its
    DataFrame, so they stay set.
    """
    for name, most in (("maxRecordsPerBatch", ROWS), ("maxBytesPerBatch", BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(key).removesuffix("b")
        if not (now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(key, str(most))
