"""Flight-leg normalisation and the previous-leg outcome of each aircraft.

``normalise_flights`` is the reference's flight transform: drop cancelled and
diverted legs, type and derive 35 contract columns in one projection, and add
``PR_ARR_DEL15`` = the arrival-delay flag of the same aircraft's previous leg.

The previous-leg lookup is a ``lag`` over a window partitioned by tail number.
A single tail number (NULL above all, which every untracked leg shares) can
hold a large share of all legs; one window partition would then be one task.
``lag_by`` therefore cuts the rows into ranges of the whole order (key, then
order columns) of about equal size, takes each row's value from the row before it in
the range, and hands the last row of a range over to the next one.  Only the
columns of the order and the value are moved for that; whole rows stay where
they were written, and the values come back to them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runway.functions.text import comma_part, concat_key
from runway.functions.timecols import block_hour, hhmm_round_hour, hhmm_timestamp, trunc_hour
from runway.operators.predicates import not_flagged
from runway.params import FLIGHT_COLUMNS
from runway.session import default_parallelism
from runway.sources.sinks import materialise, materialise_buckets


PIECE_BITS = 17       # a piece holds the rows of one task whose numbers agree above these bits
BUCKETS = 64          # least number of buckets of pieces: the values of one are held by a task


def _with_before(key: str):
    """An in-order partition of (key, _value, ...) with ``_before``, the key and value of the row before, and its count ``_n``."""
    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            own = pa.StructArray.from_arrays([batch.column(key), batch.column("_value")], names=["k", "v"])
            first = pa.nulls(1, own.type) if last is None else last
            before = pa.concat_arrays([first, own.slice(0, len(own) - 1)])
            last = own.slice(len(own) - 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, before, pa.array(np.arange(n, n + len(own)))], names=[*batch.schema.names, "_before", "_n"])
            n += len(own)
    return shift


def lag_by(df: DataFrame, value: str, key: str, order: list[str], out: str,
           ranges: int | None = None) -> DataFrame:
    """``out = lag(value, 1) over (partition by key order by order...)``, skew safe.

    Rows with a NULL ``key`` form one group, as in a Spark window.  ``order`` is
    ascending with NULLs first, of any sortable types.  Rows that it leaves tied are
    ordered by a hash of their content, so the result does not depend on how the rows
    were partitioned; rows alike in all columns are told apart by a row number, which
    cannot change the result.  Columns of map type stay out of the hash.

    ``df`` runs once: it is written with row numbers, in buckets by pieces of
    consecutive numbers.  Key, order, value and number alone are cut into ``ranges`` (default:
    the shuffle partitions) by sampled borders of (key, order..., hash, number) and written
    with the row before each, so that a lost executor finds the same ranges.  However the
    keys and times are spread, all of them equal or NULL included, a range holds about
    1 / ranges of the rows.  The values then go to the buckets of their rows, which
    are not shuffled as long as the session has the setting below.
    """
    spark = df.sparkSession
    ranges = ranges or default_parallelism(spark)
    buckets = max(ranges, BUCKETS)
    content = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    numbered = numbered.withColumn("_piece", F.shiftright("_row", PIECE_BITS))
    whole = materialise_buckets(spark, numbered, "lag-whole", "_piece", buckets)
    order = [*order, "_hash", "_row"]
    rows = whole.withColumn("_hash", F.xxhash64(*content)).withColumn("_value", F.col(value))
    rows = materialise(spark, rows.select(*dict.fromkeys([key, *order, "_value"])), "lag-rows")
    cut = rows.repartitionByRange(ranges, key, *order).sortWithinPartitions(key, *order)
    cut = cut.select(key, "_value", "_row", F.spark_partition_id().alias("_range"))
    pair = T.StructType([T.StructField("k", cut.schema[key].dataType), T.StructField("v", cut.schema["_value"].dataType)])
    fields = [T.StructField(f.name, f.dataType) for f in cut.schema.fields]
    schema = T.StructType([*fields, T.StructField("_before", pair), T.StructField("_n", T.LongType())])
    cut = materialise(spark, cut.mapInArrow(_with_before(key), schema), "lag-ranges")

    # the last row of each range, one of each, for the first row of the next one
    last = cut.groupBy("_range").agg(F.max_by(F.struct(F.col(key).alias("k"), F.col("_value").alias("v")), "_n").alias("_last"))
    handover = last.select(F.col("_range").alias("_to"), F.lag("_last").over(Window.orderBy("_range")).alias("_handed"))
    fixed = cut.join(F.broadcast(handover), F.col("_before").isNull() & (F.col("_range") == F.col("_to")), "left")
    fixed = fixed.withColumn("_before", F.coalesce("_before", "_handed"))
    same = F.col("_before").isNotNull() & F.col(key).eqNullSafe(F.col("_before.k"))
    values = fixed.select(F.shiftright("_row", PIECE_BITS).alias("_piece"), "_row", F.when(same, F.col("_before.v")).alias("_lag"))
    # read when a plan runs, which is after a query has returned its DataFrame: it stays set
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return whole.join(values.hint("shuffle_hash"), ["_piece", "_row"], "left").withColumn(out, F.col("_lag")).drop("_piece", "_row", "_lag")


def normalise_flights(df: DataFrame, tie_breakers: tuple[str, ...] = (),
                      keep: tuple[str, ...] = (),
                      prior: bool = True, ranges: int | None = None) -> DataFrame:
    """Raw legs -> the 35-column flight contract (plus ``keep`` columns).

    ``tie_breakers`` extend the window order after ``CRS_DEP_TIMESTAMP``; legs
    that share a scheduled time without them are ordered by their content.  With
    ``prior=False`` the previous-leg flag is left NULL and no window runs (for
    consumers that never read it).
    """
    fl_date = F.col("FL_DATE").cast("date")
    to_text = ("YEAR", "QUARTER", "MONTH", "DAY_OF_MONTH", "DAY_OF_WEEK",
               "DISTANCE_GROUP", "DEP_DEL15", "ARR_DEL15")
    derived = {
        "FL_DATE": fl_date,
        "FL_PATH": concat_key("ORIGIN", "DEST", sep="-"),
        "OP_CARRIER_FL_NUM": concat_key("OP_CARRIER", "OP_CARRIER_FL_NUM", sep="_"),
        "CRS_DEP_TIME_HOUR": hhmm_round_hour("CRS_DEP_TIME"),
        "DEP_TIME_HOUR": block_hour("DEP_TIME_BLK"),
        "CRS_ARR_TIME_HOUR": hhmm_round_hour("CRS_ARR_TIME"),
        "ARR_TIME_HOUR": block_hour("ARR_TIME_BLK"),
        "CRS_DEP_TIMESTAMP": hhmm_timestamp(fl_date, "CRS_DEP_TIME"),
        "CRS_ARR_TIMESTAMP": hhmm_timestamp(fl_date, "CRS_ARR_TIME"),
    }
    derived.update({c: F.col(c).cast("string") for c in to_text})
    extra = [c for c in dict.fromkeys(tie_breakers + keep) if c not in FLIGHT_COLUMNS]
    body = [derived.get(c, F.col(c)).alias(c) for c in FLIGHT_COLUMNS if c != "PR_ARR_DEL15"]
    typed = not_flagged(df).select(*body, *extra)
    if prior:
        lagged = lag_by(typed, "ARR_DEL15", "TAIL_NUM",
                        ["CRS_DEP_TIMESTAMP", *tie_breakers], "PR_ARR_DEL15", ranges=ranges)
    else:
        lagged = typed.withColumn("PR_ARR_DEL15", F.lit(None).cast("string"))
    return lagged.select(*FLIGHT_COLUMNS, *[c for c in keep if c not in FLIGHT_COLUMNS])


def with_hour_keys(df: DataFrame) -> DataFrame:
    """Add the hour join keys, the route and the two city names."""
    return df.withColumns({
        "dep_time": trunc_hour("CRS_DEP_TIMESTAMP"),
        "arr_time": trunc_hour("CRS_ARR_TIMESTAMP"),
        "FL_PATH": concat_key("ORIGIN", "DEST", sep="-"),
        "ORIGIN_CITY": comma_part("ORIGIN_CITY_NAME", 0),
        "DEST_CITY": comma_part("DEST_CITY_NAME", 0),
    })
