"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Every (key, shard) pair has a hash h in (0, 1); a record goes to the shard with
the greatest weight / -ln(h).  A shard wins in proportion to its weight, and a
further shard only takes records into itself: all other scores stay as they
were.  The shard of a record depends on its key and the shards alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runway.sources.sinks import materialise

RECORD_BYTES = 16          # added to the bytes of each record
SLOT_RANGES = 64           # least number of ranges in which the records of a shard are numbered


def shard_of(key: Column, weights: list[float] | int) -> Column:
    """The shard (0, 1, ...) of a key.  ``weights``: one positive weight per shard, or a number of equal shards.

    A NULL key hashes as one value, so all NULL keys share a shard, as equal keys do.
    Equal scores go to the smaller shard.
    """
    weights = [1.0] * weights if isinstance(weights, int) else [float(w) for w in weights]
    if not weights or min(weights) <= 0:
        raise ValueError("shards need positive weights")

    def score(shard: int, weight: float) -> Column:
        # the upper 52 bits, moved off 0 and 1
        h = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 12).cast("double") + 0.5) / float(1 << 52)
        return F.struct((F.lit(weight) / -F.log(h)).alias("score"), F.lit(-shard).alias("shard"))

    best = F.greatest(*[score(s, w) for s, w in enumerate(weights)]) if len(weights) > 1 else score(0, weights[0])
    return -best["shard"]


def assign_shards(docs: DataFrame, shards: list[float] | int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, size, text_crc32, shard, slot, grown_shard.

    ``size`` is the UTF-8 bytes of the text (NULL: none) plus 16 and
    ``text_crc32`` the CRC-32 of those bytes.  ``slot`` numbers the records of a
    shard from 0 without gaps: a shard's records are split into ranges by a hash
    of their content, each range is numbered by itself and moved up by the
    sizes of the ranges before it, so no task orders a whole shard.  Repeated
    equal rows are counted first and take consecutive slots.  ``grown_shard``
    is the shard with one more shard of weight 1.  Rows without an id are
    sharded by the NULL key.  The result is the same on every run.
    """
    weights = [1.0] * shards if isinstance(shards, int) else list(shards)
    key = F.col("doc_id")
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.coalesce(F.octet_length(text_col), F.lit(0)) + RECORD_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text_crc32"))
    spark = docs.sparkSession
    ranges = max(SLOT_RANGES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # equal rows as one, with their number; written, since both the offsets and the rows are read from it
    rows = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    rows = rows.select("*", shard_of(key, weights).alias("shard"), shard_of(key, [*weights, 1.0]).alias("grown_shard"),
                       F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(ranges)).alias("range"))
    rows = materialise(spark, rows, "sharded")

    totals = rows.groupBy("shard", "range").agg(F.sum("copies").alias("n"))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("shard", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "range").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (rows.withColumn("skip", F.coalesce(F.sum("copies").over(within), F.lit(0)))
              .join(offsets, ["shard", "range"]).withColumn("first", F.col("skip") + F.col("offset")))
    # copies in two steps, so that neither list is long
    step = 1 << 16
    placed = placed.withColumn("high", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {step}"))))
    placed = placed.withColumn("low", F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.lit(step - 1).cast("long"), F.col("copies") - 1 - F.col("high") * step))))
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("high") * step + F.col("low")).alias("slot"), "grown_shard")
