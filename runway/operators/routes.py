"""Route graph: edge tables, delay aggregates, and the two-hop motif.

The reference builds graph frames whose vertices are carriers, weekdays or
routes and then only queries their edge tables; those become plain edge
aggregates here.  Only the airport graph (vertices = origin airports) is a
graph proper; it feeds ``two_hop_counts`` and ``runway.operators.pagerank``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runway.functions.text import comma_part
from runway.operators.predicates import delayed_from, delayed_into
from runway.params import MOTIF_MIN_DELAY, MOTIF_MIN_TRIP_GAP
from runway.session import default_parallelism, ensure_checkpoint_dir
from runway.sources.sinks import materialise


def route_vertices(df: DataFrame, column: str = "ORIGIN") -> DataFrame:
    """Distinct vertex ids."""
    return df.select(F.col(column).alias("id")).distinct()


def route_edges(df: DataFrame, delay: str = "DEP_DELAY_NEW", attrs: dict[str, str] | None = None,
                dest_side: bool = True) -> DataFrame:
    """Edge table (src, dst, delay, attributes...).

    ``dest_side`` adds the destination's city and state (``city_dst``,
    ``state_dst``), otherwise the origin's (``city_org``, ``state_org``).
    """
    cols = [F.col(c).alias(a) for a, c in (attrs or {}).items()]
    cols += [F.col(delay).alias("delay"), F.col("ORIGIN").alias("src"), F.col("DEST").alias("dst")]
    if dest_side:
        cols += [comma_part("DEST_CITY_NAME", 0).alias("city_dst"),
                 F.col("DEST_STATE_ABR").alias("state_dst")]
    else:
        cols += [comma_part("ORIGIN_CITY_NAME", 0).alias("city_org"),
                 F.col("ORIGIN_STATE_ABR").alias("state_org")]
    return df.select(cols)


def delay_counts(edges: DataFrame, code: str, keys: list[str], outbound: bool = True) -> DataFrame:
    """Delayed legs leaving (or entering) the airport, counted per key, most first."""
    picked = delayed_from(edges, code) if outbound else delayed_into(edges, code)
    return (picked.groupBy(*keys).agg(F.count("delay").alias("n_delayed"))
                  .orderBy(F.desc("n_delayed"), *keys))


def delay_means(edges: DataFrame, code: str, keys: list[str]) -> DataFrame:
    """Mean delay of delayed legs leaving the airport, per key, largest first."""
    return (delayed_from(edges, code).groupBy(*keys).agg(F.avg("delay").alias("avg_delay"))
                                     .orderBy(F.desc("avg_delay"), *keys))


def two_hop_counts(edges: DataFrame, vertices: DataFrame, mid: str, end: str,
                   trip: str = "tripId", min_delay: float = MOTIF_MIN_DELAY,
                   min_gap: int = MOTIF_MIN_TRIP_GAP, buckets: int | None = None) -> DataFrame:
    """Paths a -[ab]-> mid -[bc]-> end, counted per start vertex ``a``.

    A path counts when ``ab.delay > min_delay OR bc.delay > min_delay`` and
    ``bc.trip > ab.trip + min_gap`` (and ``bc.trip > ab.trip``); parallel edges
    each count, ``a`` may equal ``end``, and a, mid, end must all be vertices.

    No path is materialised: the number of partners of an ``ab`` edge is the
    number of ``bc`` edges above a threshold, a rank count.  Both sides are
    first collapsed per distinct trip value (and checkpointed, so the edge table
    is scanned once), then cut into ``buckets`` ranges (default: the shuffle
    partitions) at borders that Spark's range shuffle samples, equal trip values
    together; inside a range a running count sorted by trip value gives the partners in
    that range, and per-range totals summed over the ranges above give the rest.  Work is
    linear in the edges.
    """
    ids = vertices.select(F.col("id").alias("_v"))
    mid_v = ids.where(F.col("_v") == mid)
    end_v = ids.where(F.col("_v") == end)
    if buckets is None:
        buckets = default_parallelism(edges.sparkSession)
    big = F.col("delay") > F.lit(min_delay)
    # bc side, collapsed per trip value: (key, all partners, partners with a big delay)
    points = (edges.where((F.col("src") == mid) & (F.col("dst") == end) & F.col(trip).isNotNull())
                   .join(mid_v, F.col("src") == F.col("_v"), "left_semi")
                   .join(end_v, F.col("dst") == F.col("_v"), "left_semi")
                   .groupBy(F.col(trip).cast("long").alias("_key"))
                   .agg(F.count(F.lit(1)).alias("_all"), F.count(F.when(big, 1)).alias("_big")))
    # ab side, collapsed per (a, threshold, ab has a big delay); a must be a vertex
    gap = max(int(min_gap), 0)
    queries = (edges.where((F.col("dst") == mid) & F.col(trip).isNotNull())
                    .join(ids, F.col("src") == F.col("_v"), "left_semi")
                    .join(mid_v, F.col("dst") == F.col("_v"), "left_semi")
                    .groupBy(F.col("src").alias("a"),
                             (F.col(trip).cast("long") + F.lit(gap)).alias("_key"),
                             F.coalesce(big, F.lit(False)).alias("_abbig"))
                    .agg(F.count(F.lit(1)).alias("_q")))

    # Both sides, collapsed, in one checkpointed table: the edges are scanned once,
    # although the cuts below and the counting after them both read these rows.
    zero = F.lit(0).cast("long")
    collapsed = (points.select("_key", F.lit(1).alias("_kind"), F.lit(None).cast("string").alias("a"),
                               F.lit(None).cast("boolean").alias("_abbig"), zero.alias("_q"),
                               "_all", "_big")
                 .unionByName(queries.select("_key", F.lit(0).alias("_kind"), "a", "_abbig", "_q",
                                             zero.alias("_all"), zero.alias("_big"))))
    ensure_checkpoint_dir(edges.sparkSession)
    collapsed = collapsed.checkpoint()

    ranged = collapsed.repartitionByRange(buckets, "_key").withColumn("_b", F.spark_partition_id())
    rows = materialise(edges.sparkSession, ranged, "motif-ranges")     # both uses see the same ranges
    # Inside a range, sorted by key descending with queries before points of the
    # same key, the running sum at a query covers the points with a larger key.
    w = (Window.partitionBy("_b").orderBy(F.desc("_key"), F.asc("_kind"))
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inside = (rows.withColumn("_in_all", F.sum("_all").over(w))
                  .withColumn("_in_big", F.sum("_big").over(w))
                  .where(F.col("_kind") == 0))
    # One row per range (at most `buckets`): totals of all ranges above it.
    above_w = Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("_b").agg(F.sum("_all").alias("_t_all"), F.sum("_big").alias("_t_big"))
    above = totals.select("_b",
                          F.coalesce(F.sum("_t_all").over(above_w), zero).alias("_up_all"),
                          F.coalesce(F.sum("_t_big").over(above_w), zero).alias("_up_big"))
    scored = inside.join(F.broadcast(above), "_b", "left")
    partners = F.when(F.col("_abbig"), F.col("_in_all") + F.col("_up_all")).otherwise(
        F.col("_in_big") + F.col("_up_big"))
    return (scored.groupBy("a").agg(F.sum(F.col("_q") * partners).cast("long").alias("n_paths"))
                  .where(F.col("n_paths") > 0))
