"""Static PageRank over the airport graph, as iterative DataFrame jobs.

Per round: ``r'(v) = reset + (1 - reset) * sum over edges u->v of r(u) * n(u,v) / outdeg(u)``
(parallel edges counted through their multiplicity ``n``; vertices without
in-edges get ``reset``), starting from 1.0, for a fixed number of rounds; then
ranks are scaled to sum to the number of vertices.  Edges whose ends are not
vertices are dropped first.

Edges are collapsed to (src, dst, weight) once and written under the shared
checkpoint folder; ranks are checkpointed every round (reliable checkpoint), so
neither lineage nor an executor loss ever replays earlier rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runway.params import PAGERANK_ITERATIONS, PAGERANK_RESET, PAGERANK_TOP
from runway.session import default_parallelism, ensure_checkpoint_dir, fixed_partitions


def weighted_edges(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(src, dst, w): edge multiplicity divided by the source's out-degree."""
    ids = vertices.select(F.col("id").alias("_v")).distinct()
    # collapse parallel edges first (map-side), then keep pairs whose ends are vertices
    pairs = (edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
                  .join(ids, F.col("src") == F.col("_v"), "left_semi")
                  .join(ids, F.col("dst") == F.col("_v"), "left_semi"))
    outdeg = pairs.groupBy("src").agg(F.sum("n").alias("deg"))
    return pairs.join(outdeg, "src").select("src", "dst", (F.col("n") / F.col("deg")).alias("w"))


def pagerank(vertices: DataFrame, edges: DataFrame, reset: float = PAGERANK_RESET,
             iterations: int = PAGERANK_ITERATIONS) -> DataFrame:
    """(id, pagerank) for every vertex.

    Weights are dealt by ``src``, vertices and ranks by ``id``, once and into as many
    partitions as a shuffle makes, and kept that way by the checkpoints.  A
    round then joins in place and shuffles only the contributions, summed up
    per task, from the sources' partitions to the targets'.
    """
    spark = vertices.sparkSession
    ensure_checkpoint_dir(spark)
    partitions = default_parallelism(spark)
    with fixed_partitions(spark):
        ids = vertices.select("id").distinct().repartition(partitions, "id").checkpoint()
        weights = weighted_edges(ids, edges).repartition(partitions, "src").checkpoint()
        ranks = ids.select("id", F.lit(1.0).alias("pagerank"))
        for _ in range(iterations):
            ranks = one_round(ids, weights, ranks, reset).checkpoint()
    n_vertices = ids.count()
    total = ranks.agg(F.sum("pagerank").alias("s")).first()["s"] or 0.0
    factor = n_vertices / total if total else 0.0
    return ranks.select("id", (F.col("pagerank") * F.lit(factor)).alias("pagerank"))


def one_round(ids: DataFrame, weights: DataFrame, ranks: DataFrame, reset: float) -> DataFrame:
    """The next ranks; weights are dealt by src, vertices and ranks by id."""
    share = (weights.hint("shuffle_hash").join(ranks.hint("shuffle_hash"), weights["src"] == ranks["id"])
             .groupBy("dst").agg(F.sum(F.col("pagerank") * F.col("w")).alias("_in")))
    return (ids.join(share.hint("shuffle_hash"), ids["id"] == share["dst"], "left")
               .select("id", (F.lit(reset) + F.lit(1.0 - reset) * F.coalesce(F.col("_in"), F.lit(0.0))).alias("pagerank")))


def top_ranked(ranks: DataFrame, k: int = PAGERANK_TOP) -> DataFrame:
    """The ``k`` highest ranks (ties by id), as the reference's top-50 report."""
    return ranks.orderBy(F.desc("pagerank"), F.asc("id")).limit(k)
