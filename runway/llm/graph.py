"""Connected components of an edge table, and helpers for cutting lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runway.sources.sinks import materialise


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over undirected ``edges``, itself included.

    Alternates the large-star and small-star steps until the edge set is a
    set of stars (a logarithmic number of rounds on long chains).  A node's
    neighbours are never gathered into a row: each step is one minimum per
    node and one join.  Every round is written to the shared folder, so a lost
    executor costs tasks of one round only.  Loops and NULL ends are ignored;
    nodes without an edge to another node do not appear.
    """
    spark = edges.sparkSession
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct())
    e = materialise(spark, e, "edges")
    before = None
    while True:
        # large star: every larger neighbour points to the smallest of the neighbourhood
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: the node and its smaller neighbours point to the smallest of them
        large = large.where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
        )).alias("x")).select("x.u", "x.v").where("u > v").distinct()
        e = materialise(spark, small, "edges")
        state = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if state == before:
            break
        before = state
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
