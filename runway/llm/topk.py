"""Exact top-k inner-product search by MaxScore over sharded postings.

A vector's component x becomes the integer floor(64 * x); dimensions are the
terms, and a dimension's posting list holds the vectors with a component other
than 0.  Vectors are dealt to shards and queries to blocks, and every (shard,
block) is one task: a stated query set against all rows, in blocks.

Within a shard the postings lie in runs of ``RUN`` vectors, each with its own
score bounds per term.  For a query the terms are ordered by their bound; the
terms at the end whose bounds together stay under the threshold (the k-th best
score so far) are non-essential.  The essential postings are traversed; each
other term is probed only for vectors whose score plus the remaining bounds
still reaches the threshold.  The best k of every shard are merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runway.session import default_parallelism

SHARD_ROWS = 16_384        # vectors in a shard, about
QUERY_ROWS = 1_024         # queries in a block, about
RUN = 4_096                # vectors in a run of postings
LIMIT = 2.0 ** 53          # sums below this are exact in double precision
_MAX, _MIN = (1 << 63) - 1, -(1 << 63)


class Run:
    """Postings of consecutive vectors of a shard, with the largest and smallest weight of each term."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray) -> None:
        self.ids, self.columns = ids, np.ascontiguousarray(weights.T)
        self.high, self.low = weights.max(axis=0, initial=0), weights.min(axis=0, initial=0)
        self.postings = [np.flatnonzero(c) for c in self.columns]

    def search(self, query: np.ndarray, own: int, best: list[tuple], k: int) -> list[tuple]:
        """``best`` (score, -id pairs, best first) after this run's vectors."""
        bound = np.maximum(query * self.high, query * self.low)
        terms = np.argsort(-bound, kind="stable")
        terms = terms[query[terms] != 0]
        rest = np.append(np.cumsum(bound[terms][::-1])[::-1], 0)   # bounds of a term and all after it
        floor = best[-1][0] if len(best) == k else -np.inf
        essential = int(np.argmax(rest < floor)) if (rest < floor).any() else len(terms)
        scores = np.zeros(len(self.ids), dtype=self.columns.dtype)
        for t in terms[:essential]:
            at = self.postings[t]
            if 2 * len(at) >= len(scores):  # a long list: with its zeros, in place
                scores += query[t] * self.columns[t]
            else:
                scores[at] += query[t] * self.columns[t][at]
        alive = np.flatnonzero(scores + rest[essential] >= floor)
        scores = scores[alive]
        for j in range(essential, len(terms)):
            scores = scores + query[terms[j]] * self.columns[terms[j]][alive]
            keep = scores + rest[j + 1] >= floor
            if not keep.all():
                alive, scores = alive[keep], scores[keep]
        found = self.ids[alive]
        other = found != own
        found, scores = found[other], scores[other]
        if len(found) > k:
            top = np.lexsort((found, -scores))[:k]
            found, scores = found[top], scores[top]
        return sorted([*best, *((s, -i) for s, i in zip(scores.tolist(), found.tolist(), strict=True))], reverse=True)[:k]


def _weights(raw: list[bytes], dim: int) -> np.ndarray:
    w = np.floor(64.0 * np.frombuffer(b"".join(raw), dtype="<f8").reshape(len(raw), dim))
    if w.size and dim * np.abs(w).max() ** 2 >= LIMIT:  # too large for exact doubles: whole numbers of any size
        w = np.array([[int(x) for x in row] for row in w], dtype=object).reshape(w.shape)
    return w


def _search(pdf: pd.DataFrame, k: int) -> pd.DataFrame:
    """One shard and one block of queries, each a row of packed vectors -> the best k of each query in the shard."""
    rows = []
    for row in pdf.itertuples(index=False):
        ids, queries = np.frombuffer(row.ids, "<i8"), np.frombuffer(row.query_ids, "<i8")
        weights, asked = _weights([row.vectors], row.dim * len(ids)), _weights([row.query_vectors], row.dim * len(queries))
        weights, asked = weights.reshape(len(ids), row.dim), asked.reshape(len(queries), row.dim)
        if object in (weights.dtype, asked.dtype) or (weights.size and asked.size and row.dim * np.abs(weights).max() * np.abs(asked).max() >= LIMIT):
            weights, asked = ([[int(x) for x in v] for v in m] for m in (weights, asked))
            weights, asked = np.array(weights, dtype=object).reshape(len(ids), row.dim), np.array(asked, dtype=object).reshape(len(queries), row.dim)
        order = np.argsort(ids, kind="stable")
        runs = [Run(ids[order[at:at + RUN]], weights[order[at:at + RUN]]) for at in range(0, len(ids), RUN)]
        for q, own in zip(asked, queries.tolist(), strict=True):
            best: list[tuple] = []
            for run in runs:
                best = run.search(q, own, best, k)
            rows += [(own, -i, max(_MIN, min(_MAX, int(s)))) for s, i in best]
    return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype("int64")


def _packed(vectors: DataFrame, group: str, ids: str, data: str) -> DataFrame:
    """One row per (dim, group): its ids and its vectors as packed binaries."""
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        flat = np.concatenate([np.asarray(v, dtype="<f8") for v in pdf["v"]])
        return pd.DataFrame({"dim": [pdf["dim"].iloc[0]], group: [pdf[group].iloc[0]],
                             ids: [pdf["id"].to_numpy("<i8").tobytes()], data: [flat.astype("<f8").tobytes()]})
    return vectors.groupBy("dim", group).applyInPandas(pack, f"dim int, {group} long, {ids} binary, {data} binary")


def top_k(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k best other rows for each query row: query_id, rank (from 1), vec_id, score.

    ``is_query`` is a condition on the column ``id``.  Rows without an id, and
    vectors that are NULL, empty, or hold a NULL or non-finite component, take no
    part.  Equal rows count once, and a query meets no row with its own id.
    Vectors meet only vectors of their own length.  Ties go to the smaller id;
    with fewer than k candidates all are returned.  Scores beyond 64 bits are cut
    to the largest or smallest long.
    """
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    v = v.where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & ~F.coalesce(bad, F.lit(False)))
    v = v.distinct().withColumn("dim", F.size("v"))
    queries = v.where(is_query)
    n, asked = v.count(), queries.count()
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-asked // QUERY_ROWS))
    of = lambda count: F.pmod(F.xxhash64("id", "v"), F.lit(count).cast("long"))
    parts = _packed(v.withColumn("shard", of(shards)), "shard", "ids", "vectors")
    parts = parts.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    questions = _packed(queries.withColumn("block", of(blocks)), "block", "query_ids", "query_vectors")
    # few rows, each worth seconds: a stated number of partitions, which adaptive execution leaves alone
    spread = min(1 << 15, max(default_parallelism(vectors.sparkSession), 4 * shards * blocks))
    met = parts.join(questions, ["dim", "block"]).repartition(spread, "dim", "shard", "block")
    found = met.groupBy("dim", "shard", "block").applyInPandas(lambda pdf: _search(pdf, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
