"""op6: exact top-k against brute force, several shard sizes, ties and odd vectors."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runway.llm import topk

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("rank", T.StringType())])


def brute(rows, k):
    usable = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in usable]
    out = []
    for i, q in whole:
        if i % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in whole if j != i and len(v) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows, k):
    df = spark.createDataFrame([(i, v, "clash") for i, v in rows], VECTORS)
    return sorted(tuple(r) for r in topk.top_k(df, F.col("id") % 20 == 0, k).collect())


@pytest.mark.parametrize("shard,run_size,block", [(16_384, 4096, 1024), (60, 16, 4)])
def test_against_brute_force(spark, monkeypatch, shard, run_size, block):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    monkeypatch.setattr(topk, "RUN", run_size)
    monkeypatch.setattr(topk, "QUERY_ROWS", block)
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.2) if rng.random() < 0.7 else 0.0 for _ in range(12)]) for i in range(300)]
    rows += [(300 + i, rows[40][1]) for i in range(40)]  # a vector that many share: ties
    rows += [(400, None), (401, []), (420, [float("nan")] * 12), (440, [float("inf")] + [0.0] * 11), (460, [None] + [0.1] * 11), (None, [0.1] * 12),
             (480, [0.5, -0.5]), (481, [0.25, 0.25]), (500, [0.0] * 12), (60, rows[60][1]), (60, rows[60][1])]
    assert run(spark, rows, 20) == brute(rows, 20)


def test_few_candidates_and_huge_components(spark):
    rows = [(0, [1e12, 3.0]), (1, [2e12, 1.0]), (2, [-1e3, 1.0])]
    assert run(spark, rows, 20) == [(0, r, j, max(-(1 << 63), min((1 << 63) - 1, s))) for _, r, j, s in brute(rows, 20)]


def test_empty_table(spark):
    assert run(spark, [], 20) == []


def test_no_term_is_skipped_wrongly():
    import numpy as np
    rng = np.random.default_rng(6)
    w = np.floor(rng.normal(0, 8, (500, 24)))
    for q in np.floor(rng.normal(0, 8, (20, 24))):
        best = []
        for at in range(0, 500, 50):
            best = topk.Run(np.arange(at, at + 50), w[at:at + 50]).search(q, -1, best, 10)
        s = w @ q
        want = sorted(((float(s[i]), -i) for i in range(500)), reverse=True)[:10]
        assert best == want
