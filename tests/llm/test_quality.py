"""op8: held-out accuracy, isotonic fit, normal equations, odd rows."""

import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runway.llm import quality
from runway.llm.wordhash import word_hashes

LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())])


@pytest.fixture
def corpus(lorem):
    docs, labels = [], []
    for i in range(400):
        good = i % 3 != 0
        text = ". ".join(lorem(12).capitalize() for _ in range(5)) if good else " ".join(w + "###" for w in lorem(60).split())
        docs.append((i, text))
        labels.append((i, int(good), 0))
    return docs, labels


def scored(spark, docs, labels):
    stats = docs.select("doc_id", quality.statistics("text").alias("stats"))
    model = quality.fit(quality.training_rows(stats, spark.createDataFrame(labels, LABELS)))
    return {r["doc_id"]: r for r in stats.select("doc_id", quality.held_out().alias("held_out"), quality.scorer(model)("stats").alias("score")).collect()}


def test_held_out_accuracy(spark, make_docs, corpus):
    docs, labels = corpus
    out = scored(spark, make_docs(docs), labels)
    held = [(q, out[i]["score"] >= 0.3) for i, q, _ in labels if out[i]["held_out"]]
    assert len(held) > 50 and sum(bool(q) == p for q, p in held) / len(held) > 0.95
    assert all(out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _ in docs)
    assert all(0 <= r["score"] <= 1 for r in out.values())


def test_held_out_labels_are_not_learned(spark, make_docs, corpus):
    docs, labels = corpus
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    a, b = (scored(spark, make_docs(docs), x) for x in (labels, flipped))
    assert all(abs(a[i]["score"] - b[i]["score"]) < 1e-9 for i, _ in docs)


def test_odd_rows(spark, make_docs, corpus):
    docs, labels = corpus
    odd = [(1000, None), (1001, ""), (1002, " \n"), (1003, "é" * 50_000), (None, "plain text")]
    out = scored(spark, make_docs(docs + odd), labels + [(5, None, 0), (7, 1, 1), (7, 1, 1), (None, 1, 0), (9999, 0, 0)])
    assert set(out) >= {1000, 1001, 1002, 1003, None} and out[None]["held_out"] is False
    assert out[1000]["score"] == out[1001]["score"] and all(0 <= out[i]["score"] <= 1 for i in (1000, 1002, 1003))


def test_no_labels_and_no_documents(spark, make_docs):
    out = scored(spark, make_docs([(1, "some text")]), [])
    assert out[1]["score"] == 0.5
    assert scored(spark, make_docs([]), [(1, 1, 0)]) == {}


def test_pool_adjacent_is_the_closest_monotone_sequence():
    rng = np.random.default_rng(2)
    v, w = rng.random(40), rng.integers(1, 5, 40).astype(float)
    got = quality.pool_adjacent(v, w)
    assert (np.diff(got) >= -1e-12).all()
    # min-max formula of isotonic regression
    mean = lambda a, b: np.average(v[a:b + 1], weights=w[a:b + 1])
    want = [max(min(mean(a, b) for b in range(i, 40)) for a in range(i + 1)) for i in range(40)]
    assert np.allclose(got, want)


def test_normal_equations_match_one_solve(spark, make_docs, corpus):
    docs, labels = corpus
    stats = make_docs(docs).repartition(7).select("doc_id", quality.statistics("text").alias("stats"))
    rows = quality.training_rows(stats, spark.createDataFrame(labels, LABELS)).cache()
    model = quality.fit(rows)
    part = rows.where(f"fold % {quality.FOLDS} != 0").collect()
    z = model.features(np.array([r["stats"] for r in part]))
    y = np.array([r["label"] for r in part], dtype=float)
    want = np.linalg.solve(z.T @ z + quality.RIDGE * np.eye(z.shape[1]), z.T @ y)
    assert np.allclose(z @ model.weights, z @ want, atol=1e-6)
    assert rows.where(F.col("fold").isNull()).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables not present")
def test_query_against_brute_force(spark):
    """op8 recomputed in plain numpy: one solve over all training rows, isotonic levels by averages of all ranges."""
    from runway.llm import queries
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in queries.QUERIES["op8_quality"](spark, sf).collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    labels = {(r["doc_id"], r["quality"]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert set(got) == set(texts)
    crc = {d: zlib.crc32(str(d).encode()) for d in texts}
    stats = {}
    with np.errstate(over="ignore"):
        for d, t in texts.items():
            h, _ = word_hashes([t], lower=False)
            stats[d] = quality.text_statistics(t, h)
    train = [(d, q) for d, q in labels if d in texts and crc[d] % 5]
    x = np.array([stats[d] for d, _ in train])
    model = quality._blank(11, x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6))
    wave = lambda rows: np.hstack([np.cos(np.clip((rows - model.mean) / model.scale, -8, 8) @ model.waves + model.phase) * np.sqrt(2 / quality.FEATURES), np.ones((len(rows), 1))])
    fold = np.array([crc[d] // 5 % quality.FOLDS for d, _ in train])
    y = np.array([q for _, q in train], dtype=float)
    z = wave(x[fold != 0])
    weights = np.linalg.solve(z.T @ z + quality.RIDGE * np.eye(z.shape[1]), z.T @ y[fold != 0])
    raw = wave(x[fold == 0]) @ weights
    cell = np.clip(((raw + 0.5) / 2 * quality.GRID).astype(int), 0, quality.GRID - 1)
    cells = np.unique(cell)
    n = np.array([(cell == c).sum() for c in cells], dtype=float)
    ones = np.array([y[fold == 0][cell == c].sum() for c in cells])
    # isotonic by its definition: the largest over beginnings of the smallest over ends of a range's mean
    mean = lambda a, b: ones[a:b + 1].sum() / n[a:b + 1].sum()
    levels = [max(min(mean(a, b) for b in range(i, len(cells))) for a in range(i + 1)) for i in range(len(cells))]
    every = sorted(texts)
    score = np.clip(np.interp(wave(np.array([stats[d] for d in every])) @ weights, (cells + 0.5) / quality.GRID * 2 - 0.5, levels), 0, 1)
    for d, s in zip(every, score.tolist(), strict=True):
        assert abs(got[d]["score"] - s) < 1e-6 and got[d]["held_out"] == (crc[d] % 5 == 0)
        assert got[d]["predicted"] == int(got[d]["score"] >= 0.3)
