"""Importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from runway.llm import resample as R


def words(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(rows, target, percent=10, least=20, buckets=10_000):
    def counts(texts):
        out = np.zeros(buckets, dtype=int)
        for t in texts:
            for w in words(t):
                out[zlib.crc32(w.encode()) % buckets] += 1
        return out
    s, t = counts([x for _, x in rows]), counts(target)
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + buckets) / ((a + 1) * (t.sum() + buckets)))) for a, b in zip(s, t)]
    out = []
    for i, text in rows:
        w = words(text)
        weight = sum(gain[zlib.crc32(x.encode()) % buckets] for x in w)
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            out.append([i, len(w), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[3], r[0]))
    for n, r in enumerate(able[:percent * len(able) // 100], 1):
        r[4] = n
    return sorted(map(tuple, out))


@pytest.fixture(scope="module")
def tables(spark, make_docs, lorem):
    rng = random.Random(2)
    target = [lorem(30) for _ in range(5)] + [None, ""]
    rows = [(i, lorem(rng.randint(1, 60)) + " É1 " + "long" * rng.choice([0, 1, 30]) + rng.choice([" " + target[0], ""])) for i in range(400)]
    rows += [(500, None), (501, ""), (502, "!!"), (503, "Word " * 5000), (504, "x" * 100_000)]
    return make_docs(rows), spark.createDataFrame([(t, "clash") for t in target], "text string, weight string"), rows, target


def test_against_brute_force(tables):
    docs, target, rows, texts = tables
    got = R.resample(docs, target)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows, texts)


def test_a_wrong_sketch_only_widens_the_bracket(tables, monkeypatch):
    docs, target, rows, texts = tables
    for margins in ((0.0,), (-0.4, -0.2), ()):                 # brackets that miss the cutoff, or none at all
        monkeypatch.setattr(R, "MARGINS", margins)
        monkeypatch.setattr(R.bracket, "__defaults__", (margins,))
        assert sorted(map(tuple, R.resample(docs, target, percent=25, min_words=5).collect())) == brute(rows, texts, 25, 5)


def test_bracket_counts_outside(spark):
    rows = spark.createDataFrame([(int(x),) for x in np.random.default_rng(0).integers(0, 50, 3000)], "score long")
    scores = sorted((r["score"] for r in rows.collect()), reverse=True)
    lo, hi, above = R.bracket(rows, 0.1, 300)
    assert lo <= scores[299] <= hi and above == sum(s > hi for s in scores) < 300


def test_null_ids_repeats_ties_and_empty_tables(spark, make_docs, lorem):
    text = lorem(25)
    target = spark.createDataFrame([(text,)], "text string")
    rows = [(1, text)] * 30 + [(None, text)] * 10 + [(i, text) for i in range(2, 12)]
    got = R.resample(make_docs(rows), target, percent=50).collect()
    assert len(got) == 50
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 21))
    assert all(r["score"] is None and r["rank"] is None for r in got if r["doc_id"] is None)
    ranked = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [(-r["score"], r["doc_id"]) for r in ranked] == sorted((-r["score"], r["doc_id"]) for r in ranked)
    assert R.resample(make_docs(rows).where("false"), target).count() == 0
    assert sorted(map(tuple, R.resample(make_docs([(3, text)]), target.where("false")).collect())) == brute([(3, text)], [])


def test_crc32_of_spans():
    rng = random.Random(1)
    parts = [bytes(rng.randrange(256) for _ in range(n)) for n in (1, 2, 3, 4, 7, 8, 47, 48, 49, 50, 500) for _ in range(3)]
    buf = np.frombuffer(b"".join(parts), dtype=np.uint8)
    sizes = np.array([len(p) for p in parts])
    got = R.crc32_spans(buf, np.cumsum(sizes) - sizes, sizes)
    assert got.tolist() == [zlib.crc32(p) for p in parts]
