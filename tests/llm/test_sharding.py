"""op10: the law of the keys, slots without gaps, weights, odd rows; no Python in the plan."""

import zlib

from pyspark.sql import functions as F

from runway.llm import sharding


def test_law_slots_and_sizes(make_docs, lorem):
    pairs = [(i, lorem(i % 9)) for i in range(600)] + [(700, None), (701, ""), (702, "é" * 9000), (None, "a"), (None, "b"), (None, "a"), (5, "again")]
    pairs += [(800, "equal")] * 40
    rows = sharding.assign_shards(make_docs(pairs), 7).collect()
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows), key=str) == sorted(
        ((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in pairs), key=str)
    for s in range(7):
        mine = [r["slot"] for r in rows if r["shard"] == s]
        assert sorted(mine) == list(range(len(mine)))
    by_id = {}
    for r in rows:  # the id decides
        assert by_id.setdefault(r["doc_id"], (r["shard"], r["grown_shard"])) == (r["shard"], r["grown_shard"])
        assert r["grown_shard"] in (r["shard"], 7)
    grown = {r["doc_id"]: r["shard"] for r in sharding.assign_shards(make_docs(pairs), 8).collect()}
    assert all(grown[d] == g for d, (_, g) in by_id.items())


def test_same_on_every_run(make_docs, lorem):
    df = make_docs([(i, lorem(5)) for i in range(200)])
    a, b = (sorted(map(tuple, sharding.assign_shards(x, 5).collect())) for x in (df, df.repartition(9)))
    assert a == b


def test_weights(spark):
    shares = dict(spark.range(30_000).select(sharding.shard_of(F.col("id"), [1, 2, 5]).alias("s")).groupBy("s").count().collect())
    assert all(abs(shares[s] / 30_000 - w / 8) < 0.02 for s, w in enumerate((1, 2, 5)))


def test_one_shard_and_empty_table(make_docs):
    assert [r["shard"] for r in sharding.assign_shards(make_docs([(1, "a")]), 1).collect()] == [0]
    assert sharding.assign_shards(make_docs([]), 4).count() == 0


def test_native_plan(make_docs, lorem):
    plan = sharding.assign_shards(make_docs([(1, "a")]), 40)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_winning_shards_recomputed_outside_spark(make_docs):
    """The highest score of each key over all shards, with the hashes of the xxhash library."""
    import math
    import struct

    import xxhash

    def winner(doc, weights):
        def score(shard):
            first = xxhash.xxh64(struct.pack("<q", doc), seed=42).intdigest()
            h = xxhash.xxh64(struct.pack("<i", shard), seed=first).intdigest() >> 12
            return weights[shard] / -math.log((h + 0.5) / (1 << 52))
        return max(range(len(weights)), key=lambda s: (score(s), -s))

    docs = make_docs([(i * 7919 - 1000, "x") for i in range(400)])
    for weights in ([1.0] * 40, [1.0, 3.0, 0.5]):
        for r in sharding.assign_shards(docs, weights).collect():
            assert r["shard"] == winner(r["doc_id"], weights) and r["grown_shard"] == winner(r["doc_id"], [*weights, 1.0])
