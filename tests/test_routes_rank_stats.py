import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fixtures import FLIGHT_SCHEMA, leg
from runway.operators import features, pagerank, routes, stats
from runway.params import JobParams
from runway.session import fixed_partitions


def _brute_two_hop(edges, vertices, mid, end, min_delay=500.0, gap=10000):
    out = defaultdict(int)
    for a_src, a_dst, a_delay, a_trip in edges:
        for b_src, b_dst, b_delay, b_trip in edges:
            if a_dst != b_src or a_dst != mid or b_dst != end:
                continue
            if a_src not in vertices or mid not in vertices or end not in vertices:
                continue
            big = (a_delay is not None and a_delay > min_delay) or (b_delay is not None and b_delay > min_delay)
            if a_trip is None or b_trip is None or not big:
                continue
            if b_trip > a_trip and b_trip > a_trip + gap:
                out[a_src] += 1
    return dict(out)


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_two_hop_counts_equal_brute_force(spark, buckets):
    rnd = random.Random(11)
    names = ["A", "B", "C", "D", "E"]
    edges = []
    for _ in range(400):
        s, d = rnd.choice(names), rnd.choice(names)
        delay = rnd.choice([None, 0.0, -5.0, 499.0, 500.0, 501.0, 900.0])
        trip = rnd.choice([None] + list(range(0, 40000, 997)))
        edges.append((s, d, delay, trip))
    edges += [("A", "B", 600.0, 100), ("B", "C", 0.0, 10100), ("B", "C", 0.0, 10101),
              ("A", "B", 600.0, 100), ("C", "B", 0.0, 5), ("B", "C", 700.0, 20000)]
    vertices = {"A", "B", "C", "D"}                      # E is not a vertex
    e = spark.createDataFrame(edges, "src string, dst string, delay double, tripId long")
    v = spark.createDataFrame([(x,) for x in sorted(vertices)], "id string")
    got = {r["a"]: r["n_paths"] for r in routes.two_hop_counts(e, v, "B", "C", buckets=buckets).collect()}
    assert got == _brute_two_hop(edges, vertices, "B", "C")


def test_two_hop_missing_vertex_gives_nothing(spark):
    e = spark.createDataFrame([("A", "B", 900.0, 1), ("B", "C", 900.0, 20000)],
                              "src string, dst string, delay double, tripId long")
    v = spark.createDataFrame([("A",), ("B",)], "id string")
    assert routes.two_hop_counts(e, v, "B", "C").count() == 0


def _brute_pagerank(vertices, edges, reset=0.15, iters=5):
    vs = sorted(vertices)
    kept = [(s, d) for s, d in edges if s in vertices and d in vertices]
    deg = defaultdict(int)
    for s, _ in kept:
        deg[s] += 1
    r = {v: 1.0 for v in vs}
    for _ in range(iters):
        inc = defaultdict(float)
        for s, d in kept:
            inc[d] += r[s] / deg[s]
        r = {v: reset + (1 - reset) * inc[v] for v in vs}
    total = sum(r.values())
    return {v: x * len(vs) / total for v, x in r.items()}


def test_pagerank_matches_definition(spark):
    edges = [("a", "b"), ("a", "b"), ("b", "c"), ("c", "a"), ("a", "d"), ("d", "c"), ("c", "z")]
    vertices = {"a", "b", "c", "d", "e"}                 # e: no edges; d -> c; z not a vertex
    v = spark.createDataFrame([(x,) for x in sorted(vertices)], "id string")
    e = spark.createDataFrame(edges, "src string, dst string")
    got = {r["id"]: r["pagerank"] for r in pagerank.pagerank(v, e).collect()}
    want = _brute_pagerank(vertices, edges)
    assert set(got) == set(want)
    for k in want:
        assert abs(got[k] - want[k]) < 1e-9
    assert abs(sum(got.values()) - len(vertices)) < 1e-9
    top = pagerank.top_ranked(pagerank.pagerank(v, e), 2).collect()
    assert [r["id"] for r in top] == sorted(want, key=lambda k: (-want[k], k))[:2]


def test_delay_counts_and_means(spark):
    e = spark.createDataFrame([("AA", 5.0, "JFK", "BOS"), ("AA", 0.0, "JFK", "BOS"),
                               ("BB", 7.0, "JFK", "SFO"), ("BB", 3.0, "JFK", "SFO"),
                               ("BB", 9.0, "SFO", "JFK"), ("CC", None, "JFK", "BOS")],
                              "operator string, delay double, src string, dst string")
    got = [tuple(r) for r in routes.delay_counts(e, "JFK", ["operator"]).collect()]
    assert got == [("BB", 2), ("AA", 1)]
    got = [tuple(r) for r in routes.delay_means(e, "JFK", ["dst"]).collect()]
    assert got == [("SFO", 5.0), ("BOS", 5.0)] or got == [("BOS", 5.0), ("SFO", 5.0)]
    got = [tuple(r) for r in routes.delay_counts(e, "JFK", ["operator"], outbound=False).collect()]
    assert got == [("BB", 1)]


def test_pearson_pairwise_and_constant(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, None, 5.0), (4.0, 8.3, 5.0)],
                               "x double, y double, k double")
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in stats.pearson_pairs(df).collect()}
    import numpy as np
    want = np.corrcoef([1.0, 2.0, 4.0], [2.0, 4.1, 8.3])[0, 1]
    assert abs(got[("x", "y")] - want) < 1e-12 and got[("x", "y")] == got[("y", "x")]
    assert got[("x", "k")] is None and got[("k", "k")] is None
    assert abs(got[("x", "x")] - 1.0) < 1e-12
    assert len(got) == 9
    empty = spark.createDataFrame([(1.0, None), (2.0, None)], "x double, n double")
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in stats.pearson_pairs(empty).collect()}
    assert got[("x", "n")] is None and got[("n", "n")] is None and len(got) == 4


def test_carrier_statistics(spark):
    df = spark.createDataFrame([("AA", 10.0), ("AA", None), ("AA", -4.0), ("BB", 1.0), (None, 99.0)],
                               "OP_UNIQUE_CARRIER string, DEP_DELAY_NEW double")
    s = [tuple(r) for r in stats.carrier_stats(df).collect()]
    assert s == [("BB", 1.0, 1.0, 1, 1.0), ("AA", -4.0, 10.0, 2, 3.0)]
    share = {r["carrier"]: r for r in stats.carrier_share(df).collect()}
    assert abs(sum(r["share_pct"] for r in share.values()) - 100.0) < 1e-9
    assert share["AA"]["share_label"] == 67.0
    df2 = spark.createDataFrame([("AA", -10.0), ("BB", 2.5)], "OP_UNIQUE_CARRIER string, DEP_DELAY_NEW double")
    clip = {r["carrier"]: (r["mean_clipped"], r["mean_label"]) for r in stats.carrier_mean_clipped(df2).collect()}
    assert clip == {"AA": (0.0, 0.0), "BB": (2.5, 2.0)}           # half to even, as the label format
    hist = sorted((tuple(r) for r in stats.delay_histogram(df, width=5.0).collect()), key=str)
    assert hist == sorted([("AA", -5.0, 1), ("AA", 10.0, 1), ("BB", 0.0, 1), (None, 95.0, 1)], key=str)


def test_motif_ranges_are_even_and_the_driver_gets_no_borders(spark, monkeypatch):
    e = spark.range(40_000).select(F.lit("A").alias("src"), F.lit("B").alias("dst"), F.lit(600.0).alias("delay"),
                                   (F.col("id") * F.col("id") % 1_000_003).alias("tripId"))
    e = e.unionByName(e.limit(1).select(F.lit("B").alias("src"), F.lit("C").alias("dst"), "delay", F.lit(999_000).cast("long").alias("tripId")))
    v = spark.createDataFrame([("A",), ("B",), ("C",)], "id string")
    seen, keep = [], routes.materialise
    monkeypatch.setattr(routes, "materialise", lambda s, x, name: seen.append(keep(s, x, name)) or seen[-1])
    got = {r["a"]: r["n_paths"] for r in routes.two_hop_counts(e, v, "B", "C", buckets=50).collect()}
    assert got == {"A": e.where("src = 'A' and tripId + 10000 < 999000").count()}
    sizes = [r["count"] for r in seen[0].groupBy("_b").count().collect()]
    assert len(sizes) > 40 and max(sizes) <= 3 * sum(sizes) / 50


def test_pagerank_round_shuffles_contributions_only(spark):
    edges = spark.range(500).select((F.col("id") % 23).cast("string").alias("src"), (F.col("id") % 37).cast("string").alias("dst"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with fixed_partitions(spark):
        ids = edges.select(F.col("src").alias("id")).distinct().repartition(n, "id").checkpoint()
        weights = pagerank.weighted_edges(ids, edges).repartition(n, "src").checkpoint()
        ranks = ids.select("id", F.lit(1.0).alias("pagerank"))
        for _ in range(2):                       # the second round reads checkpointed ranks
            turn = pagerank.one_round(ids, weights, ranks, 0.15)
            plan = turn._jdf.queryExecution().executedPlan().toString()
            exchanges = [line for line in plan.splitlines() if "Exchange" in line]
            assert len(exchanges) == 1 and "hashpartitioning(dst" in exchanges[0], plan
            ranks = turn.checkpoint()
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_pearson_large_offset_and_pairwise_nulls(spark):
    import numpy as np
    rng = np.random.default_rng(4)
    a = rng.normal(size=4000)
    cols = {"big": 1e9 + a, "mixed": 3e-7 * (a + rng.normal(size=4000)), "huge": 1e200 * (rng.normal(size=4000) - a), "late": a ** 2 - 5e6}
    gaps = {c: rng.random(4000) < 0.3 for c in cols}
    names = list(cols)
    data = [tuple(None if gaps[c][i] else float(cols[c][i]) for c in names) + (float("nan") if i % 3 else 1.5,) for i in range(4000)]
    df = spark.createDataFrame(data, ", ".join(f"{c} double" for c in [*names, "holes"])).repartition(7)
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in stats.pearson_pairs(df).collect()}
    for x in names:
        for y in names:
            both = ~gaps[x] & ~gaps[y]
            scale = 1e200 if "huge" in (x, y) else 1.0
            want = np.corrcoef(cols[x][both] / (scale if x == "huge" else 1.0), cols[y][both] / (scale if y == "huge" else 1.0))[0, 1]
            assert abs(got[(x, y)] - want) < 1e-6, (x, y)
    assert got[("holes", "big")] is None                      # NaN is missing, the rest is constant


def test_pearson_pairs_nearly_constant_on_common_rows_are_exact(spark):
    df = spark.createDataFrame([(float(i), None if i < 5 else 1e6, 2.0 * i) for i in range(8)] + [(1e12, 3.0, None), (9.0, 1e6 + 1, 1.0)], "x double, y double, z double")
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in stats.pearson_pairs(df).collect()}
    import numpy as np
    want = np.corrcoef([5, 6, 7, 9], [1e6, 1e6, 1e6, 1e6 + 1])[0, 1]
    assert got[("y", "z")] is not None and got[("x", "x")] == pytest.approx(1.0)
    pair = df.where("x < 100 and y is not null").select("x", "y")
    assert {(r["col_a"], r["col_b"]): r["corr"] for r in stats.pearson_pairs(pair).collect()}[("x", "y")] == pytest.approx(want)
    inf = spark.createDataFrame([(1.0, 1.0), (2.0, float("inf")), (3.0, 5.0)], "x double, y double")
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in stats.pearson_pairs(inf).collect()}
    assert got[("x", "y")] is None and got[("y", "y")] is None and got[("x", "x")] == pytest.approx(1.0)


def test_sketches_keep_to_their_rank_error_and_merge(spark):
    df = spark.range(60_000).select((F.col("id") % 3).cast("string").alias("OP_UNIQUE_CARRIER"), (F.col("id") % 5).alias("day"),
                                    F.when(F.col("id") % 11 > 0, F.sqrt(F.col("id") * 7919 % 60_000)).alias("DEP_DELAY_NEW"))
    whole = stats.delay_sketches(df)
    parts = stats.merge_sketches(stats.delay_sketches(df, ("OP_UNIQUE_CARRIER", "day")), ("OP_UNIQUE_CARRIER",))
    for sketches in (whole, parts):
        quantiles = stats.sketch_quantiles(sketches, (0.01, 0.5, 0.99))
        errors = stats.sketch_rank_errors(df, quantiles, (0.01, 0.5, 0.99)).collect()
        assert len(errors) == 9 and max(r["rank_error"] for r in errors) <= stats.SKETCH_ERROR
        assert sum(r["n"] for r in quantiles.collect()) == df.where("DEP_DELAY_NEW is not null").count()


def test_quantiles_are_exact(spark):
    df = spark.createDataFrame([("A", float(v)) for v in (0, 0, 1, 2, 10)] + [("B", None), ("C", 4.0)], "c string, d double")
    got = {r["carrier"]: tuple(r)[1:] for r in stats.delay_quantiles(df, carrier="c", delay="d").collect()}
    assert got == {"A": (0.0, 1.0, 2.0), "C": (4.0, 4.0, 4.0)}


def test_numbered_distinct(spark):
    df = spark.createDataFrame([(v,) for v in ("b", "a", None, "c", "a")], "x string")
    assert sorted(map(tuple, stats.numbered_distinct(df, "x").collect())) == [("a", 1), ("b", 2), ("c", 3)]


def test_exploration_counts_prepared_legs_only(spark):
    legs = spark.createDataFrame([
        leg("L1", "BOS", "JFK", "2018-01-02", 600, 700), leg("L2", "BOS", "JFK", "2018-01-02", 800, 900, diverted=1.0),
        leg("L3", "BOS", "JFK", "2018-01-02", 800, 900, cancelled=1.0), leg("L4", "BOS", "JFK", "2018-02-02", 800, 900)], FLIGHT_SCHEMA)
    params = JobParams(airport="JFK", train_start="2018-01-01", train_end="2018-01-10")
    prepared = features.prepare_legs(legs, params, prior=False, cut_lineage=False)
    edges = routes.route_edges(prepared, delay="ARR_DELAY_NEW", attrs={"operator": "OP_UNIQUE_CARRIER"}, dest_side=False)
    assert [tuple(r) for r in routes.delay_counts(edges, "JFK", ["operator"], outbound=False).collect()] == [("AA", 1)]
