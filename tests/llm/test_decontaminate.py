"""op2: windows against brute force; the Hamming blocks miss nothing within the radius."""

from collections import Counter

import numpy as np
from pyspark.sql import types as T

from runway.llm import decontaminate as D

ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])


def brute(text, item):
    w, v = (text or "").encode().lower().split(), item.encode().lower().split()
    a, b = ([tuple(x[i:i + 5]) for i in range(len(x) - 4)] for x in (w, v))
    if len(v) < 5:
        starts = [i for i in range(len(w) - len(v) + 1) if w[i:i + len(v)] == v] if v else []
        return (starts[0], 1.0) if starts else None
    best, size, counts = None, min(len(b), len(a)), Counter(b)
    for i in range(len(a) - size + 1) if a else ():
        c = Counter(a[i:i + size])
        common = sum(min(n, counts[k]) for k, n in c.items())
        s = common / (size + len(b) - common)
        if s >= 0.75 and (best is None or s > best[1]):
            best = (i, s)
    return best


def test_against_brute_force(spark, make_docs, lorem):
    items = [(i, lorem(12 + 3 * i)) for i in range(8)] + [(20, "only three words"), (21, None), (22, ""), (None, lorem(20)), (0, "")]
    docs = [(100 + i, f"{lorem(30)} {t} {lorem(30)}") for i, t in items if t and i is not None]
    docs += [(200 + i, f"{lorem(30)} {t.replace(' ', '  ', 2).upper()}") for i, t in items[:4]]
    near = items[7][1].split()
    near[0] = "other"
    docs += [(300, " ".join(near)), (301, items[5][1]), (302, " ".join(items[5][1].split()[:24])), (303, None), (304, ""), (305, lorem(5000)),
             (None, items[3][1]), (306, items[2][1]), (306, items[2][1])]
    found = D.benchmark_matches(make_docs(docs), spark.createDataFrame(items, ITEMS)).collect()
    got = sorted(((r["doc_id"], r["item_id"], r["start_word"], round(r["similarity"], 9)) for r in found), key=str)
    want = []
    for doc, text in docs:
        for item, t in items:
            if item is not None and t and (b := brute(text, t)):
                want.append((doc, item, b[0], round(b[1], 9)))
    assert got == sorted(want, key=str)


def test_slices_of_the_benchmark_give_the_same(spark, make_docs, lorem, monkeypatch):
    items = spark.createDataFrame([(i, lorem(20)) for i in range(10)], ITEMS)
    texts = [r["text"] for r in items.collect()]
    docs = make_docs([(i, f"{lorem(10)} {t}") for i, t in enumerate(texts)])
    one = sorted(map(tuple, D.benchmark_matches(docs, items).collect()))
    monkeypatch.setattr(D, "SLICE_BYTES", 300)
    assert sorted(map(tuple, D.benchmark_matches(docs, items).collect())) == one
    assert len(one) == 10


def test_blocks_miss_no_print_within_the_radius():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 256, (400, 8), dtype=np.uint8)
    for p in prints[:50]:
        flips = rng.permutation(64)[: rng.integers(0, D.RADIUS + 1)]
        bits = np.unpackbits(p)
        bits[flips] ^= 1
        q = np.packbits(bits)
        near = np.zeros(len(prints), dtype=bool)
        for b in range(D.BLOCKS):
            near |= D._NEAR[q[b], prints[:, b]]
        within = D._POP[prints ^ q].sum(axis=1) <= D.RADIUS
        assert (near | ~within).all()


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], ITEMS)
    assert D.benchmark_matches(make_docs([(1, "a b c d e f")]), none).count() == 0
    assert D.benchmark_matches(make_docs([]), spark.createDataFrame([(1, "a b c d e f")], ITEMS)).count() == 0
