"""Source divergence against brute force with Python's integers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import types as T

from runway.llm import divergence
from runway.llm.divergence import audit, term_counts

SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("text", "lang", "source", "term", "total", "bucket", "rank")])
TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def table(spark, rows):
    return spark.createDataFrame([(t, lang, s, "x", "x", "x", "x") for t, lang, s in rows], SCHEMA)


def brute(rows, top=200):
    df, count, groups = Counter(), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = terms_of(text)
        df.update((lang, t) for t in set(found))
        count[(lang, source)].update(found)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (of, t), n in df.items() if of == lang and n >= 3]
        sources = sorted(s for of, s in groups if of == lang)

        def p(counts):
            total = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 1) // total for t in kept}
        share = {s: p(count[(lang, s)]) for s in sources}
        whole = p(sum((count[(lang, s)] for s in sources), Counter()))
        for s in sources:
            pair = [(o, sum((share[s][t] - share[o][t]) ** 2 // share[o][t] for t in kept)) for o in sources if o != s]
            term = [(t, (share[s][t] - whole[t]) ** 2 // whole[t]) for t in kept if count[(lang, s)][t] and share[s][t] > whole[t]]
            for part, found in (("pair", pair), ("term", term)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, r) for r, (i, v) in enumerate(found, 1) if part == "pair" or r <= top]
    return sorted(out)


def corpus(seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdéßñ漢字Z") for _ in range(n)) for n in (1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 13, 15, 16, 17, 20, 31, 33, 60, 100, 300) for _ in range(6)]
    rows = [(" ".join(rng.choice(words[i % 7:]) + rng.choice(["", "1", "-", "_x", "'s"]) for _ in range(rng.randint(0, 60))), rng.choice("ab"), rng.choice(["s1", "s2", "s3"]))
            for i in range(120)]
    rows += [(None, "a", "s4"), ("", "c", "s1"), ("1 2 3", "c", None), ("alone here", None, None), ("w" * 100_000, "a", "s1")] + [("Same same", "d", "s1")] * 4
    return rows


def test_against_brute_force(spark, monkeypatch):
    rows = corpus()
    want = brute(rows)
    for run, bucket in ((divergence.RUN_BYTES, divergence.BUCKET_ROWS), (2_000, 50)):
        monkeypatch.setattr(divergence, "RUN_BYTES", run)
        monkeypatch.setattr(divergence, "BUCKET_ROWS", bucket)
        got = audit(table(spark, rows))
        assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert sorted(map(tuple, got.collect())) == want


def test_term_counts(spark):
    rows = corpus(4)
    want, with_it = Counter(), Counter()
    for text, lang, source in rows:
        for t, n in Counter(terms_of(text)).items():
            want[(lang or "", source or "", t)] += n
            with_it[(lang or "", source or "", t)] += 1
    got = {(r["lang"], r["source"], r["term"]): (r["n"], r["docs"]) for r in term_counts(table(spark, rows)).collect()}
    assert got == {k: (n, with_it[k]) for k, n in want.items()}


def test_top_and_empty_table(spark):
    rows = corpus()
    got = audit(table(spark, rows), top=2)
    assert sorted(map(tuple, got.collect())) == brute(rows, top=2)
    assert audit(table(spark, rows).where("false")).count() == 0


def test_radix_order_is_stable_and_shares_are_exact():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 5, 4000).astype(np.uint64) << np.uint64(40), rng.integers(0, 1 << 63, 4000).astype(np.uint64) % np.uint64(7)
    assert (divergence.radix_order([b, a]) == np.lexsort((b, a))).all()
    n = np.array([0, 1, 12_345_678_901, 8_999_999_999_999_998])
    total = np.array([1, 3, 99_999_999_999_999, 9_000_000_000_000_000])
    assert divergence.shares(n, total).tolist() == [1 + 1_000_000_000 * (int(x) + 1) // int(t) for x, t in zip(n, total)]
