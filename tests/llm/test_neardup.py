"""op5: components of 5-word shingle sets against brute force, and the odd cases."""

import random
from collections import Counter, defaultdict

import corpus_pipeline
from runway.llm.neardup import COORDS, MATCHES, _postings, near_duplicates


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(pairs):
    sets = [shingles(t) for _, t in pairs]
    parent = list(range(len(pairs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_id = {}
    for i, (doc, _) in enumerate(pairs):
        if doc is None or not sets[i]:
            continue
        if doc in by_id:
            parent[find(i)] = find(by_id[doc])
        by_id.setdefault(doc, i)
    for i in range(len(pairs)):
        for j in range(i):
            if pairs[i][0] is None or pairs[j][0] is None or not sets[i] or not sets[j]:
                continue
            common = len(sets[i] & sets[j])
            if 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(pairs)):
        members[find(i)].append(i)
    out = []
    for i, (doc, _) in enumerate(pairs):
        if doc is None:
            out.append((None, len(sets[i]), None, True))
        else:
            root = min(pairs[j][0] for j in members[find(i)]) if sets[i] else doc
            out.append((doc, len(sets[i]), root, root == doc))
    return out


def run(df):
    rows = near_duplicates(df).select("doc_id", "n_shingles", "component_id", "kept").collect()
    return sorted((tuple(r) for r in rows), key=str)


def edited(text, places):
    w = text.split()
    for p in places:
        w[p] = "changed" + str(p)
    return " ".join(w)


def test_families_against_brute_force(make_docs, lorem):
    pairs, doc = [], 500
    for family in range(6):
        base = lorem(120)
        for member in range(9):
            doc -= 3
            pairs.append((doc, edited(base, [(member * 13 + k * 17) % 120 for k in range(member % 5)])))
    pairs += [(1000 + i, lorem(60)) for i in range(20)]
    assert run(make_docs(pairs)) == sorted(brute(pairs), key=str)


def test_chain_is_one_component(make_docs, lorem):
    base, pairs = lorem(150), []
    for i in range(8):  # each step changes two more words, the ends are far apart
        pairs.append((i + 1, edited(base, range(0, 16 * i, 8))))
    assert run(make_docs(pairs)) == sorted(brute(pairs), key=str)


def test_odd_rows(make_docs, lorem):
    long = lorem(30_000)
    text = lorem(30)
    pairs = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE  two"), (6, "one"), (7, text), (8, text.upper()),
             (None, text), (9, text), (9, text), (10, long), (11, long + " end"), (12, "é ö ü ñ ç"), (13, "É Ö Ü Ñ Ç"), (14, "x " * 400), (15, "x " * 700)]
    assert run(make_docs(pairs)) == sorted(brute(pairs), key=str)


def test_empty_table(make_docs):
    assert run(make_docs([])) == []


def test_large_group_of_near_copies(make_docs, lorem):
    base = lorem(100)
    pairs = [(i, edited(base, [(i * 7) % 100, (i * 31) % 100, (i * 43) % 100][: i % 4])) for i in range(1, 160)]
    assert run(make_docs(pairs, clashing=False)) == sorted(brute(pairs), key=str)


def test_an_id_with_several_texts(spark, make_docs, lorem):
    """The texts of one id are one document: links through any of them connect; the pipeline drops the very rows that are not kept."""
    x, y, z, v, w = (lorem(60) for _ in range(5))
    pairs = [(3, x), (5, x), (5, y), (5, ""), (5, None), (7, y + " end"), (8, z), (9, z), (9, v), (10, v), (11, w), (11, lorem(50)), (12, w), (None, x), (20, lorem(60))]
    want = brute(pairs)
    assert run(make_docs(pairs)) == sorted(want, key=str)
    out = corpus_pipeline.drop_near_duplicates(spark, make_docs(pairs), "")
    assert sorted((tuple(r) for r in out.select("doc_id", "text").collect()), key=str) == sorted(
        (p for p, r in zip(pairs, want, strict=True) if r[3]), key=str)


def test_postings_are_the_rare_shared_values_and_join_nothing(spark):
    """Shuffled and sorted once by value and once by text; the values of one text alone take the first places."""
    rng = random.Random(3)
    rows = [(doc, [rng.choice([-2**31, -1, 7, 2**31 - 1, 100 + doc][: 2 + i % 4]) for i in range(COORDS)]) for doc in range(-3, 25)]
    got = _postings(spark.createDataFrame(rows, "doc long, sig array<int>"))
    df = Counter((i, v) for _, sig in rows for i, v in enumerate(sig))
    want = []
    for doc, sig in rows:
        first = sorted((df[i, v], (i << 32) + v + 2**31) for i, v in enumerate(sig))[: COORDS - MATCHES + 1]
        want += [(doc, token) for n, token in first if n > 1]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan and "collect_list" not in plan
    assert sorted(map(tuple, got.collect())) == sorted(want) and want
