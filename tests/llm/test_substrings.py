"""op3: repeated 13-word runs against brute force, over several block sizes."""

import time

import numpy as np
import pandas as pd
import pytest

from runway.llm import substrings


def brute(pairs):
    order = {}
    for doc, text in pairs:
        w = (text or "").encode().split()
        for i in range(len(w) - 12):
            if doc is not None:
                key = tuple(w[i:i + 13])
                order[key] = min(order.get(key, doc), doc)
    out = []
    for doc, text in pairs:
        w = (text or "").encode().split()
        gone = set()
        for i in range(len(w) - 12):
            least = order.get(tuple(w[i:i + 13]))
            if least is not None and (doc is None or least < doc):
                gone.update(range(i, i + 13))
        out.append((doc, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=str)


def run(df):
    return sorted((tuple(r) for r in substrings.repeats(df).select("doc_id", "n_words", "n_removed", "kept").collect()), key=str)


@pytest.fixture
def pairs(lorem):
    shared, other = lorem(60), lorem(14)
    out = [(i, f"{lorem(20 + i)} {shared if i % 3 else other} {lorem(15)}") for i in range(30, 0, -1)]
    out += [(40, shared), (41, shared), (42, " ".join(shared.split()[:13])), (43, " ".join(shared.split()[:12])), (44, "a " * 50), (45, "a " * 13),
            (46, None), (47, ""), (None, shared), (None, lorem(40)), (48, shared), (48, shared), (49, lorem(20_000) + " " + shared)]
    return out


@pytest.mark.parametrize("block_bytes", [1 << 30, 4000])
def test_against_brute_force(make_docs, pairs, monkeypatch, block_bytes):
    monkeypatch.setattr(substrings, "BLOCK_BYTES", block_bytes)
    assert run(make_docs(pairs)) == brute(pairs)


def test_spans_are_maximal(make_docs, lorem):
    a, b = lorem(20), lorem(30)
    rows = substrings.repeats(make_docs([(1, a), (2, b), (3, f"start {a} middle of it {b} end")])).where("doc_id = 3").first()
    assert [(s["start"], s["words"]) for s in rows["spans"]] == [(1, 20), (24, 30)]


def test_empty_table(make_docs):
    assert run(make_docs([])) == []


def test_rows_without_an_id_in_several_blocks(make_docs, lorem, monkeypatch):
    """Rows without an id make no other row's words repeats, in whichever late blocks they are."""
    monkeypatch.setattr(substrings, "BLOCK_BYTES", 2000)
    shared, held = lorem(30), lorem(20)
    pairs = [(i, lorem(40)) for i in range(20)] + [(20, held)]
    pairs += [(None, f"{lorem(10)} {shared} {lorem(5)} {held} {lorem(5)}") for _ in range(12)]
    got = run(make_docs(pairs))
    assert got == brute(pairs) and {r[2] for r in got if r[0] is None} == {20}


def hash_range(sizes, late):
    """A hash range's rows, shuffled: per block its own hashes and some of a common pool; the expected bits of both steps."""
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 60, 50, dtype=np.uint64)
    lists = [np.unique(np.concatenate([rng.integers(0, 1 << 60, n, dtype=np.uint64), rng.choice(pool, 3 * (n > 2))])) for n in sizes]
    flags = [rng.random(len(x)) < 0.1 for x in lists]
    holders = {}
    for block, x in enumerate(lists):
        for v in x.tolist():
            holders.setdefault(v, []).append(block)
    others = {b: [len(holders[v]) > 1 or bool(f) for v, f in zip(x.tolist(), flags[b], strict=True)] for b, x in enumerate(lists)}
    earlier = {b: [holders[v][0] < min(b, late) for v in x.tolist()] for b, x in enumerate(lists)}
    pdf = pd.DataFrame({"block": range(len(lists)), "bucket": 0, "hashes": [x.tobytes() for x in lists],
                        "flags": [np.packbits(f).tobytes() for f in flags]})
    return pdf.sample(frac=1, random_state=1), others, earlier


def bits(replies, expected):
    return {b: np.unpackbits(np.frombuffer(f, np.uint8), count=len(expected[b])).astype(bool).tolist()
            for b, f in zip(replies["block"], replies["flags"], strict=True)}


@pytest.mark.parametrize("late", [0, 7, 40])
def test_hash_range_against_brute_force(late):
    pdf, others, earlier = hash_range([1, 9, 30, 2, 8] * 8, late)
    assert bits(substrings._others_hold(pdf), others) == others
    assert bits(substrings._earlier_hold(pdf, late), earlier) == earlier


def test_hash_range_of_many_blocks_takes_time_in_proportion():
    """A range holds as many hashes at any input size, from ever more blocks: sorting them again for each block took 25 s here."""
    pdf, others, earlier = hash_range([300] * 1000, 900)
    began = time.process_time()
    held, before = substrings._others_hold(pdf), substrings._earlier_hold(pdf, 900)
    assert time.process_time() - began < 2
    assert bits(held, others) == others and bits(before, earlier) == earlier


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 8, 21])
def test_number_of_cuts_at_or_below(spark, n):
    cuts = [(i * i - 9) * (1 << 33) for i in range(n)]
    ids = [c + d for c in cuts for d in (-1, 0, 1)] + [-(1 << 62), 1 << 62]
    found = spark.createDataFrame([(i,) for i in ids], "id long")
    found = found.select("id", substrings._at_or_below(cuts, found["id"]).alias("n")).collect()
    assert [r["n"] for r in found] == [sum(c <= r["id"] for c in cuts) for r in found]


def test_neighbouring_documents_share_an_anchor_run(make_docs, lorem):
    """A document that ends in the words with which the next one begins: the anchor stands at two places."""
    shared = lorem(13)
    pairs = [(1, f"{lorem(30)} {shared}"), (2, f"{shared} {lorem(30)}"), (3, shared), (4, "b " * 40), (5, "b " * 13 + "c"), (6, lorem(12))]
    assert run(make_docs(pairs)) == brute(pairs)
