"""Benchmark decontamination with SimHash windows and multi-index Hamming blocks.

Every benchmark item has a fingerprint: the SimHash of its 5-word shingles
(lower-cased words, one vote per occurrence).  Every document is read as windows
of as many words as an item has.  A window's fingerprint is looked up in
``BLOCKS`` tables, one per block of fingerprint bits, that list the items whose
block differs in at most RADIUS // BLOCKS bits; any fingerprint within RADIUS
agrees that well in one block, so the lookup misses none within the radius.
Candidates are verified by their weighted shingle similarity, sum of minimum
counts over sum of maximum counts, at ``SIMILARITY`` or more.

Windows in which fewer than SIMILARITY of the shingles occur in any benchmark
item cannot reach the threshold and get no fingerprint; the test is one running
sum.  At similarity 0.75 a fingerprint bit differs with probability 0.172, so
more than 24 of 64 differ in about 3 of 100,000 windows.

Documents are never shuffled.  Benchmark items reach the driver and the tasks in slices
of about ``SLICE_BYTES`` of text, one at a time: a larger benchmark takes as many passes
over the documents, each written before the next one starts.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runway.llm.wordhash import gram_hashes, shingle_list, word_hashes
from runway.sources.sinks import materialise

WORDS = 5
SIMILARITY = 0.75
BITS, BLOCKS, RADIUS = 64, 8, 24
SLICE_BYTES = 16 << 20

HIT = "array<struct<item_id:bigint,start_word:bigint,n_words:bigint,similarity:double,distance:int>>"

_POP = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)
_NEAR = _POP[np.arange(256)[:, None] ^ np.arange(256)[None, :]] <= RADIUS // BLOCKS


def _votes(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each shingle hash."""
    return (np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) << 1) - 1


def fingerprint(shingles: np.ndarray) -> np.ndarray:
    """The 8 bytes of the SimHash of a shingle sequence."""
    return np.packbits(_votes(shingles).sum(axis=0) > 0)


class ItemIndex:
    """Fingerprints, block tables and shingle counts of a slice of benchmark items."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        with np.errstate(over="ignore"):
            h, at = word_hashes([t for _, t in items], lower=True)
            self.sizes: dict[int, list] = defaultdict(list)   # number of shingles -> items
            self.short: dict[int, dict] = defaultdict(lambda: defaultdict(list))  # 1-4 words -> hash -> items
            every = [np.empty(0, np.uint64)]
            for i, (item, _) in enumerate(items):
                words = h[at[i]:at[i + 1]]
                s = shingle_list(words, WORDS)
                if len(words) >= WORDS:
                    self.sizes[len(s)].append((item, Counter(s.tolist()), fingerprint(s), np.unique(s)))
                    every.append(s)
                elif len(words):
                    self.short[len(words)][int(s[0])].append(item)
        self.sizes, self.short = dict(self.sizes), {n: dict(v) for n, v in self.short.items()}
        self.vocabulary = np.unique(np.concatenate(every))
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[self.vocabulary & np.uint64((1 << 20) - 1)] = True
        # per size: prints [items, 8], tables[block][value] = which items have a near block
        self.prints = {m: np.array([x[2] for x in v]) for m, v in self.sizes.items()}
        self.tables = {m: [_NEAR[:, p[:, b]] for b in range(BLOCKS)] for m, p in self.prints.items()}

    def known(self, shingles: np.ndarray) -> np.ndarray:
        """Which shingles occur in the slice's items."""
        out = self.maybe[shingles & np.uint64((1 << 20) - 1)]
        at = np.flatnonzero(out)
        if len(at):
            found = np.searchsorted(self.vocabulary, shingles[at])
            out[at] = self.vocabulary[np.minimum(found, len(self.vocabulary) - 1)] == shingles[at]
        return out

    def hits(self, words: np.ndarray, shingles: np.ndarray, known: np.ndarray) -> list[tuple]:
        """(item, start, words, similarity, distance) of the best window for each item found in one document."""
        best: dict[int, tuple] = {}
        total = np.concatenate([[0], np.cumsum(known)])
        for m, items in self.sizes.items():
            size = min(m, len(shingles))  # a shorter document is one window
            starts = np.flatnonzero(total[size:] - total[:-size or None] >= SIMILARITY * m) if size else []
            for at in range(0, len(starts), 4096):
                self._match(shingles, np.asarray(starts[at:at + 4096]), size, m, items, best)
        for n, by_hash in self.short.items():
            for start in range(len(words) - n + 1):
                for item in by_hash.get(int(shingle_list(words[start:start + n], WORDS)[0]), ()):
                    best.setdefault(item, (1.0, -start, n, 0))
        return [(item, -start, n, s, d) for item, (s, start, n, d) in sorted(best.items())]

    def _match(self, shingles: np.ndarray, starts: np.ndarray, size: int, m: int, items: list, best: dict) -> None:
        lo, hi = int(starts[0]), int(starts[-1]) + size
        sums = np.zeros((hi - lo + 1, BITS), dtype=np.int32)
        np.cumsum(_votes(shingles[lo:hi]), axis=0, out=sums[1:])
        prints = np.packbits(sums[starts - lo + size] - sums[starts - lo] > 0, axis=1)
        near = self.tables[m][0][prints[:, 0]].copy()
        for b in range(1, BLOCKS):
            near |= self.tables[m][b][prints[:, b]]
        windows, which = np.nonzero(near)
        distance = _POP[prints[windows] ^ self.prints[m][which]].sum(axis=1)
        close = distance <= RADIUS
        windows, which, distance = windows[close], which[close], distance[close]
        for i in np.unique(which):
            item, counts, _, members = items[i]
            total = np.concatenate([[0], np.cumsum(np.isin(shingles[lo:hi], members))])
            mine = np.flatnonzero(which == i)
            begin = starts[windows[mine]]
            shared = total[begin - lo + size] - total[begin - lo]   # no fewer than the common count
            for j in np.lexsort((begin, -shared)):
                # the similarity is at most that of `shared` common shingles; later windows share no more
                most = shared[j] / max(1, size + m - shared[j])
                if most < SIMILARITY or (item in best and most < best[item][0]):
                    break
                held = Counter(shingles[begin[j]:begin[j] + size].tolist())
                common = sum(min(v, counts[k]) for k, v in held.items() if k in counts)
                similarity = common / (size + m - common)
                if similarity >= SIMILARITY:
                    found = (similarity, -int(begin[j]), size + WORDS - 1, int(distance[mine[j]]))
                    if item not in best or found[:2] > best[item][:2]:
                        best[item] = found


def _finder(index: ItemIndex):
    @F.pandas_udf(HIT)
    def find(texts: pd.Series) -> pd.Series:
        out = []
        with np.errstate(over="ignore"):
            h, at = word_hashes([None if t is None else t for t in texts], lower=True)
            runs = gram_hashes(h, WORDS)  # runs over two documents are not looked at below
            known = index.known(runs)
            for i in range(len(texts)):
                lo, hi = at[i], max(at[i], at[i + 1] - WORDS + 1)
                if known[lo:hi].any() or (index.short and at[i + 1] > lo):
                    out.append(index.hits(h[lo:at[i + 1]], runs[lo:hi], known[lo:hi]))
                else:
                    out.append([])
        return pd.Series(out)
    return find.asNondeterministic()       # evaluated once a row, also where a plan filters on its result first


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", out_col: str = "benchmark_hits") -> DataFrame:
    """``docs`` with ``out_col``: for each benchmark item found in the text, its best window.

    Ties go to the earliest window.  NULL and empty texts have no hits; benchmark
    rows with a NULL id, or NULL or blank text, are ignored; repeated items count
    once per id.  Items of one to four words match only as exact word runs.  All
    columns of ``docs`` are kept, whatever their names (an existing ``out_col``
    is replaced).
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text")).where(
        "item_id is not null and text is not null").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = -(-total // SLICE_BYTES)
    out = docs.withColumn(out_col, F.array().cast(HIT))
    for s in range(slices):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == s).orderBy("item_id", "text").collect()
        found = _finder(ItemIndex([(r["item_id"], r["text"]) for r in rows]))(F.col(text_col))
        out = out.withColumn(out_col, F.concat(F.col(out_col), found))
        if s + 1 < slices:      # a pass of its own, so that one slice's index is held at a time
            out = materialise(docs.sparkSession, out, "benchmark_pass")
    return out


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, start_word, n_words, similarity, distance."""
    rows = benchmark_hits(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), benchmark)
    return rows.select("doc_id", F.explode("benchmark_hits").alias("h")).select("doc_id", "h.*")
