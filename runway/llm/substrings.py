"""Substring dedup: winnowed anchors as a filter, an exact join of window hashes.

A word run of ``LENGTH`` words (a window) that also starts in a document with a
smaller id is a repeat.  Seeds are winnowed anchors: in every window, the k-gram
of ``SEED`` words with the smallest hash among its LENGTH - SEED + 1 (the first,
on ties).  The choice depends on the window's words alone, so equal windows have
equal anchors at the same place, and a document has about one anchor per five words.

1. Seed.  The documents' distinct anchors meet by hash; an anchor that no
   other block of documents holds, and that its own block holds once, seeds nothing.
2. Windows.  The windows that chose a remaining anchor (at most LENGTH - SEED + 1 of
   them, one word apart) meet by hash.  A window repeats if an earlier document holds it.
3. Spans.  Repeated windows that overlap or touch one after the other form one span of
   at least LENGTH words.  Its windows may come from different documents.

No two documents are joined and no match is extended word by word: a word is in a
match of LENGTH words with an earlier document exactly if such a window covers it, so
the removed words are the same, and a passage that many documents share makes no pairs.

Blocks are ranges of document ids of about ``BLOCK_BYTES`` of text, so "held by
an earlier block" settles the order between blocks and only one block's documents
are compared one by one.  What travels is one hash per block and distinct anchor or
window, packed by hash range; the answer is one bit for each.  A passage that a
third of all documents share is one hash per block.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runway.llm.bpe import raw_text
from runway.llm.wordhash import gram_hashes, word_hashes

LENGTH = 13
SEED = 5
BLOCK_BYTES = 12 << 20
BUCKETS = 1 << 16          # most hash ranges
_REACH = LENGTH - SEED     # a window's anchor starts at most so many words after the window


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbours, by doubling."""
    have = 1
    while 2 * have <= width:
        values, have = np.minimum(values[:-have], values[have:]), 2 * have
    return np.minimum(values[:len(values) - width + have], values[width - have:])


def _alike(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order that sorts ``values``, the sorted places where another value begins, and each sorted place's value number."""
    order = np.argsort(values)
    ranked = values[order]
    new = np.ones(len(ranked), dtype=bool)
    np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
    return order, np.flatnonzero(new), np.cumsum(new, dtype=np.int32) - np.int32(1)


class Block:
    """The documents of a block in id order, with their words' hashes and anchors."""

    def __init__(self, pdf: pd.DataFrame) -> None:
        self.rows = pdf.sort_values("doc", na_position="last", kind="stable").reset_index(drop=True)
        self.words, self.at = word_hashes(self.rows["text"], lower=False)
        n_words = np.diff(self.at)
        doc_of_word = np.repeat(np.arange(len(n_words), dtype=np.int32), n_words)
        # windows lie within one document
        self.starts = np.flatnonzero(doc_of_word[:1 - LENGTH] == doc_of_word[LENGTH - 1:])
        self.doc = doc_of_word[self.starts]
        best = _smallest(gram_hashes(self.words, SEED), _REACH + 1)[self.starts] if len(self.starts) else np.empty(0, np.uint64)
        # neighbouring windows mostly share their anchor: one entry per run of windows of a document
        first = np.ones(len(best), dtype=bool)
        first[1:] = (best[1:] != best[:-1]) | (self.doc[1:] != self.doc[:-1])
        self.run, found = np.cumsum(first, dtype=np.int32) - np.int32(1), best[first]
        order, begin, number = _alike(found)
        #: the block's distinct anchors, sorted, and which of them stand at several places of the block
        self.anchors, self.several = found[order[begin]], np.diff(begin, append=len(found)) > 1
        self.slot = np.empty(len(found), dtype=np.int32)
        self.slot[order] = number

    def seeded(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The windows whose anchor is kept, by their numbers, and their hashes."""
        at = np.flatnonzero(keep[self.slot][self.run])
        return at, gram_hashes(self.words, LENGTH)[self.starts[at]]

    def ranks(self) -> np.ndarray:
        """Rows that share an id are one document; rows without one come last and are each the last."""
        ids = self.rows["doc"].to_numpy(dtype=object, na_value=None)
        rank, last = np.zeros(len(ids), dtype=np.int64), -1
        for i, d in enumerate(ids):
            last = rank[i - 1] if i and d is not None and ids[i - 1] == d else last + 1
            rank[i] = len(ids) if d is None else last
        return rank

    def repeated(self, at: np.ndarray, windows: np.ndarray, answers: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Which of the seeded windows start in an earlier document, of this block or of an earlier one (``answers``)."""
        if not len(at):
            return at
        order, begin, number = _alike(windows)
        earlier, rank = answers(windows[order[begin]]), self.ranks()[self.doc[at[order]]]
        return at[order[earlier[number] | (rank > np.minimum.reduceat(rank, begin)[number])]]

    def covered(self, repeated: np.ndarray) -> np.ndarray:
        """Which words a repeated window covers."""
        change = np.zeros(self.at[-1] + 1, dtype=np.int32)
        starts = self.starts[repeated]
        change[starts] = 1
        change[starts + LENGTH] -= 1
        return np.cumsum(change)[:-1] > 0

    def remainders(self, gone: np.ndarray) -> pd.DataFrame:
        """Each row's words, those that are gone, the text of the others, and the runs of gone words."""
        removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[self.at])
        edge = np.zeros(len(gone) + 1, dtype=bool)
        edge[1:-1] = gone[1:] != gone[:-1]
        edge[self.at] = True
        # runs of equal words, which a document's end cuts
        places = np.flatnonzero(edge)
        begin, end = places[:-1][gone[places[:-1]]], places[1:][gone[places[:-1]]]
        kept, spans, runs = [], [], np.searchsorted(begin, self.at).tolist()
        for i, text in enumerate(self.rows["text"]):
            words, base, own = raw_text(text).split(), int(self.at[i]), slice(runs[i], runs[i + 1])
            pairs = list(zip((begin[own] - base).tolist(), (end[own] - base).tolist(), strict=True))
            left, done = [], 0
            for s, e in pairs:
                left += words[done:s]
                done = e
            left += words[done:]
            kept.append(b" ".join(left).decode("utf-8"))
            spans.append([{"start": s, "words": e - s} for s, e in pairs])
        return pd.DataFrame({"doc_id": self.rows["doc"], "n_words": np.diff(self.at), "n_removed": removed,
                             "kept": kept, "spans": spans}).astype({"doc_id": "Int64"})


def _asking(block: int, values: np.ndarray, flags: np.ndarray, shift: int) -> pd.DataFrame:
    """A block's sorted hashes cut by hash range, one row per range that has some."""
    edges = np.searchsorted(values >> np.uint64(shift), np.arange((1 << (64 - shift)) + 1, dtype=np.uint64))
    rows = [(block, b, values[lo:hi].tobytes(), np.packbits(flags[lo:hi]).tobytes())
            for b, (lo, hi) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)) if hi > lo]
    return pd.DataFrame(rows, columns=["block", "bucket", "hashes", "flags"])


def _lists(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all rows, one list after the other, and the lists' lengths."""
    sizes = np.fromiter(map(len, pdf["hashes"]), dtype=np.int64, count=len(pdf)) // 8
    return np.frombuffer(b"".join(pdf["hashes"]), "<u8"), sizes


def _replies(pdf: pd.DataFrame, bits: np.ndarray, sizes: np.ndarray) -> pd.DataFrame:
    ends = np.cumsum(sizes).tolist()
    flags = [np.packbits(bits[lo:hi]).tobytes() for lo, hi in zip([0, *ends], ends, strict=False)]
    return pd.DataFrame({"block": pdf["block"], "bucket": pdf["bucket"], "flags": flags})


def _others_hold(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per block of a hash range: which hashes another block holds too, or the block itself at several places."""
    values, sizes = _lists(pdf)
    order, begin, number = _alike(values)
    bits = np.empty(len(values), dtype=bool)
    bits[order] = (np.diff(begin, append=len(values)) > 1)[number]
    bits |= np.concatenate([np.unpackbits(np.frombuffer(f, np.uint8), count=n) for f, n in zip(pdf["flags"], sizes.tolist(), strict=True)]).astype(bool)
    return _replies(pdf, bits, sizes)


def _earlier_hold(pdf: pd.DataFrame, late: int) -> pd.DataFrame:
    """Per block of a hash range: which hashes an earlier block holds; blocks from ``late`` on are earlier than none.

    All lists are sorted at once, whatever the number of blocks: a hash's smallest block answers for all that hold it.
    """
    values, sizes = _lists(pdf)
    order, begin, number = _alike(values)
    block = np.repeat(pdf["block"].to_numpy(dtype=np.int64), sizes)[order]
    first = np.minimum.reduceat(block, begin)[number]
    bits = np.empty(len(values), dtype=bool)
    bits[order] = (first < block) & (first < late)
    return _replies(pdf, bits, sizes)


def _answers(replies: pd.DataFrame, values: np.ndarray, shift: int) -> np.ndarray:
    out = np.zeros(len(values), dtype=bool)
    edges = np.searchsorted(values >> np.uint64(shift), np.arange((1 << (64 - shift)) + 1, dtype=np.uint64))
    for bucket, raw in zip(replies["bucket"], replies["flags"], strict=True):
        lo, hi = edges[bucket], edges[bucket + 1]
        out[lo:hi] = np.unpackbits(np.frombuffer(raw, np.uint8), count=hi - lo).astype(bool)
    return out


def _at_or_below(cuts: list[int], column: Column) -> Column:
    """How many of the ascending cuts are at or below the column, by halving: few looks at a constant array for each row."""
    known, steps = F.lit(cuts), [1 << i for i in reversed(range(len(cuts).bit_length()))]
    # beyond the last cut the look-up gives NULL, so the step is not taken
    return F.aggregate(F.lit(steps), F.lit(0), lambda at, step: F.when(F.get(known, at + step - F.lit(1)) <= column, at + step).otherwise(at))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept (text without the repeated words), spans.

    ``spans`` are the row's runs of repeated windows: arrays of (start, words).  The
    words that remain are joined by one space.  NULL texts have no words.  Rows
    that share an id are one document: none makes the other's words repeats
    (they are judged against smaller ids only).  Rows without an id count as later than all
    others and never make another row's words repeats.  Other columns are ignored.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    facts = base.agg(F.sum(F.octet_length("text")).alias("size"), F.count("doc").alias("n")).first()
    size = facts["size"] or 0
    # enough blocks for all cores, of a megabyte at least
    blocks = max(1, -(-size // BLOCK_BYTES), min(docs.sparkSession.sparkContext.defaultParallelism, size >> 20))
    buckets = 1 << min(BUCKETS.bit_length() - 1, max(0, (blocks - 1).bit_length()))
    shift = 65 - buckets.bit_length()
    cuts = base.where("doc is not null").approxQuantile("doc", [i / blocks for i in range(1, blocks)], 0.25 / blocks) if facts["n"] and blocks > 1 else []
    cuts = sorted({int(c) for c in cuts})
    # the number of cuts at or below the id: ranges of ids, in order; rows without an id by a hash, after them
    number = _at_or_below(cuts, F.col("doc")) if cuts else F.lit(0)
    first_late = len(cuts) + 1
    late = first_late + F.pmod(F.xxhash64("text"), F.lit(blocks))
    dealt = base.withColumn("block", F.when(F.col("doc").isNull(), late).otherwise(number).cast("long")).repartition("block")
    shape, reply = "block long, bucket long, hashes binary, flags binary", "block long, bucket long, flags binary"

    def ask_anchors(pdf: pd.DataFrame) -> pd.DataFrame:
        with np.errstate(over="ignore"):
            b = Block(pdf)
            return _asking(int(pdf["block"].iloc[0]), b.anchors, b.several, shift)

    anchors = dealt.groupBy("block").applyInPandas(ask_anchors, shape).groupBy("bucket").applyInPandas(_others_hold, reply)

    def ask_windows(pdf: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        with np.errstate(over="ignore"):
            b = Block(pdf)
            _, windows = b.seeded(_answers(replies, b.anchors, shift))
            order, begin, _ = _alike(windows)
            return _asking(int(pdf["block"].iloc[0]), windows[order[begin]], np.ones(len(begin), dtype=bool), shift)

    asked = dealt.groupBy("block").cogroup(anchors.groupBy("block")).applyInPandas(ask_windows, shape)
    windows = asked.groupBy("bucket").applyInPandas(lambda pdf: _earlier_hold(pdf, first_late), reply)

    both = (anchors.select("block", "bucket", "flags", F.lit(0).alias("step"))
            .unionByName(windows.select("block", "bucket", "flags", F.lit(1).alias("step"))))

    def last(pdf: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        seeds, held = replies[replies["step"] == 0], replies[replies["step"] == 1]
        with np.errstate(over="ignore"):
            b = Block(pdf)
            at, windows = b.seeded(_answers(seeds, b.anchors, shift))
            return b.remainders(b.covered(b.repeated(at, windows, lambda found: _answers(held, found, shift))))

    return dealt.groupBy("block").cogroup(both.groupBy("block")).applyInPandas(
        last, "doc_id long, n_words long, n_removed long, kept string, spans array<struct<start:long,words:long>>")
