"""How far each source's use of words departs from the other sources of its language.

Terms are counted by length-bucketed packing inside tasks: the terms of a run of
documents are split by length, a short term becomes one or two unsigned 64-bit
words, the words are radix-sorted (16 bits a pass, the group of the document
last) and equal neighbours are counted; long terms are sorted as bytes in
buckets of their own, each at most twice as wide as its shortest term.  The sort is stable,
so the documents of a term stay in order and its distinct documents are counted
in the same pass.  Spark adds up the counts of all runs.

All arithmetic on counts is exact, on 64-bit integers: shares by long division
in three steps of a thousand, which holds for totals up to 9 * 10^15.

Two sources are compared by walking over the terms that they hold, not over the
vocabulary: against every other term a source stands with one and the same share,
and such terms are summed up by their distinct shares.  Terms are dealt into buckets,
so a large language or source is worked off by many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runway.llm.spans import LETTERS, raw_texts, term_spans, text_runs
from runway.sources.sinks import materialise

MIN_DOCS = 3                 # documents of a language that a kept term occurs in
TOP = 200                    # terms reported for each source
SCALE = 1_000_000_000        # shares are counted in parts of this
RUN_BYTES = 8 << 20          # text that is sorted at once, about
BUCKET_ROWS = 500_000        # counts of a bucket when sources are compared, about
SHORT = (2, 4, 6, 8, 12, 16)  # longest terms, in bytes, of the buckets that are packed into words


# --- counting terms ------------------------------------------------------------------

def pack(buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray, at: int) -> np.ndarray:
    """Eight bytes of each term from place ``at`` on as one integer, the first byte highest, zeros behind its end."""
    word = np.zeros(len(starts), dtype=np.uint64)
    for j in range(at, at + 8):
        word <<= np.uint64(8)
        inside = sizes > j
        if inside.all():
            word |= buf[starts + j]
        elif inside.any():
            word |= np.where(inside, buf[np.where(inside, starts + j, 0)], 0).astype(np.uint64)
    return word


def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """Stable order by unsigned integer keys, the least significant key first: one radix pass for each 16 bits that differ."""
    order = np.arange(len(keys[0]))
    for key in keys:
        for shift in range(0, key.dtype.itemsize * 8, 16):
            digit = (key >> key.dtype.type(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _starts_of_runs(columns: list[np.ndarray]) -> np.ndarray:
    """Where a new combination of values begins in sorted columns."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def count_terms(raw: list[bytes], group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Group, term, occurrences and documents of the terms of texts, bucket by bucket; ``group`` numbers each text's group."""
    buf, starts, sizes, doc = term_spans(raw, LETTERS)
    group = group.astype(np.uint32)
    lo = 0
    for hi in SHORT:
        mine = np.flatnonzero((sizes > lo) & (sizes <= hi))
        lo = hi
        if not len(mine):
            continue
        at, size, text = starts[mine], sizes[mine], doc[mine]
        words = [pack(buf, at, size, k) for k in range(0, hi, 8)]
        of = group[text]
        order = radix_order([*words[::-1], of])
        words, of, text = [w[order] for w in words], of[order], text[order]
        new = _starts_of_runs([*words, of])
        first = np.flatnonzero(new)
        terms = np.stack([w[first] for w in words], axis=1).astype(">u8").view(f"S{8 * len(words)}").ravel()
        yield (of[first], terms, *_tally(new, first, text))
    while (sizes > lo).any():
        lo = max(lo, 1 << int(sizes[sizes > lo].min() - 1).bit_length() - 1)
        width = lo * 2
        mine = np.flatnonzero((sizes > lo) & (sizes <= width))
        terms = np.frombuffer(b"".join(buf[s:s + n].tobytes().ljust(width, b"\0") for s, n in zip(starts[mine], sizes[mine], strict=True)), dtype=f"S{width}")
        order = np.argsort(terms, kind="stable")
        order = order[radix_order([group[doc[mine]][order]])]
        terms, of, text = terms[order], group[doc[mine]][order], doc[mine][order]
        new = _starts_of_runs([terms, of])
        first = np.flatnonzero(new)
        yield (of[first], terms[first], *_tally(new, first, text))
        lo = width


def _tally(new: np.ndarray, first: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and distinct texts of each run; the texts of a run ascend."""
    other = new.copy()
    other[1:] |= text[1:] != text[:-1]
    return np.diff(np.append(first, len(new))), np.add.reduceat(other.astype(np.int64), first)


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term and rows with it, over every whole text.

    Terms are runs of ASCII letters and code points above 127, with A-Z lowered.
    NULL text, language and source count as empty.  Long terms are terms as any other.
    Repeated rows count each; no rows give no rows; other columns are ignored.
    """
    base = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in text_runs(batches, "text", RUN_BYTES):
            names = run.select(["lang", "source"]).to_pandas()
            keys = names.drop_duplicates(ignore_index=True)
            number = pd.MultiIndex.from_frame(keys).get_indexer(pd.MultiIndex.from_frame(names))
            lang, source = (pa.array(keys[c], pa.string()) for c in ("lang", "source"))
            for group, term, n, with_it in count_terms(raw_texts(run.column("text").combine_chunks()), number):
                of = pa.array(group)
                yield pa.RecordBatch.from_arrays(
                    [lang.take(of), source.take(of), pa.array(term.tolist(), pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(with_it, pa.int64())],
                    names=["lang", "source", "term", "n", "docs"])

    counted = base.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# --- shares and distances ------------------------------------------------------------

def share(n: Column, total: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / total), exactly; n + 1 <= total."""
    rest, out = n + 1, F.lit(0).cast("long")
    for _ in range(3):
        step = rest * 1000
        out, rest = out * 1000 + F.call_function("div", step, total), step % total
    return out + 1


def shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The same in numpy."""
    rest, out = n + 1, np.zeros(len(n), dtype=np.int64)
    for _ in range(3):
        step = rest * 1000
        out, rest = out * 1000 + step // total, step % total
    return out + 1


def distance(p, q):
    """floor((p - q)^2 / q) of numpy integers."""
    d = p - q
    return d * d // q


def compare(source: np.ndarray, term: np.ndarray, n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Sum of distances over a bucket's terms, for each source (row) against each other (column).

    ``source`` and ``term`` number the counts' sources and terms; ``total`` is each
    source's divisor.
    """
    order = np.argsort(source, kind="stable")
    source, term, n = source[order], term[order], n[order]
    own = shares(n, total[source])
    none = shares(np.zeros(len(total), dtype=np.int64), total)
    held, first = np.unique(source, return_index=True)
    terms = int(term.max()) + 1 if len(term) else 0
    out = np.zeros((len(total), len(total)), dtype=np.int64)
    if not terms:
        return out
    last = np.append(first[1:], len(source))
    span = {s: slice(a, b) for s, a, b in zip(held.tolist(), first.tolist(), last.tolist(), strict=True)}
    at_none = none[source]
    for a in range(len(total)):
        p = np.full(terms, none[a])
        if a in span:
            p[term[span[a]]] = own[span[a]]
        values, times = np.unique(p, return_counts=True)
        step = max(1, (1 << 22) // len(total))
        for lo in range(0, len(values), step):   # as if no other source held any of the terms
            out[a] += (distance(values[lo:lo + step, None], none[None, :]) * times[lo:lo + step, None]).sum(axis=0)
        mine = p[term]
        out[a, held] += np.add.reduceat(distance(mine, own) - distance(mine, at_none), first)
    return out


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank) for every source of every language that occurs.

    A language keeps the terms that occur in at least ``min_docs`` of its rows.  With N
    occurrences of kept terms and V kept terms, a term's share is p = 1 + floor(SCALE *
    (count + 1) / (N + V)).  Part ``pair``: item is another source of the language
    and value the sum over the kept terms of floor((p - q)^2 / q), q that source's share.
    Part ``term``: the ``top`` terms of the source with p above the language's share
    q, by the same distance.  Ranks count from 1 by value, largest first, ties by item.

    NULL and empty values: see ``term_counts``; a source without terms is compared like any
    other, and a language without kept terms gives pairs of value 0.  One source alone
    has no pairs.  Repeated rows count each; no rows give no rows; other columns are
    ignored.  Pairs are as many as the sources of a language squared: that is the result.
    """
    spark = docs.sparkSession
    counts = materialise(spark, term_counts(docs, text_col, lang_col, source_col), "term_counts")
    vocabulary = (counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
                  .where(F.col("docs") >= min_docs).drop("docs"))
    kept = materialise(spark, counts.drop("docs").join(vocabulary, ["lang", "term"]), "kept_terms")
    size = kept.groupBy("lang", "source").agg(F.sum("n").alias("N"))
    terms = kept.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.count(F.lit(1)).alias("V"), F.sum("n").alias("lang_N"))
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))]).distinct()
    zero = F.lit(0).cast("long")
    groups = (groups.join(size, ["lang", "source"], "left").join(terms, "lang", "left")
              .select("lang", "source", (F.coalesce("N", zero) + F.coalesce("V", zero)).alias("total"), (F.col("lang_N") + F.col("V")).alias("lang_total")))
    groups = materialise(spark, groups, "sources")

    p, q = F.col("p"), F.col("q")
    scored = (kept.join(groups, ["lang", "source"])
              .select("lang", "source", F.col("term").alias("item"), share(F.col("n"), F.col("total")).alias("p"), share(F.col("lang_n"), F.col("lang_total")).alias("q"))
              .where(p > q).select("lang", "source", "item", F.call_function("div", (p - q) * (p - q), q).alias("value")))
    ranked = _ranked(scored, "term").where(F.col("rank") <= top)

    buckets = max(1, -(-kept.count() // BUCKET_ROWS))
    dealt = kept.select("lang", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int").alias("bucket"), "source", "term", "n")
    beside = groups.select("lang", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"), "source", "total")

    def pairs(part: pd.DataFrame, of: pd.DataFrame) -> pd.DataFrame:
        names = pd.Index(of["source"])
        out = compare(names.get_indexer(part["source"]), pd.factorize(part["term"])[0], part["n"].to_numpy(np.int64), of["total"].to_numpy(np.int64))
        a, b = np.nonzero(~np.eye(len(names), dtype=bool))
        return pd.DataFrame({"lang": of["lang"].iloc[0], "source": names[a], "item": names[b], "value": out[a, b]})

    summed = (dealt.groupBy("lang", "bucket").cogroup(beside.groupBy("lang", "bucket"))
              .applyInPandas(pairs, "lang string, source string, item string, value long")
              .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    return _ranked(summed, "pair").unionByName(ranked)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    """Rows with their rank by value within (lang, source)."""
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
