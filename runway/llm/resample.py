"""Importance resampling of documents towards a target distribution.

Words are hashed into buckets; a bucket's gain is the logarithm of how much more
often the target uses it, and a document's weight is the sum of the gains of its
words, looked up in one array.  A document's score is its weight plus a Gumbel
noise made from its id, so that the highest scores are a draw without
replacement in proportion to the weights.

The cutoff between drawn and undrawn is found without sorting all documents: a
mergeable quantile sketch gives a bracket of scores around it, exact counts
outside the bracket confirm that the cutoff lies within, or widen it, and only the rows
of the bracket are sorted, in ranges.  The drawn rows alone are then numbered.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runway.llm.spans import ALPHANUMERIC, raw_texts, term_spans, text_runs
from runway.session import default_parallelism
from runway.sources.sinks import materialise

BUCKETS = 10_000
MIN_WORDS = 20               # documents with fewer words are not drawn
PERCENT = 10                 # share of the others that is drawn
SEED = 2024
RUN_BYTES = 8 << 20          # text that is split at once, about
SKETCH_K = 2048              # size of the sketch: a rank error of about 0.1 %
MARGINS = (0.005, 0.02, 0.1)  # half widths of the bracket, as shares of the rows; after these, all rows
LONG_WORD = 48               # longer words, in bytes, are hashed one by one

_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> np.uint32(1)) ^ np.uint32(0xEDB88320), _CRC >> np.uint32(1))


def crc32_spans(buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32 of byte spans (none empty): the spans still going on take a byte at a time, side by side."""
    order = np.argsort(-np.minimum(sizes, LONG_WORD + 1).astype(np.int16), kind="stable")
    at, length = starts[order], sizes[order]
    reg = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
    going = np.searchsorted(-np.minimum(length, LONG_WORD + 1), -np.arange(1, LONG_WORD + 1), side="right")
    for j, n in enumerate(going.tolist()):
        reg[:n] = _CRC[(reg[:n] ^ buf[at[:n] + j]) & np.uint32(0xFF)] ^ (reg[:n] >> np.uint32(8))
    reg ^= np.uint32(0xFFFFFFFF)
    for i in range(int(np.count_nonzero(length > LONG_WORD))):
        reg[i] = zlib.crc32(buf[at[i]:at[i] + length[i]])
    out = np.empty_like(reg)
    out[order] = reg
    return out


def word_buckets(docs: DataFrame, id_col: str | None, text_col: str, buckets: int) -> DataFrame:
    """(id, n_features, held): the number of words of each whole text and their buckets in order, as packed integers.

    Words are runs of ASCII letters and digits and code points above 127, with A-Z lowered.
    """
    dtype = "<u2" if buckets <= 1 << 16 else "<u4"
    ident = F.col(id_col).cast("long") if id_col else F.lit(None).cast("long")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in text_runs(batches, "text", RUN_BYTES):
            buf, starts, sizes, doc = term_spans(raw_texts(run.column("text").combine_chunks()), ALPHANUMERIC)
            held = (crc32_spans(buf, starts, sizes) % np.uint32(buckets)).astype(dtype)
            at = np.searchsorted(doc, np.arange(run.num_rows + 1))
            raw, width = held.tobytes(), held.itemsize
            packed = pa.array([raw[a * width:b * width] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([run.column("id").combine_chunks(), pa.array(np.diff(at), pa.int64()), packed], names=["id", "n_features", "held"])

    base = docs.select(ident.alias("id"), F.col(text_col).cast("string").alias("text"))
    return base.mapInArrow(split, "id long, n_features long, held binary")


def _unpacked(column: pa.Array, buckets: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u2" if buckets <= 1 << 16 else "<u4")


def bucket_counts(held: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs in all rows; the driver gets ``buckets`` numbers."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            total += np.bincount(_unpacked(batch.column("held"), buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some, pa.int32()), "n": pa.array(total[some], pa.int64())})

    out = np.zeros(buckets, dtype=np.int64)
    for r in held.select("held").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of each bucket, in doubles."""
    b, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float(t + 1) * float(s_all + b) / (float(s + 1) * float(t_all + b))))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def weighted(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(id, n_features, weight, score, row): every row's words, sum of gains and noisy score, written once.

    Both tables count whole: gains come from all texts.  Rows without words weigh 0.
    """
    spark = docs.sparkSession
    held = materialise(spark, word_buckets(docs, id_col, text_col, buckets), "word_buckets")
    gain = gains(bucket_counts(held, buckets), bucket_counts(word_buckets(target, None, target_text, buckets), buckets))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = np.concatenate([[0], np.cumsum(gain[_unpacked(batch.column("held"), buckets)])])
            ends = np.concatenate([[0], np.cumsum(batch.column("n_features").to_numpy())])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_features"), pa.array(np.diff(total[ends]), pa.int64())],
                                             names=["id", "n_features", "weight"])

    weights = held.mapInArrow(weigh, "id long, n_features long, weight long")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000.0 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return materialise(spark, weights.withColumns({"score": F.col("weight") + noise, "row": F.monotonically_increasing_id()}), "scores")


def _numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with their place, from 1, by score (highest first), id and row: sorted in ranges, of which only the sizes are added up."""
    spark = rows.sparkSession
    order = [F.desc("score"), F.asc("id"), F.asc("row")]
    ranged = rows.repartitionByRange(default_parallelism(spark), *order).sortWithinPartitions(*order)
    ranged = materialise(spark, ranged.withColumn("at", F.monotonically_increasing_id()), name)
    part, within = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)      # one row per range
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return ranged.withColumn("part", part).join(F.broadcast(starts), "part").withColumn("rank", F.col("first") + within + 1).drop("part", "first", "at")


def bracket(rows: DataFrame, share: float, k: int, margins: tuple[float, ...] = MARGINS) -> tuple[int, int, int]:
    """(lo, hi, above): scores with the k-th highest between them, and how many rows score above hi.

    ``share`` is about how much of the rows is drawn.  A sketch proposes, exact counts decide.
    """
    sketch = F.kll_sketch_agg_bigint("score", F.lit(SKETCH_K))
    ask = [F.kll_sketch_get_quantile_bigint("sketch", F.lit(min(1.0, max(0.0, 1 - share + m)))) for d in margins for m in (-d, d)]
    seen = rows.agg(sketch.alias("sketch"), F.min("score").alias("lo"), F.max("score").alias("hi")).select(*[a.alias(f"q{i}") for i, a in enumerate(ask)], "lo", "hi").first()
    for lo, hi in [*zip(seen[:-2:2], seen[1:-2:2], strict=True), tuple(seen[-2:])]:
        counts = rows.agg(F.count_if(F.col("score") > hi).alias("above"), F.count_if(F.col("score") >= lo).alias("upto")).first()
        if counts["above"] < k <= counts["upto"]:
            return lo, hi, counts["above"]
    raise ValueError(f"there is no row number {k}")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, id_col: str = "doc_id",
             text_col: str = "text", target_text: str = "text", buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): every row of ``docs``; drawn rows have a rank, from 1.

    Of the N rows with at least ``min_words`` words, floor(percent * N / 100) are drawn,
    highest scores first, ties to the smaller id.  NULL and empty texts have no words and
    weigh 0.  Repeated rows are rows as any others; between rows alike in score and id the choice is
    arbitrary but fixed.  Rows without an id count for the gains, have no score and are not
    drawn.  An empty table gives no rows; an empty target makes every gain that of words it lacks.
    Other columns are ignored.
    """
    rows = weighted(docs, target, id_col, text_col, target_text, buckets, seed)
    able = rows.where((F.col("n_features") >= min_words) & F.col("score").isNotNull())
    k = percent * able.count() // 100
    none = rows.withColumn("rank", F.lit(None).cast("long"))
    if k == 0:
        return none.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")
    lo, hi, above = bracket(able, percent / 100, k)
    edge = _numbered(able.where(F.col("score").between(lo, hi)), "bracket").where(F.col("rank") == k - above).first()
    score, ident = F.col("score"), F.col("id")
    drawn = F.coalesce((F.col("n_features") >= min_words) & (
        (score > edge["score"]) | ((score == edge["score"]) & ((ident < edge["id"]) | ((ident == edge["id"]) & (F.col("row") <= edge["row"]))))), F.lit(False))
    out = _numbered(rows.where(drawn), "drawn").unionByName(none.where(~drawn))
    return out.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")
