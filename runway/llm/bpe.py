"""BPE encoding and decoding over a distinct-word table.

A tokenizer that never joins pieces over ASCII white space gives a text the
ids of its words (runs without ASCII white space) in order; trailing punctuation
counts as a word of its own (see ``Parts``).  Consecutive texts form compressed
blocks of about ``BLOCK_BYTES``; each block names its distinct words once, the words meet in buckets by a hash, where each distinct word is encoded
once, and the ids go back to the blocks that asked, in the order they asked.  A
block then joins them to its texts by position.  The blocks are shuffled once: both
passes over them read the same exchange.

Words travel in compressed lists of one block and one bucket; a bucket works off
its lists one at a time and holds only its own distinct words.  Decoding looks
each id up in the table of pieces, whose size is that of the vocabulary.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runway.llm.wordhash import joined_words, mix, span_hashes

BLOCK_BYTES = 4 << 20      # text of a block
BUCKETS = 1 << 16          # most buckets of words
TAIL_BYTES = 16            # longest trailing punctuation that is a part of its own


def load(path: str):
    """The tokenizer at ``path`` with truncation and padding off, on one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def encode_words(tokenizer, words: list[bytes]) -> list[bytes]:
    """The ids of each word as little-endian 32-bit integers."""
    out = []
    for at in range(0, len(words), 1000):      # an encoding holds far more than its ids
        texts = [w.decode("utf-8", "replace") for w in words[at:at + 1000]]
        out += [array("I", e.ids).tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    return out


def splits_words(tokenizer) -> bool:
    """Whether the tokenizer works on the parts of ``Parts`` one by one, so that their ids can be joined.

    It must lower-case after NFC, turn white space into spaces, cut letters,
    digits and other characters apart with the pattern below, drop what is between, and have no
    special token that begins with anything but "<|".  Only then are texts cut into parts;
    any other tokenizer gets whole texts.
    """
    rules = lambda part: None if part is None else json.loads(part.__getstate__())
    special = all(t.content.startswith("<|") and not (t.normalized or t.lstrip or t.rstrip or t.single_word or re.search(r"\s", t.content))
                  for t in tokenizer.get_added_tokens_decoder().values())
    return (special and rules(tokenizer.normalizer) == NORMALIZER and rules(tokenizer.pre_tokenizer) == PRE_TOKENIZER
            and tokenizer.post_processor is None)


class Facts(NamedTuple):
    """What the driver needs to know of a tokenizer."""

    splits_words: bool
    has_decoder: bool


@lru_cache(maxsize=4)
def facts(tokenizer_path: str) -> Facts:
    """The facts of the tokenizer at a path, which a task loads for them: the driver never holds it."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            t = load(tokenizer_path)
            yield pa.RecordBatch.from_arrays([pa.array([splits_words(t)]), pa.array([t.decoder is not None])], names=list(Facts._fields))

    one = SparkSession.active().range(1, numPartitions=1)
    return Facts(*one.mapInArrow(read, "splits_words boolean, has_decoder boolean").first())


@lru_cache(maxsize=4)
def pieces(tokenizer_path: str) -> pa.Array:
    """The piece of every id of the vocabulary, special tokens included; a worker loads the tokenizer once for them."""
    by_id = {i: p for p, i in load(tokenizer_path).get_vocab(with_added_tokens=True).items()}
    return pa.array([by_id.get(i, "") for i in range(max(by_id) + 1)])


def join_pieces(ids: pa.Array, table: pa.Array) -> pa.Array:
    """The pieces of each list of ids, joined by spaces; a NULL list gives the empty text, unknown ids nothing."""
    flat = ids.flatten()
    known = pc.fill_null(pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(table))), False)
    ends = np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))
    before = np.concatenate([[0], np.cumsum(known.to_numpy(zero_copy_only=False))])
    offsets = before[np.concatenate([[0], ends]).astype(np.int64)]
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), table.take(flat.filter(known)))
    return pc.binary_join(lists, " ")


# fixed values: the rules of a tokenizer that never joins pieces over the borders of parts
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


def encode_texts(tokenizer, texts: list[bytes]) -> list[np.ndarray]:
    """The ids of whole texts, a few at a time; for any tokenizer."""
    out = []
    for at in range(0, len(texts), 16):
        some = [t.decode("utf-8", "replace") for t in texts[at:at + 16]]
        out += [np.array(e.ids, dtype="<u4") for e in tokenizer.encode_batch_fast(some, add_special_tokens=False)]
    return out


def raw_text(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "replace")


def _pack(items: list[bytes]) -> bytes:
    sizes = np.fromiter(map(len, items), dtype="<u4", count=len(items))
    return zstandard.compress(np.uint32(len(items)).tobytes() + sizes.tobytes() + b"".join(items), 3)


def _unpack(raw: bytes) -> tuple[np.ndarray, bytes]:
    """Sizes and joined bytes of packed items."""
    data = zstandard.decompress(raw)
    n = int(np.frombuffer(data, "<u4", 1)[0])
    return np.frombuffer(data, "<u4", n, 4).astype(np.int64), data[4 + 4 * n:]


def _items(raw: bytes) -> list[bytes]:
    sizes, body = _unpack(raw)
    ends = np.cumsum(sizes).tolist()
    return [body[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True


class Parts:
    """Texts cut into word parts, with the distinct parts in order of first use.

    A word's trailing punctuation is a part of its own if an ASCII letter or digit
    stands before it, and parts that differ in the case of ASCII letters are one: the
    tokenizer splits and lowers there too (``splits_words``).  A word that may spell a
    special token ("<|") is one part, with its case.  Parts are told apart by a 64-bit hash.
    """

    def __init__(self, texts: list[bytes]) -> None:
        buf, starts, ends, at = joined_words(texts)
        starts, ends = starts.astype(np.int32), ends.astype(np.int32)
        self.raw = buf.tobytes()
        special = np.zeros(len(starts), dtype=bool)
        found = [m.start() for m in re.finditer(rb"<\|", self.raw)]
        special[np.searchsorted(starts, found, side="right") - 1] = True
        # where the trailing punctuation of each word begins; longer runs of it stay with their word
        cut, more = ends.copy(), np.flatnonzero(~special)
        for _ in range(TAIL_BYTES):
            more = more[(cut[more] > starts[more]) & _PUNCTUATION[buf[cut[more] - 1]]]
            cut[more] -= 1
        special[more] = True
        two = (cut > starts) & (cut < ends) & ~special
        two[two] = _ALNUM[buf[cut[two] - 1]]
        n_parts = two.astype(np.int32) + np.int32(1)
        begin = np.cumsum(n_parts, dtype=np.int32) - n_parts
        self.at = np.append(begin, np.int32(len(starts) + np.count_nonzero(two)))[at]
        starts, ends = np.repeat(starts, n_parts), np.repeat(ends, n_parts)
        ends[begin[two]] = starts[begin[two] + 1] = cut[two]
        with np.errstate(over="ignore"):
            key = span_hashes(buf, starts, ends, lower=True)
            exact = begin[special]
            key[exact] = mix(span_hashes(buf, starts[exact], ends[exact], lower=False))
        which, self.keys = pd.factorize(key)
        self.which = which.astype(np.int32)
        first = np.empty(len(self.keys), dtype=np.int32)
        first[self.which[::-1]] = np.arange(len(self.which) - 1, -1, -1, dtype=np.int32)
        self.starts, self.ends = starts[first], ends[first]

    def words(self, numbers: np.ndarray) -> list[bytes]:
        """Distinct parts by their numbers."""
        return [self.raw[a:b] for a, b in zip(self.starts[numbers].tolist(), self.ends[numbers].tolist(), strict=True)]

    def ids(self, flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and where each text's begin; the i-th part's are ``flat[first[i]:first[i] + size[i]]``."""
        sizes = size[self.which]
        after = np.cumsum(sizes, dtype=np.int64)
        out = np.empty(int(after[-1]) if len(after) else 0, dtype=flat.dtype)
        for lo in range(0, len(sizes), _STEP):
            hi = min(len(sizes), lo + _STEP)
            begin = after[lo:hi] - sizes[lo:hi]
            at = np.repeat(first[self.which[lo:hi]] - begin, sizes[lo:hi])
            at += np.arange(begin[0], after[hi - 1])
            out[begin[0]:after[hi - 1]] = flat[at]
        return out, np.append(np.int64(0), after)[self.at]

    def by_bucket(self, buckets: int) -> list[np.ndarray]:
        """The distinct parts' numbers by bucket, in order."""
        bucket = (self.keys % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        return np.split(order, np.searchsorted(bucket[order], np.arange(1, buckets)))


_STEP = 1 << 17      # parts whose ids are put in place at once


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows (last column: text) as compressed Arrow data, with a number for each run."""
    from pyspark import TaskContext
    number, held, size = TaskContext.get().partitionId() << 32, [], 0
    options = pa.ipc.IpcWriteOptions(compression="zstd")

    def block() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=options) as out:
            out.write_table(table)
        return pa.RecordBatch.from_pydict({"block": pa.array([number], pa.int64()), "data": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            done = int(ends[at - 1]) if at else 0
            to = min(batch.num_rows, int(np.searchsorted(ends, done + BLOCK_BYTES - size)) + 1)
            held.append(batch.slice(at, to - at))
            size += int(ends[to - 1]) - done
            at = to
            if size >= BLOCK_BYTES:
                yield block()
                number, held, size = number + 1, [], 0
    if held:
        yield block()


def encode(docs: DataFrame, tokenizer_path: str, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns and ``ids`` array<int> of each row's whole text (no special tokens added).

    NULL and empty texts have no ids.  Special tokens that a text spells out are
    encoded as the library does.  Repeated rows stay as many, no rows give none;
    other columns are ignored.  A tokenizer that does not keep to the
    words (``splits_words``) encodes whole texts, each in its place.
    """
    names = [f"c{i}" for i in range(len(carry))]
    base = docs.select(*[F.col(c).alias(n) for c, n in zip(carry, names, strict=True)], F.col(text_col).cast("string").alias("text"))
    out_type = T.StructType([*[T.StructField(n, base.schema[n].dataType) for n in names], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    back = [F.col(n).alias(c) for n, c in zip(names, carry, strict=True)]

    def with_ids(rows: pa.Table, flat: np.ndarray, bounds: np.ndarray) -> pa.Table:
        ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat.astype(np.int32, copy=False), pa.int32()))
        return rows.drop_columns(["text"]).append_column("ids", ids)

    if not facts(tokenizer_path).splits_words:
        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tokenizer = load(tokenizer_path)
            for batch in batches:
                found = encode_texts(tokenizer, [raw_text(t) for t in batch.column("text").to_pylist()])
                bounds = np.cumsum([0, *map(len, found)])
                yield from with_ids(pa.Table.from_batches([batch]), np.concatenate([np.empty(0, "<u4"), *found]), bounds).combine_chunks().to_batches()

        return base.mapInArrow(whole, out_type).select(*back, "ids")

    total = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(max(1, -(-total // BLOCK_BYTES)), BUCKETS)
    dealt = base.mapInArrow(_blocks, "block long, data binary").repartition("block")

    def parts_of(block: pa.Table) -> tuple[pa.Table, Parts]:
        rows = pa.ipc.open_stream(block.column("data")[0].as_buffer()).read_all()
        return rows, Parts([raw_text(t) for t in rows.column("text").to_pylist()])

    def ask(block: pa.Table) -> pa.Table:
        _, parts = parts_of(block)
        some = [(i, _pack(parts.words(numbers))) for i, numbers in enumerate(parts.by_bucket(buckets)) if len(numbers)]
        return pa.table({"block": pa.array([block.column("block")[0].as_py()] * len(some), pa.int64()),
                         "bucket": pa.array([i for i, _ in some], pa.int64()), "data": pa.array([x for _, x in some], pa.binary())})

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the lists of a bucket come one after the other; its distinct words alone are held
        tokenizer, known, now = load(tokenizer_path), {}, None
        for batch in batches:
            replies = []
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("data").to_pylist(), strict=True):
                if bucket != now:
                    known, now = {}, bucket
                words = _items(data)
                new = [w for w in words if w not in known]
                known.update(zip(new, encode_words(tokenizer, new), strict=True))
                replies.append(_pack([known[w] for w in words]))
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("bucket"), pa.array(replies, pa.binary())], names=["block", "bucket", "data"])

    def place(block: pa.Table, replies: pa.Table) -> pa.Table:
        rows, parts = parts_of(block)
        parts.raw = b""
        lists = parts.by_bucket(buckets)
        first, size = np.zeros(len(parts.keys), dtype=np.int64), np.zeros(len(parts.keys), dtype=np.int32)
        flat, at = [np.empty(0, "<u4")], 0
        for bucket, data in zip(replies.column("bucket").to_pylist(), replies.column("data"), strict=True):
            sizes, body = _unpack(data.as_buffer())
            sizes //= 4
            ends = np.cumsum(sizes)
            first[lists[bucket]], size[lists[bucket]] = at + ends - sizes, sizes
            flat.append(np.frombuffer(body, "<u4"))
            at += len(flat[-1])
        return with_ids(rows, *parts.ids(np.concatenate(flat), first, size))

    shape = "block long, bucket long, data binary"
    asked = dealt.groupBy("block").applyInArrow(ask, shape).repartition("bucket").sortWithinPartitions("bucket")
    replies = asked.mapInArrow(answer, shape)
    encoded = dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(place, out_type)
    return encoded.select(*back, "ids")


def decode(ids_col: str, tokenizer_path: str) -> Column:
    """The text of a column of ids: their pieces joined by spaces, as a tokenizer without a decoder joins them.

    The table of pieces, as large as the vocabulary, is loaded by the tasks; as a constant
    of the plan it would be in every description of it that the driver makes.  Each id is looked
    up by its number.  NULL ids give the empty text.
    """
    if facts(tokenizer_path).has_decoder:
        raise ValueError("decode() joins plain pieces; this tokenizer has a decoder of its own")

    @F.arrow_udf("string")
    def text(ids: pa.Array) -> pa.Array:
        return join_pieces(ids, pieces(tokenizer_path))

    return text(ids_col)
