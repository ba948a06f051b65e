"""Token ids as length-delimited binary records with an offset index.

File format (little-endian): each record is its length (8 bytes), the masked
CRC-32C of those bytes (4), the payload, and the masked CRC-32C of the payload
(4).  A payload is a flag byte (1: the document has an id, 2: ids are four bytes
wide, else two), the document id (8 bytes), then the ids.  Records stand in
ascending document order within a file and over the files in order of their part
number.  They come in runs of about ``RUN_BYTES``: a run begins with a record that
states its place (flag 4; the run's byte offset in the file, then the number of ids before
it in the file) and ends with an empty record.  Readers of ids skip both.

Spark's text sink writes the files and its text source reads them back: a row is a run
and the empty record is the line separator, so commits, retries, splits and every
file system that Spark knows come with it, and no task holds more than a run of a
file, however large it is.  The index, a Parquet table made by reading the
files back, gives for each record its file, byte offset, length, number of ids
and the number of ids before it, so that a reader can fetch records in any order.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runway.llm.bpe import Parts, encode_texts, encode_words, load, raw_text, splits_words
from runway.llm.spans import text_runs
from runway.session import shared_path
from runway.sources.sinks import materialise

FILE_BYTES = 32 << 20       # text per file, about
RUN_BYTES = 256 << 10       # payload of a run of records, about
CACHE_BYTES = 64 << 20      # of the table of word parts that a worker keeps
BATCH_BYTES = 2 << 20       # text that is encoded at once, about
FLAG_ID, FLAG_WIDE, FLAG_PLACE = 1, 2, 4

_CHUNK = 1024


def _crc_tables() -> np.ndarray:
    """tables[j][b]: what byte b does to the register when j more bytes follow it."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> np.uint32(1)) ^ np.uint32(0x82F63B78), t >> np.uint32(1))
    out = [t]
    for _ in range(7):
        out.append(out[0][out[-1] & 0xFF] ^ (out[-1] >> np.uint32(8)))
    return np.array(out)


_TABLES = _crc_tables()


def _zeros_after(count: int) -> np.ndarray:
    """Four byte tables that move a register over ``count`` zero bytes."""
    state = (np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * np.uint32(8))[:, None]).copy()
    for _ in range(count):
        state = _TABLES[0][state & 0xFF] ^ (state >> np.uint32(8))
    return state


_OVER_CHUNK = _zeros_after(_CHUNK)


def crc32c(parts: list[bytes]) -> np.ndarray:
    """CRC-32C of each byte string, all at once.

    Strings are cut into chunks counted from their ends (leading zeros leave a
    zero register at zero), the chunks' registers are computed side by side eight
    bytes at a time, and each string's registers are combined by moving the
    register over one chunk of zeros at a time.
    """
    if not parts:
        return np.empty(0, dtype=np.uint32)
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    chunks = np.maximum(1, -(-sizes // _CHUNK))
    first = np.concatenate([[0], np.cumsum(chunks)])
    data = np.zeros((first[-1], _CHUNK), dtype=np.uint8)
    flat = data.reshape(-1)
    for part, end in zip(parts, first[1:] * _CHUNK, strict=True):
        flat[end - len(part):end] = np.frombuffer(part, dtype=np.uint8)
    # the register starts as all ones: the same as flipping the first four bytes (shorter strings below)
    for k in range(4):
        has = sizes > k
        at = first[1:][has] * _CHUNK - sizes[has] + k
        flat[at] ^= 0xFF
    reg = np.zeros(len(data), dtype=np.uint32)
    words = data.view("<u4")
    for i in range(0, _CHUNK // 4, 2):
        low, high = words[:, i] ^ reg, words[:, i + 1]
        reg = (_TABLES[7][low & 0xFF] ^ _TABLES[6][(low >> 8) & 0xFF] ^ _TABLES[5][(low >> 16) & 0xFF] ^ _TABLES[4][low >> 24]
               ^ _TABLES[3][high & 0xFF] ^ _TABLES[2][(high >> 8) & 0xFF] ^ _TABLES[1][(high >> 16) & 0xFF] ^ _TABLES[0][high >> 24])
    total = reg[first[:-1]].copy()
    for step in range(1, int(chunks.max())):
        more = np.flatnonzero(chunks > step)
        t = total[more]
        t = (_OVER_CHUNK[0][t & 0xFF] ^ _OVER_CHUNK[1][(t >> 8) & 0xFF] ^ _OVER_CHUNK[2][(t >> 16) & 0xFF] ^ _OVER_CHUNK[3][t >> 24])
        total[more] = t ^ reg[first[:-1][more] + step]
    # strings under four bytes: the ones that had no byte to flip stay in the register
    for k in range(4):
        total[sizes == k] ^= np.uint32(0xFFFFFFFF >> (8 * k))
    return total ^ np.uint32(0xFFFFFFFF)


def mask(crc: np.ndarray) -> np.ndarray:
    """Rotate right by 15 bits and add a constant, so that checksums of checksums stay sound."""
    crc = crc.astype(np.uint32)
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)


def frame(payloads: list[bytes]) -> bytes:
    """Framed records of the payloads, in order."""
    lengths = [struct.pack("<Q", len(p)) for p in payloads]
    heads, tails = mask(crc32c(lengths)), mask(crc32c(payloads))
    out = []
    for n, p, a, b in zip(lengths, payloads, heads.tolist(), tails.tolist(), strict=True):
        out += (n, struct.pack("<I", a), p, struct.pack("<I", b))
    return b"".join(out)


EMPTY = frame([b""])        # 16 fixed bytes


def unframe(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, payload) of the records of a file, every checksum checked; empty records are skipped."""
    at, found = 0, []
    while at < len(data):
        if at + 12 > len(data):
            raise ValueError(f"cut off at byte {at}")
        n = struct.unpack_from("<Q", data, at)[0]
        if at + 16 + n > len(data):
            raise ValueError(f"record at byte {at} is longer than the file")
        found.append((at, n))
        at += 16 + n
        if len(found) == 2000 or at == len(data) or at - found[0][0] > (8 << 20):
            lengths = [data[a:a + 8] for a, _ in found]
            payloads = [data[a + 12:a + 12 + n] for a, n in found]
            heads, tails = mask(crc32c(lengths)), mask(crc32c(payloads))
            for (a, n), p, h, t in zip(found, payloads, heads.tolist(), tails.tolist(), strict=True):
                if struct.unpack_from("<I", data, a + 8)[0] != h or struct.unpack_from("<I", data, a + 12 + n)[0] != t:
                    raise ValueError(f"checksum of the record at byte {a} is wrong")
                if n:
                    yield a, p
            found = []


class WordIds:
    """The ids of word parts (``bpe.Parts``) that have been met, in flat arrays: some 20 bytes a part.

    Keys are kept sorted, in a large run and a small one of late comers.  Beyond
    CACHE_BYTES the table starts anew.
    """

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        self.dtype = "<u2" if tokenizer.get_vocab_size(True) <= 1 << 16 else "<u4"
        self.clear()

    def clear(self) -> None:
        self.runs = [(np.empty(0, np.uint64), np.empty(0, np.int32))] * 2     # keys ascending, number of the part
        self.bounds, self.parts = np.zeros(1024, dtype=np.int32), 0          # where each part's ids end, from the second place on
        self.flat = np.empty(4096, dtype=self.dtype)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key's part, -1 if new."""
        out = np.full(len(keys), -1, dtype=np.int32)
        for held, number in self.runs:
            if len(held):
                at = np.minimum(np.searchsorted(held, keys), len(held) - 1)
                out = np.where(held[at] == keys, number[at], out)
        return out

    def _add(self, keys: np.ndarray, found: list[bytes]) -> np.ndarray:
        """Remember the ids of new keys; their numbers."""
        n, used = self.parts, int(self.bounds[self.parts])
        ids = np.frombuffer(b"".join(found), "<u4").astype(self.dtype)
        ends = used + np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4)
        self.bounds = _grown(self.bounds, n + len(keys) + 1)
        self.bounds[n + 1:n + len(keys) + 1] = ends
        self.flat = _grown(self.flat, used + len(ids))
        self.flat[used:used + len(ids)] = ids
        self.parts = n + len(keys)
        number = np.arange(n, self.parts, dtype=np.int32)
        large, small = self.runs
        small = _merged(small, (keys, number))
        self.runs = [_merged(large, small), (keys[:0], number[:0])] if len(small[0]) * 8 > len(large[0]) else [large, small]
        return number

    def held_bytes(self) -> int:
        return self.flat.nbytes + self.bounds.nbytes + sum(k.nbytes + n.nbytes for k, n in self.runs)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and where each text's begin."""
        parts = Parts(texts)
        if self.held_bytes() > CACHE_BYTES:
            self.clear()
        number = self._find(parts.keys)
        new = np.flatnonzero(number < 0)
        if len(new):
            number[new] = self._add(parts.keys[new], encode_words(self.tokenizer, parts.words(new)))
        first = self.bounds[number].astype(np.int64)
        return parts.ids(self.flat, first, self.bounds[number + 1] - first)


def _grown(x: np.ndarray, size: int) -> np.ndarray:
    return x if size <= len(x) else np.concatenate([x, np.zeros(size + size // 4 - len(x), dtype=x.dtype)])


def _merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([a[0], b[0]])
    order = np.argsort(keys, kind="stable")
    return keys[order], np.concatenate([a[1], b[1]])[order]


class WholeTexts:
    """Encodes whole texts, for tokenizers that do not keep to words."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = encode_texts(self.tokenizer, texts)
        return np.concatenate([np.empty(0, "<u4"), *found]), np.cumsum([0, *map(len, found)])


_encoders: dict[str, WordIds | WholeTexts] = {}


def encoder(path: str) -> WordIds | WholeTexts:
    """This Python worker's encoder for a tokenizer; the next task goes on with its table, CACHE_BYTES at most."""
    if path not in _encoders:
        _encoders.clear()
        tokenizer = load(path)
        _encoders[path] = (WordIds if splits_words(tokenizer) else WholeTexts)(tokenizer)
    return _encoders[path]


def payload(doc: int | None, ids: np.ndarray) -> bytes:
    wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
    flags = (FLAG_ID if doc is not None else 0) | (FLAG_WIDE if wide else 0)
    return struct.pack("<Bq", flags, doc or 0) + ids.astype("<u4" if wide else "<u2").tobytes()


def parse(data: bytes) -> tuple[int | None, np.ndarray]:
    flags, doc = struct.unpack_from("<Bq", data)
    return (doc if flags & FLAG_ID else None), np.frombuffer(data, "<u4" if flags & FLAG_WIDE else "<u2", offset=9).astype("<u4")


def write_records(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id``, and write the records to ``folder`` in ascending id order.

    Rows without an id come first; rows that share an id are ordered by a hash
    of their text.  NULL and empty texts are a record with ``end_id`` alone.  An
    empty table makes files without records; other columns are ignored.  Files
    hold about FILE_BYTES of text each; ranges are split by id and text, so
    one id with many rows does not make one file unless its texts are equal too.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    base = base.withColumn("tie", F.xxhash64("text"))
    ordered = base.repartitionByRange(max(1, -(-size // FILE_BYTES)), "doc", "tie").sortWithinPartitions("doc", "tie")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, held, held_bytes, held_ids = encoder(tokenizer_path), [], 0, 0
        offset = before = 0         # of the run: a task writes one file
        end = np.array([end_id], dtype="<u4")

        def run() -> pa.RecordBatch:
            nonlocal held, held_bytes, held_ids, offset, before
            data = frame([struct.pack("<Bqq", FLAG_PLACE, offset, before), *held])
            offset, before = offset + len(data) + len(EMPTY), before + held_ids
            held, held_bytes, held_ids = [], 0, 0
            return pa.RecordBatch.from_pydict({"run": pa.array([data], pa.binary())})

        for rows in text_runs(batches, "text", BATCH_BYTES):
            flat, bounds = tokens.encode([raw_text(t) for t in rows.column("text").to_pylist()])
            for doc, a, b in zip(rows.column("doc").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                held.append(payload(doc, np.concatenate([flat[a:b], end])))
                held_bytes, held_ids = held_bytes + len(held[-1]), held_ids + b - a + 1
                if held_bytes >= RUN_BYTES:
                    yield run()
        if held:
            yield run()

    rows = ordered.select("doc", "text").mapInArrow(runs, "run binary")
    (rows.select(F.col("run").cast("string").alias("value")).write.mode("errorifexists").option("maxRecordsPerFile", 0)
     .options(**TEXT_OPTIONS).text(folder))


#: rows of the text source are runs: as written, whatever the bytes
TEXT_OPTIONS = {"encoding": "ISO-8859-1", "lineSep": EMPTY.decode("latin-1")}


def read_records(spark: SparkSession, folder: str, ids: bool = False) -> DataFrame:
    """The records of ``folder``: file, size (of the file), offset, length, doc_id, n_tokens, before (ids before it in its file), ids_crc32, part.

    With ``ids``, the token ids too.  Every checksum is checked; a broken file raises.
    """
    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, run in zip(batch.column("file").to_pylist(), batch.column("size").to_pylist(), batch.column("run"), strict=True):
                rows: list[tuple] = []
                at = before = None
                for offset, data in unframe(run.as_buffer().to_pybytes()):
                    if data[0] & FLAG_PLACE:
                        _, at, before = struct.unpack("<Bqq", data)
                        continue
                    if at is None:
                        raise ValueError("a run does not state its place")
                    doc, x = parse(data)
                    rows.append((path, size, at + offset, len(data), doc, len(x), before, zlib.crc32(x.tobytes()), *([x.astype(np.int32)] if ids else [])))
                    before += len(x)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [[]] * len(kinds), kinds, strict=True)], names=names)

    schema = T._parse_datatype_string("file string, size long, offset long, length long, doc_id long, n_tokens long, before long, ids_crc32 long"
                                      + (", ids array<int>" if ids else ""))
    names, kinds = schema.names, [pa.string(), *[pa.int64()] * 7, *([pa.list_(pa.int32())] if ids else [])]
    runs = spark.read.options(**TEXT_OPTIONS).text(folder).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("run"))
    return runs.mapInArrow(records, schema).withColumn("part", F.regexp_extract("file", r"/part-([0-9]+)", 1).cast("int"))


def build_index(spark: SparkSession, folder: str) -> DataFrame:
    """The offset index of ``folder``, written to a table of its own: the columns of read_records and ``start``.

    ``start`` counts the ids of all records before; only one number per file is
    added up in order.  A file whose records do not follow one another without a gap up to its end raises.
    """
    rows = materialise(spark, read_records(spark, folder), "offsets")
    totals = rows.groupBy("part").agg(
        F.sum("n_tokens").alias("n"), F.max(F.col("before") + F.col("n_tokens")).alias("counted"),
        F.max(F.col("offset") + F.col("length") + 16 + len(EMPTY)).alias("end"), F.max("size").alias("size"))
    whole = (F.col("n") == F.col("counted")) & (F.col("end") == F.col("size"))
    totals = totals.withColumn("n", F.when(whole, F.col("n")).otherwise(F.raise_error(F.concat(F.lit("records are missing from part "), F.col("part").cast("string")))))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("file_start"))
    return rows.join(starts, "part").withColumn("start", F.col("file_start") + F.col("before")).drop("file_start", "size")


def encode_to_files(docs: DataFrame, tokenizer_path: str, end_id: int) -> tuple[str, DataFrame]:
    """Write the records of ``docs`` to a fresh shared folder; the folder and its index."""
    spark = docs.sparkSession
    folder = shared_path(spark, "records")
    write_records(docs, tokenizer_path, folder, end_id)
    return folder, build_index(spark, folder)
