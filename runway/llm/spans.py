"""Byte spans of the terms of whole texts, found with numpy inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
PAD = 16      # zero bytes behind the joined texts, so that packing may read past the last term


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of the bytes in the given inclusive ranges."""
    table = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        table[lo:hi + 1] = True
    return table


#: ASCII letters and every byte of a code point above 127
LETTERS = byte_class((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: the same and ASCII digits
ALPHANUMERIC = LETTERS | byte_class((0x30, 0x39))


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; NULL is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def term_spans(raw: list[bytes], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The joined texts with A-Z lowered, start and size of every maximal run of bytes in ``table``, and its text's number."""
    ends = np.cumsum(np.fromiter((len(r) + 1 for r in raw), dtype=np.int64, count=len(raw)))
    buf = _FOLD[np.frombuffer(b"\n".join([*raw, bytes(PAD)]), dtype=np.uint8)]
    solid = np.zeros(len(buf) - PAD + 2, dtype=bool)
    solid[1:-1] = table[buf[:len(buf) - PAD]]
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    starts = edge[0::2]
    return buf, starts, edge[1::2] - starts, np.searchsorted(ends, starts, side="right")


def text_runs(batches: Iterator[pa.RecordBatch], text: str, run_bytes: int) -> Iterator[pa.Table]:
    """Consecutive rows as tables of about ``run_bytes`` of text, whatever the sizes of the batches; a longer text is a run alone."""
    held, size = [], 0
    for batch in batches:
        lengths = np.diff(_offsets(batch.column(text)))
        at = 0
        while at < batch.num_rows:
            take = int(np.searchsorted(np.cumsum(lengths[at:]), run_bytes - size)) + 1
            part = batch.slice(at, take)
            held.append(part)
            size += int(lengths[at:at + take].sum())
            at += take
            if size >= run_bytes:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _offsets(column: pa.Array) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))])
