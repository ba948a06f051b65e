"""Vectorised word and shingle hashes of whole texts, for use inside tasks.

A word is a maximal run of bytes other than ASCII white space
(``[^\\x20\\x09-\\x0D]+`` of the text), optionally with A-Z lowered.  Every word
gets a 64-bit hash (polynomial over its bytes, then a finalising mix); a
shingle of k words gets a hash of its k word hashes in order.  Texts are
worked off in pieces cut at white space, so a very long text needs no more
memory than a few pieces plus eight bytes per word.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PIECE = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        base = np.uint64(_BASE if kind == "up" else _BASE_INV)
        steps = np.full(max(n, _PIECE + 4096), base, dtype=np.uint64)
        steps[0] = 1
        _powers[kind] = have = np.multiply.accumulate(steps)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mix; returns a new array."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def word_hashes(texts: Iterable[str | None], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` and the offsets (one more than texts) of each text's words."""
    buf, starts, ends, at = joined_words([b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts])
    return span_hashes(buf, starts, ends, lower), at


def joined_words(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Encoded texts joined by line feeds, as bytes; every word's start and end; the offsets of each text's words."""
    sizes = np.fromiter((len(r) + 1 for r in raw), dtype=np.int64, count=len(raw))
    buf = np.frombuffer(b"\n".join([*raw, b""]), dtype=np.uint8)
    solid = np.zeros(len(buf) + 2, dtype=bool)
    np.logical_not(_SPACE[buf], out=solid[1:-1])
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edge[0::2], edge[1::2]
    return buf, starts, ends, np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)])).astype(np.int64)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """Hashes of ascending, disjoint byte spans, worked off in pieces."""
    out, i = np.empty(len(starts), dtype=np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _PIECE)))
        base = int(starts[i])
        a = buf[base:int(ends[j - 1])]
        if lower:
            a = _LOWER[a]
        total = np.empty(len(a) + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum((a.astype(np.uint64) + np.uint64(1)) * _power("up", len(a)), out=total[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        h = (total[e] - total[s]) * _power("down", len(a) + 1)[s]
        out[i:j] = mix(h + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        i = j
    return out


_MULT = np.array([pow(0xD1342543DE82EF95, i + 1, 1 << 64) | 1 for i in range(64)], dtype=np.uint64)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive entries of ``words`` (documents not told apart)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = words[:n] * _MULT[0]
    for j in range(1, k):
        out += words[j:j + n] * _MULT[j]
    return mix(out)


def whole_hash(words: np.ndarray) -> np.uint64:
    """Hash of a whole word sequence shorter than a shingle (told apart from longer shingles)."""
    out = np.uint64(0xA0761D6478BD642F) * np.uint64(len(words) + 1)
    for j, w in enumerate(words):
        out = out + w * _MULT[j]
    return mix(np.array([out], dtype=np.uint64))[0]


def shingle_list(words: np.ndarray, k: int) -> np.ndarray:
    """Shingles of one document in order: k words each; a shorter text is one shingle; no words, none."""
    if len(words) == 0:
        return np.empty(0, np.uint64)
    if len(words) < k:
        with np.errstate(over="ignore"):
            return np.array([whole_hash(words)], dtype=np.uint64)
    return gram_hashes(words, k)
