"""Words of whole texts as 64-bit hashes, many texts at once with numpy.

A word is a run of bytes other than ``0x20`` and ``0x09-0x0D`` of the UTF-8 text,
with A-Z lowered when asked.  Equal words have equal hashes; two different words
share one with a chance of about 2**-64 a pair, which is taken as never.
Texts are worked on in slices of some megabytes, so memory does not depend on
the size of an Arrow batch; a longer text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18

_INSIDE = bytes(x not in b"\x20\x09\x0A\x0B\x0C\x0D" for x in range(256))  # of a word
_LOWER = bytes(x + 32 if 65 <= x <= 90 else x for x in range(256))

_STEP = 0x9E3779B97F4A7C15 | 1
_UNSTEP = pow(_STEP, -1, 1 << 64)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        out = np.ones(max(n, SLICE_BYTES + 1), np.uint64)
        out[1:] = np.uint64(base & (2**64 - 1))
        _POWERS[base] = have = np.multiply.accumulate(out)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Scan(NamedTuple):
    """Words of consecutive texts ``first .. first + len(bounds) - 2``.

    ``hashes``, ``starts``, ``ends`` (byte positions in ``data``) hold the words of all texts one after the other;
    those of text i are ``bounds[i]:bounds[i+1]``; its bytes are ``data[offsets[i]:offsets[i+1]]``, and in ``raw`` as written.
    """

    first: int
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    data: np.ndarray
    offsets: np.ndarray
    raw: np.ndarray


def _column(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column, null as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def scan(texts: pa.Array, lower: bool = True, slice_bytes: int = SLICE_BYTES) -> Iterator[Scan]:
    """The words of each text of a string column, slice by slice."""
    data, offsets = _column(texts)
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + slice_bytes, "right")) - 1
        to = min(max(to, at + 1), n)
        piece = data[offsets[at]:offsets[to]]
        yield Scan(at, *_words(_translated(piece, _LOWER) if lower else piece, offsets[at:to + 1] - offsets[at]), piece)
        at = to


def _translated(data: np.ndarray, table: bytes, kind: type = np.uint8) -> np.ndarray:
    """Each byte by a table, several times as fast as by an index array."""
    return np.frombuffer(data.tobytes().translate(table), kind)


def _words(data: np.ndarray, offsets: np.ndarray):
    n = len(data)
    inside = _translated(data, _INSIDE, bool)
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[offsets[offsets < n]] = False
    starts = np.flatnonzero(inside > before)
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[offsets[offsets > 0] - 1] = False
    ends = np.flatnonzero(inside > after) + 1
    sums = np.zeros(n + 1, np.uint64)
    values = _BYTE.take(data)
    values *= _powers(_STEP, n)
    np.cumsum(values, out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _powers(_UNSTEP, n)[starts] + (ends - starts).astype(np.uint64))
    return hashes, starts, ends, np.searchsorted(starts, offsets), data, offsets


def written(s: Scan, words: np.ndarray) -> np.ndarray:
    """Hashes of some words of a scan as they are written, not lowered."""
    size = s.ends[words] - s.starts[words]
    ends = np.cumsum(size)
    starts = ends - size
    n = int(size.sum())
    data = s.raw[np.arange(n) + np.repeat(s.starts[words] - starts, size)]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_STEP, n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers(_UNSTEP, n)[starts] + size.astype(np.uint64))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive words."""
    if len(hashes) < n:
        return hashes[:0]
    out = np.full(len(hashes) - n + 1, n, np.uint64)
    for i in range(n):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + hashes[i:len(hashes) - n + 1 + i])
    return out


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct n-word shingles; a shorter text's whole sequence counts as one, no words give none."""
    return np.unique(grams(hashes, min(n, len(hashes)))) if len(hashes) else hashes
