"""Words and word shingles of a batch of texts as numpy arrays.

Runs inside Spark tasks on one chunk of rows at a time (at most about
``CHUNK_BYTES`` of text, or one longer text), so memory does not follow the
partition. A word is a run of ``[^\\x20\\x09-\\x0D]``; in UTF-8 those bytes
occur in no multi-byte character, so words are found on bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
SHINGLE = 5

_rng = np.random.Generator(np.random.Philox(20240521))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash (the usual xor-shift, multiply rounds)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def chunks(batch: pa.RecordBatch, column: str, most: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batch with their texts as bytes (null: empty)."""
    texts = batch.column(column)
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1])
    start = 0
    while start < len(texts):
        end = start + max(1, int(np.searchsorted(np.cumsum(sizes[start:]), most, "right")))
        part = texts.slice(start, end - start).cast(pa.large_binary()).to_pylist()
        yield batch.slice(start, end - start), [x or b"" for x in part]
        start = end


class Words:
    """Words of some texts: ``doc`` (index of the text), ``hash``, ``start``
    and ``end`` (bytes in ``buf``); ``first[d]:first[d + 1]`` are text d's."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.n = len(texts)
        self.buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        if lower:
            self.buf = _LOWER[self.buf]
        self.at = np.cumsum([0] + [len(t) + 1 for t in texts])
        gap = SPACE[self.buf]
        edge = np.diff(gap.view(np.int8), prepend=np.int8(1))
        self.start, self.end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self.doc = np.searchsorted(self.at, self.start, "right") - 1
        self.first = np.searchsorted(self.doc, np.arange(self.n + 1))
        self.hash = np.zeros(0, np.uint64)
        if len(self.start):
            size = self.end - self.start
            place = np.arange(len(self.buf)) - np.repeat(
                np.append(0, self.start), np.diff(np.concatenate(([0], self.start, [len(self.buf)]))))
            place[gap] = 0
            power = np.multiply.accumulate(np.full(int(size.max()) + 1, _STEP))
            value = _BYTE[self.buf] * power[place]
            value[gap] = 0
            self.hash = mix(np.add.reduceat(value, self.start) + size.astype(np.uint64))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of each window of five words."""
        w = self.hash
        if len(w) < SHINGLE:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        last = len(w) - SHINGLE + 1
        total = sum(w[k:last + k] * _PLACE[k] for k in range(SHINGLE))
        at = np.flatnonzero(self.doc[:last] == self.doc[SHINGLE - 1:])
        return at, mix(total[at])

    def shingle_sets(self) -> list[np.ndarray]:
        """Per text the sorted distinct shingle hashes: five-word windows, or
        the whole sequence of a text with fewer words, or none."""
        at, h = self.windows()
        cut = np.searchsorted(self.doc[at], np.arange(self.n + 1))
        out = []
        for d in range(self.n):
            a, b = self.first[d], self.first[d + 1]
            if 0 < b - a < SHINGLE:
                whole = (self.hash[a:b] * _PLACE[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                out.append(mix(np.array([whole], np.uint64)))
            else:
                s = np.sort(h[cut[d]:cut[d + 1]])
                out.append(s[np.append(True, s[1:] != s[:-1])] if len(s) else s)
        return out
