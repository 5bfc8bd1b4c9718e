"""Vectorised text primitives shared by the training-data operators.

Texts arrive as Arrow string columns, so a batch already holds one UTF-8 byte
buffer and one offsets array.  Everything here works on those two arrays with
numpy: no per-row Python objects are made.  Nulls count as empty texts.

Hashes are 64-bit: a word is a keyed polynomial over a random table of byte
values (equal words have equal hashes in every process), a window of words is a
second polynomial over the word hashes, both finished by an avalanche mix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_rng = np.random.default_rng(20240607)
BYTE_KEY = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
WORD_BASE = U64(0x9E3779B97F4A7C15)
WINDOW_BASE = U64(0xD1342543DE82EF95)
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_powers: dict[int, np.ndarray] = {}


def powers(base: U64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64; kept and grown by doubling."""
    key = int(base)
    have = _powers.get(key)
    if have is None or len(have) < n:
        size = max(1024, 1 << int(n - 1).bit_length() if n > 1 else 1)
        out = np.full(size, base, dtype=U64)
        out[0] = 1
        have = _powers[key] = np.multiply.accumulate(out)
    return have[:n]


def inverse(base: U64) -> U64:
    """The inverse of an odd number modulo 2 ** 64."""
    return U64(pow(int(base), -1, 2**64))


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values (a bijection)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def segment_sum(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of values[starts[i]:ends[i]] (empty: 0) of ascending, disjoint ranges."""
    total = np.zeros(len(values) + 1, dtype=values.dtype if values.dtype == U64 else np.int64)
    np.cumsum(values, out=total[1:])
    return total[ends] - total[starts]


class Texts:
    """Some texts as one byte array and their offsets."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @classmethod
    def of(cls, column: pa.Array) -> Texts:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = pc.fill_null(column.cast(pa.large_string()), "")
        buffers = column.buffers()
        offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
        return cls(data, offsets)

    @classmethod
    def from_strings(cls, texts: list[str | None]) -> Texts:
        return cls.of(pa.array(texts, type=pa.large_string()))

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def blocks(self, limit: int = 2 << 20) -> Iterator[tuple[int, Texts]]:
        """Runs of whole texts of about ``limit`` bytes (a longer text stands alone), with their first index."""
        at = 0
        while at < len(self):
            to = int(np.searchsorted(self.offsets, self.offsets[at] + limit, side="right")) - 1
            to = min(max(to, at + 1), len(self))
            base = self.offsets[at]
            yield at, Texts(self.data[base : self.offsets[to]], self.offsets[at : to + 1] - base)
            at = to


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a block: byte ranges, hashes and word ranges by text."""

    def __init__(self, texts: Texts, lower: bool = False, hashes: bool = True):
        data = LOWER[texts.data] if lower else texts.data
        inside = np.zeros(len(data) + 1, dtype=bool)
        inside[:-1] = ~SPACE[data]
        before = np.zeros(len(data) + 1, dtype=bool)
        before[1:] = inside[:-1]
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[texts.offsets] = True
        self.starts = np.flatnonzero(inside & (~before | cut))
        self.ends = np.flatnonzero(before & (~inside | cut))
        self.data = data
        self.first = np.searchsorted(self.starts, texts.offsets)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.hash = self._hashes() if hashes else None

    def __len__(self) -> int:
        return len(self.starts)

    def _hashes(self) -> np.ndarray:
        n, out = len(self.starts), np.zeros(len(self.starts), dtype=U64)
        if not n:
            return out
        lengths = self.ends - self.starts
        power = powers(WORD_BASE, int(lengths.max()))
        total = np.concatenate([[0], np.cumsum(lengths)])
        at = 0
        while at < n:  # about a million bytes at a time
            to = max(at + 1, int(np.searchsorted(total, total[at] + (1 << 20))) - 1)
            own = lengths[at:to]
            place = np.arange(total[to] - total[at]) - np.repeat(total[at:to] - total[at], own)
            values = BYTE_KEY[self.data[np.repeat(self.starts[at:to], own) + place]] * power[place]
            out[at:to] = np.add.reduceat(values, total[at:to] - total[at])
            at = to
        return mix(out ^ (lengths.astype(U64) * U64(0xA0761D6478BD642F)))

    def windows(self, k: int, base: U64 = WINDOW_BASE, values: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of k words, by first word, and which of them lie in one text."""
        values = self.hash if values is None else values
        n = len(values) - k + 1
        if n <= 0:
            return np.zeros(0, U64), np.zeros(0, bool)
        total = np.zeros(len(values) + 1, dtype=U64)
        np.cumsum(values * powers(base, len(values)), out=total[1:])
        raw = (total[k:] - total[:-k]) * powers(inverse(base), n)
        return mix(raw), self.doc[:n] == self.doc[k - 1 :]


def sliding_argmin(values: np.ndarray, w: int) -> np.ndarray:
    """Index of the leftmost least value of values[i:i + w], for each i; by doubling spans."""
    at = np.arange(len(values))
    span, best = 1, values
    while span * 2 <= w:
        take = best[span:] < best[:-span]
        at = np.where(take, at[span:], at[:-span])
        best = np.where(take, best[span:], best[:-span])
        span *= 2
    if rest := w - span:
        take = best[rest:] < best[:-rest]
        at = np.where(take, at[rest:], at[:-rest])
    return at
