"""Texts of Arrow batches as byte arrays, and their words, for numpy code inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one piece of a batch holds at most, unless a single text is longer.
PIECE_BYTES = 500_000

_P = 0x9E3779B97F4A7C55  # odd, hence invertible modulo 2**64
_P_INVERSE = pow(_P, -1, 2**64)

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    """base**0 … base**(n-1) modulo 2**64; kept for the next piece."""
    known = _powers.get(name)
    if known is None or len(known) < n:
        known = np.full(max(n, PIECE_BYTES + 1), base, np.uint64)
        known[0] = 1
        known = np.cumprod(known)
        if n <= 4 * PIECE_BYTES:
            _powers[name] = known
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def pieces(batch: pa.RecordBatch, text: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most ``limit`` bytes of text, or a single longer one."""
    sizes = batch.column(text)
    _, offsets = text_bytes(sizes)
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each begins (and the last ends)."""
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offsets, kind, len(column) + 1, column.offset * kind().itemsize).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """The words of a piece: bytes (A to Z in lower case if ``lower``), starts, ends, texts and hashes.

    A word is a run of bytes other than blank and 0x09 to 0x0D inside one text. ``hash`` is a
    polynomial of its bytes modulo 2**64, mixed.
    """

    def __init__(self, column: pa.Array, lower: bool = True):
        raw, self.offsets = text_bytes(column)
        self.n_texts = len(self.offsets) - 1
        self.data = LOWER[raw] if lower else raw
        n = len(raw)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = ~_BLANK[raw]
        self.inside = inside[1:-1]
        begins, stops = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        cuts = self.offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < n)]
        begins[cuts] |= inside[1:-1][cuts]
        stops[cuts - 1] |= inside[1:-1][cuts - 1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(stops) + 1
        self.text = np.searchsorted(self.offsets, self.starts, side="right") - 1
        self.counts = np.bincount(self.text, minlength=self.n_texts)
        #: Where the words of each text begin among all words.
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        terms = (self.data.astype(np.uint64) + np.uint64(1)) * _power("up", _P, len(self.data))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
        down = _power("down", _P_INVERSE, len(self.data))
        return mix((sums[self.ends] - sums[self.starts]) * down[self.starts])

    def runs(self, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hashes of the runs of words from ``first`` to before ``stop``; empty runs have 0."""
        n = len(self.hash) + 1
        sums = np.zeros(n, np.uint64)
        np.cumsum(self.hash * _power("up", _P, n)[:-1], out=sums[1:])
        return (sums[stop] - sums[first]) * _power("down", _P_INVERSE, n)[first]

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def hash_word(word: bytes) -> int:
    """The hash of one word as ``Words`` computes it."""
    total, power = 0, 1
    for byte in word:
        total = (total + (byte + 1) * power) % 2**64
        power = power * _P % 2**64
    return int(mix(np.array([total], np.uint64))[0])
