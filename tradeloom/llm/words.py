"""Words and hashes of Arrow text columns, without one Python object per word.

A word is ``[^\\x20\\x09-\\x0D]+``.  Those six bytes never occur inside a
multi-byte UTF-8 character, so words are found on the raw bytes.  Hashes are
functions of the bytes alone: equal words and equal runs of words get equal
hashes in every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Text bytes worked on at once; a longer single text is worked on alone.
SLICE_BYTES = 1 << 20
_U = np.uint64
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_NO_LETTER = np.ones(256, dtype=bool)
_NO_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (xor-shift and multiply)."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(29)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(32)
    return x


# A prime, so that sums of powers have no short relations (modulo 2^64 some simple sequences would be equal).
_PRIME = (1 << 61) - 1
_P = _U(_PRIME)
_SEEDS = (_U(0x9E3779B97F4A7C15), _U(0xD1B54A32D192ED03))
_BASES = (0x1F0A3C5E7B9D2468, 0x0B5F7D3A91C6E824)
# Longer words are hashed one by one.
_LONG = 256


def _fold(x: np.ndarray) -> np.ndarray:
    """Values below the prime for any 64-bit ones."""
    x = (x & _P) + (x >> _U(61))
    return np.where(x >= _P, x - _P, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime, from halves of 30 and 31 bits."""
    a_high, a_low = a >> _U(31), a & _U((1 << 31) - 1)
    b_high, b_low = b >> _U(31), b & _U((1 << 31) - 1)
    middle = a_low * b_high + a_high * b_low
    return _fold(
        _U(2) * a_high * b_high + (middle >> _U(30)) + ((middle & _U((1 << 30) - 1)) << _U(31)) + _fold(a_low * b_low)
    )


class _Powers:
    """Powers of a base and of its inverse modulo the prime, grown by doubling."""

    def __init__(self, base: int):
        self.factors = {"up": base, "down": pow(base, -1, _PRIME)}
        self.up = np.ones(1, dtype=_U)
        self.down = np.ones(1, dtype=_U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while n > len(self.up):
            for name, factor in self.factors.items():
                have = getattr(self, name)
                next_ = _U(pow(factor, len(have), _PRIME))
                setattr(self, name, np.concatenate([have, _times(have, next_)]))
        return self.up[:n], self.down[:n]


_POWERS = [_Powers(base) for base in _BASES]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
    """Hash of the bytes ``data[start:end]`` for every pair: eight bytes at a time are mixed in."""
    length = end - start
    out = mix(length.astype(_U) + _SEEDS[lane])
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    octets = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    going = np.flatnonzero((length > 0) & (length <= _LONG))
    done = 0
    while len(going):
        left = length[going] - done
        unused = _U(8) * (_U(8) - np.minimum(left, 8).astype(_U))
        chunk = octets[start[going] + done] & (~_U(0) >> unused)
        out[going] = mix(out[going] * _SEEDS[1 - lane] ^ chunk)
        going, done = going[left > 8], done + 8
    for i in np.flatnonzero(length > _LONG).tolist():
        out[i] = xxhash.xxh64_intdigest(data[start[i] : end[i]], int(_SEEDS[lane]))
    return out


@dataclass
class Words:
    """Words of a few texts: byte ranges, and the first word of each text."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lane: int = 0) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end, lane)

    def bytes_of(self, text: int) -> list[bytes]:
        a, b = self.first[text], self.first[text + 1]
        if a == b:
            return []
        return self.data[self.start[a] : self.end[b - 1]].tobytes().split()


def run_hashes(words: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
    """Hash of the word sequences ``words[start:end]``: 61 bits a lane, from one prefix sum modulo a prime."""
    up, down = _POWERS[lane].upto(len(words) + 1)
    terms = _times(_fold(words), up[: len(words)])
    # Halves are summed apart, so that no sum overflows.
    high, low = np.zeros(len(words) + 1, dtype=_U), np.zeros(len(words) + 1, dtype=_U)
    np.cumsum(terms >> _U(32), out=high[1:])
    np.cumsum(terms & _U(0xFFFFFFFF), out=low[1:])
    prefix = _fold(_times(_fold(high), np.full(1, 1 << 32, dtype=_U)) + _fold(low))
    return mix(_times(_fold(prefix[end] + _P - prefix[start]), down[start]) ^ mix((end - start).astype(_U)))


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and the offset of each text; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(at) or at[-1] == at[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def find_words(texts: pa.Array, lower: bool = False, separator: np.ndarray = _SEPARATOR) -> Words:
    """Words of every text; ``lower`` folds the letters A-Z only."""
    data, at = raw(texts)
    if lower:
        data = data + np.where((data >= 65) & (data <= 90), np.uint8(32), np.uint8(0))
    inside = ~separator[data]
    edge = at[:-1][at[:-1] < len(data)]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    before[edge] = False
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    after[edge[edge > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(data, start, end, np.searchsorted(start, at))


def letter_runs(texts: pa.Array, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Hashes of the runs of letters, in lower case, and the first run of each text.

    Bytes beyond ASCII count as letters.  For every length in ``prefixes`` also
    the hashes of the first so many bytes; 0 where a run is not longer.
    """
    found = find_words(texts, lower=True, separator=_NO_LETTER)
    begins = []
    for n in prefixes:
        longer = found.end - found.start > n
        end = np.where(longer, found.start + n, found.start)
        begins.append(np.where(longer, span_hashes(found.data, found.start, end), _U(0)))
    return found.hashes(), found.first, begins


def token_hashes(tokens: list[str]) -> np.ndarray:
    """What ``letter_runs`` gives for single tokens."""
    return letter_runs(pa.array(tokens, pa.string()))[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that no piece but a single long row has over ``limit`` text bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def shingle_ranges(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word ranges of all ``k``-word shingles, and the first shingle of each text.

    A text of fewer words has one shingle, the whole sequence; a text without
    words has none.
    """
    counts = np.diff(first)
    per = np.where(counts == 0, 0, np.maximum(counts - k + 1, 1))
    bounds = np.concatenate([[0], np.cumsum(per)])
    start = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - first[:-1], per)
    end = start + np.minimum(k, np.repeat(counts, per))
    return start, end, bounds
