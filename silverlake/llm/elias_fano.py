"""Elias-Fano sequences over flat buffers, searched many values at a time.

A non-decreasing sequence of n numbers below u keeps the low floor(log2(u / n)) bits of each packed side by
side, and the rest as a bit vector with a one for each number and a zero for each step of the high part. A
count of the ones before each 64-bit word lets a place be found without reading what is before. All
parts are views of one buffer, such as a memory-mapped file; nothing is unpacked when it is opened.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

import numpy as np

WORD = np.uint64(64)
ONE = np.uint64(1)


def _u64(x: np.ndarray | int) -> np.ndarray:
    return np.asarray(x).astype(np.uint64)


def _or(words: np.ndarray, at: np.ndarray, bits: np.ndarray) -> None:
    """Sets ``bits`` in the words ``at``, which do not decrease."""
    if len(at):
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        words[at[first]] |= np.bitwise_or.reduceat(bits, first)


def encode(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """The parts of the sequence of sorted ``values``, all below ``universe``."""
    values = _u64(values)
    n = len(values)
    low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
    mask = (1 << low_bits) - 1
    low = np.zeros(n * low_bits // 64 + 2, np.uint64)
    if low_bits and n:
        bit = _u64(np.arange(n)) * _u64(low_bits)
        at, shift, part = (bit >> _u64(6)).astype(np.int64), bit & _u64(63), values & _u64(mask)
        _or(low, at, part << shift)
        over = shift + _u64(low_bits) > WORD
        _or(low, at[over] + 1, part[over] >> (WORD - shift[over]))
    places = (values >> _u64(low_bits)).astype(np.int64) + np.arange(n)
    size = (n + (universe >> low_bits) + 1) // 64 + 1
    high = np.zeros(size, np.uint64)
    _or(high, places >> 6, ONE << _u64(places & 63))
    ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)])
    return {"n": np.array([n, low_bits], np.int64), "low": low, "high": high, "ones": ones}


class EliasFano:
    def __init__(self, parts: Mapping[str, np.ndarray]):
        self.n, self.low_bits = (int(x) for x in parts["n"])
        self.low, self.high, self.ones = parts["low"], parts["high"], parts["ones"]
        self.zeros = None

    def access(self, i: np.ndarray) -> np.ndarray:
        """The numbers at places ``i``."""
        i = np.asarray(i, np.int64)
        word = np.searchsorted(self.ones, i, side="right") - 1
        bit = _select(self.high[word], i - self.ones[word])
        return _u64(word * 64 + bit - i) << _u64(self.low_bits) | self._low(i)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        bit = _u64(i) * _u64(self.low_bits)
        at, shift = (bit >> _u64(6)).astype(np.int64), bit & _u64(63)
        first, second = self.low[at] >> shift, self.low[at + 1] << ((WORD - shift) & _u64(63))
        return (first | np.where(shift > 0, second, _u64(0))) & _u64((1 << self.low_bits) - 1)

    def _alike(self, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places first <= i < last of the numbers whose high part is ``high`` (as int64)."""
        k = high - 1  # the zero that ends the part before; it is followed by the ones of this part
        if self.zeros is None:
            self.zeros = np.arange(len(self.ones)) * 64 - self.ones
        word = np.clip(np.searchsorted(self.zeros, k, side="right") - 1, 0, len(self.high) - 1)
        bit = _select(~self.high[word], np.maximum(k - self.zeros[word], 0))
        at = np.where(k < 0, 0, word * 64 + bit + 1)
        first = at - high
        # Ones from there to the next zero: within the word, and on from word to word while it is full.
        count = self._run(at)
        open_ = np.flatnonzero((count == 64 - (at & 63)) & (at >> 6 < len(self.high) - 1))
        while len(open_):
            more = self._run(at[open_] + count[open_])
            count[open_] += more
            next_ = at[open_] + count[open_]
            open_ = open_[(more == 64) & (next_ >> 6 < len(self.high))]
        return first, np.minimum(first + count, self.n)

    def _run(self, at: np.ndarray) -> np.ndarray:
        """How many ones follow each other from the bit ``at`` on, up to the end of its word."""
        shift = _u64(at & 63)
        off = ~(self.high[at >> 6] >> shift)
        ones = np.bitwise_count((off & (~off + ONE)) - ONE).astype(np.int64)
        return np.minimum(ones, 64 - (at & 63))

    def successor(
        self, x: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None
    ) -> np.ndarray:
        """The place of the first number >= x, looked for among the places first <= i < last.

        ``last`` (the end) if there is none.
        """
        return self._search(x, first, last)[0]

    def _search(
        self, x: np.ndarray, first: np.ndarray | None, last: np.ndarray | None
    ) -> tuple[np.ndarray, np.ndarray]:
        """The successor's place, and where the numbers with the high part of x end."""
        x = _u64(x)
        lo, end = self._alike((x >> _u64(self.low_bits)).astype(np.int64))
        wanted = x & _u64((1 << self.low_bits) - 1)
        if first is not None:
            lo, end = np.clip(lo, first, last), np.clip(end, first, last)
        hi = end.copy()
        active = np.flatnonzero(lo < hi)
        while len(active):
            middle = (lo[active] + hi[active]) >> 1
            less = self._low(middle) < wanted[active]
            lo[active[less]] = middle[less] + 1
            hi[active[~less]] = middle[~less]
            active = active[lo[active] < hi[active]]
        return lo, end

    def find(
        self, x: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None
    ) -> np.ndarray:
        """The place of x, or -1."""
        if not self.n:
            return np.full(len(x), -1, np.int64)
        x = _u64(x)
        place, end = self._alike((x >> _u64(self.low_bits)).astype(np.int64))
        wanted = x & _u64((1 << self.low_bits) - 1)
        if first is not None:
            place, end = np.clip(place, first, last), np.clip(end, first, last)
        # High parts are equal between the two places, so only low parts are compared; a single number needs no search.
        active = np.flatnonzero(end - place > 1)
        lo, hi, low = place[active], end[active], wanted[active]
        while len(active):
            middle = (lo + hi) >> 1
            less = self._low(middle) < low
            lo, hi = np.where(less, middle + 1, lo), np.where(less, hi, middle)
            place[active] = lo
            more = np.flatnonzero(lo < hi)
            if len(more) < len(active):
                active, lo, hi, low = active[more], lo[more], hi[more], low[more]
        some = np.flatnonzero(place < end)
        found = some[self._low(place[some]) == wanted[some]]
        out = np.full(len(place), -1, np.int64)
        out[found] = place[found]
        return out


_BYTES = _u64(0x0101010101010101)
_HIGH = _u64(0x8080808080808080)
_in_byte = np.zeros((256, 8), np.int64)  # the place of each one of a byte
for _byte in range(256):
    _ones = [i for i in range(8) if _byte >> i & 1]
    _in_byte[_byte, : len(_ones)] = _ones


def _select(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The place of the ``rank``-th one (from 0) in each word."""
    rank = _u64(rank)
    sums = words - ((words >> ONE) & _u64(0x5555555555555555))
    sums = (sums & _u64(0x3333333333333333)) + ((sums >> _u64(2)) & _u64(0x3333333333333333))
    sums = ((sums + (sums >> _u64(4))) & _u64(0x0F0F0F0F0F0F0F0F)) * _BYTES  # ones up to each byte
    before = np.bitwise_count(((rank * _BYTES | _HIGH) - sums) & _HIGH)  # bytes that end before the one
    shift = _u64(np.minimum(before, 7)) << _u64(3)
    rank = rank - ((sums << _u64(8)) >> shift & _u64(255))
    byte = words >> shift & _u64(255)
    return shift.astype(np.int64) + _in_byte.ravel()[(byte << _u64(3) | rank & _u64(7)).astype(np.int64)]


# ---------------------------------------------------------------- buffers of named arrays


def pack(arrays: Mapping[str, np.ndarray]) -> bytes:
    """Named arrays in one buffer: length of the header, the header, and the arrays at multiples of 8."""
    chunks, index, at = [], {}, 0
    for name, array in arrays.items():
        data = np.ascontiguousarray(array).tobytes()
        index[name] = (array.dtype.str, at, len(array))
        chunks.append(data + bytes(-len(data) % 8))
        at += len(chunks[-1])
    header = json.dumps(index).encode()
    header += b" " * (-len(header) % 8)
    return b"".join([np.array([len(header)], "<u8").tobytes(), header, *chunks])


def unpack(buffer: np.ndarray) -> dict[str, np.ndarray]:
    """Views of the arrays; ``buffer`` is an array of bytes, as of a memory-mapped file."""
    length = int(buffer[:8].view("<u8")[0])
    body = buffer[8 + length :]
    index = json.loads(buffer[8 : 8 + length].tobytes())
    return {
        name: body[at : at + n * np.dtype(kind).itemsize].view(kind) for name, (kind, at, n) in index.items()
    }


def prefixed(name: str, parts: Mapping[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {f"{name}.{k}": v for k, v in parts.items()}


def opened(name: str, arrays: Mapping[str, np.ndarray]) -> EliasFano:
    return EliasFano({k: arrays[f"{name}.{k}"] for k in ("n", "low", "high", "ones")})
