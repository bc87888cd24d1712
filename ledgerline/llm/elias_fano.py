"""Elias-Fano sequences in numpy, and files of named arrays that are mapped into memory."""

from __future__ import annotations

import json
import uuid
from functools import cached_property, lru_cache

import numpy as np
from pyarrow import fs

_U = np.uint64


def _pack(values: np.ndarray, bits: int) -> np.ndarray:
    """Numbers of ``bits`` bits each, one after the other, in 64-bit words; one more word so that reads may overlap."""
    if bits == 0:
        return np.zeros(1, _U)
    rows = -(-len(values) // 64)
    padded = np.zeros(rows * 64, _U)
    padded[: len(values)] = values
    padded = padded.reshape(rows, 64)
    words = np.zeros((rows, bits), _U)
    for column in range(64):
        at, shift = divmod(column * bits, 64)
        words[:, at] |= padded[:, column] << _U(shift)
        if shift + bits > 64:
            words[:, at + 1] |= padded[:, column] >> _U(64 - shift)
    return np.concatenate([words.reshape(-1), np.zeros(1, _U)])


def _unpack(words: np.ndarray, bits: int, size: int) -> np.ndarray:
    """The first ``size`` numbers that ``_pack`` wrote."""
    if bits == 0:
        return np.zeros(size, _U)
    rows = -(-size // 64)
    words = words[: rows * bits].reshape(rows, bits)
    values = np.zeros((rows, 64), _U)
    for column in range(64):
        at, shift = divmod(column * bits, 64)
        values[:, column] = words[:, at] >> _U(shift)
        if shift + bits > 64:
            values[:, column] |= words[:, at + 1] << _U(64 - shift)
    values &= _U((1 << bits) - 1)
    return values.reshape(-1)[:size]


#: Place of each set bit in each byte.
_IN_BYTE = np.array([[*[i for i in range(8) if byte >> i & 1], *[0] * (8 - byte.bit_count())] for byte in range(256)],
                    np.int64).reshape(-1)
_EACH = 0x0101010101010101
#: So many numbers with equal high bits are searched by guesses.
_MANY = 32


def _select(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the set bit number ``rank`` (from 0) in each word. Bits are counted up to each of the eight bytes at once."""
    words, rank = words.astype(_U), rank.astype(_U)
    sums = words - ((words >> _U(1)) & _U(0x55 * _EACH))
    sums = (sums & _U(0x33 * _EACH)) + ((sums >> _U(2)) & _U(0x33 * _EACH))
    sums = ((sums + (sums >> _U(4))) & _U(0x0F * _EACH)) * _U(_EACH)
    passed = ((rank * _U(_EACH)) | _U(0x80 * _EACH)) - sums  # bytes up to which there are no more than ``rank``
    place = np.bitwise_count(passed & _U(0x80 * _EACH)).astype(_U) << _U(3)
    rank = rank - (((sums << _U(8)) >> place) & _U(0xFF))
    byte = (words >> place) & _U(0xFF)
    return place.astype(np.int64) + _IN_BYTE[((byte << _U(3)) | rank).astype(np.int64)]


class EliasFano:
    """Non-decreasing numbers below 2**63 in about 2 + log2(range / n) bits each.

    Low bits are packed; high bits are written in unary. ``ones`` counts the set bits before each word, so that both
    the n-th number and the numbers with given high bits are found without a scan. All methods take arrays.
    """

    def __init__(self, size: int, bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.size, self.bits, self.low, self.high, self.ones = size, bits, low, high, ones

    @cached_property
    def zeros(self) -> np.ndarray:
        return np.arange(len(self.high), dtype=np.int64) * 64 - self.ones

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(_U)
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, ((top + 1) // max(n, 1)).bit_length() - 1)
        flags = np.zeros(((n + (top >> bits) + 2 + 63) // 64) * 64, np.uint8)
        flags[(values >> _U(bits)).astype(np.int64) + np.arange(n)] = 1
        high = np.packbits(flags, bitorder="little").view(_U)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)[:-1]])
        return cls(n, bits, _pack(values & _U((1 << bits) - 1), bits), high, ones)

    def arrays(self, name: str) -> dict[str, np.ndarray]:
        return {f"{name}.shape": np.array([self.size, self.bits], np.int64), f"{name}.low": self.low,
                f"{name}.high": self.high, f"{name}.ones": self.ones}

    @classmethod
    def mapped(cls, arrays: dict[str, np.ndarray], name: str) -> EliasFano:
        size, bits = map(int, arrays[f"{name}.shape"])
        return cls(size, bits, *(arrays[f"{name}.{part}"] for part in ("low", "high", "ones")))

    def _low(self, index: np.ndarray) -> np.ndarray:
        if self.bits == 0:
            return np.zeros(len(index), _U)
        place = index.astype(_U) * _U(self.bits)
        word, shift = (place >> _U(6)).astype(np.int64), place & _U(63)
        joined = (self.low[word] >> shift) | ((self.low[word + 1] << (_U(63) - shift)) << _U(1))
        return joined & _U((1 << self.bits) - 1)

    def _place(self, index: np.ndarray) -> np.ndarray:
        """Place of the one bit ``index`` in the high bits."""
        word = np.searchsorted(self.ones, index, "right") - 1
        return word * 64 + _select(self.high[word], index - self.ones[word])

    def get(self, index: np.ndarray) -> np.ndarray:
        """Numbers at ``index``."""
        return ((self._place(index) - index) << self.bits) | self._low(index).astype(np.int64)

    def get_two(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers at ``index`` and right behind it. The next one bit is mostly in the same word."""
        place = self._place(index)
        after, next_ = place + 1, index + 1
        rest = self.high[after >> 6] >> (after & 63).astype(_U)
        following = after + np.bitwise_count(~rest & (rest - _U(1)))
        if len(far := np.flatnonzero(rest == 0)):
            following[far] = self._place(next_[far])
        return (((place - index) << self.bits) | self._low(index).astype(np.int64),
                ((following - next_) << self.bits) | self._low(next_).astype(np.int64))

    def all(self) -> np.ndarray:
        """All numbers."""
        place = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))
        return ((place - np.arange(self.size)) << self.bits) | _unpack(self.low, self.bits, self.size).astype(np.int64)

    def _zero(self, number: np.ndarray) -> np.ndarray:
        """Place of the zero bit ``number`` (from 0) in the high bits."""
        word = np.searchsorted(self.zeros, number, "right") - 1
        return word * 64 + _select(~self.high[word], number - self.zeros[word])

    def _search(self, found: np.ndarray, same: np.ndarray, size: np.ndarray, low: np.ndarray) -> None:
        """Move ``found``, where ``size`` numbers with equal high bits begin, to the first one with low bits of ``low`` or
        more; ``same`` tells whether they are equal. Among many numbers two steps of three guess the place from the values
        at either end, as low bits are spread evenly there."""
        alone = np.flatnonzero(size == 1)
        there, want = self._low(found[alone]), low[alone]
        found[alone] += there < want
        same[alone] = there == want
        for open_, many in ((np.flatnonzero((size > 1) & (size < _MANY)), False), (np.flatnonzero(size >= _MANY), True)):
            lo, want, equals, step = found[open_], low[open_], np.zeros(len(open_), bool), 0
            hi = lo + size[open_]
            least, most = np.zeros(len(open_), _U), np.full(len(open_), 1 << self.bits, _U)
            while len(open_):
                if many and step % 3 < 2:
                    middle = lo + ((want - least) / np.maximum(most - least, _U(1)) * (hi - lo)).astype(np.int64)
                    middle = np.minimum(middle, hi - 1)
                else:
                    middle = (lo + hi) >> 1
                there = self._low(middle)
                less = there < want
                lo, hi = np.where(less, middle + 1, lo), np.where(less, hi, middle)
                equals = np.where(less, equals, there == want)
                if many:
                    least, most = np.where(less, there, least), np.where(less, most, there)
                more = lo < hi
                done = ~more
                ended = open_[done]
                found[ended], same[ended] = lo[done], equals[done]
                open_, lo, hi, want, equals = open_[more], lo[more], hi[more], want[more], equals[more]
                if many:
                    least, most, step = least[more], most[more], step + 1

    def successor(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each value the index of the first number that is not smaller, and whether it is equal."""
        index, equal = np.full(len(values), self.size, np.int64), np.zeros(len(values), bool)
        if not self.size:
            return index, equal
        most = int(self.ones[-1] + np.bitwise_count(self.high[-1:])[0])
        last = len(self.high) * 64 - most - 1  # zeros are numbered up to here
        high = values >> self.bits
        inside = None
        if len(high) and high.max() > last:
            inside = np.flatnonzero(high <= last)
            high, values = high[inside], values[inside]
        low = values.astype(_U) & _U((1 << self.bits) - 1)
        first = np.zeros(len(high), np.int64)  # where numbers with these high bits begin: behind the zero before
        later = slice(None) if len(high) and high.min() > 0 else np.flatnonzero(high)
        first[later] = self._zero(high[later] - 1) + 1
        rest = ~self.high[first >> 6] >> (first & 63).astype(_U)
        size = np.bitwise_count(~rest & (rest - _U(1))).astype(np.int64)  # ones up to the next zero
        if len(far := np.flatnonzero(rest == 0)):
            size[far] = self._zero(high[far]) - first[far]
        found, same = first - high, size > 0
        if self.bits:
            self._search(found, same, size, low)
        if inside is None:
            return found, same
        index[inside], equal[inside] = found, same
        return index, equal


def write_arrays(folder: str, name: str, arrays: dict[str, np.ndarray]) -> str:
    """One file of arrays; it gets its name when it is complete, and a repeated task replaces it by an equal one."""
    files, inner = fs.FileSystem.from_uri(folder)
    files.create_dir(inner, recursive=True)
    index, at = {}, 0
    for key, array in arrays.items():
        index[key] = [at, array.dtype.str, len(array)]
        at += -(-array.nbytes // 64) * 64
    head = json.dumps(index).encode()
    draft = f"{inner}/.{uuid.uuid4().hex}"
    with files.open_output_stream(draft, compression=None) as out:
        out.write(len(head).to_bytes(64, "little") + head + bytes(-len(head) % 64))
        for array in arrays.values():
            out.write(np.ascontiguousarray(array).tobytes() + bytes(-array.nbytes % 64))
    files.move(draft, f"{inner}/{name}")
    return f"{folder}/{name}"


@lru_cache(4096)
def mapped_arrays(path: str) -> dict[str, np.ndarray]:
    """Arrays of a file, mapped into memory where the folder is mounted, else read."""
    files, inner = fs.FileSystem.from_uri(path)
    if isinstance(files, fs.LocalFileSystem):
        data = np.asarray(np.memmap(inner, np.uint8, "r"))
    else:
        with files.open_input_file(inner) as file:
            data = np.frombuffer(file.read_buffer(), np.uint8)
    size = int.from_bytes(data[:64].tobytes(), "little")
    first = 64 + -(-size // 64) * 64
    arrays = {}
    for key, (at, kind, length) in json.loads(data[64 : 64 + size].tobytes()).items():
        dtype = np.dtype(kind)
        arrays[key] = data[first + at : first + at + length * dtype.itemsize].view(dtype)
    return arrays
