"""Elias-Fano sequences as numpy arrays, read in place from memory-mapped files."""

from __future__ import annotations

import json

import numpy as np
from pyarrow import fs

# Low parts have so many bits at most.
MOST_LOW = 56

_1, _8, _63 = (np.uint64(n) for n in (1, 8, 63))
# The same in each byte of a word.
_EACH = np.uint64(0x0101010101010101)
_TOPS, _PAIRS, _FOURS, _NIBBLES = (_EACH * np.uint64(n) for n in (0x80, 0x55, 0x33, 0x0F))
# Place of the r-th set bit of byte b, from the low end, at 8 * b + r.
_SELECT = np.zeros(256 * 8, np.uint64)
for _byte in range(256):
    _places = [i for i in range(8) if _byte >> i & 1]
    _SELECT[8 * _byte : 8 * _byte + len(_places)] = _places


def _select(words: np.ndarray, before: np.ndarray, which: np.ndarray, clear: bool = False) -> np.ndarray:
    """Place of the bits number ``which`` that are set in ``words``, or that are clear; ``before``
    counts those ahead of each word."""
    at = np.searchsorted(before, which.astype(before.dtype), "right") - 1
    left = (which - before[at].astype(np.int64)).astype(np.uint64)
    word = ~words[at] if clear else words[at]
    # Bits in each byte and those ahead of it: all bytes of a word at once.
    count = word - (word >> _1 & _PAIRS)
    count = (count & _FOURS) + (count >> np.uint64(2) & _FOURS)
    upto = (count + (count >> np.uint64(4)) & _NIBBLES) * _EACH
    passed = ((left * _EACH | _TOPS) - upto) & _TOPS
    shift = np.bitwise_count(passed).astype(np.uint64) * _8
    left -= (upto << _8) >> shift & np.uint64(255)
    place = _SELECT[(word >> shift & np.uint64(255)) * _8 + left]
    return 64 * at + (shift + place).astype(np.int64)


def encode(values: np.ndarray) -> dict[str, np.ndarray]:
    """Arrays that hold unsigned values in rising order, equal ones allowed.

    The high part of a value is a step in unary; the low part is packed, as many bits as make
    the steps about as many as the values.
    """
    values = values.astype("<u8")
    n = len(values)
    top = int(values[-1]) if n else 0
    size = min(MOST_LOW, max((top // max(n, 1)).bit_length() - 1, 0))
    high = (values >> np.uint64(size)).astype(np.int64)
    places = high + np.arange(n)
    n_words = (int(places[-1]) + 2 if n else 1) // 64 + 1
    bits = np.zeros(64 * n_words, np.uint8)
    bits[places] = 1
    words = np.packbits(bits, bitorder="little").view("<u8")
    ones = np.cumsum(np.bitwise_count(words), dtype=np.int64)
    ones = np.concatenate(([0], ones[:-1]))
    kind = "<u4" if 64 * n_words < 1 << 32 else "<u8"
    low = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, count=size, bitorder="little")
    low = np.packbits(low, bitorder="little")
    return {
        "words": words,
        "ones": ones.astype(kind),
        "zeros": (64 * np.arange(n_words) - ones).astype(kind),
        # A word more, as low parts are read two words at a time.
        "low": np.append(low, np.zeros(-len(low) % 8 + 8, np.uint8)).view("<u8"),
        "shape": np.array([n, size, high[-1] if n else -1], "<i8"),
    }


class EliasFano:
    """Values by place, and places by value, for arrays of questions."""

    def __init__(self, arrays: dict[str, np.ndarray]) -> None:
        self.words, self.ones, self.zeros = (np.asarray(arrays[n]) for n in ("words", "ones", "zeros"))
        self.n, self.size, self.top = (int(x) for x in arrays["shape"])
        self.low = np.asarray(arrays["low"])

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.size:
            return np.zeros(len(at), np.uint64)
        bit = at * self.size
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        both = self.low[word] >> shift | self.low[word + 1] << _1 << (_63 - shift)
        return both & np.uint64((1 << self.size) - 1)

    def _run_end(self, begin: np.ndarray) -> np.ndarray:
        """Place of the first clear bit from each place on."""
        rest = ~self.words[begin >> 6] >> (begin & 63).astype(np.uint64)
        end = begin + np.bitwise_count((rest & -rest) - _1)
        beyond = np.flatnonzero(rest == 0)
        if len(beyond):
            word = (begin[beyond] >> 6) + 1
            first = 64 * word - self.ones[word].astype(np.int64)
            end[beyond] = _select(self.words, self.zeros, first, clear=True)
        return end

    def access(self, at: np.ndarray) -> np.ndarray:
        """The values at these places."""
        if not len(at):
            return np.zeros(0, np.uint64)
        high = (_select(self.words, self.ones, at) - at).astype(np.uint64)
        return high << np.uint64(self.size) | self._low(at)

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each value the first place that has it or a larger one, and whether it has it.

        The steps lead to the few places with the value's high part, which are then halved.
        """
        values = values.astype(np.uint64)
        at, equal = np.full(len(values), self.n, np.int64), np.zeros(len(values), bool)
        high = values >> np.uint64(self.size)
        inside = np.flatnonzero(high <= max(self.top, 0)) if self.n else np.zeros(0, np.int64)
        if not len(inside):
            return at, equal
        h, low = high[inside].astype(np.int64), values[inside] & np.uint64((1 << self.size) - 1)
        begin = np.zeros(len(h), np.int64)
        later = h > 0
        begin[later] = _select(self.words, self.zeros, h[later] - 1, clear=True) + 1
        a, end = begin - h, self._run_end(begin) - h
        b = end.copy()
        while (open_ := np.flatnonzero(a < b)).size:
            middle = (a[open_] + b[open_]) // 2
            less = self._low(middle) < low[open_]
            a[open_] = np.where(less, middle + 1, a[open_])
            b[open_] = np.where(less, b[open_], middle)
        at[inside] = a
        hit = a < end
        equal[inside[hit]] = self._low(a[hit]) == low[hit]
        return at, equal


def save(arrays: dict[str, np.ndarray], system: fs.FileSystem, path: str) -> None:
    """One file: a line that says where each array is, then the arrays."""
    place, at = {}, 0
    for name, array in arrays.items():
        place[name] = (at, str(array.dtype), len(array))
        at += -(-array.nbytes // 8) * 8
    head = json.dumps(place).encode()
    with system.open_output_stream(path, compression=None) as file:
        file.write(len(head).to_bytes(8, "little") + head + b" " * (-len(head) % 8))
        for array in arrays.values():
            file.write(array.tobytes() + b"\0" * (-array.nbytes % 8))


def load(system: fs.FileSystem, path: str) -> dict[str, np.ndarray]:
    """The arrays of a file: mapped where the folder is a mounted one, else read."""
    if isinstance(system, fs.LocalFileSystem):
        data = np.memmap(path, np.uint8, "r")
    else:
        with system.open_input_file(path) as file:
            data = np.frombuffer(file.read_buffer(), np.uint8)
    size = int(data[:8].view("<u8")[0])
    place = json.loads(data[8 : 8 + size].tobytes())
    start = 8 + -(-size // 8) * 8
    return {
        name: data[start + at : start + at + n * np.dtype(kind).itemsize].view(kind)
        for name, (at, kind, n) in place.items()
    }


def part(arrays: dict[str, np.ndarray], name: str) -> EliasFano:
    prefix = f"{name}."
    return EliasFano({k.removeprefix(prefix): v for k, v in arrays.items() if k.startswith(prefix)})


def named(name: str, values: np.ndarray) -> dict[str, np.ndarray]:
    return {f"{name}.{k}": v for k, v in encode(values).items()}
