"""Rolling fingerprints of substrings."""

from __future__ import annotations

import numpy as np

#: Longest piece of text that is worked on at a time.
CHUNK = 1 << 20
#: Odd base of the fingerprint and its inverse modulo 2**64.
BASE = 0xD1342543DE82EF95
INVERSE = pow(BASE, -1, 1 << 64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


def _powers(base: int, number: int) -> np.ndarray:
    values = np.full(number, base, np.uint64)
    values[0] = 1
    return np.cumprod(values, dtype=np.uint64)


#: Values that stand for the bytes, and powers of the base and of its inverse.
BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_UP, _DOWN = _powers(BASE, CHUNK + 4096), _powers(INVERSE, CHUNK + 4096)


class Prints:
    """Fingerprints of the substrings of a piece of text, at most a little longer than a chunk."""

    def __init__(self, data: np.ndarray) -> None:
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTES[data] * _DOWN[: len(data)], out=self.sums[1:])

    def at(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * _UP[starts] + (ends - starts).astype(np.uint64))
