"""Words and hashes of whole texts, computed with NumPy on Arrow's own buffers.

A word is a run of bytes other than space and \\x09-\\x0D. Nothing here makes a Python object for each word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_ONE = np.uint64(1)
#: Odd bases of the polynomial hashes modulo 2**64.
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64."""
    have = _powers.get(int(base))
    if have is None or len(have) <= n:
        have = np.full(max(n + 1, 1 << 16), base, np.uint64)
        have[0] = _ONE
        have = np.cumprod(have, dtype=np.uint64)
        if n <= 1 << 22:
            _powers[int(base)] = have
    return have


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n+1 offsets of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type) else pa.binary()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(kind)
    _, offs, data = column.buffers()
    width = np.int64 if kind == pa.large_binary() else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offs, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def chunks(offs: np.ndarray, most: int = 1 << 20):
    """Runs (i, j) of rows of about `most` bytes; a longer text is a run of its own."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Words:
    """Word bounds of a run of texts: `start`, `end` in bytes, `bound[i]:bound[i + 1]` the words of text i."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.data, self.offs = data, offs
        inside = ~_WHITE[data]
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        cut = offs[:-1]
        before[cut[cut < len(data)]] = False
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        if len(data):
            last = offs[1:] - 1
            after[last[last >= 0]] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.bound = np.searchsorted(self.start, offs)
        self.count = np.diff(self.bound)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word."""
        return spans(self.data, self.start, self.end, seed)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)


def spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each data[start:end]."""
    base = BASES[seed]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + _ONE) * powers(base, len(data))[: len(data)], out=sums[1:])
    # shifting every span to power 0 keeps equal spans equal
    h = (sums[end] - sums[start]) * inverse_powers(base, len(data))[start]
    return mix(h ^ (end - start).astype(np.uint64) * BASES[1])


def inverse_powers(base: np.uint64, n: int) -> np.ndarray:
    return powers(np.uint64(pow(int(base), -1, 1 << 64)), n)


def windows(h: np.ndarray, bound: np.ndarray, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of each window of k words that lies in one text."""
    n = len(h)
    if n < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    base = BASES[seed]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(h * powers(base, n)[:n], out=sums[1:])
    w = (sums[k:] - sums[:-k]) * inverse_powers(base, n)[: n - k + 1]
    end = np.repeat(bound[1:], np.diff(bound))[: n - k + 1]  # the end of each first word's text
    first = np.flatnonzero(np.arange(n - k + 1) + k <= end)
    return first, mix(w[first])


def minimizers(h: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
    """The positions that hold the leftmost smallest of `width` neighbouring hashes, for runs that start at `first`."""
    return np.unique(chosen(h, first, width))


def chosen(h: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
    """The position of the leftmost smallest of `width` neighbouring hashes, for each run that starts at `first`.

    Hashes count by their upper half, so that equal runs choose the same place wherever they are.
    """
    if not len(first):
        return np.zeros(0, np.int64)
    low = np.uint64(0xFFFFFFFF)
    x = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    if done < width:
        x = np.minimum(x[: len(h) - width + 1], x[width - done :][: len(h) - width + 1])
    return (x[first] & low).astype(np.int64)


def owners(bound: np.ndarray) -> np.ndarray:
    """The number of the text of each item."""
    return np.repeat(np.arange(len(bound) - 1), np.diff(bound))


def covered(n: int, first: np.ndarray, width: int) -> np.ndarray:
    """Which of n items lie in one of the runs of `width` items that start at `first`."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, first, 1)
    np.add.at(step, first + width, -1)
    return np.cumsum(step[:n]) > 0


def ends_of_runs(h: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the places of each hash in a text the first and the last, with numbers that add up to all of them."""
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = mix(h ^ mix(text.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
    n = np.diff(np.append(first, len(h)))
    many = n > 1
    return np.concatenate([order[first], order[(first + n - 1)[many]]]), np.concatenate([np.where(many, n - 1, 1), np.ones(int(many.sum()), np.int64)])


def members(values: np.ndarray, text: np.ndarray, sets: np.ndarray, set_offs: np.ndarray) -> np.ndarray:
    """Which values are in their text's set: set i is sets[set_offs[i]:set_offs[i + 1]]."""
    if not len(sets) or not len(values):
        return np.zeros(len(values), bool)
    tag = lambda t: mix(t.astype(np.uint64) + np.uint64(1))
    known = np.sort(mix(sets.view(np.uint64) ^ tag(owners(set_offs))))
    asked = mix(values.view(np.uint64) ^ tag(text))
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    return known[at] == asked


def lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and offsets of a list<long> column; null is empty."""
    sizes = np.nan_to_num(np.asarray(pa.compute.list_value_length(column).to_numpy(zero_copy_only=False), float)).astype(np.int64)
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.int64), np.concatenate([[0], np.cumsum(sizes)])
