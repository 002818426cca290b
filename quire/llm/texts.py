"""Texts as one byte array per chunk: word bounds, hashes and per-text sums in numpy.

Everything works on UTF-8 bytes. A null text counts as an empty one unless the caller keeps
it apart. Chunks bound the memory of a task whatever the batch size; one text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK = 2 << 20
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


BYTE = mix(np.arange(1, 257, dtype=U))
STEP = U(0x9E3779B97F4A7C15)
BACK = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def table(*spans: tuple[int, int]) -> np.ndarray:
    """Which of the 256 bytes lie in one of the spans."""
    out = np.zeros(256, bool)
    for lo, hi in spans:
        out[lo:hi + 1] = True
    return out


WORD = ~table((0x20, 0x20), (0x09, 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Sums(NamedTuple):
    """Prefix sums of values times powers, and the inverse powers."""

    sums: np.ndarray
    down: np.ndarray


def prefix(values: np.ndarray) -> Sums:
    """What ``ranged`` needs for hashes of ranges of ``values``."""
    n = len(values) + 1
    up, down = np.full(n, STEP), np.full(n, BACK)
    up[0] = down[0] = 1
    up = np.cumprod(up, dtype=U)
    np.cumprod(down, dtype=U, out=down)
    up[1:] = np.cumsum(values * up[:-1], dtype=U)
    up[0] = 0
    return Sums(up, down)


def ranged(of: Sums, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """64-bit hashes of the ranges [lo, hi), equal for equal content anywhere."""
    return mix((of.sums[hi] - of.sums[lo]) * of.down[lo] + (hi - lo).astype(U))


@dataclass
class Chunk:
    """Some texts: ``data`` holds their bytes end to end, text i is [starts[i], ends[i])."""

    first: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    def words(self, member: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the words, and for each text the number of words before it."""
        inside = member[self.data]
        if not len(inside):
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(len(self) + 1, np.int64)
        full = self.ends > self.starts
        begin, end = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        edges = self.starts[full]
        begin[edges] = inside[edges]
        edges = self.ends[full] - 1
        end[edges] = inside[edges]
        lo = np.flatnonzero(begin)
        at = np.append(np.searchsorted(lo, self.starts), len(lo))
        return lo, np.flatnonzero(end) + 1, at

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sums of per-byte flags in each text."""
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[self.ends] - sums[self.starts]


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK) -> Iterator[Chunk]:
    """Chunks of about ``limit`` bytes; a longer text is a chunk of its own."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[column.offset: column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        to = min(to, n)
        base = offsets[at]
        yield Chunk(at, data[base: offsets[to]], offsets[at:to] - base, offsets[at + 1: to + 1] - base)
        at = to


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(keys), bool)
    twice[1:] |= same
    twice[:-1] |= same
    out = np.empty(len(keys), bool)
    out[order] = twice
    return out


def covered(starts: np.ndarray, length: np.ndarray | int, n: int) -> np.ndarray:
    """Which of n places lie in one of the runs."""
    steps = np.bincount(starts, minlength=n + 1) - np.bincount(starts + length, minlength=n + 1)
    return np.cumsum(steps[:n]) > 0


def counts(at: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """Sums of per-word flags, given the number of words before each text."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[at[1:]] - sums[at[:-1]]
