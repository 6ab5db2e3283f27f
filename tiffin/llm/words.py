"""Words and hashes of words, computed for a batch of texts at once."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = " \t\n\x0b\x0c\r"  # what separates words, and nothing else does
_MULT = np.uint64(0x9E3779B97F4A7C15)
TILE = 1 << 14  # values worked on at a time where several passes go over them


def utf8(text: str | None) -> bytes:
    """The bytes of a text; NULL is empty."""
    return text.encode("utf-8", "surrogatepass") if text else b""


def values(column: pa.Array, most: int = 1 << 22) -> Iterator[str | bytes | None]:
    """The texts of a column one by one; those of about ``most`` bytes, one at least, are Python objects at a time."""
    total = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + most, "right")))
        yield from column.slice(a, b - a).to_pylist()
        a = b


def give_back() -> None:
    """Give memory that is free in this process back to the system. A Python worker stays for later tasks, and what it
    holds meanwhile is missing to the executor."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit over all output bits (the splitmix finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word in an array of bytes. Texts of a batch are joined by a space."""
    inside = np.ones(len(data) + 2, dtype=bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of words: eight bytes at a time, as many steps as the longest word needs.

    Equal words have equal hashes. They find candidates only; whoever compares words compares the words.
    """
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    length = (end - start).astype(np.int64)
    out = length.astype(np.uint64) * _MULT
    alive = np.arange(len(start))
    at = start.astype(np.int64)
    left = length
    while len(alive):
        keep = np.minimum(left, 8).astype(np.uint64)
        lane = eight[at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - keep * np.uint64(8)))
        out[alive] = mix((out[alive] ^ lane) * _MULT + keep)
        go = left > 8
        alive, at, left = alive[go], at[go] + 8, left[go] - 8
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling, in parts that stay in the processor's cache."""
    out = np.empty(max(0, len(values) - width + 1), dtype=values.dtype)
    for a in range(0, len(out), TILE):
        part = values[a : a + TILE + width - 1]
        span = 1
        while span * 2 <= width:
            part = np.minimum(part[:-span], part[span:])
            span *= 2
        if span < width:
            part = np.minimum(part[: len(part) - (width - span)], part[width - span :])
        out[a : a + TILE] = part
    return out
