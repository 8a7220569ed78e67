"""Vectorised 64-bit hashes of the words and substrings of UTF-8 buffers."""

from __future__ import annotations

import numpy as np

#: Odd multipliers of the hashes (fixed values).
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)
#: Bytes that end a word: space and tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the word (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * MIX_A
    x ^= x >> np.uint64(27)
    x *= MIX_B
    x ^= x >> np.uint64(31)
    return x


#: A pseudo-random 64-bit value for each byte.
BYTE = mix((np.arange(1, 257, dtype=np.uint64)) * BASE)


def word_spans(buf: np.ndarray, is_space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of bytes that are not in is_space."""
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = ~is_space[buf]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


#: The bytes of a block that count where so many are left.
_LEFT = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of buf[start:end] for each pair; equal bytes hash alike wherever they are.

    Blocks of eight bytes are spread with a key of their place in the span and summed, so that no pattern of
    bytes cancels out; spans of one length up to eight bytes never share a hash.
    """
    size = ends - starts
    n = np.maximum((size + 7) >> 3, 1)
    first = np.cumsum(n) - n
    at = np.arange(int(n.sum())) - np.repeat(first, n)
    place = np.repeat(starts, n) + 8 * at
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(buf) + 1, "<u8", padded, strides=(1,))
    block = eight[place] & _LEFT[np.minimum(np.repeat(ends, n) - place, 8)]
    spread = mix(block ^ mix((at + 1).astype(np.uint64) * BASE))
    return mix(np.add.reduceat(spread, first) + size.astype(np.uint64) * MIX_A) if len(n) else np.zeros(0, np.uint64)


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of each n consecutive word hashes."""
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = out * BASE + words[k : len(words) - n + 1 + k]
    return mix(out)


def blocks(sizes, limit: int):
    """Ranges [i, j) of consecutive items whose sizes sum to about limit, one item at least."""
    i = total = 0
    for j, size in enumerate(sizes):
        if total and total + size > limit:
            yield i, j
            i, total = j, 0
        total += size
    if i < len(sizes):
        yield i, len(sizes)
