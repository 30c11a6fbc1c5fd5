"""MD5 of many short byte strings at once, in numpy: what SimHash needs of a digest is its first 64 bits."""

from __future__ import annotations

import hashlib
import math

import numpy as np

# Fixed values of RFC 1321: the start state and the rotations; the sine constants come from their rule.
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_ROTATIONS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
_SINES = [np.uint32(int(abs(math.sin(i + 1)) * 2 ** 32)) for i in range(64)]
#: A string of up to 55 bytes is one block with its end mark and length; strings are hashed so many at a time.
ONE_BLOCK, AT_ONCE = 55, 16384
# By the bytes a string has left at one of its 8-byte words (-1: it ended before, 8: more than these): those to keep, and its end mark.
_KEEP = np.array([0, *((1 << 8 * k) - 1 for k in range(9))], dtype=np.uint64)
_MARK = np.array([0, *(0x80 << 8 * k for k in range(8)), 0], dtype=np.uint64)


def _one_block(words: list[np.ndarray | None], n: int) -> np.ndarray:
    """First 8 bytes of the digests, as big-endian numbers, of ``n`` padded blocks given as 16 rows of little-endian words (None: all zero)."""
    a, b, c, d = (np.full(n, v, dtype=np.uint32) for v in _START)
    mix, rotated = np.empty(n, dtype=np.uint32), np.empty(n, dtype=np.uint32)
    for i in range(64):
        turn = i // 16
        if turn == 0:
            k = i
            np.bitwise_xor(c, d, out=mix)
            mix &= b
            mix ^= d
        elif turn == 1:
            k = 5 * i + 1
            np.bitwise_xor(b, c, out=mix)
            mix &= d
            mix ^= c
        elif turn == 2:
            k = 3 * i + 5
            np.bitwise_xor(b, c, out=mix)
            mix ^= d
        else:
            k = 7 * i
            np.invert(d, out=mix)
            mix |= b
            mix ^= c
        mix += a
        mix += _SINES[i]
        if words[k % 16] is not None:
            mix += words[k % 16]
        s = _ROTATIONS[turn][i % 4]
        np.left_shift(mix, np.uint32(s), out=rotated)
        mix >>= np.uint32(32 - s)
        rotated |= mix
        rotated += b
        a, b, c, d, rotated = d, rotated, b, c, a  # the array of the old a is written next
    low, high = a + np.uint32(_START[0]), b + np.uint32(_START[1])
    return (low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)).byteswap()


def md5_prefixes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The first 64 bits (big-endian) of the MD5 of every ``data[start:end]``; long strings go one by one."""
    out = np.empty(len(starts), dtype=np.uint64)
    size = ends - starts
    short = np.flatnonzero(size <= ONE_BLOCK)
    padded = np.append(data, np.zeros(64, dtype=np.uint8))
    from_here = np.ndarray(len(data) + 57, dtype="<u8", buffer=padded, strides=(1,))  # the 8 bytes that start at each byte
    for lo in range(0, len(short), AT_ONCE):
        rows = short[lo:lo + AT_ONCE]
        n, at = size[rows], starts[rows]
        words: list[np.ndarray | None] = [None] * 16
        for k in range(int(n.max()) // 8 + 1):
            left = np.clip(n - 8 * k, -1, 8) + 1
            eight = from_here[np.minimum(at + 8 * k, len(data))]
            eight &= _KEEP[left]
            eight |= _MARK[left]
            words[2 * k], words[2 * k + 1] = eight.astype(np.uint32), (eight >> np.uint64(32)).astype(np.uint32)
        words[14] = (n * 8).astype(np.uint32)
        out[rows] = _one_block(words, len(rows))
    for k in np.flatnonzero(size > ONE_BLOCK):
        out[k] = int.from_bytes(hashlib.md5(data[starts[k]:ends[k]].tobytes()).digest()[:8], "big")
    return out
