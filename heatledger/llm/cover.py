"""Difference covers of byte positions, and names of byte strings."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import xxhash

#: Perfect difference sets: every residue of the period is a difference of two members.
COVERS = {
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
    73: (0, 1, 3, 7, 15, 31, 36, 54, 63),
    91: (0, 1, 3, 9, 27, 49, 56, 61, 77, 81),
}
MIX = np.uint64(0xD6E8FEB86659FD93)


def period_for(length: int) -> int:
    """Largest period whose samples have at least three names within every window of ``length`` that holds them first; 3 at least."""
    return max([v for v in COVERS if 4 * v - 1 <= length], default=3)


def scrambled(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits whose high bits depend on all bits."""
    h = np.uint64(32)
    x = (x ^ (x >> h)) * MIX
    return (x ^ (x >> h)) * MIX


def byte_names(data: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """64-bit names of data[start : start + size] for each start: words of eight bytes, taken in one after the other by products and shifts.

    Equal bytes have equal names; the reverse is very likely only.
    """
    out = np.full(len(starts), size, np.uint64)
    width = min(size, 8)
    # eight bytes from every position on; the last word overlaps the one before where the size is no multiple of eight
    words = np.ndarray((max(0, len(data) - 7),), "<u8", np.ascontiguousarray(data), strides=(1,)) if width == 8 else data
    for at in [*range(0, size - width, width), size - width] if width == 8 else range(size):
        out = (out ^ words[starts + at]) * MIX
        out ^= out >> np.uint64(32)
    return scrambled(out)


def digests(data: np.ndarray, starts: Sequence[int], ends: Sequence[int], salts: Sequence[int]) -> np.ndarray:
    """Cryptographic digests of 16 bytes of data[start:end] and a salt, a row of two longs each; equal ones stand for equal bytes."""
    view = memoryview(np.ascontiguousarray(data))
    every = b"".join(hashlib.blake2b(view[a:b], digest_size=16, salt=s.to_bytes(8, "little")).digest() for a, b, s in zip(starts, ends, salts, strict=True))
    return np.frombuffer(every, np.int64).reshape(-1, 2)


def sketches(data: np.ndarray, starts: Sequence[int], ends: Sequence[int], salts: Sequence[int]) -> np.ndarray:
    """Hashes of 64 bits of data[start:end] and a salt: equal bytes have equal ones, the reverse is very likely only."""
    view = memoryview(np.ascontiguousarray(data))
    return np.array([xxhash.xxh3_64_intdigest(view[a:b], s) for a, b, s in zip(starts, ends, salts, strict=True)], np.uint64).view(np.int64)
