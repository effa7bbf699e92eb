"""Static binary-fuse filter: 3 slots per 64-bit key, 16-bit fingerprints, about 18 bits a key.

Built and read with numpy inside a task. A key that was put in is always found; another one is
found with probability 2^-16.
"""

from __future__ import annotations

import numpy as np

U = np.uint64


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + U(int(seed) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    h ^= h >> U(33)
    h *= U(0xFF51AFD7ED558CCD)
    h ^= h >> U(33)
    h *= U(0xC4CEB9FE1A85EC53)
    h ^= h >> U(33)
    return h


def _layout(n: int) -> tuple[int, int]:
    """Segment length (a power of two) and number of segments that start a key, for ``n`` keys."""
    length = 1 << min(18, max(2, int(np.floor(np.log(max(n, 2)) / np.log(3.33) + 2.25))))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 3)))
    return length, max(1, int(np.ceil(n * factor / length)) - 2)


def _slots(h: np.ndarray, length: int, starts: int) -> np.ndarray:
    """Three slots in three consecutive segments."""
    length, starts = int(length), int(starts)
    first = (((h >> U(32)) * U(starts * length)) >> U(32)).astype(np.int64)
    mask = length - 1
    second = (first + length) ^ ((h >> U(18)).astype(np.int64) & mask)
    third = (first + 2 * length) ^ (h.astype(np.int64) & mask)
    return np.stack([first, second, third])


def _prints(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> U(32))) & U(0xFFFF)).astype(np.uint16)


def build(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, starting segments, fingerprints) of distinct or repeated uint64 keys.

    Peels all slots that hold a single key at once, round by round; another seed is tried when some
    keys cannot be peeled.
    """
    keys = np.unique(np.asarray(keys, dtype=np.uint64))
    n = len(keys)
    length, starts = _layout(n)
    for seed in range(1, 200):
        if seed % 20 == 0:
            starts += 1 + starts // 20
        size = (starts + 2) * length
        h = _mix(keys, seed)
        slots = _slots(h, length, starts)
        count = np.bincount(slots.ravel(), minlength=size)
        owner = np.zeros(size, dtype=np.int64)
        index = np.arange(n, dtype=np.int64)
        for row in slots:
            np.bitwise_xor.at(owner, row, index)
        left, rounds = n, []
        while left:
            single = np.flatnonzero(count == 1)
            if not len(single):
                break
            who, at = np.unique(owner[single], return_index=True)
            rounds.append((who, single[at]))
            for row in slots[:, who]:
                np.subtract.at(count, row, 1)
                np.bitwise_xor.at(owner, row, who)
            left -= len(who)
        if left:
            continue
        prints = np.zeros(size, dtype=np.uint16)
        own = _prints(h)
        for who, at in reversed(rounds):
            a, b, c = slots[:, who]
            prints[at] = 0
            prints[at] = own[who] ^ prints[a] ^ prints[b] ^ prints[c]
        return seed, length, starts, prints.tobytes()
    raise RuntimeError("no seed gives a binary-fuse filter")


def contains(keys: np.ndarray, seed: int, length: int, starts: int, prints: bytes) -> np.ndarray:
    h = _mix(np.asarray(keys, dtype=np.uint64), seed)
    table = np.frombuffer(prints, dtype=np.uint16)
    a, b, c = _slots(h, length, starts)
    return (table[a] ^ table[b] ^ table[c]) == _prints(h)
