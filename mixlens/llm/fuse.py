"""Static 3-wise binary fuse filters (Graf and Lemire, 2022) over unsigned 64-bit keys, in NumPy.

One filter holds one shard of one immutable snapshot; a shard is sized by its caller, so
building needs memory in proportion to the shard, never to the snapshot.
"""

from __future__ import annotations

import math
import struct

import numpy as np

_HEAD = "<QIII"     # seed, segment length, segment count, fingerprint bytes


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + np.uint64(seed)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def _slots(h: np.ndarray, seg: int, count: int):
    """The three slots of each hash, in consecutive segments, and its 8-bit fingerprint."""
    first = (((h >> np.uint64(32)) * np.uint64(seg * count)) >> np.uint64(32)).astype(np.int64)
    mask = seg - 1
    second = (first + seg) ^ ((h >> np.uint64(18)).astype(np.int64) & mask)
    third = (first + 2 * seg) ^ (h.astype(np.int64) & mask)
    mark = ((h ^ (h >> np.uint64(40))) & np.uint64(0xFF)).astype(np.uint8)
    return np.stack([first, second, third], axis=1), mark


def build(keys: np.ndarray) -> bytes:
    """Filter that answers True for every key given (false positives: about 1 in 256).

    Repeated keys count once; no keys give a filter that answers False always.
    """
    keys = np.unique(np.asarray(keys, dtype=np.uint64))
    n = len(keys)
    if n == 0:
        return b""
    seg = 1 << max(2, min(18, int(math.floor(math.log(max(n, 2)) / math.log(3.33) + 2.25))))
    grow = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    for attempt in range(100):
        count = max(1, math.ceil(max(n * grow, 8) / seg) - 2 + attempt // 10)
        seed = (0x9E3779B97F4A7C15 * (attempt + 1)) & 0xFFFFFFFFFFFFFFFF
        slots, mark = _slots(_mix(keys, seed), seg, count)
        rounds = _peel(slots, (count + 2) * seg)
        if rounds is None:
            continue
        cells = np.zeros((count + 2) * seg, dtype=np.uint8)
        for ids, at in reversed(rounds):               # within a round no key touches another's free slot
            cells[at] = mark[ids] ^ cells[slots[ids, 0]] ^ cells[slots[ids, 1]] ^ cells[slots[ids, 2]]
        return struct.pack(_HEAD, seed, seg, count, len(cells)) + cells.tobytes()
    raise RuntimeError("no peelable layout found")


def _peel(slots: np.ndarray, size: int):
    degree = np.bincount(slots.ravel(), minlength=size)
    holds = np.zeros(size, dtype=np.int64)             # xor of the keys' numbers in a slot
    for j in range(3):
        np.bitwise_xor.at(holds, slots[:, j], np.arange(len(slots)))
    free, rounds, left = np.flatnonzero(degree == 1), [], len(slots)
    while len(free):
        ids, pos = np.unique(holds[free], return_index=True)
        rounds.append((ids, free[pos]))
        left -= len(ids)
        touched = slots[ids].ravel()
        np.subtract.at(degree, touched, 1)
        np.bitwise_xor.at(holds, touched, np.repeat(ids, 3))
        touched = np.unique(touched)
        free = touched[degree[touched] == 1]
    return rounds if left == 0 else None


def contains(data: bytes, keys: np.ndarray) -> np.ndarray:
    keys = np.asarray(keys, dtype=np.uint64)
    if not data:
        return np.zeros(len(keys), dtype=bool)
    seed, seg, count, size = struct.unpack_from(_HEAD, data)
    cells = np.frombuffer(data, dtype=np.uint8, count=size, offset=struct.calcsize(_HEAD))
    slots, mark = _slots(_mix(keys, seed), seg, count)
    return (cells[slots[:, 0]] ^ cells[slots[:, 1]] ^ cells[slots[:, 2]]) == mark
