"""Hashed word n-grams of whole texts, vectorised over the bytes of a batch."""

from __future__ import annotations

import numpy as np

SLICE_BYTES = 1 << 20


def _kinds() -> np.ndarray:
    kind = np.full(256, 2, dtype=np.uint8)                     # punctuation
    kind[[32, *range(9, 14)]] = 0                              # white space
    kind[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
    return kind


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def word_hashes(bodies: list[bytes], punctuation: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of the texts, and the number of its text, in order.

    Words are runs of letters, digits and non-ASCII bytes, or (if asked) runs of punctuation;
    A-Z count as a-z.
    """
    buf = np.frombuffer(b"\n".join(bodies).lower(), dtype=np.uint8)
    edges = np.cumsum([len(b) + 1 for b in bodies])
    kind = _kinds()[buf]
    change = np.flatnonzero(np.diff(kind, prepend=np.uint8(0)))
    starts = change[kind[change] != 0 if punctuation else kind[change] == 1]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    ends = np.append(change, len(buf))[np.searchsorted(change, starts, side="right")]
    length = ends - starts
    power = np.full(int(length.max()) + 1, 0x9E3779B97F4A7C15, dtype=np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    before = np.concatenate(([0], np.cumsum(length)[:-1]))
    inside = np.repeat(starts - before, length) + np.arange(length.sum())
    value = (buf[inside].astype(np.uint64) + np.uint64(1)) * power[inside - np.repeat(starts, length)]
    return (_mix(np.add.reduceat(value, before) + length.astype(np.uint64)),
            np.searchsorted(edges, starts, side="right"))


def hashed(bodies: list[bytes], buckets: int):
    """Bucket of every unigram and bigram of the texts, and the number of its text; none spans two texts."""
    one, doc = word_hashes(bodies)
    same = doc[1:] == doc[:-1]
    two = _mix(one[:-1] * np.uint64(0xD6E8FEB86659FD93) + one[1:])[same]
    return ((np.concatenate((one, two)) % np.uint64(buckets)).astype(np.int64),
            np.concatenate((doc, doc[1:][same])))


def slices(bodies: list[bytes], most: int = SLICE_BYTES):
    """Runs of consecutive texts of about ``most`` bytes (one text at least)."""
    at, size = 0, 0
    for i, b in enumerate(bodies):
        if size and size + len(b) > most:
            yield at, i
            at, size = i, 0
        size += len(b)
    if at < len(bodies):
        yield at, len(bodies)
