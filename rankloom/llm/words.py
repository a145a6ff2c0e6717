"""Words and word shingles of many texts at once, as 64-bit hashes.

Words are runs of anything but the six ASCII white space characters, A-Z lower-cased.
"""

from __future__ import annotations


import numpy as np

from rankloom.llm.common import worker_cache

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_ORDER = np.array([0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                   0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@worker_cache(1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        powers = np.full(size, base, np.uint64)
        powers[0] = 1
        out.append(np.cumprod(powers, dtype=np.uint64))
    return out[0], out[1]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of all texts in order, words of each text)."""
    return hashes_and_endings(texts, 0)[:2]


def hashes_and_endings(texts: list[str], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``word_hashes`` and a hash of the last ``length`` bytes of every word, or of a shorter word whole."""
    parts = [t.encode() for t in texts]
    raw = np.frombuffer((b"\n".join(parts) + b"\n").lower(), np.uint8)
    ends = np.cumsum(np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts)))
    inside = np.zeros(len(raw) + 1, np.int8)
    inside[1:] = ~_WHITE[raw]
    steps = np.diff(inside)
    starts, stops = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    up, down = _powers(1 << max(20, (len(raw) + 1).bit_length()))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    hashes = mix((sums[stops] - sums[starts]) * down[starts])
    counts = np.diff(np.searchsorted(starts, ends), prepend=0)
    last = np.zeros(len(stops), np.uint64)
    for i in range(1, length + 1):
        last = last * np.uint64(257) + np.where(stops - i >= starts, raw[stops - i] + np.uint64(1), np.uint64(0))
    return hashes, counts, mix(last)


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """Sorted different shingles of ``size`` words of each text; fewer words make one shingle, none make no shingle."""
    hashes, counts = word_hashes(texts)
    joined = np.zeros(max(len(hashes) - size + 1, 0), np.uint64)
    for i in range(size):
        joined += hashes[i : i + len(joined)] * _ORDER[i]
    joined = mix(joined)
    out = []
    ends = np.cumsum(counts)
    for end, n in zip(ends.tolist(), counts.tolist()):
        if n >= size:
            out.append(np.unique(joined[end - n : end - size + 1]))
        elif n:
            some = hashes[end - n : end]
            short = np.add.reduce(some * _ORDER[:n], dtype=np.uint64) + np.uint64(n)
            out.append(mix(np.array([short], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
