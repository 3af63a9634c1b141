"""Word n-gram sets of texts as sorted 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(0x5EED)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
#: A random number for every byte value at every one of the first REACH places of a word.
REACH = 64
_PLACED = _rng.integers(0, 1 << 64, REACH * 256, dtype=np.uint64)
# rolling hashes of windows of one length (windows.py)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    """Powers 0..n-1 of the base or of its inverse, modulo 2**64."""
    if len(_powers[kind]) < n:
        base = _BASE if kind == "up" else _INVERSE
        steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        _powers[kind] = np.cumprod(steps, dtype=np.uint64)
    return _powers[kind][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start offset, hash) of every word of ``data``.

    A word's hash mixes the sum of one random number per byte, drawn for the
    byte and its place, and its length. (A polynomial modulo 2^64 would give
    some structured words of 1,024 letters one value for every base.)
    """
    b = np.frombuffer(data, dtype=np.uint8)
    word = np.concatenate([[False], ~_SPACE[b], [False]])
    edge = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edge[0::2], edge[1::2]
    length = ends - starts
    until = np.cumsum(length)
    place = np.arange(until[-1] if len(until) else 0) - np.repeat(until - length, length)
    value = _PLACED[((place & (REACH - 1)) << 8) | b[word[1:-1]]]
    far = place >= REACH
    if far.any():
        value[far] = mixed(value[far] + (place[far] >> 6).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
    return starts, mixed(total[until] - total[until - length] + length.astype(np.uint64))


def shingle_sets(texts: list[bytes], k: int = 5) -> list[np.ndarray]:
    """For each text (bytes, already lower-cased) its distinct k-word shingles as sorted hashes.

    A text of fewer than ``k`` words is one shingle, its whole sequence; a
    text without words has the empty set.
    """
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):  # about 2 MB at once
        end, size = at, 0
        while end < len(texts) and (end == at or size < (2 << 20)):
            size += len(texts[end]) + 1
            end += 1
        group = texts[at:end]
        starts, h = word_hashes(b"\n".join(group))
        offsets = np.cumsum([0] + [len(t) + 1 for t in group])
        first = np.searchsorted(starts, offsets)
        with np.errstate(over="ignore"):
            n = len(h)
            acc = np.zeros(max(0, n - k + 1), dtype=np.uint64)
            for j in range(k if n >= k else 0):
                acc += h[j: n - k + 1 + j] * _STEP[j]
            acc = mixed(acc)
            for a, z in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                if z - a >= k:
                    out.append(np.unique(acc[a: z - k + 1]))
                elif z > a:
                    few = (h[a:z] * _STEP[8: 8 + z - a]).sum(dtype=np.uint64) + np.uint64(z - a)
                    out.append(mixed(np.array([few], dtype=np.uint64)))
                else:
                    out.append(np.zeros(0, dtype=np.uint64))
        at = end
    return out


def lowered(text: str | None) -> bytes:
    """UTF-8 bytes with A-Z in lower case."""
    return (text or "").encode("utf-8", "replace").lower()
