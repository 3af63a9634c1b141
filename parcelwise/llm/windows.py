"""Anchors of byte windows: the places by which equal windows of a fixed length find each other.

Every window of ``LENGTH`` bytes holds ``SPAN`` grams of ``GRAM`` bytes; its
anchor is the gram with the smallest hash (leftmost on ties). Equal windows
have equal anchors at equal distances, and consecutive windows mostly share
theirs, so a text has about one anchor per 64 bytes.
"""

from __future__ import annotations

import numpy as np

from parcelwise.llm.shingles import _BYTE, _power, mixed

LENGTH = 200
SPAN = 128
GRAM = LENGTH - SPAN + 1


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text number, first window, last window, anchor offset, anchor hash, region hash) of every run of windows with one anchor.

    Offsets are bytes within the text. The region is the bytes that the run's
    windows cover; its hash also covers where the anchor lies in it.
    """
    data = b"".join(texts)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    offsets = np.cumsum(sizes) - sizes
    none = tuple(np.zeros(0, np.int64) for _ in range(4)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    if len(data) < LENGTH or sizes.max() < LENGTH:
        return none
    b = np.frombuffer(data, dtype=np.uint8)
    with np.errstate(over="ignore"):
        total = np.empty(len(b) + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(_BYTE[b] * _power("up", len(b)), dtype=np.uint64, out=total[1:])
        down = _power("down", len(b) + 1)
        grams = mixed((total[GRAM:] - total[:-GRAM]) * down[:len(b) - GRAM + 1])
        # smallest (hash, place) of 128 consecutive grams, by doubling
        best = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        width = 1
        while width < SPAN:
            best = np.minimum(best[:-width], best[width:])
            width *= 2
        place = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)
        step = np.zeros(len(place) + 1, dtype=np.int32)
        whole = sizes >= LENGTH
        step[offsets[whole]] += 1
        stop = offsets[whole] + sizes[whole] - LENGTH + 1
        np.add.at(step, stop, -1)
        windows = np.flatnonzero(np.cumsum(step[:-1]) > 0)
        place = place[windows]
        edge = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1], [True]]))
        first, last, at = windows[edge[:-1]], windows[edge[1:] - 1], place[edge[:-1]]
        region = (total[last + LENGTH] - total[first]) * down[first]
        region = mixed(mixed(region) + ((last - first) * 1024 + (at - first)).astype(np.uint64))
        owner = np.searchsorted(offsets + sizes, first, side="right")
        start = offsets[owner]
        return owner, first - start, last - start, at - start, grams[at], region
