"""Hashed word shingles of whole texts, computed for many texts at once."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[0x41:0x5B] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_STEPS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64
)

#: Longer texts are hashed in parts of about so many bytes, cut between words.
PART_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, one to one."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_powers = np.cumprod(np.full(64, _BASE, np.uint64))


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if n > len(_powers):
        _powers = np.cumprod(np.full(2 * n, _BASE, np.uint64))
    return _powers


def _parts(data: bytes) -> list[bytes]:
    """A long text in parts; no word is cut."""
    parts, begin = [], 0
    while len(data) - begin > PART_BYTES:
        cut = next((i for i in range(begin + PART_BYTES, len(data)) if _SPACE[data[i]]), len(data))
        parts.append(data[begin:cut])
        begin = cut
    parts.append(data[begin:])
    return parts


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered, and words per text."""
    hashes, counts = [], np.zeros(len(texts), np.int64)
    pending: list[bytes] = []
    owners: list[int] = []

    def flush() -> None:
        if pending:
            found, each = _hash_parts(pending)
            hashes.append(found)
            np.add.at(counts, owners, each)
            pending.clear()
            owners.clear()

    held = 0
    for owner, text in enumerate(texts):
        for part in _parts(text):
            if held + len(part) > PART_BYTES:
                flush()
                held = 0
            pending.append(part)
            owners.append(owner)
            held += len(part) + 1
    flush()
    return np.concatenate(hashes) if hashes else np.empty(0, np.uint64), counts


def _hash_parts(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    whole = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    borders = np.cumsum([len(p) + 1 for p in parts])
    place = np.flatnonzero(~_SPACE[whole])
    if not len(place):
        return np.empty(0, np.uint64), np.zeros(len(parts), np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1] + 1]))
    sizes = np.diff(np.append(first, len(place)))
    inside = np.arange(len(place)) - np.repeat(first, sizes)
    values = (_LOWER[whole[place]] + np.uint64(1)) * _powers_to(int(sizes.max()))[inside]
    found = mix(np.add.reduceat(values, first) + mix(sizes.astype(np.uint64)))
    owner = np.searchsorted(borders, place[first], "right")
    return found, np.bincount(owner, minlength=len(parts))


def shingle_sets(texts: Sequence[str | None], width: int = 5) -> list[np.ndarray]:
    """For each text the distinct hashes of its shingles, in order.

    A shingle is ``width`` consecutive words; a text of fewer words, but not none,
    has one shingle of all of them. Hashes have 64 bits: two different shingles of
    the same two texts are taken for one with a chance of about 1e-13 for texts of a
    thousand words.
    """
    words, counts = word_hashes([(text or "").encode() for text in texts])
    ends = np.cumsum(counts)
    windows = max(len(words) - width + 1, 0)
    joined = np.full(windows, width, np.uint64)
    for j in range(width):
        joined += mix(words[j : j + windows] * _STEPS[j % len(_STEPS)] + np.uint64(j))
    joined = mix(joined)
    sets = []
    for begin, end in zip((ends - counts).tolist(), ends.tolist()):
        n = end - begin
        if n >= width:
            sets.append(np.unique(joined[begin : end - width + 1]))
        elif n:
            one = np.array([n], np.uint64)
            for j in range(n):
                one += mix(words[begin + j : begin + j + 1] * _STEPS[j % len(_STEPS)] + np.uint64(j))
            sets.append(mix(one))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets
