"""Words of many texts at once: 64-bit hashes from bytes, without a Python object per word."""

from __future__ import annotations

from functools import cache

import numpy as np

from acreage.llm.common import mix, seeded

#: Bytes worked on at once; a longer word makes a longer piece.
PIECE = 1 << 20


@cache
def byte_values() -> np.ndarray:
    """A random 64-bit value per byte; A-Z have those of a-z, white space has 0."""
    values = mix(seeded(11, 256))
    values[65:91] = values[97:123]
    values[[9, 10, 11, 12, 13, 32]] = 0
    return values


@cache
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base modulo 2^64, and of its inverse."""
    base = int(seeded(12, 1)[0])
    out = []
    for b in (base, pow(base, -1, 2**64)):
        with np.errstate(over="ignore"):
            p = np.full(n, np.uint64(b))
            p[0] = 1
            out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def pieces(space: np.ndarray, edge: np.ndarray, size: int):
    """Ranges of about `size` bytes that cut no word."""
    start, n = 0, len(space)
    while start < n:
        stop = min(n, start + size)
        if stop < n:
            cuts = np.flatnonzero(space[start:stop] | edge[start + 1:stop + 1])
            if len(cuts):
                stop = start + int(cuts[-1]) + 1
            else:
                after = np.flatnonzero(space[stop:] | edge[stop:n])
                stop = stop + int(after[0]) if len(after) else n
        yield start, stop
        start = stop


def word_hashes(data: np.ndarray, offsets: np.ndarray, size: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and the n + 1 offsets of the texts among them.

    A word is a run of bytes other than 0x20 and 0x09 to 0x0D, with A-Z as a-z.
    """
    values = byte_values()
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    blank = space[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    hashes, begins = [], []
    for a, b in pieces(blank, edge, size):
        inside = ~blank[a:b]
        first = inside.copy()
        first[1:] &= blank[a:b - 1] | edge[a + 1:b]
        last = inside.copy()
        last[:-1] &= blank[a + 1:b] | edge[a + 1:b]
        start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
        n = PIECE if b - a <= PIECE else 1 << int(b - a).bit_length()
        up, down = powers(n)
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum(values[data[a:b]] * up[:b - a], out=total[1:])
        found = (total[stop] - total[start]) * down[start]
        found += (stop - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        hashes.append(mix(found))
        begins.append(start + a)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(begins), offsets).astype(np.int64)


def shingles(words: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` words per text and their n + 1 offsets; a shorter text is one run."""
    counts = np.diff(ends)
    runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    out_ends = np.zeros(len(ends), np.int64)
    np.cumsum(runs, out=out_ends[1:])
    at = np.arange(out_ends[-1]) + np.repeat(ends[:-1] - out_ends[:-1], runs)
    length = np.repeat(np.minimum(counts, width), runs)
    made = np.zeros(len(at), np.uint64)
    for j in range(width):
        there = at + j if j == 0 else np.where(length > j, at + j, at)
        nxt = mix(made * np.uint64(0xD1342543DE82EF95) + words[there] + np.uint64(j + 1))
        made = nxt if j == 0 else np.where(length > j, nxt, made)
    return made, out_ends


def distinct_sets(hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes per text, and their offsets."""
    sets = [np.unique(hashes[a:b]) for a, b in zip(ends[:-1], ends[1:])]
    out = np.zeros(len(ends), np.int64)
    np.cumsum([len(s) for s in sets], out=out[1:])
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), out
