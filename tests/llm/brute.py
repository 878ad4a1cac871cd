"""Plain, quadratic versions of the operators."""

from __future__ import annotations

import re

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def words(text: str | None) -> list[bytes]:
    return [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in WORD.findall((text or "").encode())]


def shingle_set(text: str | None, width: int) -> frozenset:
    found = words(text)
    if len(found) < width:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(tuple(found[i:i + width]) for i in range(len(found) - width + 1))


def near_components(rows: list[tuple], width: int, pct: int = 80) -> dict:
    """{doc_id: (set size, smallest doc_id of the component)} for distinct ids."""
    sets = {d: shingle_set(t, width) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a, i in enumerate(ids):
        for j in ids[a + 1:]:
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= pct * (len(sets[i]) + len(sets[j]) - shared):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return {d: (len(sets[d]), find(d)) for d in sets}


def removed_spans(rows: list[tuple], size: int = 50) -> dict:
    """{doc_id: (bytes, removed, spans, what is left)} when strings that start in a smaller id are removed."""
    seen, out = set(), {}
    for d, text in sorted(rows):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        own = [raw[i:i + size] for i in range(len(raw) - size + 1)]
        for i, s in enumerate(own):
            if s in seen:
                gone[i:i + size] = b"\x01" * size
        seen.update(own)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[d] = (len(raw), sum(gone), spans, bytes(c for c, g in zip(raw, gone) if not g))
    return out
