"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from acreage.llm import spelling as S

SCHEMA = "doc_id long, text string"


def counts_of(rows, every=97):
    counts = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return counts


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, every=97, letters=5, least=3):
    n = {w: c for w, c in counts_of(rows, every).items() if len(w) >= letters and c >= least}
    out, form = {}, {}
    for w in n:
        others = [v for v in n if near(w, v)]
        top = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = top if top is not None and n[top] >= 2 * n[w] else None
        out[w] = [n[w], len(others), form[w], n[form[w]] if form[w] else None]
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w].append(root)
    return out


def table(df):
    rows = df.select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: list(r[1:]) for r in rows}


def texts(seed=0, alphabet="abceé×Z", n=120):
    rng = random.Random(seed)
    pool = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(4, 8))) for _ in range(60)]
    for _ in range(240):  # variants of variants, each rarer than the last
        w, at = rng.choice(pool), rng.randrange(5)
        pool.append(w[:at] + rng.choice(["", rng.choice(alphabet), rng.choice(alphabet) * 2]) + w[at + 1:])
    weights = [1 / (k + 1) for k in range(len(pool))]
    rows = [(i, rng.choice([" ", "-", "9"]).join(rng.choices(pool, weights, k=rng.randrange(0, 90)))) for i in range(n)]
    long = "lorem" * 4000
    return rows + [(200, None), (201, ""), (None, "Marmalade MARMALADE marmalade marmelade marmeladeĀmarmelade"),
                   (7, rows[7][1]), *[(300 + i, f"{long} {long}x {long[1:]}") for i in range(3)]]


@pytest.mark.parametrize("parts,cell,sample", [(1, 20_000, 200_000), (5, 12, 200_000), (3, 3, 60)])
def test_variants_equal_brute_force_for_any_cells(spark, parts, cell, sample):
    rows = texts()
    want = brute(rows, every=7)
    assert sum(w[2] is not None for w in want.values()) > 40 and any(w[4] != w[2] for w in want.values() if w[2])
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("word", "n", "cell", "kind", "root")})
    assert table(S.spelling_variants(df.repartition(parts), every=7, cell=cell, sample=sample)) == want


def test_anagrams_share_a_vector(spark, monkeypatch):
    rng = random.Random(2)
    names = {"".join(rng.sample("abcdefgh", 8)) for _ in range(250)} | {"".join(rng.sample("abcdefgi", 8)) for _ in range(250)}
    rows = [(i, f"{w} {w}" + f" {w}" * rng.randrange(1, 9)) for i, w in enumerate(sorted(names))]
    want = brute(rows)
    assert sum(w[1] for w in want.values()) > 0
    df = spark.createDataFrame(rows, SCHEMA)
    assert table(S.spelling_variants(df, cell=30)) == want
    monkeypatch.setattr(S, "GRID", 100)
    same = [w for w in want if len(w) == 8]
    q, p = S.near_in_cell(same, same, False, False)
    assert sorted(zip(q, p)) == [(i, j) for i, a in enumerate(same) for j, b in enumerate(same) if near(a, b)]


def test_one_edit_reads_letters_in_order():
    words = ["aaaa", "aaab", "abaa", "bbaa", "abab", "baba"]
    for a in words:
        for b in words + ["aaaaa", "aabaa", "ababa", "bbbbb"]:
            one = S.one_edit(S.letters([a], len(a)), S.letters([b], len(b)))
            assert bool(one[0]) == near(a, b), (a, b)


def test_boxes_never_lose_a_near_word():
    rng = np.random.default_rng(1)
    rows = rng.integers(97, 103, (400, 6)).astype(np.uint8)
    changed = rows.copy()
    changed[np.arange(400), rng.integers(0, 6, 400)] = rng.integers(97, 103, 400)
    tree = S.Cells.fit(S.vectors(changed), 5)
    home = {int(r): leaf for leaf, some in tree.place(S.vectors(changed), None) for r in some}
    shown = [(int(r), leaf) for leaf, some in tree.place(S.vectors(rows), S.Queries.start(np.arange(400), np.zeros(400, bool))) for r in some]
    assert {(r, home[r]) for r in home} <= set(shown) and len(shown) == len(set(shown))


def test_no_words(spark):
    assert S.spelling_variants(spark.createDataFrame([], SCHEMA)).count() == 0
    assert S.spelling_variants(spark.createDataFrame([(1, None), (2, "12 , !"), (3, "once upon")], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        S.spelling_variants(spark.createDataFrame([], SCHEMA), ratio=1)
