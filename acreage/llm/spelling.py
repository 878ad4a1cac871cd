"""Groups of spelling variants: words one edit apart, found by k-d trees over letter-count vectors.

One edit changes few letter counts: a replacement takes one from a letter and adds one to another, an
insertion adds one to a letter. So the near words of a word lie within L1 distance two of its vector, and
within one of it if they are longer. Words are dealt to the cells of one tree per length, whose planes are
fitted on a bounded sample of the words; every word is a point of one cell, and a query of all cells whose
box lies near enough, in the tree of its own length and in that of the next. Each cell grows its tree
further, passes all its queries down at once, prunes by boxes, and compares letters in order in the leaves.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from acreage.llm.common import seeded, slices, stage

#: Runs of letters; text is lower-cased in A-Z before.
RUN = re.compile("[a-zÀ-ÿ]+")
#: Letter number of each Latin-1 byte: a-z, then U+00C0 to U+00FF.
LETTERS = 26 + 64
LETTER = np.zeros(256, np.int64)
LETTER[97:123] = np.arange(26)
LETTER[192:256] = np.arange(26, LETTERS)
#: Words of a task held before they are sent on.
HELD = 500_000
#: Bytes of text a worker takes up at once, bytes of words of one cell, and of pairs compared at once.
SLICE, CELL_BYTES, PAIR_BYTES = 4 << 20, 64 << 20, 32 << 20
#: Points of a leaf, and comparisons of a leaf up to which all its queries meet all its points.
LEAF, GRID = 16, 1 << 16


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", every: int = 97) -> DataFrame:
    """(word, n): runs of letters with A-Z lower-cased, counted over all texts.

    Let h be the CRC-32 of `<key>:<run>` in UTF-8. Where `every` divides h, the run lacks its code point
    h % length, which may leave the empty word. Null texts have no runs; a null key is written as nothing.
    """
    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(text).cast("binary").alias("body"))

    def run(batches):
        held: Counter = Counter()
        for batch in slices(batches, "body", SLICE):
            for name, raw in zip(batch.column("key").to_pylist(), batch.column("body").to_pylist()):
                start = zlib.crc32(f"{name}:".encode())
                for word, n in Counter(RUN.findall((raw or b"").lower().decode())).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                    held[word] += n
            if len(held) >= HELD:
                yield counted(held)
                held = Counter()
        if held:
            yield counted(held)

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def counted(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])


def letters(words: list[str], size: int) -> np.ndarray:
    """Latin-1 bytes of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), size)


def vectors(rows: np.ndarray) -> np.ndarray:
    """How often each letter stands in each row."""
    at = np.arange(len(rows))[:, None] * LETTERS + LETTER[rows]
    return np.bincount(at.ravel(), minlength=len(rows) * LETTERS).reshape(len(rows), LETTERS).astype(np.int32)


def plane(points: np.ndarray) -> tuple[int, int] | None:
    """The letter and count (at most: left, more: right) that halve the points best; None if all are alike."""
    low, high = points.min(axis=0), points.max(axis=0)
    if (low == high).all():
        return None
    best = None
    for cut in (low, low + 1, (low + high) // 2):
        off = np.where((cut < high) & (cut >= low), np.abs((points <= cut).mean(axis=0) - 0.5), 1.0)
        d = int(off.argmin())
        if best is None or off[d] < best[0]:
            best = (off[d], d, int(cut[d]))
    return best[1], best[2]


@dataclass
class Queries:
    """Queries on their way down: row numbers, and the letters in which a near word is known to have one more or less."""

    row: np.ndarray
    more: np.ndarray
    less: np.ndarray

    @staticmethod
    def start(rows: np.ndarray, longer: np.ndarray) -> Queries:
        """Words sought among those of their own length may lack a letter; sought among `longer` ones, only gain one."""
        return Queries(rows, np.full(len(rows), -1), np.where(longer, -2, -1))

    def split(self, value: np.ndarray, d: int, cut: int) -> tuple[Queries, Queries]:
        """The queries that can have near words with at most `cut` of letter d, and with more; `value` is each one's count."""
        known = (self.more == d) | (self.less == d)
        value = value + (self.more == d) - (self.less == d)
        out = []
        for free, edge, side in ((value <= cut, value == cut + 1, "less"), (value > cut, value == cut, "more")):
            cross = edge & ~known & (getattr(self, side) == -1)
            into = np.flatnonzero(free | cross)
            part = Queries(self.row[into], self.more[into], self.less[into])
            setattr(part, side, np.where(cross[into], d, getattr(part, side)))
            out.append(part)
        return out[0], out[1]


@dataclass
class Cells:
    """The upper part of the tree of one length: planes, children, and of each leaf its first cell and its parts."""

    planes: list[tuple[int, int]] = field(default_factory=list)
    children: list[tuple[int, int]] = field(default_factory=list)
    parts: dict[int, int] = field(default_factory=dict)

    @staticmethod
    def fit(sample: np.ndarray, room: float) -> Cells:
        """Cells for at most `room` rows of the sample; alike rows that exceed it make a cell of several parts."""
        cells = Cells()

        def grow(rows: np.ndarray) -> int:
            node = len(cells.planes)
            cells.planes.append((-1, 0))
            cells.children.append((-1, -1))
            found = plane(rows) if len(rows) > max(1.0, room) else None
            if found is None:
                cells.parts[node] = max(1, int(np.ceil(len(rows) / room)))
            else:
                cells.planes[node] = found
                left = rows[:, found[0]] <= found[1]
                cells.children[node] = (grow(rows[left]), grow(rows[~left]))
            return node

        grow(sample)
        return cells

    def place(self, points: np.ndarray, queries: Queries | None) -> list[tuple[int, np.ndarray]]:
        """(leaf, rows) of the rows of `points` as points, or of `queries` over them as queries."""
        out, open_ = [], [(0, queries or np.arange(len(points)))]
        while open_:
            node, here = open_.pop()
            rows = here.row if queries else here
            if not len(rows):
                continue
            d, cut = self.planes[node]
            if d < 0:
                out.append((node, rows))
                continue
            value = points[rows, d]
            sides = here.split(value, d, cut) if queries else (rows[value <= cut], rows[value > cut])
            open_ += list(zip(self.children[node], sides))
        return out


def halves(rows: np.ndarray, short: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first short // 2 letters and of the last short - short // 2 ones.

    Of two words one edit apart, `short` letters the shorter one, one of the two is the same."""
    head = short // 2
    tail = short - head
    by = seeded(121, max(head, tail, 1))
    return ((rows[:, :head].astype(np.uint64) + 1) @ by[:head],
            (rows[:, rows.shape[1] - tail:].astype(np.uint64) + 1) @ by[:tail])


def met(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all pairs of equal values."""
    order = np.argsort(second, kind="stable")
    low, high = (np.searchsorted(second[order], first, side) for side in ("left", "right"))
    n = high - low
    at = np.arange(int(n.sum())) + np.repeat(low - (np.cumsum(n) - n), n)
    return np.repeat(np.arange(len(first)), n), order[at]


def one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether the words of each row are one replacement, or one insertion, apart."""
    n = short.shape[1]
    if long.shape[1] == n:
        return (short != long).sum(axis=1) == 1
    ahead, behind = short != long[:, :n], (short != long[:, 1:])[:, ::-1]
    head, tail = (np.where(x.any(axis=1), x.argmax(axis=1), n) for x in (ahead, behind))
    return head + tail >= n


def near_in_cell(points: list[str], queries: list[str], longer: bool, second: bool) -> tuple[np.ndarray, np.ndarray]:
    """Numbers (query, point) of all near words of a cell; with `longer` the points have one letter more.

    `second` cells hold the points and queries that share a last half and find those pairs only that share no first one."""
    size = len(points[0])
    own, theirs = letters(points, size), letters(queries, size - longer)
    where, what = vectors(own), vectors(theirs)
    first_p, last_p = halves(own, size - longer)
    first_q, last_q = halves(theirs, size - longer)
    found, step = [], max(1, PAIR_BYTES // size)

    def check(q: np.ndarray, p: np.ndarray) -> None:
        for a in range(0, len(q), step):
            i, j = q[a:a + step], p[a:a + step]
            same = one_edit(theirs[i], own[j])
            found.append((i[same], j[same]))

    def compare(p: np.ndarray, q: np.ndarray) -> None:
        if len(p) * len(q) <= GRID:
            heads = first_q[q][:, None] == first_p[p][None, :]
            tails = last_q[q][:, None] == last_p[p][None, :]
            i, j = np.nonzero(tails & ~heads if second else heads | tails)
            check(q[i], p[j])
            return
        i, j = met(last_q[q], last_p[p])
        apart = first_q[q[i]] != first_p[p[j]]
        check(q[i[apart]], p[j[apart]])
        if not second:
            i, j = met(first_q[q], first_p[p])
            check(q[i], p[j])

    open_ = [(np.arange(len(own)), Queries.start(np.arange(len(theirs)), np.full(len(theirs), longer)))]
    while open_:
        p, q = open_.pop()
        if not len(q.row):
            continue
        cut = plane(where[p]) if len(p) > LEAF else None
        if cut is None:
            compare(p, q.row)
            continue
        left = where[p, cut[0]] <= cut[1]
        sides = q.split(what[q.row, cut[0]], *cut)
        open_ += [(p[left], sides[0]), (p[~left], sides[1])]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def fit_cells(words: DataFrame, cell: int, sample: int) -> dict[int, Cells]:
    """Trees of cells by word length, fitted on about `sample` words that a hash chooses; all go to the driver."""
    total = words.count()
    share = max(1, total // sample)
    drawn: dict[int, list[str]] = {}
    for r in words.where(F.pmod(F.xxhash64("word"), F.lit(share)) == 0).select("word").collect():
        drawn.setdefault(len(r[0]), []).append(r[0])
    return {size: Cells.fit(vectors(letters(some, size)), min(cell, max(1, CELL_BYTES // size)) / share)
            for size, some in drawn.items()}


def dealt(words: DataFrame, trees: dict[int, Cells]) -> DataFrame:
    """Rows (length, cell, part, role, word, n) of each word: a point ('p') once, a query ('q' among words of its own
    length, 's' among those one letter longer) of each cell that can hold near words."""
    one = Cells.fit(np.zeros((0, LETTERS), np.int32), 1.0)

    def rows_of(tree: Cells, size: int, role: str, names: list[str], counts: np.ndarray):
        own = letters(names, len(names[0]))
        points = vectors(own)
        everyone = np.arange(len(names))
        queries = None if role == "p" else Queries.start(everyone, np.full(len(names), role == "s"))
        # points meet queries of both kinds, whose halves are cut at different places
        kinds = (("q", size), ("s", size - 1)) if role == "p" else ((role, len(names[0])),)
        for leaf, rows in tree.place(points, queries):
            parts = tree.parts[leaf]
            for kind, short in kinds:
                if parts == 1:
                    keys = [np.zeros(len(rows), np.int64)]
                else:  # words of a part share their first half, or (numbers from `parts` on) their last
                    first, last = halves(own[rows], short)
                    keys = [(first % np.uint64(parts)).astype(np.int64), (last % np.uint64(parts)).astype(np.int64) + parts]
                for key in keys:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(rows), size)), pa.array(np.full(len(rows), leaf)), pa.array(key),
                        pa.array(np.where(key >= parts, f"{kind}2", kind) if parts > 1 else [kind] * len(rows)),
                        pa.array([role == "p"] * len(rows)),
                        pa.array([names[i] for i in rows]), pa.array(counts[rows])],
                        ["length", "cell", "part", "kind", "point", "word", "n"])

    def run(batches):
        for batch in slices(batches, "word", SLICE):
            names, counts = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            sizes = np.array([len(w) for w in names])
            for size in np.unique(sizes).tolist():
                some = np.flatnonzero(sizes == size)
                chosen = [names[i] for i in some]
                for role, at in (("p", size), ("q", size), ("s", size + 1)):
                    yield from rows_of(trees.get(at, one), at, role, chosen, counts[some])

    return words.mapInArrow(run, "length long, cell long, part long, kind string, point boolean, word string, n long")


def near_words(placed: DataFrame) -> DataFrame:
    """(word, n_near, best): per word and cell how many near words it has there, and (-n, word) of the best."""
    schema = "word string, n_near long, best struct<less: long, word: string>"

    def search(table: pa.Table) -> pa.Table:
        kind, names = table.column("kind")[0].as_py(), table.column("word").to_pylist()
        n, point = table.column("n").to_numpy(), table.column("point").to_numpy(zero_copy_only=False)
        p, q = np.flatnonzero(point), np.flatnonzero(~point)
        i = j = np.zeros(0, np.int64)
        if len(p) and len(q):
            i, j = near_in_cell([names[x] for x in p], [names[x] for x in q], kind[0] == "s", kind[1:] == "2")
            i, j = q[i], p[j]
        if kind[0] == "s":
            i, j = np.concatenate([i, j]), np.concatenate([j, i])
        rank = np.empty(len(names), np.int64)
        rank[np.array(sorted(range(len(names)), key=lambda x: (-n[x], names[x])), np.int64)] = np.arange(len(names))
        order = np.lexsort((rank[j], i))
        i, j = i[order], j[order]
        who, at, many = np.unique(i, return_index=True, return_counts=True)
        best = pa.StructArray.from_arrays([pa.array(-n[j[at]]), pa.array([names[x] for x in j[at]], pa.string())], ["less", "word"])
        return pa.table([pa.array([names[x] for x in who], pa.string()), pa.array(many, pa.int64()), best], ["word", "n_near", "best"])

    found = placed.groupBy("length", "cell", "part", "kind").applyInArrow(search, schema)
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of rows (word, form): the end of the path of forms, whose counts double at each step.

    Every round doubles the length of the paths that are followed; each is written to the shared folder."""
    paths, moved = stage(links.select("word", F.col("form").alias("root")), "forms"), True
    while moved:
        ahead = paths.select(F.col("word").alias("root"), F.col("root").alias("next"))
        nearer = paths.select("word", "root").join(ahead, "root", "left")
        paths = stage(nearer.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        moved = not paths.where("moved").isEmpty()
    return paths.select("word", "root")


def spelling_variants(
    docs: DataFrame, key: str = "doc_id", text: str = "text", every: int = 97, least_letters: int = 5,
    least: int = 3, ratio: int = 2, cell: int = 20_000, sample: int = 200_000,
) -> DataFrame:
    """One row per word of at least `least_letters` code points and `least` occurrences: word, n, n_near, form, form_n, root.

    Words are those of `word_counts`. Two are near if one inserted, deleted or replaced code point makes one
    of the other. The form of a word is its near word of largest n, of equal ones the first in code-point
    order, if that n is at least `ratio` times (more than once) the word's own; else null. The root is
    reached from the word along forms. Every word is indexed and searched, however many share a length or
    letters: only the planes that deal words to tasks come from a sample of about `sample` words (the number of planes
    is that of the words over `cell`). Rows that repeat are counted each; null texts have no words; other
    columns of `docs` are not read; an empty table gives an empty result.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their words, or paths need not end")
    counts = word_counts(docs, key, text, every)
    words = stage(counts.where((F.char_length("word") >= least_letters) & (F.col("n") >= least)), "words")
    near = near_words(dealt(words, fit_cells(words, cell, sample)))
    joined = words.join(near, "word", "left")
    more = -F.col("best.less")
    chosen = more >= ratio * F.col("n")
    formed = stage(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(chosen, F.col("best.word")).alias("form"), F.when(chosen, more).alias("form_n")), "near")
    ends = roots(formed.where("form IS NOT NULL"))
    return formed.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
