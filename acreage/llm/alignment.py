"""Alignment of two tokenizers over the same texts, by lockstep merging.

A byte-level vocabulary (A) and a piece vocabulary (B) cut the same bytes, a space and the text, into tokens. The
documents of a batch are merged side by side: one state vector holds a pointer into the A and the B tokens of every
document; each step links the tokens pointed at, advances the pointer whose token ends first, or both where
they end together, which is a cut, and drops the documents that are done. Long documents enter as several
lanes that begin where a probe finds both token rows to end, so that the steps of a batch stay few.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from acreage.llm.common import flat_bytes, slices, stage

#: Bytes of text a worker takes up at once, tokens of a lane, and probes at the end of each lane.
SLICE, LANE, PROBES = 1 << 20, 128, 6
#: Pairs a task holds before it sends their counts on, and pairs of one broadcast table (16 bytes each).
HELD, BLOCK = 1 << 21, 1 << 21
#: How the published byte-level vocabulary cuts texts before merging (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Lead byte from which letters may be classed otherwise by libraries of another Unicode version.
LATE = 0xC9


def byte_letters() -> dict[str, int]:
    """The printable letter of each byte in byte-level vocabularies: itself, or one of those from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(others)}}


class Spelling:
    """Bytes of every token of a vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)])[:-1]
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def __len__(self) -> int:
        return len(self.size)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        stop = np.cumsum(size)
        return self.bytes[np.arange(stop[-1] if len(stop) else 0) + np.repeat(self.start[ids] - stop + size, size)]


@dataclass
class Vocabularies:
    """Both vocabularies as file contents, sent to the workers, and the encoders made of them there."""

    bpe: str
    pieces: bytes

    @staticmethod
    def load(bpe: str, pieces: str) -> Vocabularies:
        with open(bpe, encoding="utf-8") as a, open(pieces, "rb") as b:
            return Vocabularies(a.read(), b.read())

    @property
    def name(self) -> str:
        return hashlib.sha256(self.bpe.encode() + self.pieces).hexdigest()

    @cached_property
    def slow(self):
        from tokenizers import Tokenizer

        made = Tokenizer.from_str(self.bpe)
        made.encode_special_tokens = True
        return made

    @cached_property
    def fast(self):
        """The same vocabulary in a faster library, if its ids are ranks; None if not."""
        import tiktoken

        model = json.loads(self.bpe)["model"]
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        if [model["vocab"].get(m) for m in merged] != list(range(256, 256 + len(merged))):
            return None
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if i < 256 + len(merged)}
        return tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def piece_encoder(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.pieces)

    @cached_property
    def a(self) -> Spelling:
        letters, n = byte_letters(), self.slow.get_vocab_size(True)
        known = {i: t for t, i in json.loads(self.bpe)["model"]["vocab"].items()}
        return Spelling([bytes(letters[c] for c in known[i]) if i in known else (self.slow.id_to_token(i) or "").encode()
                         for i in range(n)])

    @cached_property
    def b(self) -> Spelling:
        p = self.piece_encoder

        def spelled(i: int) -> bytes:
            if p.is_control(i) or p.is_unknown(i):
                return b""
            return bytes([int(p.id_to_piece(i)[3:5], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace("▁", " ").encode()

        return Spelling([spelled(i) for i in range(len(p))])

    def encode_a(self, texts: list[str], late: np.ndarray) -> list:
        """Ids of a space and each text; texts of `late` letters go to the vocabulary's own library."""
        fast = self.fast
        own = [k for k in range(len(texts)) if late[k] or fast is None]
        out: list = [None] * len(texts)
        if own:
            for k, made in zip(own, self.slow.encode_batch([f" {texts[k]}" for k in own], add_special_tokens=False)):
                out[k] = made.ids
        for k, text in enumerate(texts):
            if out[k] is None:
                out[k] = fast.encode_ordinary(f" {text}")
        return out


_LOADED: dict[str, Vocabularies] = {}


def loaded(sent: Vocabularies, name: str) -> Vocabularies:
    """One set of encoders per worker process and pair of vocabularies."""
    return _LOADED.setdefault(name, sent)


@dataclass
class Aligned:
    """Tokens, links and cuts of a batch: token numbers run over all its documents, `ends` tell where each one's end."""

    a: np.ndarray
    b: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    links: tuple[np.ndarray, np.ndarray]
    cuts: tuple[np.ndarray, np.ndarray]
    a_stop: np.ndarray

    def of(self, ends: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        return np.searchsorted(ends, tokens, side="right") - 1


def flat(ids: list) -> tuple[np.ndarray, np.ndarray]:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
    return (np.concatenate([np.asarray(x, np.int64) for x in ids]) if ids else np.zeros(0, np.int64)), ends


def lanes(a_stop: np.ndarray, b_stop: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First A and B tokens of every lane: those of the documents, and those after a probed end that both share."""
    some = np.flatnonzero(np.diff(a_ends) > 0)
    place = np.arange(a_ends[-1]) - np.repeat(a_ends[:-1], np.diff(a_ends))
    probe = np.flatnonzero(place % LANE >= LANE - PROBES)
    at = np.searchsorted(b_stop, a_stop[probe])
    shared = b_stop[np.minimum(at, len(b_stop) - 1)] == a_stop[probe] if len(b_stop) else np.zeros(0, bool)
    first = np.unique(np.concatenate([a_ends[some], probe[shared] + 1]))
    second = np.unique(np.concatenate([b_ends[some], at[shared] + 1]))
    inside = first < a_ends[-1]
    return first[inside], second[:int(inside.sum())]


def lockstep(a_stop: np.ndarray, b_stop: np.ndarray, i: np.ndarray, j: np.ndarray):
    """Links (A token, B token) and cuts of all lanes, which begin at tokens i and j and end where the next begins.

    A cut is a pair of tokens that end together."""
    last = np.append(i[1:], len(a_stop))
    links, cuts = [], []
    while len(i):
        links.append((i, j))
        ahead = a_stop[i] - b_stop[j]
        both = ahead == 0
        cuts.append((i[both], j[both]))
        i, j = i + (ahead <= 0), j + (ahead >= 0)
        open_ = i < last
        if not open_.all():
            i, j, last = i[open_], j[open_], last[open_]
    if not links:
        nothing = np.zeros(0, np.int64)
        return (nothing, nothing), (nothing, nothing)
    return tuple(tuple(np.concatenate(x) for x in zip(*rows)) for rows in (links, cuts))


def without(ids: np.ndarray, ends: np.ndarray, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens without those of some documents."""
    sizes = np.diff(ends)
    keep = np.repeat(~gone, sizes)
    return ids[keep], np.concatenate([[0], np.cumsum(np.where(gone, 0, sizes))])


def align_batch(vocabularies: Vocabularies, column: pa.Array) -> Aligned:
    """Align all texts of a batch. Null and empty texts, and those that either vocabulary does not spell back, have no tokens."""
    data, offsets = flat_bytes(column)
    texts = [t or "" for t in column.to_pylist()]
    filled = [k for k, t in enumerate(texts) if t]
    high = np.concatenate([[0], np.cumsum(data >= LATE)])[offsets]
    late = np.diff(high) > 0
    ids: list = [[] for _ in texts]
    a, b = list(ids), list(ids)
    for k, found in zip(filled, vocabularies.encode_a([texts[k] for k in filled], late[filled])):
        a[k] = found
    for k, found in zip(filled, vocabularies.piece_encoder.encode([texts[k] for k in filled], num_threads=1)):
        b[k] = found
    sizes = np.diff(offsets)
    wanted = np.insert(data, offsets[:-1][sizes > 0], 32)
    limits = np.concatenate([[0], np.cumsum(sizes + (sizes > 0))])
    sides = [(*flat(ids), spelling) for ids, spelling in ((a, vocabularies.a), (b, vocabularies.b))]
    bad = np.zeros(len(texts), bool)
    for found, ends, spelling in sides:
        spelled = spelling.spell(found)
        stops = np.concatenate([[0], np.cumsum(spelling.size[found])])[ends]
        if len(spelled) != len(wanted) or (stops != limits).any() or (spelled != wanted).any():
            bad |= np.array([spelled[stops[k]:stops[k + 1]].tobytes() != wanted[limits[k]:limits[k + 1]].tobytes()
                             for k in range(len(texts))])
    (a, a_ends), (b, b_ends) = (without(found, ends, bad) for found, ends, _ in sides)
    a_stop, b_stop = np.cumsum(vocabularies.a.size[a]), np.cumsum(vocabularies.b.size[b])
    links, cuts = lockstep(a_stop, b_stop, *lanes(a_stop, b_stop, a_ends, b_ends))
    return Aligned(a, b, a_ends, b_ends, links, tuple(np.sort(c) for c in cuts), a_stop)


def aligned(batches, vocabularies: Vocabularies, name: str, column: str) -> Iterator[tuple[pa.RecordBatch, Aligned]]:
    for batch in slices(batches, column, SLICE):
        yield batch, align_batch(loaded(vocabularies, name), batch.column(column))


def align(docs: DataFrame, bpe: str, pieces: str, text: str = "text", output: str = "alignment") -> DataFrame:
    """`docs` with `output`, a struct of a_ids, b_ids, cuts (byte offsets in space and text at which tokens of both end)
    and links (positions of an A and a B token that share bytes, from 0, ordered).

    `bpe` and `pieces` are files on the driver. Texts that are null, empty, or not spelled back by both vocabularies
    have empty lists. An input column named as the output is replaced; an empty table gives an empty result.
    """
    vocabularies = Vocabularies.load(bpe, pieces)
    name = vocabularies.name
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != output])
    longs, pair = T.ArrayType(T.LongType()), T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    kind = T.StructType([T.StructField("a_ids", longs), T.StructField("b_ids", longs), T.StructField("cuts", longs),
                         T.StructField("links", T.ArrayType(pair))])

    def lists(ends, values):
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)

    def run(batches):
        for batch, found in aligned(batches, vocabularies, name, text):
            order = np.lexsort((found.links[1], found.links[0]))
            i, j = found.links[0][order], found.links[1][order]
            doc, cut = found.of(found.a_ends, i), found.of(found.a_ends, found.cuts[0])
            before = np.concatenate([[0], found.a_stop])[found.a_ends[:-1]]
            every = np.arange(batch.num_rows + 1)
            links = pa.StructArray.from_arrays([pa.array(i - found.a_ends[doc]), pa.array(j - found.b_ends[doc])], ["a", "b"])
            made = pa.StructArray.from_arrays([
                lists(found.a_ends, pa.array(found.a)), lists(found.b_ends, pa.array(found.b)),
                lists(np.searchsorted(cut, every), pa.array(found.a_stop[found.cuts[0]] - before[cut])),
                lists(np.searchsorted(doc, every), links)], ["a_ids", "b_ids", "cuts", "links"])
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, output])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(output, kind)]))


def written_groups(found: Aligned, digits: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All groups as text, `a1,a2|b1;a3|b2,b3;`, and the places where the documents' parts begin."""
    (cut_a, cut_b), n = found.cuts, len(found.a) + len(found.b)
    at_a = np.arange(len(found.a)) + np.concatenate([[0], cut_b + 1])[np.searchsorted(cut_a, np.arange(len(found.a)))]
    at_b = np.arange(len(found.b)) + (cut_a + 1)[np.searchsorted(cut_b, np.arange(len(found.b)))]
    ids, mark = np.zeros(n, np.int64), np.full(n, ord(","), np.uint8)
    ids[at_a], ids[at_b] = found.a, found.b
    mark[at_a[cut_a]], mark[at_b[cut_b]] = ord("|"), ord(";")
    letters, size = digits[0], digits[1][ids]
    start = np.concatenate([[0], np.cumsum(size + 1)])
    out = np.zeros(start[-1], np.uint8)
    for k in range(int(size.max(initial=0))):
        some = np.flatnonzero(size > k)
        out[start[some] + k] = letters[ids[some], k]
    out[start[:-1] + size] = mark
    return out, start[found.a_ends + found.b_ends]


def decimal(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of the numbers below n, a row each, and how many there are."""
    names = np.arange(n).astype("S")
    return np.frombuffer(names.tobytes(), np.uint8).reshape(n, names.itemsize), np.char.str_len(names).astype(np.int64)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n) over the lists `pairs` and `times` of all rows; counts are added up in each task first."""
    def run(batches):
        keys, sums, waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        more: list = []

        def merged():
            everything, at = np.unique(np.concatenate([keys, *[k for k, _ in more]]), return_inverse=True)
            # sums of counts stay far below 2^53, so that bincount is exact
            return everything, np.bincount(at, np.concatenate([sums, *[n for _, n in more]]), len(everything)).astype(np.int64)

        for batch in batches:
            more.append(tuple(batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("pairs", "times")))
            waiting += len(more[-1][0])
            if waiting >= HELD:
                keys, sums = merged()
                more, waiting = [], 0
                if len(keys) >= HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], ["pair", "n"])
                    keys, sums = keys[:0], sums[:0]
        keys, sums = merged()
        if len(keys):
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], ["pair", "n"])

    return rows.select("pairs", "times").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def blocks(pairs: DataFrame, width: int, most: int) -> list[DataFrame]:
    """The pairs cut by their B id into tables of about `most` rows; a B id has at most `width` pairs."""
    by = F.floor(F.col("pair") / F.lit(width)).alias("b")
    # one row per B id of the vocabulary
    counts = pairs.groupBy(by).agg(F.count(F.lit(1)).alias("n")).orderBy("b").collect()
    edges, held = [0], 0
    for r in counts:
        if held and held + r["n"] > most:
            edges.append(r["b"] * width)
            held = 0
        held += r["n"]
    return [pairs.where((F.col("pair") >= low) & (F.col("pair") < high) if high else F.col("pair") >= low)
            for low, high in zip(edges, [*edges[1:], None])]


def looked_up(rows: DataFrame, block: DataFrame, names: list[str]) -> DataFrame:
    """`names` of each row with n_best and count_sum: the links whose pair is a best one, and the sum of their pairs' counts,
    as far as the pairs stand in `block`, a table (pair, n, best) of bounded size that every task is given."""
    table = block.toArrow().combine_chunks().sort_by("pair")
    columns = [table.column(c).to_numpy() for c in ("pair", "n", "best")]
    sent = rows.sparkSession.sparkContext.broadcast(columns)

    def run(batches):
        pair, n, best = sent.value
        for batch in batches:
            lists = batch.column("pairs")
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            wanted = lists.flatten().to_numpy(zero_copy_only=False)
            times = batch.column("times").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.minimum(np.searchsorted(pair, wanted), max(0, len(pair) - 1))
            hit = pair[at] == wanted if len(pair) else np.zeros(len(wanted), bool)
            sums = [np.concatenate([[0], np.cumsum(np.where(hit, v, 0))]) for v in
                    ((times * best[at], times * n[at]) if len(pair) else (times, times))]
            made = [pa.array(np.diff(s[ends])) for s in sums]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *made], [*names, "n_best", "count_sum"])

    kinds = [rows.schema[c] for c in names]
    sums = [T.StructField(c, T.LongType()) for c in ("n_best", "count_sum")]
    return rows.select(*names, "pairs", "times").mapInArrow(run, T.StructType([*kinds, *sums]))


def alignment_digest(
    docs: DataFrame, bpe: str, pieces: str, key: str = "doc_id", text: str = "text", block: int = BLOCK,
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    The corpus-wide count of a pair of ids says how many links of all documents hold it; n_best counts the
    document's links whose pair has the largest count among the pairs of its B id (ties included), count_sum adds up the
    counts over its links. groups_sha256 is of `a1,a2|b1;a3|b2,b3`, the ids of the groups between cuts. Texts
    that are null, empty, or not spelled back by both vocabularies have zeros and an empty string. Rows that
    repeat count each; other columns of `docs` are not read; an empty table gives an empty result.

    Every document's distinct pairs are written once. The table of counts is given to all tasks if it has at most `block`
    rows, else in blocks, one after another, whose sums are added up per document.
    """
    vocabularies = Vocabularies.load(bpe, pieces)
    name, width = vocabularies.name, len(vocabularies.a)
    known = width * len(vocabularies.b)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("body"))
    sent = Vocabularies(vocabularies.bpe, vocabularies.pieces)
    counted = ["n_a", "n_b", "n_groups", "n_links"]

    def run(batches):
        digits = decimal(max(width, known // width))
        for batch, found in aligned(batches, sent, name, "body"):
            n = batch.num_rows
            i, j = found.links
            doc, key_ = found.of(found.a_ends, i), found.b[j] * width + found.a[i]
            pairs, times = np.unique(doc * known + key_, return_counts=True)
            owner = pairs // known
            ends = pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32())
            out, parts = written_groups(found, digits)
            raw = out.tobytes()
            digest = [hashlib.sha256(raw[a:b - 1]).hexdigest() if b > a else "" for a, b in zip(parts[:-1].tolist(), parts[1:].tolist())]
            counts = [np.diff(found.a_ends), np.diff(found.b_ends),
                      np.bincount(found.of(found.a_ends, found.cuts[0]), minlength=n), np.bincount(doc, minlength=n)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), *[pa.array(c.astype(np.int64)) for c in counts], pa.array(digest, pa.string()),
                pa.ListArray.from_arrays(ends, pa.array(pairs - owner * known)),
                pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32)))],
                ["doc_id", *counted, "groups_sha256", "pairs", "times"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, "
              "times array<int>")
    staged = stage(rows.mapInArrow(run, schema).withColumn("row_id", F.monotonically_increasing_id()), "links")
    counts = stage(pair_counts(staged), "pairs")
    by = F.floor(F.col("pair") / F.lit(width))
    # one row per B id of the vocabulary
    most = F.broadcast(counts.groupBy(by.alias("b")).agg(F.max("n").alias("most")))
    judged = stage(counts.join(most, by == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "judged")
    tables, columns = blocks(judged, width, block), ["doc_id", *counted, "groups_sha256"]
    if len(tables) == 1:
        return looked_up(staged, tables[0], columns)
    parts = [stage(looked_up(staged, part, ["row_id"]), "sums") for part in tables]
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    total = total.groupBy("row_id").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return staged.select("row_id", *columns).join(total, "row_id").select(*columns, "n_best", "count_sum")
