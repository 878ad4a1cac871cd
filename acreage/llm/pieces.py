"""SentencePiece encoding and decoding with a given byte-pair vocabulary, exact and by suffix arrays.

Texts are cut at spaces into segments that no piece crosses. The distinct new segments of a batch are
laid end to end and their suffixes sorted; every piece is found by binary search as one range of
suffixes, which gives all edges (start, end, piece). Sorted by end position the edges are relaxed: a
piece extends the encoding of what stands before it if the merge order of the vocabulary would not have merged across
that border. Exactly one piece passes at each position, which is the last piece of the library's encoding.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from acreage.llm.common import flat_bytes, mix, seeded, slices

SPACE = "▁"
#: Bytes of text encoded at once, and piece ids of segments a worker remembers; both bound its memory.
SLICE = 900_000
CACHED_PIECES = 4 << 20
NEVER = np.int32(2**31 - 1)


class Pieces:
    """A vocabulary: characters, merges with their splits, and what the relaxation needs of them."""

    def __init__(self, names: list[str], scores: list[float], special: set[int], byte_ids: list[int]):
        self.names, self.byte_ids = names, np.array(byte_ids, np.int32)
        normal = {p: i for i, p in enumerate(names) if i not in special and p and i not in set(byte_ids)}
        spaces = {p for p in normal if not p.strip(SPACE)}
        if any(SPACE in p[1:] for p in normal if p not in spaces) or SPACE not in normal:
            raise ValueError("pieces that cross a space are not supported")
        merged = [p for p in normal if len(p) > 1 and p not in spaces]
        lowest = min((scores[normal[p]] for p in merged), default=float("inf"))
        if any(scores[normal[p]] >= lowest for p in spaces if len(p) > 1):
            raise ValueError("pieces of spaces must come last in the merge order")
        self.rank = {p: r for r, p in enumerate(sorted(merged, key=lambda p: (-scores[normal[p]], normal[p])), 1)}
        self.chars = sorted(p for p in normal if len(p) == 1)
        self.space_scores = {len(p): scores[normal[p]] for p in spaces}
        self.space_ids = {len(p): normal[p] for p in spaces}
        self.ids = normal
        self.build()

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        special = {i for i in range(n) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        by_byte = {int(model.id_to_piece(i)[3:-1], 16): i for i in range(n) if model.is_byte(i)}
        return cls([model.id_to_piece(i) for i in range(n)], [model.get_score(i) for i in range(n)],
                   special, [by_byte[b] for b in range(256)])

    def split(self, piece: str) -> tuple[str, str] | None:
        """The last merge that makes `piece`, or None if its merges end elsewhere."""
        parts, last = list(piece), None
        while len(parts) > 1:
            best = min(((self.rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.rank), default=None)
            if best is None:
                return None
            i = best[1]
            last = (parts[i], parts[i + 1])
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return last

    def build(self) -> None:
        splits = {p: s for p in self.rank if (s := self.split(p))}
        tokens = self.chars + [p for p in self.rank if p in splits]
        index = {p: i for i, p in enumerate(tokens)}
        self.token_ids = np.array([self.ids[p] for p in tokens], np.int32)
        self.length = np.array([len(p) for p in tokens], np.int64)
        made: dict[str, int] = {}

        def formed(p: str) -> int:
            if len(p) == 1:
                return 0
            if p not in made:
                made[p] = max(self.rank[p], formed(splits[p][0]), formed(splits[p][1]))
            return made[p]

        self.formed = np.array([formed(p) for p in tokens], np.int32)
        self.right, self.right_until = self.spine(tokens, splits, index, 1)
        self.left, self.left_until = self.spine(tokens, splits, index, 0)
        pairs = sorted((index[p[:k]] * len(tokens) + index[p[k:]], self.rank[p]) for p in splits for k in range(1, len(p))
                       if p[:k] in index and p[k:] in index)
        self.pair_keys = np.array([k for k, _ in pairs], np.int64)
        self.pair_rank = np.array([r for _, r in pairs], np.int32)
        self.char_token = np.zeros(0x110000, np.int32)
        for i, c in enumerate(self.chars):
            self.char_token[ord(c)] = i + 1
        self.char_token[32] = self.char_token[ord(SPACE)]
        self.space = int(self.char_token[32])
        bits = int(len(self.chars) + 1).bit_length()
        self.bits, self.per = bits, 63 // bits
        longest = int(self.length.max())
        self.keys = -(-longest // self.per)
        spelled = np.zeros((len(tokens), self.keys * self.per), np.int64)
        for i, p in enumerate(tokens):
            spelled[i, :len(p)] = [self.char_token[ord(c)] for c in p]
        self.low = self.packed(spelled)
        spelled[np.arange(spelled.shape[1]) >= self.length[:, None]] = (1 << bits) - 1
        self.high = self.packed(spelled)
        raw = [bytes([i]) for i in range(256)]
        spell = {int(b): raw[i] for i, b in enumerate(self.byte_ids)}
        spell |= {i: p.replace(SPACE, " ").encode() for p, i in self.ids.items()}
        parts = [spell.get(i, b"") for i in range(len(self.names))]
        self.spell_start = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
        self.spelled = np.frombuffer(b"".join(parts), np.uint8)

    def spine(self, tokens, splits, index, side: int) -> tuple[np.ndarray, np.ndarray]:
        """For each token the tokens at its border as it was formed, outermost first, and when each was merged away."""
        rows = []
        for p in tokens:
            row, until = [], NEVER
            while True:
                row.append((index[p], until))
                if p not in splits:
                    break
                until, p = self.formed[index[p]], splits[p][side]
            rows.append(row)
        depth = max(map(len, rows), default=1)
        who, until = np.full((len(rows), depth), -1, np.int32), np.zeros((len(rows), depth), np.int32)
        for i, row in enumerate(rows):
            who[i, :len(row)], until[i, :len(row)] = zip(*row)
        return who, until

    def packed(self, spelled: np.ndarray) -> np.ndarray:
        """Character numbers packed into a few sortable integers per row."""
        out = np.zeros((len(spelled), self.keys), np.int64)
        for k in range(self.keys):
            for j in range(self.per):
                out[:, k] = out[:, k] << self.bits | spelled[:, k * self.per + j]
        return out

    def borders(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether token a may stand before token b: no merge across the border comes before those that
        made them. Of equal merges the left one comes first."""
        good = np.ones(len(a), bool)
        for i in range(self.right.shape[1]):
            left = self.right[a, i]
            some = np.flatnonzero((left >= 0) & good)
            if not len(some):
                break
            for j in range(self.left.shape[1]):
                right = self.left[b[some], j]
                some = some[right >= 0]
                if not len(some):
                    break
                x, y = left[some].astype(np.int64), self.left[b[some], j].astype(np.int64)
                key = x * len(self.length) + y
                at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
                hit = self.pair_keys[at] == key
                when = np.maximum(np.maximum(self.formed[x], self.formed[y]), self.pair_rank[at])
                bad = hit & (when < self.right_until[a[some], i]) & (when <= self.left_until[b[some], j])
                good[some[bad]] = False
        return good

    def space_run(self, n: int) -> list[int]:
        """Pieces for n spaces that nothing else has taken: merges of equal score go from the left."""
        size, following, alive = [1] * n, list(range(1, n + 1)), [True] * n
        before = list(range(-1, n - 1))
        heap: list[tuple[float, int, int, int]] = []

        def offer(i: int) -> None:
            j = following[i]
            if j < n and (size[i] + size[j]) in self.space_scores:
                heapq.heappush(heap, (-self.space_scores[size[i] + size[j]], i, size[i], size[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            if not alive[i] or size[i] != a or following[i] >= n or size[following[i]] != b:
                continue
            j = following[i]
            size[i], alive[j], following[i] = a + b, False, following[j]
            if following[i] < n:
                before[following[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [self.space_ids[size[i]] for i in range(n) if alive[i]]


class Encoder:
    """Encodes batches in a worker; distinct segments and tested borders are remembered in bounded tables."""

    BORDERS = 1 << 21

    def __init__(self, pieces: Pieces):
        self.pieces, self.runs = pieces, {}
        self.border_keys = np.full(self.BORDERS, -1, np.int64)
        self.border_good = np.zeros(self.BORDERS, bool)
        self.values = mix(seeded(31, len(pieces.chars) + 2))
        self.reset()

    def reset(self) -> None:
        self.hashes, self.start = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.size, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def may_meet(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * len(self.pieces.length) + b
        slot = (mix(key.astype(np.uint64)) & np.uint64(self.BORDERS - 1)).astype(np.int64)
        out = self.border_good[slot]
        new = np.flatnonzero(self.border_keys[slot] != key)
        if len(new):
            some, at = np.unique(key[new], return_inverse=True)
            good = self.pieces.borders(some // len(self.pieces.length), some % len(self.pieces.length))
            out[new] = good[at]
            self.border_keys[slot[new]], self.border_good[slot[new]] = key[new], good[at]
        return out

    def edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and tokens of all occurrences of all pieces in `text` (character numbers, 0 between segments)."""
        p = self.pieces
        width = p.keys * p.per
        padded = np.concatenate([text, np.zeros(width, text.dtype)]).astype(np.int64)
        keys = []
        for k in range(p.keys):
            key = np.zeros(len(text), np.int64)
            for j in range(p.per):
                key = key << p.bits | padded[k * p.per + j:k * p.per + j + len(text)]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        keys = [key[order] for key in keys]
        low, high = np.zeros(len(p.low), np.int64), np.full(len(p.low), len(order), np.int64)
        for k, key in enumerate(keys):
            if k == 0:
                low, high = np.searchsorted(key, p.low[:, 0], "left"), np.searchsorted(key, p.high[:, 0], "right")
            else:
                some = np.flatnonzero((p.length > k * p.per) & (low < high))
                first, last = low[some], high[some]
                low[some] = bisected(key, first, last, p.low[some, k], False)
                high[some] = bisected(key, first, last, p.high[some, k], True)
        count = np.maximum(high - low, 0)
        token = np.repeat(np.arange(len(count)), count)
        at = np.arange(len(token)) + np.repeat(low - (np.cumsum(count) - count), count)
        return order[at], token

    def encode_segments(self, text: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of segments of known characters, one after another, and how many each has."""
        p = self.pieces
        begin = np.cumsum(sizes + 1) - sizes - 1
        flat = np.zeros(int((sizes + 1).sum()), np.int32)
        place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        flat[place + np.repeat(begin, sizes)] = text[place + np.repeat(starts, sizes)]
        start, token = self.edges(flat)
        offset = np.zeros(len(flat), np.int64)
        offset[place + np.repeat(begin, sizes)] = place
        end = start + p.length[token]
        until = offset[start] + p.length[token]
        order = np.lexsort((end, until))
        start, token, end, until = start[order], token[order], end[order], until[order]
        last = np.full(len(flat) + 1, -1, np.int64)
        bounds = np.searchsorted(until, np.arange(int(sizes.max(initial=0)) + 2))
        for a, b in zip(bounds[1:-1], bounds[2:]):
            s, t = start[a:b], token[a:b]
            first = offset[s] == 0
            good = first.copy()
            rest = np.flatnonzero(~first)
            rest = rest[last[s[rest]] >= 0]
            good[rest] = self.may_meet(last[s[rest]], t[rest])
            last[end[a:b][good]] = t[good]
        at, ends, found = begin + sizes, [], []
        who = np.flatnonzero(sizes > 0)
        while len(who):
            t = last[at[who]]
            if (t < 0).any():
                raise ValueError("a segment has no encoding")
            found.append(t)
            ends.append(who)
            at[who] -= p.length[t]
            who = who[at[who] > begin[who]]
        if not found:
            return np.zeros(0, np.int32), np.zeros(len(sizes), np.int64)
        who, token = np.concatenate(ends[::-1]), np.concatenate(found[::-1])
        order = np.argsort(who, kind="stable")
        return p.token_ids[token[order]], np.bincount(who, minlength=len(sizes))

    def remember(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        start = len(self.pool) + np.cumsum(sizes) - sizes
        hashes, starts, sizes = (np.concatenate(x) for x in ((self.hashes, hashes), (self.start, start), (self.size, sizes)))
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.start, self.size = hashes[order], starts[order], sizes[order]
        self.pool = np.concatenate([self.pool, ids])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts (UTF-8 bytes) and their n + 1 offsets."""
        p = self.pieces
        chars = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        place = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets] if len(data) else np.zeros(len(offsets), np.int64)
        filled = np.flatnonzero(np.diff(place) > 0)
        shift = np.concatenate([[0], np.cumsum(np.diff(place) > 0)])
        if not len(filled):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        code = np.insert(chars, place[:-1][filled], np.uint32(32))
        place = place + shift
        text = p.char_token[code]
        opens = text == p.space
        unknown = text == 0
        opens |= unknown
        opens[1:] |= unknown[:-1]
        opens[place[:-1][filled]] = True
        starts = np.flatnonzero(opens)
        sizes = np.diff(np.append(starts, len(text)))
        segment_ids, counts = self.segments(text, code, starts, sizes)
        ends = np.concatenate([[0], np.cumsum(counts)])
        out_ends = ends[np.searchsorted(starts, place)]
        return self.join_spaces(segment_ids, out_ends)

    def segments(self, text, code, starts, sizes) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all segments in order, from the remembered ones and those encoded now."""
        values = self.values[text]
        values[text == 0] = mix(code[text == 0].astype(np.uint64) + np.uint64(1 << 40))
        base = hash_powers(len(text) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * base[0][:len(text)])])
        hashes = mix((total[starts + sizes] - total[starts]) * base[1][starts] + sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.pool) > CACHED_PIECES:
            self.reset()
        at = np.searchsorted(self.hashes, distinct)
        at[at == len(self.hashes)] = 0
        new = np.ones(len(distinct), bool) if not len(self.hashes) else self.hashes[at] != distinct
        if new.any():
            s, n, h = starts[first[new]], sizes[first[new]], distinct[new]
            odd = text[s] == 0
            ids, counts = self.encode_segments(text, s[~odd], n[~odd])
            self.remember(h[~odd], ids, counts)
            raw = [np.frombuffer(chr(c).encode(), np.uint8) for c in code[s[odd]]]
            if raw:
                self.remember(h[odd], self.pieces.byte_ids[np.concatenate(raw)], np.array([len(x) for x in raw]))
            at = np.searchsorted(self.hashes, distinct)
        row = at[inverse]
        counts = self.size[row]
        return self.pool[np.arange(int(counts.sum())) + np.repeat(self.start[row] - (np.cumsum(counts) - counts), counts)], counts

    def join_spaces(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge neighbouring single spaces, which are the last merges of all."""
        space = ids == self.pieces.space_ids[1]
        inner = space[1:] & space[:-1]
        border = ends[1:-1]
        inner[border[(border > 0) & (border < len(ids))] - 1] = False
        if not inner.any():
            return ids, ends
        edge = np.diff(np.concatenate([[0], inner.astype(np.int8), [0]]))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
        out, keep = ids.copy(), np.ones(len(ids), bool)
        for n in np.unique(last - first).tolist():
            if n not in self.runs:
                self.runs[n] = self.pieces.space_run(n)
            run = np.array(self.runs[n], np.int32)
            at = first[last - first == n]
            out[(at[:, None] + np.arange(len(run))).ravel()] = np.tile(run, len(at))
            keep[(at[:, None] + np.arange(len(run), n)).ravel()] = False
        return out[keep], np.concatenate([[0], np.cumsum(keep)])[ends]


def bisected(key: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray, after: bool) -> np.ndarray:
    """First place in each sorted key[low:high] that is not below (or, `after`, above) the wanted value."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = (low + high) // 2
        value = key[np.minimum(middle, len(key) - 1)]
        below = open_ & ((value <= wanted) if after else (value < wanted))
        low = np.where(below, middle + 1, low)
        high = np.where(open_ & ~below, middle, high)
    return low


def hash_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    from acreage.llm.words import powers

    return powers(max(1 << 20, 1 << (n - 1).bit_length()))


def decode(pieces: Pieces, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all encoded texts, without the space put before each, and their offsets."""
    size = np.diff(pieces.spell_start)[ids]
    stop = np.concatenate([[0], np.cumsum(size)])
    out = pieces.spelled[np.arange(stop[-1]) + np.repeat(pieces.spell_start[ids] - stop[:-1], size)]
    offsets = stop[ends]
    filled = np.diff(offsets) > 0
    lead = filled & (out[np.minimum(offsets[:-1], max(0, len(out) - 1))] == 32) if len(out) else filled
    out = np.delete(out, offsets[:-1][lead])
    return out, offsets - np.concatenate([[0], np.cumsum(lead)])


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(pieces: Pieces, name: str) -> Encoder:
    """One encoder per worker process and vocabulary, so that what it remembers serves many tasks."""
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(pieces)
    return _ENCODERS[name]


def encoded(batches: Iterator[pa.RecordBatch], pieces: Pieces, name: str, column: str):
    for batch in slices(batches, column, SLICE):
        data, offsets = flat_bytes(batch.column(column))
        ids, ends = encoder_of(pieces, name).encode(data, offsets)
        yield batch, data, offsets, ids, ends


def encode(docs: DataFrame, model: str, text: str = "text", output: str = "pieces") -> DataFrame:
    """`docs` with `output`, the piece ids of each text as array<int>; null and empty texts give none.

    `model` is the path of a SentencePiece byte-pair model on the driver. An input column named as the
    output is replaced; all others pass through; an empty table gives an empty result.
    """
    pieces, name = Pieces.load(model), vocabulary_name(model)
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != output])

    def run(batches):
        for batch, _, _, ids, ends in encoded(batches, pieces, name, column):
            made = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names)

    names, column = [*docs.columns, output], f"c{docs.columns.index(text)}"
    # names with dots cannot be passed to mapInArrow
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(output, T.ArrayType(T.IntegerType()))]))


def decoded(rows: DataFrame, model: str, column: str = "pieces", output: str = "text") -> DataFrame:
    """`rows` with `output`, the text of each array of piece ids; null gives null. Control pieces spell nothing."""
    pieces = Pieces.load(model)
    rows = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c != output])

    def run(batches):
        for batch in batches:
            lists = batch.column(column)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
            out, offsets = decode(pieces, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), ends)
            raw = out.tobytes()
            texts = [raw[a:b].decode(errors="replace") if there else None
                     for a, b, there in zip(offsets[:-1], offsets[1:], lists.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, output])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(output, T.StringType())]))


def vocabulary_name(model: str) -> str:
    with open(model, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def round_trip(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_pieces, pieces_sha256 (of the ids as 32-bit little-endian), round_trip.

    round_trip tells that decoding gives the text back, which fails only for texts holding U+2581, the
    mark that stands for a space. Null counts as empty and has no pieces; repeated rows give equal rows.
    """
    pieces, name = Pieces.load(model), vocabulary_name(model)
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("body"))

    def run(batches):
        for batch, data, offsets, ids, ends in encoded(batches, pieces, name, "body"):
            back, places = decode(pieces, ids, ends)
            if len(back) == len(data) and (places == offsets).all() and (back == data).all():
                same = np.ones(batch.num_rows, bool)
            else:
                same = [back[a:b].tobytes() == data[c:d].tobytes()
                        for a, b, c, d in zip(places[:-1], places[1:], offsets[:-1], offsets[1:])]
            raw = ids.astype("<i4").tobytes()
            digest = [hashlib.sha256(raw[4 * a:4 * b]).hexdigest() for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(ends)), pa.array(digest), pa.array(same)],
                                             ["doc_id", "n_pieces", "pieces_sha256", "round_trip"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n_pieces long, pieces_sha256 string, round_trip boolean")
