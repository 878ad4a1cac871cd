"""Whole texts scored by a gated recurrent language model.

Counts come from all training documents. The most frequent words (the head) are split into classes by topic
and frequency; the output is a softmax over classes times a softmax over the words of the class.
Less frequent listed words and the unlisted tail are classes too, in which a word has its smoothed
share of the counts. The network is trained in numpy by truncated backpropagation on every training
document: a hash deals documents to learners, whose weights are averaged after each round. For scoring, the
state is carried across windows from a document's first word to its end.
"""

from __future__ import annotations

import heapq
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from acreage.llm.common import flat_bytes, partitions, slices, stage, text_of
from acreage.llm.words import word_hashes

#: The end of a document, counted as a word. 0 stands for no word.
END = np.uint64(0xE4D0F7C3A9B1D5E7)
SMOOTH = 0.1
HEAD, LISTED, TOPICS = 2048, 1 << 18, 16
CHUNKS = (16, 48)
LARGEST_CHUNK = 64
#: Bytes of text laid out together, and tokens of a window.
POOL, WINDOW_TOKENS = 24 << 20, 1 << 13
LARGEST_LOGIT = np.float32(80)
BLOCK = 4096
#: Tokens per learner, and steps of 1 of a weight in averages: whole numbers, whose sum has no order.
LEARNER_TOKENS, FINE = 1 << 22, 1 << 20


class Vocabulary(NamedTuple):
    """Listed words: sorted hashes with network id, in-class log probability and log10(count + SMOOTH).

    Ids below `head` are words of their own; then one id per class of less frequent words; the last is the tail."""
    hashes: np.ndarray
    ids: np.ndarray
    inside: np.ndarray
    weight: np.ndarray
    known: np.ndarray
    head: int
    class_of: np.ndarray
    classes: list[tuple[int, int]]
    class_log: np.ndarray
    word_log: np.ndarray
    total: int
    distinct: int
    tail_log10: float
    slots: np.ndarray

    @property
    def tail(self) -> int:
        return len(self.class_of) - 1


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, each text closed by END, and the n + 1 offsets."""
    words, ends = word_hashes(*flat_bytes(column))
    out = np.full(len(words) + len(ends) - 1, END)
    out[np.arange(len(words)) + np.repeat(np.arange(len(ends) - 1), np.diff(ends))] = words
    return out, ends + np.arange(len(ends))


def summed(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    word, topic, count = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((topic, word))
    word, topic, count = word[order], topic[order], count[order]
    first = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (topic[1:] != topic[:-1])]))
    return word[first], topic[first], np.add.reduceat(count, first)


def count_words(docs: DataFrame) -> DataFrame:
    """Exact (word, n, topic) of all rows; a word's topic is the most frequent word of the documents that
    hold most of its occurrences."""
    def count(batches):
        parts, held = [], 0
        for batch in slices(batches, "body", 1 << 20):
            tokens, ends = tokens_of(batch.column("body"))
            for a, b in zip(ends[:-1], ends[1:]):
                words, counts = np.unique(tokens[a:b - 1], return_counts=True)
                topic = words[counts.argmax()] if len(words) else np.uint64(0)
                parts.append((np.append(words, END), np.full(len(words) + 1, topic), np.append(counts, 1)))
                held += len(words) + 1
            if held > 1 << 20:
                parts = [summed(parts)]
                held = len(parts[0][0])
                if held > 1 << 19:
                    yield rows(parts[0])
                    parts, held = [], 0
        if parts:
            yield rows(summed(parts))

    def rows(part):
        return pa.RecordBatch.from_arrays([pa.array(part[0].view(np.int64)), pa.array(part[1].view(np.int64)), pa.array(part[2])],
                                          ["word", "topic", "n"])

    pairs = docs.select("body").mapInArrow(count, "word long, topic long, n long")
    pairs = pairs.repartition(partitions(docs), "word").groupBy("word", "topic").agg(F.sum("n").alias("n"))
    return pairs.groupBy("word").agg(F.sum("n").alias("n"), F.max(F.struct("n", "topic")).alias("most")).select(
        "word", "n", F.col("most.topic").alias("topic"))


def listed_words(counts: DataFrame, most: int) -> pd.DataFrame:
    """At most `most` of the most frequent words: all with a count above a cut found from a histogram."""
    fine = F.floor(F.log2("n") * 16)
    bins = sorted(((r.bin, r.k) for r in counts.groupBy(fine.alias("bin")).agg(F.count(F.lit(1)).alias("k")).collect()), reverse=True)
    seen, cut = 0, None
    for b, k in bins:
        if seen + k > most:
            break
        seen, cut = seen + k, b
    rows = counts.where(fine >= cut).collect() if cut is not None else []
    return pd.DataFrame([(r.word, r.n, r.topic) for r in rows], columns=["word", "n", "topic"])


def vocabulary(counts: DataFrame, head: int = HEAD, most: int = LISTED) -> Vocabulary:
    about = counts.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct")).first()
    total, distinct = about.total or 0, about.distinct
    listed = listed_words(counts, most)
    end = listed["word"] == int(END.view(np.int64))
    ends = int(listed["n"][end].sum())
    if not end.any() and distinct:
        ends = counts.where(F.col("word") == int(END.view(np.int64))).agg(F.sum("n")).first()[0] or 0
    listed = listed[~end].sort_values(["n", "word"], ascending=[False, True])
    mass = listed.groupby("topic")["n"].sum().sort_values(ascending=False, kind="stable")
    rank = {t: min(i, TOPICS - 1) for i, t in enumerate(mass.index)}
    topic = listed["topic"].map(rank).to_numpy(np.int64) if len(listed) else np.zeros(0, np.int64)
    words, n = listed["word"].to_numpy(np.int64).view(np.uint64), listed["n"].to_numpy(np.int64)
    order, classes = [-1], [(0, 1)]  # END is a class of its own
    for t in range(TOPICS):
        own = np.flatnonzero(topic[:head] == t)
        sizes = iter(CHUNKS)
        while len(own):
            size = next(sizes, LARGEST_CHUNK)
            classes.append((len(order), len(order) + len(own[:size])))
            order.extend(own[:size].tolist())
            own = own[size:]
    heads = len(order)
    class_of = [k for k, (a, b) in enumerate(classes) for _ in range(a, b)]
    counted = np.concatenate([[ends], n[np.array(order[1:], np.int64)]]) if heads > 1 else np.array([ends])
    smooth = counted + SMOOTH
    class_mass = [smooth[a:b].sum() for a, b in classes]
    ids, inside = np.zeros(len(words), np.int32), np.zeros(len(words))
    ids[np.array(order[1:], np.int64)] = np.arange(1, heads)
    for t in range(TOPICS):
        own = head + np.flatnonzero(topic[head:] == t)
        if len(own):
            weight = n[own] + SMOOTH
            ids[own], inside[own] = len(class_of), np.log(weight / weight.sum())
            class_of.append(len(class_mass))
            class_mass.append(weight.sum())
    rest = distinct - len(words) - (ends > 0)
    tail_mass = (total - n.sum() - ends) + SMOOTH * (rest + 1)
    class_of.append(len(class_mass))
    class_mass.append(tail_mass)
    hashes = np.concatenate([words, [END]])
    at = np.argsort(hashes)
    smooth_of = lambda x: np.log10(x + SMOOTH)
    class_mass = np.array(class_mass, np.float64)
    return Vocabulary(
        hashes[at], np.append(ids, 0).astype(np.int32)[at], np.append(inside, 0.0)[at], smooth_of(np.append(n, ends))[at],
        np.append(n, ends)[at] > 0, heads, np.array(class_of, np.int32), classes, np.log(class_mass / class_mass.sum()),
        np.log(smooth / class_mass[np.array(class_of[:heads])]), total, distinct, float(np.log10(tail_mass)), slots_of(hashes[at]))


def slots_of(hashes: np.ndarray) -> np.ndarray:
    """An open-addressed table, a quarter full at most: the row of each hash at its low bits or at the next free place."""
    slots = np.full(1 << int(4 * len(hashes)).bit_length(), -1, np.int32)
    rows = np.arange(len(hashes), dtype=np.int32)
    place = (hashes & np.uint64(len(slots) - 1)).astype(np.int64)
    while len(rows):
        free = slots[place] < 0
        slots[place[free]] = rows[free]
        left = slots[place] != rows
        rows, place = rows[left], (place[left] + 1) & (len(slots) - 1)
    return slots


def look_up(vocab: Vocabulary, tokens: np.ndarray) -> np.ndarray:
    """Row of each token in the vocabulary, or -1."""
    at, todo = np.full(len(tokens), -1, np.int32), np.arange(len(tokens))
    place = (tokens & np.uint64(len(vocab.slots) - 1)).astype(np.int64)
    while len(todo):
        row = vocab.slots[place]
        hit = (row >= 0) & (vocab.hashes[row] == tokens[todo])
        at[todo[hit]] = row[hit]
        on = (row >= 0) & ~hit
        todo, place = todo[on], (place[on] + 1) & (len(vocab.slots) - 1)
    return at


class Model:
    """A gated recurrent unit over word ids with a class-factored output. Gates: update, reset, new."""

    def __init__(self, vocab: Vocabulary, hidden: int = 16, seed: int = 5):
        rng = np.random.default_rng(seed)
        wide = lambda *s, scale: rng.normal(0, scale, s).astype(np.float32)
        self.hidden, self.head, self.class_of, self.classes = hidden, vocab.head, vocab.class_of, vocab.classes
        self.p = {
            "emb": wide(len(vocab.class_of), 3 * hidden, scale=0.3), "rec": wide(hidden, 3 * hidden, scale=hidden ** -0.5),
            "cls": np.zeros((hidden, len(vocab.class_log)), np.float32), "clsb": vocab.class_log.astype(np.float32),
            "word": np.zeros((vocab.head, hidden), np.float32), "wordb": vocab.word_log.astype(np.float32),
        }

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for k in sorted(self.p):
            size = self.p[k].size
            self.p[k] = flat[at:at + size].reshape(self.p[k].shape).astype(np.float32)
            at += size

    def window(self, ids: np.ndarray, fresh: np.ndarray, h: np.ndarray, tape: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """States before each token (steps, lanes, hidden) and after the last; `fresh` is 0 where a text starts.
        `tape` receives gates, new values and the recurrent part of the latter, one array each."""
        n, rec = self.hidden, self.p["rec"].copy()
        rec[:, :2 * n] *= 0.5  # a logistic gate is half a tanh of half its input
        given = self.p["emb"].take(ids.ravel(), axis=0).reshape(*ids.shape, 3 * n)
        gates, news = np.multiply(given[..., :2 * n], np.float32(0.5)), np.ascontiguousarray(given[..., 2 * n:])
        before = np.empty((*ids.shape, n), np.float32)
        raws = np.empty_like(before) if tape is not None else None
        for t in range(len(ids)):
            prev, zr, new = before[t], gates[t], news[t]
            np.multiply(h, fresh[t][:, None], out=prev)
            both = prev @ rec
            zr += both[:, :2 * n]
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            raw = both[:, 2 * n:]
            if tape is not None:
                raws[t] = raw
            raw *= zr[:, n:]
            new += raw
            np.tanh(new, out=new)
            h = prev - new
            h *= zr[:, :n]
            h += new
        if tape is not None:
            tape.extend((gates, news, raws))
        return before, h

    def output(self, states: np.ndarray, targets: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Log probability of each target's class and, for head words, of the word in it; gradient of minus the
        sum with respect to the states when `grads` is given, which receives those of the weights."""
        order = np.argsort(self.class_of[targets].astype(np.int16), kind="stable")
        states, targets = states[order], targets[order]
        rows, cls = np.arange(len(targets)), self.class_of[targets]
        prob = states @ self.p["cls"]
        prob += self.p["clsb"]
        np.clip(prob, -LARGEST_LOGIT, LARGEST_LOGIT, out=prob)  # bounds the exponent without a pass for each row's maximum
        own = prob[rows, cls]
        np.exp(prob, out=prob)
        norm = prob @ np.ones(prob.shape[1], prob.dtype)
        out = own - np.log(norm)
        back = None
        if grads is not None:
            prob /= norm[:, None]
            prob[rows, cls] -= 1
            grads["cls"], grads["clsb"] = states.T @ prob, np.ones(len(prob), prob.dtype) @ prob
            back = prob @ self.p["cls"].T
            grads["word"], grads["wordb"] = np.zeros_like(self.p["word"]), np.zeros_like(self.p["wordb"])
        bounds = np.searchsorted(cls, np.arange(len(self.classes) + 1))
        for (a, b), i, j in zip(self.classes, bounds[:-1], bounds[1:]):
            if b - a == 1 or i == j:
                continue
            part, weight = states[i:j], self.p["word"][a:b]
            prob = part @ weight.T
            prob += self.p["wordb"][a:b]
            np.clip(prob, -LARGEST_LOGIT, LARGEST_LOGIT, out=prob)
            here, place = rows[:j - i], targets[i:j] - a
            mine = prob[here, place]
            np.exp(prob, out=prob)
            norm = prob @ np.ones(b - a, prob.dtype)
            out[i:j] += mine - np.log(norm)
            if grads is not None:
                prob /= norm[:, None]
                prob[here, place] -= 1
                grads["word"][a:b], grads["wordb"][a:b] = prob.T @ part, prob.sum(axis=0)
                back[i:j] += prob @ weight
        logs = np.empty_like(out)
        logs[order] = out
        if back is not None:
            unsorted = np.empty_like(back)
            unsorted[order] = back
            back = unsorted
        return logs, back

    def gradients(self, ids: np.ndarray, fresh: np.ndarray, live: np.ndarray, h: np.ndarray) -> tuple[float, dict, np.ndarray]:
        """Mean negative log probability of the live tokens of a window, its truncated gradient, and the next state."""
        n, tape, grads = self.hidden, [], {}
        before, after = self.window(ids, fresh, h, tape)
        mask = live.ravel()
        logs, some = self.output(before.reshape(-1, n)[mask], ids.ravel()[mask], grads)
        back = np.zeros((ids.size, n), np.float32)
        back[mask] = some
        back = back.reshape(before.shape)
        gates, news, raws = tape
        z, r = np.ascontiguousarray(gates[..., :n]), np.ascontiguousarray(gates[..., n:])
        to_new = (1 - z) * (1 - news * news)
        to_update, to_reset = z * (1 - z) * (before - news), r * (1 - r) * raws
        # per step the slopes at update gate, reset gate and recurrent part; the new value's input apart
        slopes, dnews = np.empty((*ids.shape, 3 * n), np.float32), np.empty_like(before)
        rec_back, dh = np.ascontiguousarray(self.p["rec"].T), np.zeros_like(h)
        for t in range(len(ids) - 1, -1, -1):
            slope, dnew = slopes[t], dnews[t]
            np.multiply(to_new[t], dh, out=dnew)
            np.multiply(to_update[t], dh, out=slope[:, :n])
            np.multiply(to_reset[t], dnew, out=slope[:, n:2 * n])
            np.multiply(dnew, r[t], out=slope[:, 2 * n:])
            dh *= z[t]
            dh += slope @ rec_back
            dh += back[t]
            dh *= fresh[t][:, None]
        slopes = slopes.reshape(-1, 3 * n)
        grads["rec"] = before.reshape(-1, n).T @ slopes
        slopes[:, 2 * n:] = dnews.reshape(-1, n)
        order = np.argsort(ids.ravel().astype(np.uint16) if len(self.class_of) < 1 << 16 else ids.ravel(), kind="stable")
        sorted_ids = ids.ravel()[order]
        first = np.flatnonzero(np.concatenate([[True], sorted_ids[1:] != sorted_ids[:-1]]))
        grads["emb"] = np.zeros_like(self.p["emb"])
        grads["emb"][sorted_ids[first]] = np.add.reduceat(slopes[order], first, axis=0)
        count = max(1, int(mask.sum()))
        return -float(logs.sum()) / count, {k: g / count for k, g in grads.items()}, after


class Adam:
    def __init__(self, model: Model, rate: float):
        self.model, self.rate, self.step, self.first, self.second = model, rate, 0, {}, {}

    def apply(self, grads: dict) -> None:
        self.step += 1
        scale = self.rate * np.sqrt(1 - 0.99 ** self.step) / (1 - 0.9 ** self.step)
        for k, g in grads.items():
            if k not in self.first:
                self.first[k], self.second[k] = np.zeros_like(self.model.p[k]), np.zeros_like(self.model.p[k])
            m, v = self.first[k], self.second[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            self.model.p[k] -= (scale * m / (np.sqrt(v) + 1e-6)).astype(np.float32)


def lanes_of(ids: np.ndarray, ends: np.ndarray, most: int = 256, least_steps: int = 512):
    """Whole texts laid end to end in lanes of similar length, longest lane first.

    Returns ids, text of each token, freshness (0 where a text starts) and lane lengths; unused places hold text -1."""
    sizes = np.diff(ends)
    total, longest = int(sizes.sum()), int(sizes.max(initial=1))
    lanes = int(np.clip(min(4 * total // longest, total // least_steps), 1, most))
    heap, lane_of, place = [(0, i) for i in range(lanes)], np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for d in np.argsort(-sizes, kind="stable"):
        used, lane = heap[0]
        lane_of[d], place[d] = lane, used
        heapq.heapreplace(heap, (used + int(sizes[d]), lane))
    length = np.zeros(lanes, np.int64)
    for used, lane in heap:
        length[lane] = used
    order = np.argsort(-length, kind="stable")
    rank = np.empty(lanes, np.int64)
    rank[order] = np.arange(lanes)
    steps = int(length.max())
    text = np.full((steps, lanes), -1, np.int32)
    grid, fresh = np.zeros((steps, lanes), np.int32), np.ones((steps, lanes), np.float32)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    row = np.arange(total) - np.repeat(ends[:-1] - place, sizes)
    column = rank[lane_of[owner]]
    text[row, column], grid[row, column] = owner, ids
    fresh[place, rank[lane_of]] = 0
    return grid, text, fresh, length[order]


def windows_of(grid, text, fresh, length, steps: int):
    """Windows with the lanes still running, which are the first ones: `steps` long, and longer where few
    lanes run, so that a window holds about WINDOW_TOKENS."""
    a = 0
    while a < len(grid):
        n = int(np.searchsorted(-length, -a, side="left"))
        b = a + max(steps, min(8 * steps, WINDOW_TOKENS // n))
        yield grid[a:b, :n], text[a:b, :n], fresh[a:b, :n], n
        a = b


def pools(batches, most: int):
    """Batches joined until they hold about `most` bytes of text."""
    held, size = [], 0
    for batch in slices(batches, "body", most // 4):
        held.append(batch)
        size += batch.column("body").nbytes
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def pool_tokens(held) -> tuple[np.ndarray, np.ndarray]:
    parts = [tokens_of(b.column("body")) for b in held]
    ends = [np.zeros(1, np.int64)]
    for tokens, e in parts:
        ends.append(e[1:] + ends[-1][-1])
    return np.concatenate([t for t, _ in parts]), np.concatenate(ends)


def network_ids(vocab: Vocabulary, at: np.ndarray) -> np.ndarray:
    return np.where(at >= 0, vocab.ids[at], np.int32(vocab.tail))


def train(docs: DataFrame, vocab: Vocabulary, rounds: int = 3, steps: int = 32, rate: float = 0.01) -> Model:
    """Every training document (key, body) once, in `rounds` parts; weights are averaged after each part.

    A hash of key and text deals documents to parts and to learners, and orders them there; the number of learners
    follows that of the tokens, and averages are sums of whole numbers, so the model does not depend on how the
    table is partitioned. Rows that repeat key and text meet at one learner, which reads its texts in bounded pools."""
    model = Model(vocab)
    learners = max(1, -(-vocab.total // LEARNER_TOKENS))
    dealt = docs.select("body", F.xxhash64("key", "body").alias("deal"))
    part_of = F.pmod(F.shiftright("deal", 32), F.lit(rounds))

    def learn(batches):
        local, seen = Model(vocab), 0
        local.load(flat)
        adam = Adam(local, rate)
        for held in pools(batches, POOL):
            tokens, ends = pool_tokens(held)
            ids = network_ids(vocab, look_up(vocab, tokens))
            grid = lanes_of(ids, ends)
            h = np.zeros((grid[0].shape[1], local.hidden), np.float32)
            for part, text, fresh, n in windows_of(*grid, steps):
                _, grads, h = local.gradients(part, fresh, text >= 0, h[:n])
                adam.apply(grads)
            seen += len(tokens)
        if seen:
            weight, done = -(-seen // 1024), local.flat()
            cuts = [done[i:i + BLOCK].tobytes() for i in range(0, len(done), BLOCK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(cuts)), pa.int32()), pa.array(cuts, pa.binary()),
                                              pa.array([weight] * len(cuts), pa.int64())], ["block", "data", "n"])

    def add_up(frames, learned: bool):
        """Sums per block of what the task holds: weights as learned, times their tokens, or sums."""
        total: dict[int, list] = {}
        for frame in frames:
            for block, data, n in zip(frame["block"], frame["data"], frame["n"]):
                held = total.setdefault(block, [0, 0])
                part = np.rint(np.frombuffer(data, np.float32) * np.float64(FINE)).astype(np.int64) * n if learned else np.frombuffer(data, np.int64)
                held[0] = held[0] + part
                held[1] += n
        if total:
            yield pd.DataFrame([(b, s.tobytes(), n) for b, (s, n) in total.items()], columns=["block", "data", "n"])

    row = "block int, data binary, n long"
    for r in range(rounds):
        flat = model.flat()
        part = dealt.where(part_of == r).repartition(learners, "deal").sortWithinPartitions("deal")
        learned = part.select("body").mapInArrow(learn, row)
        if learners > 64:  # in two steps, so that no task of the last one reads every learner
            some = F.pmod(F.spark_partition_id(), F.lit(int(learners ** 0.5)))
            learned = learned.withColumn("some", some).repartition(partitions(docs), "block", "some").select("block", "data", "n")
            learned = learned.mapInPandas(lambda f: add_up(f, True), row)
        sums = learned.repartition(partitions(docs), "block")
        blocks = sums.mapInPandas(lambda f: add_up(f, learners <= 64), row).collect()
        if blocks:
            means = [np.frombuffer(b.data, np.int64) / (b.n * FINE) for b in sorted(blocks, key=lambda b: b.block)]
            model.load(np.concatenate(means).astype(np.float32))
    return model


def score_pool(vocab: Vocabulary, model: Model, tokens: np.ndarray, ends: np.ndarray, steps: int = 32):
    """Per text: natural log probability but for the share inside the tail, listed and known tokens, and their
    summed log10 weight; and the vocabulary row of each token."""
    at = look_up(vocab, tokens)
    texts = len(ends) - 1
    owner = np.repeat(np.arange(texts), np.diff(ends))
    there = at >= 0
    logs = np.bincount(owner[there], vocab.inside[at[there]], texts)
    weight = np.bincount(owner[there], vocab.weight[at[there]], texts)
    listed = np.bincount(owner[there], minlength=texts)
    known = np.bincount(owner[there], vocab.known[at[there]], texts).astype(np.int64)
    grid = lanes_of(network_ids(vocab, at), ends)
    h = np.zeros((grid[0].shape[1], model.hidden), np.float32)
    for part, text, fresh, n in windows_of(*grid, steps):
        before, h = model.window(part, fresh, h[:n])
        live = text >= 0
        out, _ = model.output(before[live], part[live])
        logs += np.bincount(text[live], out, texts)
    return logs, listed, known, weight, at


def is_held_out(key: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(10)) == 0, F.lit(False))


def score_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows whose crc32(key) mod 10 is 0 are held out, a null key is not. Tokens are runs other than white space, A-Z
    as a-z, and one end per text; a null or empty text is its end alone. base_score is the smoothed
    unigram log10 probability, score that of the network; all words unseen in training are one event in both.
    Repeated rows get equal rows; without training rows every token is unseen; an empty
    table gives an empty result; other columns are not read.
    """
    docs = docs.select(F.col(key).alias("doc_id"), is_held_out(F.col(key)).alias("held_out"), text_of(text).alias("body"))
    learn = docs.where(~F.col("held_out")).select(F.col("doc_id").alias("key"), "body")
    counts = stage(count_words(learn), "words")
    vocab = vocabulary(counts)
    model = train(learn, vocab)

    def score(batches):
        for held in pools(batches, POOL):
            tokens, ends = pool_tokens(held)
            texts = len(ends) - 1
            logs, listed, known, weight, at = score_pool(vocab, model, tokens, ends)
            owner, words = np.repeat(np.arange(texts), np.diff(ends))[at < 0], tokens[at < 0]
            if len(words):
                word, doc, n = summed([(words, owner.astype(np.uint64), np.ones(len(words), np.int64))])
                order = np.argsort(doc, kind="stable")
                word, doc, n = word[order], doc[order], n[order]
            else:
                word, doc, n = words, owner, owner
            cuts = pa.array(np.searchsorted(doc, np.arange(texts + 1)), pa.int32())
            columns = pa.Table.from_batches([b.select(["doc_id", "held_out"]) for b in held])
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays(columns[c].chunks) for c in ("doc_id", "held_out")]
                + [pa.array(np.diff(ends)), pa.array(listed), pa.array(known), pa.array(weight), pa.array(logs / np.log(10)),
                   pa.ListArray.from_arrays(cuts, pa.array(word.view(np.int64))), pa.ListArray.from_arrays(cuts, pa.array(n.astype(np.int64)))],
                ["doc_id", "held_out", "n_tokens", "listed", "known", "weight", "logs", "words", "times"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.mapInArrow(score, f"doc_id {kind}, held_out boolean, n_tokens long, listed long, known long, weight double, logs double, "
                                   "words array<long>, times array<long>")
    found = stage(found.withColumn("row_id", F.monotonically_increasing_id()), "scored")
    tail = found.select("row_id", F.explode(F.arrays_zip("words", "times")).alias("x")).select(
        "row_id", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
    met = tail.join(counts.select("word", "n"), "word").groupBy("row_id").agg(
        F.sum("times").alias("met"), F.sum(F.col("times") * F.log10(F.col("n") + SMOOTH)).alias("met_weight"))
    rows = found.drop("words", "times").join(met, "row_id", "left")
    met, unlisted = F.coalesce("met", F.lit(0)), F.col("n_tokens") - F.col("listed")
    inside = F.coalesce("met_weight", F.lit(0.0)) + (unlisted - met) * float(np.log10(SMOOTH))
    return rows.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + met).alias("n_known"), F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("weight") + inside - F.col("n_tokens") * float(np.log10(vocab.total + SMOOTH * (vocab.distinct + 1)))).alias("base_score"),
        (F.col("logs") + inside - unlisted * vocab.tail_log10).alias("score"))
