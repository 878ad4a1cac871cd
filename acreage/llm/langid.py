"""Language of whole texts by a bidirectional gated recurrent network over bytes.

The network reads two bytes a step, forwards and backwards, and labels both positions; it is
trained in numpy by backpropagation through time on a bounded sample. Texts are read in windows, every
byte is labelled, and the label probabilities of the letter bytes are averaged over the document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from acreage.llm.common import flat_bytes, slices, text_of

STEP = 2
WINDOW = 256
LANES = 1024
UNKNOWN = "und"


#: What the network reads: A-Z as a-z, so that shouting is no other language.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def letters() -> np.ndarray:
    """Bytes that count as positions: ASCII letters and all bytes of other characters."""
    out = np.zeros(256, bool)
    out[65:91] = out[97:123] = out[128:] = True
    return out


class Network:
    """Two GRUs over byte pairs and one softmax per position. Gates are in the order update, reset, new."""

    def __init__(self, labels: int, hidden: int = 16, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels, self.hidden = labels, hidden
        wide = lambda *s, scale: rng.normal(0, scale, s).astype(np.float32)
        self.p = {}
        for d in "fb":
            for j in range(STEP):
                self.p[f"in{j}{d}"] = wide(256, 3 * hidden, scale=0.3)
            self.p[f"rec{d}"] = wide(hidden, 3 * hidden, scale=hidden ** -0.5)
            self.p[f"bias{d}"] = np.zeros(3 * hidden, np.float32)
            self.p[f"out{d}"] = wide(hidden, STEP * labels, scale=hidden ** -0.5)
        self.p["outb0"] = np.zeros(STEP * labels, np.float32)

    def run(self, x: np.ndarray, d: str, tape: list | None = None) -> np.ndarray:
        """Hidden states (steps, lanes, hidden) of one direction for bytes x (steps, lanes, STEP)."""
        n = self.hidden
        rec, bias = self.p[f"rec{d}"], self.p[f"bias{d}"]
        gates, fresh = np.ascontiguousarray(rec[:, :2 * n]), np.ascontiguousarray(rec[:, 2 * n:])
        tables = [(np.ascontiguousarray(self.p[f"in{j}{d}"][:, :2 * n]), np.ascontiguousarray(self.p[f"in{j}{d}"][:, 2 * n:]))
                  for j in range(STEP)]
        tables[0] = (tables[0][0] + bias[:2 * n], tables[0][1] + bias[2 * n:])
        steps, lanes = x.shape[:2]
        h = np.zeros((lanes, n), np.float32)
        out = np.empty((steps, lanes, n), np.float32)
        order = range(steps) if d == "f" else range(steps - 1, -1, -1)
        for t in order:
            zr, new = h @ gates, h @ fresh
            for j, (a, _) in enumerate(tables):
                zr += a.take(x[t, :, j], axis=0)
            zr *= 0.5
            np.tanh(zr, out=zr)
            zr += 1
            zr *= 0.5
            raw = new.copy() if tape is not None else None
            new *= zr[:, n:]
            for j, (_, b) in enumerate(tables):
                new += b.take(x[t, :, j], axis=0)
            np.tanh(new, out=new)
            nxt = h - new
            nxt *= zr[:, :n]
            nxt += new
            if tape is not None:
                tape.append((t, h, zr, new, raw))
            h = nxt
            out[t] = h
        return out

    def probabilities(self, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
        """Label probabilities (steps, lanes, STEP, labels)."""
        steps, lanes, n = forward.shape
        flat = forward.reshape(-1, n) @ self.p["outf"] + backward.reshape(-1, n) @ self.p["outb"]
        flat += self.p["outb0"]
        flat = flat.reshape(steps, lanes, STEP, self.labels)
        flat -= flat.max(axis=-1, keepdims=True)
        np.exp(flat, out=flat)
        flat /= flat.sum(axis=-1, keepdims=True)
        return flat

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.probabilities(self.run(x, "f"), self.run(x, "b"))

    def gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Weighted mean cross-entropy of positions, and its gradient by backpropagation through time.

        x: (steps, lanes, STEP) bytes, y: (lanes,) labels, weight: as x, 1 for positions that count."""
        n, grads = self.hidden, {}
        tapes: dict[str, list] = {"f": [], "b": []}
        states = {d: self.run(x, d, tapes[d]) for d in "fb"}
        prob = self.probabilities(states["f"], states["b"])
        total = max(1.0, float(weight.sum()))
        own = prob[:, np.arange(len(y)), :, y].transpose(1, 0, 2)
        loss = float(-(np.log(own + 1e-9) * weight).sum() / total)
        delta = prob.copy()
        delta[:, np.arange(len(y)), :, y] -= 1
        delta *= weight[..., None] / total
        flat = delta.reshape(-1, STEP * self.labels)
        grads["outb0"] = flat.sum(axis=0)
        for d in "fb":
            grads[f"out{d}"] = states[d].reshape(-1, n).T @ flat
            above = (flat @ self.p[f"out{d}"].T).reshape(states[d].shape)
            rec = self.p[f"rec{d}"]
            drec, dh = np.zeros_like(rec), np.zeros(above.shape[1:], np.float32)
            din = np.empty((*x.shape[:2], 3 * n), np.float32)
            for t, h, zr, new, raw in reversed(tapes[d]):
                dh = dh + above[t]
                z, r = zr[:, :n], zr[:, n:]
                dnew = dh * (1 - z) * (1 - new * new)
                dz = dh * (h - new) * z * (1 - z)
                dr = dnew * raw * r * (1 - r)
                din[t] = np.concatenate([dz, dr, dnew], axis=1)
                back = np.concatenate([dz, dr, dnew * r], axis=1)
                drec += h.T @ back
                dh = dh * z + back @ rec.T
            flat_in = din.reshape(-1, 3 * n)
            grads[f"rec{d}"], grads[f"bias{d}"] = drec, flat_in.sum(axis=0)
            for j in range(STEP):
                hot = np.zeros((256, len(flat_in)), np.float32)
                hot[x[:, :, j].ravel(), np.arange(len(flat_in))] = 1
                grads[f"in{j}{d}"] = hot @ flat_in
        return loss, grads

    def fit(self, x: np.ndarray, y: np.ndarray, rounds: int = 500, lanes: int = 96, rate: float = 0.01, seed: int = 8) -> float:
        """Adam over random batches of x (n, bytes); returns the last loss."""
        rng, first, second, loss = np.random.default_rng(seed), {}, {}, 0.0
        counted = letters()
        for step in range(1, rounds + 1):
            rows = rng.integers(0, len(x), lanes)
            batch = x[rows].reshape(len(rows), -1, STEP).transpose(1, 0, 2)
            loss, grads = self.gradients(batch, y[rows], counted[batch].astype(np.float32))
            now = rate * min(1.0, 2 * (1 - step / (rounds + 1)))
            for k, g in grads.items():
                g = np.clip(g, -1, 1)
                first[k] = 0.9 * first.get(k, 0) + 0.1 * g
                second[k] = 0.99 * second.get(k, 0) + 0.01 * g * g
                self.p[k] = (self.p[k] - now * (first[k] / (1 - 0.9 ** step))
                             / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
        return loss


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, first byte and length of the windows that together cover every text."""
    sizes = np.diff(offsets)
    counts = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = offsets[owner] + nth * WINDOW
    return owner, start, np.minimum(WINDOW, offsets[owner + 1] - start)


def pooled(net: Network, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of label probabilities over the letter bytes of each text, and labelled bytes by label."""
    texts = len(offsets) - 1
    sums, votes = np.zeros((texts, net.labels)), np.zeros((texts, net.labels), np.int64)
    owner, start, size = windows(data, offsets)
    counted = letters()
    order = np.argsort(-size, kind="stable")
    padded = np.concatenate([FOLD[data], np.zeros(WINDOW, np.uint8)])
    for a in range(0, len(order), LANES):
        part = order[a:a + LANES]
        width = int(-(-size[part[0]] // STEP) * STEP)
        x = padded[start[part][:, None] + np.arange(width)]
        x[np.arange(width) >= size[part][:, None]] = 0
        prob = net.predict(x.reshape(len(part), -1, STEP).transpose(1, 0, 2))
        prob = prob.transpose(0, 2, 1, 3).reshape(width, len(part), net.labels)
        mask = counted[x].T
        label = prob.argmax(axis=2)
        prob *= mask[:, :, None]
        np.add.at(sums, owner[part], prob.sum(axis=0))
        np.add.at(votes, owner[part], np.stack([((label == k) & mask).sum(axis=0) for k in range(net.labels)], axis=1))
    return sums, votes


def in_thirds(key: Column) -> Column:
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(3))


def sample_windows(docs: DataFrame, per_language: int, length: int) -> tuple[list[str], list[tuple[str, str]]]:
    """Languages and (text window, language) pairs of the learning rows, at most `per_language` each.

    Rows are drawn by a hash, so that every row of a language is as likely, and only a window of each goes to the driver."""
    draw = F.xxhash64("doc_id", "body", F.lit(3))
    learn = docs.where(F.col("learn") & F.col("lang").isNotNull() & F.col("body").rlike(r"\p{L}"))
    counts = {r.lang: r.n for r in learn.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    keep = F.lit(False)
    for lang, n in counts.items():
        share = min(1.0, 1.2 * per_language / n)
        keep |= (F.col("lang") == lang) & (F.pmod("draw", F.lit(1 << 30)) < int(share * (1 << 30)))
    place = (F.pmod(F.shiftrightunsigned("draw", 33), F.greatest(F.lit(1), F.length("body") - length)) + 1).cast("int")
    rows = learn.withColumn("draw", draw).where(keep).select("draw", "lang", F.substring("body", place, F.lit(length)).alias("part"))
    found: dict[str, list] = {}
    for r in sorted(rows.collect(), key=lambda r: (r.draw, r.part)):
        found.setdefault(r.lang, []).append(r.part)
    return sorted(found), [(part, lang) for lang in sorted(found) for part in found[lang][:per_language]]


def train(docs: DataFrame, per_language: int, length: int = 160) -> tuple[list[str], Network]:
    languages, pairs = sample_windows(docs, per_language, length)
    net = Network(max(1, len(languages)))
    if len(languages) > 1:
        x = np.zeros((len(pairs), length), np.uint8)
        for i, (part, _) in enumerate(pairs):
            raw = part.encode()[:length]
            x[i, :len(raw)] = FOLD[np.frombuffer(raw, np.uint8)]
        net.fit(x, np.array([languages.index(lang) for _, lang in pairs]))
    return languages, net


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = 2000) -> DataFrame:
    """One row per document: doc_id, text_key, held_out, lang_pred, score, positions.

    Learns from at most `per_language` rows of each non-null language whose crc32(key) mod 3 is 0 or
    2; held_out is remainder 1 (false for a null key, from which nothing is learned). lang_pred is the
    label with the highest mean probability over the letter bytes, score that mean, positions the
    bytes labelled with it. Texts that are null or have no letter get `und` and 0, as do all texts when
    nothing can be learned; a tie takes the first label in order. Repeated rows give equal rows, an empty
    table an empty result; other columns are not read.
    """
    third = in_thirds(F.col(key))
    docs = docs.select(F.col(key).alias("doc_id"), text_of(text).alias("body"), F.col(lang).cast("string").alias("lang"),
                       F.coalesce(third == 1, F.lit(False)).alias("held_out"), F.coalesce(third != 1, F.lit(False)).alias("learn"))
    languages, net = train(docs, per_language)

    def predict(batches):
        for batch in slices(batches, "body", 1 << 20):
            data, offsets = flat_bytes(batch.column("body"))
            sums, votes = pooled(net, data, offsets)
            best = sums.argmax(axis=1)
            total = sums.sum(axis=1)
            known = (total > 0) & np.array(batch.column("lettered").to_pylist()) & bool(languages)
            rows = np.arange(len(best))
            score = np.where(known, sums[rows, best] / np.where(total > 0, total, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), batch.column("held_out"),
                 pa.array([languages[b] if k else UNKNOWN for b, k in zip(best, known)], pa.string()),
                 pa.array(score), pa.array(np.where(known, votes[rows, best], 0))],
                ["doc_id", "text_key", "held_out", "lang_pred", "score", "positions"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64(F.col("body").cast("binary")).alias("text_key"), "held_out", "body",
                       F.col("body").rlike(r"\p{L}").alias("lettered"))
    return rows.mapInArrow(predict, f"doc_id {kind}, text_key long, held_out boolean, lang_pred string, score double, positions long")
