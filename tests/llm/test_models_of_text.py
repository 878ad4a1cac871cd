"""Language identification, piece encoding and the language model."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from acreage.llm import langid, lm, pieces
from acreage.llm.common import flat_bytes
from acreage.llm.queries import PIECE_MODEL
from tests.llm.brute import words


def numeric(f, array, at, step=1e-3):
    value = array[at]
    array[at] = value + step
    high = f()
    array[at] = value - step
    low = f()
    array[at] = value
    return (high - low) / (2 * step)


def test_language_gradients():
    rng = np.random.default_rng(0)
    net = langid.Network(3, hidden=4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, y, w = rng.integers(0, 256, (5, 3, 2)).astype(np.uint8), np.array([0, 1, 2]), np.ones((5, 3, 2), np.float32)
    _, grads = net.gradients(x, y, w)
    for k, g in grads.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        assert math.isclose(numeric(lambda: net.gradients(x, y, w)[0], net.p[k], at), g[at], rel_tol=1e-3)


def test_languages_of_unseen_texts(spark):
    rng = random.Random(2)
    letters = {"aa": "abcde ", "bb": "vwxyz ", "cc": "éèüñç "}
    text = lambda lang, n: "".join(rng.choice(letters[lang]) for _ in range(n)) + letters[lang][0]
    rows = [(i, text(lang := rng.choice(list(letters)), rng.randrange(20, 900)), lang) for i in range(240)]
    odd = [(1000, None, "aa"), (1001, "12 34 !!", "aa"), (None, text("aa", 50), "aa"), (1002, text("bb", 50), None), (1003, "", None)]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").withColumns({c: F.lit(1) for c in ("body", "learn")})
    got = {r.doc_id: r for r in langid.identify(df).collect()}
    assert len(got) == len(rows) + len(odd)
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert all(got[r[0]].held_out == (r in held) for r in rows)
    assert sum(got[d].lang_pred == lang for d, _, lang in held) >= 0.95 * len(held)
    assert all((got[d].lang_pred, got[d].score) == ("und", 0.0) for d in (1000, 1001, 1003))
    assert got[1002].lang_pred == "bb" and not got[None].held_out and 0 <= got[None].score <= 1
    assert langid.identify(df.limit(0)).count() == 0
    nothing = langid.identify(df.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in nothing.select("lang_pred").distinct().collect()} == {"und"}


def test_window_positions_cover_the_whole_text():
    data = np.arange(1000, dtype=np.uint8)
    offsets = np.array([0, 0, 700, 701, 1000])
    owner, start, size = langid.windows(data, offsets)
    assert sorted(np.concatenate([np.arange(s, s + n) for s, n in zip(start, size)])) == list(range(1000))
    assert ((offsets[owner] <= start) & (start + size <= offsets[owner + 1])).all()


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Pieces.load(PIECE_MODEL)


def test_pieces_equal_the_library(vocabulary):
    library, rng = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL), random.Random(1)
    letters, names = "abcdefghijklmnopqrstuvwxyz ABC.,'éü  \n中文-=*", [p.replace("▁", " ") for p in vocabulary.ids]
    texts = ["Hello  world", "", None, " a", "a ", " " * 60, "\ta\n\nb   c", "ﬁ １２ é", " １", "x" * 300, "a\xa0b", "hello" * 500, "▁x", "<s>"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(200))) for _ in range(400)]
    texts += ["".join(rng.choice(names) for _ in range(rng.randrange(60))) for _ in range(400)]
    encoder = pieces.Encoder(vocabulary)
    for _ in range(2):  # anew, and from what is remembered
        ids, ends = encoder.encode(*flat_bytes(pa.array(texts)))
        for text, a, b in zip(texts, ends[:-1], ends[1:]):
            assert ids[a:b].tolist() == library.encode(text or ""), text
    out, offsets = pieces.decode(vocabulary, ids, ends)
    back = [out[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:])]
    assert back == [library.decode(library.encode(t or "")) for t in texts]


def test_encode_and_decode_tables(spark):
    rows = [(1, "some text"), (2, None), (3, ""), (1, "some text"), (4, "z" * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("pieces", F.lit("old"))
    made = pieces.encode(df, PIECE_MODEL)
    back = pieces.decoded(made.drop("text"), PIECE_MODEL).collect()
    assert sorted((r.doc_id, r.text) for r in back) == sorted((d, t or "") for d, t in rows)
    trip = pieces.round_trip(df, PIECE_MODEL).collect()
    assert all(r.round_trip for r in trip) and sorted(r.n_pieces for r in trip)[:2] == [0, 0]
    assert pieces.encode(df.limit(0), PIECE_MODEL).count() == 0


def some_counts():
    rng = np.random.default_rng(3)
    return [(int(rng.integers(1, 2**62)), n, int(rng.integers(0, 3))) for n in (40, 30, 9, 8, 7, 5, 3, 2, 2, 1)]


def test_language_model_gradients_and_total(spark):
    end = (int(lm.END.view(np.int64)), 12, 0)
    counts = spark.createDataFrame([*some_counts(), end, (77, 1, 0)], "word long, n long, topic long")
    vocab = lm.vocabulary(counts, head=5, most=11)
    assert vocab.total == 107 + 12 + 1 and vocab.distinct == 12
    model = lm.Model(vocab, hidden=3)
    rng = np.random.default_rng(4)
    model.p = {k: (v + rng.normal(0, 0.3, v.shape)) for k, v in model.p.items()}
    ids = rng.integers(0, len(vocab.class_of), (6, 4)).astype(np.int32)
    fresh, live = np.ones((6, 4)), np.ones((6, 4), bool)
    fresh[0], fresh[3, 1], live[4:, 2] = 0, 0, False
    h = np.zeros((4, 3))
    _, grads, _ = model.gradients(ids, fresh, live, h)
    for k, g in grads.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        exact = numeric(lambda: model.gradients(ids, fresh, live, h)[0], model.p[k], at)
        assert math.isclose(exact, g[at], rel_tol=2e-3, abs_tol=1e-6), k
    # head words, classes of listed words and the tail share one unit of probability
    state = rng.normal(0, 1, (1, 3))
    every = np.arange(len(vocab.class_of))
    logs, _ = model.output(np.repeat(state, len(every), axis=0), every)
    assert math.isclose(np.exp(logs).sum(), 1, rel_tol=1e-6)


def test_scores_of_whole_texts(spark, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 20)
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(vocab[:30] if i % 2 else vocab[30:]) for _ in range(rng.randrange(0, 120)))) for i in range(150)]
    rows += [(500, None), (501, ""), (502, "NEVER seen\x0bNever"), (503, rows[0][1]), (None, "w1 W1")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("word", "n", "body")})
    got = {r.doc_id: r for r in lm.score_texts(df).collect()}
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0
    tokens = {d: [*words(t), None] for d, t in rows}
    counts = Counter(w for d, ws in tokens.items() if not held(d) for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    for d, ws in tokens.items():
        r = got[d]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.held_out == held(d)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(counts[w] > 0 for w in ws), total)
    assert sum(r.score for r in got.values()) > sum(r.base_score for r in got.values())
    assert lm.score_texts(df.limit(0)).count() == 0


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm, "LEARNER_TOKENS", 400)  # more than 64 learners, so weights are added up in two steps
    rng = random.Random(16)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.7)) % 300}" for _ in range(rng.randrange(0, 200)))) for i in range(300)]
    rows += [(7, rows[7][1]), (-1, None), (None, "a b")]
    found = []
    for parts in (1, 4, 64):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        found.append(sorted((r.doc_id is not None, r.doc_id or 0, r.score) for r in lm.score_texts(df).collect()))
    for other in found[1:]:
        assert all(a[:2] == b[:2] and math.isclose(a[2], b[2], rel_tol=1e-6) for a, b in zip(found[0], other, strict=True))


def test_unlikely_rows_keep_a_finite_score(spark):
    counts = spark.createDataFrame(some_counts(), "word long, n long, topic long")
    model = lm.Model(lm.vocabulary(counts, head=5, most=10), hidden=3)
    model.p["clsb"] -= 500  # all classes underflow alike
    logs, _ = model.output(np.zeros((3, 3), np.float32), np.zeros(3, np.int32))
    assert np.isfinite(logs).all()


def test_state_is_carried_over_windows(spark):
    counts = spark.createDataFrame(some_counts(), "word long, n long, topic long")
    vocab = lm.vocabulary(counts, head=5, most=10)
    model = lm.Model(vocab, hidden=3)
    rng = np.random.default_rng(8)
    model.p = {k: (v + rng.normal(0, 0.5, v.shape)).astype(np.float32) for k, v in model.p.items()}
    tokens, ends = rng.choice(np.append(vocab.hashes, np.uint64(5)), 300), np.array([0, 1, 170, 171, 300])
    short, long = (lm.score_pool(vocab, model, tokens, ends, steps)[0] for steps in (7, 1000))
    assert np.allclose(short, long, atol=1e-3)
    for a, b, got in zip(ends[:-1], ends[1:], long):
        h, want = np.zeros((1, 3), np.float32), 0.0
        for token in tokens[a:b]:
            at = lm.look_up(vocab, np.array([token]))
            i = lm.network_ids(vocab, at)
            want += model.output(h, i)[0][0] + (vocab.inside[at[0]] if at[0] >= 0 else 0)
            _, h = model.window(i[:, None], np.ones((1, 1), np.float32), h)
        assert math.isclose(want, got, rel_tol=1e-3, abs_tol=1e-4)


def test_the_network_has_its_full_size(spark):
    import inspect

    counts = spark.createDataFrame([(i + 1, 5000 - i, 0) for i in range(3000)], "word long, n long, topic long")
    vocab = lm.vocabulary(counts)
    assert vocab.head == 1 + 2048 and lm.Model(vocab).hidden == 16  # the end of a text is one more
    assert inspect.signature(lm.train).parameters["rounds"].default == 3
