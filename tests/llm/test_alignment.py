"""Alignment of two tokenizers against a pairwise version."""

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from acreage.llm import alignment as L
from acreage.llm.queries import BYTE_BPE, PIECE_MODEL

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def vocabularies():
    return L.Vocabularies.load(BYTE_BPE, PIECE_MODEL)


def spans(tokens):
    out, at = [], 0
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def tokens_of(text):
    """(id, bytes) of both vocabularies by their own libraries; none if the bytes are not those of space and text."""
    a = Tokenizer.from_file(BYTE_BPE)
    a.encode_special_tokens = True
    letters = L.byte_letters()
    b = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    if not text:
        return [], []
    first = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    second = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        second.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    raw = (" " + text).encode()
    same = all(b"".join(t for _, t in side) == raw for side in (first, second))
    return (spans(first), spans(second)) if same else ([], [])


def brute(rows):
    """What the digest should say, every pair of tokens of a document compared."""
    found, counts = [], Counter()
    for d, text in rows:
        a, b = tokens_of(text)
        links = [(x, y) for x in a for y in b if max(x[1], y[1]) < min(x[2], y[2])]
        counts.update((x[0], y[0]) for x, y in links)
        found.append((d, a, b, links))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for d, a, b, links in found:
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        parts = [",".join(str(i) for i, _, e in a if low < e <= high) + "|" + ",".join(str(i) for i, _, e in b if low < e <= high)
                 for low, high in zip([0, *cuts], cuts)]
        out.append((d, len(a), len(b), len(cuts), len(links), sum(counts[x[0], y[0]] == best[y[0]] for x, y in links),
                    sum(counts[x[0], y[0]] for x, y in links), hashlib.sha256(";".join(parts).encode()).hexdigest() if a else ""))
    return sorted(out, key=str)


def sample():
    rng = random.Random(3)
    words = ["the", "market", "Ünïcode", "naïve", "été", "12,345", "don't", "  ", "\n", "\t", "<s>", "<|endoftext|>", "</s>",
             "日本語", "🙂🙃", "ɐʁʷ", "x" * 40, "!!!", "a_b-c", "résumé", "\x00", "Ωmega"]
    rows = [(i, rng.choice(["", " "]).join(rng.choice(words) for _ in range(rng.randrange(1, 40)))) for i in range(40)]
    rows += [(50, None), (51, ""), (52, " "), (53, "mark▁mark"), (None, "no key here"), (54, rows[3][1]), (54, rows[3][1])]
    return rows


def test_digest_equals_brute_force_however_it_is_cut(spark, monkeypatch):
    rows = sample()
    want = brute(rows)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("pairs", "n", "row_id", "body", "best")})
    for parts, block in ((1, L.BLOCK), (5, 40)):
        got = L.alignment_digest(df.repartition(parts), BYTE_BPE, PIECE_MODEL, block=block).select(*columns).collect()
        assert sorted(map(tuple, got), key=str) == want


def test_long_texts_go_by_lanes(spark, vocabularies):
    import pyarrow as pa

    rng = random.Random(4)
    texts = ["".join(rng.choice("abcde fghij\n") for _ in range(n)) for n in (3000, 20)] + ["z" * 5000, "tail"]
    whole = L.align_batch(vocabularies, pa.array(texts))
    for lane in (8, 10**6):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(L, "LANE", lane)
            cut = L.align_batch(vocabularies, pa.array(texts))
        assert sorted(zip(*cut.links)) == sorted(zip(*whole.links))
        assert all((x == y).all() for x, y in zip(cut.cuts, whole.cuts))
    a, b = tokens_of(texts[0])
    links = [(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if max(x[1], y[1]) < min(x[2], y[2])]
    inside = whole.links[0] < len(a)
    assert sorted(zip(whole.links[0][inside], whole.links[1][inside])) == links


def test_both_libraries_of_the_byte_vocabulary_agree(vocabularies):
    texts = [t for _, t in sample() if t]
    assert vocabularies.fast is not None
    slow = vocabularies.encode_a(texts, [True] * len(texts))
    assert vocabularies.encode_a(texts, [False] * len(texts)) == slow


def test_alignment_keeps_the_table(spark):
    rows = sample()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"alignment": F.lit("old"), "other": F.lit(2)})
    out = L.align(df, BYTE_BPE, PIECE_MODEL)
    assert out.columns == ["doc_id", "text", "other", "alignment"]
    for r in out.collect():
        a, b = tokens_of(r.text)
        assert r.alignment.a_ids == [i for i, *_ in a] and r.alignment.b_ids == [i for i, *_ in b]
        assert r.alignment.cuts == sorted({e for *_, e in a} & {e for *_, e in b})
        assert [tuple(x) for x in r.alignment.links] == [
            (i, j) for i, x in enumerate(a) for j, y in enumerate(b) if max(x[1], y[1]) < min(x[2], y[2])]
    assert L.align(df.limit(0), BYTE_BPE, PIECE_MODEL).count() == 0


def test_digest_of_nothing(spark):
    assert L.alignment_digest(spark.createDataFrame([], SCHEMA), BYTE_BPE, PIECE_MODEL).count() == 0
    got = L.alignment_digest(spark.createDataFrame([(1, None), (2, "")], SCHEMA), BYTE_BPE, PIECE_MODEL).collect()
    assert all(tuple(r)[1:5] == (0, 0, 0, 0) and (r.n_best, r.count_sum, r.groups_sha256) == (0, 0, "") for r in got) and len(got) == 2
