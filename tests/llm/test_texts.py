"""Line de-duplication, decontamination and repeated strings."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from acreage.llm import run_index as R
from acreage.llm.decontam import decontaminate, leaks
from acreage.llm.line_dedup import line_dedup
from tests.llm.brute import removed_spans

SCHEMA = "doc_id long, text string"


def frame(spark, rows, *extra):
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in extra})


def lines_left(rows, window=2, min_words=50):
    """What the operator should leave, window by window."""
    seen, out = set(), {}
    for d, text in sorted({(d, t or "") for d, t in rows}):
        lines = text.split("\n")
        units = [(i, x.strip(" \t\r")) for i, x in enumerate(lines) if x.strip(" \t\r")]
        spans = [(s, window) for s in range(len(units) - window + 1)]
        spans += [(s, 1) for s in range(len(units)) if len(units[s][1].split()) >= min_words and window > 1]
        gone = set()
        for s, n in spans:
            content = (n, tuple(t for _, t in units[s:s + n]))
            if content in seen:
                gone |= {i for i, _ in units[s:s + n]}
            seen.add(content)
        out[d] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def test_line_runs_equal_brute_force(spark):
    rng = random.Random(1)
    pool = [f"line {i} of the pool" for i in range(12)] + ["", "  ", " ".join(["long"] * 60)]
    rows = [(i, "\n".join(rng.choice(pool) + rng.choice(["", " ", "\r"]) for _ in range(rng.randrange(0, 9)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (3, rows[3][1])]
    got = line_dedup(frame(spark, rows, "gone", "units", "dedup", "row_id", "cut")).collect()
    want = lines_left(rows)
    assert len(got) == len(rows)
    assert all((r.dedup.text or "") == want[r.doc_id] for r in got)
    assert next(r for r in got if r.doc_id == 100).dedup.text is None


@pytest.mark.parametrize("window", [2, 3, 5])
def test_runs_around_fingerprints_equal_brute_force(spark, window):
    rng = random.Random(window)
    pool = ["same", "same", "a footer", "}"] + [f"line {i}" for i in range(6)]
    runs = [[rng.choice(pool) for _ in range(rng.randrange(1, 9))] for _ in range(5)]
    rows = [(i, "\n".join([f"own {i}", *rng.choice(runs), *rng.choice(runs), *(["same"] * rng.randrange(4))])) for i in range(30)]
    rows += [(50, "same\n" * 40), (51, "x"), (-4, rows[3][1])]
    got = line_dedup(frame(spark, rows), window=window).collect()
    want = lines_left(rows, window)
    assert {r.doc_id: r.dedup.text or "" for r in got} == want


def test_line_dedup_of_nothing(spark):
    assert line_dedup(frame(spark, [])).count() == 0


ITEM = "Then Alice buys 12 apples and 3 kg of rice at the market while Alice sells 12 pears to Bob on day 7."


def test_leaks_follow_consistent_slots(spark):
    docs = [(1, f"Intro. {ITEM} end"), (1, f"Intro. {ITEM} end"), (None, ITEM),
            (2, "so then Carol buys 15 apples and 4 kg of rice at the market while Carol sells 15 pears to Dan on day 9. ok"),
            (3, "so then Carol buys 15 apples and 4 kg of rice at the market while Eve sells 99 pears to Dan on day 9. ok"),
            (4, None), (5, ""), (6, "clean text about nothing at all which is long enough to have windows"), (7, "TINY, item (here)!"), (8, "?? ..."),
            (9, "a tiny item here and more")]
    items = spark.createDataFrame([(10, ITEM), (11, None), (12, "..."), (13, "Tiny item here")], "item_id long, text string")
    items = items.withColumns({c: F.lit(0) for c in ("p", "key", "length")})
    df = frame(spark, docs, "words", "hits", "item_id", "raw")
    got = {(r.doc_id, r.item_id): r.literal for r in leaks(df, items).collect()}
    assert got == {(1, 10): True, (None, 10): True, (2, 10): False, (7, 13): True}
    left = decontaminate(df, items)
    assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == [3, 4, 5, 6, 8, 9]
    assert leaks(df.limit(0), items).count() == 0 and leaks(df, items.limit(0)).count() == 0


def test_quotations_and_near_copies_of_items_are_found(spark):
    long = " ".join(f"w{i}x" for i in range(59))
    words = long.split()
    near = ITEM.replace("buys 12", "buys 15")
    docs = [(1, "so " + " ".join(words[10:39]) + " end"), (2, " ".join(words[:12]) + " end"), (3, f"Intro. {near} end"),
            (4, "she went to the market today"), (5, "market"), (6, "Market?"), (7, " ".join(words[:13]))]
    items = spark.createDataFrame([(10, ITEM), (11, long), (12, "market")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.longest_run, r.literal) for r in leaks(frame(spark, docs), items).collect()}
    assert got == {(1, 11): (29, True), (3, 10): (19, True), (5, 12): (1, True), (6, 12): (1, True), (7, 11): (13, True)}


def repetitive(seed, n=80):
    rng = random.Random(seed)
    text = lambda k: "".join(rng.choice("abé \n") for _ in range(k))
    shared = [text(rng.randrange(40, 200)) for _ in range(6)]
    rows = [(i * 3, text(rng.randrange(0, 60)) + rng.choice(shared) + text(rng.randrange(0, 60)) + rng.choice(["", rng.choice(shared)])) for i in range(n)]
    return rows + [(1000, None), (1001, ""), (1002, "a" * 400), (1003, "a" * 90), (1004, rows[5][1])]


def digests(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


@pytest.mark.parametrize("crowded", [4096, 2])
def test_repeated_strings_equal_brute_force(spark, monkeypatch, crowded):
    monkeypatch.setattr(R, "CROWDED", crowded)
    rows = repetitive(2)
    got = digests(R.remove_repeats(frame(spark, rows, "doc", "body", "bucket", "kind").repartition(5)))
    want = {d: (*x[:3], hashlib.sha256(x[3]).hexdigest()) for d, x in removed_spans(rows).items()}
    assert got == want


def test_keys_of_any_sign_keep_value_and_order(spark):
    rows = [(d * 7 - 300, t) for d, t in repetitive(4, 40)] + [(-2**61, "z" * 60), (2**61 - 1, "z" * 70)]
    got = digests(R.remove_repeats(frame(spark, rows)))
    assert got == {d: (*x[:3], hashlib.sha256(x[3]).hexdigest()) for d, x in removed_spans(rows).items()}


def test_other_keys_are_refused(spark):
    with pytest.raises(TypeError, match="whole numbers"):
        R.remove_repeats(spark.createDataFrame([("a", "b")], "doc_id string, text string"))
    with pytest.raises(ValueError, match="span"):
        R.remove_repeats(frame(spark, [(-2**62, "a"), (5, "b")]))


def test_one_key_with_two_texts_and_none(spark):
    a, b = "x" * 10 + "".join(map(str, range(60))), "y" * 10 + "".join(map(str, range(60)))
    rows = [(1, a), (1, b), (None, b), (None, a)]
    got = sorted((r.doc_id or 0, r.n_removed, r.n_bytes) for r in R.remove_repeats(frame(spark, rows)).collect())
    assert got == [(0, len(a), len(a)), (0, len(b), len(b)), (1, 0, len(a)), (1, 0, len(b))]
    assert R.remove_repeats(frame(spark, [])).count() == 0


def test_lengths_sampled_at_run_heads_are_the_common_lengths():
    import numpy as np

    rng = random.Random(5)
    text = np.frombuffer(("".join(rng.choice("ab") for _ in range(40)) * 6 + "~0~1").encode(), np.uint8)
    order = R.suffix_order(text)
    raw = text.tobytes()
    assert [raw[i:] for i in order] == sorted(raw[i:] for i in range(len(raw)))
    common = R.shared_lengths(text, order, 1000)
    for a, b in zip(order[:-1], order[1:]):
        n = 0
        while max(a, b) + n < len(raw) and raw[a + n] == raw[b + n]:
            n += 1
        assert common[b] == n


def test_lines_of_their_own_equal_brute_force(spark):
    rng = random.Random(3)
    pool = ["a footer", "}", "", " \t"] + [f"line {i} of the pool" for i in range(40)]
    rows = [(i, "\n".join(rng.choice(pool) + rng.choice(["", " "]) for _ in range(rng.randrange(0, 9)))) for i in range(60)]
    got = line_dedup(frame(spark, rows), window=1).collect()
    want = lines_left(rows, window=1)
    assert all((r.dedup.text or "") == want[r.doc_id] for r in got)


def test_query_removes_repeated_runs_and_lone_lines(spark, tmp_path):
    from acreage.llm.queries import op9_line_dedup

    rows = [(1, "a\nb\nc\nown"), (2, "x\na\nb\nc"), (3, "c\nother\nb"), (4, None)]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.n_lines, r.n_removed, r.n_in_runs) for r in op9_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: (4, 0, 0), 2: (4, 3, 3), 3: (3, 2, 0), 4: (1, 0, 0)}


def test_time_of_a_long_document_grows_with_its_lines(spark):
    import time

    rng = random.Random(8)
    text = "\n".join(f"line {rng.randrange(10_000)}" for _ in range(20_000))
    started = time.time()
    got = line_dedup(frame(spark, [(1, text)]), window=2, min_words=0).collect()
    assert got[0].dedup.text == lines_left([(1, text)], window=1)[1]
    assert time.time() - started < 60


def by_text(data, offsets):
    """Contexts of each text, with places counted from its start."""
    picks = R.Picks(data, offsets)
    start = offsets[picks.text]
    rows = zip(*(x.tolist() for x in (picks.place - start, picks.first - start, picks.last - start, picks.gram, picks.content)))
    out = {}
    for t, row in zip(picks.text.tolist(), rows):
        out.setdefault(bytes(data[offsets[t]:offsets[t + 1]]), set()).add(row)
    return out


def test_contexts_depend_on_the_text_alone(monkeypatch):
    import numpy as np

    monkeypatch.setattr(R, "PIECE", 300)
    rng = random.Random(6)
    texts = ["".join(rng.choice("ab \n") for _ in range(n)).encode() for n in (0, 30, 49, 50, 120, 299, 300, 301, 600, 1500, 2000, 80)]
    found = []
    for _ in range(4):
        rng.shuffle(texts)
        sizes = np.cumsum([0, *map(len, texts)])
        found.append(by_text(np.frombuffer(b"".join(texts), np.uint8), sizes))
    assert found[0] and all(f == found[0] for f in found)


def test_passes_in_different_orders_equal_brute_force(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(R, "PIECE", 300)
    rows = [(d, t or "") for d, t in repetitive(7, 40)]
    buckets = 3

    def batches(order):
        some = [rows[i] for i in order]
        yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in some], pa.int64()), pa.array([t for _, t in some])], ["doc", "body"])

    def by_bucket(*parts):
        whole = pa.concat_tables([pa.Table.from_batches(list(p)) for p in parts])
        return whole.sort_by([("bucket", "ascending"), ("kind", "ascending")]).to_batches()

    rng = random.Random(8)
    for _ in range(3):
        one, two = (rng.sample(range(len(rows)), len(rows)) for _ in range(2))
        marks = list(R.settle_grams(by_bucket(R.gather_grams(batches(one), buckets)), buckets))
        texts = list(R.packed_texts(batches(two), buckets))
        spans = R.settle_contexts(by_bucket(R.look_up_contexts(by_bucket(marks, texts), buckets)), buckets)
        got = pa.Table.from_batches(list(R.cut_texts(by_bucket(spans, texts), "digest"))).to_pylist()
        want = {d: (*x[:3], hashlib.sha256(x[3]).hexdigest()) for d, x in removed_spans(rows).items()}
        assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == want
