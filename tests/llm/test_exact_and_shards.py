import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from acreage.llm.exact_dedup import exact_dedup, misra_gries
from acreage.llm.sharding import shard

ROWS = [(5, "a  b"), (3, "a\tb"), (9, "a b"), (None, "a b"), (3, "a\tb"), (1, None), (2, ""), (4, "x" * 5000), (8, " a b")]
SCHEMA = "doc_id long, text string"


def clashing(spark, rows=ROWS):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit(None).cast("string") for c in ("digest", "n", "kept", "key", "size", "bucket", "shard")})


def test_exact_groups(spark):
    got = exact_dedup(clashing(spark), share=0.3, counters=16).collect()
    assert len(got) == len(ROWS)
    by = {(r.doc_id, r.text_sha256): r for r in got}
    digest = lambda t: hashlib.sha256(re.sub(r"[\x20\x09-\x0d]+", " ", t).encode()).hexdigest()
    for d, t in ROWS:
        same = [x for x, u in ROWS if digest(u or "") == digest(t or "")]
        r = by[d, digest(t or "")]
        assert (r.keep_id, r.group_size) == (min(x for x in same if x is not None), len(same))
    assert sum(r.kept for r in got) == 4  # the row that repeats key and text stays once


def test_hot_digest_is_the_same_by_either_path(spark):
    rows = [(i, "hot" if i % 3 else f"text {i}") for i in range(90)]
    few = exact_dedup(spark.createDataFrame(rows, SCHEMA), share=0.5, counters=4)
    none = exact_dedup(spark.createDataFrame(rows, SCHEMA), share=1.1)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, none.collect()))


def test_misra_gries_keeps_the_frequent():
    counts = misra_gries(Counter({"a": 50, **{i: 1 for i in range(30)}}), 4)
    assert len(counts) <= 4 and counts["a"] == 49


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert exact_dedup(df).count() == 0 and shard(df).count() == 0


@pytest.mark.parametrize("rows", [
    ROWS, [(i, "same text" if i % 3 == 0 else "y" * (i % 50)) for i in range(600)], [(None, "z")] * 200, [(1, "one")]])
def test_shards_are_even_and_gapless(spark, rows):
    got = shard(clashing(spark, rows), shards=6).collect()
    assert len(got) == len(rows)
    shards = defaultdict(list)
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 6
        shards[r.shard].append(r)
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in shards.values())
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((d, len((t or "").encode()) + 8) for d, t in rows)
    total, largest = sum(r["size"] for r in got), max(r["size"] for r in got)
    assert all(sum(r["size"] for r in v) <= total / 6 + 2 * largest for v in shards.values())
