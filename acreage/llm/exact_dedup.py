"""Exact duplicates with a heavy-hitter split.

Misra-Gries summaries per task name the digests that may hold a large share of all rows. One pass
counts those few exactly; the verified winners are broadcast, so their rows never meet in a shuffle.
The other digests, each below that share, are grouped by an ordinary shuffle with map-side counts.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from acreage.llm.common import SPACE, stage, text_of


def misra_gries(counts: Counter, counters: int) -> Counter:
    """Reduce merged counts to at most `counters` keys; each loses at most total / (counters + 1)."""
    if len(counts) <= counters:
        return counts
    cut = sorted(counts.values(), reverse=True)[counters]
    return Counter({k: v - cut for k, v in counts.items() if v > cut})


def heavy_digests(rows: DataFrame, counters: int, share: float) -> DataFrame:
    """Digests of `rows` that hold at least `share` of them, with exact count and first row.

    The summaries of all tasks together undercount a digest by at most n / (counters + 1), so every
    digest over the share is among the candidates, of which there are at most
    1 / (share - 1 / (counters + 1)).
    """
    def summarise(batches):
        kept = Counter()
        for batch in batches:
            kept.update(batch.column(0).to_pylist())
            kept = misra_gries(kept, counters)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(kept), pa.binary()), pa.array(list(kept.values()), pa.int64())], ["digest", "seen"])

    n = rows.count()
    least = n * (share - 1 / (counters + 1))
    candidates = (
        rows.select("digest").mapInArrow(summarise, "digest binary, seen long")
        .groupBy("digest").agg(F.sum("seen").alias("seen")).where(F.col("seen") >= least).select("digest")
    )
    counted = grouped(rows.join(F.broadcast(candidates), "digest"))
    return stage(counted.where((F.col("group_size") >= n * share) & (F.col("group_size") > 1)), "heavy")


def grouped(rows: DataFrame) -> DataFrame:
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id"))
    return rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), first.alias("first"))


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", counters: int = 4096,
                share: float = 1 / 1024) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are after each run of white space becomes one space. Null counts as
    empty, so null and empty texts are one group. Of equal texts the smallest key stays, null keys
    last; of rows that repeat the same key and text exactly one stays. An empty table gives an empty
    result; other columns of `docs` are not read.
    """
    rows = stage(docs.select(
        F.col(key).alias("doc_id"),
        F.unhex(F.sha2(F.regexp_replace(text_of(text), SPACE, " ").cast("binary"), 256)).alias("digest"),
    ).withColumn("row_id", F.monotonically_increasing_id()), "digests")
    heavy = heavy_digests(rows, counters, share)
    rest = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    found = rows.join(F.broadcast(heavy), "digest").unionByName(rest.join(grouped(rest), "digest"))
    return found.select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("row_id") == F.col("first.row_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )
