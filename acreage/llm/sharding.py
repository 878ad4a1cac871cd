"""Shards of near equal bytes by histogram sort.

Every row gets a 64-bit sort key: hash bits of the text first, so that equal texts lie together,
then hash bits of the row, so that even one text holding a third of all rows can be cut. Probes are
counted exactly in all partitions, round by round, until each splitter is within tolerance of its
share of the bytes; the rows are then exchanged once.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from acreage.llm.common import stage, text_of


def held_below(rows: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and number of the rows whose key is below each of the sorted probes."""
    def count(frames):
        total = np.zeros((2, len(probes) + 1), np.int64)
        for frame in frames:
            at = np.searchsorted(probes, frame["key"].to_numpy(), side="right")
            np.add.at(total[0], at, frame["size"].to_numpy())
            total[1] += np.bincount(at, minlength=len(probes) + 1)
        some = np.flatnonzero(total[1])
        yield pd.DataFrame({"bucket": some, "bytes": total[0][some], "n": total[1][some]})

    found = (rows.select("key", "size").mapInPandas(count, "bucket long, bytes long, n long")
             .groupBy("bucket").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).collect())
    held = np.zeros((2, len(probes) + 1), np.int64)
    for row in found:
        held[:, row.bucket] = row.bytes, row.n
    return tuple(np.cumsum(held, axis=1)[:, :-1])


def refine(shares: list[float], low: int, high: int, total: int, n: int, slack: float, ways: int,
           below: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> list[int]:
    """Key boundaries with `shares` of the bytes below them, each within `slack` bytes of its share
    or beside the one row that holds the share."""
    ends = [[(low, 0, 0), (high + 1, total, n)] for _ in shares]
    off = lambda i: min(abs(e[1] - shares[i]) for e in ends[i])
    while open_ := [i for i in range(len(shares)) if off(i) > slack and ends[i][1][2] - ends[i][0][2] > 1
                    and ends[i][1][0] - ends[i][0][0] > 1]:
        wanted = set()
        for i in open_:
            start, width = ends[i][0][0], ends[i][1][0] - ends[i][0][0]
            wanted |= {start + max(1, width * j // ways) for j in range(1, ways)}
        probes = np.array(sorted(wanted), np.int64)
        size, rows = below(probes)
        for i in open_:
            at = int(np.searchsorted(size, shares[i], side="right"))
            if at and probes[at - 1] > ends[i][0][0]:
                ends[i][0] = (int(probes[at - 1]), int(size[at - 1]), int(rows[at - 1]))
            if at < len(probes) and probes[at] < ends[i][1][0]:
                ends[i][1] = (int(probes[at]), int(size[at]), int(rows[at]))
    return [min(2**63 - 1, min(ends[i], key=lambda e: abs(e[1] - shares[i]))[0]) for i in range(len(shares))]


def shard(docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text", overhead: int = 8,
          tolerance: float = 0.001, ways: int = 16, rows_per_task: int = 20_000) -> DataFrame:
    """Rows as doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is `bytes`: each shard's bytes differ from an equal share by at most twice the tolerance
    of it, or by the size of the documents beside a boundary. Size is the UTF-8 bytes of the text
    (null: none) plus `overhead`. Slots are gapless from 0 within a shard. Null keys and repeated rows are
    rows like any other; with fewer documents than shards some shards stay empty. An empty table gives an
    empty result. Other columns of `docs` are not read.
    """
    spark = docs.sparkSession
    bits, rest = F.lit(0xFFFFFF).cast("long"), F.lit(~0xFFFFFF).cast("long")
    raw = text_of(text).cast("binary")
    rows = docs.select(
        F.col(key).alias("doc_id"), (F.octet_length(raw) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"), F.xxhash64(raw).alias("h"),
    ).withColumn("row_id", F.monotonically_increasing_id())
    rows = stage(rows.withColumn(
        "key", F.col("h").bitwiseAND(rest).bitwiseOR(F.xxhash64("doc_id", "row_id").bitwiseAND(bits))).drop("h"), "sizes")
    about = rows.agg(F.min("key").alias("low"), F.max("key").alias("high"), F.sum("size").alias("total"),
                     F.count(F.lit(1)).alias("n")).first()
    low, high, total = about.low or 0, about.high or 0, about.total or 0
    parts = int(np.clip(-(-about.n // (shards * rows_per_task)), 8, 256))
    ideal = total / shards
    span, below = (low, high, total, about.n), lambda probes: held_below(rows, probes)
    cuts = refine([ideal * i for i in range(1, shards)], *span, tolerance * ideal, ways, below)
    inner = refine([ideal * (i + j / parts) for i in range(shards) for j in range(1, parts)],
                   *span, 0.4 * ideal / parts, 4, below)
    edges = np.array(sorted([*cuts, *inner]), np.int64)
    owner = np.searchsorted(np.array(sorted(cuts), np.int64), np.concatenate([[low], edges]), side="right")

    @F.pandas_udf("int")
    def bucket_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, keys.to_numpy(), side="right").astype(np.int32))

    dealt = rows.withColumn("bucket", bucket_of("key"))
    counts = {r.bucket: r.n for r in dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, seen = [], {}
    for bucket, to in enumerate(owner.tolist()):
        starts.append((bucket, to, seen.get(to, 0)))
        seen[to] = seen.get(to, 0) + counts.get(bucket, 0)
    table = F.broadcast(spark.createDataFrame(starts, "bucket int, shard int, start long"))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("key", "row_id"))
    return dealt.withColumn("place", place).join(table, "bucket").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("start") + F.col("place") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
