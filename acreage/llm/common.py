"""Helpers shared by the operators: staged tables, hashes in numpy, bounded batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from acreage.session import delete, shared_dir

#: White space of the contracts, as a Java and RE2 pattern.
SPACE = r"[\x20\x09-\x0D]+"


#: With this setting on, a query deletes the shuffle files it wrote at its end, not when the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as Parquet under `spark.checkpoint.dir` and read it back, which cuts the lineage.

    The shuffle files of the write are deleted with its end; `discard` deletes the table."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_at = path
    return staged


def discard(*staged: DataFrame) -> None:
    """Delete tables that `stage` wrote, once nothing that is still to be computed reads them."""
    for df in staged:
        delete(df.sparkSession, df.staged_at)


def text_of(column: str = "text"):
    """The text, null counted as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def partitions(df: DataFrame) -> int:
    """Shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds at most `most` bytes of `column`, or one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ends = np.cumsum(lengths(batch.column(column)))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def lengths(column: pa.Array) -> np.ndarray:
    """Bytes of each string or binary value, null as 0."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column one after another, and the n + 1 offsets of its values."""
    sizes = lengths(column)
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    wide = column.cast(pa.large_binary())
    if wide.null_count:
        wide = wide.fill_null(b"")
    data = wide.buffers()[2]
    if data is None or offsets[-1] == 0:
        return np.zeros(0, np.uint8), offsets
    first = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset]
    return np.frombuffer(data, np.uint8)[first:first + offsets[-1]], offsets


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer, so that every bit of a sum of products reaches every other."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def seeded(seed: int, n: int) -> np.ndarray:
    """n odd 64-bit multipliers drawn from a seed."""
    drawn = np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.int64).astype(np.uint64)
    return drawn * np.uint64(2) + np.uint64(1)


def join_documents(docs: DataFrame, found: DataFrame, key: str, text: str, how: str = "inner") -> DataFrame:
    """Join `docs`, as a struct column `doc`, with rows `found` that name documents by doc_id and text_key.

    No column name of `docs` can clash with one of `found`."""
    found = found.withColumnsRenamed({"doc_id": "found_id", "text_key": "found_key"})
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(key).alias("own_id"),
                        F.xxhash64(text_of(text).cast("binary")).alias("own_key"))
    same = (F.col("own_key") == F.col("found_key")) & F.col("own_id").eqNullSafe(F.col("found_id"))
    return whole.join(found, same, how)


def split_join(rows: DataFrame, groups: DataFrame, keys: list[str], bar: float) -> DataFrame:
    """Inner join of `rows` with `groups`, which has one row per key and in `n` how many rows hold it.

    Keys held by at least `bar` rows, of which there are at most rows / bar, are broadcast and their
    rows never shuffled; the others, whose number has no bound, are shuffled, and none is larger than `bar`.
    """
    heavy = F.broadcast(groups.where(F.col("n") >= bar).drop("n"))
    light = groups.where(F.col("n") < bar).drop("n").hint("merge")
    rest = rows.join(F.broadcast(heavy.select(*keys)), keys, "left_anti")
    return rows.join(heavy, keys).unionByName(rest.join(light, keys))
