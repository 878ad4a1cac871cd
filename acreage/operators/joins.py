"""Joining a per-key table back onto the rows it was computed from."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from acreage.session import keep

#: Most bytes of a lookup that are broadcast.
BROADCAST_BYTES = 64 << 20
HOT_SHARE = 1000


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str = "left",
    known_rows: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join `rows` to a table holding one or a few rows per key, `left` or `inner`.

    The lookup is kept and measured, unless its rows are of fixed width and the caller knows a bound of
    their number. Up to `broadcast_bytes` it is broadcast, so `rows` is not shuffled and hot keys cost
    nothing. Beyond that only the ordinary keys are shuffled. A null key finds nothing, as in a
    pandas group-by.
    """
    if known_rows is None or not all(_width(f.dataType) for f in lookup.schema):
        lookup = keep(lookup)
        size = lookup.agg(F.sum(_bytes(lookup))).first()[0] or 0
        if size <= broadcast_bytes:  # one task reads what is kept, not one per partition
            lookup = lookup.coalesce(1)
    else:
        size = known_rows * (16 + sum(_width(f.dataType) for f in lookup.schema))
    if size <= broadcast_bytes:
        return rows.join(F.broadcast(lookup), keys, how)
    if rows.isStreaming:
        return rows.join(lookup, keys, how)
    return _join_hot_and_cold(rows, lookup, keys, how)


def _width(kind: T.DataType) -> int:
    """Bytes of a value of fixed width, 0 for others."""
    return 0 if isinstance(kind, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)) else 8


def _bytes(lookup: DataFrame) -> Column:
    """Bytes of a row: fixed widths, lengths of strings, and elements of arrays by their fixed width."""
    total = F.lit(16)
    for f in lookup.schema:
        if isinstance(f.dataType, T.ArrayType):
            inner = f.dataType.elementType
            width = sum(_width(x.dataType) or 64 for x in inner) if isinstance(inner, T.StructType) else _width(inner) or 64
            total = total + F.coalesce(F.size(f.name) * F.lit(width), F.lit(0))
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(f.name), F.lit(0))
        else:
            total = total + F.lit(_width(f.dataType) or 64)
    return total.cast("long")


def _join_hot_and_cold(rows: DataFrame, lookup: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Broadcast the keys that hold over a thousandth of the rows each, shuffle the others.

    Counting keys combines on the map side, and fewer than a thousand keys can be hot. Rows with a
    null key would meet in one task, so they are not joined at all.
    """
    known = rows.dropna(subset=keys)
    counts = known.groupBy(*keys).agg(F.count("*").alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    hot = F.broadcast(keep(counts.filter(F.col("_rows") * HOT_SHARE > total).select(*keys)))
    out = known.join(hot, keys, "left_anti").join(lookup, keys, how).unionByName(
        known.join(hot, keys, "left_semi").join(F.broadcast(lookup.join(hot, keys, "left_semi")), keys, how))
    if how == "left":
        lost = rows.filter(reduce(or_, [F.col(k).isNull() for k in keys]))
        out = out.unionByName(lost, allowMissingColumns=True)
    return out
