"""Exact order statistics whose memory does not grow with the data."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

DIRECT_ROWS = 1_000_000
FINAL_ROWS = 10_000
SKETCH_ACCURACY = 10_000


@dataclass
class _Search:
    """One wanted order statistic and the open interval known to hold it."""

    column: str
    rank: int
    low: float | None
    high: float | None
    below: int
    inside: int
    answer: float | None = None

    def within(self) -> Column:
        value = F.col(f"`{self.column}`")
        kept = value.isNotNull()
        if self.low is not None:
            kept = kept & (value > self.low)
        if self.high is not None:
            kept = kept & (value < self.high)
        return kept

    def value(self) -> Column:
        return F.when(self.within(), F.col(f"`{self.column}`").cast("double"))

    def narrow(self, low: float, high: float, counts: list[int]) -> None:
        """Move to the piece of the interval that holds the rank; `counts` has one per piece."""
        rest = self.rank - self.below
        pieces = [(self.low, low), low, (low, high), high, (high, self.high)]
        for piece, count in zip(pieces, counts):
            if rest < count:
                if isinstance(piece, tuple):
                    self.low, self.high = piece
                    self.inside = count
                else:
                    self.answer = piece
                return
            rest -= count
            self.below += count


def _step(df: DataFrame, open_: list[_Search], accuracy: int) -> None:
    """Bracket every open search by a sketch, then count the pieces exactly."""
    # searches of a column that share an interval read one sketch
    margin = 2.0 / accuracy
    shared: dict[tuple, tuple[_Search, list[float]]] = {}
    places = []
    for s in open_:
        at = (s.rank - s.below + 0.5) / s.inside
        interval = (s.column, s.low, s.high)
        probes = shared.setdefault(interval, (s, []))[1]
        places.append((interval, len(probes)))
        probes += [max(0.0, at - margin), min(1.0, at + margin)]
    sketches = df.agg(*[
        F.percentile_approx(s.value(), probes, accuracy).alias(f"b{i}") for i, (s, probes) in enumerate(shared.values())
    ]).first()
    sketch = dict(zip(shared, sketches))
    brackets = [sketch[interval][i:i + 2] for interval, i in places]
    pieces = []
    for i, s in enumerate(open_):
        v, (low, high) = s.value(), brackets[i]
        tests = [v < low, v == low, (v > low) & (v < high), (v == high) & F.lit(low < high), v > high]
        pieces += [F.count_if(t).alias(f"n{i}_{j}") for j, t in enumerate(tests)]
    counted = df.agg(*pieces).first()
    for i, s in enumerate(open_):
        s.narrow(brackets[i][0], brackets[i][1], [counted[5 * i + j] for j in range(5)])


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    rows: int | None = None,
    direct_rows: int = DIRECT_ROWS,
    final_rows: int = FINAL_ROWS,
    accuracy: int = SKETCH_ACCURACY,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of each column over its non-null values.

    A column of at most `direct_rows` values uses the built-in exact percentile, whose buffer is
    then bounded; `rows`, the size of `df` if the caller knows it, spares the counting pass. A
    larger column is searched: a quantile sketch brackets each wanted rank, one pass
    counts the rows around the bracket exactly, and the interval shrinks by a factor of thousands
    per round until at most `final_rows` values are left to sort. Only scans and partial
    aggregates run, so nothing is shuffled but a few numbers, and a hot value ends its search.
    """
    name = {c: f"`{c}`" for c in columns}
    if rows is not None and rows <= direct_rows:
        size = dict.fromkeys(columns, rows)
    else:
        sizes = df.agg(*[F.count(name[c]).alias(f"n{i}") for i, c in enumerate(columns)]).first()
        size = dict(zip(columns, sizes))
    out: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}

    small = [c for c in columns if 0 < size[c] <= direct_rows]
    if small:
        probs = F.array(*[F.lit(float(p)) for p in probabilities])
        exact = df.agg(*[
            F.percentile(F.col(name[c]).cast("double"), probs).alias(f"q{i}") for i, c in enumerate(small)
        ]).first()
        for c, values in zip(small, exact):
            out[c] = list(values) if values else out[c]

    large = [c for c in columns if size[c] > direct_rows]
    searches: dict[tuple[str, int], _Search] = {}
    for c in large:
        for p in probabilities:
            position = (size[c] - 1) * p
            for rank in {math.floor(position), math.ceil(position)}:
                searches[c, rank] = _Search(c, rank, None, None, 0, size[c])
    while True:
        open_ = [s for s in searches.values() if s.answer is None and s.inside > final_rows]
        if not open_:
            break
        _step(df, open_, accuracy)
    left = [s for s in searches.values() if s.answer is None]
    if left:
        picked = df.agg(*[
            F.get(F.sort_array(F.collect_list(s.value())), F.lit(s.rank - s.below)).alias(f"v{i}")
            for i, s in enumerate(left)
        ]).first()
        for s, value in zip(left, picked):
            s.answer = value
    for c in large:
        for i, p in enumerate(probabilities):
            position = (size[c] - 1) * p
            low, high = math.floor(position), math.ceil(position)
            a, b = searches[c, low].answer, searches[c, high].answer
            out[c][i] = a if low == high else (high - position) * a + (position - low) * b
    return out


def approximate_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], accuracy: int = SKETCH_ACCURACY
) -> dict[str, list[float | None]]:
    """One-pass quantiles by sketch, without interpolation."""
    row = df.agg(*[
        F.percentile_approx(F.col(f"`{c}`").cast("double"), probabilities, accuracy).alias(f"q{i}")
        for i, c in enumerate(columns)
    ]).first()
    return {c: list(values) if values else [None] * len(probabilities) for c, values in zip(columns, row)}


def long_form(df: DataFrame, keep: list[str], columns: list[str]) -> DataFrame:
    """One `(feature, value)` row per listed column and input row, null values left out."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns
    ]))
    return (
        df.select(*keep, pairs.alias("_pair"))
        .select(*keep, "_pair.feature", "_pair.value")
        .filter(F.col("value").isNotNull())
    )


def group_medians(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """`(group, feature, median)` without a null group.

    Equal values are counted on the map side first, so a hot group costs its distinct values and
    not its rows, and the window over them spills.
    """
    counts = (
        long_form(df.filter(F.col(group).isNotNull()), [group], columns)
        .groupBy(group, "feature", "value").agg(F.count("*").alias("n"))
    )
    part = Window.partitionBy(group, "feature")
    ranked = counts.select(
        group, "feature", "value", "n",
        F.sum("n").over(part.orderBy("value")).alias("upto"),
        F.sum("n").over(part).alias("total"),
    )

    def at(position: Column) -> Column:
        hit = (F.col("upto") > position) & (F.col("upto") - F.col("n") <= position)
        return F.max(F.when(hit, F.col("value")))

    middle = (F.col("total") - 1) / 2
    return ranked.groupBy(group, "feature").agg(
        ((at(F.floor(middle)) + at(F.ceil(middle))) / 2).alias("median")
    )
