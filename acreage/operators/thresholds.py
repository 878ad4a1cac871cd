"""Per-class probability thresholds chosen for macro F1."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from acreage.functions.scalar import thresholded_argmax
from acreage.session import stage

FLOOR = 1e-6


def predict_with_thresholds(probabilities: Column, thresholds: dict[str, float], labels: list[str]) -> Column:
    """Code of the class with the largest probability relative to its threshold, 0.5 if it has none."""
    return thresholded_argmax(probabilities, [thresholds.get(label, 0.5) for label in labels])


def candidate_thresholds(resolution: int = 50) -> list[float]:
    return [0.1 + k * 0.8 / (resolution - 1) for k in range(resolution)]


def _scaled(probabilities: str, thresholds: list[float]) -> list[Column]:
    return [
        F.get(F.col(probabilities), F.lit(i)) / F.lit(max(t, FLOOR)) for i, t in enumerate(thresholds)
    ]


def _first_largest(scores: list[tuple[int, Column]]) -> tuple[Column, Column]:
    """Index and value of the first largest score."""
    best = reduce(lambda a, b: F.when(b > a, b).otherwise(a), [s for _, s in scores])
    index = reduce(lambda rest, item: F.when(item[1] == best, F.lit(item[0])).otherwise(rest),
                   reversed(scores), F.lit(scores[0][0]))
    return index, best


def sweep_class(
    df: DataFrame, probabilities: str, truth: str, thresholds: list[float], cls: int, candidates: list[float]
) -> DataFrame:
    """Confusion counts of every candidate for one class: `(candidate, y_true, y_pred, n)`.

    `candidates` ascend. Raising the threshold of `cls` can only take rows away from it, so a row
    is described by the class it falls back to and by how many candidates keep it, found by
    bisection. Rows are counted per such pattern in one pass; only these few counts are expanded
    over the candidates.
    """
    scores = list(enumerate(_scaled(probabilities, thresholds)))
    other, best = _first_largest([s for s in scores if s[0] != cls])
    floors = F.array(*[F.lit(max(t, FLOOR)) for t in candidates])
    rows = df.select(
        F.col(truth).alias("y_true"), F.get(F.col(probabilities), F.lit(cls)).alias("_p"),
        other.alias("_other"), best.alias("_best"), F.lit(0).alias("_kept"),
    )
    step = 1 << (len(candidates).bit_length() - 1)
    while step:
        reached = F.col("_kept") + step
        score = F.col("_p") / F.get(floors, reached - 1)
        wins = (score > F.col("_best")) | ((score == F.col("_best")) & (F.lit(cls) < F.col("_other")))
        rows = rows.withColumn("_kept", F.when((reached <= len(candidates)) & wins, reached).otherwise(F.col("_kept")))
        step //= 2
    patterns = rows.groupBy("y_true", "_other", "_kept").agg(F.count("*").alias("n"))
    each = F.explode(F.sequence(F.lit(0), F.lit(len(candidates) - 1)))
    return (
        patterns.select("*", each.alias("candidate"))
        .groupBy("candidate", "y_true",
                 F.when(F.col("candidate") < F.col("_kept"), F.lit(cls)).otherwise(F.col("_other")).alias("y_pred"))
        .agg(F.sum("n").alias("n"))
    )


def macro_f1(counts: dict[tuple[int, int], int]) -> float:
    """Macro F1 over the labels seen in truth or prediction."""
    labels = sorted({label for pair, n in counts.items() if n for label in pair})
    total = 0.0
    for label in labels:
        hits = counts.get((label, label), 0)
        support = sum(n for (t, _), n in counts.items() if t == label)
        predicted = sum(n for (_, p), n in counts.items() if p == label)
        precision = hits / predicted if predicted else 0.0
        recall = hits / support if support else 0.0
        total += 2 * precision * recall / (precision + recall) if precision + recall else 0.0
    return total / len(labels) if labels else 0.0


def optimize_thresholds(
    df: DataFrame, probabilities: str, truth: str, labels: list[str], resolution: int = 50
) -> DataFrame:
    """Greedy search, one class after the other, one pass over the rows per class.

    A candidate replaces the incumbent only if it is strictly better; the smallest wins a tie.
    Result: `(position, label, threshold, macro_f1)`, the last being the score after that class.
    """
    candidates = candidate_thresholds(resolution)
    thresholds = [0.5] * len(labels)
    df = stage(df.select(truth, probabilities), "thresholds")  # read once per class
    best, rows = None, []
    for cls, label in enumerate(labels):
        # the first pass also tells the score of the start, as one more candidate
        tried = candidates if best is not None else sorted({*candidates, 0.5})
        found: dict[int, dict] = {k: {} for k in range(len(tried))}
        # at most candidates * classes * classes rows
        for r in sweep_class(df, probabilities, truth, thresholds, cls, tried).collect():
            found[r["candidate"]][r["y_true"], r["y_pred"]] = r["n"]
        tables = [found[tried.index(t)] for t in candidates]
        if best is None:
            best = macro_f1(found[tried.index(0.5)])
        for k, t in enumerate(candidates):
            score = macro_f1(tables[k])
            if score > best:
                best, thresholds[cls] = score, t
        rows.append((cls, label, round(thresholds[cls], 3), best))
    return df.sparkSession.createDataFrame(
        rows, "position int, label string, threshold double, macro_f1 double"
    )
