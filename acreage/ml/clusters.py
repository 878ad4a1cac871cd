"""Neighbourhoods by k-means on coordinates, all starts at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from acreage.constants import SEED
from acreage.session import discard, last_staged, stage

#: Positions from which starts are drawn and first settled; degrees per unit of the whole numbers that are added up.
SAMPLE, UNIT = 20_000, 2.0**-30


@dataclass(frozen=True)
class Clusters:
    """Centres and the sum of squared distances to them."""

    centres: np.ndarray
    cost: float
    steps: int

    def transform(self, df: DataFrame, lat: str = "LATITUDE", lon: str = "LONGITUDE", output: str = "NEIGHBORHOOD_CLUSTER") -> DataFrame:
        """Add the nearest centre of each row, the first of equal ones; rows without a position are left out."""
        squared = [F.pow(F.col(lat) - F.lit(float(a)), 2) + F.pow(F.col(lon) - F.lit(float(b)), 2) for a, b in self.centres]
        least = F.array_position(F.array(*squared), F.array_min(F.array(*squared))) - 1
        return df.where(_placed(lat, lon)).withColumn(output, least.cast("int"))


def _placed(lat: str, lon: str):
    return F.col(lat).isNotNull() & F.col(lon).isNotNull() & ~F.isnan(F.col(lat)) & ~F.isnan(F.col(lon))


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point and the squared distance to it."""
    apart = (x[:, 0][:, None] - centres[:, 0]) ** 2 + (x[:, 1][:, None] - centres[:, 1]) ** 2
    at = apart.argmin(axis=1)
    return at, apart[np.arange(len(x)), at]


def spread_start(x: np.ndarray, weight: np.ndarray, clusters: int, rng: np.random.Generator) -> np.ndarray:
    """Centres drawn one after another, each by its squared distance to those before, then settled on the sample."""
    centres = [x[rng.choice(len(x), p=weight / weight.sum())]]
    while len(centres) < clusters:
        far = weight * nearest(x, np.array(centres))[1]
        share = far / far.sum() if far.sum() > 0 else weight / weight.sum()
        centres.append(x[rng.choice(len(x), p=share)])
    out = np.array(centres)
    for _ in range(100):
        at = nearest(x, out)[0]
        n = np.bincount(at, weight, clusters)
        moved = np.column_stack([np.bincount(at, weight * x[:, d], clusters) for d in range(2)]) / np.maximum(n, 1)[:, None]
        moved = np.where(n[:, None] > 0, moved, out)
        if (moved == out).all():
            break
        out = moved
    return out


def fit_clusters(
    df: DataFrame, clusters: int = 15, seed: int = SEED, starts: int = 10,
    lat: str = "LATITUDE", lon: str = "LONGITUDE", most_steps: int = 100, tolerance: float = 1e-4,
) -> Clusters:
    """The cheapest of several seeded starts, none of which adds a scan: every step is one pass over the different
    positions, which serves all starts that still move. A start rests when its centres move by at most `tolerance` of the
    mean variance, and is drawn from a bounded sample of about SAMPLE positions that a hash chooses (all while there
    are no more). Sums are of whole numbers, so the result does not depend on partitions."""
    places = df.where(_placed(lat, lon)).groupBy(F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon")).agg(
        F.count(F.lit(1)).alias("n"))
    points = stage(places, "places")
    path = last_staged()
    points = points.persist()
    total = points.count()
    if not total:
        raise ValueError("no row has a position")
    luck = F.pmod(F.xxhash64("lat", "lon"), F.lit(1 << 30))
    chosen = points.where(luck < F.lit(float(1 << 30) * min(1.0, SAMPLE / total))).orderBy(luck, "lat", "lon").toArrow()
    if not chosen.num_rows:  # a few places, none of which the hash chose
        chosen = points.orderBy(luck, "lat", "lon").limit(1).toArrow()
    x = np.column_stack([chosen.column(c).to_numpy() for c in ("lat", "lon")])
    weight = chosen.column("n").to_numpy().astype(float)
    rest = tolerance * float(np.mean(np.cov(x.T, aweights=weight, bias=True).diagonal())) if len(x) > 1 else 0.0
    centres = [spread_start(x, weight, clusters, np.random.default_rng([seed, s])) for s in range(starts)]
    costs, open_, steps = [np.inf] * starts, list(range(starts)), 0
    while open_ and steps < most_steps + 1:
        steps += 1
        found = _sums(points, {s: centres[s] for s in open_}, clusters)
        still = []
        for s in open_:
            n, sums, costs[s] = found[s]
            moved = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres[s])
            shift = ((moved - centres[s]) ** 2).sum()
            if shift > rest and steps <= most_steps:
                centres[s] = moved
                still.append(s)
        open_ = still
    points.unpersist()
    discard(df.sparkSession, path)
    best = min(range(starts), key=lambda s: (costs[s], s))
    return Clusters(centres[best], costs[best], steps)


def _sums(points: DataFrame, centres: dict[int, np.ndarray], clusters: int) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """Rows, coordinate sums and cost per start and cluster, from one pass over the points."""
    def run(batches):
        held = {s: np.zeros((clusters, 4), dtype=object) for s in centres}
        for batch in batches:
            lat, lon, n = (batch.column(c).to_numpy() for c in ("lat", "lon", "n"))
            x = np.column_stack([lat, lon])
            whole = np.rint(x / UNIT).astype(np.int64)
            for s, own in centres.items():
                at, far = nearest(x, own)
                cost = np.rint(far / UNIT).astype(np.int64)
                order = np.argsort(at, kind="stable")
                first = np.flatnonzero(np.diff(at[order], prepend=-1))
                for c, column in enumerate((n, whole[:, 0] * n, whole[:, 1] * n, cost * n)):
                    if len(order):
                        held[s][at[order][first], c] += np.add.reduceat(column[order], first)
        rows = [(s, c, *map(int, values)) for s, table in held.items() for c, values in enumerate(table) if values[0]]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), (
                pa.int32(), pa.int32(), pa.int64(), *[pa.decimal128(38)] * 3))], ["start", "cluster", "n", "lat", "lon", "cost"])

    sums = points.mapInArrow(run, "start int, cluster int, n long, lat decimal(38,0), lon decimal(38,0), cost decimal(38,0)")
    out = {s: (np.zeros(clusters), np.zeros((clusters, 2)), 0.0) for s in centres}
    cost: dict[int, int] = dict.fromkeys(centres, 0)
    # one row per start and cluster
    for r in sums.groupBy("start", "cluster").agg(*[F.sum(c).alias(c) for c in ("n", "lat", "lon", "cost")]).collect():
        n, total, _ = out[r["start"]]
        n[r["cluster"]] = r["n"]
        total[r["cluster"]] = [float(r["lat"]) * UNIT, float(r["lon"]) * UNIT]
        cost[r["start"]] += int(r["cost"])
    return {s: (n, total, cost[s] * UNIT) for s, (n, total, _) in out.items()}


def add_neighborhood_clusters(
    df: DataFrame, clusters: int = 15, seed: int = SEED, starts: int = 10,
    lat: str = "LATITUDE", lon: str = "LONGITUDE",
) -> DataFrame:
    """Add NEIGHBORHOOD_CLUSTER; rows without a position are left out, since k-means has no answer."""
    return fit_clusters(df, clusters, seed, starts, lat, lon).transform(df, lat, lon)
