"""Checks on column names, contracts and run reports that need no data pass, or a tiny one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from acreage.constants import FORBIDDEN_COLUMNS, LEAKY_FEATURES
from acreage.session import stage


class LeakageError(ValueError):
    """A feature carries the target, by name or by dependence."""


class HealthError(ValueError):
    """Predictions are too few, broken or collapsed."""


class DriftError(ValueError):
    """Current data left the baseline."""


@dataclass(frozen=True)
class Contract:
    """Columns that must never reach a model, under a version locked by the hash of its text."""

    forbidden: frozenset[str] = frozenset(FORBIDDEN_COLUMNS)
    version: str = "v1"

    def check(self, columns: list[str]) -> None:
        present = sorted(self.forbidden & set(columns))
        if present:
            raise LeakageError(f"forbidden columns present: {present}")


def assert_no_leakage(features: list[str]) -> None:
    """Refuse feature names that come from the target; names are case-sensitive."""
    present = sorted(LEAKY_FEATURES & {str(f) for f in features})
    if present:
        raise LeakageError(f"target-derived features in the training set: {present}")


def check_no_forbidden_columns(df: DataFrame, contract: Contract = Contract()) -> None:
    contract.check(df.columns)


def schema_difference(df: DataFrame, expected: list[str]) -> tuple[list[str], list[str]]:
    """Expected columns that are missing, and extra ones, each in its own order."""
    return (
        [c for c in expected if c not in df.columns],
        [c for c in df.columns if c not in expected],
    )


def schema_difference_table(df: DataFrame, expected: list[str]) -> DataFrame:
    missing, extra = schema_difference(df, expected)
    rows = [("missing", c) for c in missing] + [("extra", c) for c in extra]
    return df.sparkSession.createDataFrame(rows, "status string, column string")


def contract_locks(contracts: DataFrame, registry: DataFrame) -> DataFrame:
    """Whether each contract text still has the hash registered for its version.

    `contracts` holds version and text, `registry` version and sha256. A version that is not
    registered is not locked.
    """
    digests = contracts.select("version", F.sha2(F.col("text"), 256).alias("sha256"))
    registered = registry.select("version", F.col("sha256").alias("registered"))
    return digests.join(registered, "version", "left").withColumn(
        "locked", F.coalesce(F.col("sha256") == F.col("registered"), F.lit(False)))


def contract_lock(spark: SparkSession, text: str, version: str, registry: dict[str, str]) -> DataFrame:
    """`contract_locks` of a single text."""
    return contract_locks(
        spark.createDataFrame([(version, text)], "version string, text string"),
        spark.createDataFrame(list(registry.items()), "version string, sha256 string"),
    )


def drop_log_consistent(report: DataFrame) -> DataFrame:
    """Whether raw = scored + dropped and dropped = the sum over the reasons."""
    total = F.aggregate(F.map_values("drop_reasons"), F.lit(0).cast("long"), lambda a, x: a + x)
    return report.select(
        "n_raw", "n_scored", "n_dropped", total.alias("n_reasons"),
        ((F.col("n_raw") == F.col("n_scored") + F.col("n_dropped"))
         & (F.col("n_dropped") == total)).alias("consistent"),
    )


def leakage_tripwire(r2: float | None, threshold: float = 0.95) -> dict:
    """A fit this good in log space means that the target leaked."""
    return {"threshold": threshold, "triggered": r2 is not None and r2 > threshold}


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Equality as multisets."""
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def check_statelessness(
    transform: Callable[[DataFrame], DataFrame], df: DataFrame, key: str, target: str, noise: DataFrame
) -> DataFrame:
    """Run a row-wise mapping on changed inputs and report whether its rows stayed the same.

    `transform` must keep `key`, which is unique. The changes: a second run, half of the rows,
    reversed columns, and the target replaced by that of another row (`noise`: key and target).
    The last compares only rows kept in both runs. The input is written once, and the rows of all runs meet in
    one shuffle by key, where equal ones are counted per run.
    """
    df = stage(df, "checked")
    half = F.pmod(F.xxhash64(key), F.lit(2)) == 0
    other = df.drop(target).join(noise.select(key, target), key).select(*df.columns)
    runs = [transform(d) for d in (df, df, df.filter(half), df.select(*reversed(df.columns)), other)]
    columns = runs[0].columns
    met = runs[0].withColumn("_run", F.lit(0))
    for i, rows in enumerate(runs[1:], 1):
        met = met.unionByName(rows.select(*columns).withColumn("_run", F.lit(i)))
    plain, again, part, turned, moved = (f"_n{i}" for i in range(len(runs)))
    rows = met.repartition(key).groupBy(*columns).agg(*[
        F.count_if(F.col("_run") == i).alias(n) for i, n in enumerate((plain, again, part, turned, moved))])
    keys = rows.groupBy(key).agg(
        F.max(F.col(plain) != F.col(again)).alias("deterministic"),
        F.max(F.when(half, F.col(plain)).otherwise(0) != F.col(part)).alias("subset"),
        F.max(F.col(plain) != F.col(turned)).alias("column_order"),
        # a key that only one run kept, or none, does not count
        (F.max(F.col(plain) != F.col(moved)) & (F.max(plain) > 0) & (F.max(moved) > 0) & F.col(key).isNotNull()).alias("target_shuffle"),
    )
    names = ["deterministic", "subset", "column_order", "target_shuffle"]
    broken = keys.agg(*[F.coalesce(F.max(n), F.lit(False)).alias(n) for n in names]).first()
    return df.sparkSession.createDataFrame([(n, not broken[n]) for n in names], "invariant string, holds boolean")


def kept_in_both(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of `a` whose key is also in `b`."""
    return a.join(b.select(key).distinct(), key, "left_semi")
