"""Session construction and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}


@dataclass
class Scope:
    """What a job keeps and stages, so that it drops its own tables and no others."""

    kept: list[DataFrame] = field(default_factory=list)
    staged: list[str] = field(default_factory=list)


_SCOPE: ContextVar[Scope] = ContextVar("scope", default=Scope())


@contextmanager
def job(spark: SparkSession) -> Iterator[None]:
    """A scope of its own: what the block keeps and stages is dropped at its end, also beside other jobs."""
    token = _SCOPE.set(Scope())
    try:
        yield
    finally:
        release(spark)
        _SCOPE.reset(token)


def build_session(app: str = "acreage", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators were tuned for; `conf` overrides them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local session may run without the setting; it gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="acreage-")
    return _LOCAL_DIRS[app]


def stage(df: DataFrame, label: str, owned: bool = False) -> DataFrame:
    """Write `df` once as Parquet in the shared folder and read it back.

    Cuts the lineage with a columnar table that survives lost executors; later passes prune
    columns and push filters into it, which a row-wise checkpoint cannot. An `owned` table belongs
    to a fitted model and outlives the job.
    """
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not owned:
        _SCOPE.get().staged.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def last_staged() -> str:
    """Path of the table the current job staged last."""
    return _SCOPE.get().staged[-1]


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged table before the end of its job, once a later one stands in its place."""
    _SCOPE.get().staged.remove(path)
    delete(spark, path)


def delete(spark: SparkSession, name: str) -> None:
    """Delete a folder wherever it lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def keep(df: DataFrame) -> DataFrame:
    """Cache a table that several steps read; `release` drops it. Lost blocks are recomputed."""
    kept = _SCOPE.get().kept
    kept.append(df.persist())
    return kept[-1]


def release(spark: SparkSession | None = None) -> None:
    """Drop every table the current job kept so far, and with a session also delete the staged ones.

    Call it when the results of a job are written; frames that read staged tables end with them,
    fitted models keep theirs.
    """
    scope = _SCOPE.get()
    while scope.kept:
        scope.kept.pop().unpersist()
    if spark is not None:
        while scope.staged:
            delete(spark, scope.staged.pop())
