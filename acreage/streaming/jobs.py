"""Scoring, drift and de-duplication on streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from acreage.functions.scalar import coordinate_key
from acreage.operators.monitoring import DRIFT_THRESHOLD, windowed_drift
from acreage.plans.scoring import score_requests
from acreage.operators.scoring import validate_requests


def start_append(df: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append to Parquet, exactly once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path).option(
        "checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def scoring_sink(
    classifier: PipelineModel, regressor: PipelineModel, path: str, thresholds: list[float] | None = None,
) -> Callable[[DataFrame, int], None]:
    """Writer of one batch: accepted requests scored and rejected ones with their reasons, both from one read.

    Each batch has a folder of its own per kind, named by its id and overwritten, so a batch that runs again after a
    failure leaves what it would have left. The checked batch is kept on memory and disk while both are written."""
    def write(batch: DataFrame, batch_id: int) -> None:
        checked = validate_requests(batch).persist()
        try:
            good = F.size("rejected") == 0
            scored = score_requests(checked.filter(good).drop("rejected"), classifier, regressor, ["request_id", "ts"], thresholds)
            for kind, rows in (("scored", scored), ("rejected", checked.filter(~good))):
                rows.write.mode("overwrite").parquet(f"{path}/{kind}/batch={batch_id}")
        finally:
            checked.unpersist()

    return write


def score_stream(
    requests: DataFrame, classifier: PipelineModel, regressor: PipelineModel, path: str, checkpoint: str,
    thresholds: list[float] | None = None, available_now: bool = False,
) -> StreamingQuery:
    """Score accepted requests under `path`/scored and set rejected ones aside under `path`/rejected; no state is kept."""
    sink = scoring_sink(classifier, regressor, path, thresholds)
    writer = requests.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def drift_stream(
    events: DataFrame, baseline: DataFrame, time: str, columns: list[str], width: str = "1 day",
    delay: str = "1 hour", threshold: float = DRIFT_THRESHOLD,
) -> DataFrame:
    """Drift of every closed window; rows later than `delay` are dropped, which bounds the state."""
    return windowed_drift(events.withWatermark(time, delay), baseline, time, columns, width, threshold)


def deduplicate_stream(listings: DataFrame, time: str, delay: str = "1 day") -> DataFrame:
    """First listing per rounded position and price within the watermark span."""
    keyed = listings.withColumns({
        "_lat": coordinate_key(F.col("LATITUDE")), "_lon": coordinate_key(F.col("LONGITUDE")),
    })
    unique = keyed.withWatermark(time, delay).dropDuplicatesWithinWatermark(["_lat", "_lon", "PRICE"])
    return unique.drop("_lat", "_lon")
