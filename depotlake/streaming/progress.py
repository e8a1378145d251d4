"""The progress of every micro-batch as a table, complete also for streams longer than what Spark remembers."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from depotlake.operators.latest import latest_by
from depotlake.sources.files import path_exists, write_small

PROGRESS = (
    "query_id STRING, run_id STRING, name STRING, batch_id BIGINT, at TIMESTAMP, input_rows BIGINT,"
    " rows_dropped_late BIGINT, state_rows BIGINT, watermark TIMESTAMP, seconds DOUBLE"
)


class ProgressTable(StreamingQueryListener):
    """Write one small file per micro-batch, named by query and batch, so a repeated batch replaces itself."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self._ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        row = {
            "query_id": str(p.id),
            "run_id": str(p.runId),
            "name": p.name,
            "batch_id": p.batchId,
            "at": p.timestamp,
            "input_rows": p.numInputRows,
            "rows_dropped_late": sum(op.numRowsDroppedByWatermark for op in p.stateOperators),
            "state_rows": sum(op.numRowsTotal for op in p.stateOperators),
            "watermark": (p.eventTime or {}).get("watermark"),
            "seconds": (p.durationMs or {}).get("triggerExecution", 0) / 1000,
        }
        # Batches without data have progress as well, under the number of the next one.
        kind = "" if p.numInputRows else "-idle"
        write_small(self.spark, f"{self.path}/{p.id}/{p.batchId:012d}{kind}.json", json.dumps(row))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        return

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._ended.setdefault(str(event.runId), threading.Event()).set()

    def wait_for(self, query, seconds: float = 60) -> None:
        """Events come after the query's end; wait until those of a stopped query are written."""
        if not self._ended.setdefault(str(query.runId), threading.Event()).wait(seconds):
            raise TimeoutError(f"no word of the end of {query.name or query.id} after {seconds} s")


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per query and micro-batch; of repeated ones the last."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], PROGRESS)
    rows = spark.read.schema(PROGRESS).option("recursiveFileLookup", True).json(path)
    return latest_by(rows, ["query_id", "batch_id"], ["input_rows", "at"])


def progress_totals(spark: SparkSession, path: str) -> DataFrame:
    """All input, late and state rows of each query since its progress is recorded."""
    return read_progress(spark, path).groupBy("query_id", "name").agg(
        F.count("*").alias("batches"),
        F.sum("input_rows").alias("input_rows"),
        F.sum("rows_dropped_late").alias("rows_dropped_late"),
        F.max_by("state_rows", "batch_id").alias("state_rows"),
        F.max("watermark").alias("watermark"),
        F.max("at").alias("last_at"),
    )
