"""Rows that a stream's watermark dropped, kept as rows.

Spark counts such rows but does not give them away. Its checkpoint tells, for each finished micro-batch, the files
it read and the watermark that held before it; both together name exactly the rows that the batch left out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlake.sources.files import list_names, path_exists


@dataclass(frozen=True)
class FinishedBatch:
    """A micro-batch: its files, and the watermark (milliseconds) its late rows lie at or below."""

    number: int
    files: list[str]
    watermark: int


def finished_batches(spark: SparkSession, checkpoint: str, after: int = -1) -> list[FinishedBatch]:
    """The committed micro-batches of a stream over files, as its checkpoint has them.

    A batch leaves out what lies at or below the watermark of the batch before it. The log keeps the
    last hundred batches or so; batches that are no longer there and were not taken before are an error.
    """
    done = sorted(int(name) for name in list_names(spark, f"{checkpoint}/commits") if name.isdigit())
    wanted = [n for n in done if n > after]
    if not wanted:
        return []
    offsets = spark.read.text(f"{checkpoint}/offsets").where(F.col("value").contains("batchWatermarkMs"))
    marks = offsets.select(
        F.col("_metadata.file_name").cast("int"), F.get_json_object("value", "$.batchWatermarkMs").cast("long")
    )
    watermark = {row[0]: row[1] for row in marks.collect()}
    lost = [n for n in range(after + 1, wanted[-1] + 1) if n not in watermark or n > 0 and n - 1 not in watermark]
    if lost:
        raise RuntimeError(f"micro-batches {lost[0]} to {lost[-1]} are no longer in the log of {checkpoint}")
    files: dict[int, set[str]] = {}
    if path_exists(spark, f"{checkpoint}/sources/0"):
        log = spark.read.text(f"{checkpoint}/sources/0").where(F.col("value").startswith("{"))
        entry = F.from_json("value", "path STRING, batchId INT")
        # Names of files that arrived since the last call; a compacted log repeats them.
        listed = log.select(entry.alias("e")).select("e.*").where(F.col("batchId") > after).distinct()
        for row in listed.toLocalIterator():
            files.setdefault(row.batchId, set()).add(row.path)
    # The source's log counts its own batches: only those that brought files. Offsets tell which they were.
    ends = spark.read.text(f"{checkpoint}/offsets").where(F.col("value").contains("logOffset"))
    reached = {
        row[0]: row[1]
        for row in ends.select(F.col("_metadata.file_name").cast("int"), F.get_json_object("value", "$.logOffset").cast("int")).collect()
    }
    found = []
    for n in wanted:
        first = reached.get(n - 1, -1) + 1
        own = [path for k in range(first, reached.get(n, -1) + 1) for path in sorted(files.get(k, ()))]
        found.append(FinishedBatch(n, own, watermark[n - 1] if n else 0))
    return found


def keep_late_rows(
    spark: SparkSession,
    checkpoint: str,
    out: str,
    read: Callable[[list[str]], DataFrame],
    time_column: str = "ingestion_time",
) -> list[int]:
    """Append the rows below the watermark of each finished batch to ``out``; returns the batches taken.

    ``read`` makes from the files of a batch the rows the stream compares with its watermark. A batch is written to a
    folder of its own, also when nothing was late, so a repeated or interrupted call changes nothing. Call it
    after the stream has stopped, or now and then beside it.
    """
    taken = [int(name[6:]) for name in list_names(spark, out) if name.startswith("batch=") and path_exists(spark, f"{out}/{name}/_SUCCESS")]
    numbers = []
    for batch in finished_batches(spark, checkpoint, max(taken, default=-1)):
        if not batch.files:
            continue
        rows = read(batch.files)
        below = F.col(time_column) <= F.timestamp_millis(F.lit(batch.watermark)) if batch.watermark else F.lit(False)
        rows.where(below).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{out}/batch={batch.number}")
        numbers.append(batch.number)
    return numbers
