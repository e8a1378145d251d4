"""Streaming stages: landing to bronze, bronze to silver, latest state, monitoring."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from depotlake.config import ROCKSDB, conf
from depotlake.operators.latest import latest_by
from depotlake.plans.silver import (
    LATEST_ORDER,
    SHIPMENT_KEYS,
    STREAM_SOURCE,
    describe_shipments,
    standardise_shipments,
    valid_shipments,
)
from depotlake.schemas import BRONZE_SHIPMENTS, SILVER_SHIPMENTS
from depotlake.sources.events import read_event_stream
from depotlake.sources.files import delete_paths, list_files, path_exists

# Fixed value: how late an event may be.
WATERMARK = "5 minutes"
LEAST_WRITERS = 4


def run_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    name: str | None = None,
    partition_by: Sequence[str] = (),
    writers: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Append a stream to a Parquet folder, exactly once per checkpoint.

    ``available_now`` handles what is there and stops; otherwise the query keeps running
    with back-to-back micro-batches. With ``partition_by``, each micro-batch writes at most
    ``writers`` files per partition, which also share the rows of a large partition; by default they
    grow with the shuffle partitions the cluster is set to.
    """
    if partition_by:
        if writers is None:
            writers = max(LEAST_WRITERS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 16)
        spread = F.pmod(F.xxhash64(*(c for c in df.columns if c not in partition_by)), F.lit(writers))
        df = df.repartition(*partition_by, spread)
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    # State that outgrows the heap needs a store on disk: mode "first" never forgets a key.
    with conf(df.sparkSession, spark__sql__streaming__stateStore__providerClass=ROCKSDB):
        return writer.start(path)


def bronze_shipments(
    spark: SparkSession,
    landing: str,
    multiline: bool = True,
    max_files: int | None = None,
    run_ts: datetime | Column | None = None,
    source_system: str = STREAM_SOURCE,
) -> DataFrame:
    """The landing folder as a stream of bronze rows."""
    events = read_event_stream(spark, landing, multiline=multiline, max_files=max_files)
    return standardise_shipments(events, run_ts, source_system).select(*BRONZE_SHIPMENTS.fieldNames())


def dedup_stream(
    df: DataFrame,
    keys: Sequence[str],
    mode: str,
    time_column: str = "ingestion_time",
    delay: str = WATERMARK,
) -> DataFrame:
    """Drop repeated keys in a stream.

    ``first`` keeps the first row ever seen, so its state holds every key for good.
    ``within_watermark`` forgets a key once the watermark has passed it, so its state is
    bounded and a key that returns later is a new one. ``none`` keeps every row. Rows that
    are older than the watermark are dropped by both and counted in the query's progress.
    """
    if mode == "none":
        return df
    marked = df.withWatermark(time_column, delay)
    if mode == "first":
        return marked.dropDuplicates(list(keys))
    if mode == "within_watermark":
        return marked.dropDuplicatesWithinWatermark(list(keys))
    raise ValueError(f"unknown mode {mode!r}")


def silver_shipments_stream(
    bronze: DataFrame,
    dedup: str = "first",
    parity: bool = False,
    run_ts: datetime | Column | None = None,
) -> DataFrame:
    """Bronze stream to silver stream.

    Invalid keys go first, unless ``parity`` asks for the order in which an invalid first
    event hides a later valid one.
    """
    if parity:
        kept = valid_shipments(dedup_stream(bronze, SHIPMENT_KEYS, dedup))
    else:
        kept = dedup_stream(valid_shipments(bronze), SHIPMENT_KEYS, dedup)
    return describe_shipments(kept, run_ts).select(*SILVER_SHIPMENTS.fieldNames())


# --- latest state: append what changed, choose when reading ------------------------------


def latest_state_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str] = SHIPMENT_KEYS,
    order_by: Sequence[str] = LATEST_ORDER,
    name: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Keep the newest row per key of a stream, as an upsert spread over writer and reader.

    Each micro-batch is reduced to one row per key and written to its own folder, so the
    cost follows the batch, not the table, and a repeated batch replaces itself. The reader
    (``latest_state``) chooses among the batches; ``compact_latest_state`` folds them.
    The folder belongs to its checkpoint, as batch numbers start again without it.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        latest_by(batch, keys, order_by).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = df.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def latest_state(
    spark: SparkSession,
    path: str,
    schema: StructType,
    keys: Sequence[str] = SHIPMENT_KEYS,
    order_by: Sequence[str] = LATEST_ORDER,
) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    return latest_by(rows, keys, order_by)


def compact_latest_state(
    spark: SparkSession,
    path: str,
    schema: StructType,
    keys: Sequence[str] = SHIPMENT_KEYS,
    order_by: Sequence[str] = LATEST_ORDER,
) -> None:
    """Fold all batches into one folder, then delete the folded ones.

    Choosing among a row and its copy gives the row, so readers and a job that dies between
    the two steps see the right state. Run it while the stream is stopped.
    """
    files = list_files(spark, path, "*.parquet")
    folders = files.select(F.regexp_extract("path", "^(.*)/[^/]*$", 1)).distinct().collect()
    state = latest_state(spark, path, schema, keys, order_by)
    state.write.parquet(f"{path}/batch=compacted-{uuid.uuid4().hex}")
    delete_paths(spark, (row[0] for row in folders))


def stream_report(spark: SparkSession, queries: Iterable[StreamingQuery] | None = None) -> DataFrame:
    """One row per streaming query: identity, status and its recent row counts."""
    rows = []
    for query in spark.streams.active if queries is None else queries:
        progress = query.recentProgress
        dropped = sum(op.numRowsDroppedByWatermark for p in progress for op in p.stateOperators)
        rows.append(
            (
                query.name,
                str(query.id),
                query.isActive,
                query.status["message"],
                len({p.batchId for p in progress}),
                sum(p.numInputRows for p in progress),
                dropped,
            )
        )
    return spark.createDataFrame(
        rows,
        "name STRING, id STRING, is_active BOOLEAN, status STRING, recent_batches INT,"
        " recent_input_rows BIGINT, recent_rows_dropped_late BIGINT",
    )
