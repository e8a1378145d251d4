"""Session settings, the shared scratch folder and the folder layout."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date

from pyspark.sql import SparkSession

# Results depend on the first three; the adaptive settings are what the plans lean on.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_local_scratch: dict[str, str] = {}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on a session somebody else has built."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def conf(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Set SQL settings for a block; underscores in the names stand for dots."""
    names = {key.replace("__", "."): value for key, value in settings.items()}
    before = {key: spark.conf.get(key, None) for key in names}
    try:
        for key, value in names.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session without that setting falls back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        app = spark.sparkContext.applicationId
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        if app not in _local_scratch:
            _local_scratch[app] = tempfile.mkdtemp(prefix="depotlake-")
        root = _local_scratch[app]
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Layout:
    """Where each layer lives below one root (any Hadoop URI)."""

    root: str

    @property
    def bronze_batch_root(self) -> str:
        return f"{self.root}/bronze/batch"

    def bronze_batch(self, folder: str) -> str:
        return f"{self.bronze_batch_root}/{folder}"

    @property
    def file_mapping(self) -> str:
        return f"{self.bronze_batch_root}/filemapping/fileMapping.json"

    @property
    def landing_batch(self) -> str:
        return f"{self.root}/landing"

    @property
    def landing_shipments(self) -> str:
        return f"{self.root}/bronze/streaming/landing_shipments"

    @property
    def bronze_shipments(self) -> str:
        return f"{self.root}/bronze/streaming/shipments"

    @property
    def silver_inventory(self) -> str:
        return f"{self.root}/silver/batch/inventory"

    @property
    def silver_sales(self) -> str:
        return f"{self.root}/silver/batch/salesorder"

    @property
    def silver_shipments(self) -> str:
        return f"{self.root}/silver/streaming/shipments"

    @property
    def sales_state(self) -> str:
        return f"{self.root}/silver/batch/sales_state"

    @property
    def late_shipments(self) -> str:
        return f"{self.root}/silver/streaming/late_shipments"

    @property
    def stream_progress(self) -> str:
        return f"{self.root}/monitoring/stream_progress"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/silver/quarantine"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    def checkpoint(self, stage: str) -> str:
        return f"{self.root}/checkpoints/{stage}"

    def archive(self, kind: str) -> str:
        return f"{self.root}/archive/{kind}"


def dated_name(prefix: str, as_of: date) -> str:
    """``inventory_`` and 2025-08-31 give ``inventory_20250831.csv``."""
    return f"{prefix}{as_of:%Y%m%d}.csv"


def dated_path(root: str, prefix: str, as_of: date) -> str:
    return f"{root}/{dated_name(prefix, as_of)}"
