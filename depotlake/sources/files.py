"""Delimited files, the file mapping and folder listings."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from depotlake.config import scratch_dir
from depotlake.schemas import FILE_MAPPING
from depotlake.sources.quoted import read_quoted_csv


def read_csv_text(spark: SparkSession, path: str, multiline: bool = True, at: str | None = None) -> DataFrame:
    """One delimited file with a header, or a folder of its parts; every column stays text.

    A quoted value may hold line breaks. Spark reads a file with such values in one task, so files larger than
    a split are cut at the true ends of their records first, which is staged in the folder ``at`` (else a
    new scratch folder). ``multiline=False`` reads files that are known to have no such values in one pass.
    """
    reader = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", "\\")
        .option("multiLine", multiline)
    )
    found = reader.csv(path)
    if not multiline:
        return found
    total = _bytes_to_cut(spark, path)
    return read_quoted_csv(spark, path, found.columns, at or scratch_dir(spark, "quoted"), total) if total else found


def _bytes_to_cut(spark: SparkSession, path: str) -> int:
    """The size of all files if one is larger than a split and can be cut, else 0."""
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    large = (F.col("length") > split) & ~F.lower("path").rlike(r"\.(gz|zst|zstd|lz4|snappy|deflate)$")
    row = list_files(spark, path).agg(F.sum("length").alias("total"), F.max(large).alias("any")).first()
    return row.total if row.any else 0


def read_csv_by_name(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    optional: Sequence[str] = (),
    multiline: bool = True,
) -> DataFrame:
    """Delimited files bound to ``schema`` by header name, not by position.

    Each path has a header of its own, so columns may stand in another order in every file
    of a list; the parts of a folder share one. Extra columns are ignored, missing optional
    ones become null, and a missing required one is an error. Values that do not fit their
    type become null.
    """
    if not isinstance(path, str):
        return reduce(DataFrame.unionByName, (read_csv_by_name(spark, p, schema, optional, multiline) for p in path))
    raw = read_csv_text(spark, path, multiline)
    missing = [f.name for f in schema if f.name not in raw.columns and f.name not in optional]
    if missing:
        raise ValueError(f"{path}: missing required columns {missing}, found {raw.columns}")
    return raw.select(
        *(
            (F.col(f.name) if f.name in raw.columns else F.lit(None)).try_cast(f.dataType).alias(f.name)
            for f in schema
        )
    )


def read_file_mapping(spark: SparkSession, path: str) -> DataFrame:
    """The JSON array that maps a file-name prefix to its bronze folder."""
    return spark.read.schema(FILE_MAPPING).option("multiLine", True).json(path)


def list_files(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """A folder listing as a relation; the contents are never read.

    A delimited file may itself be a folder of parts: ``file_name`` and ``file_path`` are then
    those of the folder. ``folder_date`` is the date at the end of the folder name, if any.
    ``uri`` is the path as Spark's file sources report it for a row.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    try:
        uri = F.col("_metadata.file_path").alias("uri")
        files = reader.load(path).select("path", "length", "modificationTime", uri)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "path STRING, length BIGINT, modificationTime TIMESTAMP, uri STRING")
    file_path = F.regexp_replace("path", r"(\.csv)/[^/]*$", "$1")
    folder = F.element_at(F.split("path", "/"), -2)
    return files.withColumns(
        {
            "file_path": file_path,
            "file_name": F.element_at(F.split(file_path, "/"), -1),
            "folder_date": F.try_to_date(F.regexp_extract(folder, "([0-9]{8})$", 1), "yyyyMMdd"),
        }
    )


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _hadoop_path(spark, path)
    return fs.exists(hadoop_path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as listings have it."""
    fs, hadoop_path = _hadoop_path(spark, path)
    return fs.makeQualified(hadoop_path).toString()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly in a folder; none if it is not there."""
    fs, hadoop_path = _hadoop_path(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(hadoop_path)] if fs.exists(hadoop_path) else []


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Write a few bytes from the driver, replacing the file."""
    fs, hadoop_path = _hadoop_path(spark, path)
    stream = fs.create(hadoop_path, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _hadoop_path(spark, path)
    fs.mkdirs(hadoop_path)


def delete_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        fs, hadoop_path = _hadoop_path(spark, path)
        fs.delete(hadoop_path, True)


def delete_files(paths: DataFrame) -> int:
    """Delete the files of a one-column relation, spread over its tasks; returns how many there were.

    For stores that Arrow reaches from the workers (local and mounted folders, HDFS, S3, GCS). A file that is gone
    already, as when a task runs again, counts as deleted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            done = 0
            for path in batch.column(0).to_pylist():
                local = path.startswith("file:") or "://" not in path
                store, inner = (fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")) if local else fs.FileSystem.from_uri(path)
                if store.get_file_info(inner).type != fs.FileType.NotFound:
                    store.delete_file(inner)
                done += 1
            yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], names=["done"])

    spread = paths.hint("rebalance") if paths.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true" else paths
    return spread.mapInArrow(run, "done long").agg(F.coalesce(F.sum("done"), F.lit(0))).first()[0]


def delete_empty(spark: SparkSession, folders: Iterable[str]) -> None:
    """Delete the folders that hold no file, at any depth."""
    for folder in folders:
        fs, hadoop_path = _hadoop_path(spark, folder)
        if fs.exists(hadoop_path) and not fs.listFiles(hadoop_path, True).hasNext():
            fs.delete(hadoop_path, True)
