"""Exports of the gold tables, the acknowledgement and the serving load."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from depotlake.operators.balance import layer_counts
from depotlake.schemas import GOLD, Table
from depotlake.sources.files import delete_paths, make_folder, path_exists

# Fixed value: the content of the marker that follows a complete export.
ACKNOWLEDGED = "acknowledged"

# The sums of the partitions as they were exported last.
DIGESTS = "_digests"
DIGEST = "table STRING, part STRING, rows BIGINT, digest DECIMAL(38, 0)"

# Text keeps the blanks at its ends and times their microseconds, in both directions.
CSV_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "escape": '"',
}


def export(df: DataFrame, path: str, fmt: str, files: int | None = None) -> None:
    """Write a CSV or Parquet copy.

    ``files`` fixes the number of files for consumers that need it. By default the copy is
    written in parallel, one file per task; a single file would send the whole table
    through one task.
    """
    if files is not None:
        df = df.repartition(files)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if fmt == "csv":
        writer.options(**CSV_OPTIONS).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown export format {fmt!r}")


def read_export(spark: SparkSession, path: str, fmt: str, table: Table) -> DataFrame:
    # An incremental export has a folder for each partition; the files hold all columns.
    reader = spark.read.schema(table.schema).option("recursiveFileLookup", True)
    if fmt == "csv":
        # Text may hold line breaks, and a value that does not fit its column fails the read.
        return reader.options(**CSV_OPTIONS, multiLine="true", mode="FAILFAST").csv(path)
    return reader.parquet(path)


def publish(
    spark: SparkSession,
    db: str,
    out: str,
    tables: Iterable[Table] = GOLD,
    files: int | None = None,
) -> DataFrame:
    """Export every table as CSV and Parquet, then write the acknowledgement.

    A marker of an earlier run is removed first, and the new one is written only after both
    copies of each table read back with the table's row count. Returns the counts:
    ``layer, row_count``.
    """
    tables = list(tables)
    # What an incremental publication knows of the folder is void from here on.
    delete_paths(spark, [f"{out}/_success", f"{out}/{DIGESTS}"])
    frames = {}
    for table in tables:
        df = spark.table(f"{db}.{table.name}").select(*table.schema.fieldNames())
        export(df, f"{out}/tables/{table.name}", "csv", files)
        export(df, f"{out}/{table.name}_parquet", "parquet", files)
        frames[table.name] = df
        for fmt, path in (("csv", f"{out}/tables/{table.name}"), ("parquet", f"{out}/{table.name}_parquet")):
            frames[f"{table.name} {fmt}"] = read_export(spark, path, fmt, table)
    report = layer_counts(frames)
    counts = {row.layer: row.row_count for row in report.collect()}
    for table in tables:
        for fmt in ("csv", "parquet"):
            if counts[f"{table.name} {fmt}"] != counts[table.name]:
                raise RuntimeError(f"{table.name}: the {fmt} export has not the table's row count")
    acknowledgement = spark.createDataFrame([(ACKNOWLEDGED,)], "status STRING")
    acknowledgement.write.mode("overwrite").text(f"{out}/_success")
    return spark.createDataFrame(sorted(counts.items()), "layer STRING, row_count BIGINT")


def digests(df: DataFrame, table: Table) -> DataFrame:
    """table, part, rows, digest: for each partition the number of rows and an order-free sum of their hashes.

    Partial sums leave the tasks. ``part`` is the partition's value as text; an unpartitioned table is one part.
    """
    part = F.coalesce(F.col(table.partition_by).cast("string"), F.lit("none")) if table.partition_by else F.lit("all")
    # With the position of nulls: the hash itself skips them.
    present = [F.col(f.name).isNull() for f in table.schema]
    row = F.xxhash64(*table.schema.fieldNames(), *present).cast("decimal(38, 0)")
    sums = df.withColumn("part", part).groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.sum(row).alias("digest"))
    return sums.select(F.lit(table.name).alias("table"), "part", "rows", "digest")


def _copies(out: str, table: Table) -> dict[str, str]:
    return {"csv": f"{out}/tables/{table.name}", "parquet": f"{out}/{table.name}_parquet"}


def _export_parts(df: DataFrame, table: Table, out: str, parts: dict[str, int]) -> None:
    """Replace the copies of the named partitions, whose row counts are known from their digests."""
    spark = df.sparkSession
    if table.partition_by:
        days = [p for p in parts if p != "none"]
        own = F.col(table.partition_by)
        chosen = own.isin([date.fromisoformat(d) for d in days]) if days else F.lit(False)
        df = df.filter(chosen | own.isNull() if "none" in parts else chosen)
        df = df.withColumn("part", F.coalesce(own.cast("string"), F.lit("none")))
    else:
        df = df.withColumn("part", F.lit("all"))
    for fmt, path in _copies(out, table).items():
        seen = Observation(f"{table.name} {fmt}")
        rows = df.hint("rebalance", F.col("part")).observe(seen, F.count(F.lit(1)).alias("rows"))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part")
        writer.options(**CSV_OPTIONS).csv(path) if fmt == "csv" else writer.parquet(path)
        folders = [f"{path}/part={part}" for part in parts]
        # What was counted on the way settles it, unless a task ran twice: then the copies are read.
        if seen.get["rows"] != sum(parts.values()):
            copied = sum(read_export(spark, folder, fmt, table).count() for folder in folders)
            if copied != sum(parts.values()):
                raise RuntimeError(f"{table.name}: the {fmt} export has not the table's row count")


def publish_changed(spark: SparkSession, db: str, out: str, tables: Iterable[Table] = GOLD) -> DataFrame:
    """Export the partitions that changed since the last publication, then write the acknowledgement.

    One pass over each table sums its partitions; those whose sums differ from the ones stored beside the
    export are written anew, those that are gone are deleted, and nothing else is touched. An unchanged day
    writes nothing. The sums are stored after the copies, so what a lost job left half done is done
    again. Returns ``layer, row_count, parts_written`` of each table and of its copies.
    """
    tables = list(tables)
    names = {t.name: t for t in tables}
    frames = {t.name: spark.table(f"{db}.{t.name}").select(*t.schema.fieldNames()) for t in tables}
    now = reduce(DataFrame.unionByName, (digests(frames[n], t) for n, t in names.items())).collect()
    stored = f"{out}/{DIGESTS}"
    known = path_exists(spark, f"{stored}/_SUCCESS")
    before = spark.read.schema(DIGEST).parquet(stored).collect() if known else []
    # Metadata: a row for each partition.
    old = {(r.table, r.part): (r.rows, r.digest) for r in before}
    new = {(r.table, r.part): (r.rows, r.digest) for r in now}
    changed = {key: rows for key, (rows, digest) in new.items() if old.get(key) != (rows, digest)}
    gone = [key for key in old if key[0] in names and key not in new]
    if changed or gone or not known:
        delete_paths(spark, [f"{out}/_success"])
        if not known:
            # Copies of whole tables would be read beside those of their partitions.
            delete_paths(spark, [path for t in tables for path in _copies(out, t).values()])
        for name, table in names.items():
            parts = {part: rows for (owner, part), rows in changed.items() if owner == name}
            if parts:
                _export_parts(frames[name], table, out, parts)
            delete_paths(spark, [f"{path}/part={part}" for owner, part in gone if owner == name for path in _copies(out, table).values()])
        for table in tables:
            for path in _copies(out, table).values():
                make_folder(spark, path)
        kept = [(t, p, r, d) for (t, p), (r, d) in (old | new).items() if (t, p) in new or t not in names]
        spark.createDataFrame(kept, DIGEST).coalesce(1).write.mode("overwrite").parquet(stored)
    if not path_exists(spark, f"{out}/_success"):
        spark.createDataFrame([(ACKNOWLEDGED,)], "status STRING").write.mode("overwrite").text(f"{out}/_success")
    report = []
    for name in sorted(names):
        total = sum(rows for (owner, _), (rows, _) in new.items() if owner == name)
        written = sum(owner == name for owner, _ in changed)
        report += [(layer, total, written) for layer in (name, f"{name} csv", f"{name} parquet")]
    return spark.createDataFrame(report, "layer STRING, row_count BIGINT, parts_written BIGINT")


def load_serving(spark: SparkSession, export_dir: str, serving_db: str, table: Table) -> str | None:
    """Create the serving table if missing and replace its rows by the Parquet export.

    Strings have a maximum length there and a longer value fails the load. The rows are
    loaded beside the table, which is pointed at them once they are complete, so a failed
    load leaves the table as it was. Returns the folder the table had before; the caller
    deletes it when no query reads it any more.
    """
    name = f"{serving_db}.{table.name}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({table.serving_ddl()}) USING parquet")
    described = spark.sql(f"DESCRIBE TABLE FORMATTED {name}").filter("lower(col_name) = 'location'").first()
    load = uuid.uuid4().hex
    home = spark.catalog.getDatabase(serving_db).locationUri.rstrip("/")
    folder = f"{home}/{table.name}-{load}"
    rows = read_export(spark, f"{export_dir}/{table.name}_parquet", "parquet", table)
    spark.sql(
        f"CREATE TABLE {name}_{load} ({table.serving_ddl()}) USING parquet LOCATION '{folder}'"
    )
    try:
        rows.select(*table.schema.fieldNames()).write.insertInto(f"{name}_{load}")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(name)
    finally:
        # An external table: dropping it keeps the files.
        spark.sql(f"DROP TABLE {name}_{load}")
    return described and described["data_type"]
