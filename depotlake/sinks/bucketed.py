"""Merge targets stored in buckets of their key, so a merge shuffles its source only.

The target's files are hashed by the key as a join would hash them. The full outer join of a merge then reads the
target in place and deals the source once into the target's buckets; the merged rows leave the join in
those buckets and are written without another shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from depotlake.operators.merge import upsert
from depotlake.schemas import Table
from depotlake.sinks.tables import location, new_folder


def _bucketed_by(table: Table, buckets: int) -> str:
    keys = ", ".join(f"`{k}`" for k in table.keys)
    return f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS"


def create_bucketed(spark: SparkSession, db: str, table: Table, buckets: int) -> None:
    """Create the table if it does not exist; a bucket should fit a task's memory when it is sorted."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {db}.{table.name} ({table.columns_ddl()}) USING parquet"
        f" {_bucketed_by(table, buckets)} LOCATION '{new_folder(spark, db, table.name)}'"
    )


def buckets_of(spark: SparkSession, db: str, table: Table) -> int:
    described = spark.sql(f"DESCRIBE TABLE FORMATTED {db}.{table.name}").where("col_name = 'Num Buckets'").first()
    if described is None:
        raise ValueError(f"{db}.{table.name} is not bucketed")
    return int(described["data_type"])


def merged_in_buckets(
    source: DataFrame,
    db: str,
    table: Table,
    update_when: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None,
    update_cols: Sequence[str] | None = None,
) -> DataFrame:
    """The merged rows: one exchange, of the source, which its check for repeated keys and the join share."""
    spark = source.sparkSession
    target = spark.table(f"{db}.{table.name}").select(*table.schema.fieldNames())
    dealt = source.select(*table.schema.fieldNames()).repartition(buckets_of(spark, db, table), *table.keys)
    # A broadcast of either side would leave the buckets; a full outer join has none.
    return upsert(target, dealt.hint("merge"), table.keys, update_when, update_cols)


def upsert_bucketed(
    source: DataFrame,
    db: str,
    table: Table,
    update_when: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None,
    update_cols: Sequence[str] | None = None,
) -> str | None:
    """Merge into a bucketed table; returns the folder it had before, for the caller to delete.

    The rows go to a new folder, by way of a table of the same buckets, and the catalog entry is pointed there
    afterwards: a job that dies leaves the former rows.
    """
    spark = source.sparkSession
    name = f"{db}.{table.name}"
    merged = merged_in_buckets(source, db, table, update_when, update_cols)
    beside, folder = f"{name}_{uuid.uuid4().hex}", new_folder(spark, db, table.name)
    spark.sql(
        f"CREATE TABLE {beside} ({table.columns_ddl()}) USING parquet"
        f" {_bucketed_by(table, buckets_of(spark, db, table))} LOCATION '{folder}'"
    )
    try:
        merged.write.insertInto(beside)
        former = location(spark, name)
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(name)
    finally:
        # An external table: dropping it keeps the files.
        spark.sql(f"DROP TABLE {beside}")
    return former
