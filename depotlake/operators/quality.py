"""Null and validity rules, rejected rows, audit columns."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_rejected(rules: Mapping[str, Column]) -> Column:
    """True where any rule rejects the row; a rule maps a reason to the rejecting condition."""
    return reduce(or_, (F.coalesce(condition, F.lit(False)) for condition in rules.values()))


def split_rejects(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split into accepted rows and rejected rows with the first failing rule as reason.

    A null condition passes. The accepted side becomes a plain conjunction, so null rules
    are filters of the scan. The other side asks for a reason instead of a disjunction,
    which Spark would expand and evaluate several times below a join.
    """
    reason = F.coalesce(*(F.when(condition, reason) for reason, condition in rules.items()))
    rejected = df.withColumn("reject_reason", reason).filter(F.col("reject_reason").isNotNull())
    return df.filter(~is_rejected(rules)), rejected


def run_time(run_ts: datetime | Column | None) -> Column:
    """The run's clock: a literal when given, else the start of the query."""
    if run_ts is None:
        return F.current_timestamp()
    return run_ts if isinstance(run_ts, Column) else F.lit(run_ts).cast("timestamp")


def add_audit(df: DataFrame, source_system: str, run_ts: datetime | None = None) -> DataFrame:
    return df.withColumns(
        {"ingestion_timestamp": run_time(run_ts), "source_system": F.lit(source_system)}
    )
