"""MERGE for DataFrames: update matched rows, insert the others, keep the rest."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_when: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None,
    update_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Merge ``source`` into ``target`` on ``keys`` and return the merged rows.

    ``update_when(t, s)`` gets two column lookups and says which matched rows change (a null
    answer means no change); ``update_cols`` limits what changes in them. A source key that
    is null or repeated fails the job, as it has no single meaning. The check is a window on
    the join key, so it shares the join's shuffle and sort.
    """
    columns = target.columns
    update_cols = [c for c in columns if c not in keys] if update_cols is None else update_cols

    window = Window.partitionBy(*keys).orderBy(*keys)
    key_text = F.concat_ws(", ", *(F.col(k).cast("string") for k in keys))
    any_null = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    present = (
        F.when(any_null, F.raise_error(F.lit("upsert source has a null key")).cast("boolean"))
        .when(
            F.row_number().over(window) > 1,
            F.raise_error(F.concat(F.lit("upsert source repeats key: "), key_text)).cast("boolean"),
        )
        .otherwise(F.lit(True))
    )
    s = source.select(*columns).withColumn("_in_source", present).alias("s")
    t = target.withColumn("_in_target", F.lit(True)).alias("t")

    def of_target(name: str) -> Column:
        return F.col(f"t.`{name}`")

    def of_source(name: str) -> Column:
        return F.col(f"s.`{name}`")

    inserted = F.col("t._in_target").isNull()
    matched = F.col("s._in_source").isNotNull() & F.col("t._in_target").isNotNull()
    changed = matched if update_when is None else matched & update_when(of_target, of_source)

    def merged(name: str) -> Column:
        take_source = inserted | changed if name in update_cols else inserted
        return F.when(take_source, of_source(name)).otherwise(of_target(name)).alias(name)

    on = reduce(lambda a, b: a & b, (of_target(k) == of_source(k) for k in keys))
    return t.join(s, on, "full_outer").select(*(merged(c) for c in columns))
