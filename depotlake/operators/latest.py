"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType


# Holds, beside the row that was chosen, how many further rows its key had.
REPEATS = "_repeats"


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """The row with the greatest ``order_by`` values per key, nulls last.

    ``tie_break`` defaults to every other column, which makes the order total: rows that
    still tie are equal, so the result does not depend on partitioning or task order.
    Spark plans ``row_number() = 1`` as a group limit on both sides of the shuffle, so a
    key that holds most of the rows sends one row per input partition, not all of them.
    """
    if tie_break is None:
        taken = {*keys, *order_by}
        tie_break = [
            f.name
            for f in df.schema
            if f.name not in taken and not isinstance(f.dataType, (MapType, VariantType))
        ]
    order = [F.col(c).desc_nulls_last() for c in [*order_by, *tie_break]]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def latest_counted(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The rows of ``latest_by`` with the number of rows that each replaced, from the same shuffle.

    A maximum of whole rows in place of a rank: repeats are counted in the tasks, before rows are left out.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    newest = F.max(F.struct(*order_by, *rest)).alias("_newest")
    grouped = df.groupBy(*keys).agg(newest, (F.count(F.lit(1)) - 1).alias(REPEATS))
    return grouped.select(*keys, "_newest.*", REPEATS).select(*df.columns, REPEATS)
