"""Daily sales kept up by signed differences of order lines, so late corrections count without a recompute.

The state holds the newest version of every order line. New lines are compared with it by key, in one shuffle:
a line that changed takes its old quantity from its old day and adds its new one to its new day. The differences are
summed per warehouse, product and day and applied to stored sums, which also count the lines of a
group, so a group that has lost its last line goes. Only the days that occur are read and written.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from depotlake.config import scratch_dir
from depotlake.plans.silver import SALES_KEYS
from depotlake.schemas import FACT_SALES_DAILY, struct
from depotlake.sinks.tables import replace_partitions
from depotlake.sinks.versions import bucket_of, complete_versions, forget_versions, read_versions, spread, version_folder, write_version
from depotlake.sources.files import delete_paths, list_names, make_folder

GROUP = ("warehouse_id", "product_id", "sale_date")
LINES = struct("order_id STRING, product_id STRING, warehouse_id STRING, sale_date DATE, quantity_sold INT")
# As they are stored: read by their names, so versions without the last two are still read as lines.
MERGED = StructType([*LINES.fields]).add("changed", "boolean").add("old", struct("sale_date DATE, quantity_sold INT"))
SUMS = struct("warehouse_id STRING, product_id STRING, sale_date DATE, qty_sold BIGINT, lines BIGINT")
# Fixed once a state exists: lines are placed by them. Some hundred MB of lines each is a good size.
LINE_BUCKETS = 16
# Tasks deal a bucket's lines out in so many parts.
PARTS = 64
# Days fall into buckets by their number, so the days of a run are few buckets.
DAY_BUCKETS = 512


def merged_lines(known: DataFrame, arrived: DataFrame, line_buckets: int) -> DataFrame:
    """The newest version of every line with its bucket, and ``old``, the version known before, where it has ``changed``.

    The newest version is chosen as silver does: by date, then quantity, nulls last; repeats in ``arrived`` and
    lines that are known already change nothing. One shuffle: lines are dealt by parts of their buckets
    before they are grouped, so no partial groups are sorted first, and each task has few buckets to write.
    """
    version = F.struct("sale_date", "quantity_sold")
    one = lambda rows, is_new: rows.select(*SALES_KEYS, version.alias("version"), F.lit(is_new).alias("is_new"))
    both = one(known, False).unionByName(one(arrived, True)).withColumns(
        {"hash": F.xxhash64(*SALES_KEYS), "bucket": bucket_of(SALES_KEYS, line_buckets)}
    )
    dealt = both.withColumn("part", F.pmod(F.shiftright("hash", 32), F.lit(PARTS))).repartition("bucket", "part")
    # The hash comes first: a sort that compares numbers, and hardly ever texts.
    lines = dealt.groupBy("hash", *SALES_KEYS, "bucket", "part").agg(
        F.max(F.when(~F.col("is_new"), F.col("version"))).alias("old"), F.max("version").alias("new")
    )
    changed = ~F.col("old").eqNullSafe(F.col("new"))
    return lines.select(*SALES_KEYS, "new.*", changed.alias("changed"), F.when(changed, F.col("old")).alias("old"), "bucket")


def signed_sums(changes: DataFrame) -> DataFrame:
    """The differences that changed lines make, per warehouse, product and day. Undated lines have no day."""
    side = lambda name, sign: F.when(
        F.col(f"{name}.sale_date").isNotNull(),
        F.struct(
            F.col(f"{name}.sale_date").alias("sale_date"),
            (sign * F.coalesce(F.col(f"{name}.quantity_sold").cast("long"), F.lit(0))).alias("qty_sold"),
            F.lit(sign).cast("long").alias("lines"),
        ),
    )
    sides = F.filter(F.array(side("old", -1), side("new", 1)), lambda s: s.isNotNull())
    signed = changes.select("warehouse_id", "product_id", F.explode(sides).alias("s")).select("warehouse_id", "product_id", "s.*")
    return signed.groupBy(*GROUP).agg(F.sum("qty_sold").alias("qty_sold"), F.sum("lines").alias("lines"))


def _day_bucket():
    return F.pmod(F.datediff("sale_date", F.lit(date(1970, 1, 1))), F.lit(DAY_BUCKETS)).cast("int")


def merge_sales(spark: SparkSession, sales: DataFrame, db: str, state: str, line_buckets: int = LINE_BUCKETS) -> list[date]:
    """Bring ``fact_sales_daily`` up to date with new or corrected silver lines; returns the days that changed.

    The lines are merged once and written with what they were before; the sums and the fact's days are made of
    those that changed. A mark is there from before the lines until after the days: the version it names does not
    count, so a run that died is made again from the same lines, and lines that are merged already make no difference.
    """
    lines_at, sums_at = f"{state}/lines", f"{state}/sums"
    pending = {int(name[8:]) for name in list_names(spark, state) if name.startswith("pending=")}
    done = {v for versions in complete_versions(spark, lines_at).values() for v in versions} - pending
    version = max(done, default=0) + 1
    mark = f"{state}/pending={version:012d}"
    staged = scratch_dir(spark, "sales-changes")
    try:
        # Read twice below: only buckets that new lines fall into are compared.
        sales.select(*LINES.fieldNames()).write.parquet(f"{staged}/arrived")
        new = spark.read.schema(LINES).parquet(f"{staged}/arrived")
        touched = [row[0] for row in new.select(bucket_of(SALES_KEYS, line_buckets)).distinct().collect()]
        if not touched:
            return []
        known = read_versions(spark, lines_at, LINES, touched, before=version)
        make_folder(spark, mark)
        write_version(merged_lines(known, new, line_buckets), lines_at, version)
        merged = spark.read.schema(MERGED).parquet(*(version_folder(lines_at, version, bucket) for bucket in touched))
        signed_sums(merged.where("changed").withColumn("new", F.struct("sale_date", "quantity_sold"))).write.parquet(f"{staged}/signed")
        signed = spark.read.schema(SUMS).parquet(f"{staged}/signed")
        # Days of the run, at most as many as there are days.
        days = sorted(row[0] for row in signed.select("sale_date").distinct().collect())
        if days:
            buckets = sorted({(day - date(1970, 1, 1)).days % DAY_BUCKETS for day in days})
            former = read_versions(spark, sums_at, SUMS, buckets, before=version)
            summed = former.unionByName(signed).groupBy(*GROUP).agg(F.sum("qty_sold").alias("qty_sold"), F.sum("lines").alias("lines"))
            # Groups without lines stay as zeros: a bucket that none is left in has a version all the same.
            write_version(spread(summed.withColumn("bucket", _day_bucket())), sums_at, version)
            current = read_versions(spark, sums_at, SUMS, buckets).where(F.col("sale_date").isin(days) & (F.col("lines") > 0))
            _replace_days(spark, current.select(*FACT_SALES_DAILY.schema.fieldNames()), db, days)
        delete_paths(spark, [mark])
        forget_versions(spark, sums_at)
        forget_versions(spark, lines_at)
        return days
    finally:
        delete_paths(spark, [staged])


def _replace_days(spark: SparkSession, rows: DataFrame, db: str, days: list[date]) -> None:
    """Make ``rows`` the whole content of the given days; days without rows are dropped."""
    name = f"{db}.{FACT_SALES_DAILY.name}"
    replace_partitions(rows, db, FACT_SALES_DAILY)
    left = {row[0] for row in rows.select("sale_date").distinct().collect()}
    gone = ", ".join(f"PARTITION (sale_date = DATE '{day.isoformat()}')" for day in days if day not in left)
    if gone:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {gone}")
