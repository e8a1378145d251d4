"""Shipment event files, as a batch or as a stream, with drift kept in a rescue column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from depotlake.schemas import SHIPMENT_JSON

EVENT_COLUMNS = SHIPMENT_JSON.fieldNames()


def read_event_stream(
    spark: SparkSession,
    path: str,
    schema: StructType = SHIPMENT_JSON,
    multiline: bool = True,
    max_files: int | None = None,
) -> DataFrame:
    """New event files as a stream; existing files are included.

    ``multiline`` files hold one pretty-printed object or an array of objects each, otherwise
    there is one object per line and large files are split. ``max_files`` bounds a
    micro-batch when there is a backlog.
    """
    reader = spark.readStream.option("recursiveFileLookup", True)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # The text reader resets an option of this name, so it has to be the argument.
    return parse_events(reader.text(path, wholetext=multiline), schema)


def read_event_files(
    spark: SparkSession, path: str | list[str], schema: StructType = SHIPMENT_JSON, multiline: bool = True
) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", True)
    return parse_events(reader.text(path, wholetext=multiline), schema)


def parse_events(raw: DataFrame, schema: StructType = SHIPMENT_JSON) -> DataFrame:
    """Parse the text in ``value``: the schema's fields, ``_rescued_data`` and ``source_file``.

    The rescue column holds the fields the schema does not know as JSON, and the whole text
    of an object that cannot be parsed.
    """
    documents = F.when(
        F.ltrim("value").startswith("["),
        F.coalesce(F.from_json("value", "array<string>"), F.array("value")),
    ).otherwise(F.array("value"))
    one_each = raw.select(
        F.explode(documents).alias("_text"), F.col("_metadata.file_path").alias("source_file")
    ).filter(F.trim("_text") != "")
    return with_rescued(one_each, "_text", schema).drop("_text")


def with_rescued(df: DataFrame, text: str, schema: StructType) -> DataFrame:
    """Add the schema's fields and ``_rescued_data``, both parsed from the column ``text``."""
    checked = StructType([*schema.fields, StructField("_corrupt", StringType())])
    known = [F.lit(f.name) for f in schema]
    extra = F.map_filter(
        F.from_json(text, "map<string,string>"), lambda name, _: ~name.isin(*known)
    )
    parsed = df.withColumn(
        "_parsed", F.from_json(text, checked, {"columnNameOfCorruptRecord": "_corrupt"})
    ).withColumn("_extra", extra)
    rescued = F.when(
        F.col("_parsed").isNull() | F.col("_parsed._corrupt").isNotNull(), F.col(text)
    ).when(F.size("_extra") > 0, F.to_json("_extra"))
    return parsed.select(
        *(F.col(f"_parsed.`{f.name}`").alias(f.name) for f in schema),
        rescued.alias("_rescued_data"),
        *df.columns,
    )
