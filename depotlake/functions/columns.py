"""Identifier, date and timestamp clean-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The two formats met in the daily files.
DATE_FORMATS = ("M/d/yyyy", "yyyy-MM-dd")
# Texts of a format that a cast reads alike, once their parts are put in order, at a fraction of the cost; a date that
# does not exist costs it no exception. Only a cast knows a year 0.
_CAST_ALIKE = {
    "M/d/yyyy": (r"^([0-9]{1,2})/([0-9]{1,2})/(?!0000)([0-9]{4})\z", "$3-$1-$2"),
    "yyyy-MM-dd": (r"^(?!0000)([0-9]{4})-([0-9]{2})-([0-9]{2})\z", None),
}


def normalise_id(column: Column | str) -> Column:
    """One rule for the identifiers of every entity, so they join."""
    return F.upper(F.trim(column))


def parse_date(column: Column | str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """The first format that fits; null when none does, also under ANSI mode.

    A format is tried only on text that holds its separator: a failed parse costs far more
    than a successful one.
    """
    text = F.trim(column)

    def attempt(fmt: str) -> Column:
        separator = next((c for c in fmt if not c.isalpha()), "")
        parsed = F.try_to_date(text, fmt)
        if fmt in _CAST_ALIKE:
            pattern, order = _CAST_ALIKE[fmt]
            ordered = F.regexp_replace(text, pattern, order) if order else text
            parsed = F.when(text.rlike(pattern), ordered.try_cast("date")).otherwise(parsed)
        return F.when(text.contains(separator), parsed)

    return F.coalesce(*(attempt(fmt) for fmt in formats))


def parse_timestamp(column: Column | str) -> Column:
    return F.try_to_timestamp(F.trim(column))


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, StringType)
