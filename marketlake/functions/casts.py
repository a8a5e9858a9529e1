"""Tolerant casts: a value that does not fit becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns. Spark's own casts accept more ('1d' as a number, '2024' as a
# timestamp, 'yes' as a boolean) than the sources mean.
NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?|nan)\s*$"
DATE_FIRST = r"^\d{4}-\d{2}-\d{2}"


def safe_double(text: Column) -> Column:
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def safe_bool(text: Column) -> Column:
    word = F.lower(text)
    return F.when(word == "true", F.lit(True)).when(word == "false", F.lit(False))


def safe_timestamp(text: Column) -> Column:
    return F.when(text.rlike(DATE_FIRST), text.try_cast("timestamp"))


def repaired_timestamp(text: Column) -> Column:
    """Also reads a bare `+00` offset, which strict parsers want as `+00:00`."""
    return F.coalesce(safe_timestamp(text), safe_timestamp(F.concat(text, F.lit(":00"))))
