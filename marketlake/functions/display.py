"""Text for report rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed units, largest first.
UNITS = ((1e9, "B"), (1e6, "M"), (1e3, "K"))


def compact_number(n: Column) -> Column:
    """1.5B / 2.3M / 4.0K, plain digits below a thousand; halves round to even."""
    text = F.format_number(n.cast("double"), 0)
    for size, suffix in reversed(UNITS):
        scaled = F.replace(F.format_number(n.cast("double") / size, 1), F.lit(","), F.lit(""))
        text = F.when(n >= size, F.concat(scaled, F.lit(suffix))).otherwise(text)
    return text


def bucket_label(bucket: Column) -> Column:
    """Price range of a decile in cents."""
    low = (bucket * 10).cast("string")
    high = (bucket * 10 + 10).cast("string")
    return F.concat(low, F.lit("–"), high, F.lit("¢"))
