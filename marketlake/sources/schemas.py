"""Explicit schemas of the raw tables. Nothing is inferred anywhere."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

LINEAGE = [
    T.StructField("_ingested_at", T.TimestampType()),
    T.StructField("_run_id", T.StringType()),
    T.StructField("_source", T.StringType()),
]

# Catalog payloads stay text: their fields drift, and ids of 77 digits must keep every digit.
RAW_CATALOG = T.StructType([*LINEAGE, T.StructField("payload", T.StringType())])

RAW_PRICES = T.StructType(
    [
        *LINEAGE,
        T.StructField("token_id", T.StringType()),
        T.StructField("market_id", T.StringType()),
        T.StructField("condition_id", T.StringType()),
        T.StructField("t", T.LongType()),
        T.StructField("p", T.DoubleType()),
        T.StructField("fidelity_minutes", T.LongType()),
    ]
)

RAW_TABLES = {
    "raw_markets": RAW_CATALOG,
    "raw_events": RAW_CATALOG,
    "raw_price_history": RAW_PRICES,
}

# The price fact. `run_id` is stored so that a merge ranks old and new rows by the
# same total order as a full rebuild.
FCT_PRICES = T.StructType(
    [
        T.StructField("price_id", T.StringType()),
        T.StructField("token_id", T.StringType()),
        T.StructField("market_id", T.StringType()),
        T.StructField("condition_id", T.StringType()),
        T.StructField("price_ts", T.TimestampType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("fidelity_minutes", T.LongType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("price_date", T.DateType()),
    ]
)


def with_corrupt(schema: T.StructType) -> T.StructType:
    """The schema plus the column that keeps a line which did not parse."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def selected_tables(include_events: bool = False) -> list[str]:
    """Tables a load ships. Event payloads repeat their markets, so they are opt-in."""
    return [t for t in RAW_TABLES if include_events or t != "raw_events"]
