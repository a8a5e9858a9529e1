"""Landing zone: append-only, date-partitioned JSON lines with lineage on every row."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketlake.sources.schemas import CORRUPT, RAW_TABLES, with_corrupt


def new_run_id(job: str, now: datetime | None = None) -> str:
    """`<job>-<utc stamp>-<hex>`, unique per call."""
    now = now or datetime.now(timezone.utc)
    return f"{job}-{now:%Y%m%dT%H%M%SZ}-{uuid.uuid4().hex[:8]}"


def with_lineage(
    df: DataFrame, run_id: Column | str, source: Column | str, ingested_at: Column | datetime
) -> DataFrame:
    def col(value):
        return value if isinstance(value, Column) else F.lit(value)

    return df.withColumns(
        {
            "_ingested_at": F.date_trunc("second", col(ingested_at).cast("timestamp")),
            "_run_id": col(run_id),
            "_source": col(source),
        }
    )


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/raw/{table}"


def json_line(df: DataFrame) -> Column:
    """One JSON object per row, on one line.

    A `payload` goes in as the nested JSON it is; its line breaks, which JSON allows between
    fields only, become spaces. One that is no JSON goes in as a string, so that its row comes back
    with the same text.
    """
    flat = [
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ssxxx").alias(c) if c == "_ingested_at" else F.col(c)
        for c in df.columns
        if c != "payload"
    ]
    line = F.to_json(F.struct(*flat))
    if "payload" not in df.columns:
        return line
    opened = F.regexp_replace(line, r"\}\z", "")
    # As the one item of a list, so that text after the value is not taken for more of the line.
    # Parsed once: the items are looked up in what was parsed.
    listed = F.try_parse_json(F.concat(F.lit("["), F.col("payload"), F.lit("]")))
    is_json = (
        F.try_variant_get(listed, "$[0]", "variant").isNotNull()
        & F.try_variant_get(listed, "$[1]", "variant").isNull()
    )
    broken = F.contains("payload", F.lit("\n")) | F.contains("payload", F.lit("\r"))
    # Few payloads have line breaks, and each character costs.
    unbroken = F.when(broken, F.translate("payload", "\r\n", "  ")).otherwise(F.col("payload"))
    nested = F.concat(
        opened, F.lit(',"payload":'), F.coalesce(unbroken, F.lit("null")), F.lit("}")
    )
    as_text = F.to_json(F.struct(*flat, F.col("payload")))
    return F.when(F.col("payload").isNull() | is_json, nested).otherwise(as_text)


# Rows of one packed file, at most: a reader cannot share such a file between tasks.
PACKED_ROWS = 100_000


def land(df: DataFrame, root: str, table: str, packed: bool = False) -> bool:
    """Append lineage-stamped rows below `raw/<table>/dt=<ingest date>/run=<run id>/`.

    One pass: rows are counted while they are written. Returns whether there were any; an empty
    run leaves no date folder. `packed`: as gzip files, of PACKED_ROWS at most; lines of JSON are
    mostly field names, so that takes a small part of the disk.
    """
    counted = Observation()
    lines = df.select(
        json_line(df).alias("value"),
        F.to_date("_ingested_at").alias("dt"),
        F.col("_run_id").alias("run"),
    ).observe(counted, F.count(F.lit(1)).alias("n"))
    writer = lines.write.mode("append").partitionBy("dt", "run")
    if packed:
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", PACKED_ROWS)
        writer = writer.option("zlib.compress.level", "BEST_SPEED")
    writer.text(table_path(root, table))
    return counted.get["n"] > 0


def scan_landed(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Landed rows of one table, with `dt`; a line that does not parse is kept apart in
    the corrupt column, unknown fields are ignored."""
    return (
        spark.read.schema(with_corrupt(RAW_TABLES[table]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(table_path(root, table))
        .drop("run")
    )


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined lines)."""
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, df.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def lineage_counts(raw: DataFrame) -> DataFrame:
    """Rows and time range per run and source."""
    return raw.groupBy("_run_id", "_source").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("_ingested_at").alias("first_ingested_at"),
        F.max("_ingested_at").alias("last_ingested_at"),
    )
