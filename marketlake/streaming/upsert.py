"""Raw price rows merged into the price fact, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.plans.facts import merge_prices
from marketlake.session import stored
from marketlake.sources.schemas import RAW_PRICES
from marketlake.streaming.load import loaded_schema

# Files of one merge: bounds a batch, not what a call merges.
FILES_PER_MERGE = 200


def upsert_prices(
    spark: SparkSession,
    raw_path: str,
    fact_path: str,
    checkpoint: str,
    files_per_merge: int = FILES_PER_MERGE,
) -> None:
    """Merge all good raw price rows not merged yet into the fact, then stop.

    Quarantined lines of a loaded table are left out, as in every other reader of it. A replayed
    micro-batch changes nothing, so at-least-once delivery is enough. Batches come from the
    checkpoint, not from a time stamp: late files are not lost.
    """
    reader = (
        spark.readStream.schema(loaded_schema("raw_price_history"))
        .option("maxFilesPerTrigger", files_per_merge)
        .parquet(raw_path)
        .filter(~F.coalesce("quarantined", F.lit(False)))
        .select(*RAW_PRICES.fieldNames())
    )

    def merge(batch: DataFrame, _batch_id: int) -> None:
        # Read twice, for the touched dates and for the merge: written to the shared folder once.
        merge_prices(batch.sparkSession, fact_path, stored(batch))

    (
        reader.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
