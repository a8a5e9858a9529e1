"""Counters of finished runs, one row each, and the gate that a run has to pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marketlake.session import table_or_empty

# Share of failed units above which a run fails.
TOLERANCE = 0.1

COUNTERS = T.StructType(
    [
        T.StructField("job", T.StringType()),
        T.StructField("counter", T.StringType()),
        T.StructField("value", T.LongType()),
        T.StructField("run_id", T.StringType()),
    ]
)


class RunFailed(RuntimeError):
    """Too many units of a run failed. What it did and counted is stored all the same."""

    def __init__(self, run_id: str, failed: int, attempted: int):
        self.run_id, self.failed, self.attempted = run_id, failed, attempted
        super().__init__(f"{failed}/{attempted} units failed (run {run_id})")


@dataclass(frozen=True)
class RunLog:
    """Counters below one folder, partitioned by run. A run recorded again replaces itself."""

    spark: SparkSession
    root: str

    def record(self, job: str, run_id: str, counters: dict[str, int]) -> None:
        rows = [(job, name, int(value or 0), run_id) for name, value in counters.items()]
        (
            self.spark.createDataFrame(rows, COUNTERS)
            .coalesce(1)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("run_id")
            .parquet(self.root)
        )

    def finish(
        self, job: str, run_id: str, counters: dict[str, int], attempted: int, failed: int
    ) -> dict[str, int]:
        """Record, then raise `RunFailed` if strictly more than the tolerated share failed."""
        self.record(job, run_id, counters)
        if failed > TOLERANCE * attempted:
            raise RunFailed(run_id, failed, attempted)
        return counters

    def read(self) -> DataFrame:
        """job, counter, value, run_id of every recorded run."""
        return table_or_empty(self.spark, COUNTERS, self.root)
