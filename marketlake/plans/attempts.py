"""The ledger of backfill attempts, and what a finished backfill or harvest run did.

    <root>/log/generation=<g>/run=<id>   the attempts of a run, replaced if the run is recorded again
    <root>/last/generation=<g>           one row a token: what its attempts have come to so far
    <root>/generations                   one row for each compaction, written last

A reader takes the last compaction and the runs after it. A compaction that crashed before its row
was written does not count. One writer at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators.dedupe import first_by
from marketlake.plans.planning import backfill_todo
from marketlake.plans.run_log import RunLog
from marketlake.session import stored, table_or_empty

# Outcomes of an attempt. A token is done when history landed, or when there is none to land.
LANDED, EMPTY, FAILED = "landed", "empty", "failed"

ATTEMPTS = T.StructType(
    [
        T.StructField("token_id", T.StringType()),
        T.StructField("market_id", T.StringType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("fidelity_minutes", T.LongType()),
        T.StructField("points", T.LongType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("attempted_at", T.TimestampType()),
    ]
)
GENERATIONS = T.StructType([T.StructField("generation", T.LongType())])


def is_done() -> Column:
    return F.col("outcome").isin(LANDED, EMPTY)


def last_attempts(attempts: DataFrame) -> DataFrame:
    """One row per token: its newest attempt that is done, else its newest one.

    A failure after a done attempt does not undo it. Ties: the greater run id.
    """
    order = [is_done().desc(), F.col("attempted_at").desc_nulls_last(), F.desc("run_id")]
    return first_by(attempts, ["token_id"], order)


@dataclass(frozen=True)
class AttemptLedger:
    """Attempts by token, appended run by run."""

    spark: SparkSession
    root: str

    def _path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def _read(self, schema: T.StructType, *parts: str) -> DataFrame:
        rows = table_or_empty(self.spark, schema, self._path(*parts))
        return rows.select(*schema.fieldNames())  # without the folders' names

    def generation(self) -> int:
        """Finished compactions."""
        newest = self._read(GENERATIONS, "generations").agg(F.max("generation").alias("g"))
        return newest.head()["g"] or 0

    def record(self, attempts: DataFrame) -> None:
        """Append the attempts of runs (columns of `ATTEMPTS`; a token once a run)."""
        log = self._path("log", f"generation={self.generation()}")
        (
            attempts.select(*ATTEMPTS.fieldNames(), F.col("run_id").alias("run"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("run")
            .parquet(log)
        )

    def last(self) -> DataFrame:
        """One row per attempted token (see `last_attempts`)."""
        g = self.generation()
        log = self._read(ATTEMPTS, "log", f"generation={g}")
        before = self._read(ATTEMPTS, "last", f"generation={g}")
        return last_attempts(before.unionByName(log))

    def done(self) -> DataFrame:
        """Tokens that no backfill needs to attempt again."""
        return self.last().filter(is_done())

    def compact(self) -> None:
        """Fold the runs since the last compaction into one row per token."""
        g = self.generation() + 1
        path = self._path("last", f"generation={g}")
        self.last().write.mode("overwrite").parquet(path)
        row = self.spark.createDataFrame([(g,)], GENERATIONS)
        row.coalesce(1).write.mode("append").parquet(self._path("generations"))


def attempt_outcomes(
    attempted: DataFrame, landed: DataFrame, failed: DataFrame, run_id: str, at: Column
) -> DataFrame:
    """What became of each attempted token of a run, in the columns of `ATTEMPTS`.

    attempted: market_id, yes_token_id. landed: the raw price rows of the run. failed: token_id of
    the fetches that failed, which count as failed whatever landed before the failure. Landed rows
    are counted by token first, so a long history meets the plan as one row.
    """
    counted = landed.groupBy("token_id").agg(
        F.count(F.lit(1)).alias("points"), F.min("fidelity_minutes").alias("fidelity_minutes")
    )
    broken = failed.select("token_id").distinct().withColumn("_failed", F.lit(True))
    tokens = attempted.select(F.col("yes_token_id").alias("token_id"), "market_id").filter(
        F.col("token_id").isNotNull()
    )
    joined = tokens.join(counted, "token_id", "left").join(broken, "token_id", "left")
    outcome = F.when(F.col("_failed"), FAILED).when(F.col("points") > 0, LANDED).otherwise(EMPTY)
    return joined.select(
        "token_id",
        "market_id",
        outcome.alias("outcome"),
        F.when(outcome == LANDED, F.col("fidelity_minutes")).alias("fidelity_minutes"),
        F.when(outcome == LANDED, F.col("points")).otherwise(0).cast("bigint").alias("points"),
        F.lit(run_id).alias("run_id"),
        at.cast("timestamp").alias("attempted_at"),
    )


def plan_backfill(scope: DataFrame, ledger: AttemptLedger) -> DataFrame:
    """Markets of the scope whose token the ledger does not have as done, in no order."""
    return backfill_todo(scope, ledger.done())


def fidelity_used(outcomes: DataFrame) -> DataFrame:
    """Tokens of a run by the fidelity that landed: a few rows."""
    landed = outcomes.filter(F.col("outcome") == LANDED)
    return landed.groupBy("fidelity_minutes").agg(F.count(F.lit(1)).alias("n_tokens"))


def finish_backfill(
    scope: DataFrame,
    landed: DataFrame,
    failed: DataFrame,
    *,
    ledger: AttemptLedger,
    log: RunLog,
    run_id: str,
    at: Column,
) -> dict[str, int]:
    """Record what a backfill run over `scope` did, and raise if too much of it failed.

    The attempts are those that `plan_backfill` gave before the run. They go to the ledger first, so
    a run that fails the gate is not fetched again as a whole.
    """
    wanted = scope.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("yes_token_id").isNull()).alias("none")
    ).head()
    attempted = plan_backfill(scope, ledger)
    outcomes = stored(attempt_outcomes(attempted, landed, failed, run_id, at))
    ledger.record(outcomes)
    did = outcomes.agg(
        F.count(F.lit(1)).alias("attempted"),
        F.count_if(F.col("outcome") == EMPTY).alias("no_history"),
        F.count_if(F.col("outcome") == FAILED).alias("token_failures"),
        F.sum("points").alias("points_landed"),
    ).head()
    counters = {
        "markets_targeted": wanted["n"],
        "skipped_no_token": wanted["none"],
        "already_done": wanted["n"] - wanted["none"] - did["attempted"],
        **did.asDict(),
        **{f"fidelity_{r['fidelity_minutes']}": r["n_tokens"] for r in fidelity_used(outcomes).collect()},
    }
    return log.finish("backfill-prices", run_id, counters, did["attempted"], did["token_failures"])


def finish_harvest(
    planned: DataFrame, landed: DataFrame, failed: DataFrame, *, log: RunLog, run_id: str
) -> dict[str, int]:
    """Record what a harvest run did with the markets of `plan_harvest`, and raise if too much of it
    failed. landed: the raw price rows of the run; failed: token_id of the fetches that failed."""
    broken = failed.select(F.col("token_id").alias("yes_token_id"), F.lit(True).alias("_failed"))
    status = F.col("status")
    did = (
        planned.select("yes_token_id", "status")
        .join(broken.distinct(), "yes_token_id", "left")
        .agg(
            F.count(F.lit(1)).alias("markets_targeted"),
            F.count_if(status == "fetch").alias("tokens_fetched"),
            F.count_if(status == "fresh").alias("skipped_fresh_watermark"),
            F.count_if(status == "no_token").alias("skipped_no_token"),
            F.count_if((status == "fetch") & F.col("_failed").isNotNull()).alias("token_failures"),
        )
        .head()
        .asDict()
    )
    counters = {**did, "points_landed": landed.count()}
    return log.finish(
        "harvest-prices", run_id, counters, did["tokens_fetched"], did["token_failures"]
    )
