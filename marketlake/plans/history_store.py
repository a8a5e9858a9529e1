"""The stored market history: closed versions appended, open ones replaced, batch by batch.

    <root>/closed/batch=<folder>/closed_year=<y>   versions that the batch closed, by the year in
                                                   which they ended
    <root>/open/batch=<folder>                     open versions after the batch
    <root>/batches                                 one row per finished batch or compaction

A batch reads the open versions alone, so its work follows the number of markets and of new
landings and not the length of the history. A batch without a row in `batches` does not count: a
crash leaves the previous state in force, and the batch can run again under its name. So a batch can
also be prepared, looked at, and finished later or never.

When more than `MOST_FOLDERS` batches have been finished since, their closed versions are rewritten
into one folder. So a reader lists a bounded number of folders, and of these only the years that the
moment it asks for can lie in.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.plans import facts
from marketlake.session import stored, table_or_empty

BATCHES = T.StructType(
    [
        T.StructField("batch", T.StringType()),
        T.StructField("number", T.LongType()),
        T.StructField("folder", T.StringType()),
        T.StructField("compacted", T.BooleanType()),
    ]
)

# Folders of closed versions that a reader lists at most, but for one more.
MOST_FOLDERS = 50


@dataclass(frozen=True)
class Prepared:
    """A batch that is written and not finished. `folders` hold the closed versions with it, `newest`
    the open ones."""

    batch: str
    folders: list[str]
    newest: str
    number: int = 0
    starts_anew: bool = False
    is_new: bool = True


@dataclass(frozen=True)
class HistoryStore:
    spark: SparkSession
    root: str

    def _path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def _rows(self) -> list[Row]:
        """Finished batches and compactions in order."""
        rows = table_or_empty(self.spark, BATCHES, self._path("batches"))
        named = rows.select(
            "batch", "number", F.coalesce("folder", "batch").alias("folder"),
            F.coalesce("compacted", F.lit(False)).alias("compacted"),
        )
        # A compaction has the number of the last batch that it takes in, and comes after it.
        return named.distinct().orderBy("number", "compacted").collect()

    def batches(self) -> list[str]:
        return [r["batch"] for r in self._rows() if not r["compacted"]]

    @staticmethod
    def _folders(rows: list[Row]) -> list[str]:
        """Folders of closed versions: the last compaction and the batches after it."""
        last = max((i for i, r in enumerate(rows) if r["compacted"]), default=0)
        return [r["folder"] for r in rows[last:]]

    def folders(self) -> list[str]:
        return self._folders(self._rows())

    def _save(self, versions: DataFrame, batch: str) -> str:
        versions, folder = stored(versions), f"{batch}-{uuid.uuid4().hex[:8]}"
        is_open = F.col("valid_to").isNull()
        self._write_closed(versions.filter(~is_open), folder)
        versions.filter(is_open).write.mode("overwrite").parquet(self._path("open", f"batch={folder}"))
        return folder

    def _write_closed(self, versions: DataFrame, folder: str) -> None:
        years = versions.withColumn("closed_year", F.year("valid_to"))
        # A year is one task at least; large ones are split, small ones share a task.
        years.hint("rebalance", "closed_year").write.mode("overwrite").partitionBy(
            "closed_year"
        ).parquet(self._path("closed", f"batch={folder}"))

    def prepare_rebuild(self, log: DataFrame, batch: str) -> Prepared:
        """The whole history from the whole landing log."""
        folder = self._save(facts.markets_history(log), batch)
        return Prepared(batch, [folder], folder, starts_anew=True)

    def prepare_batch(self, new_log: DataFrame, batch: str) -> Prepared:
        """One more batch of landings; one that is finished already changes nothing."""
        rows = self._rows()
        batches = [r for r in rows if not r["compacted"]]
        folders = self._folders(rows)
        if not batches:
            return self.prepare_rebuild(new_log, batch)
        newest = batches[-1]["folder"]
        if batch in [r["batch"] for r in batches]:
            return Prepared(batch, folders, newest, is_new=False)
        before = self.spark.read.schema(facts.history_schema()).parquet(
            self._path("open", f"batch={newest}")
        )
        folder = self._save(facts.extend_history(before, new_log), batch)
        return Prepared(batch, [*folders, folder], folder, number=batches[-1]["number"] + 1)

    def finish(self, prepared: Prepared) -> None:
        """From now on the batch counts; after a rebuild earlier ones count no more."""
        if not prepared.is_new:
            return
        row = (prepared.batch, prepared.number, prepared.newest, False)
        self._append(row, "overwrite" if prepared.starts_anew else "append")
        if len(prepared.folders) > MOST_FOLDERS:
            self.compact()

    def _append(self, row: tuple, mode: str = "append") -> None:
        rows = self.spark.createDataFrame([row], BATCHES)
        rows.coalesce(1).write.mode(mode).parquet(self._path("batches"))

    def compact(self) -> None:
        """Rewrite all closed versions into one folder. The folders it replaces stay where they are,
        for readers that have listed them; see `replaced`."""
        rows = self._rows()
        batches = [r for r in rows if not r["compacted"]]
        if not batches:
            return
        folder = f"compacted-{uuid.uuid4().hex[:8]}"
        self._write_closed(self._closed(self._folders(rows)).drop("closed_year"), folder)
        self._append((None, batches[-1]["number"], folder, True))

    def replaced(self) -> list[str]:
        """Paths that no reader needs any more once those that run now have ended."""
        rows = self._rows()
        used, batches = self._folders(rows), [r for r in rows if not r["compacted"]]
        old = [self._path("closed", f"batch={r['folder']}") for r in rows if r["folder"] not in used]
        return old + [self._path("open", f"batch={r['folder']}") for r in batches[:-1]]

    def rebuild(self, log: DataFrame, batch: str) -> None:
        self.finish(self.prepare_rebuild(log, batch))

    def extend(self, new_log: DataFrame, batch: str) -> None:
        self.finish(self.prepare_batch(new_log, batch))

    def _closed(self, folders: list[str]) -> DataFrame:
        schema = T.StructType(
            [*facts.history_schema().fields, T.StructField("closed_year", T.IntegerType())]
        )
        paths = [self._path("closed", f"batch={f}") for f in folders]
        parts = [self.spark.read.schema(schema).parquet(p) for p in paths]
        return reduce(DataFrame.unionByName, parts)

    def _open(self, newest: str) -> DataFrame:
        schema = facts.history_schema()
        return self.spark.read.schema(schema).parquet(self._path("open", f"batch={newest}"))

    def read(self, prepared: Prepared | None = None) -> DataFrame:
        """All versions after the last finished batch, or after a prepared one."""
        if prepared is None:
            rows = self._rows()
            if not rows:
                return self.spark.createDataFrame([], facts.history_schema())
            newest = [r["folder"] for r in rows if not r["compacted"]][-1]
            return self._closed(self._folders(rows)).drop("closed_year").unionByName(self._open(newest))
        closed = self._closed(prepared.folders).drop("closed_year")
        return closed.unionByName(self._open(prepared.newest))

    def as_of(self, moment: datetime) -> DataFrame:
        """The versions in force at a moment (UTC). Versions that ended in earlier years are not
        listed."""
        rows = self._rows()
        if not rows:
            return self.spark.createDataFrame([], facts.history_schema())
        at = F.lit(moment).cast("timestamp")
        newest = [r["folder"] for r in rows if not r["compacted"]][-1]
        later = self._closed(self._folders(rows)).filter(F.col("closed_year") >= moment.year)
        versions = later.drop("closed_year").unionByName(self._open(newest))
        ended = F.col("valid_to").isNotNull() & (F.col("valid_to") <= at)
        return versions.filter((F.col("valid_from") <= at) & ~ended)
