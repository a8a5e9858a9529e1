"""Materialising the warehouse: staging as views, facts and marts as tables.

A build writes each table beside the published one and checks it before anything stands on it. Only
when all checks have passed are the tables published, by one row each in a small table that says
where they lie. A build that a check stops leaves every published table as it was.

    <root>/_builds/<build>/<table>   what a build wrote
    <root>/_published                where each table lies, by build; the last row of a table counts
    <root>/fct_prices                the price fact that batches are merged into
    <root>/markets_history           see `history_store`
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators import quality as q
from marketlake.plans import checks, facts, marts, staging
from marketlake.plans.history_store import HistoryStore, Prepared
from marketlake.plans.run_log import RunLog
from marketlake.session import stored, table_or_empty
from marketlake.sources.layout import write_price_partitions

PUBLISHED = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("number", T.LongType()),
        T.StructField("build", T.StringType()),
    ]
)


class BuildBlocked(RuntimeError):
    """A table failed its checks. Nothing of the build was published."""

    def __init__(self, table: str, failed: dict[str, int]):
        self.table, self.failed = table, failed
        super().__init__("failed checks: " + ", ".join(f"{c} ({n})" for c, n in failed.items()))


@dataclass
class Build:
    """The tables of one build so far, with the rows and the failures of their checks."""

    house: Warehouse
    name: str
    strict: bool
    tables: dict[str, DataFrame] = field(default_factory=dict)
    locations: dict[str, str] = field(default_factory=dict)
    counters: dict[str, int] = field(default_factory=dict)
    seen: dict[str, dict] = field(default_factory=dict)

    def path(self, table: str) -> str:
        return self.house.path(f"_builds/{self.name}/{table}")

    def _watched(
        self, tables: list[str], df: DataFrame, extra: Sequence[Column] = ()
    ) -> tuple[DataFrame, Observation]:
        """`df` with its rows and the failures of its row checks counted as it is used."""
        counts = [
            F.count_if(c.failing).alias(f"{table}:{i}")
            for table in tables
            for i, c in enumerate(checks.row_checks(table))
        ]
        told = Observation()
        return df.observe(told, F.count(F.lit(1)).alias("n"), *counts, *extra), told

    def _judge(self, tables: list[str], df: DataFrame, seen: dict, related: list) -> None:
        """Take the counts of the row checks, run the checks that need a shuffle, stop at an error.

        A key that several names share is checked once.
        """
        keys: dict[tuple, list[str]] = {}
        for table in tables:
            if table in checks.UNIQUE:
                keys.setdefault(tuple(checks.UNIQUE[table]), []).append(table)
        repeated = [
            q.count_check("+".join(key), q.duplicates(df, list(key))) for key in keys
        ]
        found = {r["name"]: r for r in q.severity_report(repeated + related).collect()} if (
            repeated or related
        ) else {}
        for table in tables:
            results = [
                (c.name, c.severity, seen.get(f"{table}:{i}") or 0)
                for i, c in enumerate(checks.row_checks(table))
            ]
            for key, names in keys.items():
                if table in names:
                    name = "+".join(key)
                    results.append((f"unique:{table}.{name}", "error", found[name]["failures"]))
            results += [
                (name, r["severity"], r["failures"])
                for name, r in found.items()
                if name.startswith(f"relationship:{table}.")
            ]
            self.counters[f"rows:{table}"] = seen.get("n") or 0
            self.counters.update({name: n for name, _, n in results})
            self.tables[table] = df
            red = {name: n for name, severity, n in results if n and severity == "error"}
            if red and self.strict:
                raise BuildBlocked(table, red)

    def add(self, table: str, df: DataFrame, **extra: Column) -> DataFrame:
        """Write a table beside the published one, check it, and read it back.

        Rows, row checks and `extra` aggregates (kept in `seen`) are observed by the write itself.
        """
        more = [value.alias(name) for name, value in extra.items()]
        watched, told = self._watched([table], df, more)
        watched.write.mode("overwrite").parquet(self.path(table))
        back = self.house.spark.read.schema(df.schema).parquet(self.path(table))
        self.locations[table] = self.path(table)
        self.seen[table] = told.get
        self._judge([table], back, told.get, [])
        return back

    def look(self, tables: list[str], df: DataFrame, related: list) -> None:
        """Check what is stored already, under one or more names, in one pass over its rows."""
        watched, told = self._watched(tables, df)
        watched.write.format("noop").mode("overwrite").save()
        self._judge(tables, df, told.get, related)


@dataclass(frozen=True)
class Warehouse:
    """Tables below one root folder, optionally registered in a catalog database."""

    spark: SparkSession
    root: str
    database: str | None = None

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    # --- published tables -----------------------------------------------------------

    def _published(self) -> DataFrame:
        return table_or_empty(self.spark, PUBLISHED, self.path("_published"))

    def location(self, name: str) -> str:
        """Where a table lies: where the last build put it, else below the root by its name."""
        row = (
            self._published()
            .filter(F.col("name") == name)
            .agg(F.max_by("location", "number").alias("at"))
            .head()
        )
        return row["at"] or self.path(name)

    def _publish(self, build: str, locations: dict[str, str]) -> None:
        last = self._published().agg(F.max("number").alias("n")).head()["n"]
        number = 0 if last is None else last + 1
        rows = [(name, at, number, build) for name, at in locations.items()]
        # One task writes one file, so all tables change over at once.
        df = self.spark.createDataFrame(rows, PUBLISHED).coalesce(1)
        df.write.mode("append").parquet(self.path("_published"))
        if self.database is not None:
            for name, at in locations.items():
                full = f"{self.database}.{name}"
                self.spark.sql(f"drop table if exists {full}")
                self.spark.catalog.createTable(full, path=at, source="parquet")
                if name == "fct_prices":
                    self.spark.catalog.recoverPartitions(full)

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table outside of a build, published as it is, and read it back."""
        at = self.path(f"_builds/{uuid.uuid4().hex}/{name}")
        df.write.mode("overwrite").parquet(at)
        self._publish("write", {name: at})
        return self.read(name, df)

    def read(self, name: str, like: DataFrame | None = None) -> DataFrame:
        if self.database is not None:
            return self.spark.table(f"{self.database}.{name}")
        reader = self.spark.read if like is None else self.spark.read.schema(like.schema)
        return reader.parquet(self.location(name))

    # --- building -------------------------------------------------------------------

    def _markets(
        self, raw_markets: DataFrame, full_refresh: bool, batch: str, history: HistoryStore
    ) -> tuple[DataFrame, Prepared]:
        """Newest versions and the prepared history, from all raw rows or from one more batch."""
        log = stored(staging.market_log(raw_markets))
        if full_refresh:
            return staging.newest_versions(log), history.prepare_rebuild(log, batch)
        # Only the batch is parsed; it competes with the newest version of each market.
        before = self.read("newest_markets", log)
        newest = staging.newest_versions(before.unionByName(log))
        return newest, history.prepare_batch(log, batch)

    def build(
        self,
        raw_markets: DataFrame,
        raw_prices: DataFrame,
        *,
        full_refresh: bool = True,
        batch: str | None = None,
        now: Column | None = None,
        strict: bool = True,
        log: RunLog | None = None,
    ) -> dict[str, DataFrame]:
        """All tables from the raw rows.

        With `full_refresh` off both inputs are one batch (named `batch`), merged into what is
        stored; the result equals a full build of all rows, whatever the split of the prices, for
        markets that come in the order of their landing. Views and marts are made from the stored
        facts, so they hold all rows too.

        With `strict` the first table that fails an error check stops the build (`BuildBlocked`),
        and nothing is published. With `now` the inputs' age is checked first, and a stale source
        raises before anything is built. With a `log` the rows of each table, the failures of each
        check and the raw price rows left out are recorded under the batch, stopped builds too.

        One build at a time. A batch's dates of the price fact are swapped when all checks have
        passed, before the other tables are published: a crash in between is mended by running the
        batch again.
        """
        batch = batch or uuid.uuid4().hex
        if now is not None:
            sources = {"raw_markets": raw_markets, "raw_price_history": raw_prices}
            checks.require_fresh(checks.freshness_report(sources, now))
        build = Build(self, f"{batch}-{uuid.uuid4().hex[:8]}", strict)
        try:
            return self._build(build, raw_markets, raw_prices, full_refresh, batch)
        finally:
            if log is not None:
                log.record("build", batch, build.counters)

    def _build(
        self,
        build: Build,
        raw_markets: DataFrame,
        raw_prices: DataFrame,
        full_refresh: bool,
        batch: str,
    ) -> dict[str, DataFrame]:
        store = HistoryStore(self.spark, self.path("markets_history"))
        newest, prepared = self._markets(raw_markets, full_refresh, batch, store)
        newest = build.add("newest_markets", newest)
        staged = build.add("stg_markets", newest.select(*staging.MARKET_COLUMNS))
        dims = build.add("dim_markets", facts.dim_markets(staged))
        moments = {
            name: pick(F.col("resolved_at").cast("timestamp_ntz"))
            for name, pick in (("first", F.min), ("last", F.max))
        }
        resolutions = build.add("fct_resolutions", facts.fct_resolutions(staged), **moments)
        seen = build.seen["fct_resolutions"]
        reach = marts.resolved_reach(resolutions, seen["n"], seen["first"], seen["last"])

        prices, swap = self._prices(build, raw_prices, full_refresh, dims)
        history = store.read(prepared)
        build.add("mart_calibration", marts.mart_calibration(resolutions, prices, reach))
        build.add("mart_price_dynamics", marts.mart_price_dynamics(resolutions, prices, reach))
        build.add("mart_event_coherence", marts.mart_event_coherence(dims, prices))
        build.add("mart_daily_volume", marts.mart_daily_volume(history))

        # Every check has passed: from here on the build is published.
        at = self.location("fct_prices")
        if full_refresh:
            build.locations["fct_prices"] = build.path("fct_prices")
        elif swap is not None:
            write_price_partitions(swap, at)
        store.finish(prepared)
        self._publish(build.name, build.locations)
        prices = facts.read_prices(self.spark, self.location("fct_prices"))
        staged.createOrReplaceTempView("stg_markets")
        # The fact holds the best point of every moment of all raw rows: that is the staging view.
        staged_prices = prices.select(*staging.PRICE_COLUMNS)
        staged_prices.createOrReplaceTempView("stg_prices")
        return {
            "stg_markets": staged,
            "stg_prices": staged_prices,
            "dim_markets": dims,
            "fct_prices": prices,
            "fct_resolutions": resolutions,
            "markets_history": store.read(),
            **{name: df for name, df in build.tables.items() if name.startswith("mart_")},
        }

    def _prices(
        self, build: Build, raw_prices: DataFrame, full_refresh: bool, dims: DataFrame
    ) -> tuple[DataFrame, DataFrame | None]:
        """(the fact as it will be, the dates to be swapped): written beside it and checked.

        A batch's checks look at the dates that it touches: the others were checked when they were
        written, and no point's key lies on two dates.
        """
        left_out, beside = Observation(), build.path("fct_prices")
        published = self.location("fct_prices")
        touched: list = []
        if full_refresh:
            facts.rebuild_prices(raw_prices, beside, left_out=left_out)
        else:
            touched = facts.touched_dates(raw_prices, left_out)
            if touched:
                merged = facts.merged_dates(self.spark, published, raw_prices, touched)
                write_price_partitions(merged, beside)
        build.counters.update({f"left_out:{k}": v or 0 for k, v in left_out.get.items()})
        changed = facts.read_prices(self.spark, beside)
        related = checks.relationship_counts({"fct_prices": changed, "dim_markets": dims})
        build.look(["stg_prices", "fct_prices"], changed, related)
        if full_refresh:
            return changed, None
        before = facts.read_prices(self.spark, published)
        if not touched:
            return before, None
        return before.filter(~F.col("price_date").isin(touched)).unionByName(changed), changed
