"""Registration of queries with their oracle SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.plans import facts, marts, staging
from marketlake.registry import fixtures
from marketlake.registry.oracle import CTES
from marketlake.session import configure, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Inputs:
    """Raw tables and the plans above them, built on first use from one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    @cached_property
    def events(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/events.parquet")

    @cached_property
    def raw_prices(self) -> DataFrame:
        return fixtures.raw_price_history(self.spark, self.sf_dir)

    @cached_property
    def raw_markets(self) -> DataFrame:
        return fixtures.raw_markets(self.spark, self.sf_dir)

    @cached_property
    def raw_events(self) -> DataFrame:
        return fixtures.raw_events(self.spark, self.sf_dir)

    @cached_property
    def unordered_log(self) -> DataFrame:
        return fixtures.market_log_unordered(self.spark, self.sf_dir)

    @cached_property
    def market_log(self) -> DataFrame:
        return staging.market_log(self.raw_markets)

    @cached_property
    def stg_markets(self) -> DataFrame:
        return staging.stg_markets(self.raw_markets)

    @cached_property
    def stg_prices(self) -> DataFrame:
        return staging.stg_prices(self.raw_prices)

    @cached_property
    def resolutions(self) -> DataFrame:
        return facts.fct_resolutions(self.stg_markets)

    @cached_property
    def history(self) -> DataFrame:
        return facts.markets_history(stored(facts.tracked(self.market_log)))

    @cached_property
    def calibration(self) -> DataFrame:
        return marts.mart_calibration(self.resolutions, self.stg_prices)


def emit(df: DataFrame, *rounded: str) -> DataFrame:
    """Result columns both engines can compare: zone-free timestamps, and averages rounded
    with a nudge off exact halves (engines sum floats in different orders)."""
    columns = []
    for name, kind in df.dtypes:
        col = F.col(name)
        if kind == "timestamp":
            col = col.cast("timestamp_ntz")
        elif name in rounded:
            col = F.round(col + F.lit(1e-10), 6)
        columns.append(col.alias(name))
    return df.select(*columns)


def _with_ctes(body: str) -> str:
    """Prefix the CTEs that `body` reads, and those they read, dependencies first."""
    needed: dict[str, str] = {}

    def visit(sql: str) -> None:
        for name, text in CTES.items():
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b", sql):
                visit(text)
                needed[name] = text

    visit(body)
    if not needed:
        return body
    return "with " + ",\n".join(f"{n} as ({t})" for n, t in needed.items()) + "\n" + body


def query(key: str, oracle: str | None = None):
    """Register a plan under `key`. The function takes `Inputs`."""

    def wrap(fn: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Inputs(spark, sf_dir))

        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = _with_ctes(oracle)
        return fn

    return wrap
