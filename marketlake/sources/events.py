"""Raw event payloads: the events themselves, and the copies of markets inside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions import casts, payload
from marketlake.operators.dedupe import first_by
from marketlake.plans import staging

# Fixed payload field names of an event, output name first.
EVENT_FIELDS = {
    "event_id": "id",
    "slug": "slug",
    "closed": "closed",
    "end_date": "endDate",
    "volume": "volume",
}
MARKETS_FIELD = "markets"

# What tells two versions of a market apart, besides the moment of its update.
COMPARED = [
    c for c in staging.MARKET_COLUMNS if c not in ("market_id", "updated_at", "ingested_at")
]


def _parsed(raw_events: DataFrame) -> DataFrame:
    """Text fields of every landed event, its markets as the JSON they are, and its lineage."""
    wanted = [*EVENT_FIELDS.values(), MARKETS_FIELD]
    return raw_events.select(
        F.json_tuple(F.col("payload"), *wanted).alias(*EVENT_FIELDS, MARKETS_FIELD),
        F.col("_ingested_at").alias("ingested_at"),
        F.col("_run_id").alias("run_id"),
        F.xxhash64("payload").alias("payload_hash"),
    )


def latest_events(raw_events: DataFrame) -> DataFrame:
    """event_id, slug, is_closed, volume_usd, end_at, ingested_at: the latest fetch of each event.

    The columns that a sweep goes by have the names they have for markets, so that
    `sweeps.sweep` takes events too, with a floor of their own.
    """
    named = _parsed(raw_events).drop(MARKETS_FIELD).withColumns(
        {c: payload.name(F.col(c)) for c in ("event_id", "slug")}
    )
    newest = first_by(
        named.filter(F.col("event_id").isNotNull()), ["event_id"], staging.newest_first()
    )
    return newest.select(
        "event_id",
        "slug",
        casts.safe_bool(F.col("closed")).alias("is_closed"),
        casts.safe_double(F.col("volume")).alias("volume_usd"),
        casts.safe_timestamp(F.col("end_date")).alias("end_at"),
        "ingested_at",
    )


def market_copies(raw_events: DataFrame) -> DataFrame:
    """The copies of markets in all landed events, as rows of `raw_markets`.

    One row a copy, with the lineage of its event. An event whose markets are no list has none; a
    copy that is null has none.
    """
    copies = F.explode(payload.string_list(F.col(MARKETS_FIELD)))
    return (
        raw_events.select(
            "_ingested_at", "_run_id", "_source",
            F.json_tuple(F.col("payload"), MARKETS_FIELD).alias(MARKETS_FIELD),
        )
        .select("_ingested_at", "_run_id", "_source", copies.alias("payload"))
        .filter(F.col("payload").isNotNull())
    )


def _side(markets: DataFrame, name: str) -> DataFrame:
    """One side of the comparison: its columns under its name."""
    same = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in COMPARED])
    return markets.select(
        F.col("market_id").alias(f"{name}_id"),
        F.col("updated_at").alias(f"{name}_updated_at"),
        same.alias(f"{name}_content"),
    )


def compare_markets(raw_markets: DataFrame, raw_events: DataFrame) -> DataFrame:
    """market_id, status, markets_updated_at, events_updated_at: every market either source has.

    The latest fetch of a market is held against the latest copy of it in an event:

    * `only_markets`, `only_events`: the other source has never had it
    * `older_in_events`, `older_in_markets`: by the moment of its update; none is older than any
    * `different`: the same moment, yet another content
    * `same`

    Both sides have one row a market before they meet, so no key of the join is large.
    """
    fetched = _side(staging.stg_markets(raw_markets), "markets")
    copied = _side(staging.stg_markets(market_copies(raw_events)), "events")
    met = fetched.join(copied, F.col("markets_id") == F.col("events_id"), "full")
    never = F.to_timestamp(F.lit("0001-01-01"))

    def moment(name: str) -> Column:
        return F.coalesce(f"{name}_updated_at", never)

    status = (
        F.when(F.col("events_id").isNull(), "only_markets")
        .when(F.col("markets_id").isNull(), "only_events")
        .when(moment("events") < moment("markets"), "older_in_events")
        .when(moment("markets") < moment("events"), "older_in_markets")
        .when(F.col("markets_content") != F.col("events_content"), "different")
        .otherwise("same")
    )
    return met.select(
        F.coalesce("markets_id", "events_id").alias("market_id"),
        status.alias("status"),
        "markets_updated_at",
        "events_updated_at",
    )


def comparison_counts(compared: DataFrame) -> DataFrame:
    """Markets by status."""
    return compared.groupBy("status").agg(F.count(F.lit(1)).alias("n_markets"))
