"""Staging: parse and deduplicate the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions import casts, payload, prices
from marketlake.operators.dedupe import first_by

MARKET_COLUMNS = [
    "market_id",
    "condition_id",
    "question",
    "slug",
    "event_id",
    "event_slug",
    "yes_token_id",
    "no_token_id",
    "yes_price",
    "no_price",
    "is_active",
    "is_closed",
    "uma_resolution_status",
    "is_neg_risk",
    "volume_usd",
    "liquidity_usd",
    "start_at",
    "end_at",
    "closed_at",
    "created_at",
    "updated_at",
    "ingested_at",
]

PRICE_COLUMNS = [
    "price_id",
    "token_id",
    "market_id",
    "condition_id",
    "price_ts",
    "price_date",
    "price",
    "fidelity_minutes",
    "ingested_at",
]


def parse_markets(raw: DataFrame) -> DataFrame:
    """The wanted payload fields as text, next to their lineage; the payload is dropped.

    Parsing comes before the dedupe on purpose: its shuffle then moves twenty short
    fields per fetch instead of whole payloads.
    """
    text = raw.select(
        payload.fields(F.col("payload")),
        F.col("_ingested_at").alias("ingested_at"),
        F.col("_run_id").alias("run_id"),
        F.xxhash64("payload").alias("payload_hash"),
    )
    event = payload.first_event(F.col(payload.EVENTS_FIELD))
    return text.select(
        *[value.alias(field) for field, value in payload.scalar_fields().items()],
        payload.name(event["id"]).alias("event_id"),
        payload.name(event["slug"]).alias("event_slug"),
        "ingested_at",
        "run_id",
        "payload_hash",
    ).filter(F.col("market_id").isNotNull())


def type_markets(parsed: DataFrame) -> DataFrame:
    """Typed columns from the text fields, one row out per row in."""
    # Each list is parsed once for both of its items.
    parsed = parsed.withColumns(
        {f"_{c}": payload.string_list(F.col(c)) for c in ("token_list", "price_list")}
    )
    text = {
        "yes_price": F.get("_price_list", F.lit(0)),
        "no_price": F.get("_price_list", F.lit(1)),
        "volume_usd": F.col("volume"),
        "liquidity_usd": F.col("liquidity"),
    }
    typed = {
        "yes_token_id": payload.token(F.col("_token_list"), 0),
        "no_token_id": payload.token(F.col("_token_list"), 1),
        **{name: casts.safe_double(value) for name, value in text.items()},
        "is_active": casts.safe_bool(F.col("active")),
        "is_closed": casts.safe_bool(F.col("closed")),
        "is_neg_risk": casts.safe_bool(F.col("neg_risk")),
        "start_at": casts.safe_timestamp(F.col("start_date")),
        "end_at": casts.safe_timestamp(F.col("end_date")),
        "closed_at": casts.repaired_timestamp(F.col("closed_time")),
        "created_at": casts.safe_timestamp(F.col("created")),
        "updated_at": casts.safe_timestamp(F.col("updated")),
    }
    return parsed.withColumns(typed).select(*MARKET_COLUMNS, "run_id", "payload_hash")


def market_log(raw: DataFrame) -> DataFrame:
    """Every landed version of every market, typed. Feeds the history."""
    return type_markets(parse_markets(raw))


def newest_first() -> list:
    return [F.desc("ingested_at"), F.desc("run_id"), F.desc("payload_hash")]


def stg_markets(raw: DataFrame) -> DataFrame:
    """One row per market: its latest fetch."""
    latest = first_by(parse_markets(raw), ["market_id"], newest_first())
    return type_markets(latest).select(*MARKET_COLUMNS)


def newest_versions(log: DataFrame) -> DataFrame:
    """Each market's latest fetch with what ranks it, so that later fetches can compete."""
    return first_by(log, ["market_id"], newest_first())


def latest_markets(log: DataFrame) -> DataFrame:
    """The same rows as `stg_markets`, from a market log that is already stored."""
    return newest_versions(log).select(*MARKET_COLUMNS)


POINT_COLUMNS = [
    "token_id",
    "market_id",
    "condition_id",
    "price_ts",
    "price",
    "fidelity_minutes",
    "ingested_at",
    "run_id",
]


def price_points(raw: DataFrame) -> DataFrame:
    """Usable raw price rows with typed time and clamped price, duplicates still in."""
    usable = raw.filter(prices.usable_point(F.col("token_id"), F.col("t"), F.col("p")))
    return usable.select(
        "token_id",
        "market_id",
        "condition_id",
        prices.epoch_ts(F.col("t")).alias("price_ts"),
        prices.clamp_unit(F.col("p")).alias("price"),
        "fidelity_minutes",
        F.col("_ingested_at").alias("ingested_at"),
        F.col("_run_id").alias("run_id"),
    )


def best_points(points: DataFrame) -> DataFrame:
    """One row per (token, moment): finest fidelity, then newest landing.

    The order is total, so any split of the rows into batches ends in the same winners.
    Key and date are derived columns: they are added to the winners, not shuffled.
    """
    order = [
        F.asc("fidelity_minutes"),
        F.desc("ingested_at"),
        F.desc("run_id"),
        F.desc("price"),
        F.desc("market_id"),
        F.desc("condition_id"),
    ]
    winners = first_by(points.select(*POINT_COLUMNS), ["token_id", "price_ts"], order)
    key = prices.price_key(F.col("token_id"), F.unix_seconds("price_ts"))
    return winners.select(
        key.alias("price_id"), *POINT_COLUMNS, F.to_date("price_ts").alias("price_date")
    )


def stg_prices(raw: DataFrame) -> DataFrame:
    return best_points(price_points(raw)).select(*PRICE_COLUMNS)
