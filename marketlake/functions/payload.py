"""Reading a catalog payload."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed payload field names, output name first.
TEXT_FIELDS = {
    "market_id": "id",
    "condition_id": "conditionId",
    "question": "question",
    "slug": "slug",
    "token_list": "clobTokenIds",
    "price_list": "outcomePrices",
    "active": "active",
    "closed": "closed",
    "uma_resolution_status": "umaResolutionStatus",
    "neg_risk": "negRisk",
    "volume": "volumeNum",
    "liquidity": "liquidityNum",
    "start_date": "startDate",
    "end_date": "endDate",
    "closed_time": "closedTime",
    "created": "createdAt",
    "updated": "updatedAt",
}

# Kept as text, so an array or object in their place must become NULL. The other fields
# are cast, which does the same, or are lists themselves.
NAME_FIELDS = ("market_id", "condition_id", "slug", "uma_resolution_status")
PROSE_FIELDS = ("question",)

EVENTS_FIELD = "events"
EVENT_REFS = "array<struct<id: string, slug: string>>"


def fields(payload: Column) -> Column:
    """The wanted fields as text columns, NULL where absent, in one pass over the payload.

    `json_tuple` is a generator: no later filter on a field is pushed below it, which
    would parse every payload again.
    """
    wanted = [*TEXT_FIELDS.values(), EVENTS_FIELD]
    return F.json_tuple(payload, *wanted).alias(*TEXT_FIELDS, EVENTS_FIELD)


def first_event(events: Column) -> Column:
    """The first event reference (id, slug) of a market."""
    return F.get(F.from_json(events, EVENT_REFS), F.lit(0))


def opens_container(text: Column) -> Column:
    return F.startswith(text, F.lit("[")) | F.startswith(text, F.lit("{"))


def name(text: Column) -> Column:
    """An identifier-like scalar; NULL when the text is a JSON array or object."""
    return F.when(~opens_container(text), text)


def prose(text: Column) -> Column:
    """Free text, which may well begin with a bracket: NULL only if it parses as JSON."""
    return F.when(~opens_container(text) | F.try_parse_json(text).isNull(), text)


def scalar_fields() -> dict[str, Column]:
    """The extracted text fields by output name, scalars guarded."""
    guard = {**dict.fromkeys(NAME_FIELDS, name), **dict.fromkeys(PROSE_FIELDS, prose)}
    return {f: guard.get(f, lambda text: text)(F.col(f)) for f in TEXT_FIELDS}


def json_scalar(payload: Column, path: str) -> Column:
    """One scalar by path. For a single field; `fields` reads many in one pass."""
    return prose(F.get_json_object(payload, path))


def string_list(text: Column) -> Column:
    """A JSON list written as text (or a real list) as array<string>; anything else NULL."""
    return F.from_json(text, "array<string>")


def list_item(text: Column, index: int) -> Column:
    """Item `index` of a JSON list; NULL when out of range or not a list."""
    return F.get(string_list(text), F.lit(index))


def token(items: Column, index: int) -> Column:
    """A token of a parsed list; NULL when missing or empty."""
    return F.nullif(F.get(items, F.lit(index)), F.lit(""))


def yes_token(token_list: Column) -> Column:
    """Token of the first outcome; NULL when missing, empty or broken."""
    return token(string_list(token_list), 0)


def no_token(token_list: Column) -> Column:
    return token(string_list(token_list), 1)
