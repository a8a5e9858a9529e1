"""Projections, predicates and scalar functions, each over its whole input table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions import casts, display, payload, prices
from marketlake.plans import facts, marts
from marketlake.registry.core import Inputs, emit, query
from marketlake.registry.oracle import r6


@query(
    "json_scalar",
    """select _run_id, json_extract_string(payload, '$.id') as market_id,
         json_extract_string(payload, '$.conditionId') as condition_id,
         json_extract_string(payload, '$.question') as question,
         json_extract_string(payload, '$.slug') as slug,
         json_extract_string(payload, '$.umaResolutionStatus') as uma_resolution_status,
         json_extract_string(payload, '$.events[0].id') as event_id,
         json_extract_string(payload, '$.events[0].slug') as event_slug
       from fx_raw_markets""",
)
def json_scalar(x: Inputs) -> DataFrame:
    paths = {
        "market_id": "$.id",
        "condition_id": "$.conditionId",
        "question": "$.question",
        "slug": "$.slug",
        "uma_resolution_status": "$.umaResolutionStatus",
        "event_id": "$.events[0].id",
        "event_slug": "$.events[0].slug",
    }
    body = F.col("payload")
    return x.raw_markets.select(
        "_run_id", *[payload.json_scalar(body, p).alias(n) for n, p in paths.items()]
    )


_LISTS = """select _run_id, json_extract_string(payload, '$.clobTokenIds') as tokens,
    json_extract_string(payload, '$.outcomePrices') as finals from fx_raw_markets"""


def _list_fields(x: Inputs) -> DataFrame:
    return x.raw_markets.select(
        "_run_id",
        F.json_tuple("payload", "clobTokenIds", "outcomePrices").alias("tokens", "finals"),
    )


@query(
    "json_string_array",
    f"""select _run_id,
         json_extract_string(case when json_valid(tokens) then tokens end, '$[0]') as token_0,
         json_extract_string(case when json_valid(tokens) then tokens end, '$[1]') as token_1,
         json_extract_string(case when json_valid(finals) then finals end, '$[0]') as price_0,
         json_extract_string(case when json_valid(finals) then finals end, '$[1]') as price_1,
         json_extract_string(case when json_valid(finals) then finals end, '$[2]') as price_2
       from ({_LISTS})""",
)
def json_string_array(x: Inputs) -> DataFrame:
    tokens, finals = F.col("tokens"), F.col("finals")
    return _list_fields(x).select(
        "_run_id",
        *[payload.list_item(tokens, i).alias(f"token_{i}") for i in range(2)],
        *[payload.list_item(finals, i).alias(f"price_{i}") for i in range(3)],
    )


@query(
    "yes_token_id",
    f"""select _run_id, nullif(json_extract_string(
         case when json_valid(tokens) then tokens end, '$[0]'), '') as yes_token_id
       from ({_LISTS})""",
)
def yes_token_id(x: Inputs) -> DataFrame:
    return _list_fields(x).select(
        "_run_id", payload.yes_token(F.col("tokens")).alias("yes_token_id")
    )


@query(
    "safe_cast_numeric",
    "select run_id, yes_price, no_price, volume_usd, liquidity_usd from market_log",
)
def safe_cast_numeric(x: Inputs) -> DataFrame:
    text = x.raw_markets.select(
        F.col("_run_id").alias("run_id"),
        F.json_tuple("payload", "outcomePrices", "volumeNum", "liquidityNum").alias("f", "v", "l"),
    )
    return text.select(
        "run_id",
        casts.safe_double(payload.list_item(F.col("f"), 0)).alias("yes_price"),
        casts.safe_double(payload.list_item(F.col("f"), 1)).alias("no_price"),
        casts.safe_double(F.col("v")).alias("volume_usd"),
        casts.safe_double(F.col("l")).alias("liquidity_usd"),
    )


@query("safe_cast_bool", "select run_id, is_active, is_closed, is_neg_risk from market_log")
def safe_cast_bool(x: Inputs) -> DataFrame:
    names = {"is_active": "active", "is_closed": "closed", "is_neg_risk": "negRisk"}
    text = x.raw_markets.select(
        F.col("_run_id").alias("run_id"), F.json_tuple("payload", *names.values()).alias(*names)
    )
    return text.select("run_id", *[casts.safe_bool(F.col(n)).alias(n) for n in names])


@query(
    "safe_cast_timestamp", "select run_id, start_at, end_at, created_at, updated_at from market_log"
)
def safe_cast_timestamp(x: Inputs) -> DataFrame:
    names = {
        "start_at": "startDate",
        "end_at": "endDate",
        "created_at": "createdAt",
        "updated_at": "updatedAt",
    }
    text = x.raw_markets.select(
        F.col("_run_id").alias("run_id"), F.json_tuple("payload", *names.values()).alias(*names)
    )
    return emit(text.select("run_id", *[casts.safe_timestamp(F.col(n)).alias(n) for n in names]))


@query("closed_at_repair", "select run_id, closed_at from market_log")
def closed_at_repair(x: Inputs) -> DataFrame:
    text = x.raw_markets.select(
        F.col("_run_id").alias("run_id"), F.json_tuple("payload", "closedTime").alias("closed_time")
    )
    repaired = casts.repaired_timestamp(F.col("closed_time"))
    return emit(text.select("run_id", repaired.alias("closed_at")))


@query(
    "epoch_to_ts",
    """select _run_id, t, make_timestamp(t * 1000000) as price_ts,
         cast(make_timestamp(t * 1000000) as date) as price_date
       from fx_raw_price_history""",
)
def epoch_to_ts(x: Inputs) -> DataFrame:
    ts = prices.epoch_ts(F.col("t"))
    return emit(
        x.raw_prices.select("_run_id", "t", ts.alias("price_ts"), F.to_date(ts).alias("price_date"))
    )


@query(
    "surrogate_key",
    "select _run_id, token_id || ':' || cast(t as varchar) as price_id from fx_raw_price_history",
)
def surrogate_key(x: Inputs) -> DataFrame:
    key = prices.price_key(F.col("token_id"), F.col("t"))
    return x.raw_prices.select("_run_id", key.alias("price_id"))


@query(
    "clamp_unit",
    "select _run_id, p, least(greatest(p, 0), 1) as price from fx_raw_price_history",
)
def clamp_unit(x: Inputs) -> DataFrame:
    return x.raw_prices.select("_run_id", "p", prices.clamp_unit(F.col("p")).alias("price"))


@query(
    "not_null_filter",
    "select * from fct_resolutions",
)
def not_null_filter(x: Inputs) -> DataFrame:
    candidates = facts.resolution_candidates(x.stg_markets)
    return emit(candidates.dropna(subset=["outcome", "yes_token_id", "resolved_at"]))


@query(
    "boolean_filter",
    "select market_id, is_closed, is_neg_risk from stg_markets where is_closed and is_neg_risk",
)
def boolean_filter(x: Inputs) -> DataFrame:
    return x.stg_markets.filter("is_closed and is_neg_risk").select(
        "market_id", "is_closed", "is_neg_risk"
    )


@query(
    "between_filter",
    """select market_id, token_id, cast(price_ts as date) as price_date,
         cast(resolved_at as date) - cast(price_ts as date) as days_before, count(*) as n_points
       from final_month group by all""",
)
def between_filter(x: Inputs) -> DataFrame:
    joined = marts.prices_before_resolution(x.resolutions, x.stg_prices)
    left = prices.days_between(F.to_date("resolved_at"), F.col("price_date"))
    return (
        joined.withColumn("days_before", left)
        .filter(F.col("days_before").between(0, 30))
        .groupBy("market_id", "token_id", "price_date", "days_before")
        .agg(F.count(F.lit(1)).alias("n_points"))
    )


@query("terminal_outcome", """select market_id, case when yes_price = 1 and no_price = 0 then 'yes'
         when yes_price = 0 and no_price = 1 then 'no' end as outcome from stg_markets where is_closed""")
def terminal_outcome(x: Inputs) -> DataFrame:
    return facts.resolution_candidates(x.stg_markets).select("market_id", "outcome")


@query("oracle_confirms", """select market_id, uma_resolution_status = 'resolved' as oracle_confirms
       from stg_markets where is_closed""")
def oracle_confirms(x: Inputs) -> DataFrame:
    return facts.resolution_candidates(x.stg_markets).select("market_id", "oracle_confirms")


@query("resolved_at", """select market_id, closed_at, end_at, ifnull(closed_at, end_at) as resolved_at
       from stg_markets where is_closed""")
def resolved_at(x: Inputs) -> DataFrame:
    rows = facts.resolution_candidates(x.stg_markets)
    return emit(rows.select("market_id", "closed_at", "end_at", "resolved_at"))


@query(
    "outcome_int",
    "select market_id, case when outcome = 'yes' then 1 else 0 end as outcome_int "
    "from fct_resolutions",
)
def outcome_int(x: Inputs) -> DataFrame:
    return x.resolutions.select("market_id", prices.outcome_int(F.col("outcome")).alias("outcome_int"))


@query(
    "price_bucket",
    """select price_id, least(cast(floor(price * 10) as bigint), 9) as price_bucket
       from stg_prices""",
)
def price_bucket(x: Inputs) -> DataFrame:
    return x.stg_prices.select("price_id", prices.price_bucket(F.col("price")).alias("price_bucket"))


@query(
    "ts_minus_hours",
    """select market_id, horizon_hours, target_ts, target_ts - interval 50 hour as earliest_ts
       from horizon_targets""",
)
def ts_minus_hours(x: Inputs) -> DataFrame:
    earliest = prices.minus_hours(F.col("target_ts"), F.lit(marts.ASOF_TOLERANCE_HOURS))
    return emit(
        marts.horizon_targets(x.resolutions).select(
            "market_id", "horizon_hours", "target_ts", earliest.alias("earliest_ts")
        )
    )


@query(
    "days_between",
    """select market_id, date_diff('day', cast(start_at as date), cast(resolved_at as date)) as days
       from (select market_id, start_at, coalesce(closed_at, end_at) as resolved_at
             from stg_markets)""",
)
def days_between(x: Inputs) -> DataFrame:
    end = F.coalesce("closed_at", "end_at")
    days = prices.days_between(F.to_date(end), F.to_date("start_at"))
    return x.stg_markets.select("market_id", days.alias("days"))


@query(
    "wilson_interval",
    f"""select horizon_hours, price_bucket, {r6('wilson_low')} as wilson_low,
         {r6('wilson_high')} as wilson_high
       from calibration""",
)
def wilson_interval(x: Inputs) -> DataFrame:
    rows = x.calibration.select("horizon_hours", "price_bucket", "wilson_low", "wilson_high")
    return emit(rows, "wilson_low", "wilson_high")


@query(
    "squared_error",
    f"""select market_id, horizon_hours,
         {r6("pow(price - case when outcome = 'yes' then 1 else 0 end, 2)")} as squared_error,
         {r6("abs(price - case when outcome = 'yes' then 1 else 0 end)")} as abs_error
       from horizon_prices""",
)
def squared_error(x: Inputs) -> DataFrame:
    priced = marts.price_at_targets(marts.horizon_targets(x.resolutions), x.stg_prices)
    won = prices.outcome_int(F.col("outcome"))
    rows = priced.select(
        "market_id",
        "horizon_hours",
        prices.squared_error(F.col("price"), won).alias("squared_error"),
        F.abs(F.col("price") - won).alias("abs_error"),
    )
    return emit(rows, "squared_error", "abs_error")


@query(
    "deviation",
    f"select event_id, price_date, {r6('deviation')} as deviation from coherence",
)
def deviation(x: Inputs) -> DataFrame:
    rows = marts.mart_event_coherence(facts.dim_markets(x.stg_markets), x.stg_prices)
    return emit(rows.select("event_id", "price_date", "deviation"), "deviation")


@query("dim_projection", "select * from dim_markets")
def dim_projection(x: Inputs) -> DataFrame:
    return emit(x.stg_markets.select(*facts.DIM_COLUMNS))


@query(
    "compact_number",
    """select price_id, case when t >= 1e9 then printf('%.1fB', t / 1e9) end as moment,
         case when n >= 1e6 then printf('%.1fM', n / 1e6) when n >= 1e3 then printf('%.1fK', n / 1e3)
           else printf('%.0f', n) end as amount
       from (select price_id, epoch(price_ts) as t, (epoch(price_ts) % 9973) * 211.5 as n
             from stg_prices)""",
)
def compact_number(x: Inputs) -> DataFrame:
    seconds = F.unix_timestamp("price_ts")
    return x.stg_prices.select(
        "price_id",
        display.compact_number(seconds).alias("moment"),
        display.compact_number((seconds % 9973) * F.lit(211.5)).alias("amount"),
    )


@query(
    "bucket_label",
    """select horizon_hours, price_bucket, concat(cast(price_bucket * 10 as varchar), '–',
         cast(price_bucket * 10 + 10 as varchar), '¢') as label
       from calibration""",
)
def bucket_label(x: Inputs) -> DataFrame:
    return x.calibration.select(
        "horizon_hours", "price_bucket", display.bucket_label(F.col("price_bucket")).alias("label")
    )
