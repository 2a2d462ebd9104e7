"""The registered queries as DuckDB SQL over the same tables.

Written from the definitions, independently of the Spark code. Each query is a
chain of common table expressions ending in one SELECT.
"""

from __future__ import annotations

from tripmill import registry as rg
from tripmill.contracts import BUSINESS_KEY, PAYMENT_TYPES, RATE_CODES, VENDORS

_AMOUNTS = [
    "fare_amount", "extra_amount", "mta_tax_amount", "tip_amount", "tolls_amount",
    "improvement_surcharge_amount", "congestion_surcharge_amount", "airport_fee_amount",
    "cbd_congestion_fee_amount", "total_amount",
]
_KEY = BUSINESS_KEY


def _r(expr: str, digits: int) -> str:
    return f"cast(round(cast({expr} as decimal(28,10)), {digits}) as double)"


def _big(expr: str) -> str:
    return f"cast({expr} as bigint)"


def _int(expr: str) -> str:
    return f"cast({expr} as integer)"


def _values(rows, *names: str) -> str:
    body = ", ".join(f"({code}, '{text}')" for code, text in rows)
    return f"(values {body}) as codes({', '.join(names)})"


_EVENT_RAW = """
event_rows as (
    select event_id, ts, user_id, event_type, value,
           cast(json_extract_string(props, '$.k') as integer) as k
    from events
),
event_pairs as (
    select *, lead(ts) over per_user as next_ts, lead(k) over per_user as next_k
    from event_rows
    window per_user as (partition by user_id order by ts, event_id)
),
event_tips as (
    select *, case when event_id % 7 = 1 then 0.2 * value else 0 end as tip from event_pairs
),
loads as (
    select * from (values (1, timestamp '2024-03-01'), (20, timestamp '2024-03-02')) as t(every, loaded)
),
raw as (
    select
        case event_type when 'view' then 1 when 'click' then 2 when 'purchase' then 6
                        when 'signup' then 7 end as vendorid,
        ts as tpep_pickup_datetime,
        next_ts as tpep_dropoff_datetime,
        nullif(event_id % 6, 0) as passenger_count,
        value / 10 as trip_distance,
        nullif(k % 8, 0) as ratecodeid,
        case event_id % 50 when 0 then 'Y' when 1 then null else 'N' end as store_and_fwd_flag,
        case when k <> 99 then k % 25 end as pulocationid,
        next_k % 25 as dolocationid,
        event_id % 7 as payment_type,
        value - 0.5 as fare_amount,
        0.25::double as extra, 0.5::double as mta_tax,
        tip as tip_amount, 0::double as tolls_amount, 0.25::double as improvement_surcharge,
        value + 0.5 + tip as total_amount,
        case when event_id % 11 <> 0 then 2.5::double end as congestion_surcharge,
        case when k % 25 = 1 then 1.75::double end as airport_fee,
        case when event_id % 13 <> 0 then 0.75::double end as cbd_congestion_fee,
        case when event_id % 97 = 0 then 'yellow_tripdata_2024-02.parquet'
             else 'yellow_tripdata_2024-01.parquet' end as _source_file,
        loads.loaded as _loaded_at
    from event_tips join loads on event_id % loads.every = 0
)"""

_LINE_RAW = """
line_rows as (
    select *, date_trunc('month', o_orderdate)
              + case when l_linenumber = 7 then interval 1 month else interval 0 month end as file_month
    from lineitem
    join orders on o_orderkey = l_orderkey
    join customer on c_custkey = o_custkey
    join supplier on s_suppkey = l_suppkey
),
raw as (
    select
        l_suppkey % 8 as vendorid,
        o_orderdate as tpep_pickup_datetime,
        l_shipdate as tpep_dropoff_datetime,
        l_linenumber as passenger_count,
        l_quantity as trip_distance,
        null::bigint as ratecodeid,
        'N' as store_and_fwd_flag,
        c_nationkey as pulocationid,
        s_nationkey as dolocationid,
        cast(o_orderpriority[1] as integer) as payment_type,
        l_extendedprice as fare_amount,
        0::double as extra, 0::double as mta_tax, 0::double as tip_amount, 0::double as tolls_amount,
        0::double as improvement_surcharge,
        l_extendedprice * (1 - l_discount) * (1 + l_tax) as total_amount,
        null::double as congestion_surcharge, null::double as airport_fee,
        null::double as cbd_congestion_fee,
        'yellow_tripdata_' || strftime(file_month, '%Y-%m') || '.parquet' as _source_file,
        timestamp '2024-03-01' as _loaded_at
    from line_rows
)"""

_STAGED = f"""
staged as (
    select
        {_int('vendorid')} as vendor_key,
        {_int('ifnull(ratecodeid, 99)')} as rate_code_key,
        {_int('payment_type')} as payment_type_key,
        {_int('pulocationid')} as pickup_zone_key,
        {_int('dolocationid')} as dropoff_zone_key,
        tpep_pickup_datetime as pickup_at,
        tpep_dropoff_datetime as dropoff_at,
        {_int('passenger_count')} as passenger_count,
        trip_distance as trip_distance_miles,
        store_and_fwd_flag = 'Y' as is_store_and_forward,
        fare_amount, extra as extra_amount, mta_tax as mta_tax_amount, tip_amount, tolls_amount,
        improvement_surcharge as improvement_surcharge_amount,
        ifnull(congestion_surcharge, 0) as congestion_surcharge_amount,
        ifnull(airport_fee, 0) as airport_fee_amount,
        ifnull(cbd_congestion_fee, 0) as cbd_congestion_fee_amount,
        total_amount,
        _source_file as source_file,
        cast(regexp_extract(_source_file, '\\d{{4}}-\\d{{2}}') || '-01' as date) as source_file_month,
        _loaded_at as loaded_at
    from raw
)"""


def _broken(params) -> dict[str, str]:
    limit = params.max_trip_duration_min * 60
    rules = {
        "timestamp_null": "pickup_at is null or dropoff_at is null",
        "duration_non_positive": "dropoff_at <= pickup_at",
        "duration_too_long": f"date_diff('second', pickup_at, dropoff_at) > {limit}",
        "pickup_outside_file_month": "date_trunc('month', pickup_at) <> source_file_month",
        "distance_out_of_range": "trip_distance_miles <= 0"
        f" or trip_distance_miles > {params.max_trip_distance_miles}",
        "amount_non_positive": "fare_amount < 0 or total_amount <= 0",
        "zone_null": "pickup_zone_key is null or dropoff_zone_key is null",
    }
    if params.max_total_amount is not None:
        rules["amount_too_high"] = f"total_amount > {params.max_total_amount}"
    return rules


def _flagged(params) -> str:
    arms = " ".join(f"when {cond} then '{reason}'" for reason, cond in _broken(params).items())
    return f"""
flagged as (
    select *, date_diff('second', pickup_at, dropoff_at) / 60e0 as trip_duration_min,
           case {arms} end as rejection_reason
    from staged
)"""


_REST = [
    "source_file", "source_file_month", "rate_code_key", "payment_type_key", "passenger_count",
    "is_store_and_forward", *[a for a in _AMOUNTS if a not in _KEY],
]


def _key_value(column: str) -> str:
    decimal = column in ("trip_distance_miles", "fare_amount", "total_amount")
    return f"cast({column} as decimal(28,10))" if decimal else column


_DISTINCT = f"""
first_copies as (
    select * exclude (copy, rejection_reason) from (
        select *, row_number() over (
            partition by {', '.join(_key_value(c) for c in _KEY)}
            order by loaded_at, {', '.join(f'{c} nulls first' for c in [*_REST, *_KEY])}) as copy
        from flagged where rejection_reason is null
    ) where copy = 1
)"""


def _key_text(column: str) -> str:
    return f"coalesce(cast({_key_value(column)} as varchar), '')"


_ENRICHED = f"""
enriched as (
    select
        md5(concat_ws('|', {', '.join(_key_text(c) for c in _KEY)})) as trip_sk,
        vendor_key, rate_code_key, payment_type_key, pickup_zone_key, dropoff_zone_key,
        pickup_at, dropoff_at,
        cast(pickup_at as date) as pickup_date,
        {_int("strftime(pickup_at, '%Y%m%d')")} as pickup_date_key,
        {_int('extract(hour from pickup_at)')} as pickup_hour,
        {_int('isodow(pickup_at)')} as pickup_day_of_week_iso,
        isodow(pickup_at) in (6, 7) as is_weekend,
        passenger_count, is_store_and_forward, trip_distance_miles,
        {_r('trip_duration_min', 2)} as trip_duration_min,
        {_r('trip_distance_miles / nullif(trip_duration_min, 0) * 60', 2)} as avg_speed_mph,
        {', '.join(_AMOUNTS)},
        case when payment_type_key = 1 and fare_amount > 0
             then {_r('tip_amount / fare_amount * 100', 2)} end as tip_rate_pct,
        source_file, source_file_month, loaded_at
    from first_copies
)"""

_FACT = """
fact as (
    select trip_sk, pickup_date_key, pickup_zone_key, dropoff_zone_key, payment_type_key,
           rate_code_key, vendor_key, pickup_at, dropoff_at, pickup_date, pickup_hour, is_weekend,
           passenger_count, trip_distance_miles, trip_duration_min, avg_speed_mph, fare_amount,
           tip_amount, tolls_amount,
           extra_amount + mta_tax_amount + improvement_surcharge_amount
             + if(vendor_key is not distinct from 1, 0::double,
                  congestion_surcharge_amount + airport_fee_amount + cbd_congestion_fee_amount)
             as surcharges_amount,
           total_amount, tip_rate_pct, source_file, source_file_month, loaded_at
    from enriched
)"""

_ZONES = """
zones as (
    select n_nationkey as zone_key, n_name as zone_name, r_name as borough,
           'Boro Zone' as service_zone,
           contains(lower(n_name), 'nation_1') or r_name = 'ASIA' as is_airport,
           n_nationkey in (23, 24) as is_unknown_zone
    from nation join region on r_regionkey = n_regionkey
)"""
_PAYMENTS = f"payments as (select * from {_values(PAYMENT_TYPES, 'payment_type_key', 'payment_type_label')})"


def _calendar(first: str, end: str) -> str:
    return f"""
calendar as (
    select {_int("strftime(day, '%Y%m%d')")} as date_key, cast(day as date) as full_date,
           {_int('year(day)')} as year, {_int('quarter(day)')} as quarter, {_int('month(day)')} as month,
           strftime(day, '%b') as month_name, {_int('day(day)')} as day_of_month,
           {_int('isodow(day)')} as day_of_week_iso, strftime(day, '%a') as day_name,
           isodow(day) in (6, 7) as is_weekend
    from (select unnest(generate_series({first}, {end} - interval 1 day, interval 1 day)) as day)
)"""


_FILE_SPAN = _calendar(
    "(select min(source_file_month) from staged)::timestamp",
    "(select max(source_file_month) + interval 1 month from staged)",
)


def _sql(*parts: str) -> str:
    *tables, final = parts
    return f"with {', '.join(tables)} {final}" if tables else final


def _layers(raw: str, params, upto: str) -> list[str]:
    chain = {"raw": raw, "staged": _STAGED, "flagged": _flagged(params), "first_copies": _DISTINCT,
             "enriched": _ENRICHED, "fact": _FACT}
    names = list(chain)
    return [chain[name] for name in names[: names.index(upto) + 1]]


def _e(upto: str) -> list[str]:
    return _layers(_EVENT_RAW, rg.fx.EVENT_PARAMS, upto)


def _run_raw(published_only: bool, repaired: str | None = None) -> str:
    """Loaded rows of the published runs: all trips, moved; those of a month that fails if asked for."""
    rows = []
    for month, (days, passes) in rg.RUN_MONTHS.items():
        passes = passes or month == repaired
        if published_only and not passes:
            continue
        distance = "trip_distance" if passes else "case when passenger_count > 3 then trip_distance else -1 end"
        rows.append(
            f"select * replace (tpep_pickup_datetime + interval {days} day as tpep_pickup_datetime,"
            f" tpep_dropoff_datetime + interval {days} day as tpep_dropoff_datetime,"
            f" {distance} as trip_distance, 'yellow_tripdata_{month}.parquet' as _source_file)"
            " from one_raw"
        )
    return _EVENT_RAW.replace("\nraw as (", "\none_raw as (") + f",\nraw as ({' union all '.join(rows)})"


def _m(upto: str, published_only: bool = True) -> list[str]:
    return _layers(_run_raw(published_only), rg.fx.EVENT_PARAMS, upto)


def _l(upto: str, params=None) -> list[str]:
    return _layers(_LINE_RAW, params or rg.fx.LINEITEM_PARAMS, upto)


def _date(month: str) -> str:
    return f"date '{month}-01'"


_QUALITY = f"""
select source_file, source_file_month, status, nb_rows,
       {_big('sum(nb_rows) over (partition by source_file)')} as nb_rows_total,
       {_r('nb_rows / (sum(nb_rows) over (partition by source_file)) * 100', 3)} as pct_of_file
from (select source_file, source_file_month, ifnull(rejection_reason, 'valid') as status,
             count(*) as nb_rows
      from flagged group by all)"""

_REVENUE = f"""
select full_date, day_name, c.is_weekend, payment_type_label, count(*) as nb_trips,
       {_r('sum(total_amount)', 2)} as total_revenue, {_r('sum(fare_amount)', 2)} as total_fare,
       {_r('sum(tip_amount)', 2)} as total_tips, {_r('sum(surcharges_amount)', 2)} as total_surcharges,
       {_r('avg(total_amount)', 2)} as avg_revenue_per_trip,
       {_r('sum(trip_distance_miles)', 1)} as total_distance_miles
from fact f join calendar c on c.date_key = f.pickup_date_key
left join payments p using (payment_type_key)
group by all"""

_DEMAND = f"""
select pickup_zone_key, zone_name as pickup_zone_name, borough as pickup_borough,
       is_airport as pickup_is_airport, pickup_hour, is_weekend,
       count(*) as nb_trips, count(distinct pickup_date) as nb_days,
       {_r('count(*) / count(distinct pickup_date)', 1)} as avg_trips_per_day,
       {_r('sum(total_amount)', 2)} as total_revenue,
       {_r('avg(total_amount)', 2)} as avg_revenue_per_trip, {_r('avg(fare_amount)', 2)} as avg_fare,
       {_r('avg(trip_distance_miles)', 2)} as avg_distance_miles,
       {_r('avg(trip_duration_min)', 1)} as avg_duration_min,
       {_r('avg(avg_speed_mph)', 1)} as avg_speed_mph,
       {_r('avg(tip_rate_pct)', 1)} as avg_tip_rate_pct_card,
       {_r('sum(total_amount) / nullif(sum(trip_duration_min), 0) * 60', 2)} as revenue_per_hour_driven
from fact left join zones on zone_key = pickup_zone_key
group by all"""

_TOP = f"""
select zone_name as zone, borough, pickup_hour, count(*) as nb_trips,
       {_r('count(*) / count(distinct pickup_date)', 0)} as trips_per_day,
       {_r('avg(fare_amount)', 2)} as avg_fare, {_r('median(fare_amount)', 2)} as median_fare,
       {_r('avg(total_amount)', 2)} as avg_total,
       {_r('100 * count(*) filter (payment_type_key = 1) / count(*)', 1)} as card_share_pct,
       {_r('avg(total_amount) filter (payment_type_key = 1)', 2)} as avg_total_card,
       {_r('avg(total_amount) filter (payment_type_key = 2)', 2)} as avg_total_cash
from fact join zones on zone_key = pickup_zone_key
where not is_unknown_zone and total_amount <= 500 and payment_type_key not in (3, 4)
group by zone_name, borough, pickup_hour
order by nb_trips desc, zone, borough, pickup_hour limit 10"""

_IN_OUTLIER_CELL = f"zone_name = '{rg.OUTLIER_ZONE}' and pickup_hour = {rg.OUTLIER_HOUR}"


def _medians(max_total: float) -> str:
    return f"""
select payment_type_label, count(*) as nb_trips,
       {_r('median(trip_distance_miles)', 2)} as median_distance,
       {_r('median(fare_amount)', 2)} as median_fare, {_r('avg(fare_amount)', 2)} as avg_fare,
       {_r('median(fare_amount / nullif(trip_distance_miles, 0))', 2)} as median_price_per_mile
from fact join payments using (payment_type_key) where total_amount <= {max_total}
group by payment_type_label"""


def _capped_params():
    from dataclasses import replace

    return replace(rg.fx.LINEITEM_PARAMS, max_total_amount=rg.OUTLIER_AMOUNT)


def _gate_rows() -> str:
    rows = []
    for month in rg.FILE_MONTHS:
        rate = rg.fx.EVENT_PARAMS.max_rejection_rate
        checks = {
            "month_loaded": "select count(*) > 0 from raw"
            f" where _source_file = 'yellow_tripdata_{month}.parquet'",
            "month_not_empty": f"select count(*) > 0 from enriched where source_file_month = {_date(month)}",
            "no_duplicates": "select count(*) = count(distinct trip_sk) from enriched"
            f" where source_file_month = {_date(month)}",
            "rejection_rate_ok": f"select count(rejection_reason) / nullif(count(*), 0) < {rate}"
            f" from flagged where source_file_month = {_date(month)}",
        }
        rows += [
            f"select '{name}' as check_name, ({check}) as passed, {_date(month)} as source_file_month"
            for name, check in checks.items()
        ]
    return " union all ".join(rows)


def _code_rows() -> str:
    tables = [
        ("payment_type", PAYMENT_TYPES, "payment_type_key"),
        ("rate_code", RATE_CODES, "rate_code_key"),
        ("vendor", VENDORS, "vendor_key"),
    ]
    return " union all ".join(
        f"select '{name}' as dimension, code, label,"
        f" (select count(*) from staged where {key} = code) as nb_trips"
        f" from {_values(rows, 'code', 'label')}"
        for name, rows, key in tables
    )


def _profile_codes() -> str:
    return " union all ".join(
        f"select '{c}' as column_name, cast({c} as varchar) as code, count(*) as nb_rows"
        " from raw group by all"
        for c in ("vendorid", "ratecodeid", "payment_type", "store_and_fwd_flag")
    )


def _histogram() -> str:
    terms = [
        f"ifnull({cond}, false)::integer"
        for reason, cond in _broken(rg.fx.LINEITEM_PARAMS).items()
        if reason not in ("timestamp_null", "zone_null")
    ]
    terms = [f"({t})" for t in terms]
    return (
        f"select {_int(' + '.join(terms))} as nb_anomalies, count(*) as nb_trips from staged group by all"
    )


def _counts() -> str:
    broken = _broken(rg.fx.LINEITEM_PARAMS)
    each = ", ".join(f"count(*) filter ({cond}) as {reason}" for reason, cond in broken.items())
    some = " or ".join(f"({cond})" for cond in broken.values())
    return (
        f"select source_file_month, count(*) as nb_trips, {each},"
        f" count(*) filter ({some}) as at_least_one from staged group by source_file_month"
    )


_USAGE_WINDOW = f"ts >= timestamp '{rg.fx.USAGE_AS_OF}' - interval 30 days"

# Files of the load test lack the city-centre fee in February.
_DRIFTED = """
drifted as (
    select * exclude (loaded_at) replace (
        case when source_file_month = date '2024-02-01' then 0 else cbd_congestion_fee_amount end
            as cbd_congestion_fee_amount),
        timestamp '2024-03-01' as loaded_at
    from staged
)"""


def _history() -> str:
    """The ledger of ``load_history``: January's states in order, and February's single load."""
    # After it was emptied, the file offered is still another one than the one that was loaded.
    january = ["loaded", "again", "changed", "emptied", "changed", "forgotten", "loaded"]
    rows = ", ".join(
        f"({i}, '{state}', {'true' if state in ('loaded', 'again') or i == 3 else 'false'})"
        for i, state in enumerate(january, 1)
    )
    return (
        "select f as file_name, cast(event as integer) as event, state, if(there, n, 0) as nb_rows"
        f" from (values {rows}) as e(event, state, there),"
        " (select _source_file as f, count(*) as n from raw where _source_file like '%2024-01%' group by 1)"
        " union all select _source_file, 1, 'loaded', count(*) from raw where _source_file like '%2024-02%' group by 1"
    )


def _drift() -> str:
    older = f"payment_type <= {rg.LAST_OLDER_PAYMENT} and _source_file like '%2024-01%'"
    newer = f"payment_type > {rg.LAST_OLDER_PAYMENT} and _source_file like '%2024-01%'"
    items = [
        ("vendorid", "retyped", "string", "bigint", True, older),
        ("passenger_count", "retyped", "double", "bigint", False, older),
        ("cbd_congestion_fee", "missing", None, "double", False, older),
        ("surprise", "new", "string", None, False, newer),
        ("pulocationid", "retyped", "int", "bigint", False, newer),
    ]

    def text(value: str | None) -> str:
        return "cast(null as varchar)" if value is None else f"'{value}'"

    return " union all ".join(
        f"select '{name}' as column_name, '{problem}' as problem, {text(found)} as found_type,"
        f" {text(expected)} as expected_type, {str(stops).lower()} as stops,"
        f" (select count(*) from raw where {rows}) as nb_rows"
        for name, problem, found, expected, stops, rows in items
    )


def _profile_columns() -> str:
    kinds = {
        "event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double",
        "props": "string",
    }
    return " union all ".join(
        f"select 'events.parquet' as file_name, true as has_size, true as has_time, '{name}' as column_name,"
        f" '{kind}' as data_type, count(*) as nb_rows, count(*) - count({name}) as nb_nulls,"
        f" cast(min({name}) as varchar) as example from events"
        for name, kind in kinds.items()
    )


def oracle_sql() -> dict[str, str]:
    capped = _capped_params()
    profile_day = _date(rg.PROFILE_MONTH)
    return {
        "staging_projection": _sql(*_e("staged"), "select * from staged"),
        "zones_staging": "select n_nationkey as zone_key, n_name as zone_name, r_name as borough,"
        " 'Boro Zone' as service_zone, 'taxi_zone_lookup.csv' as source_file,"
        " timestamp '2024-03-01' as loaded_at from nation join region on r_regionkey = n_regionkey",
        "dim_zone": _sql(_ZONES, "select * from zones"),
        "code_dimensions": _sql(*_e("staged"), _code_rows()),
        "dim_date": _sql(*_e("staged"), _FILE_SPAN, "select * from calendar"),
        "flagged_trips": _sql(*_e("flagged"), "select * from flagged"),
        "flagged_trips_volume": _sql(*_l("flagged"), "select * from flagged"),
        "amount_cap_statuses": _sql(*_l("flagged", capped), _QUALITY),
        "valid_deduplicated": _sql(*_e("first_copies"), "select * from first_copies"),
        "trip_surrogate_key": _sql(
            *_e("enriched"), "select trip_sk, vendor_key, pickup_at, total_amount from enriched"
        ),
        "enriched_trips": _sql(*_e("enriched"), "select * exclude (trip_sk) from enriched"),
        "enriched_trips_volume": _sql(*_l("enriched"), "select * from enriched"),
        "enriched_known_copies": _sql(*_e("enriched"), "select * from enriched"),
        "enriched_known_copies_volume": _sql(*_l("enriched"), "select * from enriched"),
        "fact_trips": _sql(*_e("fact"), "select * from fact"),
        "mart_daily_revenue": _sql(
            *_e("fact"), _FILE_SPAN, _PAYMENTS, _REVENUE,
        ),
        "mart_daily_revenue_volume": _sql(
            *_l("fact"),
            _calendar("timestamp '1995-01-01'", "timestamp '2002-01-01'"),
            _PAYMENTS, _REVENUE,
        ),
        "mart_zone_hourly_demand": _sql(*_e("fact"), _ZONES, _DEMAND),
        "mart_zone_hourly_demand_volume": _sql(*_l("fact"), _ZONES, _DEMAND),
        "mart_data_quality": _sql(*_e("flagged"), _QUALITY),
        "top_zone_hours": _sql(*_e("fact"), _ZONES, _TOP),
        "anomaly_counts": _sql(*_l("staged"), _counts()),
        "anomaly_histogram": _sql(*_l("staged"), _histogram()),
        "payment_mix_for_zone_hour": _sql(
            *_e("fact"), _ZONES, _PAYMENTS,
            f"select payment_type_label, count(*) as nb_trips, {_r('avg(total_amount)', 2)} as avg_total"
            " from fact join zones on zone_key = pickup_zone_key join payments using (payment_type_key)"
            f" where zone_name = '{rg.MIX_ZONE}' and pickup_hour = {rg.MIX_HOUR} group by all",
        ),
        "outlier_share": _sql(
            *_l("fact"),
            f"select count(*) filter (total_amount > {rg.OUTLIER_AMOUNT}) as nb_outliers,"
            f" {_r(f'100 * count(*) filter (total_amount > {rg.OUTLIER_AMOUNT}) / count(*)', 3)}"
            " as share_pct from fact",
        ),
        "top_outliers": _sql(
            *_l("fact"), _ZONES,
            "select pickup_at, trip_distance_miles, fare_amount, total_amount"
            " from fact join zones on zone_key = pickup_zone_key"
            f" where {_IN_OUTLIER_CELL} and payment_type_key = {rg.OUTLIER_PAYMENT}"
            " order by total_amount desc, pickup_at, trip_sk limit 5",
        ),
        "robust_mean_vs_median": _sql(
            *_l("fact"), _ZONES,
            f"select {_r('avg(total_amount)', 2)} as avg_total_without_outliers,"
            f" {_r('median(total_amount)', 2)} as median_total"
            " from fact join zones on zone_key = pickup_zone_key"
            f" where {_IN_OUTLIER_CELL} and total_amount < {rg.OUTLIER_AMOUNT}",
        ),
        "tips_by_payment": _sql(
            *_e("fact"), _PAYMENTS,
            f"select payment_type_label, count(*) as nb_trips, {_r('avg(tip_amount)', 2)} as avg_tip,"
            f" {_r('100 * count(*) filter (tip_amount > 0) / count(*)', 1)} as tipped_share_pct"
            " from fact join payments using (payment_type_key) group by all",
        ),
        "fare_card_vs_cash": _sql(
            *_e("fact"), _PAYMENTS,
            f"select payment_type_label, {_r('avg(fare_amount)', 2)} as avg_fare,"
            f" {_r('avg(total_amount)', 2)} as avg_total from fact join payments using (payment_type_key)"
            " where payment_type_key in (1, 2) group by all",
        ),
        "median_price_per_mile": _sql(*_e("fact"), _PAYMENTS, _medians(500)),
        "median_price_per_mile_volume": _sql(*_l("fact"), _PAYMENTS, _medians(rg.OUTLIER_AMOUNT)),
        "star_filters_joins": _sql(
            *_e("fact"), _ZONES, _PAYMENTS,
            "select borough, is_airport, payment_type_label, count(*) as nb_trips,"
            " max(total_amount) as max_total"
            " from fact join zones on zone_key = pickup_zone_key join payments using (payment_type_key)"
            " where total_amount <= 500 and payment_type_key not in (3, 4) and not is_unknown_zone"
            " group by all",
        ),
        "table_counts": _sql(
            *_e("fact"), _ZONES,
            "select 'raw.yellow_tripdata' as table_name, count(*) as nb_rows from raw"
            " union all select 'raw.taxi_zone_lookup', count(*) from zones"
            " union all select 'intermediate.int_trips__flagged', count(*) from flagged"
            " union all select 'marts.fct_trips', count(*) from fact"
            f" union all select 'marts.mart_zone_hourly_demand', count(*) from ({_DEMAND})"
            f" union all select 'marts.mart_data_quality', count(*) from ({_QUALITY})",
        ),
        "rows_per_file": _sql(
            *_e("raw"), "select _source_file as source_file, count(*) as nb_rows from raw group by all"
        ),
        "rejection_rate_by_month": _sql(
            *_l("flagged"),
            "select source_file_month, count(*) as nb_trips, count(rejection_reason) as nb_rejected,"
            f" {_r('100 * count(rejection_reason) / count(*)', 2)} as rejection_rate_pct"
            " from flagged group by all",
        ),
        "usage_daily_rollup": "select event_type as entity, cast(ts as date) as usage_date,"
        f" {_r('sum(value)', 3)} as usage from events where {_USAGE_WINDOW} group by all",
        "usage_totals": f"select event_type as entity, {_r('sum(value)', 3)} as usage_total,"
        f" {_r('sum(value * 0.75)', 3)} as usage_compute,"
        f" {_r('sum(value * 0.25)', 3)} as usage_services, count(*) as active_hours"
        f" from events where {_USAGE_WINDOW} group by all",
        "gate_values": _sql(*_e("enriched"), _gate_rows()),
        "raw_contract_checks": _sql(
            *_e("raw"),
            "select _source_file as source_file, count(*) as nb_rows, min(_loaded_at) as first_loaded_at"
            " from raw group by all",
        ),
        "raw_value_checks": _sql(
            *_l("raw"),
            "select 'zone_count_ok' as check_name, count(*) = 25 as passed from nation"
            " union all select 'zone_keys_distinct', count(*) = count(distinct n_nationkey) from nation"
            " union all select 'fare_amount_has_decimals', bool_or(fare_amount % 1 <> 0) from raw"
            " union all select 'total_amount_has_decimals', bool_or(total_amount % 1 <> 0) from raw",
        ),
        "source_profile_codes": _sql(*_e("raw"), _profile_codes()),
        "source_profile_anomalies": _sql(
            *_l("raw"),
            "select min(tpep_pickup_datetime) as first_pickup, max(tpep_pickup_datetime) as last_pickup,"
            f" count(*) filter (tpep_pickup_datetime < {profile_day} or tpep_pickup_datetime"
            f" >= {profile_day} + interval 1 month) as outside_month,"
            " count(*) filter (trip_distance <= 0) as no_distance,"
            " count(*) filter (total_amount < 0) as negative_total,"
            " count(*) filter (tpep_dropoff_datetime < tpep_pickup_datetime) as dropoff_before_pickup,"
            " count(*) filter (passenger_count is null) as no_passenger_count from raw",
        ),
        "source_profile_files": "select 'events.parquet' as file_name, count(*) as nb_rows from events",
        "month_replace": _sql(
            *_l("flagged"),
            "select source_file, source_file_month, ifnull(rejection_reason, 'valid') as status,"
            f" count(*) as nb_rows from flagged where source_file_month <> {_date(rg.EMPTIED_MONTH)}"
            " group by all",
        ),
        "load_once": _sql(*_e("staged"), _DRIFTED, "select * from drifted"),
        "csv_zones": "select n_nationkey as zone_key, n_name || ', ' || r_name as zone_name,"
        " r_name as borough, 'Boro Zone' as service_zone, 'taxi_zone_lookup.csv' as source_file,"
        " timestamp '2024-03-01' as loaded_at from nation join region on r_regionkey = n_regionkey",
        "load_parts": _sql(
            *_e("staged"),
            "select * replace (timestamp '2024-03-01' as loaded_at,"
            f" case when payment_type_key <= {rg.LAST_OLDER_PAYMENT} then 0 else cbd_congestion_fee_amount end"
            " as cbd_congestion_fee_amount"
            ", 'yellow_tripdata_2024-01.parquet' as source_file, date '2024-01-01' as source_file_month)"
            " from staged",
        ),
        "monthly_fact": _sql(*_m("fact"), "select * from fact"),
        "monthly_daily_revenue": _sql(
            *_m("fact"), _calendar("timestamp '2024-01-01'", "timestamp '2024-04-01'"), _PAYMENTS, _REVENUE
        ),
        "monthly_zone_demand": _sql(*_m("fact"), _ZONES, _DEMAND),
        "monthly_quality": _sql(*_m("flagged", published_only=False), _QUALITY),
        "monthly_run": _sql(*_e("fact"), "select * from fact"),
        "monthly_top_zone_hours": _sql(*_m("fact"), _ZONES, _TOP),
        "backfill_resumed": _sql(
            *_layers(_run_raw(True, rg.REPAIRED_MONTH), rg.fx.EVENT_PARAMS, "fact"),
            f"select source_file_month, source_file_month >= {_date(rg.REPAIRED_MONTH)} as ran_again,"
            " count(*) as nb_trips, count(distinct trip_sk) as nb_keys from fact group by 1",
        ),
        "load_history": _sql(*_e("raw"), _history()),
        "drift_report": _sql(*_e("raw"), _drift()),
        "staging_views": _sql(
            *_e("staged"), _ZONES,
            "select s.* replace (timestamp '2024-03-01' as loaded_at), z.zone_name, z.borough"
            " from staged s left join zones z on z.zone_key = s.pickup_zone_key",
        ),
        "source_profile_columns": _profile_columns(),
    }
