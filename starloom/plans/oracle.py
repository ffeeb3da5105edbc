"""The registered queries as plain SQL over the same tables."""

from __future__ import annotations


_DATE_COLUMNS = """
    cast(year(d) * 10000 + month(d) * 100 + day(d) as integer) as date_key,
    d as full_date,
    strftime(d, '%Y/%m/%d') as date_name,
    strftime(d, '%m/%d/%Y') as date_name_us,
    strftime(d, '%d/%m/%Y') as date_name_eu,
    cast(dayofweek(d) + 1 as tinyint) as day_of_week,
    dayname(d) as day_name_of_week,
    cast(day(d) as tinyint) as day_of_month,
    cast(dayofyear(d) as smallint) as day_of_year,
    case when dayofweek(d) in (0, 6) then 'Weekend' else 'Weekday' end as weekday_weekend,
    cast(weekofyear(d) as tinyint) as week_of_year,
    monthname(d) as month_name,
    cast(month(d) as tinyint) as month_of_year,
    case when d = last_day(d) then 'Y' else 'N' end as is_last_day_of_month,
    cast(quarter(d) as tinyint) as calendar_quarter,
    cast(year(d) as smallint) as calendar_year,
    strftime(d, '%Y-%m') as calendar_year_month,
    year(d) || 'Q' || quarter(d) as calendar_year_qtr,
    cast(month(f) as tinyint) as fiscal_month_of_year,
    cast(quarter(f) as tinyint) as fiscal_quarter,
    cast(year(f) as integer) as fiscal_year,
    strftime(f, '%Y-%m') as fiscal_year_month,
    year(f) || 'Q' || quarter(f) as fiscal_year_qtr
"""


def _dates(offset: int = 6) -> str:
    return f"""
    span as (
        select min(cast(o_orderdate as date)) as b, max(cast(o_orderdate as date)) as e
        from orders
    ),
    listed as (
        select cast(unnest(generate_series(b, e, interval 1 day)) as date) as d from span
    ),
    shifted as (select d, cast(d + interval ({offset}) month as date) as f from listed),
    dates as (select {_DATE_COLUMNS} from shifted)
    """


_JOINED = """
    joined as (
        select row_number() over (order by o_orderkey) as fact_purchase_order_key,
               o_orderkey, o_custkey as custkey, o_orderstatus, o_totalprice,
               cast(o_orderdate as date) as o_orderdate, o_orderpriority,
               c_name, c_nationkey, c_acctbal, c_mktsegment
        from orders join customer on o_custkey = c_custkey
    ),
    ranked as (
        select *, row_number() over (
            partition by custkey order by fact_purchase_order_key
        ) as place
        from joined
    )
"""

_EVENTS = """
    touched as (
        select *, epoch_us(ts) as event_timestamp,
               epoch_us(min(ts) over (partition by user_id)) as first_touch
        from events
    ),
    bronze as (
        select case when value < 10 then 'mobile' else 'desktop' end as device,
               '{"order":' || event_id || '}' as ecommerce,
               event_type as event_name,
               case when first_touch < event_timestamp then first_touch end
                   as event_previous_timestamp,
               event_timestamp,
               '{"city":"city ' || user_id || '"}' as geo,
               '[{"item":' || event_id || '}]' as items,
               props as traffic_source,
               first_touch as user_first_touch_timestamp,
               cast(user_id as varchar) as user_id
        from touched
    ),
    silver as (
        select *, true as has_receipt_time, true as has_source_file
        from bronze where event_previous_timestamp > 0
    )
"""

_ORDERS = """
    select o_orderkey, o_custkey as custkey, o_orderstatus, o_totalprice,
           cast(o_orderdate as date) as o_orderdate, o_orderpriority
    from orders
"""

_USERS = "select c_custkey as custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer"

_DOCUMENTS_AS_TEXT = """
    select coalesce(cast(doc_id as varchar), '') as doc_id, coalesce(text, '') as text,
           coalesce(lang, '') as lang, coalesce(source, '') as source,
           coalesce(cast(n_chars as varchar), '') as n_chars
    from documents
"""

ORACLE_SQL: dict[str, str] = {
    "dim_date": f"with {_dates()} select * from dates",
    "dim_date_lagging_fiscal": f"with {_dates(-6)} select * from dates",
    "dim_date_empty_range": f"with {_dates()} select * from dates where false",
    "dim_date_extend": f"with {_dates()} select * from dates",
    "dim_date_first_20": f"with {_dates()} select * from dates order by date_key limit 20",
    "dim_users": f"""
        select row_number() over (order by custkey) as user_key, * from ({_USERS})
    """,
    "dim_users_grown": f"""
        with first as (
            select row_number() over (order by custkey) as user_key, *
            from ({_USERS}) where c_acctbal < 0
        )
        select * from first
        union all
        select (select count(*) from first) + row_number() over (order by custkey), *
        from ({_USERS}) where not coalesce(c_acctbal < 0, false)
    """,
    "dim_products": """
        select row_number() over (order by p_partkey) as product_key,
               p_partkey, p_name, p_brand, p_size, p_retailprice
        from part
    """,
    "fact_orders_joined": f"""
        with {_JOINED}
        select fact_purchase_order_key + 20100100 as date_key, * from joined
    """,
    "fact_orders": f"""
        with {_JOINED}
        select fact_purchase_order_key + 20100100 as date_key, * exclude (place)
        from ranked where place = 1
    """,
    "fact_orders_calendar_key": f"""
        with {_dates()}, {_JOINED}
        select r.* exclude (place), d.*
        from ranked r join dates d on o_orderdate = full_date
        where place = 1
    """,
    "merge_null_safe": """
        with o as (
            select * exclude (o_custkey) replace (cast(o_orderdate as date) as o_orderdate),
                   case when o_orderpriority <> '1-URGENT' then o_custkey end as custkey
            from orders
        ),
        u as (
            select * exclude (c_custkey), nullif(c_custkey, 1) as other from customer
        )
        select * exclude (other) from o join u on custkey is not distinct from other
    """,
    "merge_suffixes": """
        select o_orderkey, o_custkey as custkey, o_orderstatus, o_totalprice,
               cast(o_orderdate as date) as o_orderdate, o_orderpriority as label_x,
               c_name, c_nationkey, c_acctbal, c_mktsegment as label_y
        from orders join customer on o_custkey = c_custkey
    """,
    "key_violation_report": """
        select o_custkey as custkey, count(*) as row_count
        from orders group by 1 having o_custkey is null or count(*) > 1
    """,
    "numbered_events": """
        select *, row_number() over (order by event_type, event_id) as event_key from events
    """,
    "first_event_per_user": """
        select * from events
        qualify row_number() over (partition by user_id order by ts, event_id) = 1
    """,
    "reshaped_orders": """
        select cast(year(o_orderdate) as integer) as order_year,
               cast(o_orderdate as date) as o_orderdate,
               o_orderkey, o_custkey as custkey, o_totalprice
        from orders
    """,
    "coerced_prices": """
        select * replace (case when p_size >= 10 then p_size end as p_size) from part
    """,
    "order_preview": f"{_ORDERS} order by o_orderkey limit 5",
    "ingest_summary": """
        select count(*) as record_count,
               (select cast(count(*) as integer) from (describe lineitem)) as column_count
        from lineitem
    """,
    "csv_text": _DOCUMENTS_AS_TEXT,
    "csv_typed": _ORDERS,
    "csv_multiline": "select * from documents",
    "csv_ragged": f"""
        select doc_id, text, lang,
               case when cast(doc_id as bigint) % 3 <> 1 then source end as source,
               case when cast(doc_id as bigint) % 3 <> 1 then n_chars end as n_chars,
               case when cast(doc_id as bigint) % 3 = 2 then 'x,"y"|' || doc_id end as rest
        from ({_DOCUMENTS_AS_TEXT})
    """,
    "csv_inferred": """
        select * replace (case when p_size >= 10 then cast(p_size as double) end as p_size)
        from part
    """,
    "csv_as_json": _DOCUMENTS_AS_TEXT,
    "json_lines": f"""
        select * replace (cast(o_orderdate as varchar) as o_orderdate) from ({_ORDERS})
    """,
    "json_array": "select doc_id, text, lang, source, n_chars from documents",
    "json_array_split": "select doc_id, text, lang, source, n_chars from documents",
    "json_split": "select * from part",
    "json_split_indexed": f"""
        select row_number() over (order by o_orderdate, o_orderkey) - 1 as place, *
        from ({_ORDERS})
    """,
    "json_split_nested": """
        select *, p_brand as detail_brand, p_size as detail_size,
               p_type as first_word, p_name as second_word
        from part
    """,
    "converted_orders": _ORDERS,
    "converted_events": f"""
        with {_EVENTS}
        select device, event_id as order_id, event_name, event_previous_timestamp,
               event_timestamp, 'city ' || user_id as city, event_id as item, 1 as item_count,
               traffic_source, user_first_touch_timestamp, user_id
        from (
            select bronze.*, cast(json_extract(ecommerce, '$.order') as bigint) as event_id
            from bronze
        )
    """,
    "replaced_documents": "select * from part",
    "appended_documents": f"""
        select *, c_name as _id from ({_USERS})
        union all
        select *, c_name as _id from ({_USERS})
    """,
    "appended_once": f"""
        select *, case when coalesce(c_acctbal < 0, false) then 'first' else 'second' end
                      as load_token, 'table' as kept_in
        from ({_USERS})
        union all
        select *, '-', 'store' from ({_USERS})
    """,
    "matching_documents": f"select * from ({_USERS}) where c_mktsegment = 'BUILDING'",
    "updated_table": _USERS,
    "foreign_table": "select * from lineitem",
    "events_bronze": f"with {_EVENTS} select * from bronze",
    "events_silver": f"with {_EVENTS} select * from silver",
    "events_gold": f"""
        with {_EVENTS}
        select event_name, count(event_name) as customer_count from silver group by 1
    """,
    "events_quarantine": f"""
        with {_EVENTS}
        select *, null::varchar as text from bronze
        union all by name
        select '{{"device": "none", "event_name": "' || event_id as text
        from events where event_id % 10 = 0
    """,
    "cleaned_up": f"""
        with {_EVENTS}
        select count(event_name) as counted, 4::int as views, 2::int as tables,
               0::int as views_left, 0::int as databases_left, 0::int as running
        from silver
    """,
    "gold_null_group": """
        select nullif(event_type, 'error') as event_name,
               count(nullif(event_type, 'error')) as customer_count
        from events group by 1
    """,
    "stream_static_join": f"""
        with {_EVENTS}
        select bronze.*, c_name, c_nationkey, c_acctbal, c_mktsegment
        from bronze join customer on user_id = cast(c_custkey as varchar)
    """,
}
