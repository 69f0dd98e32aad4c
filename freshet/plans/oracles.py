"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

from freshet.plans.catalog import CHUNK, COPY_STEP, STAMP
from freshet.plans.feeds import FEEDS, Feed
from freshet.registry import registry


def field_sql(feed: Feed) -> dict[str, str]:
    """Text of each mapped payload field."""
    out = {}
    for name, sql in feed.fields.items():
        sql = sql.format(text="varchar")
        if name in feed.timestamps:
            out[name] = f"strftime({sql}, '%Y-%m-%d %H:%M:%S')"
        else:
            out[name] = f"cast({sql} as varchar)"
    return out


def event_id_sql(feed: Feed) -> str:
    identity = ", ".join(f"cast({c} as varchar)" for c in feed.identity)
    return f"md5(concat_ws('|', '{feed.spec.topic}', {identity}))"


def ingested_sql(feed: Feed) -> str:
    return f"'2024-01-0' || cast(1 + {feed.number} % 7 as varchar) || 'T00:00:00+00:00'"


def bronze_sql(name: str, raw: bool = False) -> str:
    feed = FEEDS[name]
    mapped = field_sql(feed)
    fields = [f"{mapped.get(f, 'cast(null as varchar)')} as {f}" for f in feed.spec.fields]
    event_id = event_id_sql(feed)
    offset = (
        f"{feed.number} // 3" if feed.dense else f"cast('0x' || left({event_id}, 15) as bigint)"
    )
    columns = [
        f"'{feed.spec.topic}' as _kafka_topic",
        f"cast({feed.number} % 3 as integer) as _kafka_partition",
        f"cast({offset} as bigint) as _kafka_offset",
        f"epoch_us(timestamp '2024-01-01') + ({feed.number} % 7) * 86400000000"
        f" + ({feed.number} % 60) * 1000000 as _kafka_timestamp_us",
        *fields,
        f"'{feed.spec.topic}' as _topic",
        f"{ingested_sql(feed)} as _ingested_at",
        f"{event_id} as _event_id",
        f"left({ingested_sql(feed)}, 10) as _bronze_date",
    ]
    if raw:
        pairs = ", ".join(f"'{f}', {mapped[f]}" for f in feed.fields)
        columns.append(
            f"cast(json_object({pairs}, '_topic', '{feed.spec.topic}', '_ingested_at',"
            f" {ingested_sql(feed)}, '_event_id', {event_id}) as varchar) as _raw_value"
        )
    return f"select {', '.join(columns)} from {feed.source}"


def counts_by_day_sql(name: str) -> str:
    return (
        f"select _kafka_topic, _bronze_date, count(*) as rows from ({bronze_sql(name)})"
        " group by all"
    )


def envelope_sql() -> str:
    feed = FEEDS["events"]
    mapped = field_sql(feed)
    digest = (
        f"md5(cast(to_json(['{feed.spec.topic}', 'events.parquet', cast(event_id as varchar),"
        f" {', '.join(mapped.values())}]) as varchar))"
    )
    fields = ", ".join(f"{sql} as {f}" for f, sql in mapped.items())
    return f"""
        select {mapped['event_id']} as record_key, '{feed.spec.topic}' as topic, {fields},
               '{feed.spec.topic}' as _topic, '{STAMP}' as _ingested_at,
               concat_ws('-', left(digest, 8), substr(digest, 9, 4), '8' || substr(digest, 14, 3),
                         '8' || substr(digest, 18, 3), substr(digest, 21, 12)) as _event_id
        from (select *, {digest} as digest from events)"""


ORDER_FIELDS = field_sql(FEEDS["orders"])

COPIES = f"""
    select o.* replace (
        case when order_status = 'P' then 'shared' when copy = 2 then _event_id || '-again'
             else _event_id end as _event_id,
        _kafka_offset + copy * {COPY_STEP} as _kafka_offset)
    from ({bronze_sql('orders')}) o, range(3) c(copy)
    where copy <= cast(order_id as bigint) % 3"""

GAPPY = """
    select 'shop.order_items' as _kafka_topic, l_linenumber % 3 as _kafka_partition,
           l_orderkey as _kafka_offset
    from lineitem"""


def pipeline_sql() -> str:
    parts = []
    for spec in registry().values():
        feed = FEEDS[spec.table]
        key = field_sql(feed)[spec.key_field]
        parts.append(
            f"select '{spec.topic}' as _kafka_topic, count(*) as rows, count(*) as event_ids,"
            f" count(distinct {key}) as keys, cast(0 as bigint) as missing_offsets, count(*) as offsets"
            f" from {feed.source}"
        )
    return " union all ".join(parts)


def lag_sql() -> str:
    parts = (
        f"select '{feed.spec.topic}' as _kafka_topic, ({feed.number} % 60) * 1000000 as lag"
        f" from {feed.source}"
        for feed in FEEDS.values()
    )
    return f"""
        select _kafka_topic, count(*) as rows, count(lag) as timed, min(lag) as min_lag_us,
               avg(lag) as avg_lag_us, max(lag) as max_lag_us
        from ({' union all '.join(parts)}) group by _kafka_topic"""


QUARANTINE = """
    with forms as (
        select event_id as id, unnest(range(8)) as form, props, value from events
    ), texts as (
        select id, form, case form
            when 0 then props
            when 1 then left(props, length(props) - 1)
            when 2 then '[' || props || ']'
            when 3 then '{}'
            when 4 then 'null'
            when 5 then ''
            when 7 then '{"event_id": ' || cast(value as varchar) || '}' end as text
        from forms
        union all
        select doc_id, 8, text from documents
    )
    select 'shop.events' as _kafka_topic, cast(form as integer) as _kafka_partition,
           id as _kafka_offset, text as _raw_value
    from texts
    where not coalesce(case when json_valid(text) then json_type(text) = 'OBJECT' else false end,
                       false)"""

GAP_RANGES = f"""
    select _kafka_topic, _kafka_partition, before + 1 as first_missing,
           _kafka_offset - 1 as last_missing
    from (select *, lag(_kafka_offset) over (
              partition by _kafka_topic, _kafka_partition order by _kafka_offset) as before
          from ({GAPPY}))
    where _kafka_offset - before > 1"""

EVENT_FIELDS = ", ".join(f"{sql} as {name}" for name, sql in field_sql(FEEDS["events"]).items())

# All rows that stand on one side more often than on the other.
DIFFERENCES = f"""
    with rows as (
        select 'shop.events' as _kafka_topic, {ingested_sql(FEEDS["events"])} as stamp, {EVENT_FIELDS},
               event_id as number
        from events
    ), changed as (
        select * replace (case when number % 97 = 3 then value || '0' else value end as value)
        from rows where number % 101 <> 5
    ), landed as (
        select * from changed union all select * from changed where number % 103 = 9
    ), extra as (
        select *, 1 as side from (select * from rows except all select * from landed)
        union all
        select *, -1 from (select * from landed except all select * from rows)
    ), named as (
        select distinct * exclude (side) from extra
    )
    select _kafka_topic, left(stamp, 10) as _bronze_date, event_id, user_id, event_type, value, props,
           (select count(*) from rows r where r.number = n.number and r.value = n.value) as source_copies,
           (select count(*) from landed l where l.number = n.number and l.value = n.value) as bronze_copies
    from named n"""

DRIFT = """
    with values as (
        select 'shop.' || event_type as topic, case when event_type = 'error'
               then '{"k": "' || user_id || '", "event_id": "x", "seen": [' || user_id || ', 1]}'
               else props end as v
        from events
    ), fields as (
        select topic, unnest(json_keys(v)) as field, v from values
    )
    select topic, field, count(*) as rows,
           case max(json_type(v, '$.' || field)) when 'VARCHAR' then 'STRING' when 'ARRAY' then 'ARRAY<BIGINT>'
                else 'BIGINT' end as type
    from fields where field <> 'event_id' group by topic, field"""

ORACLES: dict[str, str] = {
    "batch_ledger": f"""
        select 'bronze_orders' as stream, _kafka_partition, cast(6 as bigint) as batches, count(*) as rows,
               cast(0 as bigint) as without_event_id, min(_kafka_offset) as first_offset,
               max(_kafka_offset) as last_offset
        from ({bronze_sql('orders')}) group by _kafka_partition""",
    "bronze_failed_batch": bronze_sql("orders"),
    "bronze_lost_checkpoint": bronze_sql("orders"),
    "offset_gaps_by_batch": GAP_RANGES,
    "bronze_since": f"""
        select * from ({bronze_sql('orders')})
        where _kafka_timestamp_us >= epoch_us(timestamp '2024-01-04')""",
    "find_events": f"""
        select _event_id, _kafka_partition, _kafka_offset, _bronze_date from ({bronze_sql('orders')})
        where cast(order_id as bigint) % 1499 = 7""",
    "waves_keep_order": """
        select o_orderstatus as key, count(*) as rows, cast(0 as bigint) as late, false as overloaded
        from orders group by o_orderstatus""",
    "paced_replay": "select cast(o_orderkey as varchar) as order_id, true as on_time from orders",
    "csv_mixed_row_ends": """
        select cast(doc_id as varchar) as doc_id, lang, source, text from documents""",
    "differing_content": DIFFERENCES,
    "drifting_fields": DRIFT,
    "lag_quantiles": f"""
        select _kafka_topic, unnest([0.1::double, 0.5, 0.9, 0.99]) as quantile, timed, true as near
        from ({lag_sql()})""",
    **{f"bronze_{name}": bronze_sql(name) for name in FEEDS},
    "bronze_events_raw": bronze_sql("events", raw=True),
    "bronze_orders_by_day": counts_by_day_sql("orders"),
    "bronze_orders_stream": bronze_sql("orders"),
    "bronze_orders_compact": bronze_sql("orders"),
    "bronze_resume": bronze_sql("orders"),
    "bronze_late_files": bronze_sql("orders"),
    "bronze_trigger": bronze_sql("orders"),
    "progress_totals": " union all ".join(
        f"select 'bronze_{spec.table}' as stream, count(*) as rows,"
        f" cast(0 as bigint) as without_event_id from {FEEDS[spec.table].source}"
        for spec in registry().values()
    ),
    "bronze_all_topics": " union all ".join(
        counts_by_day_sql(spec.table) for spec in registry().values()
    ),
    "bronze_day": f"select * from ({bronze_sql('events')}) where _bronze_date = '2024-01-03'",
    "event_envelope": envelope_sql(),
    "event_ids_per_file": """
        select 2 * count(*) as rows, 2 * count(*) as event_ids from customer""",
    "missing_inputs": """
        select distinct c_mktsegment as missing from customer where c_mktsegment >= 'H'""",
    "ingested_stamp": """
        select event_id, true as in_form, true as same_date, true as now from events""",
    "record_keys": """
        select cast(o_orderkey as varchar) as order_id, cast(o_orderkey as varchar) as key_present,
               coalesce(nullif(o_orderstatus, 'P'), cast(o_orderkey as varchar)) as key_nullable,
               cast(o_orderkey as varchar) as key_absent,
               cast(length(cast(o_orderkey as varchar)) as integer) as key_bytes
        from orders""",
    "key_partitions": """
        select cast(o_orderkey as varchar) as order_id,
               cast(xor(list_reduce(
                   flatten(list_transform(
                       string_split(cast(o_orderkey as varchar), ''),
                       lambda c: list_transform(range(8), lambda i: (ord(c) >> i) & 1))),
                   lambda crc, bit:
                       xor(crc >> 1, case when xor(crc, bit) & 1 = 1 then 3988292384 else 0 end),
                   4294967295), 4294967295) % 3 as integer) as partition
        from orders""",
    "replay_schedule": """
        select cast(o_orderkey as varchar) as order_id,
               epoch_us(timestamp '2024-01-15') + o_orderkey * 50000 as arrival_us
        from orders""",
    "csv_replay": f"""
        select {', '.join(f'{sql} as {f}' for f, sql in ORDER_FIELDS.items())},
               o_orderkey % {CHUNK} as row_in_file
        from orders""",
    "csv_quoted_text": """
        select cast(doc_id as varchar) as doc_id, lang, source, text from documents""",
    "log_offsets": """
        select 'shop.orders' as topic, cast(o_orderkey % 3 as integer) as partition,
               o_orderkey // 3 as "offset", cast(o_orderkey as varchar) as order_id
        from orders""",
    "replay_to_bronze": pipeline_sql(),
    "replayed_twice": " union all ".join(
        f"select '{FEEDS[name].spec.topic}' as _kafka_topic, '{what}' as what, {count} as count"
        f" from {FEEDS[name].source}"
        for name in ("order_payments", "customers")
        for what, count in (
            ("rows", "2 * count(*)"),
            ("duplicated ids", "count(*)"),
            ("events", "count(*)"),
        )
    ),
    "quarantine": QUARANTINE,
    "duplicate_events": f"""
        select _event_id, count(*) as copies from ({COPIES}) group by _event_id
        having count(*) > 1""",
    "dedup_events": f"""
        select * from ({COPIES})
        qualify row_number() over (
            partition by _event_id order by _kafka_topic, _kafka_partition, _kafka_offset) = 1""",
    "dedup_stream": f"select distinct _event_id from ({COPIES})",
    "dedup_stream_late": f"""
        select distinct _event_id, 'shop.orders' as _topic, true as placed from ({COPIES})""",
    "offset_gaps": f"""
        select _kafka_topic, _kafka_partition, min(_kafka_offset) as first_offset,
               max(_kafka_offset) as last_offset, count(distinct _kafka_offset) as offsets,
               max(_kafka_offset) - min(_kafka_offset) + 1 - count(distinct _kafka_offset)
                   as missing
        from ({GAPPY}) group by _kafka_topic, _kafka_partition""",
    "offset_gap_ranges": GAP_RANGES,
    "topic_mismatch": """
        select 'shop.click' as _kafka_topic, nullif('shop.' || event_type, 'shop.error') as _topic,
               count(*) as rows
        from events where event_type <> 'click' group by all""",
    "ingest_lag": lag_sql(),
    "reconcile": f"""
        with source as (
            select cast(ts as date) as d, count(*) as n from events group by d
        ), landed as (
            select cast(_bronze_date as date) as d, count(*) as n
            from ({bronze_sql('events')}) group by d
        )
        select 'shop.events' as _kafka_topic, cast(d as varchar) as _bronze_date,
               coalesce(source.n, 0) as source_rows, coalesce(landed.n, 0) as bronze_rows,
               coalesce(source.n, 0) - coalesce(landed.n, 0) as missing
        from source full join landed using (d)""",
}
