"""The registered queries as plain SQL on the same tables, to compare results."""

from __future__ import annotations

# Rows of `events` as the adapter shapes them.
RAW = """
raw as (
  select 'v' || e.user_id as video_id, strftime(e.ts, '%y.%d.%m') as trending_date,
    e.event_type as title, c.c_mktsegment as channel_title,
    cast(regexp_extract(e.props, '"k": *([0-9]+)', 1) as bigint) % 30 as category_id,
    strftime(e.ts, '%Y-%m-%dT%H:%M:%S') as publish_time,
    e.event_type || '|' || c.c_mktsegment as tags,
    case when e.user_id % 10 <> 0 then cast(round(e.value * 100) as bigint) end as views,
    cast(regexp_extract(e.props, '"k": *([0-9]+)', 1) as bigint) as likes,
    e.user_id % 7 as dislikes, e.event_id % 11 as comment_count,
    'img/' || e.event_id as thumbnail_link,
    e.event_id % 2 = 0 as comments_disabled, e.event_id % 3 = 0 as ratings_disabled,
    e.event_id % 5 = 0 as video_error_or_removed, c.c_name as description,
    ' ' || r.r_name || ' ' as region, e.ts as ingested_at, e.event_id as source_row
  from events e
  join customer c on e.user_id = c.c_custkey
  join nation n on c.c_nationkey = n.n_nationkey
  join region r on n.n_regionkey = r.r_regionkey
)"""

CANONICAL = (
    "video_id, trending_date, title, channel_title, category_id, publish_time, tags,"
    " views, likes, dislikes, comment_count, thumbnail_link, comments_disabled,"
    " ratings_disabled, video_error_or_removed, description, region"
)


def cleansed(source: str, day: str) -> str:
    return f"""
cleansed as (
  select *,
    case when views > 0 then round(likes / views * 100, 4) else 0.0::double end as like_ratio,
    case when views > 0 then round((likes + dislikes + comment_count) / views * 100, 4)
      else 0.0::double end as engagement_rate
  from (
    select * replace (lower(trim(region)) as region, coalesce(views, 0) as views,
        coalesce(likes, 0) as likes, coalesce(dislikes, 0) as dislikes,
        coalesce(comment_count, 0) as comment_count),
      {day} as trending_date_parsed
    from {source} where video_id is not null)
)"""


CLEANSED = cleansed("raw", "cast(try_strptime(trending_date, '%y.%d.%m') as date)")

SILVER = """
silver as (
  select * from cleansed
  qualify row_number() over (
    partition by video_id, region, trending_date_parsed
    order by ingested_at desc, source_row desc) = 1
)"""

FACTS = """
line_rows as (
  select 'p' || l.l_partkey as video_id, cast(l.l_shipdate as date) as day,
    p.p_brand as channel_title, cast(s.s_nationkey as bigint) as category_id,
    cast(round(l.l_extendedprice * 100) as bigint) as views,
    cast(l.l_quantity as bigint) as likes, cast(l.l_linenumber as bigint) as dislikes,
    cast(round(l.l_discount * 100) as bigint) as comment_count, r.r_name as region
  from lineitem l
  join orders o on l.l_orderkey = o.o_orderkey
  join customer c on o.o_custkey = c.c_custkey
  join nation n on c.c_nationkey = n.n_nationkey
  join region r on n.n_regionkey = r.r_regionkey
  join part p on l.l_partkey = p.p_partkey
  join supplier s on l.l_suppkey = s.s_suppkey
),""" + cleansed("line_rows", "day")

LOOKUP = """
lookup as (
  select n_nationkey::bigint as category_id, min(n_name) as category_name
  from nation group by 1
)"""


def named(source: str) -> str:
    return f"""
named as (
  select t.*, coalesce(k.category_name, 'Unknown') as category_name
  from {source} t left join lookup k on t.category_id = k.category_id
)"""


def mean(column: str) -> str:
    return (
        f"sum(cast(round({column} * 10000) as bigint))::double"
        f" / count({column})::double / 10000"
    )


TRENDING = f"""
  select region, trending_date_parsed, count(video_id) as total_videos,
    sum(views)::bigint as total_views, sum(likes)::bigint as total_likes,
    sum(dislikes)::bigint as total_dislikes, sum(comment_count)::bigint as total_comments,
    sum(views)::double / count(views) as avg_views_per_video,
    {mean("like_ratio")} as avg_like_ratio, {mean("engagement_rate")} as avg_engagement_rate,
    max(views) as max_views, count(distinct channel_title) as unique_channels,
    count(distinct category_id) as unique_categories
  from %s group by region, trending_date_parsed"""

CHANNEL = f"""
  select *, row_number() over (
      partition by region order by total_views desc, channel_title) as rank_in_region
  from (
    select channel_title, region, count(distinct video_id) as total_videos,
      sum(views)::bigint as total_views, sum(likes)::bigint as total_likes,
      sum(comment_count)::bigint as total_comments,
      sum(views)::double / count(views) as avg_views_per_video,
      {mean("engagement_rate")} as avg_engagement_rate, max(views) as peak_views,
      count(trending_date_parsed) as times_trending,
      min(trending_date_parsed) as first_trending, max(trending_date_parsed) as last_trending,
      string_agg(distinct category_name, '|' order by category_name) as categories
    from named group by channel_title, region)"""

CATEGORY = f"""
  select *, round(total_views
      / nullif(sum(total_views) over (partition by region, trending_date_parsed), 0)
      * 100, 2) as view_share_pct
  from (
    select category_name, category_id, region, trending_date_parsed,
      count(video_id) as video_count, sum(views)::bigint as total_views,
      sum(likes)::bigint as total_likes, sum(comment_count)::bigint as total_comments,
      {mean("engagement_rate")} as avg_engagement_rate,
      count(distinct channel_title) as unique_channels
    from named group by category_name, category_id, region, trending_date_parsed)"""


def with_(*parts: str) -> str:
    return "with " + ",".join(parts)


TO_RAW = with_(RAW)
TO_CLEANSED = with_(RAW, CLEANSED)
TO_SILVER = with_(RAW, CLEANSED, SILVER)
TO_NAMED = with_(RAW, CLEANSED, SILVER, LOOKUP, named("silver"))
TO_FACTS = with_(FACTS)
TO_NAMED_FACTS = with_(FACTS, LOOKUP, named("cleansed"))
TO_CATEGORY = f"{TO_NAMED}, category as ({CATEGORY})"
TO_TRENDING = f"{TO_SILVER}, trending as ({TRENDING % 'silver'})"
TO_DOCUMENTS = f"""{TO_CLEANSED},
silver as (
  select * from cleansed
  qualify row_number() over (
    partition by video_id, region, trending_date_parsed order by ingested_at desc) = 1
)"""
STORED = (
    "video_id, trending_date, title, channel_title, category_id, publish_time, tags, views,"
    " likes, dislikes, comment_count, thumbnail_link, comments_disabled, ratings_disabled,"
    " video_error_or_removed, description, region, trending_date_parsed, like_ratio,"
    " engagement_rate"
)
API_STORED = STORED.replace(
    "comments_disabled, ratings_disabled, video_error_or_removed",
    "false as comments_disabled, false as ratings_disabled, false as video_error_or_removed",
)

# The quality suite: the gappy statistics, the lookup as reference data, a missing table.
CHECKS = """
stats as (
  select views - 1000 as views, video_id, channel_title, region, ingested_at from raw
),
reference as (
  select cast(category_id as varchar) as id, lower(category_name) as region from lookup
),
measured as (
  select 'clean_statistics' as "table", count(*) as n from stats
  union all select 'clean_reference_data', count(*) from reference
),
gaps as (
  select 'clean_statistics' as "table", 'video_id' as "column",
    count_if(video_id is null) * 100.0::double / count(*) as pct from stats
  union all select 'clean_statistics', 'channel_title',
    count_if(channel_title is null) * 100.0::double / count(*) from stats
  union all select 'clean_statistics', 'views',
    count_if(views is null) * 100.0::double / count(*) from stats
  union all select 'clean_statistics', 'region',
    count_if(region is null) * 100.0::double / count(*) from stats
  union all select 'clean_reference_data', 'id',
    count_if(id is null) * 100.0::double / count(*) from reference
  union all select 'clean_reference_data', 'region',
    count_if(region is null) * 100.0::double / count(*) from reference
),
ranges as (
  select count_if(views < 0) as negative, count_if(views > 50000000000) as extreme from stats
),
moments as (
  select max(ingested_at) as latest from stats
),
row_count as (
  select 'row_count' as "check", "table", null::varchar as "column", n::double as value,
    10.0::double as threshold, n >= 10 as passed,
    'Row count: ' || n || ' (min: 10)' as message from measured
),
null_pct as (
  select 'null_pct' as "check", "table", "column", round(pct, 2) as value,
    5.0::double as threshold, pct <= 5.0 as passed,
    "column" || ' null%: ' || printf('%.2f', pct) || '% (max: 5.0%)' as message from gaps
  union all
  select 'null_pct', 'clean_statistics', 'title', null, null, false,
    'Column ''title'' missing from table'
  from (select count(*) from stats)
),
schema_check as (
  select 'schema' as "check", "table",
    case when "table" = 'clean_statistics' then 'title' else '' end as missing_columns,
    "table" <> 'clean_statistics' as passed,
    case when "table" = 'clean_statistics' then 'Missing columns: title'
      else 'All expected columns present' end as message
  from measured
),
value_range as (
  select 'value_range' as "check", 'clean_statistics' as "table", 'views' as "column",
    negative as negative_count, extreme as extreme_count,
    negative = 0 and extreme = 0 as passed,
    'Views: ' || negative || ' negative, ' || extreme || ' extreme (>50000000000)' as message
  from ranges
),
freshness as (
  select 'freshness' as "check", 'clean_statistics' as "table", as_of,
    strftime(latest, '%Y-%m-%d %H:%M:%S') as latest_record,
    strftime(as_of - interval 48 hours, '%Y-%m-%d %H:%M:%S') as cutoff,
    latest >= as_of - interval 48 hours as passed,
    'Latest: ' || strftime(latest, '%Y-%m-%d %H:%M:%S')
      || case when microsecond(latest) % 1000000 = 0 then '' else strftime(latest, '.%f') end
      || '+00:00, Cutoff: '
      || strftime(as_of - interval 48 hours, '%Y-%m-%d %H:%M:%S') || '+00:00' as message
  from moments, (values (timestamp '2024-01-31 12:00:00'), (timestamp '2024-02-15 00:00:00'))
    as t(as_of)
  union all
  select 'freshness', 'clean_reference_data', as_of, null, null, true,
    'No timestamp column found — skipping freshness check (backfill data)'
  from (values (timestamp '2024-01-31 12:00:00'), (timestamp '2024-02-15 00:00:00'))
    as t(as_of)
),
read_table as (
  select 'read_table' as "check", 'missing_table' as "table", false as passed,
    'Table missing_table not found' as message
),
results as (
  select "check", "table", "column", passed, message from row_count
  union all select "check", "table", "column", passed, message from null_pct
  union all select "check", "table", null, passed, message from schema_check
  union all select "check", "table", "column", passed, message from value_range
  union all select "check", "table", null, passed, message from freshness
    where as_of = timestamp '2024-01-31 12:00:00'
  union all select "check", "table", null, passed, message from read_table
)"""
TO_CHECKS = with_(RAW, LOOKUP, CHECKS)

SUPPLIER_ITEMS = """
items as (
  select 'category' as kind, 'e' || s_suppkey as etag, cast(s_suppkey as varchar) as id,
    'c' || s_nationkey as snippet_channelId,
    case when pos = 0 then 'superseded' else s_name end as snippet_title,
    s_acctbal > 0 as snippet_assignable, ' ' || r_name as region,
    r_name || '/' || s_nationkey as _source_file, pos as _position, s_nationkey
  from supplier join nation on s_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey, (values (0::bigint), (1::bigint)) as p(pos)
)"""

REFERENCE_TABLE = with_(SUPPLIER_ITEMS) + """
select kind, etag, id, snippet_channelId, snippet_title, snippet_assignable,
  lower(trim(region)) as region, _source_file
from items where _position = 1
qualify s_nationkey = max(s_nationkey) over (partition by region)"""

STAGE_WARNINGS = """
select '%s' as stage, count(*) as rows, count_if(video_id is null) as null_video_id,
  count_if(title is null) as null_title, count_if(channel_title is null) as null_channel_title,
  count_if(views is null) as null_views, count_if(views < 0) as negative_views from %s"""

SQL: dict[str, str] = {
    "silver_statistics": f"{TO_SILVER} select {STORED} from silver",
    "normalize_two_formats": f"""{TO_RAW}
select {CANONICAL}, source_row as _source_row from raw where title not in ('click', 'view')
union all
select {CANONICAL.replace("comments_disabled, ratings_disabled, video_error_or_removed",
"false, false, false")}, source_row from raw where title in ('click', 'view')""",
    "region_clean": """
select c_custkey, lower(trim('  ' || r_name || ' ')) as region
from customer join nation on c_nationkey = n_nationkey
join region on n_regionkey = r_regionkey""",
    "date_parse": """
select event_id, cast(ts as date) as short_day, cast(ts as date) as iso_day,
  cast(try_strptime(strftime(ts, '%y.%m.%d'), '%y.%d.%m') as date) as swapped_day,
  null::date as bad_day from events""",
    "null_fill": f"""{TO_RAW} select source_row as _source_row, coalesce(views, 0) as views,
  coalesce(likes, 0) as likes, coalesce(dislikes, 0) as dislikes,
  coalesce(comment_count, 0) as comment_count from raw""",
    "like_ratio": f"""{TO_RAW} select source_row as _source_row,
  case when views > 0 then round(likes / views * 100, 4) else 0.0::double end as like_ratio
from raw""",
    "engagement_rate": f"{TO_CLEANSED} select source_row as _source_row, engagement_rate from cleansed",
    "latest_per_key": """
select * replace (cast(o_orderdate as date) as o_orderdate) from orders
qualify row_number() over (partition by o_custkey, o_orderpriority
  order by cast(o_orderdate as date) desc, o_orderkey desc) = 1""",
    "dedup_lookup": """
select p_size::bigint as category_id, min(p_name) as category_name from part group by 1""",
    "dedup_keep_last": """
select l_orderkey, l_partkey, max(l_extendedprice) as price from lineitem
group by l_orderkey, l_partkey, l_linenumber
qualify row_number() over (partition by l_orderkey, l_partkey order by l_linenumber desc) = 1""",
    "dedup_removed_count": f"""{TO_CLEANSED}, keys as (
  select distinct video_id, region, trending_date_parsed from cleansed)
select (select count(*) from cleansed) as rows_read, (select count(*) from keys) as rows_kept,
  (select count(*) from cleansed) - (select count(*) from keys) as rows_removed""",
    "silver_warnings": f"""{TO_SILVER}
{STAGE_WARNINGS % ("before", "raw")} union all {STAGE_WARNINGS % ("after", "silver")}""",
    "enrich_category": f"""{with_(RAW, LOOKUP, named("raw"))}
select source_row as _source_row, category_id, category_name from named""",
    "trending_analytics": TO_SILVER + TRENDING % "silver",
    "channel_analytics": TO_NAMED + CHANNEL,
    "category_analytics": TO_NAMED + CATEGORY,
    "trending_analytics_facts": TO_FACTS + TRENDING % "cleansed",
    "channel_analytics_facts": TO_NAMED_FACTS + CHANNEL,
    "category_analytics_facts": TO_NAMED_FACTS + CATEGORY,
    "channel_rank": """
select *, row_number() over (partition by r_name order by total desc, c_custkey) as rank_in_region
from (
  select r_name, c_custkey, sum(cast(round(o_totalprice * 100) as bigint))::bigint as total
  from orders join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
  group by r_name, c_custkey)""",
    "category_share": """
select *, round(quantity / sum(quantity) over (partition by l_returnflag) * 100, 2) as share_pct
from (
  select l_returnflag, p_type, sum(cast(l_quantity as bigint))::bigint as quantity
  from lineitem join part on l_partkey = p_partkey group by l_returnflag, p_type)""",
    "videos_per_region": f"""{TO_CLEANSED}
select region, count(*) as video_count from cleansed group by region""",
    "region_filter": f"""{TO_CLEANSED}
select video_id, trending_date, title, views, likes from cleansed where region = 'asia'""",
    "region_top_videos": f"""{TO_CLEANSED}
select video_id, trending_date, title, views, likes from cleansed where region = 'asia'
order by views desc, video_id, trending_date, title, likes limit 10""",
    "top_category_days": f"""{TO_CATEGORY}
select category_name, total_views from category
order by total_views desc, category_name, category_id, region, trending_date_parsed limit 10""",
    "top_categories": f"""{TO_CATEGORY}
select category_name, sum(total_views)::bigint as total_views from category
group by category_name order by total_views desc, category_name limit 10""",
    "regions_by_days": f"""{TO_TRENDING}
select region, count(*) as trending_videos from trending group by region""",
    "regions_by_videos": f"""{TO_TRENDING}
select region, sum(total_videos)::bigint as trending_videos from trending group by region""",
    "table_counts": f"""{TO_NAMED}
select 'trending_analytics' as table_name, count(*) as row_count
from (select distinct region, trending_date_parsed from named)
union all select 'channel_analytics', count(*)
from (select distinct channel_title, region from named)
union all select 'category_analytics', count(*)
from (select distinct category_name, category_id, region, trending_date_parsed from named)""",
    "report_sql": f"""{TO_CATEGORY}
select category_name, total_views, region from category
order by total_views desc, category_name, region limit 10""",
    "dq_row_count": f"""{TO_CHECKS}
select "table", value, threshold, passed, message from row_count""",
    "dq_null_pct": f"""{TO_CHECKS}
select "table", "column", value, threshold, passed, message from null_pct""",
    "dq_schema": f"""{TO_CHECKS}
select "table", missing_columns, passed, message from schema_check""",
    "dq_value_range": f"""{TO_CHECKS}
select "table", "column", negative_count, extreme_count, passed, message from value_range""",
    "dq_freshness": f"""{TO_CHECKS}
select "table", latest_record, cutoff, passed, message from freshness""",
    "dq_history": f"""{TO_CHECKS}, runs as (
  select case when as_of < timestamp '2024-02-01' then 'first' else 'second' end as run_id,
    "check", "table", null::varchar as "column", passed, null::double as value, latest_record
  from freshness
  union all
  select run_id, r."check", r."table", r."column", r.passed, r.value, null
  from (select "check", "table", "column", passed, value from row_count
    union all select "check", "table", "column", passed, value from null_pct
    union all select "check", "table", null, passed, null from schema_check
    union all select "check", "table", "column", passed, null from value_range
    union all select "check", "table", null, passed, null from read_table) r,
    (values ('first'), ('second')) as t(run_id)
), compared as (
  select *, lag(passed) over w as earlier, lag(value) over w as previous_value,
    latest_record > lag(latest_record) over w as advanced
  from runs window w as (partition by "check", "table", "column" order by run_id))
select run_id, "check", "table", "column", passed,
  case when earlier is null then 'first' when earlier = passed then 'same'
    when passed then 'mended' else 'broken' end as change, previous_value, advanced
from compared""",
    "dq_sampled": f"""{TO_CHECKS}
select "table", least(value, 20) as value, threshold, least(value, 20) >= threshold as passed,
  'Row count: ' || cast(least(value, 20) as bigint) || ' (min: 10)' as message
from row_count""",
    "dq_missing_table": f"""{TO_CHECKS}
select "check", "table", passed, message from results
where "check" in ('read_table', 'row_count')""",
    "dq_results": f"""{TO_CHECKS} select "check", "table", "column", passed from results""",
    "dq_verdict": f"""{TO_CHECKS} select bool_and(passed) as quality_passed,
  count_if(passed) as checks_passed, count(*) as checks_total from results""",
    "dq_failed": f"""{TO_CHECKS}
select "check", "table", message, "check" as in_payload from results where not passed""",
    "flatten_reference": with_(SUPPLIER_ITEMS) + " select * exclude (s_nationkey) from items",
    "silver_reference": REFERENCE_TABLE,
    "reference_stream": f"select * exclude (_source_file) from ({REFERENCE_TABLE})",
    "reference_gains_fields": with_(SUPPLIER_ITEMS) + """
select id, lower(trim(region)) as region, snippet_title,
  case when s_nationkey >= 21 then 'about ' || snippet_title end as snippet_description,
  case when s_nationkey >= 21 then length(id)::varchar end as position,
  case when s_nationkey >= 21 then upper(snippet_title) end as localized_title
from items where _position = 1 qualify s_nationkey = max(s_nationkey) over (partition by region)""",
    "table_gains_columns": f"""{TO_SILVER}
select video_id, region, trending_date_parsed, views,
  case when region in ('asia', 'europe') then views * 2 end as doubled from silver""",
    "bulk_csv_roundtrip": f"""{TO_RAW}
select source_row::varchar as video_id, title, views::varchar as views, likes::varchar as likes,
  description || chr(10) || '"said", he' as description, trim(region) as region from raw""",
    "silver_audit": f"""{TO_SILVER}
select video_id, region, trending_date_parsed, timestamp '2024-01-31 12:00:00' as _processed_at,
  'build_silver_statistics' as _job_name from silver""",
    "gold_audit": f"""{TO_SILVER}
select region, trending_date_parsed, count(*) as total_videos, timestamp '2024-01-31 12:00:00' as _aggregated_at
from silver group by region, trending_date_parsed""",
    "category_documents_without_items": """
select n_nationkey::varchar as id, n_name as snippet_title, lower(n_name) as region from nation""",
    "gold_rebuilt_with_less": f"""select * from (
{TO_DOCUMENTS}, {LOOKUP}, {named('silver')} {CATEGORY}) where region <> 'asia'""",
    "reference_metadata": with_(SUPPLIER_ITEMS) + """
select id, snippet_title, snippet_assignable, trim(region) as region from items
where _position = 1""",
    "envelope": f"""{TO_RAW} select lower(trim(region)) as region,
  strftime(ingested_at, '%Y%m%d_%H%M%S') as ingestion_id,
  strftime(ingested_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' as ingestion_timestamp,
  1::bigint as video_count, 'events' as source
from raw""",
    "region_parameter": """
select n_nationkey as nation, unnest([lower(r_name), cast(n_nationkey as varchar), 'us']) as region
from nation join region on n_regionkey = r_regionkey""",
    "ingest_summary": f"""{TO_RAW}, expected as (
  select lower(r_name) as region from region union all select lower(n_name) from nation)
select e.region, count(r.source_row) as documents, count(r.source_row) as videos,
  0::bigint as unreadable,
  case when count(r.source_row) = 0 then 'failed' else 'success' end as status
from expected e left join raw r on e.region = lower(trim(r.region)) group by e.region""",
    "region_outcomes": f"""{with_(RAW, SUPPLIER_ITEMS)}, expected as (
  select lower(r_name) as region from region union all select lower(n_name) from nation),
landed as (select distinct lower(trim(region)) as region from raw),
named as (select distinct lower(trim(region)) as region from items)
select e.region,
  case when l.region is null or n.region is null then 'failed' else 'success' end as status,
  case when l.region is null then 'trending' when n.region is null then 'categories' end as type,
  case when l.region is null or n.region is null then 'no document' end as error
from expected e left join landed l on e.region = l.region
left join named n on e.region = n.region""",
    "landed_summary": f"""{TO_RAW}, expected as (select lower(r_name) as region from region)
select e.region, count(r.source_row) as documents, count(r.source_row) as videos,
  0::bigint as unreadable,
  case when count(r.source_row) = 0 then 'failed' else 'success' end as status
from expected e left join raw r on e.region = lower(trim(r.region)) group by e.region""",
    "file_summary": with_(SUPPLIER_ITEMS) + """
select _source_file as file, trim(region) as region, count(distinct id) as rows,
  null::varchar as error from items group by _source_file, region""",
    "partition_pruned_scan": f"""{TO_SILVER}
select region, video_id, trending_date_parsed, views from silver
where region in ('asia', 'europe')""",
    "partition_overwrite_roundtrip": f"""{TO_SILVER}
select video_id, region, trending_date_parsed,
  case when region in ('asia', 'europe') then views * 2 else views end as views from silver""",
    "raw_landing_roundtrip": f"""{TO_RAW}
select {CANONICAL.replace("comments_disabled, ratings_disabled, video_error_or_removed",
"false as comments_disabled, false as ratings_disabled, false as video_error_or_removed").replace(
"region", "lower(trim(region)) as region")}
from raw""",
    "incremental_available_now": f"{TO_DOCUMENTS} select {API_STORED} from silver",
    "incremental_bulk": f"""{TO_SILVER}, stored as (
  select * replace (case when region in ('asia', 'europe') then views else 2 * views end as views) from silver)
select video_id, region, trending_date_parsed, title, views, likes,
  case when views > 0 then round(likes / views * 100, 4) else 0.0::double end as like_ratio
from stored""",
    "first_of_day_stream": f"""{TO_CLEANSED}
select distinct video_id, region, trending_date_parsed from cleansed
where title = 'click' or ingested_at >
  (select max(ingested_at) - interval 2 days from cleansed where title = 'click')""",
    "upsert_latest": f"{TO_SILVER} select {STORED} from silver",
    "gold_incremental": f"""{TO_DOCUMENTS}, {LOOKUP}, {named('silver')},
trending as ({TRENDING % 'silver'}), channel as ({CHANNEL}), category as ({CATEGORY})
select 'trending_analytics' as table_name, region, trending_date_parsed as day, unique_categories::varchar as key,
  total_videos as rows, total_views, unique_channels as distinct_count, avg_like_ratio as mean, null::double as place
from trending
union all select 'channel_analytics', region, first_trending, channel_title || ':' || categories,
  times_trending, total_views, total_videos, avg_engagement_rate, rank_in_region::double from channel
union all select 'category_analytics', region, trending_date_parsed, category_name,
  video_count, total_views, unique_channels, avg_engagement_rate, view_share_pct from category""",
    "run_counts": f"""{TO_DOCUMENTS},
landed as (
  select region, video_id, title, channel_title, views from raw
  union all select region, video_id, title, channel_title, views from raw where lower(trim(region)) = 'asia'
  union all select region, null, title, channel_title, views from raw where lower(trim(region)) = 'africa'),
numbers as (
  select count(*) as n, count_if(video_id is null) as dropped, count_if(title is null) as titles,
    count_if(channel_title is null) as channels, count_if(views is null) as views from landed),
kept as (
  select count(*) as n, count_if(title is null) as titles, count_if(channel_title is null) as channels,
    count_if(views < 0) as negative from silver)
select 1::bigint as loads, l.n as rows_read, l.dropped as rows_dropped, l.n - l.dropped - k.n as rows_deduplicated,
  k.n as rows_written, l.dropped as read_null_video_id, l.titles as read_null_title,
  l.channels as read_null_channel_title, l.views as read_null_views, 0::bigint as written_null_video_id,
  k.titles as written_null_title, k.channels as written_null_channel_title, 0::bigint as written_null_views,
  k.negative as written_negative_views
from numbers l, kept k""",
    "run_counts_incremental": f"""{TO_DOCUMENTS},
numbers as (
  select count(*) as n, count_if(title is null) as titles, count_if(channel_title is null) as channels,
    count_if(views is null) as views from raw where lower(trim(region)) = 'asia'),
kept as (
  select count(*) as n, count_if(title is null) as titles, count_if(channel_title is null) as channels,
    count_if(views < 0) as negative from silver where region = 'asia')
select 1::bigint as loads, l.n as rows_read, 0::bigint as rows_dropped, l.n - k.n as rows_deduplicated,
  k.n as rows_written, 0::bigint as read_null_video_id, l.titles as read_null_title,
  l.channels as read_null_channel_title, l.views as read_null_views, 0::bigint as written_null_video_id,
  k.titles as written_null_title, k.channels as written_null_channel_title, 0::bigint as written_null_views,
  k.negative as written_negative_views
from numbers l, kept k""",
    "partial_rebuild": f"{TO_DOCUMENTS}, {LOOKUP}, {named('silver')} {CATEGORY}",
    "table_switched": f"""{TO_SILVER}
select 'now' as state, region, count(*) as row_count, (3 * sum(views))::bigint as views
from silver where region in ('asia', 'europe') group by region
union all select 'before', region, count(*), sum(views)::bigint from silver group by region""",
    "gold_after_gate": f"{TO_DOCUMENTS}, {LOOKUP}, {named('silver')} {CATEGORY}",
}
