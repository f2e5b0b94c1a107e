"""The same queries as plain SQL over the driver tables."""

from __future__ import annotations

_WIRE = """
b as (select e.*, cast(json_extract_string(props, '$.k') as int) k from events e),
wire as (
  select cast(event_id as varchar) event_key, ts received_at,
         concat('v', cast(user_id as varchar)) visitor_key,
         concat('m', cast(k % 5 as varchar)) media_id,
         concat(p.p_name, case when k % 2 = 0 then ' Youtube' else ' FACEBOOK' end,
                ' Paid Ads') media_name,
         concat('https://example.com/medias/m', cast(k % 5 as varchar)) media_url,
         value / cast(100 as double) percent_viewed,
         concat('10.0.', cast(user_id % 256 as varchar), '.', cast(k as varchar)) ip,
         n.n_name country, k, event_id
  from b left join part p on p.p_partkey = k
         left join customer c on c.c_custkey = user_id
         left join nation n on n.n_nationkey = c.c_nationkey),
good as (select * from wire where percent_viewed between 0 and 1)
"""


def _fact(source: str) -> str:
    return f"""
      select event_key event_id, visitor_key visitor_id, media_id,
             cast(received_at as date) date, percent_viewed watched_percent
      from {source}
      qualify row_number() over (partition by event_key order by received_at desc nulls last,
        visitor_key desc nulls last, media_id desc nulls last,
        percent_viewed desc nulls last) = 1"""


def _media(source: str) -> str:
    return f"""
      select media_id, media_name title, media_url url,
        case when (lower(media_name) like '%youtube%') <> (lower(media_name) like '%facebook%')
             then case when lower(media_name) like '%youtube%' then 'Youtube' else 'Facebook' end
        end channel
      from {source}
      qualify row_number() over (partition by media_id order by received_at desc nulls last,
        media_name desc nulls last, media_url desc nulls last) = 1"""


def _visitors(source: str) -> str:
    return f"""
      select visitor_key visitor_id, ip ip_address, country
      from {source}
      qualify row_number() over (partition by visitor_key order by received_at desc nulls last,
        ip desc nulls last, country desc nulls last) = 1"""


def _engagement(source: str) -> str:
    return f"""
      select visitor_id, media_id, count(event_id) total_views,
             avg(watched_percent) avg_pct_viewed, max(watched_percent) max_pct_viewed,
             min(date) first_date_watched, max(date) last_date_watched
      from {source} group by visitor_id, media_id"""


_MODEL = f"""{_WIRE},
fact as ({_fact("good")}),
media as ({_media("good")}),
visitors as ({_visitors("good")}),
ve as ({_engagement("fact")}),
enriched as (
  select ve.*, coalesce(m.title, 'Unknown') title, coalesce(m.channel, 'Unknown') channel, m.url,
         coalesce(v.ip_address, 'Unknown') ip_address, coalesce(v.country, 'Unknown') country
  from ve left join media m using (media_id) left join visitors v using (visitor_id))
"""

_LOADS = f"""{_WIRE},
load1 as (select * from good where received_at < timestamp '2024-01-21'),
load2 as (
  select event_key, received_at, visitor_key, media_id, concat('New ', media_name) media_name,
         media_url, percent_viewed / 2 percent_viewed, ip, concat('NEW_', country) country
  from good where received_at >= timestamp '2024-01-11')
"""

_FAULTS = f"""{_WIRE},
issue as (
  select event_id, media_id, 0 pos, 'malformed_json' code, '$' field,
         'Not a single JSON value.' message from wire where k in (1, 2, 3)
  union all select event_id, media_id, 0, 'invalid_record_type', '$', 'Expected a JSON object.'
    from wire where k in (4, 5)
  union all select event_id, media_id, 1, 'missing_required_field', 'event_key',
    'Required field is missing.' from wire where k = 7
  union all select event_id, media_id, 1, 'invalid_type', 'event_key', 'Expected string.'
    from wire where k = 23
  union all select event_id, media_id, 2, 'invalid_type', 'received_at', 'Expected timestamp.'
    from wire where k in (13, 14, 28)
  union all select event_id, media_id, 3, 'null_required_field', 'visitor_key',
    'Required field cannot be null.' from wire where k = 9
  union all select event_id, media_id, 4, 'missing_required_field', 'media_id',
    'Required field is missing.' from wire where k = 7
  union all select event_id, media_id, 5, 'null_required_field', 'media_name',
    'Required field cannot be null.' from wire where k = 9
  union all select event_id, media_id, 7, 'invalid_type', 'percent_viewed', 'Expected number.'
    from wire where k in (11, 12)
  union all select event_id, media_id, 8, 'null_required_field', 'ip',
    'Required field cannot be null.' from wire where k = 8
  union all select event_id, media_id, 9, 'missing_required_field', 'country',
    'Required field is missing.' from wire where k in (6, 26)
  union all select event_id, media_id, 14, 'invalid_type', 'lat', 'Expected number.'
    from wire where k = 10
  union all select event_id, media_id, 18, 'invalid_type', 'thumbnail', 'Expected object.'
    from wire where k = 18
  union all select event_id, media_id, 20, 'invalid_type', 'thumbnail.width', 'Expected integer.'
    from wire where k = 19
  union all select event_id, media_id, 25, 'invalid_type', 'conversion_type',
    'Expected integer or string.' from wire where k = 15
  union all select event_id, media_id, 34, 'invalid_type', 'user_agent_details.mobile',
    'Expected boolean.' from wire where k = 20
  union all select event_id, media_id, 99, 'out_of_range', 'percent_viewed',
    'Expected a number between 0.0 and 1.0.' from wire
    where k not in (1, 2, 3, 4, 5, 11, 12) and (k = 25 or percent_viewed > 1)),
drift as (
  select event_id, 'new_field' path from wire where k in (21, 26)
  union all select event_id, 'thumbnail.new_size' from wire where k = 21
  union all select event_id, 'user_agent_details.os' from wire where k = 20),
verdict as (
  select w.event_id, w.media_id, w.k, w.event_key, w.percent_viewed, w.country,
         coalesce(string_agg(code || ':' || field, ',' order by pos), '') issues,
         count(code) issue_count
  from wire w left join issue i on i.event_id = w.event_id
  group by w.event_id, w.media_id, w.k, w.event_key, w.percent_viewed, w.country)
"""

_LEDGER = """
entry as (
  select concat('wf-', strftime(ts, '%Y-%m-%d')) workflow_run, ts logged_at,
    case event_type when 'view' then 'INGESTION_RUN_ID'
      when 'click' then 'FACT_MEDIA_ENGAGEMENT_INGESTION_RUN_ID'
      when 'purchase' then 'FACT_MEDIA_ENGAGEMENT_TABLE_URI'
      when 'signup' then 'INGESTION_END_DATE' else 'VALIDATION_REPORT_URI' end key,
    case when event_type in ('view', 'click') then concat('run-', cast(user_id % 2 as varchar))
      when event_type = 'signup' then strftime(ts, '%Y-%m-%d')
      else concat('s3://lake/', cast(user_id as varchar)) end value
  from events),
latest as (
  select workflow_run, key, value from entry
  qualify row_number() over (partition by workflow_run, key
    order by logged_at desc, value desc) = 1)
"""

_VE_ROUNDED = """select visitor_id, media_id, total_views, round(avg_pct_viewed, 9) avg_pct_viewed,
  max_pct_viewed, first_date_watched, last_date_watched"""
_DETAIL = """select visitor_id, media_id, title, channel, country, ip_address, total_views,
  round(avg_pct_viewed, 9) avg_pct_viewed, max_pct_viewed, first_date_watched, last_date_watched
  from enriched"""
_KPIS = """select count(distinct visitor_id) unique_visitors,
  cast(coalesce(sum(total_views), 0) as bigint) total_views,
  round(coalesce(sum(avg_pct_viewed * total_views) / nullif(sum(total_views), 0), 0.0), 9)
    weighted_average,
  count(distinct case when max_pct_viewed >= 0.75 then visitor_id end) high_intent_visitors"""
_CHOSEN = f"""media_id in ('m0', 'm1', 'm2') and channel = 'Youtube' and country in (
  {", ".join(f"'NATION_{n}'" for n in range(15))})"""
_OVERLAP = """last_date_watched >= date '2024-01-10' and first_date_watched <= date '2024-01-12'"""
_WINDOWED = """select * from wire where media_id in ('m3', 'm0', 'm7')
  and cast(received_at as date) between date '2024-01-08' and date '2024-01-14'"""


def _upserted(build) -> str:
    key = {_fact: "event_id", _media: "media_id", _visitors: "visitor_id"}[build]
    return f"""with {_LOADS}, old as ({build("load1")}), new as ({build("load2")})
      select * from new union all select * from old anti join new using ({key})"""


def _issue_rows(condition: str, columns: str = "event_id, field, message") -> str:
    return f"with {_FAULTS} select {columns} from issue where {condition}"


def _model(select: str) -> str:
    return f"with {_MODEL} {select}"


def oracle_sql() -> dict[str, str]:
    engagement = _model(f"{_VE_ROUNDED} from ve")
    return {
        # ---- sources and sinks
        "scan_landing_lines": f"with {_WIRE} select media_id, event_key from wire",
        "line_lineage": f"""with {_WIRE} select media_id, count(*) line_count,
            count(*) distinct_numbers, cast(1 as bigint) first_line, count(*) numbered_lines
            from wire group by media_id""",
        "scan_raw_events": f"""with {_WIRE} select event_key,
            strftime(received_at, '%Y-%m-%dT%H:%M:%S.%fZ') received_at, visitor_key, media_id,
            media_name, media_url, percent_viewed, ip, country from good""",
        "require_columns": f"""with {_WIRE}, n as (select count(*) > 0 present from wire)
            select field, n.present and field not in
              ('embed_url', 'org', 'region', 'city', 'iframe_heatmap_url', 'conversion_data') present
            from n, (values ('event_key'), ('received_at'), ('visitor_key'), ('media_id'),
              ('media_name'), ('media_url'), ('percent_viewed'), ('ip'), ('country'),
              ('embed_url'), ('org'), ('region'), ('city'), ('lat'), ('lon'), ('email'),
              ('iframe_heatmap_url'), ('thumbnail'), ('conversion_type'), ('conversion_data'),
              ('user_agent_details'), ('new_field')) f(field)""",
        "read_table_version": f"""with {_WIRE}
            select count(distinct event_key) row_count, 1 as version from good""",
        "extract_window": f"""with {_WIRE}
            select event_key, media_id, received_at, visitor_key, percent_viewed
            from ({_WINDOWED}) w""",
        "run_manifest": f"""with {_WIRE}, w as ({_WINDOWED}),
            wanted as (select * from (values (0, 'm3'), (1, 'm0'), (2, 'm7')) v(position, media_id))
            select 'run-0001' run_id, '2024-01-08' start_date, '2024-01-14' end_date,
              cast(3 as bigint) media_count, (select count(*) from w) total_event_count, position,
              wanted.media_id, count(w.event_key) event_count,
              cast(ceil(count(w.event_key) / 100.0) as bigint) page_count, 'succeeded' status
            from wanted left join w on w.media_id = wanted.media_id
            group by position, wanted.media_id""",
        "manifest_sources": """select day, cast(row_number() over (partition by day
              order by event_type) - 1 as int) as position,
            case when event_type not in ('purchase', 'error')
              then concat('s3://lake/', day, '/', event_type) end s3_uri
            from (select distinct strftime(ts, '%Y-%m-%d') as day, event_type from events)""",
        "upsert_duplicate_gate": """select l_orderkey, l_linenumber, count(*) as "count"
            from lineitem group by 1, 2 having count(*) > 1""",
        "route_valid": f"""with {_FAULTS} select event_key, media_id, percent_viewed, country
            from verdict where issue_count = 0""",
        "route_quarantine": f"""with {_FAULTS}
            select '2026-03-v1' contract_version, 'run-0001' ingestion_run_id, media_id,
              issues errors, k not in (1, 2, 3) has_event, k in (1, 2, 3) has_line, line_number
            from (select *, row_number() over (partition by media_id order by event_id) line_number
                  from verdict) where issue_count > 0""",
        "validation_report": f"""with {_FAULTS}
            select 'records' section, 'total' as name, count(*) records from verdict
            union all select 'records', 'valid', count(*) from verdict where issue_count = 0
            union all select 'records', 'quarantined', count(*) from verdict where issue_count > 0
            union all select 'records', 'malformed', count(*) from verdict where k in (1, 2, 3)
            union all select 'errors', code, count(*) from issue group by code
            union all select 'drift', path, count(*) from drift group by path""",
        "upsert_fact": _upserted(_fact),
        "upsert_dim_media": _upserted(_media),
        "upsert_dim_visitors": _upserted(_visitors),
        "overwrite_curated": engagement,
        "export_detail_csv": _model(_DETAIL),
        # ---- projections and gates
        "project_media": f"""with {_WIRE} select media_id, media_name title, media_url url,
            received_at, case when k % 2 = 0 then 'Youtube' else 'Facebook' end channel from good""",
        "project_visitors": f"""with {_WIRE} select visitor_key visitor_id, ip ip_address, country,
            received_at from good""",
        "project_fact": f"""with {_WIRE} select event_key event_id, visitor_key visitor_id,
            media_id, received_at, percent_viewed watched_percent from good""",
        "channel_classify": """select event_id, case event_type when 'view' then 'Youtube'
            when 'click' then 'Facebook' end channel from events""",
        "channel_violations": """select
            concat('m', cast(cast(json_extract_string(props, '$.k') as int) % 5 as varchar)) media_id,
            case event_type when 'purchase' then 'YouTube and facebook'
              when 'signup' then 'Spring cut' end title, count(*) row_count
            from events where event_type not in ('view', 'click') group by 1, 2""",
        "channel_examples": """select * from (select
            concat('m', cast(cast(json_extract_string(props, '$.k') as int) % 5 as varchar)) media_id,
            case event_type when 'purchase' then 'YouTube and facebook'
              when 'signup' then 'Spring cut' end title
            from events where event_type not in ('view', 'click'))
            order by media_id nulls last, title nulls last limit 10""",
        "curated_audit": _model(f"""{_VE_ROUNDED}, date '2024-01-31' data_through_date,
            '2024-02-01 06:30:00' pipeline_refreshed_at, 'run-0001' ingestion_run_id from ve"""),
        "enrich_dashboard": _model(_DETAIL.replace("from enriched", ", url from enriched")),
        "load_dashboard": _model(_DETAIL.replace(
            "from enriched", ", url, 'run-0001' newest_run, 0 as version from enriched")),
        "enrich_without_dims": _model(f"""{_VE_ROUNDED}, media_id title, 'Unknown' channel,
            'Unknown' ip_address, 'Unknown' country from ve"""),
        "engagement_bands": _model("""select case when avg_pct_viewed <= 0.25 then '0–25%'
            when avg_pct_viewed <= 0.5 then '25–50%' when avg_pct_viewed <= 0.75 then '50–75%'
            else '75–100%' end engagement_band, count(*) visitor_media_pairs from enriched
            where avg_pct_viewed > -0.001 and avg_pct_viewed <= 1 group by 1"""),
        "visitor_media_detail": _model(_DETAIL),
        "filter_membership": _model(f"""select visitor_id, media_id, channel, country, total_views
            from enriched where {_CHOSEN}"""),
        "filter_date_overlap": _model(f"""select visitor_id, media_id, first_date_watched,
            last_date_watched from enriched where {_OVERLAP}"""),
        "watch_date_violations": _model("""select visitor_id, media_id,
            case when media_id = 'm3' then '01/02/24'
              else strftime(first_date_watched, '%Y-%m-%d') end first_date_watched,
            case when max_pct_viewed <= 0.9
              then strftime(last_date_watched, '%Y-%m-%d') end last_date_watched
            from ve where media_id = 'm3' or max_pct_viewed > 0.9"""),
        "run_ledger_latest": f"with {_LEDGER} select * from latest",
        "fact_run_gate": f"""with {_LEDGER}
            select l.workflow_run, l.value left_run, r.value right_run
            from latest l join latest r using (workflow_run)
            where l.key = 'INGESTION_RUN_ID'
              and r.key = 'FACT_MEDIA_ENGAGEMENT_INGESTION_RUN_ID' and l.value <> r.value""",
        "resolve_run_input": f"""with {_LEDGER} select * from latest
            where workflow_run = (select max(workflow_run) from entry)
              and key in ('INGESTION_RUN_ID', 'VALIDATION_REPORT_URI')""",
        "lineage_gate": """select strftime(ts, '%Y-%m-%d') as day, event_type,
            case when event_type not in ('signup', 'error') then count(*) end valid_records,
            case event_type when 'click' then 'wrong run' when 'purchase' then 'no raw uri'
              when 'view' then 'ok' else 'bad count' end verdict
            from events group by 1, 2""",
        "zero_valid_noop": f"""with {_WIRE} select count(*) loaded, cast(0 as bigint) added, count(*) row_count,
            true same_version from good""",
        # ---- record validation
        "dq_malformed": _issue_rows("code = 'malformed_json'", "event_id, field"),
        "dq_record_type": _issue_rows("code = 'invalid_record_type'"),
        "dq_missing": _issue_rows("code = 'missing_required_field'"),
        "dq_null": _issue_rows("code = 'null_required_field'"),
        "dq_type": _issue_rows(
            "code = 'invalid_type' and field in ('event_key', 'lat', 'percent_viewed')"
        ),
        "dq_timestamp": _issue_rows("code = 'invalid_type' and field = 'received_at'"),
        "dq_union_type": _issue_rows("code = 'invalid_type' and field = 'conversion_type'"),
        "dq_nested": _issue_rows("""code = 'invalid_type' and field in
            ('thumbnail', 'thumbnail.width', 'user_agent_details.mobile')"""),
        "dq_range": _issue_rows("code = 'out_of_range'"),
        "dq_issues": f"""with {_FAULTS} select event_id, issue_count = 0 is_valid, issues
            from verdict""",
        "dq_drift": f"with {_FAULTS} select event_id, path from drift",
        # ---- aggregates
        "visitor_engagement": engagement,
        "kpis": _model(f"{_KPIS} from enriched"),
        "kpis_filtered": _model(f"{_KPIS} from enriched where {_CHOSEN} and {_OVERLAP}"),
        "media_summary": _model("""select media_id, title, channel,
            cast(sum(total_views) as bigint) total_views,
            count(distinct visitor_id) unique_visitors,
            round(sum(avg_pct_viewed * total_views) / sum(total_views), 9) avg_pct_viewed
            from enriched group by media_id, title, channel"""),
        "top_countries": _model("""select country, cast(sum(total_views) as bigint) total_views
            from enriched group by country order by total_views desc, country limit 10"""),
        "top_visitors": _model("""select visitor_id, country,
            cast(sum(total_views) as bigint) total_views,
            count(distinct media_id) media_watched, max(max_pct_viewed) max_pct_viewed,
            max(last_date_watched) last_date_watched
            from enriched group by visitor_id, country
            order by sum(total_views) desc, max(max_pct_viewed) desc, visitor_id, country
            limit 15"""),
        "validation_counts": f"""with {_FAULTS} select count(*) total,
            count(*) filter (issue_count = 0) valid,
            count(*) filter (issue_count > 0) quarantined,
            count(*) filter (k in (1, 2, 3)) malformed from verdict""",
        "error_counts": f"""with {_FAULTS} select code, count(*) issue_count
            from issue group by code""",
        "unknown_field_counts": f"""with {_FAULTS} select path, count(*) record_count
            from drift group by path""",
        "pipeline_freshness": """with audit as (
              select case when event_type <> 'view' then cast(ts as date) end as through,
                case when event_type <> 'click' then ts + interval 390 minutes end as refreshed,
                case when event_type <> 'error' then concat('run-', strftime(ts, '%Y%m%d')) end as run
              from events)
            select max(through) data_through_date,
              strftime(max(refreshed), '%Y-%m-%d %H:%M:%S') pipeline_refreshed_at,
              (select run from audit where run is not null
               order by refreshed desc nulls last, run desc limit 1) ingestion_run_id
            from audit""",
        "table_row_counts": f"""with {_WIRE}
            select 'dim_media' table_name, count(distinct media_id) row_count from good
            union all select 'dim_visitors', count(distinct visitor_key) from good
            union all select 'fact_media_engagement', count(distinct event_key) from good""",
        "filter_domains": _model("""select distinct 'media' as "filter", media_id choice
            from enriched union all select distinct 'channel', channel from enriched
            union all select distinct 'country', country from enriched"""),
        "date_extent": _model("""select min(first_date_watched) min_date,
            max(last_date_watched) max_date from enriched"""),
        "media_labels": _model("select distinct media_id, title from enriched"),
        # ---- newest row per key
        "dim_media": f"with {_WIRE} {_media('good')}",
        "dim_visitors": f"with {_WIRE} {_visitors('good')}",
        "fact_media_engagement": f"with {_WIRE} {_fact('good')}",
        "dedup_latest_lineitem": """select * replace (cast(l_shipdate as date) as l_shipdate)
            from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber
              order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_quantity desc,
                l_extendedprice desc, l_discount desc, l_tax desc, l_returnflag desc,
                l_linestatus desc) = 1""",
        # ---- runs
        "replay_idempotent": _model(f"""{_VE_ROUNDED},
            (select cast(max(ts) as date) from events) data_through_date,
            'run-0001' ingestion_run_id from ve"""),
        "backfill_recompute": f"""with {_LOADS}, old as ({_fact("load1")}),
            new as ({_fact("load2")}),
            merged as (select * from new union all select * from old anti join new using (event_id)),
            ve as ({_engagement("merged")})
            {_VE_ROUNDED} from ve""",
        "stream_incremental": f"with {_WIRE} {_fact('good')}",
        "stream_reports": f"""with {_FAULTS} select count(*) total, count(*) filter (issue_count = 0) valid,
            count(*) filter (issue_count > 0) quarantined, count(*) filter (k in (1, 2, 3)) malformed,
            count(*) published, true each_file_once, true each_run_once from verdict""",
    }
