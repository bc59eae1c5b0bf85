"""DuckDB SQL each query's result must equal; values come from the columns, never from log text."""

from __future__ import annotations

from accesslake.workload import inputs as I

EV = "ev as (" + I.EV.format(events="events") + ")"
OW = "ow as (" + I.OW.format(orders="orders") + ")"
CAT = "cat as (" + I.CATALOG.format(part="part") + ")"
LST = "lst as (" + I.LISTING.format(part="part") + ")"
USED = f"used as (select distinct cast(l_partkey as varchar) as did from lineitem where {I.DOWNLOADED})"

SEC = "date_trunc('second', ts)"
STATUS = "try_cast(st as integer)"
BYTES = "try_cast(bs as bigint)"
SIZE = "try_cast(sz as bigint)"
LOGTIME = "strftime({c}, '%d/%b/%Y:%H:%M:%S')"
CLASS = f"""case
  when op in ('REST.GET.OBJECT', 'WEBSITE.GET.OBJECT')
    then case when {STATUS} is null or {STATUS} in (200, 206) then 'DOWNLOAD' else 'BAD' end
  when op = 'REST.PUT.OBJECT' then case when {STATUS} between 400 and 499 then 'BLOCKED' else 'UPLOAD' end
  when op = 'REST.DELETE.OBJECT' then 'DELETED'
  when op = 'REST.HEAD.OBJECT' then 'MISC'
  else 'UNKNOWN' end"""
BUCKET_LINE = (
    "concat('own bkt [', " + LOGTIME.format(c="ts") + ", ' +0000] ', ip, ' - R', cast(event_id as varchar), ' ', op, ' ', "
    "replace(k, ' ', '%2520'), ' \"GET /x HTTP/1.1\" ', st, ' - ', bs, ' ', sz, ' 1 - \"-\" \"', ua, '\" - H - C - d T')"
)
ORDER_LINE = (
    "concat(ip, ' - - [', " + LOGTIME.format(c="wall") + ", ' -0700] \"GET ', path, ' HTTP/1.1\" 200 ', "
    "cast(bytes as varchar), ' \"-\" \"o\"')"
)
REC = (
    f"{EV}, rec as (select *, {SEC} as dtime, cast(ts as date) as dt, {STATUS} as http_status, {BYTES} as bytes_sent, "
    f"{SIZE} as object_size, {CLASS} as class from ev)"
)
DL = f"{REC}, dl as (select * from rec where class = 'DOWNLOAD')"
DAILY = f"""{DL}, daily as (select k, ip, ua, dt, cast(sum(bytes_sent) as bigint) as bytes_sent
  from dl group by k, ip, ua, dt)"""
FACT = "k as s3key, ua as user_agent, ip as remote_ip, dtime, bytes_sent, false as summary"
SUMMED = (
    "k as s3key, ua as user_agent, ip as remote_ip, cast(dt as timestamp) as dtime, bytes_sent, true as summary"
)
WEBSTATUS = "case when st = '-' then 200 else cast(st as integer) end"
WEBURL = "concat('/', replace(k, ' ', '_'), '?q=1')"
COPIES = "case when o_orderpriority = '1-URGENT' then 3 else 1 end"
# Action per listed key.
PLAN = f"""{CAT}, {LST}, plan as (
  select lst.*, case when c.s3key is null or c.etag is null or c.etag <> lst.etag then 'hash'
    when c.mtime = lst.mtime then 'keep' else 'touch_mtime' end as action
  from lst left join (select * from cat where sha2_256 is not null and sha3_256 is not null) c on c.s3key = lst.s3key)"""
VANISHED = f"{CAT}, {LST}, {USED}, gone as (select * from cat where s3key not in (select s3key from lst))"

SQL: dict[str, str] = {
    "scan_log_lines": f"with {EV} select {BUCKET_LINE} as line, strftime(ts, '%Y-%m-%d') as day from ev",
    "archive_lines_by_year": f"with {OW} select cast(year(wall) as integer) as year, {ORDER_LINE} as line from ow",
    "export_catalog_json": f"with {CAT} select s3key, etag, sha2_256, bytes from cat",
    "parse_web_log": f"""with {EV} select ip as remote_ip, '-' as ident, 'bob' as user,
        {SEC} + interval 7 hour as dtime, {SEC} as dtime_local,
        concat('GET ', {WEBURL}, ' HTTP/1.1') as request, 'GET' as method, {WEBURL} as url,
        concat('/', replace(k, ' ', '_')) as key, {WEBSTATUS} as http_status, {BYTES} as bytes_sent,
        case when event_type <> 'signup' then 'http://ref/' end as referrer,
        case when event_type <> 'signup' then ua end as user_agent, 'WEBSITE.GET.OBJECT' as operation from ev""",
    "parse_s3_log": f"""with {REC} select 'own' as bucket_owner, 'bkt' as bucket, dtime, dtime as dtime_local,
        ip as remote_ip, '-' as requester, concat('R', cast(event_id as varchar)) as request_id, op as operation,
        k as key, 'GET /x HTTP/1.1' as request_uri, http_status, bytes_sent, object_size, ua as user_agent from rec""",
    "parse_log_time": f"""with {OW} select o_orderkey,
        case when o_orderpriority = '5-LOW' then 'no date'
          else concat(strftime(wall, '%d/%b/%Y %H:%M:%S'), ' -0400') end as cleaned,
        case when o_orderpriority <> '5-LOW' then wall + interval 4 hour end as dtime,
        case when o_orderpriority <> '5-LOW' then wall end as dtime_local from ow""",
    "parse_lenient_times": f"""with {OW}, t as (select o_orderkey % 7 as n, cast(o_orderkey as varchar) as number, wall,
          date_trunc('minute', wall) as minute, cast(cast(wall as date) as timestamp) as day from ow)
        select number, case n when 6 then 'time' end as parse_error,
          case n when 0 then wall + interval 7 hour when 1 then wall + interval 250 millisecond when 4 then minute - interval 2 hour
            when 5 then day when 6 then null else wall end as dtime,
          case n when 1 then wall + interval 250 millisecond when 4 then minute when 5 then day when 6 then null else wall end as dtime_local
        from t""",
    "safe_int": f"""with {EV} select event_id, {BYTES} as bytes_sent, {STATUS} as http_status,
        case when event_type <> 'view' then {SIZE} end as object_size from ev""",
    "quarantine_bad_lines": f"""with {EV}, l as (select *, {BUCKET_LINE} as line from ev)
        select case event_type
            when 'error' then array_to_string(list_slice(string_split(line, ' '), 1, 9), ' ')
            when 'signup' then replace(line, '/2024:', '/20x4:')
            when 'purchase' then replace(line, 'HTTP/1.1" ', 'HTTP/1.1" 9" ') else line end as line,
          case event_type when 'error' then 'fields' when 'signup' then 'time' when 'purchase' then 'status' end
            as parse_error from l""",
    "decode_keys": "select doc_id, text as key from documents",
    "url_path": r"""select page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(url,
        '^[A-Za-z][A-Za-z0-9+.\-]*:', ''), '^//[^/?#]*', ''), '[?#][\s\S]*$', ''), ';[^/]*$', '') as path
        from pages""",
    "split_request": """select page_id, case when page_id % 5 = 0 then 'HEAD' else 'GET' end as method,
        case when page_id % 5 <> 0 then url end as url from pages""",
    "wikipage": f"""with {EV} select event_id, case event_type
        when 'view' then concat('Page_', cast(user_id as varchar)) when 'click' then concat('T', cast(user_id as varchar))
        when 'signup' then '' end as page from ev""",
    "is_download": f"""with {EV} select event_id,
        event_type not in ('signup', 'click') and user_id % 3 < 2 as is_download from ev""",
    "unify_logs": f"""with {REC} select 'bucket' as source, dtime, dtime as dtime_local, ip as remote_ip, op as operation,
        k as key, http_status, bytes_sent, object_size, ua as user_agent,
        concat('R', cast(event_id as varchar)) as request_id, null as method from rec
        union all select 'web', dtime + interval 7 hour, dtime, ip, 'WEBSITE.GET.OBJECT',
        concat('/', replace(k, ' ', '_')), {WEBSTATUS}, bytes_sent, bytes_sent,
        case when event_type <> 'signup' then ua end, null, 'GET' from rec""",
    "nonblank_lines": f"with {EV} select {BUCKET_LINE} as line from ev where event_type <> 'signup'",
    "filter_year": f"""with {OW} select ip as remote_ip, path as key, wall as dtime_local,
        wall + interval 7 hour as dtime from ow where year(wall) = 1998""",
    "drop_ignored_keys": f"""with {EV} select concat('R', cast(event_id as varchar)) as request_id, k as key from ev
        where user_id not in (select c_custkey from customer where c_mktsegment = 'BUILDING')""",
    "classify_records": f"""with {REC} select concat('R', cast(event_id as varchar)) as request_id, op as operation,
        http_status, class from rec""",
    "downloads_only": f"with {DL} select concat('R', cast(event_id as varchar)) as request_id, k as key, bytes_sent from dl",
    "hashed_under_prefix": f"""with {CAT} select s3key, etag from cat
        where s3key like 'corpora/1%' and sha2_256 is not null and sha3_256 is not null""",
    "dedup_lines": f"with {EV} select {BUCKET_LINE} as line, cast({I.REPEATS} as bigint) as n from ev",
    "merge_logs": f"""with {OW} select {ORDER_LINE} as line, wall + interval 7 hour as dtime from ow
        where year(wall) = 1998""",
    "merge_report": f"""with {OW}, l as (select *, year(wall) = 1998 as kept, {COPIES} as n from ow)
        select cast(count(*) filter (kept) + sum(n - 1) as bigint) as total_read, cast(sum(n - 1) as bigint) as dups,
        count(*) filter (not kept) as filtered, min(wall) filter (kept) + interval 7 hour as earliest,
        max(wall) filter (kept) + interval 7 hour as latest, count(*) filter (kept) as written from l""",
    "upsert_catalog": f"""with {DL}, first as (select k, object_size,
          row_number() over (partition by k order by dtime, object_size nulls first) as rn from dl)
        select distinct k as s3key, cast(0 as bigint) as bytes from ev where k like '%.E01'
        union all select k, object_size from first where rn = 1 and k not like '%.E01'""",
    "upsert_user_agents": f"""with {DL} select distinct ua as user_agent from ev where ua = 'agent (0) x'
        union select distinct ua from dl""",
    "load_downloads": f"with {DL} select {FACT} from dl",
    "load_downloads_by_lookup": f"with {DL} select {FACT} from dl",
    "upsert_catalog_collated": f"""with {DL}, first as (select case when event_type = 'click' then upper(k) else k end as k,
          object_size, row_number() over (partition by k order by dtime,
            case when event_type = 'click' then upper(k) else k end, object_size nulls first) as rn from dl)
        select distinct k as s3key, cast(0 as bigint) as bytes from ev where k like '%.E01'
        union all select k, object_size from first where rn = 1 and upper(k) not like '%.E01'""",
    "load_downloads_collated": f"with {DL} select {FACT} from dl",
    "unify_normalized_keys": f"""with {REC} select 'bucket' as source, k as key, count(*) as n from rec group by k
        union all select 'web', replace(k, ' ', '_'), count(*) from rec group by k""",
    "copy_missing_downloads": """select c_name as key, o_orderpriority as remote_ip, o_orderdate as dtime,
        max(cast(c_nationkey as bigint)) as object_size, max(o_orderkey) as bytes_sent
        from orders s join customer on c_custkey = o_custkey
        where not exists (select 1 from orders t where t.o_orderstatus <> 'O' and t.o_custkey = s.o_custkey
          and t.o_orderpriority = s.o_orderpriority and t.o_orderdate = s.o_orderdate)
        group by c_name, o_orderpriority, o_orderdate""",
    "digest_index_upsert": """with d as (select sha256(text) as sha256, doc_id, lang from documents),
        old as (select sha256, max(doc_id) as doc_id, 'old' as note from d where lang = 'en' group by 1),
        new as (select sha256, max(doc_id) as doc_id, 'new' as note from d
          where doc_id in (select doc_id from labels) group by 1)
        select * from old where sha256 not in (select sha256 from new) union all select * from new""",
    "digest_index_delete": """with d as (select sha256(text) as sha256, doc_id from documents)
        select sha256, min(doc_id) as doc_id from d where sha256 not in
          (select sha256 from d where doc_id in (select doc_id from labels where toxic = 1)) group by sha256""",
    "plan_hashing": f"with {PLAN} select s3key, action from plan",
    "refresh_mtime": f"""with {PLAN} select cat.s3key, coalesce(p.mtime, cat.mtime) as mtime
        from cat left join (select * from plan where action = 'touch_mtime') p on p.s3key = cat.s3key""",
    "register_objects": f"""with {CAT}, {LST} select lst.s3key, case when cat.s3key is null then 'insert'
        when cat.etag = lst.etag and sha2_256 is not null and sha3_256 is not null then 'skip' else 'rehash' end as outcome
        from lst left join cat on cat.s3key = lst.s3key""",
    "apply_hashes": f"""with {PLAN} select cat.s3key,
        case when p.s3key is null then cat.etag else p.etag end as etag,
        case when p.s3key is null then cat.mtime else p.mtime end as mtime,
        case when p.s3key is null then cat.bytes else p.bytes end as bytes,
        case when p.s3key is null then sha2_256 else sha256(p.s3key) end as sha2_256,
        case when p.s3key is null then sha3_256 else sha256(p.etag) end as sha3_256
        from cat left join (select * from plan where action = 'hash') p on p.s3key = cat.s3key""",
    "gc_missing": f"with {CAT}, {LST} select s3key from lst where s3key not in (select s3key from cat)",
    "gc_vanished": f"with {VANISHED} select s3key from gone",
    "gc_deletable": f"with {VANISHED} select s3key from gone where id not in (select did from used)",
    "gc_mark_absent": f"""with {VANISHED} select s3key, s3key not in (select s3key from gone) as present from cat
        where s3key not in (select s3key from gone) or id in (select did from used)""",
    "gc_report": f"""with {VANISHED}, g as (select id in (select did from used) as used from gone)
        select (select count(*) from cat) as n_catalog, (select count(*) from lst) as n_listed,
        (select count(*) from lst where s3key not in (select s3key from cat)) as n_missing,
        (select count(*) from g) as n_vanished, (select count(*) from g where used) as n_downloaded,
        (select count(*) from g where not used) as n_not_downloaded,
        (select count(*) from g where not used) as n_deleted, (select count(*) from g where used) as n_kept""",
    "hash_sha2": "select doc_id, sha256(text) as sha2_256 from documents",
    "class_counts": f"with {REC} select class, count(*) as n from rec group by class",
    "time_bounds": f"with {REC} select min(dtime) as earliest, max(dtime) as latest from rec",
    "dates_seen": f"with {REC} select distinct strftime(dt, '%Y-%m-%d') as day from rec",
    "batch_bounds": f"""with {REC}, idx as (select *,
          row_number() over (partition by dt order by event_id) - 1 as i from rec),
        step as (select dt, greatest(1, cast(ceil(i / 100.0) as bigint)) as step, min(dtime) as lo, max(dtime) as hi,
          max(case when i = greatest(1, cast(ceil(i / 100.0) as bigint)) * 100 then 1 else 0 end) as closes
          from idx where event_type <> 'signup' group by 1, 2),
        ends as (select dt, step from step where closes = 1)
        select strftime(dt, '%Y-%m-%d') as day, batch * 100 as processed, min(lo) as earliest, max(hi) as latest
        from (select s.*, (select min(e.step) from ends e where e.dt = s.dt and e.step >= s.step) as batch from step s)
        where batch is not null group by dt, batch""",
    "ingest_counters": f"""with {REC} select count(distinct dt) as n_objects, count(*) as n_records,
        count(*) filter (class = 'DOWNLOAD') as n_downloads, min(dtime) filter (class = 'DOWNLOAD') as earliest,
        max(dtime) filter (class = 'DOWNLOAD') as latest from rec""",
    "daily_rollup": f"with {DAILY} select k as s3key, ip as remote_ip, ua as user_agent, strftime(dt, '%Y-%m-%d') as dt, bytes_sent from daily",
    "rollup_savings": f"""with {DAILY}, r as (select dt, count(*) as raw from dl group by dt),
        g as (select dt, count(*) as groups from daily group by dt)
        select strftime(dt, '%Y-%m-%d') as dt, raw + groups as rows_before, groups + groups as rows_after, raw - groups as saved
        from r join g using (dt)""",
    "rollup_range": f"""with {DAILY} select {FACT} from dl where dt not between date '2024-01-05' and date '2024-01-20'
        union all select {SUMMED} from daily where dt between date '2024-01-05' and date '2024-01-20'""",
    "rollup_compact": f"""with {DAILY} select {FACT} from dl where dt not between date '2024-01-05' and date '2024-01-20'
        union all select k, ua, ip, cast(dt as timestamp),
          case when dt <= date '2024-01-10' then 2 * bytes_sent else bytes_sent end, true
        from daily where dt between date '2024-01-05' and date '2024-01-20'""",
    "rollup_bounds": f"with {DL} select strftime(min(dt), '%Y-%m-%d') as first_day, strftime(max(dt), '%Y-%m-%d') as last_day from dl where dt > date '2024-01-10'",
    "year_rollover": f"with {DAILY} select {SUMMED} from daily",
    "store_stats": f"""with {DL} select (select count(distinct k) from ev) as n_files, count(*) as n_downloads,
        min(dtime) as earliest, max(dtime) as latest from dl""",
    "popular_downloads": f"""with {DL}, p as (select * from (values ('day', 1), ('week', 7), ('month', 30), ('year', 365))
          as t(period, days)),
        c as (select period, k as key, count(*) as n, cast(coalesce(sum(bytes_sent), 0) as bigint) as bytes
          from dl join p on dt > date '2024-01-30' - cast(days as integer) and dt <= date '2024-01-30' group by 1, 2),
        r as (select *, cast(row_number() over (partition by period order by n desc, key) as integer) as rank from c)
        select key, period, n, bytes, rank from r where rank <= 10""",
    "downloads_by_size": f"""with {DL} select case when object_size is null then 'unknown'
        when object_size < 1000 then 'under_1k' when object_size < 10000 then 'under_10k'
        when object_size < 1000000 then 'under_1m' when object_size < 1000000000 then 'under_1g'
        else '1g_and_more' end as size_class, count(*) as n, cast(sum(bytes_sent) as bigint) as bytes
        from dl group by 1""",
    "downloads_by_tag": rf"""with {DL} select regexp_extract(props, '"k": (\d+)', 1) as tag, count(*) as n,
        cast(sum(bytes_sent) as bigint) as bytes from dl group by 1""",
    "stream_ingest": f"with {DL} select {FACT} from dl",
    "stream_resume": f"with {DL} select {FACT} from dl",
    "stream_late_reroll": f"with {DAILY} select k as s3key, ip as remote_ip, ua as user_agent, strftime(dt, '%Y-%m-%d') as dt, bytes_sent from daily",
    "stream_dedup": f"with {REC} select {BUCKET_LINE} as line, dtime from rec",
    "stream_daily_rollup": f"with {DAILY} select k as s3key, ip as remote_ip, ua as user_agent, strftime(dt, '%Y-%m-%d') as dt, bytes_sent from daily",
    "stream_daily_rollup_folded": f"with {DAILY} select k as s3key, ip as remote_ip, ua as user_agent, strftime(dt, '%Y-%m-%d') as dt, bytes_sent from daily",
    "stream_class_counts": f"with {REC} select class, count(*) as n from rec group by class",
}

