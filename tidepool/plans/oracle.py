"""DuckDB SQL twins of :mod:`tidepool.plans.queries`, for the correctness check.

The views ``events``, ``conversations``, ... are the driver's parquet tables.
Derived inputs (log lines, status texts) are rebuilt here as CTEs with the
same rules as :mod:`tidepool.sources.fixtures`. Aggregates are cast to the
Spark result types (BIGINT counts, INTEGER ranks).
"""

from __future__ import annotations

# Spelled out here, not taken from the library: an error there must show.
PAT = r'(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})? (\S+) (\S+) (\[.+?\]) "(.*?)" (\d{3}) (\S+) "(.*?)" "(.*?)"'
FULL = r"\A" + PAT + r"\z"

LOGS = """logs as (
  select event_id, ts, user_id,
    case when event_id%17=0 then concat('malformed ', event_id) else concat(
      case when event_id%23=0 then '' else concat('10.0.0.', user_id%250) end,
      ' - u', user_id, ' [', strftime(ts,'%d/%b/%Y:%H:%M:%S'), ' +0000] "',
      case when event_id%13=0 then 'GET'
           when event_id%11=0 then ''
           when event_id%19=0 then 'GET /a b HTTP/1.1'
           else concat('GET /', event_type, ' HTTP/1.1') end, '" ',
      case when event_type='error' then 500+event_id%4
           when event_type='view' and day(ts)%5=0 then 503
           when event_type='signup' then 302 else 200 end,
      ' ', event_id%5000, ' "-" "agent-', event_id%7, '"') end as line
  from events)"""

PARSED = f"""p0 as (
  select event_id, ts, line, regexp_full_match(line, '{PAT}') as m from logs),
p as (
  select event_id, ts, m,
    case when m then nullif(regexp_extract(line, '{FULL}', 1), '') end as g_ip,
    case when m then regexp_extract(line, '{FULL}', 2) end as g_client,
    case when m then regexp_extract(line, '{FULL}', 3) end as g_user,
    case when m then regexp_extract(line, '{FULL}', 4) end as g_datetime,
    case when m then regexp_extract(line, '{FULL}', 5) end as g_request,
    case when m then regexp_extract(line, '{FULL}', 6) end as g_status,
    case when m then regexp_extract(line, '{FULL}', 7) end as g_bytes,
    case when m then regexp_extract(line, '{FULL}', 8) end as g_referer,
    case when m then regexp_extract(line, '{FULL}', 9) end as g_agent
  from p0),
q as (
  select *,
    string_split(rtrim(g_request), ' ') as toks,
    case when m then cast(g_status as integer) else 0 end as status_code
  from p),
r as (
  select *,
    case when not m then 'error' else coalesce(toks[2], '[error]') end as url_loose,
    case when not m then '[error]' when len(toks) = 3 then toks[2] else '[error]' end as url_strict,
    case when not m then '[error]' when len(toks) = 3 then toks[2] else '()' end as url_leak,
    case when status_code >= 200 and status_code < 300 then 'Success'
         when status_code >= 500 and status_code < 600 then 'Failure'
         else 'Other' end as status_class,
    case when m then g_ip else 'error' end as ip_row,
    case when m then g_agent else 'error' end as agent_row
  from q)"""

STATUSES = """statuses as (
  select event_id, ts,
    concat('#', event_type, ' the ', case when event_id%3=0 then 'My' else 'my' end, ' ', event_type,
           case when event_id%5=0 then ' #' else '' end, ' #k', event_id%12,
           case when event_id%7=0 then '  ' else '' end) as text
  from events)"""

WORDS = """words as (
  select ts, unnest(string_split(rtrim(text), ' ')) as word from statuses)"""

SEC = "cast(floor(epoch(ts)) as bigint)"
STOP = "'a', 'the', 'to', 'an', 'you', 'me', 'i', 'and', 'my', 'i''m', ''"
# UTF-16 length: code points plus one more for each astral character
U16 = "(length(text) + length(regexp_replace(text, '[^\\x{10000}-\\x{10FFFF}]', '', 'g')))"


KMEANS_BASE = """with c0 as (
  select list([value, cast(user_id as double)] order by event_id) as cs
  from (select event_id, value, user_id from events order by event_id limit 5)),
a0 as (
  select event_id, value, user_id,
    list_transform((select cs from c0),
      lambda c: (c[1] - value) * (c[1] - value) + (c[2] - user_id) * (c[2] - user_id)) as dd
  from events),
a1 as (
  select event_id, value, user_id, cast(list_position(dd, list_min(dd)) - 1 as integer) as cluster
  from a0)"""

REG_BASE = """with reg as (
  select l_orderkey, l_linenumber, l_extendedprice / 1000 as y, l_quantity as x from lineitem)"""


def _with(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


def _delta(src: str, key: str, window: int, keep_zero: bool) -> str:
    """Step-function windowed counts per key over ticks (t - window, t]."""
    where = "" if keep_zero else "where n <> 0"
    return f"""select * from (
  select {key}, tick,
    cast(sum(d) over (partition by {key} order by tick rows between unbounded preceding and current row)
         as bigint) as n
  from (select {key}, tick, sum(d) as d from (
          select {key}, {SEC} as tick, 1 as d from {src}
          union all
          select {key}, {SEC} + {window} as tick, -1 as d from {src})
        group by {key}, tick having sum(d) <> 0)) {where}"""


def _topk_ticks(src: str, key: str, window: int) -> str:
    """The top 10 over ticks (t - window, t] at each tick where that list changes; rank 0 for an empty list."""
    return f"""select tick, rank, {key}, n from (
  with step as ({_delta(src, key, window, True)}),
  held as (select *, lead(tick) over (partition by {key} order by tick) as until from step),
  ticks as (select distinct tick from step),
  ranked as (
    select t.tick, h.{key}, h.n, row_number() over (partition by t.tick order by h.n desc, h.{key}) as rank
    from ticks t join held h on h.n > 0 and h.tick <= t.tick and t.tick < h.until),
  lists as (
    select t.tick, coalesce(list({{'r': rank, 'k': r.{key}, 'n': r.n}} order by rank) filter (rank <= 10), []) as l
    from ticks t left join ranked r on r.tick = t.tick group by t.tick),
  changed as (select tick, l from lists qualify l <> coalesce(lag(l) over (order by tick), []))
  select tick, cast(e.r as integer) as rank, e.k as {key}, e.n from (select tick, unnest(l) as e from changed)
  union all
  select tick, 0, null, 0 from changed where len(l) = 0)"""


def _topk(src: str, key: str, window: int, slide: int, k: int = 10) -> str:
    copies = window // slide
    return f"""select window_start, window_start + {window} as window_end, {key}, n, rank from (
  select window_start, {key}, n,
    cast(row_number() over (partition by window_start order by n desc, {key}) as integer) as rank
  from (select window_start, {key}, cast(sum(n) as bigint) as n from (
          select {key}, b - k * {slide} as window_start, n from (
            select {key}, b, n, unnest(range(0, {copies})) as k from (
              select {key}, cast(floor(epoch(ts) / {slide}) as bigint) * {slide} as b, count(*) as n
              from {src} group by 1, 2)))
        group by window_start, {key}))
where rank <= {k}"""


def _wcounts(src: str, key: str, window: int, slide: int) -> str:
    """Counts per (window, key) for windows [start, start + window) every slide."""
    copies = window // slide
    return f"""select window_start, window_start + {window} as window_end, {key}, n from (
  select window_start, {key}, cast(sum(n) as bigint) as n from (
    select {key}, b - k * {slide} as window_start, n from (
      select {key}, b, n, unnest(range(0, {copies})) as k from (
        select {key}, cast(floor(epoch(ts) / {slide}) as bigint) * {slide} as b, count(*) as n
        from {src} group by 1, 2)))
  group by window_start, {key})"""


def _alarm_state(s: str, f: str) -> str:
    return (f"case when {s} + {f} <= 100 then 'quiet' when {f} > 0.5 * {s} then 'alarm' "
            f"else 'ok' end")


SESSIONS = """v as (
  select event_id, ts, ip_row as ip, url_loose as url from r),
g as (
  select *,
    case when lag(ts) over (partition by ip order by ts, event_id) is null
           or ts - lag(ts) over (partition by ip order by ts, event_id) > interval 30 minutes
         then 1 else 0 end as brk
  from v),
s as (
  select *, sum(brk) over (partition by ip order by ts, event_id
                           rows between unbounded preceding and current row) as sid
  from g),
t as (
  select *, row_number() over (partition by ip, sid order by ts, event_id) as rn from s),
u as (
  select ip, min(ts) as first_ts, max(ts) as last_ts, count(*) as requests,
    cast(count(*) filter (where rn <= 10) as integer) as clicks,
    string_agg(url, ' ' order by rn) filter (where rn <= 10) as clickstream
  from t group by ip, sid)"""

GAP_COLUMNS = """cast(floor(epoch(first_ts)) as bigint) as session_start,
  cast(floor(epoch(last_ts + interval 30 minutes)) as bigint) as session_end, requests"""


ORACLE = {
    "log_parse_records": _with(LOGS, PARSED) + """
select event_id, m as matched, ip_row as ip, url_loose as url, status_code as status,
  agent_row as user_agent, g_client as client, g_user as user_name, g_datetime as log_time,
  g_request as request, g_bytes as bytes, g_referer as referer
from r""",

    "log_url_strict_counts": _with(LOGS, PARSED) + """
select url_strict as url, count(*) as n from r group by 1""",

    "log_url_leak_counts": _with(LOGS, PARSED) + """
select url_leak as url, count(*) as n from r group by 1""",

    "log_status_class": _with(LOGS, PARSED) + """
select status_code as status, status_class, count(*) as n from r group by 1, 2""",

    "url_sliding_counts": _with(LOGS, PARSED, "u as (select ts, url_strict as url from r)")
    + _delta("u", "url", 300, True),

    "event_type_sliding_counts": "with u as (select ts, event_type from events)\n"
    + _delta("u", "event_type", 300, True),

    "url_window_topk": _with(LOGS, PARSED, "u as (select ts, url_strict as url from r)")
    + _topk("u", "url", 86400, 3600),

    "status_sliding_counts": _with(LOGS, PARSED, "u as (select ts, status_class from r)")
    + _delta("u", "status_class", 300, False),

    "error_rate_alarm": _with(LOGS, PARSED) + f"""
select window_start, window_start + 43200 as window_end, success, failure,
  {_alarm_state('success', 'failure')} as state
from (select window_start, cast(sum(s) as bigint) as success, cast(sum(f) as bigint) as failure
      from (select b - k * 3600 as window_start, s, f from (
              select b, s, f, unnest(range(0, 12)) as k from (
                select cast(floor(epoch(ts) / 3600) as bigint) * 3600 as b,
                  sum(case when status_class = 'Success' then 1 else 0 end) as s,
                  sum(case when status_class = 'Failure' then 1 else 0 end) as f
                from r group by 1)))
      group by window_start)""",

    "error_rate_alarm_ticks": _with(LOGS, PARSED, f"""c as (
  select {SEC} as sec,
    case when status_class = 'Success' then 1 else 0 end as s,
    case when status_class = 'Failure' then 1 else 0 end as f
  from r)""") + f"""
select tick, success, failure, {_alarm_state('success', 'failure')} as state from (
  select tick,
    cast(sum(s) over (order by tick rows between unbounded preceding and current row) as bigint) as success,
    cast(sum(f) over (order by tick rows between unbounded preceding and current row) as bigint) as failure
  from (select tick, sum(s) as s, sum(f) as f from (
          select sec as tick, s, f from c
          union all
          select sec + 300 as tick, -s, -f from c)
        group by tick having sum(s) <> 0 or sum(f) <> 0))""",

    "agent_batch_counts": _with(LOGS, PARSED) + """
select cast(floor(epoch(ts) / 86400) as bigint) as batch_id, agent_row as agent, count(*) as total
from r group by 1, 2""",

    "hashtag_sliding_counts": _with(STATUSES, WORDS,
                                    "tags as (select ts, word as tag from words where starts_with(word, '#'))")
    + _delta("tags", "tag", 300, True),

    "hashtag_topk": _with(STATUSES, WORDS,
                          "tags as (select ts, word as tag from words where starts_with(word, '#'))")
    + _topk("tags", "tag", 86400, 3600),

    "hashtag_topk_ticks": _with(STATUSES, WORDS,
                                "tags as (select ts, word as tag from words where starts_with(word, '#'))")
    + _topk_ticks("tags", "tag", 300),

    "url_topk_ticks": _with(LOGS, PARSED, "u as (select ts, url_strict as url from r)") + _topk_ticks("u", "url", 300),

    "word_topk": _with(STATUSES, WORDS,
                       f"cw as (select ts, word from words where lower(trim(word)) not in ({STOP}))")
    + _topk("cw", "word", 86400, 3600),

    "text_length_stats": f"""
select role, count(*) as n, cast(sum({U16}) as bigint) as total_chars,
  cast(sum({U16}) // count(*) as bigint) as avg_length,
  round(sum({U16}) / count(*), 6) as exact_avg_length, cast(max({U16}) as bigint) as longest
from conversations group by role""",

    "text_length_by_batch": _with(STATUSES) + f"""
select batch_id, n, chars, longest, total_n, total_chars, longest_all_time,
  total_chars // total_n as avg_length,
  round(total_chars / total_n, 6) as exact_avg_length
from (select batch_id, n, chars, longest,
        cast(sum(n) over (order by batch_id rows between unbounded preceding and current row) as bigint) as total_n,
        cast(sum(chars) over (order by batch_id rows between unbounded preceding and current row) as bigint) as total_chars,
        max(longest) over (order by batch_id rows between unbounded preceding and current row) as longest_all_time
      from (select cast(floor(epoch(ts) / 86400) as bigint) as batch_id, count(*) as n,
              cast(sum({U16}) as bigint) as chars, cast(max({U16}) as bigint) as longest
            from statuses group by 1))""",

    "saved_rows_running_total": _with(STATUSES) + """
select batch_id, rows, total_rows, (total_rows - rows) <= 100 as saved
from (select batch_id, rows,
        cast(sum(rows) over (order by batch_id rows between unbounded preceding and current row) as bigint) as total_rows
      from (select cast(floor(epoch(ts) / 86400) as bigint) as batch_id, count(*) as rows
            from statuses group by 1))""",

    "session_first10": _with(LOGS, PARSED, """v as (
  select event_id, ts, ip_row as ip, url_loose as url,
    row_number() over (partition by ip_row order by ts, event_id) as rn
  from r)""") + """
select ip, count(*) as session_length, cast(count(*) filter (where rn <= 10) as integer) as clicks,
  string_agg(url, ' ' order by rn) filter (where rn <= 10) as clickstream
from v group by ip""",

    "session_gap30": _with(LOGS, PARSED, SESSIONS) + f"""
select ip, {GAP_COLUMNS} from u""",

    "session_gap_first10": _with(LOGS, PARSED, SESSIONS) + f"""
select ip, {GAP_COLUMNS}, clicks, clickstream from u""",

    "stream_session_snapshot": _with(LOGS, PARSED, SESSIONS) + """
select ip, requests as session_length, clicks, clickstream
from u where last_ts + interval 30 minutes > (select max(ts) from r)""",

    "corpus_word_topk": f"""
select word, count(*) as n from (
  select unnest(string_split(rtrim(text, ' '), ' ')) as word
  from (select text from documents union all select text from conversations) where text is not null)
where regexp_replace(lower(word), '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')
  not in ({STOP})
group by word order by n desc, word limit 100""",

    "records_preview": _with(LOGS, PARSED) + """
select event_id, url_loose as url, status_code as status, agent_row as agent from r order by event_id limit 20""",

    "vector_parse": """
select event_id, 2 as dim, value as f0, cast(user_id as double) as f1 from events""",

    "labeled_point_parse": """
select event_id, 'tuple' as form, cast(event_id % 5 as double) as label, value as f0,
  cast(user_id as double) as f1, true as parse_ok
from events
union all
select event_id, 'legacy' as form, cast(event_id % 5 as double) as label, value as f0,
  cast(user_id as double) as f1, true as parse_ok
from events""",

    "kmeans_step": KMEANS_BASE + """
select cluster, count(*) as n, round(sum(value) / count(*), 6) as c_0,
  round(sum(cast(user_id as double)) / count(*), 6) as c_1
from a1 group by cluster""",

    "kmeans_predict": KMEANS_BASE + """,
u as (
  select cluster, count(*) as m, sum(value) as s0, sum(cast(user_id as double)) as s1
  from a1 group by cluster),
old as (
  select unnest(cs) as c, unnest(range(0, len(cs))) as i from c0),
c1 as (
  select list([case when u.m is null then old.c[1] else (1.0 / u.m) * u.s0 end,
               case when u.m is null then old.c[2] else (1.0 / u.m) * u.s1 end] order by old.i) as cs
  from old left join u on u.cluster = old.i),
a2 as (
  select event_id, cast(event_id % 5 as integer) as label,
    list_transform((select cs from c1),
      lambda c: (c[1] - value) * (c[1] - value) + (c[2] - user_id) * (c[2] - user_id)) as dd
  from events)
select event_id, label, cast(list_position(dd, list_min(dd)) - 1 as integer) as cluster from a2""",

    "linreg_moments": REG_BASE + """
select count(*) as n, round(sum(y * y), 2) as yy, round(sum(x * y), 2) as h_0,
  round(sum(x * x), 2) as g_0_0, round(sum(x), 2) as g_0_1, round(sum(y), 2) as h_1,
  round(cast(count(*) as double), 2) as g_1_1
from reg""",

    "linreg_fit": REG_BASE + """
select count(*) as n, round(regr_slope(y, x), 6) as slope, round(regr_intercept(y, x), 6) as intercept
from reg""",

    "linreg_predict": REG_BASE + """,
fit as (select regr_slope(y, x) as a, regr_intercept(y, x) as b from reg)
select l_orderkey, l_linenumber, cast(trunc(y) as integer) as label,
  round((select b from fit) + (select a from fit) * x, 6) as prediction
from reg""",

    "stream_url_window_counts": _with(LOGS, PARSED, "u as (select ts, url_strict as url from r)")
    + _wcounts("u", "url", 86400, 3600),

    "stream_session_first10": None,  # filled below: same as the batch twin

    "sink_json_roundtrip": _with(LOGS, PARSED) + """
select event_id, url_loose as url, status_code as status, agent_row as agent from r""",

    "sink_text_roundtrip": _with(STATUSES) + """
select text as value from statuses""",

    "sink_upsert": _with(LOGS, PARSED, """v as (
  select ip_row as ip, url_loose as url, status_code as status, agent_row as user_agent, event_id,
    row_number() over (partition by ip_row, url_loose order by ts desc, event_id desc) as rn
  from r)""") + """
select ip, url, status, user_agent, event_id from v where rn = 1""",
}
ORACLE["stream_session_first10"] = ORACLE["session_first10"]
# Streaming k-means replayed in SQL: the centre and weight lists are carried from
# daily batch to daily batch; each step assigns the batch's points, applies the
# weighted update and splits the largest cluster when one is dying.
ORACLE["kmeans_stream"] = """with recursive
pts as (
  select cast(floor(epoch(ts) / 86400) as bigint) as batch_id, value as v0,
    cast(user_id as double) as v1 from events),
bid as (select batch_id, row_number() over (order by batch_id) as r from (select distinct batch_id from pts)),
p as (select bid.r, pts.v0, pts.v1 from pts join bid using (batch_id)),
c0 as (
  select list([value, cast(user_id as double)] order by event_id) as cs
  from (select event_id, value, user_id from events order by event_id limit 5)),
s(r, cs, ws) as (
  select 0, cs, cast([0.0, 0.0, 0.0, 0.0, 0.0] as double[]) from c0
  union all
  select s.r + 1, u.cs, u.ws
  from s, lateral (
    select
      case when list_min(ws1) < 1e-8 * list_max(ws1) then
        list_transform(range(5), lambda j:
          case when j + 1 = list_position(ws1, list_max(ws1))
                 then list_transform(cs1[j + 1], lambda x: x + 1e-14 * greatest(abs(x), 1.0))
               when j + 1 = list_position(ws1, list_min(ws1))
                 then list_transform(cs1[list_position(ws1, list_max(ws1))],
                                     lambda x: x - 1e-14 * greatest(abs(x), 1.0))
               else cs1[j + 1] end)
      else cs1 end as cs,
      case when list_min(ws1) < 1e-8 * list_max(ws1) then
        list_transform(range(5), lambda j:
          case when j + 1 = list_position(ws1, list_max(ws1)) or j + 1 = list_position(ws1, list_min(ws1))
               then (list_max(ws1) + list_min(ws1)) / 2.0 else ws1[j + 1] end)
      else ws1 end as ws
    from (
      select
        list_transform(range(5), lambda j:
          case when len(list_filter(agg, lambda a: a.k = j)) = 0 then s.cs[j + 1]
               else [ (1.0 - list_filter(agg, lambda a: a.k = j)[1].m
                             / greatest(s.ws[j + 1] + list_filter(agg, lambda a: a.k = j)[1].m, 1e-16))
                        * s.cs[j + 1][1]
                      + (list_filter(agg, lambda a: a.k = j)[1].m
                             / greatest(s.ws[j + 1] + list_filter(agg, lambda a: a.k = j)[1].m, 1e-16)
                         / list_filter(agg, lambda a: a.k = j)[1].m) * list_filter(agg, lambda a: a.k = j)[1].s0,
                      (1.0 - list_filter(agg, lambda a: a.k = j)[1].m
                             / greatest(s.ws[j + 1] + list_filter(agg, lambda a: a.k = j)[1].m, 1e-16))
                        * s.cs[j + 1][2]
                      + (list_filter(agg, lambda a: a.k = j)[1].m
                             / greatest(s.ws[j + 1] + list_filter(agg, lambda a: a.k = j)[1].m, 1e-16)
                         / list_filter(agg, lambda a: a.k = j)[1].m) * list_filter(agg, lambda a: a.k = j)[1].s1 ]
          end) as cs1,
        list_transform(range(5), lambda j:
          s.ws[j + 1] + coalesce(list_sum(list_transform(list_filter(agg, lambda a: a.k = j), lambda a: a.m)), 0.0)) as ws1
      from (
        select list({'k': k, 'm': cast(m as double), 's0': s0, 's1': s1}) as agg from (
          select k, count(*) as m, sum(v0) as s0, sum(v1) as s1 from (
            select cast(list_position(dd, list_min(dd)) - 1 as integer) as k, v0, v1 from (
              select v0, v1, list_transform(s.cs, lambda c: (c[1] - v0) * (c[1] - v0) + (c[2] - v1) * (c[2] - v1)) as dd
              from p where p.r = s.r + 1))
          group by k))
    )
  ) u
  where s.r < (select max(r) from bid))
select bid.batch_id, cast(j - 1 as integer) as cluster, s.ws[j] as weight,
  round(s.cs[j][1], 6) as c_0, round(s.cs[j][2], 6) as c_1
from s join bid on bid.r = s.r, (select unnest(range(1, 6)) as j)
"""
# Streaming SGD replayed in SQL: per-batch moments, then 50 gradient steps per
# batch (step 0.1/sqrt(i), stop when the change is below 0.001 of the weights'
# norm), weights carried from batch to batch.
ORACLE["linreg_sgd_stream"] = """with recursive
reg as (
  select l_extendedprice / 1000 as y, l_quantity as x,
    cast(floor(epoch(l_shipdate) / 31536000) as bigint) as batch_id from lineitem),
st as (select avg(x) as mu, stddev_pop(x) as sd from reg),
z as (select batch_id, y, (x - (select mu from st)) / (select sd from st) as xs from reg),
m as (
  select batch_id, count(*) as n, sum(xs * xs) as g00, sum(xs * 1.0) as g01,
    sum(1.0 * 1.0) as g11, sum(xs * y) as h0, sum(1.0 * y) as h1,
    row_number() over (order by batch_id) as r
  from z group by batch_id),
s(r, i, w, b, fin) as (
  select 1, 0, cast(0.0 as double), cast(0.0 as double), false
  union all
  select m.r,
    case when s.fin then 0 else s.i + 1 end,
    case when s.fin then s.w
         else s.w - (0.1 / sqrt(s.i + 1)) * ((m.g00 * s.w + m.g01 * s.b - m.h0) / m.n) end,
    case when s.fin then s.b
         else s.b - (0.1 / sqrt(s.i + 1)) * ((m.g01 * s.w + m.g11 * s.b - m.h1) / m.n) end,
    case when s.fin then false
         else (s.i + 1 = 50) or (s.i + 1 >= 2 and
           sqrt((s.w - (s.w - (0.1 / sqrt(s.i + 1)) * ((m.g00 * s.w + m.g01 * s.b - m.h0) / m.n)))
              * (s.w - (s.w - (0.1 / sqrt(s.i + 1)) * ((m.g00 * s.w + m.g01 * s.b - m.h0) / m.n)))
              + (s.b - (s.b - (0.1 / sqrt(s.i + 1)) * ((m.g01 * s.w + m.g11 * s.b - m.h1) / m.n)))
              * (s.b - (s.b - (0.1 / sqrt(s.i + 1)) * ((m.g01 * s.w + m.g11 * s.b - m.h1) / m.n))))
           < 0.001 * greatest(sqrt(
               (s.w - (0.1 / sqrt(s.i + 1)) * ((m.g00 * s.w + m.g01 * s.b - m.h0) / m.n))
             * (s.w - (0.1 / sqrt(s.i + 1)) * ((m.g00 * s.w + m.g01 * s.b - m.h0) / m.n))
             + (s.b - (0.1 / sqrt(s.i + 1)) * ((m.g01 * s.w + m.g11 * s.b - m.h1) / m.n))
             * (s.b - (0.1 / sqrt(s.i + 1)) * ((m.g01 * s.w + m.g11 * s.b - m.h1) / m.n))), 1.0))
    end
  from s join m on m.r = s.r + case when s.fin then 1 else 0 end)
select m.batch_id, m.n, round(s.w, 6) as weight, round(s.b, 6) as intercept
from s join m on m.r = s.r
where s.fin"""
ORACLE["stream_kmeans_predict"] = ORACLE["kmeans_predict"]
ORACLE["stream_url_sliding_counts"] = ORACLE["url_sliding_counts"]
ORACLE["stream_error_rate_alarm_ticks"] = ORACLE["error_rate_alarm_ticks"]
ORACLE["stream_session_gap_first10"] = ORACLE["session_gap_first10"]
ORACLE["stream_agent_batch_counts"] = ORACLE["agent_batch_counts"]
ORACLE["stream_kmeans_step"] = ORACLE["kmeans_stream"]
ORACLE["stream_hashtag_topk"] = ORACLE["hashtag_topk"]
ORACLE["stream_hashtag_topk_ticks"] = ORACLE["hashtag_topk_ticks"]
ORACLE["stream_error_rate_alarm"] = ORACLE["error_rate_alarm"]
ORACLE["stream_text_metrics"] = f"""select batch_id, total_n as counter, avg_length, longest as longest_in_batch
from ({ORACLE['text_length_by_batch']})"""
ORACLE["stream_alarm_messages"] = f"""
select window_start, concat('Total success: ', success, ' Total failure: ', failure) as totals_message,
  case state when 'alarm' then 'Wake somebody up! Something is horribly wrong.'
             when 'ok' then 'All systems go.' end as alarm_message
from ({ORACLE['error_rate_alarm']})"""
# The reference's rule: the intercept is 1 at the start of each batch.
ORACLE["linreg_sgd_reference"] = ORACLE["linreg_sgd_stream"].replace(
    "select 1, 0, cast(0.0 as double), cast(0.0 as double), false",
    "select 1, 0, cast(0.0 as double), cast(1.0 as double), false").replace(
    "case when s.fin then s.b\n", "case when s.fin then 1.0\n")
ORACLE["stream_status_file_hashtags"] = _with(STATUSES, WORDS) + """
select cast(floor(epoch(ts) / 86400) as bigint) as batch_id, word as tag, count(*) as n
from words where starts_with(word, '#') group by 1, 2"""
ORACLE["stream_text_line_points"] = """
select cast(event_id % 5 as double) as label, value as f0, cast(user_id as double) as f1, true as parse_ok from events"""
ORACLE["stream_session_state"] = ORACLE["session_gap_first10"]
ORACLE["stream_session_state_snapshot"] = ORACLE["stream_session_snapshot"]
ORACLE["stream_url_ring_counts"] = ORACLE["url_sliding_counts"]
ORACLE["stream_tail_url_counts"] = ORACLE["log_url_strict_counts"]
ORACLE["sink_committed_rows"] = ORACLE["sink_json_roundtrip"]
ORACLE["linreg_fit_shifted"] = REG_BASE + """
select count(*) as n, round(regr_slope(y, x + 1e9), 6) as slope, round(avg(y), 6) as mean_y from reg"""
