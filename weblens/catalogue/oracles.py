"""The SQL each registered query is checked against, over the given tables.

It computes from the base columns, without the detour over raw lines, so it checks the parsers as well as
the operators. Definitions of the derived inputs are in ``FIXTURES.md``.
"""

from __future__ import annotations

DAY = "20240105"

_TIME = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
_DAY = "strftime(ts, '%Y%m%d')"
_IP = ("'10.' || (user_id // 65536 % 256)::VARCHAR || '.' || (user_id // 256 % 256)::VARCHAR"
       " || '.' || (user_id % 256)::VARCHAR")
_REGION = "CASE WHEN user_id < 160 THEN 'R' || (user_id // 10)::VARCHAR END"

# Clean access rows. An error event never gives one.
_ACCESS = f"""access AS (
  SELECT 'http://www.example.com/' || CASE event_type
           WHEN 'view' THEN 'video/' || user_id::VARCHAR
           WHEN 'purchase' THEN 'video/' || (user_id % 20)::VARCHAR
           WHEN 'click' THEN 'article/' || user_id::VARCHAR
           ELSE 'user' END AS url,
         CASE WHEN event_type IN ('view', 'purchase') THEN 'video'
              WHEN event_type = 'click' THEN 'article' ELSE '' END AS "cmsType",
         CASE event_type WHEN 'view' THEN user_id WHEN 'purchase' THEN user_id % 20
                         WHEN 'click' THEN user_id ELSE 0 END::BIGINT AS "cmsId",
         floor(value * 100)::BIGINT AS traffic,
         {_IP} AS ip,
         {_REGION} AS city,
         {_TIME} AS time,
         {_DAY} AS day
  FROM events WHERE event_type <> 'error')"""

_STATS = f"""{_ACCESS},
video AS (SELECT * FROM access WHERE "cmsType" = 'video'),
city_counts AS (SELECT day, city, "cmsId", count(*) AS times FROM video GROUP BY ALL),
city_ranks AS (
  SELECT *, row_number() OVER (PARTITION BY day, city ORDER BY times DESC, "cmsId")::INT AS times_rank
  FROM city_counts),
stat AS (
  SELECT 'day_video_access_topn_stat' AS stat_table, day, "cmsId" AS cms_id, NULL::VARCHAR AS city,
         count(*) AS times, NULL::INT AS times_rank, NULL::BIGINT AS traffics
  FROM video GROUP BY day, "cmsId"
  UNION ALL
  SELECT 'day_video_city_access_topn_stat', day, "cmsId", city, times, times_rank, NULL
  FROM city_ranks WHERE times_rank <= 3
  UNION ALL
  SELECT 'day_video_traffics_topn_stat', day, "cmsId", NULL, NULL, NULL, sum(traffic)::BIGINT
  FROM video GROUP BY day, "cmsId")"""

_VIDEO_ACCESS = f"""WITH {_STATS}
SELECT day, "cmsId", count(*) AS times FROM video GROUP BY day, "cmsId" ORDER BY times DESC"""

_PV_UV = """SELECT strftime(ts, '%Y-%m-%d') AS date,
  count(*) FILTER (event_type <> 'signup') AS pv,
  count(DISTINCT user_id) FILTER (event_type <> 'error') AS uv
FROM events GROUP BY 1"""

_TRIPS = """trips AS (
  SELECT user_id::INT AS id, '30.' || floor(value)::BIGINT::VARCHAR AS lat,
         '104.' || user_id::VARCHAR AS lon, strftime(ts, '%H:%M:%S') AS time FROM events)"""

_TAXI_COUNTS = f"""{_TRIPS}, counts AS (
  SELECT id, substring(time, 1, 2) AS hour, count(*) AS count FROM trips GROUP BY ALL)"""

_TAXI_TOPN = f"""WITH {_TAXI_COUNTS}
SELECT * FROM (
  SELECT id, hour, count, row_number() OVER (PARTITION BY hour ORDER BY count DESC, id)::INT AS rank
  FROM counts) WHERE rank <= 5"""


def _topk(value: str) -> str:
    return f"""pairs AS (
  SELECT l_returnflag || l_linestatus AS key, floor({value})::INT AS value FROM lineitem),
top AS (
  SELECT key, value, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY value DESC)::INT AS rank FROM pairs)
  WHERE rank <= 3)"""


def _topk_lists(value: str) -> str:
    return (f"WITH {_topk(value)} SELECT key, string_agg(value::VARCHAR, ',' ORDER BY rank) AS values"
            " FROM top GROUP BY key")


_LINES = """lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)"""


def _plain(line: str) -> str:
    return f"regexp_replace(lower({line}), '[;；.!'',]', '', 'g')"


def _tokens(line: str) -> str:
    """Split on spaces without trailing empty tokens; an empty line has one empty token."""
    return (f"CASE WHEN {line} = '' THEN [''] WHEN rtrim({line}, ' ') = '' THEN []::VARCHAR[] "
            f"ELSE string_split(rtrim({line}, ' '), ' ') END")


_EMP = """emp AS (SELECT c_custkey AS empno, c_name AS ename, c_nationkey AS deptno, c_acctbal AS sal
  FROM customer)"""
_EMP_DEPT = f"""WITH {_EMP} SELECT n_name AS dname, emp.* FROM emp JOIN nation ON deptno = n_nationkey"""

_CLICKS = f"""clicks AS (
  SELECT {_IP} AS ip, strftime(ts, '%Y%m%d%H%M%S') AS time,
         CASE WHEN event_type IN ('view', 'click', 'signup') THEN user_id ELSE 0 END::INT AS "courseId",
         CASE event_type WHEN 'signup' THEN 404 WHEN 'error' THEN 500 ELSE 200 END::INT AS "statusCode",
         CASE event_type WHEN 'view' THEN 'http://cn.bing.com/search?q=x'
              WHEN 'click' THEN 'https://www.sogou.com/web?query=x'
              WHEN 'purchase' THEN 'https://www.sogou.com'
              WHEN 'signup' THEN '-' ELSE 'https://m.example.org/a/b' END AS referer,
         CASE event_type WHEN 'view' THEN 'cn.bing.com' WHEN 'click' THEN 'www.sogou.com'
              WHEN 'error' THEN 'm.example.org' ELSE '' END AS host,
         {_DAY} AS day, user_id
  FROM events)"""
_COURSES = f"""{_CLICKS}, courses AS (
  SELECT day || '_' || "courseId"::VARCHAR AS row_key, count(*) AS clicks FROM clicks GROUP BY 1)"""

ORACLES = {
    "src_text": f"""SELECT count(*) AS n, sum(length(line))::BIGINT AS chars FROM (
  SELECT concat_ws(chr(9),
    CASE WHEN event_type = 'error' AND fault = 3 THEN strftime(ts, '%H:%M:%S') ELSE {_TIME} END,
    CASE WHEN event_type = 'error' AND fault = 2 THEN 'http://other.example.org/'
         ELSE 'http://www.example.com/' END || CASE event_type
      WHEN 'view' THEN 'video/' || user_id::VARCHAR
      WHEN 'purchase' THEN 'video/' || (user_id % 20)::VARCHAR
      WHEN 'click' THEN 'article/' || user_id::VARCHAR
      WHEN 'signup' THEN 'user'
      ELSE CASE WHEN fault = 0 THEN 'video/x' ELSE 'video/' END || user_id::VARCHAR END,
    CASE WHEN event_type = 'error' AND fault = 1 THEN 'n/a'
         ELSE floor(value * 100)::BIGINT::VARCHAR END,
    CASE WHEN event_type = 'error' AND fault = 4 THEN '' ELSE {_IP} END) AS line
  FROM (SELECT *, floor(value)::BIGINT % 5 AS fault FROM events))""",
    "src_csv": f"WITH {_TRIPS} SELECT id, lat, lon, time FROM trips",
    "src_parquet_partitioned":
        f"WITH {_ACCESS} SELECT day, count(*) AS rows FROM access GROUP BY day",
    "src_catalog": f"WITH {_EMP} SELECT * FROM emp",
    "src_collection": """SELECT CASE WHEN event_type IN ('view', 'purchase') THEN 'video'
    WHEN event_type = 'click' THEN 'article' WHEN event_type = 'signup' THEN 'user'
    ELSE 'none' END AS section, count(*) AS n FROM events GROUP BY 1""",
    "typed_projection": "SELECT c_name AS name, floor(c_acctbal)::INT AS grade FROM customer",
    "sink_text": f"""SELECT date || ',' || pv::VARCHAR || ',' || uv::VARCHAR AS value
FROM ({_PV_UV})""",
    "sink_parquet_partitioned": f"WITH {_ACCESS} SELECT * FROM access",
    "sink_parquet": _EMP_DEPT,
    "sink_table_partitioned": _EMP_DEPT,
    "sink_csv": _TAXI_TOPN,
    "sink_stats": f"WITH {_STATS} SELECT * FROM stat",
    "sink_replace_day":
        f"WITH {_STATS} SELECT stat_table, day, count(*) AS rows FROM stat WHERE day <> '20240107' GROUP BY ALL",
    "clean_access": f"WITH {_ACCESS} SELECT * FROM access",
    "clean_access_rejects": """SELECT CASE floor(value)::BIGINT % 5 WHEN 0 THEN 'bad_id'
    WHEN 1 THEN 'bad_traffic' WHEN 2 THEN 'no_site_prefix' WHEN 3 THEN 'short_time'
    ELSE 'missing_field' END AS reason, count(*) AS n
FROM events WHERE event_type = 'error' GROUP BY 1""",
    "ip_region": f"SELECT event_id, {_IP} AS ip, {_REGION} AS region FROM events",
    "parse_page_views": """SELECT strftime(ts, '%Y-%m-%d') AS date,
  CASE WHEN event_type = 'signup' THEN '' ELSE event_type END AS url,
  CASE WHEN event_type = 'error' THEN '' ELSE user_id::VARCHAR END AS guid FROM events""",
    "parse_key_value": f"WITH {_topk('l_extendedprice')} SELECT key, value FROM pairs",
    "parse_clicks":
        f'WITH {_CLICKS} SELECT ip, time, "courseId", "statusCode", referer FROM clicks',
    "normalize_clf_time": f"""SELECT CASE event_type WHEN 'error' THEN 'junk'
    WHEN 'view' THEN strftime(ts + INTERVAL 8 HOUR, '[%d/%b/%Y:%H:%M:%S +0800]')
    ELSE strftime(ts, '[%d/%b/%Y:%H:%M:%S +0000]') END AS raw,
  CASE WHEN event_type = 'error' THEN '1970-01-01 00:00:00' ELSE {_TIME} END AS normalised
FROM events""",
    "normalize_click_time": f"""SELECT
  CASE WHEN event_type = 'error' THEN 'junk' ELSE {_TIME} END AS raw,
  CASE WHEN event_type = 'error' THEN '19700101000000'
       ELSE strftime(ts, '%Y%m%d%H%M%S') END AS normalised FROM events""",
    "referrer_host": f"WITH {_CLICKS} SELECT referer, host, count(*) AS n FROM clicks GROUP BY ALL",
    "filter_day_type":
        f"""WITH {_ACCESS} SELECT * FROM access WHERE day = '{DAY}' AND "cmsType" = 'video'""",
    "project_columns": "SELECT c_nationkey AS deptno, c_acctbal AS sal FROM customer",
    "preview": f"WITH {_EMP} SELECT * FROM emp ORDER BY empno LIMIT 10",
    "join_catalog_dept": _EMP_DEPT,
    "pv_uv_full_join": _PV_UV,
    "pv_daily": """SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS pv FROM events
WHERE event_type <> 'signup' GROUP BY 1""",
    "uv_daily": """SELECT strftime(ts, '%Y-%m-%d') AS date, count(DISTINCT user_id) AS uv FROM events
WHERE event_type <> 'error' GROUP BY 1""",
    "pv_uv_daily": _PV_UV,
    "pv_uv_stamped": f"SELECT 0::BIGINT AS id, date, pv, uv, true AS stamped FROM ({_PV_UV})",
    "distinct_rows": """SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS date, user_id::VARCHAR AS guid
FROM events WHERE event_type <> 'error'""",
    "video_access_topn": _VIDEO_ACCESS,
    "video_access_topn_sql": _VIDEO_ACCESS,
    "video_traffic_topn": f"""WITH {_STATS}
SELECT day, "cmsId", sum(traffic)::BIGINT AS traffics FROM video GROUP BY day, "cmsId"
ORDER BY traffics DESC""",
    "city_topn": f"WITH {_STATS} SELECT * FROM city_ranks WHERE times_rank <= 3",
    "taxi_hourly_counts": f"WITH {_TAXI_COUNTS} SELECT id, hour, count FROM counts",
    "taxi_topn": _TAXI_TOPN,
    "taxi_topn_sql": _TAXI_TOPN,
    "topk_collect": _topk_lists("l_extendedprice"),
    "topk_collect_ties": _topk_lists("l_quantity"),
    "topk_salted": _topk_lists("l_extendedprice"),
    "topk_bounded": _topk_lists("l_extendedprice"),
    "topk_secondary_sort": f"WITH {_topk('l_extendedprice')} SELECT key, value, rank FROM top",
    "word_count_raw": f"""WITH {_LINES} SELECT word, count(*) AS n FROM (
  SELECT unnest(string_split(line, ' ')) AS word FROM lines) WHERE word <> '' GROUP BY word""",
    "word_count": f"""WITH {_LINES} SELECT word, count(*) AS n FROM (
  SELECT unnest(string_split({_plain('line')}, ' ')) AS word FROM lines)
WHERE word <> '' GROUP BY word""",
    "word_count_dual": f"""WITH {_LINES}, plain AS (SELECT {_plain('line')} AS line FROM lines)
SELECT kind, word, count(*) AS n FROM (
  SELECT 'raw' AS kind, unnest({_tokens('line')}) AS word FROM lines
  UNION ALL
  SELECT 'normalised', unnest({_tokens('line')}) FROM plain) GROUP BY ALL""",
    "line_token_totals": f"""WITH {_LINES}
SELECT count(*) AS lines, sum(len({_tokens('line')}))::BIGINT AS tokens FROM lines""",
    "line_token_totals_observed": f"""WITH {_LINES}
SELECT count(*) AS lines, sum(len({_tokens('line')}))::BIGINT AS tokens FROM lines""",
    "udf_str_len": "SELECT c_name AS ename, length(c_name)::INT AS el FROM customer",
    "udf_format_double": """SELECT c_custkey AS empno,
  rtrim(rtrim(round(c_acctbal::VARCHAR::DECIMAL(38, 18), 1)::VARCHAR, '0'), '.') AS "formatSal"
FROM customer""",
    "self_avg": "SELECT c_nationkey AS deptno, round(avg(c_acctbal), 6) AS avg FROM customer GROUP BY 1",
    "self_avg_pandas":
        "SELECT c_nationkey AS deptno, round(avg(c_acctbal), 6) AS avg FROM customer GROUP BY 1",
    "udf_udaf_report": """SELECT c_nationkey AS deptno, length(c_nationkey::VARCHAR)::INT AS el,
  round(avg(c_acctbal), 6) AS "selfAvgSal", round(avg(c_acctbal), 6) AS sal,
  rtrim(rtrim(round(avg(c_acctbal)::VARCHAR::DECIMAL(38, 18), 1)::VARCHAR, '0'), '.') AS "formatSal"
FROM customer GROUP BY 1""",
    "stream_course_clicks": f"WITH {_COURSES} SELECT row_key, clicks FROM courses",
    "stream_referrer_clicks": f"""WITH {_CLICKS}
SELECT day || '_' || host || '_' || "courseId"::VARCHAR AS row_key, count(*) AS clicks
FROM clicks WHERE host <> '' GROUP BY 1""",
    "stream_running_totals": f"WITH {_COURSES} SELECT row_key, clicks FROM courses",
    "kv_increment": f"""WITH {_COURSES}
SELECT row_key, 'info' AS cf, 'click_count' AS qualifier, clicks AS value FROM courses""",
    "kv_fold": f"WITH {_COURSES} SELECT row_key, clicks FROM courses",
    "stream_batch_counts": "SELECT 3::BIGINT AS batches, count(*)::BIGINT AS lines, 0::BIGINT AS rejects FROM events",
    "kv_upsert": f"""WITH {_CLICKS},
every_day AS (SELECT "courseId", count(*) AS n FROM clicks GROUP BY 1),
late AS (SELECT "courseId", count(*) AS n FROM clicks WHERE substring(day, 7, 2) > '15' GROUP BY 1)
SELECT 'course_' || e."courseId"::VARCHAR AS row_key, 'info' AS cf, 'click_count' AS qualifier,
  coalesce(l.n, e.n) AS value
FROM every_day e LEFT JOIN late l ON e."courseId" = l."courseId" """,
    "kv_lookup": f"""WITH {_COURSES}, keys AS (
  SELECT DISTINCT day || '_' || user_id::VARCHAR AS row_key FROM clicks)
SELECT row_key, coalesce(clicks, 0) AS value FROM keys LEFT JOIN courses USING (row_key)""",
    "kv_prefix_scan": f"""WITH {_COURSES}
SELECT row_key, '{{"row_key":"' || row_key || '","cf":"info","qualifier":"click_count","value":'
  || clicks::VARCHAR || '}}' AS cell
FROM courses WHERE starts_with(row_key, '{DAY}')""",
}
