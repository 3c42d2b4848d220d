"""The registered queries as DuckDB SQL over the same parquet tables."""

from __future__ import annotations

# the stand-in inputs of trailmark/sources/standin.py
_EVENTS = """
ev AS (
  SELECT event_id, ts, user_id, event_type, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k
  FROM events),
uva AS (
  SELECT strftime(ts, '%Y-%m-%d') AS session_date, user_id,
    user_id || '_' || strftime(ts, '%Y-%m-%d') AS session_id, k % 10 AS page_id,
    date_trunc('second', ts) AS action_time,
    CASE WHEN event_type = 'view' THEN 'kw' || (k % 10) END AS search_keyword,
    CASE WHEN event_type = 'click' THEN k % 20 END AS click_category_id,
    CASE WHEN event_type = 'click' THEN k END AS click_product_id,
    CASE WHEN event_type = 'signup' THEN (k % 20) || ',' || ((k + 7) % 20) END AS order_category_ids,
    CASE WHEN event_type = 'signup' THEN (k % 100) || ',' || ((k + 7) % 100) END AS order_product_ids,
    CASE WHEN event_type = 'purchase' THEN CAST(k % 20 AS VARCHAR) END AS pay_category_ids,
    CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) END AS pay_product_ids,
    user_id % 25 AS city_id, event_id
  FROM ev)"""

# the log of the stored task's dates
_DATED = _EVENTS.replace("FROM events)", "FROM events WHERE strftime(ts, '%Y-%m-%d') BETWEEN '2024-01-06' AND '2024-01-20')")

_CITIES = """
city AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

_SESSIONS = """
sess AS (
  SELECT session_id, min(user_id) AS user_id,
    coalesce(string_agg(DISTINCT search_keyword, ',' ORDER BY search_keyword), '') AS search_keywords,
    list_sort(list(DISTINCT click_category_id) FILTER (click_category_id IS NOT NULL)) AS categories,
    min(action_time) AS start_time,
    CAST(epoch(max(action_time)) - epoch(min(action_time)) AS BIGINT) AS visit_length,
    count(*) AS step_length
  FROM uva GROUP BY session_id),
full_sess AS (
  SELECT session_id, user_id, search_keywords, categories,
    coalesce(array_to_string(categories, ','), '') AS click_category_ids,
    strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time,
    strftime(start_time, '%Y-%m-%d') AS date, strftime(start_time, '%H') AS hour,
    visit_length, step_length,
    CAST(c_custkey % 60 AS INTEGER) AS age, c_mktsegment AS professional, 'city' || c_nationkey AS city,
    CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM sess JOIN customer ON user_id = c_custkey),
filtered AS (
  SELECT * FROM full_sess
  WHERE age BETWEEN 10 AND 50 AND professional IN ('MACHINERY', 'FURNITURE', 'HOUSEHOLD')
    AND sex IN ('male', 'female')
    AND list_has_any(string_split(search_keywords, ','), ['kw1', 'kw2', 'kw3', 'kw4', 'kw5'])
    AND list_has_any(categories, [1, 2, 3, 5, 8, 13]))"""

_SAMPLE = """
hours AS (SELECT date, hour, count(*) AS n FROM full_sess GROUP BY ALL),
days AS (SELECT date, sum(n) AS in_day FROM hours GROUP BY ALL),
quotas AS (
  SELECT date, hour, least((n * (3000 // (SELECT count(*) FROM days))) // in_day, n) AS quota
  FROM hours JOIN days USING (date)),
sampled AS (
  SELECT session_id, start_time, search_keywords, click_category_ids
  FROM (
    SELECT *, row_number() OVER (
      PARTITION BY date, hour ORDER BY md5('trail' || session_id), session_id) AS rn
    FROM full_sess) JOIN quotas USING (date, hour)
  WHERE rn <= quota)"""

_CATEGORIES = """
mentions AS (
  SELECT click_category_id AS category_id, 'c' AS kind FROM uva WHERE click_category_id IS NOT NULL
  UNION ALL SELECT CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT), 'o' FROM uva
  UNION ALL SELECT CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT), 'p' FROM uva),
cat AS (
  SELECT category_id, count(*) FILTER (kind = 'c') AS click_count,
    count(*) FILTER (kind = 'o') AS order_count, count(*) FILTER (kind = 'p') AS pay_count
  FROM mentions GROUP BY category_id),
top_cat AS (
  SELECT * FROM cat ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10),
top_sess AS (
  SELECT category_id, session_id, click_count FROM (
    SELECT click_category_id AS category_id, session_id, count(*) AS click_count,
      row_number() OVER (PARTITION BY click_category_id ORDER BY count(*) DESC, session_id) AS rn
    FROM uva WHERE click_category_id IN (SELECT category_id FROM top_cat)
    GROUP BY click_category_id, session_id)
  WHERE rn <= 10)"""

# the job draws from, and counts categories of, the filtered sessions
_JOB_SAMPLE = _SAMPLE.replace("FROM full_sess", "FROM filtered").replace("3000", "1500")
_JOB_CATEGORIES = "kept_uva AS (SELECT * FROM uva WHERE session_id IN (SELECT session_id FROM filtered))," + (
    _CATEGORIES.replace("FROM uva", "FROM kept_uva")
)

_PAGES = """
flow(step, from_page, to_page) AS (VALUES (1, 1, 2), (2, 2, 3), (3, 3, 4), (4, 4, 5)),
moves AS (
  SELECT page_id, lag(page_id) OVER (PARTITION BY session_id ORDER BY action_time, event_id) AS prev
  FROM uva),
pairs AS (
  SELECT CAST(from_page AS BIGINT) AS from_page, CAST(to_page AS BIGINT) AS to_page,
    count(*) AS pair_count
  FROM moves JOIN flow ON prev = from_page AND page_id = to_page GROUP BY from_page, to_page),
conversion AS (
  SELECT CAST(step AS BIGINT) AS step, CAST(from_page AS BIGINT) AS from_page,
    CAST(to_page AS BIGINT) AS to_page, n AS pair_count,
    ((200 * n + base) // nullif(2 * base, 0)) / 100.0 AS convert_rate
  FROM (
    SELECT step, from_page, to_page, coalesce(pair_count, 0) AS n,
      coalesce(lag(coalesce(pair_count, 0)) OVER (ORDER BY step),
        (SELECT count(*) FROM uva WHERE page_id = 1)) AS base
    FROM flow LEFT JOIN pairs USING (from_page, to_page)))"""

_AREAS = """
area_clicks AS (
  SELECT area, click_product_id AS product_id, count(*) AS click_count,
    string_agg(DISTINCT city_id || ':' || city_name, ',' ORDER BY city_id || ':' || city_name) AS city_infos
  FROM uva JOIN city USING (city_id) WHERE click_product_id IS NOT NULL
  GROUP BY area, click_product_id)"""

_CLICKS = """
clicks AS (
  SELECT make_timestamp(epoch_us(ts) // 1000 * 1000) AS ts, strftime(ts, '%Y-%m-%d') AS date,
    replace(area, ' ', '-') AS province, replace(city_name, ' ', '-') AS city, user_id, k % 10 AS ad_id, event_type
  FROM ev JOIN city ON user_id % 25 = city_id),
daily AS (SELECT date, user_id, ad_id, count(*) AS click_count FROM clicks GROUP BY ALL),
stat AS (SELECT date, province, city, ad_id, count(*) AS click_count FROM clicks GROUP BY ALL),
minutes AS (SELECT date_trunc('minute', ts) AS m, ad_id, count(*) AS click_count FROM clicks GROUP BY ALL)"""

# the stream sees the days of the data in three arrivals
_ARRIVALS = """
arrivals AS (
  SELECT *, (date_diff('day', (SELECT min(CAST(ts AS DATE)) FROM ev), CAST(ts AS DATE)) * 3)
    // (1 + (SELECT date_diff('day', min(CAST(ts AS DATE)), max(CAST(ts AS DATE))) FROM ev)) AS arrival
  FROM clicks),
flags AS (
  SELECT user_id, min(arrival) AS arrival FROM (
    SELECT user_id, max(arrival) AS arrival FROM arrivals
    GROUP BY date, user_id, ad_id HAVING count(*) >= 3)
  GROUP BY user_id),
kept AS (
  SELECT a.* FROM arrivals a LEFT JOIN flags f USING (user_id)
  WHERE f.arrival IS NULL OR a.arrival <= f.arrival)"""

_ACTION_COLUMNS = """user_id, session_id, page_id, strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time,
  search_keyword, click_category_id, click_product_id, order_category_ids, order_product_ids,
  pay_category_ids, pay_product_ids"""

_VISITS = (
    ("1s_3s", "BETWEEN 1 AND 3"),
    ("4s_6s", "BETWEEN 4 AND 6"),
    ("7s_9s", "BETWEEN 7 AND 9"),
    ("10s_30s", "BETWEEN 10 AND 29"),
    ("30s_60s", "BETWEEN 30 AND 59"),
    ("1m_3m", "BETWEEN 60 AND 179"),
    ("3m_10m", "BETWEEN 180 AND 599"),
    ("10m_30m", "BETWEEN 600 AND 1799"),
    ("30m", ">= 1800"),
)
_STEPS = (
    ("1_3", "BETWEEN 1 AND 3"),
    ("4_6", "BETWEEN 4 AND 6"),
    ("7_9", "BETWEEN 7 AND 9"),
    ("10_30", "BETWEEN 10 AND 29"),
    ("30_60", "BETWEEN 30 AND 59"),
    ("60", ">= 60"),
)


def _share(column: str, name: str, condition: str) -> str:
    n = f"count(*) FILTER ({column} {condition})"
    return f"((200 * {n} + count(*)) // nullif(2 * count(*), 0)) / 100.0 AS {column}_{name}_ratio"


def _stats(table: str) -> str:
    shares = [_share("visit_length", *b) for b in _VISITS] + [_share("step_length", *b) for b in _STEPS]
    return f"SELECT count(*) AS session_count, {', '.join(shares)} FROM {table}"


def _with(select: str, *parts: str) -> str:
    return f"WITH {', '.join(parts)} {select}"


def _sessions(select: str, *more: str) -> str:
    return _with(select, _EVENTS, _SESSIONS, *more)


def _ads(select: str, *more: str) -> str:
    return _with(select, _EVENTS, _CITIES, _CLICKS, *more)


_SESSION_COLUMNS = """session_id, user_id, search_keywords, click_category_ids, start_time, visit_length,
  step_length, age, professional, city, sex"""


def _top_products(a: str, b: str, c: str) -> str:
    return f"""
SELECT area, CASE WHEN area IN {a} THEN 'A level' WHEN area IN {b} THEN 'B level'
    WHEN area IN {c} THEN 'C level' ELSE 'D level' END AS area_level,
  product_id, city_infos, click_count, p_name AS product_name,
  CASE WHEN p_size % 2 = 0 THEN 'self' ELSE 'third party' END AS product_status
FROM (
  SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) AS rn
  FROM area_clicks JOIN part ON product_id = p_partkey)
WHERE rn <= 3"""


_PROVINCE_TOP = """
SELECT date, province, ad_id, click_count FROM (
  SELECT date, province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count,
    row_number() OVER (PARTITION BY date, province ORDER BY sum(click_count) DESC, ad_id) AS rn
  FROM stat GROUP BY date, province, ad_id)
WHERE rn <= 3"""

_TREND = """
SELECT strftime(m, '%Y-%m-%d') AS date, strftime(m, '%H') AS hour, strftime(m, '%M') AS minute, ad_id,
  click_count
FROM minutes WHERE m > (SELECT max(m) FROM minutes) - INTERVAL 60 MINUTE"""

_CLICK_COLUMNS = "strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ts, province, city, user_id, ad_id"

ORACLES = {
    "session_aggregate": _sessions(f"SELECT {_SESSION_COLUMNS} FROM full_sess"),
    "filtered_sessions": _sessions(f"SELECT {_SESSION_COLUMNS} FROM filtered"),
    "session_stats": _sessions(_stats("full_sess")),
    "filtered_session_stats": _sessions(_stats("filtered")),
    "session_details": _sessions(
        f"SELECT {_ACTION_COLUMNS} FROM uva WHERE session_id IN (SELECT session_id FROM filtered)"
    ),
    "sessions_per_hour": _sessions(
        "SELECT date, hour, count(*) AS session_count FROM full_sess GROUP BY date, hour"
    ),
    "session_hour_share": _sessions(
        "SELECT date, hour, count(*) AS session_count, count(*) / (SELECT count(*) FROM full_sess) AS share"
        " FROM full_sess GROUP BY date, hour"
    ),
    "session_sample": _sessions("SELECT * FROM sampled", _SAMPLE),
    "session_sample_details": _sessions(
        f"SELECT {_ACTION_COLUMNS} FROM uva WHERE session_id IN (SELECT session_id FROM sampled)", _SAMPLE
    ),
    "category_counts": _with("SELECT * FROM cat", _EVENTS, _CATEGORIES),
    "top10_categories": _with("SELECT * FROM top_cat", _EVENTS, _CATEGORIES),
    "session_category_clicks": _with(
        "SELECT click_category_id AS category_id, session_id, count(*) AS click_count FROM uva"
        " WHERE click_category_id IS NOT NULL GROUP BY ALL",
        _EVENTS,
    ),
    "top10_sessions_per_category": _with("SELECT * FROM top_sess", _EVENTS, _CATEGORIES),
    "top_session_details": _with(
        f"SELECT {_ACTION_COLUMNS} FROM uva WHERE session_id IN (SELECT session_id FROM top_sess)",
        _EVENTS,
        _CATEGORIES,
    ),
    "top_session_details_per_category": _with(
        f"SELECT category_id, {_ACTION_COLUMNS.replace('session_id', 'uva.session_id')}"
        " FROM uva JOIN top_sess ON uva.session_id = top_sess.session_id",
        _EVENTS,
        _CATEGORIES,
    ),
    "action_text_keys": _with(
        "SELECT event_id, strftime(action_time, '%Y%m%d') AS date_key, strftime(action_time, '%Y-%m-%d_%H') AS hour_key,"
        " strftime(action_time, '%Y%m%d%H%M') AS minute_key, strftime(action_time, '%Y-%m-%d') AS date,"
        " order_category_ids AS order_categories, order_category_ids AS trimmed FROM uva",
        _EVENTS,
    ),
    "session_values": _with(
        "SELECT DISTINCT session_id, 'keyword' AS kind, search_keyword AS value FROM uva WHERE search_keyword IS NOT NULL"
        " UNION ALL SELECT DISTINCT session_id, 'category', CAST(click_category_id AS VARCHAR) FROM uva"
        " WHERE click_category_id IS NOT NULL",
        _EVENTS,
    ),
    "session_stats_of_saved_log": _with(
        _stats("full_sess"),
        _EVENTS.replace("FROM events)", "FROM events WHERE isodow(ts) = 1)"),
        _SESSIONS,
    ),
    "unmatched_counts": _with(
        "SELECT 'unmatched_sessions' AS name, count(*) AS rows FROM sess"
        " WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0)"
        " UNION ALL SELECT 'clicks_in_unknown_cities', count(*) FROM uva WHERE click_product_id IS NOT NULL"
        " AND city_id NOT IN (SELECT city_id FROM city WHERE city_id % 3 <> 0)"
        " UNION ALL SELECT 'clicks_of_unknown_products', count(*) FROM uva WHERE click_product_id IS NOT NULL"
        " AND click_product_id NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 3 <> 0)",
        _EVENTS,
        _CITIES,
        _SESSIONS,
    ),
    "session_first_days": _sessions(
        "SELECT date, count(*) AS sessions, CAST(date AS DATE) >= current_date - 1 AS recent, 1 AS step"
        " FROM full_sess GROUP BY date"
    ),
    "session_job_sample": _with(
        "SELECT CAST(7 AS BIGINT) AS task_id, * FROM sampled", _DATED, _SESSIONS, _JOB_SAMPLE
    ),
    "session_job_details": _with(
        f"SELECT CAST(7 AS BIGINT) AS task_id, {_ACTION_COLUMNS} FROM uva WHERE session_id IN"
        f" (SELECT session_id FROM sampled) UNION ALL SELECT 7, {_ACTION_COLUMNS} FROM uva WHERE session_id IN"
        " (SELECT session_id FROM top_sess)",
        _DATED,
        _SESSIONS,
        _JOB_SAMPLE,
        _JOB_CATEGORIES,
    ),
    "session_job_categories": _with(
        "SELECT CAST(7 AS BIGINT) AS task_id, * FROM top_cat", _DATED, _SESSIONS, _JOB_CATEGORIES
    ),
    "session_job_top_sessions": _with(
        "SELECT CAST(7 AS BIGINT) AS task_id, * FROM top_sess", _DATED, _SESSIONS, _JOB_CATEGORIES
    ),
    "session_job_stats": _with(
        f"SELECT CAST(7 AS BIGINT) AS task_id, * FROM ({_stats('filtered')})", _DATED, _SESSIONS
    ),
    "page_job_rates": _with(
        "SELECT CAST(7 AS BIGINT) AS task_id, string_agg(from_page || '_' || to_page || '=' || convert_rate, '|'"
        " ORDER BY step) AS convert_rate FROM conversion",
        _DATED,
        _PAGES,
    ),
    "page_pair_counts": _with("SELECT * FROM pairs", _EVENTS, _PAGES),
    "page_pair_counts_of_hot_sessions": _with("SELECT * FROM pairs", _EVENTS, _PAGES),
    "page_conversion": _with("SELECT * FROM conversion", _EVENTS, _PAGES),
    "page_split_convert_rate": _with(
        "SELECT string_agg(from_page || '_' || to_page || '=' || convert_rate, '|' ORDER BY step)"
        " AS convert_rate FROM conversion",
        _EVENTS,
        _PAGES,
    ),
    "area_product_clicks": _with("SELECT * FROM area_clicks", _EVENTS, _CITIES, _AREAS),
    "area_top3_products": _with(
        _top_products("('华北', '华东')", "('华南', '华中')", "('西北', '西南')"), _EVENTS, _CITIES, _AREAS
    ),
    "area_job_top3": _with(
        "SELECT CAST(7 AS BIGINT) AS task_id, * FROM ("
        + _top_products("('ASIA', 'EUROPE')", "('AMERICA')", "('AFRICA')")
        + ")",
        _DATED,
        _CITIES,
        _AREAS,
    ),
    "ad_log_parsed": _ads(f"SELECT {_CLICK_COLUMNS} FROM clicks"),
    "ad_user_daily_clicks": _ads("SELECT * FROM daily"),
    "ad_blacklist": _ads(
        "SELECT user_id, min(date) AS flagged_date FROM daily WHERE click_count >= 3 GROUP BY user_id"
    ),
    "ad_clicks_after_blacklist": _ads(
        f"SELECT {_CLICK_COLUMNS} FROM clicks LEFT JOIN (SELECT user_id, min(date) AS flagged FROM daily"
        " WHERE click_count >= 3 GROUP BY user_id) USING (user_id) WHERE flagged IS NULL OR date <= flagged"
    ),
    "ad_stat": _ads("SELECT * FROM stat"),
    "ad_province_top3": _ads(_PROVINCE_TOP),
    "ad_click_trend": _ads(_TREND),
    "ad_blacklist_stream": _ads("SELECT user_id FROM flags", _ARRIVALS),
    "ad_user_clicks_stream": _ads(
        "SELECT date, user_id, ad_id, count(*) AS click_count FROM kept GROUP BY ALL", _ARRIVALS
    ),
    "ad_filtered_stat_stream": _ads(
        "SELECT date, province, city, ad_id, count(*) AS click_count FROM kept GROUP BY ALL", _ARRIVALS
    ),
    "ad_stream_metrics": _ads(
        "SELECT 2 - arrival AS batch_id, count(*) + count(*) FILTER (event_type = 'error') AS lines,"
        " count(*) FILTER (event_type = 'error') AS rejects,"
        " count(*) FILTER (ts < (SELECT max(ts) FROM arrivals x WHERE x.arrival > a.arrival) - INTERVAL 60 MINUTE) AS late"
        " FROM arrivals a GROUP BY arrival",
        _ARRIVALS,
    ),
    "ad_stat_stream": _ads("SELECT * FROM stat"),
    "ad_stat_late_stream": _ads("SELECT * FROM stat"),
    "ad_click_trend_late_stream": _ads(
        "SELECT strftime(m, '%Y-%m-%d') AS date, strftime(m, '%H') AS hour, strftime(m, '%M') AS minute, ad_id,"
        " click_count FROM minutes"
    ),
    "ad_province_top3_stream": _ads(_PROVINCE_TOP),
    "ad_click_trend_stream": _ads(_TREND),
}
