"""SQL twins of the registered queries, for an independent engine.

Written from the definition of each result, not from the Spark plans.
"""

from __future__ import annotations

from trendloom.schemas import CATEGORY_NAMES

_FILE = """CASE
    WHEN s_nationkey % 10 = 7 THEN NULL
    WHEN s_nationkey % 10 = 8 THEN 'nope.csv'
    WHEN s_nationkey % 10 = 9 THEN 'set_' || chr(65 + s_nationkey) || 'X.csv'
    ELSE chr(65 + s_nationkey) || 'Xvideos.csv' END"""

_SAFE_RATE = """CASE WHEN views > 0
    THEN CAST(coalesce(likes, 0) + coalesce(comment_count, 0) AS DOUBLE) / views ELSE 0.0 END"""
_SAFE_RATIO = """CASE WHEN likes + dislikes > 0
    THEN CAST(likes AS DOUBLE) / (likes + dislikes) ELSE 0.0 END"""

_NAME_CASES = " ".join(f"WHEN {i} THEN '{n}'" for i, n in CATEGORY_NAMES.items())


def _name(default: str = "NULL") -> str:
    return f"CASE category_id {_NAME_CASES} ELSE {default} END"


_DAILY = f"""
base AS (
    SELECT CAST(l_partkey AS VARCHAR) AS video_id, p_name AS title, s_name AS channel_title,
        CAST(l_linenumber AS BIGINT) AS category_id, l_shipdate AS publish_time,
        string_split(p_name, ' ') AS tags,
        CAST(floor(l_extendedprice) AS BIGINT) AS views,
        CAST(floor(l_quantity * 100) AS BIGINT) AS likes,
        CAST(floor(l_tax * 1000) AS BIGINT) AS dislikes,
        CAST(floor(l_discount * 1000) AS BIGINT) AS comment_count,
        CAST(l_shipdate AS DATE) AS trending_date, n_name AS country,
        {_FILE} AS source_file
    FROM lineitem JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey
),
d AS (
    SELECT *, engagement_rate *
        CASE WHEN views > 0 THEN log10(views) * 100 END AS virality_score
    FROM (SELECT *, {_SAFE_RATE} AS engagement_rate, {_SAFE_RATIO} AS like_ratio FROM base)
)"""

_GAPS = f"""{_DAILY},
g AS (
    SELECT video_id, trending_date, category_id, comment_count, engagement_rate,
        CASE WHEN category_id = 7 THEN 0 WHEN category_id = 6 THEN NULL ELSE views END AS views,
        CASE WHEN category_id = 4 THEN 0 WHEN category_id = 5 THEN NULL ELSE likes END AS likes,
        CASE WHEN category_id = 4 THEN 0 WHEN category_id = 3 THEN NULL ELSE dislikes END
            AS dislikes
    FROM d
)"""

_Q = "CAST(l_quantity AS INTEGER)"
_DAY = "strftime(l_shipdate, '%Y-%m-%d')"
_RAW = f"""
raw AS (
    SELECT CAST(l_partkey AS VARCHAR) AS video_id,
        CASE WHEN p_size % 17 <> 0 THEN p_name END AS title, s_name AS channel_title,
        CAST(l_linenumber AS VARCHAR) AS category_id,
        CASE WHEN {_Q} % 13 = 0 THEN 'not a day' ELSE {_DAY} END AS trending_date,
        CASE WHEN {_Q} % 13 = 1 THEN '?' ELSE {_DAY} || ' 0' || l_linenumber || ':30:00' END
            AS publish_time,
        CASE WHEN {_Q} % 11 = 0 THEN 'n/a' WHEN {_Q} % 11 = 1 THEN {_Q} || '.7'
            ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) END AS views,
        CASE WHEN {_Q} % 7 = 0 THEN ''
            ELSE CAST(CAST(floor(l_quantity * 100) AS BIGINT) AS VARCHAR) END AS likes,
        CASE WHEN l_linenumber <> 3
            THEN CAST(CAST(floor(l_tax * 1000) AS BIGINT) AS VARCHAR) END AS dislikes,
        CAST(CAST(floor(l_discount * 1000) AS BIGINT) AS VARCHAR) AS comment_count,
        CASE {_Q} % 10 WHEN 0 THEN 'P0D' WHEN 1 THEN 'unknown'
            WHEN 2 THEN 'P1DT' || {_Q} || 'H' WHEN 3 THEN 'PT' || {_Q} || '.5S'
            ELSE 'PT1H' || {_Q} || 'M' || l_linenumber || 'S' END AS duration,
        CAST(CASE {_Q} % 10 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 86400 + 3600 * {_Q}
            WHEN 3 THEN {_Q} + 0.5 ELSE 3600 + 60 * {_Q} + l_linenumber END AS DOUBLE) AS seconds,
        {_FILE} AS source_file, l_orderkey
    FROM lineitem JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey
)"""


def _whole(c: str) -> str:
    return f"CAST(trunc(TRY_CAST({c} AS DOUBLE)) AS BIGINT)"


def _lenient_int(c: str) -> str:
    return f"coalesce(CAST(trunc(TRY_CAST({c} AS DOUBLE)) AS BIGINT), 0)"


_STRICT_COUNTRY = "regexp_extract(source_file, '([A-Z]{2})videos\\.csv', 1)"
_LOOSE_COUNTRY = "regexp_extract(source_file, '([A-Z]{2})', 1)"

# typed facts as the load job stores them: an empty country is a NULL partition
_LOADED = f"""{_RAW},
typed AS (
    SELECT video_id, title, channel_title, category_id,
        {_whole('views')} AS views, {_whole('likes')} AS likes,
        coalesce({_whole('dislikes')}, 0) AS dislikes,
        {_whole('comment_count')} AS comment_count,
        TRY_CAST(trending_date AS DATE) AS trending_date,
        TRY_CAST(publish_time AS TIMESTAMP) AS publish_time,
        CASE WHEN source_file IS NULL THEN 'XX'
            ELSE nullif({_STRICT_COUNTRY}, '') END AS country
    FROM raw
),
d AS (
    SELECT * REPLACE (CAST(category_id AS BIGINT) AS category_id), {_SAFE_RATE} AS engagement_rate,
        CASE CAST(category_id AS BIGINT) {_NAME_CASES} END AS category_name
    FROM typed
)"""

_YEARLY = _LOADED.replace(
    "TRY_CAST(trending_date AS DATE) AS trending_date",
    "CAST(date_trunc('year', TRY_CAST(trending_date AS DATE)) AS DATE) AS trending_date",
)

_HOURLY = f"""
h AS (
    SELECT *, {_SAFE_RATE} AS engagement_rate FROM (
        SELECT CAST(event_id AS VARCHAR) AS video_id, event_type AS title,
            c_name AS channel_title, CAST(user_id % 30 AS BIGINT) AS category_id,
            ts AS publish_time, CAST(floor(value * 100) AS BIGINT) AS views,
            CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS likes,
            0 AS comment_count, CAST(ts AS DATE) AS trending_date, n_name AS country, event_type
        FROM events JOIN customer ON user_id = c_custkey
        JOIN nation ON c_nationkey = n_nationkey)
)"""

_TEXT = """
t AS (
    SELECT CAST(doc_id AS VARCHAR) AS video_id, text AS title, source AS channel_title,
        string_split(text, ' ') AS tags, n_chars AS views, lang AS country,
        CAST(length(text) AS DOUBLE) / nullif(n_chars, 0) AS engagement_rate
    FROM documents
)"""

_CHANNELS = """
cats AS (
    SELECT channel_title, country, category_id, count(*) AS n,
        row_number() OVER (PARTITION BY channel_title, country
            ORDER BY count(*) DESC, category_id) AS rn
    FROM d GROUP BY channel_title, country, category_id
),
mets AS (
    SELECT channel_title, country, count(DISTINCT video_id) AS total_videos,
        CAST(sum(views) AS BIGINT) AS total_views, avg(views) AS avg_views,
        CAST(sum(likes) AS BIGINT) AS total_likes,
        round(avg(engagement_rate), 6) AS avg_engagement_rate
    FROM d GROUP BY channel_title, country
)
SELECT mets.*, cats.category_id AS top_category FROM mets LEFT JOIN cats
    ON mets.channel_title = cats.channel_title AND mets.country = cats.country AND cats.rn = 1"""

_TRENDS = """
    CAST(year(trending_date) AS BIGINT) AS year, CAST(month(trending_date) AS BIGINT) AS month,
    country, count(*) AS video_count, CAST(sum(views) AS BIGINT) AS total_views,
    avg(views) AS avg_views, avg(likes) AS avg_likes,
    round(avg(engagement_rate), 6) AS avg_engagement,
    round(CAST(sum(views) AS DOUBLE) / count(*)
        * (CAST(sum(CAST(engagement_rate AS DECIMAL(27, 12))) AS DOUBLE) / count(engagement_rate))
        * 1000, 4) AS trending_score"""

_TIME_SERIES = """
SELECT trending_date AS date_key, CAST(hour(publish_time) AS BIGINT) AS hour_of_day,
    CAST(dayofweek(trending_date) + 1 AS BIGINT) AS day_of_week, country,
    count(*) AS video_count, CAST(sum(views) AS BIGINT) AS total_views,
    avg(views) AS avg_views, max(views) AS max_views
FROM {src} WHERE trending_date IS NOT NULL GROUP BY ALL"""

_CORR_COLS = ["views", "likes", "dislikes", "comment_count", "engagement_rate"]
_CORR = " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM d"
    for i, a in enumerate(_CORR_COLS)
    for b in _CORR_COLS[i + 1 :]
)


def _viral(src: str) -> str:
    return f"""
cut AS (SELECT quantile_disc(views, 0.95) AS hi, quantile_disc(views, 0.75) AS mid FROM {src}),
viral AS (
    SELECT CASE WHEN views > hi THEN 'Viral' WHEN views > mid THEN 'Popular' ELSE 'Normal' END
            AS viral_category,
        avg(length(title)) AS avg_title_length, avg(len(tags)) AS avg_tag_count,
        avg(engagement_rate) AS avg_engagement,
        avg(CASE WHEN regexp_matches(title, '[A-Z]{{2,}}') THEN 1 ELSE 0 END) AS has_caps_ratio,
        avg(CASE WHEN regexp_matches(title, '[!?]') THEN 1 ELSE 0 END) AS has_punctuation_ratio,
        count(*) AS video_count
    FROM {src}, cut GROUP BY 1
)"""


_VIRAL_OUT = """
SELECT viral_category, round(avg_title_length, 6) AS avg_title_length,
    round(avg_tag_count, 6) AS avg_tag_count, round(avg_engagement, 6) AS avg_engagement,
    has_caps_ratio, has_punctuation_ratio, video_count FROM viral"""

_TIMING = """
cells AS (
    SELECT CAST(hour(publish_time) AS BIGINT) AS hour,
        CAST(dayofweek(publish_time) + 1 AS BIGINT) AS day_of_week, country,
        avg(views) AS avg_views, avg(engagement_rate) AS avg_engagement,
        count(*) AS sample_size, quantile_disc(views, 0.75) AS p75_views
    FROM h GROUP BY 1, 2, 3
),
slots AS (
    SELECT hour, day_of_week, avg(avg_views) AS v, avg(avg_engagement) AS e
    FROM cells WHERE sample_size > 2 GROUP BY 1, 2
),
timing AS (
    SELECT hour, day_of_week, round(v, 6) AS global_avg_views,
        round(e, 6) AS global_avg_engagement,
        rank() OVER (ORDER BY v DESC) AS view_rank,
        rank() OVER (ORDER BY e DESC) AS engagement_rank
    FROM slots
)"""

_EVOLUTION = """
months AS (
    SELECT CAST(date_trunc('month', trending_date) AS DATE) AS month, category_id,
        count(*) AS video_count, CAST(sum(views) AS BIGINT) AS total_views
    FROM d GROUP BY 1, 2
),
growth AS (
    SELECT *, lag(total_views) OVER (PARTITION BY category_id ORDER BY month) AS prev FROM months
),
evolution AS (
    SELECT month, category_id, video_count, total_views,
        CAST(total_views - prev AS DOUBLE) / nullif(prev, 0) * 100 AS growth_rate,
        rank() OVER (PARTITION BY month ORDER BY total_views DESC) AS monthly_rank
    FROM growth WHERE prev IS NOT NULL AND prev <> 0
)"""

_STRATEGIES = """
chan AS (
    SELECT channel_title, count(DISTINCT video_id) AS video_count,
        count(DISTINCT category_id) AS diversity, avg(views) AS avg_views,
        stddev_samp(views) / avg(views) AS consistency, avg(length(title)) AS title_length,
        max(views) / avg(views) AS peak
    FROM d GROUP BY 1 HAVING count(DISTINCT video_id) >= 5
),
cut AS (SELECT quantile_disc(avg_views, 0.9) AS hi, quantile_disc(avg_views, 0.5) AS mid FROM chan),
strategies AS (
    SELECT CASE WHEN avg_views > hi THEN 'Top Performer' WHEN avg_views > mid THEN 'Average'
            ELSE 'Below Average' END AS performance_tier,
        round(avg(diversity), 6) AS avg_category_diversity,
        round(avg(consistency), 6) AS avg_consistency,
        round(avg(title_length), 6) AS avg_title_length,
        round(avg(peak), 6) AS avg_peak_ratio, count(*) AS channel_count
    FROM chan, cut GROUP BY 1
)"""

_RAW_ORDER = """source_file NULLS FIRST, l_orderkey, category_id, channel_title, views, likes,
    dislikes NULLS FIRST, comment_count, duration"""

_CLEAN = f"""{_RAW},
firsts AS (
    SELECT * FROM raw QUALIFY row_number() OVER (
        PARTITION BY video_id, trending_date ORDER BY {_RAW_ORDER}) = 1
),
coerced AS (
    SELECT video_id, title, source_file, seconds AS duration_sec,
        {_lenient_int('views')} AS views, {_lenient_int('likes')} AS likes,
        {_lenient_int('dislikes')} AS dislikes, {_lenient_int('comment_count')} AS comment_count,
        TRY_CAST(trending_date AS TIMESTAMP) AS trending_date,
        TRY_CAST(publish_time AS TIMESTAMP) AS publish_time,
        CAST(category_id AS BIGINT) AS category_id
    FROM firsts
),
titled AS (SELECT * FROM coerced WHERE title IS NOT NULL),
q AS (
    SELECT quantile_cont(views, 0.25) AS q1, quantile_cont(views, 0.75) AS q3 FROM titled
),
kept AS (
    SELECT titled.* FROM titled, q
    WHERE views BETWEEN greatest(0, q1 - 0.5 * (q3 - q1)) AND q3 + 0.5 * (q3 - q1)
)"""

_WINDOWS = """
deltas AS (
    SELECT user_id AS video_id, ts, CAST(floor(value * 100) AS BIGINT) AS views_delta,
        CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS likes_delta
    FROM events
),
placed AS (
    SELECT date_trunc('minute', ts) - INTERVAL 1 MINUTE * back AS window_start, *
    FROM deltas, (SELECT unnest([0, 1, 2, 3, 4]) AS back)
),
trends AS (
    SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, video_id,
        CAST(sum(views_delta) AS BIGINT) AS views_5min, avg(likes_delta) AS avg_likes_5min,
        count(*) AS update_count
    FROM placed GROUP BY window_start, video_id
)"""

_TOP_NAMES = """
SELECT title, count(*) AS count,
    CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM d) * 100 AS percent FROM d GROUP BY title"""

_TRIP = "SELECT video_id, title, country, trending_date, views, likes FROM d"

_BASIC = """
SELECT count(*) AS total_videos, count(DISTINCT video_id) AS unique_videos,
    min(trending_date) AS first_date, max(trending_date) AS last_date,
    count(DISTINCT source_file) AS countries, CAST(sum(views) AS BIGINT) AS total_views,
    avg(views) AS avg_views, max(views) AS max_views,
    round(avg(engagement_rate), 6) AS avg_engagement,
    round(avg(like_ratio), 6) AS avg_like_ratio, quantile_cont(views, 0.5) AS median_views
    {more}
FROM d"""

_COUNTRY_STATS = """
SELECT source_file, round_even(avg(views), 2) AS avg_views,
    round_even(avg(engagement_rate), 2) AS avg_engagement, count(video_id) AS video_count
FROM d WHERE source_file IS NOT NULL GROUP BY source_file"""

_MONTHS = """
months AS (
    SELECT CAST(date_trunc('month', trending_date) AS DATE) AS month, count(*) AS videos,
        avg(views) AS avg_views
    FROM d GROUP BY 1
)"""

_CHANNEL_ORDER = "trending_date, video_id, country, category_id, views"
_VIDEO_ORDER = "trending_date, country, channel_title, category_id, views"
_CHANNEL_WINDOWS = f"""
    avg(views) OVER (PARTITION BY channel_title ORDER BY {_CHANNEL_ORDER}
        ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS channel_7day_avg,
    CAST(sum(views) OVER (PARTITION BY channel_title ORDER BY {_CHANNEL_ORDER}
        ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_channel_views"""
_PREVIOUS = f"lag(views) OVER (PARTITION BY video_id ORDER BY {_VIDEO_ORDER}) AS prev_day_views"
_DAILY_RANK = """
    rank() OVER (PARTITION BY country, trending_date ORDER BY views DESC) AS daily_rank"""


def _on(ctes: str, query: str) -> str:
    return f"WITH {ctes.strip()}\n{query.strip()}"


_RAW_COLUMNS = """video_id title channel_title category_id trending_date publish_time views likes
    dislikes comment_count duration source_file l_orderkey""".split()


def _chars(prefix: str) -> str:
    return " + ".join(
        f"coalesce(length(CAST({prefix}{c} AS VARCHAR)), 0)" for c in _RAW_COLUMNS
    )


def _measure(name: str, expr: str) -> str:
    return _on(
        _GAPS, f"SELECT video_id, trending_date, category_id, views, likes, {expr} AS {name} FROM g"
    )


def _trending(tables: str, rows: str) -> tuple[str, str]:
    windows = f"""{tables},
        w AS (
            SELECT video_id, title, channel_title, category_id, views, trending_date, country,
                {_DAILY_RANK}, {_CHANNEL_WINDOWS}, {_PREVIOUS},
                percent_rank() OVER (PARTITION BY category_id ORDER BY views)
                    AS category_percentile
            FROM {rows}
        )"""
    return windows, """SELECT *, CASE WHEN prev_day_views IS NOT NULL
        THEN CAST(views - prev_day_views AS DOUBLE) / nullif(prev_day_views, 0) * 100
        ELSE 0 END AS growth_rate FROM w WHERE daily_rank <= 5"""


def oracle_sql() -> dict[str, str]:
    gap_keys = "video_id, trending_date, category_id, views, likes"
    rate_cleaner = "coalesce(CAST(likes AS DOUBLE) / CASE WHEN views = 0 THEN 1 ELSE views END, 0)"

    def ratio_cleaner(total: str) -> str:
        return (
            f"coalesce(CAST(likes AS DOUBLE) / CASE WHEN {total} = 0 THEN 1 ELSE {total} END, 0)"
        )

    sql = {
        "engagement_rate_safe": _measure("engagement", _SAFE_RATE),
        "engagement_rate_unguarded": _measure(
            "engagement", "CAST(likes + comment_count AS DOUBLE) / nullif(views, 0)"
        ),
        "engagement_rate_cleaner": _measure("engagement", rate_cleaner),
        "like_ratio_safe": _measure("ratio", _SAFE_RATIO),
        "like_ratio_unguarded": _measure(
            "ratio", "CAST(likes AS DOUBLE) / nullif(likes + dislikes, 0)"
        ),
        "like_ratio_cleaner": _on(
            _GAPS,
            f"""SELECT {gap_keys}, {ratio_cleaner('(likes + dislikes)')} AS ratio,
                {ratio_cleaner('likes')} AS ratio_without_dislikes FROM g""",
        ),
        "virality": _measure(
            "score",
            "round(CASE WHEN views > 0 THEN log10(views) END * engagement_rate * 100, 6)",
        ),
        "tags_split_size": _on(
            _DAILY,
            """SELECT video_id, CAST(len(tags) AS BIGINT) AS tag_count,
                array_to_string(tags, ',') AS tags FROM d""",
        ),
        "country_loose": _on(
            _DAILY, f"SELECT video_id, source_file, {_LOOSE_COUNTRY} AS country_code FROM d"
        ),
        "country_strict": _on(
            _DAILY, f"SELECT video_id, source_file, {_STRICT_COUNTRY} AS country_code FROM d"
        ),
        "country_default": _on(
            _DAILY,
            f"""SELECT video_id, source_file, CASE WHEN source_file IS NULL THEN 'XX'
                ELSE {_STRICT_COUNTRY} END AS country_code FROM d""",
        ),
        "coerce_types": _on(
            _LOADED,
            """SELECT video_id, views, likes, dislikes, comment_count, trending_date, publish_time
                FROM typed""",
        ),
        "coerce_numeric": _on(
            _RAW,
            f"""SELECT video_id, {_lenient_int('views')} AS views,
                {_lenient_int('likes')} AS likes, {_lenient_int('dislikes')} AS dislikes
                FROM raw""",
        ),
        "coerce_dates": _on(
            _RAW,
            """SELECT video_id, TRY_CAST(trending_date AS TIMESTAMP) AS trending_at,
                TRY_CAST(publish_time AS TIMESTAMP) AS published_at FROM raw""",
        ),
        "iso_duration": _on(_RAW, "SELECT video_id, duration, seconds FROM raw"),
        "category_name_map": _on(
            _HOURLY, f"SELECT video_id, category_id, {_name()} AS name FROM h"
        ),
        "category_name_unknown": _on(
            _HOURLY, f"""SELECT video_id, category_id, {_name("'Unknown'")} AS name FROM h"""
        ),
        "hour_segment": _on(
            _HOURLY,
            """SELECT video_id, CAST(hour(publish_time) AS BIGINT) AS hour,
                CASE WHEN hour(publish_time) >= 18 THEN 'Prime Time'
                    WHEN hour(publish_time) >= 12 THEN 'Afternoon'
                    WHEN hour(publish_time) >= 6 THEN 'Morning' ELSE 'Late Night' END AS segment
                FROM h""",
        ),
        "percent_of_total": _on(_DAILY, _TOP_NAMES),
        "value_counts_top5": _on(_DAILY, f"{_TOP_NAMES} ORDER BY count DESC, title LIMIT 5"),
        "mode_global": _on(
            _DAILY,
            """SELECT title, count(*) AS count FROM d GROUP BY title
                ORDER BY count DESC, title LIMIT 1""",
        ),
        "drop_null_title": _on(
            _RAW, "SELECT video_id, title, l_orderkey FROM raw WHERE title IS NOT NULL"
        ),
        "iqr_filter": _on(
            f"""{_HOURLY},
            q AS (
                SELECT quantile_cont(views, 0.25) AS a, quantile_cont(views, 0.75) AS b FROM h
            )""",
            """SELECT video_id, views FROM h, q
                WHERE views BETWEEN greatest(0, a - 1.5 * (b - a)) AND b + 1.5 * (b - a)""",
        ),
        "category_join_broadcast": _on(
            _DAILY,
            """SELECT r_name AS category_group, count(*) AS row_count,
                CAST(sum(views) AS BIGINT) AS total_views
                FROM d JOIN nation ON country = n_name JOIN region ON n_regionkey = r_regionkey
                GROUP BY r_name""",
        ),
        "category_insights": _on(
            _DAILY,
            """SELECT category_id, n_name AS category_name, r_name AS category_group,
                count(DISTINCT video_id) AS unique_videos,
                CAST(sum(views) AS BIGINT) AS total_views,
                round(avg(engagement_rate), 6) AS avg_engagement,
                round(stddev_samp(views), 3) AS view_stddev,
                quantile_disc(views, 0.5) AS median_views,
                quantile_disc(views, 0.95) AS p95_views,
                round(max(virality_score), 6) AS max_virality
                FROM d JOIN nation ON category_id = n_nationkey
                JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3""",
        ),
        "top5_category_semi_join": _on(
            _DAILY,
            """SELECT video_id, category_id, trending_date, views FROM d WHERE category_id IN (
                SELECT category_id FROM d GROUP BY category_id
                ORDER BY sum(views) DESC, category_id LIMIT 5)""",
        ),
        "channel_statistics": _on(_DAILY, "," + _CHANNELS),
        "channel_statistics_joined": _on(_DAILY, "," + _CHANNELS),
        "channel_statistics_mode": _on(_DAILY, "," + _CHANNELS),
        "category_trends": _on(
            _DAILY,
            f"""SELECT category_id, {_name()} AS category_name, {_TRENDS} FROM d
                WHERE category_id IS NOT NULL GROUP BY 1, 2, 3, 4, 5""",
        ),
        "category_trends_named": _on(
            _DAILY,
            f"""SELECT category_id, {_name()} AS category_name, {_TRENDS} FROM d
                GROUP BY 1, 2, 3, 4, 5""",
        ),
        "time_series_metrics": _on(_HOURLY, _TIME_SERIES.format(src="h")),
        "time_series_peak": _on(
            f"""{_HOURLY},
            pairs AS (
                SELECT trending_date, hour(publish_time) AS hr, country, video_id, views,
                    count(*) AS n
                FROM h GROUP BY ALL
            ),
            marked AS (
                SELECT *, first_value(video_id) OVER (PARTITION BY trending_date, country
                        ORDER BY views DESC, video_id) AS peak_video_id,
                    max(views) OVER (PARTITION BY trending_date, country) AS peak_views
                FROM pairs
            )""",
            """SELECT trending_date AS date_key, CAST(hr AS BIGINT) AS hour_of_day,
                CAST(dayofweek(trending_date) + 1 AS BIGINT) AS day_of_week, country,
                CAST(sum(n) AS BIGINT) AS video_count,
                CAST(sum(views * n) AS BIGINT) AS total_views, avg(views) AS avg_views,
                min(peak_video_id) AS peak_video_id, max(peak_views) AS peak_video_views
                FROM marked GROUP BY 1, 2, 3, 4""",
        ),
        "temporal_patterns": _on(
            f"""{_HOURLY},
            hours AS (
                SELECT date_trunc('hour', publish_time) AS bucket, avg(views) AS v,
                    avg(engagement_rate) AS e
                FROM h GROUP BY 1
            )""",
            """SELECT CAST(hour(bucket) AS BIGINT) AS hour_of_day,
                CAST(dayofweek(bucket) + 1 AS BIGINT) AS day_of_week,
                round(avg(v), 6) AS typical_views, round(avg(e), 6) AS typical_engagement,
                CASE WHEN hour(bucket) >= 18 THEN 'Prime Time'
                    WHEN hour(bucket) >= 12 THEN 'Afternoon'
                    WHEN hour(bucket) >= 6 THEN 'Morning' ELSE 'Late Night' END AS time_segment
                FROM hours GROUP BY 1, 2, 5""",
        ),
        "storage_summary": _on(
            _DAILY,
            """SELECT count(DISTINCT video_id) AS unique_videos, count(*) AS total_records,
                count(DISTINCT country) AS countries, min(trending_date) AS earliest_date,
                max(trending_date) AS latest_date FROM d""",
        ),
        "basic_stats": _on(_DAILY, _BASIC.format(more="")),
        "country_stats": _on(_DAILY, _COUNTRY_STATS),
        "country_stats_top5": _on(
            _DAILY, f"{_COUNTRY_STATS} ORDER BY avg_views DESC, source_file LIMIT 5"
        ),
        "monthly_series": _on(f"{_DAILY}, {_MONTHS}", "SELECT * FROM months"),
        "monthly_summary": _on(
            f"{_DAILY}, {_MONTHS}",
            """SELECT avg(videos) AS avg_per_month,
                (SELECT month FROM months ORDER BY videos DESC, month LIMIT 1) AS peak_month,
                max(videos) AS peak_videos FROM months""",
        ),
        "correlation_matrix": _on(_DAILY, _CORR),
        "correlation_pairs": _on(
            _DAILY,
            f"SELECT * FROM ({_CORR}) ORDER BY corr DESC NULLS LAST, col_a, col_b LIMIT 3",
        ),
        "trending_analysis": _on(*_trending(_DAILY, "d")),
        "trending_analysis_skewed": _on(
            *_trending(
                f"""{_DAILY}, s AS (SELECT * REPLACE (
                    CASE WHEN views % 3 = 0 THEN 'hot channel' ELSE channel_title END AS channel_title,
                    CASE WHEN views % 3 = 0 THEN 'hot video' ELSE video_id END AS video_id,
                    CASE WHEN views % 3 = 0 THEN 'hot title' ELSE title END AS title,
                    CASE WHEN views % 3 = 0 THEN 1 ELSE category_id END AS category_id,
                    CASE WHEN views % 3 = 0 THEN 'HOT' ELSE country END AS country,
                    CASE WHEN views % 6 = 0 THEN DATE '1996-01-01' ELSE trending_date END
                        AS trending_date) FROM d)""",
                "s",
            )
        ),
        "trending_top_n": _on(
            _DAILY,
            f"""SELECT country, trending_date, video_id, views, {_DAILY_RANK} FROM d
                QUALIFY daily_rank <= 3""",
        ),
        "window_daily_rank": _on(
            _DAILY, f"SELECT country, trending_date, views, {_DAILY_RANK} FROM d"
        ),
        "window_percent_rank": _on(
            _DAILY,
            """SELECT category_id, video_id, views,
                percent_rank() OVER (PARTITION BY category_id ORDER BY views) AS percentile
                FROM d""",
        ),
        "window_channel_momentum": _on(
            _DAILY, f"SELECT channel_title, {_CHANNEL_ORDER}, {_CHANNEL_WINDOWS} FROM d"
        ),
        "window_previous_views": _on(
            _DAILY, f"SELECT video_id, {_VIDEO_ORDER}, {_PREVIOUS} FROM d"
        ),
        "window_one_channel": _on(
            _DAILY,
            f"""SELECT {_CHANNEL_ORDER}, 'all' AS channel_title, lag(views) OVER w AS prev_views,
                    avg(views) OVER (w ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS moving_avg,
                    CAST(sum(views) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_views,
                    row_number() OVER w AS pos
                FROM d WINDOW w AS (ORDER BY {_CHANNEL_ORDER})""",
        ),
        "topic_viral_factors": _on(f"{_DAILY}, {_viral('d')}", _VIRAL_OUT),
        "topic_viral_factors_text": _on(f"{_TEXT}, {_viral('t')}", _VIRAL_OUT),
        "topic_time_performance": _on(
            f"{_HOURLY}, {_TIMING}",
            """SELECT * REPLACE (round(avg_engagement, 6) AS avg_engagement) FROM cells
                WHERE sample_size > 5""",
        ),
        "topic_optimal_timing": _on(f"{_HOURLY}, {_TIMING}", "SELECT * FROM timing"),
        "topic_category_evolution": _on(f"{_DAILY}, {_EVOLUTION}", "SELECT * FROM evolution"),
        "topic_channel_strategies": _on(f"{_DAILY}, {_STRATEGIES}", "SELECT * FROM strategies"),
        "dedupe_first": _on(
            _DAILY,
            """SELECT video_id, trending_date, country, category_id, views, likes FROM d
                QUALIFY row_number() OVER (PARTITION BY video_id
                    ORDER BY trending_date, country, category_id, views, likes) = 1""",
        ),
        "union_by_name": _on(
            f"{_DAILY}, {_HOURLY}",
            """SELECT video_id, views, dislikes, NULL AS event_type FROM d
                UNION ALL SELECT video_id, views, NULL, event_type FROM h""",
        ),
        "distinct_partitions": _on(
            _DAILY,
            """SELECT count(*) AS partitions
                FROM (SELECT DISTINCT trending_date, country FROM d)""",
        ),
        "key_uniqueness": _on(
            _DAILY,
            """SELECT video_id, trending_date, count(*) AS count FROM d
                GROUP BY 1, 2 HAVING count(*) > 1""",
        ),
        "distinct_ids_limit": _on(
            _DAILY, "SELECT DISTINCT video_id FROM d ORDER BY video_id LIMIT 100"
        ),
        "head_n": _on(
            _HOURLY, "SELECT video_id, views, country FROM h ORDER BY views DESC, video_id LIMIT 25"
        ),
        "id_batches": _on(
            f"""{_DAILY},
            ids AS (
                SELECT video_id, row_number() OVER (ORDER BY video_id) AS pos
                FROM (SELECT DISTINCT video_id FROM d)
            )""",
            """SELECT (pos - 1) // 50 AS batch, count(*) AS size,
                string_agg(video_id, ',' ORDER BY video_id) AS ids FROM ids GROUP BY 1""",
        ),
        "top5_sums": _on(
            _DAILY,
            """SELECT title, CAST(sum(views) AS BIGINT) AS sum_views FROM d GROUP BY title
                ORDER BY sum_views DESC, title LIMIT 5""",
        ),
        "manifest_filter_top": """
            SELECT * FROM (
                SELECT page_id AS key, 'file' || page_id || CASE page_id % 6 WHEN 0 THEN '.csv'
                        WHEN 1 THEN '.JSON' WHEN 2 THEN '.txt.gz' WHEN 3 THEN '.tsv'
                        WHEN 4 THEN '.png' ELSE '.bin' END AS filename,
                    CAST(length(html) AS DOUBLE) / 100 AS size_mb,
                    page_id * 7919 % 1009 AS downloads
                FROM pages)
            WHERE size_mb > 0 AND size_mb < 100
                AND regexp_matches(lower(filename), '\\.(csv|json|txt|tsv)')
            ORDER BY downloads DESC, key LIMIT 5""",
        "radar_frame": _on(
            f"{_DAILY}, {_viral('d')}",
            """SELECT viral_category, round(avg_title_length / 100, 6) AS title_length,
                round(avg_tag_count / 50, 6) AS tag_count,
                round(avg_engagement * 100, 6) AS engagement, has_caps_ratio AS caps_usage,
                has_punctuation_ratio AS punctuation FROM viral""",
        ),
        "heatmap_pivot": _on(
            f"{_HOURLY}, {_TIMING}",
            "SELECT day_of_week, "
            + ", ".join(
                f"max(CASE WHEN hour = {i} THEN global_avg_views END) AS hour_{i}"
                for i in range(24)
            )
            + " FROM timing GROUP BY day_of_week",
        ),
        "evolution_frame": _on(
            f"{_DAILY}, {_EVOLUTION}",
            """SELECT month, category_id, total_views FROM evolution WHERE category_id IN (
                SELECT category_id FROM evolution GROUP BY category_id
                ORDER BY sum(total_views) DESC, category_id LIMIT 5)""",
        ),
        "strategy_unpivot": _on(
            f"{_DAILY}, {_STRATEGIES}",
            """SELECT performance_tier, 'Category Diversity' AS metric,
                    avg_category_diversity AS value FROM strategies
                UNION ALL SELECT performance_tier, 'Consistency', avg_consistency FROM strategies
                UNION ALL SELECT performance_tier, 'Peak Ratio', avg_peak_ratio FROM strategies""",
        ),
        "clean_facts": _on(
            _CLEAN,
            f"""SELECT *, {rate_cleaner} AS engagement_rate,
                {ratio_cleaner('(likes + dislikes)')} AS like_ratio,
                {_name("'Unknown'")} AS category_name FROM kept""",
        ),
        "cleaning_report": _on(
            f"""{_CLEAN},
            c AS (
                SELECT (SELECT count(*) FROM raw) AS r, (SELECT count(*) FROM firsts) AS f,
                    (SELECT count(*) FROM titled) AS t, (SELECT count(*) FROM kept) AS k
            )""",
            """SELECT r AS initial_rows, r - f AS duplicates, f - t AS missing_titles,
                t - k AS outliers, k AS kept_rows, CAST(k AS DOUBLE) / r * 100 AS kept_percent
                FROM c""",
        ),
        "window_trends_batch": _on(_WINDOWS, "SELECT * FROM trends"),
        "window_trends_stream": _on(_WINDOWS, "SELECT * FROM trends"),
        "window_trends_complete": _on(_WINDOWS, "SELECT * FROM trends"),
        "window_trends_late": _on(_WINDOWS, "SELECT * FROM trends"),
        "window_trends_late_report": _on(
            _WINDOWS,
            """SELECT (SELECT count(*) FROM trends) AS windows, count(*) AS late_windows FROM (
                SELECT DISTINCT window_start, video_id FROM placed
                WHERE ts <= (SELECT min(ts) FROM events) + INTERVAL 1 HOUR)""",
        ),
        "stream_to_catalog": _on(
            _WINDOWS,
            """SELECT CAST(video_id AS VARCHAR) AS video_id, views_delta, likes_delta,
                ts AS processing_time, 'events' AS stream FROM deltas""",
        ),
        "stream_ingest": """
            SELECT event_id, true AS has_id, true AS delta_in_range, true AS is_timed
            FROM events""",
        "collection_summary": _on(
            f"{_DAILY}, {_HOURLY}, {_TEXT}",
            """SELECT 'daily' AS source, 'complete' AS status, count(*) AS records,
                    count(DISTINCT video_id) AS unique_videos,
                    count(DISTINCT country) AS countries, avg(views) AS avg_views FROM d
                UNION ALL SELECT 'hourly', 'complete', count(*), count(DISTINCT video_id),
                    count(DISTINCT country), avg(views) FROM h
                UNION ALL SELECT 'documents', 'complete', count(*), count(DISTINCT video_id),
                    count(DISTINCT country), avg(views) FROM t
                UNION ALL SELECT 'pages', 'complete', count(*), NULL, NULL, NULL FROM pages""",
        ),
        "job_load_channels": _on(_LOADED, "," + _CHANNELS),
        "job_load_trends": _on(
            _LOADED,
            f"""SELECT category_id, min(category_name) AS category_name, {_TRENDS} FROM d
                WHERE category_id IS NOT NULL GROUP BY 1, 3, 4, 5""",
        ),
        "job_load_reach": _on(
            _YEARLY,
            """SELECT channel_title, count(*) AS n, count(DISTINCT video_id) AS unique_videos
                FROM d GROUP BY channel_title""",
        ),
        "job_load_increments": _on(
            _YEARLY,
            f"""SELECT category_id, min(category_name) AS category_name, {_TRENDS} FROM d
                WHERE category_id IS NOT NULL GROUP BY 1, 3, 4, 5""",
        ),
        "job_load_history": _on(
            _YEARLY,
            """SELECT video_id, trending_date, country, views, likes, dislikes, comment_count
                FROM typed""",
        ),
        "tables_fact_videos": _on(
            _YEARLY,
            """SELECT video_id, trending_date, country, category_id, views, likes,
                CAST(len(string_split(replace(channel_title, '#', '|'), '|')) AS BIGINT)
                    AS tag_count,
                round(engagement_rate * CASE WHEN views > 0 THEN log10(views) * 100 END, 6)
                    AS virality_score
                FROM d""",
        ),
        "tables_category_trends": _on(
            _YEARLY,
            f"""SELECT category_id, min(category_name) AS category_name, {_TRENDS} FROM d
                WHERE category_id IS NOT NULL GROUP BY 1, 3, 4, 5""",
        ),
        "tables_dim_channels": _on(
            _YEARLY,
            f"""SELECT md5(channel_title) AS channel_id, channel_title, total_videos,
                {_name("NULL")} AS channel_type
                FROM (SELECT channel_title, count(DISTINCT video_id) AS total_videos
                    FROM d WHERE channel_title IS NOT NULL GROUP BY 1)
                LEFT JOIN (SELECT channel_title, category_id FROM d
                    WHERE category_id IS NOT NULL GROUP BY 1, 2
                    QUALIFY row_number() OVER (PARTITION BY channel_title
                        ORDER BY count(*) DESC, category_id) = 1) USING (channel_title)""",
        ),
        "tables_time_series": _on(_YEARLY, _TIME_SERIES.format(src="d")),
        "tables_storage_summary": _on(
            _YEARLY,
            """SELECT count(DISTINCT video_id) AS unique_videos, count(*) AS total_records,
                count(DISTINCT country) AS countries, min(trending_date) AS earliest_date,
                max(trending_date) AS latest_date FROM d""",
        ),
        "external_csv_table": _on(
            _DAILY,
            """SELECT video_id, trending_date, title, category_id,
                array_to_string(tags, '|') AS tags, views, likes,
                CAST(NULL AS BOOLEAN) AS comments_disabled, country FROM d""",
        ),
        "summary_document": _on(
            f"{_DAILY}, {_MONTHS}",
            f"""SELECT (SELECT count(*) FROM d) AS total_videos,
                (SELECT count(DISTINCT video_id) FROM d) AS unique_videos,
                (SELECT CAST(sum(views) AS BIGINT) FROM d) AS total_views,
                (SELECT {_name("'Unknown'")} AS name FROM d GROUP BY 1
                    ORDER BY count(*) DESC, name LIMIT 1) AS top_category,
                (SELECT CAST(month AS VARCHAR) FROM months ORDER BY videos DESC, month LIMIT 1)
                    AS peak_month,
                (SELECT string_agg(name, '; ' ORDER BY n DESC, name) FROM (
                    SELECT {_name("'Unknown'")} AS name, count(*) AS n FROM d GROUP BY 1
                    ORDER BY n DESC, name LIMIT 5)) AS categories,
                (SELECT string_agg(source_file, '; ' ORDER BY avg_views DESC, source_file)
                    FROM (SELECT * FROM ({_COUNTRY_STATS})
                        ORDER BY avg_views DESC, source_file LIMIT 5)) AS files,
                true AS is_stamped""",
        ),
        "text_size_mb": """
            SELECT source, CAST(sum(strlen(text)) AS BIGINT) AS bytes,
                CAST(sum(strlen(text)) AS DOUBLE) / 1048576 AS mb,
                CAST(sum(strlen(text)) AS DOUBLE) / 1073741824 AS gb
            FROM documents GROUP BY source""",
        "job_load_time_series": _on(_LOADED, _TIME_SERIES.format(src="d")),
        "job_batch_enrich": _on(
            _DAILY,
            f"""SELECT video_id, trending_date, nullif({_LOOSE_COUNTRY}, '') AS country, views,
                CAST(likes + comment_count AS DOUBLE) / nullif(views, 0) AS engagement_rate,
                CAST(likes AS DOUBLE) / nullif(likes + dislikes, 0) AS like_ratio,
                CAST(len(tags) AS BIGINT) AS tag_count,
                round(CASE WHEN views > 0 THEN log10(views) END
                    * (CAST(likes + comment_count AS DOUBLE) / nullif(views, 0)) * 100, 6)
                    AS virality_score
                FROM d""",
        ),
        "job_summarise": _on(
            f"{_DAILY}, {_MONTHS}",
            _BASIC.format(
                more=f""",
    (SELECT {_name("'Unknown'")} AS name FROM d GROUP BY 1
        ORDER BY count(*) DESC, name LIMIT 1) AS top_category,
    (SELECT avg(videos) FROM months) AS avg_per_month,
    (SELECT month FROM months ORDER BY videos DESC, month LIMIT 1) AS peak_month,
    (SELECT max(videos) FROM months) AS peak_videos"""
            ),
        ),
        "profile": _on(
            _DAILY,
            """SELECT count(*) AS rows, CAST(16 AS BIGINT) AS columns,
                'video_id,title,channel_title,category_id,publish_time' AS first_columns FROM d""",
        ),
        "size_ratio": _on(
            f"""{_LOADED},
            c AS (
                SELECT CAST(sum({_chars('raw.')}) AS BIGINT) AS initial_chars FROM raw
            ),
            f AS (
                SELECT CAST(sum({_chars('')}) AS BIGINT) AS final_chars
                FROM (SELECT * REPLACE (CAST(category_id AS BIGINT) AS category_id,
                        {_whole('views')} AS views, {_whole('likes')} AS likes,
                        coalesce({_whole('dislikes')}, 0) AS dislikes,
                        TRY_CAST(trending_date AS DATE) AS trending_date,
                        TRY_CAST(publish_time AS TIMESTAMP) AS publish_time) FROM raw)
            )""",
            """SELECT initial_chars, final_chars,
                (1 - CAST(final_chars AS DOUBLE) / initial_chars) * 100 AS saved_percent
                FROM c, f""",
        ),
        "api_items": _on(
            _RAW,
            """SELECT video_id, title, category_id, views AS view_count, likes AS like_count,
                CAST(NULL AS VARCHAR) AS comment_count, duration FROM raw""",
        ),
    }
    for fmt in ("orc", "parquet", "csv", "tsv", "json"):
        sql[f"roundtrip_{fmt}"] = _on(_DAILY, _TRIP)
    sql["roundtrip_csv_dirty"] = """
        SELECT CAST(p_partkey AS VARCHAR) AS video_id, p_name || ', ' || chr(233) AS title,
            CASE WHEN p_partkey % 10 <> 1 THEN CAST(p_size AS VARCHAR) END AS views
        FROM part WHERE p_partkey % 10 <> 0"""
    sql["roundtrip_csv_dir"] = _on(
        _DAILY,
        """SELECT video_id, title, country, CAST(trending_date AS VARCHAR) AS trending_date,
            CAST(views AS VARCHAR) AS views, CAST(likes AS VARCHAR) AS likes FROM d""",
    )
    return {k: v.replace(")\n,\n", "),\n") for k, v in sql.items()}
