"""SQL that computes each registered query from the same Parquet tables.

Rounded ratios are formed from whole numbers, so no binary fraction is rounded.
"""


def cents(total, n="1", unit=1):
    """``total / (unit * n)`` hundredths, rounded half away from zero, as a double.

    ``total`` is a whole-number expression in units of 1/(100 * unit).
    """
    return (f"CAST(CASE WHEN {n} = 0 THEN NULL ELSE SIGN({total}) * "
            f"((2 * ABS({total}) + {unit} * ({n})) // (2 * {unit} * ({n}))) END AS DOUBLE)"
            f" / 100.0")


def units(column, scale):
    return f"CAST({column} * {10 ** scale} AS BIGINT)"


AVG_COMPLETION = cents(f"SUM({units('completion_pct', 2)})", "COUNT(completion_pct)")
AVG_ENGAGEMENT = cents(f"SUM({units('engagement_score', 4)})", "COUNT(engagement_score)", 100)
REVENUE = cents(f"SUM({units('revenue_per_view', 4)})", "1", 100)
PRICE_REVENUE = "CAST(SUM(subscription_price) AS DOUBLE)"
COMPLETED = "CAST(SUM(is_completed) AS BIGINT)"
DROPPED = "CAST(SUM(is_dropped) AS BIGINT)"

# One row per event with all silver columns; raw_pct is the completion, before any check.
SILVER = """
WITH typed AS (
  SELECT e.event_id AS event_no, e.user_id AS user_no, e.ts, e.event_type,
         CAST(e.value AS DECIMAL(12,2)) AS raw_pct,
         CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS content_no
  FROM events e
), joined AS (
  SELECT t.*, p.p_name, p.p_size, p.p_type, p.p_brand, n.n_name, n.n_nationkey, r.r_name,
         raw_pct AS completion_pct
  FROM typed t
  LEFT JOIN part p ON p.p_partkey = t.content_no
  LEFT JOIN customer c ON c.c_custkey = t.user_no
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
), watch AS (
  SELECT CAST(event_no AS VARCHAR) AS event_id,
         ts AS event_timestamp,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS event_text,
         CAST(ts AS DATE) AS event_date,
         CAST(hour(ts) AS INTEGER) AS event_hour,
         dayname(ts) AS event_day,
         CAST(month(ts) AS INTEGER) AS event_month,
         CASE WHEN hour(ts) BETWEEN 18 AND 23 THEN 1 ELSE 0 END AS is_prime_time,
         CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend,
         CAST(user_no AS VARCHAR) AS user_id,
         CASE (event_no // 3) % 5 WHEN 0 THEN '18-24' WHEN 1 THEN '25-34' WHEN 2 THEN '35-44'
                          WHEN 3 THEN '45-54' ELSE '55+' END AS age_group,
         CAST(content_no AS VARCHAR) AS content_id,
         p_name AS content_title,
         CASE WHEN p_size > 25 THEN 'Movie' ELSE 'Series' END AS content_type,
         p_type AS raw_genre,
         trim(upper(p_type)) AS genre,
         p_brand AS language,
         event_type AS action,
         raw_pct AS watch_duration_mins,
         100 AS total_duration_mins,
         raw_pct,
         completion_pct,
         CASE WHEN raw_pct >= 90 THEN 1 ELSE 0 END AS is_completed,
         CASE WHEN raw_pct < 10 THEN 1 ELSE 0 END AS is_dropped,
         CASE event_no % 5 WHEN 0 THEN 'SMARTTV' WHEN 3 THEN 'LAPTOP' WHEN 4 THEN 'TABLET'
                           ELSE 'MOBILE' END AS device_type,
         CASE event_no % 5 WHEN 0 THEN 'Android TV' WHEN 1 THEN 'Android'
                           WHEN 3 THEN 'Windows' ELSE 'iOS' END AS device_os,
         n_name AS city,
         'STATE_' || CAST(n_nationkey % 10 AS VARCHAR) AS state,
         r_name AS raw_region,
         trim(upper(r_name)) AS region,
         CASE event_no % 3 WHEN 0 THEN 'BASIC' WHEN 1 THEN 'STANDARD' ELSE 'PREMIUM' END
           AS subscription_plan,
         CASE event_no % 3 WHEN 0 THEN 149 WHEN 1 THEN 299 ELSE 649 END AS subscription_price
  FROM joined
), silver AS (
  SELECT *,
         CASE WHEN completion_pct >= 90 THEN 'COMPLETED' WHEN completion_pct >= 50
              THEN 'MAJORITY' ELSE 'PARTIAL' END AS completion_category,
         CASE WHEN device_type IN ('MOBILE', 'TABLET') THEN 'MOBILE'
              WHEN device_type IN ('SMARTTV', 'ROKU') THEN 'TV' ELSE 'DESKTOP' END
           AS device_category,
         CASE WHEN event_hour BETWEEN 5 AND 11 THEN 'MORNING'
              WHEN event_hour BETWEEN 12 AND 17 THEN 'AFTERNOON'
              WHEN event_hour BETWEEN 18 AND 23 THEN 'EVENING' ELSE 'NIGHT' END AS time_of_day,
         CAST(CAST(0.7 AS DECIMAL(2,1)) * completion_pct + 30 * is_completed
              AS DECIMAL(14,4)) AS engagement_score,
         CAST(CAST(subscription_price * CAST(completion_pct * 100 AS BIGINT)
              AS DECIMAL(18,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(14,4))
           AS revenue_per_view
  FROM watch
), dim_content AS (
  SELECT DISTINCT content_id, content_title, content_type, genre, language FROM silver
  WHERE content_id IS NOT NULL AND content_title IS NOT NULL
), dim_users AS (
  SELECT DISTINCT user_id, age_group, subscription_plan, subscription_price FROM silver
  WHERE user_id IS NOT NULL
), dim_devices AS (
  SELECT DISTINCT device_type, device_os, device_category FROM silver
), dim_locations AS (
  SELECT DISTINCT city, state, region FROM silver WHERE city IS NOT NULL
), dim_date AS (
  SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
         CAST(day(date) AS INTEGER) AS day, CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
         CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
         monthname(date) AS month_name
  FROM (SELECT DISTINCT event_date AS date FROM silver)
), fact AS (
  SELECT event_id, event_timestamp, event_date, user_id, content_id, device_type, city,
         watch_duration_mins, completion_pct, subscription_plan, subscription_price,
         engagement_score, revenue_per_view, is_completed, is_dropped, is_prime_time,
         is_weekend, event_day, time_of_day, completion_category
  FROM silver
), bronze AS (
  SELECT silver.*, 'bulk_history' AS source, TIMESTAMP '2024-01-16 00:00:00' AS ingested_at
  FROM silver
  UNION ALL
  SELECT silver.*, 'message_stream' AS source, event_timestamp + INTERVAL 5 SECOND AS ingested_at
  FROM silver
  UNION ALL
  SELECT silver.* REPLACE ('again ' || action AS action), 'message_stream' AS source,
         event_timestamp + INTERVAL 5 SECOND AS ingested_at
  FROM silver WHERE CAST(event_id AS BIGINT) % 10 = 0
), deduplicated AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingested_at, source, action) AS place
    FROM bronze)
  WHERE place = 1
)
"""

# Field name -> SQL of a watch record as it is sent.
RECORD = {
    "event_id": "event_id", "event_timestamp": "event_text", "event_hour": "event_hour",
    "event_day": "event_day", "event_month": "event_month", "is_prime_time": "is_prime_time",
    "is_weekend": "is_weekend", "user_id": "user_id", "age_group": "age_group",
    "content_id": "content_id", "content_title": "content_title",
    "content_type": "content_type", "genre": "raw_genre", "language": "language",
    "action": "action", "watch_duration_mins": "watch_duration_mins",
    "total_duration_mins": "total_duration_mins", "completion_pct": "CAST(raw_pct AS DOUBLE)",
    "is_completed": "is_completed", "is_dropped": "is_dropped", "device_type": "device_type",
    "device_os": "device_os", "city": "city", "state": "state", "region": "raw_region",
    "subscription_plan": "subscription_plan", "subscription_price": "subscription_price",
}
NUMBERS = {"event_hour", "event_month", "is_prime_time", "is_weekend", "watch_duration_mins",
           "total_duration_mins", "completion_pct", "is_completed", "is_dropped",
           "subscription_price"}


def record_columns():
    sent = {**RECORD, "watch_duration_mins": "CAST(watch_duration_mins AS DOUBLE)"}
    return ", ".join(f"{sql} AS {name}" for name, sql in sent.items())


def record_json():
    fields = []
    for name, sql in RECORD.items():
        text = f"CAST({sql} AS VARCHAR)"
        fields.append(f"""'"{name}":' || """ + (text if name in NUMBERS
                                                 else f"""'"' || {text} || '"'"""))
    return "'{' || " + " || ',' || ".join(fields) + " || '}'"


def aggregation(by, source="fact", where="TRUE", limit=None, also=""):
    return f"""
SELECT {also}{by}, COUNT(event_id) AS total_views, {AVG_COMPLETION} AS avg_completion,
       {AVG_ENGAGEMENT} AS avg_engagement, {REVENUE} AS total_revenue,
       {COMPLETED} AS completed_views, {DROPPED} AS dropped_views,
       {cents('SUM(is_completed) * 10000', 'COUNT(*)')} AS completion_rate_pct
FROM {source} WHERE {where} GROUP BY {also}{by} ORDER BY total_views DESC, {by}
""" + (f"LIMIT {limit}" if limit else "")


def content(order_by, where="TRUE", limit=None, also=""):
    keys = "c.content_title, c.genre, c.language, c.content_type"
    return f"""
SELECT {also}{keys}, COUNT(f.event_id) AS total_views, {AVG_COMPLETION} AS avg_completion,
       {AVG_ENGAGEMENT} AS avg_engagement, {REVENUE} AS total_revenue,
       {COMPLETED} AS completed_views, {DROPPED} AS dropped_views
FROM fact f JOIN dim_content c ON f.content_id = c.content_id
WHERE {where} GROUP BY {also}{keys} ORDER BY {order_by} DESC, {keys}
""" + (f"LIMIT {limit}" if limit else "")


def time_analysis(by, where="TRUE"):
    return f"""
SELECT {by}, COUNT(event_id) AS total_views, {AVG_COMPLETION} AS avg_completion,
       {AVG_ENGAGEMENT} AS avg_engagement,
       CAST(SUM(is_prime_time) AS BIGINT) AS prime_time_views,
       CAST(SUM(is_weekend) AS BIGINT) AS weekend_views
FROM fact WHERE {where} GROUP BY {by} ORDER BY {by}
"""


def location(where="TRUE", limit=None):
    keys = "l.city, l.state, l.region"
    return f"""
SELECT {keys}, COUNT(f.event_id) AS total_views, {AVG_COMPLETION} AS avg_completion,
       {AVG_ENGAGEMENT} AS avg_engagement, {REVENUE} AS total_revenue,
       COUNT(DISTINCT f.user_id) AS unique_users
FROM fact f JOIN dim_locations l ON f.city = l.city
WHERE {where} GROUP BY {keys} ORDER BY total_views DESC, {keys}
""" + (f"LIMIT {limit}" if limit else "")


def revenue(plan, source):
    return f"""
SELECT {plan} AS subscription_plan, COUNT(f.event_id) AS total_views,
       CAST(SUM(f.subscription_price) AS DOUBLE) AS total_revenue
FROM {source} GROUP BY {plan} ORDER BY total_revenue DESC, {plan}
"""


def frequency(column, limit=None, name="views", source="silver"):
    return f"""
SELECT {column}, COUNT(*) AS {name} FROM {source} GROUP BY {column}
ORDER BY {name} DESC, {column}
""" + (f"LIMIT {limit}" if limit else "")


def orphans(key, checks):
    return " UNION ALL ".join(f"""
SELECT '{name}' AS dimension, COUNT(*) AS orphan_rows, COUNT(DISTINCT f.{key}) AS orphan_keys
FROM fact f WHERE NOT EXISTS
  (SELECT 1 FROM {dim} d WHERE d.{key} = f.{key} AND {where})
""" for name, (dim, where) in checks.items())


def profile(layers):
    return " UNION ALL ".join(f"""
SELECT '{name}' AS table_name, COUNT(*) AS total_rows, COUNT(DISTINCT event_id) AS distinct_keys,
       COUNT(*) - COUNT(DISTINCT event_id) AS duplicates FROM {source}
""" for name, source in layers.items())


RULES = {
    "valid_content_id": "content_id IS NOT NULL",
    "valid_content_title": "content_title IS NOT NULL",
    "valid_user_id": "user_id IS NOT NULL",
    "valid_city": "city IS NOT NULL",
    "valid_completion": "raw_pct BETWEEN 0 AND 100",
}


ALL_RULES = " AND ".join(RULES.values())
# Columns of a stored event that are sent, which may be NULL.
SENT = ["event_id", "user_id", "content_id", "content_title", "genre", "language", "city", "state",
        "region", "device_type", "completion_pct"]


def keyed(dim, columns):
    order = ", ".join(f"{c} NULLS FIRST" for c in columns)
    texts = ", ".join(f"CAST({c} AS VARCHAR)" for c in columns)
    return f"""
SELECT '{dim}' AS dim, natural_key, dim_key FROM (
  SELECT natural_key, CAST(row_number() OVER (ORDER BY natural_key >= 'M', {order}) AS BIGINT)
    AS dim_key FROM (SELECT *, concat_ws('|', {texts}) AS natural_key FROM {dim}))
"""


FACT_COLUMNS = """event_id, event_timestamp, event_date, user_id, content_id, device_type, city,
  CAST(watch_duration_mins AS DOUBLE) AS watch_duration_mins,
  CAST(completion_pct AS DOUBLE) AS completion_pct, subscription_plan, subscription_price,
  CAST(engagement_score AS DOUBLE) AS engagement_score,
  CAST(revenue_per_view AS DOUBLE) AS revenue_per_view, is_completed, is_dropped,
  is_prime_time, is_weekend, event_day, time_of_day, completion_category"""

_AFTER_SILVER = {
    # sources and sinks
    "scan_json_bulk": f"SELECT {record_columns()} FROM silver",
    "bronze_stamp": """SELECT event_id, user_id, action, 'bulk_history' AS source,
                       TRUE AS is_stamped FROM silver""",
    "write_overwrite": """SELECT event_id, user_id, CAST(completion_pct AS DOUBLE)
                          AS completion_pct, completion_category FROM silver""",
    "save_gold": """SELECT COUNT(*) AS total_rows, COUNT(*) AS distinct_fact_keys,
                    CAST(0 AS BIGINT) AS duplicates FROM fact""",
    "register_table": "SELECT event_id, device_type, is_completed FROM silver",
    "preview": """SELECT event_id, user_id, device_type, completion_category FROM silver
                  ORDER BY event_id LIMIT 5""",
    "encode_events": f"SELECT event_id AS key, {record_json()} AS value FROM silver",
    "json_parse": f"SELECT {record_columns()} FROM silver",
    "path_fallback": "SELECT event_id, device_type, is_completed FROM silver",
    "stream_restarts": """
        SELECT n % 3 AS delivery, COUNT(*) AS read_rows, COUNT(*) AS stored_rows,
               COUNT(DISTINCT n) AS stored_events, TRUE AS four_batches
        FROM (SELECT event_id AS n FROM events) GROUP BY n % 3""",
    "stream_status": """
        SELECT CAST(batch AS BIGINT) AS batch_id,
               COUNT(*) FILTER (WHERE batch = 0 OR event_id % 4 = 0) AS input_rows,
               CAST(0 AS BIGINT) AS late_rows, CAST(0 AS BIGINT) AS state_rows,
               TRUE AS timed, TRUE AS own_run
        FROM events, range(2) AS t(batch) GROUP BY batch""",
    "silver_increment": """
        SELECT event_date, COUNT(*) AS events,
               COUNT(*) FILTER (WHERE day(event_date) = 27 AND n % 5 = 2) AS replaced,
               COUNT(*) FILTER (WHERE day(event_date) IN (20, 21) AND n % 5 = 1
                                   OR day(event_date) = 27 AND n % 5 = 2) = 0 AS files_stay
        FROM (SELECT event_date, CAST(event_id AS BIGINT) AS n FROM silver)
        GROUP BY event_date""",
    "fact_keys_over_loads": """
        SELECT event_date, COUNT(*) AS events, COUNT(*) AS distinct_keys,
               COUNT(*) FILTER (WHERE NOT late) AS kept_keys,
               COUNT(*) FILTER (WHERE late) AS new_keys
        FROM (SELECT event_date, day(event_date) IN (20, 21)
                                 AND CAST(event_id AS BIGINT) % 5 = 1 AS late FROM silver)
        GROUP BY event_date""",
    "stream_bronze": f"SELECT {record_columns()}, 'message_stream' AS source FROM silver",
    "bronze_union": """
        SELECT source, COUNT(*) AS row_count, COUNT(DISTINCT event_id) AS event_count,
               MIN(ingested_at) AS first_ingested_at, MAX(ingested_at) AS last_ingested_at
        FROM bronze GROUP BY source""",
    # silver
    "project": "SELECT event_id, user_id, content_id, device_type FROM silver",
    "completion_category": "SELECT event_id, completion_category FROM silver",
    "device_category": "SELECT event_id, device_type, device_category FROM silver",
    "dedupe_event_id": """SELECT event_id, event_timestamp, user_id, action, source,
                          ingested_at FROM deduplicated""",
    "silver_summary": f"""
        SELECT completion_category, COUNT(*) AS total, {AVG_COMPLETION} AS avg_pct
        FROM silver GROUP BY completion_category ORDER BY total DESC, completion_category""",
    "top_titles": frequency("content_title", 5),
    "top_cities": frequency("city", 5),
    "device_breakdown": frequency("device_type"),
    # star schema
    "dim_content": "SELECT * FROM dim_content",
    "dim_users": "SELECT * FROM dim_users",
    "dim_devices": "SELECT * FROM dim_devices",
    "dim_locations": "SELECT * FROM dim_locations",
    "dim_date": "SELECT * FROM dim_date",
    "dim_keys": " UNION ALL ".join([
        keyed("dim_content", ["content_id", "content_title", "content_type", "genre", "language"]),
        keyed("dim_users", ["user_id", "age_group", "subscription_plan", "subscription_price"]),
        keyed("dim_devices", ["device_type", "device_os", "device_category"]),
        keyed("dim_locations", ["city", "state", "region"]),
        keyed("dim_date", ["date"]),
    ]),
    "fact_watch_events": f"SELECT {FACT_COLUMNS} FROM fact",
    "star_genre_views": f"""
        SELECT c.genre, COUNT(f.event_id) AS total_views, {AVG_COMPLETION} AS avg_completion
        FROM fact f JOIN dim_content c ON f.content_id = c.content_id
        GROUP BY c.genre ORDER BY total_views DESC, c.genre""",
    "star_revenue_by_plan_literal": revenue("u.subscription_plan", """fact f JOIN (
        SELECT DISTINCT user_id, subscription_plan, subscription_price FROM silver) u
        ON f.user_id = u.user_id"""),
    "star_revenue_by_plan": revenue(
        "f.subscription_plan", "fact f WHERE user_id IS NOT NULL"),
    "doc_top_content": """
        SELECT c.content_title, COUNT(*) AS views
        FROM fact f JOIN dim_content c ON f.content_id = c.content_id
        GROUP BY c.content_title ORDER BY views DESC, c.content_title""",
    "doc_prime_time": f"""
        SELECT time_of_day, COUNT(*) AS views, {AVG_COMPLETION} AS avg_completion
        FROM fact GROUP BY time_of_day ORDER BY views DESC, time_of_day""",
    # quality
    "dq_profile": profile({
        "bronze_bulk": "bronze WHERE source = 'bulk_history'",
        "bronze_stream": "bronze WHERE source = 'message_stream'",
        "bronze": "bronze", "silver": "deduplicated", "fact": "fact"}),
    "dq_duplicates": """
        SELECT COUNT(*) AS total_rows,
               COUNT(DISTINCT (user_id, content_id)) AS distinct_keys,
               COUNT(*) - COUNT(DISTINCT (user_id, content_id)) AS duplicates FROM bronze""",
    "dq_null_counts": """
        SELECT column_name, CASE WHEN sent THEN nulls ELSE row_count END AS null_count
        FROM (SELECT 'event_id' AS column_name, TRUE AS sent,
                     COUNT(*) - COUNT(event_id) AS nulls, COUNT(*) AS row_count FROM silver
              UNION ALL SELECT 'user_id', TRUE, COUNT(*) - COUNT(user_id), COUNT(*) FROM silver
              UNION ALL SELECT 'content_id', TRUE, COUNT(*) - COUNT(content_id), COUNT(*)
                        FROM silver
              UNION ALL SELECT 'event_type', FALSE, 0, COUNT(*) FROM silver
              UNION ALL SELECT 'watch_duration', FALSE, 0, COUNT(*) FROM silver
              UNION ALL SELECT 'timestamp', FALSE, 0, COUNT(*) FROM silver)""",
    "dq_range_stats": f"""
        SELECT CAST(MIN(raw_pct) AS DOUBLE) AS min_completion,
               CAST(MAX(raw_pct) AS DOUBLE) AS max_completion,
               {cents(f"SUM({units('raw_pct', 2)})", "COUNT(raw_pct)")} AS avg_completion
        FROM silver""",
    "dq_range": """
        SELECT COUNT(*) FILTER (WHERE raw_pct < 0 OR raw_pct > 100) AS invalid_completion,
               COUNT(*) FILTER (WHERE watch_duration_mins <= 0) AS invalid_duration,
               COUNT(*) FILTER (WHERE subscription_price <= 0) AS invalid_price
        FROM silver""",
    "dq_range_of_messages": f"""
        SELECT "check", row_count FROM (
          SELECT COUNT(*) FILTER (WHERE n % 7 = 0 OR raw_pct < 0 OR raw_pct > 100)
                   AS invalid_completion,
                 COUNT(*) FILTER (WHERE watch_duration_mins <= 0) AS invalid_duration,
                 COUNT(*) FILTER (WHERE subscription_price <= 0) AS invalid_price,
                 COUNT(*) FILTER (WHERE n % 17 = 0) AS no_time,
                 COUNT(*) FILTER (WHERE n % 13 = 0) AS no_duration
          FROM (SELECT *, CAST(event_id AS BIGINT) AS n FROM silver) WHERE n % 11 <> 0)
        UNPIVOT (row_count FOR "check" IN (invalid_completion, invalid_duration, invalid_price,
                                           no_time, no_duration))""",
    "rejected_messages": """
        SELECT reason, messages FROM (
          SELECT COUNT(*) FILTER (WHERE n % 11 = 0) AS unreadable,
                 COUNT(*) FILTER (WHERE n % 11 <> 0 AND n % 13 = 0) AS partly_readable,
                 CAST(0 AS BIGINT) AS "empty"
          FROM (SELECT event_id AS n FROM events))
        UNPIVOT (messages FOR reason IN (unreadable, partly_readable, "empty"))""",
    "publish_counts": """
        SELECT COUNT(*) AS success_count, CAST(0 AS BIGINT) AS failed_count, COUNT(*) AS stored,
               CAST(1100000 AS INTEGER) AS largest FROM silver""",
    "dq_dist_completion": frequency("completion_category", name="count"),
    "dq_dist_time_of_day": frequency("time_of_day", name="count"),
    "dq_orphan_content": orphans("content_id", {
        "dim_content": ("dim_content", "TRUE"),
        "movies": ("dim_content", "content_type = 'Movie'")}),
    "dq_orphan_city": orphans("city", {
        "dim_locations": ("dim_locations", "TRUE"),
        "one_region": ("dim_locations", "region = 'ASIA'")}),
    "dq_orphan_device": orphans("device_type", {
        "dim_devices": ("dim_devices", "TRUE"),
        "mobile": ("dim_devices", "device_category = 'MOBILE'")}),
    "dq_cross_layer": """
        SELECT bronze_events, rejected_messages, silver_rows, gold_rows,
               round((bronze_events - silver_rows) * 100.0 / bronze_events, 1)
                 AS bronze_to_silver_pct,
               round((silver_rows - gold_rows) * 100.0 / silver_rows, 1) AS silver_to_gold_pct,
               (bronze_events - silver_rows) * 100 < 10 * bronze_events AS bronze_to_silver_ok,
               (silver_rows - gold_rows) * 100 < 5 * silver_rows AS silver_to_gold_ok
        FROM (SELECT (SELECT COUNT(DISTINCT event_id) FROM bronze) AS bronze_events,
                     CAST(0 AS BIGINT) AS rejected_messages,
                     (SELECT COUNT(*) FROM deduplicated) AS silver_rows,
                     (SELECT COUNT(*) FROM deduplicated WHERE raw_pct BETWEEN 0 AND 100)
                       AS gold_rows)""",
    "expect_or_drop": "SELECT event_id, content_id FROM silver WHERE "
                      + " AND ".join(RULES.values()),
    "expect_or_drop_failures": " UNION ALL ".join(
        f"SELECT '{name}' AS rule, COUNT(*) FILTER (WHERE NOT coalesce({rule}, FALSE)) "
        f"AS failed_rows FROM silver" for name, rule in RULES.items()),
    "expect_or_drop_counted": " UNION ALL ".join(
        f"SELECT 'events' AS dataset, '{name}' AS rule, COUNT(*) FILTER (WHERE NOT coalesce({rule}, "
        f"FALSE)) AS failed_rows, COUNT(*) AS seen_rows, COUNT(*) FILTER (WHERE {ALL_RULES}) "
        f"AS kept_rows, COUNT(*) FILTER (WHERE {ALL_RULES}) AS stored_rows FROM silver"
        for name, rule in RULES.items()),
    "dq_stored_layers": f"""
        SELECT 'rows' AS "check", item, n AS value
        FROM (SELECT COUNT(*) AS n FROM silver),
             (VALUES ('bulk_history'), ('watch_obt'), ('fact_watch_events')) AS t(item)
        UNION ALL SELECT 'duplicates', item, 0
        FROM (VALUES ('bulk_history'), ('watch_obt'), ('fact_watch_events')) AS t(item)
        UNION ALL SELECT 'invalid', item, value FROM (
          SELECT COUNT(*) FILTER (WHERE raw_pct < 0 OR raw_pct > 100) AS invalid_completion,
                 COUNT(*) FILTER (WHERE watch_duration_mins <= 0) AS invalid_duration,
                 COUNT(*) FILTER (WHERE subscription_price <= 0) AS invalid_price FROM silver)
        UNPIVOT (value FOR item IN (invalid_completion, invalid_duration, invalid_price))
        UNION ALL SELECT 'nulls', item, value FROM (
          SELECT {", ".join(f"COUNT(*) - COUNT({c}) AS {c}" for c in SENT)} FROM silver)
        UNPIVOT (value FOR item IN ({", ".join(SENT)})) WHERE value > 0
        UNION ALL SELECT 'completion', completion_category, COUNT(*) FROM silver GROUP BY ALL
        UNION ALL SELECT 'time_of_day', time_of_day, COUNT(*) FROM silver GROUP BY ALL
        UNION ALL SELECT 'orphans', item, value FROM (
          SELECT COUNT(*) FILTER (WHERE content_id IS NULL OR content_title IS NULL) AS dim_content,
                 COUNT(*) FILTER (WHERE city IS NULL) AS dim_locations,
                 COUNT(*) FILTER (WHERE device_type IS NULL) AS dim_devices FROM silver)
        UNPIVOT (value FOR item IN (dim_content, dim_locations, dim_devices))
        UNION ALL SELECT 'loss', 'events', COUNT(DISTINCT event_id) - COUNT(*) FROM silver
        UNION ALL SELECT 'rejected', item, 0
        FROM (VALUES ('unreadable'), ('partly_readable'), ('empty')) AS t(item)
        UNION ALL SELECT 'missing', 'stream_events', 1""",
    # reports
    "report_views_by_device": aggregation("device_type", limit=10),
    "report_views_by_subscription": aggregation("subscription_plan", where="is_completed = 1"),
    "report_views_by_time_of_day": aggregation("time_of_day"),
    "report_views_by_completion_category": aggregation("completion_category"),
    "report_genre": content("total_views", "c.genre = 'ECONOMY'", 5),
    "report_all_content": content("total_revenue", limit=10),
    "report_views_by_day_of_week": time_analysis("event_day"),
    "report_time_range": time_analysis(
        "event_day",
        "event_timestamp BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12'"),
    "report_region": location("l.region = 'ASIA'", 5),
    "report_all_location": location(limit=8),
    "run_reports_status": " UNION ALL ".join([
        "SELECT 'failing' AS report, FALSE AS ok, CAST(NULL AS BIGINT) AS row_count",
        *[f"SELECT '{name}', TRUE, (SELECT COUNT(*) FROM ({sql}))" for name, sql in {
            "views_by_device": aggregation("device_type", limit=10),
            "views_by_subscription": aggregation("subscription_plan", where="is_completed = 1"),
            "views_by_time_of_day": aggregation("time_of_day"),
            "views_by_completion_category": aggregation("completion_category"),
            "economy_content_performance": content("total_views", "c.genre = 'ECONOMY'", 5),
            "all_content_performance": content("total_revenue", limit=10),
            "views_by_day_of_week": time_analysis("event_day"),
            "asia_region_performance": location("l.region = 'ASIA'", 5),
            "all_location_performance": location(limit=8),
        }.items()]]),
    # gold
    "gold_content_performance": content("total_views", also="f.content_id, "),
    "gold_user_engagement": f"""
        SELECT age_group, subscription_plan, COUNT(event_id) AS total_views,
               {AVG_COMPLETION} AS avg_completion, {AVG_ENGAGEMENT} AS avg_engagement,
               COUNT(DISTINCT user_id) AS unique_users
        FROM silver GROUP BY age_group, subscription_plan""",
    "gold_device_analytics": aggregation("device_type", "silver", also="device_category, "),
    "gold_revenue_summary": f"""
        SELECT subscription_plan, region, COUNT(event_id) AS total_views,
               {REVENUE} AS total_revenue
        FROM silver GROUP BY subscription_plan, region""",
    "gold_hourly_pulse": f"""
        SELECT date_trunc('hour', event_timestamp) AS event_hour_start,
               COUNT(event_id) AS total_views, {COMPLETED} AS completed_views,
               COUNT(DISTINCT user_id) AS unique_users
        FROM fact GROUP BY date_trunc('hour', event_timestamp)""",
    # A row is late if the watermark, which the deliveries before its own have set, has passed it.
    "gold_hourly_pulse_stream": """
        , sent AS (
          SELECT event_id, user_id, is_completed, event_timestamp AS ts,
                 least((day(event_timestamp) - 1) // 10, 2)
                   + CASE WHEN CAST(event_id AS BIGINT) % 10 = 0 THEN 1 ELSE 0 END AS delivery
          FROM fact),
        marks AS (
          SELECT delivery, date_trunc('milliseconds', max(max(ts)) OVER (
                   ORDER BY delivery ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
                   - INTERVAL 2 DAY AS mark FROM sent GROUP BY delivery),
        timely AS (
          SELECT sent.* FROM sent LEFT JOIN marks ON marks.delivery = sent.delivery - 1
          WHERE mark IS NULL OR ts > mark)
        SELECT date_trunc('hour', ts) AS event_hour_start, COUNT(event_id) AS total_views,
               CAST(SUM(is_completed) AS BIGINT) AS completed_views,
               COUNT(DISTINCT user_id) AS unique_users
        FROM timely GROUP BY date_trunc('hour', ts)
        HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(mark) FROM marks)""",
    "gold_trending_content": """
        SELECT content_id, COUNT(event_id) AS total_views FROM fact
        WHERE event_timestamp > (SELECT MAX(event_timestamp) FROM fact) - INTERVAL 7 DAY
        GROUP BY content_id ORDER BY total_views DESC, content_id LIMIT 10""",
}

_DEDUPLICATED = {
    "silver_obt": """
        SELECT event_id, event_timestamp, event_hour, event_day, event_month, is_prime_time,
               is_weekend, user_id, age_group, content_id, content_title, content_type, genre,
               language, action, CAST(watch_duration_mins AS DOUBLE) AS watch_duration_mins,
               total_duration_mins, CAST(completion_pct AS DOUBLE) AS completion_pct,
               is_completed, is_dropped, device_type, device_os, city, state, region,
               subscription_plan, subscription_price, source, completion_category,
               device_category, event_date, time_of_day,
               CAST(engagement_score AS DOUBLE) AS engagement_score,
               CAST(revenue_per_view AS DOUBLE) AS revenue_per_view
        FROM deduplicated""",
    "views_by_device_end_to_end": aggregation("device_type", "deduplicated", limit=10),
}

_FROM_EVENTS = {
    "scan_table": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "event_features": """
        SELECT event_id, CAST(hour(ts) AS INTEGER) AS event_hour, dayname(ts) AS event_day,
               CAST(month(ts) AS INTEGER) AS event_month,
               CASE WHEN hour(ts) BETWEEN 18 AND 23 THEN 1 ELSE 0 END AS is_prime_time,
               CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend,
               CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS completion_pct,
               CASE WHEN CAST(value AS DECIMAL(12,2)) >= 90 THEN 1 ELSE 0 END AS is_completed,
               CASE WHEN CAST(value AS DECIMAL(12,2)) < 10 THEN 1 ELSE 0 END AS is_dropped
        FROM events""",
}

QUERIES = {
    **_FROM_EVENTS,
    **{name: SILVER + sql for name, sql in _AFTER_SILVER.items()},
    **{name: SILVER + sql for name, sql in _DEDUPLICATED.items()},
}
