"""DuckDB SQL giving the expected result of each query in ``queries``."""

from __future__ import annotations

from eventloom.operators.retrieval import SYSTEM_PROMPT

# Events in raw shape: text time with junk, missing users, category from part.
_EV = """
WITH b AS (
  SELECT event_id AS eid, user_id AS uid, event_type AS et, ts, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
ev AS (
  SELECT b.eid, CAST(b.eid AS VARCHAR) AS event_id,
    CONCAT('U', LPAD(CAST(b.uid AS VARCHAR), 4, '0')) AS user_id,
    CASE WHEN b.eid % 97 <> 0 THEN CONCAT('U', LPAD(CAST(b.uid AS VARCHAR), 4, '0')) END AS user_raw,
    CASE WHEN b.eid % 7 = 0 THEN UPPER(b.et) ELSE b.et END AS event_type,
    CASE WHEN b.k < 70 THEN CONCAT('P', LPAD(CAST(b.k AS VARCHAR), 4, '0')) END AS product_id,
    CASE WHEN b.k < 70 THEN p.p_type END AS product_category,
    b.ts AS event_ts,
    CASE b.eid % 4 WHEN 0 THEN strftime(b.ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'
                   WHEN 1 THEN strftime(b.ts, '%Y-%m-%dT%H:%M:%S') || '+00:00'
                   WHEN 2 THEN strftime(b.ts, '%Y-%m-%dT%H:%M:%S') ELSE 'junk' END AS timestamp_str,
    CASE b.eid % 6 WHEN 0 THEN 'home' WHEN 1 THEN 'product_detail' WHEN 2 THEN 'cart'
                   WHEN 3 THEN 'checkout' WHEN 4 THEN 'profile' ELSE 'search_results' END AS page,
    CASE b.eid % 6 WHEN 0 THEN 'google' WHEN 1 THEN 'direct' WHEN 2 THEN 'twitter'
                   WHEN 3 THEN 'facebook' WHEN 4 THEN 'email' END AS referrer,
    CAST(ROUND((b.value - 5) * 1000) AS BIGINT) AS duration_ms,
    CASE b.eid % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END AS device,
    CASE b.eid % 4 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Firefox' WHEN 2 THEN 'Safari' ELSE 'Edge' END AS browser,
    b.k, b.value
  FROM b LEFT JOIN part p ON p.p_partkey = b.k),
folded AS (SELECT * REPLACE (LOWER(event_type) AS event_type) FROM ev),
parsed AS (
  SELECT *, try_strptime(timestamp_str, ['%Y-%m-%dT%H:%M:%S.%f+00:00', '%Y-%m-%dT%H:%M:%S+00:00', '%Y-%m-%dT%H:%M:%S']) AS parsed_ts
  FROM ev),
cleaned AS (
  SELECT eid, event_id, user_raw AS user_id, LOWER(event_type) AS event_type,
         COALESCE(product_id, 'unknown') AS product_id, parsed_ts AS event_ts, page,
         COALESCE(referrer, 'direct') AS referrer, duration_ms, device, browser, DATE '2024-02-01' AS processing_date
  FROM parsed
  WHERE user_raw IS NOT NULL AND (duration_ms IS NULL OR duration_ms BETWEEN 0 AND 300000)),
stg AS (
  SELECT * EXCLUDE (user_raw, timestamp_str, k, value)
         REPLACE (LOWER(event_type) AS event_type, COALESCE(product_id, 'unknown') AS product_id, COALESCE(referrer, 'direct') AS referrer),
         CAST(event_ts AS DATE) AS event_date
  FROM ev WHERE event_ts IS NOT NULL),
segments(least, below, user_segment) AS (VALUES (1, 2, 'new'), (2, 10, 'regular'), (10, 50, 'active'), (50, 1e18, 'power_user')),
users AS (
  SELECT user_id, days[1] AS first_seen_at, days[2] AS last_seen_at, total_events, user_segment
  FROM (SELECT user_id, [MIN(event_date), MAX(event_date)] AS days, COUNT(*) AS total_events FROM stg GROUP BY user_id)
  JOIN segments ON total_events >= least AND total_events < below),
product_types AS (SELECT product_id, histogram(event_type) AS seen FROM stg WHERE product_id <> 'unknown' GROUP BY product_id),
products AS (
  SELECT *, IF(total_purchases = 0, 0.0::DOUBLE, IF(total_views = 0, NULL, ROUND(total_purchases * 100.0::DOUBLE / total_views, 2))) AS conversion_rate_pct
  FROM (SELECT product_id, CAST(COALESCE(seen['view'], 0) AS BIGINT) AS total_views, CAST(COALESCE(seen['purchase'], 0) AS BIGINT) AS total_purchases,
               CAST(COALESCE(seen['signup'], 0) AS BIGINT) AS total_add_to_cart, CAST(list_sum(map_values(seen)) AS BIGINT) AS total_interactions
        FROM product_types)),
daily AS (
  SELECT event_date, event_type, n AS total_events, unique_users, CAST(ROUND(ms / n) AS BIGINT) AS avg_duration_ms,
         ROUND(CAST(ms AS DOUBLE) / 1000, 2) AS total_duration_seconds
  FROM (SELECT event_date, event_type, COUNT(*) AS n, SUM(duration_ms) AS ms, COUNT(DISTINCT user_id) AS unique_users
        FROM stg SEMI JOIN (SELECT eid FROM ev WHERE duration_ms IS NOT NULL) timed USING (eid) GROUP BY ALL))
"""

_CLEAN = "event_id, user_id, event_type, product_id, event_ts, page, referrer, duration_ms, device, browser"
_RAW = """event_id, user_raw AS user_id, event_type, product_id, timestamp_str AS "timestamp", page, referrer,
  duration_ms, device, browser"""

_SCORE = "LEAST(GREATEST(total_events * 1.0 / (days_last + 1), 0), 100)"
_FEATURES = f""",
aged AS (
  SELECT *, CAST(DATE '2024-02-01' - first_seen_at AS BIGINT) AS days_first,
         CAST(DATE '2024-02-01' - last_seen_at AS BIGINT) AS days_last FROM users),
user_features AS (SELECT *, {_SCORE} AS score FROM aged),
product_features AS (
  SELECT product_id, total_views, total_purchases, conversion_rate_pct,
         CASE WHEN total_views >= 100 THEN 'hot' WHEN total_views >= 50 THEN 'warm'
              WHEN total_views >= 10 THEN 'cool' ELSE 'cold' END AS popularity_tier,
         ROUND(total_purchases * 1.0 / (total_views + 1), 4) AS purchase_view_ratio
  FROM products)
"""
_USER_FEATURES = """user_id, user_segment, total_events, first_seen_at, last_seen_at,
  days_first AS days_since_first_seen, days_last AS days_since_last_seen, ROUND(score, 6) AS activity_score"""


def _chunk(lo: int, hi: int) -> str:
    """Sentence and length-fitted chunk per event over ``src`` columns of a relation."""
    return f""",
sentences AS (
  SELECT *, CONCAT_WS(' ', 'User ' || user_id || ' performed ' || event_type,
      CASE WHEN product_id <> 'unknown' THEN 'on product ' || product_id END,
      CASE WHEN product_category IS NOT NULL THEN '(category: ' || product_category || ')' END,
      CASE WHEN referrer <> 'direct' THEN 'from ' || referrer END,
      'on page ' || page, 'via ' || device || ' ' || browser,
      CASE WHEN duration_ms > 0 THEN 'duration ' || CAST(duration_ms AS VARCHAR) || 'ms' END) AS sentence
  FROM talk),
named AS (
  SELECT *, CASE WHEN LENGTH(sentence) < {lo} THEN 'Event ' || event_id || ': ' || sentence ELSE sentence END AS whole FROM sentences),
cut AS (
  SELECT *, CASE WHEN LENGTH(whole) <= {hi} THEN [whole] ELSE regexp_extract_all(whole, '(\\S.{{0,{hi - 1}}})(?:\\s|$)', 1) END AS parts FROM named),
chunks AS (
  SELECT * EXCLUDE (parts), UNNEST(parts) AS chunk, UNNEST(range(len(parts)))::INTEGER AS chunk_no FROM cut)
"""


_TALK_EV = ", talk AS (SELECT * FROM ev)"

# Element-wise mean vectors and inner products in double precision.
_MEANS = """,
vecs AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings),
label_queries AS (
  SELECT label AS query_id, list(x ORDER BY pos) AS q FROM (
    SELECT label, pos, AVG(x) AS x FROM (
      SELECT label, UNNEST(v) AS x, UNNEST(range(len(v))) AS pos FROM vecs) GROUP BY label, pos)
  GROUP BY label)
"""


def _topk(corpus: str, queries: str, k: int, where: str = "TRUE") -> str:
    return f""",
scored AS (
  SELECT CAST(query_id AS BIGINT) AS query_id, id, ROUND(list_dot_product(q, v), 9) AS score
  FROM {queries} CROSS JOIN {corpus} WHERE {where}),
hits AS (
  SELECT * FROM (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM scored)
  WHERE rank <= {k})
"""


# The nearest label mean is a vector's cluster; a query looks into the clusters of its 3 nearest means.
_PROBED = """,
homes AS (SELECT id, arg_min(query_id, list_distance(q, v)) AS cluster FROM vecs CROSS JOIN label_queries GROUP BY id),
looks AS (
  SELECT * FROM (SELECT a.query_id, b.query_id AS cluster, ROW_NUMBER() OVER (PARTITION BY a.query_id ORDER BY list_distance(a.q, b.q), b.query_id) AS r
    FROM label_queries a CROSS JOIN label_queries b) WHERE r <= 3),
near AS (
  SELECT CAST(looks.query_id AS BIGINT) AS query_id, vecs.id, ROUND(list_dot_product(q, v), 9) AS score
  FROM looks JOIN homes USING (cluster) JOIN vecs ON vecs.id = homes.id JOIN label_queries l ON l.query_id = looks.query_id),
hits AS (
  SELECT * FROM (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM near) WHERE rank <= 10)
"""

_RULED = """,
judged AS (
  SELECT CASE WHEN total_events >= 80 THEN 'power_user' WHEN total_events >= 68 THEN 'active' WHEN total_events >= 58 THEN 'regular' ELSE 'new' END AS y,
         CASE WHEN total_events >= 84 THEN 'power_user' WHEN total_events >= 66 THEN 'active' WHEN total_events >= 60 THEN 'regular' ELSE 'new' END AS z
  FROM users),
names AS (SELECT y AS s FROM judged UNION SELECT z FROM judged),
tallied AS (SELECT s, COUNT(*) FILTER (y = s) AS support, COUNT(*) FILTER (z = s) AS told, COUNT(*) FILTER (y = s AND z = s) AS hit
  FROM names CROSS JOIN judged GROUP BY s),
per AS (SELECT s, support, hit, IF(told = 0, 0, hit / told) AS p, IF(support = 0, 0, hit / support) AS r FROM tallied),
report AS (SELECT *, IF(p + r = 0, 0, 2 * p * r / (p + r)) AS f FROM per)
"""

_HITS = "SELECT query_id, id, ROUND(score, 6) AS score, rank FROM hits"

def _lexical(src: str, id_: str, text: str, out: str, also: str = "") -> str:
    """Unit vectors of a relation's texts by words dealt to 384 slots, as ``out`` (id, v); ``also`` is vectored by the same weights."""
    split = "SELECT {0} AS id, UNNEST(regexp_split_to_array(LOWER({1}), '[ \\t\\n\\r\\f\\v]+')) AS w FROM {2}"
    cast = "CAST('0x' || SUBSTR(MD5(w), 1, 8) AS BIGINT) % 384"
    steps = f""",
{out}_words AS (SELECT id, {cast} AS slot, COUNT(*) AS n FROM ({split.format(id_, text, src)}) WHERE w <> '' GROUP BY 1, 2),
{out}_rare AS (SELECT slot, LN(((SELECT COUNT(*) FROM {src}) + 1.0::DOUBLE) / (COUNT(*) + 1)) AS idf FROM {out}_words GROUP BY slot)"""
    for name, words, rows, key in ((out, f"{out}_words", src, id_), *([(also, f"{also}_words", "asked", "query_id")] if also else [])):
        if name == also:
            steps += f""",
{also}_words AS (SELECT id, {cast} AS slot, COUNT(*) AS n FROM ({split.format("query_id", "question", "asked")}) WHERE w <> '' GROUP BY 1, 2)"""
        steps += f""",
{name}_long AS (SELECT id, slot, n * idf AS x FROM {words} JOIN {out}_rare USING (slot)),
{name}_unit AS (SELECT id, slot, CAST(CAST(x / SQRT(SUM(x * x) OVER (PARTITION BY id)) AS FLOAT) AS DOUBLE) AS x FROM {name}_long),
{name}_maps AS (SELECT id, map_from_entries(list((slot, x))) AS m FROM {name}_unit GROUP BY id),
{name} AS (SELECT {rows}.{key} AS id, list_transform(range(384), lambda i: COALESCE(m[i], 0.0::DOUBLE)) AS v
  FROM {rows} LEFT JOIN {name}_maps ON {name}_maps.id = {rows}.{key})"""
    return steps


_KB_ID = "CAST('0x' || SUBSTR(MD5(event_id || '#' || chunk_no), 1, 15) AS BIGINT)"
_MEAN_OF = """SELECT {key}, list(x ORDER BY pos) AS q FROM (
    SELECT {key}, pos, AVG(x) AS x FROM (SELECT {key}, UNNEST(v) AS x, UNNEST(range(len(v))) AS pos FROM {src}) GROUP BY {key}, pos)
  GROUP BY {key}"""
_PLACE = "list_sum(list_transform(range(len(v)), lambda i: v[i + 1] * (i + 1)))"

_KNOWLEDGE = (
    _EV
    + """, talk AS (
  SELECT eid, event_id, user_id, LOWER(event_type) AS event_type, COALESCE(product_id, 'unknown') AS product_id,
         product_category, page, COALESCE(referrer, 'direct') AS referrer,
         LEAST(GREATEST(duration_ms, 0), 300000) AS duration_ms, device, browser
  FROM ev)"""
    + _chunk(20, 200)
    + f", listed AS (SELECT {_KB_ID} AS id, * FROM chunks)"
    + _lexical("listed", "id", "chunk", "lex")
    + f""",
kb AS (SELECT lex.v, e.* FROM listed e JOIN lex ON lex.id = e.id),
questions AS (
  SELECT event_type AS expected_type, 'Find ' || event_type || ' events' AS question,
         list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) AS query_id, q
  FROM ({_MEAN_OF.format(key="event_type", src="kb")}))
"""
)
_DOCS = ", docs AS (SELECT h.query_id, h.rank, h.score, kb.* FROM hits h JOIN kb ON kb.id = h.id)"


def _rag(k: int, select: str) -> str:
    return _KNOWLEDGE + _topk("kb", "questions", k) + _DOCS + select


_EVENT_VECTORS = (
    _EV
    + """, told AS (SELECT *, CONCAT_WS('，', '事件类型: ' || event_type, '用户: ' || user_id, '商品: ' || product_id, '页面: ' || page,
          CASE WHEN referrer <> 'direct' THEN '来源: ' || referrer END, '设备: ' || device, '浏览器: ' || browser) AS text_content FROM ev)"""
    + _lexical("told", "eid", "text_content", "lex")
    + f""", target AS (SELECT lex.id, v, told.* FROM lex JOIN told ON told.eid = lex.id),
page_queries AS (SELECT ROW_NUMBER() OVER (ORDER BY page) AS query_id, q FROM ({_MEAN_OF.format(key="page", src="target")}))"""
)

_SYSTEM = SYSTEM_PROMPT.replace("'", "''")


def _rule(kind: str, column: str, failures: str, source: str = "FROM parsed") -> str:
    name = f"{kind}:{column}" if column else kind
    return f"""SELECT '{name}' AS rule, '{column}' AS "column", failures, failures = 0 AS passed
      FROM (SELECT {failures} AS failures {source})"""


def _nulls(c: str, source: str = "FROM parsed") -> str:
    return _rule("not_null", c.replace("user_raw", "user_id"), f"COUNT(*) FILTER ({c} IS NULL)", source)


def _dups(c: str, source: str = "parsed") -> str:
    return _rule("unique", c.replace("user_raw", "user_id"), "COUNT(*)",
                 f"FROM (SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1)")


def _strays(c: str, values: tuple[str, ...], source: str = "FROM parsed") -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return _rule("accepted_values", c, f"COUNT(*) FILTER ({c} NOT IN ({listed}))", source)


def _range(kind: str, column: str, measure: str, low: int, high: int, source: str = "FROM parsed") -> str:
    return _rule(kind, column, f"CAST(CASE WHEN {measure} BETWEEN {low} AND {high} THEN 0 ELSE 1 END AS BIGINT)", source)


def _union(*parts: str) -> str:
    return " UNION ALL ".join(parts)


_TYPES = ("click", "view", "add_to_cart", "purchase", "search", "logout")
_DEVICES = ("desktop", "mobile", "tablet")

_POINT_IN_TIME = """
SELECT p.event_id, p.user_id, p.event_ts AS as_of, v.event_ts AS view_ts, v.event_id AS view_id,
       v.product_id, v.duration_ms
FROM (SELECT * FROM stg WHERE event_type = 'purchase') p
LEFT JOIN LATERAL (
  SELECT * FROM stg w WHERE w.event_type = 'view' AND w.user_id = p.user_id AND w.event_ts <= p.event_ts {ttl}
  ORDER BY w.event_ts DESC, w.event_id DESC LIMIT 1) v ON TRUE
"""

_TRAINING_USERS = """,
labelled AS (
  SELECT user_id, CASE WHEN total_events >= 80 THEN 'power_user' WHEN total_events >= 68 THEN 'active'
         WHEN total_events >= 58 THEN 'regular' ELSE 'new' END AS user_segment FROM users)
"""

_HOURLY = """SELECT date_trunc('hour', event_ts) AS window_start, COUNT(*) AS events,
  COUNT(*) FILTER (event_type = 'purchase') AS purchases FROM {src} GROUP BY 1"""

ORACLES: dict[str, str] = {
    # cleaning
    "clean_events": _EV + f"SELECT {_CLEAN}, processing_date FROM cleaned",
    "clip_duration": _EV + "SELECT event_id, LEAST(GREATEST(duration_ms, 0), 300000) AS duration_ms FROM ev WHERE user_raw IS NOT NULL",
    "parse_timestamps": _EV + """SELECT event_id, parsed_ts AS event_ts, parsed_ts AS lenient_ts,
        COALESCE(CAST(FLOOR(epoch(parsed_ts)) AS BIGINT), 0) AS epoch FROM parsed""",
    "dedup_events": _EV + "SELECT event_id, event_type, page, event_ts FROM ev",
    "cleaning_report": _EV + """SELECT raw_rows, dropped_null_key, dropped_duration, clean_rows, partitions,
        raw_rows - clean_rows AS dropped_rows, ROUND(clean_rows * 100.0 / raw_rows, 1) AS retention_pct,
        clean_rows * 512 / 1048576.0::DOUBLE AS raw_estimate_mb
      FROM (SELECT COUNT(*) AS raw_rows, COUNT(*) FILTER (user_raw IS NULL) AS dropped_null_key,
              COUNT(*) FILTER (user_raw IS NOT NULL AND duration_ms NOT BETWEEN 0 AND 300000) AS dropped_duration,
              COUNT(*) FILTER (user_raw IS NOT NULL AND duration_ms BETWEEN 0 AND 300000) AS clean_rows FROM parsed),
           (SELECT COUNT(*) AS partitions FROM (SELECT DISTINCT CAST(event_ts AS DATE), event_type FROM cleaned))""",
    # sources and sinks
    "read_jsonl_roundtrip": _EV + f"SELECT {_RAW} FROM parsed",
    "partitioned_roundtrip": _EV + f"SELECT {_CLEAN}, processing_date FROM cleaned",
    "recursive_read": _EV + "SELECT event_id, user_id, CASE WHEN k < 3 THEN NULL ELSE value END AS value FROM ev",
    "glob_view": _EV + """SELECT device, COUNT(*) AS events, CAST(SUM(duration_ms) AS BIGINT) AS duration_ms FROM cleaned
        WHERE event_type IN ('view', 'click') GROUP BY device""",
    "csv_roundtrip": _EV + """SELECT event_id, COALESCE(user_raw, '') AS user_id, event_type, COALESCE(product_id, '') AS product_id,
        COALESCE(referrer, '') AS referrer, CAST(duration_ms AS VARCHAR) AS duration_ms FROM ev""",
    "warehouse_load": _EV + """SELECT event_id, user_raw AS user_id, event_type, COALESCE(product_id, 'unknown') AS product_id,
        CAST(NULL AS VARCHAR) AS product_category, timestamp_str AS "timestamp", parsed_ts AS event_ts, page,
        COALESCE(referrer, 'direct') AS referrer, CAST(duration_ms AS DOUBLE) AS duration_ms, device, browser,
        TIMESTAMP '2024-02-01 00:00:00' AS processed_at, DATE '2024-02-01' AS processing_date FROM parsed""",
    "table_migration": _EV + f"SELECT {_CLEAN}, processing_date FROM cleaned",
    "table_append": _EV + """SELECT event_id, event_type, duration_ms FROM cleaned
        UNION ALL SELECT event_id || '-b', event_type, duration_ms FROM cleaned""",
    "incremental_read": _EV + "SELECT event_id, user_id, event_ts FROM ev WHERE event_ts > TIMESTAMP '2024-01-16 12:00:00'",
    "incremental_load": _EV + "SELECT event_id, user_raw AS user_id, event_type, event_ts FROM ev",
    "stored_mark": _EV + "SELECT MAX(event_ts) AS mark, CAST(2 AS BIGINT) AS increments, COUNT(*) AS rows FROM ev",
    "high_water_mark": "SELECT MAX(ts) AS mark FROM events",
    "table_sample": _EV + "SELECT event_id, user_id, event_type FROM ev ORDER BY md5(event_id || ':42'), event_id LIMIT 5000",
    "table_head": _EV + "SELECT event_id, user_id, event_type FROM ev ORDER BY event_id LIMIT 1000",
    "source_availability": _EV + """SELECT 'dim_users' AS table_name, COUNT(*) AS row_count, COUNT(*) > 0 AS available FROM users
        UNION ALL SELECT 'dim_products', COUNT(*), COUNT(*) > 0 FROM products
        UNION ALL SELECT 'fct_user_events_daily', COUNT(*), COUNT(*) > 0 FROM daily
        UNION ALL SELECT 'no_such_table', 0, FALSE""",
    "collection_stats": """SELECT COUNT(*) AS num_entities, CAST(MIN(len(embedding)) AS INTEGER) AS min_dim,
        CAST(MAX(len(embedding)) AS INTEGER) AS max_dim, COUNT(DISTINCT label) AS labels FROM embeddings""",
    "collection_report": """SELECT 'user_events' AS collection, TRUE AS exists, COUNT(*) AS num_entities, CAST(MIN(len(embedding)) AS INTEGER) AS min_dim,
        CAST(MAX(len(embedding)) AS INTEGER) AS max_dim, 'vec_id:bigint,embedding:array<float>,label:int' AS columns FROM embeddings
        UNION ALL SELECT 'product_features', FALSE, NULL, NULL, NULL, NULL""",
    "cleaning_output": _EV + """SELECT COUNT(*) AS clean_rows, COUNT(*) * 512 / 1048576.0::DOUBLE AS raw_estimate_mb, TRUE AS usable,
        TRUE AS has_files, TRUE AS smaller FROM cleaned""",
    "output_inspection": _EV + "SELECT TRUE AS usable, COUNT(*) AS written FROM cleaned",
    "codec_sizes": _EV + """SELECT codec, TRUE AS usable, n AS rows FROM (VALUES ('snappy'), ('gzip'), ('zstd'), ('lz4')) c(codec),
        (SELECT COUNT(*) AS n FROM cleaned)""",
    "layout_report": """SELECT layout, TRUE AS usable, n AS rows FROM (VALUES ('date'), ('date_type'), ('date_hour')) c(layout),
        (SELECT COUNT(*) AS n FROM events)""",
    "compaction_report": _EV + """SELECT stage, TRUE AS usable, n AS rows FROM (VALUES ('before'), ('after')) c(stage),
        (SELECT COUNT(*) AS n FROM cleaned)""",
    "small_file_merge": _EV + "SELECT event_id, event_type, product_id, event_ts, duration_ms FROM cleaned",
    "kafka_roundtrip": _EV + f"SELECT {_RAW} FROM parsed",
    # models and statistics
    "stg_user_events": _EV + """SELECT event_id, user_id, event_type, product_id, event_ts, event_date, page, referrer,
        duration_ms, device, browser FROM stg""",
    "dim_users": _EV + "SELECT * FROM users",
    "dim_products": _EV + "SELECT * FROM products",
    "fct_user_events_daily": _EV + "SELECT * FROM daily",
    "refreshed_users": _EV + "SELECT * FROM users",
    "refreshed_products": _EV + "SELECT * FROM products",
    "refreshed_daily": _EV + "SELECT * FROM daily",
    "segment_totals": _EV + "SELECT user_segment, COUNT(*) AS cnt, CAST(SUM(total_events) AS BIGINT) AS events FROM users GROUP BY user_segment",
    "user_segments": _EV + """, per AS (SELECT user_segment, COUNT(*) AS n, SUM(total_events) AS e FROM users GROUP BY ALL)
        SELECT user_segment AS segment, n AS users, CAST(e AS BIGINT) AS events, ROUND(100.0 * n / whole, 1) AS pct
        FROM per, (SELECT SUM(n) AS whole FROM per)""",
    "events_by_type": _EV + "SELECT event_type, CAST(SUM(total_events) AS BIGINT) AS cnt FROM daily GROUP BY event_type",
    "top_products": _EV + """SELECT product_id, total_views, total_purchases, conversion_rate_pct FROM products
        WHERE total_views > 5 ORDER BY conversion_rate_pct DESC NULLS LAST, product_id LIMIT 10""",
    "top_users": _EV + """SELECT user_id, user_segment AS segment, total_events, first_seen_at AS first_seen, last_seen_at AS last_seen
        FROM users ORDER BY total_events DESC, user_id LIMIT 20""",
    "top_users_page_2": _EV + """SELECT user_id, user_segment AS segment, total_events, first_seen_at AS first_seen, last_seen_at AS last_seen
        FROM users ORDER BY total_events DESC, user_id LIMIT 20 OFFSET 20""",
    "product_rank": _EV + """, kinds AS (SELECT product_id, MIN(product_category) AS kind FROM ev GROUP BY ALL)
        SELECT product_id, IFNULL(kind, 'unknown') AS category, total_views, total_purchases, ROUND(conversion_rate_pct, 1) AS conversion_rate
        FROM products LEFT JOIN kinds USING (product_id) ORDER BY total_views DESC, product_id LIMIT 20""",
    "row_count": "SELECT COUNT(*) AS total_rows FROM events",
    "dashboard_overview": _EV + """, c AS (SELECT COUNT(*) AS n, COUNT(DISTINCT user_id) AS u,
          SUM((event_type = 'purchase')::BIGINT)::BIGINT AS bought, SUM((event_type IN ('view', 'click'))::BIGINT)::BIGINT AS looked FROM folded)
        SELECT n AS total_events, bought AS today_orders, u AS today_users,
          IF(looked = 0, 0.0::DOUBLE, ROUND(100.0 * bought / looked, 2)) AS conversion_rate FROM c""",
    "sales_trend": _EV + """SELECT CAST(event_ts AS DATE) AS date, COUNT(*) AS events, COUNT(*) FILTER (event_type = 'purchase') AS purchases
        FROM folded WHERE event_ts IS NOT NULL GROUP BY 1""",
    "hourly_histogram": _EV + "SELECT CAST(EXTRACT(HOUR FROM event_ts) AS INTEGER) AS hour, COUNT(*) AS events FROM ev GROUP BY 1",
    "hourly_heatmap": _EV + "SELECT CAST(EXTRACT(HOUR FROM event_ts) AS INTEGER) AS hour, event_type, COUNT(*) AS cnt FROM folded GROUP BY 1, 2",
    "daily_event_count": "SELECT CAST(ts AS DATE) AS event_date, COUNT(*) AS cnt FROM events GROUP BY 1",
    "user_activity_rank": _EV + "SELECT user_id, COUNT(*) AS event_count FROM ev GROUP BY user_id ORDER BY event_count DESC, user_id LIMIT 10",
    "event_type_distribution": _EV + """, per AS (SELECT event_type, COUNT(*) AS n FROM folded GROUP BY ALL)
        SELECT event_type, n AS cnt, ROUND(100.0 * n / whole, 2) AS pct FROM per, (SELECT SUM(n) AS whole FROM per)""",
    "category_share": _EV + """, per AS (SELECT product_category AS c, COUNT(*) AS n, SUM((event_type = 'purchase')::BIGINT)::BIGINT AS p
          FROM folded WHERE product_category IS NOT NULL GROUP BY ALL)
        SELECT c AS category, n AS views, p AS purchases, ROUND(100.0 * n / whole, 1) AS pct FROM per, (SELECT SUM(n) AS whole FROM per)""",
    "funnel": _EV + """, roles AS (SELECT CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 1 WHEN 'signup' THEN 2 WHEN 'purchase' THEN 3 END AS step FROM folded),
        per AS (SELECT step, name, COUNT(roles.step) AS n FROM (VALUES (1, '浏览/搜索'), (2, '加入购物车'), (3, '下单购买')) s(step, name)
          LEFT JOIN roles USING (step) GROUP BY ALL)
        SELECT step, name, n AS value, ROUND(100.0 * n / (SELECT n FROM per WHERE step = 1), 1) AS pct FROM per""",
    "funnel_union": _EV + """SELECT 1 AS step, '浏览/搜索' AS name, COUNT(*) AS value FROM folded WHERE event_type IN ('view', 'click')
        UNION ALL SELECT 2, '加入购物车', COUNT(*) FROM folded WHERE event_type = 'signup'
        UNION ALL SELECT 3, '下单购买', COUNT(*) FROM folded WHERE event_type = 'purchase'""",
    "funnel_step_rates": _EV + """, steps AS (SELECT 1 AS step, '浏览/搜索' AS name, COUNT(*) AS value FROM folded WHERE event_type IN ('view', 'click')
        UNION ALL SELECT 2, '加入购物车', COUNT(*) FROM folded WHERE event_type = 'signup'
        UNION ALL SELECT 3, '下单购买', COUNT(*) FROM folded WHERE event_type = 'purchase')
        SELECT step, name, value, ROUND(value * 100.0 / FIRST_VALUE(value) OVER (ORDER BY step), 1) AS pct_of_first,
               ROUND(value * 100.0 / LAG(value) OVER (ORDER BY step), 1) AS pct_of_previous FROM steps""",
    "filter_agg_device": _EV + """SELECT device, ROUND(SUM(value), 4) AS sum_value, ROUND(AVG(value), 6) AS avg_value, COUNT(*) AS cnt
        FROM folded WHERE event_type = 'purchase' GROUP BY device""",
    "agg_type_device": _EV + "SELECT event_type, device, ROUND(SUM(value), 4) AS sum_value, COUNT(*) AS cnt FROM folded GROUP BY event_type, device",
    "duration_stats": _EV + """SELECT event_type, COUNT(*) AS count, ROUND(AVG(duration_ms), 6) AS mean, MEDIAN(duration_ms) AS median,
        MIN(duration_ms) AS min, MAX(duration_ms) AS max,
        list_sort(list(duration_ms))[CAST(FLOOR(COUNT(*) * 0.95::DOUBLE) AS BIGINT) + 1] AS p95,
        list_sort(list(duration_ms))[CAST(FLOOR(COUNT(*) * 0.99::DOUBLE) AS BIGINT) + 1] AS p99,
        ROUND(COALESCE(STDDEV_SAMP(duration_ms), 0), 6) AS stdev
        FROM folded GROUP BY event_type""",
    # quality
    "dq_not_null": _EV + _union(*[_nulls(c) for c in ("event_id", "user_raw", "event_type", "product_id", "referrer")]),
    "dq_unique": _EV + _union(*[_dups(c) for c in ("event_id", "user_raw", "product_id")]),
    "dq_accepted_values": _EV + _union(_strays("event_type", _TYPES), _strays("referrer", ("google", "direct"))),
    "dq_ranges": _EV + _union(
        _range("min_between", "duration_ms", "MIN(duration_ms)", 0, 100),
        _range("max_between", "duration_ms", "MAX(duration_ms)", 0, 1_000_000),
        _rule("row_count_between", "", "CAST(CASE WHEN COUNT(*) >= 1 THEN 0 ELSE 1 END AS BIGINT)"),
        _rule("ordered_columns", "", "CAST(0 AS BIGINT)", ""),
    ),
    "dq_suite": _EV + _union(
        _rule("ordered_columns", "", "CAST(0 AS BIGINT)", ""),
        *[_nulls(c, "FROM cleaned") for c in ("event_id", "user_id", "event_type")],
        _dups("event_id", "cleaned"),
        _strays("event_type", _TYPES, "FROM cleaned"), _strays("device", _DEVICES, "FROM cleaned"),
        _range("min_between", "duration_ms", "MIN(duration_ms)", 0, 100, "FROM cleaned"),
        _range("max_between", "duration_ms", "MAX(duration_ms)", 0, 300000, "FROM cleaned"),
        _range("row_count_between", "", "COUNT(*)", 1, 1000000, "FROM cleaned"),
    ),
    "dq_summary": _EV + ", r AS (" + _union(
        _nulls("event_id", "FROM stg"), _dups("event_id", "stg"), _nulls("user_id", "FROM stg"),
        _nulls("event_type", "FROM stg"), _strays("event_type", _TYPES, "FROM stg"),
    ) + """) SELECT COUNT(*) AS rules, COUNT(*) FILTER (passed) AS passed, COUNT(*) FILTER (NOT passed) AS failed,
        CAST(0 AS BIGINT) AS warnings, COUNT(*) FILTER (NOT passed) AS errors FROM r""",
    "dq_models": _EV + _union(*[
        f"SELECT *, '{model}' AS model FROM ({rule})"
        for model, rules in {
            "user_events": [_nulls("event_id", "FROM ev"), _dups("event_id", "ev"), _nulls("user_id", "FROM ev"),
                            _nulls("event_type", "FROM ev"), _strays("event_type", _TYPES, "FROM ev")],
            "stg_user_events": [_nulls("event_id", "FROM stg"), _dups("event_id", "stg"), _nulls("user_id", "FROM stg"),
                                _nulls("event_type", "FROM stg")],
            "dim_users": [_nulls("user_id", "FROM users"), _dups("user_id", "users")],
            "fct_user_events_daily": [_nulls("event_date", "FROM daily"), _nulls("event_type", "FROM daily")],
            "dim_products": [_nulls("product_id", "FROM products"), _dups("product_id", "products")],
        }.items() for rule in rules
    ]),
    "dq_failures": _EV + """SELECT 'not_null:user_id' AS rule, event_id, CAST(NULL AS VARCHAR) AS value FROM ev WHERE user_raw IS NULL
        UNION ALL SELECT 'accepted_values:event_type', event_id, event_type FROM ev
        WHERE event_type NOT IN ('click', 'view', 'add_to_cart', 'purchase', 'search', 'logout')""",
    "dq_stored_failures": _EV + """SELECT 'not_null:user_id' AS rule, event_id AS key, CAST(NULL AS VARCHAR) AS value FROM ev WHERE user_raw IS NULL
        UNION ALL SELECT 'accepted_values:event_type', event_id, event_type FROM ev
        WHERE event_type NOT IN ('click', 'view', 'add_to_cart', 'purchase', 'search', 'logout')
        UNION ALL SELECT 'unique:product_id', product_id, CAST(COUNT(*) AS VARCHAR) FROM ev
        WHERE product_id IS NOT NULL GROUP BY product_id HAVING COUNT(*) > 1""",
    "dq_duplicates": _EV + "SELECT product_id, COUNT(*) AS n_records FROM ev WHERE product_id IS NOT NULL GROUP BY product_id HAVING COUNT(*) > 1",
    # features
    "user_features": _EV + _FEATURES + f"SELECT {_USER_FEATURES} FROM user_features",
    "user_features_fractional": _EV + """, aged AS (SELECT *,
          epoch(TIMESTAMP '2024-02-01 06:00:00' - CAST(first_seen_at AS TIMESTAMP)) / 86400.0::DOUBLE AS days_first,
          epoch(TIMESTAMP '2024-02-01 06:00:00' - CAST(last_seen_at AS TIMESTAMP)) / 86400.0::DOUBLE AS days_last FROM users)
        SELECT user_id, user_segment, total_events, first_seen_at, last_seen_at, ROUND(days_first, 6) AS days_since_first_seen,
          ROUND(days_last, 6) AS days_since_last_seen,
          ROUND(LEAST(GREATEST(total_events / (days_last + 1), 0), 100), 6) AS activity_score
        FROM aged ORDER BY total_events DESC, user_id LIMIT 100""",
    "product_features": _EV + _FEATURES + "SELECT * FROM product_features",
    "feature_service_user": _EV + _FEATURES + """SELECT user_id, user_segment, total_events, days_last AS days_since_last_seen,
        ROUND(score, 6) AS activity_score FROM user_features""",
    "feature_service_product": _EV + _FEATURES + "SELECT * FROM product_features",
    "feature_lookup": _EV + _FEATURES + f"""SELECT {_USER_FEATURES} FROM user_features
        WHERE user_id IN (SELECT user_id FROM stg WHERE event_type = 'purchase' AND device = 'mobile')""",
    "feature_latest": _EV + """SELECT user_id, event_ts, event_id AS view_id, product_id, duration_ms FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_ts DESC, event_id DESC) AS rn
        FROM stg WHERE event_type = 'view') WHERE rn = 1""",
    "feature_online": _EV + """SELECT user_id, event_ts, event_id AS view_id, product_id, duration_ms FROM stg WHERE event_type = 'view'
        AND user_id IN (SELECT user_id FROM stg WHERE event_type = 'purchase' AND device = 'mobile')
        QUALIFY (event_ts, event_id) = MAX((event_ts, event_id)) OVER (PARTITION BY user_id)""",
    "feature_historical": _EV + """, seen AS (
          SELECT p.event_id, p.user_id, p.event_ts AS as_of, w.event_type, arg_max(w, (w.event_ts, w.event_id)) AS w
          FROM stg p JOIN stg w ON w.user_id = p.user_id AND w.event_ts <= p.event_ts
            AND (w.event_type = 'view' OR (w.event_type = 'click' AND w.event_ts >= p.event_ts - INTERVAL 1 DAY))
          WHERE p.event_type = 'purchase' GROUP BY ALL)
        SELECT p.event_id, p.user_id, p.event_ts AS as_of, v.w.event_ts AS view_ts, v.w.event_id AS view_id, v.w.product_id AS product_id,
          v.w.duration_ms AS duration_ms, c.w.event_ts AS click_ts, c.w.event_id AS click_id, c.w.page AS page
        FROM stg p LEFT JOIN seen v ON v.event_id = p.event_id AND v.event_type = 'view'
        LEFT JOIN seen c ON c.event_id = p.event_id AND c.event_type = 'click' WHERE p.event_type = 'purchase'""",
    "feature_point_in_time": _EV + _POINT_IN_TIME.format(ttl=""),
    "feature_point_in_time_ttl": _EV + _POINT_IN_TIME.format(ttl="AND w.event_ts >= p.event_ts - INTERVAL 1 DAY"),
    "feature_point_in_time_hot": _EV + """, hot AS (SELECT * REPLACE (CASE WHEN eid % 10 = 0 THEN user_id ELSE 'hot' END AS user_id,
            make_timestamp(epoch_us(TIMESTAMP '2024-01-15 10:00:00') + epoch_us(event_ts) % 3600000000) AS event_ts) FROM stg)
        """ + _POINT_IN_TIME.format(ttl="").replace("FROM stg", "FROM hot"),
    "recommendation_inputs": _EV + _FEATURES + """SELECT * FROM (SELECT 'user' AS kind, user_id AS id, user_segment AS label,
          ROUND(score, 6) AS score FROM user_features ORDER BY user_features.score DESC, user_id LIMIT 5)
        UNION ALL SELECT * FROM (SELECT 'product', product_id, popularity_tier, purchase_view_ratio FROM product_features
          WHERE popularity_tier IN ('hot', 'warm') ORDER BY purchase_view_ratio DESC, product_id LIMIT 5)""",
    "feature_summary": _EV + _FEATURES + """SELECT user_segment, COUNT(*) AS cnt, ROUND(AVG(score), 6) AS mean_activity_score
        FROM user_features GROUP BY user_segment""",
    "on_demand_udf": _EV + "SELECT product_id, ROUND(total_purchases * 1.0 / total_interactions, 6) AS purchase_share FROM products",
    "training_frame": _EV + _FEATURES + """SELECT user_id, user_segment, CAST(total_events AS DOUBLE) AS total_events,
        CAST(days_first AS DOUBLE) AS days_since_first_seen, CAST(days_last AS DOUBLE) AS days_since_last_seen,
        ROUND(total_events * 1.0 / (days_first + 1), 6) AS events_per_day, ROUND(1.0 / (days_last + 1), 6) AS recency_score,
        ROUND(score, 6) AS activity_score FROM user_features""",
    "training_split": _EV + _TRAINING_USERS + """SELECT user_segment, COUNT(*) AS users,
        CAST(FLOOR(COUNT(*) * 0.2::DOUBLE) AS BIGINT) AS test_users FROM labelled GROUP BY user_segment""",
    "rule_report": _EV + _RULED + "SELECT s AS segment, ROUND(p, 9) AS precision, ROUND(r, 9) AS recall, ROUND(f, 9) AS f1, support FROM report",
    "rule_metrics": _EV + _RULED + """SELECT ROUND(SUM(hit) / SUM(support), 9) AS accuracy, ROUND(SUM(p * support) / SUM(support), 9) AS precision_weighted,
        ROUND(SUM(r * support) / SUM(support), 9) AS recall_weighted, ROUND(SUM(f * support) / SUM(support), 9) AS f1_weighted,
        CAST(SUM(support) AS BIGINT) AS users FROM report""",
    # text and vectors
    "event_text": _EV + """SELECT event_id, CONCAT_WS('，', '事件类型: ' || event_type, '用户: ' || COALESCE(user_raw, 'unknown'),
        '商品: ' || product_id, '页面: ' || page, CASE WHEN referrer <> 'direct' THEN '来源: ' || referrer END,
        '设备: ' || device, '浏览器: ' || browser) AS text_content FROM ev""",
    "product_text": _EV + """SELECT product_id, CONCAT_WS('，', '商品ID: ' || product_id,
        CASE WHEN total_views <> 0 THEN '浏览次数: ' || CAST(total_views AS VARCHAR) END,
        CASE WHEN total_purchases <> 0 THEN '购买次数: ' || CAST(total_purchases AS VARCHAR) END,
        CASE WHEN conversion_rate_pct <> 0 THEN '转化率: ' || CAST(conversion_rate_pct AS VARCHAR) || '%' END) AS text_content FROM products""",
    "event_chunks": _EV + _TALK_EV + _chunk(20, 200) + "SELECT event_id, chunk_no, chunk FROM chunks",
    "event_chunks_short": _EV + _TALK_EV + _chunk(80, 120) + "SELECT event_id, chunk_no, chunk FROM chunks",
    "chunk_length_stats": _EV + _TALK_EV + _chunk(20, 200) + """SELECT COUNT(*) AS cnt, MIN(LENGTH(chunk)) AS min, MAX(LENGTH(chunk)) AS max,
        CAST(FLOOR(AVG(LENGTH(chunk))) AS BIGINT) AS avg, list_sort(list(LENGTH(chunk)))[COUNT(*) // 2 + 1] AS median FROM chunks""",
    "vector_normalize": """SELECT vec_id AS id, 1.0::DOUBLE AS norm, ROUND(SQRT(list_dot_product(v, v)), 5) AS same,
        ROUND(v[1] / SQRT(list_dot_product(v, v)), 5) AS first_x
        FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)""",
    "vector_topk_exact": _EV + _MEANS + _topk("vecs", "label_queries", 10) + _HITS,
    "vector_topk_dirty": _EV + _MEANS + _topk("vecs", "label_queries", 10) + _HITS,
    "vector_topk_filtered": _EV + _MEANS + _topk("vecs", "label_queries", 10, "label < 5") + _HITS,
    "vector_topk_centres": _EV + _MEANS + _PROBED + _HITS,
    "centres_recall": _EV + _MEANS + _PROBED + """, every AS (
          SELECT * FROM (SELECT CAST(query_id AS BIGINT) AS query_id, id,
            ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY ROUND(list_dot_product(q, v), 9) DESC, id) AS r FROM label_queries CROSS JOIN vecs) WHERE r <= 10)
        SELECT COUNT(*) AS exact_hits, COUNT(hits.id) AS found_hits, COUNT(hits.id) / COUNT(*) AS recall
        FROM every LEFT JOIN hits USING (query_id, id)""",
    "vector_topk_ivf_all": _EV + _MEANS + _topk("vecs", "label_queries", 10) + _HITS,
    "vector_tree_all": _EV + _MEANS + _topk("vecs", "label_queries", 10) + _HITS,
    "vector_tree_given": _EV + _MEANS + f""", halved AS (SELECT label * 2 + id % 2 AS half, v FROM vecs),
        halves AS (SELECT half // 2 AS label, half, q FROM ({_MEAN_OF.format(key="half", src="halved")})),
        near_label AS (SELECT id, v, arg_min(query_id, list_distance(q, v)) AS label FROM vecs CROSS JOIN label_queries GROUP BY id, v),
        leaves AS (SELECT n.id, n.v, arg_min(h.half, list_distance(h.q, n.v)) AS half FROM near_label n JOIN halves h USING (label) GROUP BY n.id, n.v),
        first AS (SELECT * FROM (SELECT a.query_id, a.q, b.query_id AS label,
            ROW_NUMBER() OVER (PARTITION BY a.query_id ORDER BY list_distance(a.q, b.q)) AS r FROM label_queries a CROSS JOIN label_queries b) WHERE r <= 3),
        looks AS (SELECT * FROM (SELECT f.query_id, f.q, h.half, ROW_NUMBER() OVER (PARTITION BY f.query_id ORDER BY list_distance(f.q, h.q)) AS r
            FROM first f JOIN halves h USING (label)) WHERE r <= 3),
        near AS (SELECT CAST(query_id AS BIGINT) AS query_id, id, ROUND(list_dot_product(q, v), 9) AS score FROM looks JOIN leaves USING (half)),
        hits AS (SELECT * FROM (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM near) WHERE rank <= 10)
        """ + _HITS,
    "vector_all_queries": _EV + _MEANS + _topk("vecs", "(SELECT id AS query_id, v AS q FROM vecs)", 10) + _HITS,
    "vector_search_events": _EVENT_VECTORS + _topk("target", "page_queries", 10, "LOWER(event_type) = 'purchase'")
        + """SELECT h.query_id, h.id, ROUND(h.score, 4) AS score, h.rank, t.event_id, t.user_id, t.event_type, t.text_content
        FROM hits h JOIN target t ON t.id = h.id""",
    "vector_search_products": _EVENT_VECTORS + f""", goods AS (
        SELECT CAST(SUBSTR(product_id, 2) AS BIGINT) AS id, q AS v FROM ({_MEAN_OF.format(key="product_id", src="(SELECT * FROM target WHERE product_id IS NOT NULL)")}))"""
        + _topk("goods", "page_queries", 5) + """SELECT h.query_id, h.id, ROUND(h.score, 4) AS score, h.rank,
        p.product_id, p.total_views, p.total_purchases
        FROM hits h JOIN products p ON CAST(SUBSTR(p.product_id, 2) AS BIGINT) = h.id""",
    "text_embed": "WITH none AS (SELECT 1)" + _lexical("documents", "doc_id", "COALESCE(text, '')", "lex")
        + f"""SELECT id AS doc_id, CAST(len(v) AS INTEGER) AS dim, ROUND(list_dot_product(v, v), 4) AS norm,
        CAST(len(list_filter(v, lambda x: x > 0)) AS INTEGER) AS slots, ROUND({_PLACE}, 3) AS place FROM lex""",
    "rag_text_hit_rate": _EV + _TALK_EV + _chunk(20, 200) + f""", listed AS (SELECT {_KB_ID} AS id, * FROM chunks),
        asked AS (SELECT * FROM (VALUES (1, 'User performed purchase from google via mobile Chrome', 'purchase'), (2, 'User performed click on page cart', 'click'),
          (3, 'User performed view on page product_detail via desktop', 'view'), (4, 'User performed signup from email', 'signup'),
          (5, 'User performed error on page profile via tablet', 'error')) t(query_id, question, expected_type))"""
        + _lexical("listed", "id", "chunk", "lex", "ask") + _topk("lex", "(SELECT id AS query_id, v AS q FROM ask)", 10)
        + """, judged AS (SELECT a.query_id, MAX(CAST(LOWER(e.event_type) = a.expected_type AS INTEGER)) AS hit
          FROM asked a LEFT JOIN hits h ON h.query_id = a.query_id LEFT JOIN listed e ON e.id = h.id GROUP BY 1)
        SELECT COUNT(*) AS queries, COUNT(*) FILTER (hit = 1) AS hits, COUNT(*) FILTER (hit = 1) / COUNT(*) AS hit_rate FROM judged""",
    # retrieval
    "rag_retrieve": _rag(5, "SELECT query_id, id, ROUND(score, 4) AS score, rank, event_type, user_id, product_id, chunk FROM docs"),
    "rag_prompt": _rag(5, f""", entries AS (SELECT query_id, string_agg(CAST(rank AS VARCHAR) || '. [Event: ' || event_type || ' | User: ' || user_id ||
          ' | Product: ' || product_id || ']' || chr(10) || '   ' || chunk, chr(10) ORDER BY rank) AS context FROM docs GROUP BY query_id)
        SELECT CAST(q.query_id AS BIGINT) AS query_id, concat_ws(chr(10), '{_SYSTEM}', '', '## Context (retrieved from data platform)', context, '',
          '## User Question', question, '', '## Answer') AS prompt FROM questions q JOIN entries e ON e.query_id = q.query_id"""),
    "rag_hit_rate": _rag(10, """, judged AS (SELECT q.query_id, MAX(CAST(d.event_type = q.expected_type AS INTEGER)) AS hit
          FROM questions q LEFT JOIN docs d ON d.query_id = q.query_id GROUP BY q.query_id)
        SELECT COUNT(*) AS queries, COUNT(*) FILTER (hit = 1) AS hits, COUNT(*) FILTER (hit = 1) / COUNT(*) AS hit_rate FROM judged"""),
    "rag_first_types": _rag(10, "SELECT query_id, event_type AS top1_type, ROUND(score, 4) AS score FROM docs WHERE rank = 1"),
    "query_intent": _rag(10, """, types AS (SELECT query_id, event_type, COUNT(*) AS n, MIN(rank) AS first_rank FROM docs GROUP BY 1, 2),
        best AS (SELECT query_id, first(event_type ORDER BY n DESC, first_rank) AS top_type,
          string_agg(event_type || '=' || CAST(n AS VARCHAR), ',' ORDER BY event_type) AS distribution FROM types GROUP BY 1)
        SELECT d.query_id, top_type AS interpreted_intent, COUNT(DISTINCT user_id) AS distinct_users, COUNT(DISTINCT product_id) AS distinct_products,
          'SELECT * FROM raw.user_events WHERE event_type = ''' || top_type || ''' ORDER BY event_ts DESC LIMIT 100;' AS suggested_sql,
          distribution, string_agg(event_type || '|' || chunk, ';' ORDER BY rank) FILTER (rank <= 5) AS matches
        FROM docs d JOIN best b ON b.query_id = d.query_id GROUP BY d.query_id, top_type, distribution"""),
    "kb_build": _EV + _TALK_EV + _chunk(20, 200) + f", listed AS (SELECT {_KB_ID} AS id, * FROM chunks)" + _lexical("listed", "id", "chunk", "lex")
        + f"""SELECT id, event_id, user_id, event_type, COALESCE(product_id, '') AS product_id, page,
        COALESCE(referrer, '') AS referrer, device, browser, COALESCE(product_category, '') AS product_category, duration_ms, chunk,
        CAST(len(v) AS INTEGER) AS dim, ROUND({_PLACE}, 3) AS place FROM listed JOIN lex USING (id)""",
    "kb_build_doubled": _EV + _TALK_EV + _chunk(20, 200) + "SELECT event_id, event_type, chunk FROM chunks",
    "hit_metadata": _EV + _MEANS + _topk("vecs", "label_queries", 10) + """SELECT h.query_id, h.id, h.rank,
        COALESCE(m.event_type, '?') AS event_type, COALESCE(m.user_id, '?') AS user_id
        FROM hits h LEFT JOIN (SELECT * FROM ev WHERE LOWER(event_type) = 'purchase') m ON m.eid = h.id""",
    # streaming
    "stream_land": _EV + f"SELECT {_RAW} FROM parsed",
    "stream_clean": _EV + f"SELECT {_CLEAN}, processing_date FROM cleaned",
    "stream_dedup": _EV + "SELECT event_id, user_raw AS user_id FROM ev",
    "stream_dedup_batches": _EV + "SELECT event_id, user_raw AS user_id FROM ev",
    "stream_window_counts": _EV + _HOURLY.format(src="folded"),
    "stream_bounded": _EV + """SELECT CASE WHEN ROW_NUMBER() OVER (ORDER BY eid // 3, eid % 3) <= 1000 THEN 1 ELSE 2 END AS run,
        eid // 3 AS "offset", event_id, user_raw AS user_id, event_type FROM ev""",
    "stream_sliding_counts": _EV + ", hourly AS (" + _HOURLY.format(src="folded") + """)
        SELECT window_start - to_hours(i) AS window_start, CAST(SUM(events) AS BIGINT) AS events, CAST(SUM(purchases) AS BIGINT) AS purchases
        FROM hourly, range(3) r(i) GROUP BY 1""",
    "failure_rate_alert": _EV + """, minutes AS (SELECT date_trunc('minute', event_ts) AS m, COUNT(*) FILTER (event_type = 'error') AS failures,
          COUNT(*) AS total FROM stg GROUP BY 1)
        SELECT m - to_minutes(i) AS window_start, CAST(SUM(failures) AS BIGINT) AS failures, CAST(SUM(total) AS BIGINT) AS total,
          ROUND(SUM(failures) / SUM(total), 6) AS failure_rate
        FROM minutes, range(5) r(i) GROUP BY 1 HAVING SUM(failures) / SUM(total) > 0.3""",
    "failure_rate_held": _EV + """, minutes AS (SELECT date_trunc('minute', event_ts) AS m, COUNT(*) FILTER (event_type = 'error') AS failures,
          COUNT(*) AS total FROM stg GROUP BY 1),
        hot AS (SELECT m - to_minutes(i) AS w FROM minutes, range(5) r(i) GROUP BY 1 HAVING SUM(failures) / SUM(total) > 0.3)
        SELECT a.w AS window_start FROM hot a JOIN hot b ON b.w BETWEEN a.w - INTERVAL 4 MINUTE AND a.w GROUP BY a.w HAVING COUNT(*) = 5""",
    "absence_alert": _EV + """, ends AS (SELECT epoch(MIN(event_ts))::BIGINT // 600 * 600 AS lo, epoch(MAX(event_ts))::BIGINT // 600 * 600 AS hi FROM ev)
        SELECT make_timestamp(w * 1000000) AS window_start FROM (SELECT UNNEST(range(lo, hi + 1, 600)) AS w FROM ends)
        WHERE w NOT IN (SELECT CAST(FLOOR(epoch(event_ts)) AS BIGINT) // 600 * 600 FROM ev WHERE LOWER(event_type) = 'signup')""",
    "threshold_held": _EV + """, hourly AS (SELECT device, date_trunc('hour', event_ts) AS h, COUNT(*) AS events FROM ev GROUP BY 1, 2)
        SELECT a.device, a.h AS window_start FROM hourly a
        JOIN hourly b ON b.device = a.device AND b.h = a.h - INTERVAL 1 HOUR AND b.events > 2
        JOIN hourly c ON c.device = a.device AND c.h = a.h - INTERVAL 2 HOUR AND c.events > 2 WHERE a.events > 2""",
    "request_rate": _EV + """SELECT time_bucket(INTERVAL 5 MINUTE, event_ts) AS window_start, page, COUNT(*) AS increase,
        ROUND(COUNT(*) / 300.0::DOUBLE, 6) AS per_second FROM ev GROUP BY 1, 2""",
    # SQL surface and jobs
    "sample_sql_1": _EV + "SELECT event_type, COUNT(*) AS cnt FROM ev GROUP BY event_type",
    "sample_sql_2": _EV + "SELECT user_segment, COUNT(*) AS users, CAST(SUM(total_events) AS BIGINT) AS events FROM users GROUP BY user_segment",
    "sample_sql_3": _EV + "SELECT * REPLACE (CAST(event_date AS VARCHAR) AS event_date) FROM daily ORDER BY event_date DESC, event_type LIMIT 10",
    "sample_sql_4": _EV + "SELECT * FROM products ORDER BY conversion_rate_pct DESC NULLS LAST, product_id LIMIT 10",
    "batch_job_counts": _EV + """, loaded AS (SELECT * FROM cleaned WHERE event_ts IS NOT NULL)
        SELECT 'user_events' AS model, COUNT(*) AS rows, CAST(1 AS BIGINT) AS failed_rules FROM cleaned
        UNION ALL SELECT 'stg_user_events', COUNT(*), 0 FROM loaded
        UNION ALL SELECT 'dim_users', COUNT(DISTINCT user_id), 0 FROM loaded
        UNION ALL SELECT 'fct_user_events_daily', COUNT(*), 0 FROM (SELECT DISTINCT CAST(event_ts AS DATE), event_type FROM loaded)
        UNION ALL SELECT 'dim_products', COUNT(DISTINCT product_id), 0 FROM loaded WHERE product_id <> 'unknown'""",
}
ORACLES |= {f"{name}_all": ORACLES[name] for name in (
    "vector_search_events", "vector_search_products", "rag_retrieve", "rag_prompt", "rag_hit_rate", "rag_first_types", "query_intent",
)}
