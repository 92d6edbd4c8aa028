"""DuckDB oracle SQL for each registered query.

Each text sees only the pre-registered tables, so each starts from the same
``ce`` definition over ``events`` that ``sources.tables.change_events_from``
builds in Spark.  Column names and types are aligned with the Spark side.
"""

from __future__ import annotations

CE = """ce AS (
  SELECT event_id AS id, event_type AS type,
    CAST(CAST(regexp_extract(props,'([0-9]+)',1) AS INT) % 16 AS INT) AS namespace,
    concat('Page_', CAST(event_id % 1000 AS VARCHAR)) AS title,
    concat('Page_', CAST(event_id % 1000 AS VARCHAR)) AS title_url,
    CASE WHEN event_id % 4 = 0 THEN '' WHEN event_id % 4 = 1 THEN '/* edit */'
         WHEN event_id % 4 = 2 THEN 'revert' ELSE 'update' END AS comment,
    CAST(floor(epoch(ts)) AS BIGINT) AS timestamp,
    concat('user_', CAST(user_id AS VARCHAR)) AS "user",
    (user_id % 7 = 0) AS bot, 'https://example.org' AS server_url, 'Example Wiki' AS server_name,
    'https://example.org/w' AS server_script_url,
    CASE user_id % 4 WHEN 0 THEN 'enwiki' WHEN 1 THEN 'dewiki' WHEN 2 THEN 'frwiki'
         ELSE 'wikidata' END AS wiki,
    CAST(floor(epoch(ts)) AS BIGINT) AS parsed_timestamp,
    value / 20.0 AS duration_s
  FROM events)"""

CE_COLS = ('id, type, namespace, title, title_url, comment, timestamp, "user", bot, server_url, '
           'server_name, server_script_url, wiki, parsed_timestamp')

WSTART = "CAST(floor(timestamp / 60) * 60000 AS BIGINT)"

ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql.strip()


oracle("window_type_counts", f"""
WITH {CE}
SELECT {WSTART} AS window_start, {WSTART} + 60000 AS window_end, type, count(*) AS count
FROM ce GROUP BY 1, 2, 3""")

oracle("window_wiki_counts", f"""
WITH {CE}
SELECT {WSTART} AS window_start, {WSTART} + 60000 AS window_end, wiki, count(*) AS edits
FROM ce GROUP BY 1, 2, 3""")

oracle("window_counts_union", f"""
WITH {CE}
SELECT {WSTART} AS window_start, {WSTART} + 60000 AS window_end, 'type' AS dim, type AS key,
       count(*) AS count FROM ce GROUP BY 1, 2, 3, 4
UNION ALL
SELECT {WSTART} AS window_start, {WSTART} + 60000 AS window_end, 'wiki' AS dim, wiki AS key,
       count(*) AS count FROM ce GROUP BY 1, 2, 3, 4""")

oracle("window_counts_json", f"""
WITH {CE},
t AS (SELECT {WSTART} AS s, type AS k, count(*) AS n FROM ce GROUP BY 1, 2),
w AS (SELECT {WSTART} AS s, wiki AS k, count(*) AS n FROM ce GROUP BY 1, 2)
SELECT '{{"window":{{"start":' || s || ',"end":' || (s + 60000) || '}},"type":"' || k || '","count":' || n || '}}' AS value FROM t
UNION ALL
SELECT '{{"window":{{"start":' || s || ',"end":' || (s + 60000) || '}},"wiki":"' || k || '","edits":' || n || '}}' AS value FROM w""")

oracle("window_top_wikis", f"""
WITH {CE},
c AS (SELECT {WSTART} AS window_start, {WSTART} + 60000 AS window_end, wiki, count(*) AS edits
      FROM ce GROUP BY 1, 2, 3)
SELECT * FROM (
  SELECT window_start, window_end, wiki, edits,
         CAST(row_number() OVER (PARTITION BY window_start ORDER BY edits DESC, wiki) AS BIGINT) AS rank
  FROM c) WHERE rank <= 3""")

UTC_TS = "make_timestamp(CAST({c} AS BIGINT) * 1000000)"
DT = "strftime(" + UTC_TS.format(c="timestamp") + ", '%Y-%m-%d')"
HOUR = "strftime(" + UTC_TS.format(c="timestamp") + ", '%H')"

oracle("event_key", f"""
WITH {CE}
SELECT id, concat(coalesce(wiki, ''), '/', coalesce(title, '')) AS event_key FROM ce""")

oracle("stored_row", f"""
WITH {CE}
SELECT id, namespace, parsed_timestamp,
       strftime({UTC_TS.format(c='parsed_timestamp')}, '%Y-%m-%d %H:%M:%S') AS parsed_utc,
       true AS round_trip
FROM ce""")

oracle("estimated_bytes", f"""
WITH {CE}
SELECT id, CAST(64 + octet_length(encode(type)) + octet_length(encode(title))
  + octet_length(encode(title_url)) + octet_length(encode(comment)) + octet_length(encode("user"))
  + octet_length(encode(server_url)) + octet_length(encode(server_name))
  + octet_length(encode(server_script_url)) + octet_length(encode(wiki)) AS BIGINT) AS estimated_bytes
FROM ce""")

oracle("flush_by_bytes", f"""
WITH {CE},
sized AS (
  SELECT {DT} AS dt, {HOUR} AS hour, timestamp, id, CAST(64 + octet_length(encode(type)) + octet_length(encode(title))
    + octet_length(encode(title_url)) + octet_length(encode(comment)) + octet_length(encode("user"))
    + octet_length(encode(server_url)) + octet_length(encode(server_name))
    + octet_length(encode(server_script_url)) + octet_length(encode(wiki)) AS BIGINT) AS size
  FROM ce),
step AS (SELECT 1024 - max(size) AS step FROM sized WHERE size <= 512),
summed AS (
  SELECT *, size > 512 AS big, row_number() OVER w AS nth, sum(size) OVER w - size AS bytes_before
  FROM sized WINDOW w AS (PARTITION BY dt, hour, size > 512 ORDER BY timestamp, id % 16, id))
SELECT dt, hour, min(timestamp) AS first_ts, max(timestamp) AS last_ts, count(*) AS events,
       CAST(sum(size) AS BIGINT) AS estimated_bytes
FROM (SELECT *, CASE WHEN big THEN nth ELSE (nth - 1) // 6 END AS r,
             CASE WHEN big THEN 0 ELSE CAST(bytes_before AS BIGINT) // step END AS b FROM summed, step)
GROUP BY dt, hour, big, r, b""")

oracle("partition_counts", f"""
WITH {CE}
SELECT {DT} AS dt, {HOUR} AS hour, count(*) AS events FROM ce GROUP BY 1, 2""")

oracle("replay_range", f"""
WITH {CE}
SELECT id, concat(wiki, '/', title) AS event_key, {DT} AS dt, {HOUR} AS hour
FROM ce WHERE {DT} BETWEEN '2024-01-08' AND '2024-01-14'""")

_IN_RANGE = f"{DT} BETWEEN '2024-01-08' AND '2024-01-14'"
oracle("replay_totals", f"""
WITH {CE}
SELECT count(*) AS events, count(*) > 0 AS has_files FROM ce WHERE {_IN_RANGE}""")

oracle("replay_job", f"""
WITH {CE}
SELECT {CE_COLS} FROM ce WHERE {_IN_RANGE}""")

oracle("replay_paced", f"""
WITH {CE}
SELECT id, concat(wiki, '/', title) AS event_key, timestamp,
       CAST((row_number() OVER (ORDER BY timestamp, wiki, id) - 1) // 2000 AS BIGINT) AS tick
FROM ce WHERE {_IN_RANGE}""")

oracle("publish_partitions", f"""
WITH {CE}
SELECT concat(wiki, '/', title) AS event_key, count(*) AS messages, CAST(1 AS BIGINT) AS partitions
FROM ce GROUP BY 1""")

DUPS = f"""{CE},
d0 AS (SELECT {CE_COLS} FROM ce
       UNION ALL
       SELECT id, type, namespace, title, title_url, comment, timestamp + 5 AS timestamp, "user", bot,
              server_url, server_name, server_script_url, wiki, parsed_timestamp
       FROM ce WHERE id % 10 = 0),
dups AS (SELECT CASE WHEN id % 97 = 0 THEN CAST(0 AS BIGINT) ELSE id END AS id, type, namespace, title,
                title_url, comment, timestamp, "user", bot, server_url, server_name, server_script_url,
                wiki, parsed_timestamp FROM d0)"""

oracle("dedup_events", f"""
WITH {DUPS}
SELECT {CE_COLS} FROM dups WHERE id = 0
UNION ALL
SELECT {CE_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY wiki, id ORDER BY timestamp, title, "user", comment) AS rn
  FROM dups WHERE id <> 0) WHERE rn = 1""")

PARSE_ERROR = "json unmarshal: payload is not a valid change event"
MISSING_TS_ERROR = "parse: timestamp field is missing"

oracle("parse_change_event", f"""
WITH {CE}
SELECT id AS source_id, NOT (id % 50 IN (0, 1)) AS is_valid,
  CASE WHEN id % 50 IN (0, 1) THEN NULL ELSE id END AS id,
  CASE WHEN id % 50 IN (0, 1) THEN NULL WHEN id % 50 = 4 THEN '' ELSE type END AS type,
  CASE WHEN id % 50 IN (0, 1) THEN NULL ELSE namespace END AS namespace,
  CASE WHEN id % 50 IN (0, 1) THEN NULL ELSE title END AS title,
  CASE WHEN id % 50 IN (0, 1) THEN NULL ELSE title_url END AS title_url,
  CASE WHEN id % 50 IN (0, 1) THEN NULL ELSE comment END AS comment,
  CASE WHEN id % 50 IN (0, 1) THEN NULL WHEN id % 50 = 2 THEN 0 ELSE timestamp END AS timestamp,
  CASE WHEN id % 50 IN (0, 1) THEN NULL ELSE "user" END AS "user",
  CASE WHEN id % 50 IN (0, 1) THEN NULL ELSE bot END AS bot,
  CASE WHEN id % 50 IN (0, 1) THEN NULL ELSE server_url END AS server_url,
  CASE WHEN id % 50 IN (0, 1) THEN NULL ELSE server_name END AS server_name,
  CASE WHEN id % 50 IN (0, 1) THEN NULL ELSE server_script_url END AS server_script_url,
  CASE WHEN id % 50 IN (0, 1) THEN NULL WHEN id % 50 = 3 THEN '' ELSE wiki END AS wiki,
  CASE WHEN id % 50 IN (0, 1) THEN NULL WHEN id % 50 = 2 THEN 0 ELSE parsed_timestamp END
    AS parsed_timestamp,
  CASE WHEN id % 50 IN (0, 1) THEN '{PARSE_ERROR}' ELSE NULL END AS error_message
FROM ce""")

oracle("parse_defaults", f"""
WITH {CE}
SELECT id AS source_id, NOT (id % 50 IN (0, 2)) AS is_valid,
  CASE WHEN id % 50 IN (0, 2) THEN NULL WHEN id % 50 = 3 THEN 'unknown' ELSE wiki END AS wiki,
  CASE WHEN id % 50 IN (0, 2) THEN NULL WHEN id % 50 = 4 THEN 'unknown' ELSE type END AS type,
  CASE WHEN id % 50 IN (0, 2) THEN NULL ELSE timestamp END AS timestamp,
  CASE WHEN id % 50 = 0 THEN '{PARSE_ERROR}' WHEN id % 50 = 2 THEN '{MISSING_TS_ERROR}'
       ELSE NULL END AS error_message
FROM ce""")

oracle("sse_frames", f"""
WITH {CE}
SELECT {CE_COLS} FROM ce""")

oracle("evolve_v1_v2", f"""
WITH {CE}
SELECT {CE_COLS}, CASE WHEN id % 2 = 0 THEN CAST(namespace % 2 AS INT) ELSE 0 END AS minor,
       CASE WHEN id % 2 = 0 THEN id ELSE NULL END AS page_id
FROM ce""")

oracle("evolve_v2_v1", f"""
WITH {CE}
SELECT {CE_COLS} FROM ce""")

M40 = "id % 40"
WIRE_ERR = (f"CASE WHEN {M40} = 0 THEN 'short message: 3 bytes' WHEN {M40} = 1 THEN 'bad magic byte: 0xff' "
            f"WHEN {M40} = 2 THEN 'get schema 999: schema not found' "
            f"WHEN {M40} = 3 THEN 'avro unmarshal: unexpected end of data' END")

oracle("wire_envelope", f"""
WITH {CE}
SELECT id AS source_id,
  CASE WHEN {M40} = 1 THEN 255 ELSE 0 END AS magic,
  CASE WHEN {M40} = 0 THEN NULL WHEN {M40} = 2 THEN 999 WHEN id % 2 = 1 THEN 1 ELSE 2 END AS schema_id,
  CASE WHEN {M40} = 0 THEN 'short message: 3 bytes' WHEN {M40} = 1 THEN 'bad magic byte: 0xff'
       ELSE NULL END AS envelope_error
FROM ce""")

oracle("schema_lookup", f"""
WITH {CE},
m AS (SELECT id, CASE WHEN {M40} = 0 THEN NULL WHEN {M40} = 2 THEN 999 WHEN id % 2 = 1 THEN 1 ELSE 2 END
        AS schema_id FROM ce)
SELECT id AS source_id, schema_id,
  CASE WHEN schema_id IN (1, 2) THEN 'recentchanges-value' END AS subject,
  CASE WHEN schema_id IN (1, 2) THEN schema_id END AS version,
  coalesce(schema_id IN (1, 2), false) AS found
FROM m""")

def _schema_problems(r: str, w: str) -> str:
    """What keeps version ``r`` from reading ``w``, from the rules that made the schemas."""
    return f"""CASE WHEN {w} IS NULL OR {r} IS NULL THEN '' WHEN {r} % 50 = 7 OR {w} % 50 = 7 THEN 'not a record'
    ELSE concat_ws('; ',
      CASE WHEN {r} % 3 = 0 AND {w} % 3 = 1 THEN 'id: cannot read long'
           WHEN {r} % 3 = 0 AND {w} % 3 = 2 THEN 'id: cannot read null|long'
           WHEN {r} % 3 = 1 AND {w} % 3 = 2 THEN 'id: cannot read null' END,
      CASE WHEN {r} % 4 = 2 AND {w} % 2 = 1 THEN 'minor: missing, no default' END,
      CASE WHEN {r} % 7 = 1 AND {w} % 7 = 2 THEN 'score: cannot read null|double'
           WHEN {r} % 7 = 1 AND {w} % 7 <> 1 THEN 'score: missing, no default' END) END"""


oracle("schema_compatibility", f"""
WITH v AS (
  SELECT user_id, event_id AS n, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS p
  FROM (SELECT DISTINCT user_id, event_id FROM events)),
c AS (SELECT *, {_schema_problems("n", "p")} AS b, {_schema_problems("p", "n")} AS f FROM v)
SELECT concat('user-', CAST(user_id AS VARCHAR)) AS subject, n AS version, p AS previous_version,
  b = '' AS backward, f = '' AS forward, b = '' AND f = '' AS "full", b AS backward_problems, f AS forward_problems
FROM c""")

_V = f"{M40} > 3"
oracle("decode_wire", f"""
WITH {CE}
SELECT id AS source_id, {_V} AS is_valid,
""" + ",\n".join(f"  CASE WHEN {_V} THEN {c} END AS {c}" for c in CE_COLS.split(", ")) + f""",
  {WIRE_ERR} AS error_message
FROM ce""")

oracle("wire_round_trip", f"""
WITH {CE}
SELECT {CE_COLS} FROM ce""")

oracle("error_type", f"""
WITH {CE}
SELECT 'wire' AS source, id AS source_id, {WIRE_ERR} AS error_message,
  CASE WHEN {M40} = 3 THEN 'decode_error' ELSE 'unknown' END AS error_type
FROM ce WHERE {M40} <= 3
UNION ALL
SELECT 'json' AS source, id AS source_id, '{PARSE_ERROR}' AS error_message, 'decode_error' AS error_type
FROM ce WHERE id % 50 IN (0, 1)""")

DLQ_ROWS = f"""{CE},
d AS (SELECT id, concat(wiki, '/', title) AS key, {WIRE_ERR} AS error_message,
        CASE WHEN {M40} = 3 THEN 'decode_error' ELSE 'unknown' END AS error_type,
        strftime(make_timestamp(timestamp * 1000000), '%Y-%m-%d %H:%M:%S') AS ts
      FROM ce WHERE {M40} <= 3)"""

oracle("dlq_route", f"""
WITH {DLQ_ROWS}
SELECT id AS source_id, key, 'recentchanges-dlq' AS topic, error_type, error_message,
  'recentchanges' AS original_topic, '0' AS retry_count, ts AS original_timestamp,
  'decode' AS error_stage, CAST(CASE WHEN id % 80 = 0 THEN 7 ELSE 6 END AS INT) AS n_headers
FROM d""")

oracle("dlq_inspect", f"""
WITH {DLQ_ROWS}
SELECT CASE WHEN id % 80 = 3 THEN '' ELSE 'recentchanges' END AS original_topic, error_type,
  error_message, key, id AS "offset"
FROM d""")

oracle("dlq_replay", f"""
WITH {DLQ_ROWS}
SELECT 'recentchanges' AS topic, key, id AS "offset" FROM d WHERE id % 80 <> 3""")

oracle("retry_route", """
WITH a AS (SELECT user_id AS part, event_id AS attempt,
             event_type='error' OR event_type='view' AS failed FROM events),
e AS (SELECT *, sum(CASE WHEN failed THEN 0 ELSE 1 END)
             OVER (PARTITION BY part ORDER BY attempt) AS epoch FROM a),
n AS (SELECT *, row_number() OVER (PARTITION BY part, epoch ORDER BY attempt) AS n
      FROM e WHERE failed)
SELECT attempt, CAST((n-1)%4 AS BIGINT) AS retry_count, (n-1)%4=3 AS to_dlq FROM n""")

EDIT_STATS = f"""{CE},
h AS (SELECT wiki, CAST(floor(timestamp/3600) AS BIGINT) AS hr, count(*) AS n,
             count(DISTINCT "user") AS u, sum(CASE WHEN bot THEN 1 ELSE 0 END) AS b
      FROM ce GROUP BY 1,2),
k AS (SELECT CAST(range AS BIGINT) AS k FROM range(24)),
g AS (SELECT wiki, hr+k AS hr, sum(n) AS n24 FROM h CROSS JOIN k GROUP BY 1,2),
f AS (SELECT g.wiki AS wiki, CAST((g.hr+1)*3600 AS BIGINT) AS feature_ts,
        CAST(coalesce(h.n,0) AS BIGINT) AS edits_last_hour,
        CAST(g.n24 AS BIGINT) AS edits_last_24h, CAST(coalesce(h.u,0) AS BIGINT) AS unique_users_last_hour,
        round(CAST(h.b AS DOUBLE)/h.n,6) AS bot_fraction,
        round(CAST(h.n AS DOUBLE)/h.u,6) AS avg_edits_per_user
      FROM g LEFT JOIN h ON g.wiki=h.wiki AND g.hr=h.hr)"""

oracle("feature_events", f"""
WITH {CE}
SELECT id AS event_id, wiki, type, namespace, title, "user", CAST(bot AS INT) AS bot, timestamp,
       server_name, comment, timestamp AS feature_ts
FROM ce""")

oracle("feature_edit_stats", f"""
WITH {EDIT_STATS}
SELECT * FROM f""")

_FCOLS = ["feature_ts", "edits_last_hour", "edits_last_24h", "unique_users_last_hour", "bot_fraction",
          "avg_edits_per_user"]
oracle("feature_asof", f"""
WITH {EDIT_STATS},
j AS (SELECT ce.id, ce.wiki, ce.timestamp, {", ".join("f." + c + " AS f_" + c for c in _FCOLS)}
      FROM ce ASOF LEFT JOIN f ON ce.wiki = f.wiki AND ce.timestamp >= f.feature_ts)
SELECT id, wiki, timestamp,
""" + ",\n".join(f"  CASE WHEN timestamp - f_feature_ts <= 7200 THEN f_{c} END AS {c}" for c in _FCOLS)
       + """
FROM j""")

_STATS = ["edits_last_hour", "edits_last_24h", "unique_users_last_hour", "bot_fraction", "avg_edits_per_user"]
oracle("feature_service", f"""
WITH {EDIT_STATS},
r AS (SELECT *, CAST(timestamp + CASE WHEN id % 13 = 0 THEN 400 * 86400 WHEN id % 10 = 0 THEN -1800
             ELSE (id % 120) * 86400 + (id % 7) * 1800 END AS BIGINT) AS request_ts FROM ce),
j AS (SELECT r.*, r.request_ts BETWEEN r.timestamp AND r.timestamp + 90 * 86400 AS fresh,
             f.feature_ts AS stats_feature_ts, r.request_ts - f.feature_ts <= 365 * 86400 AS f_fresh,
             {", ".join("f." + c for c in _STATS)}
      FROM r ASOF LEFT JOIN f ON r.wiki = f.wiki AND r.request_ts >= f.feature_ts)
SELECT id AS event_id, wiki, request_ts, CASE WHEN fresh THEN timestamp END AS event_feature_ts,
  CASE WHEN fresh THEN timestamp END AS event_timestamp, CASE WHEN fresh THEN type END AS type,
  CASE WHEN fresh THEN namespace END AS namespace, CASE WHEN fresh THEN title END AS title,
  CASE WHEN fresh THEN "user" END AS "user", CASE WHEN fresh THEN CAST(bot AS INT) END AS bot,
  CASE WHEN fresh THEN server_name END AS server_name, CASE WHEN fresh THEN comment END AS comment,
  CASE WHEN f_fresh THEN stats_feature_ts END AS stats_feature_ts,
  {", ".join(f"CASE WHEN f_fresh THEN {c} END AS {c}" for c in _STATS)}
FROM j""")

oracle("feature_incremental", f"""
WITH {EDIT_STATS}
SELECT * FROM f""")

oracle("feature_latest", f"""
WITH {EDIT_STATS}
SELECT wiki, feature_ts, edits_last_hour, edits_last_24h, unique_users_last_hour, bot_fraction,
       avg_edits_per_user
FROM (SELECT *, row_number() OVER (PARTITION BY wiki ORDER BY feature_ts DESC) AS rn
      FROM f WHERE feature_ts >= 1704844800 AND feature_ts < 1705708800) WHERE rn = 1""")

BUCKETS = [("0.005", 0.005), ("0.01", 0.01), ("0.025", 0.025), ("0.05", 0.05), ("0.1", 0.1),
           ("0.25", 0.25), ("0.5", 0.5), ("1", 1.0), ("2.5", 2.5), ("5", 5.0), ("10", 10.0)]

oracle("metric_counters", f"""
WITH {CE}
SELECT 'events_published_total' AS metric, 'recentchanges' AS topic, '' AS type, count(*) AS value FROM ce
UNION ALL
SELECT 'events_consumed_total', 'recentchanges', '', count(*) FROM ce WHERE {M40} > 3
UNION ALL
SELECT 'events_failed_total', 'recentchanges',
       CASE WHEN {M40} = 3 THEN 'decode_error' ELSE 'unknown' END, count(*)
FROM ce WHERE {M40} <= 3 GROUP BY 3""")

oracle("metric_histogram", f"""
WITH {CE},
b AS (SELECT * FROM (VALUES {", ".join(f"('{s}', {v})" for s, v in BUCKETS)}, ('+Inf', 'Infinity'::DOUBLE))
      t(le, bound))
SELECT ce.type, b.le, CAST(count(*) FILTER (WHERE ce.duration_s <= b.bound) AS BIGINT) AS count
FROM ce CROSS JOIN b GROUP BY 1, 2""")

oracle("metric_quantiles", f"""
WITH {CE},
b AS (SELECT * FROM (VALUES {", ".join(f"({i + 1}, {v})" for i, (_, v) in enumerate(BUCKETS))}) t(i, bound)),
h AS (SELECT ce.type, b.i, b.bound, CAST(count(*) FILTER (WHERE ce.duration_s <= b.bound) AS DOUBLE) AS cum
      FROM ce CROSS JOIN b GROUP BY 1, 2, 3),
tot AS (SELECT type, CAST(count(*) AS DOUBLE) AS total FROM ce GROUP BY 1),
q AS (SELECT * FROM (VALUES (0.5), (0.95), (0.99)) t(q)),
r AS (SELECT tot.type, q.q, q.q * tot.total AS rank FROM tot CROSS JOIN q),
f AS (SELECT r.type, r.q, r.rank, min(h.i) AS i FROM r LEFT JOIN h ON h.type = r.type AND h.cum >= r.rank
      GROUP BY 1, 2, 3)
SELECT f.type, CAST(f.q AS DOUBLE) AS q, round(CASE WHEN f.i IS NULL THEN 10.0
  ELSE coalesce(p.bound, 0.0) + (c.bound - coalesce(p.bound, 0.0)) * (f.rank - coalesce(p.cum, 0.0))
       / (c.cum - coalesce(p.cum, 0.0)) END, 6) AS value
FROM f LEFT JOIN h c ON c.type = f.type AND c.i = f.i
       LEFT JOIN h p ON p.type = f.type AND p.i = f.i - 1""")

oracle("metric_rate", f"""
WITH {CE}
SELECT CAST((timestamp - timestamp % 60) * 1000 AS BIGINT) AS window_start, type,
       round(count(*) / 60.0, 6) AS rate
FROM ce GROUP BY 1, 2""")

oracle("metric_error_rate", f"""
WITH {CE}
SELECT CAST((timestamp - timestamp % 60) * 1000 AS BIGINT) AS window_start,
       CASE WHEN {M40} = 3 THEN 'decode_error' ELSE 'unknown' END AS error_type,
       round(count(*) / 60.0, 6) AS rate
FROM ce WHERE {M40} <= 3 GROUP BY 1, 2""")

oracle("metric_lag", """
SELECT CAST(user_id % 4 AS INT) AS partition, count(*) AS end_offset,
       CAST(count(*) FILTER (WHERE event_type <> 'error') AS BIGINT) AS committed_offset,
       CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS lag
FROM events GROUP BY 1""")

BATCH_BUCKETS = [(str(10 + 100 * i), 10 + 100 * i) for i in range(20)]
oracle("metric_batch_size", f"""
WITH {CE},
per AS (SELECT wiki, timestamp - timestamp % 30 AS slot, count(*) AS n FROM ce GROUP BY 1, 2),
sz AS (SELECT least(1000, n - (k - 1) * 1000) AS batch_size
       FROM per, LATERAL (SELECT unnest(generate_series(1, CAST(ceil(n / 1000.0) AS BIGINT))) AS k)),
b AS (SELECT * FROM (VALUES {", ".join(f"('{s}', {v})" for s, v in BATCH_BUCKETS)}, ('+Inf', 'Infinity'::DOUBLE))
      t(le, bound))
SELECT b.le, CAST(count(sz.batch_size) FILTER (WHERE sz.batch_size <= b.bound) AS BIGINT) AS count
FROM b CROSS JOIN sz GROUP BY 1""")

oracle("slo_report", f"""
WITH {CE},
x AS (SELECT wiki, timestamp, duration_s * 1000.0 AS latency_ms, type = 'error' AS is_error FROM ce),
s AS (SELECT wiki,
        round(quantile_cont(latency_ms, 0.5), 6) AS p50_ms,
        round(quantile_cont(latency_ms, 0.95), 6) AS p95_ms,
        round(quantile_cont(latency_ms, 0.99), 6) AS p99_ms,
        round(avg(CAST(is_error AS DOUBLE)), 6) AS error_rate,
        round(count(*) / CAST(max(timestamp) - min(timestamp) + 1 AS DOUBLE), 6) AS write_rate
      FROM x GROUP BY 1)
SELECT *, (p50_ms < 50 AND p95_ms < 200 AND p99_ms < 500) AS latency_ok,
       error_rate < 0.01 AS error_rate_ok, write_rate > 100 AS write_rate_ok
FROM s""")

oracle("amplify_events", f"""
WITH {CE},
s AS (SELECT *, row_number() OVER (ORDER BY id) - 1 AS idx FROM ce),
k AS (SELECT count(*) AS k FROM ce),
r AS (SELECT range AS i FROM range((SELECT 2 * k FROM k)))
SELECT CAST(r.i + 1000001 AS BIGINT) AS id, s.type, s.namespace,
  'LoadTest_Page_' || CAST((r.i + 1000001) % 1000 AS VARCHAR) AS title,
  'LoadTest_Page_' || CAST((r.i + 1000001) % 1000 AS VARCHAR) AS title_url, s.comment,
  CAST(1704067200 + floor(r.i / 1000) AS BIGINT) AS timestamp,
  'loadtester_' || CAST(((r.i + 1000001) * 7919) % 100 AS VARCHAR) AS "user", s.bot, s.server_url,
  s.server_name, s.server_script_url, s.wiki,
  CAST(1704067200 + floor(r.i / 1000) AS BIGINT) AS parsed_timestamp
FROM r JOIN s ON s.idx = r.i % (SELECT k FROM k)""")

oracle("dlq_route_retries", """
WITH a AS (SELECT user_id AS part, event_id AS attempt,
             event_type='error' OR event_type='view' AS failed,
             CAST(floor(epoch(ts)) AS BIGINT) AS t FROM events),
e AS (SELECT *, sum(CASE WHEN failed THEN 0 ELSE 1 END)
             OVER (PARTITION BY part ORDER BY attempt) AS epoch FROM a),
n AS (SELECT *, row_number() OVER (PARTITION BY part, epoch ORDER BY attempt) AS n
      FROM e WHERE failed)
SELECT attempt AS source_id, CAST(part AS VARCHAR) AS key, 'sink_error' AS error_type,
  'write to sink failed: flush error' AS error_message, 'recentchanges' AS original_topic,
  CAST((n-1)%4 AS VARCHAR) AS retry_count,
  strftime(make_timestamp(t * 1000000), '%Y-%m-%d %H:%M:%S') AS original_timestamp,
  'sink' AS error_stage
FROM n WHERE (n-1)%4 = 3""")

oracle("stream_window_counts", f"""
WITH {CE},
p AS (SELECT CASE WHEN id % 50 = 3 THEN 'unknown' ELSE wiki END AS wiki,
             CASE WHEN id % 50 = 4 THEN 'unknown' ELSE type END AS type, timestamp
      FROM ce WHERE id % 50 NOT IN (0, 2)),
c AS (SELECT {WSTART} AS window_start, {WSTART} + 60000 AS window_end, 'type' AS dim, type AS key,
             count(*) AS count FROM p GROUP BY 1, 2, 3, 4
      UNION ALL
      SELECT {WSTART} AS window_start, {WSTART} + 60000 AS window_end, 'wiki' AS dim, wiki AS key,
             count(*) AS count FROM p GROUP BY 1, 2, 3, 4)
SELECT * FROM c WHERE window_end <= (SELECT (max(timestamp) - 5) * 1000 FROM p)""")

oracle("stream_dedup", f"""
WITH {DUPS}
SELECT wiki, id FROM dups WHERE id = 0
UNION ALL
SELECT DISTINCT wiki, id FROM dups WHERE id <> 0""")

oracle("store_job", f"""
WITH {CE}
SELECT {CE_COLS} FROM ce WHERE {M40} > 3""")

oracle("ingest_job", f"""
WITH {CE}
SELECT {CE_COLS} FROM ce""")

ORACLES["stream_retry_route"] = ORACLES["retry_route"]

oracle("stream_top_wikis", f"""
WITH {CE},
p AS (SELECT CASE WHEN id % 50 = 3 THEN 'unknown' ELSE wiki END AS wiki, timestamp
      FROM ce WHERE id % 50 NOT IN (0, 2)),
c AS (SELECT {WSTART} AS window_start, {WSTART} + 60000 AS window_end, wiki, count(*) AS edits
      FROM p GROUP BY 1, 2, 3)
SELECT * FROM (
  SELECT window_start, window_end, wiki, edits,
         CAST(row_number() OVER (PARTITION BY window_start ORDER BY edits DESC, wiki) AS BIGINT) AS rank
  FROM c WHERE window_end <= (SELECT (max(timestamp) - 5) * 1000 FROM p)) WHERE rank <= 3""")

oracle("stream_window_json", f"""
WITH {CE},
p AS (SELECT CASE WHEN id % 50 = 3 THEN 'unknown' ELSE wiki END AS wiki,
             CASE WHEN id % 50 = 4 THEN 'unknown' ELSE type END AS type, timestamp
      FROM ce WHERE id % 50 NOT IN (0, 2)),
lim AS (SELECT (max(timestamp) - 5) * 1000 AS w FROM p),
t AS (SELECT {WSTART} AS s, type AS k, count(*) AS n FROM p GROUP BY 1, 2),
w AS (SELECT {WSTART} AS s, wiki AS k, count(*) AS n FROM p GROUP BY 1, 2)
SELECT '{{"window":{{"start":' || s || ',"end":' || (s + 60000) || '}},"type":"' || k || '","count":' || n || '}}' AS value
FROM t WHERE s + 60000 <= (SELECT w FROM lim)
UNION ALL
SELECT '{{"window":{{"start":' || s || ',"end":' || (s + 60000) || '}},"wiki":"' || k || '","edits":' || n || '}}' AS value
FROM w WHERE s + 60000 <= (SELECT w FROM lim)""")

oracle("evolve_wire_v2", f"""
WITH {CE}
SELECT {CE_COLS}, CASE WHEN id % 2 = 0 THEN CAST(namespace % 2 AS INT) ELSE 0 END AS minor,
       CASE WHEN id % 2 = 0 THEN id END AS page_id
FROM ce WHERE {M40} > 3""")

# Each message was delivered twice and read by two runs; n % 40 in (3, 5, 6, 7) is damaged.
oracle("store_redelivery", f"""
WITH {CE}
SELECT CAST(CASE WHEN id % 97 = 0 THEN 0 ELSE id END AS BIGINT) AS id, type, namespace, title, title_url, comment, timestamp,
       "user", bot, server_url, server_name, server_script_url, wiki, parsed_timestamp
FROM ce WHERE id % 40 NOT IN (3, 5, 6, 7)""")
