"""The catalog's queries as plain SQL over the same tables, to check results by."""

from __future__ import annotations

# Fixed value: the word characters, for an engine without a Unicode-wide \w.
_DELIMITER = r"[^\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{200C}\x{200D}]+"

_LINES = r"""
numbered AS (
  SELECT doc_id, unnest(l) AS value, unnest(range(0, len(l))) AS line
  FROM (SELECT doc_id, string_split_regex(coalesce(text, ''), '\r\n|\r|\n') AS l FROM documents)
),
lines AS (
  SELECT row_number() OVER (ORDER BY doc_id, line) - 1 AS "offset", value FROM numbered
)"""


def _words(source: str, number: str, text: str) -> str:
    """The words of each text of a table."""
    return f"""
pieces AS (
  SELECT {number} AS "offset", string_split_regex(lower({text}), '{_DELIMITER}') AS p FROM {source}
),
trimmed AS (
  SELECT "offset",
         CASE WHEN len(p) = 1 THEN p
              ELSE p[1:coalesce(list_max(list_transform(range(1, len(p) + 1),
                                lambda i: CASE WHEN p[i] <> '' THEN i ELSE 0 END)), 0)] END AS p
  FROM pieces
),
words AS (
  SELECT "offset", unnest(p) AS word, CAST(unnest(range(0, len(p))) AS INTEGER) AS pos FROM trimmed
)"""


_WORDS = _words("documents", "doc_id", "text")

_SALES = """
sales AS (
  SELECT event_type AS key, CAST(round(value * 100) AS BIGINT) AS value, ts,
         user_id % 4 AS "partition", event_id AS "offset"
  FROM events
)"""

_SHUFFLED = """
arrived AS (
  SELECT CASE WHEN event_id % 33 <> 7 THEN event_type END AS key,
         CAST(round(value * 100) AS BIGINT) AS value,
         CASE WHEN event_id % 33 = 7 THEN ts + INTERVAL '1 day' ELSE ts END AS ts,
         user_id % 4 AS "partition", event_id,
         event_id + CASE WHEN event_id % 10 = 3 THEN 40 ELSE 0 END AS "offset"
  FROM events
)"""


def _timed(source: str) -> str:
    """Window bounds and stream time of each record, by the record-order rule."""
    return f"""
timed AS (
  SELECT *, time_bucket(INTERVAL '1 hour', ts) AS window_start,
         time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
         max(ts) OVER (PARTITION BY "partition" ORDER BY "offset"
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stream_time
  FROM {source} WHERE key IS NOT NULL
),
final_time AS (SELECT "partition", max(ts) AS last_time FROM timed GROUP BY ALL),
final AS (
  SELECT t."partition", window_start, window_end, key, CAST(sum(value) AS BIGINT) AS value
  FROM timed t JOIN final_time f ON t."partition" = f."partition"
  WHERE window_end > stream_time AND window_end <= last_time AND key IS NOT NULL
  GROUP BY ALL
)"""


_MESSAGES = r"""
parts AS (
  SELECT *, CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS cents,
         '"title":"' || event_type || '"' AS title
  FROM events
),
messages AS (
  SELECT event_id AS "offset", user_id % 4 AS "partition", ts,
         CASE event_id % 22
           WHEN 0 THEN '{' || title || ',"tickettotalvalue":' || cents || ',"extra":1}'
           WHEN 1 THEN '{' || title || ',"tickettotalvalue":'
           WHEN 2 THEN '{' || title || ',"tickettotalvalue":"' || cents || '"}'
           WHEN 3 THEN '{' || title || ',"tickettotalvalue":' || cents || '.7}'
           WHEN 4 THEN '{' || title || '}'
           WHEN 5 THEN '{"tickettotalvalue":' || cents || '}'
           WHEN 6 THEN '[' || cents || ']'
           WHEN 7 THEN '{"title":{"a":"' || event_type || '"},"tickettotalvalue":' || cents || '}'
           WHEN 8 THEN '{' || title || ',"tickettotalvalue":"abc"}'
           WHEN 9 THEN '{' || title || ',"tickettotalvalue":-' || cents || '.7}'
           WHEN 10 THEN ''
           WHEN 11 THEN '{' || title || ',"tickettotalvalue":true}'
           WHEN 12 THEN '{"title":null,"tickettotalvalue":null}'
           WHEN 13 THEN '{"title":' || cents || ',"tickettotalvalue":' || cents || '}'
           WHEN 14 THEN '{' || title || ',"tickettotalvalue":"' || cents || '.7"}'
           WHEN 15 THEN NULL
           WHEN 16 THEN '{"title":' || cents || '0.50,"tickettotalvalue":' || cents || '}'
           WHEN 17 THEN '{"title":1e2,"salets":"\"title\":7","tickettotalvalue":' || cents || '}'
           WHEN 18 THEN '{"title":1234567890' || repeat('9876543210', 4) || ',"tickettotalvalue":'
                        || cents || '}'
           WHEN 19 THEN '{' || title || ',"tickettotalvalue":' || cents || ',"title":"twice"}'
           ELSE '{' || title || ',"salets":"' || replace(props, '"', '\"')
                || '","tickettotalvalue":' || cents || '}'
         END AS value, cents
  FROM parts
),
parsed AS (
  SELECT *, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS doc FROM messages
),
shaped AS (
  SELECT *, json_type(doc) AS kind, json_keys(doc) AS names,
         json_type(doc, '$.title') AS title_kind,
         CASE "offset" % 22 WHEN 16 THEN cents || '0.50' WHEN 17 THEN '1e2'
              WHEN 18 THEN '1234567890' || repeat('9876543210', 4) WHEN 19 THEN 'twice'
              ELSE json_extract_string(doc, '$.title') END AS title,
         json_type(doc, '$.salets') AS salets_kind, json_extract_string(doc, '$.salets') AS salets,
         json_type(doc, '$.tickettotalvalue') AS amount_kind,
         json_extract_string(doc, '$.tickettotalvalue') AS amount
  FROM parsed
),
decoded AS (
  SELECT *,
    CASE WHEN doc IS NULL OR kind <> 'OBJECT' THEN 'malformed'
         WHEN len(list_filter(names, lambda n: n NOT IN ('title', 'salets', 'tickettotalvalue'))) > 0
           THEN 'unknown field'
         WHEN coalesce(title_kind, '') IN ('OBJECT', 'ARRAY')
           OR coalesce(salets_kind, '') IN ('OBJECT', 'ARRAY')
           OR coalesce(amount_kind, '') IN ('OBJECT', 'ARRAY', 'BOOLEAN')
           OR (amount_kind = 'VARCHAR' AND NOT regexp_full_match(trim(amount), '[+-]?[0-9]+'))
           THEN 'bad field'
    END AS reject_reason,
    CAST(trunc(CAST(coalesce(try_cast(amount AS DOUBLE), 0) AS DECIMAL(38, 10))) AS BIGINT)
      AS tickettotalvalue
  FROM shaped
)"""

_PAIRS = """
SELECT CAST(v.user_id AS VARCHAR) AS key, greatest(v.ts, c.ts) AS ts,
       v.event_id AS left_id, c.event_id AS right_id, v.value AS left_value, c.value AS right_value
FROM events v JOIN events c
  ON v.user_id = c.user_id
 AND c.ts BETWEEN v.ts - INTERVAL '1 hour' AND v.ts + INTERVAL '1 hour'
WHERE v.event_id % 2 = 0 AND c.event_id % 2 = 1
"""

_ARRIVING = """
arriving AS (
  SELECT event_id, user_id, value, ts, user_id % 4 AS "partition",
         event_id + CASE event_id % 10 WHEN 3 THEN 40 WHEN 6 THEN 20 ELSE 0 END AS "offset"
  FROM events WHERE user_id IS NOT NULL
)"""

# Neither record may be past its reach and the grace when the later one arrives.
_GRACE_PAIRS = f"""
WITH {_ARRIVING},
timed AS (
  SELECT *, max(ts) OVER (PARTITION BY "partition" ORDER BY "offset"
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stream_time
  FROM arriving
)
SELECT CAST(v.user_id AS VARCHAR) AS key, greatest(v.ts, c.ts) AS ts,
       v.event_id AS left_id, c.event_id AS right_id, v.value AS left_value, c.value AS right_value
FROM timed v JOIN timed c
  ON v.user_id = c.user_id
 AND c.ts BETWEEN v.ts - INTERVAL '1 hour' AND v.ts + INTERVAL '1 hour'
WHERE v.event_id % 2 = 0 AND c.event_id % 2 = 1
  AND greatest(v.stream_time, c.stream_time) <= v.ts + INTERVAL '90 minutes'
  AND greatest(v.stream_time, c.stream_time) <= c.ts + INTERVAL '90 minutes'
"""

_FINAL_HOURS = f"""
WITH {_SHUFFLED}, {_timed("arrived")}
SELECT "partition", window_start, window_end, key, value FROM final"""

_LATE = f"""
WITH {_SHUFFLED}, {_timed("arrived")}
SELECT key, value, ts, "partition", event_id, "offset", window_start, window_end
FROM timed WHERE window_end <= stream_time"""

_WORD_COUNT = f"WITH {_WORDS} SELECT word AS key, count(*) AS value FROM words GROUP BY word"

_CHANGES = """
SELECT word AS key, "offset", pos,
       count(*) OVER (PARTITION BY word ORDER BY "offset", pos
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
FROM words"""

_WORD_CHANGES = f"WITH {_WORDS} {_CHANGES}"

_GROUPED_SUM = f"WITH {_SALES} SELECT key, CAST(sum(value) AS BIGINT) AS value FROM sales GROUP BY key"

_SUM_CHANGES = f"""
WITH {_SALES}
SELECT key, "offset",
       CAST(sum(value) OVER (PARTITION BY key ORDER BY "offset"
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS value
FROM sales
"""


def _tumbling(total: str, having: str = "") -> str:
    return f"""
WITH {_SALES}
SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
       time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
       key, {total} AS value
FROM sales GROUP BY 1, 2, 3 {having}
"""


_TICKET_TOTALS = f"""
WITH {_MESSAGES}
SELECT title AS key, CAST(sum(tickettotalvalue) AS BIGINT) AS value
FROM decoded WHERE reject_reason IS NULL AND title IS NOT NULL GROUP BY title
"""


SQL: dict[str, str] = {
    "text_source": 'SELECT doc_id AS "offset", text AS value FROM documents',
    "tokenize_words": f'WITH {_WORDS} SELECT "offset", pos, word FROM words',
    "json_decode_strict": f"""
        WITH {_MESSAGES}
        SELECT "offset", title, salets, tickettotalvalue FROM decoded WHERE reject_reason IS NULL""",
    "json_quarantine": f"""
        WITH {_MESSAGES}
        SELECT "offset", value, reject_reason FROM decoded WHERE reject_reason IS NOT NULL""",
    "json_encode": """
        SELECT event_id, CAST(to_json({'event_id': event_id, 'user_id': user_id,
                                       'event_type': event_type, 'value': value}) AS VARCHAR) AS value
        FROM events""",
    "rekey_project": """
        SELECT event_id, event_type AS key, CAST(round(value * 100) AS BIGINT) AS value FROM events""",
    "rekey_by_id": "SELECT event_id, CAST(user_id AS VARCHAR) AS key, value FROM events",
    "peek_identity": f'WITH {_SALES} SELECT key, value, ts, "partition", "offset" FROM sales',
    "intermediate_hop": """
        SELECT CAST(o_custkey AS VARCHAR) AS key, o_custkey, o_totalprice, o_orderdate AS ts, o_orderkey
        FROM orders""",
    "word_count": _WORD_COUNT,
    "word_count_changelog": _WORD_CHANGES,
    "grouped_sum": _GROUPED_SUM,
    "grouped_count": f"WITH {_SALES} SELECT key, count(*) AS value FROM sales GROUP BY key",
    "grouped_sum_changelog": _SUM_CHANGES,
    "hot_key_changelog": _SUM_CHANGES,
    "hot_word_changelog": _WORD_CHANGES,
    "changelog_compact": _GROUPED_SUM,
    "latest_record": """
        SELECT CAST(user_id AS VARCHAR) AS key,
               arg_max(CAST(round(value * 100) AS BIGINT), event_id) AS cents
        FROM events GROUP BY user_id""",
    "stream_time": f"""
        WITH {_SHUFFLED}, {_timed("arrived")}
        SELECT event_id, "partition", "offset", ts,
               max(ts) OVER (PARTITION BY "partition" ORDER BY "offset"
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stream_time
        FROM arrived""",
    "late_records": _LATE,
    "tumbling_sum": _tumbling("CAST(sum(value) AS BIGINT)"),
    "tumbling_count": _tumbling("count(*)"),
    "tumbling_count_small": _tumbling("count(*)", "HAVING count(*) < 3"),
    "tumbling_sum_final": _FINAL_HOURS,
    "fan_out": f"""
        WITH {_SHUFFLED}, {_timed("arrived")}
        SELECT 'totals' AS branch, CAST(NULL AS BIGINT) AS "partition",
               CAST(NULL AS TIMESTAMP) AS window_start, CAST(NULL AS TIMESTAMP) AS window_end,
               key, CAST(sum(value) AS BIGINT) AS value
        FROM arrived WHERE key IS NOT NULL GROUP BY key
        UNION ALL
        SELECT 'closed windows', "partition", window_start, window_end, key, value FROM final""",
    "interval_join": _PAIRS,
    "interval_join_grace": _GRACE_PAIRS,
    "table_join": f"""
        WITH {_ARRIVING},
        latest AS (
          SELECT event_id, user_id, value, "offset",
                 last_value(CASE WHEN event_id % 2 = 0 THEN event_id END IGNORE NULLS) OVER (
                   PARTITION BY user_id ORDER BY "offset"
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS right_id
          FROM arriving
        )
        SELECT CAST(l.user_id AS VARCHAR) AS key, l.event_id AS left_id, right_id,
               e.value AS right_value
        FROM latest l JOIN events e ON e.event_id = right_id
        WHERE l.event_id % 2 = 1""",
    "ticket_totals": _TICKET_TOTALS,
    "ticket_closed_hours": f"""
        WITH {_MESSAGES},
        amounts AS (
          SELECT title AS key, tickettotalvalue AS value, ts, "partition", "offset"
          FROM decoded WHERE reject_reason IS NULL AND title IS NOT NULL
        ), {_timed("amounts")}
        SELECT CAST("partition" AS INTEGER) AS "partition", window_start, window_end, key, value
        FROM final""",
    "rated_movie_messages": """
        SELECT CAST(r.user_id AS VARCHAR) AS key,
               CAST(to_json({'id': m.user_id, 'title': m.event_type,
                             'releaseyear': year(m.ts), 'rating': r.value}) AS VARCHAR) AS value
        FROM events r JOIN events m
          ON r.user_id = m.user_id
         AND m.ts BETWEEN r.ts - INTERVAL '1 hour' AND r.ts + INTERVAL '1 hour'
        WHERE r.event_id % 2 = 1 AND m.event_id % 2 = 0""",
    "word_count_stream": _WORD_COUNT,
    "grouped_sum_stream": _GROUPED_SUM,
    "grouped_sum_changelog_stream": _SUM_CHANGES,
    # Amounts are not negative, so the largest total is the last.
    "per_partition_changelog_stream": f"""
        WITH {_SALES}
        SELECT key, count(*) AS records, CAST(sum(value) AS BIGINT) AS value FROM sales GROUP BY key""",
    "changelog_table_stream": _GROUPED_SUM,
    "word_count_changelog_stream": _WORD_CHANGES,
    # The accepted sales come in time order, so no record is late.
    "ticket_minutes_stream": f"""
        WITH {_MESSAGES},
        amounts AS (
          SELECT title AS key, tickettotalvalue AS value, ts,
                 time_bucket(INTERVAL '1 hour', ts) AS window_start
          FROM decoded WHERE reject_reason IS NULL AND title IS NOT NULL
        )
        SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, key,
               CAST(sum(value) AS BIGINT) AS value
        FROM amounts WHERE window_start + INTERVAL '1 hour' <= (SELECT max(ts) FROM amounts)
        GROUP BY ALL""",
    # The events come in time order, so no record is late.
    "tumbling_sum_stream": f"""
        SELECT * FROM ({_tumbling("CAST(sum(value) AS BIGINT)")})
        WHERE window_end <= (SELECT max(ts) FROM events)""",
    "interval_join_stream": _PAIRS,
    "ticket_totals_stream": _TICKET_TOTALS,
    "rated_movies_stream": """
        SELECT CAST(r.user_id AS VARCHAR) AS key, greatest(r.ts, m.ts) AS ts, m.user_id AS id,
               m.event_type AS title, CAST(year(m.ts) AS INTEGER) AS releaseyear, r.value AS rating
        FROM events r JOIN events m
          ON r.user_id = m.user_id
         AND m.ts BETWEEN r.ts - INTERVAL '1 hour' AND r.ts + INTERVAL '1 hour'
        WHERE r.event_id % 2 = 1 AND m.event_id % 2 = 0""",
    "grouped_sum_state_stream": _GROUPED_SUM,
    "tumbling_final_stream": _FINAL_HOURS,
    "late_records_stream": _LATE,
    "interval_join_grace_stream": _GRACE_PAIRS,
    "text_in_order": f'WITH {_LINES} SELECT "offset", value FROM lines',
    "text_word_changelog": f"""WITH {_LINES}, {_words("lines", '"offset"', "value")} {_CHANGES}""",
    "bucketed_stop": _PAIRS,
    "start_in_days": """
        SELECT event_id, ts, user_id FROM events
        WHERE ts >= (SELECT min(ts) FROM events) + INTERVAL '10 days'""",
    "observed_counts_stream": f"""
        WITH {_MESSAGES},
        counted AS (
          SELECT CASE WHEN reject_reason IS NULL THEN 'accepted' ELSE 'rejected' END AS metric FROM decoded
        )
        SELECT metric, count(*) AS value FROM counted GROUP BY metric
        UNION ALL SELECT 'records', count(*) FROM counted""",
}
