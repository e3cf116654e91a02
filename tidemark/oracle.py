"""DuckDB SQL that each registered query must agree with."""

from __future__ import annotations

E = """e AS (
  SELECT event_id, user_id, event_type AS url, value, epoch_us(ts) // 1000 AS ms
  FROM events
)"""

LINES = """lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
  FROM documents
),
split_lines AS (
  SELECT doc_id, line_no,
         CASE WHEN regexp_full_match(line, ' +') THEN []
              ELSE string_split(regexp_replace(line, ' +$', ''), ' ') END AS words
  FROM lines
),
w AS (
  SELECT doc_id, line_no, unnest(words) AS word,
         generate_subscripts(words, 1) - 1 AS pos
  FROM split_lines
)"""

HOURLY = """hourly AS (
  SELECT url, ms - ms % 3600000 AS window_start, count(*) AS cnt
  FROM e GROUP BY ALL
)"""

SLIDING = """sliding AS (
  SELECT url, window_start, window_start + 7200000 AS window_end, count(*) AS cnt
  FROM (SELECT url, ms - ms % 3600000 - unnest([0, 3600000]) AS window_start FROM e)
  GROUP BY ALL
),
ranked AS (
  SELECT window_end, url, cnt,
         row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS rank
  FROM sliding
)"""

DAYS = """d AS (
  SELECT event_id, user_id, url, ms, ms - ms % 86400000 AS window_start FROM e
),
lefts AS (
  SELECT user_id, window_start, event_id AS left_id FROM d WHERE url = 'click'
),
rights AS (
  SELECT user_id, window_start, event_id AS right_val, ms FROM d WHERE url = 'purchase'
),
lasts AS (
  SELECT user_id, window_start, arg_max(right_val, (ms, right_val)) AS right_val
  FROM rights GROUP BY ALL
),
left_rows AS (
  SELECT l.user_id, l.window_start, l.left_id, coalesce(r.right_val, -1) AS right_val
  FROM lefts l LEFT JOIN lasts r USING (user_id, window_start)
)"""

ORDERS = """numbered AS (
  SELECT url, ms, value, user_id || '-' ||
         row_number() OVER (PARTITION BY url, user_id ORDER BY ms, event_id) AS order_id
  FROM e WHERE url IN ('click', 'purchase')
),
pairs AS (
  SELECT order_id, a.ms AS a, t.ms AS t, t.value < 20 AS fail
  FROM (SELECT * FROM numbered WHERE url = 'click') a
  FULL JOIN (SELECT * FROM numbered WHERE url = 'purchase') t USING (order_id)
),
outcomes AS (
  SELECT order_id, 'third_timeout' AS outcome, a + 21600000 AS fire_ms FROM pairs
  WHERE t IS NULL OR abs(a - t) > 21600000
  UNION ALL
  SELECT order_id, 'app_timeout', t + 21600000 FROM pairs
  WHERE a IS NULL OR abs(a - t) > 21600000
  UNION ALL
  SELECT order_id,
         CASE WHEN fail THEN 'payment_failed' WHEN a <= t THEN 'third_matched'
              ELSE 'app_matched' END,
         CASE WHEN fail THEN least(a, t) + 21600000 ELSE greatest(a, t) END
  FROM pairs WHERE abs(a - t) <= 21600000
)"""

AGAIN = """again AS (
  SELECT user_id || '-' || k % 3 AS order_id, ms, CASE WHEN url = 'click' THEN 0 ELSE 1 END AS side,
         CASE WHEN url = 'click' THEN '' WHEN value < 20 THEN 'fail' ELSE 'success' END AS status
  FROM (SELECT *, row_number() OVER (PARTITION BY url, user_id ORDER BY ms, event_id) AS k
        FROM e WHERE url IN ('click', 'purchase'))
),
in_turn AS (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ms, side, status) AS rn FROM again
),
steps AS (
  SELECT DISTINCT order_id, 0::BIGINT AS rn, NULL::BIGINT AS app, NULL::BIGINT AS third, NULL::VARCHAR AS status,
         []::BIGINT[] AS timers, NULL::VARCHAR AS ended, NULL::BIGINT AS ended_ms,
         NULL::VARCHAR AS matched, NULL::BIGINT AS ms
  FROM again
  UNION ALL
  SELECT order_id, rn,
         CASE WHEN matched = 'third_matched' THEN NULL WHEN matched IS NULL AND side = 0 THEN ms ELSE app END,
         CASE WHEN matched = 'app_matched' THEN NULL WHEN matched IS NULL AND side = 1 THEN ms ELSE third END,
         CASE WHEN matched = 'app_matched' THEN NULL WHEN matched IS NULL AND side = 1 THEN new_status ELSE status END,
         list_concat(list_filter(timers, lambda t: t >= ms), CASE WHEN matched IS NULL THEN [ms + 21600000] ELSE [] END),
         ended, ended_ms, matched, ms
  FROM (
    SELECT *, CASE WHEN side = 0 AND third IS NOT NULL AND status = 'success' THEN 'app_matched'
                   WHEN side = 1 AND app IS NOT NULL AND new_status = 'success' THEN 'third_matched' END AS matched
    FROM (
      SELECT n.order_id, n.rn, n.ms, n.side, n.status AS new_status, s.timers,
             CASE WHEN s.timers[1] < n.ms THEN NULL ELSE s.app END AS app,
             CASE WHEN s.timers[1] < n.ms THEN NULL ELSE s.third END AS third,
             CASE WHEN s.timers[1] < n.ms THEN NULL ELSE s.status END AS status,
             CASE WHEN NOT s.timers[1] < n.ms THEN NULL WHEN s.app IS NOT NULL AND s.third IS NOT NULL THEN 'payment_failed'
                  WHEN s.app IS NOT NULL THEN 'third_timeout' WHEN s.third IS NOT NULL THEN 'app_timeout' END AS ended,
             s.timers[1] AS ended_ms
      FROM steps s JOIN in_turn n ON n.order_id = s.order_id AND n.rn = s.rn + 1
    )
  )
),
again_outcomes AS (
  SELECT order_id, ended AS outcome, ended_ms AS fire_ms FROM steps WHERE ended IS NOT NULL
  UNION ALL
  SELECT order_id, matched, ms FROM steps WHERE matched IS NOT NULL
  UNION ALL
  SELECT order_id, CASE WHEN app IS NOT NULL AND third IS NOT NULL THEN 'payment_failed'
                        WHEN app IS NOT NULL THEN 'third_timeout' ELSE 'app_timeout' END, timers[1]
  FROM steps JOIN (SELECT order_id, max(rn) AS rn FROM in_turn GROUP BY order_id) USING (order_id, rn)
  WHERE len(timers) > 0 AND (app IS NOT NULL OR third IS NOT NULL)
)"""

PATTERNS = """moves AS (
  SELECT user_id, event_id, url, ms,
         lag(url) OVER (PARTITION BY user_id ORDER BY ms, event_id) AS prev
  FROM e
),
patterns AS (
  SELECT 'view' AS action1, 'click' AS action2, min(ms) AS from_ms,
         1705363200000 AS to_ms FROM e
  UNION ALL
  SELECT 'click', 'purchase', 1705363200000, 9223372036854775807
),
matches AS (
  SELECT user_id, event_id, action1, action2
  FROM moves JOIN patterns
    ON prev = action1 AND url = action2 AND ms >= from_ms AND ms < to_ms
)"""

CYCLES = """ordered AS (
  SELECT user_id, ms, count(*) OVER (PARTITION BY user_id ORDER BY ms) AS upto FROM e
),
nexts AS (
  SELECT a.user_id, a.ms, min(b.ms) AS next_ms
  FROM e a LEFT JOIN e b ON a.user_id = b.user_id AND b.ms > a.ms + 21600000
  GROUP BY a.user_id, a.ms
),
opened AS (
  SELECT user_id, min(ms) AS ms FROM e GROUP BY user_id
  UNION ALL
  SELECT n.user_id, n.next_ms
  FROM opened o JOIN nexts n ON n.user_id = o.user_id AND n.ms = o.ms
  WHERE n.next_ms IS NOT NULL
),
cycles AS (
  SELECT o.user_id, o.ms + 21600000 AS fire_ms, max(r.upto) AS pv
  FROM opened o JOIN ordered r ON r.user_id = o.user_id AND r.ms <= o.ms + 21600000
  GROUP BY o.user_id, o.ms
)"""

AVERAGES = """numbered AS (
  SELECT user_id, row_number() OVER w AS nth, sum(ms) OVER w AS total
  FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ms, event_id)
),
averages AS (
  SELECT user_id, nth, CAST(total // nth AS BIGINT) AS avg_ms
  FROM numbered WHERE nth % 5 = 0
)"""

BUFFERS = """numbered AS (
  SELECT event_id, user_id % 4 AS shard,
         (row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1) // 10 AS chunk
  FROM e
),
chunks AS (
  SELECT shard, chunk, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id
  FROM numbered GROUP BY shard, chunk HAVING count(*) = 10
)"""

TIMERS = """trace AS (
  SELECT 'arrival' AS kind, user_id, ms FROM e
  UNION ALL
  SELECT 'watermark', user_id,
         max(ms) OVER (ORDER BY ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1
  FROM e
  UNION ALL
  SELECT DISTINCT 'timer', CAST(NULL AS BIGINT), ms + 10 FROM e
)"""

WATERMARKS = """seen AS (
  SELECT event_id, ms,
         max(ms) OVER (ORDER BY event_id + (event_id * 7919) % 41, event_id
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 3600001 AS wm_ms
  FROM e
)"""


def _sql(*parts: str, recursive: bool = False) -> str:
    *tables, body = parts
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(tables)}\n{body}"


ORACLE: dict[str, str] = {
    "word_count": _sql(LINES, "SELECT word, count(*) AS cnt FROM w GROUP BY word"),
    "running_word_count": _sql(
        LINES,
        """SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CAST(pos AS INTEGER) AS pos, word,
  count(*) OVER (PARTITION BY word ORDER BY doc_id, line_no, pos
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
FROM w""",
    ),
    "url_tumbling_count": _sql(
        E, HOURLY, "SELECT url, window_start, window_start + 3600000 AS window_end, cnt FROM hourly"
    ),
    "url_count_text": _sql(
        E, HOURLY, "SELECT window_start, 'Url:' || url || '数量为:' || cnt AS message FROM hourly"
    ),
    "fake_window_pv": _sql(
        E,
        """SELECT url, ms // 3600000 * 3600000 AS window_start,
  ms // 3600000 * 3600000 + 3600000 AS window_end, count(*) AS pv
FROM e GROUP BY ALL""",
    ),
    "url_sliding_count": _sql(
        E, SLIDING, "SELECT url, window_start, window_end, cnt FROM sliding"
    ),
    "url_topn_keyed": _sql(
        E, SLIDING, "SELECT window_end, rank, url, cnt FROM ranked WHERE rank <= 3"
    ),
    "url_topn_all": _sql(
        E, SLIDING, "SELECT window_end, rank, url, cnt FROM ranked WHERE rank <= 2"
    ),
    "window_join": _sql(
        E,
        DAYS,
        """SELECT user_id, window_start, left_id AS click_id, right_val AS purchase_id
FROM lefts JOIN rights USING (user_id, window_start)""",
    ),
    "cogroup_left_join": _sql(
        E, DAYS, "SELECT user_id, window_start, left_id, right_val FROM left_rows"
    ),
    "cogroup_full_join": _sql(
        E,
        DAYS,
        """SELECT user_id, window_start, left_id, right_val FROM left_rows
UNION ALL
SELECT user_id, window_start, -1, right_val
FROM rights ANTI JOIN lefts USING (user_id, window_start)""",
    ),
    "interval_join": _sql(
        E,
        """SELECT p.user_id, p.event_id AS purchase_id, c.event_id AS click_id
FROM e p JOIN e c ON p.user_id = c.user_id
 AND c.ms BETWEEN p.ms - 18000000 AND p.ms + 36000000
WHERE p.url = 'purchase' AND c.url = 'click'""",
    ),
    "two_stream_join": _sql(
        E,
        """SELECT l.user_id, l.event_id AS left_id, r.event_id AS right_id
FROM e l JOIN e r ON l.user_id = r.user_id
WHERE l.url = 'signup' AND r.url = 'error'""",
    ),
    "two_stream_join_within": _sql(
        E,
        """SELECT l.user_id, l.event_id AS left_id, r.event_id AS right_id
FROM e l JOIN e r ON l.user_id = r.user_id AND abs(l.ms - r.ms) <= 86400000
WHERE l.url = 'signup' AND r.url = 'error'""",
    ),
    "bill_check": _sql(E, ORDERS, "SELECT order_id, outcome, fire_ms FROM outcomes"),
    "bill_check_repeated": _sql(
        E, AGAIN, "SELECT order_id, outcome, fire_ms FROM again_outcomes", recursive=True
    ),
    "pattern_match": _sql(
        E, PATTERNS, "SELECT user_id, event_id, action1, action2 FROM matches"
    ),
    "periodic_pv": _sql(
        E, CYCLES, "SELECT user_id, fire_ms, pv FROM cycles", recursive=True
    ),
    "avg_ts_every_n": _sql(E, AVERAGES, "SELECT user_id, nth, avg_ms FROM averages"),
    "buffered_chunks": _sql(
        E, BUFFERS, "SELECT shard, chunk, n, first_id, last_id FROM chunks"
    ),
    "buffered_rows": _sql(
        E,
        BUFFERS,
        """SELECT shard, chunk, event_id
FROM numbered JOIN chunks USING (shard, chunk)""",
    ),
    "event_timer_trace": _sql(E, TIMERS, "SELECT kind, user_id, ms FROM trace"),
    "watermark_trace": _sql(
        E,
        WATERMARKS,
        "SELECT event_id, wm_ms, coalesce(ms <= wm_ms, false) AS is_late FROM seen",
    ),
    "route_alerts": _sql(
        E,
        """texts AS (
  SELECT event_id, url, 'Event{name=''' || user_id || ''', url=''' || url ||
         ''', timestamp=' || ms || '}' AS txt
  FROM e
)""",
        """SELECT event_id, CASE WHEN url IN ('click', 'purchase') THEN 'main' ELSE 'side' END AS route,
  CASE WHEN url IN ('click', 'purchase') THEN '检测到' || url || '的信息' || txt
       ELSE 'side-output: ' || txt END AS message
FROM texts""",
    ),
    "split_by_user": _sql(
        E,
        """SELECT CASE user_id WHEN 1 THEN 'user-1' WHEN 2 THEN 'user-2' ELSE 'main' END AS route,
  user_id, url, ms
FROM e""",
    ),
}

# A replay ends with a row that closes everything, so streams report what tables do.
_AS_TABLE = (
    "word_count", "url_tumbling_count", "url_topn_keyed", "url_topn_all", "window_join",
    "cogroup_left_join", "cogroup_full_join", "interval_join", "two_stream_join",
    "two_stream_join_within", "bill_check", "bill_check_repeated", "running_word_count", "pattern_match", "periodic_pv", "avg_ts_every_n",
    "buffered_rows", "route_alerts", "split_by_user",
)
ORACLE |= {f"stream_{name.removesuffix('_keyed')}": ORACLE[name] for name in _AS_TABLE}
ORACLE |= {
    "stream_url_delayed_count": ORACLE["url_tumbling_count"],
    "stream_two_stream_join_salted": ORACLE["two_stream_join"],
    "stream_pattern_control": ORACLE["pattern_match"],
    "stream_buffered_rows_dealt": ORACLE["buffered_rows"],
    "stream_event_timer_trace": _sql(
        E,
        TIMERS,
        """tops AS (SELECT ms // 432000000 AS batch, max(ms) AS top FROM e GROUP BY ALL)""",
        """SELECT kind, user_id, ms FROM trace WHERE kind <> 'watermark'
UNION ALL
SELECT 'watermark', user_id,
  coalesce((SELECT max(top) FROM tops WHERE batch < e.ms // 432000000) - 1, 0)
FROM e""",
    ),
}
