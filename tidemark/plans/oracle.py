"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written from the operator semantics, not from the Spark plans: sliding
windows expand each row to every window holding it; running aggregates use
plain `OVER` windows; pattern rules use correlated forms where natural.
"""

from __future__ import annotations

# The behaviour log, as `tidemark.sources.tables.behaviour_log` maps it.
B = """b AS (
  SELECT event_id AS seq, ts, user_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         event_type AS behavior, value
  FROM events)"""


def _hop_rows(src: str, size_s: int, slide_s: int, cols: str) -> str:
    """Every (window_end, cols) a row of `src` belongs to."""
    return f"""SELECT {cols}, unnest(range(
          time_bucket(INTERVAL {slide_s} SECOND, ts) + INTERVAL {slide_s} SECOND,
          time_bucket(INTERVAL {slide_s} SECOND, ts) + INTERVAL {size_s + slide_s} SECOND,
          INTERVAL {slide_s} SECOND)) AS window_end
        FROM {src}"""


def _top(src: str, size_s: int, slide_s: int, keys: list[str], n: int = 3) -> str:
    k = ", ".join(keys)
    return f"""SELECT * FROM (
      SELECT window_end, {k}, click_count,
             CAST(row_number() OVER (PARTITION BY window_end ORDER BY click_count DESC, {k})
                  AS INTEGER) AS rank
      FROM (SELECT window_end, {k}, count(*) AS click_count
            FROM ({_hop_rows(src, size_s, slide_s, k)}) GROUP BY ALL))
    WHERE rank <= {n}"""


SQL: dict[str, str] = {}

SQL["pv_tumbling"] = f"""WITH {B}
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       count(*) AS pv
FROM b WHERE behavior = 'view' GROUP BY 1, 2"""

SQL["uv_tumbling"] = f"""WITH {B}
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       count(DISTINCT user_id) AS uv
FROM b WHERE behavior = 'view' GROUP BY 1, 2"""

SQL["uv_whole_window"] = SQL["uv_tumbling"]

SQL["uv_sketch_daily"] = f"""WITH {B}
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start,
       time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
       count(DISTINCT user_id) AS uv, true AS within
FROM b WHERE behavior = 'view' GROUP BY 1, 2"""

SQL["value_profile"] = f"""WITH {B}
SELECT behavior, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(*) AS n,
       CAST(sum(item_id) AS DOUBLE) / count(item_id) AS mean_item, max(value) AS top_value,
       min_by(seq, (-value, seq)) FILTER (value IS NOT NULL) AS top_seq
FROM b GROUP BY 1, 2"""

SQL["hop_count"] = f"""WITH {B}, v AS (SELECT * FROM b WHERE behavior = 'view')
SELECT item_id, count(*) AS click_count, window_end
FROM ({_hop_rows('v', 3600, 300, 'item_id')}) GROUP BY item_id, window_end"""

SQL["top_items"] = f"""WITH {B}, v AS (SELECT * FROM b WHERE behavior = 'view')
SELECT window_end, rank, item_id, click_count FROM ({_top('v', 3600, 300, ['item_id'])})"""

SQL["top_pages"] = f"""WITH {B}
SELECT window_end, rank, item_id AS url_id, click_count FROM ({_top('b', 600, 5, ['item_id'])})"""

SQL["top_ads"] = f"""WITH {B}, a AS (SELECT ts, behavior AS province, item_id AS ad_id FROM b)
SELECT window_end, rank, province, ad_id, click_count
FROM ({_top('a', 3600, 300, ['province', 'ad_id'])})"""

SQL["top_report"] = f"""WITH {B}, v AS (SELECT * FROM b WHERE behavior = 'view'),
t AS ({_top('v', 3600, 300, ['item_id'])})
SELECT window_end,
       'window end: ' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || chr(10) ||
       string_agg('No' || rank || ': item_id=' || item_id || ' click_count=' || click_count,
                  chr(10) ORDER BY rank) AS report
FROM t GROUP BY window_end"""

# ---------------------------------------------------------------- words
WS = r"[ \t\n\x0B\f\r]"
LB = r"\r\n|\r|\n"

SQL["wc_space"] = f"""WITH l AS (
  SELECT unnest(regexp_split_to_array(text, '{LB}')) AS line FROM documents),
t AS (
  SELECT unnest(CASE WHEN line = '' THEN ['']
                     WHEN rtrim(line, ' ') = '' THEN []::VARCHAR[]
                     ELSE string_split(rtrim(line, ' '), ' ') END) AS word
  FROM l)
SELECT word, count(*) AS cnt FROM t GROUP BY word"""

SQL["wc_nonempty_ws"] = f"""SELECT word, count(*) AS cnt
FROM (SELECT unnest(regexp_split_to_array(text, '{WS}')) AS word FROM documents)
WHERE length(word) > 0 GROUP BY word"""

SQL["wc_running"] = f"""WITH a AS (SELECT doc_id, regexp_split_to_array(text, '{WS}') AS arr FROM documents),
t AS (SELECT doc_id, unnest(arr) AS word, CAST(generate_subscripts(arr, 1) - 1 AS INTEGER) AS pos
      FROM a)
SELECT doc_id, pos, word,
       count(*) OVER (PARTITION BY word ORDER BY doc_id, pos
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt
FROM t WHERE length(word) > 0"""

# ---------------------------------------------------------------- decode
SQL["line_decode"] = """SELECT event_id AS seq, user_id, event_type AS behavior, value,
       epoch_us(ts) // 1000000 AS ts_s, date_trunc('second', ts) AS event_time
FROM events"""

SQL["log_decode"] = f"""WITH {B}
SELECT seq, '10.0.' || (user_id % 256) || '.' || (item_id % 256) AS ip,
       CAST(user_id AS VARCHAR) AS user_id, date_trunc('second', ts) AS event_time,
       CASE WHEN behavior = 'purchase' THEN 'POST' ELSE 'GET' END AS method,
       '/item/' || item_id AS url
FROM b"""

# ---------------------------------------------------------------- relational
SQL["select_filter"] = """SELECT event_id, user_id, ts, value FROM events
WHERE event_type = 'view' AND value > 25"""

SQL["sql_view"] = """SELECT event_id, user_id, ts, value FROM events
WHERE event_type = 'click' AND value <= 25"""

SQL["split_high_low"] = f"""WITH {B}
SELECT seq, user_id, value, CASE WHEN value > 30 THEN 'high' ELSE 'low' END AS tag FROM b"""

SQL["connect_map"] = f"""WITH {B}
SELECT seq, user_id AS id, value AS temp, 'high temp warning' AS msg FROM b WHERE value > 30
UNION ALL
SELECT seq, user_id AS id, CAST(NULL AS DOUBLE) AS temp, 'normal' AS msg FROM b
WHERE value IS NULL OR NOT value > 30"""

SQL["pattern_single"] = f"""WITH {B}
SELECT seq, user_id,
       '{{"start":[{{"seq":' || seq || ',"user_id":' || user_id || ',"ts":' ||
       (epoch_us(ts) // 1000000) || ',"behavior":"' || behavior || '"}}]}}' AS match
FROM b WHERE item_id = 29"""

# ---------------------------------------------------------------- rolling
RUN = "(PARTITION BY user_id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
ORD = "(PARTITION BY user_id ORDER BY ts, seq)"

SQL["rolling_reduce"] = f"""WITH {B}
SELECT user_id, seq, max(ts) OVER {RUN} AS max_ts, min(value) OVER {RUN} AS min_value FROM b"""

SQL["rolling_sum"] = f"""WITH {B}
SELECT user_id, seq, round(sum(value) OVER {RUN}, 6) AS running_sum FROM b"""

SQL["rolling_min_first"] = f"""WITH {B}
SELECT user_id, seq, min(value) OVER {RUN} AS min_value, first_value(ts) OVER {RUN} AS first_ts,
       first_value(item_id) OVER {RUN} AS first_item_id FROM b"""

SQL["rolling_min_by"] = f"""WITH {B},
m AS (SELECT user_id, seq,
             min(struct_pack(v := value, t := ts, s := seq, i := item_id)) OVER {RUN} AS r FROM b)
SELECT user_id, seq, r.v AS min_value, r.s AS min_seq, r.t AS min_ts, r.i AS min_item_id FROM m"""

SQL["prev_change_alert"] = f"""WITH {B},
x AS (SELECT user_id, seq, value, lag(value, 1, 0.0) OVER {ORD} AS last FROM b)
SELECT user_id, seq,
       CASE WHEN abs(value - last) > 10 THEN last ELSE 0.0 END AS last_value,
       CASE WHEN abs(value - last) > 10 THEN value ELSE 0.0 END AS cur_value
FROM x"""

SQL["sustained_rise_first"] = f"""WITH {B},
x AS (SELECT user_id, seq, ts, value, lag(value, 1, 0.0) OVER {ORD} AS last FROM b),
z AS (SELECT *, value > last AS rise, value < last AS fall,
             sum(CASE WHEN value < last THEN 1 ELSE 0 END) OVER {RUN} AS run FROM x),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, run ORDER BY ts, seq) AS rn
      FROM z WHERE rise)
SELECT r.user_id, r.seq AS start_seq, r.ts AS start_ts, r.ts + INTERVAL 43200 SECOND AS alert_ts
FROM r LEFT JOIN z f ON f.user_id = r.user_id AND f.fall AND f.run = r.run + 1
WHERE r.rn = 1 AND (f.ts IS NULL OR f.ts > r.ts + INTERVAL 43200 SECOND)"""

# every alert of the rise timer: d is the pending deadline after row n of a user
SQL["stream_rise_alerts"] = f"""WITH RECURSIVE {B},
o AS (SELECT user_id, ts, value, lag(value, 1, 0.0) OVER {ORD} AS last, row_number() OVER {ORD} AS n FROM b),
w(user_id, n, d, alert) AS (
  SELECT DISTINCT user_id, CAST(0 AS BIGINT), CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP) FROM o
  UNION ALL
  SELECT o.user_id, o.n,
         CASE WHEN o.value < o.last THEN NULL
              WHEN o.value > o.last AND (w.d IS NULL OR w.d < o.ts) THEN o.ts + INTERVAL 43200 SECOND
              WHEN w.d < o.ts THEN NULL ELSE w.d END,
         CASE WHEN w.d < o.ts THEN w.d END
  FROM w JOIN o ON o.user_id = w.user_id AND o.n = w.n + 1),
z AS (SELECT user_id, max(n) AS n FROM o GROUP BY user_id),
a AS (SELECT user_id, alert AS alert_ts FROM w WHERE alert IS NOT NULL
      UNION ALL
      SELECT w.user_id, w.d FROM w JOIN z ON z.user_id = w.user_id AND z.n = w.n WHERE w.d IS NOT NULL)
SELECT user_id, alert_ts - INTERVAL 43200 SECOND AS start_ts, alert_ts FROM a"""

# ---------------------------------------------------------------- joins
PAIRS = f"""WITH {B}
SELECT c.user_id, c.seq AS click_seq, p.seq AS purchase_seq, c.ts AS click_ts, p.ts AS purchase_ts
FROM b c JOIN b p ON c.user_id = p.user_id
 AND p.ts BETWEEN c.ts - INTERVAL 3600 SECOND AND c.ts + INTERVAL 3600 SECOND
WHERE c.behavior = 'click' AND p.behavior = 'purchase'"""

SQL["interval_join"] = PAIRS

SQL["reconcile_msg"] = f"""SELECT user_id, click_seq, purchase_seq,
       'order ' || click_seq || ' reconciled with ' || purchase_seq AS msg
FROM ({PAIRS})"""

# ---------------------------------------------------------------- patterns
SQL["pattern_next"] = f"""WITH {B},
x AS (SELECT user_id, seq, ts, behavior, lag(seq) OVER {ORD} AS a_seq, lag(ts) OVER {ORD} AS a_ts,
             lag(behavior) OVER {ORD} AS a_behavior FROM b)
SELECT user_id, a_seq, a_ts, seq AS b_seq, ts AS b_ts FROM x
WHERE behavior = 'error' AND a_behavior = 'error'
  AND epoch_us(ts) - epoch_us(a_ts) < 21600000000"""

SQL["pattern_next_unkeyed"] = f"""WITH {B},
x AS (SELECT user_id, seq, ts, behavior,
             lag(user_id) OVER (ORDER BY ts, seq) AS a_user_id,
             lag(seq) OVER (ORDER BY ts, seq) AS a_seq, lag(ts) OVER (ORDER BY ts, seq) AS a_ts,
             lag(behavior) OVER (ORDER BY ts, seq) AS a_behavior FROM b)
SELECT a_user_id, a_seq, a_ts, user_id AS b_user_id, seq AS b_seq, ts AS b_ts FROM x
WHERE behavior = 'error' AND a_behavior = 'error'
  AND epoch_us(ts) - epoch_us(a_ts) < 21600000000"""

NEXT_BUY = f"""WITH {B},
v AS (SELECT * FROM b WHERE behavior = 'view'),
p AS (SELECT * FROM b WHERE behavior = 'purchase'),
n AS (SELECT v.user_id, v.seq AS a_seq, v.ts AS a_ts,
             min(CASE WHEN p.seq IS NOT NULL THEN struct_pack(t := p.ts, s := p.seq) END) AS nx
      FROM v LEFT JOIN p ON p.user_id = v.user_id
       AND (p.ts > v.ts OR (p.ts = v.ts AND p.seq > v.seq))
      GROUP BY v.user_id, v.seq, v.ts)"""

SQL["pattern_followed_by"] = f"""{NEXT_BUY}
SELECT user_id, a_seq, a_ts, nx.s AS b_seq, nx.t AS b_ts FROM n
WHERE nx IS NOT NULL AND epoch_us(nx.t) - epoch_us(a_ts) < 86400000000"""

SQL["pattern_timeout"] = f"""{NEXT_BUY}
SELECT user_id, a_seq, a_ts, a_ts + INTERVAL 86400 SECOND AS timeout_ts FROM n
WHERE nx IS NULL OR epoch_us(nx.t) - epoch_us(a_ts) >= 86400000000"""

# ---------------------------------------------------------------- detectors
SQL["first_fail"] = f"""WITH {B},
f AS (SELECT user_id, seq, ts FROM b WHERE behavior = 'error'),
x AS (SELECT *, first_value(seq) OVER {RUN} AS ref_seq, first_value(ts) OVER {RUN} AS ref_ts,
             row_number() OVER {ORD} AS rn FROM f)
SELECT user_id, seq, ts, ref_seq, ref_ts FROM x
WHERE rn > 1 AND abs(epoch_us(ts) - epoch_us(ref_ts)) <= 86400000000"""

SQL["prev_fail"] = f"""WITH {B},
f AS (SELECT user_id, seq, ts FROM b WHERE behavior = 'error'),
x AS (SELECT *, lag(seq) OVER {ORD} AS ref_seq, lag(ts) OVER {ORD} AS ref_ts FROM f)
SELECT user_id, seq, ts, ref_seq, ref_ts FROM x
WHERE ref_seq IS NOT NULL AND abs(epoch_us(ts) - epoch_us(ref_ts)) <= 86400000000"""

CAPPED = f"""WITH {B},
x AS (SELECT user_id, behavior, seq, ts,
             row_number() OVER (PARTITION BY user_id, behavior, date_trunc('day', ts)
                                ORDER BY ts, seq) AS n FROM b)"""

SQL["cap_pass"] = f"""{CAPPED}
SELECT user_id, behavior, seq, ts FROM x WHERE n <= 2"""

SQL["cap_alarm"] = f"""{CAPPED}
SELECT user_id, behavior, seq, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, behavior ORDER BY ts, seq) AS k
  FROM x WHERE n = 3) WHERE k = 1"""

SQL["cap_top"] = f"""{CAPPED}, pz AS (SELECT * FROM x WHERE n <= 2)
SELECT window_end, rank, user_id, behavior, click_count
FROM ({_top('pz', 3600, 300, ['user_id', 'behavior'])})"""

SQL["order_status"] = """WITH c AS (SELECT o_orderkey AS order_id, min(o_orderdate) AS create_ts
           FROM orders GROUP BY 1),
p AS (SELECT l_orderkey AS order_id, min(l_shipdate) AS pay_ts FROM lineitem GROUP BY 1),
j AS (SELECT coalesce(c.order_id, p.order_id) AS order_id, create_ts, pay_ts
      FROM c FULL OUTER JOIN p ON c.order_id = p.order_id),
d AS (SELECT *, epoch_us(pay_ts) // 1000000 - epoch_us(create_ts) // 1000000 AS delay_s FROM j)
SELECT order_id,
       CASE WHEN create_ts IS NOT NULL AND pay_ts IS NOT NULL
                 THEN CASE WHEN delay_s > 31536000 THEN 'paid_late' ELSE 'ok' END
            WHEN create_ts IS NOT NULL THEN 'unpaid'
            WHEN pay_ts IS NOT NULL THEN 'pay_without_create'
            ELSE 'bad_type' END AS status,
       create_ts, pay_ts, delay_s
FROM d"""


SQL["stream_late"] = f"""WITH {B}
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS kept, CAST(0 AS BIGINT) AS late
FROM b WHERE behavior = 'view' GROUP BY 1"""

SQL["stream_cap_outputs"] = f"""SELECT *, 'pass' AS output FROM ({SQL["cap_pass"]})
UNION ALL BY NAME SELECT *, 'alarm' AS output FROM ({SQL["cap_alarm"]})"""

SQL["stream_pattern_outputs"] = f"""SELECT user_id, 'match' AS output, a_seq, b_seq, b_ts AS ts FROM ({SQL["pattern_followed_by"]})
UNION ALL SELECT user_id, 'timeout', a_seq, NULL, timeout_ts FROM ({SQL["pattern_timeout"]})"""


def _stream_oracles() -> None:
    from tidemark.streaming.twins import BATCH_TWIN
    for stream_name, batch_name in BATCH_TWIN.items():
        SQL[stream_name] = SQL[batch_name]


_stream_oracles()
