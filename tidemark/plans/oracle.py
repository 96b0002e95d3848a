"""DuckDB SQL that recomputes each registered query from the raw tables.

These strings are the independent check of the DataFrame code: they share no
code path with it, only the conventions (adapter, column names, null rules).
"""

from __future__ import annotations

from dataclasses import dataclass



@dataclass
class MetricSpec:
    """What a metrics query computes, written out here: nothing is shared with the library."""
    key: str
    key_out: str
    category: str
    classes: tuple
    class_names: tuple
    ratio_classes: tuple
    ratio_names: tuple
    measure: str
    count_name: str
    avg_name: str
    max_name: str
    rate_name: str
    rate_divisor: float

    def class_col(self, c: str) -> str:
        return self.class_names[self.classes.index(c)]

    def ratio_col(self, c: str) -> str:
        return self.ratio_names[self.ratio_classes.index(c)]


TWEET_SPEC = MetricSpec("airline", "airline", "airline_sentiment", ("positive", "negative", "neutral"),
                        ("positive_count", "negative_count", "neutral_count"), ("positive", "negative"),
                        ("positive_ratio", "negative_ratio"), "retweet_count", "tweet_count", "avg_retweet",
                        "max_retweet", "tweet_rate", 60.0)
ORDERS_SPEC = MetricSpec("o_orderpriority", "o_orderpriority", "o_orderstatus", ("F", "O", "P"), ("F_count", "O_count", "P_count"),
                         ("F", "O"), ("F_ratio", "O_ratio"), "o_totalprice", "order_count", "avg_totalprice",
                         "max_totalprice", "order_rate", 60.0)

TW = """tw AS (
  SELECT CAST(event_id AS VARCHAR) AS tweet_id,
         'airline_' || CAST(user_id % 6 AS VARCHAR) AS airline,
         CASE event_type WHEN 'error' THEN 'negative' WHEN 'purchase' THEN 'positive' ELSE 'neutral' END
           AS airline_sentiment,
         props AS text,
         CAST(floor(value) AS INTEGER) AS retweet_count,
         strftime(ts, '%Y-%m-%d %H:%M:%S') || ' -0800' AS tweet_created,
         event_id, user_id, ts
  FROM events)"""

WALL = "try_strptime(substr(tweet_created, 1, 19), '%Y-%m-%d %H:%M:%S')"
INSTANT = "timezone('UTC', try_strptime(tweet_created, '%Y-%m-%d %H:%M:%S %z'))"


def metrics_sql(source: str, t_expr: str, unit: str, layer: str, spec: MetricSpec = TWEET_SPEC,
                extra_cols: str = "") -> str:
    """SELECT computing windowed metrics from relation ``source`` (a CTE name)."""
    n = "count(*)"
    cls = ",\n    ".join(
        f"count(*) FILTER (WHERE {spec.category} = '{c}') AS {spec.class_col(c)}" for c in spec.classes)
    ratios = ",\n    ".join(
        f"CASE WHEN {n} > 0 THEN (count(*) FILTER (WHERE {spec.category} = '{c}')) / {n} ELSE 0.0 END"
        f" AS {spec.ratio_col(c)}" for c in spec.ratio_classes)
    if layer == "batch":
        avg = f"CAST(avg({spec.measure}) AS DOUBLE)"
        mx = f"max({spec.measure})"
    else:
        avg = f"CAST(sum(coalesce({spec.measure}, 0)) AS DOUBLE) / {n}"
        mx = f"greatest(0, max({spec.measure}))"
    if spec.measure == TWEET_SPEC.measure:
        mx = f"CAST({mx} AS BIGINT)"
    return f"""SELECT {spec.key} AS {spec.key_out},
    {n} AS {spec.count_name},
    {cls},
    {ratios},
    {avg} AS {spec.avg_name},
    {mx} AS {spec.max_name},
    {n} / CAST({spec.rate_divisor} AS DOUBLE) AS {spec.rate_name},
    date_trunc('{unit}', {t_expr}) AS window_start,
    date_trunc('{unit}', {t_expr}) + INTERVAL 1 {unit} AS window_end{extra_cols}
  FROM {source}
  WHERE {t_expr} IS NOT NULL
  GROUP BY {spec.key}, date_trunc('{unit}', {t_expr})"""


BATCH_HOURLY = f"WITH {TW}\n{metrics_sql('tw', WALL, 'hour', 'batch')}"
BATCH_HOURLY_INSTANT = f"WITH {TW}\n{metrics_sql('tw', INSTANT, 'hour', 'batch')}"
SPEED_MINUTE = f"WITH {TW}\n{metrics_sql('tw', INSTANT, 'minute', 'speed')}"
SPEED_HOUR_DIRECT = f"WITH {TW}\n{metrics_sql('tw', INSTANT, 'hour', 'speed')}"

# Windows a watermarked stream (5 s delay, append mode) has emitted once the
# whole input was read: those that end at or before max(event time) - 5 s.
SPEED_CLOSED = f"""WITH {TW},
m AS ({metrics_sql('tw', INSTANT, 'minute', 'speed')})
SELECT * FROM m
WHERE window_end <= (SELECT max({INSTANT}) FROM tw) - INTERVAL 5 SECOND"""

ORDERS_DAILY = f"""WITH o AS (SELECT * FROM orders)
{metrics_sql('o', 'o_orderdate', 'day', 'batch', ORDERS_SPEC)}"""

WIRE_COLS = ", ".join(f for f in ["airline", "tweet_count", "positive_count", "negative_count", "neutral_count",
                                    "positive_ratio", "negative_ratio", "avg_retweet", "max_retweet",
                                    "tweet_rate"])


def wire_of(sql_with_metrics: str) -> str:
    return f"""SELECT {WIRE_COLS},
  strftime(window_start, '%Y-%m-%dT%H:%M:%SZ') AS window_start,
  strftime(window_end, '%Y-%m-%dT%H:%M:%SZ') AS window_end
FROM ({sql_with_metrics}) w"""


METRIC_COLS = WIRE_COLS + ", window_start, window_end"


def unified_sql(batch_sql: str, speed_sql: str) -> str:
    return f"""WITH b AS ({batch_sql}), s AS ({speed_sql})
SELECT {METRIC_COLS}, 'BATCH' AS source FROM b
UNION ALL
SELECT {METRIC_COLS}, 'REAL-TIME' AS source FROM s
WHERE window_start >= coalesce((SELECT max(window_end) FROM b), TIMESTAMP '1970-01-01 00:00:00')"""


def prune_sql(batch_sql: str, speed_sql: str) -> str:
    return f"""WITH b AS ({batch_sql}), s AS ({speed_sql})
SELECT {METRIC_COLS} FROM s
WHERE NOT coalesce(window_end <= (SELECT max(window_end) FROM b), false)"""


ORACLE: dict[str, str] = {
    "batch_hourly_metrics": BATCH_HOURLY,
    "batch_hourly_metrics_instant": BATCH_HOURLY_INSTANT,
    "speed_minute_metrics": SPEED_MINUTE,
    "metrics_rollup": SPEED_HOUR_DIRECT,
    "metrics_wire": wire_of(SPEED_MINUTE),
    "orders_daily_metrics": ORDERS_DAILY,
    "parse_instant": f"WITH {TW} SELECT tweet_id, tweet_created, {INSTANT} AS t FROM tw",
    "parse_wall": f"WITH {TW} SELECT tweet_id, tweet_created, {WALL} AS t FROM tw",
}


# ============================================================================ more relations
TWEET_COLS = "tweet_id, airline, airline_sentiment, text, retweet_count, tweet_created"
INGESTED = "'2024-02-01T00:00:00.000000+00:00'"
LAKE_ROWS = (f"WITH {TW} SELECT tweet_id, airline, airline_sentiment, text, CAST(retweet_count AS BIGINT) "
             f"AS retweet_count, tweet_created, {INGESTED} AS ingested_at FROM tw")

ALERTS = f"""WITH {TW},
u AS (SELECT CAST(user_id AS VARCHAR) AS tweet_id, airline, airline_sentiment, text, retweet_count,
             tweet_created, ts AS created_at, event_id
      FROM tw WHERE airline_sentiment = 'negative')
SELECT {TWEET_COLS}, created_at FROM u
QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY event_id DESC) = 1"""


def _dq_union(layer: str, a: str, items: list[tuple[str, str, str, str]]) -> str:
    """items: (check, passed expr, detail expr, guard) over relation ``a``."""
    parts = []
    for check, passed, detail, guard in items:
        where = f" WHERE {guard}" if guard else ""
        parts.append(f"SELECT '{layer}' AS layer, '{check}' AS \"check\", {passed} AS passed, "
                     f"{detail} AS detail FROM {a}{where}")
    return "\nUNION ALL\n".join(parts)


def dq_metrics_sql(rel: str, layer: str) -> str:
    a = f"""(SELECT count(*) AS n,
    count(*) FILTER (WHERE airline IS NULL) AS null_airline,
    count(*) FILTER (WHERE tweet_count IS NULL) AS null_tweet_count,
    count(*) FILTER (WHERE positive_ratio < 0 OR positive_ratio > 1) AS range_positive_ratio,
    count(*) FILTER (WHERE negative_ratio < 0 OR negative_ratio > 1) AS range_negative_ratio,
    count(*) FILTER (WHERE tweet_count < 0) AS neg_tweet_count,
    count(*) FILTER (WHERE positive_count < 0) AS neg_positive_count,
    count(*) FILTER (WHERE negative_count < 0) AS neg_negative_count,
    count(*) FILTER (WHERE positive_count + negative_count + neutral_count > tweet_count) AS inconsistent
  FROM ({rel}) m) a"""
    items = [("row count > 0", "n > 0", "CAST(n AS VARCHAR) || ' rows'", "")]
    for c in ["airline", "tweet_count"]:
        items.append((f"null check: {c}", f"null_{c} = 0", f"CAST(null_{c} AS VARCHAR) || ' nulls'", "n > 0"))
    for c in ["positive_ratio", "negative_ratio"]:
        items.append((f"ratio range 0-1: {c}", f"range_{c} = 0", f"CAST(range_{c} AS VARCHAR) || ' out of range'",
                      "n > 0"))
    for c in ["tweet_count", "positive_count", "negative_count"]:
        items.append((f"non-negative: {c}", f"neg_{c} = 0", f"CAST(neg_{c} AS VARCHAR) || ' negative'", "n > 0"))
    items.append(("class counts <= tweet_count", "inconsistent = 0",
                  "CAST(inconsistent AS VARCHAR) || ' inconsistent'", "n > 0"))
    return _dq_union(layer, a, items)


def dq_lake_sql(files: int = 4, rel: str | None = None) -> str:
    a = f"""(SELECT count(*) AS n,
    count(*) FILTER (WHERE tweet_id IS NULL) AS null_tweet_id,
    count(*) FILTER (WHERE airline IS NULL) AS null_airline,
    count(*) FILTER (WHERE airline_sentiment IS NULL) AS null_airline_sentiment,
    count(*) FILTER (WHERE airline_sentiment IS NOT NULL
                     AND airline_sentiment NOT IN ('positive', 'negative', 'neutral')) AS bad_sent,
    string_agg(DISTINCT airline_sentiment, ', ' ORDER BY airline_sentiment)
      FILTER (WHERE airline_sentiment IN ('positive', 'negative', 'neutral')) AS sent_values
  FROM ({rel or LAKE_ROWS}) l) a"""
    items = [("files exist", "true", f"'{files} files found'", ""),
             ("row count > 0", "n > 0", "CAST(n AS VARCHAR) || ' rows'", ""),
             ("schema (7 columns)", "true",
              "'columns: airline, airline_sentiment, ingested_at, retweet_count, text, tweet_created, tweet_id'", "")]
    for c in ["tweet_id", "airline", "airline_sentiment"]:
        items.append((f"null check: {c}", f"null_{c} = 0", f"CAST(null_{c} AS VARCHAR) || ' nulls'", ""))
    items.append(("sentiment values valid", "bad_sent = 0",
                  "CASE WHEN bad_sent = 0 THEN 'values: ' || sent_values ELSE CAST(bad_sent AS VARCHAR) || ' rows with invalid values' END", ""))
    return _dq_union("lake", a, items) + f"""
UNION ALL SELECT 'lake', 'invalid sentiment value', false, airline_sentiment || ': ' || CAST(count(*) AS VARCHAR) || ' rows'
FROM ({rel or LAKE_ROWS}) v WHERE airline_sentiment NOT IN ('positive', 'negative', 'neutral') GROUP BY airline_sentiment"""


def dq_alerts_sql(rel: str | None = None) -> str:
    a = f"""(SELECT count(*) AS n,
    count(*) FILTER (WHERE tweet_id IS NULL OR tweet_id = '') AS null_tweet_id,
    count(*) FILTER (WHERE airline IS NULL OR airline = '') AS null_airline,
    count(*) FILTER (WHERE airline_sentiment IS DISTINCT FROM 'negative') AS not_negative
  FROM ({rel or ALERTS}) x) a"""
    items = [("row count > 0", "n > 0", "CAST(n AS VARCHAR) || ' rows'", "")]
    for c in ["tweet_id", "airline"]:
        items.append((f"null check: {c}", f"null_{c} = 0", f"CAST(null_{c} AS VARCHAR) || ' nulls'", "n > 0"))
    items.append(("all negative", "not_negative = 0", "CAST(not_negative AS VARCHAR) || ' not negative'", "n > 0"))
    return _dq_union("alerts", a, items)


DQ_SPEED = dq_metrics_sql(SPEED_MINUTE, "speed")
DQ_BATCH = dq_metrics_sql(BATCH_HOURLY, "batch")
DQ_SUMMARY = f"""SELECT count(*) AS total, count(*) FILTER (WHERE passed) AS passed,
  count(*) FILTER (WHERE NOT passed) AS failed
FROM (SELECT * FROM ({dq_lake_sql()}
UNION ALL {DQ_SPEED}
UNION ALL {DQ_BATCH}
UNION ALL {dq_alerts_sql()}) c WHERE "check" <> 'invalid sentiment value') r"""

ORACLE.update({
    "valid_time_filter": f"WITH {TW} SELECT {TWEET_COLS}, {WALL} AS tweet_ts FROM tw WHERE {WALL} IS NOT NULL",
    "alert_filter": f"WITH {TW} SELECT {TWEET_COLS} FROM tw WHERE airline_sentiment = 'negative'",
    "landing_normalise": f"WITH {TW} SELECT {TWEET_COLS}, false AS is_bad FROM tw",
    "landing_ordered": f"WITH {TW} SELECT {TWEET_COLS}, false AS is_bad FROM tw",
    "decode_skip_bad": f"WITH {TW} SELECT {TWEET_COLS} FROM tw",
    "raw_lake_scan": LAKE_ROWS,
    "raw_lake_append": LAKE_ROWS,
    "speed_stream": wire_of(SPEED_CLOSED),
    "speed_table_append": f"SELECT {METRIC_COLS} FROM ({SPEED_CLOSED}) s",
    "unified_metrics": unified_sql(BATCH_HOURLY, SPEED_MINUTE),
    "unified_metrics_aligned": unified_sql(BATCH_HOURLY_INSTANT, SPEED_MINUTE),
    "prune_speed": prune_sql(BATCH_HOURLY, SPEED_MINUTE),
    "publish_batch": f"SELECT {METRIC_COLS} FROM ({BATCH_HOURLY}) b",
    "batch_range_scan": f"""SELECT {METRIC_COLS} FROM ({BATCH_HOURLY}) b
WHERE window_start BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 23:59:59'""",
    "metrics_for_airline": f"SELECT * FROM ({BATCH_HOURLY}) b WHERE airline = 'airline_3'",
    "batch_archive": f"SELECT {METRIC_COLS} FROM ({BATCH_HOURLY}) b",
    "alerts_upsert": ALERTS,
    "alerts_by_airline": f"SELECT * FROM ({ALERTS}) a WHERE airline = 'airline_0'",
    "alerts_airline_sentiment": f"""SELECT * FROM ({ALERTS}) a
WHERE airline = 'airline_1' AND airline_sentiment = 'negative'""",
    "alerts_recent_24h": f"""WITH a AS ({ALERTS})
SELECT * FROM a WHERE airline = 'airline_2'
  AND created_at >= (SELECT max(created_at) FROM a) - INTERVAL 24 HOUR""",
    "alerts_latest": f"SELECT * FROM ({ALERTS}) a ORDER BY created_at DESC, tweet_id LIMIT 100",
    "dq_raw_lake": dq_lake_sql(),
    "dq_metrics_speed": DQ_SPEED,
    "dq_metrics_batch": DQ_BATCH,
    "dq_alerts": dq_alerts_sql(),
    "dq_summary": DQ_SUMMARY,
})

SPEED_AFTER_PRUNE = f"""SELECT * FROM ({SPEED_CLOSED}) s
WHERE NOT coalesce(window_end <= (SELECT max(window_end) FROM ({BATCH_HOURLY}) b), false)"""

ORACLE["batch_cycle"] = f"""{dq_lake_sql()}
UNION ALL {dq_metrics_sql(SPEED_AFTER_PRUNE, "speed")}
UNION ALL {DQ_BATCH}
UNION ALL {dq_alerts_sql()}"""

ORACLE["batch_hourly_incremental"] = BATCH_HOURLY
ORACLE["dq_raw_lake_incremental"] = dq_lake_sql(8)
ORACLE["unified_serving_view"] = unified_sql(BATCH_HOURLY, SPEED_AFTER_PRUNE)

# ============================================================================ dirty rows
DTW = TW + """,
dtw AS (
  SELECT CASE WHEN m <> 11 THEN tweet_id END AS tweet_id,
         CASE WHEN m = 10 THEN '' WHEN m <> 0 THEN airline END AS airline,
         CASE WHEN m = 1 THEN NULL WHEN m = 3 THEN 'Positive'
              WHEN m = 4 THEN 'odd_' || CAST((event_id // 23) % 25 AS VARCHAR) ELSE airline_sentiment END AS airline_sentiment,
         CASE WHEN m = 8 THEN '' ELSE text END AS text,
         CASE WHEN m = 7 THEN -5 WHEN m <> 2 THEN retweet_count END AS retweet_count,
         CASE WHEN m = 5 THEN 'garbage' WHEN m = 6 THEN replace(tweet_created, ' -0800', ' +0530')
              WHEN m <> 9 THEN tweet_created END AS tweet_created, event_id, m
  FROM (SELECT *, event_id % 23 AS m FROM tw) x)"""
BATCH_DIRTY = f"WITH {DTW}\n{metrics_sql('dtw', WALL, 'hour', 'batch')}"
DIRTY_LAKE = (f"WITH {DTW} SELECT tweet_id, airline, airline_sentiment, text, CAST(retweet_count AS BIGINT) "
              f"AS retweet_count, tweet_created, {INGESTED} AS ingested_at FROM dtw")
LANDED = f"""WITH {DTW},
l AS (SELECT coalesce(tweet_id, '') AS tweet_id, coalesce(airline, '') AS airline,
             coalesce(airline_sentiment, '') AS airline_sentiment, coalesce(text, '') AS text,
             CASE WHEN m = 12 THEN NULL WHEN m = 13 THEN 7 ELSE coalesce(retweet_count, 0) END AS retweet_count,
             coalesce(tweet_created, '') AS tweet_created, m = 12 AS is_bad, event_id FROM dtw)"""
METRICS_BROKEN = f"""SELECT * REPLACE (
    CASE WHEN airline = 'airline_1' THEN positive_ratio + 1 ELSE positive_ratio END AS positive_ratio,
    CASE WHEN airline = 'airline_2' THEN -1 ELSE negative_count END AS negative_count,
    CASE WHEN airline = 'airline_3' THEN tweet_count + 1 ELSE neutral_count END AS neutral_count,
    CASE WHEN airline IS DISTINCT FROM 'airline_4' THEN tweet_count END AS tweet_count)
  FROM ({BATCH_DIRTY}) b"""
ALERTS_DIRTY = f"""WITH {TW},
u AS (SELECT CASE WHEN user_id % 7 <> 0 THEN CAST(user_id AS VARCHAR) END AS tweet_id, airline, airline_sentiment, text,
             retweet_count, tweet_created, ts AS created_at, event_id
      FROM tw WHERE airline_sentiment = 'negative')
SELECT {TWEET_COLS}, created_at FROM u
QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY event_id DESC) = 1"""

ORACLE.update({
    "batch_hourly_dirty": BATCH_DIRTY,
    "speed_minute_dirty": f"WITH {DTW}\n{metrics_sql('dtw', INSTANT, 'minute', 'speed')}",
    "valid_time_dirty": f"WITH {DTW} SELECT event_id, {TWEET_COLS}, {INSTANT} AS tweet_ts FROM dtw WHERE {INSTANT} IS NOT NULL",
    "decode_skip_dirty": f"""WITH {DTW} SELECT {TWEET_COLS}, event_id FROM dtw
WHERE event_id % 29 NOT IN (0, 1, 2) AND tweet_id IS NOT NULL AND airline IS NOT NULL AND airline_sentiment IS NOT NULL
  AND text IS NOT NULL AND retweet_count IS NOT NULL AND tweet_created IS NOT NULL""",
    "landing_dirty": f"{LANDED} SELECT {TWEET_COLS}, is_bad FROM l",
    "landing_counts": f"{LANDED} SELECT count(*) FILTER (WHERE NOT is_bad) AS records, count(*) FILTER (WHERE is_bad) AS rejected FROM l",
    "landing_replay_index": f"""{LANDED} SELECT airline, tweet_id, tweet_created,
  row_number() OVER (PARTITION BY airline ORDER BY tweet_created, event_id) AS replay_index FROM l""",
    "alerts_upsert_dirty": ALERTS_DIRTY,
    "alert_publish": ORACLE["alert_filter"],
    "wire_frame_check": """SELECT event_id, CASE WHEN event_id % 7 IN (5, 6) THEN 3 END AS schema_id,
  CASE WHEN event_id % 7 IN (5, 6) THEN coalesce(props, '') END AS body, event_id % 7 NOT IN (5, 6) AS is_bad FROM events""",
    "raw_lake_mixed": f"SELECT * FROM ({LAKE_ROWS}) a UNION ALL SELECT * FROM ({DIRTY_LAKE}) b",
    "raw_lake_nested_incremental": BATCH_HOURLY,
    "dq_raw_lake_broken": dq_lake_sql(4, DIRTY_LAKE),
    "dq_metrics_dirty": dq_metrics_sql(METRICS_BROKEN, "batch"),
    "dq_alerts_dirty": dq_alerts_sql(f"WITH {DTW} SELECT * FROM dtw"),
    "dq_missing_alerts": f"""{dq_lake_sql()}
UNION ALL {dq_metrics_sql(SPEED_AFTER_PRUNE, "speed")}
UNION ALL {DQ_BATCH}
UNION ALL SELECT 'alerts', 'row count > 0', false, 'no table'""",
})

# ============================================================================ faults and repairs
ORACLE["raw_lake_ledger"] = f"""SELECT *, CAST(4 AS BIGINT) AS batches, (SELECT count(*) FROM events) AS entered, CAST(0 AS BIGINT) AS wrong
FROM ({LAKE_ROWS}) l"""
ORACLE["batch_hourly_retracted"] = f"""WITH {TW}, kept AS (SELECT * FROM tw WHERE event_id % 4 IN (0, 3) OR event_id % 8 = 2)
{metrics_sql('kept', WALL, 'hour', 'batch')}"""
ORACLE["alerts_out_of_order"] = ORACLE["alerts_merge_on_read"] = f"""WITH {TW},
u AS (SELECT CASE WHEN user_id % 7 <> 0 THEN CAST(user_id AS VARCHAR) END AS tweet_id, airline, airline_sentiment, text,
             retweet_count, tweet_created, ts AS created_at, event_id
      FROM tw WHERE airline_sentiment = 'negative')
SELECT {TWEET_COLS}, created_at FROM u
QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY date_trunc('hour', created_at) DESC, event_id % 3 DESC, event_id // 3 DESC) = 1"""

LAYOUTS = f"""WITH {TW} SELECT tweet_id, airline, CASE event_id % 3 WHEN 1 THEN NULL
       WHEN 2 THEN CASE WHEN event_id % 10 = 0 THEN 'bogus' ELSE airline_sentiment END ELSE airline_sentiment END AS airline_sentiment FROM tw"""
_FULL = "airline, airline_sentiment, ingested_at, retweet_count, text, tweet_created, tweet_id"
_OWN = {0: _FULL, 1: _FULL.replace("airline_sentiment, ", ""), 2: _FULL.replace("ingested_at", "ingested_at, lang")}


def _layouts_sql(layer: str) -> str:
    report = dq_lake_sql(3, LAYOUTS).replace(_FULL, _OWN[2]).replace("'lake'", f"'{layer}'")
    own = "".join(f"""
UNION ALL SELECT '{layer}', 'layout', true, '1 files, ' || count(*) || ' rows: {columns}' FROM events WHERE event_id % 3 = {k}"""
                  for k, columns in _OWN.items())
    return report + own


ORACLE["dq_lake_layouts"] = f"{_layouts_sql('lake')}\nUNION ALL {_layouts_sql('reversed')}"

# ============================================================================ state, sources, lateness
ORACLE["unified_dirty"] = unified_sql(BATCH_DIRTY, ORACLE["speed_minute_dirty"])
MID = "(SELECT make_timestamp((epoch_us(min(ts)) + epoch_us(max(ts))) // 2) FROM events)"
# three-day windows counted from the epoch
ORACLE["speed_open_windows"] = f"""WITH {TW},
h AS (SELECT *, epoch_us({INSTANT} AT TIME ZONE 'UTC') AS us FROM tw WHERE ts < {MID}),
w AS (SELECT *, make_timestamp(us - us % (86400000000 * 3)) AS ws FROM h)
SELECT airline, count(*) AS tweet_count, count(*) FILTER (WHERE airline_sentiment = 'positive') AS positive_count,
  count(*) FILTER (WHERE airline_sentiment = 'negative') AS negative_count, count(*) FILTER (WHERE airline_sentiment = 'neutral') AS neutral_count,
  count(*) FILTER (WHERE airline_sentiment = 'positive') / count(*) AS positive_ratio,
  count(*) FILTER (WHERE airline_sentiment = 'negative') / count(*) AS negative_ratio,
  CAST(sum(coalesce(retweet_count, 0)) AS DOUBLE) / count(*) AS avg_retweet, CAST(greatest(0, max(retweet_count)) AS BIGINT) AS max_retweet,
  count(*) / CAST(60 AS DOUBLE) AS tweet_rate, ws AS window_start, ws + INTERVAL 3 DAY AS window_end
FROM w GROUP BY airline, ws HAVING ws + INTERVAL 3 DAY > (SELECT make_timestamp(max(us)) FROM h) - INTERVAL 5 SECOND"""


def _two_sources(policy: str) -> str:
    pick = {"min": "least", "max": "greatest"}[policy]
    return wire_of(f"""SELECT * FROM (SELECT * FROM m) x WHERE window_end <= (SELECT {pick}(
      max({INSTANT}) FILTER (WHERE event_id % 2 = 0), max({INSTANT}) FILTER (WHERE event_id % 2 = 1)) FROM both_) - INTERVAL 5 SECOND""")


ORACLE["speed_two_sources"] = f"""WITH {TW}, both_ AS (SELECT * FROM tw WHERE event_id % 2 = 0 OR ts < {MID}),
m AS ({metrics_sql('both_', INSTANT, 'minute', 'speed')})
SELECT *, 'min' AS policy FROM ({_two_sources('min')}) a UNION ALL SELECT *, 'max' AS policy FROM ({_two_sources('max')}) b"""
# a micro-batch takes for late what the watermark of the one before its predecessor had closed
ORACLE["speed_late_rows"] = f"""WITH {TW},
x AS (SELECT CASE WHEN event_id % 4 = 1 THEN 3 WHEN ts < {MID} THEN 1 ELSE 2 END AS arrival, airline, {INSTANT} AS t FROM tw WHERE event_id % 4 IN (0, 1)),
n AS (SELECT arrival, count(*) AS input_rows FROM x GROUP BY arrival),
d AS (SELECT count(*) AS dropped FROM (SELECT DISTINCT airline, date_trunc('minute', t) AS w FROM x WHERE arrival = 3) y
      WHERE w + INTERVAL 1 MINUTE <= (SELECT max(t) FROM x WHERE arrival = 1) - INTERVAL 5 SECOND)
SELECT CAST(arrival AS BIGINT) AS arrival, input_rows, CASE WHEN arrival = 3 THEN dropped ELSE 0 END AS dropped FROM n, d"""
