"""Equivalent ANSI SQL (DuckDB dialect) for each registered query.

The SQL is written independently of the Spark plans: plain windows
(``lag``, running ``max``, ``row_number``) and ``CASE`` instead of the
chunked scans, ``max_by`` and literal maps used on the Spark side. Tables
``events``, ``orders`` and ``lineitem`` are views over the given parquet.
"""

from __future__ import annotations

from ..functions.lifecycle import STATE_RANKS, edges_values_sql, rank_case_sql, state_case_sql
from ..sources.testdata import (BAD_PAYLOAD_EVERY, CLICK_TYPES, DUP_DELAY_MIN, DUP_EVERY, ERROR_TYPES,
                                EVENT_TIME_SHIFT_MUL, NO_ID_EVERY, SLICES, TRUNCATED_EVERY, UNKNOWN_EVERY)

TTL_MICROS = 600_000_000
SWAPPED_EVERY = 997  # stored rows of reconcile_content that are another's


def _click_type_case() -> str:
    parts = [f"WHEN n % {UNKNOWN_EVERY} = 0 THEN 'ORDER_LOST'"]
    parts += [f"WHEN et = '{k}' THEN '{v}'" for k, v in CLICK_TYPES.items()]
    parts += [f"WHEN et = 'error' AND k % 4 = {i} THEN '{v}'" for i, v in enumerate(ERROR_TYPES)]
    return "CASE " + " ".join(parts) + " END"


def adapter_a_ctes() -> str:
    """CTE ``order_events``: adapter A with arrival columns and rank."""
    return f"""
a_src AS (
  SELECT event_id AS n, ts, user_id, event_type AS et, value,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k
  FROM events
),
a_good AS (
  SELECT CAST(n AS VARCHAR) AS event_id,
         'O' || CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS order_id,
         {_click_type_case()} AS event_type,
         ts - to_seconds(CAST((n * {EVENT_TIME_SHIFT_MUL}) % 3600 AS BIGINT)) AS "timestamp",
         'C' || CAST(user_id AS VARCHAR) AS customer_id,
         'P' || CAST(k AS VARCHAR) AS product_id,
         CAST(1 + k % 5 AS INTEGER) AS quantity,
         value AS price,
         ts AS arrival_ts,
         n * 2 AS arrival_seq,
         n
  FROM a_src
),
a_fault AS (
  SELECT *, n % {TRUNCATED_EVERY} = 0 AS cut, n % {TRUNCATED_EVERY} <> 0 AND n % {BAD_PAYLOAD_EVERY} = 0 AS word,
         n % {TRUNCATED_EVERY} <> 0 AND n % {BAD_PAYLOAD_EVERY} <> 0 AND n % {NO_ID_EVERY} = 0 AS noid
  FROM a_good
),
a_flat AS (
  SELECT CASE WHEN NOT cut AND NOT noid THEN event_id END AS event_id,
         CASE WHEN NOT cut THEN order_id END AS order_id,
         CASE WHEN NOT cut THEN event_type END AS event_type,
         CASE WHEN NOT cut THEN "timestamp" END AS "timestamp",
         CASE WHEN NOT cut THEN customer_id END AS customer_id,
         CASE WHEN NOT cut THEN product_id END AS product_id,
         CASE WHEN NOT cut AND NOT word THEN quantity END AS quantity,
         CASE WHEN NOT cut THEN price END AS price,
         arrival_ts, arrival_seq, cut OR word OR noid AS malformed, n
  FROM a_fault
),
a_wire AS (
  SELECT * EXCLUDE (n) FROM a_flat
  UNION ALL
  SELECT event_id, order_id, event_type, "timestamp", customer_id, product_id, quantity, price,
         arrival_ts + to_minutes(CAST({DUP_DELAY_MIN} + n % 40 AS BIGINT)) AS arrival_ts,
         arrival_seq + 1 AS arrival_seq, malformed
  FROM a_flat WHERE n % {DUP_EVERY} = 0
),
order_events AS (
  SELECT *, {rank_case_sql('event_type')} AS rk FROM a_wire
)"""


def routed_ctes(mode: str = "drop") -> str:
    """CTEs ``flagged`` and ``routed`` on top of ``order_events``."""
    counted = "NOT malformed AND rk IS NOT NULL" + (" AND NOT is_dup" if mode == "drop" else "")
    dup_route = "WHEN is_dup THEN 'duplicate'" if mode == "drop" else ""
    return f"""{adapter_a_ctes()},
seen AS (
  SELECT *, CASE WHEN order_id IS NOT NULL AND event_id IS NOT NULL THEN
              lag(arrival_ts) OVER (PARTITION BY order_id, event_id
                                    ORDER BY arrival_ts, arrival_seq) END AS prev_seen_ts
  FROM order_events
),
flagged AS (
  SELECT *, (prev_seen_ts IS NOT NULL
             AND date_diff('microsecond', prev_seen_ts, arrival_ts) < {TTL_MICROS}) AS is_dup
  FROM seen
),
ranked AS (
  SELECT *, CASE WHEN order_id IS NOT NULL THEN max(CASE WHEN {counted} THEN rk END) OVER (
              PARTITION BY order_id ORDER BY arrival_ts, arrival_seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS prev_rank
  FROM flagged
),
routed AS (
  SELECT *, CASE WHEN malformed OR rk IS NULL THEN 'quarantine' {dup_route}
                 WHEN prev_rank IS NULL OR rk >= prev_rank THEN 'valid'
                 ELSE 'invalid' END AS route
  FROM ranked
)"""


def adapter_b_ctes() -> str:
    """CTE ``b_events``: adapter B (orders + lineitem)."""
    return """
b_lines AS (
  SELECT l.*, o.o_custkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
b_events AS (
  SELECT CAST(o_orderkey AS VARCHAR) || '-N' AS event_id, CAST(o_orderkey AS VARCHAR) AS order_id,
         'ORDER_PENDING' AS event_type, o_orderdate AS "timestamp",
         'C' || CAST(o_custkey AS VARCHAR) AS customer_id, CAST(NULL AS VARCHAR) AS product_id,
         CAST(NULL AS INTEGER) AS quantity, o_totalprice AS price
  FROM orders
  UNION ALL
  SELECT CAST(o_orderkey AS VARCHAR) || '-A', CAST(o_orderkey AS VARCHAR), 'ORDER_PAID',
         o_orderdate + INTERVAL 1 HOUR, 'C' || CAST(o_custkey AS VARCHAR), NULL, NULL, o_totalprice
  FROM orders WHERE o_orderstatus IN ('F', 'P')
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || kind,
         CAST(l_orderkey AS VARCHAR),
         CASE kind WHEN 'S' THEN 'ORDER_SHIPPED' WHEN 'D' THEN 'ORDER_DELIVERED' ELSE 'ORDER_RETURNED' END,
         CASE kind WHEN 'S' THEN l_shipdate WHEN 'D' THEN l_shipdate + INTERVAL 3 DAY
                   ELSE l_shipdate + INTERVAL 30 DAY END,
         'C' || CAST(o_custkey AS VARCHAR), 'P' || CAST(l_partkey AS VARCHAR),
         CAST(l_quantity AS INTEGER), l_extendedprice
  FROM (SELECT *, 'S' AS kind FROM b_lines
        UNION ALL SELECT *, 'D' FROM b_lines WHERE l_linestatus = 'F'
        UNION ALL SELECT *, 'R' FROM b_lines WHERE l_linestatus = 'F' AND l_returnflag = 'R')
)"""


def latest_sql(src: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT order_id, event_id AS latest_event_id, event_type AS order_status,
         "timestamp" AS latest_event_time, customer_id, product_id, quantity,
         CAST(price AS DECIMAL(10,2)) AS price
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id
          ORDER BY "timestamp" DESC NULLS LAST, event_id DESC, product_id DESC NULLS LAST,
                   quantity DESC NULLS LAST, price DESC NULLS LAST) AS rn
        FROM {src}) t
  WHERE rn = 1
)"""


ORDER_OUT = ("order_id, latest_event_id, order_status, latest_event_time, "
             "customer_id, product_id, quantity, price")


def merge_sql(stored: str, inc: str) -> str:
    newer = (f"(s.order_id IS NOT NULL AND (o.latest_event_time IS NULL "
             f"OR s.latest_event_time > o.latest_event_time))")

    def pick(c):
        return f"CASE WHEN o.order_id IS NULL THEN s.{c} WHEN {newer} THEN s.{c} ELSE o.{c} END AS {c}"

    def sticky(c):
        return f"CASE WHEN o.order_id IS NOT NULL THEN o.{c} ELSE s.{c} END AS {c}"

    return f"""SELECT coalesce(o.order_id, s.order_id) AS order_id,
       {pick('latest_event_id')}, {pick('order_status')}, {pick('latest_event_time')},
       {sticky('customer_id')}, {sticky('product_id')}, {sticky('quantity')}, {sticky('price')}
FROM {stored} o FULL OUTER JOIN {inc} s ON o.order_id = s.order_id"""


def milestones_sql(src: str) -> str:
    cols = ",\n  ".join(
        f"min(CASE WHEN event_type = '{s}' THEN \"timestamp\" END) AS "
        f"{s.removeprefix('ORDER_').lower()}_at" for s in STATE_RANKS)
    return f"SELECT order_id,\n  {cols}\nFROM {src} GROUP BY order_id"


SLICE1_TYPES = "('ORDER_PENDING', 'ORDER_PAID', 'ORDER_SHIPPED')"


def ttl_fold_sql(mode: str = "drop", ttl_micros: int = TTL_MICROS) -> str:
    """Expiring-state validation as a recursive CTE, one step per event."""
    counted = "NOT malformed AND rk IS NOT NULL" + (" AND NOT is_dup" if mode == "drop" else "")
    dup_route = "WHEN r.is_dup THEN 'duplicate'" if mode == "drop" else ""
    ok = f"(c.us - f.st_us >= {ttl_micros} OR c.rk >= f.st_rank)"
    return f"""WITH RECURSIVE {routed_ctes(mode)},
c AS (
  SELECT order_id, arrival_seq, rk, epoch_us(arrival_ts) AS us,
         row_number() OVER (PARTITION BY order_id ORDER BY arrival_ts, arrival_seq) AS i
  FROM flagged WHERE {counted}
),
fold AS (
  SELECT order_id, i, arrival_seq, true AS ok, rk AS st_rank, us AS st_us FROM c WHERE i = 1
  UNION ALL
  SELECT c.order_id, c.i, c.arrival_seq, {ok},
         CASE WHEN {ok} THEN c.rk ELSE f.st_rank END,
         CASE WHEN {ok} THEN c.us ELSE f.st_us END
  FROM fold f JOIN c ON c.order_id = f.order_id AND c.i = f.i + 1
)
SELECT r.event_id, r.order_id, r.event_type, r.arrival_seq, r.is_dup,
       CASE WHEN r.malformed OR r.rk IS NULL THEN 'quarantine' {dup_route}
            WHEN f.ok THEN 'valid' ELSE 'invalid' END AS route
FROM flagged r LEFT JOIN fold f ON r.order_id = f.order_id AND r.arrival_seq = f.arrival_seq"""


def oracle_sql() -> dict[str, str]:
    A = adapter_a_ctes()
    R = routed_ctes("drop")
    K = routed_ctes("keep")
    B = adapter_b_ctes()
    route_cols = "event_id, order_id, event_type, arrival_seq, is_dup, prev_rank, route"
    q: dict[str, str] = {}
    q["parse_flatten_events"] = f"""WITH {A}
SELECT event_id, order_id, event_type, "timestamp", customer_id, product_id, quantity, price,
       arrival_ts, arrival_seq, rk FROM order_events"""
    q["quarantine_unknown"] = f"""WITH {R}
SELECT event_id, order_id, event_type, arrival_seq, CASE WHEN malformed THEN 'malformed' ELSE 'unknown_type' END AS quarantine_reason
FROM routed WHERE route = 'quarantine'"""
    q["duplicate_flags"] = f"""WITH {R}
SELECT event_id, order_id, arrival_ts, arrival_seq, prev_seen_ts, is_dup FROM flagged"""
    q["dedup_drop"] = f"""WITH {R}
SELECT event_id, order_id, event_type, arrival_seq FROM flagged WHERE NOT is_dup"""
    q["validate_drop_dups"] = f"WITH {R}\nSELECT {route_cols} FROM routed"
    q["validate_keep_dups"] = f"WITH {K}\nSELECT {route_cols} FROM routed"
    q["validate_ttl"] = ttl_fold_sql("drop")
    q["validate_ttl_keep_dups"] = ttl_fold_sql("keep")
    q["route_counts"] = f"""WITH {R}
SELECT route, count(*) AS n, CAST(sum(CAST(is_dup AS BIGINT)) AS BIGINT) AS flagged_dups
FROM routed GROUP BY route"""
    q["counts_tumbling_30s"] = f"""WITH {A}
SELECT time_bucket(INTERVAL 30 SECOND, arrival_ts) AS window_start,
       time_bucket(INTERVAL 30 SECOND, arrival_ts) + INTERVAL 30 SECOND AS window_end,
       event_type, count(*) AS n
FROM order_events GROUP BY 1, 2, 3"""
    q["dup_counts_2s"] = f"""WITH {R}
SELECT time_bucket(INTERVAL 2 SECOND, arrival_ts) AS window_start,
       time_bucket(INTERVAL 2 SECOND, arrival_ts) + INTERVAL 2 SECOND AS window_end,
       count(*) AS n
FROM flagged WHERE is_dup GROUP BY 1, 2"""
    q["running_totals"] = f"""WITH {A},
c AS (
  SELECT time_bucket(INTERVAL 30 SECOND, arrival_ts) AS window_start,
         time_bucket(INTERVAL 30 SECOND, arrival_ts) + INTERVAL 30 SECOND AS window_end,
         event_type, count(*) AS n
  FROM order_events GROUP BY 1, 2, 3
)
SELECT window_start, window_end, event_type, n,
       CAST(sum(n) OVER (PARTITION BY event_type ORDER BY window_start
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_n
FROM c"""
    q["latest_order_state"] = f"WITH {B},{latest_sql('b_events', 'latest')}\nSELECT * FROM latest"
    q["latest_order_state_rn"] = q["latest_order_state"]
    q["orders_upsert_incremental"] = f"""WITH {B},
{latest_sql(f"(SELECT * FROM b_events WHERE event_type IN {SLICE1_TYPES})", 's1')},
{latest_sql(f"(SELECT * FROM b_events WHERE event_type NOT IN {SLICE1_TYPES})", 's2')}
{merge_sql('s1', 's2')}"""
    q["orders_point_lookup"] = f"""WITH {B},{latest_sql('b_events', 'latest')}
SELECT * FROM latest WHERE order_id = '7'"""
    q["order_milestones"] = f"WITH {B}\n{milestones_sql('b_events')}"
    q["avg_delivery_time"] = f"""WITH {B}, m AS ({milestones_sql('b_events')}),
d AS (SELECT date_diff('microsecond', paid_at, delivered_at) AS us FROM m
      WHERE delivered_at IS NOT NULL AND paid_at IS NOT NULL)
SELECT count(*) AS n_orders, CAST(sum(us) AS BIGINT) AS total_delivery_micros,
       round(CAST(sum(us) AS DOUBLE) / count(*) / 3.6e9, 6) AS avg_delivery_hours
FROM d"""
    q["invalid_events_report"] = f"""WITH {R}
SELECT strftime(arrival_ts, '%Y-%m/%d/%H') AS partition_key, event_type,
       count(*) AS n, max(arrival_ts) AS last_arrival
FROM routed WHERE route = 'invalid' GROUP BY 1, 2
ORDER BY partition_key DESC, n DESC, event_type"""
    q["partition_keys_hourly"] = f"""WITH {A}
SELECT strftime(arrival_ts, '%Y-%m/%d/%H') AS partition_key,
       strftime(arrival_ts, '%Y-%m-%d') AS dt, strftime(arrival_ts, '%H') AS hr,
       count(*) AS n
FROM order_events GROUP BY 1, 2, 3"""
    trans = f"""WITH {R},
t AS (SELECT *, {state_case_sql('prev_rank')} AS from_state, event_type AS to_state
      FROM routed WHERE route = 'valid')"""
    q["transition_matrix"] = f"{trans}\nSELECT from_state, to_state, count(*) AS n FROM t GROUP BY 1, 2"
    q["strict_transition_violations"] = f"""{trans}
SELECT order_id, event_id, arrival_ts, arrival_seq, from_state, to_state FROM t
WHERE from_state IS NOT NULL AND from_state <> to_state
  AND NOT EXISTS (SELECT 1 FROM {edges_values_sql()} e(a, b)
                  WHERE e.a = t.from_state AND e.b = t.to_state)"""
    q["status_funnel"] = f"""WITH {R},
{latest_sql("(SELECT * FROM routed WHERE route = 'valid')", 'latest')}
SELECT order_status, count(*) AS n_orders FROM latest GROUP BY 1"""
    q["sql_latest_order_state"] = q["orders_point_lookup"]
    q["sql_avg_delivery_time"] = q["avg_delivery_time"]
    q["sql_invalid_lifecycle_events"] = f"""WITH {R}
SELECT event_id, order_id, event_type, "timestamp", customer_id, product_id, quantity, price,
       strftime(arrival_ts, '%Y-%m/%d/%H') AS partition_key
FROM routed WHERE route = 'invalid' ORDER BY "timestamp" DESC"""
    q["status_disagreement"] = f"""WITH {R},
v AS (SELECT * FROM routed WHERE route = 'valid'),
t AS (SELECT order_id, event_type AS event_time_status FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY "timestamp" DESC NULLS LAST,
               event_id DESC, arrival_ts DESC, arrival_seq DESC) AS rn FROM v) WHERE rn = 1),
a AS (SELECT order_id, event_type AS arrival_status FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY arrival_ts DESC,
               arrival_seq DESC) AS rn FROM v) WHERE rn = 1)
SELECT t.order_id, event_time_status, arrival_status FROM t JOIN a USING (order_id)
WHERE event_time_status <> arrival_status"""
    hours = ", ".join(
        f"count(*) FILTER (WHERE route = '{r}') AS {r}" for r in ["valid", "invalid", "duplicate", "quarantine"])
    q["reconcile_routes"] = f"""WITH {R},
h AS (SELECT strftime(arrival_ts, '%Y-%m/%d/%H') AS partition_key, count(*) AS raw, {hours} FROM routed GROUP BY 1)
SELECT *, raw = valid + invalid + duplicate + quarantine AS balanced FROM h"""
    q["reconcile_stored"] = f"""WITH {R},
r AS (SELECT strftime(arrival_ts, '%Y-%m/%d/%H') AS partition_key, count(*) AS raw FROM order_events GROUP BY 1),
h AS (SELECT strftime(arrival_ts, '%Y-%m/%d/%H') AS partition_key, {hours} FROM routed GROUP BY 1)
SELECT *, raw = valid + invalid + duplicate + quarantine AS balanced FROM r FULL JOIN h USING (partition_key)"""
    q["csv_cleanup"] = f"""WITH {R}
SELECT CASE WHEN arrival_seq % 19 = 0 THEN chr(65533) || event_id ELSE event_id END AS event_id, order_id, event_type,
       CASE WHEN arrival_seq % 13 = 0 THEN NULL ELSE "timestamp" END AS "timestamp",
       CASE WHEN arrival_seq % 7 = 0 THEN NULL ELSE customer_id END AS customer_id, product_id,
       CASE WHEN arrival_seq % 11 = 0 THEN NULL ELSE quantity END AS quantity, price, arrival_seq
FROM routed WHERE route = 'valid'"""
    loaded = f"""WITH {R},
ld AS (SELECT route AS dataset, strftime(arrival_ts, '%Y-%m/%d/%H') AS partition_key, *
       FROM routed WHERE route IN ('valid', 'invalid'))"""
    q["load_pending_partitions"] = f"""{loaded}
SELECT DISTINCT dataset, partition_key, true AS ready FROM ld WHERE day(arrival_ts) > 15"""
    event_cols = 'event_id, order_id, event_type, "timestamp", customer_id, product_id, quantity, price, partition_key'
    q["load_is_idempotent"] = f"{loaded}\nSELECT dataset, {event_cols} FROM ld"
    q["load_late_file_after_promote"] = f"{loaded}\nSELECT {event_cols} FROM ld WHERE dataset = 'valid'"
    q["load_retry_after_failed_snapshot"] = q["load_late_file_after_promote"]
    q["orders_from_loads"] = f"""WITH {R},
{latest_sql("(SELECT * FROM routed WHERE route = 'valid' AND day(arrival_ts) <= 15)", 's1')},
{latest_sql("(SELECT * FROM routed WHERE route = 'valid' AND day(arrival_ts) > 15)", 's2')}
{merge_sql('s1', 's2')}"""
    for name in ("stream_validate_replay", "stream_validate_keyed", "validate_incremental", "validate_incremental_indexed",
                 "replay_from_raw", "replay_from_point"):
        q[name] = q["validate_drop_dups"]
    q["load_then_compact"] = q["load_is_idempotent"]
    q["orders_upsert_bucketed"] = q["orders_upsert_incremental"]
    q["stream_running_totals"] = q["running_totals"]
    q["sql_invalid_events_of_a_day"] = f"""WITH {R}, i AS (SELECT * FROM routed WHERE route = 'invalid')
SELECT event_id, order_id, event_type, "timestamp", strftime(arrival_ts, '%H') AS hr,
       strftime(arrival_ts, '%Y-%m/%d/%H') AS partition_key
FROM i WHERE CAST(arrival_ts AS DATE) = (SELECT max(CAST(arrival_ts AS DATE)) FROM i)"""
    text = ("event_id", "order_id", "event_type", "CAST(epoch_us(\"timestamp\") AS VARCHAR)", "{}", "product_id",
            "CAST(quantity AS VARCHAR)", "CAST(CAST(round(price * 10000) AS BIGINT) AS VARCHAR)", "CAST(arrival_seq AS VARCHAR)")

    def content(customer: str) -> str:
        told = " || ".join(f"coalesce(length({c}) || ':' || {c}, '-')" for c in (x.format(customer) for x in text))
        return f"sum(CAST(('0x' || substr(md5({told}), 1, 15)) AS BIGINT))"

    swapped = f"(CASE WHEN arrival_seq % {SWAPPED_EVERY} = 0 THEN 'C-other' ELSE customer_id END)"
    q["reconcile_content"] = f"""WITH {R},
h AS (SELECT strftime(arrival_ts, '%Y-%m/%d/%H') AS partition_key, count(*) AS raw, {hours},
             {content('customer_id')} AS a, {content(swapped)} AS b FROM routed GROUP BY 1)
SELECT partition_key, raw, valid, invalid, duplicate, quarantine, CAST(a AS VARCHAR) AS raw_fingerprint,
       CAST(b AS VARCHAR) AS out_fingerprint, true AS counts_agree, a = b AS balanced FROM h"""
    q["validate_incremental_ttl"] = q["validate_ttl"]
    q["stream_duplicate_counts"] = q["dup_counts_2s"]
    q["stream_counts"] = q["counts_tumbling_30s"]
    q["dup_running_totals"] = f"""WITH {R},
c AS (SELECT time_bucket(INTERVAL 2 SECOND, arrival_ts) AS window_start,
             time_bucket(INTERVAL 2 SECOND, arrival_ts) + INTERVAL 2 SECOND AS window_end, count(*) AS n
      FROM flagged WHERE is_dup GROUP BY 1, 2)
SELECT window_start, window_end, n, CAST(sum(n) OVER (ORDER BY window_start) AS BIGINT) AS running_n FROM c"""
    sliced = f"""sl AS (
  SELECT *, CAST(floor((epoch_us(arrival_ts) - lo) * {SLICES} / CAST(hi - lo + 1 AS DOUBLE)) AS INTEGER) AS slice
  FROM routed, (SELECT min(epoch_us(arrival_ts)) AS lo, max(epoch_us(arrival_ts)) AS hi FROM order_events))"""
    # a slice's rows are late when their window ended 5 s or more before the
    # newest event time of the slices before
    q["stream_event_time_counts"] = f"""WITH {R}, {sliced},
w AS (SELECT *, time_bucket(INTERVAL 30 SECOND, "timestamp") AS window_start FROM sl WHERE "timestamp" IS NOT NULL),
marks AS (SELECT s, (SELECT max(epoch_ms("timestamp")) FROM w WHERE slice < s) - 5000 AS mark FROM range({SLICES}) t(s))
SELECT window_start, window_start + INTERVAL 30 SECOND AS window_end, event_type, count(*) AS n
FROM w JOIN marks ON slice = s
WHERE mark IS NULL OR epoch_ms(window_start + INTERVAL 30 SECOND) > mark GROUP BY 1, 2, 3"""
    q["stream_late_events"] = f"""WITH {R}, {sliced},
w AS (SELECT *, time_bucket(INTERVAL 30 SECOND, "timestamp") AS window_start FROM sl WHERE "timestamp" IS NOT NULL),
marks AS (SELECT s, (SELECT max(epoch_ms("timestamp")) FROM w WHERE slice < s) - 5000 AS mark FROM range({SLICES}) t(s)),
told AS (SELECT *, mark IS NULL OR epoch_ms(window_start + INTERVAL 30 SECOND) > mark AS in_time FROM w JOIN marks ON slice = s)
SELECT 'counted' AS kind, window_start, event_type, count(*) AS n, CAST(NULL AS BIGINT) AS arrival_seq
FROM told WHERE in_time GROUP BY 2, 3
UNION ALL SELECT 'late', window_start, event_type, 1, arrival_seq FROM told WHERE NOT in_time
UNION ALL SELECT 'untimed', NULL, event_type, 1, arrival_seq FROM order_events WHERE "timestamp" IS NULL"""
    q["stream_orders"] = f"""WITH {R}, {sliced},
""" + ",\n".join(latest_sql(f"(SELECT * FROM sl WHERE route = 'valid' AND slice = {i})", f"s{i}").strip() for i in range(3)) + f""",
m AS ({merge_sql('s0', 's1')})
{merge_sql('m', 's2')}"""
    q["stream_raw_archive"] = f"""WITH {A}
SELECT event_id, order_id, event_type, "timestamp", customer_id, product_id, quantity, price, malformed, arrival_ts, arrival_seq,
       strftime(arrival_ts, '%Y-%m/%d/%H') AS partition_key FROM order_events"""
    q["stream_clean_source"] = q["stream_raw_archive"]
    return q
