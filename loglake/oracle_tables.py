"""Oracle SQL (DuckDB) of the queries in ``queries_tables``, from the raw tables."""

from __future__ import annotations

from loglake.oracle import (
    DUP,
    KJSON,
    LOG,
    RECORD,
    O,
    P,
    _fetch_join,
    _filtered_sql,
    _group_zero,
    _lag0,
    _loop_drain,
    full_round,
    per_each,
    positions,
    water,
    with_,
)

EVT = with_(LOG, water("water", "log"))
_MIDDLE = "(SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) // 2 FROM log)"
_AT_TIME = (
    f"first_at AS (SELECT w.topic, w.{P}, CAST(coalesce(min(l.{O}), w.latest) AS BIGINT) AS {O} FROM water w LEFT JOIN log l "
    f"ON l.topic = w.topic AND l.{P} = w.{P} AND epoch_us(l.ts) >= {_MIDDLE} GROUP BY w.topic, w.{P}, w.latest)"
)
_CUT = f"pay AS (SELECT topic, {P}, {O}, event_id, CASE WHEN event_id % 11 = 0 THEN substr(value, 1, 12) ELSE value END AS value FROM log)"

ORACLE: dict[str, str] = {
    "range_scan_many": with_(LOG)
    + f"SELECT l.topic, l.{P}, l.{O}, l.key, l.value FROM log l JOIN log r ON r.topic = l.topic AND r.{P} = l.{P} "
    f"AND r.{O} % 2 = 0 AND l.{O} >= r.{O} AND l.{O} < r.{O} + 3",
    "offsets_at_time": with_(LOG, water("water", "log"), _AT_TIME) + f"SELECT topic, {P}, {O} FROM first_at",
    "start_at_time": _filtered_sql().rstrip()
    + f", {_AT_TIME} SELECT f.{P}, f.{O}, f.event_id, f.k FROM filtered f JOIN first_at a ON a.topic = 'purchase' AND a.{P} = f.{P} AND f.{O} >= a.{O}",
    "publish_concurrent": with_(LOG, water("water", "log"))
    + f"SELECT {P}, count(*) AS messages, count(*) AS offsets, count(*) AS events, CAST(0 AS BIGINT) AS earliest, CAST(count(*) + 7 AS BIGINT) AS latest "
    f"FROM log WHERE topic IN ('click', 'purchase', 'view') AND {P} IN (SELECT {P} FROM water WHERE topic = 'click') GROUP BY {P}",
    "retention": EVT
    + f"SELECT topic, {P}, latest // 3 AS earliest, latest, latest // 3 AS first_left, latest AS end_left, latest - latest // 3 AS messages FROM water",
    "fenced_commit": with_(LOG, water("water", "log"), *_loop_drain("fc", "click", 4))
    + f"SELECT topic, {P}, latest AS committed, 'fast' AS owner, true AS slow_refused, (SELECT max(batch_no) + 1 FROM d) AS fast_batches FROM water WHERE topic = 'click'",
    "refuse_unstable": "SELECT DISTINCT event_type AS topic, event_type = 'click' AS refused, event_type <> 'click' AND false AS stored FROM events",
    "persist_released": with_(LOG, water("water", "log"), *_loop_drain("pr", "click", 4))
    + "SELECT DISTINCT batch_no, true AS persisted, true AS earlier_released, true AS released FROM d",
    "stream_exact_throttle": with_(LOG, water("water", "log"), *_loop_drain("ss", "click", 4)) + f"SELECT {RECORD}, batch_no FROM d",
    "sink_two_phase": _group_zero()
    + f"SELECT topic, {P}, count(*) AS records, min({O}) AS min_offset, max({O}) AS max_offset, CAST(sum(length(value)) AS BIGINT) AS value_bytes, "
    f"CAST(0 AS BIGINT) AS files_after_failure FROM ({_fetch_join()}) GROUP BY topic, {P}",
    "stream_committed_sink": with_(LOG) + f"SELECT {RECORD} FROM log WHERE topic IN ('click', 'view')",
    "stream_lag": with_(LOG, water("water", "log"), positions("pos", "water", "sl", _lag0("click", 4), "0", ["click"]), per_each("pe", "pos"), full_round("kk", "pe"))
    + f"SELECT group_id, topic, {P}, position, latest, latest - position AS lag FROM (SELECT p.group_id, p.topic, p.{P}, p.latest, "
    "CAST(CASE WHEN kk.full_round <= 1 THEN p.latest ELSE least(p.latest, 2 * p.per_each) END AS BIGINT) AS position "
    "FROM pe p JOIN kk ON kk.group_id = p.group_id AND kk.topic = p.topic)",
    "dedup_history": with_(
        LOG, water("water", "log"), DUP, f"ends AS (SELECT topic, {P}, max({O}) + 1 AS z FROM dup GROUP BY topic, {P})",
        f"parts AS (SELECT d.*, CAST(CASE WHEN d.{O} < z // 2 THEN 0 WHEN d.{O} < (3 * z) // 4 THEN 1 ELSE 2 END AS INTEGER) AS part FROM dup d JOIN ends e ON e.topic = d.topic AND e.{P} = d.{P})",
    )
    + f"SELECT part, topic, {P}, {O}, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY part, topic, {P}, {O}) AS rn FROM parts) WHERE rn = 1",
    "dedup_expiry": with_(
        LOG, "span AS (SELECT (max(epoch_us(ts)) - min(epoch_us(ts))) // 1000 AS ms, (min(epoch_us(ts)) + max(epoch_us(ts))) // 2 AS middle FROM log)",
        "halves AS (SELECT l.*, CASE WHEN epoch_us(ts) < middle THEN 0 ELSE 1 END AS half, epoch_us(ts) // 1000 AS at_ms, ms FROM log l, span)",
        f"s0 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY topic, {P}, {O}) AS rn FROM halves WHERE half = 0) WHERE rn = 1)",
        "alive AS (SELECT key FROM s0 WHERE at_ms + ms // 4 > (SELECT max(at_ms) FROM halves WHERE half = 0) - ms // 8)",
        f"s1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY topic, {P}, {O}) AS rn FROM halves WHERE half = 1 AND key NOT IN (SELECT key FROM alive)) WHERE rn = 1)",
    )
    + f"SELECT topic, {P}, {O}, key AS user FROM s0 UNION ALL SELECT topic, {P}, {O}, key FROM s1",
    "running_summary": with_(LOG, water("water", "log"), *_loop_drain("rs", "view", 4))
    + f"SELECT topic, count(DISTINCT batch_no) AS batches, count(*) AS n, CAST(sum({KJSON}) AS BIGINT) AS total, max({KJSON}) AS most, true AS users_near, true AS quantiles_near FROM d GROUP BY topic",
    "decode_variant": with_(LOG, _CUT) + f"SELECT topic, {P}, {O}, event_id, {KJSON} AS k, CAST(NULL AS VARCHAR) AS absent FROM pay WHERE event_id % 11 <> 0",
    "dead_letter": with_(LOG, _CUT) + f"SELECT topic, {P}, {O}, value, 'not JSON' AS reason FROM pay WHERE event_id % 11 = 0",
    "payload_schema": "SELECT DISTINCT event_type AS topic, 'OBJECT<event_id: BIGINT, props: OBJECT<k: BIGINT>>' AS payload_schema FROM events WHERE event_id % 11 <> 0",
}
