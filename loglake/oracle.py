"""Oracle SQL (DuckDB dialect) for the registered queries.

Each statement recomputes its answer from the raw tables (``events``,
``orders``) with plain SQL: window ``row_number`` for offsets, ``arg_max`` for
latest commits, ``CASE`` for start resolution, and a brute-force enumeration
of rounds (``unnest(range(..))``) for the drain's full round -- independent
of the closed forms the engine uses.
"""

from __future__ import annotations

P = '"partition"'
O = '"offset"'

# --- fixture logs -------------------------------------------------------------------

LOG = f"""log AS (
  SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS {P},
         CAST(row_number() OVER (PARTITION BY event_type, user_id % 4 ORDER BY ts, event_id) - 1 AS BIGINT) AS {O},
         ts, event_id, CAST(user_id AS VARCHAR) AS key,
         '{{"event_id": ' || CAST(event_id AS VARCHAR) || ', "props": ' || props || '}}' AS value
  FROM events)"""

ORDERS_LOG = f"""olog AS (
  SELECT 'orders' AS topic, CAST(o_custkey % 3 AS INTEGER) AS {P},
         CAST(row_number() OVER (PARTITION BY o_custkey % 3 ORDER BY o_orderdate, o_orderkey) - 1 AS BIGINT) AS {O},
         CAST(o_custkey AS VARCHAR) AS key, CAST(o_orderkey AS VARCHAR) AS value
  FROM orders)"""

SKEW_LOG = f"""slog AS (
  SELECT topic, {P}, CAST(row_number() OVER (PARTITION BY {P} ORDER BY ts, event_id) - 1 AS BIGINT) AS {O}
  FROM (SELECT 'hot' AS topic, CAST(CASE WHEN event_id IN (1, 2, 3) THEN event_id ELSE 0 END AS INTEGER) AS {P},
               ts, event_id FROM events))"""

RETAINED = f"retained AS (SELECT * FROM log WHERE {O} >= 10)"


def water(name: str, src: str) -> str:
    return (
        f"{name} AS (SELECT topic, {P}, min({O}) AS earliest, CAST(max({O}) + 1 AS BIGINT) AS latest "
        f"FROM {src} GROUP BY topic, {P})"
    )


GAPS = f"""gaps AS (
  SELECT l.topic, l.{P}, l.{O}, l.key, l.value FROM log l JOIN water w ON l.topic = w.topic AND l.{P} = w.{P}
  WHERE l.{O} % 5 <> 0 OR l.{O} = w.latest - 1)"""

DUP = f"""dup AS (
  SELECT topic, {P}, {O}, event_id FROM log
  UNION ALL
  SELECT l.topic, l.{P}, CAST(w.latest + row_number() OVER (PARTITION BY l.topic, l.{P} ORDER BY l.{O}) - 1 AS BIGINT),
         l.event_id
  FROM log l JOIN water w ON l.topic = w.topic AND l.{P} = w.{P} WHERE l.event_id % 7 = 0)"""

RECORD = f"topic, {P}, {O}, key, value"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- offsets fixtures on the retained log ------------------------------------------


def _commit(group: str, committed: str, seq: int, where: str = "") -> str:
    return (
        f"SELECT '{group}' AS group_id, topic, {P}, CAST({committed} AS BIGINT) AS committed, "
        f"CAST({seq} AS BIGINT) AS commit_seq FROM rwater {where}"
    )


G1_COMMITTED = f"CASE WHEN {P} = 1 THEN 5 WHEN {P} = 2 THEN latest + 100 ELSE earliest + (latest - earliest) // 2 END"
OFFS_G1 = _commit("g1", G1_COMMITTED, 1, f"WHERE {P} <> 0")
OFFS_ALL = "offs AS (" + "\nUNION ALL ".join(
    [
        _commit("g0", "0", 1),
        OFFS_G1,
        _commit("gh", "earliest + 2 * ((latest - earliest) // 4)", 1),
        _commit("gh", "earliest + 3 * ((latest - earliest) // 4)", 2),
        _commit("gh", "earliest + (latest - earliest) // 4", 3),
    ]
) + ")"
COMMITTED = f"""committed AS (
  SELECT group_id, topic, {P}, arg_max(committed, commit_seq) AS committed, max(commit_seq) AS commit_seq
  FROM offs GROUP BY group_id, topic, {P})"""


def resolve(name: str, wsrc: str, regs: str, committed: str) -> str:
    """Start resolution (E1) of registrations ``regs`` (group_id, topic, max_queue)."""
    return f"""{name} AS (
  SELECT r.group_id, w.topic, w.{P}, r.max_queue, w.earliest, w.latest, c.committed AS stored,
    CASE WHEN c.committed IS NULL OR c.committed = 0 THEN w.latest
         WHEN c.committed < w.earliest THEN w.earliest
         WHEN c.committed > w.latest THEN w.latest ELSE c.committed END AS position,
    CASE WHEN c.committed IS NULL OR c.committed = 0 THEN 'missing'
         WHEN c.committed < w.earliest THEN 'below'
         WHEN c.committed > w.latest THEN 'above' ELSE 'valid' END AS status
  FROM {wsrc} w JOIN {regs} r ON r.topic = w.topic
  LEFT JOIN {committed} c ON c.group_id = r.group_id AND c.topic = w.topic AND c.{P} = w.{P})"""


def regs_all(name: str, wsrc: str, groups: list[str], max_queue: int = 5000) -> str:
    parts = [f"SELECT '{g}' AS group_id, topic, {max_queue} AS max_queue FROM (SELECT DISTINCT topic FROM {wsrc})" for g in groups]
    return f"{name} AS (" + " UNION ALL ".join(parts) + ")"


RPOS = with_(
    LOG, RETAINED, water("rwater", "retained"), OFFS_ALL, COMMITTED, regs_all("regs", "rwater", ["g0", "g1", "gh"]),
    resolve("pos", "rwater", "regs", "committed"),
)

# --- positions set directly ---------------------------------------------------------


def positions(name: str, wsrc: str, group: str, max_queue: str, position: str, topics: list[str] | None = None) -> str:
    """Positions at a given expression; ``max_queue`` is an SQL expression of topic."""
    where = "" if topics is None else "WHERE topic IN (" + ", ".join(f"'{t}'" for t in topics) + ")"
    return f"""{name} AS (
  SELECT '{group}' AS group_id, topic, {P}, CAST({max_queue} AS BIGINT) AS max_queue, earliest, latest,
         CAST(least(greatest({position}, earliest), latest) AS BIGINT) AS position
  FROM {wsrc} {where})"""


def throttle_case(throttles: dict[str, int]) -> str:
    return "CASE topic " + " ".join(f"WHEN '{t}' THEN {q}" for t, q in throttles.items()) + " END"


GROUP_THROTTLES = {"click": 100, "view": 40, "error": 2}
TAIL_POSITION = "CASE WHEN topic IN ('click', 'view') THEN greatest(0, latest - 45) ELSE 0 END"


def per_each(name: str, src: str) -> str:
    return f"""{name} AS (
  SELECT *, greatest(1, max_queue // parts) AS per_each FROM (
    SELECT *, count(*) OVER (PARTITION BY group_id, topic) AS parts,
           sum(latest - position) OVER (PARTITION BY group_id, topic) AS topic_lag FROM {src}))"""


def plan_topic(name: str, src: str) -> str:
    return f"""{name} AS (
  SELECT group_id, topic, {P}, position AS start_offset,
         CAST(CASE WHEN topic_lag > max_queue THEN least(position + per_each, latest) ELSE latest END AS BIGINT)
           AS stop_offset
  FROM {src})"""


def plan_group(name: str, src: str) -> str:
    return f"""{name} AS (
  SELECT group_id, topic, {P}, position AS start_offset,
         CAST(least(position + per_each, latest) AS BIGINT) AS stop_offset
  FROM {src} WHERE topic_lag > 0)"""


def full_round(name: str, src: str) -> str:
    """Brute force: first round k whose remaining topic lag is <= max_queue."""
    return f"""{name}_k AS (
  SELECT group_id, topic, max_queue, per_each,
         unnest(range(0, (max(latest - position) + per_each - 1) // per_each + 1)) AS k
  FROM {src} GROUP BY group_id, topic, max_queue, per_each),
{name}_rem AS (
  SELECT k.group_id, k.topic, k.k, k.max_queue,
         sum(greatest(0, p.latest - p.position - k.k * k.per_each)) AS rem
  FROM {name}_k k JOIN {src} p ON p.group_id = k.group_id AND p.topic = k.topic
  GROUP BY k.group_id, k.topic, k.k, k.max_queue),
{name} AS (SELECT group_id, topic, min(k) AS full_round FROM {name}_rem WHERE rem <= max_queue GROUP BY group_id, topic)"""


def drained(name: str, logsrc: str, pe: str, kk: str | None, extra: str = "") -> str:
    batch = f"(l.{O} - p.position) // p.per_each"
    if kk is not None:
        batch = f"least({batch}, kk.full_round)"
        join_k = f"JOIN {kk} kk ON kk.group_id = p.group_id AND kk.topic = p.topic"
    else:
        join_k = ""
    return f"""{name} AS (
  SELECT l.topic, l.{P}, l.{O}, l.key, l.value, p.group_id, CAST({batch} AS BIGINT) AS batch_no {extra}
  FROM {logsrc} l JOIN {pe} p ON p.topic = l.topic AND p.{P} = l.{P} {join_k}
  WHERE l.{O} >= p.position AND l.{O} < p.latest)"""


def range_filter(topic: str, ranges: dict[int, tuple[int, int]]) -> str:
    terms = " OR ".join(f"({P} = {p} AND {O} >= {lo} AND {O} < {hi})" for p, (lo, hi) in ranges.items())
    return f"topic = '{topic}' AND ({terms})"


RANGES = {0: (0, 30), 1: (10, 25), 3: (5, 5)}
EVT = with_(LOG, water("water", "log"))
KJSON = "CAST(json_extract_string(value, '$.props.k') AS BIGINT)"
EIDJSON = "CAST(json_extract_string(value, '$.event_id') AS BIGINT)"


def _fetch_tail() -> str:
    return with_(
        LOG, water("water", "log"), positions("pos", "water", "ft", "200", TAIL_POSITION), per_each("pe", "pos"),
        plan_topic("plan", "pe"),
    )


def _group_zero(group: str = "pg") -> str:
    return with_(
        LOG, water("water", "log"),
        positions("pos", "water", group, throttle_case(GROUP_THROTTLES), "0", list(GROUP_THROTTLES)),
        per_each("pe", "pos"), plan_group("plan", "pe"),
    )


def _fetch_join(plan: str = "plan") -> str:
    return (
        f"SELECT l.topic, l.{P}, l.{O}, l.key, l.value FROM log l JOIN {plan} p ON p.topic = l.topic AND p.{P} = l.{P} "
        f"WHERE l.{O} >= p.start_offset AND l.{O} < p.stop_offset"
    )


def _drain_topic_sql(max_queue: int = 200) -> str:
    return with_(
        LOG, water("water", "log"), positions("pos", "water", "dt", str(max_queue), "0"), per_each("pe", "pos"),
        full_round("kk", "pe"), drained("d", "log", "pe", "kk"),
    )


def _filtered_sql() -> str:
    return with_(
        LOG, water("water", "log"), positions("pos", "water", "fl", "5000", "0", ["purchase"]),
        per_each("pe", "pos"), plan_topic("plan", "pe"),
        f"fetched AS ({_fetch_join()})",
        f"filtered AS (SELECT *, {KJSON} AS k, {EIDJSON} AS event_id FROM fetched WHERE {KJSON} >= 50)",
    )


SKEW = with_(
    SKEW_LOG, water("swater", "slog"), positions("pos", "swater", "sk", "1000", "0"), per_each("pe", "pos"),
    plan_topic("pt", "pe"), plan_group("pg", "pe"), full_round("kk", "pe"),
)

ORACLE: dict[str, str] = {
    "fetch_topic": _fetch_tail() + _fetch_join(),
    "range_scan": with_(LOG) + f"SELECT {RECORD} FROM log WHERE {range_filter('click', RANGES)}",
    "range_scan_gaps": with_(LOG, water("water", "log"), GAPS)
    + f"SELECT {RECORD} FROM gaps WHERE {range_filter('click', RANGES)}",
    "decode_string": with_(LOG) + f"SELECT {RECORD} FROM log",
    "decode_json": with_(LOG)
    + f"SELECT topic, {P}, {O}, CAST(key AS BIGINT) AS user_id, {EIDJSON} AS event_id, {KJSON} AS k FROM log",
    "message_id": with_(LOG)
    + f"SELECT topic, {P}, {O}, sha256(topic || '|' || CAST({P} AS VARCHAR) || '|' || CAST({O} AS VARCHAR)) AS message_id FROM log",
    "topic_partitions": with_(LOG, ORDERS_LOG, water("ew", "log"), water("ow", "olog"))
    + "SELECT topic, count(*) AS partitions, count(DISTINCT topic) AS topics "
    "FROM (SELECT topic FROM ew UNION ALL SELECT topic FROM ow) GROUP BY ROLLUP (topic)",
    "watermarks": with_(LOG, RETAINED, ORDERS_LOG, water("rw", "retained"), water("ow", "olog"))
    + "SELECT * FROM rw UNION ALL SELECT * FROM ow",
    "committed_offsets": with_(LOG, RETAINED, water("rwater", "retained"), OFFS_ALL, COMMITTED)
    + "SELECT * FROM committed",
    "resolve_start": RPOS + f"SELECT group_id, topic, {P}, earliest, latest, position, status FROM pos",
    "lag_partition": RPOS + f"SELECT group_id, topic, {P}, position, latest, latest - position AS lag FROM pos",
    "lag_topic": RPOS
    + "SELECT group_id, topic, CAST(sum(latest - position) AS BIGINT) AS lag, count(*) AS partitions "
    "FROM pos GROUP BY group_id, topic",
    "lag_total": RPOS
    + "SELECT group_id, CAST(sum(latest - position) AS BIGINT) AS lag, count(DISTINCT topic) AS topics, "
    "count(*) AS partitions FROM pos GROUP BY group_id",
    "plan_partition": with_(LOG, water("water", "log"), positions("pos", "water", "pp", "30", "0"))
    + f"SELECT group_id, topic, {P}, position AS start_offset, CAST(CASE WHEN latest - position > max_queue "
    "THEN least(position + greatest(1, max_queue), latest) ELSE latest END AS BIGINT) AS stop_offset FROM pos",
    "plan_topic": _fetch_tail() + "SELECT * FROM plan",
    "plan_group": _group_zero() + "SELECT * FROM plan",
    "drain_topic": _drain_topic_sql() + f"SELECT topic, {P}, {O}, batch_no FROM d",
    "drain_group": with_(
        LOG, water("water", "log"),
        positions("pos", "water", "dg", throttle_case(GROUP_THROTTLES), "0", list(GROUP_THROTTLES)),
        per_each("pe", "pos"), drained("d", "log", "pe", None),
    )
    + f"SELECT topic, {P}, {O}, batch_no FROM d",
    "plan_skew": SKEW
    + f"SELECT pt.topic, pt.{P}, pt.start_offset, pt.stop_offset AS stop_topic, pg.stop_offset AS stop_group "
    f"FROM pt JOIN pg ON pg.topic = pt.topic AND pg.{P} = pt.{P}",
    "drain_skew": SKEW
    + f"""SELECT rule, {P}, count(*) AS records, max(batch_no) AS last_batch FROM (
      SELECT 'topic' AS rule, l.{P}, least((l.{O} - p.position) // p.per_each, kk.full_round) AS batch_no
      FROM slog l JOIN pe p ON p.{P} = l.{P} JOIN kk ON kk.topic = p.topic
      WHERE l.{O} >= p.position AND l.{O} < p.latest
      UNION ALL
      SELECT 'group', l.{P}, (l.{O} - p.position) // p.per_each
      FROM slog l JOIN pe p ON p.{P} = l.{P} WHERE l.{O} >= p.position AND l.{O} < p.latest AND p.topic_lag > 0)
    GROUP BY rule, {P}""",
    "fetch_partition": with_(LOG, water("water", "log"), positions("pos", "water", "fp", "30", "0"))
    + f"SELECT {RECORD} FROM log l WHERE topic = 'click' AND {P} = 2 AND {O} < 30",
    "fetch_group": _group_zero() + _fetch_join(),
    "fetch_each": _group_zero()
    + f"SELECT l.topic, l.{P}, l.{O}, l.key, l.value, l.topic AS dataset FROM log l JOIN plan p "
    f"ON p.topic = l.topic AND p.{P} = l.{P} WHERE l.{O} >= p.start_offset AND l.{O} < p.stop_offset",
    "dedup_batch": with_(LOG, water("water", "log"), DUP)
    + f"SELECT topic, {P}, {O}, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_id "
    f"ORDER BY topic, {P}, {O}) AS rn FROM dup) WHERE rn = 1",
    "repartition_batch": _fetch_tail() + _fetch_join(),
    "filter_processor": _filtered_sql() + f"SELECT {P}, {O}, event_id, k FROM filtered",
    "republish": _filtered_sql()
    + f"SELECT 'click' AS topic, f.{P}, CAST(w.latest + row_number() OVER (PARTITION BY f.{P} ORDER BY f.{O}) - 1 "
    f"AS BIGINT) AS {O}, f.key, f.value FROM filtered f JOIN water w ON w.topic = 'click' AND w.{P} = f.{P}",
    "sink_partitions": _group_zero()
    + f"SELECT topic, {P}, count(*) AS records, min({O}) AS min_offset, max({O}) AS max_offset, "
    f"CAST(sum(length(value)) AS BIGINT) AS value_bytes FROM ({_fetch_join()}) GROUP BY topic, {P}",
}

_G1_BASE = [LOG, RETAINED, water("rwater", "retained"), f"seed AS ({OFFS_G1})"]

ORACLE["commit_offsets"] = with_(
    *_G1_BASE,
    f"sc AS (SELECT group_id, topic, {P}, arg_max(committed, commit_seq) AS committed FROM seed GROUP BY ALL)",
    regs_all("regs", "rwater", ["g1"], 200),
    resolve("pos", "rwater", "regs", "sc"),
    f"e1 AS (SELECT group_id, topic, {P}, position AS committed FROM pos WHERE position <> coalesce(stored, 0))",
    per_each("pe", "pos"),
    plan_topic("plan", "pe"),
    f"c2 AS (SELECT group_id, topic, {P}, stop_offset AS committed FROM plan "
    "WHERE stop_offset > 0 AND stop_offset <> start_offset)",
    f"hist AS (SELECT group_id, topic, {P}, committed, 1 AS seq FROM seed UNION ALL "
    f"SELECT group_id, topic, {P}, committed, 2 FROM e1 UNION ALL SELECT group_id, topic, {P}, committed, 3 FROM c2)",
) + f"SELECT group_id, topic, {P}, arg_max(committed, seq) AS committed, count(*) AS commits FROM hist GROUP BY ALL"

ORACLE["seek_offsets"] = with_(
    *_G1_BASE,
    f"offs AS (SELECT * FROM seed UNION ALL SELECT 'g1', topic, {P}, CAST((earliest + latest) // 2 AS BIGINT), "
    "CAST(2 AS BIGINT) FROM rwater WHERE topic = 'click')",
    COMMITTED,
    regs_all("regs", "rwater", ["g1"]),
    resolve("pos", "rwater", "regs", "committed"),
) + f"SELECT group_id, topic, {P}, position, status FROM pos"


# --- loops and streams ---------------------------------------------------------------


def _lag0(topic: str, div: int) -> str:
    return f"greatest(1, (SELECT sum(latest - earliest) FROM water WHERE topic = '{topic}') // {div})"


def _loop_drain(group: str, topic: str, div: int) -> list[str]:
    return [
        positions("pos", "water", group, _lag0(topic, div), "0", [topic]),
        per_each("pe", "pos"), full_round("kk", "pe"), drained("d", "log", "pe", "kk"),
    ]


ORACLE["stream_single"] = with_(LOG, water("water", "log"), *_loop_drain("ss", "click", 4)) + (
    f"SELECT {RECORD}, batch_no FROM d"
)
ORACLE["stream_multi"] = with_(
    LOG, water("water", "log"),
    positions("pos", "water", "sm", f"CASE topic WHEN 'click' THEN {_lag0('click', 4)} ELSE {_lag0('view', 4)} END",
              "0", ["click", "view"]),
    per_each("pe", "pos"), drained("d", "log", "pe", None),
) + f"SELECT {RECORD}, batch_no FROM d"


def _proc(name: str, topic: str, div: int) -> str:
    return "(" + with_(LOG, water("water", "log"), *_loop_drain(name, topic, div)) + (
        f"SELECT '{name}' AS processor, topic, {P}, {O}, batch_no FROM d)"
    )


ORACLE["stream_multi_proc"] = f"SELECT * FROM {_proc('proc1', 'click', 3)} UNION ALL SELECT * FROM {_proc('proc2', 'view', 5)}"
ORACLE["gated_drain"] = with_(LOG, water("water", "log"), *_loop_drain("gd", "click", 5)) + (
    f"SELECT topic, {P}, {O}, batch_no FROM d WHERE batch_no IN (SELECT k FROM kk_rem WHERE rem >= "
    "(SELECT sum(latest - earliest) FROM water WHERE topic = 'click') // 2)"
)
ORACLE["replay_uncommitted"] = with_(LOG, water("water", "log"), *_loop_drain("ru", "click", 4)) + (
    f"SELECT topic, {P}, {O}, batch_no FROM d"
)
ORACLE["two_groups"] = with_(
    LOG, water("water", "log"),
    positions("pa", "water", "ga", "40", "0", ["click"]),
    positions("pb", "water", "gb", "120", "0", ["click"]),
    "pos AS (SELECT * FROM pa UNION ALL SELECT * FROM pb)",
    per_each("pe", "pos"), full_round("kk", "pe"),
) + (
    f"SELECT p.group_id, p.topic, p.{P}, CAST(p.position + CASE WHEN kk.full_round <= 1 THEN p.latest - p.position "
    "ELSE least(p.latest - p.position, 2 * p.per_each) END AS BIGINT) AS position "
    "FROM pe p JOIN kk ON kk.group_id = p.group_id AND kk.topic = p.topic"
)
ORACLE["stream_throttled"] = with_(LOG) + f"SELECT {RECORD} FROM log"
ORACLE["idempotent_sink"] = with_(LOG) + f"SELECT {RECORD} FROM log"
ORACLE["dedup_stream"] = with_(LOG) + f"SELECT topic, {P}, key, value, event_id FROM log"
ORACLE["stream_multi_query"] = with_(LOG) + (
    f"SELECT 'q_' || topic AS processor, {RECORD} FROM log WHERE topic IN ('click', 'view')"
)

ORACLE["plan_proportional"] = _fetch_tail() + (
    f"SELECT group_id, topic, {P}, position AS start_offset, CAST(greatest(position, CASE WHEN topic_lag > max_queue "
    "THEN least(position + greatest(1, (max_queue * (latest - position)) // topic_lag), latest) ELSE latest END) "
    "AS BIGINT) AS stop_offset FROM pe"
)
ORACLE["project_key_value"] = with_(LOG) + "SELECT key, value FROM log"

# --- results of rules, hooks and shared groups -----------------------------------------

_GATED = (
    "batch_no IN (SELECT k FROM kk_rem WHERE rem >= (SELECT sum(latest - earliest) FROM water WHERE topic = 'click') // 2)"
)
ORACLE["aggregate_batch"] = with_(LOG, water("water", "log"), *_loop_drain("gd", "click", 5)) + (
    f"SELECT topic, batch_no, key, count(*) AS n, max({O}) AS max_offset FROM d WHERE {_GATED} GROUP BY topic, batch_no, key"
)
ORACLE["foreach_partition_sink"] = _group_zero() + (
    f"SELECT topic, {P}, count(*) AS records, CAST(sum({O}) AS BIGINT) AS offset_sum FROM ({_fetch_join()}) GROUP BY topic, {P}"
)
ORACLE["fetch_two_groups_union"] = with_(
    LOG, water("water", "log"), positions("pa", "water", "ua", "100", "0", ["click"]),
    positions("pb", "water", "ub", "300", "0", ["click"]), "pos AS (SELECT * FROM pa UNION ALL SELECT * FROM pb)",
    per_each("pe", "pos"), plan_group("plan", "pe"),
) + _fetch_join()
ORACLE["default_throttle"] = with_(
    LOG, water("water", "log"), positions("pos", "water", "dd", "5000", "0", ["click", "view"]), per_each("pe", "pos"),
    plan_topic("plan", "pe"),
) + "SELECT * FROM plan"
ORACLE["duplicate_registration"] = (
    "SELECT topic, g AS second_group, g = 'g' AS refused FROM (SELECT DISTINCT event_type AS topic FROM events), "
    "(VALUES ('g'), ('h')) AS v(g)"
)
ORACLE["decode_custom"] = with_(LOG) + f"SELECT topic, {P}, {O}, 'user-' || key AS key, md5(value) AS value FROM log"
ORACLE["dedup_batch_null_ids"] = with_(
    LOG, water("water", "log"), DUP,
    f"part_ids AS (SELECT topic, {P}, {O}, CASE WHEN event_id % 5 <> 0 THEN event_id END AS event_id FROM dup)",
) + (
    f"SELECT topic, {P}, {O}, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_id "
    f"ORDER BY topic, {P}, {O}) AS rn FROM part_ids) WHERE rn = 1 OR event_id IS NULL"
)
ORACLE["stream_shared_group"] = with_(LOG, water("water", "log")) + (
    f"SELECT 'sg' AS group_id, topic, {P}, latest AS committed FROM water WHERE topic IN ('click', 'view')"
)
ORACLE["loop_new_partition"] = with_(LOG) + f"SELECT topic, {P}, {O} FROM log WHERE topic = 'click' AND {P} = 3"
ORACLE["stop_after_batch"] = with_(
    LOG, water("water", "log"), positions("pos", "water", "sb", _lag0("click", 4), "0", ["click"]), per_each("pe", "pos"),
    plan_topic("plan", "pe"),
) + f"SELECT group_id, topic, {P}, stop_offset AS committed FROM plan WHERE stop_offset > 0"
