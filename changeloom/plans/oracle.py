"""The same queries as SQL for DuckDB. Expected values come straight from the table columns; no JSON is parsed here."""

from __future__ import annotations

TOPICS = "['legacy_a1.public.person', 'legacy_a2.public.person', 'legacy_b1.public.person', 'legacy_b2.public.person']"
TENANTS = "['tenant_a1', 'tenant_a2', 'tenant_b1', 'tenant_b2']"

# One row per message: what was sent, and what has to become of it.
FEED = f"""
sent AS (
  SELECT event_id, ts, user_id, event_type,
    CAST(user_id % 4 AS INTEGER) AS idx,
    event_id % 97 = 0 AS other,
    CASE WHEN event_id % 97 = 0 THEN 'other.public.person' ELSE {TOPICS}[user_id % 4 + 1] END AS topic,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE {TENANTS}[user_id % 4 + 1] END AS tenant_id,
    CAST(user_id // 4 AS INTEGER) AS id,
    event_id % 79 = 0 AS no_id,
    event_id % 71 = 0 AS long_city,
    CASE WHEN event_id % 73 <> 0 THEN event_type END AS firstname,
    'user-' || user_id AS surname,
    DATE '1970-01-01' + CAST(event_id % 20000 AS INTEGER) AS birth,
    CASE WHEN event_id % 71 = 0 THEN repeat('c', 101) ELSE 'city' || (event_id % 10) END AS city,
    CASE WHEN event_id % 5 <> 0 THEN CAST(event_id % 100 AS VARCHAR) END AS extra,
    user_id % 4 < 2 AS is_a,
    CASE event_type WHEN 'error' THEN 'DELETE' WHEN 'signup' THEN 'INSERT' WHEN 'view' THEN 'INSERT' ELSE 'UPDATE' END AS operation
  FROM events
),
feed AS (
  SELECT *,
    CASE
      WHEN event_id % 89 = 0 THEN 'NULL_VALUE: no message'
      WHEN event_id % 83 = 0 THEN 'NOT_JSON: message'
      WHEN other THEN 'UNKNOWN_TOPIC: topic'
      WHEN event_type = 'error' THEN 'DELETE_WITHOUT_ROW: after is null'
      WHEN no_id THEN 'ID_MISSING: id'
      WHEN long_city THEN 'TEXT_TOO_LONG: city'
    END AS error,
    split_part(error, ':', 1) AS reason,
    CASE WHEN error IS NULL THEN 'staged' WHEN reason IN ('NULL_VALUE', 'UNKNOWN_TOPIC') THEN 'dropped'
      ELSE 'dead_letter' END AS outcome
  FROM sent
),
staged AS (
  SELECT topic, CAST(0 AS INTEGER) AS "partition", event_id AS "offset", tenant_id, id AS source_id,
    'person' AS source_table, operation, firstname, surname, birth AS date_of_birth, city,
    CASE WHEN is_a THEN 'one' END AS data_1,
    CASE WHEN is_a THEN extra END AS data_2,
    CASE WHEN is_a THEN 'three' END AS data_3,
    CASE WHEN NOT is_a THEN 'one' END AS data_a,
    CASE WHEN NOT is_a THEN 'two' END AS data_b,
    CASE WHEN NOT is_a THEN extra END AS data_c,
    ts AS created_at, event_id // 1000 AS batch_id,
    event_id >= (SELECT count(*) // 2 FROM events) AS late
  FROM feed WHERE outcome = 'staged'
)"""

STAGING_COLUMNS = (
    'topic, "partition", "offset", tenant_id, source_id, source_table, operation, firstname, surname, date_of_birth, '
    "city, data_1, data_2, data_3, data_a, data_b, data_c, message_time, created_at"
)

# The text that was sent.
RAW = """
raw AS (
  SELECT *,
    '{' || CASE WHEN no_id THEN '' ELSE '"id":' || id || ',' END
      || '"firstname":' || coalesce('"' || firstname || '"', 'null')
      || ',"surname":"' || surname || '","date_of_birth":'
      || CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 20000 AS VARCHAR) ELSE '"' || CAST(birth AS VARCHAR) || '"' END
      || ',"city":"' || city || '"'
      || CASE WHEN is_a THEN ',"data_1":"one","data_2":' || coalesce('"' || extra || '"', 'null') || ',"data_3":"three"'
         ELSE ',"data_a":"one","data_b":"two","data_c":' || coalesce('"' || extra || '"', 'null') END
      || '}' AS after_text,
    '{"op":"' || CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' ELSE 'u' END
      || '","before":' || CASE WHEN event_type = 'error' THEN '{"id":' || id || '}' ELSE 'null' END
      || ',"after":' || CASE WHEN event_type = 'error' THEN 'null' ELSE after_text END || '}' AS payload_text,
    CASE WHEN event_id % 83 = 0 THEN 'not json' WHEN event_id % 3 = 0 THEN payload_text
      ELSE '{"payload":' || payload_text || '}' END AS raw_value
  FROM feed
)"""

PERSON_COLUMNS = (
    "tenant_id, legacy_id, firstname, surname, date_of_birth, city, extra_field, modernized_only, synced_at, "
    "created_at, updated_at"
)


def latest(name: str, where: str, source: str = "staged") -> str:
    """The latest acceptable staged row of each key, with the columns of the target."""
    return f"""
{name} AS (
  SELECT tenant_id, source_id AS legacy_id, firstname, surname, date_of_birth, city,
    coalesce(data_2, data_c) AS extra_field, created_at, operation
  FROM {source} WHERE firstname IS NOT NULL AND surname IS NOT NULL AND ({where})
  QUALIFY row_number() OVER (PARTITION BY tenant_id, source_id ORDER BY "offset" DESC) = 1
)"""


def merged(name: str, new: str, old: str | None, now: str) -> str:
    """The target after a batch: new rows replace old ones of their key, all but modernized_only."""
    carried = "o.modernized_only" if old else "CAST(NULL AS DATE)"
    join = f"LEFT JOIN {old} o ON n.tenant_id = o.tenant_id AND n.legacy_id = o.legacy_id" if old else ""
    rest = (
        f"UNION ALL SELECT {PERSON_COLUMNS} FROM {old} o WHERE NOT EXISTS (SELECT 1 FROM {new} n "
        "WHERE n.tenant_id = o.tenant_id AND n.legacy_id = o.legacy_id)"
    ) if old else ""
    return f"""
{name} AS (
  SELECT n.tenant_id, n.legacy_id, n.firstname, n.surname, n.date_of_birth, n.city, n.extra_field,
    {carried} AS modernized_only, TIMESTAMP '{now}' AS synced_at, n.created_at, TIMESTAMP '{now}' AS updated_at
  FROM {new} n {join}
  {rest}
)"""


FIRST, SECOND = "2024-02-01 00:00:00", "2024-02-02 00:00:00"


def patched(name: str, old: str) -> str:
    return f"""
{name} AS (
  SELECT * REPLACE (CASE WHEN legacy_id % 10 = 0 THEN DATE '2024-05-01' ELSE modernized_only END AS modernized_only)
  FROM {old}
)"""


ONE_BATCH = f"{FEED},{latest('l0', 'true')},{merged('person', 'l0', None, FIRST)}"
FIRST_HALF = f"{FEED},{latest('l1', 'NOT late')},{merged('p1', 'l1', None, FIRST)}"
BOTH = f"{FIRST_HALF},{patched('p1x', 'p1')},{latest('l2', 'late')},{merged('p2', 'l2', 'p1x', SECOND)}"

# In apply mode a delete is staged by the key of its before image.
DELETES = f"""{FEED},
acts AS (
  SELECT tenant_id, source_id, "offset", operation, firstname, surname, date_of_birth, city, data_2, data_c,
    created_at, late
  FROM staged WHERE firstname IS NOT NULL
  UNION ALL
  SELECT tenant_id, id, event_id, 'DELETE', NULL, NULL, NULL, NULL, NULL, NULL, ts,
    event_id >= (SELECT count(*) // 2 FROM events)
  FROM feed WHERE reason = 'DELETE_WITHOUT_ROW'
),
first_last AS (
  SELECT * FROM acts WHERE NOT late
  QUALIFY row_number() OVER (PARTITION BY tenant_id, source_id ORDER BY "offset" DESC) = 1
),
p1 AS (
  SELECT tenant_id, source_id AS legacy_id, firstname, surname, date_of_birth, city,
    coalesce(data_2, data_c) AS extra_field,
    CASE WHEN source_id % 10 = 0 THEN DATE '2024-05-01' END AS modernized_only,
    TIMESTAMP '{FIRST}' AS synced_at, created_at, TIMESTAMP '{FIRST}' AS updated_at
  FROM first_last WHERE operation <> 'DELETE'
),
second_last AS (
  SELECT *, bool_or(operation = 'DELETE') OVER (PARTITION BY tenant_id, source_id) AS had_delete
  FROM acts WHERE late
  QUALIFY row_number() OVER (PARTITION BY tenant_id, source_id ORDER BY "offset" DESC) = 1
)
SELECT s.tenant_id, s.source_id AS legacy_id, s.firstname, s.surname, s.date_of_birth, s.city,
  coalesce(s.data_2, s.data_c) AS extra_field,
  CASE WHEN NOT s.had_delete THEN p.modernized_only END AS modernized_only,
  TIMESTAMP '{SECOND}' AS synced_at, s.created_at, TIMESTAMP '{SECOND}' AS updated_at
FROM second_last s LEFT JOIN p1 p ON s.tenant_id = p.tenant_id AND s.source_id = p.legacy_id
WHERE s.operation <> 'DELETE'
UNION ALL
SELECT {PERSON_COLUMNS} FROM p1
WHERE (tenant_id, legacy_id) NOT IN (SELECT tenant_id, source_id FROM second_last)"""

LEGACY = f"""
legacy AS (
  SELECT {TENANTS}[c_custkey % 4 + 1] AS tenant_id, CAST(c_custkey // 4 AS INTEGER) AS legacy_id,
    'Customer' AS firstname, split_part(c_name, '#', 2) AS surname,
    DATE '1970-01-01' + CAST(c_custkey % 20000 AS INTEGER) AS date_of_birth, c_mktsegment AS city,
    CAST(NULL AS VARCHAR) AS data_1,
    CASE WHEN c_custkey % 4 < 2 THEN CAST(c_nationkey AS VARCHAR) END AS data_2,
    CAST(NULL AS VARCHAR) AS data_3, CAST(NULL AS VARCHAR) AS data_a, CAST(NULL AS VARCHAR) AS data_b,
    CASE WHEN c_custkey % 4 >= 2 THEN CAST(c_nationkey AS VARCHAR) END AS data_c,
    {TOPICS}[c_custkey % 4 + 1] AS topic
  FROM customer
),
backfill AS (
  SELECT tenant_id, legacy_id, firstname, surname, date_of_birth, city, coalesce(data_2, data_c) AS extra_field,
    CAST(NULL AS DATE) AS modernized_only, TIMESTAMP '{FIRST}' AS synced_at, TIMESTAMP '{FIRST}' AS created_at,
    TIMESTAMP '{FIRST}' AS updated_at
  FROM legacy
)"""


def _data(i: int, name: str) -> str:
    return (
        f"CASE (o_orderkey + {i}) % 3 WHEN 0 THEN '' WHEN 1 THEN 'd{i}-' || (o_orderkey % 1000) END AS {name}"
    )


DATA = ("data_1", "data_2", "data_3", "data_a", "data_b", "data_c")
FAMILY = {c: ("legacy_a" if c in DATA[:3] else "legacy_b") for c in DATA}
EXTRA = ("data_2", "data_c")

COMMANDS = f"""
cmd AS (
  SELECT o_orderkey AS seq,
    CASE WHEN o_orderstatus = 'O' AND o_orderkey % 13 = 0 THEN 'legacy_create' WHEN o_orderstatus = 'O' THEN 'create'
      WHEN o_orderstatus = 'P' THEN 'update' ELSE 'legacy_update' END AS kind,
    CASE WHEN o_orderkey % 61 = 0 THEN 'tenant_zz' ELSE {TENANTS}[o_custkey % 4 + 1] END AS tenant_id,
    CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE {TOPICS}[o_custkey % 4 + 1] END AS topic,
    CASE WHEN o_orderkey % 61 = 0 THEN NULL WHEN o_custkey % 4 < 2 THEN 'legacy_a' ELSE 'legacy_b' END AS legacy_type,
    CAST(CASE WHEN o_orderstatus = 'O' THEN 1000000 + o_orderkey
      WHEN o_orderkey % 37 = 0 THEN 500000 + o_custkey // 4
      WHEN o_orderkey % 43 = 0 THEN 1000000 + o_orderkey - 43
      WHEN o_orderkey % 47 = 0 THEN 1000000 + o_orderkey + 47
      ELSE o_custkey // 4 END AS INTEGER) AS legacy_id,
    o_orderpriority AS firstname,
    CASE WHEN o_orderkey % 59 <> 0 THEN 'order-' || o_orderkey END AS surname,
    CAST(o_orderdate AS DATE) AS date_of_birth,
    CASE WHEN o_orderkey % 6 <> 0 THEN 'city' || (o_orderkey % 10) END AS city,
    o_orderkey % 11 = 0 AS absent,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN '' ELSE o_orderpriority END AS extra_field,
    CASE WHEN o_orderkey % 9 = 0 THEN CAST(o_orderdate AS DATE) END AS modernized_only,
    {", ".join(_data(i, c) for i, c in enumerate(DATA))},
    o_orderdate AS written_at
  FROM orders
),
valid AS (
  SELECT *,
    CASE WHEN kind = 'create' AND (tenant_id = '' OR firstname = '' OR surname IS NULL)
           THEN 'tenant_id, firstname, and surname are required'
         WHEN kind = 'update' AND legacy_id = 0 THEN 'tenant_id and legacy_id are required'
         WHEN tenant_id = 'tenant_zz' THEN 'unknown tenant tenant_zz' END AS refused
  FROM cmd
)"""


def _created(name: str) -> str:
    own = f"CASE WHEN legacy_type = '{FAMILY[name]}' AND {name} <> '' THEN {name} END"
    mapped = f"CASE WHEN legacy_type = '{FAMILY[name]}' AND extra_field <> '' THEN extra_field END"
    if name not in EXTRA:
        mapped = "NULL"
    return f"CASE WHEN kind = 'create' THEN {mapped} ELSE {own} END AS {name}"


CREATED = f"""
created AS (
  SELECT seq, topic, tenant_id, legacy_type, legacy_id, firstname, surname, date_of_birth, city,
    {", ".join(_created(c) for c in DATA)}
  FROM valid WHERE refused IS NULL AND kind IN ('create', 'legacy_create')
)"""


def _sets(name: str) -> str:
    by_legacy = f"v.kind = 'legacy_update' AND v.legacy_type = '{FAMILY[name]}' AND v.{name} <> ''"
    legacy = f"WHEN {by_legacy} THEN struct_pack(v := v.{name})"
    update = ""
    if name in EXTRA:
        update = (
            f"WHEN v.kind = 'update' AND v.legacy_type = '{FAMILY[name]}' "
            "THEN struct_pack(v := CASE WHEN v.absent THEN '' ELSE v.extra_field END)"
        )
    return f"CASE {legacy} {update} END AS s_{name}"


def updates(kinds: str) -> str:
    """The updates that hit a row, what they set, and the row as it stood after each."""
    running = ", ".join(
        f"last_value(s_{c} IGNORE NULLS) OVER w AS r_{c}" for c in DATA
    )
    return f"""
base AS (
  SELECT tenant_id, legacy_id, firstname, surname, date_of_birth, city, {", ".join(DATA)}, CAST(-1 AS BIGINT) AS since
  FROM legacy
  UNION ALL
  SELECT tenant_id, legacy_id, firstname, surname, date_of_birth, city, {", ".join(DATA)}, seq
  FROM created WHERE {kinds.count('create')} > 0
),
hits AS (
  SELECT v.*, {", ".join(_sets(c) for c in DATA)}
  FROM valid v JOIN base b ON v.tenant_id = b.tenant_id AND v.legacy_id = b.legacy_id AND v.seq > b.since
  WHERE v.refused IS NULL AND v.kind IN ({kinds}) AND v.kind IN ('update', 'legacy_update')
),
running AS (
  SELECT h.seq, h.topic, h.tenant_id, h.legacy_id, h.firstname, h.surname, h.date_of_birth, h.city, {running}
  FROM hits h WINDOW w AS (PARTITION BY tenant_id, legacy_id ORDER BY seq ROWS UNBOUNDED PRECEDING)
),
images AS (
  SELECT r.seq, r.topic, r.tenant_id, r.legacy_id, r.firstname, r.surname, r.date_of_birth, r.city,
    {", ".join(f"CASE WHEN r_{c} IS NOT NULL THEN r_{c}.v ELSE b.{c} END AS {c}" for c in DATA)}
  FROM running r JOIN base b ON r.tenant_id = b.tenant_id AND r.legacy_id = b.legacy_id
),
final AS (
  SELECT * FROM images QUALIFY row_number() OVER (PARTITION BY tenant_id, legacy_id ORDER BY seq DESC) = 1
),
applied AS (
  SELECT b.tenant_id, b.legacy_id,
    {", ".join(f"CASE WHEN f.seq IS NULL THEN b.{c} ELSE f.{c} END AS {c}"
               for c in ("firstname", "surname", "date_of_birth", "city", *DATA))}
  FROM base b LEFT JOIN final f ON b.tenant_id = f.tenant_id AND b.legacy_id = f.legacy_id
)"""


APPLIED_COLUMNS = f"tenant_id, legacy_id, firstname, surname, date_of_birth, city, {', '.join(DATA)}"
ALL_KINDS = "'create', 'legacy_create', 'update', 'legacy_update'"
COMMAND_BASE = f"{LEGACY},{COMMANDS},{CREATED}"
ALL_APPLIED = f"{COMMAND_BASE},{updates(ALL_KINDS)}"

COMMAND_STAGED = f"""{ALL_APPLIED},
cstaged AS (
  SELECT topic, CAST(0 AS INTEGER) AS "partition", seq AS "offset", tenant_id, legacy_id AS source_id,
    'INSERT' AS operation, firstname, surname, date_of_birth, city, {", ".join(DATA)},
    TIMESTAMP '{FIRST}' AS created_at
  FROM created
  UNION ALL
  SELECT topic, 0, seq, tenant_id, legacy_id, 'UPDATE', firstname, surname, date_of_birth, city, {", ".join(DATA)},
    TIMESTAMP '{FIRST}'
  FROM images
)"""

RESOLVED = f"""{ALL_APPLIED},
resolved AS (
  SELECT v.*,
    CASE WHEN refused IS NOT NULL THEN 'rejected' WHEN kind IN ('create', 'legacy_create') THEN 'applied'
      WHEN i.seq IS NOT NULL THEN 'applied' WHEN kind = 'update' THEN 'no_row' ELSE 'rejected' END AS status,
    CASE WHEN refused IS NOT NULL THEN refused
      WHEN kind = 'legacy_update' AND i.seq IS NULL THEN 'record not found' ELSE '' END AS reason
  FROM valid v LEFT JOIN images i ON v.seq = i.seq
)"""

FAULTY = """
faulty AS (
  SELECT * REPLACE (
    CASE WHEN legacy_id % 101 = 1 THEN 'tenant_bad' WHEN legacy_id % 101 = 2 THEN NULL ELSE tenant_id END AS tenant_id,
    CASE WHEN legacy_id % 103 = 3 THEN NULL ELSE firstname END AS firstname)
  FROM backfill WHERE legacy_id % 7 <> 6
  UNION ALL SELECT * FROM backfill WHERE legacy_id % 107 = 5
)"""


def column_failures(table: str) -> str:
    names = [f"not_null_{c}" for c in ("tenant_id", "legacy_id", "firstname", "surname")]
    parts = [
        f"SELECT '{n}' AS check_name, count(*) FILTER (WHERE {n[9:]} IS NULL) AS failures FROM {table}" for n in names
    ]
    parts.append(
        f"SELECT 'accepted_values_tenant_id', count(*) FILTER (WHERE NOT list_contains({TENANTS}, tenant_id)) FROM {table}"
    )
    return " UNION ALL ".join(parts)


def key_failures(table: str) -> str:
    return (
        f"SELECT 'unique_key', count(*) FROM (SELECT 1 FROM {table} GROUP BY tenant_id, legacy_id HAVING count(*) > 1) "
        f"UNION ALL SELECT 'tenants_stay_separate', count(*) FROM (SELECT 1 FROM {table} GROUP BY legacy_id "
        "HAVING count(*) <> count(DISTINCT tenant_id) + max(CASE WHEN tenant_id IS NULL THEN 1 ELSE 0 END))"
    )


ARRIVED = (
    "SELECT 'every_key_arrived', count(*) FROM legacy l WHERE NOT EXISTS "
    "(SELECT 1 FROM {table} p WHERE p.tenant_id = l.tenant_id AND p.legacy_id = l.legacy_id)"
)
STATUS = "CASE WHEN failures IS NULL THEN 'skipped' WHEN failures > 0 THEN 'failed' ELSE 'passed' END"

SNAPSHOT = "tenant_id, legacy_id, firstname, surname, extra_field"


def diff(before: str, after: str) -> str:
    return f"""
diff AS (
  SELECT {SNAPSHOT}, CASE WHEN sum(n) < 0 THEN 'missing' ELSE 'extra' END AS side,
    CAST(abs(sum(n)) AS BIGINT) AS copies
  FROM (SELECT {SNAPSHOT}, -1 AS n FROM {before} UNION ALL SELECT {SNAPSHOT}, 1 FROM {after})
  WHERE surname IS NULL OR surname NOT LIKE '%-canary'
  GROUP BY ALL HAVING sum(n) <> 0
)"""


LOG = f"""
log AS (
  SELECT event_id AS id, ts, CASE WHEN event_type = 'purchase' THEN 'api' ELSE 'cdc-consumer' END AS source,
    event_type AS stage,
    CASE event_type WHEN 'error' THEN 'error' WHEN 'click' THEN 'warn' ELSE 'info' END AS severity,
    {TENANTS}[user_id % 4 + 1] AS tenant_id, CAST(user_id // 4 AS INTEGER) AS legacy_id,
    event_type || ' by user ' || user_id AS message, props AS detail
  FROM events
)"""

POLLS = """
polls AS (
  SELECT CAST(user_id % 4 AS INTEGER) AS cluster_id, event_id AS poll_seq, event_id % 67 <> 0 AS reachable,
    CAST(user_id AS VARCHAR) AS name,
    CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'click' THEN 'PAUSED' ELSE 'RUNNING' END AS state,
    CASE WHEN event_id % 5 = 0 THEN 0 ELSE 1 END AS tasks
  FROM events
)"""

STATE_CHANGES = f"""WITH {POLLS},
named AS (
  SELECT *, coalesce(lag(state) OVER (PARTITION BY cluster_id, name ORDER BY poll_seq),
    CASE WHEN state = 'RUNNING' THEN 'RUNNING' END) AS old
  FROM polls WHERE reachable
),
lost AS (
  SELECT *, lag(reachable) OVER (PARTITION BY cluster_id ORDER BY poll_seq) AS was FROM polls
),
changes AS (
  SELECT cluster_id, poll_seq, name, old AS from_state, state AS to_state FROM named WHERE state IS DISTINCT FROM old
  UNION ALL
  SELECT cluster_id, poll_seq, 'debezium', NULL, 'UNREACHABLE' FROM lost WHERE NOT reachable AND coalesce(was, true)
)
SELECT *, CASE WHEN to_state = 'RUNNING' THEN 'info' WHEN to_state IN ('FAILED', 'UNREACHABLE') THEN 'error'
    ELSE 'warn' END AS severity,
  name || ': ' || coalesce(from_state, 'unknown') || ' -> ' || to_state AS message
FROM changes"""

READY = f"""{POLLS},
readiness AS (
  SELECT cluster_id, name, state, CAST(tasks AS INTEGER) AS tasks, state = 'RUNNING' AND tasks > 0 AS ready
  FROM polls WHERE reachable
  QUALIFY row_number() OVER (PARTITION BY cluster_id, name ORDER BY poll_seq DESC) = 1
)"""


WHERE_TEXT = (
    "'{\"operation\":\"' || operation || '\",\"topic\":\"' || topic || '\",\"partition\":0,\"offset\":' || event_id || '}'"
)

EVENTS = f"""WITH {FEED},{RAW},
record AS (
  SELECT *, tenant_id || ' person#'
    || CASE WHEN no_id OR event_type = 'error' THEN 'None' ELSE CAST(id AS VARCHAR) END || ' ' || operation AS who,
    CASE WHEN no_id OR event_type = 'error' THEN NULL ELSE id END AS known_id
  FROM raw
)
SELECT event_id AS position, 2 AS step, ts, 'cdc-consumer' AS source, 'consumer.received' AS stage,
  'info' AS severity, tenant_id, known_id AS legacy_id,
  who || ' change captured from legacy via Kafka (' || topic || ')' AS message, {WHERE_TEXT} AS detail
FROM record WHERE outcome = 'staged' OR reason IN ('DELETE_WITHOUT_ROW', 'ID_MISSING', 'TEXT_TOO_LONG')
UNION ALL
SELECT event_id, 4, ts, 'cdc-consumer', 'consumer.staged', 'info', tenant_id, known_id,
  who || ' staged in new system (person_staging)', {WHERE_TEXT}
FROM record WHERE outcome = 'staged'
UNION ALL
SELECT event_id, 5, ts, 'cdc-consumer', 'consumer.dead_letter',
  'error', tenant_id, NULL, 'dead-lettered ' || topic || '@' || event_id || ': ' || error,
  '{{"topic":"' || topic || '","partition":0,"offset":' || event_id || ',"error":"' || error
    || '","raw_value":"' || replace(raw_value, '"', '\\"') || '"}}'
FROM record WHERE outcome = 'dead_letter'"""

# Events in the order of arrival: by message, and the events of a message by step.
OWN_LOG = f"""SELECT row_number() OVER (ORDER BY position, step) AS id, * EXCLUDE (step) FROM ({EVENTS})"""

COMMAND_EVENTS = f"""{RESOLVED},
spoken AS (
  SELECT *, list_position({TOPICS}, topic) AS tidx,
    kind IN ('create', 'legacy_create') AS creates, status <> 'rejected' AS done
  FROM resolved
),
api AS (
  SELECT seq AS position, 0 AS step, written_at AS ts, 'api' AS source, 'api' AS stage,
    CASE WHEN done THEN 'info' ELSE 'warn' END AS severity,
    CASE WHEN tenant_id <> 'tenant_zz' OR reason NOT LIKE 'unknown%' THEN tenant_id END AS tenant_id,
    CASE WHEN done THEN legacy_id END AS legacy_id,
    CASE WHEN done THEN tenant_id || ' person#' || legacy_id || CASE WHEN creates THEN ' INSERT' ELSE ' UPDATE' END
        || ' written to legacy DB (postgres-' || replace(split_part(topic, '.', 1), '_', '-') || ')'
      ELSE CASE WHEN creates THEN 'POST' ELSE 'PUT' END || ' /api/persons rejected: ' || reason END AS message
  FROM spoken WHERE done OR kind IN ('create', 'update')
  UNION ALL
  SELECT seq, 1, written_at, 'api', 'api', 'info', tenant_id, legacy_id,
    tenant_id || ' person#' || legacy_id || ' modernized_only written to new system (person table)'
  FROM spoken WHERE done AND kind = 'update' AND modernized_only IS NOT NULL
)"""

JOURNEY = f"""WITH {COMMAND_EVENTS},
writes AS (
  SELECT tenant_id, legacy_id, seq FROM created UNION ALL SELECT tenant_id, legacy_id, seq FROM images
),
batches AS (SELECT DISTINCT seq // 1000 AS batch_id FROM resolved WHERE status = 'applied'),
arrived AS (
  SELECT position, step, 'api' AS stage, tenant_id, legacy_id, position // 1000 AS batch_id,
    position // 1000 * 8 + 2 + CASE WHEN position // 1000 % 5 = 4 THEN 2 ELSE 0 END AS turn FROM api
  UNION ALL SELECT seq, 2, 'received', tenant_id, legacy_id, seq // 1000, seq // 1000 * 8 + 3 FROM writes
  UNION ALL SELECT seq, 4, 'staged', tenant_id, legacy_id, seq // 1000, seq // 1000 * 8 + 3 FROM writes
  UNION ALL SELECT 0, 6, 'merge', NULL, NULL, batch_id,
    batch_id * 8 + 2 + CASE WHEN batch_id % 7 = 6 THEN -1 ELSE 3 END
  FROM batches WHERE batch_id <= (SELECT max(batch_id) // 2 FROM batches)
),
log AS (SELECT *, row_number() OVER (ORDER BY turn, position, step) AS id FROM arrived),
firsts AS (
  SELECT tenant_id, legacy_id, min(id) FILTER (stage = 'api') AS api, min(id) FILTER (stage = 'received') AS received,
    min(id) FILTER (stage = 'staged') AS staged, arg_min(batch_id, id) FILTER (stage = 'staged') AS batch_id
  FROM log WHERE legacy_id IS NOT NULL GROUP BY ALL
)
SELECT tenant_id, legacy_id, api, received, staged, coalesce(api < received AND received < staged, false) AS in_order,
  m.id AS merged, coalesce(m.id > staged, false) AS merge_followed
FROM firsts f LEFT JOIN (SELECT batch_id, id FROM log WHERE stage = 'merge') m USING (batch_id)"""

TOP_FIVE = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY tenant_id, source_id, "offset") AS rn FROM staged
),
summed AS (
  SELECT batch_id, count(*) AS "rows",
    string_agg(tenant_id || ' person#' || source_id, ', ' ORDER BY rn) FILTER (WHERE rn <= 5)
      || CASE WHEN count(*) > 5 THEN ', +' || (count(*) - 5) || ' more' ELSE '' END AS shown
  FROM ranked GROUP BY batch_id
)"""

LAG = f"""WITH {BOTH},{latest('lw', 'true')},
lags AS (
  SELECT p.tenant_id, CAST(date_diff('microsecond', w.created_at, p.synced_at) // 1000 AS BIGINT) AS lag_ms
  FROM lw w JOIN p2 p ON w.tenant_id = p.tenant_id AND w.legacy_id = p.legacy_id
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY tenant_id ORDER BY lag_ms) AS rn,
    count(*) OVER (PARTITION BY tenant_id) AS n FROM lags
)
SELECT tenant_id, percentile, lag_ms FROM ranked
JOIN (VALUES ('p50', 50), ('p95', 95), ('max', 100)) AS w(percentile, pct) ON rn = greatest(1, (n * pct + 99) // 100)"""

PROGRESS = f"""WITH {FEED},
        done AS (SELECT topic, max(event_id) AS handled FROM feed
          WHERE event_id < (SELECT count(*) // 2 FROM events) GROUP BY ALL)
        SELECT topic, CAST(0 AS INTEGER) AS "partition", max(event_id) AS newest, any_value(handled) AS handled,
          max(event_id) - coalesce(any_value(handled), -1) AS lag
        FROM feed LEFT JOIN done USING (topic) GROUP BY topic"""

RECONCILED = f"""WITH {LEGACY},
        target AS (
          SELECT * REPLACE (CASE WHEN legacy_id % 19 = 0 THEN NULL ELSE city END AS city,
            CASE WHEN legacy_id % 13 = 0 THEN 'x' ELSE extra_field END AS extra_field)
          FROM backfill WHERE legacy_id % 17 <> 0)
        SELECT l.tenant_id, l.legacy_id,
          CASE WHEN t.legacy_id IS NULL THEN 'missing'
            WHEN l.city IS DISTINCT FROM t.city OR coalesce(l.data_2, l.data_c) IS DISTINCT FROM t.extra_field
            THEN 'different' ELSE 'equal' END AS status,
          CASE WHEN t.legacy_id IS NOT NULL THEN nullif(concat_ws(',',
            CASE WHEN l.city IS DISTINCT FROM t.city THEN 'city' END,
            CASE WHEN coalesce(l.data_2, l.data_c) IS DISTINCT FROM t.extra_field THEN 'extra_field' END), '')
            END AS differences
        FROM legacy l LEFT JOIN target t ON l.tenant_id = t.tenant_id AND l.legacy_id = t.legacy_id
        UNION ALL
        SELECT tenant_id, legacy_id + 10000000, 'extra', NULL FROM backfill WHERE legacy_id % 23 = 0"""

ORACLE: dict[str, str] = {
    "decode_changes": f"""WITH {FEED} SELECT {STAGING_COLUMNS}
        FROM (SELECT * EXCLUDE created_at, created_at AS message_time, TIMESTAMP '{FIRST}' AS created_at FROM staged)""",
    "dead_letters": f"""WITH {FEED},{RAW} SELECT topic, CAST(0 AS INTEGER) AS "partition", event_id AS "offset",
        tenant_id, raw_value, reason, error, ts AS created_at FROM raw WHERE outcome = 'dead_letter'""",
    "dropped_messages": f"""WITH {FEED} SELECT topic, CAST(0 AS INTEGER) AS "partition", event_id AS "offset", reason
        FROM feed WHERE outcome = 'dropped'""",
    "outcome_counts": f"""WITH {FEED} SELECT outcome, coalesce(reason, '') AS reason, count(*) AS messages
        FROM feed GROUP BY ALL""",
    "deleted_ids": f"""WITH {FEED} SELECT topic, CAST(0 AS INTEGER) AS "partition", event_id AS "offset", tenant_id,
        id AS deleted_id FROM feed WHERE reason = 'DELETE_WITHOUT_ROW'""",
    "backfill_snapshot": f"""WITH {LEGACY} SELECT topic, CAST(-1 AS INTEGER) AS "partition",
        CAST(legacy_id AS BIGINT) AS "offset", tenant_id, legacy_id AS source_id, 'person' AS source_table,
        'INSERT' AS operation, firstname, surname, date_of_birth, city, {", ".join(DATA)},
        TIMESTAMP '{FIRST}' AS message_time, TIMESTAMP '{FIRST}' AS created_at FROM legacy""",
    # the chunk is newer than the first quarter of the feed; keys with events after that are left to the feed
    "snapshot_cutover": f"""WITH {FIRST_HALF},{LEGACY},
        chunk AS (SELECT * FROM backfill b WHERE NOT EXISTS (SELECT 1 FROM staged s WHERE s.tenant_id = b.tenant_id
          AND s.source_id = b.legacy_id AND NOT s.late AND s."offset" > (SELECT count(*) // 4 FROM events))),
        {merged('pc', 'chunk', 'p1', FIRST)},{latest('l2', 'late')},{merged('p2', 'l2', 'pc', SECOND)} SELECT * FROM p2""",
    "snapshot_and_log": f"""WITH {ONE_BATCH},{LEGACY} SELECT * FROM person UNION ALL BY NAME SELECT * FROM backfill b
        WHERE NOT EXISTS (SELECT 1 FROM person p WHERE p.tenant_id = b.tenant_id AND p.legacy_id = b.legacy_id)""",
    "merge_first": f"WITH {ONE_BATCH} SELECT * FROM person",
    "merge_incremental": f"WITH {BOTH} SELECT * FROM p2",
    "merge_apply_deletes": f"WITH {DELETES}",
    "merge_unapplied": f"""WITH {FEED},{latest('lu', 'batch_id > 4')},{merged('person', 'lu', None, FIRST)}
        SELECT * FROM person""",
    "merge_quarantine": f"""WITH {FEED} SELECT topic, "partition", "offset", tenant_id, 'TARGET_NOT_NULL' AS reason,
        'TARGET_NOT_NULL: firstname' AS error, created_at FROM staged WHERE firstname IS NULL""",
    "preserve_join": f"""WITH {FIRST_HALF},{patched('p1x', 'p1')},{latest('l2', 'late')}
        SELECT l2.tenant_id, l2.legacy_id, l2.firstname, l2.extra_field, p.modernized_only
        FROM l2 LEFT JOIN p1x p ON l2.tenant_id = p.tenant_id AND l2.legacy_id = p.legacy_id""",
    "merge_survivors": f"""WITH {ONE_BATCH} SELECT tenant_id, legacy_id, firstname, created_at FROM person
        WHERE (tenant_id, legacy_id) NOT IN (SELECT tenant_id, source_id FROM staged WHERE firstname IS NULL)""",
    "affected_keys": f"WITH {FEED} SELECT batch_id, tenant_id, source_id AS legacy_id FROM staged",
    "evolve_schema": f"""WITH {FIRST_HALF},{latest('l2', 'late')},{merged('p2', 'l2', 'p1', SECOND)}
        SELECT p2.*, upper(l2.firstname) AS nickname
        FROM p2 LEFT JOIN l2 ON p2.tenant_id = l2.tenant_id AND p2.legacy_id = l2.legacy_id""",
    "latest_window": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1""",
    "replay_diff": f"""WITH {ONE_BATCH} SELECT (SELECT count(*) FROM person) AS rows_before,
        (SELECT count(*) FROM person)
          + (SELECT count(*) FROM staged WHERE firstname = 'purchase') AS rows_after,
        CAST(0 AS BIGINT) AS differences""",
    "replay_dedup": f"WITH {FEED} SELECT tenant_id, count(*) AS staged FROM staged GROUP BY ALL",
    "snapshot_diff": f"WITH {BOTH},{diff('p1', 'p2')} SELECT * FROM diff",
    "snapshot_diff_digests": f"WITH {BOTH},{diff('p1', 'p2')} SELECT * FROM diff",
    "tenant_counts": f"WITH {ONE_BATCH} SELECT tenant_id, count(*) AS persons FROM person GROUP BY ALL",
    "layer_counts": f"""WITH {ONE_BATCH}
        SELECT 'legacy' AS layer, count(*) AS records FROM customer
        UNION ALL SELECT 'staging', count(*) FROM staged
        UNION ALL SELECT 'dead_letter', count(*) FROM feed WHERE outcome = 'dead_letter'
        UNION ALL SELECT 'person', count(*) FROM person""",
    "prefix_counts": f"""WITH {ONE_BATCH} SELECT prefix, (SELECT count(*) FROM person
        WHERE starts_with(firstname, prefix)) AS matches FROM (VALUES ('s'), ('v'), ('purch'), ('zz')) AS t(prefix)""",
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
        GROUP BY ALL HAVING count(*) > 1""",
    "staging_backlog": f"""WITH {FEED} SELECT count(*) AS total, count(*) FILTER (WHERE batch_id > 4) AS pending
        FROM staged""",
    "missing_keys": f"""WITH {ONE_BATCH},{LEGACY} SELECT tenant_id, legacy_id FROM legacy
        WHERE (tenant_id, legacy_id) NOT IN (SELECT tenant_id, legacy_id FROM person)""",
    "reconcile": RECONCILED,
    "reconcile_digests": f"SELECT * FROM ({RECONCILED}) WHERE status <> 'equal'",
    "quality_report": f"""WITH {LEGACY},{FAULTY},{diff('backfill', 'faulty')},
        results AS ({column_failures('faulty')} UNION ALL {key_failures('faulty')}
          UNION ALL {ARRIVED.format(table='faulty')}
          UNION ALL SELECT 'replay_changes_nothing', CAST(coalesce(sum(copies), 0) AS BIGINT) FROM diff)
        SELECT check_name, failures, {STATUS} AS status FROM results""",
    "check_summary": f"""WITH {LEGACY},{FAULTY},
        results AS ({column_failures('backfill')} UNION ALL {key_failures('backfill')}
          UNION ALL {column_failures('faulty')} UNION ALL {key_failures('faulty')}
          UNION ALL SELECT 'every_key_arrived', NULL)
        SELECT {STATUS} AS status, count(*) AS checks FROM results GROUP BY ALL""",
    "shared_ids": f"""WITH {ONE_BATCH} SELECT legacy_id, count(DISTINCT tenant_id) AS tenants, count(*) AS persons
        FROM person GROUP BY legacy_id HAVING count(DISTINCT tenant_id) > 1""",
    "commands_validate": f"""WITH {COMMANDS} SELECT seq, kind,
        CASE WHEN refused IS NULL THEN 'accepted' ELSE 'rejected' END AS status, coalesce(refused, '') AS reason
        FROM valid""",
    "commands_resolve": f"WITH {RESOLVED} SELECT seq, kind, status, reason FROM resolved",
    "commands_create": f"""WITH {COMMANDS},{CREATED} SELECT * FROM created
        WHERE seq IN (SELECT seq FROM cmd WHERE kind = 'create')""",
    "commands_legacy_create": f"""WITH {COMMANDS},{CREATED} SELECT * FROM created
        WHERE seq IN (SELECT seq FROM cmd WHERE kind = 'legacy_create')""",
    "commands_update": f"""WITH {COMMAND_BASE},{updates("'update'")} SELECT {APPLIED_COLUMNS} FROM applied""",
    "commands_legacy_patch": f"""WITH {COMMAND_BASE},{updates("'legacy_update'")}
        SELECT {APPLIED_COLUMNS} FROM applied""",
    "commands_apply": f"WITH {ALL_APPLIED} SELECT {APPLIED_COLUMNS} FROM applied",
    "patch_target_only": f"""WITH {LEGACY},{COMMANDS},
        patches AS (SELECT * FROM valid WHERE refused IS NULL AND kind = 'update' AND modernized_only IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY tenant_id, legacy_id ORDER BY seq DESC) = 1)
        SELECT b.* REPLACE (coalesce(p.modernized_only, b.modernized_only) AS modernized_only)
        FROM backfill b LEFT JOIN patches p ON b.tenant_id = p.tenant_id AND b.legacy_id = p.legacy_id""",
    "command_changes": f"""WITH {COMMAND_STAGED} SELECT topic, "partition", "offset", tenant_id, source_id, operation,
        firstname, surname, date_of_birth, city, {", ".join(DATA)} FROM cstaged""",
    "command_roundtrip": f"""WITH {COMMAND_STAGED},{latest('lc', 'true', 'cstaged')},
        {merged('p2', 'lc', 'backfill', SECOND)} SELECT * FROM p2""",
    "tenant_isolation": f"""WITH {COMMAND_BASE},{updates("'update'")}
        SELECT a.tenant_id, count(*) AS persons, count(*) FILTER (WHERE a.tenant_id = 'tenant_a1' AND (
          {" OR ".join(f"a.{c} IS DISTINCT FROM l.{c}"
                       for c in ("firstname", "surname", "date_of_birth", "city", *DATA))})) AS changed
        FROM applied a JOIN legacy l ON a.tenant_id = l.tenant_id AND a.legacy_id = l.legacy_id GROUP BY ALL""",
    "tenant_list": f"WITH {FEED} SELECT tenant_id, count(*) AS messages FROM feed WHERE NOT other GROUP BY ALL",
    "person_list": f"WITH {BOTH} SELECT * FROM p2 ORDER BY synced_at DESC NULLS FIRST, tenant_id, legacy_id",
    "legacy_list": f"""WITH {LEGACY} SELECT {APPLIED_COLUMNS} FROM legacy WHERE tenant_id = 'tenant_b1'
        ORDER BY legacy_id DESC""",
    "legacy_lookup": f"""WITH {LEGACY},
        asked AS (SELECT o_orderkey AS request, {TENANTS}[o_custkey % 4 + 1] AS tenant_id,
          CAST(o_custkey // 4 + CASE WHEN o_orderkey % 10 = 0 THEN 1000000 ELSE 0 END AS INTEGER) AS legacy_id
          FROM orders)
        SELECT a.request, a.tenant_id, a.legacy_id, l.legacy_id IS NOT NULL AS found, l.surname, l.city
        FROM asked a LEFT JOIN legacy l ON a.tenant_id = l.tenant_id AND a.legacy_id = l.legacy_id""",
    "existing_keys": f"""WITH {ONE_BATCH},{LEGACY} SELECT tenant_id, legacy_id FROM legacy
        WHERE (tenant_id, legacy_id) IN (SELECT tenant_id, legacy_id FROM person)""",
    "person_find": f"""WITH {ONE_BATCH} SELECT tenant_id, legacy_id, firstname, surname, extra_field FROM person
        WHERE tenant_id = 'tenant_a2' AND firstname LIKE 'p%'""",
    "latest_staged": f"""WITH {FEED} SELECT tenant_id, source_id, firstname, surname, {", ".join(DATA)}, created_at
        FROM staged ORDER BY created_at DESC NULLS FIRST, topic, "offset" LIMIT 5""",
    "latest_synced": f"""WITH {BOTH} SELECT tenant_id, legacy_id, firstname, surname, extra_field, synced_at FROM p2
        ORDER BY synced_at DESC NULLS FIRST, tenant_id, legacy_id LIMIT 5""",
    "event_feed_first": f"WITH {LOG} SELECT * FROM log WHERE id > 0 ORDER BY id DESC LIMIT 200",
    "event_feed_since": f"""WITH {LOG} SELECT * FROM log WHERE id > 1000 AND severity IN ('warn', 'error')
        AND tenant_id = 'tenant_b1' ORDER BY id LIMIT 100""",
    "event_feed_own": f"""WITH log AS ({OWN_LOG}) SELECT * EXCLUDE position FROM log
        WHERE position >= (SELECT count(*) // 2 FROM events) ORDER BY id LIMIT 300""",
    "event_search": f"""WITH {LOG} SELECT * FROM log WHERE contains(lower(message), 'user 1')
        AND severity IN ('error', 'info') AND tenant_id = 'tenant_a2' ORDER BY id DESC""",
    "system_status": f"""WITH {FEED},{LOG} SELECT
        (SELECT count(*) FROM staged WHERE batch_id > 4) AS staging_backlog,
        (SELECT count(*) FROM feed WHERE outcome = 'dead_letter') AS dead_letters,
        (SELECT max(ts) FROM log WHERE source = 'cdc-consumer') AS last_consumer_activity,
        (SELECT count(*) FROM log WHERE severity = 'error') AS errors,
        (SELECT count(*) FROM log WHERE ts > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 1 MINUTE) AS events_last_minute""",
    "status_by_parts": f"""WITH {FEED}, own AS ({OWN_LOG}),
        kept AS (SELECT * FROM own WHERE ts >= TIMESTAMP '2024-01-16 00:00:00' - INTERVAL 24 HOUR AND id > (SELECT max(id) FROM own) - 5000)
        SELECT (SELECT count(*) FROM staged WHERE batch_id > 4) AS staging_backlog,
          (SELECT count(*) FROM feed WHERE outcome = 'dead_letter') AS dead_letters,
          (SELECT max(ts) FROM kept WHERE source = 'cdc-consumer') AS last_consumer_activity,
          (SELECT count(*) FROM kept WHERE severity = 'error') AS errors,
          (SELECT count(*) FROM kept WHERE ts > TIMESTAMP '2024-01-16 00:00:00' - INTERVAL 1 MINUTE) AS events_last_minute""",
    "topic_progress": PROGRESS,
    "stream_lag": PROGRESS,
    "barrier_check": f"""WITH {FEED},
        done AS (SELECT topic, max(event_id) AS handled FROM feed
          WHERE event_id < (SELECT count(*) // 2 FROM events) GROUP BY ALL)
        SELECT topic, CAST(0 AS INTEGER) AS "partition", event_id AS marker_offset, handled,
          coalesce(handled >= event_id, false) AS passed
        FROM feed LEFT JOIN done USING (topic) WHERE NOT other""",
    "barrier_gaps": f"""WITH {FEED}, size AS (SELECT count(*) AS n FROM events),
        state AS (SELECT feed.*, event_id < n // 2 AND (event_id % 89 <> 17 OR event_id < n // 4) AS taken FROM feed, size WHERE NOT other),
        done AS (SELECT topic, max(event_id) FILTER (taken) AS handled, min(event_id) FILTER (NOT taken) AS missing FROM state GROUP BY topic)
        SELECT topic, CAST(0 AS INTEGER) AS "partition", event_id AS marker_offset, handled, missing,
          event_id < coalesce(missing, event_id + 1) AS passed FROM state JOIN done USING (topic)""",
    "quiet_check": f"""WITH {FEED},
        timed AS (SELECT batch_id, TIMESTAMP '{FIRST}' + to_seconds(batch_id) AS staged_at FROM staged),
        cases AS (SELECT * FROM (VALUES ('waiting', 4, 60), ('just merged', NULL, 5), ('settled', NULL, 15)) AS t(state, applied, after))
        SELECT state, count(*) AS total, count(*) FILTER (batch_id > applied) AS pending, max(staged_at) AS last_staged,
          count(*) >= 8 AND count(*) FILTER (batch_id > applied) = 0 AND after >= 15 AS quiet
        FROM timed, cases GROUP BY state, applied, after""",
    "sync_lag": LAG,
    "state_changes": STATE_CHANGES,
    "current_state": f"""WITH {POLLS},
        up AS (SELECT cluster_id, arg_max(reachable, poll_seq) AS up FROM polls GROUP BY ALL)
        SELECT cluster_id, name, arg_max(state, poll_seq) AS state FROM polls JOIN up USING (cluster_id)
        WHERE reachable AND up GROUP BY ALL
        UNION ALL SELECT cluster_id, 'debezium', 'UNREACHABLE' FROM up WHERE NOT up""",
    "connector_readiness": f"WITH {READY} SELECT * FROM readiness",
    "restart_list": f"WITH {READY} SELECT cluster_id, name, state FROM readiness WHERE NOT ready",
    "prune_events": f"""WITH {LOG} SELECT * FROM log
        WHERE NOT (ts < TIMESTAMP '2024-01-16 00:00:00' - INTERVAL 24 HOUR OR id <= (SELECT max(id) FROM log) - 5000)""",
    "prune_own_log": f"""WITH log AS ({OWN_LOG}) SELECT * EXCLUDE position FROM log
        WHERE NOT (ts < TIMESTAMP '2024-01-16 00:00:00' - INTERVAL 24 HOUR OR id <= (SELECT max(id) FROM log) - 5000)""",
    "event_log": f"SELECT * EXCLUDE position FROM ({OWN_LOG})",
    "command_log": f"""WITH {COMMAND_EVENTS} SELECT row_number() OVER (ORDER BY position, step) AS id, * EXCLUDE (position, step)
        FROM api""",
    "connector_log": f"""SELECT row_number() OVER (ORDER BY poll_seq, name, cluster_id) AS id, TIMESTAMP '{FIRST}' AS ts,
        'api' AS source, 'connector' AS stage, severity, CAST(NULL AS VARCHAR) AS tenant_id, CAST(NULL AS INTEGER) AS legacy_id,
        message, '{{"connector":"' || name || '","from":' || coalesce('"' || from_state || '"', 'null')
          || ',"to":"' || to_state || '"}}' AS detail FROM ({STATE_CHANGES})""",
    "record_journey": JOURNEY,
    # two batches; each fails twice, and reports the first message of each topic partition
    "retry_counts": f"""WITH {FEED} SELECT topic, CAST(0 AS INTEGER) AS "partition", min(event_id) AS "offset",
        CAST(2 AS BIGINT) AS retries, CAST(2 AS INTEGER) AS last_attempt
        FROM feed GROUP BY topic, event_id >= (SELECT count(*) // 2 FROM events)""",
    "batch_summary": f"""WITH {FEED},{TOP_FIVE} SELECT batch_id, "rows", shown,
        'dbt run finished in 0.5s: ' || "rows" || ' staged row(s) merged into person (' || shown || ')' AS message
        FROM summed""",
    "stream_merge": f"WITH {BOTH} SELECT * REPLACE (synced_at AS created_at) FROM p2",
    "stream_replay": f"""WITH {BOTH} SELECT tenant_id, legacy_id, firstname, surname, extra_field, modernized_only,
        (SELECT count(*) + count(*) FILTER (NOT late) FROM staged) AS staged FROM p2""",
    "stream_state_changes": STATE_CHANGES,
    "stream_repeats": f"""WITH {FEED} SELECT 'staging' AS layer, count(*) AS records FROM staged
        UNION ALL SELECT 'dead_letter', (SELECT count(*) FROM feed WHERE outcome = 'dead_letter')
          + (SELECT count(*) FROM staged WHERE firstname IS NULL OR surname IS NULL)""",
    "catch_up_backlog": f"""WITH {ONE_BATCH} SELECT tenant_id, legacy_id, firstname, surname, extra_field, synced_at,
        (SELECT max(batch_id) // 4 FROM staged) AS last_batch FROM person""",
    "stream_late_names": f"""{STATE_CHANGES} WHERE to_state <> 'UNREACHABLE'""",
}
