"""The same questions in plain SQL over the given tables, for DuckDB.

Nothing here goes through JSON: the two sides share no parsing or replay code.
"""

from __future__ import annotations

from workload.fixtures import wide_decimals
from workload.queries import GIVEN_KEYS, MYSQL_TYPES, POSTGRES_TYPES
from workload.type_pairs import TO_MYSQL, TO_POSTGRES

LOG = """log AS (
  SELECT event_id AS seq, ts AS event_ts,
    CASE user_id % 3 WHEN 0 THEN 'users' WHEN 1 THEN 'orders' ELSE 'products' END AS tab,
    user_id AS id,
    CASE WHEN event_id < 200 THEN 'r' WHEN event_type IN ('signup', 'view') THEN 'c'
         WHEN event_type IN ('click', 'purchase') THEN 'u' ELSE 'd' END AS op,
    CASE WHEN event_id < 199 THEN 'true' WHEN event_id = 199 THEN 'last' ELSE 'false' END AS snapshot,
    event_type, value, event_id % 3 <> 0 AS has_value, event_id % 5 = 0 AS null_value
  FROM events)"""

# Lines that make it through the parser when damaged ones are mixed in.
DIRTY = LOG + """,
dirty AS (
  SELECT seq, event_ts, tab, CASE WHEN seq % 29 = 4 THEN 't' ELSE op END AS op,
    CASE WHEN seq % 29 = 7 THEN '' ELSE snapshot END AS snapshot,
    CASE WHEN seq % 29 IN (4, 7) THEN op <> 'd' WHEN seq % 29 = 5 THEN false ELSE true END AS applies
  FROM log WHERE seq % 29 NOT IN (1, 2, 3, 6, 8, 9))"""

# A bag per user, folded event by event.
CHAIN = """steps AS (
    SELECT event_id AS seq, user_id AS u, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS step, event_type AS t,
      CASE event_type WHEN 'error' THEN CASE WHEN event_id % 10 = 0 THEN 'd' ELSE 'c' END WHEN 'signup' THEN 'c' ELSE 'u' END AS op,
      CASE event_id % 3 WHEN 0 THEN 'view' WHEN 1 THEN 'click' ELSE 'purchase' END AS moved
    FROM events),
  state AS (
    SELECT DISTINCT u, CAST(0 AS BIGINT) AS step, CAST([] AS VARCHAR[]) AS held FROM steps
    UNION ALL
    SELECT l.u, l.step, CASE l.op WHEN 'c' THEN list_append(s.held, l.t) WHEN 'd' THEN CAST([] AS VARCHAR[])
      ELSE CASE WHEN list_contains(s.held, l.t) THEN [CASE WHEN x = l.t THEN l.moved ELSE x END FOR x IN s.held]
                ELSE list_append(s.held, l.moved) END END
    FROM state s JOIN steps l ON l.u = s.u AND l.step = s.step + 1)"""

# A bag per user, folded event by event. Updates that meet no row insert what their image carries; without the user it
# stays apart for good.
PARTIAL_CHAIN = """steps AS (
    SELECT event_id AS seq, user_id AS u, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS step, event_type AS t, value AS v,
      CASE WHEN event_id % 16 = 2 THEN 2 WHEN event_id % 4 = 2 THEN 1 ELSE event_id % 4 END AS k,
      CASE event_type WHEN 'error' THEN CASE WHEN event_id % 10 = 0 THEN 'd' ELSE 'c' END WHEN 'signup' THEN 'c' ELSE 'u' END AS op,
      CASE event_id % 3 WHEN 0 THEN 'view' WHEN 1 THEN 'click' ELSE 'purchase' END AS moved
    FROM events),
  state AS (
    SELECT DISTINCT u, CAST(0 AS BIGINT) AS step, CAST([] AS STRUCT(t VARCHAR, v DOUBLE)[]) AS held FROM steps
    UNION ALL
    SELECT l.u, l.step, CASE l.op WHEN 'c' THEN list_append(s.held, {'t': l.t, 'v': l.v}) WHEN 'd' THEN CAST([] AS STRUCT(t VARCHAR, v DOUBLE)[])
      ELSE CASE WHEN len([x FOR x IN s.held IF l.k = 2 OR x.t = l.t]) > 0 THEN
        [CASE WHEN l.k = 2 OR x.t = l.t THEN {'t': CASE WHEN l.k IN (0, 3) THEN l.moved ELSE x.t END, 'v': CASE WHEN l.k = 0 THEN x.v ELSE l.v END} ELSE x END FOR x IN s.held]
        WHEN l.k = 0 THEN list_append(s.held, {'t': l.moved, 'v': NULL}) ELSE s.held END END
    FROM state s JOIN steps l ON l.u = s.u AND l.step = s.step + 1),
  missed AS (
    SELECT l.* FROM steps l JOIN state s ON s.u = l.u AND s.step = l.step - 1
    WHERE l.op = 'd' AND len(s.held) = 0 OR l.op = 'u' AND len([x FOR x IN s.held IF l.k = 2 OR x.t = l.t]) = 0)"""

STAGE = "CASE WHEN snapshot IN ('false', '') THEN 'stream' WHEN snapshot = 'last' THEN 'last' ELSE 'snapshot' END"
CUSTOMERS = "base AS (SELECT c_custkey AS id, c_mktsegment AS event_type, c_acctbal AS value FROM customer)"
SUPPLIERS = "base AS (SELECT s_suppkey AS id, s_name AS event_type, s_acctbal AS value FROM supplier)"


def replay_on(base: str | None, where: str) -> str:
    """Last event per key wins; untouched base rows stay."""
    parts = [LOG, f"""final AS (SELECT * FROM log WHERE {where}
      QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1)"""]
    kept = ""
    if base:
        parts.insert(1, base)
        kept = "UNION ALL SELECT id, event_type, value FROM base WHERE id NOT IN (SELECT id FROM final)"
    return f"WITH {', '.join(parts)} SELECT id, event_type, value FROM final WHERE op <> 'd' {kept}"


ORDERS_TARGET = """target AS (
  SELECT * FROM orders WHERE o_orderkey % 17 <> 0
  UNION ALL SELECT * REPLACE (o_orderkey + 1000000000 AS o_orderkey) FROM orders WHERE o_orderkey % 13 = 0)"""
LINES_TARGET = """line_target AS (
  SELECT * FROM lineitem WHERE l_orderkey % 17 <> 0
  UNION ALL SELECT * REPLACE (l_suppkey + 1000000 AS l_suppkey) FROM lineitem WHERE l_orderkey % 13 = 0)"""
LINE_MISSING = """NOT EXISTS (SELECT 1 FROM lineitem s WHERE s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber
  AND s.l_partkey = t.l_partkey AND s.l_suppkey = t.l_suppkey)"""

BAG = """bag AS (SELECT l_orderkey AS k, l_linenumber AS n FROM lineitem),
events_of AS (SELECT o_orderkey AS k, CAST(o_custkey % 7 + 1 AS INT) AS n FROM orders)"""

CENTS = "(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE -1 END * CAST(round(o_totalprice * 100) AS BIGINT))"

HOURS = """seen AS (SELECT date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', date_trunc('hour', ts)) AS sample, event_id FROM events),
hours AS (SELECT sample, count(*) AS n, 0 AS arrived FROM seen GROUP BY 1 UNION ALL SELECT sample + event_id % 3, 0, count(*) FROM seen GROUP BY 1),
samples AS (SELECT sample, CAST(sum(sum(n)) OVER (ORDER BY sample) AS BIGINT) AS total,
  CAST(sum(sum(n) - sum(arrived)) OVER (ORDER BY sample) AS BIGINT) AS lag FROM hours GROUP BY sample)"""

COUNTS = """counts AS (SELECT tab, count(*) FILTER (op = 'r') AS snapshot_rows, count(*) FILTER (op = 'c') AS inserts,
  count(*) FILTER (op = 'u') AS updates, count(*) FILTER (op = 'd') AS deletes, max(event_ts) AS last_event
  FROM log GROUP BY tab)"""
REGISTERED = """registered AS (SELECT DISTINCT tab FROM log UNION SELECT lower(c_mktsegment) FROM customer)"""
TOTALS = """totals AS (SELECT CASE c_custkey % 3 WHEN 1 THEN 'orders' WHEN 2 THEN 'products' ELSE 'unused' END AS tab,
  count(*) AS total FROM customer GROUP BY 1)"""
LABEL = """CASE WHEN total > 0 THEN format('{:.1f}% ({:,}/{:,})', CAST(round(CAST(snapshot_rows AS DECIMAL(18,6)) * 100 / total, 1) AS DOUBLE),
  snapshot_rows, total) ELSE snapshot_rows || ' rows' END"""


def _literals(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def catalogs(types: list[str]) -> str:
    return f"""source AS (
  SELECT 'T' || (p_partkey // 20) AS tab, 'Col_' || (p_partkey % 20) AS col,
    ([{_literals(types)}])[CAST(p_partkey * 7 % {len(types)} AS INT) + 1] AS type_name,
    CAST(CASE p_partkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE p_size END AS INT) AS size,
    CAST(p_partkey % 4 AS INT) AS digits, p_partkey % 3 <> 0 AS nullable, p_partkey % 40 = 0 AS auto,
    CAST(p_partkey % 20 + 1 AS INT) AS ordinal,
    CASE WHEN p_partkey % 20 < 2 THEN 2 - p_partkey % 20 END AS key_seq, p_partkey // 20 AS number, p_partkey % 20 AS nth
  FROM part),
target AS (SELECT * REPLACE (upper(col) AS col) FROM source WHERE number % 5 <> 0 AND (number + nth) % 7 <> 3),
required AS (
  SELECT DISTINCT 'T' || (p_partkey // 20) AS tab, p_partkey // 20 AS position FROM part
  UNION ALL SELECT 'T' || (1000000 + s_suppkey), 1000000 + s_suppkey FROM supplier)"""


def sized(name: str) -> str:
    return f"""CASE WHEN contains({name}, '(') THEN {name}
      WHEN contains(upper({name}), 'VARCHAR') OR upper({name}) IN ('CHAR', 'BPCHAR')
        THEN {name} || '(' || CASE WHEN size > 0 THEN size ELSE 255 END || ')'
      WHEN contains(upper({name}), 'NUMERIC') OR contains(upper({name}), 'DECIMAL')
        THEN {name} || '(' || CASE WHEN size > 0 THEN size ELSE 18 END || ', ' || digits || ')'
      ELSE {name} END"""


def translated(types: list[str], family: str) -> str:
    """The source catalog with its translated types, as CTE `typed`."""
    # Sizes other than the default are put in by `sized`, as for a type that spells none out.
    listed = TO_POSTGRES if family == "mysql" else TO_MYSQL
    bare = {"CHAR(255)": "CHAR", "VARCHAR(255)": "VARCHAR", "NUMERIC(18, 0)": "NUMERIC", "DECIMAL(18, 0)": "DECIMAL"}
    pairs = ", ".join(f"('{a}', '{bare.get(b, b)}')" for a, b in listed)
    special = ("WHEN base = 'TINYINT' AND size = 1 THEN 'BOOLEAN'" if family == "mysql"
               else "WHEN base LIKE '\\_%' ESCAPE '\\' THEN 'LONGTEXT'")
    fallback = "TEXT" if family == "mysql" else "LONGTEXT"
    return f"""{catalogs(types)},
mapping(a, b) AS (VALUES {pairs}),
named AS (SELECT *, trim(split_part(trim(upper(type_name)), '(', 1)) AS base FROM source),
mapped AS (SELECT n.*, coalesce((SELECT b FROM mapping WHERE a = n.base),
  (SELECT b FROM mapping WHERE a = regexp_replace(n.base, ' UNSIGNED$', ''))) AS m FROM named n),
typed AS (SELECT *, CASE {special} WHEN m IS NULL THEN '{fallback}' ELSE {sized('m')} END AS target_type FROM mapped)"""


TYPED_COLUMNS = 'tab AS "table", col AS "column", type_name, target_type'
LACKING = """tab IN (SELECT tab FROM target)
  AND NOT EXISTS (SELECT 1 FROM target t WHERE t.tab = s.tab AND lower(t.col) = lower(s.col))"""
PLAN = f"""plan AS (SELECT DISTINCT s.tab, CASE WHEN s.tab NOT IN (SELECT tab FROM target) THEN 'create'
  WHEN s.tab IN (SELECT s.tab FROM source s WHERE {LACKING}) THEN 'alter' ELSE 'keep' END AS action FROM source s)"""

GIVEN_COLUMNS = {
    "region": "r_regionkey INTEGER, r_name TEXT",
    "nation": "n_nationkey INTEGER, n_name TEXT, n_regionkey INTEGER",
    "customer": "c_custkey BIGINT, c_name TEXT, c_nationkey INTEGER, c_acctbal DOUBLE PRECISION, c_mktsegment TEXT",
    "supplier": "s_suppkey BIGINT, s_name TEXT, s_nationkey INTEGER, s_acctbal DOUBLE PRECISION",
    "part": "p_partkey BIGINT, p_name TEXT, p_brand TEXT, p_type TEXT, p_size INTEGER, p_retailprice DOUBLE PRECISION",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus TEXT, o_totalprice DOUBLE PRECISION, "
              "o_orderdate TIMESTAMP, o_orderpriority TEXT",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INTEGER, l_quantity DOUBLE PRECISION, "
                "l_extendedprice DOUBLE PRECISION, l_discount DOUBLE PRECISION, l_tax DOUBLE PRECISION, l_returnflag TEXT, "
                "l_linestatus TEXT, l_shipdate TIMESTAMP",
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type TEXT, value DOUBLE PRECISION, props TEXT",
}


def _given_catalog() -> str:
    rows = []
    for table, columns in GIVEN_COLUMNS.items():
        for i, column in enumerate(columns.split(", "), start=1):
            name, type_name = column.split(" ", 1)
            key = GIVEN_KEYS[table].index(name) + 1 if name in GIVEN_KEYS[table] else "NULL"
            rows.append(f"SELECT '{table}' AS \"table\", '{name}' AS \"column\", '{type_name}' AS type_name, {i} AS ordinal, "
                        f"CAST({key} AS INT) AS key_seq, (SELECT count(*) FROM {table}) AS rows")
    return " UNION ALL ".join(rows)


def _wire(*columns: str) -> str:
    listed = ", ".join(f"CASE WHEN event_id % 10 = 9 THEN NULL ELSE {c.rsplit(' AS ', 1)[0]} END AS {c.rsplit(' AS ', 1)[1]}"
                       for c in columns)
    return f"SELECT event_id, {listed} FROM events"


ORACLE: dict[str, str] = {
    "snapshot_scan": "SELECT 'orders' AS \"table\", 'r' AS op, 'SNAPSHOT' AS counted_as, o_orderkey, o_custkey, o_totalprice FROM orders",
    "changelog_scan": f'WITH {LOG} SELECT seq, tab AS "table", op, id, event_type, value FROM log',
    "table_select": f"WITH {LOG} SELECT seq, tab AS \"table\", op FROM log WHERE tab IN ('orders', 'users')",
    "snapshot_mode_initial": replay_on(CUSTOMERS, "true"),
    "snapshot_mode_never": replay_on(SUPPLIERS, "op <> 'r'"),
    "snapshot_mode_schema_only": replay_on(None, "op <> 'r'"),
    "snapshot_mode_initial_only": replay_on(CUSTOMERS, "op = 'r'"),
    "envelope_flatten": f"""WITH {LOG} SELECT seq, tab AS "table", op, snapshot,
      CASE WHEN op IN ('u', 'd') THEN CAST(id AS VARCHAR) END AS before_id,
      CASE WHEN op <> 'd' THEN CAST(id AS VARCHAR) END AS after_id,
      CASE WHEN op <> 'd' THEN event_type END AS after_event_type FROM log""",
    "event_filter": f'WITH {DIRTY} SELECT seq, tab AS "table", op FROM dirty',
    "event_quarantine": f"WITH {LOG} SELECT seq, '{{bad' AS value, 'not_json' AS reject_reason FROM log WHERE seq % 29 = 1",
    "op_classify": f"""WITH {DIRTY} SELECT seq, op,
      CASE WHEN op IN ('r', 'c', 'u') THEN 'upsert' WHEN op = 'd' THEN 'delete' ELSE 'ignore' END AS action,
      CASE op WHEN 'r' THEN 'SNAPSHOT' WHEN 'c' THEN 'INSERT' WHEN 'u' THEN 'UPDATE' WHEN 'd' THEN 'DELETE' END AS counted_as,
      applies AND op <> 't' AS applies FROM dirty""",
    "snapshot_flag": f"WITH {DIRTY} SELECT seq, snapshot, {STAGE} AS stage FROM dirty",
    "route_by_table": f"WITH {LOG} SELECT tab AS route, seq, op FROM log",
    "field_schema_map": """SELECT o_orderkey AS seq, f.field AS field, CASE WHEN f.field = 'price'
      THEN 'org.apache.kafka.connect.data.Decimal' END AS logical_name,
      CASE WHEN f.field = 'price' THEN CAST(o_orderkey % 4 AS VARCHAR) END AS scale
      FROM orders, (VALUES ('id'), ('price'), ('code')) f(field)""",
    "image_typed_case": f"""WITH {LOG} SELECT seq, id, event_type, CASE WHEN has_value AND NOT null_value THEN value END AS value,
      CAST(has_value AS INT) AS value_present FROM log WHERE op <> 'd'""",
    "image_typed": f"""WITH {LOG} SELECT seq, id, event_type, CASE WHEN has_value AND NOT null_value THEN value END AS value,
      CAST(has_value AS INT) AS value_present FROM log WHERE op <> 'd'""",
    "decimal_decode_wide": f"""SELECT o_orderkey, ({[text for _, text in wide_decimals()]})[CAST(o_orderkey % {len(wide_decimals())} + 1 AS BIGINT)] AS price
      FROM orders""",
    "decimal_decode": f"""SELECT o_orderkey, CAST({CENTS} / 100 AS DECIMAL(18,2)) AS price,
      CAST({CENTS} / power(10, o_orderkey % 4) AS DECIMAL(18,4)) AS scaled FROM orders""",
    "record_decode": f"""SELECT o_orderkey AS seq, CAST(o_orderkey AS VARCHAR) AS id,
      CAST({CENTS} / power(10, o_orderkey % 4) AS DECIMAL(18,4)) AS price, 'AAAA' AS code FROM orders""",
    "coerce_boolean": _wire("CAST(event_id % 3 <> 0 AS INT) AS flag", "CAST(trunc(value / 100) <> 0 AS INT) AS ratio",
                            "CAST(event_id % 2 = 0 AS INT) AS word"),
    "coerce_timestamp": _wire("date_trunc('millisecond', ts) AS millis", "date_trunc('millisecond', ts) AS local_text",
                              "date_trunc('millisecond', ts) - INTERVAL 2 HOUR AS zoned", "date_trunc('millisecond', ts) AS utc"),
    "coerce_timestamptz": _wire("epoch_us(ts) // 1000 AS millis", "epoch_us(ts + INTERVAL 210 MINUTE) // 1000 AS zoned", "CAST(NULL AS BIGINT) AS no_offset"),
    "coerce_date": _wire("CAST(CAST(ts AS DATE) AS VARCHAR) AS days", "CAST(CAST(ts AS DATE) AS VARCHAR) AS iso"),
    "coerce_time": _wire("strftime(ts, '%H:%M:%S.%g') AS millis", "strftime(ts, '%H:%M:%S.%g') AS micros", "'12:34:56' AS plain"),
    "key_normalize": "SELECT o_orderkey AS key, o_orderstatus FROM orders WHERE o_orderkey % 3 = 0",
    "apply_changes": f"""WITH {LOG}, final AS (SELECT * FROM log
      QUALIFY row_number() OVER (PARTITION BY tab, id ORDER BY seq DESC) = 1)
      SELECT tab AS "table", id, event_type, value FROM final WHERE op <> 'd'""",
    "apply_upserts": replay_on(CUSTOMERS, "op <> 'd'"),
    "apply_deletes": replay_on(CUSTOMERS, "op = 'd'"),
    "apply_changes_on_base": f"""WITH {ORDERS_TARGET}
      SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)
      UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 FROM orders WHERE o_orderkey % 4 <> 3""",
    "apply_changes_composite": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      l_quantity + CASE WHEN l_orderkey % 3 = 1 THEN 1 ELSE 0 END AS l_quantity FROM lineitem WHERE l_orderkey % 3 <> 0
      QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey ORDER BY l_extendedprice DESC) = 1""",
    "apply_partial": f"""WITH {LOG}, {CUSTOMERS}, mine AS (SELECT * FROM log),
      ends AS (SELECT id, max(seq) FILTER (op = 'd') AS removed FROM mine GROUP BY id),
      alive AS (SELECT m.* FROM mine m JOIN ends e USING (id) WHERE m.op <> 'd' AND (e.removed IS NULL OR m.seq > e.removed)),
      last_any AS (SELECT * FROM alive QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1),
      last_value AS (SELECT * FROM alive WHERE has_value QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1)
      SELECT a.id, a.event_type, CASE WHEN v.id IS NOT NULL THEN CASE WHEN v.null_value THEN NULL ELSE v.value END
        WHEN e.removed IS NULL THEN b.value END AS value
      FROM last_any a JOIN ends e USING (id) LEFT JOIN last_value v USING (id) LEFT JOIN base b USING (id)
      UNION ALL SELECT id, event_type, value FROM base WHERE id NOT IN (SELECT id FROM mine)""",
    "apply_reordered": f"""WITH {LOG}, {CUSTOMERS}, mine AS (SELECT * FROM log),
      ends AS (SELECT id, max(seq) FILTER (op = 'd') AS removed FROM mine GROUP BY id),
      alive AS (SELECT m.* FROM mine m JOIN ends e USING (id) WHERE m.op <> 'd' AND (e.removed IS NULL OR m.seq > e.removed)),
      last_any AS (SELECT * FROM alive QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1),
      last_value AS (SELECT * FROM alive WHERE has_value QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1)
      SELECT a.id, a.event_type, CASE WHEN v.id IS NOT NULL THEN CASE WHEN v.null_value THEN NULL ELSE v.value END
        WHEN e.removed IS NULL THEN b.value END AS value
      FROM last_any a JOIN ends e USING (id) LEFT JOIN last_value v USING (id) LEFT JOIN base b USING (id)
      UNION ALL SELECT id, event_type, value FROM base WHERE id NOT IN (SELECT id FROM mine)""",
    "apply_key_only": f"""WITH {LOG}, {SUPPLIERS}, mine AS (SELECT * FROM log),
      ends AS (SELECT id, max(seq) FILTER (op = 'd') AS removed, max(seq) FILTER (op <> 'd') AS put FROM mine GROUP BY id)
      SELECT b.id, b.event_type, b.value FROM base b LEFT JOIN ends e USING (id) WHERE e.removed IS NULL
      UNION ALL SELECT e.id, NULL, NULL FROM ends e WHERE e.put IS NOT NULL AND (e.put > e.removed
        OR (e.removed IS NULL AND e.id NOT IN (SELECT id FROM base)))""",
    "apply_unkeyed_insert": f"WITH {BAG} SELECT k, n FROM bag UNION ALL SELECT k, n FROM events_of",
    "apply_unkeyed_update": f"""WITH {BAG}
      SELECT b.k, CAST(CASE WHEN e.k IS NULL THEN b.n ELSE b.n + 100 END AS INT) AS n FROM bag b LEFT JOIN events_of e ON e.k = b.k AND e.n = b.n
      UNION ALL SELECT k, CAST(n + 100 AS INT) FROM events_of e WHERE NOT EXISTS (SELECT 1 FROM bag b WHERE b.k = e.k AND b.n = e.n)""",
    "apply_unkeyed_delete": f"""WITH {BAG} SELECT k, n FROM bag b
      WHERE NOT EXISTS (SELECT 1 FROM events_of e WHERE e.k = b.k AND (e.k % 5 = 0 OR e.n = b.n))""",
    "apply_unkeyed_partial": f"""WITH RECURSIVE {PARTIAL_CHAIN}
      SELECT u AS user_id, x.t AS event_type, x.v AS value
      FROM (SELECT u, unnest(held) AS x FROM (SELECT u, held FROM state QUALIFY row_number() OVER (PARTITION BY u ORDER BY step DESC) = 1))
      UNION ALL SELECT NULL, CASE k WHEN 3 THEN moved END, v FROM missed WHERE op = 'u' AND k <> 0""",
    "noop_unkeyed_partial": f"""WITH RECURSIVE {PARTIAL_CHAIN}
      SELECT seq, CASE op WHEN 'd' THEN 'no_row' ELSE 'update_inserted' END AS reason FROM missed""",
    "apply_unkeyed_chain": f"""WITH RECURSIVE {CHAIN}
      SELECT u AS user_id, unnest(held) AS event_type
      FROM (SELECT u, held FROM state QUALIFY row_number() OVER (PARTITION BY u ORDER BY step DESC) = 1)""",
    "noop_unkeyed": f"""WITH RECURSIVE {CHAIN}
      SELECT l.seq, CASE l.op WHEN 'd' THEN 'no_row' ELSE 'update_inserted' END AS reason
      FROM steps l JOIN state s ON s.u = l.u AND s.step = l.step - 1
      WHERE (l.op = 'd' AND len(s.held) = 0) OR (l.op = 'u' AND NOT list_contains(s.held, l.t))""",
    "noop_deletes": f"""WITH {LOG}, {SUPPLIERS}, mine AS (
        SELECT *, lag(op) OVER (PARTITION BY id ORDER BY seq) AS previous FROM log)
      SELECT seq, id, 'no_row' AS reason FROM mine WHERE op = 'd'
        AND (previous = 'd' OR (previous IS NULL AND id NOT IN (SELECT id FROM base)))""",
    "orphan_rows": f"WITH {ORDERS_TARGET} SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)",
    "orphan_rows_composite": f"""WITH {LINES_TARGET} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
      FROM line_target t WHERE {LINE_MISSING}""",
    "orphan_rows_pruned": f"""WITH {LINES_TARGET} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
      FROM line_target t WHERE {LINE_MISSING}""",
    "orphan_cleanup": f"WITH {ORDERS_TARGET} SELECT * FROM target WHERE o_orderkey IN (SELECT o_orderkey FROM orders)",
    "orphans_removed": f"""WITH {LINES_TARGET} SELECT 'lineitem' AS "table", count(*) AS removed FROM line_target t WHERE {LINE_MISSING}""",
    "orphan_totals": f"""WITH {ORDERS_TARGET}, {LINES_TARGET}, each AS (
        SELECT 'orders' AS "table", count(*) AS orphans FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)
        UNION ALL SELECT 'lineitem', count(*) FROM line_target t WHERE {LINE_MISSING}
        UNION ALL SELECT 'customer', 0)
      SELECT "table", orphans, 'ok' AS status FROM each UNION ALL SELECT 'TOTAL', CAST(sum(orphans) AS BIGINT), 'ok' FROM each""",
    "cleanup_trigger": f"WITH {LOG} SELECT min(seq) AS position FROM log WHERE snapshot IN ('last', 'false', '')",
    "reconcile_counts": f"""WITH {ORDERS_TARGET}, {LINES_TARGET}, both_sides(t, s, d) AS (
        SELECT 'customer', (SELECT count(*) FROM customer), (SELECT count(*) FROM customer)
        UNION ALL SELECT 'events', (SELECT count(*) FROM events), (SELECT count(*) FROM events)
        UNION ALL SELECT 'lineitem', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM line_target)
        UNION ALL SELECT 'orders', (SELECT count(*) FROM orders), (SELECT count(*) FROM target)
        UNION ALL SELECT 'part', (SELECT count(*) FROM part), (SELECT count(*) FROM supplier)
        UNION ALL SELECT 'region', (SELECT count(*) FROM region), 0
        UNION ALL SELECT 'nation', 0, (SELECT count(*) FROM nation))
      SELECT t AS "table", s AS source_rows, d AS target_rows, s - d AS lag,
        CASE WHEN s = d THEN 'synced' WHEN s - d > 5 THEN 'far behind' ELSE 'behind' END AS status FROM both_sides
      UNION ALL SELECT 'TOTAL', CAST(sum(s) AS BIGINT), CAST(sum(d) AS BIGINT), CAST(sum(s - d) AS BIGINT),
        CASE WHEN sum(s - d) = 0 THEN 'synced' WHEN sum(s - d) >= 10 THEN 'far behind' ELSE 'behind' END FROM both_sides""",
    "latest_rows": """SELECT o_orderstatus, o_orderkey, o_custkey, o_totalprice,
        row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey DESC) AS rank FROM orders QUALIFY rank <= 3""",
    "latest_rows_diff": """WITH s AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey DESC) <= 3),
      t AS (SELECT * FROM orders WHERE o_orderkey % 3 <> 1 QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey DESC) <= 3)
      SELECT coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus, coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
        coalesce(s.o_custkey, t.o_custkey) AS o_custkey, coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice,
        CASE WHEN s.o_orderkey IS NULL THEN 'target only' WHEN t.o_orderkey IS NULL THEN 'source only' ELSE 'both' END AS side
      FROM s FULL OUTER JOIN t ON s.o_orderkey = t.o_orderkey""",
    "source_rate": f"""WITH {HOURS} SELECT sample, (total - lag(total, 5) OVER (ORDER BY sample)) / (5 * 3600.0) AS rate
      FROM samples QUALIFY row_number() OVER (ORDER BY sample DESC) = 1""",
    "lag_trend": f"""WITH {HOURS}, recent AS (SELECT * FROM samples ORDER BY sample DESC LIMIT 20)
      SELECT sample, lag, CAST(CASE WHEN lag <= 0 THEN 0 ELSE least(7, floor(lag / (SELECT CASE WHEN max(lag) > 0 THEN max(lag) ELSE 1 END FROM recent) * 7)) END AS INT) AS level
      FROM recent""",
    "progress_counts": f"""WITH {DIRTY} SELECT tab AS "table", count(*) FILTER (op = 'r') AS snapshot_rows, count(*) FILTER (op = 'c') AS inserts,
      count(*) FILTER (op = 'u') AS updates, count(*) FILTER (op = 'd') AS deletes,
      max(event_ts) FILTER (op <> 't') AS last_event FROM dirty GROUP BY tab""",
    "progress_totals": f"""WITH {LOG}, {COUNTS} SELECT coalesce(tab, 'TOTAL') AS "table", CAST(sum(inserts) AS BIGINT) AS inserts,
      CAST(sum(updates) AS BIGINT) AS updates, CAST(sum(deletes) AS BIGINT) AS deletes,
      CAST(sum(inserts + updates + deletes) AS BIGINT) AS changes FROM counts GROUP BY ROLLUP (tab)""",
    "progress_phase": f"""WITH {LOG}, {REGISTERED}, changes AS (
        SELECT o_orderstatus || ' ' || o_orderpriority AS tab, o_orderkey AS seq, o_orderkey % 4 AS op FROM orders),
      last_op AS (SELECT tab, op FROM changes QUALIFY row_number() OVER (PARTITION BY tab ORDER BY seq DESC) = 1)
      SELECT tab AS "table", CASE WHEN op = 0 THEN 'SNAPSHOT' ELSE 'CDC' END AS phase FROM last_op
      UNION ALL SELECT tab, CASE WHEN EXISTS (SELECT 1 FROM changes WHERE op <> 0) THEN 'CDC' ELSE 'INITIALIZING' END
        FROM registered WHERE tab NOT IN (SELECT tab FROM last_op)""",
    "progress_merged": f"""WITH {LOG}, {REGISTERED}, changes AS (
        SELECT o_orderstatus || ' ' || o_orderpriority AS tab, o_orderkey AS seq, o_orderkey % 4 AS op FROM orders),
      seen AS (SELECT tab, CASE WHEN max_by(op, seq) = 0 THEN 'SNAPSHOT' ELSE 'CDC' END AS phase, count(*) FILTER (op = 0) AS snapshot_rows,
        count(*) FILTER (op = 1) AS inserts, count(*) FILTER (op = 2) AS updates, count(*) FILTER (op = 3) AS deletes FROM changes GROUP BY tab)
      SELECT tab AS "table", phase, snapshot_rows, inserts, updates, deletes, inserts + updates + deletes AS changes FROM seen
      UNION ALL SELECT tab, CASE WHEN EXISTS (SELECT 1 FROM changes WHERE op <> 0) THEN 'CDC' ELSE 'INITIALIZING' END, 0, 0, 0, 0, 0
        FROM registered WHERE tab NOT IN (SELECT tab FROM seen)""",
    "snapshot_pct": f"""WITH {LOG}, {COUNTS}, {TOTALS}, joined AS (
        SELECT tab, snapshot_rows, coalesce(total, -1) AS total FROM counts LEFT JOIN totals USING (tab))
      SELECT tab AS "table", snapshot_rows, total,
        CASE WHEN total > 0 THEN round(snapshot_rows / total * 100.0, 6) ELSE -1.0 END AS snapshot_pct, {LABEL} AS snapshot_label FROM joined""",
    "status_report": f"""WITH {LOG}, {COUNTS}, {REGISTERED}, {TOTALS}, joined AS (
        SELECT r.tab, coalesce(snapshot_rows, 0) AS snapshot_rows, coalesce(inserts, 0) AS inserts, coalesce(updates, 0) AS updates,
          coalesce(deletes, 0) AS deletes, coalesce(total, -1) AS total,
          CASE WHEN c.tab IS NULL THEN CASE WHEN EXISTS (SELECT 1 FROM log WHERE snapshot = 'false') THEN 'CDC' ELSE 'INITIALIZING' END
            WHEN inserts + updates + deletes > 0 THEN 'CDC' ELSE 'SNAPSHOT' END AS phase,
          date_diff('microsecond', last_event, TIMESTAMP '2024-01-31 00:00:00') // 1000 AS ms
        FROM registered r LEFT JOIN counts c USING (tab) LEFT JOIN totals USING (tab))
      SELECT tab AS "table", phase, CASE WHEN phase = 'INITIALIZING' THEN '-' ELSE {LABEL} END AS snapshot, inserts, updates, deletes,
        CASE WHEN ms IS NULL THEN NULL WHEN ms < 1000 THEN ms || 'ms' WHEN ms < 60000 THEN (ms // 1000) || 's ago'
          WHEN ms < 3600000 THEN (ms // 60000) || 'm ago' ELSE (ms // 3600000) || 'h ago' END AS last
      FROM joined ORDER BY tab""",
    "missing_tables": f"WITH {catalogs(MYSQL_TYPES)} SELECT tab AS \"table\" FROM required WHERE tab NOT IN (SELECT tab FROM target)",
    "table_checks": f"""WITH {catalogs(MYSQL_TYPES)},
      in_source AS (SELECT list(tab ORDER BY position) AS missing FROM required WHERE tab NOT IN (SELECT tab FROM source)),
      in_target AS (SELECT list(tab ORDER BY position) AS missing FROM required WHERE tab NOT IN (SELECT tab FROM target))
      SELECT 'tables.source' AS id, 'FAIL' AS status, 'Missing in source: [' || array_to_string(missing, ', ') || ']' AS message,
        array_to_string(list_transform(missing, lambda t: 'not found: ' || t), '; ') AS details FROM in_source
      UNION ALL SELECT 'tables.target', 'WARN', len(missing) || ' table(s) missing in target (will be created by schema sync)',
        array_to_string(list_transform(missing, lambda t: 'not in target: ' || t), '; ') FROM in_target""",
    "check_summary": f"""WITH {catalogs(MYSQL_TYPES)}, {PLAN} SELECT count(*) AS total, count(*) FILTER (action = 'keep') AS passed,
      count(*) FILTER (action = 'alter') AS warned, count(*) FILTER (action = 'create') AS failed,
      CAST(CASE WHEN count(*) FILTER (action = 'create') > 0 THEN 1 ELSE 0 END AS INT) AS exit_code FROM plan""",
    "schema_catalog": _given_catalog(),
    "pk_columns": f"""WITH {catalogs(MYSQL_TYPES)} SELECT tab AS "table",
      coalesce(string_agg(col, ',' ORDER BY key_seq) FILTER (key_seq IS NOT NULL), '') AS keys FROM source GROUP BY tab""",
    "translate_mysql_pg": f"WITH {translated(MYSQL_TYPES, 'mysql')} SELECT {TYPED_COLUMNS} FROM typed",
    "translate_pg_mysql": f"WITH {translated(POSTGRES_TYPES, 'postgresql')} SELECT {TYPED_COLUMNS} FROM typed",
    "translate_same_family": f"""WITH {catalogs(MYSQL_TYPES)} SELECT tab AS "table", col AS "column", type_name,
      {sized('type_name')} AS target_type FROM source""",
    "schema_diff": f"WITH {catalogs(MYSQL_TYPES)} SELECT tab AS \"table\", col AS \"column\" FROM source s WHERE {LACKING}",
    "schema_plan": f"WITH {catalogs(MYSQL_TYPES)}, {PLAN} SELECT tab AS \"table\", action FROM plan",
    "schema_evolve": """SELECT o_orderkey, o_totalprice, CAST(NULL AS DECIMAL(10,2)) AS discount, CAST(NULL AS VARCHAR) AS note FROM orders""",
    "create_ddl": f"""WITH {translated(MYSQL_TYPES, 'mysql')}, lines AS (SELECT *, '  "' || col || '" ' ||
        CASE WHEN auto THEN 'BIGSERIAL' ELSE target_type || CASE WHEN nullable THEN '' ELSE ' NOT NULL' END END AS line FROM typed)
      SELECT tab AS "table", 'CREATE TABLE IF NOT EXISTS "' || tab || '" (' || chr(10) || string_agg(line, ',' || chr(10) ORDER BY ordinal)
        || coalesce(',' || chr(10) || '  PRIMARY KEY (' || string_agg('"' || col || '"', ', ' ORDER BY key_seq) FILTER (key_seq IS NOT NULL) || ')', '')
        || chr(10) || ')' AS ddl FROM lines GROUP BY tab""",
    "alter_ddl": f"""WITH {translated(POSTGRES_TYPES, 'postgresql')} SELECT tab AS "table", col AS "column",
      'ALTER TABLE `' || tab || '` ADD COLUMN   `' || col || '` ' ||
      CASE WHEN auto THEN 'BIGINT AUTO_INCREMENT' ELSE target_type || CASE WHEN nullable THEN '' ELSE ' NOT NULL' END END AS ddl
      FROM typed s WHERE {LACKING}""",
}
