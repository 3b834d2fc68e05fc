"""Independent SQL (DuckDB dialect) for every recipe.

Written from the operator semantics, not from the Spark code: each query
computes the expected rows directly on the driver's tables.  Aliases match
the Spark recipes column for column.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

# Session table derived from the login events (LOGIN = signup, LOGOUT = purchase).
SESSIONS_CTE = f"""
ev AS (
  SELECT 'u' || CAST(user_id AS VARCHAR) AS usuario,
         CASE WHEN event_type = 'signup' THEN 'LOGIN' ELSE 'LOGOUT' END AS kind,
         user_id AS subject, ts AS event_at, event_id AS seq,
         CASE WHEN event_type = 'signup' AND value < 20 THEN ts + INTERVAL 1 DAY END AS expires_at
  FROM events WHERE event_type IN ('signup', 'purchase')
),
ll AS (
  SELECT * FROM ev
  WHERE kind = 'LOGIN' AND subject IN (SELECT c_custkey FROM customer)
  QUALIFY row_number() OVER (PARTITION BY usuario ORDER BY event_at DESC, seq DESC) = 1
),
fl AS (
  SELECT o.usuario, min(o.event_at) AS first_at
  FROM ev o LEFT JOIN ll ON o.usuario = ll.usuario
  WHERE o.kind = 'LOGOUT' AND (ll.usuario IS NULL OR o.event_at > ll.event_at OR (o.event_at = ll.event_at AND o.seq > ll.seq))
  GROUP BY o.usuario
),
sessions AS (
  SELECT ll.usuario, ll.subject, fl.usuario IS NULL AS active, ll.event_at AS started_at,
         CASE WHEN fl.usuario IS NOT NULL THEN fl.first_at ELSE ll.expires_at END AS expires_at
  FROM ll LEFT JOIN fl ON ll.usuario = fl.usuario
),
usable AS (
  SELECT * FROM sessions WHERE active AND (expires_at IS NULL OR expires_at > {AS_OF})
),
principal AS (SELECT min_by(usuario, subject) AS usuario FROM usable),
allowed AS (SELECT subject FROM usable WHERE usuario = (SELECT usuario FROM principal))
"""

LOG_CTE = """
alog AS (
  SELECT 'u' || CAST(user_id AS VARCHAR) AS usuario, event_type AS action, 'events' AS table_name,
         user_id AS subject, ts AS event_at, event_id AS seq, event_type <> 'error' AS success, props AS detail
  FROM events
)
"""

CHANGED_ORDERS = """
cur AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'P')
  UNION ALL
  SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'P'
)
"""

ORACLE: dict[str, str] = {}

ORACLE["scan_projection"] = """
SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_acctbal > 0 AND c_nationkey < 10
"""

ORACLE["inline_values_join"] = """
SELECT c.c_custkey, c.c_mktsegment, v.seg_code
FROM customer c JOIN (VALUES ('AUTOMOBILE', 'AU'), ('BUILDING', 'BU'), ('FURNITURE', 'FU'),
                             ('HOUSEHOLD', 'HO'), ('MACHINERY', 'MA')) AS v(segment, seg_code)
  ON c.c_mktsegment = v.segment
"""

ORACLE["summary_view"] = """
SELECT c_custkey, c_name, c_mktsegment, c_nationkey FROM customer WHERE c_acctbal >= 0
"""

ORACLE["append_rows"] = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
UNION ALL SELECT CAST(1000000001 AS BIGINT), 'Customer#new1', 3, CAST(10.5 AS DOUBLE), 'BUILDING'
UNION ALL SELECT CAST(1000000002 AS BIGINT), 'Customer#new2', 7, CAST(0.0 AS DOUBLE), 'UNASSIGNED'
"""

ORACLE["insert_if_absent"] = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
UNION ALL
SELECT s.s_suppkey * 20, s.s_name, s.s_nationkey, s.s_acctbal, 'SUPPLIER' FROM supplier s
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = s.s_suppkey * 20)
"""

ORACLE["snapshot_full_manifest"] = """
SELECT 'customer' AS table_name, count(*) AS n_rows, 5 AS n_cols, 'SUCCESS' AS status FROM customer
UNION ALL SELECT 'orders', count(*), 6, 'SUCCESS' FROM orders
UNION ALL SELECT 'lineitem', count(*), 11, 'SUCCESS' FROM lineitem
UNION ALL SELECT 'part', count(*), 6, 'SUCCESS' FROM part
UNION ALL SELECT 'supplier', count(*), 4, 'SUCCESS' FROM supplier
"""

ORACLE["snapshot_diff"] = f"""
WITH {CHANGED_ORDERS}
SELECT change_kind, count(*) AS n FROM (
  SELECT CASE WHEN b.o_orderkey IS NULL THEN 'INSERT'
              WHEN c.o_orderkey IS NULL THEN 'DELETE'
              WHEN c.o_custkey IS DISTINCT FROM b.o_custkey OR c.o_orderstatus IS DISTINCT FROM b.o_orderstatus
                OR c.o_totalprice IS DISTINCT FROM b.o_totalprice OR c.o_orderdate IS DISTINCT FROM b.o_orderdate
                OR c.o_orderpriority IS DISTINCT FROM b.o_orderpriority THEN 'UPDATE' END AS change_kind
  FROM cur c FULL OUTER JOIN orders b ON c.o_orderkey = b.o_orderkey
) WHERE change_kind IS NOT NULL GROUP BY change_kind
"""

ORACLE["snapshot_chain_restore"] = f"""
WITH {CHANGED_ORDERS}
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN '4-NOT SPECIFIED' ELSE o_orderpriority END AS o_orderpriority
FROM cur WHERE NOT (o_orderkey < 0 AND o_totalprice < 100000)
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'P' AND o_totalprice > 200000
"""

ORACLE["snapshot_bucket_diff"] = """
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 'F' END AS o_orderstatus,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'DELETE' ELSE 'UPDATE' END AS change_kind, 'SUCCESS' AS run_status
FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 499000
"""

ORACLE["snapshot_failed_log"] = """
SELECT 'plain' AS db, 'FULL' AS kind, 'SUCCESS' AS status, CAST(NULL AS BOOLEAN) AS told
UNION ALL
SELECT 'strict', 'FULL', CASE WHEN n > 0 THEN 'FAILED' ELSE 'SUCCESS' END, CASE WHEN n > 0 THEN true END
FROM (SELECT count(*) FILTER (o_orderstatus = 'P') AS n FROM orders)
"""

ORACLE["format_timestamps"] = """
SELECT o_orderkey,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS fmt120,
       strftime(o_orderdate, '%Y%m%d') AS fmt112,
       strftime(o_orderdate, '%H:%M:%S') AS fmt108,
       '/backups/academy_FULL_' || strftime(o_orderdate, '%Y%m%d') || '_'
         || replace(strftime(o_orderdate, '%H:%M:%S'), ':', '') || '.bak' AS snap_path
FROM orders
"""

ORACLE["in_list_filter"] = """
SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') ORDER BY o_orderpriority, o_orderkey
"""

ORACLE["like_patterns"] = """
SELECT p_partkey, p_name, p_name LIKE 'red%' AS starts_red, p_name LIKE '%ring%' AS has_ring,
       p_name LIKE '%bolt' AS ends_bolt
FROM part
"""

ORACLE["like_char_class"] = """
WITH g AS (
  SELECT o_orderkey, o_orderpriority,
         CAST(year(o_orderdate) AS VARCHAR) || 'S' || CASE WHEN month(o_orderdate) <= 6 THEN '1' ELSE '2' END AS good
  FROM orders
), p AS (
  SELECT o_orderkey,
         rpad(CASE WHEN o_orderpriority = '5-LOW' THEN substring(good, 2, 5)
                   WHEN o_orderpriority = '4-NOT SPECIFIED' THEN substring(good, 1, 5) || '3'
                   ELSE good END, 6, ' ') AS periodo
  FROM g
)
SELECT o_orderkey, periodo, regexp_full_match(rtrim(periodo), '[12][0-9][0-9][0-9][S][12]') AS valid FROM p
"""

ORACLE["case_labels"] = """
SELECT o_orderkey,
       CASE o_orderstatus WHEN 'F' THEN 'Finalizado' WHEN 'O' THEN 'Abierto' ELSE 'Otro' END AS status_label,
       CASE WHEN o_totalprice >= 300000 THEN 'alto' WHEN o_totalprice >= 100000 THEN 'medio' ELSE 'bajo' END AS price_band,
       CASE WHEN o_orderpriority LIKE '%LOW' THEN 'OK' ELSE 'INVALID' END AS prio_format
FROM orders
"""

ORACLE["exists_flag"] = """
SELECT c.c_custkey,
       EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F') AS has_finished_order
FROM customer c
"""

ORACLE["child_count"] = """
SELECT c.c_custkey,
       (SELECT count(*) FROM orders o WHERE o.o_custkey = c.c_custkey
          AND o.o_orderdate >= TIMESTAMP '1998-01-01 00:00:00') AS n_orders
FROM customer c
"""

ORACLE["scalar_lookup"] = """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey = (SELECT c_custkey FROM customer WHERE c_name = 'Customer#000000007')
"""

ORACLE["inner_join"] = """
SELECT c.c_custkey, c.c_name, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

ORACLE["enrollment_detail"] = """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, o.o_custkey, p.p_name, l.l_quantity, o.o_orderdate
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
ORDER BY o.o_orderdate DESC, l.l_orderkey, l.l_linenumber, l.l_partkey
"""

ORACLE["left_join_default"] = """
SELECT c.c_custkey, coalesce(n.n_name, 'OTHER') AS nation_label
FROM customer c LEFT JOIN (SELECT * FROM nation WHERE n_regionkey = 1) n ON c.c_nationkey = n.n_nationkey
"""

ORACLE["count_where"] = """
SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 100000
"""

ORACLE["enrollments_per_course"] = """
SELECT l_partkey, count(*) AS total FROM lineitem GROUP BY l_partkey
"""

ORACLE["count_distinct_roles"] = """
SELECT count(DISTINCT c.c_nationkey) AS n_nations
FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey WHERE o.o_orderstatus = 'F'
"""

ORACLE["global_row_number"] = """
SELECT p_partkey, p_retailprice, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part
"""

ORACLE["latest_accesses"] = f"""
WITH {LOG_CTE}
SELECT usuario, action, table_name, subject, event_at FROM alog ORDER BY event_at DESC, seq DESC LIMIT 1000
"""

ORACLE["latest_accesses_filtered"] = f"""
WITH {LOG_CTE},
top AS (SELECT * FROM alog ORDER BY event_at DESC, seq DESC LIMIT 1000)
SELECT usuario, action, subject, event_at FROM top WHERE action = 'error' ORDER BY event_at DESC, seq DESC LIMIT 10
"""

ORACLE["union_all_totals"] = """
SELECT 'customer' AS object_type, count(*) AS n FROM customer
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'part', count(*) FROM part
UNION ALL SELECT 'supplier', count(*) FROM supplier
"""

ORACLE["full_name"] = """
SELECT c_custkey, (CASE WHEN c_acctbal >= 0 THEN c_mktsegment END) || ' ' || c_name AS full_name FROM customer
"""

ORACLE["update_where"] = """
SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' AND p_size < 10 THEN p_size + 1 ELSE p_size END AS p_size FROM part
"""

ORACLE["guarded_update"] = """
WITH m AS (SELECT count(*) AS n FROM part WHERE p_name LIKE '%red%')
SELECT p_partkey,
       CASE WHEN p_name LIKE '%red%' AND (SELECT n FROM m) <= 1000000000
            THEN p_size + CAST(ceil(p_size * 0.03) AS INTEGER) ELSE p_size END AS size_guard_pass,
       CASE WHEN p_name LIKE '%red%' AND (SELECT n FROM m) <= 10
            THEN p_size + CAST(ceil(p_size * 0.03) AS INTEGER) ELSE p_size END AS size_guard_block
FROM part
"""

ORACLE["staged_update"] = """
SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN p_size + 1 ELSE p_size END AS p_size FROM part
"""

ORACLE["delete_where"] = """
SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT coalesce(o_orderstatus = 'P', false)
"""

ORACLE["delete_by_subquery"] = """
SELECT o_orderkey, o_custkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_mktsegment = 'AUTOMOBILE' AND c.c_custkey = o.o_custkey)
"""

ORACLE["fk_cascade_delete"] = """
WITH gone_c AS (SELECT c_custkey FROM customer WHERE c_nationkey = 3),
gone_o AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM gone_c))
SELECT 'customer' AS table_name, count(*) AS n_rows FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM gone_c)
UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM gone_o)
UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM gone_o)
"""

ORACLE["fk_set_null"] = """
SELECT c_custkey, CASE WHEN c_nationkey IN (0, 1, 2) THEN NULL ELSE c_nationkey END AS c_nationkey FROM customer
"""

ORACLE["fk_restrict"] = """
SELECT p.p_partkey, count(*) AS n_blocking
FROM part p JOIN lineitem l ON l.l_partkey = p.p_partkey WHERE p.p_size > 45 GROUP BY p.p_partkey
"""

ORACLE["pk_violations"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n,
       CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 'NULL_KEY' ELSE 'DUPLICATE' END AS reason
FROM lineitem GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL
"""

ORACLE["unique_violations"] = """
SELECT c_nationkey, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS c_mktsegment, count(*) AS n
FROM customer GROUP BY 1, 2 HAVING count(*) > 1
"""

ORACLE["fk_violations"] = """
SELECT o_orderkey, o_custkey FROM orders o
WHERE o_custkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_acctbal >= 0 AND c.c_custkey = o.o_custkey)
"""

ORACLE["check_violations"] = """
SELECT rule, count(*) AS n FROM (
  SELECT 'qty_range' AS rule FROM lineitem WHERE NOT (l_quantity BETWEEN 1 AND 40)
  UNION ALL SELECT 'max_discount' FROM lineitem WHERE NOT (l_discount <= 0.08)
  UNION ALL SELECT 'flag_pattern' FROM lineitem WHERE NOT regexp_full_match(l_returnflag, '[AN]')
) GROUP BY rule
"""

ORACLE["domain_violations"] = """
SELECT rule, count(*) AS n FROM (
  SELECT 'p_name:not_null' AS rule FROM part WHERE p_name IS NULL
  UNION ALL SELECT 'p_name:max_len_9' FROM part WHERE NOT (length(p_name) <= 9)
  UNION ALL SELECT 'size_units:range_0_255' FROM part WHERE NOT (p_size * 10 BETWEEN 0 AND 255)
) GROUP BY rule
"""

ORACLE["apply_defaults"] = """
SELECT event_id, ts, user_id, event_type, CAST(0.0 AS DOUBLE) AS value, '{}' AS props FROM events
"""

ORACLE["validated_append"] = """
WITH cand AS (
  SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey ELSE -1 - o_orderkey END AS o_orderkey,
         CASE WHEN o_orderpriority = '2-HIGH' THEN o_custkey + 1000000000 ELSE o_custkey END AS o_custkey,
         CASE WHEN o_orderpriority = '5-LOW' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice
  FROM orders
), bn AS (SELECT o_orderkey, count(*) AS n FROM cand GROUP BY o_orderkey),
tagged AS (
  SELECT concat_ws(',',
           CASE WHEN NOT coalesce(c.o_totalprice >= 0, true) THEN 'check:price_nonneg' END,
           CASE WHEN c.o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer x WHERE x.c_custkey = c.o_custkey)
                THEN 'fk:customer' END,
           CASE WHEN c.o_orderkey IS NOT NULL AND (SELECT n FROM bn WHERE bn.o_orderkey = c.o_orderkey) > 1
                THEN 'pk:duplicate_in_batch' END,
           CASE WHEN EXISTS (SELECT 1 FROM orders t WHERE t.o_orderkey = c.o_orderkey) THEN 'pk:exists' END,
           CASE WHEN c.o_orderkey IS NULL THEN 'pk:null' END) AS rules
  FROM cand c
)
SELECT CASE WHEN rules = '' THEN 'ACCEPTED' ELSE 'REJECTED' END AS outcome, rules, count(*) AS n
FROM tagged GROUP BY 1, 2
"""

ORACLE["assign_ids"] = """
SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) + 999 AS new_id FROM customer
"""

ORACLE["evolve_schema"] = """
SELECT s_suppkey AS supplier_key, s_name AS supplier_name, s_nationkey, s_acctbal,
       s_name || ' / ' || CAST(s_nationkey AS VARCHAR) AS s_label, 'ACTIVE' AS status
FROM supplier
"""

ORACLE["extract_dimension"] = """
SELECT c_custkey, c_name, c_acctbal, dense_rank() OVER (ORDER BY c_mktsegment, c_nationkey) AS contact_id FROM customer
"""

ORACLE["nm_attribute_join"] = """
SELECT DISTINCT c.c_custkey, p.p_brand
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
JOIN customer c ON c.c_custkey = o.o_custkey
"""

ORACLE["nm_attribute_explode"] = """
SELECT DISTINCT p_partkey, word FROM (
  SELECT p_partkey, trim(unnest(string_split(p_name, ' '))) AS word FROM part
) WHERE length(word) > 0
"""

ORACLE["session_state"] = f"""
WITH {SESSIONS_CTE}
SELECT usuario, subject, active, started_at, expires_at FROM sessions
"""

# Applying the events in two overlapping batches gives what applying them at once gives.
ORACLE["session_merge"] = ORACLE["session_state"]

ORACLE["session_log"] = f"""
WITH {SESSIONS_CTE}
SELECT usuario, kind AS action, 'SesionAlumno' AS table_name,
       CASE kind WHEN 'LOGIN' THEN subject END AS subject, event_at, seq
FROM ev WHERE event_at >= TIMESTAMP '2024-01-14 00:00:00' AND (kind = 'LOGOUT' OR subject IN (SELECT c_custkey FROM customer))
"""

ORACLE["session_rejected"] = f"""
WITH {SESSIONS_CTE}
SELECT usuario, subject, event_at, seq, 'unknown subject' AS reason
FROM ev WHERE kind = 'LOGIN' AND subject NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey % 3 <> 0)
"""

ORACLE["null_test"] = """
SELECT c_nationkey, count(*) FILTER (NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)) AS n_without,
       count(*) FILTER (EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)) AS n_with
FROM customer GROUP BY c_nationkey
"""

ORACLE["rls_admin"] = "SELECT c_custkey, c_name FROM customer"

ORACLE["policy_update"] = f"""
WITH {SESSIONS_CTE}
SELECT o_orderkey, o_custkey, o_totalprice,
       CASE WHEN o_orderstatus <> 'P' AND o_totalprice >= 1000 AND o_custkey IN (SELECT subject FROM allowed) THEN 'X' ELSE o_orderstatus END AS o_orderstatus
FROM orders
"""

ORACLE["policy_delete"] = f"""
WITH {SESSIONS_CTE}
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE NOT coalesce(o_totalprice >= 1000 AND o_custkey IN (SELECT subject FROM allowed), false)
"""

ORACLE["policy_listing"] = """
SELECT r_name AS policy, r_regionkey % 2 = 0 AS is_enabled, n_name AS target, 'fn_' || n_name AS predicate
FROM nation JOIN region ON r_regionkey = n_regionkey
"""

ORACLE["fk_end_of_statement"] = """
WITH c AS (SELECT c_custkey FROM customer WHERE c_nationkey = 3),
o AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c)),
l AS (SELECT l_suppkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM o))
SELECT 'nation' AS what, count(*) AS n_rows FROM nation WHERE n_nationkey <> 3
UNION ALL SELECT 'supplier', count(*) FROM supplier WHERE s_nationkey <> 3
UNION ALL SELECT 'customer', count(*) FROM customer WHERE c_nationkey <> 3
UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM o)
UNION ALL SELECT 'lineitem', count(*) FROM l
UNION ALL SELECT 'blocking', count(*) FROM l WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey = 3)
"""

ORACLE["fk_update_key"] = """
SELECT 'lineitem' AS child_table, '{"l_partkey":' || l_partkey || '}' AS child_key, count(*) AS n
FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 45) GROUP BY l_partkey
"""

ORACLE["audit_summary_prefix"] = """
SELECT 'u' || user_id AS usuario, event_type AS action, count(*) AS n_events, min(ts) AS first_at, max(ts) AS last_at
FROM events WHERE starts_with('u' || user_id, 'u1') GROUP BY 1, 2
"""

ORACLE["purge_expired"] = f"""
WITH {SESSIONS_CTE}
SELECT usuario, subject, active, started_at, expires_at FROM sessions
WHERE NOT coalesce(NOT active AND expires_at < {AS_OF} - INTERVAL 1 DAY, false)
"""

ORACLE["rls_session_filter"] = f"""
WITH {SESSIONS_CTE}
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT subject FROM allowed)
"""

ORACLE["rls_child_table"] = f"""
WITH {SESSIONS_CTE}
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT subject FROM allowed)
"""

ORACLE["rls_flag_filter"] = """
SELECT c_custkey FROM customer WHERE c_acctbal >= 0
"""

ORACLE["rls_view_inherits"] = f"""
WITH {SESSIONS_CTE}
SELECT c_custkey, c_name, c_mktsegment, c_nationkey FROM customer
WHERE c_custkey IN (SELECT subject FROM allowed) AND c_acctbal >= 0
"""

ORACLE["policy_probe"] = f"""
WITH {SESSIONS_CTE}
SELECT c_custkey, c_custkey IN (SELECT subject FROM allowed) AS allowed FROM customer
"""

ORACLE["rls_all_principals"] = f"""
WITH {SESSIONS_CTE}
SELECT u.usuario, u.subject, (SELECT count(*) FROM orders o WHERE o.o_custkey = u.subject) AS n_visible FROM usable u
"""

ORACLE["rls_policy_bitmaps"] = f"""
WITH {SESSIONS_CTE}
SELECT u.usuario, u.subject, count(o.o_orderkey) AS n_session, count(*) FILTER (o.o_totalprice >= 150000) AS n_dear,
       count(*) FILTER (o.o_orderstatus = 'O') AS n_open, count(*) FILTER (o.o_totalprice >= 150000 AND o.o_orderstatus = 'O') AS n_both
FROM usable u LEFT JOIN orders o ON o.o_custkey = u.subject GROUP BY u.usuario, u.subject
"""

ORACLE["active_sessions"] = f"""
WITH {SESSIONS_CTE}
SELECT s.usuario, s.subject, c.c_name || ' ' || c.c_mktsegment AS full_name, s.started_at,
       date_diff('minute', s.started_at, {AS_OF}) AS minutes_open, s.expires_at
FROM sessions s JOIN customer c ON c.c_custkey = s.subject WHERE s.active
"""

ORACLE["audit_report_24h"] = f"""
WITH {LOG_CTE}
SELECT seq, event_at, usuario, action, CASE success WHEN true THEN 'SÍ' ELSE 'NO' END AS exito, detail
FROM alog WHERE event_at >= {AS_OF} - INTERVAL 24 HOUR
"""

ORACLE["audit_top_detail"] = f"""
WITH {LOG_CTE}
SELECT event_at, action, CASE WHEN action = 'error' THEN detail ELSE usuario END AS detalle,
       CASE success WHEN true THEN 'ÉXITO' ELSE 'FALLO' END AS estado
FROM alog WHERE event_at >= {AS_OF} - INTERVAL 24 HOUR ORDER BY event_at DESC, seq DESC LIMIT 3
"""

ORACLE["audit_action_summary"] = """
SELECT user_id, event_type, count(*) AS n_events, min(ts) AS first_at, max(ts) AS last_at
FROM events GROUP BY user_id, event_type
"""

ACL_CTE = """
principals AS (
  SELECT s_suppkey AS principal_id, s_name AS name, 'S' AS type, 'SQL_USER' AS type_desc FROM supplier
  UNION ALL
  SELECT -1 - CAST(n_nationkey AS BIGINT), n_name, 'R', 'DATABASE_ROLE' FROM nation
),
members AS (SELECT s_suppkey AS member_id, -1 - CAST(s_nationkey AS BIGINT) AS role_id FROM supplier),
perms AS (
  SELECT l_suppkey AS grantee_id, l_partkey AS object_id, 'OBJECT_OR_COLUMN' AS class_desc,
         CASE WHEN l_linestatus = 'O' THEN 'SELECT' ELSE 'UPDATE' END AS permission,
         CASE WHEN l_returnflag = 'R' THEN 'DENY' ELSE 'GRANT' END AS state
  FROM lineitem
  UNION ALL
  SELECT DISTINCT -1 - CAST(s.s_nationkey AS BIGINT), l.l_partkey, 'OBJECT_OR_COLUMN', 'SELECT', 'GRANT'
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
objs AS (SELECT p_partkey AS object_id, p_name AS object_name, p_brand AS schema_name FROM part)
"""

# From the operator's contract: every watched principal with each of its grants, once per role it has;
# those without a grant or a role still appear once.
ORACLE["permission_audit"] = f"""
WITH {ACL_CTE},
watched AS (
  SELECT principal_id, name, type_desc, coalesce(roles, [NULL]) AS roles
  FROM principals ANTI JOIN (SELECT unnest(['dbo', 'guest', 'INFORMATION_SCHEMA', 'sys', 'Supplier#000000000']) AS name) hidden USING (name)
  LEFT JOIN (
    SELECT member_id AS principal_id, list(names.name) AS roles
    FROM members JOIN (SELECT principal_id AS role_id, name FROM principals) names USING (role_id) GROUP BY member_id
  ) USING (principal_id)
  WHERE list_contains(['S', 'U', 'R'], type)
),
held AS (SELECT grantee_id AS principal_id, object_name, permission, state FROM perms LEFT JOIN objs USING (object_id)),
listed AS (
  SELECT name, type_desc, roles, object_name, permission, state FROM held JOIN watched USING (principal_id)
  UNION ALL
  SELECT name, type_desc, roles, NULL, NULL, NULL FROM watched ANTI JOIN held USING (principal_id)
)
SELECT name AS usuario, type_desc AS tipo_usuario, unnest(roles) AS rol, object_name AS objeto, permission AS permiso, state AS estado FROM listed
"""

ORACLE["role_permissions"] = f"""
WITH {ACL_CTE},
held AS (SELECT * FROM perms WHERE grantee_id = (SELECT min(principal_id) FROM principals WHERE name = 'NATION_3'))
SELECT 'NATION_3' AS rol, class_desc AS clase, schema_name AS esquema, object_name AS objeto, permission AS permiso, state AS estado
FROM held LEFT JOIN objs USING (object_id)
"""

ORACLE["effective_permissions"] = """
WITH g0 AS (
  SELECT 'U:' || CAST(l_suppkey AS VARCHAR) AS grantee, 'OBJECT' AS level, CAST(l_partkey AS VARCHAR) AS securable,
         'SELECT' AS permission, CASE WHEN l_returnflag = 'R' THEN 'DENY' ELSE 'GRANT' END AS state
  FROM lineitem
  UNION ALL
  SELECT * FROM (VALUES ('R:1', 'SCOPE', 'Brand#1', 'SELECT', 'DENY'), ('R:2', 'SCOPE', 'Brand#2', 'SELECT', 'GRANT'),
                        ('R:3', 'SCOPE', 'Brand#3', 'SELECT', 'DENY'), ('R:4', 'SCOPE', 'Brand#4', 'SELECT', 'GRANT'))
         AS v(grantee, level, securable, permission, state)
), g AS (
  SELECT * FROM g0
  WHERE NOT (grantee = 'R:2' AND level = 'SCOPE' AND securable = 'Brand#2' AND permission = 'SELECT')
), req AS (
  SELECT DISTINCT l.l_suppkey AS user_id, l.l_partkey AS object_id, 'SELECT' AS permission FROM lineitem l
), rq AS (
  SELECT r.user_id, r.object_id, r.permission, s.s_nationkey AS role_id, p.p_brand AS scope
  FROM req r LEFT JOIN supplier s ON s.s_suppkey = r.user_id LEFT JOIN part p ON p.p_partkey = r.object_id
), lk AS (
  SELECT user_id, object_id, permission, 'U:' || CAST(user_id AS VARCHAR) AS grantee, 'OBJECT' AS level,
         CAST(object_id AS VARCHAR) AS securable FROM rq
  UNION ALL
  SELECT user_id, object_id, permission, 'U:' || CAST(user_id AS VARCHAR), 'SCOPE', scope FROM rq
  UNION ALL
  SELECT user_id, object_id, permission, 'R:' || CAST(role_id AS VARCHAR), 'OBJECT', CAST(object_id AS VARCHAR)
  FROM rq WHERE role_id IS NOT NULL
  UNION ALL
  SELECT user_id, object_id, permission, 'R:' || CAST(role_id AS VARCHAR), 'SCOPE', scope FROM rq WHERE role_id IS NOT NULL
)
SELECT lk.user_id, lk.object_id, lk.permission,
       CASE WHEN bool_or(g.state = 'DENY') THEN 'DENY' WHEN bool_or(g.state = 'GRANT') THEN 'GRANT' ELSE 'NONE' END AS effective
FROM lk LEFT JOIN g ON g.grantee = lk.grantee AND g.level = lk.level AND g.securable = lk.securable
                    AND g.permission = lk.permission
GROUP BY lk.user_id, lk.object_id, lk.permission
"""

ORACLE["effective_nested"] = """
WITH RECURSIVE edges AS (
  SELECT n_nationkey::BIGINT AS r, (100 + n_regionkey)::BIGINT AS p FROM nation
  UNION ALL SELECT (100 + r_regionkey)::BIGINT, 200::BIGINT FROM region
  UNION ALL SELECT * FROM (VALUES (200::BIGINT, 100::BIGINT), (200, 300)) v(r, p)
), reach(u, r) AS (
  SELECT s_suppkey, s_nationkey::BIGINT FROM supplier
  UNION SELECT u, p FROM reach JOIN edges USING (r)
), g(r, scope, state) AS (
  VALUES (100, 'Brand#5', 'GRANT'), (300, 'Brand#1', 'DENY'), (102, 'Brand#2', 'GRANT'), (103, 'Brand#5', 'DENY'),
         (7, 'Brand#1', 'GRANT'), (8, 'Brand#3', 'GRANT')
), req AS (SELECT DISTINCT l_suppkey AS u, l_partkey AS o FROM lineitem),
hit AS (
  SELECT req.u, req.o, state FROM req JOIN part ON p_partkey = o JOIN g ON g.scope = p_brand JOIN reach ON reach.u = req.u AND reach.r = g.r
)
SELECT req.u AS user_id, req.o AS object_id, 'SELECT' AS permission,
       CASE WHEN bool_or(state = 'DENY') THEN 'DENY' WHEN bool_or(state = 'GRANT') THEN 'GRANT' ELSE 'NONE' END AS effective
FROM req LEFT JOIN hit USING (u, o) GROUP BY req.u, req.o
"""

ORACLE["scd2_merge_runs"] = """
WITH cur AS (SELECT c_custkey, c_mktsegment, TIMESTAMP '1998-03-01 00:00:00' AS since FROM customer WHERE c_acctbal >= 0),
ch AS (
  SELECT o_custkey AS c_custkey, o_orderpriority AS c_mktsegment, o_orderdate::TIMESTAMP AS since, o_orderkey AS tie,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'D' ELSE 'U' END AS op,
         coalesce(o_orderdate::TIMESTAMP < (SELECT c.since FROM cur c WHERE c.c_custkey = o_custkey), false) AS late
  FROM orders
), run AS (
  SELECT c_custkey, c_mktsegment, since, 'U' AS op, 0 AS turn, NULL AS tie FROM cur
  UNION ALL SELECT c_custkey, c_mktsegment, since, op, 1, tie FROM ch WHERE NOT late
), led AS (SELECT *, lead(since) OVER (PARTITION BY c_custkey ORDER BY since, turn, tie) AS til FROM run)
SELECT c_custkey, c_mktsegment, since AS valid_from, coalesce(til, TIMESTAMP '9999-12-31 00:00:00') AS valid_to
FROM led WHERE op = 'U' AND (til IS NULL OR til > since)
UNION ALL
SELECT c_custkey, 'PROSPECT', TIMESTAMP '1997-01-01 00:00:00', TIMESTAMP '1998-03-01 00:00:00' FROM customer
UNION ALL
SELECT c_custkey, 'LATE ' || c_mktsegment, since, since FROM ch WHERE late
"""

ORACLE["validated_append_keys"] = """
WITH b AS (
  SELECT CASE WHEN o_orderpriority = '2-HIGH' THEN NULL WHEN o_orderpriority = '3-MEDIUM' THEN -1 - o_custkey ELSE -1000000000 - o_orderkey END AS k,
         CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END AS cust, o_orderpriority,
         CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderstatus = 'P' THEN o_orderdate ELSE o_orderdate + INTERVAL 100 YEAR END AS day
  FROM orders
), pairs AS (
  SELECT cust, day, count(*) AS n FROM (SELECT cust, day FROM b UNION ALL SELECT o_custkey, o_orderdate FROM orders) GROUP BY cust, day
), dup AS (SELECT k, count(*) AS n FROM b GROUP BY k)
SELECT o_orderpriority, concat_ws(',', CASE WHEN dup.n > 1 THEN 'pk:duplicate_in_batch' END, CASE WHEN EXISTS (SELECT 1 FROM orders t WHERE t.o_orderkey = b.k) THEN 'pk:exists' END,
         CASE WHEN b.k IS NULL THEN 'pk:null' END, CASE WHEN pairs.n > 1 THEN 'unique:cust_day' END) AS rules, count(*) AS n
FROM b LEFT JOIN dup ON dup.k = b.k JOIN pairs ON pairs.cust IS NOT DISTINCT FROM b.cust AND pairs.day IS NOT DISTINCT FROM b.day
GROUP BY 1, 2
"""

ORACLE["validated_append_filtered"] = """
WITH b AS (
  SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey ELSE -1 - o_orderkey END AS k,
         CASE WHEN o_orderpriority = '2-HIGH' THEN o_custkey + 1000000000 ELSE o_custkey END AS cust,
         CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_orderdate ELSE o_orderdate + INTERVAL 100 YEAR END AS day
  FROM orders WHERE o_totalprice > 499000 AND o_orderstatus <> 'P'
)
SELECT k AS o_orderkey, concat_ws(',', CASE WHEN NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = b.cust) THEN 'fk:customer' END,
         CASE WHEN (SELECT count(*) FROM b x WHERE x.k = b.k) > 1 THEN 'pk:duplicate_in_batch' END,
         CASE WHEN EXISTS (SELECT 1 FROM orders t WHERE t.o_orderkey = b.k) THEN 'pk:exists' END,
         CASE WHEN (SELECT count(*) FROM b x WHERE x.cust = b.cust AND x.day = b.day)
                 + (SELECT count(*) FROM orders t WHERE t.o_custkey = b.cust AND t.o_orderdate = b.day) > 1 THEN 'unique:cust_day' END) AS rules
FROM b
"""

ORACLE["archive_split"] = f"""
SELECT CAST(ts AS DATE) AS day, CASE WHEN ts < {AS_OF} - INTERVAL 20 DAY THEN 'ARCHIVE' ELSE 'KEEP' END AS bucket,
       count(*) AS n
FROM events GROUP BY 1, 2
"""

ORACLE["retention_by_day"] = """
SELECT CAST(ts AS DATE) AS day, CASE WHEN ts < TIMESTAMP '2024-01-11 06:30:00' THEN 'ARCHIVE' ELSE 'KEEP' END AS bucket, count(*) AS n,
       count(*) FILTER (CAST(ts AS DATE) = DATE '2024-01-11') AS n_rewritten
FROM events GROUP BY 1, 2
"""

ORACLE["snapshot_history"] = """
WITH runs AS (
  SELECT l.l_returnflag, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, o.o_orderdate, l.l_shipdate,
         date_diff('second', o.o_orderdate, l.l_shipdate) AS duration_s
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)
SELECT l_returnflag, l_orderkey, l_linenumber, o_orderdate, l_shipdate, duration_s FROM runs
QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY o_orderdate DESC, l_orderkey DESC, l_linenumber DESC,
                           l_partkey, l_suppkey, l_shipdate) <= 5
"""

ORACLE["quality_checklist"] = f"""
WITH {SESSIONS_CTE},
r AS (
  SELECT 'customers present' AS item, CASE WHEN n > 0 THEN '✓ OK' ELSE '⚠ ADVERTENCIA' END AS status,
         CAST(n AS VARCHAR) || ' customers' AS detail FROM (SELECT count(*) AS n FROM customer)
  UNION ALL
  SELECT 'order keys unique', CASE WHEN n = 0 THEN '✓ OK' ELSE '✗ FALLO' END, CAST(n AS VARCHAR) || ' bad keys'
  FROM (SELECT count(*) AS n FROM (SELECT o_orderkey FROM orders GROUP BY o_orderkey HAVING count(*) > 1 OR o_orderkey IS NULL))
  UNION ALL
  SELECT 'line keys unique', CASE WHEN n = 0 THEN '✓ OK' ELSE '✗ FALLO' END, CAST(n AS VARCHAR) || ' bad keys'
  FROM (SELECT count(*) AS n FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber
                                   HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL))
  UNION ALL
  SELECT 'orders have customer', CASE WHEN n = 0 THEN '✓ OK' ELSE '✗ FALLO' END, CAST(n AS VARCHAR) || ' orphans'
  FROM (SELECT count(*) AS n FROM orders o WHERE o_custkey IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey))
  UNION ALL
  SELECT 'sessions usable', CASE WHEN n >= 2 THEN '✓ OK' ELSE '✗ FALLO' END, CAST(n AS VARCHAR) || ' usable sessions'
  FROM (SELECT count(*) AS n FROM usable)
  UNION ALL
  SELECT 'event json valid', CASE WHEN n = 0 THEN '✓ OK' ELSE '✗ FALLO' END, CAST(n AS VARCHAR) || ' invalid'
  FROM (SELECT count(*) AS n FROM events WHERE props IS NOT NULL
          AND NOT (json_valid(props) AND substring(ltrim(props), 1, 1) IN ('{{', '[')))
  UNION ALL
  SELECT 'audit records', CASE WHEN n > 0 THEN '✓ OK' ELSE '⚠ ADVERTENCIA' END, CAST(n AS VARCHAR) || ' records'
  FROM (SELECT count(*) AS n FROM events)
  UNION ALL
  SELECT 'parts priced', CASE WHEN n = 0 THEN '✓ OK' ELSE '✗ FALLO' END, CAST(n AS VARCHAR) || ' unpriced'
  FROM (SELECT count(*) AS n FROM part WHERE p_retailprice <= 0)
)
SELECT row_number() OVER (ORDER BY CASE status WHEN '✗ FALLO' THEN 0 WHEN '⚠ ADVERTENCIA' THEN 1 ELSE 2 END, item) AS num,
       item, status, detail
FROM r
"""

ORACLE["json_validity"] = """
WITH p AS (
  SELECT event_id,
         CASE WHEN event_type = 'error' AND value > 40 THEN substring(props, 1, length(props) - 1)
              WHEN event_type = 'view' AND value > 40 THEN CAST(event_id AS VARCHAR)
              WHEN event_type = 'click' AND value > 100 THEN ''
              WHEN event_type = 'click' AND value > 60 THEN '{"k": 1, "k": ' || event_id || '}'
              WHEN event_type = 'signup' AND value > 60 THEN chr(10) || chr(9) || props
              WHEN event_type = 'signup' AND value > 30 THEN props || ' x'
              ELSE props END AS props
  FROM events
)
SELECT event_id, props,
       CASE WHEN props IS NULL THEN NULL
            ELSE CASE WHEN json_valid(props) THEN json_type(props) IN ('OBJECT', 'ARRAY') ELSE false END END AS is_valid
FROM p
"""

ORACLE["json_admission"] = """
WITH p AS (
  SELECT event_id,
         CASE WHEN event_type = 'error' AND value > 40 THEN substring(props, 1, length(props) - 1)
              WHEN event_type = 'view' AND value > 40 THEN CAST(event_id AS VARCHAR)
              WHEN event_type = 'click' AND value > 100 THEN ''
              WHEN event_type = 'click' AND value > 60 THEN '{"k": 1, "k": ' || event_id || '}'
              WHEN event_type = 'signup' AND value > 60 THEN chr(10) || chr(9) || props
              WHEN event_type = 'signup' AND value > 30 THEN props || ' x'
              ELSE props END AS props
  FROM events
)
SELECT event_id, props FROM p
WHERE props IS NOT NULL AND NOT (CASE WHEN json_valid(props) THEN json_type(props) IN ('OBJECT', 'ARRAY') ELSE false END)
"""

# The shaped documents are known, so the answer of each shape is written down; the others are flat.
ORACLE["json_extract"] = """
SELECT event_id,
       CASE WHEN event_type IN ('view', 'click') THEN NULL
            WHEN event_type = 'signup' AND value < 20 THEN NULL
            WHEN event_type = 'signup' AND value < 40 THEN event_id || '.50'
            WHEN event_type = 'signup' THEN '1' || repeat(event_id::VARCHAR, 9)
            ELSE json_extract_string(props, '$.k') END AS k,
       CASE WHEN event_type = 'signup' AND value >= 20 AND value < 40 THEN '1e2'
            WHEN event_type IN ('view', 'click', 'signup') THEN NULL
            ELSE json_extract_string(props, '$.origen') END AS origen
FROM events
"""

ORACLE["scd2_history"] = """
SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate AS valid_from,
       coalesce(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey),
                TIMESTAMP '9999-12-31 00:00:00') AS valid_to
FROM orders
"""

ORACLE["scd2_apply"] = f"""
WITH batch AS (
  SELECT c_custkey, CASE WHEN c_nationkey = 24 THEN 'D' ELSE 'U' END AS op, 'DELINQUENT' AS c_mktsegment
  FROM customer WHERE c_acctbal < 0 OR c_nationkey = 24
  UNION ALL
  SELECT s_suppkey + 1000000000, 'U', 'SUPPLIER' FROM supplier
)
SELECT c.c_custkey, c.c_mktsegment, TIMESTAMP '2024-01-01 00:00:00' AS valid_from, TIMESTAMP '9999-12-31 00:00:00' AS valid_to
FROM customer c WHERE c.c_custkey NOT IN (SELECT c_custkey FROM batch)
UNION ALL
SELECT b.c_custkey, b.c_mktsegment, {AS_OF}, TIMESTAMP '9999-12-31 00:00:00' FROM batch b WHERE b.op = 'U'
UNION ALL
SELECT c.c_custkey, c.c_mktsegment, TIMESTAMP '2024-01-01 00:00:00', {AS_OF}
FROM customer c WHERE c.c_custkey IN (SELECT c_custkey FROM batch)
"""

ORACLE["mv_incremental"] = """
SELECT l_partkey, total FROM (
  SELECT l_partkey,
         CAST(count(*) + sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)
              - sum(CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS total
  FROM lineitem GROUP BY l_partkey
) WHERE total > 0
"""

ORACLE["mv_change_feed"] = ORACLE["mv_incremental"]

ORACLE["objects_by_schema_type"] = """
SELECT p.p_brand, l.l_returnflag, count(*) AS n_objects
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1, 2 ORDER BY 1, 2
"""

ORACLE["dependency_impact"] = """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_partkey = 7)
"""

ORACLE["storage_stats"] = """
SELECT r.r_name, n.n_name, count(*) AS n_rows, CAST(sum(l.l_quantity) AS BIGINT) * 8 // 1024 AS size_units
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
GROUP BY r.r_name, n.n_name
"""

ORACLE["composite_key_join"] = """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, p.n_lines,
       CAST(l.l_quantity AS BIGINT) * 1000 // CAST(p.pair_qty AS BIGINT) AS qty_share_permille
FROM lineitem l
JOIN (SELECT l_partkey, l_suppkey, count(*) AS n_lines, sum(l_quantity) AS pair_qty FROM lineitem GROUP BY 1, 2) p
  ON l.l_partkey = p.l_partkey AND l.l_suppkey = p.l_suppkey
"""

ORACLE["audit_append"] = f"""
WITH pc AS (
  SELECT row_number() OVER (ORDER BY event_id) AS audit_id, {AS_OF} AS event_time,
         'PERMISSION_CHANGE' AS event_type, 'app_admin' AS login_name, 'app_admin' AS database_user,
         'events' AS object_name, 'SELECT' AS permission_type, value >= 50 AS success, CAST(NULL AS VARCHAR) AS details
  FROM events WHERE event_type = 'click'
), lf AS (
  SELECT coalesce((SELECT max(audit_id) FROM pc), 0) + row_number() OVER (ORDER BY ts, event_id) AS audit_id,
         ts AS event_time, 'LOGIN_FAILED' AS event_type, 'u' || CAST(user_id AS VARCHAR) AS login_name,
         'app_admin' AS database_user, CAST(NULL AS VARCHAR) AS object_name, CAST(NULL AS VARCHAR) AS permission_type,
         false AS success, props AS details
  FROM events WHERE event_type = 'error'
)
SELECT * FROM pc UNION ALL SELECT * FROM lf
"""
