"""DuckDB oracle SQL for the named queries (views: the driver tables)."""

from __future__ import annotations

from ledgerlake.functions.scalar import size_pretty_sql

ORACLE: dict[str, str] = {}

ORACLE["sales_report"] = """
SELECT p.p_name AS good_name,
       CAST(SUM(CAST(p.p_retailprice AS DECIMAL(12,2)) * CAST(l.l_quantity AS INTEGER)) AS DECIMAL(38,2)) AS sum_sale
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
GROUP BY p.p_name
"""

ORACLE["inner_on"] = """
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, c.c_custkey, c.c_name
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""

ORACLE["inner_natural"] = """
SELECT o_custkey, o_orderkey, o_orderstatus, c_name, c_mktsegment
FROM (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders) o
NATURAL JOIN (SELECT c_custkey AS o_custkey, c_name, c_mktsegment FROM customer) c
"""

ORACLE["inner_comma"] = """
SELECT o_orderkey, c_name, n_name FROM orders, customer, nation
WHERE o_custkey = c_custkey AND c_nationkey = n_nationkey
"""

ORACLE["semi_orders"] = """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders o
WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
"""

ORACLE["anti_orders"] = """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
"""

ORACLE["left_default"] = """
SELECT o.o_orderkey, COALESCE(strftime(l.last_ship, '%Y-%m-%d %H:%M:%S'), 'not shipped yet!') AS last_ship_text
FROM orders o LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey) l
  ON o.o_orderkey = l.l_orderkey
"""

ORACLE["null_after_left"] = """
SELECT o.o_orderkey, b.l_linenumber
FROM orders o LEFT JOIN (SELECT l_orderkey, l_linenumber,
                                CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS boarding_time
                         FROM lineitem) b ON o.o_orderkey = b.l_orderkey
WHERE o.o_orderstatus = 'P' AND b.boarding_time IS NULL
"""

ORACLE["right_join"] = """
SELECT n.n_name, r.r_name
FROM (SELECT * FROM nation WHERE n_name >= 'M') n RIGHT JOIN region r ON n.n_regionkey = r.r_regionkey
"""

ORACLE["cross_count"] = "SELECT count(*) AS n FROM customer CROSS JOIN nation"

ORACLE["full_compare"] = """
SELECT a.l_partkey AS a_l_partkey, b.l_partkey AS b_l_partkey
FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_suppkey = 1) a
FULL JOIN (SELECT DISTINCT l_partkey FROM lineitem WHERE l_suppkey = 2) b ON a.l_partkey = b.l_partkey
"""

ORACLE["lateral_lookup"] = """
SELECT o.o_orderkey, t.c_name, t.c_mktsegment
FROM orders o JOIN LATERAL (SELECT c_name, c_mktsegment FROM customer c WHERE c.c_custkey = o.o_custkey) t ON true
"""

ORACLE["boarding_call"] = """
SELECT t.c_custkey, t.c_name, s.l_orderkey, s.l_linenumber,
       COALESCE(strftime(bp.boarding_time, '%Y-%m-%d %H:%M:%S'), 'not boarded yet!') AS boarding
FROM orders f
JOIN lineitem s ON s.l_orderkey = f.o_orderkey
JOIN LATERAL (SELECT c_custkey, c_name FROM customer WHERE c_custkey = f.o_custkey) t ON true
LEFT JOIN (SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS boarding_time
           FROM lineitem WHERE l_returnflag = 'N') bp
  ON bp.l_orderkey = s.l_orderkey AND bp.l_linenumber = s.l_linenumber
WHERE f.o_orderstatus = 'P' AND bp.boarding_time IS NULL
ORDER BY f.o_orderdate DESC
"""

ORACLE["join_strategies"] = """
SELECT s.strategy, count(*) AS n,
       CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS revenue
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
CROSS JOIN (VALUES ('broadcast'), ('merge'), ('shuffle_hash')) s(strategy)
GROUP BY s.strategy
"""

ORACLE["point"] = "SELECT * FROM customer WHERE c_name = 'Customer#000000042'"
ORACLE["prefix"] = "SELECT * FROM customer WHERE c_name LIKE 'Customer#0000001%'"
ORACLE["infix"] = "SELECT doc_id, lang FROM documents WHERE text LIKE '%mentoi%'"
ORACLE["ci_match"] = "SELECT * FROM customer WHERE upper(c_name) = upper('customer#000000042')"
ORACLE["compound"] = """
SELECT * FROM orders WHERE o_orderstatus = 'F'
  AND o_orderdate > TIMESTAMP '1996-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1996-03-01 00:00:00'
"""
ORACLE["between_day"] = """
SELECT * FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-01-05 00:00:00'
"""
ORACLE["in_list"] = "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')"
ORACLE["regex_out"] = """
SELECT doc_id, source, lang FROM documents WHERE NOT regexp_matches(source, '^src1') AND lang <> 'en'
"""
ORACLE["distinct_status"] = "SELECT DISTINCT o_orderstatus FROM orders"
ORACLE["distinct_pairs"] = "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders"
ORACLE["top_orders"] = """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey LIMIT 10
"""
ORACLE["except_days"] = """
SELECT CAST(o_orderdate AS DATE) AS d FROM orders EXCEPT SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem
"""
ORACLE["minus_alias"] = """
SELECT o_custkey AS k FROM orders EXCEPT SELECT c_custkey AS k FROM customer WHERE c_mktsegment = 'BUILDING'
"""
ORACLE["bounds"] = "SELECT min(o_orderdate) AS min_o_orderdate, max(o_orderdate) AS max_o_orderdate FROM orders"
ORACLE["joined_length"] = """
SELECT CAST(length(string_agg(CAST(c_custkey AS VARCHAR) || c_name, ',')) AS BIGINT) AS joined_length FROM customer
"""


def _row_text_sql(cols):
    parts = []
    for c in cols:
        v = f"CAST({c} AS VARCHAR)"
        q = (f"CASE WHEN regexp_matches({v}, '(^$)|[\\s,()\"\\\\]') "
             f"THEN '\"' || replace(replace({v}, '\\\\', '\\\\\\\\'), '\"', '\"\"') || '\"' ELSE {v} END")
        parts.append(f"COALESCE({q}, '')")
    return "'(' || concat_ws(',', " + ", ".join(parts) + ") || ')'"


ORACLE["profile_rows"] = f"""
WITH c AS (SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, c_mktsegment
           FROM customer),
x AS (SELECT count(*) AS ct,
             CAST(sum(length({_row_text_sql(['c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment'])})) AS BIGINT) AS txt_len,
             CAST(sum(length(c_name)) AS BIGINT) AS name_bytes
      FROM c)
SELECT 'live_rows_in_text_representation' AS metric, txt_len AS bytes, {size_pretty_sql('txt_len')} AS bytes_pretty,
       CAST(txt_len // NULLIF(ct, 0) AS BIGINT) AS bytes_per_row FROM x
UNION ALL
SELECT 'name_bytes', name_bytes, {size_pretty_sql('name_bytes')}, CAST(name_bytes // NULLIF(ct, 0) AS BIGINT) FROM x
UNION ALL
SELECT 'row_count', ct, NULL, NULL FROM x
"""

ORACLE["cte_chain"] = """
WITH names AS (SELECT c_name, c_mktsegment FROM customer
               WHERE NOT regexp_matches(c_mktsegment, '^AUTO') AND c_mktsegment <> 'BUILDING')
SELECT c_mktsegment, count(*) AS n FROM names GROUP BY c_mktsegment
"""

ORACLE["size_pretty"] = f"""
SELECT o_orderkey, bytes, {size_pretty_sql('bytes')} AS pretty
FROM (SELECT o_orderkey, CAST(round(o_totalprice) AS BIGINT) * o_orderkey AS bytes FROM orders)
"""

ORACLE["day_trunc"] = """
SELECT CAST(date_trunc('day', o_orderdate) AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1
"""

ORACLE["case_nullif"] = """
WITH g AS (
  SELECT o_orderpriority,
         CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS finished,
         CAST(sum(CASE WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END) AS BIGINT) AS unfinished,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
  FROM orders GROUP BY o_orderpriority)
SELECT o_orderpriority, finished, unfinished, CAST((100 * finished) // (unfinished + 1) AS DOUBLE) AS pct,
       CAST(total / NULLIF(finished, 0) AS DECIMAL(18,2)) AS per_finished
FROM g
"""

ORACLE["series_md5"] = "SELECT o_orderkey AS i, md5(CAST(o_orderkey AS VARCHAR)) AS h FROM orders WHERE o_orderkey >= 1"

ORACLE["update_where"] = """
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderstatus = 'P' AND o_totalprice > 300000 THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice, o_orderdate,
       CASE WHEN o_orderstatus = 'P' AND o_totalprice > 300000 THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority
FROM orders
"""

ORACLE["bulk_rewrite"] = "SELECT o_orderkey, o_orderpriority || repeat('x', 20) AS o_orderpriority FROM orders"

ORACLE["update_from"] = """
SELECT o.o_orderkey, o.o_orderstatus, l.n AS n_lines, l.q AS total_qty
FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS q
                         FROM lineitem GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey
"""

ORACLE["delete_where"] = """
SELECT * FROM orders WHERE NOT COALESCE(o_orderpriority = '5-LOW' AND o_totalprice < 100000, false)
"""

ORACLE["merge_clauses"] = """
WITH t AS (SELECT c_custkey, c_name, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment
           FROM customer WHERE c_mktsegment <> 'BUILDING'),
s AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS delta, count(*) AS n
      FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)
SELECT COALESCE(t.c_custkey, s.o_custkey) AS c_custkey,
       CASE WHEN t.c_custkey IS NULL THEN 'new customer' ELSE t.c_name END AS c_name,
       CAST(CASE WHEN t.c_custkey IS NULL THEN s.delta WHEN s.o_custkey IS NULL THEN t.c_acctbal
                 ELSE t.c_acctbal + s.delta END AS DECIMAL(18,2)) AS c_acctbal,
       CASE WHEN t.c_custkey IS NULL THEN 'BUILDING' ELSE t.c_mktsegment END AS c_mktsegment
FROM t FULL JOIN s ON t.c_custkey = s.o_custkey
WHERE NOT (t.c_custkey IS NOT NULL AND s.o_custkey IS NOT NULL AND s.n >= 8)
"""

ORACLE["merge_files"] = ORACLE["merge_clauses"]
ORACLE["update_files"] = ORACLE["update_where"]
ORACLE["delete_files"] = ORACLE["delete_where"]
ORACLE["compound_zones"] = ORACLE["compound"]

ORACLE["copy_roundtrip"] = "SELECT * FROM customer"
ORACLE["export_restore"] = "SELECT * FROM customer"
ORACLE["checked_load"] = "SELECT * FROM customer"

ORACLE["table_diff"] = """
WITH a AS (SELECT * FROM orders),
b AS (SELECT o_orderkey, o_custkey,
             CASE WHEN o_orderstatus = 'P' AND o_totalprice > 300000 THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
             o_totalprice, o_orderdate,
             CASE WHEN o_orderstatus = 'P' AND o_totalprice > 300000 THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority
      FROM orders),
u AS (SELECT *, 1 AS na, 0 AS nb FROM a UNION ALL SELECT *, 0, 1 FROM b),
g AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
             sum(na) AS na, sum(nb) AS nb FROM u GROUP BY ALL)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CASE WHEN na > nb THEN 'a_only' ELSE 'b_only' END AS side, CAST(abs(na - nb) AS BIGINT) AS n
FROM g WHERE na <> nb
"""

ORACLE["rule_violations"] = """
SELECT l_orderkey, l_linenumber, 'quantity_positive' AS rule FROM lineitem WHERE NOT (l_quantity > 0)
UNION ALL SELECT l_orderkey, l_linenumber, 'discount_range' FROM lineitem WHERE NOT (l_discount BETWEEN 0.0 AND 0.1)
UNION ALL SELECT l_orderkey, l_linenumber, 'tax_not_above_discount' FROM lineitem WHERE NOT (l_tax <= l_discount)
UNION ALL SELECT l_orderkey, l_linenumber, 'flag_domain' FROM lineitem WHERE NOT (l_returnflag IN ('A', 'N', 'R'))
UNION ALL SELECT l_orderkey, l_linenumber, 'shipped_after_1996' FROM lineitem
          WHERE NOT (l_shipdate >= TIMESTAMP '1996-01-01 00:00:00')
"""

ORACLE["dup_keys"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
"""

ORACLE["fk_orphans"] = """
SELECT 'orders_customer' AS fk, o_orderkey AS k FROM orders o
WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
UNION ALL
SELECT 'orders_have_lines', o_orderkey FROM orders o
WHERE o_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
"""

ORACLE["migrate_enrich"] = """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, o.o_orderdate, o.o_custkey
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

ORACLE["upper_layout"] = "SELECT * FROM customer WHERE upper(c_name) = upper('customer#000000042')"
ORACLE["trigram_appended"] = """
SELECT pattern, doc_id FROM documents, (VALUES ('mentoi'), ('tion'), ('a b'), ('Ent'), ('zzyqx')) AS p(pattern)
WHERE contains(text, pattern)"""
ORACLE["trigram_find"] = "SELECT doc_id FROM documents WHERE text LIKE '%mentoi%'"

ORACLE["range_part"] = """
SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1996-04-01'
"""
ORACLE["default_part"] = """
SELECT * FROM orders WHERE NOT (o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '2000-01-01')
"""
ORACLE["pruned_read"] = """
SELECT * FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-03-15 00:00:00' AND TIMESTAMP '1996-05-10 12:00:00'
"""
ORACLE["moved_rows"] = """
WITH m AS (SELECT o_orderkey,
                  CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'
                       THEN o_orderdate + INTERVAL 400 DAY ELSE o_orderdate END AS o_orderdate
           FROM orders)
SELECT o_orderkey, o_orderdate,
       CASE WHEN o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'
            THEN 'p' || strftime(o_orderdate, '%Y_%m') ELSE 'p_default' END AS part
FROM m
"""
ORACLE["list_part"] = """
SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem WHERE l_returnflag = 'R'
"""
ORACLE["hash_part"] = "SELECT * FROM orders WHERE o_custkey = 42"

_MART_FINAL = """
WITH s AS (
  SELECT CASE WHEN l_linestatus = 'F' AND l_linenumber = 3 THEN l_suppkey ELSE l_partkey END AS good_id,
         CAST(l_quantity AS INTEGER) + CASE WHEN l_returnflag = 'A' AND l_linenumber = 2 THEN 1 ELSE 0 END AS qty
  FROM lineitem WHERE NOT (l_returnflag = 'R' AND l_linenumber = 4))
SELECT p_name AS good_name, CAST(sum(CAST(p_retailprice AS DECIMAL(12,2)) * qty) AS DECIMAL(38,2)) AS sum_sale
FROM s JOIN part ON p_partkey = good_id GROUP BY p_name
"""
ORACLE["mart_delta"] = _MART_FINAL
ORACLE["mart_exact"] = _MART_FINAL
ORACLE["mart_stream_exact"] = _MART_FINAL

ORACLE["mart_price_change"] = """
WITH RECURSIVE
li AS (
  SELECT *, (l_orderkey * 8 + l_linenumber) * 1024 + row_number() OVER (
           PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS pos
  FROM lineitem),
half AS (SELECT (max(l_orderkey) // 2) * 8192 AS h FROM lineitem),
prices AS (
  SELECT p_partkey AS good_id, p_name AS name, CAST(p_retailprice AS DECIMAL(12,2)) AS price,
         CAST(-4611686018427387904 AS BIGINT) AS valid_from,
         CASE WHEN p_size <= 10 THEN (SELECT h FROM half) END AS valid_to
  FROM part
  UNION ALL
  SELECT p_partkey, p_name, CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 20 AS DECIMAL(12,2)), (SELECT h FROM half), NULL
  FROM part WHERE p_size <= 10),
ev AS (
  SELECT l_partkey AS good_id, pos AS seq, 'ADD' AS kind, CAST(l_quantity AS INTEGER) AS qty FROM li
  UNION ALL
  SELECT l_partkey, 576460752303423488 + pos, 'DEL', CAST(l_quantity AS INTEGER) FROM li WHERE l_returnflag = 'R'),
st AS (
  SELECT p.name, e.seq AS o, e.kind, CAST(e.qty * p.price AS DECIMAL(38,2)) AS amt
  FROM ev e JOIN prices p ON p.good_id = e.good_id AND e.seq >= p.valid_from
                          AND (p.valid_to IS NULL OR e.seq < p.valid_to)),
num AS (SELECT name, row_number() OVER (PARTITION BY name ORDER BY o) AS i, kind, amt FROM st),
fold(name, i, s, present) AS (
  SELECT DISTINCT name, CAST(0 AS BIGINT), CAST(0 AS DECIMAL(38,2)), false FROM num
  UNION ALL
  SELECT f.name, f.i + 1,
         CAST(CASE WHEN n.kind = 'ADD' THEN f.s + n.amt
                   WHEN f.present AND f.s = n.amt THEN 0
                   WHEN f.present AND f.s > n.amt THEN f.s - n.amt
                   ELSE f.s END AS DECIMAL(38,2)),
         CASE WHEN n.kind = 'ADD' THEN true
              WHEN f.present AND f.s = n.amt THEN false
              ELSE f.present END
  FROM fold f JOIN num n ON n.name = f.name AND n.i = f.i + 1)
SELECT name AS good_name, s AS sum_sale
FROM (SELECT name, s, present, row_number() OVER (PARTITION BY name ORDER BY i DESC) AS rn FROM fold)
WHERE rn = 1 AND present
"""

_EVENT_LOG = """
ch AS (SELECT event_id AS seq, ts AS commit_ts, user_id AS account_id,
              CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op,
              CAST(value AS DECIMAL(12,2)) AS balance, event_type AS last_event FROM events {where})"""


def _replica(where="", base=True):
    base_sql = ("SELECT c_custkey AS account_id, CAST(c_acctbal AS DECIMAL(12,2)) AS balance, 'base' AS last_event "
                "FROM customer")
    out = f"""
WITH {_EVENT_LOG.format(where=where)},
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY seq DESC) AS rn FROM ch)
           WHERE rn = 1)
"""
    if base:
        out += f"""SELECT account_id, balance, last_event FROM ({base_sql}) b
WHERE account_id NOT IN (SELECT account_id FROM latest)
UNION ALL """
    return out + "SELECT account_id, balance, last_event FROM latest WHERE op <> 'D'"


ORACLE["replica_apply"] = _replica()
ORACLE["as_of_view"] = _replica("WHERE ts <= TIMESTAMP '2024-01-15 00:00:00'")
ORACLE["merged_replicas"] = (
    "SELECT 'node1' AS source, * FROM (" + _replica("WHERE event_type IN ('click', 'view')", False) + ")\n"
    "UNION ALL SELECT 'node2' AS source, * FROM ("
    + _replica("WHERE event_type NOT IN ('click', 'view')", False) + ")")

ORACLE["publish_diff"] = """
WITH b AS (SELECT user_id, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS total
           FROM events WHERE ts < TIMESTAMP '2024-01-20' AND event_type <> 'error' GROUP BY user_id),
a AS (SELECT user_id, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS total
      FROM events WHERE ts >= TIMESTAMP '2024-01-05' GROUP BY user_id)
SELECT CASE WHEN b.user_id IS NULL THEN 'I' WHEN a.user_id IS NULL THEN 'D' ELSE 'U' END AS op,
       COALESCE(b.user_id, a.user_id) AS user_id, b.n AS before_n, b.total AS before_total,
       a.n AS after_n, a.total AS after_total
FROM b FULL JOIN a ON a.user_id = b.user_id
WHERE b.user_id IS NULL OR a.user_id IS NULL OR b.n IS DISTINCT FROM a.n OR b.total IS DISTINCT FROM a.total
"""

ORACLE["churn"] = f"""
WITH {_EVENT_LOG.format(where="")},
latest AS (SELECT account_id, arg_max(op, seq) AS op FROM ch GROUP BY account_id),
x AS (SELECT (SELECT count(*) FROM ch) AS changes,
             (SELECT count(*) FROM ch WHERE op IN ('U', 'D')) AS dead,
             (SELECT count(*) FROM latest WHERE op <> 'D') AS live)
SELECT changes, dead, live, CAST((100 * dead) // (live + 1) AS DOUBLE) AS dead_pct FROM x
"""

ORACLE["ledger_balances"] = """
SELECT 'account' AS level, CAST(c_custkey AS VARCHAR) AS id,
       CAST(CAST(c_acctbal AS DECIMAL(12,2)) + COALESCE(h.d, 0) AS DECIMAL(38,2)) AS balance
FROM customer FULL JOIN (SELECT user_id, sum(CAST(value AS DECIMAL(12,2))) AS d FROM events GROUP BY user_id) h
  ON h.user_id = c_custkey
UNION ALL
SELECT 'teller', event_type, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DECIMAL(38,2)) FROM events GROUP BY event_type
UNION ALL
SELECT 'branch', CAST(CAST(ts AS DATE) AS VARCHAR), CAST(sum(CAST(value AS DECIMAL(12,2))) AS DECIMAL(38,2))
FROM events GROUP BY CAST(ts AS DATE)
"""

ORACLE["ledger_running"] = """
SELECT e.event_id, e.user_id,
       CAST(COALESCE(CAST(c.c_acctbal AS DECIMAL(12,2)), 0)
            + sum(CAST(e.value AS DECIMAL(12,2))) OVER (PARTITION BY e.user_id ORDER BY e.ts, e.event_id
                                                         ROWS UNBOUNDED PRECEDING) AS DECIMAL(38,2)) AS balance
FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id
"""

_VOLUME = f"""
m AS (SELECT date_trunc('minute', ts) AS sample_ts, CAST(sum(length(props)) * 8192 AS BIGINT) AS b
      FROM events GROUP BY 1),
c AS (SELECT sample_ts, CAST(sum(b) OVER (ORDER BY sample_ts ROWS UNBOUNDED PRECEDING) AS BIGINT) AS lsn FROM m),
l AS (SELECT sample_ts, printf('%X/%X', lsn >> 32, lsn & 4294967295) AS lsn_position,
             lsn - lag(lsn) OVER (ORDER BY sample_ts) AS wal_bytes_since_previous,
             date_diff('second', lag(sample_ts) OVER (ORDER BY sample_ts), sample_ts) AS seconds_since_previous
      FROM c),
v AS (SELECT sample_ts, lsn_position, wal_bytes_since_previous,
             {size_pretty_sql('wal_bytes_since_previous')} AS wal_size_since_previous,
             wal_bytes_since_previous // seconds_since_previous AS bytes_per_second,
             {size_pretty_sql('wal_bytes_since_previous // seconds_since_previous')} || '/s' AS rate_pretty,
             seconds_since_previous FROM l)"""

ORACLE["log_volume"] = f"WITH {_VOLUME} SELECT * FROM v"

ORACLE["log_summary"] = f"""
WITH {_VOLUME},
w("window", secs) AS (VALUES ('Last 5 minutes', 300), ('Last 10 minutes', 600), ('Last hour', 3600),
                           ('Last day', 86400)),
g AS (SELECT w."window", w.secs, count(v.sample_ts) AS samples, CAST(sum(v.wal_bytes_since_previous) AS BIGINT) AS total
      FROM w LEFT JOIN v ON date_diff('second', v.sample_ts, (SELECT max(sample_ts) FROM v)) < w.secs
      GROUP BY w."window", w.secs)
SELECT "window", samples, {size_pretty_sql('total')} AS total_wal_size,
       {size_pretty_sql('total // samples')} AS avg_wal_per_minute,
       {size_pretty_sql('total // secs')} || '/s' AS avg_rate
FROM g
"""

ORACLE["checkpoints"] = """
WITH c AS (SELECT date_trunc('millisecond', ts) AS ts, CAST(floor(value) AS BIGINT) AS buffers,
                  CAST(floor(value * 100) AS BIGINT) AS distance_kb
           FROM events WHERE event_type = 'purchase'),
l AS (SELECT *, epoch_ms(ts) - epoch_ms(lag(ts) OVER (ORDER BY ts, buffers, distance_kb)) AS ms_since_previous FROM c)
SELECT ts, buffers, distance_kb, ms_since_previous, ms_since_previous <= 1800000 AS on_schedule FROM l
"""

ORACLE["checkpoint_summary"] = f"""
WITH r AS ({ORACLE["checkpoints"]})
SELECT count(*) AS checkpoints, count(*) FILTER (WHERE on_schedule) AS on_schedule,
       CAST(sum(distance_kb) // count(distance_kb) AS BIGINT) AS mean_distance_kb FROM r
"""

ORACLE["lock_waits"] = """
SELECT event_id + 1000 AS pid,
       CASE WHEN event_id % 2 = 1 THEN 'ExclusiveLock' ELSE 'ShareLock' END AS mode,
       CASE WHEN event_id % 2 = 1 THEN 'tuple (0,' || (event_id % 100) || ') of relation 16388 of database 16385'
            ELSE 'transaction ' || (event_id + 4545000) END AS target,
       CASE WHEN event_id % 2 = 0 THEN event_id + 4545000 END AS trx,
       CAST(user_id + 1000 AS VARCHAR) || CASE WHEN event_id % 3 = 0 THEN ', 999' ELSE '' END AS holders,
       CAST(event_id + 1000 AS VARCHAR) AS queue,
       date_trunc('millisecond', ts) AS waiting_at,
       date_trunc('millisecond', ts) + to_milliseconds(CAST(floor(value * 1000) AS BIGINT)) AS acquired_at,
       CAST(floor(value * 1000) AS BIGINT) + 100 + CAST(0.250 AS DECIMAL(18,3)) AS wait_ms
FROM events WHERE event_type = 'error'
"""

ORACLE["chains"] = """
WITH RECURSIVE
e AS (SELECT event_id + 1000 AS pid, user_id, ts FROM events WHERE event_type = 'error'),
edges AS (SELECT pid, COALESCE(lag(pid) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, pid),
                               user_id + 100000) AS blocker FROM e),
r(pid, cur, depth, path) AS (
  SELECT pid, blocker, 1, pid || ' -> ' || blocker FROM edges
  UNION ALL
  SELECT r.pid, edges.blocker, r.depth + 1, r.path || ' -> ' || edges.blocker FROM r JOIN edges ON edges.pid = r.cur WHERE r.depth < 100000)
SELECT pid, cur AS root, CAST(depth AS INTEGER) AS min_depth, CAST(depth AS INTEGER) AS max_depth, path
FROM (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY depth DESC) AS rn FROM r) WHERE rn = 1
"""

ORACLE["load_report"] = """
WITH per AS (SELECT event_type AS run, sum(CAST(value AS DECIMAL(12,2))) AS tps
             FROM events GROUP BY event_type, floor(epoch(ts) / 3600)),
g AS (SELECT run, count(*) AS intervals, CAST(min(tps) AS DECIMAL(18,2)) AS min_tps,
             CAST(max(tps) AS DECIMAL(18,2)) AS max_tps, CAST(sum(tps * 100) AS BIGINT) // count(*) AS avg_tps_cents
      FROM per GROUP BY run)
SELECT run, intervals, min_tps, max_tps, avg_tps_cents,
       (avg_tps_cents * 1000) // (SELECT avg_tps_cents FROM g WHERE run = 'click') AS vs_baseline_permille
FROM g
"""

ORACLE["replica_stream"] = ORACLE["replica_apply"]
ORACLE["mart_stream"] = _MART_FINAL
ORACLE["mart_stream_state"] = _MART_FINAL
ORACLE["replica_batches"] = ORACLE["replica_apply"]
ORACLE["replica_keys"] = ("SELECT r.* FROM (" + ORACLE["replica_apply"] + ") r WHERE account_id IN "
                          "(SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
ORACLE["minute_stream"] = """
SELECT date_trunc('minute', ts) AS minute, count(*) AS events, CAST(sum(length(props)) AS BIGINT) AS bytes
FROM events GROUP BY 1
"""

_FOLD_SQL = ORACLE["mart_price_change"].strip()
ORACLE["mart_drift"] = _FOLD_SQL.replace("SELECT name AS good_name, s AS sum_sale\nFROM", """,
mart AS (SELECT name AS good_name, s AS sum_sale
FROM""", 1) + """),
report AS (
  SELECT p_name AS good_name,
         CAST(sum(CAST(CASE WHEN p_size <= 10 THEN CAST(p_retailprice AS DECIMAL(12,2)) * 20
                            ELSE CAST(p_retailprice AS DECIMAL(12,2)) END AS DECIMAL(12,2))
                  * CAST(l_quantity AS INTEGER)) AS DECIMAL(38,2)) AS sum_sale
  FROM lineitem JOIN part ON p_partkey = l_partkey
  WHERE l_returnflag <> 'R'
  GROUP BY p_name)
SELECT COALESCE(r.good_name, m.good_name) AS good_name, r.sum_sale AS report_sum, m.sum_sale AS mart_sum
FROM report r FULL JOIN mart m ON r.good_name = m.good_name
WHERE r.sum_sale IS DISTINCT FROM m.sum_sale
"""

ORACLE["fingerprints"] = """
WITH o AS (SELECT o_orderstatus, CAST(o_orderkey AS VARCHAR) AS a, CAST(o_custkey AS VARCHAR) AS b, o_orderpriority AS p,
                  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS t FROM orders),
h AS (SELECT o_orderstatus, md5(concat_ws(',', length(a) || ':' || a, length(b) || ':' || b, length(o_orderstatus) || ':' || o_orderstatus,
                                          length(p) || ':' || p, length(d) || ':' || d, length(t) || ':' || t)) AS h FROM o)
SELECT o_orderstatus, count(*) AS rows, CAST(sum(CAST(CAST('0x' || substr(h, 1, 15) AS BIGINT) AS HUGEINT)) AS DECIMAL(38,0)) AS fingerprint
FROM h GROUP BY o_orderstatus
"""

ORACLE["publish_apply"] = """
SELECT user_id, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS total
FROM events WHERE ts >= TIMESTAMP '2024-01-05' GROUP BY user_id
"""

_MIDDLE = "(SELECT (min(event_id) + max(event_id)) // 2 FROM events)"
ORACLE["replica_truncated"] = _replica(f"WHERE event_id > {_MIDDLE}", base=False)
ORACLE["changes_after"] = ORACLE["replica_truncated"]

ORACLE["replica_full"] = """
WITH ev AS (
  SELECT event_id, CASE WHEN event_type = 'signup' THEN 'I' WHEN event_type IN ('error', 'view') THEN 'D' ELSE 'U' END AS op,
         ['AUTOMOBILE', 'BUILDING', 'MACHINERY', 'nowhere'][user_id % 4 + 1] AS segment, CAST(event_id % 3 AS INTEGER) AS zone FROM events),
moves AS (
  SELECT event_id * 2 AS o, segment, zone, -1 AS n FROM ev WHERE op <> 'I'
  UNION ALL SELECT event_id * 2 + 1, CASE WHEN op = 'U' THEN 'moved' ELSE segment END, zone, 1 FROM ev WHERE op <> 'D'),
base AS (SELECT c_mktsegment AS segment, CAST(c_nationkey % 3 AS INTEGER) AS zone, count(*) AS c FROM customer GROUP BY ALL),
falls AS (SELECT segment, zone, sum(n) AS total, least(0, min(run)) AS low
          FROM (SELECT *, sum(n) OVER (PARTITION BY segment, zone ORDER BY o ROWS UNBOUNDED PRECEDING) AS run FROM moves) GROUP BY ALL),
ends AS (SELECT segment, zone, coalesce(c, 0) + coalesce(total, 0) - least(0, coalesce(c, 0) + coalesce(low, 0)) AS k
         FROM base FULL JOIN falls USING (segment, zone))
SELECT segment, zone FROM (SELECT segment, zone, unnest(range(CAST(k AS BIGINT))) FROM ends WHERE k > 0)
"""

ORACLE["zoned_read"] = """
WITH o AS (SELECT o_orderkey, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS placed_at FROM orders)
SELECT o_orderkey, placed_at, 'p' || strftime(placed_at + INTERVAL 3 HOUR, '%Y_%m_%d') AS part FROM o
WHERE placed_at BETWEEN TIMESTAMP '1996-01-14 20:30:00' AND TIMESTAMP '1996-01-16 22:00:00'
"""

ORACLE["insert_values"] = "SELECT * FROM region UNION ALL SELECT 100, 'NOWHERE' UNION ALL SELECT 101, NULL"
ORACLE["insert_select"] = """
SELECT l_orderkey, l_linenumber, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""
ORACLE["create_as"] = "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'"
ORACLE["table_reset"] = """
SELECT 'first' AS version, count(*) AS n FROM customer UNION ALL SELECT 'empty', 0
UNION ALL SELECT 'last', count(*) FROM customer WHERE c_acctbal > 0
"""
ORACLE["mart_start"] = ORACLE["sales_report"]
ORACLE["cascade"] = """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE l_orderkey IS NULL OR EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderpriority <> '5-LOW')
"""
ORACLE["semi_composite"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem l WHERE EXISTS (
  SELECT 1 FROM lineitem r WHERE r.l_returnflag = 'R' AND r.l_partkey = l.l_partkey AND r.l_suppkey = l.l_suppkey)
"""
ORACLE["anti_composite"] = ORACLE["semi_composite"].replace("WHERE EXISTS", "WHERE NOT EXISTS")
ORACLE["left_composite"] = """
SELECT l.l_orderkey, l.l_linenumber, coalesce(strftime(b.m, '%Y-%m-%d %H:%M:%S'), 'never returned') AS last_back_text
FROM lineitem l LEFT JOIN (SELECT l_partkey, l_suppkey, max(l_shipdate) AS m FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL) b
  ON b.l_partkey = l.l_partkey AND b.l_suppkey = l.l_suppkey
"""
ORACLE["backfill_checked"] = """
WITH d AS (SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem)
SELECT d.*, r.rule FROM d CROSS JOIN (VALUES ('lines_not_null'), ('lines_fk')) r(rule)
WHERE NOT EXISTS (SELECT 1 FROM lineitem f WHERE f.l_linestatus = 'F' AND f.l_partkey = d.l_partkey AND f.l_suppkey = d.l_suppkey)
"""
ORACLE["substring_first"] = """
SELECT substr(c_mktsegment, 1, 1) AS letter, substr(c_name, 1, 4) AS start, count(*) AS n FROM customer GROUP BY ALL
"""

ORACLE["tree_diff"] = ORACLE["table_diff"]
ORACLE["restore_catalog"] = """
SELECT n_name, r_name, 'nation,region' AS tables FROM nation JOIN region ON n_regionkey = r_regionkey
"""
ORACLE["bucketed_join"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS total_qty
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL
"""
ORACLE["log_records"] = """
WITH w AS (SELECT *, event_id + 1000 AS pid,
                  CASE WHEN event_id % 2 = 1 THEN 'ExclusiveLock on tuple (0,' || (event_id % 100) || ') of relation 16388 of database 16385'
                       ELSE 'ShareLock on transaction ' || (event_id + 4545000) END AS lock,
                  CAST(floor(value * 1000) AS BIGINT) AS more
           FROM events WHERE event_type = 'error')
SELECT date_trunc('millisecond', ts) AS ts, pid, 'LOG' AS level, 'process ' || pid || ' still waiting for ' || lock || ' after 100.000 ms' AS message,
       CASE WHEN event_id % 3 = 0 THEN 'Processes holding the lock: ' || (user_id + 1000) || ', 999. Wait queue: '
            ELSE 'Process holding the lock: ' || (user_id + 1000) || '. Wait queue: ' END || pid || '.' AS detail,
       'update accounts set n = n + 1' || chr(10) || chr(9) || 'where id = ' || user_id || ';' AS statement
FROM w
UNION ALL
SELECT date_trunc('millisecond', ts) + to_milliseconds(more), pid, 'LOG',
       'process ' || pid || ' acquired ' || lock || ' after ' || (more + 100) || '.250 ms', NULL, NULL
FROM w
"""
ORACLE["log_summary_at"] = ORACLE["log_summary"].replace(
    "date_diff('second', v.sample_ts, (SELECT max(sample_ts) FROM v)) < w.secs",
    "v.sample_ts <= TIMESTAMP '2024-01-15' AND date_diff('second', v.sample_ts, TIMESTAMP '2024-01-15') < w.secs")
ORACLE["subscribed_replicas"] = ORACLE["merged_replicas"]
# commit times grow with positions only in part: the last position of a time has earlier ones after it
ORACLE["as_of_archive"] = _replica("WHERE event_id <= (SELECT max(event_id) FROM events WHERE ts <= TIMESTAMP '2024-01-15 00:00:00')")
ORACLE["synth_rows"] = """
SELECT CAST(o_orderkey AS INTEGER) AS id, md5(CAST(o_orderkey AS VARCHAR)) AS random_text, o_custkey FROM orders WHERE o_orderkey >= 1
"""
ORACLE["views_sql"] = "SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"
ORACLE["read_sound"] = """
SELECT *, (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS lost FROM orders WHERE o_orderstatus <> 'P'
"""
