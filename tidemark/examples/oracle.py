"""The registered queries as plain SQL over the same tables, for checking."""

from __future__ import annotations

LT = """lt AS (
    SELECT o_orderkey AS orderkey, o_custkey AS ref, o_orderstatus AS status,
           o_totalprice AS amount, o_orderdate AS dt
    FROM orders)"""
LD = """ld AS (
    SELECT l_orderkey AS orderkey, l_partkey AS ref, l_returnflag AS status,
           l_extendedprice AS amount, l_shipdate AS dt
    FROM lineitem)"""
ET = """et AS (
    SELECT event_id, ts, NULLIF(event_type, 'error') AS k1, user_id AS k2, value FROM events)"""
ED = """ed AS (
    SELECT event_id, ts + INTERVAL 30 DAY AS ts, NULLIF(event_type, 'error') AS k1,
           user_id + 50 AS k2, value + 1 AS value
    FROM events)"""
LG = """lg AS (
    SELECT event_id AS entry_id, event_type AS object_name,
           CAST(user_id AS VARCHAR) AS invocation_id,
           CAST(1 + event_id % 2 AS BIGINT) AS status, ts AS created_at,
           CASE WHEN event_id % 2 = 1 AND event_id % 17 <> 0 THEN ts END AS extraction_to
    FROM events)"""
LEDGER = f"WITH {LT}, {LD}"
HISTORY = f"WITH {ET}, {ED}"
COLS = "orderkey, ref, status, amount, dt"


def start_of(grown_by: str | None = None) -> str:
    """Partition start of ``dt``: years from 1996, months from 2000 up to the
    end of 2000, or up to the month of the highest ``dt`` of a relation."""
    beyond = ""
    if grown_by:
        beyond = (
            f" WHEN date_trunc('month', dt) <= (SELECT max(dt) FROM {grown_by})"
            " THEN date_trunc('month', dt)"
        )
    return (
        "CASE WHEN dt < TIMESTAMP '1996-01-01' THEN NULL"
        " WHEN dt < TIMESTAMP '2000-01-01' THEN date_trunc('year', dt)"
        " WHEN dt < TIMESTAMP '2001-01-01' THEN date_trunc('month', dt)"
        f"{beyond} ELSE NULL END"
    )


def label(grown_by: str | None = None) -> str:
    return f"coalesce(strftime({start_of(grown_by)}, '%Y-%m-%d'), '__default__')"


def routed(target: str, delta: str) -> str:
    """Both relations with their partition start after the delta's arrival."""
    rt = start_of(delta)
    return f"""{LEDGER},
t AS (SELECT *, {rt} AS rt FROM {target}),
d AS (SELECT *, {rt} AS rt FROM {delta})"""


def anti(target: str, delta: str, keys: list[str], same: str) -> str:
    match = " AND ".join(f"{delta}.{k} {same} {target}.{k}" for k in keys)
    return f"SELECT * FROM {target} WHERE NOT EXISTS (SELECT 1 FROM {delta} WHERE {match})"


SAME, EQUAL = "IS NOT DISTINCT FROM", "="
LATEST_ED = """SELECT event_id, ts, k1, k2, value FROM (
    SELECT *, row_number() OVER (PARTITION BY k1, k2 ORDER BY ts DESC NULLS FIRST, event_id DESC) AS r
    FROM ed) z WHERE r = 1"""
TIES = "dt DESC NULLS FIRST, ref DESC NULLS FIRST, status DESC NULLS FIRST, amount DESC NULLS FIRST"
SALES_FROM = """FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey"""
SUM_QUANTITY = "CAST(sum(CAST(l.l_quantity AS DECIMAL(19,4))) AS DECIMAL(29,4)) AS quantity"
SUM_DISCOUNT = "CAST(sum(CAST(l.l_discount AS DECIMAL(19,4))) AS DECIMAL(29,4)) AS discount"
MONTH = "strftime(dt, '%Y%m')"

#: Labels with characters that catalogs escape, as they are stored.
ODD = "CASE WHEN status IN ('A', 'O') THEN 'a~2Fb' WHEN status IN ('F', 'N') THEN 'x~3Ay+~25' ELSE '~' END"

MERGED_WITH_DEFAULT = f"""SELECT {COLS}, rt FROM (
    SELECT *, rank() OVER (PARTITION BY rt, orderkey ORDER BY rnk) AS k FROM (
        SELECT *, 1 AS rnk FROM d UNION ALL SELECT *, 2 AS rnk FROM t) q) z
WHERE k = 1"""
OVERWRITTEN_NAMED = f"""SELECT {COLS}, rt FROM d WHERE rt IS NOT NULL
UNION ALL
SELECT {COLS}, rt FROM t
WHERE rt IS NULL OR rt NOT IN (SELECT rt FROM d WHERE rt IS NOT NULL)"""
# Overwriting with rows that no named partition covers: in the default partition
# they replace those with the same key.
OVERWRITTEN_WITH_STRAY = f"""SELECT {COLS}, rt FROM d
UNION ALL
SELECT {COLS}, rt FROM t WHERE rt NOT IN (SELECT rt FROM d WHERE rt IS NOT NULL)
UNION ALL
SELECT {COLS}, rt FROM t WHERE rt IS NULL AND NOT EXISTS (
    SELECT 1 FROM d WHERE d.rt IS NULL AND d.orderkey IS NOT DISTINCT FROM t.orderkey)"""
PART_LABEL = "coalesce(strftime(rt, '%Y-%m-%d'), '__default__') AS part"

ORACLE: dict[str, str] = {
    "scan_external_full": "SELECT p_partkey, p_name, p_brand, p_size FROM part",
    "scan_external_delta": """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '2000-01-01' AND TIMESTAMP '2001-01-01'""",
    "scan_split_plan": """
WITH b AS (SELECT min(o_orderdate) AS low, max(o_orderdate) AS high FROM orders),
s AS (SELECT low, high, greatest(1, CAST(floor(date_diff('day', low, high) / 16) AS BIGINT)) AS w FROM b),
r AS (SELECT x AS lo, least(x + to_days(CAST(w AS INTEGER)), high) AS hi, high
      FROM (SELECT unnest(range(low, high, to_days(CAST(w AS INTEGER)))) AS x, w, high FROM s) q)
SELECT lo, hi, count(*) AS n FROM r JOIN orders
ON o_orderdate >= lo AND (o_orderdate < hi OR (hi = high AND o_orderdate = high))
GROUP BY lo, hi""",
    "typed_projection": """
SELECT CAST(c_custkey AS BIGINT) AS custkey, substr(c_mktsegment, 1, 10) AS mktsegment,
       CAST(c_nationkey AS INT) AS nationkey, rpad(substr(c_name, 1, 25), 25, ' ') AS name,
       CAST(c_acctbal AS DECIMAL(19,4)) AS acctbal
FROM customer""",
    "typed_lineitem": """
SELECT CAST(l_shipdate AS DATE) AS shipdate, CAST(l_orderkey AS BIGINT) AS orderkey,
       CAST(l_linenumber AS BIGINT) AS linenumber, CAST(l_suppkey AS INT) AS suppkey,
       CAST(l_discount AS DECIMAL(19,4)) AS discount, CAST(l_quantity AS BIGINT) AS quantity,
       substr(l_returnflag, 1, 1) AS returnflag
FROM lineitem""",
    "delta_filter": """
SELECT event_id, ts, value FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'""",
    "delta_filter_auto": """
SELECT * FROM (SELECT event_id, ts, value * 2 AS v FROM events) m
WHERE ts BETWEEN TIMESTAMP '2024-01-20' AND TIMESTAMP '2024-01-25'""",
    "partition_filter": f"""
WITH {LT} SELECT {COLS} FROM lt
WHERE dt >= TIMESTAMP '1999-06-15' AND dt < TIMESTAMP '2000-03-10'""",
    "delta_profile": f"""
WITH {LD} SELECT count(*) AS row_cnt, min(dt) AS min_key, max(dt) AS max_key FROM ld""",
    "table_stats": """
SELECT count(*) AS row_count, min(l_shipdate) AS min_shipdate, max(l_shipdate) AS max_shipdate,
       count(DISTINCT l_returnflag) AS ndv_returnflag
FROM lineitem""",
    "sales_view": f"""
SELECT l.l_orderkey AS orderkey, l.l_linenumber AS linenumber, l.l_partkey AS partkey,
       l.l_suppkey AS suppkey, o.o_orderdate AS orderdate, o.o_orderstatus AS orderstatus,
       c.c_name AS customer, l.l_returnflag AS returnflag, o.o_orderpriority AS orderpriority,
       {SUM_QUANTITY}, {SUM_DISCOUNT}
{SALES_FROM}
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9""",
    "dedup_latest": f"WITH {ED} {LATEST_ED}",
    "load_init": f"WITH {LT} SELECT * FROM lt",
    "load_full_refresh": """
SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(19,4)) AS totalprice FROM orders""",
    "load_init_partitioned": f"WITH {LT} SELECT *, {start_of()} AS part_start FROM lt",
    "load_full": f"WITH {LD} SELECT * FROM ld",
    "load_truncate_insert": f"WITH {LD} SELECT * FROM ld",
    "load_append": f"{LEDGER} SELECT * FROM lt UNION ALL SELECT * FROM ld",
    "load_delete_insert": f"""
{LEDGER} {anti("lt", "ld", ["orderkey"], EQUAL)} UNION ALL SELECT * FROM ld""",
    "load_delta_append": f"""
{LEDGER} SELECT *, {start_of("ld")} AS part_start
FROM (SELECT * FROM lt UNION ALL SELECT * FROM ld) q""",
    "load_delta_upsert": f"""
{LEDGER} {anti("lt", "ld", ["orderkey"], SAME)} UNION ALL SELECT * FROM ld""",
    "load_delta_upsert_dedup": f"""
{HISTORY} {anti("et", "ed", ["k1", "k2"], SAME)} UNION ALL {LATEST_ED}""",
    "load_delta_upsert_null_never_match": f"""
{HISTORY} {anti("et", "ed", ["k1", "k2"], EQUAL)} UNION ALL SELECT * FROM ed""",
    "load_delta_merge_rank": f"""
{HISTORY} SELECT event_id, ts, k1, k2, value FROM (
    SELECT *, rank() OVER (PARTITION BY k1, k2 ORDER BY rnk) AS r FROM (
        SELECT *, 1 AS rnk FROM ed UNION ALL SELECT *, 2 AS rnk FROM et) q) z
WHERE r = 1""",
    "load_delta_merge_rownum": f"""
{HISTORY} SELECT event_id, ts, k1, k2, value FROM (
    SELECT *, row_number() OVER (
        PARTITION BY k1, k2 ORDER BY rnk, ts DESC NULLS FIRST, event_id DESC) AS r
    FROM (SELECT *, 1 AS rnk FROM ed UNION ALL SELECT *, 2 AS rnk FROM et) q) z
WHERE r = 1""",
    "load_partitions_merge": f"""
{routed("lt", "ld")} SELECT {COLS} FROM (
    SELECT *, rank() OVER (PARTITION BY rt, orderkey ORDER BY rnk) AS k FROM (
        SELECT *, 1 AS rnk FROM d WHERE rt IS NOT NULL
        UNION ALL SELECT *, 2 AS rnk FROM t WHERE rt IS NOT NULL) q) z
WHERE k = 1 UNION ALL SELECT {COLS} FROM t WHERE rt IS NULL""",
    "load_partitions_merge_unrouted": f"""
{routed("lt", "ld")} SELECT {COLS} FROM ({MERGED_WITH_DEFAULT}) m""",
    "load_partitions_merge_rownum": f"""
{routed("ld", "lt")} SELECT {COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY rt, orderkey ORDER BY rnk, {TIES}) AS k FROM (
        SELECT *, 1 AS rnk FROM d WHERE rt IS NOT NULL
        UNION ALL SELECT *, 2 AS rnk FROM t WHERE rt IS NOT NULL) q) z
WHERE k = 1 UNION ALL SELECT {COLS} FROM t WHERE rt IS NULL""",
    "load_partitions_merge_rownum_unrouted": f"""
{routed("ld", "lt")} SELECT {COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY rt, orderkey ORDER BY rnk, {TIES}) AS k FROM (
        SELECT *, 1 AS rnk FROM d UNION ALL SELECT *, 2 AS rnk FROM t) q) z
WHERE k = 1""",
    "load_partitions_overwrite_distinct_unrouted": f"""
{routed("lt", "ld")}
SELECT DISTINCT {COLS} FROM (SELECT * FROM d UNION ALL SELECT * FROM d) q
UNION ALL
SELECT {COLS} FROM t WHERE rt NOT IN (SELECT rt FROM d WHERE rt IS NOT NULL)
UNION ALL
SELECT {COLS} FROM t WHERE rt IS NULL AND NOT EXISTS (
    SELECT 1 FROM d WHERE d.rt IS NULL AND d.orderkey IS NOT DISTINCT FROM t.orderkey)""",
    "load_partitions_overwrite": f"""
{routed("lt", "ld")} SELECT {COLS} FROM ({OVERWRITTEN_NAMED}) m""",
    "load_partitions_overwrite_unrouted": f"""
{routed("lt", "ld")} SELECT {COLS} FROM ({OVERWRITTEN_WITH_STRAY}) m""",
    "load_partitions_overwrite_distinct": f"""
{routed("lt", "ld")}
SELECT DISTINCT {COLS} FROM (SELECT * FROM d UNION ALL SELECT * FROM d) q WHERE rt IS NOT NULL
UNION ALL
SELECT {COLS} FROM t WHERE rt IS NULL OR rt NOT IN (SELECT rt FROM d WHERE rt IS NOT NULL)""",
    "load_partitions_merge_global": f"""
{LEDGER} SELECT {COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY orderkey ORDER BY rnk, {TIES}) AS k FROM (
        SELECT *, 1 AS rnk FROM ld
        UNION ALL
        SELECT *, 2 AS rnk FROM lt WHERE {MONTH} IN (SELECT {MONTH} FROM ld)) q) z
WHERE k = 1
UNION ALL SELECT {COLS} FROM lt WHERE {MONTH} NOT IN (SELECT {MONTH} FROM ld)""",
    "load_partitions_overwrite_months": f"""
{LEDGER} SELECT * FROM ld
UNION ALL SELECT * FROM lt WHERE {MONTH} NOT IN (SELECT {MONTH} FROM ld)""",
    "changed_partitions": f"WITH {LD} SELECT DISTINCT {MONTH} AS part FROM ld",
    "partition_route": f"""
WITH {LT} SELECT {start_of()} AS part_start, count(*) AS n, min(dt) AS min_key, max(dt) AS max_key
FROM lt GROUP BY 1""",
    "partition_plan": f"""
WITH {LD} SELECT 'm_' || strftime(x, '%m_%Y') AS part_name, x AS part_start,
       x + INTERVAL 1 MONTH AS part_end
FROM (SELECT unnest(generate_series(TIMESTAMP '2001-01-01',
    (SELECT date_trunc('day', max(dt)) FROM ld), INTERVAL 1 MONTH)) AS x) s""",
    "partition_overlap": f"""
WITH {LD} SELECT part_start, part_end FROM (
    SELECT x AS part_start, x + INTERVAL 1 YEAR AS part_end FROM (
        SELECT unnest(generate_series(TIMESTAMP '1996-01-01', TIMESTAMP '1999-01-01',
            INTERVAL 1 YEAR)) AS x) y
    UNION ALL
    SELECT x, x + INTERVAL 1 MONTH FROM (
        SELECT unnest(generate_series(TIMESTAMP '2000-01-01',
            (SELECT greatest(TIMESTAMP '2000-12-01', date_trunc('day', max(dt))) FROM ld),
            INTERVAL 1 MONTH)) AS x) m) s
WHERE part_start <= (SELECT max(dt) FROM ld) AND part_end > (SELECT min(dt) FROM ld)""",
    "partition_split_default": f"""
{LEDGER}, t AS (SELECT *, {start_of()} AS before, {start_of("ld")} AS part_start FROM lt)
SELECT part_start, count(*) AS n FROM t WHERE before IS NULL GROUP BY 1""",
    "window_adjust": """
SELECT o_orderkey,
  CASE o_orderkey % 5 WHEN 0 THEN date_trunc('month', o_orderdate)
    WHEN 1 THEN date_trunc('day', o_orderdate) WHEN 2 THEN date_trunc('year', o_orderdate)
    WHEN 3 THEN date_trunc('hour', o_orderdate) ELSE o_orderdate END
    - INTERVAL 4 DAY AS extraction_from,
  CASE o_orderkey % 5 WHEN 0 THEN date_trunc('month', o_orderdate) + INTERVAL 62 DAY
    WHEN 1 THEN date_trunc('day', o_orderdate) + INTERVAL 3 DAY
    WHEN 2 THEN date_trunc('year', o_orderdate) + INTERVAL 365 DAY
    WHEN 3 THEN date_trunc('hour', o_orderdate) + INTERVAL 5 HOUR
    ELSE o_orderdate END AS extraction_to
FROM orders""",
    "next_windows": f"""
WITH {LG} SELECT object_name,
  date_trunc('month', max(extraction_to)) - INTERVAL 5 DAY AS extraction_from,
  TIMESTAMP '2024-02-01' + INTERVAL 31 DAY AS extraction_to
FROM lg WHERE status = 2 GROUP BY 1""",
    "load_log_last_extraction": f"""
WITH {LG} SELECT object_name, max(extraction_to) AS extraction_to
FROM lg WHERE status = 2 GROUP BY object_name""",
    "load_log_complete": f"""
WITH {LG} SELECT object_name, invocation_id, status, created_at, extraction_to FROM (
    SELECT *, row_number() OVER (
        PARTITION BY object_name, invocation_id ORDER BY created_at DESC, entry_id DESC) AS r
    FROM lg) z WHERE r = 1""",
    "load_log_clear": f"""
WITH {LG} SELECT * FROM lg
WHERE NOT (object_name = 'click' AND created_at >= TIMESTAMP '2024-01-15')""",
    "load_log_verify": f"""
WITH {LG} SELECT missing_column, row_cnt FROM (VALUES ('extraction_from'), ('updated_at'),
  ('extraction_from_original'), ('extraction_to_original'), ('model_sql'), ('load_method'),
  ('extraction_type'), ('load_type'), ('row_cnt'), ('delta_field')) AS v(missing_column),
  (SELECT count(*) AS row_cnt FROM lg) n""",
    "load_chain_e2e": f"""
WITH loaded AS (
    SELECT * REPLACE (CASE WHEN o_orderdate >= (
        SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01')
        - INTERVAL 30 DAY THEN lower(o_orderstatus) ELSE o_orderstatus END AS o_orderstatus)
    FROM orders)
SELECT o.o_orderpriority, o.o_orderstatus, l.l_returnflag, {SUM_QUANTITY}, {SUM_DISCOUNT}
{SALES_FROM.replace("orders o", "loaded o")}
GROUP BY 1, 2, 3""",
    "load_run_partitions_merge": f"""
{routed("lt", "ld")} SELECT {COLS}, {PART_LABEL} FROM ({MERGED_WITH_DEFAULT}) m""",
    "load_run_partitions_overwrite": f"""
{routed("lt", "ld")} SELECT {COLS}, {PART_LABEL} FROM ({OVERWRITTEN_WITH_STRAY}) m""",
    "load_run_overwrite_twice": f"""
{routed("lt", "ld")} SELECT {COLS}, {PART_LABEL} FROM ({OVERWRITTEN_WITH_STRAY}) m""",
    "load_run_merge_expression": f"""
{LEDGER}, t AS (SELECT *, {ODD} AS part FROM lt), d AS (SELECT *, {ODD} AS part FROM ld)
SELECT {COLS}, part FROM d
UNION ALL
SELECT {COLS}, part FROM t WHERE NOT EXISTS (
    SELECT 1 FROM d WHERE d.part = t.part AND d.orderkey IS NOT DISTINCT FROM t.orderkey)""",
    "load_run_merge_across": f"""
{LEDGER}, t AS (SELECT *, {ODD} AS part FROM lt), d AS (SELECT *, {ODD} AS part FROM ld)
SELECT {COLS}, part FROM (
    SELECT *, row_number() OVER (PARTITION BY orderkey ORDER BY rnk, {TIES}) AS k FROM (
        SELECT *, 1 AS rnk FROM d
        UNION ALL
        SELECT *, 2 AS rnk FROM t WHERE part IN (SELECT part FROM d)) q) z
WHERE k = 1
UNION ALL
SELECT {COLS}, part FROM t WHERE part NOT IN (SELECT part FROM d)""",
    "load_run_full_list": f"""
{LEDGER} SELECT {COLS}, CASE WHEN status IN ('A', 'N') THEN status ELSE '__default__' END AS part FROM ld""",
    "load_run_delete_insert": f"""
{LEDGER} SELECT *, {label()} AS part
FROM ({anti("lt", "ld", ["orderkey"], EQUAL)} UNION ALL SELECT * FROM ld) q""",
    "load_run_truncate_insert": f"""
{LEDGER} SELECT *, {label()} AS part FROM ld""",
    "load_run_log": """
WITH o AS (SELECT count(*) AS n, max(o_orderdate) AS top,
                  count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1996-01-01' OR o_orderdate >= TIMESTAMP '2001-01-01') AS stray
           FROM orders),
l AS (SELECT count(*) AS n, max(l_shipdate) AS top, count(*) FILTER (WHERE l_shipdate < TIMESTAMP '1996-01-01') AS stray FROM lineitem)
SELECT CAST(2 AS BIGINT) AS status, 'init' AS load_type, n AS row_cnt, stray AS unrouted,
       CAST(NULL AS TIMESTAMP) AS extraction_from, CAST(top AS TIMESTAMP) AS extraction_to FROM o
UNION ALL
SELECT 2, 'partitions', l.n, l.stray, CAST(NULL AS TIMESTAMP), CAST(l.top AS TIMESTAMP) FROM l
UNION ALL
SELECT 2, 'partitions', 0, 0, CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP)""",
    "load_run_upsert_partitioned": f"""
{LEDGER} SELECT *, {label()} AS part
FROM ({anti("lt", "ld", ["orderkey"], SAME)} UNION ALL SELECT * FROM ld) q""",
    "load_run_delta_append": f"""
{LEDGER} SELECT *, {label("ld")} AS part
FROM (SELECT * FROM lt UNION ALL SELECT * FROM ld) q""",
    "load_run_upsert_flat": f"""
{LEDGER} {anti("lt", "ld", ["orderkey"], SAME)} UNION ALL SELECT * FROM ld""",
    "load_run_upsert_buckets": f"""
{LEDGER} {anti("lt", "ld", ["orderkey"], SAME)} UNION ALL SELECT * FROM ld""",
    "load_run_merge_buckets": f"""
{LEDGER} SELECT *, 'now' AS version FROM ({anti("lt", "ld", ["orderkey"], SAME)} UNION ALL SELECT * FROM ld) q
UNION ALL SELECT *, 'before' FROM lt""",
    "load_run_new_keys": f"""
{LEDGER} SELECT *, {label()} AS part
FROM (SELECT * FROM lt UNION ALL
      SELECT orderkey + 1000000000000 AS orderkey, ref, status, amount, dt FROM ld) q""",
    "load_run_replicated": """
SELECT n_name, count(*) AS customers, sum(c_acctbal) AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
    "load_run_merge_flat": f"""
{LEDGER} SELECT *, 'now' AS version FROM ({anti("lt", "ld", ["orderkey"], SAME)} UNION ALL SELECT * FROM ld) q
UNION ALL SELECT *, 'before' FROM lt""",
    "load_run_merge_flat_rownum": f"""
{LEDGER} SELECT {COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY orderkey ORDER BY rnk, {TIES}) AS k FROM (
        SELECT *, 1 AS rnk FROM ld UNION ALL SELECT *, 2 AS rnk FROM lt) q) z
WHERE k = 1""",
    "load_run_full_flat": f"""
{LEDGER} SELECT *, 'now' AS version FROM ld UNION ALL SELECT *, 'before' FROM lt""",
    "load_run_backup_partitioned": f"""
{LEDGER} SELECT {COLS}, CASE WHEN status IN ('O', 'F') THEN status ELSE '__default__' END AS part FROM lt""",
    "load_run_repeated": f"""
{LEDGER} SELECT *, {label("ld")} AS part
FROM (SELECT * FROM lt UNION ALL SELECT * FROM ld) q""",
    "load_run_open_rows": f"""
WITH {LT}, early AS (SELECT * FROM lt WHERE dt < TIMESTAMP '2000-01-01'),
mark AS (SELECT max(dt) AS top FROM early WHERE status IS DISTINCT FROM 'F'),
d AS (SELECT orderkey, ref, lower(status) AS status, amount, dt FROM lt, mark WHERE dt >= top)
SELECT * FROM d
UNION ALL
SELECT * REPLACE (CASE WHEN status = 'F' THEN TIMESTAMP '9999-12-31' ELSE dt END AS dt)
FROM early WHERE orderkey NOT IN (SELECT orderkey FROM d)""",
    "load_run_unrouted": f"""
{LEDGER}, t AS (SELECT *, {start_of()} AS rt FROM lt), d AS (SELECT *, {start_of()} AS rt FROM ld),
t2 AS (SELECT * FROM t WHERE rt IS NOT NULL), d2 AS (SELECT * FROM d WHERE rt IS NOT NULL),
rows AS (SELECT * FROM d2 UNION ALL SELECT * FROM t2 WHERE orderkey NOT IN (SELECT orderkey FROM d2)),
counts AS (SELECT CAST(count(*) FILTER (WHERE rt IS NOT NULL) AS BIGINT) AS logged,
                  CAST(count(*) FILTER (WHERE rt IS NULL) AS BIGINT) AS unrouted
           FROM (SELECT rt FROM t UNION ALL SELECT rt FROM d) q)
SELECT strftime(rt, '%Y-%m-%d') AS part, count(*) AS n, logged, unrouted FROM rows, counts GROUP BY ALL""",
    "load_run_unrouted_delta": f"""
{LEDGER}, t AS (SELECT *, {start_of()} AS rt FROM lt), d AS (SELECT *, {start_of("ld")} AS rt FROM ld),
rows AS (SELECT * FROM t WHERE rt IS NOT NULL UNION ALL SELECT * FROM d WHERE rt IS NOT NULL),
counts AS (SELECT CAST(count(*) FILTER (WHERE rt IS NOT NULL) AS BIGINT) AS logged,
                  CAST(count(*) FILTER (WHERE rt IS NULL) AS BIGINT) AS unrouted
           FROM (SELECT rt FROM t UNION ALL SELECT rt FROM d) q)
SELECT strftime(rt, '%Y-%m-%d') AS part, count(*) AS n, logged, unrouted FROM rows, counts GROUP BY ALL""",
    "load_run_statistics": f"""
{LEDGER}, t AS (SELECT *, {ODD} AS part FROM lt), d AS (SELECT *, {ODD} AS part FROM ld)
SELECT part, count(*) AS row_cnt FROM (
    SELECT * FROM d
    UNION ALL
    SELECT * FROM t WHERE NOT EXISTS (
        SELECT 1 FROM d WHERE d.part = t.part AND d.orderkey IS NOT DISTINCT FROM t.orderkey)) q
GROUP BY part""",
    "load_run_column_statistics": f"""
{LEDGER}, r AS ({anti("lt", "ld", ["orderkey"], SAME)} UNION ALL SELECT * FROM ld)
SELECT 'orderkey' AS col, min(orderkey) AS low, max(orderkey) AS high, count(*) - count(orderkey) AS num_nulls, true AS histogram FROM r
UNION ALL
SELECT 'ref', min(ref), max(ref), count(*) - count(ref), true FROM r""",
}
