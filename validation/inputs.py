"""Control tables, listings and change feeds derived from the given tables.

Every input is one portable SELECT over given tables or other inputs, read by Spark and
DuckDB alike. They grow with the given tables; none is a fixed set of rows. Remainders
of keys only decide what differs between two sides (a missing row, a stale version, a
layer count off by one); they are never used to make an input smaller.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _stamp(column: str) -> str:
    return f"year({column}) * 10000 + month({column}) * 100 + day({column})"


INPUTS: dict[str, str] = {}

# Object-store listing of one system.
INPUTS["fx_objects"] = f"""
SELECT concat('cda/pc/pc_t', CAST(l_suppkey % 20 AS STRING),
              '/s', CAST(l_linenumber % 3 AS STRING), '/',
              CAST({_stamp('l_shipdate')} AS STRING),
              '/part-', CAST(l_orderkey AS STRING), '-', CAST(l_partkey AS STRING),
              CASE WHEN l_linestatus = 'O' THEN '.snappy.parquet' ELSE '.crc' END) AS object_key,
       CAST(l_quantity AS BIGINT) * 1000 + l_linenumber AS size_bytes,
       l_shipdate AS last_modified
FROM lineitem
"""

# Listing of the second system: some objects missing, some of another size.
INPUTS["fx_objects_landed"] = """
SELECT object_key,
       CASE WHEN size_bytes % 41 = 0 THEN size_bytes + 1 ELSE size_bytes END AS size_bytes,
       last_modified
FROM fx_objects WHERE size_bytes % 49 <> 0
"""

# Inventory with storage class and restore state.
INPUTS["fx_archive"] = """
SELECT object_key,
       CASE WHEN size_bytes % 3 = 0 THEN 'DEEP_ARCHIVE' WHEN size_bytes % 3 = 1 THEN 'STANDARD'
            ELSE CAST(NULL AS STRING) END AS storage_class,
       CASE WHEN size_bytes % 4 = 0 THEN 'ongoing-request' WHEN size_bytes % 4 = 1 THEN 'done'
            ELSE CAST(NULL AS STRING) END AS restore_state
FROM fx_objects
"""

# Newly received manifest, upper-case table names.
INPUTS["fx_src_manifest"] = f"""
SELECT concat('PC_T', CAST(o_custkey AS STRING)) AS table_name,
       concat('s', CAST(o_custkey % 3 AS STRING)) AS cda_schema_id,
       CAST(max({_stamp('o_orderdate')}) AS STRING) AS cda_folder,
       max(o_orderdate) AS cda_folder_tms,
       count(*) AS total_records_count
FROM orders GROUP BY o_custkey
UNION ALL
SELECT 'HEARTBEAT', 's0', '20240101', max(o_orderdate), count(*) FROM orders
"""

# What was loaded before: never for 1 table in 7, up to date for 1 in 5.
INPUTS["fx_dest_manifest"] = f"""
SELECT concat('PC_T', CAST(o_custkey AS STRING)) AS table_name,
       concat('s', CAST(o_custkey % 3 AS STRING)) AS cda_schema_id,
       CAST(max({_stamp('o_orderdate')}) AS STRING) AS cda_folder,
       max(o_orderdate) AS cda_folder_tms,
       count(*) AS total_records_count
FROM orders
WHERE o_custkey % 7 <> 0 AND (o_custkey % 5 = 0 OR o_orderdate < DATE '1998-01-01')
GROUP BY o_custkey
"""

# One row per layer and table, lower-case names; some absent, some without a status.
INPUTS["fx_load_status"] = """
SELECT layer, concat('pc_t', CAST(c_custkey AS STRING)) AS table_name,
       CASE WHEN c_custkey % 13 = 0 THEN CAST(NULL AS STRING)
            WHEN c_custkey % 3 = 0 OR c_custkey % 5 = 0 THEN 'completed'
            WHEN (c_custkey + k) % 4 = 0 THEN 'completed'
            WHEN (c_custkey + k) % 4 = 1 THEN 'failed'
            WHEN (c_custkey + k) % 4 = 2 THEN 'started'
            ELSE 'pending' END AS status
FROM (SELECT c_custkey, 'raw' AS layer, 0 AS k FROM customer
      UNION ALL SELECT c_custkey, 'stg', 1 FROM customer
      UNION ALL SELECT c_custkey, 'mrg', 2 FROM customer) layers
WHERE (c_custkey + k) % 11 <> 0
"""

# One configuration row per core center.
INPUTS["fx_core_centers"] = """
SELECT concat('cc', CAST(c_custkey AS STRING)) AS core_center,
       c_acctbal > 0 AS s3_initial_load_flag,
       CASE WHEN c_nationkey % 6 = 0 THEN CAST(NULL AS BOOLEAN) ELSE c_acctbal > 2000 END AS s3_incremental_load_flag,
       c_nationkey % 2 = 0 AS mrg_initial_load_flag,
       c_nationkey % 3 = 0 AS mrg_incremental_load_flag,
       concat('raw_', lower(c_mktsegment)) AS raw_schema_name,
       concat('stg_', lower(c_mktsegment)) AS stg_schema_name,
       concat('mrg_', lower(c_mktsegment)) AS merge_schema_name
FROM customer
"""

# Five large tables: the system of record ...
INPUTS["fx_replica"] = """
SELECT concat('PC_', upper(substring(o_orderpriority, 1, 1))) AS table_name,
       o_orderkey AS id, CAST(o_custkey AS STRING) AS beanversion
FROM orders WHERE o_orderkey % 101 <> 0
"""

# ... and the merged copy with missing rows, stale versions, soft deletes, extra rows.
INPUTS["fx_merged"] = """
SELECT concat('PC_', upper(substring(o_orderpriority, 1, 1))) AS table_name,
       o_orderkey AS id,
       CASE WHEN o_orderkey % 89 = 0 THEN o_custkey + 1 ELSE o_custkey END AS beanversion,
       CASE WHEN o_orderkey % 83 = 0 THEN 'Y' WHEN o_orderkey % 79 = 0 THEN CAST(NULL AS STRING) ELSE 'N' END
           AS gw_delete_flag
FROM orders WHERE o_orderkey % 97 <> 0
"""

# Many tables, one per customer, in varied names: plain, pattern-blocked, almost blocked.
INPUTS["fx_tables"] = """
SELECT CASE c_custkey % 25 WHEN 4 THEN concat('pct_', CAST(c_custkey AS STRING))
                           WHEN 9 THEN concat('pcta', CAST(c_custkey AS STRING))
                           WHEN 13 THEN concat('Pc_Tmp', CAST(c_custkey AS STRING))
                           WHEN 17 THEN concat('PC_', CAST(c_custkey AS STRING), '_WorkItem')
                           WHEN 19 THEN concat('pcst', CAST(c_custkey AS STRING))
                           ELSE concat('PC_T', CAST(c_custkey AS STRING)) END AS table_name,
       c_custkey AS table_key,
       c_custkey % 25 NOT IN (6, 14) AS in_mrg,
       c_custkey % 25 <> 11 AS in_replica,
       CASE c_nationkey % 4 WHEN 0 THEN 'MRG_PC' WHEN 1 THEN 'MRG_BC' WHEN 2 THEN 'MRG_CC' ELSE 'MRG_CM' END
           AS schema_name,
       concat(CASE c_custkey % 5 WHEN 0 THEN 'PC' WHEN 1 THEN 'bc' WHEN 2 THEN 'CC' WHEN 3 THEN 'ab' ELSE 'XX' END,
              '_T', CAST(c_custkey AS STRING)) AS tenant_table_name
FROM customer
"""

# Names on the block list.
INPUTS["fx_listed"] = """
SELECT lower(table_name) AS table_name FROM fx_tables WHERE table_key % 25 IN (14, 21)
"""

# Rows of the many tables on both sides; replica tables of one kind are empty.
INPUTS["fx_table_rows"] = """
SELECT side, t.table_name, o_orderkey AS id,
       CAST(CASE WHEN side = 'mrg' AND o_orderkey % 89 = 0 THEN o_custkey + 1 ELSE o_custkey END AS STRING) AS beanversion,
       CASE WHEN side = 'rep' THEN 'N' WHEN o_orderkey % 83 = 0 THEN 'Y' WHEN o_orderkey % 79 = 0 THEN CAST(NULL AS STRING)
            ELSE 'N' END AS gw_delete_flag,
       o_orderpriority
FROM fx_tables t
JOIN (SELECT 'mrg' AS side, o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderkey % 97 <> 0
      UNION ALL
      SELECT 'rep', o_orderkey, o_custkey, o_orderpriority FROM orders
      WHERE o_orderkey % 101 <> 0 AND o_custkey % 25 <> 16) r
  ON r.o_custkey = t.table_key
WHERE (side = 'mrg' AND in_mrg) OR (side = 'rep' AND in_replica)
"""

# Column metadata of the many tables. Attribute columns come from the rows a side holds, so
# a row missing on one side can be a column missing there.
INPUTS["fx_columns"] = """
SELECT 'mrg' AS side, table_name, 'ID' AS column_name FROM fx_tables WHERE in_mrg
UNION ALL SELECT 'rep', table_name, 'id' FROM fx_tables WHERE in_replica
UNION ALL SELECT 'mrg', table_name, 'BEANVERSION' FROM fx_tables WHERE in_mrg AND table_key % 25 <> 3
UNION ALL SELECT 'rep', table_name, 'beanversion' FROM fx_tables WHERE in_replica AND table_key % 25 <> 3
UNION ALL SELECT 'mrg', table_name, 'GW_DELETE_FLAG' FROM fx_tables WHERE in_mrg
UNION ALL SELECT 'mrg', table_name, 'BATCHID' FROM fx_tables WHERE in_mrg
UNION ALL SELECT side, table_name,
       CASE side WHEN 'rep' THEN concat('attr_', substring(o_orderpriority, 1, 1))
                 ELSE concat('ATTR_', substring(o_orderpriority, 1, 1)) END AS column_name
FROM fx_table_rows GROUP BY 1, 2, 3
"""

# Change rows, several per key, in folders of one day.
INPUTS["fx_cdc"] = f"""
SELECT user_id AS id, event_id AS seqval, ts AS payload_ts,
       CASE event_type WHEN 'error' THEN 'D' WHEN 'signup' THEN 'I' ELSE 'U' END AS operation,
       event_type AS payload,
       concat('pc_', event_type) AS table_name,
       CAST({_stamp('ts')} AS BIGINT) AS cda_folder
FROM events
"""

# Load plan of the change feed: each table up to its newest folder, above a low mark or from the start.
INPUTS["fx_cdc_plan"] = """
SELECT table_name, max(cda_folder) AS src_cda_folder,
       CASE WHEN table_name IN ('pc_error', 'pc_click') THEN CAST(NULL AS BIGINT) ELSE CAST(20240110 AS BIGINT) END
           AS dest_cda_folder
FROM fx_cdc GROUP BY table_name
"""

# Rows waiting for delivery.
INPUTS["fx_outbox"] = """
SELECT c_custkey AS identity, c_name AS name,
       CASE WHEN c_nationkey % 4 = 0 THEN CAST(NULL AS STRING) ELSE c_mktsegment END AS segment,
       CASE WHEN c_custkey % 17 = 0 THEN CAST(NULL AS STRING)
            WHEN c_custkey % 3 = 0 THEN 'SUCCESS' WHEN c_custkey % 3 = 1 THEN 'FAILURE' ELSE 'NEW' END AS submission_status,
       c_nationkey % 5 AS submission_attempt_count,
       3 AS max_submission_attempt_count
FROM customer
"""

# Quota rows.
INPUTS["fx_monitors"] = """
SELECT concat('m', CAST(o_orderkey AS STRING)) AS name,
       CAST(100 + o_orderkey % 50 AS DECIMAL(18, 2)) AS credit_quota,
       CAST(o_custkey % 170 AS DECIMAL(18, 2)) AS used_credits,
       CASE WHEN o_orderkey % 2 = 0 THEN 'WEEKLY' ELSE 'DAILY' END AS frequency,
       o_orderdate AS start_time,
       CASE o_orderkey % 4 WHEN 0 THEN '90%' WHEN 1 THEN ' 100% ' WHEN 2 THEN '' ELSE CAST(NULL AS STRING) END AS suspend_at,
       CASE o_orderkey % 3 WHEN 0 THEN '110%' WHEN 1 THEN '100%' ELSE '95%' END AS suspend_immediately_at
FROM orders
"""

# Counts and folders of every layer, some off by one.
INPUTS["fx_layer_counts"] = """
SELECT lower(table_name) AS table_name, total_records_count AS manifest_count, cda_folder AS manifest_folder,
       CASE WHEN total_records_count % 7 = 0 THEN total_records_count - 1 ELSE total_records_count END AS raw_count,
       CASE WHEN total_records_count % 11 = 0 THEN '0' ELSE cda_folder END AS raw_folder,
       CASE WHEN total_records_count % 13 = 0 THEN total_records_count - 2 ELSE total_records_count END AS stg_count,
       CASE WHEN total_records_count % 17 = 0 THEN total_records_count + 1 ELSE total_records_count END AS mrg_count,
       total_records_count AS expected_mrg_count
FROM fx_src_manifest WHERE lower(table_name) <> 'heartbeat'
"""

# Failed steps with messages of several lines: every error event.
INPUTS["fx_errors"] = """
SELECT CASE event_id % 4 WHEN 0 THEN 'pc' WHEN 1 THEN 'bc' WHEN 2 THEN 'cc' ELSE 'cm' END AS core_center,
       concat('pc_t', CAST(event_id AS STRING)) AS table_name,
       CASE user_id % 3 WHEN 0 THEN 'RAW' WHEN 1 THEN 'STG' ELSE 'MRG' END AS procedure_name,
       concat('Traceback', chr(10), 'line ', CAST(user_id AS STRING), chr(10), 'failed: ', props) AS error_message
FROM events WHERE event_type = 'error'
"""

# Changes of many keys with a total order, for the merge measured in the bench.
INPUTS["fx_line_changes"] = """
SELECT l_orderkey AS id, l_shipdate, l_linenumber, l_partkey, l_suppkey,
       CASE l_returnflag WHEN 'R' THEN 'D' WHEN 'A' THEN 'I' ELSE 'U' END AS operation,
       l_linestatus AS payload
FROM lineitem
"""


def _names_in(sql: str) -> list[str]:
    return [name for name in INPUTS if re.search(rf"\b{name}\b", sql)]


def duckdb_with(sql: str) -> str:
    """The statement with the inputs it uses, and theirs, as leading common table expressions.

    The statement may itself start with further expressions, written `name AS (...), ... SELECT`
    after the word WITH.
    """
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in _names_in(text):
            if name not in needed:
                visit(INPUTS[name])
                needed.add(name)

    visit(sql)
    expressions = ",\n".join(f"{name} AS ({INPUTS[name].strip()})" for name in INPUTS if name in needed)
    body = sql.strip()
    if not expressions:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {expressions},\n{body[5:]}"
    return f"WITH {expressions}\n{body}"


class Inputs:
    """The given tables of a folder and the inputs derived from them, as frames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._derive(name) if name in INPUTS else self._read(name)
        return self._frames[name]

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")

    def _derive(self, name: str) -> DataFrame:
        sql = INPUTS[name]
        used = [n for n in (*TABLES, *INPUTS) if re.search(rf"\bFROM {n}\b|\bJOIN {n}\b", sql)]
        for used_name in used:
            sql = re.sub(rf"\b(FROM|JOIN) {used_name}\b", rf"\1 {{{used_name}}}", sql)
        return self.spark.sql(sql, **{n: self[n] for n in used})
