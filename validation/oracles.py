"""The same results in plain SQL for DuckDB, written independently of the operators."""

from __future__ import annotations

from validation.inputs import duckdb_with

_SQL: dict[str, str] = {}

RUN_TS = "TIMESTAMP '2024-02-01 00:00:00'"
EARLIER_TS = "TIMESTAMP '2024-01-01 00:00:00'"
AS_OF = "TIMESTAMP '2024-02-01 13:30:00'"

# Sources

_SQL["object_inventory"] = """
SELECT object_key, size_bytes, last_modified FROM fx_objects WHERE suffix(object_key, '.snappy.parquet')
"""

_SQL["path_decompose"] = """
SELECT object_key, split_part(object_key, '/', 3) AS table_name, split_part(object_key, '/', 4) AS cda_schema_id,
       split_part(object_key, '/', 5) AS cda_timestamp
FROM fx_objects WHERE object_key LIKE '%.snappy.parquet'
"""

FOLDERS = """
SELECT DISTINCT split_part(object_key, '/', 3) AS table_name, split_part(object_key, '/', 4) AS cda_schema_id,
       split_part(object_key, '/', 5) AS cda_timestamp
FROM fx_objects WHERE object_key LIKE '%.snappy.parquet'
"""
_SQL["folder_discovery"] = FOLDERS

_SQL["landing_key"] = """
SELECT object_key, '__copy_into__' || substr(object_key, length('cda/pc') + 1) AS landing_key
FROM fx_objects WHERE object_key LIKE '%.snappy.parquet'
"""

_SQL["manifest_explode"] = "SELECT * FROM fx_src_manifest"

_SQL["replica_tagged"] = """
SELECT CAST(4567 AS BIGINT) AS batch_id, 'MRG_PC' AS schema_name, table_name, id AS replica_id,
       beanversion AS replica_beanversion
FROM fx_replica
"""

# The columns of the given tables.
TABLE_COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}
_SQL["column_metadata"] = "\nUNION ALL\n".join(
    f"SELECT '{table.upper()}' AS table_name, upper(unnest({columns.split()})) AS column_name, "
    f"CAST(unnest(range(1, {len(columns.split())} + 1)) AS INTEGER) AS ordinal_position, count(*) AS row_count FROM {table}"
    for table, columns in TABLE_COLUMNS.items()
)

_SQL["archive_candidates"] = """
SELECT object_key FROM fx_archive
WHERE storage_class = 'DEEP_ARCHIVE' AND (restore_state IS NULL OR restore_state <> 'ongoing-request')
"""

# Inventory


def _rollup(listing: str, system: str, stamp: str) -> str:
    return f"""
SELECT '{system}' AS system, 'pc' AS core_center, split_part(object_key, '/', 3) AS table_name,
       split_part(object_key, '/', 4) AS cda_schema_id, split_part(object_key, '/', 5) AS cda_timestamp,
       CAST(sum(size_bytes) AS BIGINT) AS total_bytes, count(*) AS file_count, max(last_modified) AS max_last_modified,
       {stamp} AS row_insert_tms, {stamp} AS row_update_tms
FROM {listing} WHERE object_key LIKE '%.snappy.parquet' GROUP BY 1, 2, 3, 4, 5
"""


_SQL["file_rollup"] = _rollup("fx_objects", "source", RUN_TS)

_SQL["upsert_file_counts"] = f"""
WITH old AS ({_rollup("fx_objects_landed", "source", EARLIER_TS)}),
     new AS ({_rollup("fx_objects", "source", RUN_TS)})
SELECT n.system, n.core_center, n.table_name, n.cda_schema_id, n.cda_timestamp, n.total_bytes, n.file_count,
       n.max_last_modified, coalesce(o.row_insert_tms, n.row_insert_tms) AS row_insert_tms, n.row_update_tms
FROM new n LEFT JOIN old o USING (system, core_center, table_name, cda_schema_id, cda_timestamp)
UNION ALL
SELECT o.* FROM old o ANTI JOIN new n USING (system, core_center, table_name, cda_schema_id, cda_timestamp)
"""

_SQL["inventory_compare"] = f"""
WITH a AS ({_rollup("fx_objects", "source", RUN_TS)}), b AS ({_rollup("fx_objects_landed", "landed", RUN_TS)})
SELECT core_center, table_name, cda_schema_id, cda_timestamp,
       a.total_bytes AS bytes, b.total_bytes AS other_bytes, a.file_count AS files, b.file_count AS other_files,
       coalesce(a.total_bytes, 0) - coalesce(b.total_bytes, 0) AS bytes_diff,
       coalesce(a.file_count, 0) - coalesce(b.file_count, 0) AS files_diff,
       CASE WHEN b.file_count IS NULL THEN 'missing in landed' WHEN a.file_count IS NULL THEN 'missing in source'
            WHEN a.file_count <> b.file_count THEN 'file count differs'
            WHEN a.total_bytes <> b.total_bytes THEN 'bytes differ' ELSE 'equal' END AS finding
FROM a FULL JOIN b USING (core_center, table_name, cda_schema_id, cda_timestamp)
"""

# Load plan and control tables


def _plan(s3_on: bool = True, mrg_on: bool = True, initial: bool = False) -> str:
    nothing = " AND FALSE" if initial else ""
    return f"""
SELECT lower(s.table_name) AS table_name, s.cda_schema_id AS src_cda_schema_id,
       CAST(s.cda_folder AS BIGINT) AS src_cda_folder, s.cda_folder_tms AS src_cda_folder_tms,
       s.total_records_count AS src_total_records_count, CAST(d.cda_folder AS BIGINT) AS dest_cda_folder,
       d.cda_folder_tms AS dest_cda_folder_tms,
       d.cda_folder_tms IS NULL OR s.cda_folder_tms > d.cda_folder_tms AS load_s3,
       coalesce(r.status, 'initial') AS raw_status, load_s3 OR r.status IS DISTINCT FROM 'completed' AS load_raw,
       coalesce(g.status, 'initial') AS stg_status, load_raw OR g.status IS DISTINCT FROM 'completed' AS load_stg,
       coalesce(m.status, 'initial') AS mrg_status, load_stg OR m.status IS DISTINCT FROM 'completed' AS load_mrg
FROM fx_src_manifest s
LEFT JOIN fx_dest_manifest d ON s.table_name = d.table_name{nothing}
LEFT JOIN fx_load_status r ON lower(s.table_name) = lower(r.table_name) AND r.layer = 'raw'{nothing}
LEFT JOIN fx_load_status g ON lower(s.table_name) = lower(g.table_name) AND g.layer = 'stg'{nothing}
LEFT JOIN fx_load_status m ON lower(s.table_name) = lower(m.table_name) AND m.layer = 'mrg'{nothing}
WHERE lower(s.table_name) <> 'heartbeat'
  AND (({s3_on} AND load_s3) OR ({mrg_on} AND (load_raw OR load_stg OR load_mrg)))
"""


_SQL["load_plan"] = _plan()
_SQL["load_plan_mrg_only"] = _plan(s3_on=False)
_SQL["load_plan_s3_only"] = _plan(mrg_on=False)
_SQL["load_plan_initial"] = _plan(initial=True)


def _flags(mode: str, incremental: bool) -> str:
    return f"""
SELECT upper(core_center) AS core_center, s3_{mode}_load_flag AS s3_load_enabled, mrg_{mode}_load_flag AS mrg_load_enabled,
       upper(raw_schema_name) AS raw_schema_name, upper(stg_schema_name) AS stg_schema_name,
       upper(merge_schema_name) AS mrg_schema_name, {incremental} AS is_incremental
FROM fx_core_centers
"""


_SQL["mode_flags"] = f"{_flags('incremental', True)} UNION ALL {_flags('initial', False)}"

_SQL["folder_window"] = f"""
WITH plan AS ({_plan()}), folders AS ({FOLDERS})
SELECT f.* FROM folders f JOIN plan p USING (table_name)
WHERE p.load_s3 AND CAST(f.cda_timestamp AS BIGINT) > coalesce(p.dest_cda_folder, 0)
  AND CAST(f.cda_timestamp AS BIGINT) <= p.src_cda_folder
"""

MANIFEST_AFTER = f"""
SELECT table_name,
       CASE WHEN newer OR is_new THEN s_schema ELSE d_schema END AS cda_schema_id,
       CASE WHEN newer OR is_new THEN s_folder ELSE d_folder END AS cda_folder,
       CASE WHEN newer OR is_new THEN s_tms ELSE d_tms END AS cda_folder_tms,
       CASE WHEN newer OR is_new THEN s_count ELSE d_count END AS total_records_count,
       CASE WHEN is_new THEN {RUN_TS} ELSE {EARLIER_TS} END AS row_insert_tms,
       CASE WHEN is_new OR newer THEN {RUN_TS} ELSE {EARLIER_TS} END AS row_update_tms,
       CASE WHEN is_new THEN 'insert' WHEN newer THEN 'update' ELSE 'keep' END AS action
FROM (SELECT coalesce(d.table_name, s.table_name) AS table_name, d.table_name IS NULL AS is_new,
             coalesce(d.cda_folder_tms < s.cda_folder_tms, FALSE) AS newer,
             s.cda_schema_id AS s_schema, d.cda_schema_id AS d_schema, s.cda_folder AS s_folder, d.cda_folder AS d_folder,
             s.cda_folder_tms AS s_tms, d.cda_folder_tms AS d_tms,
             s.total_records_count AS s_count, d.total_records_count AS d_count
      FROM fx_dest_manifest d FULL JOIN fx_src_manifest s ON d.table_name = s.table_name)
"""

_SQL["upsert_manifest"] = f"SELECT * EXCLUDE (action) FROM ({MANIFEST_AFTER})"

_SQL["upsert_action_counts"] = f"""
SELECT count(*) FILTER (action = 'insert') AS rows_inserted, count(*) FILTER (action = 'update') AS rows_updated,
       count(*) FILTER (action <> 'keep') AS row_count
FROM ({MANIFEST_AFTER})
"""

STATUS_AFTER = f"""
WITH touched AS (SELECT unnest(['raw', 'stg', 'mrg']) AS layer, table_name FROM ({_plan()}) WHERE load_s3)
SELECT s.layer, s.table_name,
       CASE WHEN t.layer IS NOT NULL AND s.status = 'completed' THEN 4567 ELSE 4566 END AS batch_id,
       CASE WHEN t.layer IS NOT NULL AND s.status = 'completed' THEN 'pending' ELSE s.status END AS status,
       CASE WHEN t.layer IS NOT NULL AND s.status = 'completed' THEN {RUN_TS} ELSE {EARLIER_TS} END AS row_insert_tms,
       CASE WHEN t.layer IS NOT NULL AND s.status = 'completed' THEN {RUN_TS} ELSE {EARLIER_TS} END AS row_update_tms
FROM fx_load_status s LEFT JOIN touched t ON s.layer = t.layer AND s.table_name = t.table_name
UNION ALL
SELECT t.layer, t.table_name, NULL, 'initial', NULL, NULL
FROM touched t WHERE (t.layer, t.table_name) NOT IN (SELECT (layer, table_name) FROM fx_load_status)
"""
_SQL["status_after_load"] = f"""
SELECT layer, table_name, CAST(batch_id AS BIGINT) AS batch_id, status, row_insert_tms, row_update_tms
FROM ({STATUS_AFTER})
"""

_SQL["process_log"] = f"""
WITH arrived AS (SELECT table_name FROM ({_plan()}) WHERE load_s3),
     touched AS (SELECT unnest(['raw', 'stg', 'mrg']) AS layer, table_name FROM arrived)
SELECT CAST(4567 AS BIGINT) AS batchid, schema_name, table_name, 'incremental_load' AS job_name, process_name,
       CAST(row_count AS BIGINT) AS row_count
FROM (SELECT upper(t.layer) || '_PC' AS schema_name, t.table_name, 'merge into load status' AS process_name,
             CASE WHEN s.layer IS NULL OR s.status = 'completed' THEN 1 ELSE 0 END AS row_count
      FROM touched t LEFT JOIN fx_load_status s ON t.layer = s.layer AND t.table_name = s.table_name
      UNION ALL
      SELECT 'RAW_PC', m.table_name, 'merge into manifest details', CASE WHEN m.action = 'keep' THEN 0 ELSE 1 END
      FROM ({MANIFEST_AFTER}) m JOIN arrived a ON lower(m.table_name) = a.table_name)
"""

# Layers

_SQL["audit_counts"] = """
SELECT table_name, CAST(4567 AS BIGINT) AS batch_id, manifest_count AS manifest_total_records_count, raw_count,
       raw_count - manifest_count AS total_records_count_diff, manifest_folder AS manifest_cda_folder,
       raw_folder AS raw_cda_folder, raw_folder <> manifest_folder AS cda_folder_diff, stg_count,
       stg_count - raw_count AS stg_count_diff, mrg_count, expected_mrg_count,
       mrg_count - expected_mrg_count AS expected_mrg_count_diff
FROM fx_layer_counts
"""

FAILURES = """
SELECT table_name, 'raw' AS layer,
       format('RAW_PC.{} | TOTAL_RECORDS_COUNT: table {}, manifest: {} | CDA_FOLDER: table {}, manifest: {}',
              table_name, raw_count, manifest_count, raw_folder, manifest_folder) AS error_message
FROM fx_layer_counts WHERE raw_count <> manifest_count OR raw_folder <> manifest_folder
UNION ALL
SELECT table_name, 'stg', format('STG_PC.{} | RAW count: {}, STG count: {}', table_name, raw_count, stg_count)
FROM fx_layer_counts WHERE stg_count <> raw_count
UNION ALL
SELECT table_name, 'mrg', format('MRG_PC.{} | MRG count: {}, Expected MRG count: {}', table_name, mrg_count, expected_mrg_count)
FROM fx_layer_counts WHERE mrg_count <> expected_mrg_count
"""
_SQL["audit_failures"] = FAILURES

_SQL["error_log"] = f"""
SELECT CAST(4567 AS BIGINT) AS batchid, DATE '2024-02-01' AS day_id, error_message, 'N/A' AS error_sql,
       CASE layer WHEN 'raw' THEN 'load_raw' WHEN 'stg' THEN 'load_stage' ELSE 'load_merge' END AS job_name, {RUN_TS} AS row_insert_tms,
       upper(layer) || '_PC' AS schema_name, table_name
FROM ({FAILURES})
"""

OUTCOMES = f"""
WITH bad AS (SELECT table_name, bool_or(layer = 'raw') AS r, bool_or(layer = 'stg') AS g, bool_or(layer = 'mrg') AS m
             FROM ({FAILURES}) GROUP BY table_name),
     plan AS (SELECT p.table_name, p.load_raw AS lr, p.load_stg AS lg, p.load_mrg AS lm, coalesce(b.r, FALSE) AS r,
                     coalesce(b.g, FALSE) AS g, coalesce(b.m, FALSE) AS m
              FROM ({_plan()}) p LEFT JOIN bad b USING (table_name)),
     raw AS (SELECT *, CASE WHEN NOT lr THEN 'skipped' WHEN r THEN 'failed' ELSE 'completed' END AS o_raw FROM plan),
     stg AS (SELECT *, CASE WHEN o_raw = 'failed' THEN 'blocked' WHEN NOT lg THEN 'skipped' WHEN g THEN 'failed'
                            ELSE 'completed' END AS o_stg FROM raw),
     mrg AS (SELECT *, CASE WHEN o_stg IN ('failed', 'blocked') THEN 'blocked' WHEN NOT lm THEN 'skipped'
                            WHEN m THEN 'failed' ELSE 'completed' END AS o_mrg FROM stg)
SELECT table_name, 'raw' AS layer, o_raw AS outcome FROM mrg
UNION ALL SELECT table_name, 'stg', o_stg FROM mrg
UNION ALL SELECT table_name, 'mrg', o_mrg FROM mrg
"""
_SQL["layer_outcomes"] = OUTCOMES

_SQL["status_transition"] = f"""
SELECT s.layer, s.table_name, CAST(CASE WHEN o.outcome IS NULL THEN 4566 ELSE 4567 END AS BIGINT) AS batch_id,
       coalesce(o.outcome, s.status) AS status, {EARLIER_TS} AS row_insert_tms,
       CASE WHEN o.outcome IS NULL THEN {EARLIER_TS} ELSE {RUN_TS} END AS row_update_tms
FROM fx_load_status s
LEFT JOIN (SELECT * FROM ({OUTCOMES}) WHERE outcome IN ('completed', 'failed')) o
  ON s.layer = o.layer AND s.table_name = o.table_name
"""

IN_WINDOW = f"""
SELECT c.*, CAST(4567 AS BIGINT) AS batchid, {RUN_TS} AS row_insert_tms, {RUN_TS} AS row_update_tms
FROM fx_cdc c JOIN fx_cdc_plan p USING (table_name)
WHERE c.cda_folder > coalesce(p.dest_cda_folder, 0) AND c.cda_folder <= p.src_cda_folder
"""
_SQL["raw_load"] = IN_WINDOW
_SQL["stage_load"] = f"""
SELECT * REPLACE (CASE WHEN cda_folder >= 20240116 THEN payload END AS payload),
       CASE WHEN cda_folder < 20240116 THEN 1 END AS legacy
FROM ({IN_WINDOW})
"""


def _latest(table: str, order: str) -> str:
    return f"SELECT * FROM {table} QUALIFY row_number() OVER (PARTITION BY id ORDER BY {order}) = 1"


LATEST = f"SELECT id, seqval, payload_ts, operation, payload FROM ({_latest('fx_cdc', 'seqval DESC')})"
_SQL["latest_per_key"] = LATEST

_SQL["merge_load"] = f"""
SELECT *, CASE WHEN operation = 'D' THEN 'Y' ELSE 'N' END AS gw_delete_flag, CAST(4567 AS BIGINT) AS batchid,
       {RUN_TS} AS row_insert_tms, {RUN_TS} AS row_update_tms
FROM ({LATEST})
"""

_SQL["merge_load_second_batch"] = f"""
WITH firsts AS (SELECT id, min(payload_ts) AS first_ts FROM fx_cdc GROUP BY id)
SELECT l.*, CASE WHEN operation = 'D' THEN 'Y' ELSE 'N' END AS gw_delete_flag,
       CAST(CASE WHEN payload_ts < TIMESTAMP '2024-01-16' THEN 4566 ELSE 4567 END AS BIGINT) AS batchid,
       CASE WHEN first_ts < TIMESTAMP '2024-01-16' THEN {EARLIER_TS} ELSE {RUN_TS} END AS row_insert_tms,
       CASE WHEN payload_ts < TIMESTAMP '2024-01-16' THEN {EARLIER_TS} ELSE {RUN_TS} END AS row_update_tms
FROM ({LATEST}) l JOIN firsts USING (id)
"""

_SQL["merge_load_lines"] = f"""
SELECT *, CASE WHEN operation = 'D' THEN 'Y' ELSE 'N' END AS gw_delete_flag, CAST(4567 AS BIGINT) AS batchid,
       {RUN_TS} AS row_insert_tms, {RUN_TS} AS row_update_tms
FROM ({_latest('fx_line_changes', 'l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC')})
"""

_SQL["merge_load_lines_second_batch"] = f"""
WITH firsts AS (SELECT id, bool_or(operation = 'U') AS early FROM fx_line_changes GROUP BY id)
SELECT l.*, CASE WHEN operation = 'D' THEN 'Y' ELSE 'N' END AS gw_delete_flag,
       CAST(CASE WHEN operation = 'U' THEN 4566 ELSE 4567 END AS BIGINT) AS batchid,
       CASE WHEN early THEN {EARLIER_TS} ELSE {RUN_TS} END AS row_insert_tms,
       CASE WHEN operation = 'U' THEN {EARLIER_TS} ELSE {RUN_TS} END AS row_update_tms
FROM ({_latest('fx_line_changes', 'l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC')}) l
JOIN firsts USING (id)
"""

_SQL["merge_load_hex_order"] = _SQL["merge_load_lines_second_batch"]

_SQL["merge_load_widened"] = f"""
SELECT operation, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS lines,
       CASE WHEN operation = 'U' THEN 0 ELSE count(*) END AS with_supplier
FROM ({_latest('fx_line_changes', 'l_shipdate DESC, l_linenumber DESC, l_partkey DESC')}) GROUP BY operation
"""

U32 = 4294967295


def spark_hash(number: str, name: str, rows: str) -> str:
    """The 32-bit hash Spark deals a whole number by: two halves mixed in, then finished (fixed constants of the public algorithm)."""

    def times(value: str, factor: int) -> str:
        return f"(({value})::HUGEINT * {factor} & {U32})::BIGINT"

    def turned(value: str, bits: int) -> str:
        return f"(((({value}) << {bits}) & {U32}) | (({value}) >> {32 - bits}))"

    steps, h = f"SELECT *, ({number} & {U32}) AS k0, ({number} >> 32 & {U32}) AS k1, 42::BIGINT AS h0 FROM {rows}", "h0"
    for i in range(2):
        steps = f"SELECT *, {times(f'k{i}', 3432918353)} AS a{i} FROM ({steps})"
        steps = f"SELECT *, xor({h}, {times(turned(f'a{i}', 15), 461845907)}) AS b{i} FROM ({steps})"
        steps = f"SELECT *, ({times(turned(f'b{i}', 13), 5)} + 3864292196) & {U32} AS h{i + 1} FROM ({steps})"
        h = f"h{i + 1}"
    steps = f"SELECT *, xor({h}, 8) AS c0 FROM ({steps})"
    for i, (shift, factor) in enumerate([(16, 2246822507), (13, 3266489909)]):
        steps = f"SELECT *, {times(f'xor(c{i}, c{i} >> {shift})', factor)} AS c{i + 1} FROM ({steps})"
    return f"SELECT *, xor(c2, c2 >> 16) AS u, CASE WHEN u > 2147483647 THEN u - 4294967296 ELSE u END AS {name} FROM ({steps})"


_SQL["merge_touched_partitions"] = f"""
WITH numbered AS (
    SELECT id, ((h % 16384) + 16384) % 16384 AS part FROM ({spark_hash("id", "h", "(SELECT DISTINCT id FROM fx_line_changes)")})
), newest AS (
    SELECT id, operation = 'U' AS early,
           max((l_shipdate, l_linenumber, l_partkey, l_suppkey)) AS newest_at
    FROM fx_line_changes GROUP BY ALL
), sides AS (
    SELECT id, part, max(newest_at) FILTER (early) AS old_at, max(newest_at) FILTER (NOT early) AS new_at FROM newest JOIN numbered USING (id) GROUP BY ALL
)
SELECT part::INT AS part, count(old_at) AS rows_read, count(*) FILTER (old_at IS NULL) AS rows_inserted, count(*) FILTER (new_at > old_at) AS rows_updated
FROM sides GROUP BY part HAVING count(new_at) > 0
"""

_SQL["footer_counts"] = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) AS row_count, min({column})::VARCHAR AS least, max({column})::VARCHAR AS greatest FROM {table}"
    for table, column in [
        ("customer", "c_custkey"), ("orders", "o_orderdate"), ("lineitem", "l_orderkey"), ("events", "event_id"), ("documents", "doc_id"), ("pages", "page_id"),
    ]
)

_SQL["record_range_digests"] = """
WITH told AS (
    SELECT table_name, id, beanversion::VARCHAR AS version, 1 AS mrg FROM fx_merged WHERE gw_delete_flag = 'N'
    UNION ALL SELECT table_name, id, beanversion::VARCHAR, 0 FROM fx_replica
), hashed AS (
    SELECT upper(table_name) AS table_name, floor(id / 128)::BIGINT AS key_range, mrg,
           ('0x' || substr(md5('=' || id || ':' || coalesce('=' || version, '-')), 1, 15))::BIGINT AS h
    FROM told WHERE id IS NOT NULL
), counted AS (
    SELECT table_name, key_range,
           count(*) FILTER (mrg = 1) AS mrg_rows, coalesce(sum(h) FILTER (mrg = 1), 0)::VARCHAR AS mrg_sum, coalesce(bit_xor(h) FILTER (mrg = 1), 0) AS mrg_xor,
           count(*) FILTER (mrg = 0) AS replica_rows, coalesce(sum(h) FILTER (mrg = 0), 0)::VARCHAR AS replica_sum, coalesce(bit_xor(h) FILTER (mrg = 0), 0) AS replica_xor
    FROM hashed GROUP BY ALL
)
SELECT *, (mrg_rows, mrg_sum, mrg_xor) <> (replica_rows, replica_sum, replica_xor) AS differs FROM counted
"""

# Names. The patterns as regular expressions over lower-case names.

BLOCKED = (
    r"regexp_full_match(lower(table_name), '(bc|cc|ab|pc).tmp.*|(bc|cc|ab|pc)(t|tt)_.*|bcst_.*|(cc|ab|pc)st.+|xx_.*"
    r"|(cc|ab|pc)_.*workitem')"
)
_SQL["name_pattern"] = f"SELECT table_name, {BLOCKED} AS matches FROM fx_tables"

FLAGGED = f"""
SELECT table_name, {BLOCKED} OR lower(table_name) IN (SELECT lower(table_name) FROM fx_listed) AS is_blocked
FROM fx_tables
"""
_SQL["blocklist_flag"] = FLAGGED
_SQL["blocklist_filter"] = f"SELECT table_name FROM ({FLAGGED}) WHERE NOT is_blocked"

_SQL["tenant_prefix"] = """
SELECT schema_name, tenant_table_name FROM fx_tables
WHERE upper(left(tenant_table_name, 2)) =
      CASE schema_name WHEN 'MRG_PC' THEN 'PC' WHEN 'MRG_BC' THEN 'BC' WHEN 'MRG_CC' THEN 'CC' WHEN 'MRG_CM' THEN 'AB' END
"""

# Reconciliation


def _lists(side: str) -> str:
    return f"""
SELECT upper(table_name) AS table_name, list(DISTINCT upper(column_name) ORDER BY upper(column_name)) AS columns
FROM fx_columns WHERE side = '{side}' GROUP BY 1
"""


MRG_COLUMNS = f"""
SELECT l.table_name, l.columns, m.cda_folder, m.cda_folder_tms, m.cda_schema_id
FROM ({_lists('mrg')}) l LEFT JOIN fx_dest_manifest m ON l.table_name = upper(m.table_name)
"""
_SQL["columns_with_manifest"] = f"SELECT * REPLACE (array_to_string(columns, ',') AS columns) FROM ({MRG_COLUMNS})"

MRG_COUNTS = """
SELECT t.table_name, count(r.id) AS row_count
FROM fx_tables t LEFT JOIN fx_table_rows r ON r.table_name = t.table_name AND r.side = 'mrg' AND r.gw_delete_flag = 'N'
WHERE t.in_mrg GROUP BY 1
"""
_SQL["live_row_counts"] = MRG_COUNTS

REPLICA_COUNTS = f"""
SELECT t.table_name, count(r.id) AS row_count
FROM fx_tables t LEFT JOIN fx_table_rows r ON r.table_name = t.table_name AND r.side = 'rep'
WHERE t.in_replica AND t.table_name NOT IN (SELECT table_name FROM ({FLAGGED}) WHERE is_blocked) GROUP BY 1
"""
_SQL["replica_row_counts"] = REPLICA_COUNTS

REPLICA = f"""
SELECT upper(c.table_name) AS table_name, c.row_count, l.columns
FROM ({REPLICA_COUNTS}) c JOIN ({_lists('rep')}) l ON upper(c.table_name) = l.table_name
"""
_SQL["replica_columns"] = f"SELECT * REPLACE (array_to_string(columns, ',') AS columns) FROM ({REPLICA})"

_SQL["live_rows"] = "SELECT * FROM fx_merged WHERE gw_delete_flag = 'N'"

METADATA = (
    "['BATCHID', 'GWCBI___CONNECTOR_TS_MS', 'GWCBI___LSN', 'GWCBI___OPERATION', 'GWCBI___PAYLOAD_TS_MS', "
    "'GWCBI___SEQVAL', 'GWCBI___SEQVAL_HEX', 'GWCBI___TX_ID', 'GW_DELETE_FLAG', 'ROW_INSERT_TMS', 'ROW_UPDATE_TMS']"
)

COMPARISON = f"""
SELECT *, list_filter([
           CASE WHEN replica_row_count = 0 THEN 'REPLICA_ROW_COUNT_IS_ZERO' END,
           CASE WHEN mrg_row_count IS NULL AND replica_row_count <> 0 AND NOT is_blocked THEN 'TABLE_MISSING_IN_MRG'
                WHEN replica_row_count IS NULL AND mrg_row_count IS NOT NULL THEN 'TABLE_MISSING_IN_REPLICA' END,
           CASE WHEN row_count_variance <> 0 THEN 'ROW_COUNT_VARIANCE' END,
           CASE WHEN len(columns_variance) > 0 THEN 'COLUMN_VARIANCE' END], lambda r: r IS NOT NULL) AS reasons
FROM (
  SELECT *, coalesce(replica_row_count, 0) - coalesce(mrg_row_count, 0) AS row_count_variance,
         CASE WHEN replica_columns IS NULL THEN mrg_columns
              WHEN mrg_columns IS NULL THEN CASE WHEN replica_row_count = 0 OR is_blocked THEN [] ELSE replica_columns END
              ELSE list_filter(list_concat(mrg_columns, replica_columns), lambda c:
                     list_contains(mrg_columns, c) <> list_contains(replica_columns, c) AND NOT list_contains({METADATA}, c))
         END AS columns_variance
  FROM (
    SELECT CAST(4567 AS BIGINT) AS batch_id, 'MRG_PC' AS schema_name, table_name, m.cda_folder, m.cda_folder_tms,
           m.cda_schema_id, m.columns AS mrg_columns, r.columns AS replica_columns,
           n.row_count AS mrg_row_count, r.row_count AS replica_row_count,
           {BLOCKED} OR lower(table_name) IN (SELECT lower(table_name) FROM fx_listed) AS is_blocked
    FROM ({MRG_COLUMNS}) m
    FULL JOIN (SELECT upper(table_name) AS table_name, row_count FROM ({MRG_COUNTS})) n USING (table_name)
    FULL JOIN ({REPLICA}) r USING (table_name)))
"""

_SQL["column_variance"] = f"""
SELECT table_name, array_to_string(list_sort(columns_variance), ',') AS columns_variance FROM ({COMPARISON})
"""

_SQL["table_comparison"] = f"""
SELECT batch_id, schema_name, table_name, cda_folder, cda_folder_tms, cda_schema_id,
       array_to_string(mrg_columns, ',') AS mrg_columns, array_to_string(replica_columns, ',') AS replica_columns,
       array_to_string(list_sort(columns_variance), ',') AS columns_variance, mrg_row_count, replica_row_count,
       row_count_variance, array_to_string(reasons, ',') AS exclusion_reason
FROM ({COMPARISON})
"""

CANDIDATES = f"""
SELECT batch_id, schema_name, table_name FROM ({COMPARISON})
WHERE NOT list_has_any(reasons, ['REPLICA_ROW_COUNT_IS_ZERO', 'TABLE_MISSING_IN_MRG'])
  AND list_contains(mrg_columns, 'BEANVERSION') AND list_contains(replica_columns, 'BEANVERSION')
"""
_SQL["comparison_candidates"] = CANDIDATES

RECORDS = """
SELECT CAST(4567 AS BIGINT) AS batch_id, 'MRG_PC' AS schema_name, coalesce(m.table_name, r.table_name) AS table_name,
       m.id AS mrg_id, CAST(m.beanversion AS VARCHAR) AS mrg_beanversion, r.id AS replica_id,
       r.beanversion AS replica_beanversion
FROM (SELECT * FROM fx_merged WHERE gw_delete_flag = 'N') m
FULL JOIN fx_replica r ON m.table_name = r.table_name AND m.id = r.id
"""
_SQL["record_comparison"] = RECORDS

_SQL["record_mismatch_counts"] = f"""
SELECT batch_id, schema_name, table_name, count(*) AS id_beanversion_mismatches FROM ({RECORDS})
WHERE mrg_id IS DISTINCT FROM replica_id OR mrg_beanversion IS DISTINCT FROM replica_beanversion
GROUP BY ALL
"""

FINAL = f"""
WITH comparison AS ({COMPARISON}), candidates AS ({CANDIDATES}),
     m AS (SELECT upper(table_name) AS table_name, id, beanversion FROM fx_table_rows
           WHERE side = 'mrg' AND gw_delete_flag = 'N' AND upper(table_name) IN (SELECT table_name FROM candidates)),
     r AS (SELECT upper(table_name) AS table_name, id, beanversion FROM fx_table_rows
           WHERE side = 'rep' AND upper(table_name) IN (SELECT table_name FROM candidates)),
     mismatches AS (SELECT coalesce(m.table_name, r.table_name) AS table_name, count(*) AS n
                    FROM m FULL JOIN r ON m.table_name = r.table_name AND m.id = r.id
                    WHERE m.id IS NULL OR r.id IS NULL OR m.beanversion <> r.beanversion GROUP BY 1)
SELECT c.batch_id, c.schema_name, c.table_name, c.row_count_variance, x.n AS id_beanversion_mismatches,
       CASE WHEN x.n > 0 THEN list_append(c.reasons, 'ID_BEANVERSION_MISMATCHES') ELSE c.reasons END AS reasons
FROM comparison c LEFT JOIN mismatches x USING (table_name)
"""
_SQL["table_comparison_final"] = f"""
SELECT * EXCLUDE (reasons), array_to_string(reasons, ',') AS exclusion_reason FROM ({FINAL})
"""

REPORT = f"""
SELECT schema_name, table_name, array_to_string(reasons, ', ') AS exclusion_reason,
       format('Schema Name: {{}}{{}}Table Name: {{}}{{}}Variance: {{}}{{}}', schema_name, chr(10), table_name, chr(10),
              array_to_string(reasons, ', '), chr(10)) AS text
FROM ({FINAL}) WHERE NOT list_contains(reasons, 'REPLICA_ROW_COUNT_IS_ZERO') AND len(reasons) > 0
"""
_SQL["variance_report"] = REPORT

_SQL["variance_notice"] = f"""
SELECT schema_name, count(*) AS entry_count,
       string_agg(text, repeat(chr(10), 3) ORDER BY table_name) AS notice
FROM ({REPORT}) GROUP BY schema_name
"""

# Outbox

PENDING = """
SELECT * FROM fx_outbox
WHERE submission_status <> 'SUCCESS' AND submission_attempt_count < max_submission_attempt_count
"""
_SQL["outbox_pending"] = PENDING

BATCHES = f"""
SELECT *, row_number() OVER (ORDER BY identity) - 1 AS position,
       CAST((row_number() OVER (ORDER BY identity) - 1) // 100 AS BIGINT) AS batch_no
FROM ({PENDING})
"""
_SQL["outbox_batches"] = f"SELECT identity, position, batch_no FROM ({BATCHES})"

_SQL["outbox_payload"] = f"""
SELECT identity, CAST(json_object('name', name, 'segment', segment) AS VARCHAR) AS payload FROM ({PENDING})
"""

_SQL["outbox_payload_columns"] = f"""
SELECT identity, CAST(json_object('segment', segment, 'identity', identity) AS VARCHAR) AS payload FROM ({PENDING})
"""

_SQL["outbox_writeback"] = f"""
WITH batches AS ({BATCHES}),
     answers AS (SELECT batch_no, CASE count(*) FILTER (segment IS NULL) % 3 WHEN 0 THEN 'SUCCESS' WHEN 1 THEN 'FAILURE' END AS answer
                 FROM batches GROUP BY batch_no),
     sent AS (SELECT identity, answer FROM batches JOIN answers USING (batch_no) WHERE answer IS NOT NULL)
SELECT o.identity, o.name, o.segment, coalesce(s.answer, o.submission_status) AS submission_status,
       CAST(o.submission_attempt_count + CASE WHEN s.answer IS NULL THEN 0 ELSE 1 END AS INTEGER) AS submission_attempt_count,
       o.max_submission_attempt_count
FROM fx_outbox o LEFT JOIN sent s USING (identity)
"""

# Quota and reports

CELLS = f"""
SELECT *, greatest(50, time_cells) AS time_length, greatest(50, credit_cells) AS credit_length
FROM (
  SELECT name, credit_quota, used_credits, frequency, start_time, suspend_pct, stop_pct,
         CAST(round_even(CAST(phase * 50 AS DOUBLE) / period, 0) AS INTEGER) AS time_cells,
         CAST(round_even(CAST(used_credits AS DOUBLE) * 50 / CAST(credit_quota AS DOUBLE), 0) AS INTEGER) AS credit_cells,
         CASE WHEN suspend_pct <> 0 THEN CAST(suspend_pct AS INTEGER) * 50 // 100 END AS suspend_cell,
         CASE WHEN stop_pct <> 0 THEN CAST(stop_pct AS INTEGER) * 50 // 100 END AS stop_cell
  FROM (SELECT *, CASE frequency WHEN 'WEEKLY' THEN 604800 ELSE 86400 END AS period,
               date_diff('second', start_time, {AS_OF}) % period AS phase0,
               CASE WHEN phase0 < 0 THEN phase0 + period ELSE phase0 END AS phase,
               CAST(nullif(replace(trim(suspend_at), '%', ''), '') AS INTEGER) AS suspend_pct,
               CAST(nullif(replace(trim(suspend_immediately_at), '%', ''), '') AS INTEGER) AS stop_pct
        FROM fx_monitors))
"""


def _bar(kind: str) -> str:
    length = f"{kind}_length"
    extended = f"(coalesce(suspend_cell = {length}, FALSE))"
    cells = f"({length} + CASE WHEN {extended} THEN 1 ELSE 0 END)"
    total = f"({cells} + CASE WHEN coalesce(stop_cell = {cells}, FALSE) THEN 1 ELSE 0 END)"
    return f"""
array_to_string(list_transform(range(CAST({total} AS BIGINT)), lambda i:
    CASE WHEN i = coalesce(stop_cell, -1) THEN '🛑' WHEN i = coalesce(suspend_cell, -1) THEN '⚠️'
         WHEN i < {kind}_cells THEN '▓' ELSE '░' END), '')
"""


BARS = f"SELECT *, {_bar('time')} AS time_bar, {_bar('credit')} AS credit_bar FROM ({CELLS})"

_SQL["quota_bars"] = f"""
SELECT name, time_cells, credit_cells, CAST(suspend_cell AS INTEGER) AS suspend_cell, CAST(stop_cell AS INTEGER) AS stop_cell,
       time_bar, credit_bar
FROM ({BARS})
"""

_SQL["quota_report"] = f"""
SELECT name, used_credits > credit_quota AS over_quota,
       array_to_string(list_filter([
         'Resource Monitor Name: ' || name, 'Monitor Frequency: ' || frequency,
         'Frequency Start Time: ' || strftime(start_time, '%Y-%m-%d %H:%M:%S'),
         'Credit Limit: ' || CAST(credit_quota AS VARCHAR), 'Credits Consumed: ' || CAST(used_credits AS VARCHAR),
         'Suspend At: ' || CAST(CAST(credit_quota * suspend_pct / 100 AS DECIMAL(18, 2)) AS VARCHAR),
         'Suspend Immediately At: ' || CAST(CAST(credit_quota * stop_pct / 100 AS DECIMAL(18, 2)) AS VARCHAR),
         'Time:', time_bar, 'Credits:', credit_bar, repeat('-', 50)], lambda l: l IS NOT NULL), chr(10)) AS status
FROM ({BARS})
"""

_REPORT_TEXT = """
SELECT core_center, count(*) AS entry_count,
       {OPEN}string_agg(format('Table Name: {}{}Procedure Name: {}{}Exception: {}{}{}', table_name, chr(10), procedure_name,
                              chr(10), split_part(error_message, chr(10), -1), repeat(chr(10), 2), repeat('*', 56)),
                       repeat(chr(10), 3) ORDER BY table_name, procedure_name){CLOSE} AS notice
FROM fx_errors GROUP BY core_center
"""
_SQL["failure_report"] = _REPORT_TEXT.replace("{OPEN}", "").replace("{CLOSE}", "")
_SQL["failure_report_cut"] = _REPORT_TEXT.replace("{OPEN}", "left(").replace("{CLOSE}", ", 1500)")

_SQL["table_failure_notice"] = """
SELECT schema_name, count(*) AS entry_count,
       string_agg(format('Schema Name: {}{}Table Name: {}{}Exception: {}{}', schema_name, chr(10), table_name, chr(10),
                              split_part(error_message, chr(10), -1), chr(10)),
                       repeat(chr(10), 3) ORDER BY table_name) AS notice
FROM (SELECT 'MRG_' || upper(core_center) AS schema_name, * FROM fx_errors) GROUP BY schema_name
"""

def in_parts(sql: str, group: str, order: str) -> str:
    """The report with a row for every 1,000 entries of a group."""
    numbered = f"SELECT *, (row_number() OVER (PARTITION BY {group} ORDER BY {order}) - 1) // 1000 AS part_no FROM"
    head, tail = sql.rsplit("\nFROM ", 1)
    rows = tail.rsplit(" GROUP BY ", 1)[0]
    return f"{head.replace('SELECT ' + group + ',', 'SELECT ' + group + ', part_no,', 1)}\nFROM ({numbered} {rows}) GROUP BY {group}, part_no"


_SQL["failure_report_parts"] = in_parts(_SQL["failure_report"], "core_center", "table_name, procedure_name, error_message")
_SQL["table_failure_notice_parts"] = in_parts(_SQL["table_failure_notice"], "schema_name", "table_name, error_message")

ORACLES = {name: duckdb_with(sql) for name, sql in _SQL.items()}
