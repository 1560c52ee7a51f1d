"""Registered queries: the monitoring views and operational reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedmill.operators import coverage, discovery, mapping, quality
from feedmill.plans import reports as R
from feedmill.plans import views as V
from feedmill.queries import tables as T
from feedmill.queries.tables import Query, as_of, sql, with_text_times as shown

TS = "'%Y-%m-%d %H:%M:%S'"


def ts(*names: str) -> str:
    return ", ".join(f"strftime({n}, {TS}) AS {n.split('.')[-1]}" for n in names)


def _hours(a: str, b: str) -> str:
    return f"date_diff('hour', {a}, {b})"


NOW = f"TIMESTAMP '{T.AS_OF}'"
LOG_NOW = "1998-06-15 00:00:00"
SECONDS = "date_diff('second', start_timestamp, end_timestamp)"

VIEWS = {
    "view_01_transformation_status": Query(
        lambda s, d: shown(V.transformation_status_summary(T.log(s, d))),
        sql("log", f"""
SELECT target_table, status, count(*) AS batch_count, CAST(sum(records_processed) AS BIGINT) AS total_processed,
       CAST(sum(records_rejected) AS BIGINT) AS total_rejected,
       round(avg({SECONDS}), 4) AS avg_duration_seconds,
       strftime(max(end_timestamp), {TS}) AS last_batch_timestamp
FROM log WHERE end_timestamp IS NOT NULL GROUP BY target_table, status"""),
    ),
    "view_02_recent_batches": Query(
        lambda s, d: shown(V.recent_transformation_batches(T.log(s, d))),
        sql("log", f"""
SELECT batch_id, source_table, target_table, status, records_read, records_processed, records_rejected,
       rules_applied, {SECONDS} AS duration_seconds, {ts('start_timestamp', 'end_timestamp')}, error_message
FROM (SELECT * FROM log ORDER BY log.start_timestamp DESC, batch_id DESC LIMIT 100)"""),
    ),
    "view_03_quality_dashboard": Query(
        lambda s, d: shown(V.data_quality_dashboard(T.metrics(s, d))),
        sql("metrics", f"""
SELECT metric_id, batch_id, table_name, column_name, metric_type, round(metric_value, 4) AS metric_value,
       threshold_value, pass_fail, rule_id, {ts('measurement_timestamp')} FROM metrics"""),
    ),
    "view_04_quarantine_summary": Query(
        lambda s, d: shown(V.quarantine_summary(T.quarantine(s, d))),
        sql("quarantine", f"""
SELECT target_table, count(*) AS total_quarantined_records, count(CASE WHEN resolved THEN 1 END) AS resolved_records,
       count(CASE WHEN NOT resolved THEN 1 END) AS unresolved_records,
       strftime(min(quarantine_timestamp), {TS}) AS first_quarantine_timestamp,
       strftime(max(quarantine_timestamp), {TS}) AS last_quarantine_timestamp
FROM quarantine GROUP BY target_table"""),
    ),
    "view_05_watermark_status": Query(
        lambda s, d: shown(V.watermark_status(T.watermarks(s, d), as_of())),
        sql("watermarks", f"""
SELECT watermark_id, source_table, target_table, last_processed_id, records_processed, {ts('updated_timestamp')},
       {_hours('watermarks.updated_timestamp', NOW)} AS hours_since_update,
       CASE WHEN watermarks.updated_timestamp IS NULL THEN 'Never Processed'
            WHEN {_hours('watermarks.updated_timestamp', NOW)} > 24 THEN 'Stale (>24h)'
            WHEN {_hours('watermarks.updated_timestamp', NOW)} > 6 THEN 'Warning (>6h)' ELSE 'Current' END AS status
FROM watermarks"""),
    ),
    "view_06_mappings_by_tpa": Query(
        lambda s, d: V.field_mappings_by_tpa(T.mappings(s, d)).select(
            "mapping_id", "source_field", "source_table", "target_table", "target_column", "tpa",
            "mapping_method", "confidence_score", "transformation_logic", "approved", "description"),
        sql("mappings", """
SELECT mapping_id, source_field, source_table, target_table, target_column, coalesce(tpa, 'ALL') AS tpa,
       mapping_method, confidence_score, transformation_logic, approved, description FROM mappings WHERE approved"""),
    ),
    "view_07_rules_by_tpa": Query(
        lambda s, d: shown(V.transformation_rules_by_tpa(T.rules(s, d))),
        sql("rules", f"""
SELECT rule_id, rule_name, rule_type, target_table, target_column, coalesce(tpa, 'ALL') AS tpa, rule_logic,
       priority, error_action, active, {ts('created_timestamp')} FROM rules WHERE active"""),
    ),
    "view_08_target_field_status": Query(
        lambda s, d: shown(coverage.target_field_status(T.schemas(s, d), T.mappings(s, d))),
        sql("schemas mappings", """
SELECT f.table_name, f.column_name,
       CASE WHEN bool_or(m.mapping_id IS NOT NULL AND m.tpa IS NULL) THEN 'Mapped (Global)' ELSE 'Unmapped' END AS mapping_status,
       coalesce(array_to_string(list_sort(list(DISTINCT m.tpa) FILTER (m.tpa IS NOT NULL)), '|'), '') AS mapped_for_tpas
FROM (SELECT DISTINCT table_name, column_name FROM schemas WHERE active) f
LEFT JOIN (SELECT * FROM mappings WHERE approved) m
  ON m.target_table = f.table_name AND m.target_column = f.column_name
GROUP BY f.table_name, f.column_name"""),
    ),
    "view_09_file_mapping_coverage": Query(
        lambda s, d: shown(coverage.file_mapping_coverage(T.raw(s, d), *coverage_metadata(s, d))),
        None,
    ),
    "view_10_schemas_summary": Query(
        lambda s, d: shown(V.target_schemas_summary(T.schemas(s, d))),
        sql("schemas", f"""
SELECT table_name, tpa, count(*) AS column_count, count(CASE WHEN NOT nullable THEN 1 END) AS required_columns,
       strftime(max(created_timestamp), {TS}) AS last_modified
FROM schemas WHERE active GROUP BY table_name, tpa"""),
    ),
    "view_11_creation_readiness": Query(
        lambda s, d: V.table_creation_readiness(T.schemas(s, d)),
        sql("schemas", """
SELECT table_name, count(*) AS column_count, CASE WHEN count(*) = 0 THEN 'NOT READY - No columns defined' ELSE 'READY' END AS status
FROM schemas WHERE active GROUP BY table_name, tpa"""),
    ),
    "view_12_mapping_summary": Query(
        lambda s, d: shown(V.field_mapping_summary(T.mappings(s, d))),
        sql("mappings", """
SELECT mapping_method, approved, count(*) AS mapping_count, round(avg(confidence_score), 4) AS avg_confidence,
       round(min(confidence_score), 4) AS min_confidence, round(max(confidence_score), 4) AS max_confidence
FROM mappings GROUP BY mapping_method, approved"""),
    ),
    "view_13_duplicate_targets": Query(
        lambda s, d: V.duplicate_target_mappings(T.mappings(s, d)),
        sql("mappings", """
SELECT target_table, target_column, count(*) AS mapping_count,
       string_agg(entry, ', ' ORDER BY entry) AS source_fields
FROM (SELECT *, source_field || ' (' || mapping_method || ', conf=' || CAST(confidence_score AS VARCHAR) || ')' AS entry FROM mappings)
GROUP BY target_table, target_column HAVING count(*) > 1"""),
    ),
    "view_14_unmapped_targets": Query(
        lambda s, d: coverage.unmapped_target_fields(T.schemas(s, d), T.mappings(s, d)),
        sql("schemas mappings", """
SELECT table_name, column_name, description FROM schemas s WHERE active AND NOT EXISTS (
  SELECT 1 FROM mappings m WHERE m.target_table = s.table_name AND m.target_column = s.column_name)"""),
    ),
    "view_15_rules_summary": Query(
        lambda s, d: shown(V.rules_summary(T.rules(s, d))),
        sql("rules", """
SELECT rule_type, active, count(*) AS rule_count, count(DISTINCT target_table) AS affected_tables,
       round(avg(priority), 4) AS avg_priority FROM rules GROUP BY rule_type, active"""),
    ),
    "view_16_rule_history": Query(
        lambda s, d: shown(V.rule_execution_history(T.metrics(s, d), T.rules(s, d))),
        sql("metrics rules", f"""
SELECT m.rule_id, r.rule_name, r.rule_type, count(*) AS execution_count,
       count(CASE WHEN pass_fail = 'PASS' THEN 1 END) AS pass_count,
       count(CASE WHEN pass_fail = 'FAIL' THEN 1 END) AS fail_count,
       count(CASE WHEN pass_fail = 'WARNING' THEN 1 END) AS warning_count,
       round(avg(metric_value), 4) AS avg_metric_value, strftime(max(measurement_timestamp), {TS}) AS last_execution
FROM metrics m JOIN rules r ON m.rule_id = r.rule_id GROUP BY m.rule_id, r.rule_name, r.rule_type"""),
    ),
    "view_17_error_files": Query(
        lambda s, d: shown(V.error_files(T.listing(s, d), T.queue(s, d), as_of())),
        sql("listing queue", f"""
SELECT l.path AS file_name, l.size AS file_size_bytes, round(l.size / CAST(1024 AS DOUBLE), 2) AS file_size_kb,
       strftime(l.last_modified, {TS}) AS last_modified, q.file_type, q.status, q.error_message,
       {ts('q.discovered_timestamp', 'q.processed_timestamp')},
       {_hours('l.last_modified', NOW)} AS hours_in_error_stage
FROM listing l LEFT JOIN queue q ON l.path = q.file_name"""),
    ),
}

# -- coverage over the raw objects ----------------------------------------------

COVERAGE_SQL = """
cov_tables AS (SELECT DISTINCT event_type AS tpa, 'T_' || upper(event_type) AS table_name FROM events),
cov_mappings AS (
  SELECT DISTINCT m.source_field, 'T_' || upper(event_type) AS target_table, m.target_column,
         CASE WHEN m.own THEN event_type END AS tpa
  FROM events, (VALUES ('USER_ID', 'MEMBER', false), ('K', 'KEY_VALUE', true), ('VALUE', 'AMOUNT', true)) m(source_field, target_column, own)),
newest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY load_timestamp DESC, raw_id DESC) AS rn FROM raw) WHERE rn = 1),
cols AS (
  SELECT file_name, tpa, unnest(CASE tpa WHEN 'error' THEN ['event_id', 'k', 'user_id']
         WHEN 'signup' THEN ['event_id', 'k', 'USER_ID', 'value'] ELSE ['event_id', 'k', 'user_id', 'value'] END) AS source_column FROM newest),
pairs AS (
  SELECT c.file_name, t.table_name AS target_table, c.source_column, m.target_column
  FROM cols c CROSS JOIN (SELECT DISTINCT table_name FROM cov_tables) t
  LEFT JOIN cov_mappings m ON upper(trim(c.source_column)) = upper(trim(m.source_field))
    AND m.target_table = t.table_name AND (m.tpa IS NULL OR m.tpa = c.tpa)),
cov AS (
  SELECT file_name, target_table, count(DISTINCT source_column) AS total_source_columns,
         count(DISTINCT CASE WHEN target_column IS NOT NULL THEN source_column END) AS mapped_columns,
         count(DISTINCT CASE WHEN target_column IS NULL THEN source_column END) AS unmapped_columns,
         round(count(DISTINCT CASE WHEN target_column IS NOT NULL THEN source_column END) * CAST(100 AS DOUBLE)
               / count(DISTINCT source_column), 2) AS mapping_coverage_pct,
         list_sort(list(DISTINCT source_column)) AS all_list,
         coalesce(list_sort(list(DISTINCT source_column) FILTER (target_column IS NOT NULL)), []) AS mapped_list,
         coalesce(list_sort(list(DISTINCT target_column) FILTER (target_column IS NOT NULL)), []) AS target_list
  FROM pairs GROUP BY file_name, target_table)"""


def coverage_sql(body: str) -> str:
    return sql("raw", "").rstrip() + ",\n" + COVERAGE_SQL.strip() + "\n" + body


def coverage_metadata(s, d):
    """One target table per provider and three mappings each, derived from the events."""
    types = T.load(s, d, "events").select("event_type").distinct()
    table = F.concat(F.lit("T_"), F.upper("event_type"))
    schemas = types.select(table.alias("table_name"), F.lit(True).alias("active"))
    entries = F.array(*[
        F.struct(F.lit(a).alias("source_field"), F.lit(b).alias("target_column"), F.lit(own).alias("own"))
        for a, b, own in (("USER_ID", "MEMBER", False), ("K", "KEY_VALUE", True), ("VALUE", "AMOUNT", True))
    ])
    mappings = types.withColumn("e", F.explode(entries)).select(
        "e.source_field", table.alias("target_table"), "e.target_column",
        F.when(F.col("e.own"), F.col("event_type")).alias("tpa"),
        F.lit(True).alias("approved"), F.lit(1).alias("mapping_id"),
    )
    return schemas, mappings


_STATUS = """CASE WHEN mapping_coverage_pct >= 80 THEN 'Good' WHEN mapping_coverage_pct >= 50 THEN 'Fair' ELSE 'Poor' END"""
VIEWS["view_09_file_mapping_coverage"].sql = coverage_sql(f"""
SELECT file_name, target_table, total_source_columns, mapped_columns, unmapped_columns, mapping_coverage_pct,
       {_STATUS} AS coverage_status, array_to_string(all_list, '|') AS all_source_columns,
       array_to_string(mapped_list, '|') AS mapped_column_list, array_to_string(target_list, '|') AS target_column_list FROM cov""")


def _coverage(s, d):
    return coverage.file_mapping_coverage(T.raw(s, d), *coverage_metadata(s, d))


_LOAD = f"strftime(min(load_timestamp), {TS}) AS first_upload, strftime(max(load_timestamp), {TS}) AS last_upload"
ROWS_IN = "CASE WHEN process_result LIKE '%rows%' THEN TRY_CAST(regexp_extract(process_result, '[0-9]+') AS INTEGER) ELSE 0 END"

REPORTS = {
    "rep_01_queue_status": Query(
        lambda s, d: shown(R.queue_status(T.queue(s, d))),
        sql("queue", f"""SELECT status, file_type, count(*) AS file_count, strftime(min(discovered_timestamp), {TS}) AS oldest,
            strftime(max(discovered_timestamp), {TS}) AS newest FROM queue GROUP BY status, file_type""")),
    "rep_02_files_per_stage": Query(
        lambda s, d: R.files_per_stage({
            "SRC": T.queue(s, d).filter("status = 'PENDING'"),
            "COMPLETED": T.queue(s, d).filter("status = 'SUCCESS'"),
            "ERROR": T.queue(s, d).filter("status = 'FAILED'")}),
        sql("queue", """SELECT 'SRC' AS stage, count(*) AS file_count FROM queue WHERE status = 'PENDING'
            UNION ALL SELECT 'COMPLETED', count(*) FROM queue WHERE status = 'SUCCESS'
            UNION ALL SELECT 'ERROR', count(*) FROM queue WHERE status = 'FAILED'""")),
    "rep_03_recent_loads": Query(
        lambda s, d: shown(R.recent_loads(T.raw(s, d, False), as_of(), 72)),
        sql("raw", f"""SELECT file_name, count(DISTINCT file_row_number) AS rows_loaded, strftime(max(load_timestamp), {TS}) AS last_load_time
            FROM raw WHERE load_timestamp >= {NOW} - INTERVAL 72 HOUR GROUP BY file_name""")),
    "rep_04_queue_history": Query(
        lambda s, d: shown(R.queue_history(T.queue(s, d))),
        sql("queue", f"""SELECT queue_id, file_name, file_type, status, process_result,
            {ts('discovered_timestamp', 'processed_timestamp', 'moved_timestamp')}, error_message
            FROM queue ORDER BY queue_id DESC LIMIT 50""")),
    "rep_05_active_providers": Query(
        lambda s, d: R.providers(T.master(s, d), active_only=True),
        sql("master", "SELECT tpa_code, tpa_name, active FROM master WHERE active")),
    "rep_05_all_providers": Query(
        lambda s, d: R.providers(T.master(s, d)),
        sql("master", "SELECT tpa_code, tpa_name, active FROM master")),
    "rep_06_provider_usage": Query(
        lambda s, d: shown(R.provider_usage(T.master(s, d), T.raw(s, d, False))),
        sql("master", f"""SELECT m.tpa_code, m.tpa_name, m.active, count(DISTINCT r.file_name) AS file_count, count(*) AS row_count, {_LOAD}
            FROM master m LEFT JOIN raw r ON m.tpa_code = r.tpa GROUP BY m.tpa_code, m.tpa_name, m.active""")),
    "rep_07_provider_file_status": Query(
        lambda s, d: shown(R.provider_file_status(T.master(s, d), T.raw(s, d, False), T.queue(s, d))),
        sql("master queue", """SELECT m.tpa_code, m.tpa_name, count(*) AS total_files,
            count(CASE WHEN q.status = 'SUCCESS' THEN 1 END) AS successful_files,
            count(CASE WHEN q.status = 'FAILED' THEN 1 END) AS failed_files,
            count(CASE WHEN q.status = 'PENDING' THEN 1 END) AS pending_files,
            round(CAST(100 AS DOUBLE) * count(CASE WHEN q.status = 'SUCCESS' THEN 1 END) / count(*), 2) AS success_rate
            FROM master m JOIN raw r ON m.tpa_code = r.tpa JOIN queue q ON r.file_name = q.file_name
            GROUP BY m.tpa_code, m.tpa_name""")),
    "rep_07_provider_file_status_per_file": Query(
        lambda s, d: shown(R.provider_file_status(T.master(s, d), T.raw(s, d, False), T.queue(s, d), per_file=True)),
        sql("master queue", """SELECT m.tpa_code, m.tpa_name, count(*) AS total_files,
            count(CASE WHEN q.status = 'SUCCESS' THEN 1 END) AS successful_files,
            count(CASE WHEN q.status = 'FAILED' THEN 1 END) AS failed_files,
            count(CASE WHEN q.status = 'PENDING' THEN 1 END) AS pending_files,
            round(CAST(100 AS DOUBLE) * count(CASE WHEN q.status = 'SUCCESS' THEN 1 END) / count(*), 2) AS success_rate
            FROM master m JOIN (SELECT DISTINCT tpa, file_name FROM raw) r ON m.tpa_code = r.tpa JOIN queue q ON r.file_name = q.file_name
            GROUP BY m.tpa_code, m.tpa_name""")),
    "rep_08_provider_uploads": Query(
        lambda s, d: shown(R.provider_uploads(T.raw(s, d, False), as_of())),
        sql("raw", f"""SELECT tpa, count(DISTINCT file_name) AS files_uploaded, count(*) AS rows_loaded, {_LOAD}
            FROM raw WHERE load_timestamp >= {NOW} - INTERVAL 7 DAY GROUP BY tpa""")),
    "rep_09_provider_volume": Query(
        lambda s, d: shown(R.provider_volume(T.raw(s, d, False))),
        sql("raw", """SELECT tpa, count(DISTINCT file_name) AS file_count, count(*) AS row_count, CAST(sum(file_size) AS BIGINT) AS total_bytes,
            round(CAST(sum(file_size) AS DOUBLE) / 1024 / 1024, 2) AS total_mb, round(avg(file_size) / 1024 / 1024, 2) AS avg_file_mb
            FROM raw GROUP BY tpa""")),
    "rep_09_provider_volume_per_file": Query(
        lambda s, d: shown(R.provider_volume(T.raw(s, d, False), per_file=True)),
        sql("raw", """SELECT tpa, count(*) AS file_count, CAST(sum(n) AS BIGINT) AS row_count, CAST(sum(size) AS BIGINT) AS total_bytes,
            round(CAST(sum(size) AS DOUBLE) / 1024 / 1024, 2) AS total_mb, round(avg(size) / 1024 / 1024, 2) AS avg_file_mb
            FROM (SELECT tpa, file_name, count(*) AS n, max(file_size) AS size FROM raw GROUP BY ALL) GROUP BY tpa""")),
    "rep_10_orphan_providers": Query(
        lambda s, d: R.orphan_providers(T.raw(s, d, False), T.master(s, d)),
        sql("master", """SELECT r.tpa, count(DISTINCT r.file_name) AS file_count, count(*) AS row_count
            FROM raw r LEFT JOIN master m ON r.tpa = m.tpa_code WHERE m.tpa_code IS NULL GROUP BY r.tpa""")),
    "rep_11_null_provider_totals": Query(
        lambda s, d: R.null_provider_totals(_some_null_tpa(s, d)),
        sql("raw", "SELECT count(*) AS null_tpa_count, count(DISTINCT file_name) AS affected_files FROM raw WHERE value > 450")),
    "rep_11_null_provider_files": Query(
        lambda s, d: shown(R.null_provider_files(_some_null_tpa(s, d))),
        sql("raw", f"""SELECT file_name, stage_name, strftime(min(load_timestamp), {TS}) AS first_loaded, count(*) AS row_count
            FROM raw WHERE value > 450 GROUP BY file_name, stage_name""")),
    "rep_12_processed_files": Query(
        lambda s, d: shown(R.processed_files(T.queue(s, d), T.raw(s, d, False)).select(
            "file_name", "file_type", "status", "discovered_timestamp", "processed_timestamp",
            "process_result", "error_message", "tpa")),
        sql("raw queue", f"""SELECT q.file_name, file_type, status, {ts('discovered_timestamp', 'processed_timestamp')},
            process_result, error_message, coalesce(r.tpa, 'N/A') AS tpa
            FROM queue q LEFT JOIN (SELECT DISTINCT file_name, tpa FROM raw) r ON q.file_name = r.file_name""")),
    "rep_13_processing_statistics": Query(
        lambda s, d: R.processing_statistics(T.queue(s, d)),
        sql("queue", f"""SELECT count(*) AS total_files, count(CASE WHEN status = 'SUCCESS' THEN 1 END) AS successful_files,
            count(CASE WHEN status = 'FAILED' THEN 1 END) AS failed_files, count(CASE WHEN status = 'PROCESSING' THEN 1 END) AS processing_files,
            count(CASE WHEN status = 'PENDING' THEN 1 END) AS pending_files, CAST(sum({ROWS_IN}) AS BIGINT) AS total_rows_processed FROM queue""")),
    "rep_13_processing_statistics_of_provider": Query(
        lambda s, d: R.processing_statistics(T.queue(s, d), T.raw(s, d, False), "click"),
        sql("raw queue", f"""SELECT count(*) AS total_files, count(CASE WHEN status = 'SUCCESS' THEN 1 END) AS successful_files,
            count(CASE WHEN status = 'FAILED' THEN 1 END) AS failed_files, count(CASE WHEN status = 'PROCESSING' THEN 1 END) AS processing_files,
            count(CASE WHEN status = 'PENDING' THEN 1 END) AS pending_files, CAST(sum({ROWS_IN}) AS BIGINT) AS total_rows_processed FROM queue
            WHERE file_name IN (SELECT file_name FROM raw WHERE tpa = 'click')""")),
    "rep_14_raw_summary": Query(
        lambda s, d: shown(R.raw_summary(T.raw(s, d, False))),
        sql("raw", f"""SELECT count(*) AS total_rows, count(DISTINCT file_name) AS unique_files, count(DISTINCT tpa) AS unique_tpas,
            strftime(min(load_timestamp), {TS}) AS earliest_load, strftime(max(load_timestamp), {TS}) AS latest_load FROM raw""")),
    "rep_15_mapping_totals": Query(
        lambda s, d: R.mapping_totals(T.mappings(s, d)),
        sql("mappings", """SELECT count(*) AS total_mappings, count(CASE WHEN approved THEN 1 END) AS approved_mappings,
            count(DISTINCT target_table) AS target_tables, count(DISTINCT source_field) AS source_fields FROM mappings""")),
    "rep_15_rule_totals": Query(
        lambda s, d: R.rule_totals(T.rules(s, d)),
        sql("rules", "SELECT count(*) AS total_rules, count(CASE WHEN active THEN 1 END) AS active_rules, count(DISTINCT rule_type) AS rule_types FROM rules")),
    "rep_16_table_statistics": Query(
        lambda s, d: shown(quality.table_statistics(T.claims(s, d).select("claim_num", "status", "billed", "service_date", "paid_date"))),
        sql("claims", "SELECT count(*) AS row_count, CAST(5 AS INTEGER) AS column_count, count(DISTINCT claim_num) AS distinct_keys, strftime(max(service_date), '%Y-%m-%d') AS latest_date FROM claims")),
    "rep_17_quality_score": Query(
        lambda s, d: shown(R.overall_quality_score(T.metrics(s, d))),
        sql("metrics", """SELECT round(avg(CASE WHEN pass_fail = 'PASS' THEN CAST(100 AS DOUBLE) ELSE 0 END), 4) AS quality_score,
            count(DISTINCT table_name) AS tables_monitored FROM metrics""")),
    "rep_18_coverage_summary": Query(
        lambda s, d: shown(coverage.coverage_summary(T.raw(s, d), *coverage_metadata(s, d))),
        coverage_sql(f"""SELECT count(*) AS files, round(avg(mapping_coverage_pct), 4) AS avg_coverage_pct,
            count(CASE WHEN {_STATUS} = 'Good' THEN 1 END) AS good_files, count(CASE WHEN {_STATUS} = 'Poor' THEN 1 END) AS poor_files FROM cov""")),
    "rep_19_unmapped_columns": Query(
        lambda s, d: shown(coverage.unmapped_source_columns(_coverage(s, d))),
        coverage_sql("""SELECT file_name, target_table,
            array_to_string(list_filter(all_list, lambda x: NOT list_contains(mapped_list, x)), '|') AS unmapped_column_list FROM cov""")),
    "join_12_column_hits": Query(
        lambda s, d: coverage.column_hits(coverage.file_columns(T.raw(s, d)), coverage_metadata(s, d)[1]).groupBy(
            "file_name", "target_table").agg(F.count(F.lit(1)).alias("hits"), F.min("target_column").alias("first_target")),
        coverage_sql("""SELECT file_name, target_table, count(*) AS hits, min(target_column) AS first_target
            FROM pairs WHERE target_column IS NOT NULL GROUP BY file_name, target_table""")),
    "rep_20_field_inventory": Query(
        lambda s, d: mapping.field_inventory(T.raw(s, d)),
        sql("raw", """SELECT source_field_name, count(*) AS occurrence_count, count(DISTINCT file_name) AS file_count FROM (
            SELECT file_name, unnest(CASE tpa WHEN 'error' THEN ['event_id', 'k', 'user_id']
              WHEN 'signup' THEN ['event_id', 'k', 'USER_ID', 'value'] ELSE ['event_id', 'k', 'user_id', 'value'] END) AS source_field_name FROM raw)
            GROUP BY source_field_name""")),
    "rep_21_schema_discovery": Query(
        lambda s, d: discovery.discover_schema(T.raw(s, d)),
        sql("raw", """SELECT field_name, mode(type) AS data_type, count(CASE WHEN type = 'VOID' THEN 1 END) AS null_count,
              count(DISTINCT val) AS distinct_count, count(*) AS sample_count FROM (
            SELECT 'event_id' AS field_name, 'STRING' AS type, CAST(raw_id AS VARCHAR) AS val FROM raw
            UNION ALL SELECT 'k', 'STRING', k FROM raw
            UNION ALL SELECT CASE WHEN tpa = 'signup' THEN 'USER_ID' ELSE 'user_id' END, 'STRING', CAST(user_id AS VARCHAR) FROM raw
            UNION ALL SELECT 'value', CASE WHEN value <= 400 THEN 'STRING' ELSE 'VOID' END, CASE WHEN value <= 400 THEN CAST(value AS VARCHAR) END FROM raw WHERE tpa <> 'error')
            GROUP BY field_name""")),
    "rep_22_daily_batch_trend": Query(
        lambda s, d: shown(R.daily_batch_trend(T.log(s, d), as_of(LOG_NOW))),
        sql("log", f"""SELECT strftime(start_timestamp, '%Y-%m-%d') AS date, count(*) AS batches, CAST(sum(records_processed) AS BIGINT) AS total_records,
            round(avg({SECONDS}), 4) AS avg_duration_sec, count(CASE WHEN status = 'SUCCESS' THEN 1 END) AS successful_batches
            FROM log WHERE start_timestamp >= TIMESTAMP '{LOG_NOW}' - INTERVAL 7 DAY GROUP BY 1""")),
    "rep_23_quality_trend": Query(
        lambda s, d: shown(R.quality_trend(T.metrics(s, d), as_of())),
        sql("metrics", f"""SELECT strftime(measurement_timestamp, '%Y-%m-%d') AS date, metric_type, round(avg(metric_value), 4) AS avg_score,
            round(min(metric_value), 4) AS min_score, round(max(metric_value), 4) AS max_score
            FROM metrics WHERE measurement_timestamp >= {NOW} - INTERVAL 30 DAY GROUP BY 1, 2""")),
    "rep_24_quarantine_reasons": Query(
        lambda s, d: R.top_quarantine_reasons(T.quarantine(s, d)),
        sql("quarantine", """SELECT rule_id, count(*) AS violation_count, count(DISTINCT quarantine_id) AS unique_records
            FROM (SELECT quarantine_id, unnest(failed_rules) AS rule_id FROM quarantine WHERE NOT resolved)
            GROUP BY rule_id ORDER BY violation_count DESC, rule_id LIMIT 10""")),
    "rep_25_quarantine_rate": Query(
        lambda s, d: shown(R.quarantine_rate(T.log(s, d), as_of(LOG_NOW), hours=24 * 365)),
        sql("log", f"""SELECT round(sum(records_rejected) * CAST(100 AS DOUBLE) / sum(records_read), 4) AS quarantine_rate,
            coalesce(sum(records_rejected) * CAST(100 AS DOUBLE) / sum(records_read) > 10, false) AS alert
            FROM log WHERE start_timestamp >= TIMESTAMP '{LOG_NOW}' - INTERVAL {24 * 365} HOUR""")),
    "rep_26_records_by_file": Query(
        lambda s, d: shown(R.records_by_file(T.raw(s, d, False), "file_name", "load_timestamp")),
        sql("raw", f"""SELECT file_name AS source_file_name, count(*) AS record_count, strftime(min(load_timestamp), {TS}) AS first_ingested,
            strftime(max(load_timestamp), {TS}) AS last_ingested FROM raw GROUP BY file_name""")),
    "rep_27_batch_metrics": Query(
        lambda s, d: shown(R.batch_metrics_per_target(T.log(s, d))),
        sql("log", f"""SELECT target_table, round(avg({SECONDS}), 4) AS avg_seconds, round(avg(records_processed), 4) AS avg_records
            FROM log WHERE status = 'SUCCESS' GROUP BY target_table""")),
    "rep_28_queue_durations": Query(
        lambda s, d: shown(R.queue_durations(T.queue(s, d))),
        sql("queue", f"""SELECT status, count(*) AS files, CAST(sum({ROWS_IN}) AS BIGINT) AS rows,
            round(avg(date_diff('second', discovered_timestamp, processed_timestamp)), 4) AS avg_seconds FROM queue GROUP BY status""")),
    "rep_29_config_checks": Query(
        lambda s, d: R.config_checks(T.schemas(s, d), T.mappings(s, d), T.rules(s, d)),
        sql("schemas mappings rules", """SELECT component, found, CASE WHEN found > 0 THEN 'PASS' ELSE 'FAIL' END AS check_result FROM (
            SELECT 'Target tables' AS component, count(DISTINCT table_name) AS found FROM schemas
            UNION ALL SELECT 'Target columns', count(*) FROM schemas UNION ALL SELECT 'Field mappings', count(*) FROM mappings
            UNION ALL SELECT 'Transformation rules', count(*) FROM rules)""")),
    "rep_30_mappings_per_tpa": Query(
        lambda s, d: R.mappings_per_tpa(T.mappings(s, d)),
        sql("mappings", "SELECT tpa, count(*) AS mapping_count FROM mappings WHERE approved GROUP BY tpa")),
    "rep_30_rules_per_tpa": Query(
        lambda s, d: R.rules_per_tpa(T.rules(s, d)),
        sql("rules", "SELECT tpa, rule_type, count(*) AS rule_count FROM rules WHERE active GROUP BY tpa, rule_type")),
    "rep_31_quarantine_list": Query(
        lambda s, d: shown(R.quarantine_list(T.quarantine(s, d).select("quarantine_timestamp", "quarantine_id"))),
        sql("quarantine", f"""SELECT strftime(t, {TS}) AS quarantine_timestamp, quarantine_id FROM (
            SELECT quarantine_timestamp AS t, quarantine_id FROM quarantine ORDER BY t DESC, quarantine_id DESC LIMIT 50)""")),
    "rep_32_rows_per_provider": Query(
        lambda s, d: shown(R.rows_per_provider(T.raw(s, d, False))),
        sql("raw", f"SELECT tpa, count(*) AS row_count, count(DISTINCT file_name) AS file_count, {_LOAD} FROM raw GROUP BY tpa")),
    "rep_32_rows_per_provider_file": Query(
        lambda s, d: shown(R.rows_per_provider(T.raw(s, d, False), by_file=True)),
        sql("raw", f"SELECT tpa, file_name, count(*) AS row_count, {_LOAD} FROM raw GROUP BY tpa, file_name")),
    "rep_33_mappings_by_confidence": Query(
        lambda s, d: R.mappings_by_confidence(T.mappings(s, d), "economy"),
        sql("mappings", "SELECT mapping_id, source_field, target_table, target_column, confidence_score FROM mappings WHERE tpa = 'economy'")),
    "rep_33_columns_per_table": Query(
        lambda s, d: R.columns_per_table(T.schemas(s, d), "economy"),
        sql("schemas", "SELECT table_name, count(*) AS column_count FROM schemas WHERE tpa = 'economy' GROUP BY table_name")),
    "rep_33_longest_rules": Query(
        lambda s, d: R.longest_rules(T.rules(s, d), "tpa_1"),
        sql("rules", """SELECT rule_id, rule_type, CAST(length(rule_logic) AS INTEGER) AS logic_length FROM rules WHERE tpa = 'tpa_1'
            ORDER BY length(rule_logic) DESC, rule_id LIMIT 20""")),
    "rep_34_required_columns": Query(
        lambda s, d: R.required_columns(T.schemas(s, d)),
        sql("schemas", "SELECT table_name, count(*) AS column_count, count(CASE WHEN NOT nullable THEN 1 END) AS required_columns FROM schemas GROUP BY table_name")),
    "rep_34_mappings_per_target": Query(
        lambda s, d: R.mappings_per_target(T.mappings(s, d)),
        sql("mappings", """SELECT target_table, count(*) AS mapping_count, count(DISTINCT source_field) AS source_fields,
            count(DISTINCT target_column) AS target_columns, count(CASE WHEN approved THEN 1 END) AS approved_count FROM mappings GROUP BY target_table""")),
    "rep_34_rules_per_target": Query(
        lambda s, d: R.rules_per_target(T.rules(s, d)),
        sql("rules", """SELECT target_table, rule_type, count(*) AS rule_count, count(CASE WHEN active THEN 1 END) AS active_count
            FROM rules GROUP BY target_table, rule_type""")),
    "rep_35_table_structure": Query(
        lambda s, d: R.table_structure(T.schemas(s, d), "brand_2"),
        sql("schemas", "SELECT schema_id, column_name, data_type, nullable, default_value, description FROM schemas WHERE table_name = 'BRAND_2'")),
}


def _some_null_tpa(s, d):
    raw = T.raw(s, d, False)
    return raw.withColumn("tpa", F.when(F.col("value") <= 450, F.col("tpa")))


QUERIES = {**VIEWS, **REPORTS}
