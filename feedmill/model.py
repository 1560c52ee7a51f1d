"""Schemas of the state and metadata tables, and their seed rows.

Fixed values: column names, method, status and rule-type words below must
match what users' files and rules say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TPA_MASTER = (
    "tpa_code string, tpa_name string, tpa_description string, active boolean, "
    "created_timestamp timestamp_ntz, updated_timestamp timestamp_ntz, created_by string"
)
RAW_DATA = (
    "raw_id bigint, raw_data variant, file_name string, file_row_number bigint, "
    "load_timestamp timestamp_ntz, stage_name string, file_size bigint, "
    "file_last_modified timestamp_ntz, tpa string"
)
RAW_RANGES = "load_id string, first_id bigint, last_id bigint"
QUEUE = (
    "queue_id bigint, file_name string, file_type string, status string, process_result string, "
    "discovered_timestamp timestamp_ntz, processed_timestamp timestamp_ntz, "
    "moved_timestamp timestamp_ntz, error_message string, retry_count int"
)
REPROCESS = "reprocess_id bigint, file_name string, status string, requested_timestamp timestamp_ntz"
TARGET_SCHEMAS = (
    "schema_id bigint, table_name string, column_name string, tpa string, data_type string, "
    "nullable boolean, default_value string, description string, created_timestamp timestamp_ntz, "
    "updated_timestamp timestamp_ntz, created_by string, active boolean"
)
FIELD_MAPPINGS = (
    "mapping_id bigint, source_field string, source_table string, target_table string, "
    "target_column string, tpa string, mapping_method string, confidence_score double, "
    "transformation_logic string, description string, created_timestamp timestamp_ntz, "
    "updated_timestamp timestamp_ntz, created_by string, approved boolean, approved_by string, "
    "approved_timestamp timestamp_ntz"
)
KNOWN_MAPPINGS = (
    "mapping_id bigint, source_field string, target_field string, description string, active boolean"
)
RULES = (
    "rule_id string, rule_name string, rule_type string, target_table string, target_column string, "
    "tpa string, rule_logic string, rule_parameters string, priority int, error_action string, "
    "description string, created_timestamp timestamp_ntz, updated_timestamp timestamp_ntz, "
    "created_by string, active boolean"
)
PROCESSING_LOG = (
    "batch_id string, source_table string, target_table string, start_timestamp timestamp_ntz, "
    "end_timestamp timestamp_ntz, status string, records_read bigint, records_processed bigint, "
    "records_inserted bigint, records_updated bigint, records_rejected bigint, rules_applied int, "
    "error_message string, processing_metadata string, created_by string"
)
QUALITY_METRICS = (
    "metric_id string, batch_id string, table_name string, column_name string, metric_type string, "
    "metric_value double, threshold_value double, pass_fail string, rule_id string, "
    "measurement_timestamp timestamp_ntz, details string"
)
QUARANTINE = (
    "quarantine_id string, batch_id string, source_table string, target_table string, "
    "source_record variant, failed_rules array<string>, error_details variant, "
    "quarantine_timestamp timestamp_ntz, resolved boolean, resolution_action string, "
    "resolution_timestamp timestamp_ntz, resolved_by string"
)
WATERMARKS = (
    "watermark_id string, source_table string, target_table string, last_processed_id bigint, "
    "last_processed_timestamp timestamp_ntz, records_processed bigint, last_batch_id string, "
    "updated_timestamp timestamp_ntz"
)
PROMPTS = (
    "template_id string, template_name string, template_text string, model_name string, "
    "description string, active boolean"
)
METRIC_DEFINITIONS = (
    "metric_name string, target_table string, target_column string, metric_type string, "
    "threshold_value double, threshold_operator string, measurement_query string, "
    "enabled boolean, alert_on_failure boolean, description string"
)

TABLES = {
    "tpa_master": TPA_MASTER,
    "raw_data": RAW_DATA,
    "raw_ranges": RAW_RANGES,
    "file_processing_queue": QUEUE,
    "reprocess_queue": REPROCESS,
    "target_schemas": TARGET_SCHEMAS,
    "field_mappings": FIELD_MAPPINGS,
    "known_field_mappings": KNOWN_MAPPINGS,
    "transformation_rules": RULES,
    "silver_processing_log": PROCESSING_LOG,
    "data_quality_metrics": QUALITY_METRICS,
    "quarantine_records": QUARANTINE,
    "processing_watermarks": WATERMARKS,
    "llm_prompt_templates": PROMPTS,
    "quality_metric_definitions": METRIC_DEFINITIONS,
}

# Columns every silver table may carry, and where two of them come from.
STANDARD_COLUMNS = [
    ("SOURCE_FILE_NAME", "VARCHAR(500)", True, None, "Original source file name from Bronze layer"),
    ("INGESTION_TIMESTAMP", "TIMESTAMP_NTZ", False, "CURRENT_TIMESTAMP()", "Timestamp when record was ingested"),
    ("CREATED_AT", "TIMESTAMP_NTZ", False, "CURRENT_TIMESTAMP()", "Record creation timestamp in Silver layer"),
    ("UPDATED_AT", "TIMESTAMP_NTZ", False, "CURRENT_TIMESTAMP()", "Record last update timestamp"),
]
STANDARD_MAPPINGS = [("FILE_NAME", "SOURCE_FILE_NAME"), ("LOAD_TIMESTAMP", "INGESTION_TIMESTAMP")]

# Accepted type names of a target column.
TYPE_PATTERN = (
    "^(VARCHAR|NUMBER|INTEGER|FLOAT|DOUBLE|BOOLEAN|DATE|TIMESTAMP_NTZ|TIMESTAMP_LTZ|TIMESTAMP_TZ|"
    "TIME|VARIANT|OBJECT|ARRAY|BINARY|GEOGRAPHY|GEOMETRY)"
)


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[table])
