"""Metadata tables from CSV files, bound by header name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.functions.text import blank_to_null, parse_flag


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header; quoted cells may span lines. A row without a first cell is dropped."""
    rows = spark.read.options(header=True, multiLine=True, escape='"', quote='"').csv(path)
    return rows.filter(F.col(rows.columns[0]).isNotNull())


def _optional(rows: DataFrame, column: str):
    return blank_to_null(F.col(column)) if column in rows.columns else F.lit(None).cast("string")


def target_schemas(spark: SparkSession, path: str) -> DataFrame:
    rows = read_config(spark, path)
    return rows.select(
        F.upper(F.trim("table_name")).alias("table_name"),
        F.upper(F.trim("column_name")).alias("column_name"),
        _optional(rows, "tpa").alias("tpa"),
        F.upper(F.trim("data_type")).alias("data_type"),
        parse_flag(F.col("nullable")).alias("nullable"),
        _optional(rows, "default_value").alias("default_value"),
        _optional(rows, "description").alias("description"),
        F.lit(True).alias("active"),
    )


def field_mappings(spark: SparkSession, path: str) -> DataFrame:
    rows = read_config(spark, path)
    confidence = _optional(rows, "confidence_score").try_cast("double")
    approved = parse_flag(F.col("approved")) if "approved" in rows.columns else F.lit(True)
    note = "description" if "description" in rows.columns else "notes"
    logic = _repaired(_optional(rows, "transformation_logic"))
    return rows.select(
        F.trim("source_field").alias("source_field"),
        F.coalesce(F.upper(_optional(rows, "source_table")), F.lit("RAW_DATA_TABLE")).alias("source_table"),
        F.upper(F.trim("target_table")).alias("target_table"),
        F.upper(F.trim("target_column")).alias("target_column"),
        _optional(rows, "tpa").alias("tpa"),
        F.coalesce(F.upper(_optional(rows, "mapping_method")), F.lit("MANUAL")).alias("mapping_method"),
        F.coalesce(confidence, F.lit(1.0)).alias("confidence_score"),
        logic.alias("transformation_logic"),
        _optional(rows, note).alias("description"),
        approved.alias("approved"),
    ).filter("target_column IS NOT NULL")


def _repaired(text):
    """The argument commas a CSV export dropped, put back."""
    out = F.regexp_replace(text, r"(?i)(TO_DATE\(\s*\w+)\s+'", "$1, '")
    return F.regexp_replace(out, r"(?i)((?:NUMBER|DECIMAL)\(\s*\d+)\s+(\d+\s*\))", "$1, $2")


def transformation_rules(spark: SparkSession, path: str) -> DataFrame:
    rows = read_config(spark, path)
    params = _optional(rows, "rule_parameters")
    return rows.select(
        F.trim("rule_id").alias("rule_id"),
        _optional(rows, "rule_name").alias("rule_name"),
        F.upper(F.trim("rule_type")).alias("rule_type"),
        F.upper(_optional(rows, "target_table")).alias("target_table"),
        F.upper(_optional(rows, "target_column")).alias("target_column"),
        _optional(rows, "tpa").alias("tpa"),
        _optional(rows, "rule_logic").alias("rule_logic"),
        F.when(F.try_parse_json(params).isNotNull(), params).alias("rule_parameters"),
        F.coalesce(_optional(rows, "priority").try_cast("int"), F.lit(100)).alias("priority"),
        F.coalesce(F.upper(_optional(rows, "error_action")), F.lit("LOG")).alias("error_action"),
        _optional(rows, "description").alias("description"),
        parse_flag(F.col("active")).alias("active"),
    )


def metric_definitions(spark: SparkSession, path: str) -> DataFrame:
    rows = read_config(spark, path)
    return rows.select(
        "metric_name", F.upper("target_table").alias("target_table"),
        F.upper("target_column").alias("target_column"), F.upper("metric_type").alias("metric_type"),
        F.col("threshold_value").try_cast("double").alias("threshold_value"), "threshold_operator",
        "measurement_query", parse_flag(F.col("enabled")).alias("enabled"),
        parse_flag(F.col("alert_on_failure")).alias("alert_on_failure"), "description",
    )


def prompt_templates(spark: SparkSession, path: str) -> DataFrame:
    rows = read_config(spark, path)
    return rows.select(
        F.upper(F.regexp_replace(F.trim("prompt_name"), "[^A-Za-z0-9]+", "_")).alias("template_id"),
        F.col("prompt_name").alias("template_name"),
        F.col("prompt_template").alias("template_text"),
        F.col("model_preference").alias("model_name"),
        "description", parse_flag(F.col("enabled")).alias("active"),
    )
