"""Monitoring views over the state and metadata tables.

Each takes the tables it reads as DataFrames (lower-case column names) and
returns a DataFrame. Views ordered for display end in a sort; callers who
aggregate further pay nothing for it, Catalyst drops it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions.dates import boundary_diff
from feedmill.operators.limits import top


def _seconds() -> Column:
    return boundary_diff("second", F.col("start_timestamp"), F.col("end_timestamp"))


def transformation_status_summary(log: DataFrame) -> DataFrame:
    return (
        log.filter("end_timestamp IS NOT NULL")
        .groupBy("target_table", "status")
        .agg(
            F.count(F.lit(1)).alias("batch_count"),
            F.sum("records_processed").alias("total_processed"),
            F.sum("records_rejected").alias("total_rejected"),
            F.avg(_seconds()).alias("avg_duration_seconds"),
            F.max("end_timestamp").alias("last_batch_timestamp"),
        )
        .orderBy("target_table", "status")
    )


def recent_transformation_batches(log: DataFrame, n: int = 100) -> DataFrame:
    newest = top(log, [F.desc("start_timestamp"), F.desc("batch_id")], n)
    return newest.select(
        "batch_id", "source_table", "target_table", "status", "records_read", "records_processed",
        "records_rejected", "rules_applied", _seconds().alias("duration_seconds"),
        "start_timestamp", "end_timestamp", "error_message",
    )


def data_quality_dashboard(metrics: DataFrame) -> DataFrame:
    severity = F.when(F.col("pass_fail") == "FAIL", 1).when(F.col("pass_fail") == "WARNING", 2).otherwise(3)
    return metrics.orderBy(severity, F.desc("measurement_timestamp"))


def quarantine_summary(quarantine: DataFrame) -> DataFrame:
    return (
        quarantine.groupBy("target_table")
        .agg(
            F.count(F.lit(1)).alias("total_quarantined_records"),
            F.count_if(F.col("resolved")).alias("resolved_records"),
            F.count_if(~F.col("resolved")).alias("unresolved_records"),
            F.min("quarantine_timestamp").alias("first_quarantine_timestamp"),
            F.max("quarantine_timestamp").alias("last_quarantine_timestamp"),
        )
        .orderBy(F.desc("unresolved_records"), F.desc("total_quarantined_records"))
    )


def watermark_status(watermarks: DataFrame, as_of: Column) -> DataFrame:
    hours = boundary_diff("hour", F.col("updated_timestamp"), as_of)
    return (
        watermarks.withColumn("hours_since_update", hours)
        .withColumn(
            "status",
            F.when(F.col("updated_timestamp").isNull(), "Never Processed")
            .when(F.col("hours_since_update") > 24, "Stale (>24h)")
            .when(F.col("hours_since_update") > 6, "Warning (>6h)")
            .otherwise("Current"),
        )
        .orderBy(F.desc_nulls_last("updated_timestamp"))
    )


def field_mappings_by_tpa(mappings: DataFrame) -> DataFrame:
    return (
        mappings.filter("approved")
        .withColumn("tpa", F.coalesce("tpa", F.lit("ALL")))
        .orderBy("tpa", "target_table", "source_field")
    )


def transformation_rules_by_tpa(rules: DataFrame) -> DataFrame:
    return (
        rules.filter("active")
        .withColumn("tpa", F.coalesce("tpa", F.lit("ALL")))
        .orderBy("tpa", "priority", "rule_id")
    )


def target_schemas_summary(schemas: DataFrame) -> DataFrame:
    return (
        schemas.filter("active")
        .groupBy("table_name", "tpa")
        .agg(
            F.count(F.lit(1)).alias("column_count"),
            F.count_if(~F.col("nullable")).alias("required_columns"),
            F.max("created_timestamp").alias("last_modified"),
        )
        .orderBy("table_name")
    )


def table_creation_readiness(schemas: DataFrame) -> DataFrame:
    return (
        target_schemas_summary(schemas)
        .select(
            "table_name", "column_count",
            F.when(F.col("column_count") == 0, "NOT READY - No columns defined")
            .otherwise("READY").alias("status"),
        )
        .orderBy("status", "table_name")
    )


def field_mapping_summary(mappings: DataFrame) -> DataFrame:
    return (
        mappings.groupBy("mapping_method", "approved")
        .agg(
            F.count(F.lit(1)).alias("mapping_count"),
            F.avg("confidence_score").alias("avg_confidence"),
            F.min("confidence_score").alias("min_confidence"),
            F.max("confidence_score").alias("max_confidence"),
        )
        .orderBy("mapping_method", F.desc("approved"))
    )


def duplicate_target_mappings(mappings: DataFrame) -> DataFrame:
    text = F.concat(
        F.col("source_field"), F.lit(" ("), F.col("mapping_method"), F.lit(", conf="),
        F.col("confidence_score").cast("string"), F.lit(")"),
    )
    return (
        mappings.withColumn("entry", text)
        .groupBy("target_table", "target_column")
        .agg(
            F.count(F.lit(1)).alias("mapping_count"),
            F.expr("listagg(entry, ', ') WITHIN GROUP (ORDER BY entry)").alias("source_fields"),
        )
        .filter("mapping_count > 1")
        .orderBy(F.desc("mapping_count"), "target_table", "target_column")
    )


def rules_summary(rules: DataFrame) -> DataFrame:
    return (
        rules.groupBy("rule_type", "active")
        .agg(
            F.count(F.lit(1)).alias("rule_count"),
            F.count_distinct("target_table").alias("affected_tables"),
            F.avg("priority").alias("avg_priority"),
        )
        .orderBy("rule_type", F.desc("active"))
    )


def rule_execution_history(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Metrics are folded per rule before the join, so a busy rule is one row there."""
    per_rule = metrics.groupBy("rule_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("pass_fail") == "PASS").alias("passed"),
        F.count_if(F.col("pass_fail") == "FAIL").alias("failed"),
        F.count_if(F.col("pass_fail") == "WARNING").alias("warned"),
        F.sum("metric_value").alias("total"),
        F.count("metric_value").alias("valued"),
        F.max("measurement_timestamp").alias("last"),
    )
    return (
        per_rule.join(rules.select("rule_id", "rule_name", "rule_type"), "rule_id")
        .groupBy("rule_id", "rule_name", "rule_type")
        .agg(
            F.sum("n").alias("execution_count"),
            F.sum("passed").alias("pass_count"),
            F.sum("failed").alias("fail_count"),
            F.sum("warned").alias("warning_count"),
            F.try_divide(F.sum("total"), F.sum("valued")).alias("avg_metric_value"),
            F.max("last").alias("last_execution"),
        )
        .orderBy(F.desc("last_execution"))
    )


def error_files(listing: DataFrame, queue: DataFrame, as_of: Column) -> DataFrame:
    return (
        listing.join(queue, listing["path"] == queue["file_name"], "left")
        .select(
            F.col("path").alias("file_name"),
            F.col("size").alias("file_size_bytes"),
            F.round(F.col("size") / F.lit(1024.0), 2).alias("file_size_kb"),
            "last_modified", "file_type", "status", "error_message",
            "discovered_timestamp", "processed_timestamp",
            boundary_diff("hour", F.col("last_modified"), as_of).alias("hours_in_error_stage"),
        )
        .orderBy(F.desc("last_modified"))
    )
