"""Operational reports. ``as_of`` replaces the clock; tables come in as DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions.dates import boundary_diff
from feedmill.functions.text import rows_in_result
from feedmill.operators.dedup import mark_duplicates
from feedmill.operators.joins import queue_with_provider
from feedmill.operators.limits import page, top


def _rows() -> Column:
    return F.count(F.lit(1))


def _since(column: str, as_of: Column, interval: str) -> Column:
    return F.col(column) >= as_of - F.expr(f"INTERVAL {interval}")


def _load_span(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows, distinct files, first and last load per key, folded per file first."""
    per_file = rows.groupBy(*keys, "file_name").agg(
        _rows().alias("n"), F.min("load_timestamp").alias("lo"), F.max("load_timestamp").alias("hi")
    )
    return per_file.groupBy(*keys).agg(
        F.sum("n").alias("row_count"), F.count("file_name").alias("file_count"),
        F.min("lo").alias("first_upload"), F.max("hi").alias("last_upload"),
    )


def queue_status(queue: DataFrame) -> DataFrame:
    return queue.groupBy("status", "file_type").agg(
        _rows().alias("file_count"),
        F.min("discovered_timestamp").alias("oldest"),
        F.max("discovered_timestamp").alias("newest"),
    ).orderBy("status", "file_type")


def files_per_stage(listings: dict[str, DataFrame]) -> DataFrame:
    counted = [df.agg(_rows().alias("file_count")).select(F.lit(name).alias("stage"), "file_count")
               for name, df in listings.items()]
    return reduce(DataFrame.unionByName, counted)


def recent_loads(raw: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    return (
        raw.filter(_since("load_timestamp", as_of, f"{hours} HOURS"))
        .groupBy("file_name")
        .agg(F.count_distinct("file_row_number").alias("rows_loaded"),
             F.max("load_timestamp").alias("last_load_time"))
        .orderBy(F.desc("last_load_time"))
    )


def queue_history(queue: DataFrame, n: int = 50) -> DataFrame:
    return top(queue, [F.desc("queue_id")], n)


def providers(master: DataFrame, active_only: bool = False) -> DataFrame:
    rows = master.filter("active") if active_only else master
    return rows.orderBy(F.desc("active"), "tpa_code")


def provider_usage(master: DataFrame, raw: DataFrame) -> DataFrame:
    """An unused provider shows one row, as a left join counts it."""
    usage = _load_span(raw, ["tpa"])
    return (
        master.join(usage, master["tpa_code"] == usage["tpa"], "left")
        .select(
            "tpa_code", "tpa_name", "active",
            F.coalesce("file_count", F.lit(0)).alias("file_count"),
            F.coalesce("row_count", F.lit(1)).alias("row_count"),
            "first_upload", "last_upload",
        )
        .orderBy(F.desc("row_count"))
    )


def provider_file_status(
    master: DataFrame, raw: DataFrame, queue: DataFrame, per_file: bool = False
) -> DataFrame:
    """Queue states per provider, weighted by raw rows; ``per_file`` counts files once.

    Rows are folded per file and queue rows per file and status before they
    meet, so the row-weighted product is computed by multiplication.
    """
    files = raw.groupBy("tpa", "file_name").agg(_rows().alias("weight"))
    if per_file:
        files = files.withColumn("weight", F.lit(1))
    states = queue.groupBy("file_name").agg(
        _rows().alias("total"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ("SUCCESS", "FAILED", "PENDING")],
    )
    weighted = lambda c: F.sum(F.col("weight") * F.col(c))
    totals = (
        files.join(states, "file_name")
        .groupBy("tpa")
        .agg(
            weighted("total").alias("total_files"),
            weighted("SUCCESS").alias("successful_files"),
            weighted("FAILED").alias("failed_files"),
            weighted("PENDING").alias("pending_files"),
        )
    )
    return (
        master.join(totals, master["tpa_code"] == totals["tpa"])
        .select(
            "tpa_code", "tpa_name", "total_files", "successful_files", "failed_files", "pending_files",
            F.round(F.lit(100.0) * F.col("successful_files") / F.col("total_files"), 2).alias("success_rate"),
        )
        .orderBy(F.desc("total_files"))
    )


def provider_uploads(raw: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    recent = raw.filter(_since("load_timestamp", as_of, f"{days} DAYS"))
    return _load_span(recent, ["tpa"]).select(
        "tpa", F.col("file_count").alias("files_uploaded"), F.col("row_count").alias("rows_loaded"),
        "first_upload", "last_upload",
    ).orderBy(F.desc("rows_loaded"))


def provider_volume(raw: DataFrame, per_file: bool = False) -> DataFrame:
    """Bytes per provider, weighted by raw rows; ``per_file`` counts each file once."""
    per = raw.groupBy("tpa", "file_name").agg(
        _rows().alias("n"), F.sum("file_size").alias("bytes"), F.count("file_size").alias("sized"),
        F.max("file_size").alias("size"),
    )
    if per_file:
        per = per.withColumn("bytes", F.col("size")).withColumn(
            "sized", F.when(F.col("size").isNotNull(), 1).otherwise(0)
        )
    mb = lambda c: F.round(c / F.lit(1024.0) / F.lit(1024.0), 2)
    return (
        per.groupBy("tpa")
        .agg(
            F.count("file_name").alias("file_count"), F.sum("n").alias("row_count"),
            F.sum("bytes").alias("total_bytes"), F.sum("sized").alias("_sized"),
        )
        .select(
            "tpa", "file_count", "row_count", "total_bytes",
            mb(F.col("total_bytes")).alias("total_mb"),
            mb(F.try_divide("total_bytes", "_sized")).alias("avg_file_mb"),
        )
        .orderBy(F.desc("total_bytes"))
    )


def orphan_providers(raw: DataFrame, master: DataFrame) -> DataFrame:
    counted = _load_span(raw, ["tpa"]).select("tpa", "file_count", "row_count")
    return counted.join(master, counted["tpa"] == master["tpa_code"], "left_anti").orderBy(F.desc("row_count"))


def null_provider_totals(raw: DataFrame) -> DataFrame:
    per_file = raw.filter("tpa IS NULL").groupBy("file_name").agg(_rows().alias("n"))
    return per_file.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("null_tpa_count"), F.count("file_name").alias("affected_files")
    )


def null_provider_files(raw: DataFrame) -> DataFrame:
    return (
        raw.filter("tpa IS NULL")
        .groupBy("file_name", "stage_name")
        .agg(F.min("load_timestamp").alias("first_loaded"), _rows().alias("row_count"))
        .orderBy(F.desc("first_loaded"))
    )


def processed_files(queue: DataFrame, raw: DataFrame) -> DataFrame:
    return queue_with_provider(queue, raw).orderBy(F.desc("discovered_timestamp"))


def processing_statistics(queue: DataFrame, raw: DataFrame | None = None, tpa: str | None = None) -> DataFrame:
    if tpa is not None:
        files = raw.filter(F.col("tpa") == tpa).select("file_name").distinct()
        queue = queue.join(files, "file_name", "left_semi")
    state = lambda s: F.count_if(F.col("status") == s)
    return queue.agg(
        _rows().alias("total_files"),
        state("SUCCESS").alias("successful_files"),
        state("FAILED").alias("failed_files"),
        state("PROCESSING").alias("processing_files"),
        state("PENDING").alias("pending_files"),
        F.sum(rows_in_result(F.col("process_result")).cast("long")).alias("total_rows_processed"),
    )


def raw_summary(raw: DataFrame) -> DataFrame:
    per_file = raw.groupBy("tpa", "file_name").agg(
        _rows().alias("n"), F.min("load_timestamp").alias("lo"), F.max("load_timestamp").alias("hi")
    )
    per_name = per_file.groupBy("file_name").agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
    )
    totals = per_name.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count("file_name").alias("unique_files"),
        F.min("lo").alias("earliest_load"), F.max("hi").alias("latest_load"),
    )
    tpas = per_file.groupBy("tpa").agg(_rows().alias("n")).agg(F.count("tpa").alias("n")).scalar()
    return totals.select("total_rows", "unique_files", tpas.alias("unique_tpas"), "earliest_load", "latest_load")


def mapping_totals(mappings: DataFrame) -> DataFrame:
    return mappings.agg(
        _rows().alias("total_mappings"),
        F.count_if(F.col("approved")).alias("approved_mappings"),
        F.count_distinct("target_table").alias("target_tables"),
        F.count_distinct("source_field").alias("source_fields"),
    )


def rule_totals(rules: DataFrame) -> DataFrame:
    return rules.agg(
        _rows().alias("total_rules"),
        F.count_if(F.col("active")).alias("active_rules"),
        F.count_distinct("rule_type").alias("rule_types"),
    )


def overall_quality_score(metrics: DataFrame) -> DataFrame:
    return metrics.agg(
        F.avg(F.when(F.col("pass_fail") == "PASS", 100.0).otherwise(0.0)).alias("quality_score"),
        F.count_distinct("table_name").alias("tables_monitored"),
    )


def daily_batch_trend(log: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    return (
        log.filter(_since("start_timestamp", as_of, f"{days} DAYS"))
        .groupBy(F.to_date("start_timestamp").alias("date"))
        .agg(
            _rows().alias("batches"),
            F.sum("records_processed").alias("total_records"),
            F.avg(boundary_diff("second", F.col("start_timestamp"), F.col("end_timestamp"))).alias("avg_duration_sec"),
            F.count_if(F.col("status") == "SUCCESS").alias("successful_batches"),
        )
        .orderBy(F.desc("date"))
    )


def quality_trend(metrics: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    return (
        metrics.filter(_since("measurement_timestamp", as_of, f"{days} DAYS"))
        .groupBy(F.to_date("measurement_timestamp").alias("date"), "metric_type")
        .agg(
            F.avg("metric_value").alias("avg_score"),
            F.min("metric_value").alias("min_score"),
            F.max("metric_value").alias("max_score"),
        )
        .orderBy(F.desc("date"), "metric_type")
    )


def top_quarantine_reasons(quarantine: DataFrame, n: int = 10) -> DataFrame:
    reasons = quarantine.filter(~F.col("resolved")).select(
        "quarantine_id", F.explode("failed_rules").alias("rule_id")
    )
    counted = reasons.groupBy("rule_id").agg(
        _rows().alias("violation_count"), F.count_distinct("quarantine_id").alias("unique_records")
    )
    return top(counted, [F.desc("violation_count"), F.asc("rule_id")], n)


def quarantine_rate(log: DataFrame, as_of: Column, hours: int = 1, limit: float = 10.0) -> DataFrame:
    """Share of batch records rejected lately, with the alert condition."""
    recent = log.filter(_since("start_timestamp", as_of, f"{hours} HOURS"))
    rate = F.try_divide(F.sum("records_rejected") * F.lit(100.0), F.sum("records_read"))
    return recent.agg(rate.alias("quarantine_rate")).withColumn(
        "alert", F.coalesce(F.col("quarantine_rate") > limit, F.lit(False))
    )


def records_by_file(rows: DataFrame, file_column: str, time_column: str) -> DataFrame:
    return rows.groupBy(F.col(file_column).alias("source_file_name")).agg(
        _rows().alias("record_count"),
        F.min(time_column).alias("first_ingested"), F.max(time_column).alias("last_ingested"),
    )


def batch_metrics_per_target(log: DataFrame) -> DataFrame:
    return log.filter("status = 'SUCCESS'").groupBy("target_table").agg(
        F.avg(boundary_diff("second", F.col("start_timestamp"), F.col("end_timestamp"))).alias("avg_seconds"),
        F.avg("records_processed").alias("avg_records"),
    )


def queue_durations(queue: DataFrame) -> DataFrame:
    return queue.groupBy("status").agg(
        _rows().alias("files"),
        F.sum(rows_in_result(F.col("process_result")).cast("long")).alias("rows"),
        F.avg(boundary_diff("second", F.col("discovered_timestamp"), F.col("processed_timestamp"))).alias("avg_seconds"),
    )


def config_checks(schemas: DataFrame, mappings: DataFrame, rules: DataFrame) -> DataFrame:
    """PASS or FAIL per component, with its row count."""
    parts = [
        ("Target tables", schemas.select("table_name").distinct()),
        ("Target columns", schemas),
        ("Field mappings", mappings),
        ("Transformation rules", rules),
    ]
    rows = [
        df.agg(_rows().alias("found")).select(
            F.lit(label).alias("component"), "found",
            F.when(F.col("found") > 0, "PASS").otherwise("FAIL").alias("check_result"),
        )
        for label, df in parts
    ]
    return reduce(DataFrame.unionByName, rows)


def mappings_per_tpa(mappings: DataFrame) -> DataFrame:
    return mappings.filter("approved").groupBy("tpa").agg(_rows().alias("mapping_count")).orderBy(
        F.asc_nulls_first("tpa")
    )


def rules_per_tpa(rules: DataFrame) -> DataFrame:
    return rules.filter("active").groupBy("tpa", "rule_type").agg(_rows().alias("rule_count")).orderBy(
        F.asc_nulls_first("tpa"), "rule_type"
    )


def quarantine_list(quarantine: DataFrame, n: int = 50) -> DataFrame:
    return top(quarantine, [F.desc("quarantine_timestamp"), F.desc("quarantine_id")], n)


def rows_per_provider(raw: DataFrame, by_file: bool = False) -> DataFrame:
    if by_file:
        return raw.groupBy("tpa", "file_name").agg(
            _rows().alias("row_count"), F.min("load_timestamp").alias("first_upload"),
            F.max("load_timestamp").alias("last_upload"),
        )
    return _load_span(raw, ["tpa"])


def mappings_by_confidence(mappings: DataFrame, tpa: str) -> DataFrame:
    return mappings.filter(F.col("tpa") == tpa).select(
        "mapping_id", "source_field", "target_table", "target_column", "confidence_score"
    ).orderBy(F.desc("confidence_score"), "mapping_id")


def columns_per_table(schemas: DataFrame, tpa: str) -> DataFrame:
    return schemas.filter(F.col("tpa") == tpa).groupBy("table_name").agg(_rows().alias("column_count"))


def longest_rules(rules: DataFrame, tpa: str, n: int = 20) -> DataFrame:
    sized = rules.filter(F.col("tpa") == tpa).select(
        "rule_id", "rule_type", F.length("rule_logic").alias("logic_length")
    )
    return top(sized, [F.desc("logic_length"), F.asc("rule_id")], n)


def required_columns(schemas: DataFrame) -> DataFrame:
    return schemas.groupBy("table_name").agg(
        _rows().alias("column_count"), F.count_if(~F.col("nullable")).alias("required_columns")
    )


def mappings_per_target(mappings: DataFrame) -> DataFrame:
    return mappings.groupBy("target_table").agg(
        _rows().alias("mapping_count"),
        F.count_distinct("source_field").alias("source_fields"),
        F.count_distinct("target_column").alias("target_columns"),
        F.count_if(F.col("approved")).alias("approved_count"),
    )


def rules_per_target(rules: DataFrame) -> DataFrame:
    return rules.groupBy("target_table", "rule_type").agg(
        _rows().alias("rule_count"), F.count_if(F.col("active")).alias("active_count")
    )


def table_structure(schemas: DataFrame, table: str) -> DataFrame:
    return schemas.filter(F.upper("table_name") == table.upper()).select(
        "schema_id", "column_name", "data_type", "nullable", "default_value", "description"
    ).orderBy("schema_id")


# -- filtered lists -----------------------------------------------------------

def browse_raw(raw: DataFrame, tpas: list[str] | None = None, files: list[str] | None = None,
               limit: int = 100, offset: int = 0) -> DataFrame:
    rows = raw
    if tpas:
        rows = rows.filter(F.col("tpa").isin(*tpas))
    if files:
        rows = rows.filter(F.col("file_name").isin(*files))
    return page(rows, [F.desc("load_timestamp"), F.desc("raw_id")], limit, offset)


def browse_table(rows: DataFrame, where: str | None, order_column: str, limit: int = 100, offset: int = 0) -> DataFrame:
    chosen = rows.filter(F.expr(where)) if where else rows
    return page(chosen, [F.desc(order_column)], limit, offset)


# The sort orders a mapping list offers (column, descending).
MAPPING_ORDERS = {
    "confidence_desc": [("confidence_score", True)],
    "confidence_asc": [("confidence_score", False)],
    "source": [("source_field", False)],
    "target": [("target_table", False), ("target_column", False)],
    "method": [("mapping_method", False)],
    "newest": [("mapping_id", True)],
}


def list_mappings(mappings: DataFrame, table: str | None = None, tpa: str | None = None,
                  status: str | None = None, order: str = "newest") -> DataFrame:
    rows = mappings
    if table:
        rows = rows.filter(F.col("target_table") == table)
    if tpa:
        rows = rows.filter(F.col("tpa") == tpa)
    rows = mark_duplicates(rows, ["source_field", "target_table", "target_column", "tpa"])
    label = F.when(F.col("is_duplicate"), "DUPLICATE").when(F.col("approved"), "APPROVED").otherwise("PENDING")
    rows = rows.withColumn("status", label)
    if status:
        rows = rows.filter(F.col("status") == status)
    return rows.orderBy(*[F.desc(c) if down else F.asc(c) for c, down in MAPPING_ORDERS[order]], F.asc("mapping_id"))


def list_rules(rules: DataFrame, rule_type: str | None = None, table: str | None = None,
               active: bool | None = None) -> DataFrame:
    rows = rules
    if rule_type:
        rows = rows.filter(F.col("rule_type") == rule_type)
    if table:
        rows = rows.filter(F.col("target_table") == table)
    if active is not None:
        rows = rows.filter(F.col("active") == active)
    return rows.orderBy(F.asc("priority"), F.desc("created_timestamp"))


def list_queue(queue: DataFrame, statuses: list[str] | None = None, types: list[str] | None = None,
               raw: DataFrame | None = None, tpa: str | None = None) -> DataFrame:
    rows = queue
    if statuses:
        rows = rows.filter(F.col("status").isin(*statuses))
    if types:
        rows = rows.filter(F.col("file_type").isin(*types))
    if tpa is not None:
        rows = queue_with_provider(rows, raw).filter(F.col("tpa") == tpa)
    return rows
