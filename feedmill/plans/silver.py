"""Raw rows to typed tables: projection, rules, upsert, state and logs."""

from __future__ import annotations

import datetime
import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill import model
from feedmill.functions import dialect
from feedmill.functions.dates import ntz
from feedmill.operators import dedup, rules as rule_ops
from feedmill.operators.joins import collect_metadata
from feedmill.operators.limits import batch_bounds
from feedmill.operators.merge import delete_where, merge_rows
from feedmill.plans.store import ROW, Store
from feedmill.session import drop_staged, stage

# Columns of a raw row that a mapping may name directly.
PROVENANCE = ["file_name", "file_row_number", "load_timestamp", "stage_name", "file_size",
              "file_last_modified", "tpa", "raw_id"]
LOG = "silver_processing_log"
BATCH_RETRIES = 2


@dataclass
class Mapping:
    source_field: str
    target_column: str
    tpa: str | None
    logic: str | None
    method: str | None = None


def approved_mappings(mappings: DataFrame, target: str, tpa: str | None = None) -> list[Mapping]:
    """Approved mappings of a target, as a list; own rows and global rows of a provider."""
    chosen = mappings.filter(F.col("approved") & (F.upper("target_table") == target.upper()))
    if tpa is not None:
        chosen = chosen.filter(F.col("tpa").isNull() | (F.col("tpa") == tpa))
    rows = collect_metadata(chosen)
    rows.sort(key=lambda r: (r["target_column"], r["tpa"] or "", r["mapping_id"] or 0))
    out: dict[tuple, Mapping] = {}
    for r in rows:
        # A score note of a proposed mapping is not an expression.
        logic = r["transformation_logic"]
        if logic and logic.startswith("Scores:"):
            logic = None
        out.setdefault(
            (r["target_column"], r["tpa"]),
            Mapping(r["source_field"], r["target_column"], r["tpa"], logic, r["mapping_method"]),
        )
    return list(out.values())


def mapping_conflicts(mappings: DataFrame, target: str, tpa: str | None = None) -> DataFrame:
    """Metric rows for columns with several approved mappings of one provider; the lowest id is used."""
    here = mappings.filter(F.col("approved") & (F.upper("target_table") == target.upper()))
    if tpa is not None:
        here = here.filter(F.col("tpa").isNull() | (F.col("tpa") == tpa))
    slots = here.groupBy("target_column", "tpa").agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("mapping_id")).alias("ids")).filter("n > 1")
    return slots.select(
        F.lit(None).cast("string").alias("rule_id"), F.lit(target.upper()).alias("table_name"),
        F.col("target_column").alias("column_name"), F.lit("MAPPING_ERROR").alias("metric_type"),
        (F.col("n") - 1).cast("double").alias("metric_value"), F.lit(0.0).alias("threshold_value"),
        F.lit("FAIL").alias("pass_fail"),
        F.concat(F.lit("several mappings for "), F.coalesce("tpa", F.lit("all providers")), F.lit(": "),
                 F.array_join(F.transform("ids", lambda i: i.cast("string")), ", ")).alias("details"),
    )


def mapping_column(mapping: Mapping, known_fields: list[str] | None = None) -> Column:
    """Column of one mapping: an expression, a raw-row column, or a field in any case."""
    field = mapping.source_field
    if field.lower() in PROVENANCE and not (known_fields and field in known_fields):
        value = F.col(field.lower())
        if not mapping.logic:
            return value
        return F.expr(dialect.to_spark(mapping.logic).replace("source_value", field.lower()))
    if known_fields is not None:
        exact = [f for f in known_fields if f == field]
        others = sorted(f for f in known_fields if f.lower() == field.lower() and f != field)
        spellings = exact + others or [field]
    else:
        spellings = list(dict.fromkeys([field, field.upper(), field.lower()]))
    return F.expr(dialect.source_expression(spellings, mapping.logic))


def project(raw: DataFrame, mappings: list[Mapping], types: dict[str, str] | None = None,
            known_fields: list[str] | None = None, keep: list[str] = ("raw_id", "tpa")) -> DataFrame:
    """Typed target columns of every raw row, one projection for all providers.

    A provider's own mapping beats the global one of the same column. With
    ``types`` every column is cast to its declared type; a value that cannot be
    cast becomes NULL.
    """
    by_column: dict[str, list[Mapping]] = {}
    for m in mappings:
        by_column.setdefault(m.target_column, []).append(m)
    out = []
    for name, options in by_column.items():
        value, default = None, F.lit(None)
        for m in options:
            if m.tpa is None:
                default = mapping_column(m, known_fields)
        for m in [m for m in options if m.tpa is not None]:
            branch, hit = mapping_column(m, known_fields), F.col("tpa") == m.tpa
            value = F.when(hit, branch) if value is None else value.when(hit, branch)
        value = default if value is None else value.otherwise(default)
        if types and name in types:
            value = value.try_cast(types[name])
        out.append(value.alias(name))
    return raw.select(*[F.col(c) for c in keep], *out)


def cast_failures(rows: DataFrame, types: dict[str, str]) -> DataFrame:
    """Per column: values present that the declared type cannot hold; one scan."""
    entries = list(types.items())
    totals = rows.agg(
        *[
            F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(f"n{i}")
            for i, (c, t) in enumerate(entries)
        ]
    )
    listed = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("data_type"), F.col(f"n{i}").alias("failed_casts"))
            for i, (c, t) in enumerate(entries)
        ]
    )
    return totals.select(F.explode(listed).alias("e")).select("e.*")


def conform_columns(rows: DataFrame, types: dict[str, str]) -> DataFrame:
    return rows.select(
        *[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in rows.columns]
    )


def apply_all_rules(
    projected: DataFrame, rules: list, table: str, references: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Rows left after quality, business, standardisation and dedup rules, as one lazy plan."""
    checked = rule_ops.apply_quality_rules(projected, rules, table, references)
    business = rule_ops.apply_business_rules(checked.survivors(), rules, table)
    standard = rule_ops.apply_standard_rules(business.rows, rules, table)
    return rule_ops.apply_dedup_rules(standard.rows, rules, table)[0]


@dataclass
class BatchResult:
    batch_id: str
    status: str
    read: int = 0
    processed: int = 0
    inserted: int = 0
    updated: int = 0
    rejected: int = 0
    rules_applied: int = 0
    message: str | None = None


def target_columns(store: Store, target: str) -> list:
    """Active declared columns of a table in order, one per name."""
    rows = collect_metadata(
        store.snapshot("target_schemas").filter(F.col("active") & (F.upper("table_name") == target.upper()))
    )
    rows.sort(key=lambda r: r["schema_id"])
    return list({r["column_name"]: r for r in reversed(rows)}.values())[::-1]


def last_processed(store: Store, watermark_id: str) -> tuple[int, int]:
    """(last id, records so far) of a source-target pair."""
    found = store.snapshot("processing_watermarks").filter(F.col("watermark_id") == watermark_id).collect()
    return (found[0]["last_processed_id"] or 0, found[0]["records_processed"] or 0) if found else (0, 0)


def latest_log(log: DataFrame) -> DataFrame:
    """Newest row per batch of the append-only log."""
    return dedup.keep_one(
        log, ["batch_id"], [F.desc_nulls_last("end_timestamp"), F.desc(F.col("status") == "SUCCESS")])


def unfinished_batch(store: Store, mark: str) -> tuple[str | None, int]:
    """(id, tries so far) of a batch of this mark that failed or whose run died, if there is one."""
    opened = store.read(LOG).filter(F.get_json_object("processing_metadata", "$.watermark") == mark)
    left = (
        opened.groupBy("batch_id")
        .agg(F.count_if(F.col("status") == "PROCESSING").alias("tries"),
             F.count_if(F.col("status").isin("SUCCESS", "QUARANTINED")).alias("done"))
        .filter("done = 0").orderBy(F.desc("tries"), "batch_id").first()
    )
    return (left.batch_id, left.tries) if left else (None, 0)


def new_batch_id(spark: SparkSession, as_of: datetime.datetime) -> str:
    return f"BATCH_{as_of:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"


def transform_batch(
    store: Store,
    target: str,
    as_of: datetime.datetime,
    raw: DataFrame | None = None,
    source: str = "RAW_DATA_TABLE",
    batch_size: int | None = 10_000,
    apply_rules: bool = True,
    incremental: bool = True,
    tpa: str | None = None,
    strict: bool = False,
    references: dict[str, DataFrame] | None = None,
    max_retries: int | None = BATCH_RETRIES,
) -> BatchResult:
    """Move the next raw rows into a typed table.

    Reads above the high-water mark, projects through the approved mappings,
    applies quality, business, standardisation and dedup rules, upserts on the
    first declared column, and records metrics, quarantine, mark and log.
    Intermediate rows are written twice to the shared folder: after the quality
    checks and before the upsert; both copies go when the batch ends.

    A batch that failed, or whose run died, keeps its id: the next call replaces
    its metrics and quarantine records, and the upsert repeats without effect, so
    a rerun leaves what one clean run leaves. After ``max_retries`` failed retries
    the raw rows go to quarantine and the mark moves on (None: never).
    """
    spark = store.spark
    now = ntz(as_of)
    mark = f"{source}_TO_{target.upper()}" + (f"_{tpa}" if tpa else "")
    open_id, tries = unfinished_batch(store, mark)
    batch_id = open_id or new_batch_id(spark, as_of)
    result = BatchResult(batch_id, "SUCCESS")
    bounds, staged = None, []
    try:
        declared = target_columns(store, target)
        if not declared:
            raise ValueError(f"No active columns defined for {target}")
        types = {r["column_name"]: dialect.type_name(r["data_type"]) for r in declared}
        key = declared[0]["column_name"]
        mappings = approved_mappings(store.snapshot("field_mappings"), target, tpa)
        if not mappings:
            raise ValueError(f"No approved field mappings found for {target}")
        if "SOURCE_FILE_NAME" in types and "SOURCE_FILE_NAME" not in {m.target_column for m in mappings}:
            mappings.append(Mapping("FILE_NAME", "SOURCE_FILE_NAME", None, None, "SYSTEM"))
        rows = store.read("raw_data") if raw is None else raw
        if tpa is not None:
            rows = rows.filter(F.col("tpa") == tpa)
        after, so_far = last_processed(store, mark) if incremental else (0, 0)
        bounds = batch_bounds(rows, "raw_id", after, batch_size)
        if bounds is None:
            result.message = "No new records to process"
            _write_log(store, result, source, target, as_of, mark)
            return result
        rows = rows.filter(F.col("raw_id").between(*bounds))
        _write_log(store, BatchResult(batch_id, "PROCESSING"), source, target, as_of, mark)
        _forget(store, batch_id)
        projected = project(rows, mappings, types)

        rules = rule_ops.active_rules(store.snapshot("transformation_rules"), target) if apply_rules else []
        checked = rule_ops.apply_quality_rules(projected, rules, target.upper(), references)
        checked.rows = stage(checked.rows, "checked")
        staged.append(checked.rows)
        result.read = checked.rows.count()
        metrics = [checked.metrics(), mapping_conflicts(store.snapshot("field_mappings"), target, tpa)]
        if strict and checked.rows.filter("_removed_at IS NOT NULL").limit(1).count():
            raise ValueError("batch holds rejected rows and strict is set")
        business = rule_ops.apply_business_rules(checked.survivors(), rules, target.upper())
        standard = rule_ops.apply_standard_rules(business.rows, rules, target.upper())
        survivors = checked.survivors()
        if business.counters or business.errors:
            metrics.append(business.metrics(survivors))
        if standard.counters or standard.errors:
            metrics.append(standard.metrics(business.rows))
        kept, held, dedup_metrics = rule_ops.apply_dedup_rules(standard.rows, rules, target.upper())
        metrics.append(dedup_metrics)
        keyed = dedup.keep_last(kept.filter(F.col(key).isNotNull()), [key])
        final = stage(keyed.unionByName(kept.filter(F.col(key).isNull())), "final")
        staged.append(final)
        result.processed = final.count()
        result.rejected = result.read - result.processed

        _write_quarantine(store, checked.quarantined(), batch_id, source, target, now)
        if held is not None:
            _write_quarantine(store, held, batch_id, source, target, now)
        _write_metrics(store, reduce(DataFrame.unionByName, metrics), batch_id, now)
        if not store.is_created(target):
            store.create(target, ", ".join(f"`{c}` {t}" for c, t in types.items()))
        columns = [c for c in final.columns if c in types]
        defaults = {
            r["column_name"]: _default(r["default_value"], now) for r in declared
            if r["default_value"] is not None and r["column_name"] not in columns
        }
        touched = {"UPDATED_AT": now} if "UPDATED_AT" in types else {}
        result.inserted, result.updated = store.upsert(
            target, final.select(*columns, F.col("raw_id").alias(ROW)), key, [c for c in columns if c != key], touched, defaults
        )
        result.rules_applied = len(rules)
        if incremental:
            _set_mark(store, mark, source, target, bounds[1], so_far + result.processed, batch_id, as_of)
        result.message = f"Processed {result.processed} records"
    except Exception as error:
        text = str(error).strip()
        result.status, result.message = "FAILED", text.splitlines()[0] if text else repr(error)
        if incremental and bounds is not None and max_retries is not None and tries >= max_retries:
            _give_up(store, rows, result, source, target, now)
            _set_mark(store, mark, source, target, bounds[1], so_far, batch_id, as_of)
    finally:
        drop_staged(*staged)
    _write_log(store, result, source, target, as_of, mark)
    return result


def _forget(store: Store, batch_id: str) -> None:
    """Remove what an earlier try of this batch recorded."""
    for table in ("quarantine_records", "data_quality_metrics"):
        store.drop_partition(table, "batch_id", batch_id)


def _set_mark(store: Store, mark: str, source: str, target: str, last: int, records: int, batch_id: str,
              as_of: datetime.datetime) -> None:
    state = store.spark.createDataFrame(
        [(mark, source, target.upper(), last, as_of, records, batch_id, as_of)], model.WATERMARKS)
    store.merge("processing_watermarks", state, ["watermark_id"])


def _give_up(store: Store, raw: DataFrame, result: BatchResult, source: str, target: str, now: Column) -> None:
    """All raw rows of a batch that fails again and again, as quarantine records."""
    _forget(store, result.batch_id)
    held = raw.select(
        F.col("raw_data").alias("source_record"), F.array(F.lit("BATCH_FAILED")).alias("failed_rules"),
        F.to_variant_object(F.struct(F.col("raw_id"), F.lit(result.message).alias("error"))).alias("error_details"),
    )
    _write_quarantine(store, held, result.batch_id, source, target, now)
    result.status = "QUARANTINED"
    result.read = result.rejected = raw.count()
    result.processed = 0


def _default(text: str, now: Column) -> Column:
    if text.upper().startswith("CURRENT_TIMESTAMP"):
        return now
    return F.expr(dialect.to_spark(text))


def _write_quarantine(store: Store, records: DataFrame, batch_id: str, source: str, target: str, now: Column) -> None:
    store.append(
        "quarantine_records",
        records.select(
            F.expr("uuid()").alias("quarantine_id"), F.lit(batch_id).alias("batch_id"),
            F.lit(source).alias("source_table"), F.lit(target.upper()).alias("target_table"),
            "source_record", "failed_rules", "error_details",
            now.alias("quarantine_timestamp"), F.lit(False).alias("resolved"),
        ),
        partition_by=["batch_id"],
    )


def _write_metrics(store: Store, metrics: DataFrame, batch_id: str, now: Column) -> None:
    store.append(
        "data_quality_metrics",
        metrics.select(
            F.expr("uuid()").alias("metric_id"), F.lit(batch_id).alias("batch_id"),
            now.alias("measurement_timestamp"), "*",
        ),
        partition_by=["batch_id"],
    )


def _write_log(store: Store, result: BatchResult, source: str, target: str, as_of: datetime.datetime,
               mark: str | None = None) -> None:
    """Append the state of a batch; a PROCESSING row has no end."""
    ended = None if result.status == "PROCESSING" else as_of
    row = store.spark.createDataFrame(
        [(result.batch_id, source, target.upper(), as_of, ended, result.status, result.read, result.processed,
          result.inserted, result.updated, result.rejected, result.rules_applied,
          result.message if result.status in ("FAILED", "QUARANTINED") else None,
          json.dumps({"message": result.message, "watermark": mark}))],
        "batch_id string, source_table string, target_table string, start_timestamp timestamp_ntz, "
        "end_timestamp timestamp_ntz, status string, records_read bigint, records_processed bigint, "
        "records_inserted bigint, records_updated bigint, records_rejected bigint, rules_applied int, "
        "error_message string, processing_metadata string",
    )
    store.append(LOG, row.coalesce(1))


def process_all_pending(store: Store, target: str, as_of: datetime.datetime, max_batches: int | None = None,
                        **options) -> list[BatchResult]:
    """Batches until nothing is left or one fails; ``max_batches`` stops earlier."""
    done = []
    while max_batches is None or len(done) < max_batches:
        result = transform_batch(store, target, as_of, **options)
        if result.status == "FAILED":
            done.append(result)
            break
        if result.read == 0:
            break
        done.append(result)
    return done


def transform_all_targets(store: Store, as_of: datetime.datetime, **options) -> BatchResult:
    """One batch for every active target; a summary log row tells the overall status."""
    targets = sorted(
        r[0] for r in collect_metadata(store.snapshot("target_schemas").filter("active").select("table_name").distinct())
    )
    results = [transform_batch(store, t, as_of, **options) for t in targets]
    failed = [r for r in results if r.status != "SUCCESS"]
    status = "SUCCESS" if not failed else ("FAILED" if len(failed) == len(results) else "PARTIAL_SUCCESS")
    total = BatchResult(
        new_batch_id(store.spark, as_of), status, sum(r.read for r in results), sum(r.processed for r in results),
        sum(r.inserted for r in results), sum(r.updated for r in results), sum(r.rejected for r in results),
        message=f"{len(results) - len(failed)} of {len(results)} targets transformed",
    )
    _write_log(store, total, "RAW_DATA_TABLE", "ALL", as_of)
    return total


def discovery_log_row(raw: DataFrame, schemas: DataFrame, as_of: Column) -> DataFrame:
    """One log row: raw rows present and active targets, as an object."""
    targets = schemas.filter("active").agg(F.count_distinct("table_name").alias("n")).scalar()
    return raw.agg(F.count(F.lit(1)).alias("bronze_records")).select(
        F.lit("DISCOVERY").alias("batch_id"), F.lit("SUCCESS").alias("status"),
        as_of.alias("start_timestamp"),
        F.to_variant_object(
            F.struct(F.col("bronze_records"), targets.alias("target_tables"))
        ).alias("processing_metadata"),
    )


def reset_watermark(store: Store, target: str, source: str = "RAW_DATA_TABLE") -> None:
    """Forget the mark of a pair, so the next batch starts from the first row."""
    state = store.snapshot("processing_watermarks")
    gone = F.col("watermark_id") == f"{source}_TO_{target.upper()}"
    store.replace("processing_watermarks", delete_where(state, gone))


def resolve_quarantine(records: DataFrame, decisions: DataFrame, as_of: Column) -> DataFrame:
    """Quarantine records with resolutions (quarantine_id, resolution_action, resolved_by) applied."""
    known = decisions.join(records.select("quarantine_id"), "quarantine_id", "left_semi")
    return merge_rows(
        records, known, ["quarantine_id"], ["resolution_action", "resolved_by"],
        {"resolved": F.lit(True), "resolution_timestamp": as_of},
    )
