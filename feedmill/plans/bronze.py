"""Files to raw rows: discovery, loading, queue states, moves and reprocessing."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill import model
from feedmill.functions import paths
from feedmill.operators.limits import top
from feedmill.operators.merge import delete_where, merge_rows, rows_to_insert, update_where
from feedmill.plans.store import Store, conform
from feedmill.session import drop_staged, stage
from feedmill.sources import listing as L
from feedmill.sources import tabular

QUEUE = "file_processing_queue"
FILES_PER_RUN = 10
MAX_RETRIES = 3
# Up to this many file names are pushed to the scan of the rows already loaded.
PUSHED_FILES = 1000


def discover_files(store: Store, landing: str, as_of: Column) -> int:
    """Queue files of the landing area that are new or may be tried again; returns how many."""
    queue = store.snapshot(QUEUE)
    found = L.new_files(L.admissible(L.list_files(store.spark, landing)), queue)
    found = found.join(given_up(queue).select("file_name"), "file_name", "left_anti")
    fresh = stage(found.filter("file_type IS NOT NULL AND rejection_reason IS NULL"), "discovered")
    count = fresh.count()
    if count:
        store.merge(
            QUEUE, numbered(fresh, queue, as_of), ["file_name"],
            update=["file_type", "status", "discovered_timestamp"],
            set_values={"process_result": F.lit(None), "error_message": F.lit(None)},
        )
    drop_staged(fresh)
    return count


def numbered(found: DataFrame, queue: DataFrame, as_of: Column) -> DataFrame:
    """Pending queue rows; ids continue after the highest one, gaps allowed."""
    last = queue.agg(F.coalesce(F.max("queue_id"), F.lit(0)).alias("n")).first()[0]
    return found.select(
        (F.lit(last + 1) + F.monotonically_increasing_id()).alias("queue_id"),
        "file_name", "file_type", F.lit("PENDING").alias("status"),
        as_of.alias("discovered_timestamp"), F.lit(0).alias("retry_count"),
    )


def pick_pending(queue: DataFrame, limit: int = FILES_PER_RUN) -> DataFrame:
    return top(queue.filter("status = 'PENDING'"), [F.asc("discovered_timestamp"), F.asc("queue_id")], limit)


@dataclass
class Load:
    """Outcome of loading some files: one row per file, and the new raw rows."""

    results: DataFrame
    inserted: DataFrame


def load_files(store: Store, landing: str, files: list[tuple[str, str]], as_of: Column,
               stage_name: str = "SRC") -> Load:
    """Load (file_name, file_type) pairs: all files in one plan, each row at most once.

    The parsed cells are written once to the shared folder; headers, row counts,
    new rows and per-file results are all read off that table.
    """
    spark = store.spark
    csv = [f for f, kind in files if kind == "CSV"]
    excel = [f for f, kind in files if kind == "EXCEL"]
    parts = []
    lines = [tabular.csv_parts(spark, landing, csv)] if csv else []
    if csv:
        parts.append(tabular.csv_cells(lines[0], landing))
    if excel:
        parts.append(tabular.excel_cells(spark, landing, excel))
    cells = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    cells = stage(cells.withColumn("width", tabular.used_width(F.col("cells"))), "cells")
    drop_staged(*lines)

    asked = spark.createDataFrame(files, "file_name string, file_type string")
    listing = L.list_files(spark, landing).join(F.broadcast(asked), "file_name", "left_semi")
    per_file = cells.groupBy("file_name").agg(
        F.min_by("cells", "row_no").alias("header_cells"), F.min_by("width", "row_no").alias("header_width"),
        F.max("width").alias("widest"), F.max("error").alias("error"),
        F.count_if(F.col("row_no") > 1).alias("rows"),
    )
    facts = asked.join(listing, "file_name", "left").join(per_file, "file_name", "left")
    facts = facts.select(
        "file_name", "file_type", "size", "last_modified", "rows",
        tabular.column_names(F.slice("header_cells", F.lit(1), F.col("header_width"))).alias("names"),
        F.when(F.col("size").isNull(), "FAILURE: File not found in stage")
        .when(F.col("error").isNotNull(), F.concat(F.lit("FAILURE: "), F.col("error")))
        .when(F.col("rows").isNull(), "FAILURE: No columns to parse from file")
        .when(F.col("rows") == 0, "FAILURE: File is empty")
        .when(F.col("widest") > F.col("header_width"),
              F.concat(F.lit("FAILURE: Expected "), F.col("header_width").cast("string"),
                       F.lit(" fields, saw "), F.col("widest").cast("string")))
        .alias("failure"),
    )
    ordered = Window.orderBy("file_name")
    loadable = F.when(F.col("failure").isNull(), F.col("rows")).otherwise(0)
    facts = stage(
        facts.withColumn("before", F.coalesce(
            F.sum(loadable).over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))),
        "files",
    )
    total = facts.agg(F.coalesce(F.sum(F.when(F.col("failure").isNull(), F.col("rows"))), F.lit(0))).first()[0]
    base = reserve_ids(store, total)

    good = facts.filter("failure IS NULL")
    name = F.col("file_name")
    rows = cells.filter("row_no > 1").join(F.broadcast(good), "file_name").select(
        (F.lit(base) + F.col("before") + F.col("row_no") - 1).alias("raw_id"),
        F.parse_json(tabular.row_json(F.col("names"), F.col("cells"))).alias("raw_data"),
        "file_name", F.col("row_no").alias("file_row_number"),
        as_of.alias("load_timestamp"), F.lit(stage_name).alias("stage_name"),
        F.col("size").alias("file_size"), F.col("last_modified").alias("file_last_modified"),
        paths.provider(name).alias("tpa"),
    )
    tpas = [r[0] for r in good.select(paths.provider(name)).distinct().collect()]
    known = store.read("raw_data").select("file_name", "file_row_number", "tpa").filter(F.col("tpa").isin(tpas))
    if len(files) <= PUSHED_FILES:
        known = known.filter(F.col("file_name").isin([f for f, _ in files]))
    known = known.join(F.broadcast(good.select("file_name")), "file_name", "left_semi")
    fresh = rows_to_insert(rows, known, ["file_name", "file_row_number"])
    if total:
        store.append("raw_data", fresh, partition_by=["tpa"])
    drop_staged(cells)
    inserted = store.read("raw_data").filter(
        F.col("tpa").isin(tpas) & F.col("raw_id").between(base + 1, base + total)
    )
    counts = inserted.groupBy("file_name").agg(F.count(F.lit(1)).alias("inserted"))
    done = facts.join(counts, "file_name", "left").withColumn("inserted", F.coalesce("inserted", F.lit(0)))
    text = lambda c: F.col(c).cast("string")
    results = done.select(
        "file_name", "file_type", "rows", "inserted",
        F.coalesce(
            "failure",
            F.concat(F.lit("SUCCESS: Processed "), text("rows"), F.lit(" rows, Inserted "), text("inserted"),
                     F.lit(", Skipped "), (F.col("rows") - F.col("inserted")).cast("string")),
        ).alias("result"),
    )
    return Load(results, inserted)


def reserve_ids(store: Store, count: int) -> int:
    """Highest id before a new block of ``count`` ids, recorded before they are used."""
    last = store.read("raw_ranges").agg(F.max("last_id")).first()[0] or 0
    if count:
        block = store.spark.createDataFrame(
            [(uuid.uuid4().hex, last + 1, last + count)], "load_id string, first_id bigint, last_id bigint"
        )
        store.append("raw_ranges", block.coalesce(1))
    return last


def queue_after(queue: DataFrame, results: DataFrame, as_of: Column) -> DataFrame:
    """Queue with the outcome of each file; a file fails for good after three retries."""
    ok = F.col("result").startswith("SUCCESS")
    outcome = results.select(
        "file_name", F.when(ok, "SUCCESS").otherwise("FAILED").alias("status"),
        F.col("result").alias("process_result"),
        F.when(~ok, F.col("result")).alias("error_message"),
        as_of.alias("processed_timestamp"),
    )
    known = queue.select("file_name").distinct()
    outcome = outcome.join(known, "file_name", "left_semi")
    merged = merge_rows(
        queue, outcome, ["file_name"],
        update=["status", "process_result", "error_message", "processed_timestamp"],
        set_values={"retry_count": F.col("old")["retry_count"] + F.when(F.col("new")["status"] == "FAILED", 1).otherwise(0)},
    )
    return merged


def retryable(queue: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Failed files still allowed another try."""
    return queue.filter((F.col("status") == "FAILED") & (F.coalesce("retry_count", F.lit(0)) < max_retries))


def given_up(queue: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Files that failed as often as they may."""
    return queue.filter((F.col("status") == "FAILED") & (F.coalesce("retry_count", F.lit(0)) >= max_retries))


def process_queued_files(store: Store, landing: str, as_of: Column, limit: int = FILES_PER_RUN) -> str:
    """Load the oldest pending files and write their states.

    Files are PROCESSING while they load. One writer is assumed, so a file found
    in that state belongs to a run that died; it is pending again.
    """
    queue = store.snapshot(QUEUE)
    queue = update_where(queue, F.col("status") == "PROCESSING", {"status": F.lit("PENDING")})
    picked = [(r.file_name, r.file_type) for r in pick_pending(queue, limit).collect()]
    if not picked:
        return "Processed 0 files"
    chosen = store.spark.createDataFrame([(f,) for f, _ in picked], "file_name string")
    store.replace(QUEUE, merge_rows(
        queue, chosen, ["file_name"], update=[],
        set_values={"status": F.lit("PROCESSING"), "processed_timestamp": as_of}))
    load = load_files(store, landing, picked, as_of)
    store.replace(QUEUE, queue_after(store.snapshot(QUEUE), load.results, as_of))
    store.purge(QUEUE)
    return f"Processed {len(picked)} files"


def record_results(store: Store, results: DataFrame, as_of: Column) -> None:
    """Queue rows with outcome for files (file_name, file_type, result) that came past the queue."""
    queue = store.snapshot(QUEUE)
    unknown = results.join(queue.select("file_name"), "file_name", "left_anti")
    queue = queue.unionByName(conform(numbered(unknown, queue, as_of), model.QUEUE))
    store.replace(QUEUE, queue_after(queue, results, as_of))
    store.purge(QUEUE)


# -- moves and reprocessing -----------------------------------------------------------

def move_plan(queue: DataFrame, status: str, limit: int = FILES_PER_RUN) -> DataFrame:
    """Next files to copy out of the landing area."""
    waiting = queue.filter((F.col("status") == status) & F.col("moved_timestamp").isNull())
    return top(waiting, [F.asc("processed_timestamp"), F.asc("queue_id")], limit).select("queue_id", "file_name")


def stamp_moved(queue: DataFrame, moved: DataFrame, as_of: Column) -> DataFrame:
    marked = moved.select("queue_id", as_of.alias("moved_timestamp"))
    return merge_rows(queue, marked, ["queue_id"], update=["moved_timestamp"])


def archive_plan(completed: DataFrame, errors: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    return (
        L.older_than(completed, as_of, days).withColumn("area", F.lit("COMPLETED"))
        .unionByName(L.older_than(errors, as_of, days).withColumn("area", F.lit("ERROR")))
    )


def reprocess_requests(errors: DataFrame, names: list[str] | None, as_of: Column, limit: int | None = None) -> DataFrame:
    """Requests for named error files that exist, or for all (the first ``limit``, if given)."""
    if names is not None:
        chosen = errors.filter(F.col("file_name").isin(names))
    else:
        chosen = errors if limit is None else top(errors, [F.asc("file_name")], limit)
    return chosen.select(
        "file_name", F.lit("PENDING_REPROCESS").alias("status"), as_of.alias("requested_timestamp")
    )


def apply_reprocessing(queue: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(queue with requested files pending again, requests left over)."""
    wanted = requests.filter("status = 'PENDING_REPROCESS'").select("file_name").distinct()
    hit = F.col("_hit").isNotNull()
    marked = queue.join(wanted.withColumn("_hit", F.lit(True)), "file_name", "left")
    reset = update_where(
        marked, hit,
        {"status": F.lit("PENDING"), "error_message": F.lit("Reprocessing requested"),
         "processed_timestamp": F.lit(None), "process_result": F.lit(None)},
    ).select(*queue.columns)
    moved = update_where(requests, F.col("status") == "PENDING_REPROCESS", {"status": F.lit("MOVED")})
    return reset, delete_where(moved, F.col("status") == "MOVED")
