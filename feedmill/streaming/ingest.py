"""Landing areas and raw rows as streams."""

from __future__ import annotations

import datetime
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedmill.functions import paths
from feedmill.functions.dates import ntz
from feedmill.operators.merge import rows_to_insert
from feedmill.plans import bronze, silver
from feedmill.plans.store import Store
from feedmill.sources.listing import relative

FILES_PER_TRIGGER = 10


def landing_stream(spark: SparkSession, landing: str, files_per_trigger: int = FILES_PER_TRIGGER,
                   archive: str | None = None) -> DataFrame:
    """Stream of new file names; Spark's file log remembers what was seen.

    With ``archive`` finished files are moved there by the file source.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_trigger)
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(landing).select(
        relative(F.col("path"), landing).alias("file_name"), F.col("length").alias("size")
    )


def stream_files_to_raw(store: Store, landing: str, checkpoint: str, as_of: Callable[[], datetime.datetime],
                        files_per_trigger: int = FILES_PER_TRIGGER, once: bool = True) -> StreamingQuery:
    """Load arriving files and queue each with its outcome, refused files with the reason.

    A repeated micro-batch adds nothing: rows are keyed by file and row. A file
    that failed is left to ``bronze.discover_files``, which retries it.
    """

    def load(batch: DataFrame, _: int) -> None:
        name = F.col("file_name")
        named = batch.select(
            "file_name", paths.file_type(name).alias("kind"),
            paths.rejection_reason(name, F.col("size")).alias("reason"),
        ).collect()  # at most files_per_trigger
        files = [(r.file_name, r.kind) for r in named if r.reason is None]
        refused = [(r.file_name, r.kind, f"FAILURE: {r.reason}") for r in named if r.reason is not None]
        results = store.spark.createDataFrame(refused, "file_name string, file_type string, result string")
        if files:
            loaded = bronze.load_files(store, landing, files, ntz(as_of())).results
            results = results.unionByName(loaded.select("file_name", "file_type", "result"))
        if named:
            bronze.record_results(store, results, ntz(as_of()))

    writer = landing_stream(store.spark, landing, files_per_trigger).writeStream.foreachBatch(load)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="60 minutes")).start()


def append_new(store: Store, table: str, rows: DataFrame, keys: list[str], partition_by: list[str] | None = None) -> None:
    """Append rows whose key the table lacks (the micro-batch itself is deduplicated too)."""
    fresh = rows_to_insert(rows.dropDuplicates(keys), store.read(table), keys)
    store.append(table, fresh, partition_by)


def stream_distinct(rows: DataFrame, keys: list[str], event_time: str, delay: str, target: str, checkpoint: str) -> StreamingQuery:
    """Write the first row of each key of a stream to the Parquet folder ``target``, a part per micro-batch.

    Keys live in the state store from their first row until the watermark, the latest
    ``event_time`` less ``delay``, passes it by ``delay``; rows older than the watermark
    are dropped. So the state holds the keys of that span, however long the stream
    runs. A repeated micro-batch replaces its own part.
    """
    first = rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return (
        first.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stream_raw_to_silver(store: Store, target: str, checkpoint: str,
                         as_of: Callable[[], datetime.datetime], **options) -> StreamingQuery:
    """Run a silver batch whenever raw rows arrive; the high-water mark decides what is new."""
    raw = store.spark.readStream.schema(store.read("raw_data").schema).parquet(store.path("raw_data"))

    def run(batch: DataFrame, _: int) -> None:
        failed = [r for r in silver.process_all_pending(store, target, as_of(), **options) if r.status == "FAILED"]
        if failed:
            # the trigger fails with its batch, so that the next start repeats it
            raise RuntimeError(f"silver batch failed: {failed[-1]}")

    return (
        raw.select("raw_id").writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
