"""State tables as Parquet folders.

Three write patterns, all plain Spark writes: append-only (logs, raw rows),
whole snapshots for small metadata tables, and key-bucketed silver tables in
which an upsert rewrites only the buckets the batch touches. One writer per
table is assumed. With a row-level-capable catalog the same calls map to
MERGE INTO.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill import model
from feedmill.operators.merge import merge_rows

BUCKET = "key_bucket"
NULL_BUCKET = -1
# Raw id of a row without a key; a replayed batch finds its keyless rows by it.
ROW = "keyless_row"


@dataclass
class Store:
    spark: SparkSession
    root: str
    buckets: int = 64

    # -- folders ---------------------------------------------------------------

    def path(self, table: str) -> str:
        return f"{self.root}/{table.lower()}"

    def _folder(self, path: str):
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def exists(self, table: str) -> bool:
        fs, target = self._folder(self.path(table))
        return fs.exists(target)

    def _numbers(self, table: str) -> list[int]:
        fs, target = self._folder(self.path(table))
        if not fs.exists(target):
            return []
        names = [entry.getPath().getName() for entry in fs.listStatus(target)]
        return sorted(int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit())

    def _complete(self, table: str, version: int) -> bool:
        fs, marker = self._folder(f"{self.path(table)}/v{version}/_SUCCESS")
        return fs.exists(marker)

    def versions(self, table: str) -> list[int]:
        """Complete snapshot numbers of a table, oldest first."""
        return [v for v in self._numbers(table) if self._complete(table, v)]

    def latest(self, table: str) -> int | None:
        return next((v for v in reversed(self._numbers(table)) if self._complete(table, v)), None)

    def purge(self, table: str, keep: int = 10) -> int:
        """Delete all but the newest ``keep`` snapshots; returns how many went."""
        old = self.versions(table)[:-keep]
        for version in old:
            fs, target = self._folder(f"{self.path(table)}/v{version}")
            fs.delete(target, True)
        return len(old)

    # -- append-only ------------------------------------------------------------

    def append(self, table: str, rows: DataFrame, partition_by: list[str] | None = None) -> None:
        if table in model.TABLES:
            rows = conform(rows, model.TABLES[table])
        writer = rows.write.mode("append")
        if partition_by:
            # Few files per folder; AQE splits a folder holding most of the rows.
            writer = rows.hint("rebalance", *[F.col(c) for c in partition_by]).write.mode("append")
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(table))

    def drop_partition(self, table: str, column: str, value: str) -> None:
        """Delete what was appended to one partition folder of a table."""
        fs, target = self._folder(f"{self.path(table)}/{column}={value}")
        fs.delete(target, True)

    def read(self, table: str) -> DataFrame:
        """An append-only or bucketed table; a known table without data is empty."""
        if not self.exists(table):
            return model.empty(self.spark, table)
        reader = self.spark.read
        if table in model.TABLES:
            reader = reader.schema(model.TABLES[table])
        return reader.parquet(self.path(table))

    # -- snapshots ---------------------------------------------------------------

    def snapshot(self, table: str, version: int | None = None) -> DataFrame:
        chosen = self.latest(table) if version is None else version
        if chosen is None:
            return model.empty(self.spark, table)
        return self.spark.read.schema(model.TABLES[table]).parquet(f"{self.path(table)}/v{chosen}")

    def replace(self, table: str, rows: DataFrame) -> int:
        """Write the next snapshot; readers switch when it is complete."""
        version = (self._numbers(table) or [0])[-1] + 1
        conform(rows, model.TABLES[table]).write.mode("overwrite").parquet(f"{self.path(table)}/v{version}")
        return version

    def restore(self, table: str, version: int) -> int:
        return self.replace(table, self.snapshot(table, version))

    def merge(self, table: str, source: DataFrame, keys: list[str], update: list[str] | None = None,
              set_values: dict[str, Column] | None = None,
              insert_values: dict[str, Column] | None = None) -> int:
        merged = merge_rows(self.snapshot(table), source, keys, update, set_values, insert_values)
        return self.replace(table, merged)

    # -- bucketed silver tables ----------------------------------------------------

    def create(self, table: str, schema: str) -> None:
        empty = self.spark.createDataFrame([], f"{schema}, {ROW} bigint, {BUCKET} int")
        empty.write.mode("errorifexists").parquet(f"{self.root}/_schema/{table.lower()}")

    def swap(self, table: str, rows: DataFrame) -> None:
        """Replace data and columns of a silver table by ``rows``, which may read it.

        All is written beside the table first. From the marker on, a reader
        finishes a switch that was cut off; before it, the old table stands.
        """
        beside = f"{self.path(table)}.next"
        columns = [c for c in rows.columns if c not in (ROW, BUCKET)]
        rows.select(*columns, ROW, BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{beside}/data")
        rows.select(*columns, ROW, BUCKET).limit(0).write.mode("overwrite").parquet(f"{beside}/shape")
        fs, marker = self._folder(f"{beside}/ready")
        fs.mkdirs(marker)
        self._finish_swap(table)

    def reshape(self, table: str, rows: DataFrame) -> None:
        """Replace the columns of a silver table by those of ``rows``, writing no data.

        Files that lack a column read as NULL, so this suits added columns only.
        """
        beside = f"{self.path(table)}.next"
        fs, stale = self._folder(beside)
        fs.delete(stale, True)
        columns = [c for c in rows.columns if c not in (ROW, BUCKET)]
        rows.select(*columns, ROW, BUCKET).limit(0).write.parquet(f"{beside}/shape")
        fs.mkdirs(self._folder(f"{beside}/ready")[1])
        self._finish_swap(table)

    def _finish_swap(self, table: str) -> None:
        beside = f"{self.path(table)}.next"
        fs, marker = self._folder(f"{beside}/ready")
        if not fs.exists(marker):
            return
        for part, place in (("data", self.path(table)), ("shape", f"{self.root}/_schema/{table.lower()}")):
            _, new = self._folder(f"{beside}/{part}")
            _, old = self._folder(place)
            if fs.exists(new):
                fs.delete(old, True)
                fs.rename(new, old)
        fs.delete(marker.getParent(), True)

    def is_created(self, table: str) -> bool:
        self._finish_swap(table)
        fs, target = self._folder(f"{self.root}/_schema/{table.lower()}")
        return fs.exists(target)

    def drop(self, *tables: str) -> None:
        for name in tables:
            for folder in (self.path(name), f"{self.root}/_schema/{name.lower()}"):
                fs, target = self._folder(folder)
                fs.delete(target, True)

    def silver(self, table: str) -> DataFrame:
        self._finish_swap(table)
        shape = self.spark.read.parquet(f"{self.root}/_schema/{table.lower()}")
        if not self.exists(table):
            return shape
        return self.spark.read.schema(shape.schema).parquet(self.path(table))

    def bucket_of(self, key: str) -> Column:
        return F.when(F.col(key).isNull(), F.lit(NULL_BUCKET)).otherwise(
            F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(self.buckets)).cast("int")
        )

    def upsert(self, table: str, batch: DataFrame, key: str, update: list[str],
               set_values: dict[str, Column] | None = None,
               insert_values: dict[str, Column] | None = None) -> tuple[int, int]:
        """Merge ``batch`` (unique on its non-null key); returns (inserted, updated).

        Only buckets holding a key of the batch are read and rewritten, by
        dynamic partition overwrite. Rows without a key are appended, unless the
        batch names their raw ids in ``keyless_row`` and the table holds that id.
        """
        target = self.silver(table)
        batch = batch.withColumn(BUCKET, self.bucket_of(key))
        if ROW not in batch.columns:
            batch = batch.withColumn(ROW, F.lit(None).cast("bigint"))
        keyless = batch.filter(F.col(key).isNull())
        keyed = batch.filter(F.col(key).isNotNull()).withColumn(ROW, F.lit(None).cast("bigint"))
        touched = [r[0] for r in keyed.select(BUCKET).distinct().collect()]
        total = batch.count()
        updated = replayed = 0
        if touched:
            old = target.filter(F.col(BUCKET).isin(touched))
            updated = keyed.join(old.select(BUCKET, key), [BUCKET, key], "left_semi").count()
            merged = merge_rows(old, keyed, [BUCKET, key], update, set_values, insert_values)
            (
                merged.hint("rebalance", F.col(BUCKET))
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy(BUCKET).parquet(self.path(table))
            )
        alone = keyless.agg(F.count(F.lit(1)).alias("n"), F.min(ROW).alias("low"), F.max(ROW).alias("high")).first()
        if alone.n:
            if alone.low is not None:
                held = target.filter((F.col(BUCKET) == NULL_BUCKET) & F.col(ROW).between(alone.low, alone.high)).select(ROW)
                replayed = keyless.join(held, ROW, "left_semi").count()
                keyless = keyless.join(held, ROW, "left_anti")
            rows = merge_rows(target.limit(0), keyless, [key], [], {}, insert_values)
            rows.withColumn(BUCKET, F.lit(NULL_BUCKET)).write.mode("append").partitionBy(BUCKET).parquet(self.path(table))
        return total - updated - replayed, updated


def conform(rows: DataFrame, schema: str) -> DataFrame:
    """Columns of ``schema`` in order; missing ones become NULL."""
    shape = rows.sparkSession.createDataFrame([], schema).schema
    present = {c.lower(): c for c in rows.columns}
    return rows.select(
        *[
            (F.col(present[f.name.lower()]) if f.name.lower() in present else F.lit(None))
            .cast(f.dataType).alias(f.name)
            for f in shape.fields
        ]
    )
