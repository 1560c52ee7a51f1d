"""What lies in a landing area."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.functions import paths


def relative(path: Column, landing: str) -> Column:
    """Path below the landing folder, whatever scheme precedes it."""
    root = re.sub(r"^[a-z0-9]+:/*", "/", landing).rstrip("/")
    return F.regexp_replace(path, "^.*?" + re.escape(root) + "/", "")


def list_files(spark: SparkSession, landing: str) -> DataFrame:
    """(file_name, size, last_modified) of all files; contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing)
        .select(
            relative(F.col("path"), landing).alias("file_name"),
            F.col("length").alias("size"),
            F.col("modificationTime").cast("timestamp_ntz").alias("last_modified"),
        )
    )


def admissible(listing: DataFrame) -> DataFrame:
    """Listing with file type, provider and the reason a file is refused (NULL if none)."""
    name = F.col("file_name")
    return listing.select(
        "*",
        paths.file_type(name).alias("file_type"),
        paths.provider(name).alias("tpa"),
        paths.rejection_reason(name, F.col("size")).alias("rejection_reason"),
    )


def new_files(listing: DataFrame, queue: DataFrame) -> DataFrame:
    """Files not queued as pending, running or done; failed ones come again."""
    known = queue.filter(F.col("status").isin("PENDING", "PROCESSING", "SUCCESS")).select("file_name")
    return listing.join(known, "file_name", "left_anti")


def older_than(listing: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    return listing.filter(F.col("last_modified") < as_of - F.expr(f"INTERVAL {days} DAYS"))
