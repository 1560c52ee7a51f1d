"""Top-k, paging and bounded batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.session import stage

_RANGES = 1000
DEEP = 100_000
_SMALL = 10_000


def top(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def page(df: DataFrame, order: list[Column], limit: int, offset: int = 0, deep: int = DEEP) -> DataFrame:
    """``limit`` rows after the first ``offset``; ``order`` is by names of columns.

    Up to ``deep`` rows in front are skipped by a sort that keeps limit + offset rows.
    Beyond, rows are dealt to ranges of the order and written, counts per range
    (at most 1000 reach the driver) tell the ranges the page lies in, and only
    those go on. Rows of equal order stay in one range.
    """
    rows = df
    while offset > deep:
        ranged = rows.repartitionByRange(_RANGES, *order).withColumn("_range", F.spark_partition_id())
        ranged = stage(ranged, "page-ranges")
        counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).orderBy("_range").collect()
        start, inside = 0, []
        for part in counts:
            if start + part.n > offset and start < offset + limit:
                inside.append((part["_range"], start, part.n))
            start += part.n
        if not inside:
            return ranged.drop("_range").limit(0)
        rows = ranged.filter(F.col("_range").between(inside[0][0], inside[-1][0])).drop("_range")
        offset -= inside[0][1]
        if len(inside) == len(counts):
            break  # nothing was left out: one value of the order fills a range
    return rows.orderBy(*order).offset(offset).limit(limit)


def batch_bounds(rows: DataFrame, id_column: str, after: int, size: int | None) -> tuple[int, int] | None:
    """(first, last) id of the next ``size`` rows above ``after``; None when there are none.

    The n-th smallest id is found by counting ids per range and narrowing the
    range it falls in, so no sort and no single-task limit over the whole batch
    is needed. At most 1000 range counts reach the driver per step.
    """
    pending = rows.select(F.col(id_column).alias("id")).filter(F.col("id") > after)
    low, high = pending.agg(F.min("id"), F.max("id")).first()
    if low is None:
        return None
    first = low
    if size is None:
        return first, high
    wanted = size
    while True:
        width = max(1, -(-(high - low + 1) // _RANGES))
        counts = (
            pending.filter((F.col("id") >= low) & (F.col("id") <= high))
            .groupBy(F.floor((F.col("id") - low) / width).cast("long").alias("slot"))
            .agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last"))
            .orderBy("slot")
            .collect()
        )
        for slot in counts:
            if slot.n < wanted:
                wanted -= slot.n
                continue
            if slot.n == wanted or width == 1:
                return first, slot.last
            low, high = low + slot.slot * width, slot.last
            if slot.n <= _SMALL:
                tail = (
                    pending.filter((F.col("id") >= low) & (F.col("id") <= high))
                    .orderBy("id").limit(wanted).agg(F.max("id")).first()
                )
                return first, tail[0]
            break
        else:
            return first, high
