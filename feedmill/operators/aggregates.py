"""Grouped aggregates in the shapes the reports need, folded before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def most_frequent(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Mode per group; of equally frequent values the smallest.

    Counting per (group, value) first keeps a hot group to one row per value.
    """
    counted = rows.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    best = counted.groupBy(*keys).agg(F.max("_n").alias("_n"))
    return counted.join(best, [*keys, "_n"]).groupBy(*keys).agg(F.min(value).alias(name))


def sorted_values(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Sorted distinct values per group; no value gives an empty array.

    Values are made distinct before they are gathered, so an array holds each once.
    """
    distinct = rows.select(*keys, value).distinct()
    return distinct.groupBy(*keys).agg(F.array_sort(F.collect_set(value)).alias(name))


def listed_values(rows: DataFrame, keys: list[str], value: str, name: str, separator: str = ", ") -> DataFrame:
    """Sorted distinct values per group as one text."""
    distinct = rows.select(*keys, value).distinct().withColumnRenamed(value, "_value")
    return distinct.groupBy(*keys).agg(
        F.expr(f"listagg(_value, '{separator}') WITHIN GROUP (ORDER BY _value)").alias(name)
    )


def distinct_counts(rows: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """Distinct values of several columns per group, each column counted on its own.

    One distinct aggregate at a time avoids the row multiplication of several
    ``count(distinct)`` in one query; the results meet on the group key.
    """
    parts = [
        rows.select(*key, v).distinct().groupBy(*key).agg(F.count(v).alias(f"distinct_{v}")) for v in values
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.join(part, key, "full") if key else out.select("*", part.scalar().alias(part.columns[0]))
    return out


def distinct_when(rows: DataFrame, keys: list[str], condition: str, value: str) -> DataFrame:
    """Distinct values with and without the condition, per group."""
    hit = F.expr(condition)
    per_value = rows.groupBy(*keys, value).agg(
        F.max(F.coalesce(hit, F.lit(False))).alias("_any"), F.max(~F.coalesce(hit, F.lit(False))).alias("_none")
    ).filter(F.col(value).isNotNull())
    return per_value.groupBy(*keys).agg(
        F.count_if("_any").alias("distinct_matching"), F.count_if("_none").alias("distinct_other")
    )
