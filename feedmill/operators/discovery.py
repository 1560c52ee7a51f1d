"""What the semi-structured rows contain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.functions.variant import fields_of, read_first


def discover_schema(raw: DataFrame, sample_size: int | None = None) -> DataFrame:
    """Per field: most frequent type, nulls, distinct values, values seen.

    Types are counted per (field, type, value) first, so neither a hot field
    nor a hot value reaches one task row by row.
    """
    values = fields_of(raw.select("raw_data"), "raw_data").filter("field_name IS NOT NULL")
    typed = values.select(
        "field_name",
        F.regexp_replace(F.schema_of_variant("field_value"), r"\(.*\)$", "").alias("type"),
        F.to_json("field_value").alias("text"),
    )
    if sample_size is not None:
        typed = typed.limit(sample_size)
    is_null = F.col("type") == "VOID"
    per_value = typed.groupBy("field_name", "type", "text").agg(F.count(F.lit(1)).alias("n"))
    per_type = per_value.groupBy("field_name", "type").agg(
        F.sum("n").alias("n"), F.count(F.when(~is_null, F.col("text"))).alias("distinct")
    )
    order = F.struct(F.col("n"), F.col("type"))
    return per_type.groupBy("field_name").agg(
        F.max_by("type", order).alias("data_type"),
        F.sum(F.when(is_null, F.col("n")).otherwise(0)).alias("null_count"),
        F.sum("distinct").alias("distinct_count"),
        F.sum("n").alias("sample_count"),
    )


def field_presence(raw: DataFrame, spellings: dict[str, list[str]]) -> DataFrame:
    """Rows in which any spelling of a field has a value; one scan for all fields."""
    totals = raw.agg(
        *[
            F.count(read_first(F.col("raw_data"), names)).alias(f"f{i}")
            for i, names in enumerate(spellings.values())
        ]
    )
    entries = F.array(
        *[
            F.struct(F.lit(label).alias("field_name"), F.col(f"f{i}").alias("row_count"))
            for i, label in enumerate(spellings)
        ]
    )
    return totals.select(F.explode(entries).alias("e")).select("e.*")
