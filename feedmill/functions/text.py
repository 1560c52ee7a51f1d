"""Text helpers built from Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def normalise_name(name: Column) -> Column:
    """Field name with punctuation blanked, lower-cased and trimmed."""
    return F.trim(F.lower(F.regexp_replace(F.coalesce(name, F.lit("")), "[^a-zA-Z0-9]", " ")))


def edit_similarity(left: Column, right: Column) -> Column:
    """1 - edit distance / longer length; two empty strings are equal."""
    longest = F.greatest(F.length(left), F.length(right))
    return F.when(longest == 0, F.lit(1.0)).otherwise(
        F.lit(1.0) - F.levenshtein(left, right) / longest
    )


def format_phone(phone: Column) -> Column:
    digits = F.regexp_replace(phone, "[^0-9]", "")
    return F.regexp_replace(digits, "([0-9]{3})([0-9]{3})([0-9]{4})", "($1) $2-$3")


def map_codes(code: Column, groups: dict[str, list[str]]) -> Column:
    """Replace any listed variant by its standard value, keep the rest."""
    mapped = code
    for standard, variants in groups.items():
        mapped = F.when(code.isin(*variants), F.lit(standard)).otherwise(mapped)
    return mapped


def matches_whole(text: Column, pattern: str) -> Column:
    """Whole-string regex match (Spark's ``rlike`` matches anywhere)."""
    return text.rlike(f"^(?:{pattern})$")


def parse_flag(text: Column) -> Column:
    return F.coalesce(F.upper(F.trim(text)).isin("TRUE", "YES", "1"), F.lit(False))


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def register_sql_functions(spark: SparkSession) -> None:
    """SQL functions that rule and mapping text may call."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION format_phone(phone STRING) RETURNS STRING "
        "RETURN regexp_replace(regexp_replace(phone, '[^0-9]', ''), "
        "'([0-9]{3})([0-9]{3})([0-9]{4})', '($1) $2-$3')"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION generate_batch_id(at TIMESTAMP_NTZ) RETURNS STRING "
        "RETURN concat('BATCH_', date_format(at, 'yyyyMMdd_HHmmss'), '_', substring(uuid(), 1, 8))"
    )


def batch_id(at: Column) -> Column:
    return F.concat(
        F.lit("BATCH_"), F.date_format(at, "yyyyMMdd_HHmmss"), F.lit("_"),
        F.substring(F.expr("uuid()"), 1, 8),
    )


def rows_in_result(result: Column) -> Column:
    """Leading row count of a load message; other messages count as zero."""
    return F.when(
        result.like("%rows%"), F.regexp_substr(result, F.lit("[0-9]+")).try_cast("int")
    ).otherwise(F.lit(0))
