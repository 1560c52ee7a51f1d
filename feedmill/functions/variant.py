"""Semi-structured rows: building, reading and listing their fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_path(field: str) -> str:
    quoted = field.replace("\\", "\\\\").replace("'", "\\'")
    return f"$['{quoted}']"


def read_field(obj: Column, field: str, as_type: str = "string") -> Column:
    """One field of an object; absent, null and uncastable all read NULL."""
    return F.try_variant_get(obj, json_path(field), as_type)


def read_first(obj: Column, fields: list[str], as_type: str = "string") -> Column:
    """First present spelling of a field."""
    return F.coalesce(*[read_field(obj, name, as_type) for name in fields])


def row_object(*columns: str) -> Column:
    """Row as a variant object that keeps NULL columns as JSON nulls."""
    return F.to_variant_object(F.struct(*columns))


def object_from_map(entries: Column) -> Column:
    return F.parse_json(F.to_json(entries, {"ignoreNullFields": "false"}))


def fields_of(df: DataFrame, obj: str) -> DataFrame:
    """One row per (input row, field): adds ``field_name`` and ``field_value``."""
    flattened = df.lateralJoin(
        df.sparkSession.tvf.variant_explode(F.col(obj).outer())
    )
    return (
        flattened.withColumnRenamed("key", "field_name")
        .withColumnRenamed("value", "field_value")
        .drop("pos")
    )


def field_type(value: Column) -> Column:
    """Type name of a variant value, without precision (``DECIMAL(3,1)`` is ``DECIMAL``)."""
    return F.regexp_replace(F.schema_of_variant(value), r"\(.*\)$", "")
