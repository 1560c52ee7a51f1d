"""Upsert, insert-only merge, conditional update and delete over DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: list[str] | None = None,
    set_values: dict[str, Column] | None = None,
    insert_values: dict[str, Column] | None = None,
    action: str | None = None,
) -> DataFrame:
    """Target after MERGE: matched rows take ``update`` columns, the rest is inserted.

    Keys compare NULL-safe, and ``source`` must hold one row per key.
    ``set_values`` are assigned on a match, ``insert_values`` on an insert;
    columns the source lacks stay as they are or start NULL. ``action`` names
    an extra column telling KEEP, UPDATE or INSERT.
    """
    set_values, insert_values = set_values or {}, insert_values or {}
    given = [c for c in source.columns if c in target.columns]
    update = [c for c in given if c not in keys] if update is None else update
    old = target.select(F.struct(*target.columns).alias("old"), *[F.col(k).alias(f"_t_{k}") for k in keys])
    new = source.select(F.struct(*given).alias("new"), *[F.col(k).alias(f"_s_{k}") for k in keys])
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"_t_{key}").eqNullSafe(F.col(f"_s_{key}"))
    joined = old.join(new, same, "full")
    missing_old, missing_new = F.col("old").isNull(), F.col("new").isNull()
    out = []
    for field in target.schema.fields:
        c = field.name
        kept = F.col("old")[c]
        inserted = F.col("new")[c] if c in given else insert_values.get(c, F.lit(None))
        if c in set_values:
            matched = set_values[c]
        elif c in update and c in given:
            matched = F.col("new")[c]
        else:
            matched = kept
        value = F.when(missing_new, kept).when(missing_old, inserted).otherwise(matched)
        out.append(value.cast(field.dataType).alias(c))
    if action:
        out.append(
            F.when(missing_new, "KEEP").when(missing_old, "INSERT").otherwise("UPDATE").alias(action)
        )
    return joined.select(*out)


def rows_to_insert(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key the target lacks (insert-only merge, NULL-safe keys)."""
    known = target.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_k_{key}"))
    return source.join(known, same, "left_anti")


def update_where(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    hit = F.coalesce(condition, F.lit(False))
    return df.select(
        *[
            F.when(hit, values[f.name]).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name)
            if f.name in values
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    return df.filter(~F.coalesce(condition, F.lit(False)))


def apply_changes(df: DataFrame, changes: DataFrame, key: str, editable: list[str]) -> DataFrame:
    """Row edits as data: ``changes`` has ``op`` (I, U, D, S), the key and new values.

    U sets the editable columns that are not NULL in the change, D deletes, S
    switches ``active`` off, I inserts.
    """
    old = df.select(F.struct(*df.columns).alias("old"), F.col(key).alias("_k"))
    new = changes.select(F.struct(*changes.columns).alias("new"), F.col(key).alias("_c"))
    joined = old.join(new, F.col("_k") == F.col("_c"), "full")
    op = F.col("new")["op"]
    joined = joined.filter(~F.coalesce(op == "D", F.lit(False)))
    joined = joined.filter(F.col("old").isNotNull() | (op == "I"))
    out = []
    for field in df.schema.fields:
        c = field.name
        kept = F.col("old")[c]
        given = F.col("new")[c] if c in changes.columns else F.lit(None)
        value = F.when(F.col("old").isNull(), given)
        if c in editable:
            value = value.when(op == "U", F.coalesce(given, kept))
        if c == "active":
            value = value.when(op == "S", F.lit(False))
        out.append(value.otherwise(kept).cast(field.dataType).alias(c))
    return joined.select(*out)


def diff_rows(old: DataFrame, new: DataFrame, key: str, compare: list[str]) -> DataFrame:
    """Changes turning ``old`` into ``new``: I inserted, D removed, U changed."""
    left = old.select(F.col(key).alias("_o"), F.struct(*compare).alias("old"))
    right = new.select(F.col(key).alias("_n"), F.struct(*compare).alias("new"))
    joined = left.join(right, F.col("_o") == F.col("_n"), "full")
    op = (
        F.when(F.col("old").isNull(), "I")
        .when(F.col("new").isNull(), "D")
        .when(~F.col("old").eqNullSafe(F.col("new")), "U")
    )
    return joined.select(
        op.alias("op"), F.coalesce("_o", "_n").alias(key), F.col("new.*")
    ).filter("op IS NOT NULL")
