"""How much of each file, and of each target, the approved mappings cover."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions.variant import fields_of
from feedmill.operators.dedup import keep_one
from feedmill.operators.joins import bounded_broadcast, join_any


def file_columns(raw: DataFrame) -> DataFrame:
    """(file_name, tpa, source_column) of each file's newest row."""
    newest = keep_one(
        raw.select("file_name", "tpa", "load_timestamp", "raw_id", "raw_data"),
        ["file_name"], [F.desc("load_timestamp"), F.desc("raw_id")],
    )
    return fields_of(newest.select("file_name", "tpa", "raw_data"), "raw_data").filter(
        "field_name IS NOT NULL"
    ).select("file_name", "tpa", F.col("field_name").alias("source_column"))


def active_tables(schemas: DataFrame) -> Column:
    """Names of the active target tables, one array found by the query itself."""
    names = schemas.filter("active").agg(F.array_sort(F.collect_set("table_name")).alias("names"))
    return names.scalar()


def fields_by_table(columns: DataFrame, schemas: DataFrame) -> DataFrame:
    """Every column beside every active target table.

    The table names are one array, so the pairing is a map over the columns and
    not a join.
    """
    paired = columns.withColumn("_tables", active_tables(schemas))
    return paired.withColumn("target_table", F.explode("_tables")).drop("_tables")


def column_hits(columns: DataFrame, mappings: DataFrame) -> DataFrame:
    """(file_name, target_table, source_column, target_column) of columns with an approved mapping.

    Columns meet mappings by name: those of the file's provider and those of all
    providers are two joins, so a name mapped by many providers meets only one of them.
    """
    approved = bounded_broadcast(mappings.filter("approved AND mapping_id IS NOT NULL").select(
        F.upper(F.trim("source_field")).alias("_field"), "target_table",
        F.col("tpa").alias("_tpa"), "target_column",
    ))
    same_name = F.upper(F.trim("source_column")) == F.col("_field")
    found = join_any(columns, approved, [same_name & (F.col("_tpa") == F.col("tpa")), same_name & F.col("_tpa").isNull()])
    return found.select("file_name", "target_table", "source_column", "target_column")


def file_mapping_coverage(raw: DataFrame, schemas: DataFrame, mappings: DataFrame) -> DataFrame:
    """Per (file, target table): columns mapped and unmapped, percent, status, column lists.

    Only hits are joined and grouped; a file is then listed once per table, with its
    hits there, if any.
    """
    columns = file_columns(raw)
    hits = column_hits(columns, mappings).groupBy("file_name", "target_table").agg(
        F.array_sort(F.collect_set("source_column")).alias("mapped"),
        F.array_sort(F.collect_set("target_column")).alias("targets"),
    )
    files = columns.groupBy("file_name").agg(
        F.array_sort(F.collect_set("source_column")).alias("all_source_columns"))
    none = F.array().cast("array<string>")
    stats = fields_by_table(files, schemas).join(hits, ["file_name", "target_table"], "left").select(
        "file_name", "target_table", "all_source_columns",
        F.coalesce("mapped", none).alias("mapped_column_list"),
        F.coalesce("targets", none).alias("target_column_list"),
    )
    counted = stats.select(
        "*", F.size("all_source_columns").cast("long").alias("total_source_columns"),
        F.size("mapped_column_list").cast("long").alias("mapped_columns"),
    ).withColumn("unmapped_columns", F.col("total_source_columns") - F.col("mapped_columns"))
    percent = F.round(F.col("mapped_columns") * 100.0 / F.col("total_source_columns"), 2)
    return counted.select(
        "file_name", "target_table", "total_source_columns", "mapped_columns", "unmapped_columns",
        percent.alias("mapping_coverage_pct"),
        F.when(percent >= 80, "Good").when(percent >= 50, "Fair").otherwise("Poor").alias("coverage_status"),
        "all_source_columns", "mapped_column_list", "target_column_list",
    )


def coverage_summary(raw: DataFrame, schemas: DataFrame, mappings: DataFrame) -> DataFrame:
    """Number of (file, target table) pairs, mean coverage, good and poor ones.

    Equals a summary of ``file_mapping_coverage`` without listing its pairs: those
    with a hit are counted, all others have no coverage and are poor.
    """
    columns = file_columns(raw)
    tables = schemas.filter("active").select(F.col("table_name").alias("target_table")).distinct()
    files = columns.groupBy("file_name").agg(F.count_distinct("source_column").alias("total"))
    hits = (
        column_hits(columns, mappings).join(tables, "target_table", "left_semi")
        .groupBy("file_name", "target_table").agg(F.count_distinct("source_column").alias("mapped"))
        .join(files, "file_name")
        .select(F.round(F.col("mapped") * 100.0 / F.col("total"), 2).alias("percent"))
    )
    facts = hits.agg(
        F.count(F.lit(1)).alias("hits"), F.sum("percent").alias("percents"),
        F.count_if(F.col("percent") >= 80).alias("good_files"), F.count_if(F.col("percent") < 50).alias("poor"),
    )
    count = lambda rows: rows.agg(F.count(F.lit(1))).scalar()
    return facts.withColumn("files", count(files) * count(tables)).select(
        "files",
        F.when(F.col("files") > 0, F.coalesce("percents", F.lit(0.0)) / F.col("files")).alias("avg_coverage_pct"),
        "good_files",
        (F.col("poor") + F.col("files") - F.col("hits")).alias("poor_files"),
    )


def unmapped_source_columns(coverage: DataFrame) -> DataFrame:
    return coverage.select(
        "file_name", "target_table",
        F.array_except("all_source_columns", "mapped_column_list").alias("unmapped_column_list"),
    )


def target_field_status(schemas: DataFrame, mappings: DataFrame) -> DataFrame:
    """Per active target column: globally mapped or not, and the providers mapping it."""
    slot = ["table_name", "column_name"]
    fields = schemas.filter("active").select(*slot).distinct()
    mapped = mappings.filter("approved").select(
        F.col("target_table").alias("table_name"), F.col("target_column").alias("column_name"), "tpa"
    ).distinct()
    facts = mapped.groupBy(*slot).agg(
        F.max(F.col("tpa").isNull()).alias("is_global"),
        F.array_sort(F.collect_set("tpa")).alias("mapped_for_tpas"),
    )
    return fields.join(facts, slot, "left").select(
        *slot,
        F.when(F.col("is_global"), "Mapped (Global)").otherwise("Unmapped").alias("mapping_status"),
        F.coalesce("mapped_for_tpas", F.array().cast("array<string>")).alias("mapped_for_tpas"),
    )


def unmapped_target_fields(schemas: DataFrame, mappings: DataFrame) -> DataFrame:
    """Active target columns without any mapping."""
    mapped = mappings.select(
        F.col("target_table").alias("table_name"), F.col("target_column").alias("column_name")
    ).distinct()
    return (
        schemas.filter("active")
        .join(mapped, ["table_name", "column_name"], "left_anti")
        .select("table_name", "column_name", "description")
    )
