"""Target tables described as rows: checking, creating, changing and loading them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill import model
from feedmill.functions import dialect
from feedmill.operators import mapping
from feedmill.operators.joins import collect_metadata
from feedmill.operators.merge import delete_where, diff_rows, rows_to_insert, update_where
from feedmill.plans.store import BUCKET, ROW, Store
from feedmill.session import drop_staged, stage

SCHEMA_KEY = ["table_name", "column_name", "tpa"]
MAPPING_KEY = ["source_field", "source_table", "target_table", "target_column", "tpa"]
RULE_KEY = ["rule_id", "tpa"]


# -- metadata upserts ---------------------------------------------------------------

def _with_ids(rows: DataFrame, current: DataFrame, id_column: str) -> DataFrame:
    """Rows numbered in their order, from the highest id on.

    One task numbers them; the joins they come from keep their own tasks.
    """
    last = current.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("n")).first()[0]
    in_order = rows.withColumn("_at", F.monotonically_increasing_id()).repartition(1).sortWithinPartitions("_at")
    return in_order.withColumn(id_column, F.lit(last + 1) + F.monotonically_increasing_id()).drop("_at")


def load_target_schemas(store: Store, rows: DataFrame, as_of: Column) -> None:
    rows = _with_ids(rows, store.snapshot("target_schemas"), "schema_id")
    store.merge(
        "target_schemas", rows, SCHEMA_KEY,
        update=["data_type", "nullable", "default_value", "description"],
        set_values={"updated_timestamp": as_of, "active": F.lit(True)},
        insert_values={"created_timestamp": as_of, "updated_timestamp": as_of, "active": F.lit(True)},
    )


def load_field_mappings(store: Store, rows: DataFrame, as_of: Column) -> None:
    rows = _with_ids(rows, store.snapshot("field_mappings"), "mapping_id")
    store.merge(
        "field_mappings", rows, MAPPING_KEY,
        update=["transformation_logic", "description", "approved", "confidence_score", "mapping_method"],
        set_values={"updated_timestamp": as_of},
        insert_values={"created_timestamp": as_of, "updated_timestamp": as_of},
    )


def store_proposals(store: Store, proposed: DataFrame, as_of: Column) -> int:
    """Add proposed mappings (of names or of a model) to the stored ones; returns how many."""
    fresh = stage(rows_to_insert(proposed, store.snapshot("field_mappings"), MAPPING_KEY), "proposed")
    count = fresh.count()
    if count:
        load_field_mappings(store, fresh, as_of)
    drop_staged(fresh)
    return count


def auto_map(store: Store, tpa: str, as_of: Column, top_n: int = 3, min_confidence: float = 0.6) -> int:
    """Propose unapproved mappings for the raw fields of a provider and store the new ones."""
    fields = mapping.source_fields(store.read("raw_data"), tpa).select(F.col("field_name").alias("source_field"))
    targets = store.snapshot("target_schemas").filter("active").select(
        F.col("table_name").alias("target_table"), F.col("column_name").alias("target_column")).distinct()
    proposed = mapping.propose_mappings(
        fields, targets, store.snapshot("field_mappings"), tpa, top_n=top_n, min_confidence=min_confidence)
    return store_proposals(store, proposed, as_of)


def load_rules(store: Store, rows: DataFrame, as_of: Column) -> None:
    store.merge(
        "transformation_rules", rows, RULE_KEY,
        set_values={"updated_timestamp": as_of},
        insert_values={"created_timestamp": as_of, "updated_timestamp": as_of},
    )


def seed(store: Store, table: str, rows: DataFrame, keys: list[str]) -> None:
    """Insert rows whose key is absent; running it twice changes nothing."""
    current = store.snapshot(table)
    fresh = rows_to_insert(rows, current, keys)
    missing = [c for c in current.columns if c not in fresh.columns]
    for c in missing:
        fresh = fresh.withColumn(c, F.lit(None).cast(current.schema[c].dataType))
    store.replace(table, current.unionByName(fresh.select(*current.columns)))


# -- checks and definitions ------------------------------------------------------------

def validate_schemas(schemas: DataFrame) -> DataFrame:
    """Per table: active columns, bad types, repeated column names and the verdict."""
    active = F.coalesce("active", F.lit(False))
    checked = schemas.groupBy("table_name").agg(
        F.count_if(active).alias("column_count"),
        F.count_if(active & ~F.col("data_type").rlike(model.TYPE_PATTERN)).alias("invalid_types"),
        (F.count_if(active) - F.count_distinct(F.when(active, F.col("column_name")))).alias("duplicate_columns"),
    )
    part = lambda hit, text: F.when(hit, text).otherwise("")
    # The texts users know.
    errors = F.concat(
        part(F.col("column_count") == 0, "No columns defined for table. "),
        part(F.col("invalid_types") > 0, "Invalid data types detected. "),
        part(F.col("duplicate_columns") > 0, "Duplicate column names detected. "),
    )
    return checked.withColumn(
        "message",
        F.when(errors == "", F.concat(F.lit("Validation passed for table: "), "table_name"))
        .otherwise(F.concat(F.lit("Validation FAILED for table: "), "table_name", F.lit(" - Errors: "), errors)),
    )


def clean_type(data_type: Column) -> Column:
    """Declared type with a lost comma restored and AUTOINCREMENT dropped."""
    text = F.trim(F.regexp_replace(F.upper(data_type), r"\s*AUTOINCREMENT", ""))
    return F.regexp_replace(text, r"\(\s*(\d+)\s+(\d+)\s*\)", "($1,$2)")


def table_ddl(schemas: DataFrame) -> DataFrame:
    """CREATE TABLE text per table, columns in schema_id order."""
    line = F.concat(
        F.lit("    "), F.col("column_name"), F.lit(" "), clean_type(F.col("data_type")),
        F.when(~F.col("nullable"), " NOT NULL").otherwise(""),
        F.when(F.coalesce(F.col("default_value"), F.lit("")) != "",
               F.concat(F.lit(" DEFAULT "), F.col("default_value"))).otherwise(""),
        F.when(F.coalesce(F.col("description"), F.lit("")) != "",
               F.concat(F.lit(" COMMENT '"), F.replace("description", F.lit("'"), F.lit("''")), F.lit("'"))).otherwise(""),
    )
    listed = schemas.filter("active").groupBy("table_name").agg(
        F.array_sort(F.collect_list(F.struct("schema_id", line.alias("line")))).alias("lines")
    )
    return listed.select(
        "table_name",
        F.concat(
            F.lit("CREATE TABLE IF NOT EXISTS "), F.col("table_name"), F.lit(" (\n"),
            F.array_join(F.transform("lines", lambda x: x["line"]), ",\n"), F.lit("\n)"),
        ).alias("ddl"),
    )


def spark_schema(store: Store, table: str) -> str:
    """Spark column list of a declared table."""
    rows = collect_metadata(
        store.snapshot("target_schemas").filter(F.col("active") & (F.upper("table_name") == table.upper()))
    )
    rows.sort(key=lambda r: r["schema_id"])
    seen: dict[str, str] = {}
    for r in rows:
        seen.setdefault(r["column_name"], dialect.type_name(r["data_type"]))
    return ", ".join(f"`{c}` {t}" for c, t in seen.items())


# -- table life -------------------------------------------------------------------------

def create_table(store: Store, table: str) -> str:
    verdict = validate_schemas(store.snapshot("target_schemas").filter(F.upper("table_name") == table.upper())).collect()
    if not verdict:
        return f"Validation FAILED for table: {table.upper()} - Errors: No columns defined for table. "
    if not verdict[0]["message"].startswith("Validation passed"):
        return verdict[0]["message"]
    if store.is_created(table):
        return f"Table {table.upper()} already exists"
    try:
        store.create(table, spark_schema(store, table))
    except ValueError as error:
        return f"Error creating table {table.upper()}: {error}"
    return f"Successfully created table: {table.upper()}"


def create_all_tables(store: Store) -> str:
    names = sorted(
        r[0] for r in collect_metadata(store.snapshot("target_schemas").filter("active").select("table_name").distinct())
    )
    done = [create_table(store, n) for n in names]
    failed = [m for m in done if not m.startswith(("Successfully", "Table"))]
    return f"Created {len(done) - len(failed)} table(s), {len(failed)} failed"


def drop_table(store: Store, table: str, metadata_only: bool = False) -> str:
    """Drop data, switch schema rows and rules off, delete mappings; or delete schema rows only."""
    name = table.upper()
    schemas = store.snapshot("target_schemas")
    here = F.upper("table_name") == name
    if metadata_only:
        store.replace("target_schemas", delete_where(schemas, here))
        return f"Deleted schema definition for table: {name}"
    store.drop(table)
    store.replace("target_schemas", update_where(schemas, here, {"active": F.lit(False)}))
    targeted = F.upper("target_table") == name
    store.replace("field_mappings", delete_where(store.snapshot("field_mappings"), targeted))
    store.replace(
        "transformation_rules",
        update_where(store.snapshot("transformation_rules"), targeted, {"active": F.lit(False)}),
    )
    return f"Dropped table: {name}"


def add_column(store: Store, table: str, column: str, data_type: str, tpa: str, as_of: Column,
               nullable: bool = True, default: str | None = None, description: str | None = None) -> str:
    if not tpa:
        raise ValueError("tpa is required")
    row = store.spark.createDataFrame(
        [(table.upper(), column.upper(), tpa, data_type.upper(), nullable, default, description)],
        "table_name string, column_name string, tpa string, data_type string, nullable boolean, "
        "default_value string, description string",
    )
    load_target_schemas(store, row, as_of)
    if store.is_created(table):
        value = F.expr(dialect.to_spark(default)) if default else F.lit(None)
        rows = store.silver(table)
        if column.upper() not in [c.upper() for c in rows.columns]:
            widened = rows.withColumn(column.upper(), value.cast(dialect.type_name(data_type)))
            # only a default is written into the rows that are there
            (store.swap if default else store.reshape)(table, widened)
    return f"Added column {column.upper()} to {table.upper()}"


def alter_column(store: Store, table: str, column: str, as_of: Column, data_type: str | None = None,
                 nullable: bool | None = None, default: str | None = None) -> str:
    values: dict[str, Column] = {"updated_timestamp": as_of}
    if data_type is not None:
        values["data_type"] = F.lit(data_type.upper())
    if nullable is not None:
        values["nullable"] = F.lit(nullable)
    if default is not None:
        values["default_value"] = F.lit(default)
    here = (F.upper("table_name") == table.upper()) & (F.upper("column_name") == column.upper())
    store.replace("target_schemas", update_where(store.snapshot("target_schemas"), here, values))
    if data_type is not None and store.is_created(table):
        rows = store.silver(table)
        store.swap(table, rows.withColumn(column, F.col(column).try_cast(dialect.type_name(data_type))))
    return f"Altered column {column.upper()} of {table.upper()}"


def drop_column(store: Store, table: str, column: str) -> str:
    here = (F.upper("table_name") == table.upper()) & (F.upper("column_name") == column.upper())
    store.replace("target_schemas", update_where(store.snapshot("target_schemas"), here, {"active": F.lit(False)}))
    if store.is_created(table):
        store.swap(table, store.silver(table).drop(column))
    return f"Dropped column {column.upper()} from {table.upper()}"


def sync_table(store: Store, table: str, reset: bool = False) -> str:
    """Bring a table to its declared columns; common columns keep their data unless ``reset``."""
    if not store.is_created(table):
        return create_table(store, table)
    wanted = store.spark.createDataFrame([], spark_schema(store, table)).schema
    old = store.silver(table)
    if reset:
        store.drop(table)
        return create_table(store, table)
    present = {c.upper(): c for c in old.columns}
    rows = old.select(
        *[
            (F.col(present[f.name.upper()]).try_cast(f.dataType) if f.name.upper() in present
             else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in wanted.fields
        ],
        ROW, BUCKET,
    )
    store.swap(table, rows)
    return f"Synchronised table: {table.upper()}"


def schema_edits(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changes between the stored and the edited definition, by schema_id."""
    return diff_rows(
        old, new, "schema_id",
        ["table_name", "column_name", "tpa", "data_type", "nullable", "default_value", "description"],
    )


# -- standard columns -----------------------------------------------------------------------

def standard_columns(schemas: DataFrame, table: str, tpa: str | None = None) -> DataFrame:
    """Standard columns the table lacks; the provider defaults to the table's own."""
    spark = schemas.sparkSession
    here = schemas.filter(F.upper("table_name") == table.upper())
    if tpa is None:
        first = here.select(F.min("tpa").alias("tpa")).first()
        tpa = first["tpa"]
    wanted = spark.createDataFrame(
        [(table.upper(), n, tpa, t, null, default, text) for n, t, null, default, text in model.STANDARD_COLUMNS],
        "table_name string, column_name string, tpa string, data_type string, nullable boolean, "
        "default_value string, description string",
    )
    return rows_to_insert(wanted, here, ["column_name"])


def standard_mappings(mappings: DataFrame, table: str, tpa: str | None) -> DataFrame:
    spark = mappings.sparkSession
    wanted = spark.createDataFrame(
        [(s, "RAW_DATA_TABLE", table.upper(), t, tpa, "SYSTEM", 1.0, True) for s, t in model.STANDARD_MAPPINGS],
        "source_field string, source_table string, target_table string, target_column string, tpa string, "
        "mapping_method string, confidence_score double, approved boolean",
    )
    return rows_to_insert(wanted, mappings, ["target_table", "target_column", "tpa"])


def initialise_table(store: Store, table: str, as_of: Column, tpa: str | None = None) -> str:
    columns = standard_columns(store.snapshot("target_schemas"), table, tpa)
    load_target_schemas(store, columns, as_of)
    load_field_mappings(store, standard_mappings(store.snapshot("field_mappings"), table, tpa), as_of)
    return f"Initialised table: {table.upper()}"


def defined_tables(schemas: DataFrame, existing: DataFrame) -> DataFrame:
    """Declared tables and whether each exists; ``existing`` has table_name."""
    names = existing.select(F.upper("table_name").alias("table_name")).distinct().withColumn("found", F.lit(True))
    return (
        schemas.filter("active").groupBy(F.upper("table_name").alias("table_name"))
        .agg(F.count(F.lit(1)).alias("column_count"))
        .join(names, "table_name", "left")
        .select("table_name", "column_count", F.coalesce("found", F.lit(False)).alias("is_created"))
    )


def catalog_tables(spark) -> DataFrame:
    """Tables and views of the session catalog."""
    return spark.createDataFrame(
        [(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables()],
        "table_name string, table_type string, is_temporary boolean",
    )
