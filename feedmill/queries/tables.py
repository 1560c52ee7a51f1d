"""The engine's tables, derived from the given parquet tables.

Every stand-in exists twice: as a DataFrame for the engine and as SQL text for
the check. They grow with the given tables.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-31 12:00:00"
# Moves rounding ties the same way in both engines, whatever the order of a sum.
TIE = 1e-9


def as_of(text: str = AS_OF):
    return F.lit(text).cast("timestamp_ntz")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@dataclass
class Query:
    """One registered query: the engine's answer and, if SQL can say it, the check."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def sql(tables: str, body: str) -> str:
    """SQL text over the named stand-ins."""
    names = []
    for name in tables.split():
        for needed in [*_NEEDS.get(name, []), name]:
            if needed not in names:
                names.append(needed)
    ctes = ",\n".join(f"{n} AS ({SQL[n].strip()})" for n in names)
    body = re.sub(r"\bround\(((?:(?!\bround\().)*?), 4\)", rf"round(\1 + {TIE}, 4)", body.strip(), flags=re.S)
    return f"WITH {ctes}\n{body}" if ctes else body


_NEEDS = {"master": ["raw"], "listing": ["raw"], "watermarks": ["raw"]}

# -- raw rows ------------------------------------------------------------------

_RAW_FIELDS = "raw_id, tpa, file_name, file_row_number, load_timestamp, stage_name, file_size, file_last_modified"


def raw(spark, d, with_data: bool = True) -> DataFrame:
    """Bronze rows from events: one provider per event type, one file per user and type.

    Objects differ by provider: error rows have no ``value``, signup rows spell
    ``USER_ID``, and a value above 400 is a JSON null.
    """
    e = load(spark, d, "events")
    text = lambda c: F.col(c).cast("string")
    k = F.get_json_object("props", "$.k")
    value = F.when(F.col("value") <= 400, text("value"))
    common = [text("event_id").alias("event_id"), k.alias("k")]
    user, amount = text("user_id"), value.alias("value")
    entries = (
        F.when(F.col("event_type") == "error", F.to_variant_object(F.struct(*common, user.alias("user_id"))))
        .when(F.col("event_type") == "signup", F.to_variant_object(F.struct(*common, user.alias("USER_ID"), amount)))
        .otherwise(F.to_variant_object(F.struct(*common, user.alias("user_id"), amount)))
    )
    columns = [
        F.col("event_id").alias("raw_id"),
        F.col("event_type").alias("tpa"),
        F.concat("event_type", F.lit("/"), text("user_id"), F.lit(".csv")).alias("file_name"),
        (F.col("event_id") + 2).alias("file_row_number"),
        F.col("ts").alias("load_timestamp"),
        F.lit("SRC").alias("stage_name"),
        (F.lit(1000) + F.pmod("user_id", F.lit(20)) * 100).alias("file_size"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("file_last_modified"),
        F.col("user_id"), F.col("value"),
    ]
    if with_data:
        columns.append(stored_object(entries))
    return e.select(*columns)


def stored_object(entries):
    """The object of a row, computed once per row as if it were read from a table.

    The generator keeps the optimizer from copying the construction into every
    expression over the object.
    """
    return F.explode(F.array(entries)).alias("raw_data")


def master(spark, d) -> DataFrame:
    """Providers: every event type but ``error``, plus regions as unused ones."""
    used = load(spark, d, "events").select(F.col("event_type").alias("tpa_code")).distinct()
    unused = load(spark, d, "region").select(F.concat(F.lit("unused_"), F.lower("r_name")).alias("tpa_code"))
    return used.filter("tpa_code <> 'error'").unionByName(unused).select(
        "tpa_code",
        F.concat(F.upper(F.substring("tpa_code", 1, 1)), F.expr("substring(tpa_code, 2)")).alias("tpa_name"), (F.col("tpa_code") != "signup").alias("active")
    )


def queue(spark, d) -> DataFrame:
    o = load(spark, d, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    kinds = F.array(*[F.lit(t) for t in ("click", "signup", "view", "purchase", "error")])
    status = (
        F.when(F.col("o_orderstatus") == "F", "SUCCESS")
        .when(F.col("o_orderstatus") == "O", "FAILED")
        .when(cust % 2 == 0, "PENDING").otherwise("PROCESSING")
    )
    result = (
        F.when(F.col("status") == "SUCCESS", F.concat(
            F.lit("SUCCESS: Processed "), F.col("n"), F.lit(" rows, Inserted "), F.col("n"), F.lit(", Skipped 0")))
        .when(F.col("status") == "FAILED", F.concat(F.lit("FAILURE: bad line "), F.col("n")))
    )
    return o.select(
        key.alias("queue_id"),
        F.concat(F.element_at(kinds, (key % 5 + 1).cast("int")), F.lit("/"),
                 F.floor(key / 5).cast("string"), F.lit(".csv")).alias("file_name"),
        F.when(key % 3 == 0, "EXCEL").otherwise("CSV").alias("file_type"),
        status.alias("status"),
        cust.cast("string").alias("n"), cust, key, F.col("o_orderdate").alias("discovered_timestamp"),
    ).withColumn("process_result", result).select(
        "queue_id", "file_name", "file_type", "status", "process_result", "discovered_timestamp",
        F.when(F.col("status") != "PENDING",
               F.expr("discovered_timestamp + make_interval(0, 0, 0, 0, 0, 0, o_custkey)")).alias("processed_timestamp"),
        F.when((F.col("status") == "SUCCESS") & (F.col("queue_id") % 2 == 0),
               F.col("discovered_timestamp") + F.expr("INTERVAL 1 DAY")).alias("moved_timestamp"),
        F.when(F.col("status") == "FAILED", F.col("process_result")).alias("error_message"),
    )


def listing(spark, d) -> DataFrame:
    """Directory listing: one entry per raw file."""
    return raw(spark, d, False).groupBy(F.col("file_name").alias("path")).agg(
        (F.count(F.lit(1)) * 100).alias("size"), F.max("load_timestamp").alias("last_modified")
    )


def schemas(spark, d) -> DataFrame:
    p = load(spark, d, "part")
    kinds = F.array(*[F.lit(t) for t in ("VARCHAR(100)", "NUMBER(15,2)", "DATE", "BOOLEAN", "BLOB")])
    return p.select(
        (F.col("p_partkey") + 1).alias("schema_id"),
        F.upper(F.replace("p_brand", F.lit("#"), F.lit("_"))).alias("table_name"),
        F.concat(F.upper(F.replace("p_name", F.lit(" "), F.lit("_"))),
                 F.when(F.col("p_size") == 7, "_X").otherwise("")).alias("column_name"),
        F.lower("p_type").alias("tpa"),
        F.when(F.col("p_size") == 50, "BLOB").otherwise(
            F.element_at(kinds, (F.col("p_size") % 4 + 1).cast("int"))).alias("data_type"),
        (F.col("p_size") > 10).alias("nullable"),
        F.when(F.col("p_size") % 5 == 0, "0").alias("default_value"),
        F.concat(F.lit("About "), F.col("p_name")).alias("description"),
        F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_interval(0, 0, 0, p_size)").alias("created_timestamp"),
        (F.col("p_partkey") % 7 != 0).alias("active"),
    )


def mappings(spark, d) -> DataFrame:
    p = load(spark, d, "part")
    methods = F.array(*[F.lit(m) for m in ("MANUAL", "ML_AUTO", "LLM_CORTEX", "SYSTEM", "GUESS")])
    return p.select(
        (F.col("p_partkey") + 1).alias("mapping_id"),
        F.concat(F.upper(F.split("p_name", " ")[0]), F.lit("_"), F.col("p_partkey") % 9).alias("source_field"),
        F.lit("RAW_DATA_TABLE").alias("source_table"),
        F.upper(F.replace("p_brand", F.lit("#"), F.lit("_"))).alias("target_table"),
        F.upper(F.replace("p_name", F.lit(" "), F.lit("_"))).alias("target_column"),
        F.when(F.col("p_size") % 4 != 0, F.lower("p_type")).alias("tpa"),
        F.element_at(methods, (F.col("p_partkey") % 5 + 1).cast("int")).alias("mapping_method"),
        (F.col("p_size") / 64.0).alias("confidence_score"),
        F.concat(F.lit("UPPER(TRIM(source_value)) -- "), F.col("p_size")).alias("transformation_logic"),
        (F.col("p_partkey") % 3 != 0).alias("approved"),
        F.lit(None).cast("string").alias("approved_by"),
        F.lit(None).cast("timestamp_ntz").alias("approved_timestamp"),
        F.concat(F.lit("About "), F.col("p_name")).alias("description"),
    )


def rules(spark, d) -> DataFrame:
    c = load(spark, d, "customer")
    key = F.col("c_custkey")
    types = F.array(*[F.lit(t) for t in ("DATA_QUALITY", "BUSINESS_LOGIC", "STANDARDIZATION", "DEDUPLICATION")])
    actions = F.array(*[F.lit(t) for t in ("LOG", "REJECT", "QUARANTINE")])
    return c.select(
        F.concat(F.lit("R"), key).alias("rule_id"),
        F.concat(F.lit("Rule "), key).alias("rule_name"),
        F.element_at(types, (key % 4 + 1).cast("int")).alias("rule_type"),
        F.concat(F.lit("T"), F.col("c_nationkey")).alias("target_table"),
        F.col("c_mktsegment").alias("target_column"),
        F.when(F.col("c_nationkey") % 3 != 0, F.concat(F.lit("tpa_"), F.col("c_nationkey") % 5)).alias("tpa"),
        F.concat(F.lit("> "), F.repeat(F.lit("9"), (key % 17).cast("int"))).alias("rule_logic"),
        (key % 10 * 10).alias("priority"),
        F.element_at(actions, (key % 3 + 1).cast("int")).alias("error_action"),
        (F.col("c_acctbal") > 0).alias("active"),
        F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, c_custkey)").alias("created_timestamp"),
    )


def log(spark, d) -> DataFrame:
    o = load(spark, d, "orders")
    cust = F.col("o_custkey")
    return o.select(
        F.concat(F.lit("BATCH_"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("batch_id"),
        F.lit("RAW_DATA_TABLE").alias("source_table"),
        F.concat(F.lit("T"), F.substring("o_orderpriority", 1, 1)).alias("target_table"),
        F.when(F.col("o_orderstatus") == "F", "SUCCESS").when(F.col("o_orderstatus") == "O", "FAILED")
        .otherwise("PROCESSING").alias("status"),
        F.col("o_orderdate").alias("start_timestamp"),
        F.when(F.col("o_orderstatus") != "P",
               F.expr("o_orderdate + make_interval(0, 0, 0, 0, 0, 0, o_custkey % 600)")).alias("end_timestamp"),
        (cust * 10).alias("records_read"), (cust * 9).alias("records_processed"),
        cust.alias("records_rejected"), (cust % 20).alias("rules_applied"),
        F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("error "), cust)).alias("error_message"),
    )


def metrics(spark, d) -> DataFrame:
    e = load(spark, d, "events")
    user = F.col("user_id")
    return e.select(
        F.col("event_id").alias("metric_id"),
        F.concat(F.lit("BATCH_"), user).alias("batch_id"),
        F.concat(F.lit("T"), user % 7).alias("table_name"),
        F.concat(F.lit("C"), user % 11).alias("column_name"),
        F.upper("event_type").alias("metric_type"),
        F.col("value").alias("metric_value"),
        F.lit(100.0).alias("threshold_value"),
        F.when(F.col("value") <= 300, "PASS").when(F.col("value") <= 450, "WARNING").otherwise("FAIL").alias("pass_fail"),
        F.concat(F.lit("R"), user).alias("rule_id"),
        F.col("ts").alias("measurement_timestamp"),
    )


def quarantine(spark, d) -> DataFrame:
    li = load(spark, d, "lineitem")
    rule = lambda c: F.concat(F.lit("R"), F.col(c) % 30)
    return li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("quarantine_id"),
        F.concat(F.lit("BATCH_"), F.col("l_orderkey")).alias("batch_id"),
        F.concat(F.lit("T"), F.col("l_suppkey") % 7).alias("target_table"),
        F.when(F.col("l_discount") > 0.05, F.array(rule("l_partkey"), rule("l_suppkey")))
        .otherwise(F.array(rule("l_partkey"))).alias("failed_rules"),
        (F.col("l_linestatus") == "F").alias("resolved"),
        F.col("l_shipdate").alias("quarantine_timestamp"),
    )


def watermarks(spark, d) -> DataFrame:
    r = raw(spark, d, False).groupBy("user_id").agg(
        F.max("raw_id").alias("last_processed_id"), F.max("load_timestamp").alias("seen"),
        F.count(F.lit(1)).alias("records_processed"),
    )
    return r.select(
        F.concat(F.lit("RAW_TO_U"), F.col("user_id")).alias("watermark_id"),
        F.lit("RAW_DATA_TABLE").alias("source_table"),
        F.concat(F.lit("U"), F.col("user_id")).alias("target_table"),
        "last_processed_id", "records_processed",
        F.when(F.col("user_id") % 10 != 0, F.col("seen")).alias("updated_timestamp"),
    )


def claims(spark, d) -> DataFrame:
    """Typed claim rows from orders: ten per member on average, some values missing or wrong."""
    o = load(spark, d, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        key.alias("raw_id"),
        F.concat(F.lit("CLM"), F.lpad(cust.cast("string"), 8, "0")).alias("claim_num"),
        F.when(key % 11 != 0, F.concat(F.lit("first"), cust % 50)).alias("first_name"),
        F.concat(F.lit("Last"), cust % 70).alias("last_name"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("plan_type"),
        (F.col("o_totalprice") - F.when(key % 13 == 0, 400000).otherwise(0)).alias("billed"),
        F.when(key % 17 != 0, F.col("o_totalprice") - F.lit(100.0)).alias("allowed"),
        F.to_date("o_orderdate").alias("service_date"),
        F.when(key % 19 != 0, F.expr("CAST(date_add(to_date(o_orderdate), CAST(o_custkey % 45 AS INT)) AS DATE)"))
        .alias("paid_date"),
        F.concat(F.lpad((cust * 7919 % 1000000000).cast("string"), 9, "1"),
                 F.when(key % 23 == 0, "").otherwise("5")).alias("provider_npi"),
        F.col("o_custkey").alias("member_id"),
    )


SQL = {
    "raw": """
SELECT event_id AS raw_id, event_type AS tpa,
       event_type || '/' || CAST(user_id AS VARCHAR) || '.csv' AS file_name,
       event_id + 2 AS file_row_number, ts AS load_timestamp, 'SRC' AS stage_name,
       1000 + (user_id % 20) * 100 AS file_size,
       CAST(date_trunc('day', ts) AS TIMESTAMP) AS file_last_modified, user_id, value,
       regexp_extract(props, '"k": *([0-9]+)', 1) AS k
FROM events""",
    "master": """
SELECT tpa_code, upper(substr(tpa_code, 1, 1)) || substr(tpa_code, 2) AS tpa_name,
       tpa_code <> 'signup' AS active
FROM (SELECT DISTINCT event_type AS tpa_code FROM events WHERE event_type <> 'error'
      UNION ALL SELECT 'unused_' || lower(r_name) FROM region)""",
    "queue": """
SELECT *, CASE WHEN status = 'FAILED' THEN process_result END AS error_message FROM (
SELECT *, CASE status WHEN 'SUCCESS' THEN 'SUCCESS: Processed ' || n || ' rows, Inserted ' || n || ', Skipped 0'
                   WHEN 'FAILED' THEN 'FAILURE: bad line ' || n END AS process_result,
       CASE WHEN status <> 'PENDING' THEN discovered_timestamp + to_seconds(CAST(n AS BIGINT)) END AS processed_timestamp,
       CASE WHEN status = 'SUCCESS' AND queue_id % 2 = 0 THEN discovered_timestamp + INTERVAL 1 DAY END AS moved_timestamp
FROM (SELECT o_orderkey AS queue_id,
       ['click', 'signup', 'view', 'purchase', 'error'][CAST(o_orderkey % 5 + 1 AS INTEGER)] || '/'
         || CAST(o_orderkey // 5 AS VARCHAR) || '.csv' AS file_name,
       CASE WHEN o_orderkey % 3 = 0 THEN 'EXCEL' ELSE 'CSV' END AS file_type,
       CASE WHEN o_orderstatus = 'F' THEN 'SUCCESS' WHEN o_orderstatus = 'O' THEN 'FAILED'
            WHEN o_custkey % 2 = 0 THEN 'PENDING' ELSE 'PROCESSING' END AS status,
       CAST(o_custkey AS VARCHAR) AS n, o_orderdate AS discovered_timestamp FROM orders))""",
    "listing": """
SELECT file_name AS path, count(*) * 100 AS size, max(load_timestamp) AS last_modified FROM raw GROUP BY file_name""",
    "schemas": """
SELECT p_partkey + 1 AS schema_id, upper(replace(p_brand, '#', '_')) AS table_name,
       upper(replace(p_name, ' ', '_')) || CASE WHEN p_size = 7 THEN '_X' ELSE '' END AS column_name,
       lower(p_type) AS tpa,
       CASE WHEN p_size = 50 THEN 'BLOB' ELSE ['VARCHAR(100)', 'NUMBER(15,2)', 'DATE', 'BOOLEAN'][p_size % 4 + 1] END AS data_type,
       p_size > 10 AS nullable, CASE WHEN p_size % 5 = 0 THEN '0' END AS default_value,
       'About ' || p_name AS description,
       TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(p_size AS INTEGER)) AS created_timestamp,
       p_partkey % 7 <> 0 AS active
FROM part""",
    "mappings": """
SELECT p_partkey + 1 AS mapping_id,
       upper(split_part(p_name, ' ', 1)) || '_' || CAST(p_partkey % 9 AS VARCHAR) AS source_field,
       'RAW_DATA_TABLE' AS source_table, upper(replace(p_brand, '#', '_')) AS target_table,
       upper(replace(p_name, ' ', '_')) AS target_column,
       CASE WHEN p_size % 4 <> 0 THEN lower(p_type) END AS tpa,
       ['MANUAL', 'ML_AUTO', 'LLM_CORTEX', 'SYSTEM', 'GUESS'][CAST(p_partkey % 5 + 1 AS INTEGER)] AS mapping_method,
       CAST(p_size AS DOUBLE) / CAST(64 AS DOUBLE) AS confidence_score,
       'UPPER(TRIM(source_value)) -- ' || CAST(p_size AS VARCHAR) AS transformation_logic,
       p_partkey % 3 <> 0 AS approved, CAST(NULL AS VARCHAR) AS approved_by,
       'About ' || p_name AS description
FROM part""",
    "rules": """
SELECT 'R' || CAST(c_custkey AS VARCHAR) AS rule_id, 'Rule ' || CAST(c_custkey AS VARCHAR) AS rule_name,
       ['DATA_QUALITY', 'BUSINESS_LOGIC', 'STANDARDIZATION', 'DEDUPLICATION'][CAST(c_custkey % 4 + 1 AS INTEGER)] AS rule_type,
       'T' || CAST(c_nationkey AS VARCHAR) AS target_table, c_mktsegment AS target_column,
       CASE WHEN c_nationkey % 3 <> 0 THEN 'tpa_' || CAST(c_nationkey % 5 AS VARCHAR) END AS tpa,
       '> ' || repeat('9', CAST(c_custkey % 17 AS INTEGER)) AS rule_logic, c_custkey % 10 * 10 AS priority,
       ['LOG', 'REJECT', 'QUARANTINE'][CAST(c_custkey % 3 + 1 AS INTEGER)] AS error_action,
       c_acctbal > 0 AS active, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c_custkey) AS created_timestamp
FROM customer""",
    "log": """
SELECT 'BATCH_' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS batch_id, 'RAW_DATA_TABLE' AS source_table,
       'T' || substr(o_orderpriority, 1, 1) AS target_table,
       CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'FAILED' ELSE 'PROCESSING' END AS status,
       o_orderdate AS start_timestamp,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + to_seconds(o_custkey % 600) END AS end_timestamp,
       o_custkey * 10 AS records_read, o_custkey * 9 AS records_processed, o_custkey AS records_rejected,
       o_custkey % 20 AS rules_applied,
       CASE WHEN o_orderstatus = 'O' THEN 'error ' || CAST(o_custkey AS VARCHAR) END AS error_message
FROM orders""",
    "metrics": """
SELECT event_id AS metric_id, 'BATCH_' || CAST(user_id AS VARCHAR) AS batch_id,
       'T' || CAST(user_id % 7 AS VARCHAR) AS table_name, 'C' || CAST(user_id % 11 AS VARCHAR) AS column_name,
       upper(event_type) AS metric_type, value AS metric_value, CAST(100 AS DOUBLE) AS threshold_value,
       CASE WHEN value <= 300 THEN 'PASS' WHEN value <= 450 THEN 'WARNING' ELSE 'FAIL' END AS pass_fail,
       'R' || CAST(user_id AS VARCHAR) AS rule_id, ts AS measurement_timestamp
FROM events""",
    "quarantine": """
SELECT l_orderkey * 8 + l_linenumber AS quarantine_id, 'BATCH_' || CAST(l_orderkey AS VARCHAR) AS batch_id,
       'T' || CAST(l_suppkey % 7 AS VARCHAR) AS target_table,
       CASE WHEN l_discount > CAST(0.05 AS DOUBLE)
            THEN ['R' || CAST(l_partkey % 30 AS VARCHAR), 'R' || CAST(l_suppkey % 30 AS VARCHAR)]
            ELSE ['R' || CAST(l_partkey % 30 AS VARCHAR)] END AS failed_rules,
       l_linestatus = 'F' AS resolved, l_shipdate AS quarantine_timestamp
FROM lineitem""",
    "watermarks": """
SELECT 'RAW_TO_U' || CAST(user_id AS VARCHAR) AS watermark_id, 'RAW_DATA_TABLE' AS source_table,
       'U' || CAST(user_id AS VARCHAR) AS target_table, max(raw_id) AS last_processed_id,
       count(*) AS records_processed,
       CASE WHEN user_id % 10 <> 0 THEN max(load_timestamp) END AS updated_timestamp
FROM raw GROUP BY user_id""",
    "claims": """
SELECT o_orderkey AS raw_id, 'CLM' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS claim_num,
       CASE WHEN o_orderkey % 11 <> 0 THEN 'first' || CAST(o_custkey % 50 AS VARCHAR) END AS first_name,
       'Last' || CAST(o_custkey % 70 AS VARCHAR) AS last_name, o_orderstatus AS status,
       o_orderpriority AS plan_type,
       o_totalprice - CASE WHEN o_orderkey % 13 = 0 THEN 400000 ELSE 0 END AS billed,
       CASE WHEN o_orderkey % 17 <> 0 THEN o_totalprice - CAST(100 AS DOUBLE) END AS allowed,
       CAST(o_orderdate AS DATE) AS service_date,
       CASE WHEN o_orderkey % 19 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_custkey % 45 AS INTEGER) END AS paid_date,
       lpad(CAST(o_custkey * 7919 % 1000000000 AS VARCHAR), 9, '1')
         || CASE WHEN o_orderkey % 23 = 0 THEN '' ELSE '5' END AS provider_npi,
       o_custkey AS member_id
FROM orders""",
}


def with_text_times(df: DataFrame) -> DataFrame:
    """Render every timestamp and date column as text."""
    out = {}
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if kind.startswith("timestamp"):
            out[f.name] = F.date_format(f.name, "yyyy-MM-dd HH:mm:ss")
        elif kind == "date":
            out[f.name] = F.date_format(f.name, "yyyy-MM-dd")
        elif kind.startswith("array<string"):
            out[f.name] = F.array_join(f.name, "|")
        elif kind == "double":
            out[f.name] = F.round(F.col(f.name) + TIE, 4)
    return df.withColumns(out) if out else df
