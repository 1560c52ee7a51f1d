"""Registered queries: sources, sinks, table life, jobs and streams.

Files and state tables are written below the shared scratch folder from the
given tables, so their size follows the data.
"""

from __future__ import annotations

import datetime
import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill import session
from feedmill.functions import paths
from feedmill.functions.dates import ntz
from feedmill.functions.dialect import type_name
from feedmill.operators import limits, quality
from feedmill.operators.dedup import keep_last
from feedmill.operators.merge import apply_changes, delete_where, merge_rows, rows_to_insert, update_where
from feedmill.operators.rules import active_rules
from feedmill.plans import bronze, schema_admin as A, silver, views
from feedmill.plans.store import BUCKET, ROW, Store
from feedmill.queries import tables as T
from feedmill.queries.quality import LIMITS, rule_frame, verdict_sql
from feedmill.queries.tables import Query, as_of, sql
from feedmill.sources import config_files, listing as L, tabular
from feedmill.streaming import ingest

NOW_TEXT = "2024-01-31 12:00:00"
NOW = datetime.datetime(2024, 1, 31, 12)
TS = "'%Y-%m-%d %H:%M:%S'"

_landings: dict[tuple[str, str], str] = {}


def landing(s, d) -> str:
    """CSV files written from the events, one per day and type, rows in event order."""
    key = (s.sparkContext.applicationId, d)
    if key not in _landings:
        path = session.scratch_path(s, "landing")
        e = T.load(s, d, "events")
        rows = e.select(
            F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("event_type").alias("tpa"),
            F.col("event_id").cast("string").alias("EVENT_ID"), F.col("user_id").cast("string").alias("User Id"),
            F.col("value").cast("string").alias("AMT"),
            F.when(F.col("value") < 100, F.lit("NA")).when(F.col("value") < 200, F.lit('say "hi", twice\nor more'))
            .alias("NOTE"),
        )
        (
            rows.repartition("day", "tpa").sortWithinPartitions("day", "tpa", F.col("EVENT_ID").cast("bigint"))
            .write.partitionBy("day", "tpa").options(header=True, escape='"', quote='"').csv(path)
        )
        _landings[key] = path
    return _landings[key]


def csv_files(s, d) -> list[str]:
    return [r.file_name for r in L.list_files(s, landing(s, d)).filter(
        F.col("file_name").endswith(".csv")).select("file_name").collect()]


_CELLS_SQL = """SELECT 'tpa=' || event_type AS tpa, strftime(ts, '%Y-%m-%d') AS day,
    row_number() OVER (PARTITION BY event_type, strftime(ts, '%Y-%m-%d') ORDER BY event_id) + 1 AS file_row_number,
    CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, CAST(value AS VARCHAR) AS amt,
    CASE WHEN value >= 100 AND value < 200 THEN 'say "hi", twice' || chr(10) || 'or more' END AS note FROM events"""


def _csv_rows(s, d) -> DataFrame:
    cells = tabular.csv_cells(tabular.csv_parts(s, landing(s, d), csv_files(s, d)), landing(s, d)).filter("row_no > 1")
    clean = F.transform("cells", lambda c: F.when(~c.isin(tabular.NULL_TOKENS), c))
    return cells.select(
        paths.provider(F.col("file_name")).alias("tpa"),
        F.regexp_extract("file_name", "day=([^/]+)/", 1).alias("day"), F.col("row_no").alias("file_row_number"),
        clean[0].alias("event_id"), clean[1].alias("user_id"), clean[2].alias("amt"), clean[3].alias("note"),
        "file_name")


_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PKG = "http://schemas.openxmlformats.org/package/2006/relationships"


def _workbook(group: pd.DataFrame) -> pd.DataFrame:
    """One .xlsx per group, for the Excel reader to read back."""
    rows = "".join(
        f'<row r="{i}"><c r="A{i}"><v>{e}</v></c><c r="B{i}" t="inlineStr"><is><t>{u}</t></is></c></row>'
        for i, (e, u) in enumerate(zip(group.sort_values("event_id")["event_id"], group.sort_values("event_id")["event_type"]), 2)
    )
    head = '<row r="1"><c r="A1" t="inlineStr"><is><t>EVENT_ID</t></is></c><c r="B1" t="inlineStr"><is><t>KIND</t></is></c></row>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets><sheet name="a" sheetId="1" r:id="r1"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PKG}"><Relationship Id="r1" Type="t" Target="worksheets/sheet1.xml"/></Relationships>')
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{_MAIN}"><sheetData>{head}{rows}</sheetData></worksheet>')
    return pd.DataFrame({"file_name": [f"{group['hour'].iloc[0]}.xlsx"], "content": [out.getvalue()]})


def _excel_rows(s, d) -> DataFrame:
    e = T.load(s, d, "events").select("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd_HH").alias("hour"))
    books = e.groupBy("hour").applyInPandas(_workbook, "file_name string, content binary")
    cells = tabular.workbook_cells(books).filter("row_no > 1")
    return cells.select("file_name", "row_no", F.col("cells")[0].alias("event_id"), F.col("cells")[1].alias("kind"))


def _pages(s, d) -> DataFrame:
    return T.load(s, d, "pages").select(
        "page_id", F.col("url").alias("file_name"), (F.length("html").cast("bigint") * 40000).alias("size"))


def _config_csv(s, rows: DataFrame, label: str) -> str:
    path = session.scratch_path(s, label)
    rows.write.options(header=True, escape='"', quote='"').csv(path)
    return path


def _config_schemas(s, d):
    rows = T.schemas(s, d).select(
        F.lower("table_name").alias("table_name"), "column_name", "tpa", "data_type",
        F.when(F.col("nullable"), "yes").otherwise("FALSE").alias("nullable"), "default_value", "description")
    return config_files.target_schemas(s, _config_csv(s, rows, "schemas")).select(
        "table_name", "column_name", "tpa", "data_type", "nullable", "default_value", "description", "active")


def _config_mappings(s, d):
    rows = T.mappings(s, d).select(
        "source_field", F.lower("target_table").alias("target_table"), "target_column",
        F.when(F.col("mapping_id") % 2 == 0, "TO_DATE(source_value 'MM-DD-YYYY')")
        .otherwise("CAST(source_value AS NUMBER(10 2))").alias("transformation_logic"),
        F.lower("mapping_method").alias("mapping_method"), F.col("confidence_score").cast("string").alias("confidence_score"),
        F.when(F.col("approved"), "1").otherwise("no").alias("approved"), F.col("description").alias("notes"), "tpa")
    return config_files.field_mappings(s, _config_csv(s, rows, "mappings")).select(
        "source_field", "source_table", "target_table", "target_column", "tpa", "mapping_method", "confidence_score",
        "transformation_logic", "approved")


def _config_rules(s, d):
    rows = T.rules(s, d).select(
        "rule_id", "rule_name", F.lower("rule_type").alias("rule_type"), "target_table", F.lower("target_column").alias("target_column"),
        "rule_logic", F.when(F.col("priority") > 50, '{"strategy": "KEEP_LAST"}').otherwise("not json").alias("rule_parameters"),
        F.when(F.col("priority") % 20 == 0, "soon").otherwise(F.col("priority").cast("string")).alias("priority"),
        F.when(F.col("error_action") != "LOG", F.lower("error_action")).alias("error_action"),
        F.lit("a, b").alias("description"), F.when(F.col("active"), "TRUE").otherwise("").alias("active"), "tpa")
    return config_files.transformation_rules(s, _config_csv(s, rows, "rules")).select(
        "rule_id", "rule_type", "target_column", "tpa", "rule_logic", "rule_parameters", "priority", "error_action",
        "description", "active")


def _config_metrics(s, d):
    rows = T.load(s, d, "part").select(
        F.concat(F.lit("Completeness - "), F.col("p_partkey")).alias("metric_name"), F.lower("p_brand").alias("target_table"),
        F.lit("name").alias("target_column"), F.lit("completeness").alias("metric_type"), F.col("p_size").alias("threshold_value"),
        F.lit(">=").alias("threshold_operator"),
        F.lit("SELECT COUNT(*) FROM T WHERE DATEDIFF('day' A B) <= 30").alias("measurement_query"),
        F.lit("TRUE").alias("enabled"), F.when(F.col("p_size") > 9, "TRUE").otherwise("FALSE").alias("alert_on_failure"),
        F.lit("x").alias("description"))
    out = config_files.metric_definitions(s, _config_csv(s, rows, "metrics"))
    return out.select("metric_name", "target_table", "threshold_value", "threshold_operator", "enabled", "alert_on_failure")


# metric name -> measurement text; the export lost the commas of some
MEASUREMENTS = {
    "Completeness - First Name": "SELECT (COUNT(FIRST_NAME) * 100.0 / COUNT(*)) FROM CLAIMS",
    "Validity - NPI": "SELECT (COUNT(*) * 100.0 / (SELECT COUNT(*) FROM CLAIMS WHERE PROVIDER_NPI IS NOT NULL)) FROM CLAIMS WHERE LENGTH(PROVIDER_NPI) = 10",
    "Consistency - Dates": "SELECT (COUNT(*) * 100.0 / (SELECT COUNT(*) FROM CLAIMS WHERE PAID_DATE IS NOT NULL)) FROM CLAIMS WHERE SERVICE_DATE <= PAID_DATE",
    "Uniqueness - Claim": "SELECT (COUNT(DISTINCT CLAIM_NUM) * 100.0 / COUNT(*)) FROM CLAIMS",
    "Timeliness - 30 days": "SELECT (COUNT(*) * 100.0 / (SELECT COUNT(*) FROM CLAIMS WHERE PAID_DATE IS NOT NULL)) FROM CLAIMS WHERE DATEDIFF('day' SERVICE_DATE PAID_DATE) <= 30",
    "Accuracy - Status": "SELECT (COUNT(*) * 100.0 / (SELECT COUNT(*) FROM CLAIMS WHERE STATUS IS NOT NULL)) FROM CLAIMS WHERE STATUS IN ('F' 'O')",
    "Coverage - Recent": "SELECT CASE WHEN COUNT(*) > 0 THEN 100.0 ELSE 0.0 END FROM CLAIMS WHERE SERVICE_DATE >= DATEADD('day' -90 '1998-12-01')",
    "Duplicate Rate - Claim": "SELECT ((COUNT(*) - COUNT(DISTINCT CLAIM_NUM)) * 100.0 / COUNT(*)) FROM CLAIMS",
    "Outlier - Billed": "SELECT (COUNT(*) * 100.0 / (SELECT COUNT(*) FROM CLAIMS)) FROM CLAIMS WHERE BILLED > (SELECT AVG(BILLED) + (3 * STDDEV(BILLED)) FROM CLAIMS)",
    "Share of none": "SELECT (COUNT(*) * 100.0 / (SELECT COUNT(*) FROM CLAIMS WHERE CLAIM_NUM IS NULL)) FROM CLAIMS",
    "Malformed": "SELECT COUNT( FROM CLAIMS",
}


def _measured_definitions(s, d):
    known = {name: (limit, op, alert) for name, limit, op, alert in LIMITS}
    rows = s.createDataFrame(
        [(n, "claims", "x", "kind", str(known.get(n, (1.0,))[0]), known.get(n, (0, ">="))[1], q, "TRUE",
          str(known.get(n, (0, 0, True))[2]).upper(), "d") for n, q in MEASUREMENTS.items()],
        "metric_name string, target_table string, target_column string, metric_type string, threshold_value string, "
        "threshold_operator string, measurement_query string, enabled string, alert_on_failure string, description string")
    definitions = config_files.metric_definitions(s, _config_csv(s, rows, "metrics"))
    return quality.run_definitions(definitions, {"CLAIMS": T.claims(s, d)}).select(
        "metric_name", F.round(F.col("metric_value") + T.TIE, 4).alias("metric_value"), "threshold_value", "threshold_operator",
        "pass_fail", "alert")


def _measured_definitions_sql() -> str:
    names = ", ".join(f"'{n}'" for n in MEASUREMENTS)
    return f"""SELECT * FROM ({verdict_sql()}) WHERE metric_name IN ({names})
        UNION ALL SELECT 'Share of none', NULL, 1.0, '>=', 'FAIL', true UNION ALL SELECT 'Malformed', NULL, 1.0, '>=', 'ERROR', true"""


def _config_prompts(s, d):
    rows = T.load(s, d, "benchmark").select(
        F.concat(F.lit("Prompt no "), F.col("item_id")).alias("prompt_name"),
        F.concat(F.lit('Say "'), "text", F.lit('"\nthen {source_fields}')).alias("prompt_template"),
        F.lit("m1").alias("model_preference"), F.lit("TRUE").alias("enabled"), F.lit("d").alias("description"))
    return config_files.prompt_templates(s, _config_csv(s, rows, "prompts")).select(
        "template_id", F.md5("template_text").alias("text_hash"), "active")


def _row_objects(s, d):
    c = T.load(s, d, "customer")
    names = F.array(F.lit("name"), F.lit("segment"), F.lit("nation"))
    cells = F.array("c_name", F.when(F.col("c_nationkey") > 5, F.col("c_mktsegment")).otherwise("N/A"),
                    F.col("c_nationkey").cast("string"))
    return c.select("c_custkey", F.to_json(F.parse_json(tabular.row_json(names, cells))).alias("raw_data"))


def _catalog(s, d):
    for name in ("orders", "lineitem"):
        T.load(s, d, name).createOrReplaceTempView(f"feedmill_{name}")
    known = A.catalog_tables(s).filter(F.col("table_name").startswith("feedmill_"))
    counts = [s.table(f"feedmill_{n}").groupBy().agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(f"feedmill_{n}").alias("table_name"), "n") for n in ("orders", "lineitem")]
    return known.join(counts[0].unionByName(counts[1]), "table_name", "left").select("table_name", "is_temporary", "n")


SOURCES = {
    "src_01_directory_scan": Query(
        lambda s, d: L.list_files(s, landing(s, d)).filter(F.col("file_name").endswith(".csv")).groupBy(
            paths.provider(F.col("file_name")).alias("folder")).agg(
            F.count(F.lit(1)).alias("files"), (F.min("size") > 0).alias("sized"), (F.count("last_modified") == F.count(F.lit(1))).alias("dated")),
        """SELECT 'tpa=' || event_type AS folder, count(DISTINCT strftime(ts, '%Y-%m-%d')) AS files, true AS sized, true AS dated
           FROM events GROUP BY event_type"""),
    "src_02_admission": Query(
        lambda s, d: L.admissible(_pages(s, d).withColumn(
            "file_name", F.when(F.col("page_id") % 3 != 0, F.concat("file_name", F.lit(".CSV"))).otherwise(F.col("file_name")))).select(
            "page_id", F.col("rejection_reason").startswith("Invalid").alias("bad_type"),
            F.col("rejection_reason").startswith("File too").alias("too_big")),
        """SELECT page_id, CASE WHEN page_id % 3 = 0 THEN true WHEN length(html) * 40000 > 104857600 THEN false END AS bad_type,
           CASE WHEN page_id % 3 = 0 THEN false WHEN length(html) * 40000 > 104857600 THEN true END AS too_big FROM pages"""),
    "src_03_new_files": Query(
        lambda s, d: L.new_files(T.listing(s, d).withColumnRenamed("path", "file_name"), T.queue(s, d)).select("file_name", "size"),
        sql("listing queue", """SELECT path AS file_name, size FROM listing l WHERE NOT EXISTS (SELECT 1 FROM queue q
            WHERE q.file_name = l.path AND status IN ('PENDING', 'PROCESSING', 'SUCCESS'))""")),
    "src_04_routing": Query(
        lambda s, d: T.load(s, d, "orders").select(
            "o_orderkey", paths.file_type(F.concat(F.lit("p/f"), F.col("o_orderkey"), F.element_at(
                F.array(F.lit(".csv"), F.lit(".XLSX"), F.lit(".xls"), F.lit(".txt")), (F.col("o_orderkey") % 4 + 1).cast("int")))).alias("file_type")),
        """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'CSV' WHEN 1 THEN 'EXCEL' WHEN 2 THEN 'EXCEL' END AS file_type FROM orders"""),
    "src_05_csv_scan": Query(lambda s, d: _csv_rows(s, d).drop("file_name"), _CELLS_SQL),
    "src_06_excel_scan": Query(
        _excel_rows,
        """SELECT strftime(ts, '%Y-%m-%d_%H') || '.xlsx' AS file_name,
           row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d_%H') ORDER BY event_id) + 1 AS row_no,
           CAST(event_id AS VARCHAR) AS event_id, event_type AS kind FROM events"""),
    "src_07_row_objects": Query(
        _row_objects,
        """SELECT c_custkey, '{"name":"' || c_name || '","nation":"' || CAST(c_nationkey AS VARCHAR) || '","segment":'
           || CASE WHEN c_nationkey > 5 THEN '"' || c_mktsegment || '"' ELSE 'null' END || '}' AS raw_data FROM customer"""),
    "src_08_row_numbers": Query(
        lambda s, d: _csv_rows(s, d).groupBy("tpa", "day").agg(
            F.min("file_row_number").alias("first"), F.max("file_row_number").alias("last"), F.count(F.lit(1)).alias("n")),
        """SELECT 'tpa=' || event_type AS tpa, strftime(ts, '%Y-%m-%d') AS day, CAST(2 AS BIGINT) AS first, count(*) + 1 AS last,
           count(*) AS n FROM events GROUP BY 1, 2"""),
    "src_10_provider_from_path": Query(
        lambda s, d: T.load(s, d, "pages").select(
            "page_id", paths.provider(F.col("url")).alias("tpa"),
            paths.provider(F.concat(F.lit("file"), F.col("page_id"), F.lit(".v1.csv"))).alias("root_tpa")),
        "SELECT page_id, string_split(url, '/')[-2] AS tpa, 'file' || page_id || '.v1' AS root_tpa FROM pages"),
    "src_11_target_schema_csv": Query(
        _config_schemas,
        sql("schemas", "SELECT table_name, column_name, tpa, data_type, nullable, default_value, description, true AS active FROM schemas")),
    "src_12_field_mapping_csv": Query(
        _config_mappings,
        sql("mappings", """SELECT source_field, source_table, target_table, target_column, tpa, mapping_method, confidence_score,
            CASE WHEN mapping_id % 2 = 0 THEN 'TO_DATE(source_value, ''MM-DD-YYYY'')' ELSE 'CAST(source_value AS NUMBER(10, 2))' END
            AS transformation_logic, approved FROM mappings""")),
    "src_13_rules_csv": Query(
        _config_rules,
        sql("rules", """SELECT rule_id, rule_type, target_column, tpa, rule_logic,
            CASE WHEN priority > 50 THEN '{"strategy": "KEEP_LAST"}' END AS rule_parameters,
            CASE WHEN priority % 20 = 0 THEN CAST(100 AS INTEGER) ELSE CAST(priority AS INTEGER) END AS priority, error_action,
            'a, b' AS description, active FROM rules""").replace("rule_logic,\n", "trim(rule_logic) AS rule_logic,\n", 1)),
    "src_14_inline_seed": Query(
        lambda s, d: T.load(s, d, "events").select(F.col("event_type").alias("tpa_code")).distinct().unionByName(
            s.createDataFrame([("provider_a",), ("provider_b",)], "tpa_code string")),
        "SELECT DISTINCT event_type AS tpa_code FROM events UNION ALL VALUES ('provider_a'), ('provider_b')"),
    "src_15_metric_definitions": Query(
        _config_metrics,
        """SELECT 'Completeness - ' || p_partkey AS metric_name, upper(p_brand) AS target_table, CAST(p_size AS DOUBLE) AS threshold_value,
           '>=' AS threshold_operator, true AS enabled, p_size > 9 AS alert_on_failure FROM part"""),
    "dq_10_metric_definitions": Query(_measured_definitions, _measured_definitions_sql()),
    "src_16_prompt_templates": Query(
        _config_prompts,
        """SELECT 'PROMPT_NO_' || item_id AS template_id, md5('Say "' || text || '"' || chr(10) || 'then {source_fields}') AS text_hash,
           true AS active FROM benchmark"""),
    "src_17_catalog": Query(
        _catalog,
        """SELECT 'feedmill_orders' AS table_name, true AS is_temporary, count(*) AS n FROM orders
           UNION ALL SELECT 'feedmill_lineitem', true, count(*) FROM lineitem"""),
}

# -- sinks and DML -----------------------------------------------------------------


def _raw_keys(s, d, condition: str = "true") -> DataFrame:
    return T.raw(s, d, False).filter(condition).select("raw_id", "tpa", "file_name", "file_row_number", "value")


def _fresh(s, d):
    return rows_to_insert(_raw_keys(s, d), _raw_keys(s, d, "value <= 250"), ["file_name", "file_row_number"])


def _merge_target(s, d):
    return T.schemas(s, d).filter("schema_id % 3 <> 0").select("schema_id", "column_name", "data_type", "active")


def _merge_source(s, d):
    return T.schemas(s, d).filter("schema_id % 2 = 0").select(
        "schema_id", "column_name", F.concat("data_type", F.lit(" NEW")).alias("data_type"))


def _upserted(s, d):
    store = Store(s, session.scratch_path(s, "lake"), buckets=8)
    store.create("CLAIMS", "CLAIM_NUM string, LAST_ID bigint, STATUS string, CREATED_AT timestamp_ntz")
    claims = T.claims(s, d).select(
        F.col("claim_num").alias("CLAIM_NUM"), F.col("raw_id").alias("LAST_ID"), F.col("status").alias("STATUS"))
    counts = []
    for part, batch in enumerate(("LAST_ID % 2 = 0", "LAST_ID % 2 = 1")):
        rows = session.stage(keep_last(claims.filter(batch), ["CLAIM_NUM"], "LAST_ID"), "claims")
        counts.append(store.upsert("CLAIMS", rows, "CLAIM_NUM", ["LAST_ID", "STATUS"], {}, {"CREATED_AT": as_of()}))
    return store, counts


def _merge_master(s, d):
    staged = T.master(s, d).filter("tpa_code <> 'view'").select(
        "tpa_code", F.concat(F.lit("New "), "tpa_name").alias("tpa_name")).unionByName(
        T.load(s, d, "nation").select(F.lower("n_name").alias("tpa_code"), F.col("n_name").alias("tpa_name")))
    return merge_rows(T.master(s, d), staged, ["tpa_code"], ["tpa_name"], {}, {"active": F.lit(True)})


def _audit(s, d):
    store = Store(s, session.scratch_path(s, "lake"))
    log = T.log(s, d)
    opened = log.withColumn("status", F.lit("PROCESSING")).withColumn("end_timestamp", F.lit(None).cast("timestamp_ntz"))
    store.append("silver_processing_log", opened)
    store.append("silver_processing_log", log.filter("end_timestamp IS NOT NULL"))
    return silver.latest_log(store.read("silver_processing_log")).select(
        "batch_id", "status", F.date_format("end_timestamp", "yyyy-MM-dd HH:mm:ss").alias("end_timestamp"))


def _queue_retries(s, d) -> DataFrame:
    return T.queue(s, d).withColumn("retry_count", (F.col("queue_id") % 4).cast("int"))


def _results(s, d) -> DataFrame:
    return T.queue(s, d).filter("status IN ('PENDING', 'PROCESSING')").select(
        "file_name", F.when(F.col("queue_id") % 3 == 0, "FAILURE: bad").otherwise("SUCCESS: Processed 5 rows, Inserted 5, Skipped 0").alias("result"))


def _moved(s, d):
    queue = T.queue(s, d)
    return bronze.stamp_moved(queue, bronze.move_plan(queue, "SUCCESS", 10), as_of()).filter(
        F.col("moved_timestamp") == as_of()).select("queue_id")


def _reprocess(s, d):
    queue = T.queue(s, d)
    asked = queue.filter("status = 'FAILED' AND queue_id % 2 = 0").select(
        F.lit(1).cast("bigint").alias("reprocess_id"), "file_name", F.lit("PENDING_REPROCESS").alias("status"))
    done, left = bronze.apply_reprocessing(queue, asked)
    return done.select("queue_id", "status", "error_message", left.agg(F.count(F.lit(1)).alias("n")).scalar().alias("left_over"))


def _error_listing(s, d) -> DataFrame:
    return T.queue(s, d).filter("status = 'FAILED'").select("file_name", F.col("discovered_timestamp").alias("last_modified"))


def _exported(s, d):
    path = session.scratch_path(s, "export")
    T.load(s, d, "customer").select("c_custkey", "c_name", "c_mktsegment").write.options(header=True, quoteAll=True).csv(path)
    text = s.read.text(path)
    return text.groupBy(F.col("value").startswith('"').alias("quoted"), F.col("value").endswith('"').alias("closed")).agg(
        F.count(F.when(F.col("value") != '"c_custkey","c_name","c_mktsegment"', 1)).alias("rows"))


def _crud(s, d):
    changes = T.load(s, d, "customer").select(
        F.concat(F.lit("R"), F.col("c_custkey") + F.when(F.col("c_nationkey") == 3, 10000000).otherwise(0)).alias("rule_id"),
        F.when(F.col("c_nationkey") == 1, "U").when(F.col("c_nationkey") == 2, "D").when(F.col("c_nationkey") == 3, "I")
        .when(F.col("c_nationkey") == 4, "S").alias("op"),
        F.lit("changed").alias("rule_name"), F.lit(5).cast("bigint").alias("priority"), F.lit(True).alias("active")).filter("op IS NOT NULL")
    return apply_changes(T.rules(s, d), changes, "rule_id", ["rule_name"]).select("rule_id", "rule_name", "priority", "active")


SINKS = {
    "snk_01_insert_only_merge": Query(
        lambda s, d: _fresh(s, d).select("raw_id", "file_name"),
        sql("raw", "SELECT raw_id, file_name FROM raw WHERE value > 250")),
    "snk_02_load_counters": Query(
        lambda s, d: _raw_keys(s, d).groupBy("tpa").agg(F.count(F.lit(1)).alias("processed")).join(
            _fresh(s, d).groupBy("tpa").agg(F.count(F.lit(1)).alias("inserted")), "tpa", "left").withColumn(
            "inserted", F.coalesce("inserted", F.lit(0))).withColumn("skipped", F.col("processed") - F.col("inserted")),
        sql("raw", """SELECT tpa, count(*) AS processed, count(CASE WHEN value > 250 THEN 1 END) AS inserted,
            count(CASE WHEN value <= 250 THEN 1 END) AS skipped FROM raw GROUP BY tpa""")),
    "snk_03_staged_batch": Query(
        lambda s, d: session.stage(T.claims(s, d).select("raw_id", "claim_num"), "batch"),
        sql("claims", "SELECT raw_id, claim_num FROM claims")),
    "snk_04_appended_rows": Query(
        lambda s, d: _appended(s, d), sql("metrics", "SELECT table_name, pass_fail, count(*) AS metrics FROM metrics WHERE metric_value IS NOT NULL GROUP BY ALL")),
    "snk_05_audit_rows": Query(
        _audit,
        sql("log", f"SELECT batch_id, status, strftime(end_timestamp, {TS}) AS end_timestamp FROM log")),
    "snk_06_update_where": Query(
        lambda s, d: update_where(T.rules(s, d), (F.col("priority") > 50) & F.col("tpa").isNull(), {"active": F.lit(False)}).select(
            "rule_id", "active"),
        sql("rules", "SELECT rule_id, CASE WHEN priority > 50 AND tpa IS NULL THEN false ELSE active END AS active FROM rules")),
    "snk_07_delete_where": Query(
        lambda s, d: delete_where(T.rules(s, d), F.col("tpa") == "tpa_1").select("rule_id"),
        sql("rules", "SELECT rule_id FROM rules WHERE tpa IS NULL OR tpa <> 'tpa_1'")),
    "snk_08_queue_transition": Query(
        lambda s, d: bronze.queue_after(_queue_retries(s, d), _results(s, d), as_of()).select("queue_id", "status", "error_message"),
        sql("queue", """SELECT queue_id, CASE WHEN status IN ('SUCCESS', 'FAILED') THEN status WHEN queue_id % 3 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
            CASE WHEN status IN ('SUCCESS', 'FAILED') THEN error_message WHEN queue_id % 3 = 0 THEN 'FAILURE: bad' END AS error_message FROM queue""")),
    "snk_09_move_plan": Query(
        _moved,
        sql("queue", """SELECT queue_id FROM queue WHERE status = 'SUCCESS' AND moved_timestamp IS NULL
            ORDER BY processed_timestamp, queue_id LIMIT 10""")),
    "snk_10_archive_plan": Query(
        lambda s, d: bronze.archive_plan(
            T.queue(s, d).filter("status = 'SUCCESS'").select("file_name", F.col("discovered_timestamp").alias("last_modified")),
            _error_listing(s, d), as_of("1998-06-15 00:00:00")).select("file_name", "area"),
        sql("queue", """SELECT file_name, CASE status WHEN 'SUCCESS' THEN 'COMPLETED' ELSE 'ERROR' END AS area FROM queue
            WHERE status IN ('SUCCESS', 'FAILED') AND discovered_timestamp < TIMESTAMP '1998-06-15 00:00:00' - INTERVAL 30 DAY""")),
    "snk_11_reprocess_one": Query(
        lambda s, d: bronze.reprocess_requests(_error_listing(s, d), ["view/0.csv", "view/4.csv", "click/1.csv", "nowhere.csv"], as_of()).select(
            "file_name", "status"),
        sql("queue", """SELECT file_name, 'PENDING_REPROCESS' AS status FROM queue WHERE status = 'FAILED'
            AND file_name IN ('view/0.csv', 'view/4.csv', 'click/1.csv', 'nowhere.csv')""")),
    "snk_12_reprocess_all": Query(
        lambda s, d: bronze.reprocess_requests(_error_listing(s, d), None, as_of()).select("file_name"),
        sql("queue", "SELECT file_name FROM queue WHERE status = 'FAILED'")),
    "snk_13_apply_reprocess": Query(
        _reprocess,
        sql("queue", """SELECT queue_id, CASE WHEN status = 'FAILED' AND queue_id % 2 = 0 THEN 'PENDING' ELSE status END AS status,
            CASE WHEN status = 'FAILED' AND queue_id % 2 = 0 THEN 'Reprocessing requested' ELSE error_message END AS error_message,
            CAST(0 AS BIGINT) AS left_over FROM queue""")),
    "snk_14_csv_export": Query(
        _exported, "SELECT true AS quoted, true AS closed, count(*) AS rows FROM customer"),
    "snk_15_row_edits": Query(
        _crud,
        """SELECT 'R' || c_custkey AS rule_id, CASE WHEN c_nationkey = 1 THEN 'changed' ELSE 'Rule ' || c_custkey END AS rule_name,
             c_custkey % 10 * 10 AS priority, CASE WHEN c_nationkey = 4 THEN false ELSE c_acctbal > 0 END AS active FROM customer WHERE c_nationkey <> 2
           UNION ALL SELECT 'R' || (c_custkey + 10000000), 'changed', 5, true FROM customer WHERE c_nationkey = 3"""),
    "snk_16_retries": Query(
        lambda s, d: bronze.retryable(bronze.queue_after(_queue_retries(s, d), _results(s, d), as_of())).select("queue_id", "retry_count"),
        sql("queue", """SELECT queue_id, CAST(retries AS INTEGER) AS retry_count FROM (SELECT queue_id, queue_id % 4
              + CASE WHEN status IN ('PENDING', 'PROCESSING') AND queue_id % 3 = 0 THEN 1 ELSE 0 END AS retries,
              CASE WHEN status IN ('PENDING', 'PROCESSING') AND queue_id % 3 = 0 THEN 'FAILED' WHEN status = 'FAILED' THEN 'FAILED' END AS st
            FROM queue) WHERE st = 'FAILED' AND retries < 3""")),
    "merge_01_upsert": Query(
        lambda s, d: merge_rows(_merge_target(s, d), _merge_source(s, d), ["schema_id"], ["data_type"],
                                {"active": F.lit(True)}, {"active": F.lit(False)}, action="did"),
        sql("schemas", """SELECT schema_id, column_name, CASE WHEN schema_id % 2 = 0 THEN data_type || ' NEW' ELSE data_type END AS data_type,
            CASE WHEN schema_id % 2 <> 0 THEN active WHEN schema_id % 3 = 0 THEN false ELSE true END AS active,
            CASE WHEN schema_id % 2 <> 0 THEN 'KEEP' WHEN schema_id % 3 = 0 THEN 'INSERT' ELSE 'UPDATE' END AS did
            FROM schemas WHERE schema_id % 3 <> 0 OR schema_id % 2 = 0""")),
    "merge_02_seed": Query(
        lambda s, d: rows_to_insert(_merge_source(s, d), _merge_target(s, d), ["schema_id"]),
        sql("schemas", "SELECT schema_id, column_name, data_type || ' NEW' AS data_type FROM schemas WHERE schema_id % 6 = 0")),
    "merge_03_silver_upsert": Query(
        lambda s, d: _upserted(s, d)[0].silver("CLAIMS").select("CLAIM_NUM", "LAST_ID", "STATUS"),
        sql("claims", """SELECT claim_num AS "CLAIM_NUM", coalesce(max(CASE WHEN raw_id % 2 = 1 THEN raw_id END), max(raw_id)) AS "LAST_ID",
            coalesce(arg_max(status, raw_id) FILTER (raw_id % 2 = 1), arg_max(status, raw_id)) AS "STATUS" FROM claims GROUP BY claim_num""")),
    "merge_03_upsert_counts": Query(
        lambda s, d: s.createDataFrame(
            [(i + 1, n, u) for i, (n, u) in enumerate(_upserted(s, d)[1])], "batch bigint, inserted bigint, updated bigint"),
        sql("claims", """SELECT CAST(1 AS BIGINT) AS batch, count(DISTINCT claim_num) AS inserted, CAST(0 AS BIGINT) AS updated FROM claims WHERE raw_id % 2 = 0
            UNION ALL SELECT 2, count(CASE WHEN NOT seen THEN 1 END), count(CASE WHEN seen THEN 1 END) FROM (
              SELECT DISTINCT claim_num, claim_num IN (SELECT claim_num FROM claims WHERE raw_id % 2 = 0) AS seen FROM claims WHERE raw_id % 2 = 1)""")),
    "merge_04_bulk_providers": Query(
        _merge_master,
        sql("master", """SELECT tpa_code, CASE WHEN tpa_code = 'view' THEN tpa_name ELSE 'New ' || tpa_name END AS tpa_name, active FROM master
            UNION ALL SELECT lower(n_name), n_name, true FROM nation""")),
}

# -- table life ------------------------------------------------------------------------

CLAIM_COLUMNS = [("CLAIM_NUM", "VARCHAR(100)"), ("MEMBER", "NUMBER(38 0)"), ("BILLED", "NUMBER(15 2)"), ("STATUS", "VARCHAR(10)")]


def _claims_table(s, d) -> Store:
    store = Store(s, session.scratch_path(s, "lake"), buckets=8)
    A.load_target_schemas(store, s.createDataFrame(
        [("CLAIMS", c, "all", t, True, None, None) for c, t in CLAIM_COLUMNS],
        "table_name string, column_name string, tpa string, data_type string, nullable boolean, default_value string, description string"),
        as_of())
    A.create_table(store, "CLAIMS")
    rows = T.claims(s, d).select(
        F.concat("claim_num", F.lit("-"), F.col("raw_id")).alias("CLAIM_NUM"), F.col("member_id").alias("MEMBER"),
        F.col("billed").alias("BILLED"), F.col("status").alias("STATUS"))
    store.upsert("CLAIMS", session.stage(rows, "claims"), "CLAIM_NUM", ["MEMBER", "BILLED", "STATUS"])
    return store


def _changed_table(s, d):
    store = _claims_table(s, d)
    A.add_column(store, "CLAIMS", "REGION", "VARCHAR(10)", "all", as_of(), default="'north'")
    A.alter_column(store, "CLAIMS", "STATUS", as_of(), data_type="INTEGER")
    A.drop_column(store, "CLAIMS", "MEMBER")
    return store.silver("CLAIMS").select(
        "CLAIM_NUM", F.col("BILLED").cast("double").alias("BILLED"), F.col("STATUS").isNull().alias("NO_STATUS"), "REGION")


def _synced_table(s, d):
    store = _claims_table(s, d)
    store.replace("target_schemas", store.snapshot("target_schemas").withColumn(
        "data_type", F.when(F.col("column_name") == "MEMBER", "VARCHAR(20)").otherwise(F.col("data_type"))))
    A.sync_table(store, "CLAIMS")
    return store.silver("CLAIMS").select("CLAIM_NUM", "MEMBER", "STATUS")


def _created_tables(s, d):
    store = Store(s, session.scratch_path(s, "lake"))
    found = T.schemas(s, d).filter("active AND data_type <> 'BLOB'").dropDuplicates(["table_name", "column_name"])
    store.replace("target_schemas", found)
    A.create_all_tables(store)
    names = [r[0] for r in found.filter("active").select("table_name").distinct().collect()]
    existing = s.createDataFrame([(n,) for n in names if store.is_created(n)], "table_name string")
    return A.defined_tables(store.snapshot("target_schemas"), existing).select("table_name", "is_created")


def _created_columns(s, d):
    store = Store(s, session.scratch_path(s, "lake"))
    store.replace("target_schemas", T.schemas(s, d).filter("active AND data_type <> 'BLOB'").dropDuplicates(["table_name", "column_name"]))
    message = A.create_table(store, "brand_22")
    columns = [c for c in store.silver("BRAND_22").columns if c not in (BUCKET, ROW)]
    return s.createDataFrame([(c, message) for c in columns], "column_name string, message string")


def _initialised(s, d):
    store = Store(s, session.scratch_path(s, "lake"))
    store.replace("target_schemas", T.schemas(s, d))
    store.replace("field_mappings", T.mappings(s, d))
    A.initialise_table(store, "brand_22", as_of())
    columns = store.snapshot("target_schemas").filter("table_name = 'BRAND_22'").select(F.lit("column").alias("kind"), F.col("column_name").alias("name"))
    mapped = store.snapshot("field_mappings").filter("target_table = 'BRAND_22'").select(F.lit("mapping").alias("kind"), F.col("target_column").alias("name"))
    return columns.unionByName(mapped)


def _dropped(s, d):
    store = Store(s, session.scratch_path(s, "lake"))
    store.replace("target_schemas", T.schemas(s, d))
    store.replace("field_mappings", T.mappings(s, d))
    store.replace("transformation_rules", T.rules(s, d))
    A.drop_table(store, "brand_2")
    left = store.snapshot("target_schemas").groupBy("table_name").agg(F.count_if("active").alias("active_columns"))
    kept = store.snapshot("field_mappings").groupBy(F.col("target_table").alias("table_name")).agg(F.count(F.lit(1)).alias("mappings"))
    return left.join(kept, "table_name", "left").select("table_name", "active_columns", F.coalesce("mappings", F.lit(0)).alias("mappings"))


def _restored(s, d):
    store = Store(s, session.scratch_path(s, "lake"))
    first = store.replace("transformation_rules", T.rules(s, d))
    store.replace("transformation_rules", T.rules(s, d).filter("false"))
    store.restore("transformation_rules", first)
    return store.snapshot("transformation_rules").select("rule_id", "active")


_STANDARD = "('SOURCE_FILE_NAME', 'VARCHAR(500)'), ('INGESTION_TIMESTAMP', 'TIMESTAMP_NTZ'), ('CREATED_AT', 'TIMESTAMP_NTZ'), ('UPDATED_AT', 'TIMESTAMP_NTZ')"

TABLES = {
    "ddl_01_validate_schema": Query(
        lambda s, d: A.validate_schemas(T.schemas(s, d).withColumn("active", F.col("active") & (F.col("table_name") != "BRAND_3"))),
        sql("schemas", """SELECT table_name, column_count, invalid_types, duplicate_columns,
            CASE WHEN column_count > 0 AND invalid_types + duplicate_columns = 0 THEN 'Validation passed for table: ' || table_name
              ELSE 'Validation FAILED for table: ' || table_name || ' - Errors: '
                || CASE WHEN column_count = 0 THEN 'No columns defined for table. ' ELSE '' END
                || CASE WHEN invalid_types > 0 THEN 'Invalid data types detected. ' ELSE '' END
                || CASE WHEN duplicate_columns > 0 THEN 'Duplicate column names detected. ' ELSE '' END END AS message
            FROM (SELECT table_name, count(CASE WHEN active THEN 1 END) AS column_count,
              count(CASE WHEN active AND data_type = 'BLOB' THEN 1 END) AS invalid_types,
              count(CASE WHEN active THEN 1 END) - count(DISTINCT CASE WHEN active THEN column_name END) AS duplicate_columns
              FROM (SELECT * REPLACE (active AND table_name <> 'BRAND_3' AS active) FROM schemas) GROUP BY table_name)""")),
    "ddl_03_create_table": Query(
        _created_columns,
        sql("schemas", """SELECT DISTINCT column_name, CAST('Successfully created table: ' || table_name AS VARCHAR) AS message
            FROM schemas WHERE active AND data_type <> 'BLOB' AND table_name = 'BRAND_22'""")),
    "ddl_12_initialise_table": Query(
        _initialised,
        sql("schemas mappings", f"""SELECT 'column' AS kind, column_name AS name FROM schemas WHERE table_name = 'BRAND_22'
            UNION ALL SELECT 'column', c FROM (VALUES {_STANDARD}) v(c, t)
            UNION ALL SELECT 'mapping', target_column FROM mappings WHERE target_table = 'BRAND_22'
            UNION ALL VALUES ('mapping', 'SOURCE_FILE_NAME'), ('mapping', 'INGESTION_TIMESTAMP')""")),
    "ddl_02_table_ddl": Query(
        lambda s, d: A.table_ddl(T.schemas(s, d)),
        sql("schemas", """SELECT table_name, 'CREATE TABLE IF NOT EXISTS ' || table_name || ' (' || chr(10)
              || string_agg('    ' || column_name || ' ' || data_type || CASE WHEN NOT nullable THEN ' NOT NULL' ELSE '' END
                || CASE WHEN default_value IS NOT NULL THEN ' DEFAULT ' || default_value ELSE '' END
                || ' COMMENT ''' || description || '''', ',' || chr(10) ORDER BY schema_id) || chr(10) || ')' AS ddl
            FROM schemas WHERE active GROUP BY table_name""")),
    "ddl_04_create_tables": Query(
        _created_tables,
        sql("schemas", "SELECT DISTINCT table_name, true AS is_created FROM schemas WHERE active AND data_type <> 'BLOB'")),
    "ddl_05_drop_table": Query(
        _dropped,
        sql("schemas mappings", """SELECT s.table_name, count(CASE WHEN active AND s.table_name <> 'BRAND_2' THEN 1 END) AS active_columns,
            coalesce(any_value(n), 0) AS mappings FROM schemas s
            LEFT JOIN (SELECT target_table, count(*) AS n FROM mappings WHERE target_table <> 'BRAND_2' GROUP BY target_table) m
            ON m.target_table = s.table_name GROUP BY s.table_name""")),
    "ddl_06_07_08_change_columns": Query(
        _changed_table,
        sql("claims", """SELECT claim_num || '-' || raw_id AS "CLAIM_NUM", round(billed, 2) AS "BILLED", true AS "NO_STATUS", 'north' AS "REGION" FROM claims""")),
    "ddl_09_sync_table": Query(
        _synced_table,
        sql("claims", """SELECT claim_num || '-' || raw_id AS "CLAIM_NUM", CAST(member_id AS VARCHAR) AS "MEMBER", status AS "STATUS" FROM claims""")),
    "ddl_10_standard_columns": Query(
        lambda s, d: A.standard_columns(T.schemas(s, d).withColumn(
            "column_name", F.when(F.col("schema_id") % 2 == 0, "CREATED_AT").otherwise(F.col("column_name"))), "brand_2").select(
            "table_name", "column_name", "data_type", "tpa"),
        sql("schemas", f"""SELECT 'BRAND_2' AS table_name, c AS column_name, t AS data_type,
            (SELECT min(tpa) FROM schemas WHERE table_name = 'BRAND_2') AS tpa FROM (VALUES {_STANDARD}) v(c, t)
            WHERE c <> 'CREATED_AT' OR NOT EXISTS (SELECT 1 FROM schemas WHERE table_name = 'BRAND_2' AND schema_id % 2 = 0)""")),
    "ddl_11_standard_mappings": Query(
        lambda s, d: A.standard_mappings(T.mappings(s, d).withColumn(
            "target_column", F.when(F.col("tpa") == "economy", "SOURCE_FILE_NAME").otherwise(F.col("target_column"))), "brand_2", "economy").select(
            "source_field", "target_column", "mapping_method"),
        sql("mappings", """SELECT s AS source_field, t AS target_column, 'SYSTEM' AS mapping_method
            FROM (VALUES ('FILE_NAME', 'SOURCE_FILE_NAME'), ('LOAD_TIMESTAMP', 'INGESTION_TIMESTAMP')) v(s, t)
            WHERE t <> 'SOURCE_FILE_NAME' OR NOT EXISTS (SELECT 1 FROM mappings WHERE target_table = 'BRAND_2' AND tpa = 'economy')""")),
    "ddl_13_schema_edits": Query(
        lambda s, d: A.schema_edits(
            T.schemas(s, d).filter("schema_id % 5 <> 0"),
            T.schemas(s, d).filter("schema_id % 7 <> 0").withColumn("nullable", F.col("nullable") | (F.col("schema_id") % 11 == 0))
        ).select("op", "schema_id"),
        sql("schemas", """SELECT * FROM (SELECT CASE WHEN schema_id % 5 = 0 AND schema_id % 7 <> 0 THEN 'I' WHEN schema_id % 7 = 0 AND schema_id % 5 <> 0 THEN 'D'
            WHEN schema_id % 11 = 0 AND NOT nullable AND schema_id % 35 <> 0 AND schema_id % 5 <> 0 AND schema_id % 7 <> 0 THEN 'U' END AS op, schema_id
            FROM schemas) WHERE op IS NOT NULL""")),
    "ddl_14_restore": Query(_restored, sql("rules", "SELECT rule_id, active FROM rules")),
}

# -- jobs ---------------------------------------------------------------------------------

CLAIM_TARGET = [
    ("CLAIM_NUM", "VARCHAR(100)"), ("FIRST_NAME", "VARCHAR(100)"), ("SERVICE_DATE", "DATE"), ("BILLED", "NUMBER(15 2)"),
    ("PROVIDER_NPI", "VARCHAR(20)"), ("STATUS", "VARCHAR(20)"), ("TOTAL", "NUMBER(15,2)"), ("SOURCE_FILE_NAME", "VARCHAR(500)"),
]
CLAIM_MAPPINGS = [
    ("CLM_NBR", "CLAIM_NUM", None, "TRIM(source_value)"),
    ("Claim Number", "CLAIM_NUM", "provider_2", None),
    ("PAT_FNAME", "FIRST_NAME", None, None),
    ("MEMBER", "FIRST_NAME", "provider_2", None),
    ("SVC_DT", "SERVICE_DATE", None, "TO_DATE(source_value 'MM-DD-YYYY')"),
    ("Service From", "SERVICE_DATE", "provider_2", "TO_DATE(source_value, 'YYYY-MM-DD')"),
    ("CHRG_AMT", "BILLED", None, "CAST(source_value AS NUMBER(15 2))"),
    ("NPI", "PROVIDER_NPI", None, "TRIM(source_value)"),
    ("status", "STATUS", None, None),
]
CLAIM_RULES = [
    ("Q1", "DATA_QUALITY", "FIRST_NAME", None, "IS NOT NULL", None, 10, "REJECT"),
    ("Q2", "DATA_QUALITY", "PROVIDER_NPI", None, "RLIKE '^[0-9]{10}$'", None, 20, "QUARANTINE"),
    ("Q3", "DATA_QUALITY", "BILLED", None, ">= 0", None, 30, "REJECT"),
    ("Q4", "DATA_QUALITY", "STATUS", None, "IN ('F', 'O')", None, 40, "LOG"),
    ("B1", "BUSINESS_LOGIC", "TOTAL", None, "COALESCE(BILLED, 0) + 1", None, 50, "LOG"),
    ("T1", "STANDARDIZATION", "FIRST_NAME", None, "UPPER", None, 60, "LOG"),
    ("T2", "STANDARDIZATION", "STATUS", None, "LOWER", None, 70, "LOG"),
    ("D1", "DEDUPLICATION", None, None, "CLAIM_NUM", '{"strategy": "KEEP_FIRST"}', 80, "LOG"),
]


def raw_claims(s, d) -> DataFrame:
    """Claims as providers send them: text cells, names and date layouts differing by provider."""
    c = T.claims(s, d)
    tpa = F.concat(F.lit("provider_"), F.substring("plan_type", 1, 1))
    number = F.concat(F.lit(" "), F.col("claim_num"), F.lit(" "))
    money = F.format_string("%.2f", F.col("billed"))
    shared = [money.alias("CHRG_AMT"), F.col("provider_npi").alias("NPI"), F.col("status").alias("STATUS")]
    plain = F.to_variant_object(F.struct(
        number.alias("CLM_NBR"), F.col("first_name").alias("PAT_FNAME"),
        F.date_format("service_date", "MM-dd-yyyy").alias("SVC_DT"), *shared))
    other = F.to_variant_object(F.struct(
        F.col("claim_num").alias("Claim Number"), F.col("first_name").alias("MEMBER"),
        F.date_format("service_date", "yyyy-MM-dd").alias("Service From"), *shared))
    return c.select(
        (F.col("raw_id") + 1).alias("raw_id"), tpa.alias("tpa"),
        T.stored_object(F.when(tpa == "provider_2", other).otherwise(plain)),
        F.concat(tpa, F.lit("/"), F.col("member_id") % 100, F.lit(".csv")).alias("file_name"),
        F.col("raw_id").alias("file_row_number"), ntz(NOW_TEXT).alias("load_timestamp"))


def claim_types() -> dict[str, str]:
    return {c: type_name(t) for c, t in CLAIM_TARGET}


def claim_mappings() -> list[silver.Mapping]:
    return [silver.Mapping(f, c, t, logic) for f, c, t, logic in CLAIM_MAPPINGS] + [
        silver.Mapping("FILE_NAME", "SOURCE_FILE_NAME", None, None)]


def silver_claims(s, d) -> DataFrame:
    projected = silver.project(raw_claims(s, d), claim_mappings(), claim_types())
    return silver.apply_all_rules(projected, active_rules(rule_frame(s, CLAIM_RULES), "CLAIMS"), "CLAIMS")


_GOOD = """good AS (SELECT *, 'provider_' || substr(plan_type, 1, 1) AS tpa FROM claims
    WHERE first_name IS NOT NULL AND regexp_full_match(provider_npi, '[0-9]{10}') AND billed >= 0),
kept AS (SELECT * FROM good QUALIFY row_number() OVER (PARTITION BY claim_num ORDER BY raw_id) = 1)"""
_SILVER = f"""SELECT claim_num AS "CLAIM_NUM", upper(first_name) AS "FIRST_NAME", strftime(service_date, '%Y-%m-%d') AS "SERVICE_DATE",
    round(billed, 2) AS "BILLED", lower(status) AS "STATUS", round(billed + 1, 2) AS "TOTAL" FROM kept"""


def good_sql(body: str) -> str:
    return sql("claims", "").rstrip() + ",\n" + _GOOD + "\n" + body


class _LosesMark(Store):
    """A store whose first write of the high-water mark fails."""

    lost = False

    def merge(self, table, *args, **options):
        if table == "processing_watermarks" and not self.lost:
            self.lost = True
            raise RuntimeError("the mark was not written")
        return super().merge(table, *args, **options)


def _claim_store(s, d, kind: type[Store] = Store) -> Store:
    store = kind(s, session.scratch_path(s, "lake"), buckets=8)
    A.load_target_schemas(store, s.createDataFrame(
        [("CLAIMS", c, None, t, True, None, None) for c, t in CLAIM_TARGET],
        "table_name string, column_name string, tpa string, data_type string, nullable boolean, default_value string, description string"),
        as_of())
    A.load_field_mappings(store, s.createDataFrame(
        [(f, "RAW_DATA_TABLE", "CLAIMS", c, t, "MANUAL", 1.0, logic, True) for f, c, t, logic in CLAIM_MAPPINGS],
        "source_field string, source_table string, target_table string, target_column string, tpa string, "
        "mapping_method string, confidence_score double, transformation_logic string, approved boolean"), as_of())
    A.load_rules(store, rule_frame(s, CLAIM_RULES), as_of())
    store.append("raw_data", raw_claims(s, d), partition_by=["tpa"])
    return store


def _typed(df: DataFrame) -> DataFrame:
    return df.select(
        "CLAIM_NUM", "FIRST_NAME", F.date_format("SERVICE_DATE", "yyyy-MM-dd").alias("SERVICE_DATE"),
        F.col("BILLED").cast("double").alias("BILLED"), "STATUS", F.col("TOTAL").cast("double").alias("TOTAL"))


def _batch(s, d):
    store = _claim_store(s, d)
    result = silver.transform_batch(store, "CLAIMS", NOW, batch_size=None)
    if result.status != "SUCCESS":
        raise RuntimeError(result.message)
    return store


def _rerun(s, d):
    """State after a batch that failed before its mark was written and ran again."""
    store = _claim_store(s, d, _LosesMark)
    states = [silver.transform_batch(store, "CLAIMS", NOW, batch_size=None).status for _ in range(2)]
    if states != ["FAILED", "SUCCESS"]:
        raise RuntimeError(f"unexpected states {states}")
    return _state(store)


def _appended(s, d):
    store = Store(s, session.scratch_path(s, "lake"))
    for part in ("value <= 300", "value > 300"):
        rows = T.metrics(s, d).filter(part.replace("value", "metric_value"))
        store.append("data_quality_metrics", rows)
    return store.read("data_quality_metrics").groupBy("table_name", "pass_fail").agg(F.count(F.lit(1)).alias("metrics"))


def _staleness(s, d):
    return views.watermark_status(_batch(s, d).snapshot("processing_watermarks"), as_of()).select(
        "watermark_id", "last_processed_id", "status")


def _state(store: Store) -> DataFrame:
    metrics = store.read("data_quality_metrics").select(F.concat("metric_type", F.lit("/"), "rule_id").alias("what"), F.col("metric_value").cast("bigint").alias("n"))
    log = silver.latest_log(store.read(silver.LOG))
    counts = log.select(F.explode(F.create_map(
        F.lit("read"), "records_read", F.lit("processed"), "records_processed", F.lit("inserted"), "records_inserted",
        F.lit("updated"), "records_updated", F.lit("rejected"), "records_rejected")).alias("what", "n"))
    held = store.read("quarantine_records").groupBy().agg(F.count(F.lit(1)).alias("n")).select(F.lit("quarantined").alias("what"), "n")
    mark = store.snapshot("processing_watermarks").select(F.lit("mark").alias("what"), F.col("last_processed_id").alias("n"))
    return metrics.unionByName(counts).unionByName(held).unionByName(mark)


def _two_batches(s, d):
    """Drain in batches of two thirds of the rows, then reset the mark and drain again."""
    store = _claim_store(s, d)
    rows = T.load(s, d, "orders").count()
    first = silver.process_all_pending(store, "CLAIMS", NOW, batch_size=rows * 2 // 3)
    silver.reset_watermark(store, "CLAIMS")
    again = silver.process_all_pending(store, "CLAIMS", NOW, batch_size=None)
    return s.createDataFrame(
        [(i + 1, r.status, r.read) for i, r in enumerate(first + again)], "batch bigint, status string, records_read bigint")


def _all_targets(s, d):
    store = _claim_store(s, d)
    A.load_target_schemas(store, s.createDataFrame(
        [("UNMAPPED", "X", None, "DATE", True, None, None)],
        "table_name string, column_name string, tpa string, data_type string, nullable boolean, default_value string, description string"),
        as_of())
    silver.transform_all_targets(store, NOW, batch_size=None)
    return silver.latest_log(store.read(silver.LOG)).select("target_table", "status", "records_read")


def _loaded(s, d, stream: bool) -> DataFrame:
    store = Store(s, session.scratch_path(s, "lake"))
    if stream:
        ingest.stream_files_to_raw(
            store, landing(s, d), session.scratch_path(s, "checkpoint"), lambda: NOW, files_per_trigger=60).awaitTermination()
    else:
        bronze.discover_files(store, landing(s, d), as_of())
        bronze.process_queued_files(store, landing(s, d), as_of(), limit=100_000)
    raw = store.read("raw_data")
    queued = store.snapshot(bronze.QUEUE).filter("status = 'SUCCESS'").groupBy(paths.provider(F.col("file_name")).alias("tpa")).agg(
        F.count(F.lit(1)).alias("queued"))
    return raw.groupBy("tpa").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("raw_id").alias("ids"), F.count_distinct("file_name").alias("files"),
        F.sum(F.variant_get("raw_data", "$.EVENT_ID", "bigint")).alias("event_sum"),
        F.count(F.variant_get("raw_data", "$.NOTE", "string")).alias("notes")).join(queued, "tpa", "left")


_LOADED = """SELECT 'tpa=' || event_type AS tpa, count(*) AS rows, count(*) AS ids, count(DISTINCT strftime(ts, '%Y-%m-%d')) AS files,
    CAST(sum(event_id) AS BIGINT) AS event_sum, count(CASE WHEN value >= 100 AND value < 200 THEN 1 END) AS notes,
    count(DISTINCT strftime(ts, '%Y-%m-%d')) AS queued FROM events GROUP BY event_type"""


def _provenance(s, d):
    store = Store(s, session.scratch_path(s, "lake"))
    files = [(f, "CSV") for f in csv_files(s, d)]
    load = bronze.load_files(store, landing(s, d), files, as_of())
    return load.inserted.groupBy("stage_name", (F.col("file_size") > 0).alias("sized"), F.col("file_last_modified").isNotNull().alias("dated"),
                                 (F.col("load_timestamp") == as_of()).alias("stamped")).count()


def _stream_once(s, d):
    """Raw rows in four arrivals of one stream, most of them again, the oldest too late: each stays once."""
    source, target, checkpoint = (session.scratch_path(s, p) for p in ("arrivals", "distinct", "stream"))
    rows = raw_claims(s, d).withColumn("arrived", F.timestamp_seconds(F.col("raw_id")))
    last = rows.agg(F.max("raw_id")).first()[0] or 0
    third = F.floor(3 * F.col("raw_id") / (last + 1))
    for new, again in ((0, []), (1, [0]), (2, [1]), (None, [0, 1, 2])):
        arriving = rows.where(third.isin(*again)) if again else rows.limit(0)
        if new is not None:
            arriving = arriving.unionByName(rows.where(third == new))
        arriving.select("file_name", "file_row_number", "tpa", "arrived").write.mode("append").parquet(source)
        stream = s.readStream.schema("file_name string, file_row_number bigint, tpa string, arrived timestamp").parquet(source)
        ingest.stream_distinct(
            stream, ["file_name", "file_row_number"], "arrived", f"{2 * last // 3 + 2} seconds", target, checkpoint
        ).awaitTermination()
    return s.read.parquet(target).groupBy("tpa").agg(F.count(F.lit(1)).alias("rows"))


_STATE = """SELECT 'read' AS what, count(*) AS n FROM claims UNION ALL SELECT 'mark', max(raw_id) + 1 FROM claims
            UNION ALL SELECT 'processed', count(*) FROM kept UNION ALL SELECT 'inserted', count(*) FROM kept UNION ALL SELECT 'updated', 0
            UNION ALL SELECT 'rejected', (SELECT count(*) FROM claims) - count(*) FROM kept
            UNION ALL SELECT 'RULE_VIOLATIONS/Q1', count(*) FROM claims WHERE first_name IS NULL
            UNION ALL SELECT 'RULE_VIOLATIONS/Q2', count(*) FROM claims WHERE first_name IS NOT NULL AND NOT regexp_full_match(provider_npi, '[0-9]{10}')
            UNION ALL SELECT 'quarantined', count(*) FROM claims WHERE first_name IS NOT NULL AND NOT regexp_full_match(provider_npi, '[0-9]{10}')
            UNION ALL SELECT 'RULE_VIOLATIONS/Q3', count(*) FROM claims WHERE first_name IS NOT NULL AND regexp_full_match(provider_npi, '[0-9]{10}') AND billed < 0
            UNION ALL SELECT 'RULE_VIOLATIONS/Q4', count(*) FROM good WHERE status NOT IN ('F', 'O')
            UNION ALL SELECT 'BUSINESS_TRANSFORM/B1', count(*) FROM good UNION ALL SELECT 'STANDARDIZATION/T1', count(*) FROM good
            UNION ALL SELECT 'STANDARDIZATION/T2', count(*) FROM good
            UNION ALL SELECT 'DUPLICATES_REMOVED/D1', count(*) - count(DISTINCT claim_num) FROM good"""


JOBS = {
    "flagship_silver_summary": Query(
        lambda s, d: silver_claims(s, d).groupBy("tpa", "STATUS").agg(
            F.count(F.lit(1)).alias("claims"), F.round(F.sum("TOTAL").cast("double"), 2).alias("total"),
            F.date_format(F.max("SERVICE_DATE"), "yyyy-MM-dd").alias("last_service")).orderBy("tpa", "STATUS"),
        good_sql("""SELECT tpa, lower(status) AS "STATUS", count(*) AS claims, round(sum(CAST(round(billed + 1, 2) AS DECIMAL(18, 2))), 2)::DOUBLE AS total,
            strftime(max(service_date), '%Y-%m-%d') AS last_service FROM kept GROUP BY tpa, lower(status)""")),
    "flagship_silver_rows": Query(lambda s, d: _typed(silver_claims(s, d)), good_sql(_SILVER)),
    "src_09_provenance": Query(
        _provenance, "SELECT 'SRC' AS stage_name, true AS sized, true AS dated, true AS stamped, count(*) AS count FROM events"),
    "job_01_load_queued_files": Query(lambda s, d: _loaded(s, d, False), _LOADED),
    "job_02_silver_batch": Query(lambda s, d: _typed(_batch(s, d).silver("CLAIMS")), good_sql(_SILVER)),
    "job_02_batch_state": Query(lambda s, d: _state(_batch(s, d)), good_sql(_STATE)),
    "job_02_rerun_state": Query(_rerun, good_sql(_STATE.replace(
        "'inserted', count(*) FROM kept UNION ALL SELECT 'updated', 0", "'inserted', 0 UNION ALL SELECT 'updated', count(*) FROM kept"))),
    "str_04_staleness": Query(
        _staleness,
        sql("claims", "SELECT 'RAW_DATA_TABLE_TO_CLAIMS' AS watermark_id, max(raw_id) + 1 AS last_processed_id, 'Current' AS status FROM claims")),
    "job_03_06_drain_and_reset": Query(
        _two_batches,
        sql("claims", """SELECT CAST(1 AS BIGINT) AS batch, 'SUCCESS' AS status, count(*) * 2 // 3 AS records_read FROM claims
            UNION ALL SELECT 2, 'SUCCESS', count(*) - count(*) * 2 // 3 FROM claims UNION ALL SELECT 3, 'SUCCESS', count(*) FROM claims""")),
    "job_04_all_targets": Query(
        _all_targets,
        sql("claims", """SELECT 'CLAIMS' AS target_table, 'SUCCESS' AS status, count(*) AS records_read FROM claims
            UNION ALL SELECT 'UNMAPPED', 'FAILED', 0 UNION ALL SELECT 'ALL', 'PARTIAL_SUCCESS', count(*) FROM claims""")),
    "job_05_discovery_row": Query(
        lambda s, d: silver.discovery_log_row(T.raw(s, d, False), T.schemas(s, d), as_of()).select(
            "status", F.variant_get("processing_metadata", "$.bronze_records", "bigint").alias("bronze_records"),
            F.variant_get("processing_metadata", "$.target_tables", "bigint").alias("target_tables")),
        sql("raw schemas", """SELECT 'SUCCESS' AS status, (SELECT count(*) FROM raw) AS bronze_records,
            (SELECT count(DISTINCT table_name) FROM schemas WHERE active) AS target_tables""")),
    "str_01_next_rows_after_mark": Query(
        lambda s, d: _after_mark(s, d),
        sql("raw watermarks", """SELECT raw_id FROM raw WHERE raw_id > (SELECT min(last_processed_id) FROM watermarks)
            ORDER BY raw_id LIMIT 1000""")),
    "str_02_file_stream": Query(lambda s, d: _loaded(s, d, True), _LOADED),
    "str_03_stream_dedup": Query(
        _stream_once,
        sql("claims", "SELECT 'provider_' || substr(plan_type, 1, 1) AS tpa, count(*) AS rows FROM claims GROUP BY 1")),
}


def _after_mark(s, d):
    raw = T.raw(s, d, False)
    mark = T.watermarks(s, d).agg(F.min("last_processed_id")).first()[0]
    bounds = limits.batch_bounds(raw, "raw_id", mark, 1000) or (0, -1)
    return raw.filter(F.col("raw_id").between(*bounds)).select("raw_id")


QUERIES = {**SOURCES, **SINKS, **TABLES, **JOBS}
