"""Registered queries: projections, joins, aggregates, windows, limits, set operations, functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.functions import dates, dialect, paths, text, variant
from feedmill.operators import aggregates, coverage, dedup, discovery, joins, limits, mapping, quality, rules
from feedmill.operators.merge import diff_rows
from feedmill.plans import reports as R
from feedmill.plans import schema_admin, silver
from feedmill.plans.silver import Mapping
from feedmill.queries import tables as T
from feedmill.queries.tables import Query, as_of, sql, with_text_times as shown
from feedmill.sources.listing import new_files

TS = "'%Y-%m-%d %H:%M:%S'"
NOW = f"TIMESTAMP '{T.AS_OF}'"
V_TEXT = "CASE WHEN tpa <> 'error' AND value <= 400 THEN value END"

# Mapping rows of a small target: provider-specific and global, plain and with expressions.
EVENT_MAPPINGS = [
    Mapping("event_id", "EVENT_ID", None, "CAST(source_value AS NUMBER(18 0))"),
    Mapping("USER_ID", "MEMBER", None, "LPAD(TRIM(source_value), 8, '0')"),
    Mapping("k", "KEY_VALUE", None, None),
    Mapping("k", "KEY_VALUE", "purchase", "'P' || source_value"),
    Mapping("value", "AMOUNT", None, "CAST(source_value AS NUMBER(10 2))"),
    Mapping("FILE_NAME", "SOURCE_FILE_NAME", None, None),
]
EVENT_TYPES = {"EVENT_ID": "bigint", "MEMBER": "string", "KEY_VALUE": "int", "AMOUNT": "double",
               "SOURCE_FILE_NAME": "string"}
_PROJECTED = f"""raw_id AS "EVENT_ID", lpad(CAST(user_id AS VARCHAR), 8, '0') AS "MEMBER",
       CASE WHEN tpa <> 'purchase' THEN CAST(k AS INTEGER) END AS "KEY_VALUE", {V_TEXT} AS "AMOUNT",
       file_name AS "SOURCE_FILE_NAME" """


def _projected(s, d):
    return silver.project(T.raw(s, d), EVENT_MAPPINGS, EVENT_TYPES)


def _projected_text(s, d):
    return silver.project(T.raw(s, d), EVENT_MAPPINGS, None)


PROJECTIONS = {
    "prj_01_path_extraction": Query(
        lambda s, d: T.raw(s, d).select(
            "raw_id",
            variant.read_field(F.col("raw_data"), "event_id", "bigint").alias("event_id"),
            variant.read_field(F.col("raw_data"), "user_id").alias("user_id"),
            variant.read_field(F.col("raw_data"), "value", "double").alias("value"),
            variant.read_field(F.col("raw_data"), "absent").alias("absent")),
        sql("raw", f"""SELECT raw_id, raw_id AS event_id, CASE WHEN tpa <> 'signup' THEN CAST(user_id AS VARCHAR) END AS user_id,
            {V_TEXT} AS value, CAST(NULL AS VARCHAR) AS absent FROM raw""")),
    "prj_02_mapping_projection": Query(
        lambda s, d: _projected(s, d),
        sql("raw", f"SELECT raw_id, tpa, {_PROJECTED} FROM raw")),
    "prj_03_provenance_column": Query(
        lambda s, d: silver.project(T.raw(s, d), [Mapping("FILE_NAME", "SOURCE_FILE_NAME", None, None)]).groupBy(
            "SOURCE_FILE_NAME").count(),
        sql("raw", 'SELECT file_name AS "SOURCE_FILE_NAME", count(*) AS count FROM raw GROUP BY file_name')),
    "prj_04_source_value_expressions": Query(
        lambda s, d: _dated(T.raw(s, d)).select(
            "raw_id",
            *[F.expr(dialect.source_expression("d", logic)).alias(name) for name, logic in (
                ("day_a", "TO_DATE(source_value 'MM-DD-YYYY')"), ("upper_trim", "UPPER(TRIM(source_value))"))],
            F.expr(dialect.source_expression("amt", "CAST(source_value AS NUMBER(10 2))")).cast("double").alias("amount"),
        ).withColumn("day_a", F.date_format("day_a", "yyyy-MM-dd")),
        sql("raw", """SELECT raw_id, strftime(load_timestamp, '%Y-%m-%d') AS day_a,
            strftime(load_timestamp, '%m-%d-%Y') AS upper_trim, value AS amount FROM raw""")),
    "prj_05_multi_alias": Query(
        lambda s, d: T.raw(s, d).select(
            "raw_id", variant.read_first(F.col("raw_data"), ["user_id", "USER_ID", "UserId"]).alias("member")),
        sql("raw", "SELECT raw_id, CAST(user_id AS VARCHAR) AS member FROM raw")),
    "prj_06_mapping_preview": Query(
        lambda s, d: limits.top(_projected(s, d), [F.asc("raw_id")], 20),
        sql("raw", f"SELECT raw_id, tpa, {_PROJECTED} FROM raw ORDER BY raw_id LIMIT 20")),
    "prj_07_conform_types": Query(
        lambda s, d: silver.conform_columns(_projected_text(s, d), EVENT_TYPES).select("raw_id", *EVENT_TYPES),
        sql("raw", f"SELECT raw_id, {_PROJECTED} FROM raw")),
    "prj_07_cast_failures": Query(
        lambda s, d: silver.cast_failures(_projected_text(s, d), EVENT_TYPES),
        sql("raw", """SELECT column_name, data_type, failed_casts FROM (
            SELECT 'EVENT_ID' AS column_name, 'bigint' AS data_type, CAST(0 AS BIGINT) AS failed_casts UNION ALL
            SELECT 'MEMBER', 'string', 0 UNION ALL SELECT 'AMOUNT', 'double', 0 UNION ALL
            SELECT 'SOURCE_FILE_NAME', 'string', 0 UNION ALL
            SELECT 'KEY_VALUE', 'int', count(*) FROM raw WHERE tpa = 'purchase')""")),
    "prj_08_browse_raw": Query(
        lambda s, d: shown(R.browse_raw(
            T.raw(s, d, False).select("raw_id", "file_name", "tpa", "file_row_number", "load_timestamp", "file_size"),
            tpas=["click", "view"], limit=100, offset=50)),
        sql("raw", f"""SELECT raw_id, file_name, tpa, file_row_number, strftime(t, {TS}) AS load_timestamp, file_size FROM (
            SELECT *, load_timestamp AS t FROM raw WHERE tpa IN ('click', 'view')
            ORDER BY load_timestamp DESC, raw_id DESC LIMIT 100 OFFSET 50)""")),
    "prj_09_field_presence": Query(
        lambda s, d: discovery.field_presence(T.raw(s, d), {
            "USER_ID": ["USER_ID", "user_id", "userId", "UserId"], "VALUE": ["VALUE", "value", "Value"],
            "TOOTH_NUMBER": ["TOOTH_NUMBER", "tooth_number"]}),
        sql("raw", f"""SELECT 'USER_ID' AS field_name, count(*) AS row_count FROM raw UNION ALL
            SELECT 'VALUE', count({V_TEXT}) FROM raw UNION ALL SELECT 'TOOTH_NUMBER', 0""")),
    "prj_10_browse_table": Query(
        lambda s, d: shown(R.browse_table(T.claims(s, d), "status = 'F' AND billed > 100000", "raw_id", 50, 10)),
        sql("claims", """SELECT raw_id, claim_num, first_name, last_name, status, plan_type, round(billed, 4) AS billed,
            round(allowed, 4) AS allowed, strftime(service_date, '%Y-%m-%d') AS service_date,
            strftime(paid_date, '%Y-%m-%d') AS paid_date, provider_npi, member_id
            FROM claims WHERE status = 'F' AND billed > 100000 ORDER BY raw_id DESC LIMIT 50 OFFSET 10""")),
    "prj_11_mapping_list": Query(
        lambda s, d: R.list_mappings(T.mappings(s, d), tpa="economy", order="confidence_desc").select(
            "mapping_id", "source_field", "target_table", "target_column", "status"),
        sql("mappings", """SELECT mapping_id, source_field, target_table, target_column,
            CASE WHEN count(*) OVER (PARTITION BY source_field, target_table, target_column, tpa) > 1 THEN 'DUPLICATE'
                 WHEN approved THEN 'APPROVED' ELSE 'PENDING' END AS status FROM mappings WHERE tpa = 'economy'""")),
    "prj_12_rule_list": Query(
        lambda s, d: R.list_rules(T.rules(s, d), "DATA_QUALITY", active=True).select("rule_id", "priority"),
        sql("rules", "SELECT rule_id, priority FROM rules WHERE rule_type = 'DATA_QUALITY' AND active")),
    "prj_13_queue_list": Query(
        lambda s, d: R.list_queue(T.queue(s, d), ["SUCCESS", "FAILED"], ["CSV"], T.raw(s, d, False), "view").select(
            "queue_id", "file_name", "status", "tpa"),
        sql("raw queue", """SELECT queue_id, q.file_name, status, tpa FROM queue q
            JOIN (SELECT DISTINCT file_name, tpa FROM raw) r ON q.file_name = r.file_name
            WHERE status IN ('SUCCESS', 'FAILED') AND file_type = 'CSV' AND tpa = 'view'""")),
    "prj_14_like_filter": Query(
        lambda s, d: T.raw(s, d, False).filter(F.col("file_name").like("%click/1%")).select("raw_id", "file_name"),
        sql("raw", "SELECT raw_id, file_name FROM raw WHERE file_name LIKE '%click/1%'")),
    "pred_01_rule_predicates": Query(
        lambda s, d: T.claims(s, d).select(
            "raw_id",
            *[F.expr(dialect.predicate(c, logic)).alias(n) for n, c, logic in RULE_TEXTS]),
        sql("claims", r"""SELECT raw_id, first_name IS NOT NULL AS p_present, billed >= 0 AS p_amount,
            status IN ('F', 'O') AS p_domain, regexp_full_match(provider_npi, '[0-9]{10}') AS p_npi,
            paid_date IS NOT NULL AND paid_date IS NOT NULL AS p_date, billed BETWEEN 0.01 AND 100000 AS p_range FROM claims""")),
    "pred_02_three_valued_violation": Query(
        lambda s, d: T.claims(s, d).filter(F.expr(f"NOT ({dialect.predicate('allowed', '>= 100000')})")).select("raw_id"),
        sql("claims", "SELECT raw_id FROM claims WHERE NOT (allowed >= 100000)")),
}

RULE_TEXTS = [
    ("p_present", "first_name", "IS NOT NULL"),
    ("p_amount", "billed", ">= 0"),
    ("p_domain", "status", "IN ('F' 'O')"),
    ("p_npi", "provider_npi", "RLIKE '[0-9]{10}'"),
    ("p_date", "paid_date", "IS NOT NULL AND TRY_TO_DATE(paid_date) IS NOT NULL"),
    ("p_range", "billed", "BETWEEN 0.01 AND 100000"),
]


def _dated(raw: DataFrame) -> DataFrame:
    entries = F.create_map(
        F.lit("d"), F.date_format("load_timestamp", "MM-dd-yyyy"), F.lit("amt"), F.col("value").cast("string"))
    return raw.select("raw_id", F.parse_json(F.to_json(entries)).alias("RAW_DATA"))


def _members(s, d):
    return T.load(s, d, "customer").select(F.col("c_custkey").alias("member_id"), "c_mktsegment", "c_nationkey")


JOINS = {
    "join_01_left_distinct_right": Query(
        lambda s, d: joins.queue_with_provider(T.queue(s, d), T.raw(s, d, False)).select("queue_id", "file_name", "tpa"),
        sql("raw queue", """SELECT queue_id, q.file_name, coalesce(r.tpa, 'N/A') AS tpa FROM queue q
            LEFT JOIN (SELECT DISTINCT file_name, tpa FROM raw) r ON q.file_name = r.file_name""")),
    "join_02_listing_with_queue": Query(
        lambda s, d: T.listing(s, d).join(
            T.queue(s, d).select(F.col("file_name").alias("path"), "status"), "path", "left").select("path", "size", "status"),
        sql("listing queue", "SELECT path, size, status FROM listing l LEFT JOIN queue q ON l.path = q.file_name")),
    "join_03_left_join_aggregate": Query(
        lambda s, d: R.provider_usage(T.master(s, d), T.raw(s, d, False)).select("tpa_code", "row_count"),
        sql("master", "SELECT tpa_code, count(*) AS row_count FROM master LEFT JOIN raw ON tpa_code = tpa GROUP BY tpa_code")),
    "join_04_three_way": Query(
        lambda s, d: R.provider_file_status(T.master(s, d), T.raw(s, d, False), T.queue(s, d)).select(
            "tpa_code", "total_files", "failed_files"),
        sql("master queue", """SELECT tpa_code, count(*) AS total_files, count(CASE WHEN status = 'FAILED' THEN 1 END) AS failed_files
            FROM master JOIN raw ON tpa_code = tpa JOIN queue USING (file_name) GROUP BY tpa_code""")),
    "join_05_anti_outer_null": Query(
        lambda s, d: T.raw(s, d, False).join(
            joins.bounded_broadcast(T.master(s, d)), F.col("tpa") == F.col("tpa_code"), "left_anti").groupBy("tpa").count(),
        sql("master", "SELECT tpa, count(*) AS count FROM raw LEFT JOIN master ON tpa = tpa_code WHERE tpa_code IS NULL GROUP BY tpa")),
    "join_06_not_exists": Query(
        lambda s, d: mapping.orphan_mappings(T.mappings(s, d), T.schemas(s, d)).select("mapping_id"),
        sql("schemas mappings", """SELECT mapping_id FROM mappings m WHERE NOT EXISTS (SELECT 1 FROM schemas s
            WHERE s.active AND s.table_name = m.target_table AND s.column_name = m.target_column)""")),
    "join_07_not_in": Query(
        lambda s, d: _new_listing(s, d),
        sql("listing queue", """SELECT path AS file_name, size FROM listing WHERE path NOT IN (
            SELECT file_name FROM queue WHERE status IN ('PENDING', 'PROCESSING', 'SUCCESS') AND file_name IS NOT NULL)""")),
    "join_08_in_subquery": Query(
        lambda s, d: T.queue(s, d).join(
            T.raw(s, d, False).filter("tpa = 'view'").select("file_name").distinct(), "file_name", "left_semi"
        ).select("queue_id"),
        sql("raw queue", "SELECT queue_id FROM queue WHERE file_name IN (SELECT file_name FROM raw WHERE tpa = 'view')")),
    "join_09_exists_in_case": Query(
        lambda s, d: coverage.target_field_status(T.schemas(s, d), T.mappings(s, d)).select(
            "table_name", "column_name", "mapping_status"),
        sql("schemas mappings", """SELECT table_name, column_name, CASE WHEN EXISTS (SELECT 1 FROM mappings m WHERE m.approved
              AND m.target_table = f.table_name AND m.target_column = f.column_name AND m.tpa IS NULL)
            THEN 'Mapped (Global)' ELSE 'Unmapped' END AS mapping_status
            FROM (SELECT DISTINCT table_name, column_name FROM schemas WHERE active) f""")),
    "join_10_inner_equi": Query(
        lambda s, d: T.metrics(s, d).join(T.rules(s, d).select("rule_id", "rule_type"), "rule_id").select(
            "metric_id", "rule_id", "rule_type"),
        sql("metrics rules", "SELECT metric_id, m.rule_id, rule_type FROM metrics m JOIN rules r ON m.rule_id = r.rule_id")),
    "join_11_fields_by_table": Query(
        lambda s, d: coverage.fields_by_table(
            T.mappings(s, d).select(F.col("source_field").alias("source_column")).distinct(), T.schemas(s, d)),
        sql("schemas mappings", """SELECT source_column, target_table FROM
            (SELECT DISTINCT source_field AS source_column FROM mappings),
            (SELECT DISTINCT table_name AS target_table FROM schemas WHERE active)""")),
    "join_12_theta_or": Query(
        lambda s, d: _theta(s, d),
        sql("raw mappings", """SELECT f.tpa, f.field, count(m.mapping_id) AS hits FROM
            (SELECT DISTINCT r.tpa, p.source_field AS field FROM (SELECT DISTINCT lower(p_type) AS tpa FROM part) r
              JOIN mappings p ON p.approved) f
            LEFT JOIN mappings m ON upper(trim(f.field)) = upper(trim(m.source_field)) AND m.approved
              AND (m.tpa = f.tpa OR m.tpa IS NULL) GROUP BY f.tpa, f.field""")),
    "join_13_full_outer_override": Query(
        lambda s, d: joins.effective_mappings(_one_per_slot(T.mappings(s, d)), "economy").select(
            "target_table", "target_column", "source_field", "mapping_source"),
        sql("mappings", """SELECT coalesce(a.target_table, g.target_table) AS target_table,
              coalesce(a.target_column, g.target_column) AS target_column, coalesce(a.source_field, g.source_field) AS source_field,
              CASE WHEN a.mapping_id IS NOT NULL THEN 'TPA-Specific' ELSE 'Global' END AS mapping_source
            FROM (SELECT target_table, target_column, min(mapping_id) AS mapping_id, arg_min(source_field, mapping_id) AS source_field
                  FROM mappings WHERE approved AND tpa = 'economy' GROUP BY ALL) a
            FULL JOIN (SELECT target_table, target_column, min(mapping_id) AS mapping_id, arg_min(source_field, mapping_id) AS source_field
                  FROM mappings WHERE approved AND tpa IS NULL GROUP BY ALL) g
            ON a.target_table = g.target_table AND a.target_column = g.target_column""")),
    "join_14_repeated_keys": Query(
        lambda s, d: joins.with_key_count(T.claims(s, d).select("raw_id", "claim_num"), ["claim_num"]).filter("key_count > 1"),
        sql("claims", """SELECT raw_id, claim_num, n AS key_count FROM (
            SELECT raw_id, claim_num, count(*) OVER (PARTITION BY claim_num) AS n FROM claims) WHERE n > 1""")),
    "join_15_lateral_flatten": Query(
        lambda s, d: variant.fields_of(T.raw(s, d).select("raw_id", "raw_data"), "raw_data").select(
            "raw_id", "field_name", F.col("field_value").try_cast("string").alias("field_value")),
        sql("raw", f"""SELECT raw_id, 'event_id' AS field_name, CAST(raw_id AS VARCHAR) AS field_value FROM raw
            UNION ALL SELECT raw_id, 'k', k FROM raw
            UNION ALL SELECT raw_id, CASE WHEN tpa = 'signup' THEN 'USER_ID' ELSE 'user_id' END, CAST(user_id AS VARCHAR) FROM raw
            UNION ALL SELECT raw_id, 'value', CASE WHEN value <= 400 THEN CAST(value AS VARCHAR) END FROM raw WHERE tpa <> 'error'""")),
    "join_16_metadata_with_catalog": Query(
        lambda s, d: schema_admin.defined_tables(
            T.schemas(s, d), T.mappings(s, d).select(F.col("target_table").alias("table_name"))),
        sql("schemas mappings", """SELECT table_name, count(*) AS column_count,
            table_name IN (SELECT target_table FROM mappings) AS is_created FROM schemas WHERE active GROUP BY table_name""")),
    "join_17_lookup": Query(
        lambda s, d: rules.look_up(
            T.claims(s, d).select("raw_id", "member_id"), "member_id", _members(s, d), "member_id", "c_mktsegment", "segment"),
        sql("claims", """SELECT raw_id, member_id, c_mktsegment AS segment FROM claims
            LEFT JOIN customer ON member_id = c_custkey""")),
    "join_17_referential": Query(
        lambda s, d: rules.missing_references(
            T.claims(s, d).select("raw_id", "member_id"), "member_id", _members(s, d).filter("c_nationkey < 20"), "member_id"),
        sql("claims", "SELECT raw_id, member_id FROM claims WHERE member_id NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20)")),
}


def _one_per_slot(mappings: DataFrame) -> DataFrame:
    return dedup.keep_first(mappings.filter("approved"), ["target_table", "target_column", "tpa"], "mapping_id")


def _new_listing(s, d):
    return new_files(T.listing(s, d).select(F.col("path").alias("file_name"), "size"), T.queue(s, d))


def _theta(s, d):
    """Fields of every provider against mappings of that provider or of all."""
    approved = T.mappings(s, d).filter("approved")
    fields = approved.select(F.col("source_field").alias("field")).distinct()
    same_name = F.upper(F.trim("field")) == F.upper(F.trim("source_field"))
    found = fields.join(approved.select("source_field", F.col("tpa").alias("_tpa"), "mapping_id"), same_name)
    # hits of all providers and of one are counted apart; fields are listed per provider, as asked, after that
    everywhere = found.filter("_tpa IS NULL").groupBy("field").agg(F.count("mapping_id").alias("_all"))
    own = found.filter("_tpa IS NOT NULL").groupBy(F.col("_tpa").alias("tpa"), "field").agg(F.count("mapping_id").alias("_own"))
    tpas = T.load(s, d, "part").agg(F.collect_set(F.lower("p_type")).alias("tpas")).scalar()
    listed = fields.join(everywhere, "field", "left").withColumn("_tpas", tpas)
    listed = listed.withColumn("tpa", F.explode("_tpas")).join(own, ["tpa", "field"], "left")
    return listed.select("tpa", "field", (F.coalesce("_all", F.lit(0)) + F.coalesce("_own", F.lit(0))).alias("hits"))


AGGREGATES = {
    "agg_01_basic": Query(
        lambda s, d: shown(T.load(s, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
            F.count(F.lit(1)).alias("rows"), F.sum("l_quantity").alias("total"), F.avg("l_quantity").alias("mean"),
            F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high"))),
        """SELECT l_returnflag, l_linestatus, count(*) AS rows, round(sum(l_quantity), 4) AS total, round(avg(l_quantity), 4) AS mean,
           min(l_extendedprice) AS low, max(l_extendedprice) AS high FROM lineitem GROUP BY ALL"""),
    "agg_02_conditional": Query(
        lambda s, d: T.load(s, d, "lineitem").groupBy("l_linestatus").agg(
            F.count_if(F.col("l_discount") > 0.05).alias("discounted"),
            F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("returned")),
        """SELECT l_linestatus, count(CASE WHEN l_discount > CAST(0.05 AS DOUBLE) THEN 1 END) AS discounted,
           CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned FROM lineitem GROUP BY l_linestatus"""),
    "agg_03_distinct_counts": Query(
        lambda s, d: aggregates.distinct_counts(
            T.load(s, d, "lineitem"), ["l_returnflag"], ["l_orderkey", "l_partkey", "l_suppkey"]),
        """SELECT l_returnflag, count(DISTINCT l_orderkey) AS distinct_l_orderkey, count(DISTINCT l_partkey) AS distinct_l_partkey,
           count(DISTINCT l_suppkey) AS distinct_l_suppkey FROM lineitem GROUP BY l_returnflag"""),
    "agg_03_multi_column_key": Query(
        lambda s, d: dedup.duplicate_count(T.load(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]),
        """SELECT (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS duplicate_count"""),
    "agg_04_conditional_distinct": Query(
        lambda s, d: aggregates.distinct_when(T.load(s, d, "lineitem"), ["l_returnflag"], "l_discount > 0.05", "l_partkey"),
        """SELECT l_returnflag, count(DISTINCT CASE WHEN l_discount > CAST(0.05 AS DOUBLE) THEN l_partkey END) AS distinct_matching,
           count(DISTINCT CASE WHEN NOT l_discount > CAST(0.05 AS DOUBLE) THEN l_partkey END) AS distinct_other
           FROM lineitem GROUP BY l_returnflag"""),
    "agg_05_mode": Query(
        lambda s, d: aggregates.most_frequent(T.load(s, d, "lineitem"), ["l_suppkey"], "l_linenumber", "usual_line"),
        """SELECT l_suppkey, l_linenumber AS usual_line FROM (SELECT l_suppkey, l_linenumber,
           row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_linenumber) AS rn
           FROM lineitem GROUP BY l_suppkey, l_linenumber) WHERE rn = 1"""),
    "agg_06_sorted_array": Query(
        lambda s, d: shown(aggregates.sorted_values(T.load(s, d, "customer"), ["c_nationkey"], "c_mktsegment", "segments")),
        "SELECT c_nationkey, array_to_string(list_sort(list(DISTINCT c_mktsegment)), '|') AS segments FROM customer GROUP BY c_nationkey"),
    "agg_07_listagg": Query(
        lambda s, d: aggregates.listed_values(T.load(s, d, "part"), ["p_brand"], "p_type", "types"),
        "SELECT p_brand, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS types FROM part GROUP BY p_brand"),
    "agg_08_having": Query(
        lambda s, d: T.load(s, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
            F.count(F.lit(1)).alias("n")).filter("n > 1"),
        "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1"),
    "agg_09_scalar_subquery": Query(
        lambda s, d: _share_of_total(s, d),
        """SELECT l_returnflag, count(*) AS n, round(count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM lineitem), 4) AS pct
           FROM lineitem GROUP BY l_returnflag"""),
    "agg_10_outlier_share": Query(
        lambda s, d: shown(quality.outliers(T.load(s, d, "orders"), "o_totalprice", 1.5)),
        """SELECT count(CASE WHEN o_totalprice > lim THEN 1 END) AS outliers,
           round(count(CASE WHEN o_totalprice > lim THEN 1 END) * CAST(100 AS DOUBLE) / count(*), 4) AS outlier_pct
           FROM orders, (SELECT avg(o_totalprice) + CAST(1.5 AS DOUBLE) * stddev_samp(o_totalprice) AS lim FROM orders)"""),
    "agg_11_distinct": Query(
        lambda s, d: T.load(s, d, "lineitem").select("l_suppkey", "l_returnflag").distinct(),
        "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem"),
    "agg_12_null_profile": Query(
        lambda s, d: shown(quality.null_profile(T.claims(s, d), ["first_name", "allowed", "paid_date", "claim_num"])),
        sql("claims", """SELECT column_name, null_count, row_count,
            round((row_count - null_count) * CAST(100 AS DOUBLE) / row_count, 4) AS completeness_pct FROM (
            SELECT 'first_name' AS column_name, count(*) - count(first_name) AS null_count, count(*) AS row_count FROM claims
            UNION ALL SELECT 'allowed', count(*) - count(allowed), count(*) FROM claims
            UNION ALL SELECT 'paid_date', count(*) - count(paid_date), count(*) FROM claims
            UNION ALL SELECT 'claim_num', count(*) - count(claim_num), count(*) FROM claims)""")),
}


def _share_of_total(s, d):
    li = T.load(s, d, "lineitem")
    total = li.agg(F.count(F.lit(1)).alias("n")).scalar()
    counted = li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("pct", F.round(F.col("n") * 100.0 / total, 4))


WINDOWS = {
    "win_01_keep_first": Query(
        lambda s, d: dedup.keep_first(T.claims(s, d), ["claim_num"]).select("raw_id", "claim_num"),
        sql("claims", "SELECT min(raw_id) AS raw_id, claim_num FROM claims GROUP BY claim_num")),
    "win_02_keep_last": Query(
        lambda s, d: dedup.keep_last(T.claims(s, d), ["claim_num"]).select("raw_id", "claim_num"),
        sql("claims", "SELECT max(raw_id) AS raw_id, claim_num FROM claims GROUP BY claim_num")),
    "win_03_latest_row_per_file": Query(
        lambda s, d: dedup.keep_one(T.raw(s, d, False), ["file_name"], [F.desc("load_timestamp"), F.desc("raw_id")]).select(
            "file_name", "raw_id"),
        sql("raw", """SELECT file_name, raw_id FROM raw
            QUALIFY row_number() OVER (PARTITION BY file_name ORDER BY load_timestamp DESC, raw_id DESC) = 1""")),
    "win_04_rank_top_n": Query(
        lambda s, d: dedup.top_per_group(
            T.claims(s, d).select("member_id", "raw_id", "billed"), ["member_id"], [F.desc("billed"), F.asc("raw_id")], 3
        ).select("member_id", "raw_id", "match_rank"),
        sql("claims", """SELECT member_id, raw_id, CAST(rn AS INTEGER) AS match_rank FROM (SELECT *,
            row_number() OVER (PARTITION BY member_id ORDER BY billed DESC, raw_id) AS rn FROM claims) WHERE rn <= 3""")),
    "win_05_mark_duplicates": Query(
        lambda s, d: dedup.mark_duplicates(
            T.mappings(s, d).select("mapping_id", "source_field", "target_table", "target_column", "tpa"),
            ["source_field", "target_table", "target_column", "tpa"]).select("mapping_id", "is_duplicate"),
        sql("mappings", """SELECT mapping_id, count(*) OVER (PARTITION BY source_field, target_table, target_column, tpa) > 1
            AS is_duplicate FROM mappings""")),
    "win_06_best_per_group": Query(
        lambda s, d: dedup.keep_one(T.mappings(s, d), ["source_field"], [F.desc("confidence_score"), F.asc("mapping_id")]).select(
            "source_field", "mapping_id", "confidence_score"),
        sql("mappings", """SELECT source_field, mapping_id, confidence_score FROM mappings
            QUALIFY row_number() OVER (PARTITION BY source_field ORDER BY confidence_score DESC, mapping_id) = 1""")),
}

LIMITS = {
    "lim_01_sort_limit": Query(
        lambda s, d: limits.top(T.queue(s, d).filter("status = 'PENDING'"), [F.asc("discovered_timestamp"), F.asc("queue_id")], 10)
        .select("queue_id", "file_name"),
        sql("queue", """SELECT queue_id, file_name FROM queue WHERE status = 'PENDING'
            ORDER BY discovered_timestamp, queue_id LIMIT 10""")),
    "lim_02_next_batch": Query(
        lambda s, d: _next_batch(s, d),
        sql("claims", "SELECT raw_id, claim_num FROM claims WHERE raw_id > 999 ORDER BY raw_id LIMIT 500")),
    "lim_03_page": Query(
        lambda s, d: limits.page(T.raw(s, d, False), [F.desc("load_timestamp"), F.desc("raw_id")], 25, 100).select("raw_id"),
        sql("raw", "SELECT raw_id FROM raw ORDER BY load_timestamp DESC, raw_id DESC LIMIT 25 OFFSET 100")),
    "lim_04_custom_rank": Query(
        lambda s, d: limits.top(
            T.metrics(s, d),
            [F.when(F.col("pass_fail") == "FAIL", 1).when(F.col("pass_fail") == "WARNING", 2).otherwise(3),
             F.desc_nulls_last("measurement_timestamp")], 60).select("metric_id", "pass_fail"),
        sql("metrics", """SELECT metric_id, pass_fail FROM metrics ORDER BY
            CASE pass_fail WHEN 'FAIL' THEN 1 WHEN 'WARNING' THEN 2 ELSE 3 END, measurement_timestamp DESC NULLS LAST LIMIT 60""")),
}


def _next_batch(s, d):
    claims = T.claims(s, d).select("raw_id", "claim_num")
    first, last = limits.batch_bounds(claims, "raw_id", 999, 500) or (0, -1)
    return claims.filter(F.col("raw_id").between(first, last))


SETS = {
    "set_01_union_all": Query(
        lambda s, d: reduce(DataFrame.unionByName, [
            T.load(s, d, t).groupBy().agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n")
            for t in ("orders", "lineitem", "events")]),
        """SELECT 'orders' AS table_name, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
           UNION ALL SELECT 'events', count(*) FROM events"""),
    "set_02_difference": Query(
        lambda s, d: diff_rows(
            T.schemas(s, d).filter("nullable"), T.schemas(s, d).filter("active").withColumn(
                "data_type", F.when(F.col("default_value").isNotNull(), "DATE").otherwise(F.col("data_type"))),
            "schema_id", ["column_name", "data_type"]),
        sql("schemas", """SELECT * FROM (SELECT CASE WHEN o.schema_id IS NULL THEN 'I' WHEN n.schema_id IS NULL THEN 'D'
              WHEN o.data_type <> n.data_type THEN 'U' END AS op, coalesce(o.schema_id, n.schema_id) AS schema_id,
              n.column_name, n.data_type
            FROM (SELECT * FROM schemas WHERE nullable) o FULL JOIN (SELECT schema_id, column_name,
              CASE WHEN default_value IS NOT NULL THEN 'DATE' ELSE data_type END AS data_type FROM schemas WHERE active) n
            ON o.schema_id = n.schema_id) WHERE op IS NOT NULL""")),
    "set_03_word_sets": Query(
        lambda s, d: _word_sets(s, d),
        """SELECT p_partkey, CAST(len(list_intersect(w, t)) AS INTEGER) AS shared,
             CAST(len(list_distinct(list_concat(w, t))) AS INTEGER) AS total
           FROM (SELECT p_partkey, list_distinct(string_split(p_name, ' ')) AS w,
             list_distinct(string_split(lower(p_type) || ' ' || split_part(p_name, ' ', 1), ' ')) AS t FROM part)"""),
}


def _word_sets(s, d):
    words = F.array_distinct(F.split("p_name", " "))
    other = F.array_distinct(F.split(F.concat(F.lower("p_type"), F.lit(" "), F.split("p_name", " ")[0]), " "))
    return T.load(s, d, "part").select(
        "p_partkey", F.size(F.array_intersect(words, other)).alias("shared"), F.size(F.array_union(words, other)).alias("total"))


FUNCTIONS = {
    "fn_01_case_trim": Query(
        lambda s, d: T.load(s, d, "part").select(
            "p_partkey", F.upper("p_name").alias("u"), F.lower("p_type").alias("l"),
            F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("t"),
            F.expr(dialect.standard_expression("p_type", "PROPER")).alias("p")),
        """SELECT p_partkey, upper(p_name) AS u, lower(p_type) AS l, trim('  ' || p_name || ' ') AS t,
           upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS p FROM part"""),
    "fn_02_text": Query(
        lambda s, d: T.load(s, d, "customer").select(
            F.concat("c_name", F.lit("/"), "c_mktsegment").alias("joined"), F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("padded"),
            F.repeat(F.lit("="), 5).alias("line"), F.replace("c_name", F.lit("#"), F.lit("-")).alias("replaced"),
            F.substring("c_name", 3, 4).alias("part"), F.length("c_mktsegment").alias("len")),
        """SELECT c_name || '/' || c_mktsegment AS joined, lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS padded, '=====' AS line,
           replace(c_name, '#', '-') AS replaced, substr(c_name, 3, 4) AS part, CAST(length(c_mktsegment) AS INTEGER) AS len FROM customer"""),
    "fn_03_regex": Query(
        lambda s, d: T.load(s, d, "customer").select(
            "c_custkey", text.matches_whole(F.col("c_name"), "Customer#[0-9]+5").alias("whole"),
            (~F.col("c_name").rlike("0$")).alias("not_zero"), F.regexp_substr("c_name", F.lit("[1-9][0-9]*")).alias("digits"),
            F.regexp_replace("c_name", "([a-z]+)#0*", "$1:").alias("short")),
        r"""SELECT c_custkey, regexp_full_match(c_name, 'Customer#[0-9]+5') AS whole, NOT regexp_matches(c_name, '0$') AS not_zero,
           CASE WHEN regexp_matches(c_name, '[1-9]') THEN regexp_extract(c_name, '[1-9][0-9]*') END AS digits,
           regexp_replace(c_name, '([a-z]+)#0*', '\1:') AS short FROM customer"""),
    "fn_04_like": Query(
        lambda s, d: T.queue(s, d).select(
            "queue_id", F.col("process_result").like("%rows%").alias("has_rows"),
            F.col("process_result").startswith("SUCCESS").alias("ok")),
        sql("queue", "SELECT queue_id, process_result LIKE '%rows%' AS has_rows, starts_with(process_result, 'SUCCESS') AS ok FROM queue")),
    "fn_05_paths": Query(
        lambda s, d: T.load(s, d, "pages").select(
            "page_id", F.element_at(F.split("url", "/"), -1).alias("last"), paths.provider(F.col("url")).alias("folder"),
            F.substring_index("url", ".", 1).alias("before_dot"), paths.extension(F.col("url")).alias("ext")),
        r"""SELECT page_id, string_split(url, '/')[-1] AS last, string_split(url, '/')[-2] AS folder,
           split_part(url, '.', 1) AS before_dot, lower(regexp_extract(url, '\.([^./]+)$', 1)) AS ext FROM pages"""),
    "fn_06_edit_similarity": Query(
        lambda s, d: T.load(s, d, "part").select(
            "p_partkey", F.round(text.edit_similarity(F.col("p_name"), F.lower("p_type")), 4).alias("similarity")),
        """SELECT p_partkey, round(1 - CAST(levenshtein(p_name, lower(p_type)) AS DOUBLE)
           / greatest(length(p_name), length(p_type)), 4) AS similarity FROM part"""),
    "fn_07_clock": Query(
        lambda s, d: T.load(s, d, "orders").select(
            (F.col("o_orderdate") <= F.current_date()).alias("past"), (F.length(F.current_user()) > 0).alias("named")
        ).groupBy("past", "named").count(),
        "SELECT CAST(o_orderdate AS DATE) <= current_date AS past, true AS named, count(*) AS count FROM orders GROUP BY ALL"),
    "fn_08_date_arithmetic": Query(
        lambda s, d: T.load(s, d, "events").select(
            "event_id",
            *[dates.boundary_diff(u, F.col("ts"), as_of()).alias(f"{u}s") for u in ("second", "hour", "day", "month", "year")],
            F.date_format(F.col("ts") - F.expr("INTERVAL 30 DAYS"), "yyyy-MM-dd HH:mm:ss").alias("earlier")),
        f"""SELECT event_id, date_diff('second', ts, {NOW}) AS seconds, date_diff('hour', ts, {NOW}) AS hours,
            date_diff('day', ts, {NOW}) AS days, date_diff('month', ts, {NOW}) AS months, date_diff('year', ts, {NOW}) AS years,
            strftime(ts - INTERVAL 30 DAY, {TS}) AS earlier FROM events"""),
    "fn_09_parse_format_dates": Query(
        lambda s, d: T.load(s, d, "orders").select(
            "o_orderkey",
            F.date_format(F.try_to_date(F.date_format("o_orderdate", dates.spark_pattern("MM-DD-YYYY")),
                                        dates.spark_pattern("MM-DD-YYYY")), "yyyyMMdd").alias("day"),
            F.try_to_date(F.col("o_orderpriority"), dates.spark_pattern("YYYY-MM-DD")).isNull().alias("unreadable"),
            F.date_format("o_orderdate", dates.spark_pattern("YYYYMMDD_HH24MISS")).alias("stamp")),
        """SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS day, true AS unreadable,
           strftime(o_orderdate, '%Y%m%d_%H%M%S') AS stamp FROM orders"""),
    "fn_10_multi_format_dates": Query(
        lambda s, d: T.load(s, d, "orders").select(
            "o_orderkey",
            F.date_format(dates.parse_any_date(
                F.when(F.col("o_orderkey") % 4 == 0, F.date_format("o_orderdate", "MM-dd-yyyy"))
                .when(F.col("o_orderkey") % 4 == 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
                .when(F.col("o_orderkey") % 4 == 2, F.date_format("o_orderdate", "MM/dd/yyyy"))
                .otherwise("not a date")), "yyyy-MM-dd").alias("day")),
        "SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders"),
    "fn_11_conditional": Query(
        lambda s, d: T.claims(s, d).select(
            "raw_id", F.coalesce("first_name", F.lit("?")).alias("name"), F.nullif("status", F.lit("P")).alias("status"),
            F.when(F.col("billed") < 0, "credit").when(F.col("billed") < 100000, "small").otherwise("large").alias("band")),
        sql("claims", """SELECT raw_id, coalesce(first_name, '?') AS name, nullif(status, 'P') AS status,
            CASE WHEN billed < 0 THEN 'credit' WHEN billed < 100000 THEN 'small' ELSE 'large' END AS band FROM claims""")),
    "fn_12_numeric": Query(
        lambda s, d: T.load(s, d, "lineitem").select(
            F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 100 + 1e-5, 0).cast("bigint").alias("net"),
            F.greatest("l_quantity", F.lit(25.0)).alias("at_least"), F.col("l_quantity").between(10, 20).alias("mid")
        ).groupBy("at_least", "mid").agg(F.count(F.lit(1)).alias("n"), F.sum("net").alias("net_cents")),
        """SELECT greatest(l_quantity, CAST(25 AS DOUBLE)) AS at_least, l_quantity BETWEEN 10 AND 20 AS mid, count(*) AS n,
           CAST(sum(CAST(round(l_extendedprice * (1 - l_discount) * 100 + 1e-5, 0) AS BIGINT)) AS BIGINT) AS net_cents FROM lineitem GROUP BY ALL"""),
    "fn_13_safe_casts": Query(
        lambda s, d: T.claims(s, d).select(
            "raw_id", F.col("status").try_cast("int").alias("bad"), F.col("provider_npi").try_cast("bigint").alias("npi"),
            F.col("billed").try_cast("decimal(15,2)").cast("double").alias("amount"),
            text.parse_flag(F.when(F.col("status") == "F", "yes").otherwise(F.col("status"))).alias("flag")),
        sql("claims", """SELECT raw_id, TRY_CAST(status AS INTEGER) AS bad, TRY_CAST(provider_npi AS BIGINT) AS npi,
            round(billed, 2) AS amount, status = 'F' AS flag FROM claims""")),
    "fn_14_json_build": Query(
        lambda s, d: T.load(s, d, "customer").select(
            "c_custkey", F.to_json(variant.row_object("c_name", "c_nationkey")).alias("obj"),
            F.to_json(F.try_parse_json(F.concat(F.lit('{"n": '), "c_nationkey", F.lit("}")))).alias("parsed"),
            F.to_json(F.try_parse_json("c_mktsegment")).alias("bad")),
        """SELECT c_custkey, '{"c_name":"' || c_name || '","c_nationkey":' || CAST(c_nationkey AS VARCHAR) || '}' AS obj,
           '{"n":' || CAST(c_nationkey AS VARCHAR) || '}' AS parsed, CAST(NULL AS VARCHAR) AS bad FROM customer"""),
    "fn_15_json_inspect": Query(
        lambda s, d: variant.fields_of(T.raw(s, d).select("tpa", "raw_data"), "raw_data").groupBy(
            "tpa", "field_name", variant.field_type(F.col("field_value")).alias("type")).agg(F.count(F.lit(1)).alias("n")),
        sql("raw", """SELECT tpa, 'event_id' AS field_name, 'STRING' AS type, count(*) AS n FROM raw GROUP BY tpa
            UNION ALL SELECT tpa, 'k', 'STRING', count(*) FROM raw GROUP BY tpa
            UNION ALL SELECT tpa, CASE WHEN tpa = 'signup' THEN 'USER_ID' ELSE 'user_id' END, 'STRING', count(*) FROM raw GROUP BY tpa
            UNION ALL SELECT tpa, 'value', CASE WHEN value <= 400 THEN 'STRING' ELSE 'VOID' END, count(*) FROM raw
              WHERE tpa <> 'error' GROUP BY ALL""")),
    "fn_16_array_ops": Query(
        lambda s, d: T.quarantine(s, d).select(
            F.array_join(F.array_sort(F.array_distinct("failed_rules")), "|").alias("rules"),
            F.array_contains("failed_rules", "R7").alias("has_r7")).groupBy("rules", "has_r7").count(),
        sql("quarantine", """SELECT array_to_string(list_sort(list_distinct(failed_rules)), '|') AS rules,
            list_contains(failed_rules, 'R7') AS has_r7, count(*) AS count FROM quarantine GROUP BY ALL""")),
    "fn_17_batch_id": Query(
        lambda s, d: T.log(s, d).select("start_timestamp", text.batch_id(F.col("start_timestamp")).alias("id")).select(
            F.date_format("start_timestamp", "yyyyMMdd_HHmmss").alias("at"),
            F.substring("id", 1, 22).alias("head"), F.col("id").rlike("^BATCH_[0-9]{8}_[0-9]{6}_[0-9a-f]{8}$").alias("shaped")),
        sql("log", """SELECT strftime(start_timestamp, '%Y%m%d_%H%M%S') AS at,
            'BATCH_' || strftime(start_timestamp, '%Y%m%d_%H%M%S') || '_' AS head, true AS shaped FROM log""")),
    "fn_18_codes_phones": Query(
        lambda s, d: T.claims(s, d).select(
            "raw_id", text.map_codes(F.col("status"), {"OPEN": ["O", "P"], "FINAL": ["F"]}).alias("status"),
            text.format_phone(F.concat(F.lit("+"), "provider_npi")).alias("phone")),
        sql("claims", r"""SELECT raw_id, CASE WHEN status IN ('O', 'P') THEN 'OPEN' WHEN status = 'F' THEN 'FINAL' ELSE status END AS status,
            regexp_replace(provider_npi, '([0-9]{3})([0-9]{3})([0-9]{4})', '(\1) \2-\3') AS phone FROM claims""")),
    "udf_01_sql_function": Query(
        lambda s, d: _batch_ids(s, d),
        sql("log", """SELECT 'BATCH_' || strftime(start_timestamp, '%Y%m%d_%H%M%S') AS head, count(*) AS n FROM log GROUP BY 1""")),
    "udf_02_function_in_rule": Query(
        lambda s, d: _phone_rule(s, d),
        sql("claims", r"""SELECT raw_id, regexp_replace(provider_npi, '([0-9]{3})([0-9]{3})([0-9]{4})', '(\1) \2-\3') AS provider_npi
            FROM claims""")),
}


def _batch_ids(s, d):
    text.register_sql_functions(s)
    return T.log(s, d).select(F.substring(F.expr("generate_batch_id(start_timestamp)"), 1, 21).alias("head")).groupBy(
        "head").agg(F.count(F.lit(1)).alias("n"))


def _phone_rule(s, d):
    text.register_sql_functions(s)
    claims = T.claims(s, d).select("raw_id", "provider_npi")
    rule = rules.Rule("STD1", "Format phone", rules.STANDARD, None, "provider_npi", None,
                      "format_phone(source_value)", {}, 20, "LOG")
    return rules.apply_standard_rules(claims, [rule]).rows


QUERIES = {**PROJECTIONS, **JOINS, **AGGREGATES, **WINDOWS, **LIMITS, **SETS, **FUNCTIONS}
