"""Registered queries: rules engine and quality metrics over claim rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.operators import dedup, joins, quality as Q, rules as E
from feedmill.plans import silver
from feedmill.queries import tables as T
from feedmill.queries.tables import Query, as_of, sql, with_text_times as shown

# (rule_id, type, column, provider, logic, parameters, priority, action)
QUALITY_RULES = [
    ("Q1", "DATA_QUALITY", "first_name", None, "IS NOT NULL", None, 10, "REJECT"),
    ("Q2", "DATA_QUALITY", "provider_npi", None, "RLIKE '[0-9]{10}'", None, 20, "QUARANTINE"),
    ("Q3", "DATA_QUALITY", "billed", None, ">= 0", None, 30, "REJECT"),
    ("Q4", "DATA_QUALITY", "status", None, "IN ('F', 'O')", None, 40, "LOG"),
    ("Q5", "DATA_QUALITY", "paid_date", None, "IS NOT NULL", None, 50, "FLAG"),
    ("Q6", "DATA_QUALITY", "no_such_column", None, "IS NOT NULL", None, 60, "REJECT"),
    ("Q7", "DATA_QUALITY", "allowed", None, "<= 200000", None, 70, "QUARANTINE"),
]

# texts that do not parse, that are whole conditions, or that start like an operator
ODD_RULES = [
    ("X1", "DATA_QUALITY", "billed", None, ">= (0", None, 80, "REJECT"),
    ("X2", "DATA_QUALITY", "status", None, "INSTR(status, 'F') = 0", None, 81, "LOG"),
    ("X3", "DATA_QUALITY", "billed", None, "NOT (billed < 0)", None, 82, "LOG"),
]

_VERDICT = """v AS (SELECT *, first_name IS NULL AS v1, NOT regexp_full_match(provider_npi, '[0-9]{10}') AS v2, billed < 0 AS v3,
    status NOT IN ('F', 'O') AS v4, paid_date IS NULL AS v5, coalesce(allowed > 200000, false) AS v7 FROM claims),
a AS (SELECT *, CASE WHEN v1 THEN 1 WHEN v2 THEN 2 WHEN v3 THEN 3 WHEN v7 THEN 7 END AS gone FROM v)"""


def rule_frame(spark, rows) -> DataFrame:
    return spark.createDataFrame(
        [(i, f"Rule {i}", t, "CLAIMS", c, p, l, q, n, a, True) for i, t, c, p, l, q, n, a in rows],
        "rule_id string, rule_name string, rule_type string, target_table string, target_column string, tpa string, "
        "rule_logic string, rule_parameters string, priority int, error_action string, active boolean",
    )


def rule_list(spark, rows) -> list[E.Rule]:
    return E.active_rules(rule_frame(spark, rows), "CLAIMS")


def verdict(body: str) -> str:
    return sql("claims", "").rstrip() + ",\n" + _VERDICT + "\n" + body


def _checked(s, d):
    return E.apply_quality_rules(T.claims(s, d), rule_list(s, QUALITY_RULES), "CLAIMS")


def _metric(k: int) -> str:
    return f"count(CASE WHEN v{k} AND (gone IS NULL OR gone >= {k}) THEN 1 END)"


_METRIC_SQL = " UNION ALL ".join(
    f"SELECT 'Q{k}' AS rule_id, 'RULE_VIOLATIONS' AS metric_type, CAST({_metric(k)} AS DOUBLE) AS metric_value, "
    f"CASE WHEN {_metric(k)} = 0 THEN 'PASS' ELSE 'FAIL' END AS pass_fail FROM a" for k in (1, 2, 3, 4, 5, 7)
) + " UNION ALL SELECT 'Q6', 'RULE_ERROR', 0, 'FAIL'"

PARAMETER_RULES = [
    ("P1", "DATA_QUALITY", "provider_npi", None, None, '{"pattern": "[0-9]{10}"}', 10, "LOG"),
    ("P2", "DATA_QUALITY", "billed", None, None, '{"min": 0, "max": 300000}', 20, "LOG"),
    ("P3", "DATA_QUALITY", "status", None, None, '{"values": ["F", "O"]}', 30, "LOG"),
    ("P4", "DATA_QUALITY", "plan_type", None, None, '{"max_length": 8}', 40, "LOG"),
    ("P5", "DATA_QUALITY", "service_text", None, None, '{"date_format": "MM-DD-YYYY"}', 50, "LOG"),
]

REFERENCE_RULES = [
    ("F1", "REFERENTIAL_INTEGRITY", "member_id", None, None,
     '{"reference_table": "members", "reference_column": "c_custkey"}', 10, "QUARANTINE"),
    ("F2", "REFERENTIAL_INTEGRITY", "service_date", None, None, '{"not_after": "paid_date"}', 20, "LOG"),
]

FIXING_RULES = [
    ("C1", "DATA_QUALITY", "billed", None, ">= 0", '{"correction": "billed + 300000"}', 10, "CORRECT"),
    ("C2", "DATA_QUALITY", "first_name", None, "IS NOT NULL", None, 20, "FLAG"),
    ("C3", "DATA_QUALITY", "allowed", None, "IS NOT NULL", None, 30, "FLAG"),
]

PROVIDER_RULES = [
    ("G1", "DATA_QUALITY", "billed", None, ">= 100000", None, 10, "REJECT"),
    ("S1", "DATA_QUALITY", "billed", "F", ">= 0", None, 10, "REJECT"),
]

PROVIDER_DEDUP_RULES = [
    ("DF", "DEDUPLICATION", None, "F", "member_id", '{"strategy": "KEEP_FIRST"}', 10, "LOG"),
    ("DG", "DEDUPLICATION", None, None, "claim_num, status", '{"strategy": "KEEP_LAST"}', 20, "LOG"),
]

BUSINESS_RULES = [
    ("B1", "BUSINESS_LOGIC", "patient_pays", None, "COALESCE(billed, 0) - COALESCE(allowed, 0)", None, 10, "LOG"),
    ("B2", "BUSINESS_LOGIC", "pays_twice", None, "patient_pays * 2", None, 20, "LOG"),
    ("B3", "BUSINESS_LOGIC", "broken", None, "nothing_here + 1", None, 30, "LOG"),
]

STANDARD_RULES = [
    ("T1", "STANDARDIZATION", "first_name", None, "UPPER", None, 10, "LOG"),
    ("T2", "STANDARDIZATION", "plan_type", None, "LOWER(TRIM(plan_type))", None, 20, "LOG"),
    ("T3", "STANDARDIZATION", "status", None, "CASE WHEN status IN ('O', 'P') THEN 'OPEN' ELSE 'FINAL' END", None, 30, "LOG"),
]


def _dedup(s, d, strategy: str, key: str = "claim_num") -> tuple:
    rule = rule_list(s, [("D1", "DEDUPLICATION", None, None, key, f'{{"strategy": "{strategy}"}}', 10, "LOG")])
    return E.apply_dedup_rules(T.claims(s, d), rule, "CLAIMS")


def _by_provider(s, d):
    claims = T.claims(s, d).withColumn("tpa", F.col("status"))
    return E.apply_quality_rules(claims, rule_list(s, PROVIDER_RULES), "CLAIMS").survivors().select("raw_id", "tpa")


def _referential(s, d):
    members = T.load(s, d, "customer").filter("c_nationkey < 20")
    return E.apply_quality_rules(
        T.claims(s, d), rule_list(s, REFERENCE_RULES), "CLAIMS", {"members": members})


def _fixed(s, d):
    return E.apply_quality_rules(T.claims(s, d), rule_list(s, FIXING_RULES), "CLAIMS").survivors()


def _fuzzy(s, d):
    c = T.load(s, d, "customer").select(
        F.col("c_custkey").alias("raw_id"), "c_nationkey", "c_mktsegment", F.col("c_name").alias("name"))
    return dedup.drop_fuzzy_duplicates(c, "name", ["c_nationkey", "c_mktsegment"], 0.85, "raw_id", "LAST")


RULES = {
    "rule_01_active_rules": Query(
        lambda s, d: T.rules(s, d).filter("active AND rule_type = 'DATA_QUALITY'").select("rule_id", "priority").orderBy("priority", "rule_id"),
        sql("rules", "SELECT rule_id, priority FROM rules WHERE active AND rule_type = 'DATA_QUALITY'")),
    "rule_02_quality_metrics": Query(
        lambda s, d: _checked(s, d).metrics().select("rule_id", "metric_type", "metric_value", "pass_fail"),
        verdict(_METRIC_SQL)),
    "rule_03_survivors": Query(
        lambda s, d: _checked(s, d).survivors().select("raw_id", "claim_num"),
        verdict("SELECT raw_id, claim_num FROM a WHERE gone IS NULL")),
    "rule_03_rejected": Query(
        lambda s, d: _checked(s, d).rejected().groupBy("_removed_at").agg(F.count(F.lit(1)).alias("n")).select(
            F.concat(F.lit("Q"), F.col("_removed_at") + 1).alias("rule_id"), "n"),
        verdict("SELECT 'Q' || CAST(gone AS VARCHAR) AS rule_id, count(*) AS n FROM a WHERE gone IS NOT NULL GROUP BY gone")),
    "rule_04_quarantine_records": Query(
        lambda s, d: _checked(s, d).quarantined().select(
            F.variant_get("source_record", "$.raw_id", "bigint").alias("raw_id"),
            F.variant_get("source_record", "$.claim_num", "string").alias("claim_num"),
            F.array_join("failed_rules", "|").alias("failed_rules"),
            F.variant_get("error_details", "$.column", "string").alias("error_column")),
        verdict("""SELECT raw_id, claim_num, 'Q' || CAST(gone AS VARCHAR) AS failed_rules,
            CASE gone WHEN 2 THEN 'provider_npi' ELSE 'allowed' END AS error_column FROM a WHERE gone IN (2, 7)""")),
    "rule_05_log_only": Query(
        lambda s, d: E.apply_quality_rules(T.claims(s, d), rule_list(s, QUALITY_RULES[3:4]), "CLAIMS").metrics().select(
            "rule_id", "metric_value"),
        sql("claims", "SELECT 'Q4' AS rule_id, CAST(count(*) AS DOUBLE) AS metric_value FROM claims WHERE status NOT IN ('F', 'O')")),
    "rule_06_error_isolation": Query(
        lambda s, d: _checked(s, d).metrics().filter("metric_type = 'RULE_ERROR'").select(
            "rule_id", "column_name", "pass_fail",
            T.claims(s, d).agg(F.count(F.lit(1)).alias("rows")).scalar().alias("rows")),
        sql("claims", "SELECT 'Q6' AS rule_id, 'no_such_column' AS column_name, 'FAIL' AS pass_fail, count(*) AS rows FROM claims")),
    "rule_06_malformed_rules": Query(
        lambda s, d: E.apply_quality_rules(T.claims(s, d), rule_list(s, ODD_RULES), "CLAIMS").metrics().select(
            "rule_id", "metric_type", "metric_value", "pass_fail"),
        sql("claims", """SELECT 'X1' AS rule_id, 'RULE_ERROR' AS metric_type, CAST(0 AS DOUBLE) AS metric_value, 'FAIL' AS pass_fail
            UNION ALL SELECT 'X2', 'RULE_VIOLATIONS', count(CASE WHEN status LIKE '%F%' THEN 1 END),
              CASE WHEN count(CASE WHEN status LIKE '%F%' THEN 1 END) = 0 THEN 'PASS' ELSE 'FAIL' END FROM claims
            UNION ALL SELECT 'X3', 'RULE_VIOLATIONS', count(CASE WHEN billed < 0 THEN 1 END),
              CASE WHEN count(CASE WHEN billed < 0 THEN 1 END) = 0 THEN 'PASS' ELSE 'FAIL' END FROM claims""")),
    "rule_07_business": Query(
        lambda s, d: E.apply_business_rules(T.claims(s, d), rule_list(s, BUSINESS_RULES), "CLAIMS").rows.select(
            "raw_id", F.round("patient_pays", 2).alias("patient_pays"), F.round("pays_twice", 2).alias("pays_twice")),
        sql("claims", """SELECT raw_id, round(coalesce(billed, 0) - coalesce(allowed, 0), 2) AS patient_pays,
            round((coalesce(billed, 0) - coalesce(allowed, 0)) * 2, 2) AS pays_twice FROM claims""")),
    "rule_07_business_metrics": Query(
        lambda s, d: E.apply_business_rules(T.claims(s, d), rule_list(s, BUSINESS_RULES), "CLAIMS").metrics().select(
            "rule_id", "metric_type", "metric_value", "pass_fail"),
        sql("claims", """SELECT 'B1' AS rule_id, 'BUSINESS_TRANSFORM' AS metric_type, CAST(count(*) AS DOUBLE) AS metric_value, 'PASS' AS pass_fail FROM claims
            UNION ALL SELECT 'B2', 'BUSINESS_TRANSFORM', count(*), 'PASS' FROM claims
            UNION ALL SELECT 'B3', 'BUSINESS_TRANSFORM_ERROR', 0, 'FAIL'""")),
    "rule_08_standardisation": Query(
        lambda s, d: E.apply_standard_rules(T.claims(s, d), rule_list(s, STANDARD_RULES), "CLAIMS").rows.select(
            "raw_id", "first_name", "plan_type", "status"),
        sql("claims", """SELECT raw_id, upper(first_name) AS first_name, lower(trim(plan_type)) AS plan_type,
            CASE WHEN status IN ('O', 'P') THEN 'OPEN' ELSE 'FINAL' END AS status FROM claims""")),
    "rule_08_standardisation_metrics": Query(
        lambda s, d: E.apply_standard_rules(T.claims(s, d), rule_list(s, STANDARD_RULES), "CLAIMS").metrics(T.claims(s, d)).select(
            "rule_id", "metric_value"),
        sql("claims", """SELECT 'T1' AS rule_id, CAST(count(first_name) AS DOUBLE) AS metric_value FROM claims
            UNION ALL SELECT 'T2', count(plan_type) FROM claims UNION ALL SELECT 'T3', count(status) FROM claims""")),
    "rule_09_keep_first": Query(
        lambda s, d: _dedup(s, d, "KEEP_FIRST", "claim_num, status")[0].select("raw_id", "claim_num", "status"),
        sql("claims", "SELECT min(raw_id) AS raw_id, claim_num, status FROM claims GROUP BY claim_num, status")),
    "rule_09_duplicates_metric": Query(
        lambda s, d: _dedup(s, d, "KEEP_FIRST")[2].select("rule_id", "metric_type", "metric_value", "pass_fail"),
        sql("claims", """SELECT 'D1' AS rule_id, 'DUPLICATES_REMOVED' AS metric_type,
            CAST(count(*) - count(DISTINCT claim_num) AS DOUBLE) AS metric_value,
            CASE WHEN count(*) = count(DISTINCT claim_num) THEN 'PASS' ELSE 'WARNING' END AS pass_fail FROM claims""")),
    "rule_10_keep_last": Query(
        lambda s, d: _dedup(s, d, "KEEP_LAST")[0].select("raw_id", "claim_num"),
        sql("claims", "SELECT max(raw_id) AS raw_id, claim_num FROM claims GROUP BY claim_num")),
    "rule_11_quarantine_all": Query(
        lambda s, d: _dedup(s, d, "QUARANTINE_ALL", "first_name, member_id")[1].select(
            F.variant_get("source_record", "$.raw_id", "bigint").alias("raw_id"),
            F.variant_get("error_details", "$.violation_type", "string").alias("violation")),
        sql("claims", """SELECT raw_id, 'DUPLICATE' AS violation FROM (SELECT raw_id, first_name, member_id,
            count(*) OVER (PARTITION BY first_name, member_id) AS n FROM claims) WHERE n > 1 AND first_name IS NOT NULL""")),
    "rule_11_quarantine_all_kept": Query(
        lambda s, d: _dedup(s, d, "QUARANTINE_ALL", "first_name, member_id")[0].select("raw_id"),
        sql("claims", """SELECT raw_id FROM (SELECT raw_id, first_name, member_id,
            count(*) OVER (PARTITION BY first_name, member_id) AS n FROM claims) WHERE n = 1 OR first_name IS NULL""")),
    "rule_12_fuzzy_dedup": Query(
        lambda s, d: _fuzzy(s, d).select("raw_id", "name"),
        """WITH RECURSIVE c AS (SELECT c_custkey AS raw_id, c_nationkey, c_mktsegment, c_name AS name FROM customer),
           e AS MATERIALIZED (SELECT c.raw_id AS a, x.raw_id AS b FROM c JOIN c x ON x.c_nationkey = c.c_nationkey AND x.c_mktsegment = c.c_mktsegment
             WHERE levenshtein(x.name, c.name) <= floor(greatest(length(x.name), length(c.name)) * 0.15 + 1e-9)),
           r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
           SELECT raw_id, name FROM c WHERE raw_id = (SELECT max(b) FROM r WHERE r.a = c.raw_id)"""),
    "rule_13_referential": Query(
        lambda s, d: _referential(s, d).metrics().select("rule_id", "metric_value"),
        sql("claims", """SELECT 'F1' AS rule_id, CAST(count(CASE WHEN m.c_custkey IS NULL THEN 1 END) AS DOUBLE) AS metric_value
              FROM claims LEFT JOIN (SELECT c_custkey FROM customer WHERE c_nationkey < 20) m ON member_id = m.c_custkey
            UNION ALL SELECT 'F2', count(CASE WHEN m.c_custkey IS NOT NULL AND service_date > paid_date THEN 1 END)
              FROM claims LEFT JOIN (SELECT c_custkey FROM customer WHERE c_nationkey < 20) m ON member_id = m.c_custkey""")),
    "rule_14_flag_correct": Query(
        lambda s, d: _fixed(s, d).select(
            "raw_id", F.round("billed", 2).alias("billed"), F.array_join("dq_flags", "|").alias("dq_flags")),
        sql("claims", """SELECT raw_id, round(fixed, 2) AS billed, array_to_string(list_filter([CASE WHEN first_name IS NULL THEN 'C2' END,
              CASE WHEN allowed IS NULL THEN 'C3' END], lambda x: x IS NOT NULL), '|') AS dq_flags
            FROM (SELECT *, CASE WHEN billed < 0 THEN billed + 300000 ELSE billed END AS fixed FROM claims) WHERE fixed >= 0""")),
    "rule_15_parameter_checks": Query(
        lambda s, d: E.apply_quality_rules(
            T.claims(s, d).withColumn("service_text", F.date_format("service_date", "MM-dd-yyyy")),
            rule_list(s, PARAMETER_RULES), "CLAIMS").metrics().select("rule_id", "metric_value"),
        sql("claims", """SELECT 'P1' AS rule_id, CAST(count(CASE WHEN NOT regexp_full_match(provider_npi, '[0-9]{10}') THEN 1 END) AS DOUBLE) AS metric_value FROM claims
            UNION ALL SELECT 'P2', count(CASE WHEN NOT (billed >= 0 AND billed <= 300000) THEN 1 END) FROM claims
            UNION ALL SELECT 'P3', count(CASE WHEN status NOT IN ('F', 'O') THEN 1 END) FROM claims
            UNION ALL SELECT 'P4', count(CASE WHEN length(plan_type) > 8 THEN 1 END) FROM claims
            UNION ALL SELECT 'P5', 0""")),
    "rule_16_provider_override": Query(
        lambda s, d: _by_provider(s, d),
        sql("claims", """SELECT raw_id, status AS tpa FROM claims
            WHERE CASE WHEN status = 'F' THEN billed >= 0 ELSE billed >= 100000 END""")),
    "rule_16_dedup_by_provider": Query(
        lambda s, d: E.apply_dedup_rules(
            T.claims(s, d).withColumn("tpa", F.col("status")), rule_list(s, PROVIDER_DEDUP_RULES), "CLAIMS",
        )[0].select("raw_id", "tpa"),
        sql("claims", """SELECT min(raw_id) AS raw_id, status AS tpa FROM claims WHERE status = 'F' GROUP BY member_id, status
            UNION ALL SELECT max(raw_id), status FROM claims WHERE status <> 'F' GROUP BY claim_num, status
            UNION ALL SELECT raw_id, status FROM claims WHERE status IS NULL""")),
    "rule_16_effective_rules": Query(
        lambda s, d: E.effective_rules(T.rules(s, d), "tpa_1").select("rule_id"),
        sql("rules", """SELECT rule_id FROM rules r WHERE active AND (tpa = 'tpa_1' OR (tpa IS NULL AND NOT EXISTS (
              SELECT 1 FROM rules o WHERE o.active AND o.tpa = 'tpa_1' AND o.rule_type = r.rule_type
              AND o.target_table = r.target_table AND o.target_column = r.target_column)))""")),
    "rule_17_merge_duplicates": Query(
        lambda s, d: dedup.merge_duplicates(
            T.claims(s, d).select("raw_id", "claim_num", "first_name", "allowed", "paid_date"), ["claim_num"]
        ).select("claim_num", "raw_id", "first_name", F.round("allowed", 2).alias("allowed"),
                 F.date_format("paid_date", "yyyy-MM-dd").alias("paid_date")),
        sql("claims", """SELECT claim_num, max(raw_id) AS raw_id, arg_max(first_name, raw_id) FILTER (first_name IS NOT NULL) AS first_name,
              round(arg_max(allowed, raw_id) FILTER (allowed IS NOT NULL), 2) AS allowed,
              strftime(arg_max(paid_date, raw_id) FILTER (paid_date IS NOT NULL), '%Y-%m-%d') AS paid_date
            FROM claims GROUP BY claim_num""")),
    "rule_18_aggregate_column": Query(
        lambda s, d: joins.with_key_sum(
            T.claims(s, d).select("raw_id", "member_id", "billed"), ["member_id"], "billed", "member_total"
        ).select("raw_id", F.round("member_total", 2).alias("member_total")),
        sql("claims", "SELECT raw_id, round(sum(billed) OVER (PARTITION BY member_id), 2) AS member_total FROM claims")),
}

TODAY = "1998-12-01"


def _definitions() -> list[Q.Metric]:
    today = F.lit(TODAY).cast("date")
    day = lambda text: F.lit(text).cast("date")
    return [
        Q.completeness("Completeness - First Name", "first_name", 99.0),
        Q.completeness("Completeness - Claim", "claim_num", 100.0),
        Q.share("Validity - Service Date", "VALIDITY", "service_date", F.col("service_date").between(day("1900-01-01"), today), 99.0),
        Q.share("Validity - NPI", "VALIDITY", "provider_npi", F.length("provider_npi") == 10, 95.0, of_present=True),
        Q.share("Validity - Positive", "VALIDITY", "billed", F.col("billed") > 0, 99.5),
        Q.share("Consistency - Allowed", "CONSISTENCY", "allowed", F.col("allowed") <= F.col("billed"), 98.0, of_present=True),
        Q.share("Consistency - Dates", "CONSISTENCY", "paid_date", F.col("service_date") <= F.col("paid_date"), 99.0, of_present=True),
        Q.uniqueness("Uniqueness - Claim", "claim_num", 100.0),
        Q.share("Timeliness - 30 days", "TIMELINESS", "paid_date", Q.within_days("service_date", "paid_date", 30), 95.0, of_present=True, alert=False),
        Q.share("Accuracy - Status", "ACCURACY", "status", F.col("status").isin("F", "O"), 98.0, of_present=True),
        Q.share("Reasonableness - Amount", "REASONABLENESS", "billed", F.col("billed").between(0.01, 100000), 95.0, alert=False),
        Q.share("Reasonableness - Age", "REASONABLENESS", "service_date", Q.age_between("service_date", today, 0, 120), 99.0),
        Q.recency("Coverage - Recent", "service_date", F.date_sub(today, 90)),
        Q.duplicate_rate("Duplicate Rate - Claim", "claim_num", 2.0),
        Q.null_rate("Null Rate - First Name", "first_name", 1.0),
        Q.outlier_share("Outlier - Billed", "billed", 5.0, alert=False),
        Q.completeness("Disabled", "status", 100.0, enabled=False),
    ]


_PCT = "CAST(100 AS DOUBLE)"
_PARTS = {
    "Completeness - First Name": ("count(first_name)", "count(*)"),
    "Completeness - Claim": ("count(claim_num)", "count(*)"),
    "Validity - Service Date": (f"count(CASE WHEN service_date BETWEEN DATE '1900-01-01' AND DATE '{TODAY}' THEN 1 END)", "count(*)"),
    "Validity - NPI": ("count(CASE WHEN length(provider_npi) = 10 THEN 1 END)", "count(provider_npi)"),
    "Validity - Positive": ("count(CASE WHEN billed > 0 THEN 1 END)", "count(*)"),
    "Consistency - Allowed": ("count(CASE WHEN allowed <= billed THEN 1 END)", "count(allowed)"),
    "Consistency - Dates": ("count(CASE WHEN service_date <= paid_date THEN 1 END)", "count(paid_date)"),
    "Uniqueness - Claim": ("count(DISTINCT claim_num)", "count(*)"),
    "Timeliness - 30 days": ("count(CASE WHEN date_diff('day', service_date, paid_date) <= 30 THEN 1 END)", "count(paid_date)"),
    "Accuracy - Status": ("count(CASE WHEN status IN ('F', 'O') THEN 1 END)", "count(status)"),
    "Reasonableness - Amount": ("count(CASE WHEN billed BETWEEN 0.01 AND 100000 THEN 1 END)", "count(*)"),
    "Reasonableness - Age": (f"count(CASE WHEN date_diff('year', service_date, DATE '{TODAY}') BETWEEN 0 AND 120 THEN 1 END)", "count(*)"),
    "Duplicate Rate - Claim": ("(count(*) - count(DISTINCT claim_num))", "count(*)"),
    "Null Rate - First Name": ("count(CASE WHEN first_name IS NULL THEN 1 END)", "count(*)"),
    "Outlier - Billed": ("count(CASE WHEN billed > (SELECT avg(billed) + 3 * stddev_samp(billed) FROM claims) THEN 1 END)", "count(*)"),
}
_MEASURED = " UNION ALL ".join(
    [f"SELECT '{n}' AS metric_name, round({a} * {_PCT} / {b}, 4) AS metric_value FROM claims" for n, (a, b) in _PARTS.items()]
    + [f"SELECT 'Coverage - Recent', CASE WHEN count(*) > 0 THEN {_PCT} ELSE 0 END FROM claims WHERE service_date >= DATE '{TODAY}' - 90"]
)


def measured(*kinds: str):
    return lambda s, d: shown(Q.measure(T.claims(s, d), [m for m in _definitions() if m.kind in kinds]))


def measured_sql(*names: str) -> str:
    return sql("claims", f"SELECT * FROM ({_MEASURED}) WHERE metric_name SIMILAR TO '({'|'.join(names)}) - .*'")


def verdict_sql() -> str:
    limits = {m.name: (float(m.threshold), m.operator, m.alert) for m in _definitions_for_sql()}
    rows = ", ".join(f"('{n}', CAST({t} AS DOUBLE), '{o}', {str(a).lower()})" for n, (t, o, a) in limits.items())
    return sql("claims", f"""SELECT metric_name, metric_value, threshold_value, threshold_operator,
        CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS pass_fail, alert_on_failure AND NOT ok AS alert FROM (
        SELECT m.*, t.threshold_value, t.threshold_operator, t.alert_on_failure,
          CASE t.threshold_operator WHEN '>=' THEN metric_value >= threshold_value ELSE metric_value <= threshold_value END AS ok
        FROM ({_MEASURED}) m JOIN (VALUES {rows}) t(metric_name, threshold_value, threshold_operator, alert_on_failure)
        ON m.metric_name = t.metric_name)""")


# Thresholds of the metrics above, as the check needs them without a session.
LIMITS = [
    ("Completeness - First Name", 99.0, ">=", True), ("Completeness - Claim", 100.0, ">=", True),
    ("Validity - Service Date", 99.0, ">=", True), ("Validity - NPI", 95.0, ">=", True),
    ("Validity - Positive", 99.5, ">=", True), ("Consistency - Allowed", 98.0, ">=", True),
    ("Consistency - Dates", 99.0, ">=", True), ("Uniqueness - Claim", 100.0, ">=", True),
    ("Timeliness - 30 days", 95.0, ">=", False), ("Accuracy - Status", 98.0, ">=", True),
    ("Reasonableness - Amount", 95.0, ">=", False), ("Reasonableness - Age", 99.0, ">=", True),
    ("Coverage - Recent", 100.0, ">=", True), ("Duplicate Rate - Claim", 2.0, "<=", True),
    ("Null Rate - First Name", 1.0, "<=", True), ("Outlier - Billed", 5.0, "<=", False),
]


def _definitions_for_sql():
    return [Q.Metric(n, "", "", t, o, alert=a) for n, t, o, a in LIMITS]


def _resolved(s, d):
    held = T.quarantine(s, d)
    held = dedup.keep_one(held, ["quarantine_id"], [F.asc("quarantine_timestamp"), F.asc("batch_id"), F.asc("target_table"),
                                                   F.asc(F.array_join("failed_rules", "|")), F.asc("resolved")])
    held = held.select(
        "quarantine_id", "target_table", "resolved", F.lit(None).cast("string").alias("resolution_action"),
        F.lit(None).cast("timestamp_ntz").alias("resolution_timestamp"), F.lit(None).cast("string").alias("resolved_by"))
    decisions = T.load(s, d, "orders").filter("o_orderstatus = 'F'").select(
        (F.col("o_orderkey") * 8 + 1).alias("quarantine_id"), F.lit("FIXED").alias("resolution_action"),
        F.concat(F.lit("user"), F.col("o_custkey") % 9).alias("resolved_by"))
    out = silver.resolve_quarantine(held, decisions, as_of())
    return out.filter("resolution_action IS NOT NULL").select(
        "quarantine_id", "resolved", "resolution_action", "resolved_by",
        F.date_format("resolution_timestamp", "yyyy-MM-dd HH:mm:ss").alias("resolution_timestamp"))


QUALITY = {
    "dq_01_completeness": Query(measured("COMPLETENESS"), measured_sql("Completeness")),
    "dq_02_validity": Query(measured("VALIDITY"), measured_sql("Validity")),
    "dq_03_consistency": Query(measured("CONSISTENCY"), measured_sql("Consistency")),
    "dq_04_uniqueness": Query(measured("UNIQUENESS"), measured_sql("Uniqueness")),
    "dq_05_timeliness": Query(measured("TIMELINESS"), measured_sql("Timeliness")),
    "dq_06_accuracy": Query(measured("ACCURACY"), measured_sql("Accuracy")),
    "dq_07_reasonableness": Query(measured("REASONABLENESS"), measured_sql("Reasonableness")),
    "dq_08_coverage": Query(measured("COVERAGE"), measured_sql("Coverage")),
    "dq_09_rates_outliers": Query(
        measured("DUPLICATE_RATE", "NULL_RATE", "OUTLIER"), measured_sql("Duplicate Rate", "Null Rate", "Outlier")),
    "dq_10_thresholds": Query(
        lambda s, d: shown(Q.evaluate(Q.measure(T.claims(s, d), _definitions()), _definitions())).select(
            "metric_name", "metric_value", "threshold_value", "threshold_operator", "pass_fail", "alert"),
        verdict_sql()),
    "dq_11_rule_preview": Query(
        lambda s, d: E.apply_quality_rules(
            T.claims(s, d).orderBy("raw_id").limit(200), rule_list(s, QUALITY_RULES), "CLAIMS"
        ).metrics().select("rule_id", "metric_value"),
        verdict("SELECT rule_id, metric_value FROM (" + _METRIC_SQL + ")").replace("FROM v)", "FROM v ORDER BY raw_id LIMIT 200)")),
    "dq_12_resolution": Query(
        _resolved,
        """SELECT o_orderkey * 8 + 1 AS quarantine_id, true AS resolved, 'FIXED' AS resolution_action,
             'user' || CAST(o_custkey % 9 AS VARCHAR) AS resolved_by, '2024-01-31 12:00:00' AS resolution_timestamp
           FROM orders WHERE o_orderstatus = 'F' AND o_orderkey * 8 + 1 IN (SELECT l_orderkey * 8 + l_linenumber FROM lineitem)"""),
}

QUERIES = {**RULES, **QUALITY}
