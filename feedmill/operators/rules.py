"""Data-driven rules: quality checks, derived columns, standardisation, dedup.

Rules are rows. All quality rules of a table are evaluated in one projection:
``_removed_at`` is the position of the first removing rule a row violates, so
a rule sees exactly the rows that earlier rules left over, without a pass or a
rewrite per rule.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions import dialect
from feedmill.functions.dates import spark_pattern
from feedmill.operators import dedup
from feedmill.operators.joins import attach_reference, collect_metadata

QUALITY, BUSINESS = "DATA_QUALITY", "BUSINESS_LOGIC"
STANDARD, DEDUP = "STANDARDIZATION", "DEDUPLICATION"
REFERENTIAL = "REFERENTIAL_INTEGRITY"
REMOVING = ("REJECT", "QUARANTINE", "CORRECT")

METRIC_SCHEMA = (
    "rule_id string, table_name string, column_name string, metric_type string, "
    "metric_value double, threshold_value double, pass_fail string, details string"
)


@dataclass
class Rule:
    rule_id: str
    rule_name: str
    rule_type: str
    target_table: str | None
    target_column: str | None
    tpa: str | None
    rule_logic: str | None
    rule_parameters: dict
    priority: int
    error_action: str
    applies_to: str = "TRUE"

    @classmethod
    def from_row(cls, row) -> "Rule":
        get = row.asDict().get
        params = get("rule_parameters")
        if params is not None and not isinstance(params, str):
            params = params.toJson() if hasattr(params, "toJson") else str(params)
        try:
            parsed = json.loads(params) if params else {}
        except ValueError:
            parsed = {}
        return cls(
            get("rule_id"), get("rule_name") or get("rule_id"), (get("rule_type") or "").upper(),
            (get("target_table") or "").upper() or None, get("target_column"), get("tpa"),
            get("rule_logic"), parsed if isinstance(parsed, dict) else {},
            100 if get("priority") is None else int(get("priority")),
            (get("error_action") or "LOG").upper(),
        )


def active_rules(rules: DataFrame, target_table: str | None = None) -> list[Rule]:
    """Active rules of a table in (priority, rule_id) order, provider overrides resolved."""
    chosen = rules.filter("active")
    if target_table:
        chosen = chosen.filter(
            F.col("target_table").isNull() | (F.upper("target_table") == target_table.upper())
        )
    found = [Rule.from_row(r) for r in collect_metadata(chosen)]
    found.sort(key=lambda r: (r.priority, r.rule_id))
    return resolve_providers(found)


def resolve_providers(rules: list[Rule]) -> list[Rule]:
    """A global rule skips providers that have their own rule for the same column."""
    own: dict[tuple, set[str]] = {}
    for rule in rules:
        if rule.tpa is not None:
            own.setdefault((rule.rule_type, rule.target_table, rule.target_column), set()).add(rule.tpa)
    for rule in rules:
        if rule.tpa is not None:
            rule.applies_to = f"tpa <=> {_quote(rule.tpa)}"
        else:
            skipped = own.get((rule.rule_type, rule.target_table, rule.target_column))
            if skipped:
                names = ", ".join(_quote(t) for t in sorted(skipped))
                rule.applies_to = f"NOT coalesce(tpa IN ({names}), FALSE)"
    return rules


def effective_rules(rules: DataFrame, tpa: str) -> DataFrame:
    """Active rules a provider gets: its own, and global ones it does not override."""
    active = rules.filter("active")
    own = active.filter(F.col("tpa") == tpa)
    slot = ["rule_type", "target_table", "target_column"]
    overridden = own.select(*[F.col(c).alias(f"_{c}") for c in slot]).distinct()
    same = F.lit(True)
    for c in slot:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    shared = active.filter(F.col("tpa").isNull()).join(overridden, same, "left_anti")
    return own.unionByName(shared)


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def parameter_condition(rule: Rule) -> str | None:
    """Condition described by rule parameters (pattern, bounds, date format, values, length)."""
    p, c = rule.rule_parameters, rule.target_column
    parts = []
    if "pattern" in p:
        parts.append(f"{c} RLIKE {_quote('^(?:' + p['pattern'] + ')$')}")
    if "min" in p:
        parts.append(f"{c} >= {p['min']}")
    if "max" in p:
        parts.append(f"{c} <= {p['max']}")
    if "max_length" in p:
        parts.append(f"length({c}) <= {int(p['max_length'])}")
    if "date_format" in p:
        parts.append(f"try_to_date({c}, {_quote(spark_pattern(p['date_format']))}) IS NOT NULL")
    if "values" in p:
        parts.append(f"{c} IN ({', '.join(_quote(str(v)) for v in p['values'])})")
    if "not_after" in p:
        parts.append(f"{c} <= {p['not_after']}")
    return " AND ".join(parts) or None


def rule_condition(rule: Rule) -> str:
    if rule.rule_logic and rule.rule_logic.strip():
        return dialect.predicate(rule.target_column, rule.rule_logic)
    condition = parameter_condition(rule)
    if condition is None:
        raise ValueError("rule has neither logic nor known parameters")
    return condition


def _analysis_error(df: DataFrame, text: str) -> str | None:
    try:
        df.select(F.expr(text)).schema
    except (AnalysisException, ParseException) as error:
        lines = str(error).strip().splitlines()
        return lines[0] if lines else type(error).__name__
    return None


@dataclass
class RuleResult:
    """Rows with their verdicts, plus how to read metrics off them."""

    rows: DataFrame
    counters: list[tuple[dict, Column]] = field(default_factory=list)
    errors: list[dict] = field(default_factory=list)
    quarantine_rules: dict[int, Rule] = field(default_factory=dict)
    helper_columns: list[str] = field(default_factory=list)

    def survivors(self) -> DataFrame:
        if "_removed_at" not in self.rows.columns:
            return self.rows
        return self.rows.filter("_removed_at IS NULL").drop("_removed_at", *self.helper_columns)

    def rejected(self) -> DataFrame:
        return self.rows.filter("_removed_at IS NOT NULL").drop(*self.helper_columns)

    def quarantined(self) -> DataFrame:
        """Removed rows of quarantining rules as (source_record, failed_rules, error_details)."""
        positions = list(self.quarantine_rules)
        hit = self.rows.filter(F.col("_removed_at").isin(*positions) if positions else F.lit(False))
        data = [c for c in self.rows.columns if c not in self.helper_columns and c != "_removed_at"]
        pick = lambda value: F.coalesce(
            *[F.when(F.col("_removed_at") == k, F.lit(value(r))) for k, r in self.quarantine_rules.items()],
            F.lit(None).cast("string"),
        )
        return hit.select(
            F.to_variant_object(F.struct(*data)).alias("source_record"),
            F.array(pick(lambda r: r.rule_id)).alias("failed_rules"),
            F.to_variant_object(
                F.struct(
                    pick(lambda r: r.rule_name).alias("rule"),
                    pick(lambda r: r.target_column or "").alias("column"),
                    F.lit(QUALITY).alias("violation_type"),
                )
            ).alias("error_details"),
        )

    def metrics(self, rows: DataFrame | None = None) -> DataFrame:
        """One row per rule, from a single aggregate over all rows."""
        rows = self.rows if rows is None else rows
        return metric_rows(rows, self.counters, self.errors)


def metric_rows(rows: DataFrame, counters: list[tuple[dict, Column]], errors: list[dict]) -> DataFrame:
    spark = rows.sparkSession
    failed = spark.createDataFrame([_metric(**e) for e in errors], METRIC_SCHEMA)
    if not counters:
        return failed
    totals = rows.agg(*[count.alias(f"n{i}") for i, (_, count) in enumerate(counters)])
    entries = []
    for i, (info, _) in enumerate(counters):
        value = F.coalesce(F.col(f"n{i}"), F.lit(0)).cast("double")
        verdict = F.when(value == 0, "PASS").otherwise(info["when_hit"])
        entries.append(
            F.struct(
                F.lit(info["rule_id"]).alias("rule_id"),
                F.lit(info["table_name"]).alias("table_name"),
                F.lit(info["column_name"]).cast("string").alias("column_name"),
                F.lit(info["metric_type"]).alias("metric_type"),
                value.alias("metric_value"),
                F.lit(info["threshold"]).cast("double").alias("threshold_value"),
                verdict.alias("pass_fail"),
                F.lit(None).cast("string").alias("details"),
            )
        )
    found = totals.select(F.explode(F.array(*entries)).alias("m")).select("m.*")
    return found.unionByName(failed) if errors else found


def _metric(rule: Rule, metric_type: str, error: str, table: str | None):
    return (rule.rule_id, table, rule.target_column, metric_type, 0.0, None, "FAIL",
            json.dumps({"error": error}))


def apply_quality_rules(
    batch: DataFrame,
    rules: list[Rule],
    table: str | None = None,
    references: dict[str, DataFrame] | None = None,
) -> RuleResult:
    """Evaluate all quality rules in priority order in one pass.

    A NULL check result is not a violation. REJECT and QUARANTINE remove the
    row, FLAG adds the rule id to ``dq_flags``, CORRECT replaces the value and
    quarantines what is still wrong, anything else only counts.
    """
    chosen = [r for r in rules if r.rule_type in (QUALITY, REFERENTIAL)]
    result = RuleResult(batch)
    df = batch
    flags, helpers = [], []
    removals: list[tuple[int, Column]] = []
    counted: list[tuple[int, str, Rule]] = []
    has_tpa = "tpa" in batch.columns
    for position, rule in enumerate(chosen):
        name = f"_v{position}"
        try:
            if references and rule.rule_parameters.get("reference_table") in references:
                df, violated = _reference_check(df, rule, references, f"_ref{position}")
                helpers.append(f"_ref{position}")
                condition = None
            else:
                condition = rule_condition(rule)
                problem = _analysis_error(df, f"NOT ({condition})")
                if problem:
                    raise ValueError(problem)
                violated = F.expr(f"NOT ({condition})")
        except (ValueError, AnalysisException) as error:
            result.errors.append(
                {"rule": rule, "metric_type": "RULE_ERROR", "error": str(error), "table": table or rule.target_table}
            )
            continue
        hit = F.coalesce(violated, F.lit(False))
        if has_tpa and rule.applies_to != "TRUE":
            hit = hit & F.expr(rule.applies_to)
        removes = F.col(name)
        if rule.error_action == "CORRECT":
            # A row an earlier rule removed keeps the value it was removed with.
            hit = hit & _first_removal(removals).isNull()
        df = df.withColumn(name, hit)
        helpers.append(name)
        counted.append((position, name, rule))
        if rule.error_action == "CORRECT":
            fix = rule.rule_parameters.get("correction")
            if fix and condition:
                fixed = F.expr(dialect.to_spark(fix)).cast(df.schema[rule.target_column].dataType)
                df = df.withColumn(
                    rule.target_column,
                    F.when(F.col(name), fixed).otherwise(F.col(rule.target_column)),
                )
                df = df.withColumn(f"_c{position}", F.col(name) & ~F.coalesce(F.expr(condition), F.lit(False)))
                helpers.append(f"_c{position}")
                removes = F.col(f"_c{position}")
            result.quarantine_rules[position] = rule
        if rule.error_action in REMOVING:
            removals.append((position, removes))
            if rule.error_action == "QUARANTINE":
                result.quarantine_rules[position] = rule
        elif rule.error_action == "FLAG":
            flags.append(F.when(F.col(name), F.lit(rule.rule_id)))
    if flags:
        df = df.withColumn("dq_flags", F.array_compact(F.array(*flags)))
    result.rows = df.withColumn("_removed_at", _first_removal(removals))
    result.helper_columns = helpers
    for position, name, rule in counted:
        seen = F.col("_removed_at").isNull() | (F.col("_removed_at") >= position)
        info = {
            "rule_id": rule.rule_id, "table_name": table or rule.target_table,
            "column_name": rule.target_column, "metric_type": "RULE_VIOLATIONS",
            "threshold": 0.0, "when_hit": "FAIL",
        }
        result.counters.append((info, F.count_if(F.col(name) & seen)))
    return result


def _first_removal(removals: list[tuple[int, Column]]) -> Column:
    """Position of the first removing rule that is violated."""
    return F.coalesce(
        *[F.when(hit, F.lit(position)) for position, hit in removals], F.lit(None).cast("int")
    )


def _reference_check(
    df: DataFrame, rule: Rule, references: dict[str, DataFrame], flag: str
) -> tuple[DataFrame, Column]:
    """Violated when a non-null value is missing from the reference column."""
    p = rule.rule_parameters
    known = references[p["reference_table"]].select(
        F.col(p["reference_column"]).alias("_ref_key")
    ).distinct().withColumn(flag, F.lit(True))
    joined = attach_reference(df, rule.target_column, known, "_ref_key")
    return joined, F.col(rule.target_column).isNotNull() & F.col(flag).isNull()


def missing_references(rows: DataFrame, column: str, reference: DataFrame, key: str) -> DataFrame:
    """Rows whose non-null value the reference table lacks."""
    known = reference.select(F.col(key).alias("_ref_key")).distinct().withColumn("_known", F.lit(True))
    joined = attach_reference(rows.filter(F.col(column).isNotNull()), column, known, "_ref_key")
    return joined.filter(F.col("_known").isNull()).drop("_known")


def look_up(
    rows: DataFrame, column: str, reference: DataFrame, key: str, value: str, name: str
) -> DataFrame:
    """Derived column read from a reference table (one value per key, smallest wins)."""
    facts = reference.groupBy(F.col(key).alias("_ref_key")).agg(F.min(value).alias(name))
    return attach_reference(rows, column, facts, "_ref_key")


def _gate(df: DataFrame, rule: Rule) -> Column | None:
    if "tpa" in df.columns and rule.applies_to != "TRUE":
        return F.expr(rule.applies_to)
    return None


def apply_business_rules(batch: DataFrame, rules: list[Rule], table: str | None = None) -> RuleResult:
    """``column = expression`` for every row, in order; unknown columns are created."""
    result, df = RuleResult(batch), batch
    for rule in [r for r in rules if r.rule_type == BUSINESS]:
        text = dialect.to_spark(rule.rule_logic or rule.rule_parameters.get("calculation", ""))
        problem = _analysis_error(df, text)
        if problem or not text:
            result.errors.append({"rule": rule, "metric_type": "BUSINESS_TRANSFORM_ERROR",
                                  "error": problem or "empty logic", "table": table})
            continue
        gate, value = _gate(df, rule), F.expr(text)
        if rule.target_column in df.columns:
            old_type = df.schema[rule.target_column].dataType
            value = value.try_cast(old_type)
            if gate is not None:
                value = F.when(gate, value).otherwise(F.col(rule.target_column))
        elif gate is not None:
            value = F.when(gate, value)
        df = df.withColumn(rule.target_column, value)
        hit = F.count(F.lit(1)) if gate is None else F.count_if(gate)
        result.counters.append((_info(rule, table, "BUSINESS_TRANSFORM"), hit))
    result.rows = df
    return result


def apply_standard_rules(batch: DataFrame, rules: list[Rule], table: str | None = None) -> RuleResult:
    """``column = FUNC(column)`` where the column is not NULL."""
    result, df = RuleResult(batch), batch
    for rule in [r for r in rules if r.rule_type == STANDARD]:
        column = rule.target_column
        text = dialect.standard_expression(column, rule.rule_logic or "")
        problem = _analysis_error(df, f"struct({text}, {column})")
        if problem:
            result.errors.append({"rule": rule, "metric_type": "STANDARDIZATION_ERROR",
                                  "error": problem, "table": table})
            continue
        hit = F.col(column).isNotNull()
        gate = _gate(df, rule)
        if gate is not None:
            hit = hit & gate
        value = F.expr(text).try_cast(df.schema[column].dataType)
        result.counters.append((_info(rule, table, "STANDARDIZATION"), F.count_if(hit)))
        df = df.withColumn(column, F.when(hit, value).otherwise(F.col(column)))
    result.rows = df
    return result


def _info(rule: Rule, table: str | None, kind: str) -> dict:
    return {
        "rule_id": rule.rule_id, "table_name": table or rule.target_table,
        "column_name": rule.target_column, "metric_type": kind, "threshold": None, "when_hit": "PASS",
    }


def dedup_keys(rule: Rule) -> list[str]:
    return [k.strip() for k in (rule.rule_logic or "").split(",") if k.strip()]


def apply_dedup_rule(
    batch: DataFrame, rule: Rule, row_id: str = "raw_id"
) -> tuple[DataFrame, DataFrame | None]:
    """(kept rows, rows for quarantine or None) under the rule's strategy."""
    strategy = str(rule.rule_parameters.get("strategy", "KEEP_FIRST")).upper()
    if strategy == "FUZZY":
        named = batch.withColumn("_match_name", F.expr(dialect.to_spark(rule.rule_logic)))
        kept = dedup.drop_fuzzy_duplicates(
            named, "_match_name", list(rule.rule_parameters.get("within", [])),
            float(rule.rule_parameters.get("threshold", 0.85)), row_id,
            str(rule.rule_parameters.get("keep", "LAST")).upper(),
        )
        return kept.drop("_match_name"), None
    keys = dedup_keys(rule)
    if not keys or [k for k in keys if k.lower() not in [c.lower() for c in batch.columns]]:
        raise ValueError(f"dedup key columns not in batch: {rule.rule_logic}")
    if strategy == "KEEP_FIRST":
        return dedup.keep_first(batch, keys, row_id), None
    if strategy == "KEEP_LAST":
        return dedup.keep_last(batch, keys, row_id), None
    if strategy == "QUARANTINE_ALL":
        return dedup.split_all_duplicates(batch, keys)
    if strategy == "MERGE":
        return dedup.merge_duplicates(batch, keys, row_id).select(*batch.columns), None
    raise ValueError(f"unknown dedup strategy: {strategy}")


def apply_dedup_rules(
    batch: DataFrame, rules: list[Rule], table: str, row_id: str = "raw_id"
) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """(kept rows, quarantine records or None, metrics) after all dedup rules in order."""
    spark = batch.sparkSession
    df, held, metrics = batch, None, spark.createDataFrame([], METRIC_SCHEMA)
    for rule in [r for r in rules if r.rule_type == DEDUP]:
        # a rule of one provider, or one that others override, leaves the rest alone
        mine, rest = df, None
        try:
            if rule.applies_to != "TRUE":
                mine, rest = df.filter(rule.applies_to), df.filter(f"NOT ({rule.applies_to})")
            kept, removed = apply_dedup_rule(mine, rule, row_id)
        except (ValueError, AnalysisException) as error:
            metrics = metrics.unionByName(
                metric_rows(df, [], [{"rule": rule, "metric_type": "DEDUPLICATION_ERROR",
                                      "error": str(error), "table": table}])
            )
            continue
        if rule.rule_parameters.get("strategy", "KEEP_FIRST").upper() == "FUZZY":
            counted = mine.groupBy().count().select(F.col("count").alias("duplicate_count"))
            counted = counted.unionByName(
                kept.groupBy().agg((-F.count(F.lit(1))).alias("duplicate_count"))
            ).agg(F.sum("duplicate_count").alias("duplicate_count"))
        else:
            counted = dedup.duplicate_count(mine, dedup_keys(rule))
        info = {**_info(rule, table, "DUPLICATES_REMOVED"), "when_hit": "WARNING", "column_name": None}
        metrics = metrics.unionByName(
            metric_rows(counted, [(info, F.sum("duplicate_count"))], [])
        )
        if removed is not None:
            records = removed.select(
                F.to_variant_object(F.struct(*removed.columns)).alias("source_record"),
                F.array(F.lit(rule.rule_id)).alias("failed_rules"),
                F.to_variant_object(
                    F.struct(
                        F.lit(rule.rule_name).alias("rule"),
                        F.lit(rule.rule_logic).alias("duplicate_key"),
                        F.lit("DUPLICATE").alias("violation_type"),
                    )
                ).alias("error_details"),
            )
            held = records if held is None else held.unionByName(records)
        df = kept if rest is None else kept.unionByName(rest)
    return df, held, metrics
