"""Column profiles and thresholded quality metrics."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions.dates import boundary_diff
from feedmill.functions.dialect import to_spark
from feedmill.operators.joins import collect_metadata


@dataclass
class Metric:
    """One quality metric: a share in percent, compared with a threshold."""

    name: str
    kind: str
    column: str
    threshold: float
    operator: str = ">="
    condition: Column | None = None   # counted rows
    base: Column | None = None        # rows the share is taken of; None = all
    alert: bool = True
    enabled: bool = True


def completeness(name: str, column: str, threshold: float, **kw) -> Metric:
    return Metric(name, "COMPLETENESS", column, threshold, condition=F.col(column).isNotNull(), **kw)


def null_rate(name: str, column: str, threshold: float, **kw) -> Metric:
    return Metric(name, "NULL_RATE", column, threshold, "<=", F.col(column).isNull(), **kw)


def share(name: str, kind: str, column: str, condition: Column, threshold: float,
          of_present: bool = False, **kw) -> Metric:
    base = F.col(column).isNotNull() if of_present else None
    return Metric(name, kind, column, threshold, condition=condition, base=base, **kw)


def uniqueness(name: str, column: str, threshold: float, **kw) -> Metric:
    return Metric(name, "UNIQUENESS", column, threshold, **kw)


def duplicate_rate(name: str, column: str, threshold: float, **kw) -> Metric:
    return Metric(name, "DUPLICATE_RATE", column, threshold, "<=", **kw)


def outlier_share(name: str, column: str, threshold: float, **kw) -> Metric:
    return Metric(name, "OUTLIER", column, threshold, "<=", **kw)


def recency(name: str, column: str, since: Column, threshold: float = 100.0, **kw) -> Metric:
    return Metric(name, "COVERAGE", column, threshold, condition=F.col(column) >= since, **kw)


def within_days(earlier: str, later: str, days: int) -> Column:
    return F.date_diff(F.col(later), F.col(earlier)) <= days


def age_between(born: str, today: Column, low: int, high: int) -> Column:
    return boundary_diff("year", F.col(born), today).between(low, high)


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part * F.lit(100.0) / whole)


def measure(rows: DataFrame, metrics: list[Metric]) -> DataFrame:
    """(metric_name, metric_value): all plain shares in one aggregate over ``rows``.

    Distinct counts and the outlier share need their own grouping, so each of
    those columns is aggregated alone; nothing expands the rows.
    """
    metrics = [m for m in metrics if m.enabled]
    plain = [m for m in metrics if m.condition is not None]
    parts = []
    if plain:
        aggregates = []
        for i, m in enumerate(plain):
            aggregates.append(F.count_if(m.condition).alias(f"p{i}"))
            whole = F.count(F.lit(1)) if m.base is None else F.count_if(m.base)
            aggregates.append(whole.alias(f"w{i}"))
        totals = rows.agg(*aggregates)
        values = [
            F.struct(
                F.lit(m.name).alias("metric_name"),
                (
                    F.when(F.col(f"p{i}") > 0, 100.0).otherwise(0.0)
                    if m.kind == "COVERAGE"
                    else _percent(F.col(f"p{i}"), F.col(f"w{i}"))
                ).alias("metric_value"),
            )
            for i, m in enumerate(plain)
        ]
        parts.append(totals.select(F.explode(F.array(*values)).alias("m")).select("m.*"))
    for column in sorted({m.column for m in metrics if m.kind in ("UNIQUENESS", "DUPLICATE_RATE")}):
        per_value = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        totals = per_value.agg(F.count(column).alias("distinct"), F.sum("n").alias("total"))
        for m in metrics:
            if m.column == column and m.kind == "UNIQUENESS":
                value = _percent(F.col("distinct"), F.col("total"))
            elif m.column == column and m.kind == "DUPLICATE_RATE":
                value = _percent(F.col("total") - F.col("distinct"), F.col("total"))
            else:
                continue
            parts.append(totals.select(F.lit(m.name).alias("metric_name"), value.alias("metric_value")))
    for m in metrics:
        if m.kind == "OUTLIER":
            parts.append(outliers(rows, m.column).select(
                F.lit(m.name).alias("metric_name"), F.col("outlier_pct").alias("metric_value")
            ))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def outliers(rows: DataFrame, column: str, deviations: float = 3.0) -> DataFrame:
    """Share of rows above mean + ``deviations`` sample standard deviations."""
    stats = rows.agg((F.avg(column) + deviations * F.stddev_samp(column)).alias("limit"))
    limit = stats.scalar()
    return rows.agg(
        F.count_if(F.col(column) > limit).alias("outliers"),
        _percent(F.count_if(F.col(column) > limit), F.count(F.lit(1))).alias("outlier_pct"),
    )


def evaluate(measured: DataFrame, metrics: list[Metric]) -> DataFrame:
    """Compare measured values with their thresholds."""
    spark = measured.sparkSession
    definitions = spark.createDataFrame(
        [(m.name, m.kind, m.column, float(m.threshold), m.operator, m.alert) for m in metrics if m.enabled],
        "metric_name string, metric_type string, column_name string, threshold_value double, "
        "threshold_operator string, alert_on_failure boolean",
    )
    joined = measured.join(F.broadcast(definitions), "metric_name")
    return with_verdict(joined)


def measurement_sql(query: str) -> str:
    """Measurement text of a metric definition as Spark SQL; a share of nothing is NULL."""
    return re.sub(r"(/\s*(?:\(\s*SELECT\s+)?)(COUNT\([^()]*\))", r"\1NULLIF(\2, 0)", to_spark(query), flags=re.I)


def run_definitions(definitions: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Enabled metric definitions measured by their own texts, with verdicts.

    All texts of one table are scalar subqueries of one plan. A text that is no
    valid SQL, or whose table is unknown, gives ERROR and the reason in ``error``;
    the other definitions are measured all the same.
    """
    spark = definitions.sparkSession
    rows = collect_metadata(definitions.filter("enabled"))
    parts = []
    for name in sorted({r.target_table for r in rows}):
        frame = tables.get(name)
        wanted = sorted((r for r in rows if r.target_table == name), key=lambda r: r.metric_name)
        good, entries = [], []
        for r in wanted:
            value, error = "CAST(NULL AS DOUBLE)", None
            if frame is None:
                error = f"unknown table {name}"
            else:
                text = f"CAST(({measurement_sql(r.measurement_query or '')}) AS DOUBLE)"
                error = _sql_error(frame, name, text)
                value = value if error else text
            good.append(value)
            entries.append((r, error))
        source = spark.range(1) if frame is None else frame
        totals = _over(source, name, ", ".join(f"{v} AS v{i}" for i, v in enumerate(good)))
        listed = F.array(*[
            F.struct(
                F.lit(r.metric_name).alias("metric_name"), F.lit(name).alias("target_table"),
                F.lit(r.target_column).cast("string").alias("target_column"),
                F.lit(r.metric_type).cast("string").alias("metric_type"), F.col(f"v{i}").alias("metric_value"),
                F.lit(r.threshold_value).cast("double").alias("threshold_value"),
                F.lit(r.threshold_operator).cast("string").alias("threshold_operator"),
                F.lit(bool(r.alert_on_failure)).alias("alert_on_failure"), F.lit(error).cast("string").alias("error"),
            )
            for i, (r, error) in enumerate(entries)
        ])
        parts.append(totals.select(F.explode(listed).alias("m")).select("m.*"))
    if not parts:
        parts = [spark.createDataFrame([], "metric_name string, target_table string, target_column string, "
                                           "metric_type string, metric_value double, threshold_value double, "
                                           "threshold_operator string, alert_on_failure boolean, error string")]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return with_verdict(out).withColumn(
        "pass_fail", F.when(F.col("error").isNotNull(), "ERROR").otherwise(F.col("pass_fail")))


def _over(rows: DataFrame, name: str, select: str) -> DataFrame:
    """One row of scalar subqueries that know ``rows`` as ``name``."""
    text = select.replace("{", "{{").replace("}", "}}")
    return rows.sparkSession.sql(f"WITH `{name}` AS (SELECT * FROM {{_rows}}) SELECT {text}", _rows=rows)


def _sql_error(rows: DataFrame, name: str, text: str) -> str | None:
    try:
        _over(rows, name, text)
    except (AnalysisException, ParseException) as error:
        lines = str(error).strip().splitlines()
        return lines[0] if lines else type(error).__name__
    return None


def with_verdict(rows: DataFrame) -> DataFrame:
    value, limit, op = F.col("metric_value"), F.col("threshold_value"), F.col("threshold_operator")
    ok = (
        F.when(op == ">=", value >= limit)
        .when(op == "<=", value <= limit)
        .when(op == ">", value > limit)
        .when(op == "<", value < limit)
        .when(op == "=", value == limit)
    )
    passed = F.coalesce(ok, F.lit(False))
    return rows.withColumn("pass_fail", F.when(passed, "PASS").otherwise("FAIL")).withColumn(
        "alert", F.col("alert_on_failure") & ~passed
    )


def null_profile(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column: nulls and completeness percent, worst first; one scan."""
    columns = columns or rows.columns
    totals = rows.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)],
    )
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_count"))
            for i, c in enumerate(columns)
        ]
    )
    return (
        totals.select("total", F.explode(entries).alias("e"))
        .select(
            "e.column_name", "e.null_count", F.col("total").alias("row_count"),
            _percent(F.col("total") - F.col("e.null_count"), F.col("total")).alias("completeness_pct"),
        )
        .orderBy(F.desc("null_count"), "column_name")
    )


def table_statistics(rows: DataFrame) -> DataFrame:
    """Rows, columns, distinct values of the first column, latest of the first date-like column."""
    first = rows.columns[0]
    dated = next(
        (f.name for f in rows.schema.fields if re.match(r"date|timestamp", f.dataType.simpleString())),
        None,
    )
    per_value = rows.groupBy(first).agg(
        F.count(F.lit(1)).alias("n"),
        (F.max(dated) if dated else F.lit(None).cast("timestamp_ntz")).alias("latest"),
    )
    return per_value.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.lit(len(rows.columns)).alias("column_count"),
        F.count(first).alias("distinct_keys"),
        F.max("latest").alias("latest_date"),
    )
