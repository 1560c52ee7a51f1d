"""Joins whose keys may be badly skewed, and joins against metadata."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 1000
METADATA_ROWS = 100_000


def collect_metadata(df: DataFrame) -> list:
    """Configuration rows that become expressions of one plan: rules, mappings, columns of a table."""
    return df.collect()


def attach_by_key(
    rows: DataFrame,
    per_key: DataFrame,
    keys: list[str],
    weight: str,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """Left join ``rows`` with one-row-per-key facts, however skewed the keys are.

    ``weight`` names the column of ``per_key`` holding the number of rows of a
    key. The heaviest ``hot_keys`` keys are broadcast (that count bounds the
    broadcast) and their rows are spread over all partitions by a salt; every
    other key holds under ``1 / hot_keys`` of the rows and is joined by shuffle.
    NULL keys join with NULL keys.
    """
    facts = [c for c in per_key.columns if c not in keys]
    hot = per_key.orderBy(F.desc(weight)).limit(hot_keys)
    hot = hot.select(
        *[F.col(k).alias(f"_hk_{k}") for k in keys],
        F.struct(*facts).alias("_hot"),
    )
    same_hot = _all([F.col(k).eqNullSafe(F.col(f"_hk_{k}")) for k in keys])
    marked = rows.join(F.broadcast(hot), same_hot, "left").drop(*[f"_hk_{k}" for k in keys])
    salt = F.when(
        F.col("_hot").isNotNull(), (F.lit(1) + F.spark_partition_id()).cast("bigint")
    ).otherwise(F.lit(0).cast("bigint"))
    marked = marked.withColumn("_salt", salt)
    # Always zero, but not a literal: a constant would be folded out of the join
    # keys and the hot rows would meet in one partition again.
    zero = F.least(F.col(weight), F.lit(0)).cast("bigint")
    cold = per_key.select(
        *[F.col(k).alias(f"_ck_{k}") for k in keys],
        zero.alias("_csalt"),
        F.struct(*facts).alias("_cold"),
    )
    same_cold = _all(
        [F.col("_salt") == F.col("_csalt")]
        + [F.col(k).eqNullSafe(F.col(f"_ck_{k}")) for k in keys]
    )
    joined = marked.join(cold, same_cold, "left")
    return joined.select(
        *[F.col(c) for c in rows.columns],
        *[F.coalesce(F.col(f"_hot.{f}"), F.col(f"_cold.{f}")).alias(f) for f in facts],
    )


def with_key_count(rows: DataFrame, keys: list[str], name: str = "key_count") -> DataFrame:
    """Add the number of rows sharing the key (partial counts, then a skew-safe join)."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return attach_by_key(rows, counts, keys, name)


def with_key_sum(rows: DataFrame, keys: list[str], value: str, name: str, how: str = "sum") -> DataFrame:
    """Derived column holding a per-key ``sum``, ``avg`` or ``count`` of ``value``."""
    aggregate = {"sum": F.sum, "avg": F.avg, "count": F.count}[how](value)
    facts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), aggregate.alias(name))
    return attach_by_key(rows, facts, keys, "_n").drop("_n")


def latest_files(raw: DataFrame) -> DataFrame:
    """Distinct (file, provider) pairs, pre-aggregated before the shuffle."""
    return raw.select("file_name", "tpa").distinct()


def queue_with_provider(queue: DataFrame, raw: DataFrame) -> DataFrame:
    return queue.join(latest_files(raw), "file_name", "left").withColumn(
        "tpa", F.coalesce("tpa", F.lit("N/A"))
    )


def effective_mappings(mappings: DataFrame, tpa: str | None = None) -> DataFrame:
    """Approved mappings where a provider's own row beats the global one.

    With ``tpa`` the result is that provider's view; without it one row per
    provider named in ``mappings`` and target column.
    """
    approved = mappings.filter("approved")
    facts = ["mapping_id", "source_field", "transformation_logic", "confidence_score"]
    slot = ["target_table", "target_column"]
    own = approved.filter(F.col("tpa").isNotNull() if tpa is None else F.col("tpa") == tpa)
    own = own.select("tpa", *slot, F.struct(*facts).alias("own"))
    shared = approved.filter(F.col("tpa").isNull()).select(*slot, F.struct(*facts).alias("shared"))
    if tpa is None:
        providers = own.agg(F.collect_set("tpa").alias("tpas")).scalar()
        shared = shared.withColumn("_tpas", providers).withColumn("tpa", F.explode_outer("_tpas")).drop("_tpas")
        merged = own.join(shared, ["tpa", *slot], "full")
    else:
        merged = own.drop("tpa").join(shared, slot, "full").withColumn("tpa", F.lit(tpa))
    pick = F.coalesce("own", "shared")
    return merged.select(
        "tpa", *slot,
        *[pick[f].alias(f) for f in facts],
        F.when(F.col("own").isNotNull(), "TPA-Specific").otherwise("Global").alias("mapping_source"),
    )


def join_any(left: DataFrame, right: DataFrame, branches: list[Column]) -> DataFrame:
    """Inner join on ``branches[0] OR branches[1] OR ...``, one equi join per branch.

    A disjunction has no key to hash or shuffle by, but each branch, an AND with at
    least one equality, does. A pair that fits several branches comes from the first
    of them; a branch that is NULL does not hold. Column names of the sides differ.
    """
    found = []
    for place, branch in enumerate(branches):
        fresh = [~F.coalesce(earlier, F.lit(False)) for earlier in branches[:place]]
        found.append(left.join(right, _all([branch, *fresh])))
    return reduce(DataFrame.unionByName, found)


def bounded_broadcast(df: DataFrame, limit: int = METADATA_ROWS) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``limit`` rows; else leave the choice to AQE."""
    return F.broadcast(df) if is_small(df, limit) else df


def is_small(df: DataFrame, limit: int = METADATA_ROWS) -> bool:
    return df.limit(limit + 1).count() <= limit


def attach_reference(rows: DataFrame, column: str, facts: DataFrame, key: str) -> DataFrame:
    """Left join with a reference table holding one row per ``key``.

    A small reference is broadcast after its size was checked. A large one is
    joined by key counts, so a hot value of ``column`` is spread out. A NULL
    value finds nothing.
    """
    facts = facts.filter(F.col(key).isNotNull())
    if is_small(facts):
        return rows.join(F.broadcast(facts), F.col(column) == F.col(key), "left").drop(key)
    weights = rows.groupBy(column).agg(F.count(F.lit(1)).alias("_weight"))
    per_value = weights.join(facts, F.col(column) == F.col(key), "left").drop(key)
    return attach_by_key(rows, per_value, [column], "_weight").drop("_weight")


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for condition in conditions[1:]:
        out = out & condition
    return out
