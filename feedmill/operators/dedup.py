"""Duplicate handling: keep one, mark, combine, or match approximately."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.operators.components import connected_components
from feedmill.operators.joins import with_key_count
from feedmill.session import stage


def keep_one(rows: DataFrame, keys: list, order: list[Column]) -> DataFrame:
    """First row per key under ``order``.

    ``row_number() = 1`` lets Spark drop all but one row per key before the
    shuffle (WindowGroupLimit), so a hot key costs one row per input partition.
    """
    spec = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(spec)).filter("_rn = 1").drop("_rn")


def keep_first(rows: DataFrame, keys: list[str], row_id: str = "raw_id") -> DataFrame:
    return keep_one(rows, keys, [F.asc(row_id)])


def keep_last(rows: DataFrame, keys: list[str], row_id: str = "raw_id") -> DataFrame:
    return keep_one(rows, keys, [F.desc(row_id)])


def top_per_group(rows: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The ``n`` best rows per group with their rank."""
    spec = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("match_rank", F.row_number().over(spec)).filter(F.col("match_rank") <= n)


def mark_duplicates(rows: DataFrame, keys: list[str], name: str = "is_duplicate") -> DataFrame:
    """Flag every member of a key that occurs more than once."""
    return with_key_count(rows, keys, "_count").withColumn(name, F.col("_count") > 1).drop("_count")


def split_all_duplicates(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a unique key, all members of repeated keys). NULL keys never match."""
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    marked = with_key_count(rows, keys, "_count")
    repeated = complete & (F.col("_count") > 1)
    return marked.filter(~repeated).drop("_count"), marked.filter(repeated).drop("_count")


def merge_duplicates(
    rows: DataFrame, keys: list[str], row_id: str = "raw_id", columns: list[str] | None = None
) -> DataFrame:
    """One row per key: each column takes its latest non-null value."""
    columns = columns or [c for c in rows.columns if c not in keys and c != row_id]
    return rows.groupBy(*keys).agg(
        F.max(row_id).alias(row_id),
        *[
            F.max_by(c, F.when(F.col(c).isNotNull(), F.col(row_id))).alias(c)
            for c in columns
        ],
    )


def duplicate_count(rows: DataFrame, keys: list[str], name: str = "duplicate_count") -> DataFrame:
    """Rows minus distinct complete keys, as one row."""
    per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    return per_key.agg(
        (F.coalesce(F.sum("_n"), F.lit(0)) - F.count(F.when(complete, 1))).alias(name)
    )


# -- approximate matching ----------------------------------------------------

def allowed_edits(length: Column, threshold: float) -> Column:
    """Most edits two strings may differ by when the longer has ``length`` characters."""
    return F.floor(length * F.lit(round(1.0 - threshold, 9)) + F.lit(1e-9)).cast("int")


_SHORT_EDITS = 3


def similar_names(names: DataFrame, name: str, within: list[str], threshold: float) -> DataFrame:
    """Pairs (``a``, ``b``) of distinct names, a < b, at least ``threshold`` alike.

    Names allowing up to three edits meet on a shared deletion variant: two
    strings d edits apart become equal after at most d deletions from each.
    Few distinct names can share a variant, so candidates stay close to the
    answer even when all names have the same prefix. Longer names meet on
    an unchanged segment. Both ways miss nothing; candidates are then verified.
    A name becomes hundreds of rows, which the planner counts as one: names are
    dealt to all tasks first, and every join on their pieces is a shuffled one.
    """
    distinct = names.select(*within, F.col(name).alias("a")).filter("a IS NOT NULL").distinct()
    parts = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a hash of the columns: dealt by the columns themselves, the shuffle is left out and tasks are few
    distinct = distinct.repartition(parts, F.xxhash64(*within, "a"))
    distinct = distinct.withColumn("len", F.length("a")).withColumn(
        "d", allowed_edits(F.col("len"), threshold)
    )
    candidates = _variant_candidates(distinct, within).unionByName(
        _segment_candidates(distinct, within, threshold)
    )
    pairs = candidates.distinct().filter(
        F.levenshtein("long_name", "short_name") <= F.col("d")
    )
    return pairs.select(
        *within,
        F.least("long_name", "short_name").alias("a"),
        F.greatest("long_name", "short_name").alias("b"),
    )


def _longer_first(left: str, right: str) -> Column:
    """True when ``left`` is the longer name (ties: the greater one)."""
    return (F.length(left) > F.length(right)) | (
        (F.length(left) == F.length(right)) & (F.col(left) > F.col(right))
    )


def _variant_candidates(distinct: DataFrame, within: list[str]) -> DataFrame:
    step = (
        "flatten(transform(v, x -> transform("
        "CASE WHEN x.at <= length(x.t) THEN sequence(x.at, length(x.t)) ELSE array() END, p -> "
        "named_struct('at', p, 't', concat(substring(x.t, 1, p - 1), substring(x.t, p + 1))))))"
    )
    short = distinct.filter(F.col("d") <= _SHORT_EDITS)
    levels = short.withColumn("v", F.expr("array(named_struct('at', 1, 't', a))"))
    levels = levels.withColumn("all", F.expr("transform(v, x -> x.t)"))
    for used in range(1, _SHORT_EDITS + 1):
        levels = levels.withColumn("v", F.when(F.col("d") >= used, F.expr(step)).otherwise(F.expr("filter(v, x -> false)")))
        levels = levels.withColumn("all", F.expr("concat(all, transform(v, x -> x.t))"))
    variants = levels.select(
        *within, "a", "d", F.explode(F.array_distinct("all")).alias("variant")
    ).withColumn("variant", F.xxhash64(*within, "variant"))
    # both sides hold the same columns, so that one shuffle serves both
    left = variants.withColumnsRenamed({"a": "long_name", "d": "long_d"})
    right = variants.withColumnsRenamed({"a": "short_name", "d": "short_d"})
    return (
        left.hint("merge").join(right, ["variant", *within])
        .filter(_longer_first("long_name", "short_name"))
        .select(*within, "long_name", "short_name", F.greatest("long_d", "short_d").alias("d"))
    )


def _segment_candidates(distinct: DataFrame, within: list[str], threshold: float) -> DataFrame:
    """Cut the longer name into d + 1 pieces: one survives in the shorter, moved by at most d."""
    ratio = round(threshold, 9)
    cut = lambda k: F.floor(F.col("long_len") * k / (F.col("d") + 1)).cast("int")

    def with_pieces(df: DataFrame) -> DataFrame:
        out = df.filter(F.col("d") > _SHORT_EDITS)
        out = out.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("d"))))
        return out.withColumn("at", cut(F.col("piece"))).withColumn(
            "size", cut(F.col("piece") + 1) - F.col("at")
        )

    left = with_pieces(distinct.withColumn("long_len", F.col("len"))).select(
        *within, F.col("a").alias("long_name"), "d", "piece", "long_len",
        F.expr("substring(a, at + 1, size)").alias("text"),
    )
    shorter = distinct.withColumn(
        "long_len",
        F.explode(F.sequence(F.col("len"), F.floor(F.col("len") / ratio + 1e-9).cast("int"))),
    ).withColumn("d", allowed_edits(F.col("long_len"), threshold))
    shorter = with_pieces(shorter).withColumn(
        "shift", F.explode(F.sequence(-F.col("d"), F.col("d")))
    ).filter("at + shift >= 0 AND at + shift + size <= len")
    right = shorter.select(
        *within, F.col("a").alias("short_name"), "piece", "long_len",
        F.expr("substring(a, at + shift + 1, size)").alias("text"),
    ).distinct()
    return (
        left.hint("merge").join(right, [*within, "long_len", "piece", "text"])
        .filter(_longer_first("long_name", "short_name"))
        .select(*within, "long_name", "short_name", "d")
    )


def drop_fuzzy_duplicates(
    rows: DataFrame,
    name: str,
    within: list[str],
    threshold: float = 0.85,
    row_id: str = "raw_id",
    keep: str = "LAST",
) -> DataFrame:
    """Keep the last (``LAST``) or first row of every group of similar names.

    Groups are connected: names linked through others belong together. Equal
    names are folded first and written once, so matching runs over distinct
    names and a hot name costs one entry; ``within`` names the columns that must
    be equal. Rows without a name stay.
    """
    if keep not in ("LAST", "FIRST"):
        raise ValueError(f"unknown keep: {keep}")
    edge = F.max if keep == "LAST" else F.min
    named = rows.filter(F.col(name).isNotNull())
    per_name = stage(named.groupBy(*within, name).agg(edge(row_id).alias("_edge")), "names")
    pairs = similar_names(per_name, name, within, threshold)
    for side in ("a", "b"):
        ids = per_name.select(*within, F.col(name).alias(side), F.col("_edge").alias(f"_{side}"))
        pairs = pairs.join(ids.hint("merge"), [*within, side])
    groups = connected_components(pairs.select(F.col("_a").alias("a"), F.col("_b").alias("b")))
    member = per_name.select("_edge").join(groups, F.col("_edge") == F.col("node"), "left")
    winners = member.groupBy(F.coalesce("component", "_edge").alias("_group")).agg(edge("_edge").alias(row_id))
    unnamed = rows.filter(F.col(name).isNull())
    return rows.join(winners.select(row_id), row_id, "left_semi").unionByName(unnamed)
