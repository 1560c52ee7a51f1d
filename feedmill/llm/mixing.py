"""Mixing sources to target weights by weighted fair queueing.

Every source queues its documents in shuffled order, pass after pass. A document
finishes at the virtual time at which its source, served at its target's rate,
has sent all words up to and including it: cumulative words divided by target.
All queues are then served in order of finish time until the budget, the sum of
all targets, is used up.

Orders are never built in one task: the shuffle order and the virtual time are
cut into fixed buckets, bucket sums are accumulated over the few buckets, and the
running sum inside a bucket starts from there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.session import stage

WEIGHTS = (5.0, 2.0, 1.0)
MAX_PASSES = 3
BUCKETS = 4096


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def shuffle_order(doc_id: Column) -> Column:
    """60 bits of md5 of the id as text; ids that are null come first."""
    return F.coalesce(F.conv(F.substring(F.md5(doc_id.cast("string")), 1, 15), 16, 10).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MAX_PASSES) -> DataFrame:
    """source, source_size, target from (source, source_size), one row per source.

    Weights repeat over the sources by code point, null last. A target stops at
    ``most`` times the source's size; the excess is shared again by weight. In
    order of size per weight the stopped sources come first: with S words still to
    share among weights W, a source of size s and weight w stops if most * s / w <=
    S / W, and all that follow the last stopped one get w * S / W.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_need = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    picked = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = (
        sizes.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", picked).withColumn("cap", F.col("source_size") * float(most))
        .withColumn("left_size", F.sum("source_size").over(everything).cast("double")
                    - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("left_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("stops", F.col("cap") * F.col("left_weight") <= F.col("weight") * F.col("left_size"))
        .withColumn("level", F.min(F.when(~F.col("stops"), F.struct(F.col("cap") / F.col("weight"), "source", "left_size", "left_weight"))).over(everything))
    )
    share = F.col("weight") * F.col("level.left_size") / F.col("level.left_weight")
    return ranked.select(
        "source", "source_size", F.when(F.col("stops"), F.col("cap")).otherwise(share).alias("target")
    )


def _running(rows: DataFrame, keys: list[str], bucket: str, order: list[Column], value: str, name: str) -> DataFrame:
    """Running sum of ``value`` per key over ``order``, whose prefix is ``bucket``."""
    per_bucket = rows.groupBy(*keys, bucket).agg(F.sum(value).alias("bucket_sum"))
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = per_bucket.select(
        *[F.col(k).alias(f"s_{k}") for k in (*keys, bucket)],
        F.coalesce(F.sum("bucket_sum").over(earlier), F.lit(0).cast("long")).alias("bucket_start"),
    )
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    same = [F.col(k).eqNullSafe(F.col(f"s_{k}")) for k in (*keys, bucket)]
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    return (
        rows.withColumn("inside", F.sum(value).over(inside)).join(starts, condition)
        .withColumn(name, F.col("bucket_start") + F.col("inside")).select(*rows.columns, name)
    )


def _time_bucket(finish: Column) -> Column:
    """Monotone in the finish time: fine up to twice the budget, coarse beyond."""
    fine = F.least(finish, F.lit(2.0)) * BUCKETS
    coarse = F.greatest(finish - 2.0, F.lit(0.0)) * 64
    return (F.floor(fine) + F.floor(coarse)).cast("long")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MAX_PASSES) -> DataFrame:
    """doc_id, source, size, source_size, target, sent, copies and taken (words) of every document.

    ``copies`` is how often the mix takes the document, 0 to ``most``; ``sent`` the
    words its source has sent with it in one pass. Null and empty texts have size 0
    and are never taken; a source without words has target 0. Rows that repeat an
    id are documents of their own, queued one after the other. The order depends on
    the ids only, so reruns agree. An empty table gives no rows.
    """
    sized = stage(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
    ).withColumn("row", F.monotonically_increasing_id()), "document-sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, most).withColumnRenamed("source", "of_source")
    budget = sized.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    queued = (
        sized.withColumn("order", shuffle_order(F.col("doc_id")))
        .withColumn("bucket", F.shiftright("order", 60 - (BUCKETS.bit_length() - 1)))
    )
    place = [F.col(c) for c in ("order", "doc_id", "size", "row")]
    sent = _running(queued, ["source"], "bucket", place, "size", "sent").drop("order", "bucket")
    joined = sent.join(targets, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    passes = F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("pass")
    finish = F.when(F.col("target") > 0, (F.col("pass") * F.col("source_size") + F.col("sent")) / F.col("target"))
    served = stage(
        joined.select("*", passes).withColumn("finish", F.coalesce(finish, F.lit(0.0)))
        .withColumn("time", _time_bucket(F.col("finish"))).withColumn("all", F.lit(1)), "finish-times",
    )
    order = [F.col("finish"), F.col("source").asc_nulls_last(), F.col("sent"), F.col("doc_id"), F.col("row")]
    counted = _running(served, ["all"], "time", order, "size", "served")
    copies = F.sum(((F.col("served") <= budget) & (F.col("size") > 0)).cast("int")).alias("copies")
    return (
        counted.groupBy("row", "doc_id", "source", "size", "source_size", "target", "sent").agg(copies)
        .withColumn("taken", F.col("copies") * F.col("size")).drop("row")
    )


def take(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MAX_PASSES) -> DataFrame:
    """The rows of ``docs``, with all their columns, each as often as the mix takes it."""
    keys = ["k_id", "k_source", "k_size", "k_place"]
    mixed = mix(docs, weights, most).select(
        F.col("doc_id").alias("k_id"), F.col("source").alias("k_source"), F.col("size").alias("k_size"), "copies",
        F.row_number().over(Window.partitionBy("doc_id", "source", "size").orderBy("sent")).alias("k_place"),
    ).where(F.col("copies") > 0)
    rows = docs.select(
        F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"),
        F.col("source").cast("string").alias("of_source"), word_count(F.col("text")).alias("words"),
        F.col("text").cast("string").alias("words_of"),
    ).withColumn("place", F.row_number().over(
        Window.partitionBy("id", "of_source", "words").orderBy("words_of")
    )).drop("words_of")
    same = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(keys, ("id", "of_source", "words", "place"))]
    return (
        rows.join(mixed, same[0] & same[1] & same[2] & same[3])
        .select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
        .select("row.*")
    )
