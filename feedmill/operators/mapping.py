"""Proposing, checking and approving source-field to target-column mappings."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from feedmill.functions.text import normalise_name
from feedmill.functions.variant import fields_of
from feedmill.operators.dedup import top_per_group
from feedmill.operators.joins import bounded_broadcast
from feedmill.operators.merge import rows_to_insert, update_where
from feedmill.session import stage

MAPPING_KEY = ["source_field", "target_table", "target_column", "tpa"]
# How a mapping may come about.
METHODS = ["MANUAL", "ML_AUTO", "LLM_CORTEX", "SYSTEM"]
# Weights of the combined score.
WEIGHTS = {"exact": 0.4, "substring": 0.2, "sequence": 0.2, "word": 0.2}
BASIC_WEIGHT, TFIDF_WEIGHT = 0.7, 0.3
# Without a shared pair of letters only one-letter matches score, at most this much.
UNPAIRED_SCORE = BASIC_WEIGHT * (WEIGHTS["substring"] + WEIGHTS["sequence"] + WEIGHTS["word"])


def source_fields(raw: DataFrame, tpa: str | None = None, limit: int | None = None) -> DataFrame:
    """Distinct field names of the raw objects, optionally of one provider."""
    rows = raw if tpa is None else raw.filter(F.col("tpa") == tpa)
    names = fields_of(rows.select("raw_data"), "raw_data").select("field_name")
    names = names.filter("field_name IS NOT NULL").distinct()
    return names if limit is None else names.orderBy("field_name").limit(limit)


def field_inventory(raw: DataFrame) -> DataFrame:
    """Per field: how often it occurs and in how many files."""
    per_file = (
        fields_of(raw.select("file_name", "raw_data"), "raw_data")
        .filter("field_name IS NOT NULL")
        .groupBy("field_name", "file_name")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_file.groupBy(F.col("field_name").alias("source_field_name")).agg(
        F.sum("n").alias("occurrence_count"), F.count("file_name").alias("file_count")
    )


@F.pandas_udf(DoubleType())
def sequence_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Matching-block similarity (2 * matched / total characters)."""
    return pd.Series(
        [SequenceMatcher(None, a, b).ratio() if a and b else 0.0 for a, b in zip(left, right)],
        dtype="float64",
    )


def word_overlap(left: Column, right: Column) -> Column:
    words = lambda c: F.filter(F.array_distinct(F.split(c, " +")), lambda w: w != "")
    a, b = words(left), words(right)
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(
        F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))
    )


def substring_score(left: Column, right: Column) -> Column:
    return F.when((left == "") | (right == ""), 0.0).when(
        F.contains(left, right) | F.contains(right, left), 1.0
    ).otherwise(0.0)


def _grams(names: DataFrame, text: str, sizes: list[int], keep: list[str]) -> DataFrame:
    collapsed = F.regexp_replace(F.col(text), r"\s+", " ")
    slices = [
        F.when(
            F.length("_t") >= n,
            F.transform(F.sequence(F.lit(1), F.length("_t") - (n - 1)), lambda i: F.substring("_t", i, n)),
        ).otherwise(F.array().cast("array<string>"))
        for n in sizes
    ]
    return names.withColumn("_t", collapsed).select(*keep, F.explode(F.concat(*slices)).alias("gram"))


def gram_weights(documents: DataFrame) -> DataFrame:
    """L2-normalised tf-idf of 2- and 3-letter pieces.

    ``documents`` has ``name`` and ``copies``: equal names count as that many
    documents in the smoothed inverse document frequency.
    """
    terms = _grams(documents, "name", [2, 3], ["name", "copies"])
    tf = terms.groupBy("name", "copies", "gram").agg(F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy("gram").agg(F.sum("copies").alias("df"))
    total = documents.agg(F.sum("copies").alias("n")).scalar()
    weighted = tf.join(df, "gram").select(
        "name", "gram",
        (F.col("tf") * (F.log((1 + total) / (1 + F.col("df"))) + 1)).alias("w"),
    )
    norms = weighted.groupBy("name").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighted.join(norms, "name").select("name", "gram", (F.col("w") / F.col("norm")).alias("w"))


def gram_cosines(weights: DataFrame, sources: DataFrame, targets: DataFrame) -> DataFrame:
    """Cosine of every (s, t) pair of names sharing a piece; the rest is zero."""
    left = weights.join(sources, F.col("name") == F.col("s"), "left_semi").select(
        F.col("name").alias("s"), "gram", F.col("w").alias("ws"))
    right = weights.join(targets, F.col("name") == F.col("t"), "left_semi").select(
        F.col("name").alias("t"), "gram", F.col("w").alias("wt"))
    return left.join(right, "gram").groupBy("s", "t").agg(F.sum(F.col("ws") * F.col("wt")).alias("tfidf"))


def shared_pieces(s_names: DataFrame, t_names: DataFrame, size: int) -> DataFrame:
    """(s, t) of names that share a piece of ``size`` letters."""
    pieces = lambda names, c: _grams(names, c, [size], [c]).distinct()
    return pieces(s_names, "s").join(pieces(t_names, "t"), "gram").select("s", "t").distinct()


def score_pairs(sources: DataFrame, targets: DataFrame, min_confidence: float = 0.6) -> DataFrame:
    """Scores of (source_field, target_table, target_column) pairs at or above the minimum.

    Pairs meet on a shared piece of the normalised name (two letters, or one
    letter when the minimum is low enough for that to matter), so no pair that
    can reach the minimum is missed and no all-pairs product is formed. Names
    and weights are written once, as each is read several times.
    """
    if min_confidence <= 0:
        raise ValueError("min_confidence must be above zero")
    src = stage(
        sources.select("source_field").distinct().withColumn("s", normalise_name(F.col("source_field"))),
        "source_names",
    )
    tgt = stage(
        targets.select("target_table", "target_column").distinct()
        .withColumn("t", normalise_name(F.col("target_column"))),
        "target_names",
    )
    copies = src.select(F.col("s").alias("name")).unionByName(tgt.select(F.col("t").alias("name")))
    documents = copies.groupBy("name").agg(F.count(F.lit(1)).alias("copies"))
    weights = stage(gram_weights(stage(documents, "names")), "gram_weights")
    s_names, t_names = src.select("s").distinct(), tgt.select("t").distinct()
    dots = gram_cosines(weights, s_names, t_names)
    candidates = dots.unionByName(
        s_names.join(t_names, F.col("s") == F.col("t")).withColumn("tfidf", F.lit(0.0))
    )
    if min_confidence <= UNPAIRED_SCORE:
        met = shared_pieces(s_names, t_names, 1)
        candidates = candidates.unionByName(met.withColumn("tfidf", F.lit(0.0)))
    pairs = candidates.groupBy("s", "t").agg(F.max("tfidf").alias("tfidf"))
    scored = pairs.select(
        "s", "t", "tfidf",
        F.when(F.col("s") == F.col("t"), 1.0).otherwise(0.0).alias("exact"),
        substring_score(F.col("s"), F.col("t")).alias("substring"),
        sequence_ratio("s", "t").alias("sequence"),
        word_overlap(F.col("s"), F.col("t")).alias("word"),
    )
    basic = sum((F.col(name) * weight for name, weight in WEIGHTS.items()), F.lit(0.0))
    scored = scored.withColumn("combined", basic * BASIC_WEIGHT + F.col("tfidf") * TFIDF_WEIGHT)
    scored = scored.filter(F.col("combined") >= min_confidence)
    return (
        scored.join(src, "s").join(tgt, "t")
        .select(
            "source_field", "target_table", "target_column",
            F.round("combined", 4).alias("combined_score"),
            F.round("exact", 4).alias("exact_score"),
            F.round("substring", 4).alias("substring_score"),
            F.round("sequence", 4).alias("sequence_score"),
            F.round("word", 4).alias("word_overlap"),
            F.round("tfidf", 4).alias("tfidf_score"),
        )
    )


def propose_mappings(
    sources: DataFrame,
    targets: DataFrame,
    existing: DataFrame,
    tpa: str,
    source_table: str = "RAW_DATA_TABLE",
    top_n: int = 3,
    min_confidence: float = 0.6,
) -> DataFrame:
    """New unapproved ML_AUTO mappings: best ``top_n`` targets per source field."""
    if not tpa:
        raise ValueError("tpa is required")
    scored = score_pairs(sources, targets, min_confidence)
    best = top_per_group(
        scored, ["source_field"],
        [F.desc("combined_score"), F.asc("target_table"), F.asc("target_column")], top_n,
    )
    note = F.concat(
        F.lit("Scores: Exact="), F.col("exact_score").cast("string"),
        F.lit(", Substring="), F.col("substring_score").cast("string"),
        F.lit(", Sequence="), F.col("sequence_score").cast("string"),
        F.lit(", WordOverlap="), F.col("word_overlap").cast("string"),
        F.lit(", TFIDF="), F.col("tfidf_score").cast("string"),
        F.lit(", Rank="), F.col("match_rank").cast("string"),
    )
    proposed = best.select(
        "source_field", F.lit(source_table).alias("source_table"), "target_table", "target_column",
        F.lit(tpa).alias("tpa"), F.lit("ML_AUTO").alias("mapping_method"),
        F.col("combined_score").alias("confidence_score"), note.alias("transformation_logic"),
        F.lit(False).alias("approved"),
    )
    return rows_to_insert(proposed, existing, MAPPING_KEY)


def propose_synonyms(sources: DataFrame, known: DataFrame, targets: DataFrame) -> DataFrame:
    """Source fields whose target column is listed in the known-mapping dictionary."""
    pairs = known.filter("active").select(
        F.upper(F.trim("source_field")).alias("_s"), F.upper(F.trim("target_field")).alias("_t")
    ).distinct()
    return (
        sources.join(bounded_broadcast(pairs), F.upper(F.trim("source_field")) == F.col("_s"))
        .join(targets, F.upper("target_column") == F.col("_t"))
        .select("source_field", "target_table", "target_column")
    )


def approve(mappings: DataFrame, condition: Column, by: str, at: Column) -> DataFrame:
    return update_where(
        mappings, condition,
        {"approved": F.lit(True), "approved_by": F.lit(by), "approved_timestamp": at},
    )


def unapprove(mappings: DataFrame, condition: Column) -> DataFrame:
    return update_where(
        mappings, condition,
        {"approved": F.lit(False), "approved_by": F.lit(None), "approved_timestamp": F.lit(None)},
    )


def confident_pending(target_table: str, min_confidence: float = 0.8) -> Column:
    """Unapproved mappings of a table good enough to approve together."""
    return (
        (F.upper("target_table") == target_table.upper())
        & (F.col("confidence_score") >= min_confidence)
        & ~F.col("approved")
    )


def orphan_mappings(mappings: DataFrame, schemas: DataFrame) -> DataFrame:
    """Mappings whose target column is not an active column."""
    known = schemas.filter("active").select(
        F.col("table_name").alias("target_table"), F.col("column_name").alias("target_column")
    ).distinct()
    return mappings.join(known, ["target_table", "target_column"], "left_anti")


def validate_mappings(mappings: DataFrame, schemas: DataFrame, target_table: str | None = None) -> DataFrame:
    """One row: duplicate, orphan and bad-method counts and the verdict text."""
    chosen = mappings if target_table is None else mappings.filter(
        F.col("target_table") == target_table.upper()
    )
    key = ["source_field", "source_table", "target_table", "target_column"]
    duplicates = (
        chosen.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        .agg(F.count(F.lit(1)).alias("duplicate_count"))
    )
    orphans = orphan_mappings(chosen, schemas).agg(F.count(F.lit(1)).alias("n")).scalar()
    invalid = chosen.filter(~F.col("mapping_method").isin(*METHODS)).agg(F.count(F.lit(1)).alias("n")).scalar()
    counted = duplicates.select(
        "duplicate_count", orphans.alias("orphan_count"), invalid.alias("invalid_method_count")
    )
    part = lambda c, text: F.when(F.col(c) > 0, F.concat(F.col(c).cast("string"), F.lit(text))).otherwise("")
    problems = F.concat(
        part("duplicate_count", " duplicate mapping(s) detected. "),
        part("orphan_count", " mapping(s) to non-existent target columns. "),
        part("invalid_method_count", " mapping(s) with invalid method. "),
    )
    scope = "all field mappings" if target_table is None else f"table: {target_table.upper()}"
    failed_scope = "field mappings" if target_table is None else scope
    return counted.withColumn(
        "message",
        F.when(problems == "", F.lit(f"Validation passed for {scope}")).otherwise(
            F.concat(F.lit(f"Validation FAILED for {failed_scope} - Errors: "), problems)
        ),
    )
