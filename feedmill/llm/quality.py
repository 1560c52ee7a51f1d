"""Quality classifier: supervised subword embeddings.

Every word of a text contributes its own hashed vector and those of its character
n-grams (3 to 5 bytes of ``<word>``), every two neighbouring words that of their
bigram; a word followed by itself is the same bigram whatever the word. A document
is the average of the vectors of all its features, a softmax layer on top gives
the class. Vectors and
layer are learned together by stochastic gradient descent in numpy, on a bounded
sample of labelled rows. Scoring is linear in the features, so every feature has
one number, the log odds it adds; only that vector is sent to the executors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedmill.llm.words import id_and_text, ragged, slices, sums_between, utf8, word_table

BUCKET_BITS = 18
DIMENSIONS = 16
GRAMS = (3, 4, 5)
REPEATED = 0xA0761D6478BD642F
SAMPLE_PER_CLASS = 400
EPOCHS = 6
RATE = 2.0
SLICE_BYTES = 1 << 20  # of texts that are scored together
TRAINED_AT_ONCE = 16  # texts whose features, or 1024 times as many buckets whose vectors, are made together


def _spread(values: np.ndarray) -> np.ndarray:
    """Bucket of each 64-bit code."""
    return ((values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def word_features(distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature buckets of all words, where each word's begin and end, hash of each word).

    The empty word has no features.
    """
    data, bounds = utf8(distinct)
    lengths = np.diff(bounds)
    # <word> for every word, in one buffer
    begins = bounds[:-1] + 2 * np.arange(len(lengths))
    framed = np.full(len(data) + 2 * len(lengths), ord(">"), np.uint8)
    framed[begins] = ord("<")
    if len(data):
        framed[ragged(begins + 1, lengths)] = data
    sizes = np.where(lengths > 0, lengths + 2, 0)
    powers = framed.astype(np.uint64) + np.uint64(1)
    parts, counts = [], []
    for n in GRAMS:
        rows = np.maximum(sizes - n + 1, 0)
        at = ragged(begins, rows)
        code = np.full(len(at), n, np.uint64)
        for k in range(n):
            code = code * np.uint64(1_000_003) + powers[at + k]
        parts.append(_spread(code))
        counts.append(rows)
    # the word itself: a polynomial over its bytes, from a running sum of weighted bytes
    with np.errstate(over="ignore"):
        weights = np.cumprod(np.full(int(sizes.max(initial=0)) + 1, 0x100000001B3, np.uint64), dtype=np.uint64)
        inside = ragged(begins, sizes)
        place = np.arange(len(inside)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        running = np.zeros(len(inside) + 1, np.uint64)
        np.cumsum(powers[inside] * weights[place], out=running[1:], dtype=np.uint64)
        ends = np.cumsum(sizes)
        whole = running[ends] - running[ends - sizes]
    has_word = (sizes > 0).astype(np.int64)
    parts.append(_spread(whole ^ np.uint64(0xD6E8FEB86659FD93))[has_word > 0])
    counts.append(has_word)
    per_word = sum(counts)
    out_bounds = np.concatenate(([0], np.cumsum(per_word)))
    out = np.empty(int(out_bounds[-1]), np.int64)
    filled = out_bounds[:-1].copy()
    for values, rows in zip(parts, counts):
        out[ragged(filled, rows)] = values
        filled += rows
    return out, out_bounds, whole


def bigram_features(codes: np.ndarray, bounds: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each word's bigram with the next, 1 where there is one); none across texts or empty words."""
    follows = np.zeros(len(codes), bool)
    if len(codes) > 1:
        inside = np.ones(len(codes), bool)
        inside[bounds[1:-1][bounds[1:-1] < len(codes)]] = False
        empty = (np.diff(ends) == 0)[codes]
        follows[:-1] = inside[1:] & ~empty[1:] & ~empty[:-1]
    following = np.roll(codes, -1)
    pair = hashes[codes] * np.uint64(0x9E3779B97F4A7C15) + hashes[following]
    return _spread(np.where(codes == following, np.uint64(REPEATED), pair)), follows


def document_features(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(distinct buckets, counts) of each text."""
    codes, bounds, distinct = word_table(pa.array([t or "" for t in texts], pa.string()))
    features, ends, hashes = word_features(distinct)
    pairs, follows = bigram_features(codes, bounds, ends, hashes)
    lengths = np.diff(ends)
    out = []
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        words, times = np.unique(codes[lo:hi], return_counts=True)
        bigrams = pairs[lo:hi][follows[lo:hi]]
        found = np.concatenate([features[ragged(ends[words], lengths[words])], bigrams])
        weight = np.concatenate([np.repeat(times, lengths[words]), np.ones(len(bigrams), np.int64)])
        buckets, where = np.unique(found, return_inverse=True)
        out.append((buckets, np.bincount(where, weight, len(buckets))))
    return out


def train(texts: list[str | None], labels: list[int], prior: float | None = None, seed: int = 7) -> tuple[np.ndarray, float]:
    """(log odds per bucket, bias) of class 1 against class 0.

    Without two classes the bias alone decides: the only class seen, or 1/2 if none.
    ``prior`` is the share of class 1 where it differs from the sample's.
    """
    size = 1 << BUCKET_BITS
    ones = sum(labels)
    if not labels or ones in (0, len(labels)):
        return np.zeros(size, np.float32), 0.0 if not labels else (5.0 if ones else -5.0)
    rng = np.random.default_rng(seed)
    vectors = np.empty((size, DIMENSIONS), np.float32)
    for i in range(0, size, TRAINED_AT_ONCE << 10):
        part = vectors[i: i + (TRAINED_AT_ONCE << 10)]
        part[:] = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, part.shape)
    layer = np.zeros((DIMENSIONS, 2), np.float32)
    bias = np.zeros(2, np.float32)
    # the driver trains, so it holds the words of few texts at a time
    docs = [
        (buckets.astype(np.int32), counts.astype(np.int32))
        for i in range(0, len(texts), TRAINED_AT_ONCE) for buckets, counts in document_features(texts[i: i + TRAINED_AT_ONCE])
    ]
    steps, done = EPOCHS * len(docs), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(docs)):
            rate = RATE * (1 - done / steps)
            done += 1
            buckets, counts = docs[i]
            share = (counts / max(counts.sum(), 1)).astype(np.float32)
            hidden = share @ vectors[buckets]
            odds = hidden @ layer + bias
            odds = np.exp(odds - odds.max())
            error = odds / odds.sum()
            error[labels[i]] -= 1
            back = layer @ error
            layer -= rate * np.outer(hidden, error)
            bias -= rate * error
            vectors[buckets] -= rate * np.outer(share, back)
    shift = 0.0
    if prior is not None and 0 < prior < 1:
        sampled = ones / len(labels)
        shift = float(np.log(prior / (1 - prior)) - np.log(sampled / (1 - sampled)))
    return vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]) + shift


def log_odds(odds: np.ndarray, bias: float, codes: np.ndarray, bounds: np.ndarray, distinct: pa.Array) -> np.ndarray:
    """Log odds of class 1 of each text of a word table."""
    features, ends, hashes = word_features(distinct)
    pairs, follows = bigram_features(codes, bounds, ends, hashes)
    word_odds = sums_between(odds[features].astype(np.float64), ends)
    total = sums_between(word_odds[codes] + np.where(follows, odds[pairs], 0), bounds)
    number = sums_between(np.diff(ends)[codes] + follows, bounds)
    return total / np.maximum(number, 1) + bias


def labelled_sample(
    docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS
) -> tuple[list[str | None], list[int], float | None]:
    """At most ``per_class`` training texts of each class, the first by hash of their id.

    Only rows whose crc32(doc_id as text) mod 3 is not 1 are read. Also returns
    the share of class 1 among all of them.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("quality").isin(0, 1) & ~held_out("doc_id"))
        .groupBy("doc_id").agg(F.max("quality").alias("quality"))
        .withColumn("order", F.md5(F.col("doc_id").cast("string")))
    )
    sizes = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    total = sum(sizes.values())
    picked = [
        known.where(F.col("quality") == q).orderBy("order", "doc_id").limit(per_class) for q in (0, 1)
    ]
    # at most 2 * per_class ids, so this side may be broadcast
    rows = (
        id_and_text(docs).join(F.broadcast(picked[0].unionAll(picked[1])), "doc_id")
        .orderBy("order", "doc_id", "text").select("text", "quality").limit(2 * per_class).collect()
    )
    return [r["text"] for r in rows], [r["quality"] for r in rows], (sizes.get(1, 0) / total if total else None)


def held_out(doc_id: str):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _scored(docs: DataFrame, labels: DataFrame, per_class: int, carried: list[str]) -> DataFrame:
    """doc_id, score and a struct of the ``carried`` columns, in one Arrow pass without a shuffle."""
    texts, classes, prior = labelled_sample(docs, labels, per_class)
    odds, bias = train(texts, classes, prior)
    shared = docs.sparkSession.sparkContext.broadcast(odds)
    rows = docs.select(
        F.struct(*[f"`{c}`" for c in carried]).alias("carried"),
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, strings in slices(batches, limit=SLICE_BYTES):
            codes, bounds, distinct = word_table(strings)
            logit = log_odds(shared.value, bias, codes, bounds, distinct)
            yield pa.RecordBatch.from_arrays([
                part.column("carried"), part.column("doc_id"),
                pa.array(1 / (1 + np.exp(-np.clip(logit, -30, 30)))),
            ], names=["carried", "doc_id", "score"])

    # a type, not its text: column names may hold any character
    kind = StructType().add("carried", rows.schema["carried"].dataType).add("doc_id", "long").add("score", "double")
    return rows.mapInArrow(score, kind)


def score_quality(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """Every whole text scored: doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.5).

    Null and empty texts have no features and get the score of the bias. A null
    doc_id is not held out and never used in training. Without labels every score
    is 0.5. Repeated rows are scored each; an empty table gives no rows.
    """
    return _scored(docs, labels, per_class, ["doc_id"]).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text is predicted to be of quality 1."""
    scored = _scored(docs, labels, per_class, docs.columns)
    return scored.where(F.col("score") >= 0.5).select("carried.*")
