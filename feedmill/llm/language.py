"""Language identification by string kernels.

The kernel of two texts is the number of byte n-grams (n = 1, 2, 3, lower case)
that occur in both, over the grams known from the training sample, normalised by
the number each has. Nystroem landmarks turn it into a short vector, and ridge
regression of each language against the rest is solved on the sample. Scoring a
block of texts is two matrix products: gram presence by landmarks, kernel values
by classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedmill.llm.words import id_and_text, slices, utf8
from feedmill.session import stage

LENGTHS = (1, 2, 3)
MAX_GRAMS = 30_000
SAMPLE_ROWS = 1_600
LANDMARKS = 96
RIDGE = 1e-2
SHARPNESS = 4.0
ROWS_AT_ONCE = 128
UNKNOWN = "und"


def _codes(data: np.ndarray) -> list[np.ndarray]:
    """One 32-bit code per position and length; 1 in the high byte tells lengths apart."""
    wide = data.astype(np.uint32)
    out, code = [], np.zeros(len(wide), np.uint32)
    for n in LENGTHS:
        code = (code[: len(wide) - n + 1] << np.uint32(8)) | wide[n - 1:] if n > 1 else wide
        out.append(code)
    return out


@dataclass
class LanguageModel:
    grams: list[np.ndarray]  # of each length, sorted codes
    landmarks: np.ndarray  # grams x landmarks, 0/1
    sizes: np.ndarray  # square root of each landmark's number of grams
    weights: np.ndarray  # landmarks x classes
    classes: list[str]

    def tables(self) -> list[np.ndarray]:
        """Gram number by code, for each length; the last number means unknown."""
        unknown = sum(map(len, self.grams))
        out, first = [], 0
        for n, codes in zip(LENGTHS, self.grams):
            table = np.full(1 << (8 * n), unknown, np.int16)
            table[codes] = np.arange(first, first + len(codes))
            out.append(table)
            first += len(codes)
        return out

    def presence(self, tables: list[np.ndarray], data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Texts x grams, 1 where the text holds the gram."""
        width = sum(map(len, self.grams)) + 1
        flags = np.zeros((len(bounds) - 1, width), np.uint8)
        codes = _codes(data)
        for row in range(len(bounds) - 1):
            for n, table, code in zip(LENGTHS, tables, codes):
                flags[row, table[code[bounds[row]: max(bounds[row], bounds[row + 1] - n + 1)]]] = 1
        return flags[:, :-1]

    def kernel(self, flags: np.ndarray) -> np.ndarray:
        flags = flags.astype(np.float32)
        norms = np.sqrt(np.maximum(flags.sum(axis=1), 1))
        return (flags @ self.landmarks) / norms[:, None] / self.sizes

    def predict(self, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the best class, its share of the softmax of all responses)."""
        response = SHARPNESS * (self.kernel(flags).astype(np.float64) @ self.weights)
        best = response.argmax(axis=1)
        odds = np.exp(response - response.max(axis=1, keepdims=True))
        return best, odds[np.arange(len(best)), best] / odds.sum(axis=1)


def train(texts: list[str], langs: list[str], seed: int = 11) -> LanguageModel | None:
    """Kernel ridge regression on Nystroem features; None without any row."""
    if not texts:
        return None
    data, bounds = utf8(pc.utf8_lower(pa.array(texts, pa.string())))
    codes = _codes(data)
    grams = []
    for n, code in zip(LENGTHS, codes):
        seen = [np.unique(code[a: max(a, b - n + 1)]) for a, b in zip(bounds[:-1], bounds[1:])]
        values, in_docs = np.unique(np.concatenate(seen), return_counts=True)
        most = np.argsort(-in_docs, kind="stable")[: MAX_GRAMS // len(LENGTHS)]
        grams.append(np.sort(values[most]))
    classes = sorted(set(langs))
    width = sum(map(len, grams))
    model = LanguageModel(grams, np.zeros((width, 0), np.float32), np.zeros(0), np.zeros((0, 0)), classes)
    flags = model.presence(model.tables(), data, bounds)
    rng = np.random.default_rng(seed)
    picked = np.sort(rng.choice(len(texts), min(LANDMARKS, len(texts)), replace=False))
    model.landmarks = np.ascontiguousarray(flags[picked].T.astype(np.float32))
    model.sizes = np.sqrt(np.maximum(model.landmarks.sum(axis=0), 1))
    near = np.concatenate([model.kernel(flags[i: i + 256]) for i in range(0, len(texts), 256)]).astype(np.float64)
    values, vectors = np.linalg.eigh(near[picked])
    keep = values > 1e-6
    root = vectors[:, keep] / np.sqrt(values[keep])
    features = near @ root
    is_class = np.array(langs)[:, None] == np.array(classes)[None, :]
    # every class weighs the same in the regressions, however many rows it has
    weight = (1 / is_class.sum(axis=0))[is_class.argmax(axis=1)] * len(texts) / len(classes)
    target = np.where(is_class, 1.0, -1.0)
    left = features.T @ (features * weight[:, None]) + RIDGE * np.eye(features.shape[1])
    model.weights = root @ np.linalg.solve(left, features.T @ (target * weight[:, None]))
    return model


def held_out(doc_id: str):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[list[str], list[str]]:
    """At most ``rows`` texts with a language, as many of each as of any other.

    Picked by the hash of their ids among rows whose crc32(doc_id as text) mod 5
    is not 0. The ids are chosen before any text is read.
    """
    usable = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.md5(F.col("doc_id").cast("string")).alias("order"),
    ).where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    # sizes are written, so that the plan knows how small they are and need not deal rows by language;
    # of a language with n rows only those whose hash lies in the lowest 4 * rows / n are ranked,
    # so that no language fills a task; that many are left but for a vanishing chance
    counts = stage(usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "language-sizes")
    share = F.conv(F.substring("order", 1, 8), 16, 10).cast("double") / 2.0 ** 32
    usable = usable.join(counts, "lang").where(share * F.col("n") <= 4.0 * rows)
    first = Window.partitionBy("lang").orderBy("order", "doc_id")
    ids = (
        usable.withColumn("place", F.row_number().over(first)).where(F.col("place") <= rows)
        .orderBy("place", "lang").limit(rows).select("doc_id", F.col("lang").alias("is_lang"))
    )
    # at most ``rows`` ids, so this side may be broadcast; a row is learned from under its own language only
    texts = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("is_lang"),
            F.col("text").cast("string").alias("text"),
        )
        .join(F.broadcast(ids.distinct()), ["doc_id", "is_lang"]).where(F.col("text").isNotNull())
        .orderBy("doc_id", "is_lang", "text").limit(rows).collect()
    )
    return [r["text"] for r in texts], [r["is_lang"] for r in texts]


def identify_languages(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred and score (0 to 1) of every whole text.

    ``und`` with score 0 if the text is null or has no letter, or if there was
    nothing to learn from. A null doc_id is not held out and not learned from;
    repeated rows are judged each; an empty table gives no rows. Only the text is
    an input of the prediction. One Arrow pass without a shuffle; the model sent
    to the executors is bounded by MAX_GRAMS x LANDMARKS.
    """
    model = train(*training_sample(docs, sample_rows))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        tables = model.tables() if model else []
        for part, texts in slices(batches):
            known = pc.match_substring_regex(texts, r"\pL").to_numpy(zero_copy_only=False)
            lang = np.full(len(texts), UNKNOWN, object)
            score = np.zeros(len(texts))
            if model:
                data, bounds = utf8(pc.utf8_lower(texts))
                for i in range(0, len(texts), ROWS_AT_ONCE):
                    ends = bounds[i: i + ROWS_AT_ONCE + 1]
                    flags = model.presence(tables, data[ends[0]: ends[-1]], ends - ends[0])
                    best, share = model.predict(flags)
                    rows = slice(i, i + len(best))
                    lang[rows] = np.where(known[rows], np.array(model.classes, object)[best], UNKNOWN)
                    score[rows] = np.where(known[rows], share, 0.0)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score)],
                names=["doc_id", "lang_pred", "score"],
            )

    judged = id_and_text(docs).mapInArrow(identify, "doc_id long, lang_pred string, score double")
    return judged.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
