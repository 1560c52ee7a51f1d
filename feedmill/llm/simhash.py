"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints that differ in few bits agree on all bits of some blocks: with m
blocks and a radius of r, at least m - r blocks are equal, so each choice of
m - r blocks is a table whose key is their bits. Fingerprints under one key are
compared bit-sliced: bit plane b holds bit b of 64 candidates per machine word,
carry-save counters add up the differing planes of many (fingerprint, word) pairs
at once, and a pair is abandoned as soon as all 64 distances exceed the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm.words import id_and_text, ragged, slices
from feedmill.operators.components import connected_components
from feedmill.session import drop_staged, stage

SEED = 42
BITS = 64
SHINGLES_AT_ONCE = 1 << 15
KEY_ROWS = 256  # wanted fingerprints per key, if they were spread evenly
GROUP_ROWS = 4096  # a key with more is split into blocks of about this size
BUFFER_ROWS = 1 << 16
PAIRS_AT_ONCE = 1 << 15
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes, words: int = 4) -> int:
    """Majority bits of the XXH64 of all word shingles; 0 for a text without words."""
    from xxhash import xxh64_intdigest

    parts = text.lower().split()  # bytes: lower-cases A-Z, splits at [\x20\x09-\x0D]
    if not parts:
        return 0
    number = max(1, len(parts) - words + 1)
    ones = np.zeros(BITS, np.int64)
    for start in range(0, number, SHINGLES_AT_ONCE):
        stop = min(number, start + SHINGLES_AT_ONCE)
        hashes = np.array(
            [xxh64_intdigest(b" ".join(parts[i: i + words]), SEED) for i in range(start, stop)], "<u8"
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > number, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """doc_id, text_hash and fingerprint (a signed long of the 64 bits) of every whole text."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            found = np.array([fingerprint(t.as_buffer().to_pybytes(), words) for t in texts.cast(pa.binary())], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_hash"), pa.array(found.view(np.int64))],
                names=["doc_id", "text_hash", "fingerprint"],
            )

    hashed = id_and_text(docs).withColumn("text_hash", F.xxhash64("text"))
    return hashed.mapInArrow(prints, "doc_id long, text_hash long, fingerprint long")


def table_masks(number: int, radius: int) -> list[int]:
    """Bit masks of the tables: the fewest blocks whose keys hold about KEY_ROWS fingerprints."""
    for blocks in range(radius + 1, BITS + 1):
        edges = [BITS * i // blocks for i in range(blocks + 1)]
        masks = [
            sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in chosen)
            for chosen in combinations(range(blocks), blocks - radius)
        ]
        if number >> min(m.bit_count() for m in masks) <= KEY_ROWS:
            return masks
    return [(1 << BITS) - 1]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _planes(prints: np.ndarray) -> np.ndarray:
    """bits x words: bit b of fingerprint 64 w + k is bit k of planes[b, w]."""
    padded = np.zeros(-(-len(prints) // 64) * 64, np.uint64)
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def _exceeds(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose count is above ``radius``."""
    above, equal = over.copy(), np.full(len(over), ALL)
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            above |= equal & counters[k]
            equal &= ~counters[k]
    return above


def close_lanes(
    planes: np.ndarray, prints: np.ndarray, rows: np.ndarray, words: np.ndarray, lanes: np.ndarray, radius: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, words, lanes) of the pairs that have a lane within ``radius``, with those lanes."""
    counters = [np.zeros(len(rows), np.uint64) for _ in range(max(1, radius.bit_length()))]
    over = np.zeros(len(rows), np.uint64)
    own = prints[rows]
    for bit in range(0, BITS, 2):
        x = planes[bit, words] ^ (np.uint64(0) - (own >> np.uint64(bit) & np.uint64(1)))
        y = planes[bit + 1, words] ^ (np.uint64(0) - (own >> np.uint64(bit + 1) & np.uint64(1)))
        half = counters[0] ^ x
        carry = (counters[0] & x) | (half & y)
        counters[0] = half ^ y
        for k in range(1, len(counters)):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if bit % 8 == 6:
            lanes = lanes & ~_exceeds(counters, over, radius)
            live = np.flatnonzero(lanes)
            if 4 * len(live) < 3 * len(lanes) or bit == BITS - 2:
                rows, words, lanes, own, over = rows[live], words[live], lanes[live], own[live], over[live]
                counters = [c[live] for c in counters]
            if not len(rows):
                break
    return rows, words, lanes


def _join(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the classes of linked rows; a class is labelled by its first row."""
    while len(a):
        left, right = labels[a], labels[b]
        apart = left != right
        a, b, left, right = a[apart], b[apart], left[apart], right[apart]
        np.minimum.at(labels, np.maximum(left, right), np.minimum(left, right))
        while True:
            further = labels[labels]
            if (further == labels).all():
                break
            labels[:] = further


def link_groups(group: np.ndarray, side: np.ndarray, prints: np.ndarray, radius: int) -> np.ndarray:
    """For each row the first row of its class, linking rows of one group within ``radius``.

    Rows are sorted by group. ``side`` is 0 for groups compared within; where it is
    1 and 2, only rows of different sides are compared. Words whose 64 rows all are
    in the row's class already are not compared again.
    """
    number = len(prints)
    planes, labels = _planes(prints), np.arange(number)
    last = np.searchsorted(group, group, "right") - 1
    padded = np.zeros(planes.shape[1] * 64, np.uint8)
    sides = []
    for value in (1, 2):
        padded[:number] = side == value
        sides.append(np.packbits(padded, bitorder="little").view(np.uint64))
    first_word, last_word = (np.arange(number) + 1) >> 6, last >> 6
    lengths = np.where(last > np.arange(number), last_word - first_word + 1, 0)
    ends = np.cumsum(lengths)
    start = 0
    while start < number:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + PAIRS_AT_ONCE, "right")))
        rows = np.repeat(np.arange(start, stop), lengths[start:stop])
        words = ragged(first_word[start:stop], lengths[start:stop])
        start = stop
        if not len(rows):
            continue
        tail = np.arange(len(labels), planes.shape[1] * 64)
        of_word = np.concatenate([labels, labels[-1:].repeat(len(tail))]).reshape(-1, 64)
        same = (of_word.min(axis=1)[words] == labels[rows]) & (of_word.max(axis=1)[words] == labels[rows])
        rows, words = rows[~same], words[~same]
        lanes = np.where(words == first_word[rows], ALL << ((rows + 1) & 63).astype(np.uint64), ALL)
        lanes &= np.where(words == last_word[rows], ALL >> (63 - (last[rows] & 63)).astype(np.uint64), ALL)
        lanes &= np.where(side[rows] == 0, ALL, np.where(side[rows] == 1, sides[1][words], sides[0][words]))
        live = lanes != 0
        rows, words, lanes = close_lanes(planes, prints, rows[live], words[live], lanes[live], radius)
        if len(rows):
            bits = np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            pair, lane = np.nonzero(bits)
            _join(labels, rows[pair], words[pair] * 64 + lane)
    return labels


def _links(keyed: DataFrame, radius: int) -> DataFrame:
    """Edges (a, b) that connect whatever is linked within a group of ``keyed``."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(rows: list[np.ndarray]) -> pa.RecordBatch:
            table, key, pair, side, prints = rows
            new = np.ones(len(prints), bool)
            new[1:] = (table[1:] != table[:-1]) | (key[1:] != key[:-1]) | (pair[1:] != pair[:-1])
            labels = link_groups(np.cumsum(new), side, prints.view(np.uint64), radius)
            linked = np.flatnonzero(labels != np.arange(len(labels)))
            return pa.RecordBatch.from_arrays(
                [pa.array(prints[linked]), pa.array(prints[labels[linked]])], names=["a", "b"]
            )

        held: list[list[np.ndarray]] = []
        number = 0
        for batch in batches:
            held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in range(5)])
            number += batch.num_rows
            if number >= BUFFER_ROWS:
                rows = [np.concatenate(c) for c in zip(*held)]
                same = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1]) & (rows[2] == rows[2][-1])
                whole = len(same) - int(same.sum())
                if whole:
                    yield edges([c[:whole] for c in rows])
                held, number = [[c[whole:] for c in rows]], len(same) - whole
        if number:
            yield edges([np.concatenate(c) for c in zip(*held)])

    return (
        keyed.repartition("t", "key", "pair").sortWithinPartitions("t", "key", "pair", "fingerprint")
        .select("t", "key", "pair", "side", "fingerprint").mapInArrow(compare, "a long, b long")
    )


def near_links(prints: DataFrame, radius: int = 4) -> DataFrame:
    """Edges that connect all distinct fingerprints (column ``fingerprint``) within ``radius`` bits.

    Linked fingerprints are connected through edges, not all listed. A key with
    more than GROUP_ROWS fingerprints is split into blocks, and every pair of
    blocks is a group of its own, so no group grows with the data.
    """
    masks = table_masks(prints.count(), radius)
    keyed = prints.select("fingerprint", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fingerprint").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for t, m in enumerate(masks)
    ])).alias("k")).select("fingerprint", "k.*")
    large = stage(
        keyed.groupBy("t", "key").count().where(F.col("count") > GROUP_ROWS)
        .select(F.col("t").alias("lt"), F.col("key").alias("lkey"), F.ceil(F.col("count") / GROUP_ROWS).cast("int").alias("blocks")),
        "large-keys",
    )
    placed = keyed.join(large, (F.col("t") == F.col("lt")) & (F.col("key") == F.col("lkey")), "left").select(
        "t", "key", "fingerprint", F.coalesce("blocks", F.lit(1)).alias("blocks"),
        F.pmod(F.xxhash64("fingerprint"), F.coalesce("blocks", F.lit(1))).cast("int").alias("block"),
    )
    # block x meets block y in the pair (min, max); side tells the two apart, 0 where they are the same
    grouped = placed.select("t", "key", "fingerprint", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"), "blocks").select(
        "t", "key", "fingerprint",
        (F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")).alias("pair"),
        F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2).alias("side"),
    )
    return _links(grouped, radius)


def _components(docs: DataFrame, words: int, radius: int) -> DataFrame:
    """fingerprints with the component of each: its smallest fingerprint, and component_id."""
    prints = stage(fingerprints(docs, words), "fingerprints")
    distinct = stage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    nodes = connected_components(near_links(distinct.select("fingerprint"), radius))
    placed = distinct.join(nodes, F.col("fingerprint") == F.col("node"), "left").select(
        F.col("fingerprint").alias("f"), F.coalesce("component", "fingerprint").alias("component"), "least"
    )
    lowest = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    by_print = placed.select("f", "component").join(lowest, "component").select("f", "component", "component_id")
    return prints.join(by_print, F.col("fingerprint") == F.col("f")).drop("f")


def simhash_components(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits) and component_id of every document.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; texts of fewer than
    ``words`` words are one shingle, null and empty texts have fingerprint zero and
    are linked like any other. component_id is the smallest doc_id reachable over
    links of at most ``radius`` differing bits (null ids count last). Repeated rows
    give repeated rows; an empty table gives none.
    """
    return _components(docs, words, radius).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """One row of each component of ``docs``, with all its columns.

    The row with the smallest doc_id stays (null ids count last); of rows that
    repeat that id the one whose text has the smallest hash, so rows without an id
    or with a repeated one are told apart by their texts. An empty table gives no
    rows.
    """
    first = _components(docs, words, radius).groupBy("component").agg(F.min(
        F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), "text_hash")
    ).alias("first")).select("first.*").distinct()
    row_id = F.col("doc_id").cast("long")
    key = ["no_id", "id", "text_hash"]
    rows = docs.select(
        F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"), row_id.isNull().alias("no_id"),
        F.coalesce(row_id, F.lit(0)).alias("id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
    )
    return rows.join(first, key, "left_semi").dropDuplicates(key).select("row.*")
