"""Exact duplicates by counting quotient filters and byte verification.

Every partition builds a counting quotient filter of the 64-bit fingerprints of
its normalised texts. The high bits of a fingerprint, its quotient, are not stored:
one bit per quotient tells whether it is occupied, and the remainders of a quotient
lie sorted in a run of slots whose last one carries a run-end bit. The run of a
quotient is found by its rank among the occupied ones. A fingerprint that occurs
more than once is followed by slots that carry a counter bit and hold the digits of
its count. A filter is written once, so its runs lie back to back without free slots.

Filters are cut at ranges of quotients, so they merge losslessly range by range:
sorted remainders are merged and equal ones add their counts. A fingerprint of
count one is a single text. The texts of all others are grouped by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.session import stage

FILTER_ROWS = 1 << 20  # fingerprints in one filter, and about as many in one merged range

_FILTER = "range int, slots int, quotient_bits int, occupied binary, run_ends binary, counters binary, remainders binary"


def normalised(text: Column) -> Column:
    """Each ``[\\x20\\x09-\\x0D]+`` as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _entries(prints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints in order, with summed counts. Sorted stretches are merged, not sorted anew."""
    order = np.argsort(prints, kind="stable")
    prints, counts = prints[order], counts[order]
    first = np.flatnonzero(np.append(True, prints[1:] != prints[:-1])[: len(prints)])
    return prints[first], np.add.reduceat(counts, first) if len(first) else counts


def _pack(values: np.ndarray, bits: int) -> bytes:
    """The low ``bits`` bits of each value, one after the other."""
    wide = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return np.packbits(wide[:, 64 - bits:]).tobytes()


def _unpack(packed: bytes, number: int, bits: int) -> np.ndarray:
    wide = np.zeros((number, 64), np.uint8)
    wide[:, 64 - bits:] = np.unpackbits(np.frombuffer(packed, np.uint8), count=number * bits).reshape(number, bits)
    return np.packbits(wide, axis=1).view(">u8")[:, 0].astype(np.uint64)


def write_filter(prints: np.ndarray, counts: np.ndarray, width: int) -> tuple[int, int, bytes, bytes, bytes, bytes]:
    """A filter of distinct fingerprints of ``width`` bits in order, each counted at least once.

    (number of slots, quotient bits, occupied, run ends, counters, remainders). The
    number of quotients is the largest power of two up to that of the fingerprints.
    """
    quotient_bits = min(len(prints).bit_length(), width) - 1
    bits = width - quotient_bits
    low = np.uint64((1 << bits) - 1)
    quotient = (prints >> np.uint64(bits)).astype(np.int64)
    occupied = np.zeros(1 << quotient_bits, np.uint8)
    occupied[quotient] = 1
    # the count above one, in digits of as many bits as a remainder has
    more = (counts - 1).astype(np.uint64)
    digits, rest = np.zeros(len(prints), np.int64), more.copy()
    while rest.any():
        digits += rest > 0
        rest >>= np.uint64(bits)
    slot = np.arange(len(prints)) + np.cumsum(digits) - digits
    held = np.zeros(len(prints) + int(digits.sum()), np.uint64)
    counter = np.ones(len(held), np.uint8)
    held[slot], counter[slot] = prints & low, 0
    for place in range(int(digits.max())):
        long = digits > place
        held[slot[long] + 1 + place] = more[long] >> np.uint64(place * bits) & low
    run_end = np.zeros(len(held), np.uint8)
    run_end[(slot + digits)[np.append(quotient[1:] != quotient[:-1], True)]] = 1
    return (
        len(held), quotient_bits, np.packbits(occupied).tobytes(), np.packbits(run_end).tobytes(),
        np.packbits(counter).tobytes(), _pack(held, bits),
    )


def read_filter(
    slots: int, quotient_bits: int, occupied: bytes, run_ends: bytes, counters: bytes, remainders: bytes, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints of a filter in order, and their counts."""
    bits = width - quotient_bits
    held = _unpack(remainders, slots, bits)
    run_end = np.unpackbits(np.frombuffer(run_ends, np.uint8), count=slots).astype(np.int64)
    slot = np.flatnonzero(np.unpackbits(np.frombuffer(counters, np.uint8), count=slots) == 0)
    quotients = np.flatnonzero(np.unpackbits(np.frombuffer(occupied, np.uint8), count=1 << quotient_bits))
    # the runs that end before a slot are as many as the occupied quotients before its own
    quotient = quotients[(np.cumsum(run_end) - run_end)[slot]].astype(np.uint64)
    digits = np.diff(np.append(slot, slots)) - 1
    counts = np.ones(len(slot), np.int64)
    for place in range(int(digits.max())):
        long = digits > place
        counts[long] += (held[slot[long] + 1 + place] << np.uint64(place * bits)).astype(np.int64)
    return quotient << np.uint64(bits) | held[slot], counts


def _write(prints: np.ndarray, counts: np.ndarray, range_bits: int) -> pa.RecordBatch:
    """One filter for each range of quotients; the bits of the range are left out of it."""
    width = 64 - range_bits
    of_range = (prints >> np.uint64(width)).astype(np.int64)
    ranges, first = np.unique(of_range, return_index=True)
    own = prints & np.uint64((1 << width) - 1)
    filters = [write_filter(own[a:b], counts[a:b], width) for a, b in zip(first, [*first[1:], len(prints)])]
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays(
        [pa.array(ranges, pa.int32()), *[pa.array(column, kind) for column, kind in zip(zip(*filters), kinds)]],
        names=["range", "slots", "quotient_bits", "occupied", "run_ends", "counters", "remainders"],
    )


def _merge(table: pa.Table, range_bits: int) -> pa.Table:
    """One range of all filters: remainders merged, counts added; the fingerprints counted more than once."""
    width = 64 - range_bits
    columns = [table.column(c) for c in table.column_names[1:]]
    parts = [read_filter(*(c[i].as_py() for c in columns), width) for i in range(table.num_rows)]
    prints, counts = _entries(*(np.concatenate(column) for column in zip(*parts)))
    of_range = np.uint64(table.column("range")[0].as_py()) << np.uint64(width)
    return pa.table({"fingerprint": (prints[counts > 1] | of_range).view(np.int64)})


def repeated_fingerprints(rows: DataFrame) -> DataFrame:
    """Fingerprints (column ``fingerprint``, long) that occur more than once, each one time.

    Only filters are shuffled. The number of ranges follows the number of rows, so
    that a merged range holds about FILTER_ROWS entries at every size; a
    fingerprint of any number of rows is one entry of each filter.
    """
    range_bits = max(4, (2 * rows.count() // FILTER_ROWS).bit_length())

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = [], 0
        for batch in batches:
            held.append(batch.column("fingerprint").to_numpy(zero_copy_only=False).view(np.uint64))
            number += batch.num_rows
            if number >= FILTER_ROWS:
                yield _write(*_entries(np.concatenate(held), np.ones(number, np.int64)), range_bits)
                held, number = [], 0
        if number:
            yield _write(*_entries(np.concatenate(held), np.ones(number, np.int64)), range_bits)

    filters = rows.select("fingerprint").mapInArrow(build, _FILTER)
    return filters.groupBy("range").applyInArrow(lambda table: _merge(table, range_bits), "fingerprint long")


def _split(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose text is single, rows for byte verification), with ``norm``, ``doc`` and ``row``."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc"), normalised(F.col("text")).alias("norm"),
        F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"),
    ).withColumn("fingerprint", F.xxhash64("norm"))
    repeated = stage(repeated_fingerprints(rows), "repeated-fingerprints")
    return rows.join(repeated, "fingerprint", "left_anti"), rows.join(repeated, "fingerprint", "left_semi")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after ``normalised``; null counts as empty. The
    row with the smallest doc_id stays (null ids count last). If rows repeat that
    id as well, exactly one of them is kept. An empty table gives no rows.
    """
    single, members = _split(docs)
    sha = F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256")
    alone = single.select(
        F.col("doc").alias("doc_id"), F.col("doc").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), sha,
    )
    # rows that repeat id and text are folded, so that one of them can be told from the rest
    folded = stage(
        members.groupBy("fingerprint", "norm", "doc").agg(F.count(F.lit(1)).alias("times")), "repeated-texts"
    )
    # written, so that the join below deals both sides anew and can split a text with very many copies
    groups = stage(folded.groupBy("fingerprint", "norm").agg(
        F.min("doc").alias("keep_id"), F.sum("times").alias("group_size")
    ).select(F.col("fingerprint").alias("f"), F.col("norm").alias("n"), "keep_id", "group_size"), "text-groups")
    judged = folded.join(groups, (F.col("fingerprint") == F.col("f")) & (F.col("norm") == F.col("n"))).select(
        F.col("doc").alias("doc_id"), "keep_id", "group_size", F.col("doc").eqNullSafe(F.col("keep_id")).alias("first"),
        sha, F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("copy"),
    )
    return alone.unionByName(judged.select(
        "doc_id", "keep_id", "group_size", (F.col("first") & (F.col("copy") == 1)).alias("kept"), "text_sha256"
    ))


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    single, members = _split(docs)
    groups = members.groupBy("fingerprint", "norm").agg(F.min("doc").alias("keep_id")).select(
        F.col("fingerprint").alias("f"), F.col("norm").alias("n"), "keep_id"
    )
    first = (
        members.join(groups, (F.col("fingerprint") == F.col("f")) & (F.col("norm") == F.col("n"))
                     & F.col("doc").eqNullSafe(F.col("keep_id")))
        .dropDuplicates(["fingerprint", "norm"])
    )
    return single.select("row.*").unionByName(first.select("row.*"))
