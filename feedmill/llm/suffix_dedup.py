"""Removal of repeated byte strings by a depth-limited radix sort of sampled suffixes.

A string of ``depth`` bytes that repeats need not be found from each of its
bytes. The gram of ``GRAM`` bytes with the smallest hash among those of a window
of ``depth`` bytes is its anchor, wherever the window occurs; only windows around
equal anchors can be equal. The sort looks at them digit by digit, most
significant digit first, and stops at ``depth`` bytes:

1. the first digit is the anchor: its occurrences meet in one bucket. An
   occurrence whose whole surroundings (all windows around the anchor) equal
   those of an earlier one is repeated altogether, and anchors that occur once,
   or with one surrounding only, are done. Copies end here, without their bytes.
2. the rest is sorted byte by byte, to the right and to the left of the anchor.
   Windows of equal digits on both sides are exactly the repeated ones.

An anchor with very many occurrences meets in no bucket. Its windows are keyed by a
128-bit hash instead; a slice of text marks all but its first window of each key and
sends that one on, so the rows of a key are at most as many as the slices.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm.words import ragged, slices, utf8
from feedmill.session import stage

DEPTH = 100
GRAM = 24
CHUNK = 1 << 20
BUCKET_BYTES = 16 << 20  # of text per bucket of anchors
HOT = 1 << 16  # occurrences of an anchor from which on it meets in no bucket
COUNTED = 16  # one of so many shorter documents is counted to find them
COUNT_ALL = 1 << 16  # bytes from which on a document is always counted
LAST_DOC = (1 << 63) - 1

_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_ENTRY = [("anchor", "<u4"), ("around", "<u8"), ("doc", "<i8"), ("hash", "<i4"), ("pos", "<i4"), ("left", "u1"), ("right", "u1")]


def _sliding(op, values: np.ndarray, width: int) -> np.ndarray:
    """op over every ``width`` neighbouring values."""
    number, out, size = len(values) - width + 1, values, 1
    while 2 * size <= width:
        out = op(out[:-size], out[size:])
        size *= 2
    return op(out[:number], out[width - size: width - size + number])


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes at every position, never 0."""
    lanes = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), strides=(1,))
    number = len(data) - GRAM + 1
    code = np.zeros(number, np.uint64)
    for k in range(0, GRAM, 8):
        code += lanes[k: k + number]
        code *= _C[k // 8]
        code ^= code >> np.uint64(31)
    code *= _C[3]
    code ^= code >> np.uint64(32)
    return code | np.uint64(1)


def anchors(data: np.ndarray, bounds: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """(positions of all anchors of the texts in ``data``, hash of each anchor's gram)."""
    width, positions, hashes = depth - GRAM + 1, [], []
    for start in range(0, len(data) - depth + 1, CHUNK):
        part = data[start: start + CHUNK + depth - 1]
        code = _gram_hashes(part)
        lowest = _sliding(np.minimum, code, width)
        # windows that reach into the next text do not count
        at = np.arange(start, start + len(lowest))
        lowest[at + depth > bounds[np.searchsorted(bounds, at, "right")]] = 0
        framed = np.zeros(len(code) + width - 1, np.uint64)
        framed[width - 1: width - 1 + len(lowest)] = lowest
        chosen = np.flatnonzero(_sliding(np.maximum, framed, width) == code)
        positions.append(chosen + start)
        hashes.append(code[chosen])
    if not positions:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    found, first = np.unique(np.concatenate(positions), return_index=True)
    return found, np.concatenate(hashes)[first]


def surroundings(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, positions: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all windows around each anchor, FF outside the text, how far they reach to the left and right)."""
    reach = depth - GRAM
    left = np.minimum(positions - begins, reach)
    right = np.minimum(ends - positions, depth)
    at = positions[:, None] + np.arange(-reach, depth)[None, :]
    inside = (at >= (positions - left)[:, None]) & (at < (positions + right)[:, None])
    around = np.where(inside, data[np.clip(at, 0, max(len(data) - 1, 0))], np.uint8(0xFF))
    return around, left.astype(np.uint8), right.astype(np.uint8)


def _hash_rows(rows: np.ndarray) -> np.ndarray:
    pad = -rows.shape[1] % 8
    lanes = np.ascontiguousarray(np.pad(rows, ((0, 0), (0, pad)))).view("<u8")
    code = np.full(len(rows), _C[0])
    for k in range(lanes.shape[1]):
        code ^= lanes[:, k]
        code *= _C[1 + k % 3]
        code ^= code >> np.uint64(29)
    code *= _C[0]
    return code ^ (code >> np.uint64(32))


def _pack(bucket: np.ndarray, columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    """One row per bucket: the bytes of every column's entries, in their order."""
    order = np.argsort(bucket, kind="stable")
    values, first = np.unique(bucket[order], return_index=True)
    parts = list(zip(first, [*first[1:], len(order)]))
    out = [pa.array(values, pa.int32())]
    for column in columns:
        sorted_column = column[order]
        out.append(pa.array([sorted_column[a:b].tobytes() for a, b in parts], pa.binary()))
    return pa.RecordBatch.from_arrays(out, names=["bucket", *names])


def _unpack(table: pa.Table, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _same_place(entry: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (entry["doc"][a] == entry["doc"][b]) & (entry["hash"][a] == entry["hash"][b]) & (entry["pos"][a] == entry["pos"][b])


def resolve_anchors(entry: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(entries repeated altogether, entries whose bytes must be sorted) of one bucket."""
    order = np.lexsort([entry[c] for c in ("pos", "hash", "doc", "around", "anchor")])
    anchor, around = entry["anchor"][order], entry["around"][order]
    new_anchor = np.ones(len(order), bool)
    new_anchor[1:] = anchor[1:] != anchor[:-1]
    new = new_anchor.copy()
    new[1:] |= around[1:] != around[:-1]
    first = order[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(order) else order
    repeated = order[~_same_place(entry, order, first)]
    group = np.cumsum(new_anchor) - 1
    kinds = np.bincount(group, new, minlength=1)
    return repeated, order[new & (kinds[group] > 1)] if len(order) else order


def _classes(start: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """rows x (columns + 1): class of each row by ``start`` and its first k columns, one radix pass each."""
    out = np.empty((columns.shape[1] + 1, len(start)), np.int64)
    out[0] = start
    for k in range(columns.shape[1]):
        out[k + 1] = np.unique(out[k] * 256 + columns[:, k], return_inverse=True)[1]
    return out


def _row_classes(rows: np.ndarray) -> np.ndarray:
    """Class of each row of GRAM bytes: equal rows, equal numbers."""
    lanes = np.ascontiguousarray(rows).view("<u8")
    order = np.lexsort(lanes.T)
    new = np.zeros(len(order), np.int64)
    new[1:] = (lanes[order[1:]] != lanes[order[:-1]]).any(axis=1)
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def repeated_windows(around: np.ndarray, entry: dict[str, np.ndarray], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the bytes covered by repeated windows, per anchor occurrence.

    The first digit is the anchor's own bytes, not their hash. Rows must be in order of
    place, so that the first of equal windows is the earliest.
    """
    reach = depth - GRAM
    start = _row_classes(around[:, reach:depth])
    to_left = _classes(start, around[:, :reach][:, ::-1])
    to_right = _classes(start, around[:, depth:])
    low = np.full(len(start), depth, np.int64)
    high = np.full(len(start), -1, np.int64)
    left, right = entry["left"].astype(np.int64), entry["right"].astype(np.int64)
    for shift in range(reach + 1):
        rows = np.flatnonzero((reach - left <= shift) & (shift <= right - GRAM))
        key = to_left[reach - shift, rows] * (len(start) + 1) + to_right[shift, rows]
        _, first, where = np.unique(key, return_index=True, return_inverse=True)
        later = ~_same_place(entry, rows, rows[first[where]])
        rows = rows[later]
        low[rows] = np.minimum(low[rows], shift)
        high[rows] = shift
    rows = np.flatnonzero(high >= 0)
    base = entry["pos"][rows].astype(np.int64) - reach
    return rows, base + low[rows], base + high[rows] + depth


_MARK = "doc long, hash int, start int, stop int, bucket int, anchor long"


def _marks(entry: dict[str, np.ndarray], rows: np.ndarray, start: np.ndarray, stop: np.ndarray, bucket=None) -> pa.Table:
    """Rows of _MARK; with a bucket they ask for the bytes around an anchor at ``start``."""
    none = pa.nulls(len(rows), pa.int32())
    return pa.table({
        "doc": entry["doc"][rows], "hash": entry["hash"][rows],
        "start": start.astype(np.int32), "stop": stop.astype(np.int32),
        "bucket": none if bucket is None else pa.array(np.full(len(rows), bucket, np.int32)),
        "anchor": pa.nulls(len(rows), pa.int64()) if bucket is None else pa.array(entry["anchor"][rows].astype(np.int64)),
    })


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_DOC)).alias("doc"), F.hash(text).alias("hash"),
        text.alias("text"),
    )


def _window_hashes(data: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the ``depth`` bytes from each start."""
    lanes = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), strides=(1,))
    one, two = np.full(len(starts), _C[0]), np.full(len(starts), _C[3])
    for at in [*range(0, depth - 8, 8), depth - 8]:
        lane = lanes[starts + at]
        one = (one ^ lane) * _C[1]
        one ^= one >> np.uint64(29)
        two = (two + lane) * _C[2]
        two ^= two >> np.uint64(32)
    return (one * _C[2]).view(np.int64), (two * _C[1]).view(np.int64)


def hot_anchors(texts: DataFrame, depth: int) -> np.ndarray:
    """Hashes of the anchors with about HOT occurrences or more, in order.

    They are estimated from some documents: where an anchor is sorted decides on
    memory only, not on the result.
    """
    long_text = F.octet_length("text") >= COUNT_ALL
    counted = texts.withColumn("weight", F.when(long_text, 1).otherwise(COUNTED)).where(
        long_text | (F.pmod(F.xxhash64("doc", "hash"), F.lit(COUNTED)) == 0)
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, strings in slices(batches):
            data, bounds = utf8(strings)
            if len(data) < depth:
                continue
            at, code = anchors(data, bounds, depth)
            weight = part.column("weight").to_numpy()[np.searchsorted(bounds, at, "right") - 1]
            distinct, where = np.unique(code, return_inverse=True)
            held = np.bincount(where, weight, len(distinct)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(held)], names=["code", "held"])

    held = counted.mapInArrow(count, "code long, held long").groupBy("code").agg(F.sum("held").alias("held"))
    # HOT // 2, as a count may come out low; there are at most (all anchors) / (HOT // 2) of them
    found = held.where(F.col("held") >= HOT // 2).select("code").toArrow().column("code").to_numpy()
    return np.sort(found.view(np.uint64))


def _hot_windows(texts: DataFrame, hot: np.ndarray, depth: int) -> DataFrame:
    """Marks of the repeated windows around hot anchors."""
    reach = depth - GRAM

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, strings in slices(batches):
            data, bounds = utf8(strings)
            if len(data) < depth:
                continue
            at, code = anchors(data, bounds, depth)
            at = at[np.isin(code, hot)]
            of = np.searchsorted(bounds, at, "right") - 1
            first, last = np.maximum(at - reach, bounds[of]), np.minimum(at, bounds[of + 1] - depth)
            steps = np.bincount(first, minlength=len(data) + 1) - np.bincount(last + 1, minlength=len(data) + 1)
            starts = np.flatnonzero(np.cumsum(steps) > 0)
            if not len(starts):
                continue
            of = np.searchsorted(bounds, starts, "right") - 1
            doc = part.column("doc").to_numpy(zero_copy_only=False)[of]
            text_hash = part.column("hash").to_numpy(zero_copy_only=False)[of]
            pos = starts - bounds[of]
            one, two = _window_hashes(data, starts, depth)
            order = np.lexsort([pos, text_hash, doc, two, one])
            new = np.ones(len(order), bool)
            new[1:] = (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]])
            lead = np.empty_like(order)
            lead[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
            first = order[new]
            # one row for all windows in a row that are repeated
            later = np.flatnonzero((doc != doc[lead]) | (text_hash != text_hash[lead]) | (pos != pos[lead]))
            breaks = np.flatnonzero((np.diff(starts[later]) != 1) | (np.diff(of[later]) != 0)) + 1
            from_, to = later[[0, *breaks][: len(later)]], later[[*(breaks - 1), len(later) - 1][: len(later)]]
            rows, ends = np.concatenate([first, from_]), np.concatenate([first, to])
            repeated = np.arange(len(rows)) >= len(first)
            yield pa.RecordBatch.from_arrays([
                pa.array(one[rows]), pa.array(two[rows]), pa.array(doc[rows]), pa.array(text_hash[rows], pa.int32()),
                pa.array(pos[rows], pa.int32()), pa.array(pos[ends] + depth, pa.int32()), pa.array(repeated),
            ], names=["one", "two", "doc", "hash", "start", "stop", "later"])

    keyed = texts.mapInArrow(key, "one long, two long, doc long, hash int, start int, stop int, later boolean")
    keyed = stage(keyed, "hot-windows")
    place = F.struct("doc", "hash", "start")
    firsts = keyed.where(~F.col("later")).groupBy("one", "two").agg(F.array_sort(F.collect_set(place)).alias("places"))
    across = firsts.where(F.size("places") > 1).select(
        F.explode(F.slice("places", 2, F.size("places"))).alias("p")
    ).select("p.*", (F.col("p.start") + depth).cast("int").alias("stop"))
    found = keyed.where("later").select("doc", "hash", "start", "stop").unionAll(across)
    return found.select(
        "doc", "hash", "start", "stop",
        F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("long").alias("anchor"),
    )


def _anchor_buckets(texts: DataFrame, buckets: int, depth: int, hot: np.ndarray) -> DataFrame:
    """Anchors of all texts but the hot ones, packed by bucket."""
    names = [c for c, _ in _ENTRY]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, strings in slices(batches):
            data, bounds = utf8(strings)
            if len(data) < depth:
                continue
            at, code = anchors(data, bounds, depth)
            cold = ~np.isin(code, hot)
            at, code = at[cold], code[cold]
            if not len(at):
                continue
            of = np.searchsorted(bounds, at, "right") - 1
            hashes, left, right = [], [], []
            for i in range(0, len(at), 1 << 16):
                rows = slice(i, i + (1 << 16))
                around, l, r = surroundings(data, bounds[of[rows]], bounds[of[rows] + 1], at[rows], depth)
                hashes.append(_hash_rows(np.column_stack([around, l, r])))
                left.append(l)
                right.append(r)
            doc = part.column("doc").to_numpy(zero_copy_only=False)[of]
            text_hash = part.column("hash").to_numpy(zero_copy_only=False)[of]
            yield _pack((code >> np.uint64(33)).astype(np.int64) % buckets, [
                (code & np.uint64(0xFFFFFFFF)).astype("<u4"), np.concatenate(hashes), doc.astype("<i8"),
                text_hash.astype("<i4"), (at - bounds[of]).astype("<i4"), np.concatenate(left), np.concatenate(right),
            ], names)

    return texts.mapInArrow(find, "bucket int, " + ", ".join(f"{c} binary" for c in names))


def _first_digit(packed: DataFrame) -> DataFrame:
    def resolve(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        entry = {c: _unpack(table, c, kind) for c, kind in _ENTRY}
        repeated, open_ = resolve_anchors(entry)
        pos = entry["pos"].astype(np.int64)
        return pa.concat_tables([
            _marks(entry, repeated, pos[repeated] - entry["left"][repeated], pos[repeated] + entry["right"][repeated]),
            _marks(entry, open_, pos[open_], pos[open_], bucket),
        ])

    return packed.groupBy("bucket").applyInArrow(resolve, _MARK)


def _other_digits(texts: DataFrame, wanted: DataFrame, depth: int) -> DataFrame:
    """Marks of the repeated windows around the wanted anchors, from their bytes."""
    names = [("around", "u1"), *[(c, k) for c, k in _ENTRY if c != "around"]]

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, strings in slices(batches):
            data, bounds = utf8(strings)
            asked = part.column("asked")
            number = np.diff(asked.offsets.to_numpy())
            flat = asked.flatten()
            bucket, anchor, pos = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            of = np.repeat(np.arange(len(number)), number)
            around, left, right = surroundings(data, bounds[of], bounds[of + 1], bounds[of] + pos, depth)
            yield _pack(bucket.astype(np.int64), [
                around, anchor.astype("<u4"), part.column("doc").to_numpy(zero_copy_only=False)[of].astype("<i8"),
                part.column("hash").to_numpy(zero_copy_only=False)[of].astype("<i4"), pos.astype("<i4"), left, right,
            ], [c for c, _ in names])

    def sort(table: pa.Table) -> pa.Table:
        entry = {c: _unpack(table, c, kind) for c, kind in names}
        around = entry.pop("around").reshape(-1, 2 * depth - GRAM)
        order = np.lexsort([entry["pos"], entry["hash"], entry["doc"]])
        entry = {c: v[order] for c, v in entry.items()}
        return _marks(entry, *repeated_windows(around[order], entry, depth))

    by_doc = wanted.groupBy("doc", "hash").agg(F.collect_list(F.struct("bucket", "anchor", "start")).alias("asked"))
    packed = texts.join(by_doc, ["doc", "hash"]).select("doc", "hash", "text", "asked").mapInArrow(
        fetch, "bucket int, " + ", ".join(f"{c} binary" for c, _ in names)
    )
    return packed.groupBy("bucket").applyInArrow(sort, _MARK)


def remove_repeats(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document.

    A byte goes if a string of ``depth`` bytes that covers it also starts earlier, in
    a smaller doc_id or before it in the same document. Texts count as UTF-8, null as
    empty; a null id comes after all others. Documents are told apart by id and text:
    rows that repeat both are one document and all get its result, texts under one id
    are in the order of their hash. An empty table gives no rows.
    """
    texts = _keyed(docs)
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(16, size // BUCKET_BYTES)
    hot = hot_anchors(texts, depth)
    first = stage(_first_digit(_anchor_buckets(texts, buckets, depth, hot)), "anchor-marks")
    rest = _other_digits(texts, first.where(F.col("bucket").isNotNull()), depth)
    found = first.where(F.col("bucket").isNull()).unionAll(rest)
    if len(hot):
        found = found.unionAll(_hot_windows(texts, hot, depth))
    marks = found.groupBy("doc", "hash").agg(
        F.collect_list(F.struct("start", "stop")).alias("marks")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, strings in slices(batches):
            data, bounds = utf8(strings)
            out = [cut_spans(data[a:b], spans) for a, b, spans in zip(bounds[:-1], bounds[1:], part.column("marks"))]
            yield pa.RecordBatch.from_arrays([
                part.column("doc"), pa.array(np.diff(bounds)), pa.array([o[0] for o in out], pa.int64()),
                pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.string()),
            ], names=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = texts.join(marks, ["doc", "hash"], "left").select("doc", "text", "marks")
    done = joined.mapInArrow(cut, "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return done.select(F.nullif(F.col("doc"), F.lit(LAST_DOC)).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def cut_spans(data: np.ndarray, spans: pa.Scalar) -> tuple[int, int, str]:
    """(bytes removed, maximal removed runs, sha256 of the rest)."""
    if not spans.is_valid:
        return 0, 0, hashlib.sha256(data.tobytes()).hexdigest()
    starts = spans.values.field(0).to_numpy().astype(np.int64)
    stops = spans.values.field(1).to_numpy().astype(np.int64)
    steps = np.bincount(starts, minlength=len(data) + 1) - np.bincount(stops, minlength=len(data) + 1)
    gone = np.cumsum(steps)[:-1] > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return int(gone.sum()), runs, hashlib.sha256(data[~gone].tobytes()).hexdigest()
