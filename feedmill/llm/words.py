"""Words of whole texts in Arrow batches.

Python workers see a bounded number of bytes at a time, and do the costly work
once per distinct word of such a slice instead of once per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 4 << 20


def id_and_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns every text operator reads; all others are pruned from the scan."""
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Consecutive rows of at most ``limit`` bytes (or a single longer row), null texts as empty."""
    for batch in batches:
        texts = batch.column(column)
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
            part = batch.slice(start, stop - start)
            yield part, pc.fill_null(part.column(column), "")
            start = stop


def word_table(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(code of each word, where each text's codes begin and end, distinct words).

    Words are ``[^\\x20\\x09-\\x0D]+``. The split leaves empty words at the ends
    of a text; they stay in the table as the empty string.
    """
    lists = pc.ascii_split_whitespace(texts)
    bounds = lists.offsets.to_numpy()
    coded = lists.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    return codes, (bounds - bounds[0]).astype(np.int64), coded.dictionary


def sums_between(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive bounds."""
    total = np.zeros(len(values) + 1, dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``start, start+1, ...`` of each run, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def utf8(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all strings, where each begins and ends)."""
    if len(strings) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    strings = strings.cast(pa.string())
    _, offsets, data = strings.buffers()
    bounds = np.frombuffer(offsets, np.int32)[strings.offset: strings.offset + len(strings) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[bounds[0]: bounds[-1]], (bounds - bounds[0]).astype(np.int64)


def space_chunks(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where each chunk of the texts in ``data`` begins, and the end; chunks before each text).

    A chunk begins at every space after an ASCII character that is no white space, and
    at every text. No word pattern or piece that holds a space anywhere but at its
    front reaches across such a place, so chunks can be encoded one by one.
    """
    white = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D)) | ((data >= 0x1C) & (data <= 0x1F)) | (data >= 0x80)
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = (data[1:] == 0x20) & ~white[:-1]
    cut[bounds] = True
    begins = np.flatnonzero(cut)
    return begins, np.searchsorted(begins, bounds)


def distinct_strings(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(code of each string between consecutive ``begins``, distinct strings)."""
    buffers = [None, pa.py_buffer(begins.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    coded = pa.Array.from_buffers(pa.string(), len(begins) - 1, buffers).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def gather(flat: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(runs of ``flat`` in the order of ``codes``, where each ends): run k has ``lengths[k]`` values."""
    begins = np.cumsum(lengths) - lengths
    of = lengths[codes]
    return flat[ragged(begins[codes], of)], np.cumsum(of)
