"""Alignment of two tokenizations of the same texts, and how often two ids are linked.

Both tokenizers read whole texts. Places where a token that carries the space mark
begins in both, and both have come to the same byte, are anchors: they cut a document
into windows, pairs of id tuples. A window is aligned once in a slice of text, whatever
the documents it occurs in: the byte offsets where tokens of both sides end together cut it into groups,
and every id of a group is linked to every id of the other side.

Counts over the corpus take three steps. A task aligns a slice of text and writes, in
one row, the windows of its documents as numbers, its distinct windows and its distinct
id pairs with the number of documents that hold them. The counts of a pair are summed
over the slices, and the largest of an id's pairs found. Both go back to the slices that
hold the pair, where the links of a document are summed up.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm.words import distinct_strings, gather, id_and_text, ragged, slices, space_chunks, sums_between, utf8
from feedmill.operators.joins import attach_by_key
from feedmill.session import stage

SPACE = "▁"
SLICE = 1 << 20  # bytes of text aligned at a time
BLOCK = 1 << 16  # characters that a tokenizer reads at a time


class ByteTokens:
    """Ids by a byte-level BPE; strings of special tokens in a text are plain text.

    If the merges of the file are in the order of the ids they make, ``tiktoken`` reads
    texts by these ids as ranks, which gives the same; else ``tokenizers`` does.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = iter(range(256, 512))
        byte_of = {chr(b) if b in printable else chr(next(others)): b for b in range(256)}
        vocabulary, added = spec["model"]["vocab"], {t["content"] for t in spec["added_tokens"]}
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(byte_of[c] for c in token) if token not in added else token.encode()
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
        made = [vocabulary[left + right] for left, right in merges]
        plain = spec["normalizer"] is None and spec["pre_tokenizer"] == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True,
        }
        if plain and made == sorted(made) and len(made) + 256 == len(vocabulary.keys() - added):
            import public_tokenizers
            import tiktoken

            ranks = {self.bytes[i]: i for token, i in vocabulary.items() if token not in added}
            self.encode = tiktoken.Encoding("ids", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            slow = Tokenizer.from_file(path)
            slow.encode_special_tokens = True
            self.encode = lambda text: slow.encode(text, add_special_tokens=False).ids


class PieceTokens:
    """Ids by a sentence-piece model, which puts the space that a text begins with before it itself."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [
            bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(SPACE, " ").encode()
            for i, piece in enumerate(model.id_to_piece(list(range(model.get_piece_size()))))
        ]
        self._space = [model.piece_to_id(SPACE)]

    def encode(self, text: str) -> list[int]:
        # a space alone would be an empty text
        return self._model.encode(text[1:], num_threads=1) if len(text) > 1 else self._space


@lru_cache(maxsize=4)
def tokenizer(kind: Callable, path: str):
    """One tokenizer for all tasks of a worker."""
    return kind(path)


class Side:
    """One tokenizer with the byte lengths of its tokens."""

    def __init__(self, tokens):
        self.tokens = tokens
        self.sizes = np.array([len(b) for b in tokens.bytes], np.int64)
        self.spaced = np.array([b[:1] == b" " for b in tokens.bytes])

    def encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all chunks, number of each, whether they spell it).

        Chunks begin with a space; those that end in ASCII other than white space are
        read many at a time, as no token reaches across their end.
        """
        closed = np.array(["!" <= c[-1:] <= "~" for c in chunks], bool)
        blocks = [np.array([k]) for k in np.flatnonzero(~closed)]
        together = np.flatnonzero(closed)
        sizes = np.cumsum([len(chunks[k]) for k in together])
        blocks += np.split(together, np.flatnonzero(np.diff(sizes // BLOCK)) + 1) if len(together) else []
        lengths, spelled, parts = np.zeros(len(chunks), np.int64), np.ones(len(chunks), bool), []
        while blocks:
            block = blocks.pop(0)
            texts = [chunks[k] for k in block]
            ids = self.tokens.encode("".join(texts))
            own = [t.encode() for t in texts]
            ends = np.cumsum(self.sizes[ids])
            stops = np.cumsum([len(t) for t in own])
            cuts = np.searchsorted(ends, stops)
            whole = b"".join([self.tokens.bytes[i] for i in ids]) == b"".join(own)
            if not whole and len(block) > 1:
                # some text of the block is not spelled: which one?
                blocks[:0] = np.split(block, [len(block) // 2])
                continue
            spelled[block] = whole
            lengths[block] = np.diff(cuts + 1, prepend=0) if whole else len(ids)
            parts.append((block, np.array(ids, np.int64)))
        order = np.concatenate([b for b, _ in parts] or [np.zeros(0, np.int64)])
        flat = np.concatenate([i for _, i in parts] or [np.zeros(0, np.int64)])
        begins = np.zeros(len(chunks), np.int64)
        begins[order] = np.cumsum(lengths[order]) - lengths[order]
        return flat[ragged(begins, lengths)], lengths, spelled


def _decimal(values: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(decimal digits of all values, each with the byte of ``after`` behind it; where each begins and ends)."""
    digits = 1 + np.searchsorted(10 ** np.arange(1, 10), values, "right")
    ends = np.cumsum(digits + 1)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    out[ends - 1] = after
    rest = values.copy()
    for k in range(int(digits.max(initial=0))):
        at = np.flatnonzero(digits > k)
        out[ends[at] - 2 - k] = 48 + rest[at] % 10
        rest[at] //= 10
    return out, np.concatenate(([0], ends))


def align(a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray) -> tuple:
    """Groups and links of windows that lie one after the other, cut at ``a_cuts`` and ``b_cuts``.

    (groups of each window, text of each, linked pairs by window, how often each, pairs of each window)
    """
    at_a = np.flatnonzero(np.isin(a_ends, b_ends, assume_unique=True)) + 1
    at_b = np.searchsorted(b_ends, a_ends[at_a - 1]) + 1
    n_a, n_b = np.diff(at_a, prepend=0), np.diff(at_b, prepend=0)
    groups = np.diff(np.searchsorted(at_a, a_cuts, "right"))
    window = np.repeat(np.arange(len(groups)), groups)
    # the text: ids of a, then ids of b, group by group
    in_order = np.argsort(np.concatenate([np.repeat(np.arange(len(n_a)) * 2, n_a), np.repeat(np.arange(len(n_b)) * 2 + 1, n_b)]), kind="stable")
    after = np.full(len(a) + len(b), ord(","), np.uint8)
    stops = np.cumsum(n_a + n_b)
    after[stops - 1] = ord(";")
    after[stops - n_b - 1] = ord("|")
    text, places = _decimal(np.concatenate([a, b])[in_order], after)
    raw, ends = text.tobytes(), places[np.concatenate(([0], stops))][np.concatenate(([0], np.cumsum(groups)))]
    texts = [raw[x:y] for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())]
    # ids that repeat within a group are counted first, so a group makes a row per two ids, not per two tokens
    sides = []
    for ids, number in ((a, n_a), (b, n_b)):
        key, times = np.unique(np.repeat(np.arange(len(number)), number) << 32 | ids, return_counts=True)
        sides.append((key & 0xFFFFFFFF, times, np.bincount(key >> 32, minlength=len(number))))
    (x, x_times, x_held), (y, y_times, y_held) = sides
    of = np.repeat(np.arange(len(x_held)), x_held)
    right = ragged((np.cumsum(y_held) - y_held)[of], y_held[of])
    left = np.repeat(np.arange(len(x)), y_held[of])
    pair, count, window = x[left] << 32 | y[right], x_times[left] * y_times[right], window[of][left]
    order = np.lexsort([pair, window])
    pair, count, window = pair[order], count[order], window[order]
    new = np.ones(len(pair), bool)
    new[1:] = (pair[1:] != pair[:-1]) | (window[1:] != window[:-1])
    first = np.flatnonzero(new)
    return groups, texts, pair[first], np.add.reduceat(count, first) if len(first) else count, np.bincount(window[first], minlength=len(groups))


class Aligner:
    """Aligned documents of slices of text."""

    def __init__(self, one, two):
        self.sides = (Side(one), Side(two))

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, list, np.ndarray]:
        """(byte offsets of the texts, (ids, offsets into them) of both sides, texts that both sides spell)."""
        data, bounds = utf8(texts)
        begins, first = space_chunks(data, bounds)
        codes, distinct = distinct_strings(data, begins)
        chunks = distinct.to_pylist()
        wrong, out = np.zeros(len(chunks), bool), []
        for side in self.sides:
            ids, lengths, spelled = side.encode(chunks)
            wrong |= ~spelled
            flat, ends = gather(ids, lengths, codes)
            out.append((flat, np.concatenate(([0], ends))[first]))
        return bounds, out, sums_between(wrong[codes].astype(np.int64), first) == 0

    def slice(self, texts: pa.Array) -> dict[str, np.ndarray | list]:
        """What a slice's row holds; ``texts`` begin with the space, texts without tokens are empty."""
        bounds, sides, whole = self._encode(texts)
        if not whole.all():
            return self.slice(pc.if_else(pa.array(whole), texts, ""))
        (a, a_first), (b, b_first) = sides
        a_ends, b_ends = np.cumsum(self.sides[0].sizes[a]), np.cumsum(self.sides[1].sizes[b])
        # shared ends before a token that carries the space mark on both sides, and ends of texts
        at_a = np.flatnonzero(np.isin(a_ends, b_ends, assume_unique=True))
        at_b = np.searchsorted(b_ends, a_ends[at_a])
        last = np.isin(a_ends[at_a], bounds)
        marked = np.append(self.sides[0].spaced[a], True)[at_a + 1] & np.append(self.sides[1].spaced[b], True)[at_b + 1]
        anchors = np.flatnonzero(last | marked)
        a_cuts, b_cuts = np.append(0, at_a[anchors] + 1), np.append(0, at_b[anchors] + 1)
        of_text = np.searchsorted(a_cuts, a_first)
        codes, firsts = self._codes(a, a_cuts, b, b_cuts)
        # each distinct window is aligned once
        own = [(x[ragged(cuts[firsts], n)], np.append(0, np.cumsum(n))) for x, cuts, n in (
            (a, a_cuts, np.diff(a_cuts)[firsts]), (b, b_cuts, np.diff(b_cuts)[firsts]))]
        own_ends = [np.cumsum(side.sizes[ids]) for side, (ids, _) in zip(self.sides, own)]
        groups, text, pair_of, times, held = align(own[0][0], own[1][0], *own_ends, own[0][1], own[1][1])
        pairs, index = np.unique(pair_of, return_inverse=True)
        links = sums_between(times, np.concatenate(([0], np.cumsum(held))))
        # documents that hold a pair: each of their distinct windows once
        doc = np.repeat(np.arange(len(texts)), np.diff(of_text))
        once = np.unique(doc * max(len(firsts), 1) + codes)
        doc, window = once // max(len(firsts), 1), once % max(len(firsts), 1)
        at, _ = gather(index, held, window)
        holding = np.unique(np.repeat(doc, held[window]) * max(len(pairs), 1) + at) % max(len(pairs), 1)
        digests = [
            hashlib.sha256(b"".join([text[c] for c in codes[x:y].tolist()])[:-1]).hexdigest() if y > x else ""
            for x, y in zip(of_text[:-1].tolist(), of_text[1:].tolist())
        ]
        return {
            "n_a": np.diff(a_first), "n_b": np.diff(b_first), "n_groups": sums_between(groups[codes], of_text),
            "n_links": sums_between(links[codes], of_text), "groups_sha256": digests,
            "bounds": of_text, "codes": codes, "held": held, "index": index, "times": times,
            "pairs": pairs, "docs": np.bincount(holding, minlength=len(pairs)),
        }

    @staticmethod
    def _codes(a: np.ndarray, a_cuts: np.ndarray, b: np.ndarray, b_cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of each window, where each distinct window first occurs)."""
        numbers = []
        for ids, cuts in ((a, a_cuts), (b, b_cuts)):
            buffers = [None, pa.py_buffer((cuts * 4).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))]
            tuples = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, buffers).dictionary_encode()
            numbers.append(tuples.indices.to_numpy(zero_copy_only=False).astype(np.int64))
        both = numbers[0] * (numbers[1].max(initial=0) + 1) + numbers[1]
        _, firsts, codes = np.unique(both, return_index=True, return_inverse=True)
        return codes, firsts


_LISTS = {"doc_id": "long", "n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "groups_sha256": "string"}
_BLOBS = ("bounds", "codes", "held", "index", "times", "pairs", "docs")


def _pack(values: np.ndarray) -> bytes:
    """The width that holds all of the values, none below zero, and their bytes."""
    most = int(values.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def align_texts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per slice of text: its documents, windows and id pairs."""
    spaced = id_and_text(docs).withColumn("text", F.when(F.col("text") != "", F.concat(F.lit(" "), "text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(tokenizer(ByteTokens, a_path), tokenizer(PieceTokens, b_path))
        for part, texts in slices(batches, limit=SLICE):
            found = {"doc_id": part.column("doc_id"), **aligner.slice(texts)}
            lists = [pa.array([pa.array(found[c]).to_pylist()], pa.list_(pa.string() if k == "string" else pa.int64())) for c, k in _LISTS.items()]
            blobs = [pa.array([_pack(found[c])], pa.binary()) for c in _BLOBS]
            yield pa.RecordBatch.from_arrays([*lists, *blobs], names=[*_LISTS, *_BLOBS])
            del found, lists, blobs
            pa.default_memory_pool().release_unused()

    schema = [f"{c} array<{k}>" for c, k in _LISTS.items()] + [f"{c} binary" for c in _BLOBS]
    return spaced.mapInArrow(run, ", ".join(schema))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """slice, place (in the slice's pairs), a and b of every id pair of every slice, and the documents there that hold it."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, pairs, docs in zip(*(batch.column(c).to_pylist() for c in ("slice", "pairs", "docs"))):
                pair, held = _unpack(pairs), _unpack(docs)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(pair), number)), pa.array(np.arange(len(pair), dtype=np.int32)),
                    pa.array((pair >> 32).astype(np.int32)), pa.array((pair & 0xFFFFFFFF).astype(np.int32)), pa.array(held),
                ], names=["slice", "place", "a", "b", "docs"])

    return aligned.select("slice", "pairs", "docs").mapInArrow(unpack, "slice long, place int, a int, b int, docs long")


def _finish(slices_: pa.Table, counts: pa.Table) -> pa.Table:
    """Documents of one slice with the sums over their links."""
    row = {c: _unpack(slices_.column(c)[0].as_py()) for c in _BLOBS if c != "docs"}
    count, best = np.zeros(len(row["pairs"]), np.int64), np.zeros(len(row["pairs"]), np.int64)
    place = counts.column("place").to_numpy()
    count[place], best[place] = counts.column("count").to_numpy(), counts.column("best").to_numpy()
    ends = np.concatenate(([0], np.cumsum(row["held"])))
    times = row["times"]
    score = sums_between(times * count[row["index"]], ends)
    top = sums_between(times * (count == best)[row["index"]], ends)
    bounds = row["bounds"]
    out = {c: slices_.column(c).combine_chunks().flatten() for c in _LISTS}
    out["n_best"] = pa.array(sums_between(top[row["codes"]], bounds))
    out["count_sum"] = pa.array(sums_between(score[row["codes"]], bounds))
    return pa.table(out)


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document.

    A text gets a space before it for tokenizer ``a`` (byte-level BPE); ``b`` (sentence
    pieces) adds its own. Null and empty texts, and texts that the tokens of either do
    not spell exactly, have no tokens: zeros and an empty hash. A null id stays null,
    repeated rows are documents each, an empty table gives no rows; other columns take
    no part. A task holds a slice of text, or one longer text. An id pair crosses the
    network once per slice that holds it; pairs that very many slices hold are spread.
    """
    aligned = stage(align_texts(docs, a_path, b_path).withColumn("slice", F.monotonically_increasing_id()), "aligned")
    held = stage(pair_counts(aligned), "slice-pairs")
    counts = held.groupBy("a", "b").agg(F.sum("docs").alias("count"), F.count(F.lit(1)).alias("_slices"))
    counts = stage(counts, "pair-counts")
    best = counts.groupBy("a").agg(F.max("count").alias("best"))
    facts = counts.join(best, "a")
    scored = attach_by_key(held.drop("docs"), facts, ["a", "b"], "_slices").select("slice", "place", "count", "best")
    schema = ", ".join(f"{c} {k}" for c, k in _LISTS.items()) + ", n_best long, count_sum long"
    done = aligned.drop("docs").groupBy("slice").cogroup(scored.groupBy("slice")).applyInArrow(_finish, schema)
    return done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
