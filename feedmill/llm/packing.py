"""Packing documents into token sequences by lexical retrieval.

Documents are dealt into shards by their content: a tree of hyperplanes, trained on
a bounded sample of document sketches, keeps documents of like tokens together and
shards equally large. Each shard has a BM25 inverted index over token ids, weighted
by the document frequencies, number and mean length of all documents. A seed
document's distinct tokens are all looked up in it, and the unused documents that
score best follow the seed until the window is full. A document that crosses the end of the window is cut there; its rest
starts the next window and is that window's seed. Only the last window of a shard
can stay open: it is split into sequences whose lengths are powers of two, which
need no padding.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm.words import id_and_text, ragged, slices, word_table
from feedmill.session import drop_staged, stage

WINDOW = 4096
END = 2
SHARD_BYTES = 8 << 20
SLICE_BYTES = 1 << 20  # of encoded documents that are counted or sketched together
SKETCH = 64  # components of a document's sketch
SKETCH_HASHES = 2  # components that a token adds to
SAMPLE_ROWS = 1 << 18  # most sketches the tree is trained on
BLOCK_ROWS = 1 << 13  # of sketches the driver widens together
ROWS_PER_SHARD = 16  # least sampled sketches per leaf of the tree
K1, B = 1.2, 0.75
STEPS = 256  # of a BM25 weight, which is below 128
COMMON = 16  # a token of more than one in so many documents of a shard has a row
FIRST = 64  # neighbours sorted at first
WORD_END = "</w>"
MARK = "\0"
_PLAIN = "^[!-~\u00a1-\u00ac\u00ae-\u00ff]+$"
# Of each character up to U+00FF: 0 between words, 1 a letter, 2 a number, 3 another character.
_KIND = np.array([0 if c == 10 else {"L": 1, "N": 2}.get(unicodedata.category(chr(c))[0], 3) for c in range(256)], np.uint8)

_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class WordTokenizer:
    """Token ids of texts by a lower-casing BPE with word ends, one encoding per distinct word.

    White space only separates, so the ids of a text are those of its words, one
    after the other. Words of printable ASCII and Latin-1 characters go through
    ``tiktoken`` with the file's own vocabulary: a byte that no such word holds stands
    for the word end, and ranks are the ids. All others go through ``tokenizers``.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self._slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        bytes_of = {c: bytes([b]) for b, c in enumerate(_byte_alphabet())}
        ranks = {}
        for token, rank in spec["model"]["vocab"].items():
            if token not in ("<|startoftext|>", "<|endoftext|>"):
                ends = token.endswith(WORD_END)
                raw = b"".join(bytes_of[c] for c in token.removesuffix(WORD_END))
                ranks[raw + MARK.encode() if ends else raw] = rank
        self._pieces = "(" + spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] + ")"
        self._fast = tiktoken.Encoding("words", pat_str=rf"[^{MARK}\n]+{MARK}|\n", mergeable_ranks=ranks, special_tokens={})
        self._line = ranks[b"\n"]

    def _marked(self, words: pa.Array, simple: bool) -> str:
        """The words in lower case, a line each, MARK after each piece.

        In simple words, which hold no apostrophe, a piece is a run of letters, a number or a run of other characters.
        """
        lines = pc.utf8_lower(pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), "\n"))
        if not simple:
            return pc.replace_substring_regex(lines, self._pieces, rf"\1{MARK}")[0].as_py()
        text = np.frombuffer(lines[0].as_py().encode("latin-1"), np.uint8)
        kind = _KIND[text]
        ends = (kind == 2) | (kind != np.append(kind[1:], 0))
        ends &= kind > 0
        marked = np.repeat(text, ends + 1)
        marked[np.flatnonzero(ends) + np.arange(1, np.count_nonzero(ends) + 1)] = ord(MARK)
        return marked.tobytes().decode("latin-1")

    def _encode(self, words: pa.Array, simple: bool) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of each); words of printable ASCII and Latin-1 characters."""
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        ids = np.array(self._fast.encode_ordinary(self._marked(words, simple) + "\n"), np.uint32)
        ends = np.flatnonzero(ids == self._line)
        return ids[ids != self._line], np.diff(ends, prepend=-1) - 1

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each begins and ends), without an end token."""
        codes, bounds, distinct = word_table(texts)
        holds = lambda part: pc.match_substring(distinct, part).to_numpy(zero_copy_only=False)
        plain = pc.match_substring_regex(distinct, _PLAIN).to_numpy(zero_copy_only=False) & ~holds("<|")
        simple = plain & ~holds("'")
        groups = [np.flatnonzero(simple), np.flatnonzero(plain & ~simple), np.flatnonzero(~plain)]
        words = [distinct.take(pa.array(group)) for group in groups]
        slow = [self._slow.encode(w, add_special_tokens=False).ids for w in words[2].to_pylist()]
        found = [self._encode(words[0], True), self._encode(words[1], False)]
        flat = np.concatenate([*[ids for ids, _ in found], *[np.array(x, np.uint32) for x in slow]])
        in_order = np.concatenate(groups)
        lengths = np.zeros(len(distinct), np.int64)
        lengths[in_order] = np.concatenate([*[sizes for _, sizes in found], np.array([len(x) for x in slow], np.int64)])
        begins = np.zeros(len(distinct), np.int64)
        begins[in_order] = np.cumsum(lengths[in_order]) - lengths[in_order]
        of_word = lengths[codes]
        ends = np.concatenate(([0], np.cumsum(of_word)))
        return flat[ragged(begins[codes], of_word)], ends[bounds]


def _byte_alphabet() -> list[str]:
    """The printable character of each byte in byte-level vocabularies: itself, or the next from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def inverse_frequency(number: int, held: np.ndarray) -> np.ndarray:
    """BM25 weight of tokens that ``held`` of ``number`` documents hold."""
    return np.log1p((number - held + 0.5) / (held + 0.5))


class ShardIndex:
    """BM25 inverted index of one shard: postings by token, with the weight of each.

    ``idf`` by token and ``mean`` length are those of all documents; a shard that
    holds all of them finds its own.
    """

    def __init__(self, ids: np.ndarray, bounds: np.ndarray, idf: np.ndarray | None = None, mean: float | None = None):
        sizes = np.diff(bounds)
        number = len(sizes)
        doc = np.repeat(np.arange(number), sizes)
        key, times = np.unique(ids.astype(np.int64) * number + doc, return_counts=True)
        token, self.docs = key // number, (key % number).astype(np.int32)
        self.tokens, first, held = np.unique(token, return_index=True, return_counts=True)
        self.bounds = np.append(first, len(key))
        idf = inverse_frequency(number, held) if idf is None else idf[self.tokens]
        norm = K1 * (1 - B + B * sizes / max(sizes.mean() if mean is None else mean, 1))
        weights = np.repeat(idf, held) * times * (K1 + 1) / (times + norm[self.docs])
        # whole steps, so that sums do not depend on their order
        self.weights = np.rint(weights * STEPS).astype(np.int16)
        self.held, self.number = held, number
        # tokens of many documents as rows over all documents: 16 times the postings at most
        common = np.flatnonzero(held * COMMON > number)
        self.row = np.full(len(held), -1, np.int64)
        self.row[common] = np.arange(len(common))
        self.rows = np.zeros((len(common), number), np.int16)
        at = ragged(self.bounds[common], held[common])
        self.rows[np.repeat(np.arange(len(common)), held[common]), self.docs[at]] = self.weights[at]

    def scores(self, ids: np.ndarray) -> np.ndarray:
        """Score of every document of the shard for all tokens that other documents share, in steps."""
        terms = np.searchsorted(self.tokens, np.unique(ids))
        terms = terms[self.held[terms] > 1]
        rows = self.row[terms]
        rare = terms[rows < 0]
        at = ragged(self.bounds[rare], self.held[rare])
        score = np.bincount(self.docs[at], self.weights[at], self.number).astype(np.int64)
        return score + self.rows[rows[rows >= 0]].sum(axis=0, dtype=np.int32)


def best_first(score: np.ndarray) -> Iterator[int]:
    """Documents with a score, best first, ties in their order; only the first ones are sorted unless more are asked for."""
    related = np.flatnonzero(score > 0)
    value = score[related]
    if len(related) > FIRST:
        least = np.partition(value, len(value) - FIRST)[len(value) - FIRST]
        top = related[value >= least]
        yield from top[np.argsort(-score[top], kind="stable")].tolist()
        related = related[value < least]
    yield from related[np.argsort(-score[related], kind="stable")].tolist()


def reading_order(
    ids: np.ndarray, bounds: np.ndarray, window: int = WINDOW, idf: np.ndarray | None = None, mean: float | None = None
) -> Iterator[int]:
    """Documents of a shard in the order in which they fill its windows."""
    index, sizes = ShardIndex(ids, bounds, idf, mean), np.diff(bounds)
    unused = np.ones(len(sizes), bool)
    seed, filled, following = 0, 0, 0
    while True:
        while following < len(sizes) and not unused[following]:
            following += 1
        if following == len(sizes):
            return
        if not filled:
            seed = following
            unused[seed] = False
            yield seed
            filled = int(sizes[seed])
            if filled >= window:
                filled %= window
                if not filled:
                    continue
        score = index.scores(ids[bounds[seed]: bounds[seed + 1]]) * unused
        # nothing related is left: the next unused document joins and becomes the seed
        for doc in best_first(score) if score.any() else [following]:
            unused[doc] = False
            yield doc
            filled += int(sizes[doc])
            seed = doc
            if filled >= window:
                filled %= window
                break


def cut_points(total: int, window: int = WINDOW) -> np.ndarray:
    """Where sequences begin and end: full windows, then powers of two."""
    cuts = list(range(0, total - total % window + 1, window))
    rest = total % window
    while rest:
        cuts.append(cuts[-1] + (1 << rest.bit_length() - 1))
        rest -= 1 << rest.bit_length() - 1
    return np.array(cuts, np.int64)


def sketches(ids: np.ndarray, bounds: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vectors of SKETCH components; documents that share rare tokens point the same way."""
    rng, number = np.random.default_rng(7), len(bounds) - 1
    row = np.repeat(np.arange(number) * SKETCH, np.diff(bounds))
    out = np.zeros(number * SKETCH)
    for _ in range(SKETCH_HASHES):
        column, sign = rng.integers(0, SKETCH, len(idf)), rng.choice([-1.0, 1.0], len(idf))
        out += np.bincount(row + column[ids], (sign * idf ** 2)[ids], number * SKETCH)
    out = out.reshape(number, SKETCH)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def _blocks(rows: np.ndarray, held: np.ndarray) -> Iterator[np.ndarray]:
    """The rows of the numbers ``held`` as doubles, a bounded number at a time."""
    for start in range(0, len(held), BLOCK_ROWS):
        yield rows[held[start: start + BLOCK_ROWS]].astype(np.float64)


def widest_axis(rows: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Direction in which the rows ``held`` differ most."""
    mean = sum(block.sum(axis=0) for block in _blocks(rows, held)) / len(held)
    spread = sum((block - mean).T @ (block - mean) for block in _blocks(rows, held))
    return np.linalg.eigh(spread)[1][:, -1]


class ShardTree:
    """Hyperplanes that cut sketches into leaves of like documents and equal weight."""

    def __init__(self, rows: np.ndarray, weights: np.ndarray, leaves: int):
        """``leaves`` cuts of the weight, each across the direction in which its sketches differ most.

        The sketches stay as narrow as they came and are never copied as a whole.
        """
        self.axes, self.cuts, self.below = [], [], []
        self._grow(rows, weights, np.arange(len(rows), dtype=np.int32), 0, leaves)
        self.axes, self.cuts, self.below = np.array(self.axes), np.array(self.cuts), np.array(self.below)

    def _grow(self, rows: np.ndarray, weights: np.ndarray, held: np.ndarray, first: int, last: int) -> int:
        """Number of the node for leaves ``first`` to ``last``; a leaf is its own complement."""
        if last - first == 1:
            return ~first
        middle, node = (first + last) // 2, len(self.cuts)
        axis, cut, right = np.zeros(rows.shape[1]), 0.0, np.zeros(len(held), bool)
        if len(held) > 1:
            axis = widest_axis(rows, held)
            along = np.concatenate([block @ axis for block in _blocks(rows, held)])
            order = np.argsort(along, kind="stable")
            sums = np.cumsum(weights[held[order]])
            at = int(np.searchsorted(sums, sums[-1] * (middle - first) / (last - first)))
            # between two sketches, so that copies of one stay together
            cut = along[order[min(at, len(order) - 2): min(at, len(order) - 2) + 2]].mean()
            right = along > cut
        self.axes.append(axis)
        self.cuts.append(cut)
        self.below.append((0, 0))
        self.below[node] = (
            self._grow(rows, weights, held[~right], first, middle), self._grow(rows, weights, held[right], middle, last)
        )
        return node

    def leaf(self, rows: np.ndarray) -> np.ndarray:
        """Leaf of each row."""
        node = np.full(len(rows), 0 if len(self.cuts) else ~0)
        while (at := np.flatnonzero(node >= 0)).size:
            inner = node[at]
            right = np.einsum("ij,ij->i", rows[at], self.axes[inner]) > self.cuts[inner]
            node[at] = self.below[inner, right.astype(int)]
        return ~node


def pack_shard(
    shard: int, doc_ids: pa.Array, ids: np.ndarray, bounds: np.ndarray, window: int = WINDOW,
    idf: np.ndarray | None = None, mean: float | None = None,
) -> pa.Table:
    """Pieces of all documents of one shard."""
    order = np.fromiter(reading_order(ids, bounds, window, idf, mean), np.int64, len(bounds) - 1)
    sizes = np.diff(bounds)[order]
    begins = np.cumsum(sizes) - sizes
    cuts = cut_points(int(sizes.sum()), window)
    edges = np.unique(np.concatenate([begins, cuts]))
    starts, lengths = edges[:-1], np.diff(edges)
    of = np.searchsorted(begins, starts, "right") - 1
    sequence = np.searchsorted(cuts, starts, "right") - 1
    start = starts - begins[of]
    at = bounds[order[of]] + start
    little = ids.astype("<u4")
    return pa.table({
        "doc_id": doc_ids.take(pa.array(order[of])), "start": start, "length": lengths,
        "ids_crc32": pa.array([zlib.crc32(little[a: a + n].tobytes()) for a, n in zip(at, lengths)], pa.int64()),
        "doc_tokens": sizes[of], "sequence_id": (np.int64(shard) << 32) + sequence, "offset": starts - cuts[sequence],
    })


def _token_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Encoded rows in bounded slices: (rows, ids of all, where each begins and ends)."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("ids")).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + SLICE_BYTES, "right")))
            rows = batch.slice(start, stop - start)
            widths = rows.column("width").to_numpy()
            parts = [np.frombuffer(b, f"<u{w}").astype(np.int64) for b, w in zip(rows.column("ids").to_pylist(), widths)]
            yield rows, np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))
            start = stop


def documents_holding(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, how many of the documents hold each)."""
    if ids.max(initial=0) < 1 << 16:
        ids = ids.astype(np.uint16)  # sorted by its digits, in linear time
    order = np.argsort(ids, kind="stable")
    token, doc = ids[order], np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))[order]
    first = np.ones(len(ids), bool)
    first[1:] = (token[1:] != token[:-1]) | (doc[1:] != doc[:-1])
    counts = np.bincount(token[first])
    tokens = np.flatnonzero(counts)
    return tokens, counts[tokens]


def with_statistics(encoded: DataFrame) -> DataFrame:
    """size and held of encoded documents (code, doc_id, width, ids) that came without them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ids, bounds in _token_ids(batches):
            held = np.concatenate(documents_holding(ids, bounds)).astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.diff(bounds)), pa.array([held] + [None] * (rows.num_rows - 1), pa.binary())], names=["size", "held"])

    return encoded.mapInArrow(count, "size long, held binary")


def corpus_statistics(encoded: DataFrame, end: int = END) -> tuple[int, int, np.ndarray]:
    """(documents, tokens, inverse document frequency by token) of all encoded documents, end tokens included.

    One document of each slice carries the tokens of the slice and how many documents hold each.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.int64)
        for batch in batches:
            for blob in batch.column("held").to_pylist():
                tokens, counts = np.frombuffer(blob, "<u4").astype(np.int64).reshape(2, -1)
                if tokens.max(initial=-1) >= len(held):
                    held = np.concatenate([held, np.zeros(int(tokens.max()) + 1 - len(held), np.int64)])
                held[tokens] += counts
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["token", "held"])

    encoded = encoded if "held" in encoded.columns else with_statistics(encoded)
    length = F.coalesce(F.sum(F.col("size")), F.lit(0))
    number, tokens = encoded.agg(F.count(F.lit(1)), length).first()
    slices_ = encoded.where(F.col("held").isNotNull()).select("held")
    # one row per entry of the vocabulary at most
    found = slices_.mapInArrow(count, "token long, held long").groupBy("token").agg(F.sum("held").alias("held")).toArrow()
    token = found.column("token").to_numpy()
    held = np.zeros(max(token.max(initial=0), end) + 1)
    held[token] = found.column("held").to_numpy()
    held[end] = number
    return number, tokens + number, inverse_frequency(number, held)


def shard_tree(encoded: DataFrame, number: int, idf: np.ndarray, shards: int) -> ShardTree:
    """Tree with a leaf per shard, trained on documents whose hash is small, at most about SAMPLE_ROWS."""
    if shards == 1:
        return ShardTree(np.zeros((0, SKETCH)), np.zeros(0), 1)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ids, bounds in _token_ids(batches):
            # half precision is enough to place the cuts
            narrow = sketches(ids, bounds, idf).astype("<f2")
            yield pa.RecordBatch.from_arrays([
                rows.column("code"), pa.array(np.diff(bounds) + 1), pa.array([row.tobytes() for row in narrow], pa.binary()),
            ], names=["code", "tokens", "sketch"])

    share = int(min(1.0, SAMPLE_ROWS / max(number, 1)) * (1 << 30))
    sample = encoded.where(F.pmod("code", F.lit(1 << 30)) < share).mapInArrow(
        sketch, "code long, tokens long, sketch binary"
    ).toArrow()
    tokens = sample.column("tokens").to_numpy()
    rows = np.empty((len(tokens), SKETCH), "<f2")
    done = 0
    for part in sample.column("sketch").chunks:
        for start in range(0, len(part), BLOCK_ROWS):
            joined = b"".join(part.slice(start, BLOCK_ROWS).to_pylist())
            block = np.frombuffer(joined, "<f2").reshape(-1, SKETCH)
            rows[done: done + len(block)] = block
            done += len(block)
    # in an order that does not depend on the tasks
    order = np.lexsort((tokens, sample.column("code").to_numpy()))
    del sample
    return ShardTree(rows[order], tokens[order], min(shards, max(1, len(rows) // ROWS_PER_SHARD)))


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece.

    A document is its token ids and ``end``; null and empty texts are ``end`` alone.
    Each id lies in exactly one piece. Sequences hold ``window`` tokens; at the end
    of a shard they are shorter, each a power of two. A null id is packed like any
    other, repeated rows are packed each; an empty table gives no rows. Shards hold
    about SHARD_BYTES of text whatever the size of the table: the tree has a leaf for
    each, and a leaf that holds more than twice its share, such as many copies, is
    spread by the hash of id and text.
    """
    texts = id_and_text(docs)
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-size // SHARD_BYTES))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(tokenizer_path)
        for part, strings in slices(batches, limit=SHARD_BYTES):
            ids, bounds = tokenizer.encode(strings)
            kind = "<u2" if len(ids) == 0 or ids.max() < 1 << 16 else "<u4"
            held = np.concatenate(documents_holding(ids, bounds)).astype("<u4").tobytes()
            ids = ids.astype(kind)
            yield pa.RecordBatch.from_arrays([
                part.column("code"), part.column("doc_id"), pa.array([np.dtype(kind).itemsize] * part.num_rows, pa.int32()),
                pa.array([ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()), pa.array(np.diff(bounds)),
                pa.array([held] + [None] * (part.num_rows - 1), pa.binary()),
            ], names=["code", "doc_id", "width", "ids", "size", "held"])

    encoded = stage(texts.withColumn("code", F.xxhash64("doc_id", "text")).mapInArrow(
        encode, "code long, doc_id long, width int, ids binary, size long, held binary"), "token-ids")
    number, tokens, idf = corpus_statistics(encoded, end)
    tree = shard_tree(encoded, number, idf, shards)
    mean, shared = tokens / max(number, 1), texts.sparkSession.sparkContext.broadcast((idf, tree))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, tree = shared.value
        for rows, ids, bounds in _token_ids(batches):
            leaf = pa.array(tree.leaf(sketches(ids, bounds, idf)), pa.int32())
            yield pa.RecordBatch.from_arrays([leaf, *rows.columns], names=["leaf", *rows.schema.names])

    # the tree has at most SAMPLE_ROWS / ROWS_PER_SHARD leaves
    parts = np.ones(len(tree.cuts) + 1, np.int64)
    dealt, columns = encoded.select(F.lit(0).alias("leaf"), "code", "doc_id", "width", "ids", "size"), "code long, doc_id long, width int, ids binary"
    if len(tree.cuts):
        dealt = stage(encoded.select("code", "doc_id", "width", "ids", "size").mapInArrow(place, f"leaf int, {columns}, size long"), "dealt-ids")
        drop_staged(encoded)
    if shards > 1:
        for leaf, held in dealt.groupBy("leaf").agg(F.sum(F.col("size") + 1)).collect():
            parts[leaf] = 1 if held * shards <= 2 * tokens else -(-held * shards // tokens)
    # one row per leaf
    spread = texts.sparkSession.createDataFrame(
        list(zip(range(len(parts)), (np.cumsum(parts) - parts).tolist(), parts.tolist())), "leaf int, before long, parts long")
    keyed = dealt.join(F.broadcast(spread), "leaf").select(
        (F.col("before") + F.pmod("code", "parts")).cast("int").alias("shard"), "doc_id", "width", "ids")

    def fill(table: pa.Table) -> pa.Table:
        idf, _ = shared.value
        table = table.sort_by([("doc_id", "ascending"), ("ids", "ascending")])
        widths = table.column("width").to_numpy()
        parts = [np.append(np.frombuffer(b, f"<u{w}"), np.uint32(end)).astype(np.uint32)
                 for b, w in zip(table.column("ids").to_pylist(), widths)]
        bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        return pack_shard(
            table.column("shard")[0].as_py(), table.column("doc_id").combine_chunks(), np.concatenate(parts), bounds,
            window, idf, mean,
        )

    return keyed.groupBy("shard").applyInArrow(fill, _PIECE)
