"""Token counts by a linear longest-match automaton.

The vocabulary becomes one trie with two roots: pieces that start a word and
pieces that continue one. A failure link leads from a node to the node reached
after the greedy pieces of its string are popped, and the number of popped
pieces is stored with it. A word is then read byte by byte, never looking back,
and its greedy piece count is the sum of the pops. All distinct words of a slice
advance together, one byte per numpy step.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from feedmill.llm.words import id_and_text, slices, sums_between, utf8, word_table

WORD_MARK = "▁"
NO_NODE = -1


@dataclass
class Automaton:
    edges: np.ndarray  # node * 256 + byte, sorted
    targets: np.ndarray
    failure: np.ndarray
    pops: np.ndarray
    starts: int
    middle: int
    mark: bytes  # bytes put before every word

    def child(self, nodes: np.ndarray, byte: np.ndarray) -> np.ndarray:
        wanted = nodes.astype(np.int64) * 256 + byte
        at = np.searchsorted(self.edges, wanted)
        at[at == len(self.edges)] = 0
        return np.where(self.edges[at] == wanted, self.targets[at], NO_NODE)

    def piece_counts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Greedy pieces of each word; 1 where the vocabulary cannot spell it, 0 if empty."""
        mark = np.frombuffer(self.mark, np.uint8)
        begins, lengths = bounds[:-1], np.diff(bounds)
        counts = np.zeros(len(lengths), np.int64)
        state = np.full(len(lengths), self.starts, np.int64)
        alive = np.flatnonzero(lengths > 0)
        alive = alive[np.argsort(-lengths[alive], kind="stable")]
        longest_first = -lengths[alive]
        for step in range(len(mark) + (int(lengths.max()) if len(lengths) else 0)):
            at = step - len(mark)
            if at >= 0:
                alive = alive[: np.searchsorted(longest_first, -at, "left")]
                byte = data[begins[alive] + at]
            else:
                byte = np.full(len(alive), mark[step])
            self._advance(alive, byte, state, counts)
        words = np.flatnonzero(lengths > 0)
        while len(words):
            words = words[(state[words] != self.middle) & (state[words] != NO_NODE)]
            counts[words] += self.pops[state[words]]
            state[words] = self.failure[state[words]]
        counts[(state == NO_NODE) & (lengths > 0)] = 1
        return counts

    def _advance(self, words: np.ndarray, byte: np.ndarray, state: np.ndarray, counts: np.ndarray) -> None:
        live = state[words] != NO_NODE
        words, byte = words[live], byte[live]
        while len(words):
            reached = self.child(state[words], byte)
            found = reached != NO_NODE
            state[words[found]] = reached[found]
            words, byte = words[~found], byte[~found]
            counts[words] += self.pops[state[words]]
            state[words] = self.failure[state[words]]
            live = state[words] != NO_NODE
            words, byte = words[live], byte[live]


def build_automaton(initial: Iterable[bytes], middle: Iterable[bytes], mark: bytes = b"") -> Automaton:
    """Trie, failure links and pop counts of a vocabulary.

    ``initial`` pieces start a word (after ``mark``), ``middle`` pieces continue it.
    """
    children: list[dict[int, int]] = [{}, {}]
    is_piece = [False, False]
    for root, pieces in ((0, initial), (1, middle)):
        for piece in pieces:
            node = root
            for byte in piece:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    is_piece.append(False)
                node = children[node][byte]
            if node != root:
                is_piece[node] = True
    failure, pops = [NO_NODE] * len(children), [0] * len(children)
    level = [0, 1]
    while level:
        below = []
        for parent in level:
            for byte, node in children[parent].items():
                below.append(node)
                if is_piece[node]:
                    failure[node], pops[node] = 1, 1
                    continue
                popped, back = pops[parent], failure[parent]
                while back != NO_NODE and byte not in children[back]:
                    popped, back = popped + pops[back], failure[back]
                if back != NO_NODE:
                    failure[node], pops[node] = children[back][byte], popped
        level = below
    edges = [(node * 256 + byte, to) for node, out in enumerate(children) for byte, to in out.items()]
    edges.sort()
    return Automaton(
        np.array([e for e, _ in edges] or [-1], np.int64),
        np.array([t for _, t in edges] or [NO_NODE], np.int64),
        np.array(failure, np.int64), np.array(pops, np.int64), 0, 1, mark,
    )


def sentencepiece_automaton(model_file: str) -> Automaton:
    """Pieces with the word mark start a word, others continue it; byte pieces spell the rest."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    initial, middle = [], []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            middle.append(bytes([int(piece[3:5], 16)]))
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            (initial if piece.startswith(WORD_MARK) else middle).append(piece.encode())
    return build_automaton(initial, middle, WORD_MARK.encode())


def count_tokens(
    docs: DataFrame, automaton: Automaton, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Words and greedy word pieces of every whole text: doc_id, n_words, n_tokens.

    Words are ``[^\\x20\\x09-\\x0D]+``. Null and empty texts have 0 of both; a null
    id stays null; repeated rows are counted each; an empty table gives no rows.
    No shuffle: one Arrow pass, with memory bounded by a slice of the text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(automaton)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for part, texts in slices(batches):
            codes, bounds, distinct = word_table(texts)
            data, ends = utf8(distinct)
            pieces = machine.piece_counts(data, ends)
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"),
                pa.array(sums_between((np.diff(ends) > 0)[codes].astype(np.int64), bounds)),
                pa.array(sums_between(pieces[codes], bounds)),
            ], names=["doc_id", "n_words", "n_tokens"])

    return id_and_text(docs, doc_id, text).mapInArrow(count, "doc_id long, n_words long, n_tokens long")
