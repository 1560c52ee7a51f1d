"""Byte-level BPE as a finite-state transducer, and streaming decoding.

Merges are compiled into a nondeterministic transducer: a trie of all tokens that merges
lead to, and a test whether two tokens can stand side by side. They can if no merge
across their border comes before the merges that enclose it on either side. What has
been read of a word up to some place has exactly one such sequence of tokens. The
transducer is made deterministic while it reads: all ways to go on are followed
together, and as the places they have reached in the trie are suffixes of the deepest
one, that place names the state. A move is worked out when it is first needed, along
suffix links, and kept. Tokens are emitted once all ways pass through them, which no
way can delay by more than the length of the tokens begun.

Decoding looks tokens up and keeps back the bytes of an unfinished character, which a
UTF-8 state machine recognises, so a stream of ids can be cut anywhere.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from feedmill.llm.words import distinct_strings, gather, id_and_text, slices, space_chunks, sums_between, utf8

MOST_PAIRS = 1 << 20  # tests of two tokens that are remembered
MOST_MOVES = 1 << 20  # moves that are remembered
LOOK_BACK = 1 << 12  # bytes of a word after which certain tokens are emitted
TOGETHER = 64  # bytes of a word up to which it advances together with others
WORDS_AT_ONCE = 1 << 15
DECODE_BLOCK = 1 << 16  # ids decoded at a time
NEVER = 1 << 62
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: base64 of the token, a space, its rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts that are merged last when ``token`` is spelled from bytes; None if merges do not lead to it."""
    parts = [token[i: i + 1] for i in range(len(token))]
    while len(parts) > 2:
        rank, at = min((ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == NEVER:
            return None
        parts[at: at + 2] = [parts[at] + parts[at + 1]]
    return parts[0], parts[1]


class _Lazy(dict):
    """Values worked out when they are first asked for; starts anew beyond ``most`` of them."""

    def __init__(self, work, most: int):
        self.work, self.most = work, most

    def __missing__(self, key: int):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.work(key)
        return value


class _Cache:
    """Arrays of values for arrays of keys, one place for each key's hash, in front of a ``_Lazy``."""

    def __init__(self, source: _Lazy, bits: int):
        self.source, self.shift = source, np.uint64(64 - bits)
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        slot = (keys.view(np.uint64) * _SPREAD) >> self.shift
        out, missing = self.values[slot], np.flatnonzero(self.keys[slot] != keys)
        if len(missing):
            wanted, first, where = np.unique(keys[missing], return_index=True, return_inverse=True)
            found = np.array([self.source[k] for k in wanted.tolist()], np.int32)
            out[missing] = found[where]
            at = slot[missing][first]
            self.keys[at], self.values[at] = wanted, found
        return out


class Transducer:
    """Ids of words by the merges of ``ranks``, as certain as soon as they are."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.spelling = ranks, {rank: token for token, rank in ranks.items()}
        self.merges = {token: last_merge(token, ranks) for token in ranks if len(token) > 1}
        # the trie: below, above and the last byte of a node, the token that ends there
        self.edges: dict[int, int] = {}
        self.above, self.last, self.accepts = [0], [0], [-1]
        for token, rank in ranks.items():
            if len(token) > 1 and self.merges[token] is None:
                continue
            node = 0
            for byte in token:
                below = self.edges.get(node << 8 | byte)
                if below is None:
                    below = self.edges[node << 8 | byte] = len(self.above)
                    self.above.append(node)
                    self.last.append(byte)
                    self.accepts.append(-1)
                node = below
            self.accepts[node] = rank
        self.spines: tuple[dict, dict] = ({}, {})
        self.size = {rank: len(token) for token, rank in ranks.items()}
        # filled while reading: node and byte, two tokens
        self.moves = _Lazy(self._move, MOST_MOVES)
        self.allowed = _Lazy(self._fits, MOST_PAIRS)
        self.suffix: dict[int, int] = {0: 0}
        self.ends: dict[int, tuple[tuple[int, int], ...]] = {0: ()}
        # the same for many words at a time
        self.many_moves, self.many_allowed = _Cache(self.moves, 18), _Cache(self.allowed, 20)
        self.first = np.zeros(len(self.above), np.int64)
        self.listed = np.zeros((1 << 12, 2), np.int32)
        self.used = 0
        self.sizes = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
        self.sizes[list(self.size)] = list(self.size.values())

    def _spine(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """Parts of a token at its left (0) or right (1) end, largest first, with the rank of the merge that takes them in."""
        if token not in self.spines[side]:
            part, end, out = self.spelling[token], NEVER, []
            while True:
                out.append((part, end))
                if len(part) == 1:
                    break
                end = self.ranks[part]
                part = self.merges[part][side]
            self.spines[side][token] = out
        return self.spines[side][token]

    def _fits(self, pair: int) -> bool:
        """Whether two tokens stay apart: no pair of parts that meet at their border merges first."""
        ends, begins = self._spine(pair >> 32, 1), self._spine(pair & 0xFFFFFFFF, 0)
        i, j = len(ends) - 1, len(begins) - 1
        while True:
            (x, x_end), (y, y_end) = ends[i], begins[j]
            rank = self.ranks.get(x + y)
            # of equal ranks the pair further left merges first
            if rank is not None and rank < x_end and rank <= y_end:
                return False
            if i == j == 0:
                return True
            # the part that is merged into a larger one first gives way to it
            if j == 0 or (i > 0 and x_end <= y_end):
                i -= 1
            else:
                j -= 1

    def _shorter(self, node: int) -> int:
        """The longest live place beside ``node``: its string without one or more bytes at the front."""
        todo = []
        while node not in self.suffix:
            todo.append(node)
            node = self.above[node]
        for node in reversed(todo):
            above = self.above[node]
            self.suffix[node] = self._move(self.suffix[above] << 8 | self.last[node]) if above else 0
        return self.suffix[node]

    def _move(self, key: int) -> int:
        """State after one more byte: the deepest place in the trie that some way to go on has reached."""
        node, byte = key >> 8, key & 0xFF
        below = self.edges.get(key)
        while below is None and node:
            node = self._shorter(node)
            below = self.edges.get(node << 8 | byte)
        below = below or 0
        if below not in self.ends:
            chain = [below]
            while (at := self._shorter(chain[-1])) not in self.ends:
                chain.append(at)
            for at in reversed(chain):
                own, others = self.accepts[at], self.ends[self._shorter(at)]
                self.ends[at] = others if own < 0 else ((own, self.size[own]), *others)
                self._list(at)
        return below

    def _list(self, node: int) -> None:
        """Put the tokens that end at ``node`` into ``listed``."""
        ends = self.ends[node]
        while self.used + len(ends) > len(self.listed):
            self.listed = np.concatenate([self.listed, np.zeros_like(self.listed)])
        self.first[node] = self.used
        self.listed[self.used: self.used + len(ends)] = ends
        self.used += len(ends)

    def encode_many(self, data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of each): words lie in ``data`` between consecutive ``begins``.

        All words advance together, one byte per step, like ``encode`` does one.
        """
        lengths = np.diff(begins)
        order = np.argsort(-lengths, kind="stable")
        counts, parts = np.zeros(len(lengths), np.int64), []
        long = int(np.searchsorted(-lengths[order], -TOGETHER, "left"))
        for word in order[:long]:
            ids = self.encode(data[begins[word]: begins[word + 1]].tobytes())
            counts[word] = len(ids)
            parts.append((np.full(len(ids), word), np.arange(len(ids)), np.array(ids, np.int32)))
        for at in range(long, len(order), WORDS_AT_ONCE):
            words = order[at: at + WORDS_AT_ONCE]
            tokens = self._advance(data, begins[words], lengths[words])
            number, place, steps = np.arange(len(words)), lengths[words], []
            while len(number):
                number, place = number[place > 0], place[place > 0]
                token = tokens[number, place]
                steps.append((number, token))
                counts[words[number]] += 1
                place = place - self.sizes[token]
            for back, (number, token) in enumerate(steps):
                parts.append((words[number], counts[words[number]] - 1 - back, token))
        flat = np.zeros(int(counts.sum()), np.int32)
        starts = np.cumsum(counts) - counts
        for word, index, token in parts:
            flat[starts[word] + index] = token
        return flat, counts

    def _advance(self, data: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Last token of the ids of every word up to every place; words are in order of falling length."""
        tokens = np.full((len(lengths), int(lengths.max(initial=0)) + 1), -1, np.int32)
        node = np.zeros(len(lengths), np.int64)
        for place in range(1, tokens.shape[1]):
            alive = int(np.searchsorted(-lengths, -place, "right"))
            node = self.many_moves.lookup(node[:alive] << 8 | data[begins[:alive] + place - 1]).astype(np.int64)
            open_, at = np.arange(alive), self.first[node]
            while len(open_):
                token, length = self.listed[at].T
                left = tokens[open_, place - length].astype(np.int64)
                fits = left < 0
                inner = np.flatnonzero(~fits)
                fits[inner] = self.many_allowed.lookup(left[inner] << 32 | token[inner]) != 0
                tokens[open_[fits], place] = token[fits]
                open_, at = open_[~fits], at[~fits] + 1
        return tokens

    def _certain(self, node: int, tokens: list[int]) -> int:
        """The last place that every way to go on passes through."""
        live, at = {len(tokens) - 1}, node
        while at:
            depth, up = 0, at
            while up:
                depth, up = depth + 1, self.above[up]
            live.add(len(tokens) - 1 - depth)
            at = self._shorter(at)
        while len(live) > 1:
            latest = max(live)
            live.remove(latest)
            live.add(latest - self.size[tokens[latest]])
        return live.pop()

    def encode(self, word: bytes) -> list[int]:
        """Ids of one word.

        ``tokens`` holds, for each place since the last certain one, the last token of
        the ids of what has been read up to there; -1 stands for the front of the word.
        """
        out: list[int] = []
        tokens, node = [-1], 0
        moves, ends, allowed = self.moves, self.ends, self.allowed
        for start in range(0, len(word), LOOK_BACK):
            if start and (sure := self._certain(node, tokens)):
                out += self._path(tokens, sure)
                tokens = tokens[sure:]
            for byte in word[start: start + LOOK_BACK]:
                node = moves[node << 8 | byte]
                for token, length in ends[node]:
                    left = tokens[-length]
                    if left < 0 or allowed[left << 32 | token]:
                        break
                else:
                    raise ValueError(f"the merges spell no way to read {word!r}")
                tokens.append(token)
        return out + self._path(tokens, len(tokens) - 1)

    def _path(self, tokens: list[int], place: int) -> list[int]:
        """The tokens that lead from the front to ``place``."""
        out, size = [], self.size
        while place:
            token = tokens[place]
            out.append(token)
            place -= size[token]
        out.reverse()
        return out


class TextEncoder:
    """Ids of whole texts: the words of a slice's distinct chunks go through the transducer together."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.transducer, self.words = Transducer(ranks), regex.compile(pattern)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each begins and ends)."""
        data, bounds = utf8(texts)
        begins, first = space_chunks(data, bounds)
        codes, chunks = distinct_strings(data, begins)
        split = [self.words.findall(chunk) for chunk in chunks.to_pylist()]
        number: dict[str, int] = {}
        word = np.fromiter((number.setdefault(w, len(number)) for words in split for w in words), np.int64)
        ids, counts = self.transducer.encode_many(*utf8(pa.array(list(number), pa.string())))
        bounds = np.cumsum([0, *map(len, split)])
        ids, _ = gather(ids, counts, word)
        ids, ends = gather(ids, sums_between(counts[word], bounds), codes)
        return ids, np.concatenate(([0], ends))[first]


@lru_cache(maxsize=2)
def text_encoder(rank_file: str, pattern: str) -> TextEncoder:
    """One encoder for all tasks of a worker."""
    return TextEncoder(read_ranks(rank_file), pattern)


def _utf8_machine() -> np.ndarray:
    """state x byte: next state; 0 between characters, 1 to 3 bytes due, 4 to 7 after E0, ED, F0 and F4."""
    starts = {**{b: 1 for b in range(0xC2, 0xE0)}, **{b: 2 for b in range(0xE1, 0xF0)}, **{b: 3 for b in range(0xF1, 0xF4)},
              0xE0: 4, 0xED: 5, 0xF0: 6, 0xF4: 7}
    due = {1: (0x80, 0xC0, 0), 2: (0x80, 0xC0, 1), 3: (0x80, 0xC0, 2), 4: (0xA0, 0xC0, 1), 5: (0x80, 0xA0, 1),
           6: (0x90, 0xC0, 2), 7: (0x80, 0x90, 2)}
    # a byte that does not go on with a character starts anew
    table = np.tile(np.array([starts.get(b, 0) for b in range(256)], np.uint8), (8, 1))
    for state, (low, high, after) in due.items():
        table[state, low:high] = after
    return table


_MACHINE = _utf8_machine().tolist()


class StreamDecoder:
    """Bytes of ids as they come in, only whole characters; ``flush`` gives what an unfinished one left."""

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens, self.held = tokens, b""

    def push(self, ids: Iterable[int]) -> bytes:
        tokens = self.tokens
        data = self.held + b"".join([tokens[i] for i in ids])
        # a character has four bytes at most, so an unfinished one began in the last three
        state, cut = 0, len(data)
        for at in range(max(0, len(data) - 3), len(data)):
            before, state = state, _MACHINE[state][data[at]]
            if state and (before == 0 or data[at] >= 0xC0):
                cut = at
        if not state:
            cut = len(data)
        self.held = data[cut:]
        return data[:cut]

    def flush(self) -> bytes:
        out, self.held = self.held, b""
        return out


def encode_texts(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of every whole text.

    Null and empty texts have no ids; a null id stays null, repeated rows are encoded
    each, an empty table gives no rows; other columns take no part. No shuffle. A task
    holds a slice of text, or one longer text, and a cache of bounded size.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(rank_file, pattern)
        for part, texts in slices(batches):
            ids, bounds = encoder.encode(texts)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], names=["doc_id", "ids"])

    return id_and_text(docs).mapInArrow(encode, "doc_id long, ids array<int>")


def digest_ids(encoded: DataFrame, rank_file: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by one space) and decoded_sha256 (bytes that the ids decode to)."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in read_ranks(rank_file).items()}
        for batch in batches:
            hashes = []
            for ids in batch.column("ids"):
                ids = ids.values.to_numpy().tolist()
                decoder, text = StreamDecoder(tokens), hashlib.sha256()
                for at in range(0, len(ids), DECODE_BLOCK):
                    text.update(decoder.push(ids[at: at + DECODE_BLOCK]))
                text.update(decoder.flush())
                hashes.append((len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), text.hexdigest()))
            columns = [pa.array([h[k] for h in hashes], kind) for k, kind in enumerate((pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.mapInArrow(digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
