"""Operators on texts against brute force, exact round trips and held-out accuracy."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
import xxhash
from pyspark.sql import types as T

from feedmill.llm import (
    exact_dedup, language, mixing, packing, quality, simhash, suffix_dedup, token_counts,
)
from feedmill.llm.queries import tokenizer_file

SF = "/root/testdata/sf0.001"
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    # names the operators use inside
    T.StructField("score", T.StringType()), T.StructField("row", T.IntegerType()),
    T.StructField("fingerprint", T.DoubleType()), T.StructField("norm", T.StringType()),
])
SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["x", 1, 0.5, "y"][: 8 - len(r)]) if len(r) == 4 else r for r in rows], DOCS)


@pytest.fixture(scope="module")
def odd_rows():
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    passage = "this very passage is shared by many documents and is certainly longer than one hundred bytes in all, é"
    rows = [
        (1, "a b c d e f", "en", "s1"), (2, None, None, None), (3, "", "en", ""), (4, " \t\n ", "en", "s1"),
        (5, "a  b c\td e f", "en", "s1"), (6, long, "de", "s2"), (7, long, "de", "s2"), (8, "ÉTÉ été\x0b1 x\x0cy", "fr", "s2"),
        (9, f"before {passage} after", "en", "s1"), (10, f"other {passage} end", "en", "s1"),
        (10, f"third {passage}!", "en", "s1"), (11, "ab" * 300, "en", "s3"), (12, "12 34 %%", "en", "s3"),
        (None, "no id here at all", "en", "s3"), (None, "no id here at all", "en", "s3"),
        (13, "twice the same row", "es", "s3"), (13, "twice the same row", "es", "s3"), (14, "<|endoftext|> It's. A b\x1cc", "en", "s1"),
    ]
    return rows


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    return frame(spark, odd_rows)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def greedy(word, initial, middle, mark):
    """Pieces of the longest match, cut off one by one."""
    rest, left, count = mark + word, initial, 0
    while rest:
        for n in range(len(rest), 0, -1):
            if rest[:n] in left:
                break
        else:
            return 1
        rest, left, count = rest[n:], middle, count + 1
    return count


def test_automaton_equals_longest_match():
    rng = np.random.default_rng(1)
    for _ in range(30):
        pieces = {bytes(rng.integers(97, 100, rng.integers(1, 6)).astype(np.uint8)) for _ in range(12)}
        initial, middle = set(list(pieces)[:7]), set(list(pieces)[4:])
        machine = token_counts.build_automaton(initial, middle)
        words = [bytes(rng.integers(97, 100, rng.integers(0, 12)).astype(np.uint8)) for _ in range(200)]
        ends = np.cumsum([0, *map(len, words)])
        got = machine.piece_counts(np.frombuffer(b"".join(words), np.uint8), ends)
        assert got.tolist() == [greedy(w, initial, middle, b"") if w else 0 for w in words]


def test_token_counts(spark, odd, odd_rows, empty):
    model = token_counts.sentencepiece_automaton(tokenizer_file("piece_bpe_32k.model"))
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    initial, middle = set(), {bytes([b]) for b in range(256)}
    for i in range(sp.get_piece_size()):
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)):
            piece = sp.id_to_piece(i)
            (initial if piece.startswith("▁") else middle).add(piece.encode())
    pieces = {}

    def tokens(text):
        words = WORD.findall(text or "")
        for w in set(words) - pieces.keys():
            pieces[w] = greedy(w.encode(), initial, middle, "▁".encode())
        return len(words), sum(pieces[w] for w in words)

    got = token_counts.count_tokens(odd, model).collect()
    want = Counter((r[0], *tokens(r[1])) for r in odd_rows)
    assert Counter(map(tuple, got)) == want
    assert token_counts.count_tokens(empty, model).count() == 0


def brute_removal(rows, depth):
    """Rows in order of id and place; the first start of every string stays."""
    seen, out = set(), []
    for text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - depth + 1):
            string = raw[at: at + depth]
            if string in seen:
                gone[at: at + depth] = b"\1" * depth
            seen.add(string)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_dedup(spark, docs, odd, odd_rows, empty):
    rows = sorted(docs.select("doc_id", "text").collect())
    got = {r[0]: tuple(r[1:]) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert [got[r[0]] for r in rows] == brute_removal([r[1] for r in rows], 100)
    # one row of each repeated pair of id and text, so that the order is plain
    unique = [r for i, r in enumerate(odd_rows) if r[0] is not None and r[0] != 10 and r not in odd_rows[:i]]
    found = {r[0]: tuple(r[1:]) for r in suffix_dedup.remove_repeats(frame(spark, unique)).collect()}
    assert [found[r[0]] for r in unique] == brute_removal([r[1] for r in unique], 100)
    everything = suffix_dedup.remove_repeats(odd).collect()
    assert len(everything) == len(odd_rows)
    # rows that repeat id and text are one document
    assert len({tuple(r) for r in everything if r[0] == 13}) == 1
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_suffix_dedup_random_strings(spark):
    rng = np.random.default_rng(4)
    base = bytes(rng.integers(97, 101, 4000).astype(np.uint8)).decode()
    rows = []
    for i in range(40):
        cuts = [base[a: a + n] for a, n in zip(rng.integers(0, 3800, 6), rng.integers(20, 260, 6))]
        rows.append((i, "".join(cuts), "en", "s"))
    rows.append((40, "xyz" * 200, "en", "s"))
    got = {r[0]: tuple(r[1:]) for r in suffix_dedup.remove_repeats(frame(spark, rows)).collect()}
    assert [got[i] for i in range(41)] == brute_removal([r[1] for r in rows], 100)


def brute_print(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i: i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows, radius=4):
    """Smallest id reachable, by comparing all pairs."""
    prints = [p for _, p in rows]
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                label[top(i)] = top(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[top(i)].append(i)
    out = [None] * len(rows)
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            out[i] = min(ids) if ids else None
    return out


def test_simhash(spark, docs, odd, odd_rows, empty):
    for table, rows in ((docs, docs.select("doc_id", "text").collect()), (odd, odd_rows)):
        prints = [(r[0], brute_print(r[1])) for r in rows]
        want = Counter((i, f"{p:016x}", c) for (i, p), c in zip(prints, components(prints)))
        assert Counter(map(tuple, simhash.simhash_components(table).collect())) == want
    assert simhash.simhash_components(empty).count() == 0
    kept = simhash.keep_one(docs)
    prints = [(r[0], brute_print(r[1])) for r in docs.select("doc_id", "text").collect()]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(components(prints)))
    assert kept.columns == docs.columns


def test_simhash_keeps_one_row_of_each_component(spark):
    words = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcd"]
    rows = [(None, words[0], 0), (None, words[0], 1), (None, words[1], 2), (5, words[2], 3), (5, words[3], 4), (6, words[3], 5),
            (None, words[2], 6), (None, None, 7), (7, "", 8)]
    table = spark.createDataFrame(rows, "doc_id long, text string, `keep_id` long").selectExpr(
        "*", "keep_id AS fingerprint", "keep_id AS component_id", "keep_id AS `odd name:<1>`", "keep_id AS row")
    kept = simhash.keep_one(table)
    assert kept.columns == table.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(
        [(None, words[0]), (None, words[1]), (5, words[2]), (5, words[3]), (7, "")])
    assert simhash.keep_one(table.limit(0)).count() == 0
    labels = spark.createDataFrame([(5, 1), (7, 0)], "doc_id long, quality int")
    assert quality.keep_good(table, labels).columns == table.columns
    assert exact_dedup.keep_first(table).columns == table.columns


@pytest.mark.parametrize("group_rows", [simhash.GROUP_ROWS, 16])
def test_links_of_crowded_fingerprints(spark, monkeypatch, group_rows):
    monkeypatch.setattr(simhash, "GROUP_ROWS", group_rows)
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    prints = set()
    for c in centres.tolist():
        for _ in range(40):
            flips = rng.choice(64, rng.integers(0, 6), replace=False)
            prints.add(c ^ sum(1 << int(b) for b in flips))
    prints = sorted(prints)
    want = components([(i, p) for i, p in enumerate(prints)])
    table = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fingerprint long")
    edges = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.near_links(table).collect()]
    label = {p: p for p in prints}

    def top(p):
        while label[p] != p:
            p = label[p]
        return p

    for a, b in edges:
        assert (a in label) and (b in label)
        label[max(top(a), top(b))] = min(top(a), top(b))
    assert [prints.index(top(p)) for p in prints] == want


def test_exact_duplicates(spark, docs, odd, odd_rows, empty):
    for table, rows in ((docs, docs.select("doc_id", "text").collect()), (odd, odd_rows)):
        groups = defaultdict(list)
        for r in rows:
            groups[SPACE.sub(" ", r[1] or "")].append(r[0])
        got = exact_dedup.exact_duplicates(table).collect()
        assert len(got) == len(rows)
        kept = Counter(r["text_sha256"] for r in got if r["kept"])
        for text, ids in groups.items():
            sha = hashlib.sha256(text.encode()).hexdigest()
            mine = [r for r in got if r["text_sha256"] == sha]
            first = min((i for i in ids if i is not None), default=None)
            assert sorted(map(repr, (r["doc_id"] for r in mine))) == sorted(map(repr, ids))
            assert {(r["keep_id"], r["group_size"]) for r in mine} == {(first, len(ids))}
            assert kept[sha] == 1 and all(r["doc_id"] == first for r in mine if r["kept"])
        first = exact_dedup.keep_first(table)
        assert first.columns == table.columns
        assert first.count() == len(groups)
    assert exact_dedup.exact_duplicates(empty).count() == 0


def test_filters_merge_losslessly(monkeypatch, spark):
    monkeypatch.setattr(exact_dedup, "FILTER_ROWS", 50)
    rng = np.random.default_rng(0)
    prints = rng.integers(-(1 << 63), (1 << 63) - 1, 400).tolist()
    prints += prints[:100] + prints[:10] * 5 + [0, 0, -1, -1]
    table = spark.createDataFrame([(p,) for p in prints], "fingerprint long").repartition(5)
    got = [r[0] for r in exact_dedup.repeated_fingerprints(table).collect()]
    assert sorted(got) == sorted(p for p, n in Counter(prints).items() if n > 1)


@pytest.mark.parametrize("width", [60, 12])
@pytest.mark.parametrize("number", [1, 2, 3, 400, 3000])
def test_filter_round_trip(width, number):
    rng = np.random.default_rng(number)
    prints = np.unique(np.append(rng.integers(0, 1 << width, number, dtype=np.uint64), [np.uint64(0), np.uint64((1 << width) - 1)]))
    counts = np.where(rng.random(len(prints)) < 0.8, 1, rng.integers(1, 1 << 40, len(prints)))
    got = exact_dedup.read_filter(*exact_dedup.write_filter(prints, counts, width), width)
    assert (got[0] == prints).all() and (got[1] == counts).all()


def test_filter_is_smaller_than_its_fingerprints():
    rng = np.random.default_rng(1)
    for number in (1000, 1 << 15, (1 << 16) - 1):
        prints = np.unique(rng.integers(0, 1 << 60, number, dtype=np.uint64))
        counts = np.where(rng.random(len(prints)) < 0.05, 1000, 1)
        size = sum(map(len, exact_dedup.write_filter(prints, counts, 60)[2:]))
        assert size < 0.95 * 8 * len(prints)


def test_mix(spark, docs, odd, odd_rows, empty):
    for table in (docs, odd):
        got = mixing.mix(table).collect()
        rows = table.select("doc_id", "source", "text").collect()
        sizes = Counter((r[0], r[1], len(WORD.findall(r[2] or ""))) for r in rows)
        assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == sizes
        by_source, total = defaultdict(list), sum(n * k[2] for k, n in sizes.items())
        for r in got:
            by_source[r["source"]].append(r)
            assert r["taken"] == r["copies"] * r["size"] and r["copies"] <= 3
        assert sum(r["taken"] for r in got) <= total
        names = sorted((s for s in by_source if s is not None)) + ([None] if None in by_source else [])
        weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
        size = {s: sum(r["size"] for r in by_source[s]) for s in names}
        open_, target, left = set(names), {}, total
        while True:
            share = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
            over = [s for s in open_ if share[s] >= 3 * size[s]]
            if not over or left == 0:
                target |= share
                break
            for s in over:
                target[s] = 3 * size[s]
                left -= 3 * size[s]
                open_.remove(s)
            if not open_:
                break
        largest = max(k[2] for k in sizes)
        for s in names:
            assert {r["source_size"] for r in by_source[s]} == {size[s]}
            assert by_source[s][0]["target"] == pytest.approx(target[s])
            assert abs(sum(r["taken"] for r in by_source[s]) - target[s]) <= 2 * largest
        taken = mixing.take(table)
        assert taken.columns == table.columns
        assert taken.count() == sum(r["copies"] for r in got)
        assert sorted(map(repr, got)) == sorted(map(repr, mixing.mix(table.repartition(3)).collect()))
    assert mixing.mix(empty).count() == 0


def test_targets_stop_at_three_times_the_size(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1), (None, 500)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    assert got["a"] == 30 and got["c"] == 3
    # b and the last (weights 2 and 5) share what is left
    assert got["b"] == pytest.approx((1511 - 33) * 2 / 7) and got[None] == pytest.approx((1511 - 33) * 5 / 7)


def test_language(spark, odd, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    got = language.identify_languages(docs).collect()
    assert len(got) == len(lang)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.97
    odd_got = language.identify_languages(odd).collect()
    assert {r["doc_id"] for r in odd_got if r["lang_pred"] == "und"} == {2, 3, 4, 12}
    assert language.identify_languages(empty).count() == 0


def test_language_kernel_is_shared_gram_presence():
    texts = ["abc abd", "xyz", "abcd", "zzzz zzzz"]
    model = language.train(texts, ["a", "b", "a", "b"])
    data, bounds = language.utf8(pa.array(texts))
    flags = model.presence(model.tables(), data, bounds)
    grams = [{t.encode()[i: i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)} for t in texts]
    want = [[len(a & b) / (len(a) * len(b)) ** 0.5 for b in grams] for a in grams]
    assert np.allclose(model.kernel(flags), want)


def test_quality(spark, odd, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    mark = {r["doc_id"]: r["quality"] for r in labels.collect()}
    got = quality.score_quality(docs, labels).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [r for r in got if r["held_out"] and r["doc_id"] in mark]
    assert sum(r["predicted"] == mark[r["doc_id"]] for r in held) / len(held) > 0.95
    scored = quality.score_quality(odd, labels)
    assert scored.count() == odd.count() and all(0 <= r["score"] <= 1 for r in scored.collect())
    assert quality.score_quality(empty, labels).count() == 0
    assert {r["score"] for r in quality.score_quality(odd, labels.limit(0)).collect()} == {0.5}
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] for r in got)


def test_pieces_of_words_are_marked_without_a_pattern():
    rng = random.Random(11)
    letters = [chr(c) for c in [*range(33, 127), *range(161, 173), *range(174, 256)] if chr(c) != "'"]
    words = pa.array(["".join(rng.choices(letters, k=rng.randrange(1, 9))) for _ in range(3000)] + ["1a22!!b", "\u00b2\u00bd", "\u00e9\u00d7\u00aa"])
    tokenizer = packing.WordTokenizer(tokenizer_file("word_bpe_49k.json"))
    assert tokenizer._marked(words, True) == tokenizer._marked(words, False)


def test_documents_that_hold_a_token_are_counted_once():
    rng = random.Random(12)
    for largest in (6, 60, 70000):
        documents = [[rng.randrange(largest) for _ in range(rng.randrange(40))] for _ in range(30)]
        bounds = np.concatenate(([0], np.cumsum([len(d) for d in documents])))
        tokens, counts = packing.documents_holding(np.array(sum(documents, []), np.uint32), bounds)
        assert dict(zip(tokens.tolist(), counts.tolist())) == Counter(t for d in documents for t in set(d))


def test_word_tokenizer_round_trip(odd_rows):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    reference = Tokenizer.from_file(path)
    texts = [r[1] or "" for r in odd_rows] + [
        "It's 's x's. I'LL", "a\x01b \0 c", "É́ É, KK ÀÉ.É,", "İstanbul. ΣΑΣ, <|startoftext|>Q.", "a.'s b,'t c!?'ve ¿qué? «x» ²½",
        "ﬁne ǅ ß ẞ 中文 字 😀😀 ª º µ", "a​b ﻿c ́x",
    ]
    ids, bounds = packing.WordTokenizer(path).encode(pa.array(texts))
    for text, a, b in zip(texts, bounds[:-1], bounds[1:]):
        assert ids[a:b].tolist() == reference.encode(text, add_special_tokens=False).ids


def test_pack(spark, docs, odd, odd_rows, empty, monkeypatch):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    reference = Tokenizer.from_file(path)
    for table, shard_bytes in ((docs, packing.SHARD_BYTES), (docs, 1 << 17), (odd, 1 << 16)):
        monkeypatch.setattr(packing, "SHARD_BYTES", shard_bytes)
        pieces = packing.pack(table, path).collect()
        sequences, by_doc = defaultdict(list), defaultdict(list)
        for p in pieces:
            sequences[p["sequence_id"]].append((p["offset"], p["length"]))
            by_doc[p["doc_id"]].append(p)
        for parts in sequences.values():
            parts.sort()
            ends = np.cumsum([n for _, n in parts])
            assert [at for at, _ in parts] == [0, *ends[:-1]]
            assert ends[-1] <= 4096 and int(ends[-1]).bit_count() == 1
        texts = defaultdict(list)
        for r in table.select("doc_id", "text").collect():
            texts[r[0]].append(r[1] or "")
        assert texts.keys() == by_doc.keys()
        for doc, own in texts.items():
            if len(own) == 1:
                ids = np.array(reference.encode(own[0], add_special_tokens=False).ids + [2], "<u4")
                parts = sorted(by_doc[doc], key=lambda p: p["start"])
                assert [p["start"] for p in parts] == [0, *np.cumsum([p["length"] for p in parts])[:-1]]
                assert {p["doc_tokens"] for p in parts} == {len(ids)} and sum(p["length"] for p in parts) == len(ids)
                for p in parts:
                    assert p["ids_crc32"] == zlib.crc32(ids[p["start"]: p["start"] + p["length"]].tobytes())
    assert packing.pack(empty, path).count() == 0


def test_packing_follows_related_documents():
    rng = np.random.default_rng(3)
    # ten topics with tokens of their own, shuffled: neighbours in the order share a topic
    topics = rng.permutation(np.repeat(np.arange(10), 12))
    parts = [rng.integers(100 * t, 100 * t + 60, 200) for t in topics]
    bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    order = list(packing.reading_order(np.concatenate(parts), bounds, 2400))
    assert sorted(order) == list(range(120))
    assert sum(topics[a] == topics[b] for a, b in zip(order, order[1:])) > 90


def test_packing_deals_related_documents_to_one_shard(spark, monkeypatch):
    rng = np.random.default_rng(4)
    words = [a + b for a in ("ba", "ko", "mi", "ru", "te", "so", "la", "ne", "fu", "di") for b in ("rak", "lin", "mot", "sup", "ved", "gor", "hal", "nix", "pum", "zet")]
    own = rng.permutation(words)[:96].reshape(8, 12)
    common = [w for w in words if w not in set(own.ravel().tolist())] + ["the", "and", "of", "to", "in", "is", "it"]
    topics = rng.integers(0, 8, 400)
    rows = [(i, " ".join(rng.permutation([*rng.choice(own[t], 20), *rng.choice(common, 10)]))) for i, t in enumerate(topics.tolist())]
    monkeypatch.setattr(packing, "SHARD_BYTES", sum(len(x) for _, x in rows) // 8)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    shards = defaultdict(set)
    for p in packing.pack(table, tokenizer_file("word_bpe_49k.json")).collect():
        shards[p["sequence_id"] >> 32].add(p["doc_id"])
    assert len(shards) >= 8 and sum(map(len, shards.values())) == 400
    same = sum(max(np.bincount(topics[list(d)])) for d in shards.values())
    # dealt by chance, a shard holds each topic about equally often
    assert same > 240


def test_packing_weighs_tokens_by_all_documents(spark):
    ids, bounds = np.array([0, 1, 0, 2, 1, 2]), np.array([0, 2, 4, 6])
    idf = packing.inverse_frequency(1000, np.array([1.0, 500.0, 900.0]))
    score = packing.ShardIndex(ids, bounds, idf, 2.0).scores(np.array([0, 1]))
    assert score[1] > 2 * score[2] > 0
    rows = [(i, "alpha beta" if i % 2 else "alpha gamma delta") for i in range(10)]
    encoded = [(i, i, 2, np.array([5, 6] if i % 2 else [5, 7, 7], "<u2").tobytes()) for i, _ in rows]
    table = spark.createDataFrame(encoded, "code long, doc_id long, width int, ids binary").repartition(3)
    number, tokens, found = packing.corpus_statistics(table)
    assert (number, tokens) == (10, 35)
    assert np.allclose(found[[5, 6, 7]], packing.inverse_frequency(10, np.array([10, 5, 5])))


def test_hot_anchors_meet_in_no_bucket(spark, monkeypatch):
    rng = np.random.default_rng(12)
    phrase = bytes(rng.integers(97, 123, 130)).decode()
    rows = [(i, bytes(rng.integers(97, 123, 150)).decode() + phrase + bytes(rng.integers(97, 123, 90)).decode()) for i in range(300)]
    rows += [(i, rows[i - 300][1]) for i in range(300, 320)] + [(5, rows[5][1]), (400, phrase * 6), (None, phrase)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    plain = sorted(suffix_dedup.remove_repeats(table).collect(), key=str)
    monkeypatch.setattr(suffix_dedup, "HOT", 100)
    monkeypatch.setattr(suffix_dedup, "COUNTED", 1)
    texts = suffix_dedup._keyed(table)
    hot = suffix_dedup.hot_anchors(texts, suffix_dedup.DEPTH)
    assert len(hot)
    largest = 0
    for r in suffix_dedup._anchor_buckets(texts, 1, suffix_dedup.DEPTH, hot).groupBy("bucket").agg(F.collect_list("anchor").alias("a")).collect():
        largest = max(largest, np.unique(np.frombuffer(b"".join(map(bytes, r["a"])), "<u4"), return_counts=True)[1].max())
    assert largest < 100
    assert sorted(suffix_dedup.remove_repeats(table).collect(), key=str) == plain
    assert sum(r["n_removed"] for r in plain) > 300 * 100


def test_all_tokens_of_a_seed_are_scored():
    # the seed shares 40 rare tokens with one document each, and 30 more common ones with the last
    seed = np.arange(70)
    parts = [seed, np.arange(40), *[np.arange(40, 70)] * 3]
    bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    score = packing.ShardIndex(np.concatenate(parts), bounds).scores(seed)
    assert (score > 0).all()


def test_windows_around_anchors_of_equal_hash_are_told_apart():
    rng = np.random.default_rng(2)
    reach = suffix_dedup.DEPTH - suffix_dedup.GRAM
    around = np.tile(rng.integers(97, 123, 2 * suffix_dedup.DEPTH - suffix_dedup.GRAM, dtype=np.uint8), (3, 1))
    around[1, reach + 5] ^= 1
    entry = {"doc": np.array([1, 2, 3]), "hash": np.array([7, 7, 7]), "pos": np.full(3, reach), "anchor": np.full(3, 5),
             "left": np.full(3, reach, np.uint8), "right": np.full(3, suffix_dedup.DEPTH, np.uint8)}
    rows, start, stop = suffix_dedup.repeated_windows(around, entry)
    # only the third is like the first; the second's windows hold another gram
    assert (rows.tolist(), start.tolist(), stop.tolist()) == ([2], [0], [2 * suffix_dedup.DEPTH - suffix_dedup.GRAM])


def test_packing_order_is_that_of_full_scoring():
    rng = np.random.default_rng(4)
    sizes = rng.integers(1, 90, 400)
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    ids = np.minimum(rng.zipf(1.3, bounds[-1]), 3000).astype(np.int64)
    number, docs = len(sizes), [Counter(ids[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:])]
    held = Counter(t for d in docs for t in d)
    index = packing.ShardIndex(ids, bounds)
    assert (index.row >= 0).any() and (index.row < 0).any()
    for seed in range(0, 400, 37):
        want = np.zeros(number)
        for doc, counts in enumerate(docs):
            for token in set(docs[seed]) & set(counts):
                if held[token] > 1:
                    idf = np.log1p((number - held[token] + 0.5) / (held[token] + 0.5))
                    norm = packing.K1 * (1 - packing.B + packing.B * sizes[doc] / sizes.mean())
                    weight = idf * counts[token] * (packing.K1 + 1) / (counts[token] + norm)
                    want[doc] += np.rint(weight * packing.STEPS)
        assert (index.scores(ids[bounds[seed]: bounds[seed + 1]]) == want).all()
        order = [d for d in np.argsort(-want, kind="stable") if want[d] > 0]
        assert list(packing.best_first(want)) == order
