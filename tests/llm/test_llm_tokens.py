"""Byte-level BPE, cross-tokenizer alignment and the manifest against libraries and brute force."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict
from itertools import accumulate

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from feedmill.llm import alignment, byte_bpe, manifest
from feedmill.llm.queries import SQL, op11, op12, op13, tokenizer_file
from oracle import compare, connect
from feedmill.queries.tables import Query

SF = "/root/testdata/sf0.001"
RANKS = tokenizer_file("byte_bpe_50k.tiktoken")
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names the operators use inside
    T.StructField("digest", T.StringType()), T.StructField("ids", T.StringType()), T.StructField("lo", T.LongType()),
    T.StructField("slice", T.LongType()), T.StructField("row", T.IntegerType()), T.StructField("pair", T.StringType()),
])


@pytest.fixture(scope="module")
def odd_rows():
    long = " ".join(f"w{i % 977}é" for i in range(200_000))  # over a megabyte
    rows = [
        (1, "It's a\nline, isn't it?", "en", "s1", 20), (2, None, None, None, None), (3, "", "en", "", 0), (4, " \t\n ", "en", "s1", 4),
        (5, "no new line", None, "s1", 11), (6, long, "de", "s2", len(long)), (7, "a  b   c \u00a0 d\n\n\ne ", "fr", "s2", 1),
        (8, "\u4e2d\u6587" * 40 + "\U0001f600\u2581x <|endoftext|> <s>", "zh", "s2", 3), (9, "=" * 300 + "ab" * 500, "en", "s3", 9),
        (10, "one\nid", "en", "s1", 5), (10, "other\ntext", "en", "s1", 5), (None, "no\nid", "en", "s1", 4), (None, "no id", "en", "é", 4),
        (11, "twice\nthe same", "es", "z", 2), (11, "twice\nthe same", "es", "z", 2), (12, "x", "en", "only", 1), (13, "tail \n", "en", None, 6),
    ]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 5, 6, 7, "z") for r in rows], DOCS)


@pytest.fixture(scope="module")
def encoder():
    import public_tokenizers

    return byte_bpe.text_encoder(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("aeh tin's.10\n\t\u00a0\x1cé\u4e2d"), st.characters(max_codepoint=0xFFFF, exclude_categories=["Cs", "Cn"]))), max_size=4))
def test_encoding_equals_the_library(encoder, library, texts):
    ids, bounds = encoder.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [library.encode_ordinary(t) for t in texts]


def test_one_word_equals_many_and_is_emitted_early(encoder, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "LOOK_BACK", 3)
    for word in ("a" * 700, "ha" * 500, "internationalisation" * 20, "=" * 333, "\u4e2d\u6587" * 99):
        assert encoder.transducer.encode(word.encode()) == library.encode_ordinary(word)


def test_stream_decoder_cuts_between_characters(library):
    text = "é\u4e2d\U0001f600a" * 5
    tokens = {i: t for t, i in byte_bpe.read_ranks(RANKS).items()}
    ids = [library.encode_single_token(bytes([b])) for b in text.encode()]
    for width in (1, 2, 3, 5):
        decoder, out = byte_bpe.StreamDecoder(tokens), []
        for at in range(0, len(ids), width):
            out.append(decoder.push(ids[at: at + width]).decode())
        assert "".join(out) == text and decoder.flush() == b""
    decoder = byte_bpe.StreamDecoder(tokens)
    byte = {b: library.encode_single_token(bytes([b])) for b in range(256)}
    # a lead byte cut off by another, a stray byte, one left over at the end
    broken = b"\xe4\xb8\xe4\xb8\xad\x80a\xf0\x9f"
    assert b"".join(decoder.push([byte[b]]) for b in broken) + decoder.flush() == broken


def test_bpe_query(spark, odd_rows, library, tmp_path):
    frame(spark, odd_rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op12(spark, str(tmp_path)).collect()), key=repr)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for r in odd_rows:
        ids = library.encode_ordinary(r[1] or "")
        want.append((r[0], len(ids), sha(" ".join(map(str, ids)).encode()), sha((r[1] or "").encode())))
    assert got == sorted(want, key=repr)
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op12(spark, f"{tmp_path}/none").collect() == []


def sha_of(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    by_source = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        head = [field(v) for v in (doc_id, source, lang, n_chars)]
        leaf = tampered = sha_of(*head, field(text))
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
            tampered = sha_of(*head, field(text.replace("\n", "")))
        by_source[source].append((doc_id is not None, doc_id or 0, leaf, tampered))

    def tree(level):
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append([sha_of(*levels[-1][i: i + 3]) for i in range(0, len(levels[-1]), 3)])
        return levels

    def steps(levels, at):
        out = []
        for level in levels[:-1]:
            first = at // 3 * 3
            out.append((level[first:at], level[at + 1: first + 3]))
            at //= 3
        return out

    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by_source[s])]) for s in order}
    trunk = tree([trees[s][-1][0] for s in order])
    out = []
    for k, source in enumerate(order):
        for at, (known, doc_id, leaf, acc) in enumerate(sorted(by_source[source])):
            path = steps(trees[source], at) + steps(trunk, k)
            for left, right in path:
                acc = sha_of(*left, acc, *right)
            proof = sha_of(*[d for left, right in path for d in left + right])
            out.append((doc_id if known else None, leaf, trees[source][-1][0], trunk[-1][0], proof, acc, acc == trunk[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("band", [1, 6])
def test_manifest(spark, odd_rows, monkeypatch, band):
    monkeypatch.setattr(manifest, "BAND", band)
    got = manifest.manifest(frame(spark, odd_rows))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_manifest(odd_rows)


def test_manifest_of_little(spark, odd_rows):
    assert manifest.manifest(frame(spark, [])).collect() == []
    for few in (odd_rows[:1], odd_rows[11:13], odd_rows[13:15]):
        assert sorted(map(tuple, manifest.manifest(frame(spark, few)).collect()), key=repr) == brute_manifest(few)


def test_manifest_equals_sql(spark):
    assert compare(spark, connect(SF), Query(op13, SQL["op13_merkle_manifest"]), SF) == ("", 200)


def brute_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    byte_of = {chr(b) if b in printable else chr(next(others)): b for b in range(256)}

    def groups_of(ids, spelled, shared):
        out = [[]]
        for i, end in zip(ids, accumulate(map(len, spelled))):
            out[-1].append(i)
            if end in shared:
                out.append([])
        return out[:-1]

    docs, count, best = [], Counter(), Counter()
    for doc_id, text in rows:
        found = None
        if text:
            a, b = one.encode(" " + text, add_special_tokens=False), two.encode(text)
            a_bytes = [bytes(byte_of[c] for c in t) for t in a.tokens]
            b_bytes = [bytes([int(p[3:5], 16)]) if two.is_byte(i) else p.replace("\u2581", " ").encode() for i, p in zip(b, two.id_to_piece(b))]
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                shared = set(accumulate(map(len, a_bytes))) & set(accumulate(map(len, b_bytes)))
                groups = list(zip(groups_of(a.ids, a_bytes, shared), groups_of(b, b_bytes, shared)))
                links = Counter((x, y) for left, right in groups for x in left for y in right)
                count.update(links.keys())
                found = len(a.ids), len(b), groups, links
        docs.append((doc_id, found))
    for (x, _), c in count.items():
        best[x] = max(best[x], c)
    out = []
    for doc_id, found in docs:
        if found is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = found
        text = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in groups)
        out.append((doc_id, n_a, n_b, len(groups), sum(links.values()), sum(n for k, n in links.items() if count[k] == best[k[0]]),
                    sum(n * count[k] for k, n in links.items()), sha_of(text)))
    return sorted(out, key=repr)


def test_alignment(spark, odd_rows, tmp_path):
    frame(spark, odd_rows).write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(map(tuple, op11(spark, str(tmp_path)).collect()), key=repr) == brute_alignment([r[:2] for r in odd_rows])
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op11(spark, f"{tmp_path}/none").collect() == []


def test_alignment_over_many_slices(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(7)
    files = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    got = alignment.align_tokenizers(docs, *files)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_alignment([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


@settings(max_examples=200, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aeh tin's.10\n\t\r\u00a0\u2581\u3000é\u4e2d"), st.characters(max_codepoint=0xFFFF, exclude_categories=["Cs"]))))
def test_chunks_are_encoded_like_whole_texts(text):
    aligner = alignment.Aligner(
        alignment.tokenizer(alignment.ByteTokens, tokenizer_file("byte_bpe_50k.json")),
        alignment.tokenizer(alignment.PieceTokens, tokenizer_file("piece_bpe_32k.model")),
    )
    got = aligner.slice(pa.array([" " + text if text else ""]))
    want = brute_alignment([(0, text)])[0]
    assert (got["n_a"][0], got["n_b"][0], got["n_groups"][0], got["n_links"][0], got["groups_sha256"][0]) == (*want[1:5], want[7])
