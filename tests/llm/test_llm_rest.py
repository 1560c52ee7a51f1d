"""Nearest neighbours, url rules, components, the pipeline and the registered queries."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

import corpus_pipeline
from feedmill.llm import ann, exact_dedup, language, mixing, packing, quality, simhash, url_rules
from feedmill.llm.queries import QUERIES, SQL, URL_RULES, tokenizer_file
from feedmill.operators.components import connected_components
from feedmill.queries.tables import Query
from oracle import compare, connect

SF = "/root/testdata/sf0.001"


def exact_neighbours(rows, most=20, every=20):
    width = max((len(v) for _, v in rows), default=0)
    ids = np.array([i for i, _ in rows])
    matrix = np.array([list(v) + [0.0] * (width - len(v)) for _, v in rows]).astype(np.float32).astype(np.float64)
    out = {}
    for at in np.flatnonzero(ids % every == 0):
        score = matrix @ matrix[at]
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[at]][:most]
        out[int(ids[at])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def test_nearest_neighbours_recall(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    want = exact_neighbours([(r[0], r[1]) for r in table.select("vec_id", "embedding").collect()])
    got = ann.nearest_by_inner_product(table).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert found.keys() == want.keys()
    assert all(len(v) == 20 and v == sorted(v, key=lambda x: (-x[1], x[0])) for v in found.values())
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9


def test_probes_are_measured_with_queries(spark):
    rng = np.random.default_rng(6)
    middles = rng.standard_normal((150, 32))
    rows = middles[rng.integers(0, 150, 6000)] + 0.5 * rng.standard_normal((6000, 32))
    rows *= (rng.lognormal(0, 1, 6000) / np.linalg.norm(rows, axis=1))[:, None]
    longest = (rows ** 2).sum(axis=1).max()
    lifted = np.column_stack([rows, np.sqrt(np.maximum(longest - (rows ** 2).sum(axis=1), 0))])
    points = np.column_stack([rows * np.sqrt(longest / (rows ** 2).sum(axis=1))[:, None], np.zeros(6000)])
    centroids = ann.train_lists(lifted[:3000], 77)
    probes = ann.needed_probes(lifted[:3000], points[:256], centroids, 20, 0.96)
    held_by = ann.nearest_lists(lifted, centroids, 1)[:, 0]
    hits = 0
    for q in range(5000, 5200):
        score = rows @ rows[q]
        score[q] = -np.inf
        hits += np.isin(held_by[np.argsort(-score)[:20]], ann.nearest_lists(points[q: q + 1], centroids, probes)[0]).sum()
    assert hits / 4000 >= 0.9


@pytest.mark.parametrize("spread", [0.0, 0.8])
def test_answers_come_from_the_probed_lists(spark, monkeypatch, spread):
    rng = np.random.default_rng(8)
    middles = rng.standard_normal((40, 16))
    rows = middles[rng.integers(0, 40, 3000)] + 0.4 * rng.standard_normal((3000, 16))
    rows *= (rng.lognormal(0, spread, 3000) / np.linalg.norm(rows, axis=1))[:, None]
    rows = rows.astype(np.float32).astype(float)
    table = spark.createDataFrame([(i, v) for i, v in enumerate(rows.tolist())], "vec_id long, embedding array<double>")
    want = exact_neighbours(list(enumerate(rows.tolist())))

    # the sample is a small part of the table
    monkeypatch.setattr(ann, "SAMPLE_PER_LIST", 10)
    got = {}
    for r in ann.nearest_by_inner_product(table).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len(got[q] & {i for i, _ in want[q]}) for q in want) / sum(map(len, want.values()))
    print("recall", spread, hits)
    assert hits >= 0.9


def test_the_sample_gives_no_answers(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [(i, v) for i, v in enumerate(rng.standard_normal((200, 8)).tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(ann, "scan", lambda *a: (np.zeros(0, np.int64), np.zeros(0)))
    assert ann.nearest_by_inner_product(table).count() == 0


def test_nearest_neighbours_odd_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.standard_normal(8) * (1 + i % 3)]) for i in range(60)]
    rows += [(i, [1.0] * 8) for i in range(60, 130)]  # copies
    rows += [(200, [1.0, 2.0]), (201, [float("nan")] + [1.0] * 7), (202, [0.0] * 8), (203, None), (204, []),
             (205, [None] + [1.0] * 7), (206, [float("inf")] + [0.0] * 7), (None, [1.0] * 8), (220, [-0.0, 1.0])]
    table = spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<double>, rep string, v double")
    usable = [(i, v) for i, v in rows if i is not None and v and any(v) and all(x is not None and np.isfinite(x) for x in v)]
    want = exact_neighbours(usable)
    got = {}
    for r in ann.nearest_by_inner_product(table).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert got.keys() == want.keys()
    hits = 0
    for q, answers in got.items():
        assert sorted(answers) == list(range(1, 21))
        hits += len({a[0] for a in answers.values()} & {i for i, _ in want[q]})
    assert hits >= 0.9 * 20 * len(want)
    # 60 is one of many copies: all of its nearest are copies, smallest ids first
    first = [got[60][k][0] for k in range(1, 21)]
    assert first == [i for i, _ in want[60]]
    assert ann.nearest_by_inner_product(table.limit(0)).count() == 0
    alone = spark.createDataFrame([(0, [1.0, 0.0])], "vec_id long, embedding array<double>")
    assert ann.nearest_by_inner_product(alone).count() == 0


def test_scan_keeps_the_nearest():
    rng = np.random.default_rng(1)
    rows, query = rng.standard_normal((65, 900)).astype(np.float32), rng.standard_normal(65).astype(np.float32)
    blocks = [rows[a: a + 16] for a in range(0, 65, 16)]
    found, far = ann.scan(query, blocks, 21)
    whole = ((rows - query[:, None]) ** 2).sum(axis=0)
    assert np.allclose(far, whole[found], rtol=1e-4)
    best = set(np.argsort(whole)[:21])
    assert len(best & set(found)) >= 20 and len(found) < 600


def brute_url(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), len(h), h + (p or "/"), v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, _, rule, verdict = max(fits, default=(0, 0, None, "allow"))
    return host, path, rule, verdict


@pytest.mark.parametrize("rules", [
    URL_RULES,
    [("net", "/", "block"), ("net", "/a", "allow"), ("net", "/a/b", "block"), ("x.net", "", "allow"), ("co", "/é", "block"),
     ("a,b.net", "/", "block"), ("b.net", "/", "allow"), ("", "/only", "block")],
    [],
])
def test_url_rules(spark, rules):
    urls = [r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()] + [
        None, "", "no scheme", "http://", "HTTP://WWW.Example.NET/en/x?y=/fr/", "http://net", "http://net/", "http://notnet/a",
        "http://x.net?q", "http://x.net#f", "http://.net/a", "http://a,b.net/q", "http://b.net/q", "http://b.a.net/a/b/c", "http://x.net/a/bc",
        "ftp://e.example.com/de/?://", "http://É.co/é/x", "http:///only/x", "http://a.org/fr/\n/x", "http://a.org/fr", "http://x.y.z.example.com/de/1",
    ]
    pages = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate([*urls, urls[0]])], "page_id long, url string, host string, key string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = url_rules.judge_urls(pages, table).collect()
    want = sorted(((i, *brute_url(u, rules)) for i, u in enumerate([*urls, urls[0]])))
    assert sorted(map(tuple, got)) == want
    assert url_rules.judge_urls(pages.limit(0), table).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (200, 150), (150, 300)] + [(500, 501 + i) for i in range(30)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100, 150: 150, 200: 150, 300: 150} | {500 + i: 500 for i in range(31)}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_stages_equal_their_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    step = dict(corpus_pipeline.STAGES)
    assert list(step) == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "mix_sources", "pack_sequences"]
    good = step["quality_classifier"](spark, docs, SF)
    scores = {r["doc_id"]: r["predicted"] for r in quality.score_quality(docs, labels).collect()}
    assert {r["doc_id"] for r in good.collect()} == {i for i, p in scores.items() if p}
    marked = {r["doc_id"]: r["quality"] for r in labels.collect()}
    clean = [i for i, q in marked.items() if q == 1 and i in texts]
    assert sum(scores[i] for i in clean) / len(clean) > 0.95
    single = step["exact_dedup"](spark, good, SF)
    assert {r["doc_id"] for r in single.collect()} == {
        r["doc_id"] for r in exact_dedup.exact_duplicates(good).collect() if r["kept"]
    }
    far = step["simhash_near_dedup"](spark, single, SF)
    assert {r["doc_id"] for r in far.collect()} == {
        r["component_id"] for r in simhash.simhash_components(single).collect()
    }
    mixed = step["mix_sources"](spark, far, SF)
    assert sorted(r["doc_id"] for r in mixed.collect()) == sorted(
        r["doc_id"] for r in mixing.mix(far).collect() for _ in range(r["copies"])
    )
    for frame in (good, single, far, mixed):
        assert frame.columns == docs.columns
        assert all(r["text"] == texts[r["doc_id"]] for r in frame.collect())
    pieces = step["pack_sequences"](spark, mixed, SF)
    direct = packing.pack(mixed, tokenizer_file("word_bpe_49k.json"))
    assert sorted(map(tuple, pieces.collect())) == sorted(map(tuple, direct.collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, pieces.collect()))


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_against_sql(spark, name):
    difference, rows = compare(spark, connect(SF), Query(QUERIES[name], SQL[name]), SF)
    assert not difference and rows


def test_url_rules_lower_only_ascii(spark):
    pages = spark.createDataFrame([(1, "http://x.É.co/a"), (2, "http://x.é.co/a"), (3, "http://X.B.CO/a")], "page_id long, url string")
    rules = spark.createDataFrame([("É.co", "", "block"), ("B.co", "", "block")], "host string, path string, verdict string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_rules.judge_urls(pages, rules).collect()}
    assert got == {1: ("É.co/", "block"), 2: (None, "allow"), 3: ("b.co/", "block")}


def test_language_learns_rows_under_their_own_language(spark):
    rows = [(1, "one", "en"), (1, "zwei", None), (1, "drei", "de"), (2, "two", "en"), (2, "two again", "en")]
    rows = [(i, t, x) for i, t, x in rows if zlib.crc32(str(i).encode()) % 5]
    texts, langs = language.training_sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert set(zip(texts, langs)) == {(t, x) for _, t, x in rows if x}
