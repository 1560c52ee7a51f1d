"""Operators against brute force on small fixtures, with skew, NULLs and ties."""

import math
import random
from collections import Counter
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from feedmill.functions import dates, dialect, paths, text
from feedmill.operators import coverage, dedup, joins, limits, mapping, merge, quality, rules, suggestions
from feedmill.plans import silver
from feedmill.queries import mappings as mapping_queries
from feedmill.session import stage
from feedmill.sources import config_files, tabular


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, a tenth have none."""
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else (None if i % 10 == 1 else f"k{rng.randrange(700)}")
        rows.append((i, key, float(i % 7)))
    return rows, spark.createDataFrame(rows, "raw_id bigint, key string, value double").repartition(4).cache()


@pytest.mark.parametrize("hot_keys", [1, 3, 1000])
def test_attach_by_key_is_exact_under_skew(skewed, hot_keys):
    rows, df = skewed
    counts = df.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    got = {r.raw_id: r.n for r in joins.attach_by_key(df, counts, ["key"], "n", hot_keys).collect()}
    want = Counter(k for _, k, _ in rows)
    assert got == {i: want[k] for i, k, _ in rows}


def test_hot_rows_are_spread(spark):
    df = spark.range(0, 40_000, 1, 8).select(
        F.col("id").alias("raw_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = joins.with_key_count(df, ["key"]).filter("key = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(spread) > 1 and sum(r["count"] for r in spread) == 13_334


def test_duplicates_split_and_merge(skewed):
    rows, df = skewed
    want = Counter(k for _, k, _ in rows)
    unique, repeated = dedup.split_all_duplicates(df, ["key"])
    assert {r.raw_id for r in repeated.collect()} == {i for i, k, _ in rows if k is not None and want[k] > 1}
    assert unique.count() + repeated.count() == len(rows)
    kept = {r.key: r.raw_id for r in dedup.keep_first(df, ["key"]).collect()}
    assert kept == {k: min(i for i, x, _ in rows if x == k) for k in want}
    plan = dedup.keep_first(df, ["key"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one row per key leaves each input partition
    assert dedup.duplicate_count(df, ["key"]).first()[0] == len(rows) - len([k for k in want if k is not None])


def test_key_sum(skewed):
    rows, df = skewed
    got = {r.raw_id: r.total for r in joins.with_key_sum(df, ["key"], "value", "total").collect()}
    sums = Counter()
    for _, k, v in rows:
        sums[k] += v
    assert got == {i: sums[k] for i, k, _ in rows}


@pytest.mark.parametrize("size", [1, 7, 500, 2000, 5000, None])
def test_batch_bounds(spark, size):
    rng = random.Random(size or 0)
    ids = sorted(rng.sample(range(1, 10**12), 1500) + list(range(50, 1050)))
    ids = sorted(set(ids))
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    left = [i for i in ids if i > 60]
    first, last = limits.batch_bounds(df, "id", 60, size)
    assert first == left[0]
    assert last == (left[min(size, len(left)) - 1] if size else left[-1])
    assert limits.batch_bounds(df, "id", ids[-1], size) is None


def test_similar_names_finds_every_pair(spark):
    rng = random.Random(3)
    base = ["ann", "robert smith", "Customer#000000", "international business machines incorporated", "a", "",
            "the quick brown fox jumps over"]
    names = set(base)
    for _ in range(160):
        n = list(rng.choice(base))
        for _ in range(rng.randrange(1, 5)):
            at, kind = rng.randrange(len(n) + 1), rng.randrange(3)
            if kind == 0 or not n:
                n.insert(at, rng.choice("abz#"))
            elif kind == 1:
                n[min(at, len(n) - 1)] = rng.choice("abz#")
            else:
                n.pop(min(at, len(n) - 1))
        names.add("".join(n))
    names = sorted(names)
    df = spark.createDataFrame([("g", n) for n in names], "g string, name string")
    got = {(r.a, r.b) for r in dedup.similar_names(df, "name", ["g"], 0.85).collect()}
    want = {
        (a, b) for i, a in enumerate(names) for b in names[i + 1:]
        if distance(a, b) <= math.floor(max(len(a), len(b)) * 0.15 + 1e-9)
    }
    assert got == want and len(want) > 50


def test_pieces_of_names_are_joined_by_shuffle(spark):
    # the planner counts the hundreds of pieces of a name as one row and would send them through the driver
    names = [("g", f"Customer#{i:09d}") for i in range(40)] + [("g", f"a much longer name of customer {i:09d}") for i in range(40)]
    df = stage(spark.createDataFrame(names, "g string, name string"), "names")
    plan = dedup.similar_names(df, "name", ["g"], 0.85)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and "Broadcast" not in plan


def test_fuzzy_duplicates_are_connected_groups(spark):
    # abcdefgh - abcdefgX - abcdefYX: the ends are too far apart, the chain is one group.
    rows = [(1, "abcdefgh"), (2, "abcdefgX"), (3, "abcdefYX"), (4, "other name"), (5, None), (6, "abcdefgh"), (7, None)]
    df = spark.createDataFrame([(i, n, "g") for i, n in rows] + [(8, "abcdefgh", "h")], "raw_id bigint, name string, g string")
    last = dedup.drop_fuzzy_duplicates(df, "name", ["g"], 0.85).collect()
    first = dedup.drop_fuzzy_duplicates(df, "name", ["g"], 0.85, keep="FIRST").collect()
    assert sorted(r.raw_id for r in last) == [4, 5, 6, 7, 8]
    assert sorted(r.raw_id for r in first) == [1, 4, 5, 7, 8]
    none = dedup.drop_fuzzy_duplicates(df.filter("raw_id = 4"), "name", ["g"], 0.85)
    assert [r.raw_id for r in none.collect()] == [4]


@pytest.mark.parametrize("name", ["map_03_exact_score", "map_04_substring_score", "map_06_word_overlap"])
def test_score_queries_score_every_pair(spark, monkeypatch, name):
    # unlike names, one letter, no letter at all and a missing name, which counts as empty, are scored too
    sources, targets = ["k", "USER_ID", "user id", "zzz", "--", None], ["KEY", "USER_ID", "AMOUNT", "_", None]
    monkeypatch.setattr(mapping_queries, "_sources", lambda s, d: spark.createDataFrame([(x,) for x in sources], "source_field string"))
    monkeypatch.setattr(mapping_queries, "_targets", lambda s, d: spark.createDataFrame(
        [(t, x) for x in targets for t in "AB"], "target_table string, target_column string"))
    norm = lambda s: "".join(c if c.isalnum() else " " for c in s or "").lower().strip()
    words = lambda s: set(norm(s).split())
    score = {
        "map_03_exact_score": lambda a, b: float(norm(a) == norm(b)),
        "map_04_substring_score": lambda a, b: float(bool(norm(a) and norm(b)) and (norm(a) in norm(b) or norm(b) in norm(a))),
        "map_06_word_overlap": lambda a, b: round(len(words(a) & words(b)) / max(len(words(a) | words(b)), 1), 4),
    }[name]
    want = {(a, b): score(a, b) for a in sources for b in targets}
    got = mapping_queries.QUERIES[name].run(spark, "").collect()
    assert {(r.source_field, r.target_column): r.score for r in got} == want and len(got) == len(want)


def test_mapping_scores_match_brute_force(spark):
    sources = ["CLM_NBR", "Claim Number", "PAT_FNAME", "PatientFirstName", "SVC_DT", "x", "Provider-NPI", "plan type"]
    targets = ["CLAIM_NUMBER", "PATIENT_FIRST_NAME", "SERVICE_DATE", "PROVIDER_NPI", "PLAN_TYPE", "X", "PLAN"]
    norm = lambda s: "".join(c if c.isascii() and c.isalnum() else " " for c in s).lower().strip()
    docs = [norm(s) for s in sources + targets]
    grams = lambda d: Counter(d[i:i + n] for n in (2, 3) for i in range(len(d) - n + 1))
    df = Counter(g for d in docs for g in grams(d))

    def vector(d):
        v = {g: c * (math.log((1 + len(docs)) / (1 + df[g])) + 1) for g, c in grams(d).items()}
        size = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {g: x / size for g, x in v.items()}

    def score(s, t):
        a, b = norm(s), norm(t)
        va, vb = vector(a), vector(b)
        words_a, words_b = set(a.split()), set(b.split())
        basic = 0.4 * (a == b) + 0.2 * (a in b or b in a) + 0.2 * SequenceMatcher(None, a, b).ratio()
        basic += 0.2 * len(words_a & words_b) / len(words_a | words_b)
        return 0.7 * basic + 0.3 * sum(w * vb.get(g, 0.0) for g, w in va.items())

    src = spark.createDataFrame([(s,) for s in sources], "source_field string")
    tgt = spark.createDataFrame([("T", t) for t in targets], "target_table string, target_column string")
    for minimum in (0.6, 0.3, 0.05):
        got = {(r.source_field, r.target_column): r.combined_score for r in mapping.score_pairs(src, tgt, minimum).collect()}
        want = {(s, t): score(s, t) for s in sources for t in targets if score(s, t) >= minimum}
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-4 for k in want)
    known = spark.createDataFrame([("plan type", "T", "PLAN_TYPE", "p")],
                                  "source_field string, target_table string, target_column string, tpa string")
    proposed = mapping.propose_mappings(src, tgt, known, "p", top_n=1, min_confidence=0.5).collect()
    assert "plan type" not in {r.source_field for r in proposed}
    assert all(not r.approved and r.mapping_method == "ML_AUTO" for r in proposed)


def test_responses(spark):
    answers = [
        (1, '[{"source_field":"a","target_field":"T.B","confidence":0.9,"reasoning":"r"}]'),
        (2, 'Sure!\n```json\n[{"source_field":"a","target_field":"T.B","confidence":0.5}]\n```'),
        (3, 'x {"source_field":"a","target_field":"T.B","confidence":0.1} y {"source_field":"c","target_field":"T.D","confidence":1}'),
        (4, "no idea"), (5, '{"a": 1'), (6, "[]"), (7, None), (8, "] none ["),
        (9, 'see [1] {"note": {"source_field":"a","target_field":"T.B"}} [2]'),
    ]
    df = spark.createDataFrame(answers, "id int, response string")
    found = suggestions.read_responses(df).collect()
    assert Counter(r.id for r in found) == {1: 1, 2: 1, 3: 2, 9: 1}


def test_rules_equal_sequential_evaluation(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice([None, -1, 0, 5]), rng.choice([None, "x", "y"]), rng.choice([None, 1.0, 2.0])) for i in range(400)]
    df = spark.createDataFrame(rows, "raw_id bigint, a int, b string, c double")
    checks = [
        ("r0", "a", ">= 0", "REJECT", lambda r: None if r[1] is None else r[1] >= 0),
        ("r1", "b", "= 'x'", "LOG", lambda r: None if r[2] is None else r[2] == "x"),
        ("r2", "b", "IS NOT NULL", "QUARANTINE", lambda r: r[2] is not None),
        ("r3", "c", "> 1", "REJECT", lambda r: None if r[3] is None else r[3] > 1),
        ("r4", "a", "IS NOT NULL", "QUARANTINE", lambda r: r[1] is not None),
    ]
    listed = [rules.Rule(i, i, rules.QUALITY, "T", col, None, logic, {}, n, act) for n, (i, col, logic, act, _) in enumerate(checks)]
    result = rules.apply_quality_rules(df, listed, "T")
    left, counts, held = rows, {}, 0
    for rule_id, _, _, action, ok in checks:
        bad = [r for r in left if ok(r) is False]
        counts[rule_id] = len(bad)
        if action in ("REJECT", "QUARANTINE"):
            held += len(bad) if action == "QUARANTINE" else 0
            left = [r for r in left if ok(r) is not False]
    assert {r.rule_id: r.metric_value for r in result.metrics().collect()} == counts
    assert {r.raw_id for r in result.survivors().collect()} == {r[0] for r in left}
    assert result.quarantined().count() == held


def test_bad_dedup_strategy_is_reported(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a")], "raw_id bigint, k string")
    bad = [rules.Rule("d", "d", rules.DEDUP, "T", None, None, "k", {"strategy": "SOMETIMES"}, 1, "LOG"),
           rules.Rule("e", "e", rules.DEDUP, "T", None, None, "missing", {}, 2, "LOG")]
    kept, held, metrics = rules.apply_dedup_rules(df, bad, "T")
    assert kept.count() == 2 and held is None
    assert [r.metric_type for r in metrics.collect()] == ["DEDUPLICATION_ERROR"] * 2


def test_merge_and_edits(spark):
    old = spark.createDataFrame([(1, "a", True), (2, "b", True), (None, "n", True)], "id int, v string, active boolean")
    new = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "id int, v string")
    got = {r.id: (r.v, r.active, r.did) for r in merge.merge_rows(
        old, new, ["id"], insert_values={"active": F.lit(False)}, action="did").collect()}
    assert got == {1: ("a", True, "KEEP"), 2: ("B", True, "UPDATE"), 3: ("C", False, "INSERT"), None: ("N", True, "UPDATE")}
    assert merge.rows_to_insert(new, old, ["id"]).collect()[0].v == "C"
    changes = merge.diff_rows(old.filter("id IS NOT NULL"), new.filter("id IS NOT NULL"), "id", ["v"])
    assert {(r.op, r.id) for r in changes.collect()} == {("D", 1), ("U", 2), ("I", 3)}
    assert merge.delete_where(old, F.col("id") == 1).count() == 2


def test_dialect():
    assert dialect.to_spark("TO_DATE(source_value 'MM-DD-YYYY')") == "try_to_date(source_value, 'MM-dd-yyyy')"
    assert dialect.to_spark("CAST(source_value AS NUMBER(10 2))") == "TRY_CAST(source_value AS DECIMAL(10, 2))"
    assert dialect.to_spark("IN ('PPO' 'HMO')") == "IN ('PPO', 'HMO')"
    assert quality.measurement_sql("SELECT (COUNT(A) / (SELECT COUNT(*) FROM T))") == (
        "SELECT (COUNT(A) / (SELECT NULLIF(COUNT(*), 0) FROM T))")
    assert dialect.to_spark("DATEDIFF('day' A B) <= 30") == "datediff(B, A) <= 30"
    assert dialect.predicate("C", "RLIKE '^[0-9]{2}$'") == "C RLIKE '^(?:^[0-9]{2}$)$'"
    assert dialect.predicate("C", "C IN ('a')") == "C IN ('a')"
    assert dialect.type_name("NUMBER(15 2)") == "decimal(15,2)"
    assert dialect.type_name("number(38,0) autoincrement") == "decimal(38,0)"
    with pytest.raises(ValueError):
        dialect.type_name("GEOMETRY")


def test_raw_paths_and_spellings(spark):
    df = spark.sql("""SELECT 1L AS raw_id, 'p' AS tpa, parse_json('{"Two Words": "7", "plain": "x", "UP": " u "}') AS raw_data""")
    expr = dialect.to_spark('RAW_DATA:"Two Words"::NUMBER(5,1) + 1')
    assert float(df.select(F.expr(expr)).first()[0]) == 8.0
    maps = [silver.Mapping("up", "A", None, "COALESCE(TRIM(source_value), 'none')"),
            silver.Mapping("PLAIN", "B", "p", None), silver.Mapping("Two Words", "B", None, None),
            silver.Mapping("Gone", "C", None, None)]
    row = silver.project(df, maps).first()
    assert (row.A, row.B, row.C) == ("u", "x", None)


def test_dates_and_text(spark):
    ts = lambda s: F.lit(s).cast("timestamp_ntz")
    row = spark.range(1).select(
        dates.boundary_diff("hour", ts("2024-01-01 00:59:00"), ts("2024-01-01 01:01:00")),
        dates.boundary_diff("day", ts("2024-01-02 00:00:01"), ts("2024-01-01 23:59:59")),
        dates.boundary_diff("year", ts("2023-12-31 00:00:00"), ts("2024-01-01 00:00:00")),
        text.matches_whole(F.lit("xABCx"), "ABC"),
        text.format_phone(F.lit("(555) 123 4567")),
        paths.provider(F.lit("a/b/c.csv")), paths.provider(F.lit("my.file.csv")),
        text.edit_similarity(F.lit(""), F.lit("")),
    ).first()
    assert tuple(row) == (1, -1, 1, False, "(555) 123-4567", "b", "my.file", 1.0)


def test_column_names(spark):
    header = F.array(*[F.lit(x) for x in ("a", "b", "a", None, "a", "")])
    got = spark.range(1).select(tabular.column_names(header)).first()[0]
    assert got == ["a", "b", "a.1", "Unnamed: 3", "a.2", "Unnamed: 5"]


def test_config_files(spark, tmp_path):
    (tmp_path / "m.csv").write_text(
        "source_field,target_table,target_column,transformation_logic,mapping_method,confidence_score,approved,notes,tpa\n"
        "SVC,claims,service_date,TO_DATE(source_value 'MM-DD-YYYY'),manual,,TRUE,n,provider_a\n"
        ",provider_e\n")
    got = config_files.field_mappings(spark, str(tmp_path / "m.csv")).collect()
    assert len(got) == 1
    assert got[0].transformation_logic == "TO_DATE(source_value, 'MM-DD-YYYY')"
    assert (got[0].target_table, got[0].confidence_score, got[0].approved) == ("CLAIMS", 1.0, True)
    (tmp_path / "r.csv").write_text(
        "rule_id,rule_name,rule_type,target_table,target_column,rule_logic,rule_parameters,priority,error_action,description,active,tpa\n"
        'D1,d,DEDUPLICATION,claims,,CLAIM_NUM,"{""strategy"": ""KEEP_LAST""}",x,,d,TRUE,\n')
    rule = rules.active_rules(config_files.transformation_rules(spark, str(tmp_path / "r.csv")), "CLAIMS")[0]
    assert (rule.priority, rule.error_action, rule.rule_parameters) == (100, "LOG", {"strategy": "KEEP_LAST"})


def test_large_reference_equals_small_one(spark, skewed, monkeypatch):
    rows, df = skewed
    reference = spark.createDataFrame([("hot", "h"), ("k1", "one"), ("k2", "two"), (None, "none")], "k string, v string")
    small = {r.raw_id: r.v for r in rules.look_up(df, "key", reference, "k", "v", "v").collect()}
    missing = {r.raw_id for r in rules.missing_references(df, "key", reference, "k").collect()}
    monkeypatch.setattr(joins, "is_small", lambda *_: False)
    assert small == {r.raw_id: r.v for r in rules.look_up(df, "key", reference, "k", "v", "v").collect()}
    assert missing == {r.raw_id for r in rules.missing_references(df, "key", reference, "k").collect()}
    assert small == {i: {"hot": "h", "k1": "one", "k2": "two"}.get(k) for i, k, _ in rows}


def csv_rows_by_character(text):
    """Records and their cells, one character after the other."""
    rows, cells, cell, quoted, at = [], [], "", False, 0
    text = text.removeprefix("\ufeff")
    while at <= len(text):
        c = text[at] if at < len(text) else None
        if quoted and c is not None:
            if c == '"' and text[at + 1: at + 2] == '"':
                cell, at = cell + c, at + 1
            elif c == '"':
                quoted = False
            elif not (c == "\r" and text[at + 1: at + 2] == "\n"):
                cell += c
        elif c == '"' and cell == "" and text[at - 1: at] in ("", ",", "\n"):
            quoted = True
        elif c == ",":
            cells, cell = [*cells, cell or None], ""
        elif c in ("\n", None):
            if c is None or text[at - 1: at] == "\r":
                cell = cell.removesuffix("\r")
            if cells or cell or (at and text[at - 1] == '"'):
                rows.append([*cells, cell or None])
            cells, cell = [], ""
        else:
            cell += c
        at += 1
    return rows


@pytest.mark.parametrize("split", [29, 1 << 20])
def test_csv_splits_anywhere(spark, tmp_path, split):
    from feedmill.sources import tabular

    rng = random.Random(5)
    cells = ["a", "", "x y", '"q"', '"two\nlines"', '"a ""quoted"" name"', '"p,q"', '"\r\n,\n\n"', "é", 'mid"dle', '"one\ntwo\nthree\n\nfive"', '""']
    texts = {
        "plain.csv": "a,b,c\n1,2,3\n\n4,5,6", "quoted.csv": '"x\ny","p,q",z,w\n1,2,3,4\n', "one.csv": "one", "empty.csv": "",
        "crlf.csv": '\ufeff"a ""quoted"", name",b\r\n1,"2\r\n3"\r\n\r\n4,5\r\n', "open.csv": 'a,b\n1,"never\nclosed,\n\nat all',
        **{f"r{k}.csv": "\n".join(",".join(rng.choice(cells) for _ in range(rng.randint(1, 4))) for _ in range(25)) + "\n" for k in range(3)},
    }
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        parts = tabular.csv_parts(spark, str(tmp_path), sorted(texts))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = tabular.csv_cells(parts, str(tmp_path)).collect()
    found = {}
    for r in sorted(got, key=lambda r: r["row_no"]):
        found.setdefault(r["file_name"], []).append((r["row_no"], r["cells"]))
    for name, text in texts.items():
        assert found.get(name, []) == list(enumerate(csv_rows_by_character(text), 1)), name


def test_predicates_match_whole_operators():
    from feedmill.functions.dialect import predicate

    assert predicate("x", "INSTR(x, 'a') > 0") == "INSTR(x, 'a') > 0"
    assert predicate("x", "ISNULL(x)") == "ISNULL(x)"
    assert predicate("x", "NOT (x > 1)") == "NOT (x > 1)"
    assert predicate("x", "NOT IN (1, 2)") == "x NOT IN (1, 2)"
    assert predicate("x", "IS NOT NULL") == "x IS NOT NULL"
    assert predicate("x", "BETWEEN 1 AND 2") == "x BETWEEN 1 AND 2"


@pytest.mark.parametrize("offset", [0, 50, 299, 1000, 2990, 3000, 5000])
def test_deep_page_equals_plain_page(spark, monkeypatch, skewed, offset):
    monkeypatch.setattr(limits, "_RANGES", 8)
    rows, df = skewed
    # a third of the rows share the first key and some have none
    order = [F.desc_nulls_last("key"), F.asc("raw_id")]
    wanted = [r.raw_id for r in df.orderBy(*order).offset(offset).limit(25).collect()]
    assert [r.raw_id for r in limits.page(df, order, 25, offset, deep=40).collect()] == wanted


def test_deep_page_in_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(limits, "_RANGES", 4)
    df = spark.range(200).select(F.lit(1).alias("k"), "id")
    assert limits.page(df, [F.asc("k")], 10, 150, deep=20).count() == 10
    assert limits.page(df.limit(0), [F.asc("k")], 10, 150, deep=20).count() == 0


def test_join_any_lists_a_pair_once(spark):
    rng = random.Random(4)
    pick = lambda: rng.choice([None, 1, 2, 3])
    left = [(i, pick(), pick()) for i in range(40)]
    right = [(i, pick(), pick()) for i in range(30)]
    got = joins.join_any(
        spark.createDataFrame(left, "i int, a int, b int"), spark.createDataFrame(right, "j int, c int, d int"),
        [F.col("a") == F.col("c"), F.col("b") == F.col("d"), (F.col("a") == F.col("d")) & F.col("c").isNull()],
    ).collect()
    same = lambda x, y: x is not None and x == y
    wanted = Counter((i, j) for i, a, b in left for j, c, d in right if same(a, c) or same(b, d) or (same(a, d) and c is None))
    assert Counter((r.i, r.j) for r in got) == wanted


@pytest.mark.parametrize("tables", [["T", "U", "V"], []])
def test_coverage_summary_equals_the_listed_pairs(spark, tables):
    raw = spark.sql("""SELECT * FROM VALUES (1, 'f', 'p', '{"a":1,"b":2}'), (2, 'g', 'q', '{" A ":1}'), (3, 'h', NULL, '{"c":1}')
        AS t(raw_id, file_name, tpa, j)""").selectExpr("raw_id", "file_name", "tpa", "current_timestamp() AS load_timestamp", "parse_json(j) AS raw_data")
    schemas = spark.createDataFrame([(t, True) for t in tables] + [("W", False)], "table_name string, active boolean")
    mappings = spark.createDataFrame(
        [(1, "A", "T", "X", None, True), (2, "a", "T", "Y", "p", True), (3, "B", "U", "X", "q", True), (4, "b", "T", "Z", "p", True),
         (5, "c", "W", "X", None, True), (6, "c", "V", "X", None, False), (None, "c", "V", "X", None, True)],
        "mapping_id int, source_field string, target_table string, target_column string, tpa string, approved boolean")
    pairs = coverage.file_mapping_coverage(raw, schemas, mappings).collect()
    got = coverage.coverage_summary(raw, schemas, mappings).first()
    assert got.files == len(pairs) == 3 * len(tables)
    assert got.good_files == sum(r.coverage_status == "Good" for r in pairs)
    assert got.poor_files == sum(r.coverage_status == "Poor" for r in pairs)
    mean = sum(r.mapping_coverage_pct for r in pairs) / len(pairs) if pairs else None
    assert got.avg_coverage_pct == (pytest.approx(mean) if pairs else None)
