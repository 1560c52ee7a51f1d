"""Registered queries: mapping discovery, approval and model suggestions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.functions.text import normalise_name
from feedmill.operators import joins, mapping as M, suggestions as S
from feedmill.operators.dedup import keep_first
from feedmill.operators.merge import apply_changes
from feedmill.queries import tables as T
from feedmill.queries.tables import Query, as_of, sql

_NORM = "trim(lower(regexp_replace({}, '[^a-zA-Z0-9]', ' ', 'g')))"


def _sources(s, d) -> DataFrame:
    """Field names as providers spell them: from the raw objects and from earlier mappings."""
    fields = M.source_fields(T.raw(s, d)).select(F.col("field_name").alias("source_field"))
    return fields.unionByName(T.mappings(s, d).select("source_field")).distinct()


def _targets(s, d) -> DataFrame:
    return T.schemas(s, d).filter("active").select(
        F.col("table_name").alias("target_table"), F.col("column_name").alias("target_column")
    ).distinct().unionByName(
        T.load(s, d, "events").select(F.lit("EVENTS").alias("target_table"), F.explode(F.array(
            *[F.lit(c) for c in ("EVENT_ID", "USER_ID", "KEY", "VALUE_AMOUNT")])).alias("target_column")).distinct())


_FIELDS_SQL = """src AS (SELECT DISTINCT source_field FROM (
    SELECT unnest(CASE tpa WHEN 'error' THEN ['event_id', 'k', 'user_id'] WHEN 'signup' THEN ['event_id', 'k', 'USER_ID', 'value']
      ELSE ['event_id', 'k', 'user_id', 'value'] END) AS source_field FROM raw
    UNION ALL SELECT source_field FROM mappings)),
tgt AS (SELECT DISTINCT table_name AS target_table, column_name AS target_column FROM schemas WHERE active
    UNION SELECT 'EVENTS', unnest(['EVENT_ID', 'USER_ID', 'KEY', 'VALUE_AMOUNT']))"""


def fields_sql(body: str) -> str:
    return sql("raw mappings schemas", "").rstrip() + ",\n" + _FIELDS_SQL + "\n" + body


def _names(s, d) -> tuple[DataFrame, DataFrame]:
    """Source names (source_field, s) and target names (target_column, t), each with its normalised form."""
    src = _sources(s, d).withColumn("s", normalise_name(F.col("source_field")))
    return src, _targets(s, d).select("target_column").distinct().withColumn("t", normalise_name(F.col("target_column")))


def _pairs(s, d) -> DataFrame:
    """Every source name with every target name; the source names are dealt to all tasks unless they are few enough to be broadcast."""
    src, tgt = _names(s, d)
    parts = int(s.conf.get("spark.sql.shuffle.partitions"))
    return src.repartition(parts, F.xxhash64("source_field")).crossJoin(tgt).select("source_field", "target_column", "s", "t")


def _lettered_pairs(s, d) -> DataFrame:
    """Source and target names that share a letter."""
    src, tgt = _names(s, d)
    met = M.shared_pieces(src.select("s").distinct(), tgt.select("t").distinct(), 1)
    return met.join(src, "s").join(tgt, "t").select("source_field", "target_column", "s", "t")


_PAIRS_SQL = f"""SELECT source_field, target_column, s, t FROM
    (SELECT source_field, coalesce({_NORM.format('source_field')}, '') AS s FROM src)
    CROSS JOIN (SELECT DISTINCT target_column, coalesce({_NORM.format('target_column')}, '') AS t FROM tgt)"""


_WORDS = "list_filter(list_distinct(regexp_split_to_array({}, ' +')), lambda w: w <> '')"

_TFIDF_SQL = f"""
docs AS (SELECT name, count(*) AS copies FROM (
    SELECT {_NORM.format('source_field')} AS name FROM src UNION ALL SELECT {_NORM.format('target_column')} FROM tgt) GROUP BY name),
grams AS (
    SELECT name, copies, substr(name, i, n) AS gram FROM docs, (VALUES (2), (3)) z(n), range(1, 200) r(i)
    WHERE i + n - 1 <= length(name)),
tf AS (SELECT name, copies, gram, count(*) AS tf FROM grams GROUP BY ALL),
df AS (SELECT gram, sum(copies) AS df FROM tf GROUP BY gram),
w AS (SELECT name, gram, tf * (ln((1 + (SELECT sum(copies) FROM docs)) / CAST(1 + df AS DOUBLE)) + 1) AS w FROM tf JOIN df USING (gram)),
wn AS (SELECT name, gram, w / sqrt(sum(w * w) OVER (PARTITION BY name)) AS w FROM w)"""


def _cosines(s, d):
    src = _sources(s, d).select(normalise_name(F.col("source_field")).alias("s"))
    tgt = _targets(s, d).select(normalise_name(F.col("target_column")).alias("t"))
    names = src.select(F.col("s").alias("name")).unionByName(tgt.select(F.col("t").alias("name")))
    weights = M.gram_weights(names.groupBy("name").agg(F.count(F.lit(1)).alias("copies")))
    return M.gram_cosines(weights, src.distinct(), tgt.distinct()).withColumn("tfidf", F.round("tfidf", 4))


def _tfidf(s, d):
    names = _sources(s, d).select(normalise_name(F.col("source_field")).alias("name")).unionByName(
        _targets(s, d).select(normalise_name(F.col("target_column")).alias("name")))
    documents = names.groupBy("name").agg(F.count(F.lit(1)).alias("copies"))
    return M.gram_weights(documents).select("name", "gram", F.round("w", 4).alias("weight"))


TEMPLATE = "Map these:\n{source_fields}\nto these:\n{target_fields}\nAnswer as JSON."

RESPONSE_KINDS = """CASE conv_id % 5
    WHEN 0 THEN '[{"source_field": "f' || conv_id || '", "target_field": "EVENTS.USER_ID", "confidence": 0.9, "reasoning": "same"}]'
    WHEN 1 THEN 'Here you are:' || chr(10) || '```json' || chr(10) || '[{"source_field": "f' || conv_id || '", "target_field": "events.key", "confidence": 0.' || turn || '5, "reasoning": "near"}]' || chr(10) || '``` done'
    WHEN 2 THEN 'One {"source_field": "f' || conv_id || '", "target_field": "EVENTS.KEY", "confidence": 0.4} and two {"source_field": "g' || conv_id || '", "target_field": "NOPE", "confidence": 0.8}'
    WHEN 3 THEN '[{"source_field": "f' || conv_id || '", "target_field": "EVENTS.MISSING", "confidence": 0.7}]'
    ELSE text END"""


def _responses(s, d) -> DataFrame:
    """Model answers built from the conversations: clean, fenced, loose, wrong and free text."""
    text = RESPONSE_KINDS.replace("chr(10)", "char(10)")
    return T.load(s, d, "conversations").selectExpr("conv_id", "turn", f"{text} AS response")


def _schemas(s, d) -> DataFrame:
    return _targets(s, d).select(
        F.col("target_table").alias("table_name"), F.col("target_column").alias("column_name"), F.lit(True).alias("active"))


_FOUND_SQL = """found AS (
    SELECT conv_id, turn, 'f' || conv_id AS source_field, 'EVENTS.USER_ID' AS target_field, CAST(0.9 AS DOUBLE) AS confidence, 'same' AS reasoning FROM conversations WHERE conv_id % 5 = 0
    UNION ALL SELECT conv_id, turn, 'f' || conv_id, 'events.key', CAST('0.' || turn || '5' AS DOUBLE), 'near' FROM conversations WHERE conv_id % 5 = 1
    UNION ALL SELECT conv_id, turn, 'f' || conv_id, 'EVENTS.KEY', CAST(0.4 AS DOUBLE), NULL FROM conversations WHERE conv_id % 5 = 2
    UNION ALL SELECT conv_id, turn, 'g' || conv_id, 'NOPE', CAST(0.8 AS DOUBLE), NULL FROM conversations WHERE conv_id % 5 = 2
    UNION ALL SELECT conv_id, turn, 'f' || conv_id, 'EVENTS.MISSING', CAST(0.7 AS DOUBLE), NULL FROM conversations WHERE conv_id % 5 = 3)"""


def found_sql(body: str) -> str:
    return "WITH " + _FOUND_SQL + "\n" + body


def _valid(s, d):
    return S.valid_suggestions(S.read_responses(_responses(s, d)), _schemas(s, d))


def _empty_mappings(s):
    return s.createDataFrame([], "source_field string, target_table string, target_column string, tpa string")


def _known(s, d) -> DataFrame:
    """Dictionary of synonyms: a mapping's source word and its target column."""
    return T.mappings(s, d).filter("approved").select(
        "source_field", F.col("target_column").alias("target_field"), (F.col("mapping_id") % 2 == 0).alias("active"))


def _approved(s, d):
    out = M.approve(T.mappings(s, d), M.confident_pending("brand_2", 0.5), "reviewer", as_of())
    return out.filter("approved_by IS NOT NULL").select("mapping_id", "approved_by", F.date_format("approved_timestamp", "yyyy-MM-dd").alias("on"))


def _edited(s, d):
    changes = T.load(s, d, "part").filter("p_size > 30").select(
        (F.col("p_partkey") + 1).alias("mapping_id"),
        F.when(F.col("p_size") > 45, "D").otherwise("U").alias("op"),
        F.concat(F.lit("TRIM("), F.col("p_size"), F.lit(")")).alias("transformation_logic"))
    return apply_changes(T.mappings(s, d), changes, "mapping_id", ["transformation_logic", "description"]).select(
        "mapping_id", "transformation_logic", "description")


def _cache_requests(s, d) -> DataFrame:
    return T.mappings(s, d).select("source_field", F.col("target_table").alias("target_schema"), F.lit("m1").alias("model_name")).distinct()


def _cache(s, d) -> DataFrame:
    known = T.mappings(s, d).filter("mapping_method = 'LLM_CORTEX'")
    return known.select(S.cache_key(F.col("source_field"), F.col("target_table"), F.lit("m1")).alias("cache_key")).distinct()


QUERIES = {
    "map_01_source_fields": Query(
        lambda s, d: M.source_fields(T.raw(s, d)),
        sql("raw", """SELECT DISTINCT unnest(CASE tpa WHEN 'error' THEN ['event_id', 'k', 'user_id']
            WHEN 'signup' THEN ['event_id', 'k', 'USER_ID', 'value'] ELSE ['event_id', 'k', 'user_id', 'value'] END) AS field_name FROM raw""")),
    "map_01_source_fields_of_provider": Query(
        lambda s, d: M.source_fields(T.raw(s, d), "signup"),
        sql("raw", "SELECT DISTINCT unnest(['event_id', 'k', 'USER_ID', 'value']) AS field_name FROM raw WHERE tpa = 'signup'")),
    "map_02_normalised_names": Query(
        lambda s, d: _sources(s, d).select("source_field", normalise_name(F.col("source_field")).alias("name")),
        fields_sql(f"SELECT source_field, {_NORM.format('source_field')} AS name FROM src")),
    "map_03_exact_score": Query(
        lambda s, d: _pairs(s, d).select(
            "source_field", "target_column", F.when(F.col("s") == F.col("t"), 1.0).otherwise(0.0).alias("score")),
        fields_sql(f"SELECT source_field, target_column, CAST(s = t AS INTEGER) * CAST(1 AS DOUBLE) AS score FROM ({_PAIRS_SQL})")),
    "map_04_substring_score": Query(
        lambda s, d: _pairs(s, d).select(
            "source_field", "target_column", M.substring_score(F.col("s"), F.col("t")).alias("score")),
        fields_sql(f"""SELECT source_field, target_column, CASE WHEN s <> '' AND t <> '' AND (contains(s, t) OR contains(t, s))
            THEN CAST(1 AS DOUBLE) ELSE 0 END AS score FROM ({_PAIRS_SQL})""")),
    "map_05_sequence_score": Query(
        lambda s, d: _lettered_pairs(s, d).select("source_field", "target_column", F.round(M.sequence_ratio("s", "t"), 4).alias("score"))),
    "map_06_word_overlap": Query(
        lambda s, d: _pairs(s, d).select(
            "source_field", "target_column", F.round(M.word_overlap(F.col("s"), F.col("t")), 4).alias("score")),
        fields_sql(f"""SELECT source_field, target_column, round(CASE WHEN len(a) = 0 OR len(b) = 0 THEN CAST(0 AS DOUBLE)
              ELSE CAST(len(list_intersect(a, b)) AS DOUBLE) / len(list_distinct(list_concat(a, b))) END, 4) AS score
            FROM (SELECT *, {_WORDS.format('s')} AS a, {_WORDS.format('t')} AS b FROM ({_PAIRS_SQL}))""")),
    "map_07_gram_weights": Query(
        _tfidf,
        fields_sql("").rstrip() + "," + _TFIDF_SQL + "\nSELECT name, gram, round(w, 4) AS weight FROM wn"),
    "map_07_gram_cosine": Query(
        _cosines,
        fields_sql("").rstrip() + "," + _TFIDF_SQL + f"""
SELECT a.name AS s, b.name AS t, round(sum(a.w * b.w), 4) AS tfidf FROM wn a JOIN wn b ON a.gram = b.gram
WHERE a.name IN (SELECT {_NORM.format('source_field')} FROM src) AND b.name IN (SELECT {_NORM.format('target_column')} FROM tgt)
GROUP BY a.name, b.name"""),
    "map_08_combined_score": Query(lambda s, d: M.score_pairs(_sources(s, d), _targets(s, d), 0.6)),
    "map_09_propose_mappings": Query(
        lambda s, d: M.propose_mappings(_sources(s, d), _targets(s, d), T.mappings(s, d), "economy", min_confidence=0.5)),
    "map_10_prompts": Query(
        lambda s, d: S.render_prompts(
            T.mappings(s, d).filter("tpa IS NOT NULL").select("tpa", "source_field"),
            T.schemas(s, d).filter("active").select(
                "tpa", F.col("table_name").alias("target_table"), F.col("column_name").alias("target_column"), "description"),
            TEMPLATE).select("tpa", "target_table", F.md5("prompt").alias("prompt_hash"), F.length("prompt").alias("prompt_length")),
        sql("mappings schemas", """SELECT c.tpa, target_table, md5(p) AS prompt_hash, CAST(length(p) AS INTEGER) AS prompt_length FROM (
            SELECT c.tpa, target_table, 'Map these:' || chr(10) || f.lines || chr(10) || 'to these:' || chr(10) || c.lines || chr(10) || 'Answer as JSON.' AS p
            FROM (SELECT tpa, table_name AS target_table, string_agg(DISTINCT line, chr(10) ORDER BY line) AS lines FROM (
                    SELECT *, '- ' || table_name || '.' || column_name || ' (' || description || ')' AS line FROM schemas WHERE active) GROUP BY ALL) c
            JOIN (SELECT tpa, string_agg(DISTINCT '- ' || source_field, chr(10) ORDER BY '- ' || source_field) AS lines FROM mappings
                  WHERE tpa IS NOT NULL GROUP BY tpa) f ON c.tpa = f.tpa) c""")),
    "map_11_read_responses": Query(
        lambda s, d: S.read_responses(_responses(s, d)).select(
            "conv_id", "turn", "source_field", "target_field", F.col("confidence").cast("double").alias("confidence"), "reasoning"),
        found_sql("SELECT * FROM found")),
    "map_12_valid_suggestions": Query(
        lambda s, d: _valid(s, d).select("conv_id", "turn", "source_field", "target_table", "target_column", "confidence_score"),
        found_sql("""SELECT conv_id, turn, upper(source_field) AS source_field, 'EVENTS' AS target_table,
            upper(split_part(target_field, '.', 2)) AS target_column, confidence AS confidence_score
            FROM found WHERE upper(target_field) IN ('EVENTS.USER_ID', 'EVENTS.KEY')""")),
    "map_13_best_suggestions": Query(
        lambda s, d: S.best_suggestions(_valid(s, d), _empty_mappings(s), "click", "m1").select(
            "source_field", "target_column", "confidence_score", "description", "approved"),
        found_sql("""SELECT upper(source_field) AS source_field, upper(split_part(target_field, '.', 2)) AS target_column,
            max(confidence) AS confidence_score, 'LLM: m1 - ' || coalesce(any_value(reasoning), '') AS description, false AS approved
            FROM found WHERE upper(target_field) IN ('EVENTS.USER_ID', 'EVENTS.KEY') GROUP BY 1, 2""")),
    "map_14_approve_one": Query(
        lambda s, d: M.approve(T.mappings(s, d), F.col("mapping_id") == 28, "reviewer", as_of()).select("mapping_id", "approved"),
        sql("mappings", "SELECT mapping_id, approved OR mapping_id = 28 AS approved FROM mappings")),
    "map_15_approve_confident": Query(
        _approved,
        sql("mappings", """SELECT mapping_id, 'reviewer' AS approved_by, '2024-01-31' AS on FROM mappings
            WHERE target_table = 'BRAND_2' AND confidence_score >= 0.5 AND NOT approved""").replace("AS on ", 'AS "on" ')),
    "map_16_review_edits": Query(
        _edited,
        sql("mappings", """SELECT mapping_id, CASE WHEN p_size > 30 THEN 'TRIM(' || p_size || ')' ELSE transformation_logic END AS transformation_logic,
            description FROM mappings JOIN part ON mapping_id = p_partkey + 1 WHERE p_size <= 45""")),
    "map_16_unapprove": Query(
        lambda s, d: M.unapprove(T.mappings(s, d), F.col("tpa").isNull()).select("mapping_id", "approved"),
        sql("mappings", "SELECT mapping_id, approved AND tpa IS NOT NULL AS approved FROM mappings")),
    "map_17_validate": Query(
        lambda s, d: M.validate_mappings(T.mappings(s, d), T.schemas(s, d)),
        sql("mappings schemas", """SELECT dup AS duplicate_count, orph AS orphan_count, bad AS invalid_method_count,
            CASE WHEN dup + orph + bad = 0 THEN 'Validation passed for all field mappings' ELSE 'Validation FAILED for field mappings - Errors: '
              || CASE WHEN dup > 0 THEN dup || ' duplicate mapping(s) detected. ' ELSE '' END
              || CASE WHEN orph > 0 THEN orph || ' mapping(s) to non-existent target columns. ' ELSE '' END
              || CASE WHEN bad > 0 THEN bad || ' mapping(s) with invalid method. ' ELSE '' END END AS message
            FROM (SELECT (SELECT count(*) FROM (SELECT 1 FROM mappings GROUP BY source_field, source_table, target_table, target_column HAVING count(*) > 1)) AS dup,
              (SELECT count(*) FROM mappings m WHERE NOT EXISTS (SELECT 1 FROM schemas s WHERE s.active AND s.table_name = m.target_table AND s.column_name = m.target_column)) AS orph,
              (SELECT count(*) FROM mappings WHERE mapping_method NOT IN ('MANUAL', 'ML_AUTO', 'LLM_CORTEX', 'SYSTEM')) AS bad)""")),
    "map_18_synonyms": Query(
        lambda s, d: M.propose_synonyms(
            T.mappings(s, d).select("source_field").distinct(), _known(s, d), _targets(s, d)),
        sql("raw mappings schemas", "").rstrip() + ",\n" + _FIELDS_SQL + """
            SELECT f.source_field, target_table, target_column FROM (SELECT DISTINCT source_field FROM mappings) f
            JOIN (SELECT DISTINCT source_field, target_column AS t FROM mappings WHERE approved AND mapping_id % 2 = 0) k ON k.source_field = f.source_field
            JOIN tgt ON target_column = t"""),
    "map_19_effective_mappings": Query(
        lambda s, d: joins.effective_mappings(_unique(s, d)).select("tpa", "target_table", "target_column", "mapping_id", "mapping_source"),
        sql("mappings", """, one AS (SELECT target_table, target_column, tpa, min(mapping_id) AS mapping_id FROM mappings WHERE approved GROUP BY ALL),
            tpas AS (SELECT DISTINCT tpa FROM one WHERE tpa IS NOT NULL)
            SELECT tpa, target_table, target_column, mapping_id, 'TPA-Specific' AS mapping_source FROM one WHERE tpa IS NOT NULL
            UNION ALL SELECT t.tpa, g.target_table, g.target_column, g.mapping_id, 'Global' FROM one g, tpas t WHERE g.tpa IS NULL
              AND NOT EXISTS (SELECT 1 FROM one o WHERE o.tpa = t.tpa AND o.target_table = g.target_table AND o.target_column = g.target_column)""")),
    "map_20_suggestion_cache_hits": Query(
        lambda s, d: S.split_cached(_cache_requests(s, d), _cache(s, d))[0].select("source_field", "target_schema"),
        sql("mappings", """SELECT DISTINCT source_field, target_table AS target_schema FROM mappings m WHERE EXISTS (SELECT 1 FROM mappings c
            WHERE c.mapping_method = 'LLM_CORTEX' AND c.source_field = m.source_field AND c.target_table = m.target_table)""")),
    "map_20_suggestion_cache_misses": Query(
        lambda s, d: S.split_cached(_cache_requests(s, d), _cache(s, d))[1].select("source_field", "target_schema"),
        sql("mappings", """SELECT DISTINCT source_field, target_table AS target_schema FROM mappings m WHERE NOT EXISTS (SELECT 1 FROM mappings c
            WHERE c.mapping_method = 'LLM_CORTEX' AND c.source_field = m.source_field AND c.target_table = m.target_table)""")),
}


def _unique(s, d):
    return keep_first(T.mappings(s, d).filter("approved"), ["target_table", "target_column", "tpa"], "mapping_id")
