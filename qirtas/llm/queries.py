"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qirtas.llm import alignment, frequency, leakage, lookalike, packing, spans, truncation
from qirtas.llm.tables import arabic_records, read

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.shared_spans(arabic_records(spark, sf_dir))


def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = arabic_records(spark, sf_dir)
    return spans.report(records, spans.shared_spans(records))


def p1_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.clusters(spans.shared_windows(arabic_records(spark, sf_dir)))


def p1_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.removal(spans.shared_windows(arabic_records(spark, sf_dir)))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.lookalike_pairs(lookalike.fields(spark, sf_dir))


def p2_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.canonical(lookalike.fields(spark, sf_dir)).select("field_name", "key", "canonical")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency.marks(read(spark, sf_dir, "word_occurrence"), read(spark, sf_dir, "lemma"))


def p3_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency.term_counts(read(spark, sf_dir, "word_occurrence"))


def p3_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = frequency.ngram_counts(read(spark, sf_dir, "word_occurrence"))
    rare = F.col("records") <= frequency.RARE
    return counts.select(F.array_join("terms", " ").alias("ngram"), F.size("terms").cast("long").alias("n_terms"), "occurrences", "records", rare.alias("rare"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(alignment.bilingual(spark, sf_dir)).drop("score")


def p6_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def p6_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.invariants(p6_fill(spark, sf_dir))


def p6_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.summary(p6_fill(spark, sf_dir))


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "eval_item"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir).select("item_id", "doc_id")


def p7_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leakage.removal(read(spark, sf_dir, "documents"), _leaks(spark, sf_dir))
    spans = F.transform("spans", lambda s: F.concat_ws("+", s["first_word"].cast("string"), s["n_words"].cast("string")))
    return found.withColumn("spans", F.array_join(spans, " "))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.scored(read(spark, sf_dir, "documents")).where("reason is not null").select("doc_id")


def p8_terminality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the closing words and lengths alone say of each document."""
    _, docs, texts = truncation.judged(read(spark, sf_dir, "documents"))
    return truncation.of_documents(docs, texts).select("doc_id", "closed", "reason")


def p8_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.cut_share(truncation.scored(read(spark, sf_dir, "documents")))


def queries() -> dict[str, Query]:
    every = p1_found, p1_report, p1_clusters, p1_removal, p2_found, p2_canonical, p3_found, p3_terms, p3_ngrams, p5_found, p6_fill, p6_invariants, p6_summary, p7_found, p7_removal, p8_found, p8_sources, p8_terminality
    return {q.__name__: q for q in every}


_P1 = """
WITH records AS (
  SELECT DISTINCT 'hadith' AS rec_table, CAST(hadith_id AS VARCHAR) AS rec_key, arabic_matn AS text FROM hadith WHERE arabic_matn IS NOT NULL
  UNION ALL SELECT DISTINCT 'tafsir', tafsir_id, text_arabic FROM tafsir WHERE text_arabic IS NOT NULL
), split AS (
  SELECT rec_table, rec_key, list_filter(regexp_split_to_array(text, '[ \\n]+'), lambda w: w <> '') AS w FROM records
), windows AS (
  SELECT rec_table, rec_key, i - 1 AS p, array_to_string(list_slice(w, i, i + 11), ' ') AS k FROM (SELECT *, unnest(range(1, len(w) - 10)) AS i FROM split)
), shared AS (
  SELECT k FROM windows GROUP BY k HAVING count(DISTINCT rec_table || ':' || rec_key) > 1
), marked AS (
  SELECT DISTINCT rec_table, rec_key, p FROM windows WHERE k IN (SELECT k FROM shared)
), opened AS (
  SELECT *, CASE WHEN p <= lag(p) OVER (PARTITION BY rec_table, rec_key ORDER BY p) + 12 THEN 0 ELSE 1 END AS o FROM marked
), runs AS (
  SELECT *, sum(o) OVER (PARTITION BY rec_table, rec_key ORDER BY p) AS run FROM opened
), found AS (
  SELECT rec_table, rec_key, CAST(min(p) AS INT) AS span_start, CAST(max(p) + 12 - min(p) AS INT) AS span_len FROM runs GROUP BY rec_table, rec_key, run
)"""

_FIELDS = """
SELECT 'lemma.text' AS field_name, lemma_id AS key, '' AS place, text AS value FROM lemma
UNION ALL SELECT 'root.arabic_trilateral', root_id, '', arabic_trilateral FROM root
UNION ALL SELECT 'hadith.arabic_matn', hadith_id, '', arabic_matn FROM hadith
UNION ALL SELECT 'word_occurrence.surface_form', occ_id, location, surface_form FROM word_occurrence"""

_P3 = """
WITH w AS (
  SELECT regexp_extract(location, '^(.*):[^:]*$', 1) AS rec, location, surface_norm, top_lemma_id FROM word_occurrence WHERE location IS NOT NULL
), c AS (
  SELECT 'surface_norm' AS field, surface_norm AS term, count(DISTINCT location) AS occurrences, count(DISTINCT rec) AS records FROM w WHERE trim(surface_norm) <> '' GROUP BY surface_norm
  UNION ALL SELECT 'lemma', CAST(top_lemma_id AS VARCHAR), count(DISTINCT location), count(DISTINCT rec) FROM w WHERE top_lemma_id IS NOT NULL GROUP BY top_lemma_id
)"""

_P7 = """
WITH fold AS (
  SELECT 'item' AS kind, item_id AS id, text FROM eval_item WHERE text IS NOT NULL UNION ALL SELECT 'doc', doc_id, text FROM documents WHERE text IS NOT NULL
), words AS (
  SELECT kind, id, list_filter(regexp_split_to_array(translate(regexp_replace(lower(text), '[\\x{064B}-\\x{065F}\\x{0670}\\x{06D6}-\\x{06ED}\\x{0640}]', '', 'g'), 'إأآىة', 'ااايه'), '[^\\p{L}\\p{Nd}]+'), lambda w: w <> '') AS w FROM fold
), grams AS (
  SELECT DISTINCT kind, id, array_to_string(list_slice(w, i, i + 7), ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - 6)) AS i FROM words)
)
SELECT DISTINCT a.id AS item_id, b.id AS doc_id FROM grams a JOIN grams b ON a.g = b.g AND a.kind = 'item' AND b.kind = 'doc'"""


_HELD = _P1.replace("WITH records", "WITH RECURSIVE records") + """, held AS (
  SELECT DISTINCT rec_table, rec_key, rec_table || ':' || rec_key AS v, k, p FROM windows WHERE k IN (SELECT k FROM shared)
), hub AS (
  SELECT k, min(v) AS u FROM held GROUP BY k
), links AS (
  SELECT DISTINCT u, v FROM held JOIN hub USING (k)
), joined AS (
  SELECT u, v FROM links UNION SELECT v, u FROM links
), reach(v, u) AS (
  SELECT v, v FROM joined UNION SELECT r.v, b.v FROM reach r JOIN joined b ON r.u = b.u
), clusters AS (
  SELECT v, min(u) AS cluster FROM reach GROUP BY v
)"""

_P1_REMOVAL = _HELD + """, gone AS (
  SELECT DISTINCT v, p + unnest(range(0, 12)) AS w FROM held JOIN hub USING (k) WHERE v <> u
), kept AS (
  SELECT DISTINCT v, p + unnest(range(0, 12)) AS w FROM held JOIN hub USING (k) WHERE v = u
), going AS (
  SELECT v, w, w - row_number() OVER (PARTITION BY v ORDER BY w) AS run FROM (SELECT * FROM gone EXCEPT SELECT * FROM kept)
)
SELECT split_part(v, ':', 1) AS rec_table, substr(v, instr(v, ':') + 1) AS rec_key, any_value(cluster) AS cluster, CAST(min(w) AS INT) AS span_start, CAST(count(*) AS INT) AS span_len
FROM going JOIN clusters USING (v) GROUP BY v, run"""

_P3_NGRAMS = """
WITH rows AS (
  SELECT regexp_extract(location, '^(.*):[^:]*$', 1) AS rec, regexp_extract(location, '([^:]*)$', 1) AS place, TRY_CAST(regexp_extract(location, '([^:]*)$', 1) AS INT) AS n, surface_norm, loaded_at, occ_id
  FROM word_occurrence WHERE location IS NOT NULL AND trim(surface_norm) <> ''
), one AS (
  SELECT rec, CASE WHEN n >= 0 THEN n END AS at_, CASE WHEN n >= 0 THEN NULL ELSE place END AS odd, arg_min(surface_norm, (loaded_at, occ_id)) AS w FROM rows GROUP BY ALL
), grams AS (
  SELECT [w] AS t, rec FROM one UNION ALL SELECT [a.w, b.w], a.rec FROM one a JOIN one b ON a.rec = b.rec AND b.at_ = a.at_ + 1
  UNION ALL SELECT [a.w, b.w, c.w], a.rec FROM one a JOIN one b ON a.rec = b.rec AND b.at_ = a.at_ + 1 JOIN one c ON a.rec = c.rec AND c.at_ = a.at_ + 2
)
SELECT array_to_string(t, ' ') AS ngram, CAST(len(t) AS BIGINT) AS n_terms, count(*) AS occurrences, count(DISTINCT rec) AS records, count(DISTINCT rec) <= 2 AS rare FROM grams GROUP BY t"""

_P6_INVARIANTS = """
WITH n AS (SELECT doc_id, greatest(coalesce(n_tokens, strlen(text) + 1), 1) AS n FROM documents WHERE n_tokens IS NOT NULL OR text IS NOT NULL)
SELECT doc_id, (n + 2047) // 2048 AS n_pieces, n AS tokens, least(n, 2048) AS largest, 0 AS n_overfull, 0 AS n_misplaced FROM n"""

_P7_REMOVAL = _P7[: _P7.index(", grams AS")] + """, items AS (
  SELECT DISTINCT id AS item, array_to_string(list_slice(w, i, i + 7), ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - 6)) AS i FROM words WHERE kind = 'item')
), hits AS (
  SELECT d.id AS doc_id, item, i - 1 AS p FROM (SELECT *, unnest(range(1, len(w) - 6)) AS i FROM words WHERE kind = 'doc') d JOIN items ON array_to_string(list_slice(w, i, i + 7), ' ') = g
), covered AS (
  SELECT DISTINCT doc_id, p + unnest(range(0, 8)) AS at_ FROM hits
), runs AS (
  SELECT doc_id, min(at_) AS a, count(*) AS n FROM (SELECT *, at_ - row_number() OVER (PARTITION BY doc_id ORDER BY at_) AS run FROM covered) GROUP BY doc_id, run
), per AS (
  SELECT doc_id, sum(n) AS shared, string_agg(a || '+' || n, ' ' ORDER BY a) AS spans FROM runs GROUP BY doc_id
), n AS (
  SELECT doc_id, count(DISTINCT item) AS n_items FROM hits GROUP BY doc_id
)
SELECT doc_id, n_items, round(shared / len(w), 6) AS covered, CASE WHEN shared / len(w) >= 0.5 THEN 'document' ELSE 'runs' END AS action, CASE WHEN shared / len(w) >= 0.5 THEN '0+' || len(w) ELSE spans END AS spans
FROM per JOIN n USING (doc_id) JOIN words ON kind = 'doc' AND id = doc_id"""

_QUOTES = "['\"»”’)\\]}]*$".replace("'", "''")
_P8 = f"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS source, text, regexp_replace(text, '[\\s\\x{{0B}}\\x{{1C}}-\\x{{1F}}\\x{{85}}\\p{{Z}}]+$', '') AS t FROM documents WHERE doc_id IS NOT NULL AND trim(text) <> ''
), cut AS (
  SELECT *, regexp_extract(t, '([^\\s\\x{{0B}}\\x{{1C}}-\\x{{1F}}\\x{{85}}\\p{{Z}}]+)$', 1) AS ending, regexp_replace(regexp_replace(t, '{truncation._PUNCTUATION.replace("'", "''")}', '', 'g'), '\\s+', ' ', 'g') AS plain FROM docs
), told AS (
  SELECT *, regexp_matches(ending, '[.!?؟]{_QUOTES}') AND NOT regexp_matches(ending, '\\.\\.[.!?؟]{_QUOTES}') AS closed, regexp_matches(ending, '(…|\\.\\.\\.){_QUOTES}') AS open_ended,
    list_transform(list_filter(string_split(plain, ' '), lambda x: x <> ''), lambda x: regexp_replace(x, '\\p{{Nd}}+', '0', 'g')) AS w FROM cut
), ends AS (
  SELECT *, coalesce(w[-1], '') AS last_word FROM told
), vocabulary AS (
  SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM ends) GROUP BY word
), texts AS (
  SELECT source, plain, count(*) AS copies, min(length(text)) AS n_chars, min(strlen(text)) AS n_bytes, bool_and(open_ended) AS open_ended, min(last_word) AS last_word FROM ends WHERE NOT closed GROUP BY source, plain
), lengths AS (
  SELECT 'c' AS kind, source, n_chars AS v, count(*) AS k FROM texts GROUP BY source, n_chars UNION ALL SELECT 'b', source, n_bytes, count(*) FROM texts GROUP BY source, n_bytes
), about AS (
  SELECT *, (sum(k) OVER (PARTITION BY kind, source ORDER BY v RANGE BETWEEN {truncation.AROUND} PRECEDING AND {truncation.AROUND} FOLLOWING) - k + 1) / (2.0 * {truncation.AROUND} + 1) AS u, count(*) OVER (PARTITION BY kind, source) AS m FROM lengths
), limits AS (
  SELECT kind, source, v, k * ln(k / u) - (k - u) - ln(m * {truncation.SURE}) AS excess FROM about WHERE k > u AND k * ln(k / u) - (k - u) > ln(m * {truncation.SURE})
), placed AS (
  SELECT t.*, greatest(coalesce(c.excess, 0), coalesce(b.excess, 0)) AS at_limit FROM texts t LEFT JOIN limits c ON c.kind = 'c' AND c.source = t.source AND c.v = t.n_chars LEFT JOIN limits b ON b.kind = 'b' AND b.source = t.source AND b.v = t.n_bytes
), closings AS (
  SELECT source, last_word, count_if(at_limit = 0 AND NOT open_ended) AS k, coalesce(sum(copies) FILTER (at_limit = 0 AND NOT open_ended), 0) AS n FROM placed GROUP BY source, last_word
), wanted AS (
  SELECT DISTINCT last_word FROM closings
), begun AS (
  SELECT last_word, sum(n) AS begun FROM wanted JOIN vocabulary ON last_word <> '' AND word <> last_word AND starts_with(word, last_word) GROUP BY last_word
), at_end AS (
  SELECT last_word, count(*) AS n_end FROM ends GROUP BY last_word
), of_words AS (
  SELECT last_word, greatest(coalesce(n, 0) - coalesce(n_end, 0), 0) AS inside, coalesce(begun, 0) AS begun FROM wanted LEFT JOIN vocabulary ON word = last_word LEFT JOIN at_end USING (last_word) LEFT JOIN begun USING (last_word)
), sources AS (
  SELECT source, count(*) AS n_docs, count_if(closed) AS n_closed FROM ends GROUP BY source
), rated AS (
  SELECT source, last_word, n, n_closed, CASE WHEN inside > 0 THEN 1.0 ELSE 0.5 / greatest(begun, 0.5) END AS whole,
    CASE WHEN k > 1 THEN (k - 1) * pow(greatest(0, 1 - 1 / (9.0 * (k - 1)) - 2.326 / (3 * sqrt(k - 1))), 3) ELSE 0 END / n_docs / ((inside + 0.5 + begun) / (SELECT sum(n) FROM vocabulary)) AS rate
  FROM closings JOIN of_words USING (last_word) JOIN sources USING (source)
), opens AS (
  SELECT source, coalesce(sum(n) FILTER (rate < 1), 0) / greatest(max(n_closed) + sum(n), 1) AS open FROM rated GROUP BY source
), scores AS (
  SELECT source, last_word, ln(rate + open * whole + 1e-9) AS score, whole = 1 AS whole FROM rated JOIN opens USING (source)
), verdicts AS (
  SELECT source, plain, CASE WHEN open_ended THEN 'mark' WHEN score - at_limit < ln({truncation.LEAST}) THEN CASE WHEN at_limit > 0 THEN 'limit' WHEN whole THEN 'open' ELSE 'fragment' END END AS reason FROM placed JOIN scores USING (source, last_word)
)
SELECT doc_id, closed, CASE WHEN NOT closed THEN reason END AS reason FROM ends LEFT JOIN verdicts USING (source, plain)"""


def oracle_sql() -> dict[str, str]:
    looks = f"WITH fields AS ({_FIELDS}), looks AS (SELECT field_name, key, place, value, {lookalike.canonical_sql('value')} AS canonical FROM fields)"
    report = """, sizes AS (SELECT rec_table, rec_key, CAST(max(len(w)) AS INT) AS n_words FROM split GROUP BY ALL),
per AS (SELECT rec_table, rec_key, sum(span_len) AS shared_words, count(*) AS n_spans, max(span_len) AS longest FROM found GROUP BY ALL)
SELECT rec_table, rec_key, n_words, CAST(coalesce(shared_words, 0) AS BIGINT) AS shared_words, coalesce(n_spans, 0) AS n_spans, coalesce(longest, 0) AS longest,
  round(CASE WHEN n_words > 0 THEN coalesce(shared_words, 0) / n_words ELSE 0.0 END, 6) AS shared_part FROM sizes LEFT JOIN per USING (rec_table, rec_key)"""
    return {
        "p1_found": _P1 + " SELECT * FROM found",
        "p1_report": _P1 + report,
        "p2_found": looks + " SELECT DISTINCT a.field_name, a.key AS key_a, b.key AS key_b FROM looks a JOIN looks b ON a.field_name = b.field_name AND a.place = b.place AND a.canonical = b.canonical AND a.key < b.key AND a.value <> b.value",
        "p2_canonical": looks + " SELECT field_name, key, canonical FROM looks",
        "p3_terms": _P3 + " SELECT field, term, occurrences, records FROM c",
        "p3_found": _P3
        + """, t AS (SELECT count(DISTINCT rec) AS total FROM w)
SELECT field AS field_name, term, 'rare' AS mark FROM c WHERE records <= 2 AND (field <> 'lemma' OR term IN (SELECT CAST(lemma_id AS VARCHAR) FROM lemma))
UNION ALL SELECT field, term, 'common' FROM c, t WHERE records > 0.05 * total AND (field <> 'lemma' OR term IN (SELECT CAST(lemma_id AS VARCHAR) FROM lemma))
UNION ALL SELECT 'lemma', CAST(l.lemma_id AS VARCHAR), 'stale' FROM lemma l LEFT JOIN c ON c.field = 'lemma' AND c.term = CAST(l.lemma_id AS VARCHAR) WHERE l.frequency IS NOT NULL AND l.frequency <> coalesce(c.occurrences, 0)""",
        "p7_found": _P7,
        "p1_clusters": _HELD + " SELECT DISTINCT rec_table, rec_key, cluster FROM held JOIN clusters USING (v)",
        "p1_removal": _P1_REMOVAL,
        "p3_ngrams": _P3_NGRAMS,
        "p6_invariants": _P6_INVARIANTS,
        "p7_removal": _P7_REMOVAL,
        "p8_terminality": _P8,
    }
