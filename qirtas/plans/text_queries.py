"""Queries of the normalisers, parsers and tokenisers over the whole text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qirtas.functions import citations, fragments, html, lemmatize, segment
from qirtas.functions import normalize as n
from qirtas.plans.register import Register, table
from qirtas.sources.files import decode_scalar, has_arabic, has_latin, split_valid

register = Register()
query = register.query

_MARKS = "\\x{064B}-\\x{065F}\\x{0670}\\x{06D6}-\\x{06ED}"
_WHITE = "[\\s\\x{0B}\\x{1C}-\\x{1F}\\x{85}\\p{Z}]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WHITE}+|{_WHITE}+$', '', 'g')"


def _squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{_WHITE}+', ' ', 'g'))"


def _key(x: str) -> str:
    return _strip(f"translate(regexp_replace({x}, '[{_MARKS}\\x{{0640}}]', '', 'g'), 'إأآىة', 'ااايه')")


def _search(x: str) -> str:
    phrases = "|".join(n.HONORIFICS)
    y = f"regexp_replace(coalesce({x}, ''), '{phrases}', ' ', 'g')"
    y = f"regexp_replace(regexp_replace({y}, '[\\x{{064B}}-\\x{{0652}}\\x{{0670}}\\x{{0640}}]', '', 'g'), '{phrases}', ' ', 'g')"
    return _squeeze(f"translate({y}, 'أإآىةؤئء', 'ااايهوي')")


@query(f"SELECT occ_id, {_key('surface_form')} AS norm_key FROM word_occurrence")
def n01_normalize_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "word_occurrence").select("occ_id", n.normalize_key(F.col("surface_form")).alias("norm_key"))


@query("SELECT hadith_id, loaded_at, " + _squeeze(f"regexp_replace(coalesce(arabic_matn, ''), '[{_MARKS}]', '', 'g')") + " AS matn FROM hadith")
def n02_normalize_matn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "hadith").select("hadith_id", "loaded_at", n.normalize_matn(F.col("arabic_matn")).alias("matn"))


@query(f"SELECT tafsir_id, loaded_at, {_search('text_arabic')} AS searched FROM tafsir")
def n03_normalize_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "tafsir").select("tafsir_id", "loaded_at", n.normalize_ar(F.col("text_arabic")).alias("searched"))


@query("SELECT lemma_id, translate(text, 'إأآ', 'ااا') AS folded FROM lemma")
def n04_fold_alef(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lemma").select("lemma_id", n.norm_alef(F.col("text")).alias("folded"))


@query("SELECT verse_key, " + _strip("regexp_replace(text, '[\\x{0660}-\\x{0669}]', '', 'g')") + " AS bare, TRY_CAST(translate(regexp_extract(text, '[\\x{0660}-\\x{0669}]+$', 0), '٠١٢٣٤٥٦٧٨٩', '0123456789') AS INT) AS shown FROM ayah")
def n05_verse_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N05, N08."""
    text = F.col("text")
    return table(spark, sf_dir, "ayah").select("verse_key", n.strip_verse_number(text).alias("bare"), n.to_int(F.regexp_extract(text, "[\\x{0660}-\\x{0669}]+$", 0)).alias("shown"))


@query("SELECT lemma_id, " + _key("regexp_replace(text, '[0-9]+$', '')") + " AS dedup_key FROM lemma")
def n06_dedup_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lemma").select("lemma_id", n.dedup_key(F.col("text")).alias("dedup_key"))


@query(
    "WITH x AS (SELECT hadith_id, loaded_at, regexp_replace(" + _strip("nomor") + ", '\\.0$', '') AS x FROM hadith), y AS (SELECT *, translate(x, '٠١٢٣٤٥٦٧٨٩', '0123456789') AS y FROM x) "
    "SELECT hadith_id, loaded_at, coalesce(CASE WHEN regexp_matches(y, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') THEN CAST(TRY_CAST(trunc(TRY_CAST(y AS DOUBLE)) AS BIGINT) AS VARCHAR) END, x, 'None') AS nomor FROM y"
)
def n07_normalize_nomor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "hadith").select("hadith_id", "loaded_at", n.normalize_nomor(F.col("nomor")).alias("nomor"))


@query("SELECT o_orderkey, " + _squeeze("replace(' #' || o_orderpriority || '  #' || o_orderkey || ' ', '#', '')") + " AS norm_id FROM orders")
def n09_norm_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = F.concat(F.lit(" #"), "o_orderpriority", F.lit("  #"), F.col("o_orderkey").cast("string"), F.lit(" "))
    return table(spark, sf_dir, "orders").select("o_orderkey", n.norm_id(made).alias("norm_id"))


@query(
    "SELECT doc_id, "
    + _squeeze("regexp_replace('a {' || doc_id || ' , ' || n_chars || '} b {x' || doc_id || '} ' || coalesce(text, ''), '\\{[\\p{Nd}\\s\\x{0640}\\x{2013},\\x{060C}-]+\\}', ' ', 'g')")
    + " AS unbraced, regexp_replace(text, '^[^\\p{Nd}\\n]{0,28}\\p{Nd}+\\s*:\\s*', '') AS unprefixed FROM documents"
)
def n11_brace_and_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N11, N12."""
    made = F.concat(F.lit("a {"), F.col("doc_id").cast("string"), F.lit(" , "), F.col("n_chars").cast("string"), F.lit("} b {x"), F.col("doc_id").cast("string"), F.lit("} "), F.coalesce("text", F.lit("")))
    return table(spark, sf_dir, "documents").select("doc_id", n.squeeze(n.drop_brace_numbers(made)).alias("unbraced"), n.drop_reference_prefix(F.col("text")).alias("unprefixed"))


@query(f"SELECT item_id, regexp_replace(text, '^[{n.EDGES}]+|[{n.EDGES}]+$', '', 'g') AS fragment FROM eval_item")
def n18_trim_fragment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "eval_item").select("item_id", n.trim_fragment(F.col("text")).alias("fragment"))


@query("SELECT event_id, CASE WHEN props = '' OR props = 'null' THEN NULL WHEN regexp_matches(props, '^\".*\"$') THEN json_extract_string(props, '$') ELSE props END AS decoded FROM events")
def s09_decode_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", decode_scalar(F.col("props")).alias("decoded"))


_CITED = "SELECT hadith_id, loaded_at, unnest(list_filter(list_transform(regexp_split_to_array(cited, '[،,]'), lambda x: trim(x)), lambda x: x <> '')) AS c FROM (SELECT hadith_id, loaded_at, {made} AS cited FROM hadith WHERE arabic_matn IS NOT NULL)"
_MADE_SQL = "'رواه ' || (['البخاري','مسلم','أبو داود','أحمد','غيره','متفق عليه'])[hadith_id % 6 + 1] || ' (' || (['١٢','3/4','٥-٦','x'])[hadith_id % 4 + 1] || ')، سورة البقرة الآية ' || (['١٠','٢٥٥','ا'])[hadith_id % 3 + 1] || ',, ' || arabic_matn"


def _cited(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = lambda values, k: F.get(F.array(*map(F.lit, values)), (F.col("hadith_id") % k).cast("int"))
    made = F.concat(
        F.lit("رواه "), pick(("البخاري", "مسلم", "أبو داود", "أحمد", "غيره", "متفق عليه"), 6), F.lit(" ("), pick(("١٢", "3/4", "٥-٦", "x"), 4), F.lit(")، سورة البقرة الآية "),
        pick(("١٠", "٢٥٥", "ا"), 3), F.lit(",, "), "arabic_matn",
    )
    rows = table(spark, sf_dir, "hadith").where("arabic_matn is not null")
    return rows.select("hadith_id", "loaded_at", F.explode(citations.split_citations(made)).alias("c"))


@query(_CITED.format(made=_MADE_SQL))
def c01_split_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cited(spark, sf_dir)


_WHEN = " ".join(f"WHEN contains(c, '{k}') THEN '{v}'" for k, v in citations.COLLECTIONS)
_REPORT = " OR ".join(f"contains(c, '{k}')" for k in (*citations.OUTSIDE, citations.AGREED))


@query(
    f"WITH x AS ({_CITED.format(made=_MADE_SQL)}), y AS (SELECT *, CASE {_WHEN} END AS coll, regexp_extract(c, '\\(([\\p{{Nd}}\\s/\\x{{2013}}-]+)\\)', 1) AS g FROM x), "
    "z AS (SELECT *, CASE WHEN NOT regexp_matches(g, '[/\\x{2013}-]') THEN TRY_CAST(trim(translate(g, '٠١٢٣٤٥٦٧٨٩', '0123456789')) AS INT) END AS num FROM y), "
    f"k AS (SELECT *, CASE WHEN contains(c, 'سورة') THEN 'quran' WHEN coll IS NOT NULL AND num IS NOT NULL THEN 'hadith_with_number' WHEN coll IS NOT NULL OR {_REPORT} THEN 'hadith_no_number' ELSE 'other' END AS category FROM z) "
    "SELECT hadith_id, loaded_at, c, category, CASE WHEN category LIKE 'hadith%' THEN coll END AS collection, CASE WHEN category = 'hadith_with_number' THEN num END AS number, "
    "NULLIF(regexp_extract(c, 'سورة\\s+([\\x{0600}-\\x{06FF}]+(?:\\s+[\\x{0600}-\\x{06FF}]+){0,2}?)\\s+الآية\\s+([\\x{0660}-\\x{0669}]+)', 1), '') AS verse_name, "
    "TRY_CAST(translate(regexp_extract(c, 'سورة\\s+([\\x{0600}-\\x{06FF}]+(?:\\s+[\\x{0600}-\\x{06FF}]+){0,2}?)\\s+الآية\\s+([\\x{0660}-\\x{0669}]+)', 2), '٠١٢٣٤٥٦٧٨٩', '0123456789') AS INT) AS verse FROM k"
)
def c02_classify_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C02, C03, P14."""
    c = F.col("c")
    rows = _cited(spark, sf_dir).withColumns({"k": citations.classify(c), "v": citations.parse_verse_reference(c)})
    return rows.select("hadith_id", "loaded_at", "c", "k.category", "k.collection", "k.number", F.col("v.name").alias("verse_name"), "v.verse")


def _entries(x: str) -> str:
    bare = _strip("regexp_replace(x, '^\\(\\x{00AC}?[\\x{0660}-\\x{0669}]+\\)\\s*', '')")
    return f"list_transform(list_filter(list_transform(string_split({x}, chr(13)), lambda x: {_strip('x')}), lambda x: x <> ''), lambda x: {bare})"


@query(
    "SELECT doc_id, CAST(len(e) AS INT) AS n_entries, array_to_string(e, '|') AS entries FROM (SELECT doc_id, "
    + _entries("'(١) ' || coalesce(text, '') || chr(13) || ' ' || chr(13) || '(¬٢)  ' || source || chr(13) || 'x (٣)'")
    + " AS e FROM documents WHERE source IS NOT NULL)"
)
def c04_footnote_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = F.concat(F.lit("(١) "), F.coalesce("text", F.lit("")), F.lit("\r \r(¬٢)  "), "source", F.lit("\rx (٣)"))
    rows = table(spark, sf_dir, "documents").where("source is not null").select("doc_id", citations.footnote_entries(made).alias("e"))
    return rows.select("doc_id", F.size("e").alias("n_entries"), F.array_join("e", "|").alias("entries"))


@query(
    "WITH t AS (SELECT tafsir_id, loaded_at, list_filter(list_transform(regexp_split_to_array(coalesce(text_arabic, ''), '" + _WHITE + "+'), lambda w: regexp_replace(w, '^(?:[^\\p{L}\\p{N}_]|\\p{Nd})+|(?:[^\\p{L}\\p{N}_]|\\p{Nd})+$', '', 'g')), lambda w: w <> '') AS w FROM tafsir) "
    "SELECT tafsir_id, loaded_at, CAST(p AS INT) AS position, w[p] AS token FROM (SELECT *, unnest(range(1, len(w) + 1)) AS p FROM t)"
)
def c09_tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C09, O06."""
    rows = table(spark, sf_dir, "tafsir").select("tafsir_id", "loaded_at", F.posexplode(n.tokenize(F.col("text_arabic"))).alias("p", "token"))
    return rows.select("tafsir_id", "loaded_at", (F.col("p") + 1).alias("position"), "token")


@query("SELECT tafsir_id, loaded_at, unnest(list_filter(string_split(ayah_keys, ','), lambda x: x <> '')) AS verse_key FROM tafsir WHERE ayah_keys IS NOT NULL")
def c10_key_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "tafsir").where("ayah_keys is not null").select("tafsir_id", "loaded_at", F.explode(n.key_list(F.col("ayah_keys"))).alias("verse_key"))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pages of books: one a source, in the order of doc_id; every third page has a heading, every second a marker."""
    number = F.translate((F.col("doc_id") % 50 + 1).cast("string"), "0123456789", n.ARABIC_DIGITS)
    body = F.concat(F.lit("مقدمة (١) "), F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("الفتوى رقم ("), number, F.lit(") س "))).otherwise(""), F.coalesce("text", F.lit("")), F.when(F.col("doc_id") % 2 == 0, F.lit(" (٢) ")).otherwise(""))
    notes = F.concat(F.lit("(١) رواه مسلم ("), number, F.lit(")\r(٢) سورة البقرة الآية ٥"))
    return table(spark, sf_dir, "documents").where("source is not null").select(F.col("source").alias("book"), F.col("doc_id").alias("sequence_num"), body.alias("body"), notes.alias("footnotes"))


_CUT, _END = "chr(64976)", "chr(64977)"
_SEGMENTS = f"""
WITH numbered AS (
  SELECT *, translate(CAST(doc_id % 50 + 1 AS VARCHAR), '0123456789', '{n.ARABIC_DIGITS}') AS number FROM documents WHERE source IS NOT NULL
), pages AS (
  SELECT source AS book, doc_id AS sequence_num, {_entries("'(١) رواه مسلم (' || number || ')' || chr(13) || '(٢) سورة البقرة الآية ٥'")} AS e,
    'مقدمة (١) ' || CASE WHEN doc_id % 3 = 0 THEN 'الفتوى رقم (' || number || ') س ' ELSE '' END || coalesce(text, '') || CASE WHEN doc_id % 2 = 0 THEN ' (٢) ' ELSE '' END AS body FROM numbered
), pieces AS (
  SELECT book, sequence_num, e, string_split(regexp_replace(body, '{segment.heading(_WHITE)}', {_CUT} || '\\1' || {_END} || '\\0', 'g'), {_CUT}) AS p FROM pages
), parts AS (
  SELECT book, sequence_num, e, k, CASE WHEN k > 1 THEN CAST(translate(split_part(p[k], {_END}, 1), '{n.ARABIC_DIGITS}', '0123456789') AS INT) END AS heading,
    CASE WHEN k > 1 THEN split_part(p[k], {_END}, 2) ELSE p[k] END AS text, len(p) AS n FROM (SELECT *, unnest(range(1, len(p) + 1)) AS k FROM pieces)
), marked AS (
  SELECT *, len(regexp_extract_all(text, '{segment.MARKER}')) - CAST(k > 1 AS INT) AS n_markers FROM parts WHERE k > 1 OR text <> '' OR n = 1
), segs AS (
  SELECT *, last_value(heading IGNORE NULLS) OVER (PARTITION BY book ORDER BY sequence_num, k ROWS UNBOUNDED PRECEDING) AS number,
    CAST(sum(n_markers) OVER (PARTITION BY book, sequence_num ORDER BY k ROWS UNBOUNDED PRECEDING) AS INT) AS upto, sum(n_markers) OVER (PARTITION BY book, sequence_num) AS total FROM marked
), handed AS (
  SELECT book, sequence_num, k, number, {_strip('text')} AS text, len(e) <> total AS mismatch, CASE WHEN n_markers > 0 THEN e[upto - n_markers + 1 : upto] ELSE [] END AS entries FROM segs
), items AS (
  SELECT book || ':' || number AS item_id, book, number, coalesce(string_agg(text, chr(10) ORDER BY sequence_num, k) FILTER (text <> ''), '') AS text,
    flatten(list(entries ORDER BY sequence_num, k)) AS entries, arg_min(sequence_num, (sequence_num, k)) AS first_page FROM handed WHERE number IS NOT NULL GROUP BY book, number
)"""


@query(_SEGMENTS + " SELECT item_id, book, number, text, array_to_string(entries, '|') AS entries, CAST(len(entries) AS INT) AS n_entries, first_page FROM items")
def c07_segment_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C05-C08, O03-O05, O14, A07, A13, T05."""
    found = segment.items(segment.segments(_pages(spark, sf_dir)))
    return found.withColumn("entries", F.array_join("entries", "|"))


@query(_SEGMENTS + " SELECT book, count(*) AS n_pages, count_if(mismatch) AS n_mismatch FROM (SELECT DISTINCT book, sequence_num, mismatch FROM handed) GROUP BY book")
def a14_page_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = segment.segments(_pages(spark, sf_dir)).select("book", "sequence_num", "mismatch").distinct()
    return pages.groupBy("book").agg(F.count(F.lit(1)).alias("n_pages"), F.count_if("mismatch").alias("n_mismatch"))


@query(f"SELECT hadith_id, loaded_at, {_search('regexp_replace(regexp_replace(arabic_full, ' + chr(39) + fragments.REMARKS + chr(39) + ', ' + chr(39) + chr(39) + '), ' + chr(39) + '(?s)^.*?(?:قال رسول الله|قال النبي|عن النبي[^:]{0,30}?قال|أنه قال|يقول)\\s*[:؛]?\\s*' + chr(39) + ', ' + chr(39) + chr(39) + ')')} AS cleaned FROM hadith")
def c11_clean_matn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "hadith").select("hadith_id", "loaded_at", fragments.clean_matn(F.col("arabic_full")).alias("cleaned"))


def _fragment(forward: bool, label: str, trigger: str) -> str:
    """One arm of the fragments of ``made``: cut at every trigger, then what follows (or precedes) each cut."""
    cut = f"'\\0' || {_CUT}" if forward else f"{_CUT} || '\\0'"
    near = f"left(array_to_string(p[k + 1 :], ''), {fragments.REACH})" if forward else f"right(array_to_string(p[: k], ''), {fragments.REACH})"
    piece = f"regexp_split_to_array({near}, '{fragments.STOP}')[1]" if forward else f"regexp_split_to_array({near}, '{fragments.START}')[-1]"
    return (
        f"SELECT tafsir_id, loaded_at, '{label}' AS label, regexp_replace({piece}, '^[{n.EDGES}]+|[{n.EDGES}]+$', '', 'g') AS fragment "
        f"FROM (SELECT *, unnest(range(1, len(p))) AS k FROM (SELECT tafsir_id, loaded_at, string_split(regexp_replace(made, '{trigger}', {cut}, 'g'), {_CUT}) AS p FROM made))"
    )


_FRAGMENTS = " UNION ALL ".join([*(_fragment(True, *x) for x in fragments.FORWARD), *(_fragment(False, *x) for x in fragments.BACKWARD)])


@query(
    "WITH made AS (SELECT tafsir_id, loaded_at, 'قال رسول الله ' || text_arabic || ' رواه مسلم في صحيحه' AS made FROM tafsir WHERE text_arabic IS NOT NULL) "
    f"SELECT * FROM ({_FRAGMENTS}) WHERE len(list_filter(regexp_split_to_array(fragment, '{_WHITE}+'), lambda w: w <> '')) >= {fragments.LEAST_WORDS} AND NOT regexp_matches(fragment, '{fragments.NOISE}')"
)
def c12_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C12, C13, P12, P13, N18."""
    made = F.concat(F.lit("قال رسول الله "), "text_arabic", F.lit(" رواه مسلم في صحيحه"))
    rows = table(spark, sf_dir, "tafsir").where("text_arabic is not null").select("tafsir_id", "loaded_at", F.explode(fragments.extract_fragments(made)).alias("f"))
    return rows.select("tafsir_id", "loaded_at", "f.label", "f.fragment")


@query()
def j14_fuzzy_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test items against every document, both in the search form and of five words or more."""
    items = fragments.comparable(table(spark, sf_dir, "eval_item"), "item_id", n.normalize_ar(F.col("text")), "query_id")
    corpus = fragments.comparable(table(spark, sf_dir, "documents"), "doc_id", n.normalize_ar(F.col("text")), "corpus_id")
    return fragments.fuzzy_top(items, corpus).withColumn("score", F.round("score", 1))


_LEMMAS = (
    "WITH w AS (SELECT DISTINCT surface_norm FROM word_occurrence WHERE surface_norm IS NOT NULL), bares AS (SELECT surface_norm, regexp_replace(surface_norm, '[\\x{064B}-\\x{065F}\\x{0670}\\x{0640}]', '', 'g') AS bare FROM w), "
    f"stripped AS (SELECT *, regexp_replace(bare, '{lemmatize.PROCLITIC}', '') AS stem FROM bares), stems AS (SELECT *, list_filter([regexp_replace(stem, '{lemmatize.ENCLITIC}', ''), stem], lambda x: length(x) >= 3) AS cut FROM stripped), "
    "lemmas AS (SELECT surface_norm, CASE WHEN bare <> '' THEN coalesce(cut[1], bare) END AS lemma, CAST(CASE WHEN bare <> '' THEN len(list_distinct(cut || [bare])) ELSE 0 END AS INT) AS n_candidates FROM stems) "
)


@query(_LEMMAS + "SELECT * FROM lemmas")
def x01_lemmatize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X01, O12."""
    found = lemmatize.lemmatize(table(spark, sf_dir, "word_occurrence"), "surface_norm")
    return found.select("surface_norm", F.get("candidates", F.lit(0)).alias("lemma"), F.size("candidates").alias("n_candidates"))


_PAGE = "'<html><body><div class=\"heading\"><h1 class=\"text-id\"> ' || coalesce(source, '') || ' </h1></div><p>' || replace(replace(replace(coalesce(text, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</p><!-- x --><b>{' || doc_id || '}</b> <a class=\"page-link\" href=\"?page_haditses=' || doc_id % 7 || '\">n</a><a class=\"page-link\" href=\"?page_haditses=' || doc_id % 5 || '\">m</a></body></html>'"


def _html(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.replace(F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    key = F.col("doc_id")
    page = F.concat(
        F.lit('<html><body><div class="heading"><h1 class="text-id"> '), F.coalesce("source", F.lit("")), F.lit(" </h1></div><p>"), text, F.lit("</p><!-- x --><b>{"), key.cast("string"),
        F.lit('}</b> <a class="page-link" href="?page_haditses='), (key % 7).cast("string"), F.lit('">n</a><a class="page-link" href="?page_haditses='), (key % 5).cast("string"), F.lit('">m</a></body></html>'),
    )
    return table(spark, sf_dir, "documents").select("doc_id", page.alias("html"))


@query("SELECT doc_id, " + _squeeze("coalesce(source, '') || ' ' || coalesce(text, '') || ' n m'") + f" AS cleaned, CAST(greatest(doc_id % 7, doc_id % 5) AS INT) AS last_page, coalesce(nullif(source, ''), 'tema ' || doc_id) AS heading FROM documents")
def n10_clean_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N10, N11, X03, C15, H04."""
    page = F.col("html")
    return _html(spark, sf_dir).select("doc_id", html.clean_html(page).alias("cleaned"), html.last_page(page).alias("last_page"), html.heading_or(page, "tema", F.col("doc_id")).alias("heading"))


@query("SELECT hadith_id, loaded_at, 'no ' || hadith_id AS title, trim(coalesce(arabic_full, '')) AS arabic, trim(coalesce(terjemah_id, '')) AS translation, coalesce(trim(grade), '') AS grade FROM hadith")
def h02_html_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H02, H03, N12, N13."""
    text = lambda c: F.coalesce(c, F.lit(""))
    block = F.concat(
        F.lit('<div class="hadits"><h2> no '), F.col("hadith_id").cast("string"), F.lit(" </h2><p>Sahih 12 : "), text("arabic_full"), F.lit("</p><p> 7: "), text("terjemah_id"),
        F.lit("</p><div><b> Grade </b> "), text("grade"), F.lit("</div></div>"),
    )
    rows = table(spark, sf_dir, "hadith").select("hadith_id", "loaded_at", F.explode(html.records(block)).alias("r"))
    return rows.select("hadith_id", "loaded_at", "r.*")


@query("SELECT o_custkey, list_sort(list(DISTINCT o_orderkey))::VARCHAR AS numbers FROM orders GROUP BY o_custkey")
def h01_html_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders of a customer as the cards of a page."""
    card = F.concat(F.lit('<div class="card" id="kitab'), F.col("o_orderkey").cast("string"), F.lit('"><a class="text-id">x</a></div>'))
    pages = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.concat(F.array_join(F.collect_list(card), ""), F.lit('<div class="card" id="kitabx"></div>')).alias("html"))
    numbers = F.array_distinct(F.transform(html.chapters(F.col("html")), lambda c: c["number"].cast("string")))
    return pages.select("o_custkey", F.concat(F.lit("["), F.array_join(numbers, ", "), F.lit("]")).alias("numbers"))


_VALID = "CASE WHEN NOT coalesce(regexp_matches(arabic_full, '[\\x{0600}-\\x{06FF}]'), false) THEN 'no Arabic letters' WHEN NOT coalesce(regexp_matches(terjemah_id, '[A-Za-z]'), false) THEN 'no Latin letters' END"


@query(f"SELECT hadith_id, loaded_at, {_VALID} AS reason FROM hadith WHERE {_VALID} IS NOT NULL")
def f16_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [(has_arabic(F.col("arabic_full")), "no Arabic letters"), (has_latin(F.col("terjemah_id")), "no Latin letters")]
    return split_valid(table(spark, sf_dir, "hadith"), checks)[1].select("hadith_id", "loaded_at", "reason")
