"""The layers of the corpus graph, its patterns and writes, and the sources and sinks, each as a query with values."""

from __future__ import annotations

import sqlite3
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qirtas.functions import html, segment
from qirtas.functions.normalize import ARABIC_DIGITS
from qirtas.graph import Graph, resilient
from qirtas.operators import joins, quality, resolve
from qirtas.plans import layers
from qirtas.plans.graph_queries import _DEDUP, CN, _lemma_sources, _roots, commerce, e03_lemma_root_edges
from qirtas.plans.layer_queries import corpus
from qirtas.plans.register import Register, table
from qirtas.plans.text_queries import _LEMMAS, _SEGMENTS, _WHEN, _pages, _squeeze, _strip
from qirtas.shared import shared_path
from qirtas.sources import files, web
from qirtas.sources.sqlite import read_sqlite
from qirtas.streaming import ingest as streams

register = Register()
query = register.query
WORD_LEMMA, LEMMA_ROOT = ("HAS_LEMMA", "WordOccurrence", "Lemma"), ("HAS_ROOT", "Lemma", "Root")

# the first delivery of records and words
_FIRST = """
WITH h AS (SELECT hadith_id, arg_min({'bab': bab_id, 'kol': koleksi_id, 'name': koleksi, 'nomor': nomor, 'matn': arabic_matn}, loaded_at) AS v FROM hadith WHERE hadith_id IS NOT NULL GROUP BY 1),
t AS (SELECT tafsir_id, arg_min({'book': book_id, 'keys': ayah_keys, 'text': text_arabic}, loaded_at) AS v FROM tafsir WHERE tafsir_id IS NOT NULL GROUP BY 1),
w AS (SELECT location, regexp_extract(location, '^(.*):[^:]*$', 1) AS parent, v FROM (SELECT location, arg_min({'source': source, 'top': top_lemma_id, 'freq': top_frequency, 'n': n_candidates, 'position': position, 'form': surface_form}, (loaded_at, occ_id)) AS v FROM word_occurrence WHERE location IS NOT NULL GROUP BY 1)),
b AS (SELECT v.bab AS bab_id, min(v.kol) AS koleksi_id FROM h WHERE v.bab IS NOT NULL GROUP BY 1),
k AS (SELECT v.kol AS koleksi_id, min(v.name) AS name_folder FROM h WHERE v.kol IS NOT NULL GROUP BY 1)
"""


# the verse layer and the dictionary


@query("SELECT surah_number AS surah_id, 'سورة ' || surah_number AS name_arabic, 'Surah ' || surah_number AS name_latin, CAST(count(*) AS INT) AS total_ayah FROM ayah GROUP BY surah_number")
def b01_surah(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B01, Q01."""
    return corpus(spark, sf_dir).nodes["Surah"].select("surah_id", "name_arabic", "name_latin", "total_ayah")


@query(f"SELECT verse_key, surah_number AS surah_id, ayah_number, {_strip("regexp_replace(text, '[\\x{0660}-\\x{0669}]', '', 'g')")} AS text_arabic, CAST((surah_number - 1) // 4 + 1 AS INT) AS juz, words_count FROM ayah")
def b02_ayah(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B02, Q02, Q03, J04."""
    return corpus(spark, sf_dir).nodes["Ayah"].select("verse_key", "surah_id", "ayah_number", "text_arabic", "juz", "words_count")


@query("SELECT 'Root' AS label, root_id AS id, arabic_trilateral AS text, english_trilateral AS extra FROM root UNION ALL SELECT 'Lemma', lemma_id, text, pos FROM lemma")
def b03_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B03, B09, Q04, Q05, Q12."""
    g = corpus(spark, sf_dir)
    roots = g.nodes["Root"].select(F.lit("Root").alias("label"), F.col("root_id").alias("id"), F.col("arabic_trilateral").alias("text"), F.col("english_trilateral").alias("extra"))
    return roots.union(g.nodes["Lemma"].select(F.lit("Lemma"), "lemma_id", "text", "pos"))


@query("SELECT verse_key AS src_key, 'ar' AS t_language, 'self' AS t_source, text AS t_text FROM ayah")
def b05_translations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B05, Q06."""
    return corpus(spark, sf_dir).match("HAS_TRANSLATION", "Ayah", "Translation", [], ["language", "source", "text"]).select("src_key", "t_language", "t_source", "t_text")


def _verse_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    """Words of the verses and their side tables: two meanings for even words, number rows among them, sounds for odd ones, stems for every third."""
    cut = table(spark, sf_dir, "ayah").select("surah_number", "ayah_number", "verse_key", F.posexplode(F.split("text", " ")).alias("p", "text")).withColumn("word", F.col("p") + 1)
    location = F.concat_ws(":", "verse_key", F.col("word").cast("string"))
    words = cut.select(location.alias("location"), F.col("surah_number").alias("surah"), F.col("ayah_number").alias("ayah"), "word", "text")
    number = F.col("word").cast("string")
    meant = F.when(F.col("word") % 2 == 0, F.array(F.concat(F.lit("a"), number), F.concat(F.lit("m"), number))).otherwise(F.array(F.concat(F.lit("("), number, F.lit(")"))))
    place = ["surah", "ayah", "word"]
    meanings = words.select(*place, F.explode(meant).alias("text"))
    sounds = words.where("word % 2 = 1").select(*place, F.concat(F.lit("t"), number).alias("text"))
    stems = words.where("word % 3 = 0").select("location", F.concat(F.lit("s"), number).alias("text"))
    return words, meanings, sounds, stems, words.select("location", F.col("surah").cast("long").alias("root_id")), words.select("location", (F.col("ayah") * 10 + F.col("word")).cast("long").alias("lemma_id"))


def _verse_words(spark: SparkSession, sf_dir: str) -> Graph:
    g = Graph().create_nodes("Ayah", table(spark, sf_dir, "ayah").select("verse_key"), "verse_key")
    g = g.create_nodes("Root", table(spark, sf_dir, "root").select("root_id"), "root_id").create_nodes("Lemma", table(spark, sf_dir, "lemma").select("lemma_id"), "lemma_id")
    return layers.verse_words(g, *_verse_tables(spark, sf_dir))


_VERSE_WORDS = """
WITH c AS (SELECT surah_number AS surah, ayah_number AS ayah, verse_key, CAST(k AS INT) AS word, w[k] AS text FROM (SELECT *, unnest(range(1, len(w) + 1)) AS k FROM (SELECT *, string_split(text, ' ') AS w FROM ayah WHERE text IS NOT NULL))),
v AS (SELECT *, verse_key || ':' || word AS location FROM c WHERE NOT regexp_matches(text, '^[\\s\\x{0660}-\\x{0669}]+$'))
"""


@query(_VERSE_WORDS + "SELECT location, word AS position, text AS surface_form, CASE WHEN word % 2 = 0 THEN 'm' || word END AS meaning, CASE WHEN word % 2 = 1 THEN 't' || word END AS transliteration, CASE WHEN word % 3 = 0 THEN 's' || word END AS stem FROM v")
def b04_verse_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B04, Q07-Q10, J01, J02, P05, P06."""
    return _verse_words(spark, sf_dir).nodes["WordOccurrence"].select("location", "position", "surface_form", "meaning", "transliteration", "stem")


@query(
    _VERSE_WORDS + "SELECT 'OCCURS_IN' AS kind, location AS src_key, verse_key AS dst_key FROM v UNION ALL SELECT 'HAS_ROOT', location, CAST(root_id AS VARCHAR) FROM v JOIN root ON root_id = surah "
    "UNION ALL SELECT 'HAS_LEMMA', location, CAST(lemma_id AS VARCHAR) FROM v JOIN lemma ON lemma_id = ayah * 10 + word"
)
def b04_verse_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links to roots and lemmas that exist, of words that exist."""
    g = _verse_words(spark, sf_dir)
    keys = ("OCCURS_IN", "WordOccurrence", "Ayah"), ("HAS_ROOT", "WordOccurrence", "Root"), WORD_LEMMA
    out = None
    for key in keys:
        part = g.edges_of(key[0]).select("kind", "src_key", "dst_key")
        out = part if out is None else out.union(part)
    return out


# commentary


def _commentary(spark: SparkSession, sf_dir: str) -> Graph:
    tafsir = layers.first_delivery(table(spark, sf_dir, "tafsir"), "tafsir_id").where("book_id is not null")
    books = tafsir.select("book_id").distinct().select("book_id", F.col("book_id").alias("title"), F.col("book_id").cast("string").alias("prefix"))
    heads = tafsir.select("book_id", F.col("tafsir_id").alias("ayah_key"), F.col("tafsir_id").alias("group_ayah_key"), "ayah_keys", F.col("text_arabic").alias("text"))
    ayah = table(spark, sf_dir, "ayah")
    side = ayah.select(F.col("verse_key").alias("key"), F.col("verse_key").alias("group_key"), "text")
    return layers.commentary_layer(Graph().create_nodes("Ayah", ayah.select("verse_key"), "verse_key"), books, heads, {"text_verses": side}, clean=False)


_BLOCKS = _FIRST + """, blocks AS (SELECT v.book || ':' || tafsir_id AS tafsir_id, v.book AS book_id, v.text AS text, list_filter(string_split(v.keys, ','), lambda x: x <> '') AS keys FROM t WHERE v.book IS NOT NULL AND v.text IS NOT NULL AND trim(v.text) <> ''),
named AS (SELECT tafsir_id, i, keys[i] AS key FROM (SELECT *, unnest(range(1, len(keys) + 1)) AS i FROM blocks))
"""


@query(
    _BLOCKS + ", g AS (SELECT tafsir_id, key, min(i) AS i, any_value(ayah.text) AS text FROM named JOIN ayah ON verse_key = key WHERE ayah.text IS NOT NULL GROUP BY 1, 2) "
    "SELECT tafsir_id, book_id, text AS text_arabic, (SELECT string_agg(g.text, chr(10) || chr(10) ORDER BY i) FROM g WHERE g.tafsir_id = blocks.tafsir_id) AS text_verses FROM blocks"
)
def b07_commentary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B06, B07, Q11, J15, A07."""
    return _commentary(spark, sf_dir).nodes["Tafsir"].select("tafsir_id", "book_id", "text_arabic", "text_verses")


@query(_BLOCKS + "SELECT 'PART_OF_BOOK' AS kind, tafsir_id AS src_key, book_id AS dst_key FROM blocks UNION ALL SELECT 'INTERPRETS', tafsir_id, key FROM named WHERE key IN (SELECT verse_key FROM ayah)")
def b07_commentary_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B07, C10, J10."""
    g = _commentary(spark, sf_dir)
    return g.edges_of("PART_OF_BOOK").union(g.edges_of("INTERPRETS")).select("kind", "src_key", "dst_key")


_TOKENS = (
    _BLOCKS + ", cut AS (SELECT tafsir_id, list_filter(list_transform(regexp_split_to_array(text, '[\\s\\x{0B}\\x{1C}-\\x{1F}\\x{85}\\p{Z}]+'), lambda x: regexp_replace(x, '^(?:[^\\p{L}\\p{N}_]|\\p{Nd})+|(?:[^\\p{L}\\p{N}_]|\\p{Nd})+$', '', 'g')), lambda x: x <> '') AS q FROM blocks), "
    "tok AS (SELECT tafsir_id, p AS position, q[p] AS form FROM (SELECT *, unnest(range(1, len(q) + 1)) AS p FROM cut)), "
    + _LEMMAS.replace("WITH w AS (SELECT DISTINCT surface_norm FROM word_occurrence WHERE surface_norm IS NOT NULL)", "forms AS (SELECT DISTINCT form AS surface_norm FROM tok)").replace("FROM w)", "FROM forms)")
    + ", placed AS (SELECT tafsir_id, position, form, lemma FROM tok JOIN lemmas ON form = surface_norm), firsts AS (SELECT lemma, min((tafsir_id, position)) AS at_ FROM placed WHERE lemma IS NOT NULL GROUP BY lemma), "
    "ids AS (SELECT lemma, 'L' || (row_number() OVER (ORDER BY at_) - 1) AS id FROM firsts) "
)


@query(_TOKENS + "SELECT tafsir_id || ':' || position AS src_key, form AS s_surface_form, id AS dst_key, ids.lemma AS t_text FROM placed JOIN ids ON placed.lemma = ids.lemma")
def b08_commentary_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of a commentary with its lemma and the lemma's new id."""
    g = layers.commentary_words(_commentary(spark, sf_dir), spark.createDataFrame([], "lemma_no long, text string"))
    return g.match("HAS_TAFSIR_LEMMA", "TafsirWordOccurrence", "TafsirLemma", ["surface_form"], ["text"]).select("src_key", "s_surface_form", "dst_key", "t_text")


register.sql["b08_commentary_counts"] = _TOKENS + """
SELECT 'node' AS what, 'Ayah' AS name, count(*) AS n FROM ayah UNION ALL SELECT 'node', 'Book', count(DISTINCT v.book) FROM t UNION ALL SELECT 'node', 'Tafsir', count(*) FROM blocks
UNION ALL SELECT 'node', 'TafsirWordOccurrence', count(*) FROM tok UNION ALL SELECT 'node', 'TafsirLemma', count(*) FROM firsts UNION ALL SELECT 'edge', 'PART_OF_BOOK:Tafsir:Book', count(*) FROM blocks
UNION ALL SELECT 'edge', 'INTERPRETS:Tafsir:Ayah', count(*) FROM named WHERE key IN (SELECT verse_key FROM ayah) UNION ALL SELECT 'edge', 'PART_OF_TAFSIR:TafsirWordOccurrence:Tafsir', count(*) FROM tok
UNION ALL SELECT 'edge', 'HAS_TAFSIR_LEMMA:TafsirWordOccurrence:TafsirLemma', count(*) FROM placed WHERE lemma IS NOT NULL"""


# hadith


@query(_FIRST + "SELECT hadith_id AS k0, v.bab AS k1, b.koleksi_id AS k2, name_folder, v.nomor AS nomor FROM h JOIN b ON v.bab = b.bab_id JOIN k ON b.koleksi_id = k.koleksi_id")
def b10_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hadith, chapter and collection, with their properties."""
    g = corpus(spark, sf_dir)
    rows = g.chain(("PART_OF", "Hadith", "Bab"), ("PART_OF", "Bab", "Koleksi"))
    rows = rows.join(g.nodes["Koleksi"].select(F.col("koleksi_id").alias("k2"), "name_folder"), "k2").join(g.nodes["Hadith"].select(F.col("hadith_id").alias("k0"), "nomor"), "k0")
    return rows.select("k0", "k1", "k2", "name_folder", "nomor")


def _words_with_candidates(spark: SparkSession, sf_dir: str) -> Graph:
    """Words with their best lemma, and as second candidate the lemma with the next id, where there is one."""
    words = layers.first_per(table(spark, sf_dir, "word_occurrence").where("location is not null"), ["location"], ["loaded_at", "occ_id"]).withColumn("parent_key", F.lit(None).cast("string"))
    more = words.where("n_candidates >= 2 and top_lemma_id is not null").select("location", F.explode(F.array(F.lit(1), F.lit(2))).alias("rank"), (F.col("top_lemma_id") + 1).alias("lemma_id"), F.col("top_frequency").alias("frequency"))
    return layers.record_words(Graph().create_nodes("Lemma", table(spark, sf_dir, "lemma").select("lemma_id"), "lemma_id"), words, more)


@query(_FIRST + "SELECT 'HAS_LEMMA' AS kind, location AS src_key, lemma_id AS dst_key, 1 AS rank, v.freq AS frequency FROM w JOIN lemma ON v.top = lemma_id UNION ALL SELECT 'HAS_CANDIDATE', location, lemma_id, 2, v.freq FROM w JOIN lemma ON v.top + 1 = lemma_id WHERE v.n >= 2")
def b11_word_lemmas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both kinds of lemma edges with their properties."""
    g = _words_with_candidates(spark, sf_dir)
    parts = [g.match(kind, "WordOccurrence", "Lemma", edge_columns=["rank", "frequency"]).select(F.lit(kind).alias("kind"), "src_key", "dst_key", "rank", "frequency") for kind in ("HAS_LEMMA", "HAS_CANDIDATE")]
    return parts[0].union(parts[1])


@query(_FIRST + "SELECT location, v.position AS position, v.form AS surface_form, v.source AS source FROM w")
def q14_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first delivery of every word."""
    return corpus(spark, sf_dir).nodes["WordOccurrence"].select("location", "position", "surface_form", "source")


# links


_REFERENCE = "'سورة\\s+([\\x{0600}-\\x{06FF}]+(?:\\s+[\\x{0600}-\\x{06FF}]+){0,2}?)\\s+الآية\\s+([\\x{0660}-\\x{0669}]+)'"
_NAMES = "['Bukhari', 'Muslim', 'Tirmizi', 'AbuDaud', 'Nesai', 'IbnMaja']"


# items of paged documents linked to hadith by collection and number and to verses by chapter name
register.sql["b13_opinion_links"] = (
    _SEGMENTS + ", " + _FIRST.strip().removeprefix("WITH ")
    + f""", noted AS (SELECT item_id, unnest(entries) AS entry FROM items),
cited AS (SELECT item_id, unnest(list_filter(list_transform(regexp_split_to_array(entry, '[،,]'), lambda x: {_strip('x')}), lambda x: x <> '')) AS c FROM noted),
y AS (SELECT *, CASE {_WHEN} END AS coll, regexp_extract(c, '\\(([\\p{{Nd}}\\s/\\x{{2013}}-]+)\\)', 1) AS g FROM cited),
z AS (SELECT *, CASE WHEN NOT regexp_matches(g, '[/\\x{{2013}}-]') THEN TRY_CAST(trim(translate(g, '{ARABIC_DIGITS}', '0123456789')) AS INT) END AS num FROM y),
nr AS (SELECT hadith_id, ({_NAMES})[v.kol % 6 + 1] AS coll, regexp_replace({_strip('v.nomor')}, '\\.0$', '') AS x FROM h),
nr2 AS (SELECT hadith_id, coll, coalesce(CASE WHEN regexp_matches(translate(x, '{ARABIC_DIGITS}', '0123456789'), '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') THEN CAST(TRY_CAST(trunc(TRY_CAST(translate(x, '{ARABIC_DIGITS}', '0123456789') AS DOUBLE)) AS BIGINT) AS VARCHAR) END, x, 'None') AS nr FROM nr),
one AS (SELECT coll, nr, min(hadith_id) AS hadith_id FROM nr2 GROUP BY 1, 2 HAVING count(*) = 1),
verse AS (SELECT item_id, regexp_extract(c, {_REFERENCE}, 1) AS name, TRY_CAST(translate(regexp_extract(c, {_REFERENCE}, 2), '{ARABIC_DIGITS}', '0123456789') AS INT) AS verse FROM z WHERE contains(c, 'سورة'))
SELECT DISTINCT 'RELATED_HADITH' AS kind, item_id AS fatwa_id, CAST(hadith_id AS VARCHAR) AS target FROM z JOIN one ON z.coll = one.coll AND CAST(num AS VARCHAR) = nr WHERE NOT contains(c, 'سورة')
UNION ALL SELECT DISTINCT 'RELATED_QURAN', item_id, verse_key FROM verse JOIN (VALUES (2, 'البقرة'), (3, 'آل عمران')) s(id, name) ON translate(verse.name, 'إأآ', 'ااا') = translate(s.name, 'إأآ', 'ااا') JOIN ayah ON verse_key = s.id || ':' || verse"""
)


@query(_SEGMENTS + " SELECT item_id AS fatwa_id, book, number AS fatwa_number, text AS text_arabic, CAST(len(entries) AS INT) AS n_footnotes FROM items")
def b12_opinions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B12, C08."""
    found = segment.items(segment.segments(_pages(spark, sf_dir)))
    return found.select(F.col("item_id").alias("fatwa_id"), "book", F.col("number").alias("fatwa_number"), F.col("text").alias("text_arabic"), F.col("n_entries").alias("n_footnotes"))


_MATN = _squeeze("regexp_replace(coalesce({}, ''), '[\\x{{064B}}-\\x{{065F}}\\x{{0670}}\\x{{06D6}}-\\x{{06ED}}]', '', 'g')".replace("{}", "@").replace("{{", "{").replace("}}", "}"))


@query(
    _FIRST + f", i AS (SELECT v.name AS coll, {_MATN.replace('@', 'v.matn')} AS key, min(hadith_id) AS hit FROM h GROUP BY 1, 2 HAVING count(*) = 1), "
    f"r AS (SELECT tafsir_id, trigger_label, rank, score, link_id, v.name AS coll, {_MATN.replace('@', "' ' || replace(v.matn, ' ', '  ')")} AS key FROM related_hadith r JOIN h ON r.hadith_id = h.hadith_id) "
    "SELECT tafsir_id AS src_key, hit AS dst_key, trigger_label, trigger_label AS fragment, arg_max(rank, link_id) AS rank, arg_max(score, link_id) AS score "
    "FROM r JOIN i ON r.coll = i.coll AND r.key = i.key WHERE tafsir_id IN (SELECT tafsir_id FROM t) GROUP BY tafsir_id, hit, trigger_label"
)
def b15_reviewed_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewed links name a hadith by its collection and text, in another spacing."""
    hadith = layers.first_delivery(table(spark, sf_dir, "hadith"), "hadith_id")
    tafsir = table(spark, sf_dir, "tafsir").where("tafsir_id is not null").select("tafsir_id").distinct()
    spaced = F.concat(F.lit(" "), F.replace("arabic_matn", F.lit(" "), F.lit("  ")))
    reviewed = table(spark, sf_dir, "related_hadith").join(hadith.select("hadith_id", F.col("koleksi").alias("collection"), spaced.alias("matn")), "hadith_id")
    reviewed = reviewed.select("tafsir_id", "collection", "matn", "trigger_label", F.col("trigger_label").alias("fragment"), "rank", "score", F.col("link_id").alias("seq"))
    g = Graph().create_nodes("Tafsir", tafsir, "tafsir_id").create_nodes("Hadith", hadith.select("hadith_id"), "hadith_id")
    g = layers.reviewed_links(g, reviewed, hadith.select("hadith_id", F.col("koleksi").alias("collection"), F.col("arabic_matn").alias("matn")))
    return g.edges["RELATED_HADITH", "Tafsir", "Hadith"].select("src_key", "dst_key", "trigger_label", "fragment", "rank", "score")


# entity resolution


_MERGED = (
    f"WITH rs AS (SELECT 0 AS r, root_id AS o, arabic_trilateral AS t FROM root UNION ALL SELECT 1, min(lemma_id), root FROM lemma WHERE root <> '' GROUP BY root), rk AS (SELECT coalesce({_DEDUP.format('t')}, chr(1)) AS k, min((r, o)) AS at_ FROM rs GROUP BY 1), roots AS (SELECT k, row_number() OVER (ORDER BY at_) - 1 AS id FROM rk), "
    "ls AS (SELECT 0 AS r, lemma_id AS o, text AS t FROM lemma WHERE lemma_id % 2 = 0 UNION ALL SELECT 1, min(occ_id), surface_norm FROM word_occurrence WHERE source = 'tafsir' AND surface_norm IS NOT NULL GROUP BY surface_norm UNION ALL SELECT 2, lemma_id, text FROM lemma), "
    f"lk AS (SELECT coalesce({_DEDUP.format('t')}, chr(1)) AS k, min((r, o)) AS at_ FROM ls GROUP BY 1), lemmas AS (SELECT k, row_number() OVER (ORDER BY at_) - 1 AS id FROM lk), "
    f"direct AS (SELECT DISTINCT lemmas.id AS lemma_id, roots.id AS root_id FROM lemma JOIN lemmas ON lemmas.k = coalesce({_DEDUP.format('text')}, chr(1)) JOIN roots ON roots.k = {_DEDUP.format('root')} WHERE root <> '') "
)


register.sql["e03_lemma_root_edges"] = _MERGED + "SELECT * FROM direct"


def _occurrence_links(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(location, old_id of the lemma) and (location, old_id of a root) of word occurrences: the lemma's own root, in every third occurrence another one."""
    words = table(spark, sf_dir, "word_occurrence").where("location is not null and top_lemma_id is not null")
    root_of = table(spark, sf_dir, "lemma").where("root is not null and root <> ''").groupBy("lemma_id").agg(F.min("root").alias("text"))
    by_text = _roots(spark, sf_dir)[1].select("text", "old_id")
    named = words.join(root_of.join(by_text, "text").withColumnRenamed("lemma_id", "top_lemma_id"), "top_lemma_id")
    other = by_text.agg(F.min("old_id").alias("other"))
    roots = named.join(F.broadcast(other)).select("location", F.when(F.col("occ_id") % 3 == 0, F.col("other")).otherwise(F.col("old_id")).alias("old_id"), "occ_id")
    return words.select("location", F.col("top_lemma_id").alias("old_id"), "occ_id"), roots


def _inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    lemma_words, root_words = _occurrence_links(spark, sf_dir)
    _, lemma_ids = resolve.merge_lemmas(_lemma_sources(spark, sf_dir), 2)
    _, root_ids = resolve.merge_roots(_roots(spark, sf_dir))
    to_lemma, to_root = lemma_ids.where("source_rank = 2").select("old_id", "lemma_id"), root_ids.where("source_rank = 1").select("old_id", "root_id")
    return resolve.inferred_edges(lemma_words, root_words, "location", ["occ_id"], to_lemma, to_root)


_INFERRED = _MERGED + (
    f", ro AS (SELECT lemma_id, min(root) AS text FROM lemma WHERE root <> '' GROUP BY 1), rn AS (SELECT root AS text, min(lemma_id) AS o FROM lemma WHERE root <> '' GROUP BY 1), "
    "rw AS (SELECT location, arg_max(CASE WHEN occ_id % 3 = 0 THEN (SELECT min(o) FROM rn) ELSE rn.o END, occ_id) AS ro FROM word_occurrence JOIN ro ON top_lemma_id = ro.lemma_id JOIN rn ON rn.text = ro.text WHERE location IS NOT NULL GROUP BY 1), "
    "lw AS (SELECT location, arg_max(top_lemma_id, occ_id) AS lo FROM word_occurrence WHERE location IS NOT NULL AND top_lemma_id IS NOT NULL GROUP BY 1), "
    f"li AS (SELECT DISTINCT lemma_id AS o, lemmas.id FROM lemma JOIN lemmas ON lemmas.k = coalesce({_DEDUP.format('text')}, chr(1))), ri AS (SELECT rn.o, roots.id FROM rn JOIN roots ON roots.k = {_DEDUP.format('rn.text')}), "
    "pairs AS (SELECT li.id AS lemma_id, ri.id AS root_id, lw.location FROM lw JOIN rw USING (location) JOIN li ON li.o = lo JOIN ri ON ri.o = ro), "
    "votes AS (SELECT lemma_id, root_id, count(*) AS votes, min(location) AS f FROM pairs GROUP BY 1, 2), "
    "inferred AS (SELECT lemma_id, root_id FROM (SELECT *, row_number() OVER (PARTITION BY lemma_id ORDER BY votes DESC, f, root_id) AS k FROM votes) WHERE k = 1) "
)


@query(_INFERRED + "SELECT lemma_id, root_id FROM inferred")
def e04_inferred_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lemma and root of each location aligned, the majority root of a lemma stands."""
    return _inferred(spark, sf_dir).select("lemma_id", "root_id")


@query(_INFERRED + "SELECT lemma_id, root_id FROM direct UNION SELECT lemma_id, root_id FROM inferred")
def e05_all_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E05, U01."""
    return e03_lemma_root_edges(spark, sf_dir).union(_inferred(spark, sf_dir).select("lemma_id", "root_id")).distinct()


@query(_FIRST + "SELECT 'PART_OF' AS kind, CAST(hadith_id AS VARCHAR) AS src_key, CAST(v.bab AS VARCHAR) AS dst_key FROM h JOIN b ON v.bab = b.bab_id UNION ALL SELECT 'PART_OF', CAST(bab_id AS VARCHAR), CAST(koleksi_id AS VARCHAR) FROM b WHERE koleksi_id IS NOT NULL")
def e08_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes and edges of one graph copied into another."""
    g = Graph().copy_from(corpus(spark, sf_dir), ["Koleksi", "Bab", "Hadith"], [("PART_OF", "Bab", "Koleksi"), ("PART_OF", "Hadith", "Bab")])
    return g.edges_of("PART_OF").select("kind", "src_key", "dst_key")


@query(
    _FIRST + "SELECT 'OCCURS_IN' AS kind, location AS src_key, parent AS dst_key, CAST(NULL AS INT) AS rank, v.position AS position, v.source AS source FROM w WHERE v.source = 'tafsir' AND parent IN (SELECT tafsir_id FROM t) OR v.source = 'hadith' AND parent IN (SELECT CAST(hadith_id AS VARCHAR) FROM h) "
    "UNION ALL SELECT 'HAS_LEMMA', location, CAST(lemma_id AS VARCHAR), 1, v.position, v.source FROM w JOIN lemma ON v.top = lemma_id WHERE v.source = 'tafsir'"
)
def e09_migrated_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of a hadith graph (HAS_WORD) and of a commentary graph (PART_OF_TAFSIR, HAS_TAFSIR_LEMMA) in one form."""
    words = layers.first_per(table(spark, sf_dir, "word_occurrence").where("location is not null"), ["location"], ["loaded_at", "occ_id"])
    last = F.length(F.substring_index("location", ":", -1))
    words = words.withColumn("parent", F.substring(F.col("location"), F.lit(1), F.length("location") - last - 1))
    hadith, tafsir = (layers.first_delivery(table(spark, sf_dir, n), k).select(k) for n, k in (("hadith", "hadith_id"), ("tafsir", "tafsir_id")))
    old = Graph().create_nodes("Hadith", hadith.withColumn("hadith_id", F.col("hadith_id").cast("string")), "hadith_id").create_nodes("WordOccurrence", words.where("source = 'hadith'").select("location", F.col("position").alias("position_in_hadith")), "location")
    old = old.create_edges("HAS_WORD", "Hadith", "WordOccurrence", words.where("source = 'hadith'").select(F.col("parent").alias("src_key"), F.col("location").alias("dst_key")))
    new = old.reverse("HAS_WORD", "Hadith", "WordOccurrence", "OCCURS_IN").rename_properties("WordOccurrence", {"position_in_hadith": "position"}, source="hadith")
    other = Graph().create_nodes("Tafsir", tafsir, "tafsir_id").create_nodes("Lemma", table(spark, sf_dir, "lemma").select("lemma_id"), "lemma_id")
    other = other.create_nodes("WordOccurrence", words.where("source = 'tafsir'").select("location", F.col("position").alias("position_in_tafsir"), "top_lemma_id"), "location")
    ends = words.where("source = 'tafsir'").select(F.col("location").alias("src_key"), "parent", "top_lemma_id")
    other = other.create_edges("PART_OF_TAFSIR", "WordOccurrence", "Tafsir", ends.select("src_key", F.col("parent").alias("dst_key"))).create_edges("HAS_TAFSIR_LEMMA", "WordOccurrence", "Lemma", ends.select("src_key", F.col("top_lemma_id").alias("dst_key")))
    other = other.rename_edges("PART_OF_TAFSIR", "WordOccurrence", "Tafsir", "OCCURS_IN").rename_edges("HAS_TAFSIR_LEMMA", "WordOccurrence", "Lemma", "HAS_LEMMA", rank=1).rename_properties("WordOccurrence", {"position_in_tafsir": "position"}, source="tafsir")

    def part(g: Graph, key: tuple[str, str, str], rank) -> DataFrame:
        rows = g.edges[key].select(F.lit(key[0]).alias("kind"), "src_key", F.col("dst_key").cast("string").alias("dst_key"), rank.cast("int").alias("rank"))
        return rows.join(g.nodes["WordOccurrence"].select(F.col("location").alias("src_key"), "position", "source"), "src_key").select("kind", "src_key", "dst_key", "rank", "position", "source")

    none = F.lit(None)
    out = part(new, ("OCCURS_IN", "WordOccurrence", "Hadith"), none).union(part(other, ("OCCURS_IN", "WordOccurrence", "Tafsir"), none))
    return out.union(part(other, WORD_LEMMA, F.col("rank")))


# patterns


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def g02_equal_property(spark: SparkSession, sf_dir: str) -> DataFrame:
    return commerce(spark, sf_dir).nodes_where("Customer", c_mktsegment="BUILDING").select("c_custkey", "c_name")


@query("SELECT c_custkey AS src_key, n_nationkey AS dst_key, c_name AS s_c_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1")
def g05_far_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return commerce(spark, sf_dir).match(*CN, ["c_name"], target_where={"n_regionkey": 1}).select("src_key", "dst_key", "s_c_name")


@query(_FIRST + "SELECT location AS k, parent AS k0, lemma_id AS k1 FROM w JOIN lemma ON v.top = lemma_id WHERE v.source = 'tafsir' AND parent IN (SELECT tafsir_id FROM t)")
def g07_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words with their commentary and their lemma."""
    return corpus(spark, sf_dir).star(("OCCURS_IN", "WordOccurrence", "Tafsir"), WORD_LEMMA)


@query(_FIRST + "SELECT DISTINCT parent AS tafsir_id, lemma_id FROM w JOIN lemma ON v.top = lemma_id WHERE v.source = 'tafsir' AND parent IN (SELECT tafsir_id FROM t)")
def g08_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g07_star(spark, sf_dir).select(F.col("k0").alias("tafsir_id"), F.col("k1").alias("lemma_id")).distinct()


@query("SELECT n_nationkey AS nation_id, n_name AS name, 'tpch' AS source FROM nation")
def g14_rename_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return commerce(spark, sf_dir).rename_properties("Nation", {"n_name": "name", "n_nationkey": "nation_id"}, source="tpch").nodes["Nation"].select("nation_id", "name", "source")


@query(_FIRST + ", d AS (SELECT arabic_trilateral AS root, min(root_id) AS root_id FROM root WHERE arabic_trilateral IS NOT NULL GROUP BY 1) SELECT location AS k0, lemma_id AS k1, d.root_id AS k2 FROM w JOIN lemma ON v.top = lemma_id JOIN d ON lemma.root = d.root WHERE lemma.root <> ''")
def g15_word_to_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).chain(WORD_LEMMA, LEMMA_ROOT)


# writes


@query(
    "WITH c(name, n) AS (SELECT 'Region', count(*) FROM region UNION ALL SELECT 'Nation', count(*) FROM nation UNION ALL SELECT 'Customer', count(*) FROM customer UNION ALL SELECT 'Order', count(*) FROM orders) "
    "SELECT 'no' AS answer, name, n FROM c UNION ALL SELECT ' Yes', name, n FROM c WHERE name <> 'Customer'"
)
def w17_clear_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label is cleared only where the answer means yes; its edges go with it."""
    g = commerce(spark, sf_dir)
    parts = [g.clear("Customer", answer=answer).counts().where("what = 'node'").select(F.lit(answer).alias("answer"), "name", "n") for answer in ("no", " Yes")]
    return parts[0].union(parts[1])


@query("SELECT 'again' AS step, name, n FROM (SELECT 'Region' AS name, count(*) AS n FROM region UNION ALL SELECT 'Nation', count(*) FROM nation UNION ALL SELECT 'PART_OF:Nation:Region', count(*) FROM nation)")
def w11_recreate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A graph is written, cleared, and written again in its place after the answer yes; then read back."""
    g, key = commerce(spark, sf_dir), ("PART_OF", "Nation", "Region")
    small = Graph({k: g.nodes[k] for k in ("Region", "Nation")}, {key: g.edges[key]}, {k: g.keys[k] for k in ("Region", "Nation")})
    path = shared_path(spark, "graph")
    small.save(path)
    if small.clear().nodes:
        raise AssertionError("a cleared graph has nodes")
    small.save(path, answer="yes")
    return Graph.load(spark, path, small.keys, [key]).counts().select(F.lit("again").alias("step"), "name", "n")


@query("SELECT l_orderkey * 10 + l_linenumber AS src_key, l_orderkey AS dst_key FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def w20_create_under(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes and their edge to a parent in one step; lines of other orders are not written."""
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    lines = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"), F.col("l_orderkey").alias("order_id"), "l_quantity")
    g = Graph().create_nodes("Order", urgent, "o_orderkey").create_under("Line", lines, "line_id", "LINE_OF", "Order", "order_id")
    return g.edges["LINE_OF", "Line", "Order"].select("src_key", "dst_key")


@query(
    "WITH o AS (SELECT l_partkey AS src_key, l_suppkey AS dst_key, min(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2), n AS (SELECT l_partkey AS src_key, l_suppkey AS dst_key, min(l_quantity) AS q FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2) "
    "SELECT src_key, dst_key, coalesce(o.q, n.q) AS q FROM o FULL JOIN n USING (src_key, dst_key) WHERE src_key IN (SELECT p_partkey FROM part) AND dst_key IN (SELECT s_suppkey FROM supplier)"
)
def w21_merge_keeps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An edge that is there keeps its properties."""
    g = Graph().create_nodes("Part", table(spark, sf_dir, "part"), "p_partkey").create_nodes("Supplier", table(spark, sf_dir, "supplier"), "s_suppkey")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("src_key"), F.col("l_suppkey").alias("dst_key"), F.col("l_quantity").alias("q"), "l_returnflag")
    for some in (rows.where("l_returnflag = 'R'"), rows.where("l_returnflag <> 'R'")):
        g = g.merge_edges("SOLD", "Part", "Supplier", some.drop("l_returnflag"))
    return g.edges["SOLD", "Part", "Supplier"].select("src_key", "dst_key", "q")


# checks


@query("SELECT name, n, n AS expected, true AS ok FROM (SELECT 'PLACED_BY:Order:Customer' AS name, count(*) AS n FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'Order', count(*) FROM orders)")
def d04_untouched_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another layer's counts are the same before and after a layer is added."""
    g = commerce(spark, sf_dir)
    after = g.create_nodes("Part", table(spark, sf_dir, "part"), "p_partkey").reverse(*CN, "HAS_CUSTOMER")
    expected = g.counts().where("name in ('Order', 'PLACED_BY:Order:Customer')").select("name", F.col("n").alias("expected"))
    return quality.check_counts(after.counts(), expected)


@query(_FIRST + "SELECT 'HAS_LEMMA' AS kind, 'frequency' AS property, count(*) AS n, count_if(v.freq IS NULL) AS n_missing FROM w JOIN lemma ON v.top = lemma_id UNION ALL SELECT 'HAS_LEMMA', 'rank', count(*), 0 FROM w JOIN lemma ON v.top = lemma_id")
def d07_rank_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges without a property that each must have."""
    rows = _words_with_candidates(spark, sf_dir).edges[WORD_LEMMA]
    return quality.missing_properties(rows, ["rank", "frequency"]).select(F.lit("HAS_LEMMA").alias("kind"), "property", "n", "n_missing")


@query("SELECT source, count(*) AS total, count_if(is_oov = 1) AS hits, round(count_if(is_oov = 1) / count(*), 6) AS part FROM word_occurrence GROUP BY source")
def d08_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D08, A04."""
    return quality.ratio(table(spark, sf_dir, "word_occurrence"), F.col("is_oov") == 1, ["source"])


# pages


@query(
    "WITH p AS (SELECT bab_id AS unit, hadith_id % 4 + 1 AS page, hadith_id, coalesce(terjemah_id, '') AS text FROM hadith WHERE bab_id IS NOT NULL) "
    "SELECT unit, CAST(page AS INT) AS page, 'tema ' || unit AS heading, 'no ' || hadith_id AS title, trim(text) AS translation FROM p WHERE page <= unit % 3 + 1"
)
def h06_topic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a topic up to the last that its navigation names, and the records on them."""
    rows = table(spark, sf_dir, "hadith").where("bab_id is not null")
    text = F.coalesce("terjemah_id", F.lit(""))
    page = F.concat(
        F.lit('<div class="hadits"><h2>no '), F.col("hadith_id").cast("string"), F.lit("</h2><p>x</p><p>"), text, F.lit('</p></div><a class="page-link" href="?page_haditses='),
        (F.col("bab_id") % 3 + 1).cast("string"), F.lit('">n</a>'),
    )
    pages = rows.select(F.col("bab_id").alias("unit"), (F.col("hadith_id") % 4 + 1).cast("int").alias("page"), page.alias("html"))
    kept = streams.until_last_page(pages.withColumn("last", html.last_page(F.col("html"))), "unit", "page", "last")
    found = kept.select("unit", "page", html.heading_or(F.col("html"), "tema", F.col("unit")).alias("heading"), F.explode(html.records(F.col("html"))).alias("r"))
    return found.select("unit", "page", "heading", "r.title", "r.translation")


_ATTEMPTS = "WITH a AS (SELECT o_custkey AS unit, o_orderkey AS page, 'u/' || o_custkey || '/' || o_orderkey AS url, k AS attempt, CASE WHEN (o_orderkey + k) % 4 = 0 THEN '<h1>' || o_orderpriority || '</h1>' END AS html FROM orders, range(1, 5) r(k)) "


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four attempts at a page for every order, of which some fail."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", F.explode(F.array(*map(F.lit, range(1, 5)))).alias("attempt"))
    page = F.when((F.col("o_orderkey") + F.col("attempt")) % 4 == 0, F.concat(F.lit("<h1>"), "o_orderpriority", F.lit("</h1>")))
    path = shared_path(spark, "fetched")
    rows.select(F.concat_ws("/", F.lit("u"), F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")).alias("url"), "attempt", page.alias("html")).write.parquet(path)
    return web.read_fetched(spark, path)


@query(_ATTEMPTS + "SELECT url, regexp_replace(min(html) FILTER (attempt <= 3), '<[^>]*>', '', 'g') AS text, CAST(min(attempt) FILTER (attempt <= 3 AND html IS NOT NULL) AS INT) AS attempt, coalesce(bool_or(html IS NOT NULL AND attempt <= 3), false) AS loaded FROM a GROUP BY url")
def s16_loaded_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched pages, at most three attempts each, parsed."""
    pages = web.loaded_pages(_attempts(spark, sf_dir))
    return pages.select("url", html.visible_text(F.col("html")).alias("text"), "attempt", "loaded")


@query(_ATTEMPTS + ", l AS (SELECT unit, page, coalesce(bool_or(html IS NOT NULL AND attempt <= 3), false) AS loaded FROM a GROUP BY 1, 2) SELECT unit, page FROM l x WHERE NOT EXISTS (SELECT 1 FROM l y WHERE y.unit = x.unit AND y.page <= x.page AND NOT y.loaded)")
def s15_until_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a customer before the first that could not be loaded."""
    parts = F.split("url", "/")
    pages = web.loaded_pages(_attempts(spark, sf_dir)).select(F.get(parts, F.lit(1)).cast("long").alias("unit"), F.get(parts, F.lit(2)).cast("long").alias("page"), "loaded")
    return web.until_failure(pages, "unit", "page").select("unit", "page")


@query("SELECT n_nationkey, n_name, 3 AS attempts FROM nation")
def w05_resilient_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A write whose first two attempts fail half-way."""
    rows, path = table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), shared_path(spark, "resilient")

    def write(attempt: int) -> None:
        rows.limit(5 if attempt < 2 else 25).write.mode("overwrite").parquet(path)
        if attempt < 2:
            raise ConnectionError("lost")

    attempts = resilient(write, 5, lambda _: None)
    return spark.read.parquet(path).withColumn("attempts", F.lit(attempts))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey = (SELECT max(c_custkey) FROM customer)")
def w13_indexed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A graph written in the order of its keys; a key is found by the statistics of the files."""
    g, path = commerce(spark, sf_dir), shared_path(spark, "indexed")
    Graph({"Customer": g.nodes["Customer"]}, {}, g.keys).save(path, indexed=True)
    top = table(spark, sf_dir, "customer").agg(F.max("c_custkey")).first()[0]
    return Graph.load(spark, path, {"Customer": "c_custkey"}, []).nodes_where("Customer", c_custkey=top).select("c_custkey", "c_name")


# sources and sinks


def _database(spark: SparkSession, sf_dir: str) -> str:
    """Nations (25 rows) as an SQLite file in the shared folder."""
    path = shared_path(spark, "sqlite").removeprefix("file://")
    Path(path).mkdir(parents=True)
    with sqlite3.connect(f"{path}/nation.db") as link:
        link.execute("CREATE TABLE nation (n_nationkey INTEGER, n_name TEXT, n_regionkey INTEGER)")
        link.executemany("INSERT INTO nation VALUES (?, ?, ?)", [tuple(r) for r in table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey").collect()])
    return f"{path}/nation.db"


@query("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey >= 2")
def s01_sqlite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table read in ranges, with the filter handed to SQLite."""
    return read_sqlite(spark, _database(spark, sf_dir), "nation", partition_column="n_nationkey", partitions=4).where("n_regionkey >= 2").select("n_nationkey", "n_name")


@query("SELECT n_regionkey, count(*) AS n FROM nation GROUP BY 1")
def s02_sqlite_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query that SQLite runs."""
    return read_sqlite(spark, _database(spark, sf_dir), "SELECT n_regionkey, count(*) AS n FROM nation GROUP BY 1")


@query("SELECT 'b' AS book, doc_id AS sequence_num, text AS body, row_number() OVER (ORDER BY doc_id) - 1 AS page FROM documents")
def s03_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of a book, numbered in their order."""
    pages = files.read_pages(spark, f"{sf_dir}/documents.parquet", "b").select("book", F.col("doc_id").alias("sequence_num"), F.col("text").alias("body"))
    return resolve.dense_ids(pages, ["sequence_num"], "page").select("book", "sequence_num", "body", "page")


@query("SELECT CAST(lemma_id AS VARCHAR) AS lemma_id, text FROM lemma WHERE text IS NOT NULL UNION ALL SELECT CAST(item_id AS VARCHAR), text FROM eval_item WHERE text IS NOT NULL")
def s04_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows appended twice to files with a header and a byte order mark, read back."""
    path = shared_path(spark, "csv")
    files.append_csv(table(spark, sf_dir, "lemma").where("text is not null").select("lemma_id", "text"), path)
    files.append_csv(table(spark, sf_dir, "eval_item").where("text is not null").select(F.col("item_id").alias("lemma_id"), "text"), path)
    return files.read_csv(spark, path).select("lemma_id", "text")


@query("SELECT link_id, rank, score FROM related_hadith WHERE score IS NOT NULL AND rank IS NOT NULL")
def s05_typed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns read with their types."""
    path = shared_path(spark, "csv")
    files.append_csv(table(spark, sf_dir, "related_hadith").where("score is not null and rank is not null").select("link_id", "rank", "score"), path)
    return files.read_csv(spark, path, "link_id long, rank int, score double")


@query("SELECT DISTINCT CAST(bab_id AS VARCHAR) AS key FROM hadith WHERE bab_id IS NOT NULL")
def s07_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units marked as done, in two runs with a blank line between, and read back."""
    path = shared_path(spark, "done")
    units = table(spark, sf_dir, "hadith").where("bab_id is not null").select(F.col("bab_id").cast("string").alias("key"))
    files.mark_done(units, path)
    files.mark_done(units.limit(1).select(F.lit(" ").alias("key")).union(units.where("key < '5'")), path)
    return files.read_progress(spark, path)


@query("SELECT c_custkey, title FROM customer JOIN (VALUES ('BUILDING', 'b'), ('MACHINERY', 'm')) r(segment, title) ON c_mktsegment = segment")
def s12_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small fixed table, joined."""
    names = files.registry(spark, [("BUILDING", "b"), ("MACHINERY", "m")], "c_mktsegment string, title string")
    return table(spark, sf_dir, "customer").join(F.broadcast(names), "c_mktsegment").select("c_custkey", "title")


@query("WITH r AS (SELECT (row_number() OVER (ORDER BY o_orderkey) - 1) // 500 AS chunk, o_orderkey FROM orders) SELECT chunk, count(*) AS n, min(o_orderkey) AS first, max(o_orderkey) AS last FROM r GROUP BY chunk")
def o15_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of 500 rows in their order."""
    rows = resolve.dense_ids(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], "i")
    return rows.groupBy(F.floor(F.col("i") / 500).alias("chunk")).agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last"))


@query("SELECT top_lemma_id, count(DISTINCT source) AS n_sources, count(*) AS n FROM word_occurrence WHERE top_lemma_id IS NOT NULL GROUP BY 1 ORDER BY n DESC, top_lemma_id LIMIT 5")
def o16_report_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five rows of a report."""
    rows = table(spark, sf_dir, "word_occurrence").where("top_lemma_id is not null").groupBy("top_lemma_id").agg(F.countDistinct("source").alias("n_sources"), F.count(F.lit(1)).alias("n"))
    return rows.orderBy(F.desc("n"), "top_lemma_id").limit(5)


@query("SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'")
def j12_remap_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose key has no new one are dropped."""
    mapping = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return joins.null_safe_remap(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), mapping, "o_custkey", "c_name", strict=False).select("o_orderkey", "c_name")
