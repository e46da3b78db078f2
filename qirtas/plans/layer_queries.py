"""The corpus graph of the project's tables, opinion linking, and streamed ingest, as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qirtas.functions.citations import COLLECTIONS
from qirtas.functions.fragments import STOP
from qirtas.graph import Graph
from qirtas.operators.joins import not_seen
from qirtas.plans import layers
from qirtas.plans.register import Register, table
from qirtas.plans.text_queries import _pages
from qirtas.shared import shared_path, write_shared
from qirtas.sources.files import seen_keys
from qirtas.streaming import ingest as streams

register = Register()
query = register.query


def corpus(spark: SparkSession, sf_dir: str) -> Graph:
    """Verses, dictionary, hadith, commentary, words and links; of a record delivered twice the first delivery."""
    read = lambda name: table(spark, sf_dir, name)
    ayah, hadith, tafsir = read("ayah"), layers.first_delivery(read("hadith"), "hadith_id"), layers.first_delivery(read("tafsir"), "tafsir_id")
    chapters = ayah.groupBy(F.col("surah_number").alias("id")).agg(F.count(F.lit(1)).cast("int").alias("verses_count")).select("id", F.concat(F.lit("سورة "), F.col("id").cast("string")).alias("name_arabic"), F.concat(F.lit("Surah "), F.col("id").cast("string")).alias("name_simple"), F.lit(None).cast("string").alias("revelation_place"), "verses_count")
    juz = ayah.groupBy("surah_number").agg(F.max("ayah_number").alias("n")).select((F.floor((F.col("surah_number") - 1) / 4) + 1).cast("int").alias("juz_number"), F.to_json(F.create_map(F.col("surah_number").cast("string"), F.concat(F.lit("1-"), F.col("n").cast("string")))).alias("verse_mapping"))
    rendered = ayah.select(F.col("verse_key").alias("ayah_key"), "text", F.lit("ar").alias("language"), F.lit("self").alias("source"))
    g = layers.verse_layer(chapters, ayah, juz, rendered)
    d = layers.dictionary_layer(read("root"), read("lemma").select("lemma_id", "text", "pos", "frequency", "source", "root"))
    g = Graph(g.nodes | d.nodes, g.edges | d.edges, g.keys | d.keys)
    bab = hadith.where("bab_id is not null").groupBy("bab_id").agg(F.min("koleksi_id").alias("koleksi_id"))
    g = layers.hadith_layer(g, hadith.where("koleksi_id is not null").groupBy("koleksi_id").agg(F.min("koleksi").alias("name_folder")), bab, hadith.select("hadith_id", "bab_id", "nomor", "arabic_full", "arabic_matn", "grade"))
    books = tafsir.where("book_id is not null").select("book_id").distinct().select("book_id", F.col("book_id").alias("title"))
    g = g.create_nodes("Book", books, "book_id").create_nodes("Tafsir", tafsir.select("tafsir_id", "book_id", "text_arabic", "text_indonesia", "text_english"), "tafsir_id")
    g = g.create_edges("PART_OF_BOOK", "Tafsir", "Book", layers._edge(tafsir, "tafsir_id", "book_id"))
    keys = F.array_distinct(F.filter(F.transform(F.split("ayah_keys", ","), lambda x: F.trim(x)), lambda x: x != ""))
    g = g.create_edges("INTERPRETS", "Tafsir", "Ayah", layers._edge(tafsir.select("tafsir_id", F.explode(keys).alias("k")), "tafsir_id", "k"))
    words = layers.first_per(read("word_occurrence").where("location is not null"), ["location"], ["loaded_at", "occ_id"])
    last = F.length(F.substring_index("location", ":", -1))
    g = layers.record_words(g, words.withColumn("parent_key", F.substring(F.col("location"), F.lit(1), F.length("location") - last - 1)))
    return layers.scored_links(g, read("related_hadith"), "related", ["loaded_at", "link_id"])


_CORPUS = """
WITH h AS (SELECT hadith_id, arg_min(bab_id, loaded_at) AS bab_id, arg_min(koleksi_id, loaded_at) AS koleksi_id FROM hadith GROUP BY 1),
t AS (SELECT tafsir_id, arg_min(book_id, loaded_at) AS book_id, arg_min(coalesce(ayah_keys, ''), loaded_at) AS ayah_keys FROM tafsir GROUP BY 1),
w AS (SELECT location, v[1] AS source, v[2] AS top FROM (SELECT location, arg_min((source, coalesce(top_lemma_id, -1)), (loaded_at, occ_id)) AS v FROM word_occurrence GROUP BY 1)),
p AS (SELECT *, regexp_extract(location, '^(.*):[^:]*$', 1) AS parent FROM w)
SELECT 'node' AS what, 'Surah' AS name, count(DISTINCT surah_number) AS n FROM ayah
UNION ALL SELECT 'node', 'Ayah', count(*) FROM ayah
UNION ALL SELECT 'node', 'Translation', count(*) FROM ayah
UNION ALL SELECT 'node', 'Root', count(*) FROM root
UNION ALL SELECT 'node', 'Lemma', count(*) FROM lemma
UNION ALL SELECT 'node', 'Koleksi', count(DISTINCT koleksi_id) FROM h
UNION ALL SELECT 'node', 'Bab', count(DISTINCT bab_id) FROM h
UNION ALL SELECT 'node', 'Hadith', count(*) FROM h
UNION ALL SELECT 'node', 'Book', count(DISTINCT book_id) FROM t
UNION ALL SELECT 'node', 'Tafsir', count(*) FROM t
UNION ALL SELECT 'node', 'WordOccurrence', count(*) FROM w
UNION ALL SELECT 'edge', 'PART_OF:Ayah:Surah', count(*) FROM ayah
UNION ALL SELECT 'edge', 'HAS_TRANSLATION:Ayah:Translation', count(*) FROM ayah
UNION ALL SELECT 'edge', 'HAS_ROOT:Lemma:Root', count(*) FROM lemma WHERE root <> '' AND root IN (SELECT arabic_trilateral FROM root WHERE arabic_trilateral IS NOT NULL)
UNION ALL SELECT 'edge', 'PART_OF:Bab:Koleksi', count(DISTINCT bab_id) FROM h
UNION ALL SELECT 'edge', 'PART_OF:Hadith:Bab', count(bab_id) FROM h
UNION ALL SELECT 'edge', 'PART_OF_BOOK:Tafsir:Book', count(book_id) FROM t
UNION ALL SELECT 'edge', 'INTERPRETS:Tafsir:Ayah', count(*) FROM (SELECT DISTINCT tafsir_id, trim(k) AS k FROM (SELECT tafsir_id, unnest(string_split(ayah_keys, ',')) AS k FROM t)) WHERE k IN (SELECT verse_key FROM ayah)
UNION ALL SELECT 'edge', 'OCCURS_IN:WordOccurrence:Hadith', count(*) FROM p WHERE source = 'hadith' AND parent IN (SELECT CAST(hadith_id AS VARCHAR) FROM h)
UNION ALL SELECT 'edge', 'OCCURS_IN:WordOccurrence:Tafsir', count(*) FROM p WHERE source = 'tafsir' AND parent IN (SELECT tafsir_id FROM t)
UNION ALL SELECT 'edge', 'HAS_LEMMA:WordOccurrence:Lemma', count(*) FROM w WHERE top IN (SELECT lemma_id FROM lemma)
UNION ALL SELECT 'edge', 'RELATED_HADITH:Tafsir:Hadith', count(*) FROM (SELECT DISTINCT tafsir_id, hadith_id FROM related_hadith) WHERE tafsir_id IN (SELECT tafsir_id FROM t) AND hadith_id IN (SELECT hadith_id FROM h)"""


@query(_CORPUS)
def b01_corpus_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes and edges of every layer, counted. The layers have queries with values of their own."""
    return corpus(spark, sf_dir).counts()


@query()
def b08_commentary_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every commentary as a block of its book, with the rendered text of its verses, its words and their lemmas."""
    tafsir = layers.first_delivery(table(spark, sf_dir, "tafsir"), "tafsir_id").where("book_id is not null")
    books = tafsir.select("book_id").distinct().select("book_id", F.col("book_id").alias("title"), F.col("book_id").cast("string").alias("prefix"))
    heads = tafsir.select("book_id", F.col("tafsir_id").alias("ayah_key"), F.col("tafsir_id").alias("group_ayah_key"), "ayah_keys", F.col("text_arabic").alias("text"))
    ayah = table(spark, sf_dir, "ayah")
    side = ayah.select(F.col("verse_key").alias("key"), F.col("verse_key").alias("group_key"), "text")
    g = layers.commentary_layer(Graph().create_nodes("Ayah", ayah.select("verse_key"), "verse_key"), books, heads, {"text_verses": side})
    return layers.commentary_words(g, spark.createDataFrame([], "lemma_no long, text string")).counts()


@query(
    "WITH k AS (SELECT tafsir_id AS src_key, hadith_id AS dst_key, arg_max((trigger_label, rank, score), (loaded_at, link_id)) AS v FROM related_hadith WHERE tafsir_id IN (SELECT tafsir_id FROM tafsir) AND hadith_id IN (SELECT hadith_id FROM hadith) GROUP BY 1, 2) "
    "SELECT src_key, dst_key, v[1] AS trigger_label, v[2] AS rank, v[3] AS score, 'related' AS source FROM k"
)
def b17_related_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda name: table(spark, sf_dir, name)
    g = Graph().create_nodes("Tafsir", read("tafsir").select("tafsir_id").distinct(), "tafsir_id").create_nodes("Hadith", read("hadith").select("hadith_id").distinct(), "hadith_id")
    rows = layers.scored_links(g, read("related_hadith"), "related", ["loaded_at", "link_id"]).edges["RELATED_HADITH", "Tafsir", "Hadith"]
    return rows.select("src_key", "dst_key", "trigger_label", "rank", "score", "source")


@query()
def b13_opinion_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of paged documents linked to hadith by collection and number and to verses by chapter name."""
    hadith = layers.first_delivery(table(spark, sf_dir, "hadith"), "hadith_id")
    names = F.array(*(F.lit(v) for v in dict.fromkeys(v for _, v in COLLECTIONS)))
    numbered = layers.numbered_index(hadith.select("hadith_id", F.get(names, (F.col("koleksi_id") % 6).cast("int")).alias("collection"), "nomor"))
    ayah = table(spark, sf_dir, "ayah")
    chapters = spark.createDataFrame([(2, "البقرة"), (3, "آل عمران")], "surah_id int, name string")
    g = Graph().create_nodes("Hadith", hadith.select("hadith_id"), "hadith_id").create_nodes("Ayah", ayah.select("verse_key"), "verse_key")
    g = layers.opinion_layer(g, _pages(spark, sf_dir), numbered, chapters)
    parts = [g.edges[k].select(F.lit(k[0]).alias("kind"), F.col("src_key").alias("fatwa_id"), F.col("dst_key").cast("string").alias("target")) for k in (("RELATED_HADITH", "Fatwa", "Hadith"), ("RELATED_QURAN", "Fatwa", "Ayah"))]
    return parts[0].union(parts[1])


@query()
def b16_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commentaries that quote a hadith behind a trigger, searched in every hadith text, for every link."""
    hadith = layers.first_delivery(table(spark, sf_dir, "hadith"), "hadith_id").where("arabic_matn is not null")
    asked = table(spark, sf_dir, "related_hadith").join(hadith.select("hadith_id", "arabic_matn"), "hadith_id")
    quoted = F.concat(F.lit("قال النبي "), F.regexp_replace("arabic_matn", STOP, " "))
    quoting = asked.select(F.concat_ws("/", "tafsir_id", F.col("link_id").cast("string")).alias("tafsir_id"), quoted.alias("text_arabic"))
    return layers.candidate_links(quoting, hadith.select("hadith_id", F.col("arabic_matn").alias("matn")))


@query("SELECT event_id, user_id, event_type, value FROM events WHERE value IS NOT NULL AND value >= 0")
def t01_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a file stream, each id once, bad values to quarantine; run twice, the second run finds nothing new."""
    base = shared_path(spark, "ingest")
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    for _ in range(2):
        stream = streams.once_per_key(streams.stream_files(spark, f"{sf_dir}/events.parquet*", ddl), ["event_id"])
        streams.ingest(stream, f"{base}/good", f"{base}/bad", f"{base}/state", [(F.col("value") >= 0, "negative value")])
    return spark.read.parquet(f"{base}/good").select("event_id", "user_id", "event_type", "value")


@query("SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS n_distinct FROM events GROUP BY event_type")
def t02_seen_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and distinct ids a type; the scan of seen keys is ``s06_unseen_keys``."""
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("n_distinct"))


@query(
    "WITH e AS (SELECT user_id, event_type, CAST(floor(value / 20) AS BIGINT) AS band, event_id <= (SELECT (min(event_id) + max(event_id)) / 2 FROM events WHERE user_id IS NOT NULL) AS early FROM events WHERE user_id IS NOT NULL) "
    "SELECT DISTINCT user_id, event_type, band FROM e l WHERE NOT early AND NOT EXISTS (SELECT 1 FROM e s WHERE s.early AND s.user_id = l.user_id AND s.event_type = l.event_type AND s.band = l.band)"
)
def s06_unseen_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of events of a user (type, and band of values) in the later half of the events (by event_id) that no earlier event of the user has, once each."""
    events = table(spark, sf_dir, "events").where("user_id is not null").withColumn("band", F.floor(F.col("value") / 20))
    half = events.agg(((F.min("event_id") + F.max("event_id")) / 2).alias("half"))
    key = ["user_id", "event_type", "band"]
    halves = events.join(F.broadcast(half)).select(*key, (F.col("event_id") <= F.col("half")).alias("early"))  # one row
    seen = write_shared(seen_keys(halves.where("early"), *key), "seen")
    return not_seen(halves.where("not early").select(*key), seen, key)


@query("WITH p AS (SELECT o_custkey AS unit, CAST(o_orderkey % 5 + 1 AS INT) AS page, o_orderpriority AS key FROM orders), f AS (SELECT unit, key, min(page) AS page FROM p GROUP BY 1, 2), g AS (SELECT DISTINCT unit, page FROM f), r AS (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY page) AS k FROM g), l AS (SELECT unit, count(*) FILTER (page = k) AS last FROM r GROUP BY unit) SELECT unit, key, page FROM f JOIN l USING (unit) WHERE page <= last")
def h05_pages_until_nothing_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a unit count until one brings no new key."""
    pages = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("unit"), (F.col("o_orderkey") % 5 + 1).cast("int").alias("page"), F.col("o_orderpriority").alias("key"))
    return streams.until_nothing_new(pages, "unit", "page", "key").select("unit", "key", "page")


@query("SELECT o_custkey, bool_and(o_totalprice > 1000) AS completed, count(*) AS n FROM orders GROUP BY o_custkey")
def h07_completed_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_custkey", (F.col("o_totalprice") > 1000).alias("loaded"))
    return streams.completed_units(rows, "o_custkey")
