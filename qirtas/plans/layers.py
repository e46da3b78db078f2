"""B01-B17, E08, E09. Layer builders: source tables in, Graph out. Every source is a DataFrame with the columns named in the docstring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qirtas.functions import citations, fragments, html, lemmatize, segment
from qirtas.functions.normalize import key_list, norm_alef, normalize_ar, normalize_matn, normalize_nomor, range_bounds, strip_verse_number, tokenize
from qirtas.graph import Graph, first_per
from qirtas.operators.joins import expand_ranges, fallback_lookup, last_wins_lookup, merge_sides, unique_match
from qirtas.operators.resolve import next_ids


def _edge(rows: DataFrame, source: str, target: str, *more) -> DataFrame:
    return rows.select(F.col(source).alias("src_key"), F.col(target).alias("dst_key"), *more).where("src_key is not null and dst_key is not null")


def verse_layer(chapters: DataFrame, verses: DataFrame, juz: DataFrame, translation: DataFrame) -> Graph:
    """B01, B02, B05. chapters(id, name_arabic, name_simple, revelation_place, verses_count), verses(surah_number, ayah_number,
    verse_key, words_count, text), juz(juz_number, verse_mapping as JSON), translation(ayah_key, text, language, source)."""
    surah = chapters.select(F.col("id").alias("surah_id"), "name_arabic", F.col("name_simple").alias("name_latin"), "revelation_place", F.col("verses_count").alias("total_ayah"))
    maps = juz.select("juz_number", F.explode(F.from_json("verse_mapping", "map<string,string>")).alias("surah", "range"))
    places = expand_ranges(maps, *range_bounds(F.col("range")), "ayah_number").select(F.col("surah").cast("int").alias("surah_number"), "ayah_number", F.col("juz_number").alias("juz"))
    ayah = last_wins_lookup(verses, places.withColumn("_o", F.col("juz")), ["surah_number", "ayah_number"], ["_o"])
    nodes = ayah.select("verse_key", F.col("surah_number").alias("surah_id"), "ayah_number", strip_verse_number(F.col("text")).alias("text_arabic"), "juz", "words_count")
    g = Graph().create_nodes("Surah", surah, "surah_id").create_nodes("Ayah", nodes, "verse_key")
    g = g.create_edges("PART_OF", "Ayah", "Surah", _edge(nodes, "verse_key", "surah_id"))
    rendered = translation.select(F.col("ayah_key").alias("verse_key"), "language", "source", "text").join(nodes.select("verse_key"), "verse_key", "left_semi")
    g = g.create_nodes("Translation", rendered, "verse_key")
    return g.create_edges("HAS_TRANSLATION", "Ayah", "Translation", rendered.select(F.col("verse_key").alias("src_key"), F.col("verse_key").alias("dst_key")).distinct())


def verse_words(g: Graph, words: DataFrame, meanings: DataFrame, sounds: DataFrame, stems: DataFrame, root_words: DataFrame, lemma_words: DataFrame) -> Graph:
    """B04. words(location, surah, ayah, word, text), meanings and sounds(surah, ayah, word, text), stems(location, text),
    root_words(location, root_id), lemma_words(location, lemma_id). Rows that are only a verse number go; lookups take the last row a key."""
    real = words.where(~F.coalesce("text", F.lit("")).rlike("(?U)^[\\s\\x{0660}-\\x{0669}]+$"))
    place = ["surah", "ayah", "word"]
    for name, extra in (("meaning", meanings), ("transliteration", sounds)):
        kept = extra.where(~F.coalesce("text", F.lit("")).rlike("^\\([0-9]+\\)$")).select(*place, F.col("text").alias(name))
        real = last_wins_lookup(real, kept.withColumn("_o", F.col(name)), place, ["_o"])
    real = last_wins_lookup(real, stems.select("location", F.col("text").alias("stem")).withColumn("_o", F.col("stem")), ["location"], ["_o"])
    nodes = real.select("location", F.col("word").alias("position"), F.col("text").alias("surface_form"), "meaning", "transliteration", "stem", F.concat_ws(":", F.col("surah").cast("string"), F.col("ayah").cast("string")).alias("verse_key"))
    g = g.create_nodes("WordOccurrence", nodes.drop("verse_key"), "location")
    g = g.create_edges("OCCURS_IN", "WordOccurrence", "Ayah", _edge(nodes, "location", "verse_key"))
    for kind, target, links, key in (("HAS_ROOT", "Root", root_words, "root_id"), ("HAS_LEMMA", "Lemma", lemma_words, "lemma_id")):
        if target in g.nodes:
            g = g.create_edges(kind, "WordOccurrence", target, _edge(links, "location", key))
    return g


def dictionary_layer(roots: DataFrame, lemmas: DataFrame) -> Graph:
    """B03, B09. roots(root_id, arabic_trilateral, english_trilateral), lemmas(lemma_id, text, pos, frequency, source, root text)."""
    g = Graph().create_nodes("Root", roots, "root_id").create_nodes("Lemma", lemmas.drop("root"), "lemma_id")
    by_text = roots.where("arabic_trilateral is not null").groupBy(F.col("arabic_trilateral").alias("root")).agg(F.min("root_id").alias("root_id"))
    links = lemmas.where("root is not null and root <> ''").join(by_text, "root")
    return g.create_edges("HAS_ROOT", "Lemma", "Root", _edge(links, "lemma_id", "root_id"))


def commentary_layer(g: Graph, books: DataFrame, heads: DataFrame, sides: dict[str, DataFrame], clean: bool = True) -> Graph:
    """B06, B07. books(book_id, title, prefix), heads(book_id, ayah_key, group_ayah_key, ayah_keys, text as HTML),
    sides: language -> (key, group_key, text). Only head rows with text count. ``g`` has the verses."""
    rows = heads.where("ayah_key = group_ayah_key and text is not null and trim(text) <> ''").join(books.select("book_id", "prefix"), "book_id")
    text = html.clean_html(F.col("text")) if clean else F.col("text")
    blocks = rows.select(F.concat_ws(":", "prefix", "group_ayah_key").alias("tafsir_id"), "book_id", text.alias("text_arabic"), key_list(F.col("ayah_keys")).alias("keys"))
    nodes = blocks.drop("keys")
    for name, side in sides.items():
        merged = merge_sides(blocks.select(F.col("tafsir_id").alias("block_key"), "keys"), side, ["group_key", "text"])
        nodes = nodes.join(merged.select(F.col("block_key").alias("tafsir_id"), F.col("text").alias(name)), "tafsir_id", "left")
    g = g.create_nodes("Book", books.select("book_id", "title"), "book_id").create_nodes("Tafsir", nodes, "tafsir_id")
    g = g.create_edges("PART_OF_BOOK", "Tafsir", "Book", _edge(nodes, "tafsir_id", "book_id"))
    return g.create_edges("INTERPRETS", "Tafsir", "Ayah", _edge(blocks.select("tafsir_id", F.explode("keys").alias("verse_key")), "tafsir_id", "verse_key"))


def commentary_words(g: Graph, known: DataFrame, using: lemmatize.Lemmatizer = lemmatize.affix_stripper) -> Graph:
    """B08. Words of every Tafsir, their first lemma candidate, and new TafsirLemma ids after those of ``known`` (lemma_no, text)."""
    words = g.nodes["Tafsir"].select("tafsir_id", F.posexplode(tokenize(F.col("text_arabic"))).alias("p", "surface_form")).withColumn("position", F.col("p") + 1)
    found = lemmatize.lemmatize(words, "surface_form", using).select("surface_form", F.get("candidates", F.lit(0)).alias("text"))
    placed = words.join(found, "surface_form", "left")
    new = next_ids(placed.where("text is not null").select("text", "tafsir_id", "position"), known.select("text", "lemma_no"), "text", ["tafsir_id", "position"], "lemma_no").select("text", "lemma_no")
    lemmas = known.select("text", "lemma_no").union(new).select(F.concat(F.lit("L"), F.col("lemma_no").cast("string")).alias("lemma_id"), "text")
    nodes = placed.select(F.concat_ws(":", "tafsir_id", F.col("position").cast("string")).alias("word_occurrence_id"), "surface_form", F.col("position").alias("position_in_tafsir"), "tafsir_id", "text")
    g = g.create_nodes("TafsirWordOccurrence", nodes.drop("tafsir_id", "text"), "word_occurrence_id").create_nodes("TafsirLemma", lemmas, "lemma_id")
    g = g.create_edges("PART_OF_TAFSIR", "TafsirWordOccurrence", "Tafsir", _edge(nodes, "word_occurrence_id", "tafsir_id"))
    return g.create_edges("HAS_TAFSIR_LEMMA", "TafsirWordOccurrence", "TafsirLemma", _edge(nodes.join(lemmas, "text"), "word_occurrence_id", "lemma_id"))


def hadith_layer(g: Graph, collections: DataFrame, chapters: DataFrame, hadith: DataFrame) -> Graph:
    """B10. collections(koleksi_id, name_folder), chapters(bab_id, koleksi_id, ...), hadith(hadith_id, bab_id, ...)."""
    g = g.create_nodes("Koleksi", collections, "koleksi_id").create_nodes("Bab", chapters.drop("koleksi_id"), "bab_id").create_nodes("Hadith", hadith.drop("bab_id"), "hadith_id")
    g = g.create_edges("PART_OF", "Bab", "Koleksi", _edge(chapters, "bab_id", "koleksi_id"))
    return g.create_edges("PART_OF", "Hadith", "Bab", _edge(hadith, "hadith_id", "bab_id"))


def record_words(g: Graph, words: DataFrame, candidates: DataFrame | None = None) -> Graph:
    """B11, E09. words(location, source, parent_key, position, surface_form, surface_norm, n_candidates, is_oov 0/1, top_lemma_id, top_frequency):
    OCCURS_IN their record, HAS_LEMMA rank 1; candidates(location, rank, lemma_id, frequency): HAS_CANDIDATE from rank 2."""
    nodes = words.select("location", "position", "surface_form", "source", "surface_norm", "n_candidates", F.col("is_oov").cast("boolean").alias("is_oov"))
    g = g.create_nodes("WordOccurrence", nodes, "location")
    for label, source, cast in (("Hadith", "hadith", "long"), ("Tafsir", "tafsir", "string")):
        if label in g.nodes:
            rows = words.where(F.col("source") == source).withColumn("parent_key", F.col("parent_key").try_cast(cast))
            g = g.create_edges("OCCURS_IN", "WordOccurrence", label, _edge(rows, "location", "parent_key"))
    top = _edge(words, "location", "top_lemma_id", F.lit(1).alias("rank"), F.col("top_frequency").alias("frequency"))
    g = g.create_edges("HAS_LEMMA", "WordOccurrence", "Lemma", top)
    if candidates is not None:
        g = g.create_edges("HAS_CANDIDATE", "WordOccurrence", "Lemma", _edge(candidates.where("rank >= 2"), "location", "lemma_id", "rank", "frequency"))
    return g


def numbered_index(hadith: DataFrame) -> DataFrame:
    """J08. (collection, nr, hadith_id) of hadith(hadith_id, collection, nomor)."""
    return hadith.select("collection", normalize_nomor(F.col("nomor")).alias("nr"), "hadith_id")


def opinion_layer(g: Graph, pages: DataFrame, numbered: DataFrame, chapters: DataFrame) -> Graph:
    """B12-B14. pages(book, sequence_num, body, footnotes), numbered(collection, nr, hadith_id), chapters(surah_id, name).

    Items become Fatwa nodes; their footnotes link to the one hadith of a collection and number, and to verses that exist. ``g`` has both.
    """
    found = segment.items(segment.segments(pages))
    nodes = found.select(F.col("item_id").alias("fatwa_id"), "book", F.col("number").alias("fatwa_number"), F.col("text").alias("text_arabic"), F.col("n_entries").alias("n_footnotes"))
    cited = found.select(F.col("item_id").alias("fatwa_id"), F.explode("entries").alias("entry")).select("fatwa_id", F.explode(citations.split_citations(F.col("entry"))).alias("c"))
    judged = cited.withColumn("k", citations.classify(F.col("c")))
    g = g.create_nodes("Fatwa", nodes, "fatwa_id")
    reports = judged.where("k.category = 'hadith_with_number'").select("fatwa_id", "k.collection", F.col("k.number").cast("string").alias("nr"))
    g = g.merge_edges("RELATED_HADITH", "Fatwa", "Hadith", _edge(unique_match(reports, numbered, ["collection", "nr"], "hadith_id"), "fatwa_id", "hadith_id"))
    verses = judged.where("k.category = 'quran'").withColumn("v", citations.parse_verse_reference(F.col("c"))).select("fatwa_id", F.col("v.name").alias("name"), "v.verse").where("name is not null")
    named = fallback_lookup(verses, chapters, "name", "surah_id", norm_alef)
    keyed = named.withColumn("verse_key", F.when(F.col("surah_id").isNotNull(), F.concat_ws(":", F.col("surah_id").cast("string"), F.col("verse").cast("string"))))
    return g.merge_edges("RELATED_QURAN", "Fatwa", "Ayah", _edge(keyed, "fatwa_id", "verse_key"))


def reviewed_links(g: Graph, reviewed: DataFrame, hadith: DataFrame) -> Graph:
    """B15. reviewed(tafsir_id, collection, matn, trigger_label, fragment, rank, score, seq) against hadith(hadith_id, collection, matn):
    linked where the normalised text stands once in the collection; of equal links the last sets rank and score."""
    index = hadith.select("collection", normalize_matn(F.col("matn")).alias("key"), "hadith_id")
    rows = unique_match(reviewed.withColumn("key", normalize_matn(F.col("matn"))), index, ["collection", "key"], "hadith_id")
    links = _edge(rows, "tafsir_id", "hadith_id", "trigger_label", "fragment", "rank", "score", "seq")
    return g.merge_edges_set("RELATED_HADITH", "Tafsir", "Hadith", links, ["seq"], ["trigger_label", "fragment"])


def candidate_links(tafsir: DataFrame, hadith: DataFrame, k: int = 3, least: float = 80.0) -> DataFrame:
    """B16. tafsir(tafsir_id, text_arabic), hadith(hadith_id, matn) -> (tafsir_id, trigger_label, fragment, hadith_id, score, rank)."""
    found = tafsir.select("tafsir_id", F.explode(fragments.extract_fragments(F.col("text_arabic"))).alias("f"))
    found = found.select("tafsir_id", F.col("f.label").alias("trigger_label"), F.col("f.fragment").alias("fragment"))
    pieces = found.withColumn("text", F.explode(F.array(normalize_ar(F.col("fragment"))))).where(fragments.n_words(F.col("text")) >= fragments.LEAST_WORDS)
    corpus = fragments.comparable(hadith, "hadith_id", fragments.clean_matn(F.col("matn")), "corpus_id")
    best = fragments.fuzzy_join(pieces, corpus, k, least).withColumn("score", F.round("score", 1))
    return pieces.join(best, "text").select("tafsir_id", "trigger_label", "fragment", F.col("corpus_id").alias("hadith_id"), "score", "rank")


def scored_links(g: Graph, links: DataFrame, source: str, order: Sequence[str]) -> Graph:
    """B17. links(tafsir_id, hadith_id, trigger_label, rank, score, ...): one edge a pair, the last sets its properties and source."""
    named = ["trigger_label", "rank", "score"]
    rows = _edge(links, "tafsir_id", "hadith_id", *named, *(c for c in order if c not in named), F.lit(source).alias("source"))
    return g.merge_edges_set("RELATED_HADITH", "Tafsir", "Hadith", rows, list(order))


def first_delivery(rows: DataFrame, key: str) -> DataFrame:
    """The earliest delivery of every key."""
    return first_per(rows.where(F.col(key).isNotNull()), [key], ["loaded_at"])
