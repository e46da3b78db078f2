"""Node and edge schemas of the corpus graph, as DDL. Edge tables carry src_key and dst_key before their properties."""

from __future__ import annotations

from pyspark.sql.types import StructType

# label -> (key column, all properties)
NODES: dict[str, tuple[str, str]] = {
    "Surah": ("surah_id", "surah_id int, name_arabic string, name_latin string, revelation_place string, total_ayah int"),
    "Ayah": ("verse_key", "verse_key string, surah_id int, ayah_number int, text_arabic string, juz int, words_count int"),
    "Translation": ("verse_key", "verse_key string, language string, source string, text string"),
    "WordOccurrence": ("location", "location string, position int, surface_form string, source string, surface_norm string, n_candidates int, is_oov boolean, makna_id string, transliteration string, stem string"),
    "Root": ("root_id", "root_id long, arabic_trilateral string, english_trilateral string"),
    "Lemma": ("lemma_id", "lemma_id long, text string, pos string, frequency long, source string"),
    "TafsirLemma": ("lemma_id", "lemma_id string, text string"),
    "TafsirWordOccurrence": ("word_occurrence_id", "word_occurrence_id string, surface_form string, position_in_tafsir int"),
    "Book": ("book_id", "book_id string, title string"),
    "Tafsir": ("tafsir_id", "tafsir_id string, book_id string, text_arabic string, text_indonesia string, text_english string"),
    "Koleksi": ("koleksi_id", "koleksi_id int, name_folder string"),
    "Bab": ("bab_id", "bab_id int, bab_number int, name_arabic string, name_latin string"),
    "Hadith": ("hadith_id", "hadith_id long, nomor string, arabic_full string, arabic_matn string, english_matn string, grade string"),
    "Fatwa": ("fatwa_id", "fatwa_id string, book string, fatwa_number int, text_arabic string, n_footnotes int"),
}

# (type, source label, target label) -> properties
EDGES: dict[tuple[str, str, str], str] = {
    ("PART_OF", "Ayah", "Surah"): "",
    ("PART_OF", "Bab", "Koleksi"): "",
    ("PART_OF", "Hadith", "Bab"): "",
    ("HAS_TRANSLATION", "Ayah", "Translation"): "",
    ("OCCURS_IN", "WordOccurrence", "Ayah"): "",
    ("OCCURS_IN", "WordOccurrence", "Tafsir"): "",
    ("OCCURS_IN", "WordOccurrence", "Hadith"): "",
    ("HAS_WORD", "Hadith", "WordOccurrence"): "",
    ("HAS_ROOT", "WordOccurrence", "Root"): "",
    ("HAS_ROOT", "Lemma", "Root"): "",
    ("HAS_LEMMA", "WordOccurrence", "Lemma"): "rank int, frequency long",
    ("HAS_CANDIDATE", "WordOccurrence", "Lemma"): "rank int, frequency long",
    ("PART_OF_TAFSIR", "TafsirWordOccurrence", "Tafsir"): "",
    ("HAS_TAFSIR_LEMMA", "TafsirWordOccurrence", "TafsirLemma"): "",
    ("PART_OF_BOOK", "Tafsir", "Book"): "",
    ("INTERPRETS", "Tafsir", "Ayah"): "",
    ("RELATED_HADITH", "Tafsir", "Hadith"): "trigger_label string, fragment string, rank int, score double, source string",
    ("RELATED_HADITH", "Fatwa", "Hadith"): "",
    ("RELATED_QURAN", "Fatwa", "Ayah"): "",
}


def node_schema(label: str) -> StructType:
    return StructType.fromDDL(NODES[label][1])


def edge_schema(kind: str, source: str, target: str) -> StructType:
    key = {"int": "int", "long": "long"}
    ends = [(n, key.get(_key_type(label), "string")) for n, label in (("src_key", source), ("dst_key", target))]
    rest = EDGES[kind, source, target]
    return StructType.fromDDL(", ".join(f"{n} {t}" for n, t in ends) + (f", {rest}" if rest else ""))


def _key_type(label: str) -> str:
    key, ddl = NODES[label]
    return next(part.split(" ")[1] for part in ddl.split(", ") if part.split(" ")[0] == key)
