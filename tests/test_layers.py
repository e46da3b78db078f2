import pathlib

from qirtas.graph import Graph
from qirtas.plans import layer_queries, layers


def test_verse_and_words(spark):
    chapters = spark.createDataFrame([(1, "ا", "A", "m", 2)], "id int, name_arabic string, name_simple string, revelation_place string, verses_count int")
    verses = spark.createDataFrame([(1, 1, "1:1", 2, "نور ١"), (1, 2, "1:2", 1, "x ٢"), (9, 1, "9:1", 1, None)], "surah_number int, ayah_number int, verse_key string, words_count int, text string")
    juz = spark.createDataFrame([(1, '{"1": "1-1"}'), (2, '{"1": "2"}')], "juz_number int, verse_mapping string")
    translation = spark.createDataFrame([("1:1", "light", "id", "s"), ("7:7", "none", "id", "s")], "ayah_key string, text string, language string, source string")
    g = layers.verse_layer(chapters, verses, juz, translation)
    assert {(r.verse_key, r.text_arabic, r.juz) for r in g.nodes["Ayah"].collect()} == {("1:1", "نور", 1), ("1:2", "x", 2), ("9:1", None, None)}
    assert g.edges["PART_OF", "Ayah", "Surah"].count() == 2
    assert g.edges["HAS_TRANSLATION", "Ayah", "Translation"].count() == 1

    d = layers.dictionary_layer(
        spark.createDataFrame([(1, "ن و ر", None), (2, "ن و ر", "n-w-r")], "root_id long, arabic_trilateral string, english_trilateral string"),
        spark.createDataFrame([(5, "نور", None, 1, None, "ن و ر"), (6, "x", None, 1, None, "")], "lemma_id long, text string, pos string, frequency long, source string, root string"),
    )
    assert [tuple(r) for r in d.edges["HAS_ROOT", "Lemma", "Root"].collect()] == [(5, 1)]
    g = Graph(g.nodes | d.nodes, g.edges | d.edges, g.keys | d.keys)
    words = spark.createDataFrame([("1:1:1", 1, 1, 1, "نور"), ("1:1:2", 1, 1, 2, "١"), ("1:1:3", 1, 1, 3, None)], "location string, surah int, ayah int, word int, text string")
    place = "surah int, ayah int, word int, text string"
    meanings = spark.createDataFrame([(1, 1, 1, "(1)"), (1, 1, 1, "light")], place)
    g = layers.verse_words(
        g, words, meanings, spark.createDataFrame([], place), spark.createDataFrame([("1:1:1", "st")], "location string, text string"),
        spark.createDataFrame([("1:1:1", 1), ("9:9:9", 1)], "location string, root_id long"), spark.createDataFrame([("1:1:1", 5)], "location string, lemma_id long"),
    )
    assert {(r.location, r.meaning, r.stem) for r in g.nodes["WordOccurrence"].collect()} == {("1:1:1", "light", "st"), ("1:1:3", None, None)}
    assert g.edges["HAS_ROOT", "WordOccurrence", "Root"].count() == 1
    assert g.chain(("HAS_LEMMA", "WordOccurrence", "Lemma"), ("HAS_ROOT", "Lemma", "Root")).first().k2 == 1


def test_commentary(spark):
    g = Graph().create_nodes("Ayah", spark.createDataFrame([("1:1",), ("1:2",)], "verse_key string"), "verse_key")
    books = spark.createDataFrame([("b", "B", "pre")], "book_id string, title string, prefix string")
    heads = spark.createDataFrame([("b", "1:1", "1:1", "1:1,1:2,,7:7", "<p>نور {١} علم</p>"), ("b", "1:2", "1:1", "1:1", "no head"), ("b", "1:2", "1:2", "1:2", " "), ("b", "1:3", "1:3", "1:3", "{1}")], "book_id string, ayah_key string, group_ayah_key string, ayah_keys string, text string")
    side = spark.createDataFrame([("1:1", "g", "one"), ("1:2", "h", "two")], "key string, group_key string, text string")
    g = layers.commentary_layer(g, books, heads, {"text_indonesia": side})
    assert {(r.tafsir_id, r.text_arabic, r.text_indonesia) for r in g.nodes["Tafsir"].collect()} == {("pre:1:1", "نور علم", "one\n\ntwo"), ("pre:1:3", None, None)}
    assert g.edges["INTERPRETS", "Tafsir", "Ayah"].count() == 2
    g = layers.commentary_words(g, spark.createDataFrame([(4, "نور")], "lemma_no long, text string"))
    assert {r.word_occurrence_id for r in g.nodes["TafsirWordOccurrence"].collect()} == {"pre:1:1:1", "pre:1:1:2"}
    assert {tuple(r) for r in g.nodes["TafsirLemma"].collect()} == {("L4", "نور"), ("L5", "علم")}
    assert g.edges["HAS_TAFSIR_LEMMA", "TafsirWordOccurrence", "TafsirLemma"].count() == 2


def test_opinions(spark):
    g = Graph().create_nodes("Hadith", spark.createDataFrame([(1,), (2,), (3,)], "hadith_id long"), "hadith_id")
    g = g.create_nodes("Ayah", spark.createDataFrame([("2:5",)], "verse_key string"), "verse_key")
    pages = spark.createDataFrame([("b", 1, "فتوى رقم (١) س (١) (٢) (٣) (٤)", "(١) البخاري (7)، مسلم (9)\r(٢) سورة البقرة الآية ٥\r(٣) سورة البقره الآية ٥\r(٤) البخاري (٧)")], "book string, sequence_num long, body string, footnotes string")
    hadith = spark.createDataFrame([(1, "Bukhari", "7.0"), (2, "Muslim", "9"), (3, "Muslim", "9.0")], "hadith_id long, collection string, nomor string")
    g = layers.opinion_layer(g, pages, layers.numbered_index(hadith), spark.createDataFrame([(2, "البقرة")], "surah_id int, name string"))
    assert [tuple(r) for r in g.edges["RELATED_HADITH", "Fatwa", "Hadith"].collect()] == [("b:1", 1)]
    assert [tuple(r) for r in g.edges["RELATED_QURAN", "Fatwa", "Ayah"].collect()] == [("b:1", "2:5")]


def test_links(spark):
    text = "من صام رمضان ايمانا واحتسابا غفر له ما تقدم من ذنبه"
    tafsir = spark.createDataFrame([("t1", "قال رسول الله " + text.replace("غفر", "غفرت") + ". كذا"), ("t2", None)], "tafsir_id string, text_arabic string")
    hadith = spark.createDataFrame([(1, text), (2, "كلام اخر لا يشبه ما قيل هناك ابدا"), (3, None)], "hadith_id long, matn string")
    got = layers.candidate_links(tafsir, hadith).collect()
    assert [(r.tafsir_id, r.trigger_label, r.hadith_id, r["rank"]) for r in got] == [("t1", "QALA_RASUL", 1, 1)] and got[0].score > 90
    g = Graph().create_nodes("Tafsir", tafsir, "tafsir_id").create_nodes("Hadith", hadith, "hadith_id")
    once = layers.scored_links(g, layers.candidate_links(tafsir, hadith), "x", ["rank"])
    assert once.edges["RELATED_HADITH", "Tafsir", "Hadith"].first().source == "x"
    reviewed = spark.createDataFrame([("t1", "c", "مِن  صام", "l", "f", 1, 1.0, 1), ("t1", "c", "من صام", "l", "f", 2, 2.0, 2), ("t2", "c", "شك", "l", "f", 1, 1.0, 3)], "tafsir_id string, collection string, matn string, trigger_label string, fragment string, rank int, score double, seq int")
    index = spark.createDataFrame([(1, "c", "من صام"), (2, "c", "شك"), (3, "c", "شَك")], "hadith_id long, collection string, matn string")
    rows = layers.reviewed_links(g, reviewed, index).edges["RELATED_HADITH", "Tafsir", "Hadith"].collect()
    assert [(r.src_key, r.dst_key, r["rank"]) for r in rows] == [("t1", 1, 2)]


def test_hadith_and_words(spark):
    g = layers.hadith_layer(
        Graph(), spark.createDataFrame([(1, "k")], "koleksi_id int, name_folder string"), spark.createDataFrame([(3, 1), (4, 9)], "bab_id int, koleksi_id int"),
        spark.createDataFrame([(10, 3, "1"), (11, None, "2")], "hadith_id long, bab_id int, nomor string"),
    )
    assert g.edges["PART_OF", "Hadith", "Bab"].count() == 1 and g.edges["PART_OF", "Bab", "Koleksi"].count() == 1
    g = g.create_nodes("Lemma", spark.createDataFrame([(7, "x")], "lemma_id long, text string"), "lemma_id")
    words = spark.createDataFrame([("10:1", "hadith", "10", 1, "w", "w", 1, 0, 7, 5), ("99:1", "hadith", "99", 1, "w", None, 0, 1, None, None)], "location string, source string, parent_key string, position int, surface_form string, surface_norm string, n_candidates int, is_oov int, top_lemma_id long, top_frequency long")
    candidates = spark.createDataFrame([("10:1", 1, 7, 5), ("10:1", 2, 7, 4)], "location string, rank int, lemma_id long, frequency long")
    g = layers.record_words(g, words, candidates)
    assert g.edges["OCCURS_IN", "WordOccurrence", "Hadith"].count() == 1
    assert [tuple(r) for r in g.edges["HAS_LEMMA", "WordOccurrence", "Lemma"].collect()] == [("10:1", 7, 1, 5)]
    assert [r["rank"] for r in g.edges["HAS_CANDIDATE", "WordOccurrence", "Lemma"].collect()] == [2]


def test_the_rest_does_not_need_the_text_operators():
    root = pathlib.Path(layers.__file__).parents[1]
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "qirtas.llm" not in path.read_text(), path


def test_queries_and_sql_have_the_same_names():
    from qirtas.plans import registry

    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_commentary_counts_read_the_whole_table(spark, tmp_path):
    tafsir = [("t1", 1, "1:1,1:2", "نور الله", 1), ("t1", 1, "1:1", "نور", 2), ("t2", 1, "1:2", "قال الله نور", 1), ("t3", 2, None, "  ", 1), ("t4", 2, "9:9", "علم", 1)]
    spark.createDataFrame(tafsir, "tafsir_id string, book_id int, ayah_keys string, text_arabic string, n int").selectExpr("* except (n)", "timestamp_seconds(n) AS loaded_at").write.parquet(f"{tmp_path}/tafsir.parquet")
    spark.createDataFrame([("1:1", "a"), ("1:2", "b")], "verse_key string, text string").write.parquet(f"{tmp_path}/ayah.parquet")
    got = {(r.what, r.name): r.n for r in layer_queries.b08_commentary_counts(spark, str(tmp_path)).collect()}
    assert (got["node", "Book"], got["node", "Tafsir"], got["node", "TafsirWordOccurrence"]) == (2, 3, 6)
    assert got["edge", "INTERPRETS:Tafsir:Ayah"] == 3 and got["edge", "PART_OF_TAFSIR:TafsirWordOccurrence:Tafsir"] == 6


def test_unseen_keys(spark, tmp_path):
    rows = [(0, 1, "a"), (1, 2, "a"), (2, 2, "a"), (7, 2, "a"), (8, 3, "a"), (9, 3, "a"), (10, 4, "a"), (6, None, "a"), (8, 2, "b"), (9, 1, None)]
    spark.createDataFrame([(*r, 5.0) for r in rows] + [(10, 2, "a", 25.0)], "event_id long, user_id long, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    assert {tuple(r) for r in layer_queries.s06_unseen_keys(spark, str(tmp_path)).collect()} == {(3, "a", 0), (4, "a", 0), (2, "b", 0), (1, None, 0), (2, "a", 1)}


def test_quoted_candidates(spark, tmp_path):
    """Quotations of hadith texts find those texts, with the best score first."""
    from qirtas.functions import fragments

    texts = ["من صام رمضان ايمانا واحتسابا غفر له ما تقدم من ذنبه", "الدين النصيحة قلنا لمن قال لله ولكتابه ولرسوله", "من صام رمضان ايمانا واحتسابا غفر له كل ما تقدم", None]
    spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "hadith_id long, arabic_matn string").selectExpr("*", "current_timestamp() AS loaded_at").write.parquet(f"{tmp_path}/hadith.parquet")
    spark.createDataFrame([(100, "t1", 0), (200, "t2", 1), (300, "t3", 3), (301, "t1", 1)], "link_id long, tafsir_id string, hadith_id long").write.parquet(f"{tmp_path}/related_hadith.parquet")
    got = {(r.tafsir_id, r.hadith_id): (r.score, r["rank"]) for r in layer_queries.b16_candidates(spark, str(tmp_path)).collect()}
    assert set(got) == {("t1/100", 0), ("t1/100", 2), ("t2/200", 1)}
    assert got["t1/100", 0] == (100.0, 1) and got["t1/100", 2] == (round(fragments.partial_ratio(texts[0], texts[2]), 1), 2)


def test_quoted_candidates_of_every_link(spark, tmp_path):
    """Whatever its link_id, and each link by itself where several quote one text."""
    texts = ["من صام رمضان ايمانا واحتسابا غفر له ما تقدم من ذنبه", "الدين النصيحة قلنا لمن قال لله ولكتابه ولرسوله"]
    spark.createDataFrame(list(enumerate(texts)), "hadith_id long, arabic_matn string").selectExpr("*", "current_timestamp() AS loaded_at").write.parquet(f"{tmp_path}/hadith.parquet")
    links = [(1, "t1", 0), (37, "t2", 1), (99, "t1", 0), (100, "t3", 0), (101, "t3", 7), (None, "t4", 1)]
    spark.createDataFrame(links, "link_id long, tafsir_id string, hadith_id long").write.parquet(f"{tmp_path}/related_hadith.parquet")
    got = [(r.tafsir_id, r.hadith_id, r.score, r["rank"]) for r in layer_queries.b16_candidates(spark, str(tmp_path)).collect()]
    assert sorted(got) == [("t1/1", 0, 100.0, 1), ("t1/99", 0, 100.0, 1), ("t2/37", 1, 100.0, 1), ("t3/100", 0, 100.0, 1), ("t4", 1, 100.0, 1)]


def test_candidates_of_equal_keys(spark):
    """Two rows under one tafsir_id have their own fragments."""
    texts = ["من صام رمضان ايمانا واحتسابا غفر له ما تقدم من ذنبه", "الدين النصيحة قلنا لمن قال لله ولكتابه ولرسوله"]
    tafsir = spark.createDataFrame([("t1", f"قال النبي {t}") for t in texts], "tafsir_id string, text_arabic string")
    got = layers.candidate_links(tafsir, spark.createDataFrame(list(enumerate(texts)), "hadith_id long, matn string")).collect()
    assert sorted((r.fragment, r.hadith_id, r.score, r["rank"]) for r in got) == sorted((t, i, 100.0, 1) for i, t in enumerate(texts))


def test_inferred_edges(spark):
    from qirtas.operators import resolve

    words = spark.createDataFrame([("p1", 1, 1), ("p1", 2, 2), ("p2", 2, 1), ("p3", 2, 1), ("p4", 9, 1)], "place string, old_id long, at int")
    roots = spark.createDataFrame([("p1", 5, 1), ("p2", 6, 1), ("p3", 6, 1), ("p3", 5, 0), ("p5", 6, 1)], "place string, old_id long, at int")
    to = lambda rows, name: spark.createDataFrame(rows, f"old_id long, {name} long")
    got = resolve.inferred_edges(words, roots, "place", ["at"], to([(1, 10), (2, 20)], "lemma_id"), to([(5, 50), (6, 60)], "root_id")).collect()
    assert [tuple(r) for r in got] == [(20, 60, 2, 2)]
