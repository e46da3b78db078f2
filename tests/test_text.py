import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from qirtas.functions import fragments, html, lemmatize, segment
from qirtas.plans import text_queries

PAGES = [
    ("b", 1, "مقدمة (١) فتوى رقم (٣) س: نص (١) آخر (¬٢)", "(١) أ\r(٢) ب\r(٣) ج"),
    ("b", 2, "تتمة (١)", "(١) د"),
    ("b", 3, "x الفتوى رقم (٤)(١): الحمد y فتوى رقم (٣) السؤال z", None),
    ("c", 1, None, "(١) e"),
]


def test_segments_and_items(spark):
    pages = spark.createDataFrame(PAGES, "book string, sequence_num long, body string, footnotes string")
    found = segment.segments(pages).orderBy("book", "sequence_num", "seg").collect()
    assert [(r.book, r.sequence_num, r.number, r.n_markers, r.entries, r.mismatch) for r in found] == [
        ("b", 1, None, 1, ["أ"], False),
        ("b", 1, 3, 2, ["ب", "ج"], False),
        ("b", 2, 3, 1, ["د"], False),
        ("b", 3, 3, 0, [], True),
        ("b", 3, 4, 1, [], True),
        ("b", 3, 3, 0, [], True),
        ("c", 1, None, 0, [], True),
    ]
    items = {r.item_id: r for r in segment.items(segment.segments(pages)).collect()}
    assert items["b:3"].entries == ["ب", "ج", "د"]
    assert items["b:3"].text.split("\n")[1:] == ["تتمة (١)", "x", "فتوى رقم (٣) السؤال z"]
    assert items["b:4"].n_entries == 0
    assert set(items) == {"b:3", "b:4"}


def test_html(spark):
    page = (
        '<div class="heading"><h1 class="text-id"> T </h1></div><p>a&amp;b<!-- c --></p><script>x = "</p>"</script>{1}<br>z<a class="page-link" href="?page_haditses=12">'
        '<div class="card" id="kitab2"><a class="text-id">zwei</a><span class="text-ar">ب</span></div><div class="card" id="kitab1"></div><div class="card" id="kitabx"></div>'
        '<div class="hadits"><h2> h 1 </h2><p>S 1: ar</p><p>tr</p><div><b>Grade</b> Sahih</div></div>'
    )
    row = spark.createDataFrame([(page,), (None,), ("",)], "h string").select(
        html.clean_html(F.col("h")).alias("t"), html.last_page(F.col("h")).alias("l"), html.heading_or(F.col("h"), "tema", F.lit(4)).alias("n"), html.chapters(F.col("h")).alias("c"), html.records(F.col("h")).alias("r")
    )
    first, null, empty = row.collect()
    assert first.t.startswith("T a&b z")
    assert first.l == 12 and first.n == "T"
    assert [tuple(x) for x in first.c] == [(1, "", ""), (2, "zwei", "ب")]
    assert [tuple(x) for x in first.r] == [("h 1", "ar", "tr", "Sahih")]
    for other in (null, empty):
        assert (other.t, other.l, other.n, other.c, other.r) == (None, 1, "tema 4", [], [])


def test_fragments(spark):
    long = "كلمة " * 200
    texts = [
        "x قال رسول الله : من صام يوما في سبيل الله. رواه مسلم", "قال النبي أربع كلمات فقط هنا من طريق", None, "",
        "قال النبي واحد اثنان قال النبي ثلاثة أربعة خمسة ستة سبعة رواه فلان", f"قال رسول الله {long}", f"{long} أخرجه فلان",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", fragments.extract_fragments(F.col("t")).alias("f")).collect()
    got = {r.i: [tuple(x) for x in r.f] for r in rows}
    assert ("QALA_RASUL", "من صام يوما في سبيل الله") in got[0]
    assert got[1] == got[2] == got[3] == []
    # the first trigger reaches over the second
    assert [x for x in got[4] if x[0] == "QALA_NABI"] == [("QALA_NABI", "واحد اثنان قال النبي ثلاثة أربعة خمسة ستة سبعة"), ("QALA_NABI", "ثلاثة أربعة خمسة ستة سبعة")]
    assert got[5] == [("QALA_RASUL", f" {long}"[:400].strip())]
    assert got[6] == [("AKHRAJA", f"{long} "[-400:].strip())]


def brute_ratio(a, b):
    def lcs(x, y):
        row = [0] * (len(y) + 1)
        for c in x:
            before = row[:]
            for j, d in enumerate(y):
                row[j + 1] = before[j] + 1 if c == d else max(before[j + 1], row[j])
        return row[-1]

    best = 0.0
    for s, t in ((a, b), (b, a)):
        if len(s) > len(t):
            continue
        for i in range(1 - len(s), len(t)):
            w = t[max(0, i) : min(len(t), i + len(s))]
            best = max(best, 200 * lcs(s, w) / (len(s) + len(w)))
    return best


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=1, max_size=9), st.text("abc", min_size=1, max_size=14))
def test_partial_ratio(a, b):
    assert abs(fragments.partial_ratio(a, b) - brute_ratio(a, b)) < 1e-9
    wanted = brute_ratio(a, b)
    assert abs(fragments.partial_ratio(a, b, 80.0) - (wanted if wanted >= 80 else 0)) < 1e-9


def near(a, b, least):
    """Places of pairs that pass the bound, whichever text is the shorter."""
    return {(i, j) for i, j in fragments.near_pairs(a, b, least).T.tolist()} | {(i, j) for j, i in fragments.near_pairs(b, a, least).T.tolist()}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=9), min_size=1, max_size=6), st.lists(st.text("abc", min_size=1, max_size=14), min_size=1, max_size=6), st.sampled_from([60.0, 80.0, 100.0]))
def test_near_pairs_lose_nothing(a, b, least):
    assert {(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if brute_ratio(x, y) >= least} <= near(a, b, least)


def test_near_pairs_are_few():
    """Of texts of some hundred letters all that score enough pass, changed here and there, cut off or inside others, and hardly any other pair."""
    rng = random.Random(7)
    letters = "aaaabbcdefghijklmnopqrstuvwxyz"
    text = lambda n: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(n))
    short = [text(n) for n in (9, 11, 20, 22, 35, 45, 60, 75) for _ in range(15)]
    long = [text(rng.randint(8, 150)) for _ in range(500)]
    for i, s in enumerate(short):
        changed = "".join(c for k, x in enumerate(s) for c in (x, rng.choice(letters))[: (0 if k % 11 == 3 else 2 if k % 11 == 8 else 1)])
        long[4 * i : 4 * i + 4] = text(20) + changed + text(9), changed[len(s) // 5 :] + text(40), text(40) + changed[: -len(s) // 5], changed[len(s) // 6 : -len(s) // 6]
    got = near(short, long, 80.0)
    scored = {(i, j) for i in range(len(short)) for j in range(4 * i, 4 * i + 4) if fragments.partial_ratio(short[i], long[j], 80.0)}
    assert len(scored) > 400 and scored <= got
    assert len(got - scored) < len(short) * len(long) / 500
    others = [(i, j) for i in range(len(short)) for j in rng.sample(range(480, 500), 2)]
    assert not any(fragments.partial_ratio(short[i], long[j], 80.0) for i, j in others if (i, j) not in got)


def test_fuzzy_top_reads_the_corpus_once(spark):
    """However many blocks the queries make."""
    corpus = spark.range(4).selectExpr("id AS corpus_id", "'one two three four five ' || id AS text")
    queries = spark.range(9).selectExpr("id AS query_id", "'two three four five' AS text")
    found = fragments.fuzzy_top(queries, corpus, block=2)
    assert [r.corpus_id for r in found.orderBy("query_id", "rank").collect()] == [0, 1, 2] * 9
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_comparable_makes_each_text_once(spark):
    rows = spark.createDataFrame([(1, "one two three four five"), (2, "one two three four"), (3, None)], "k int, t string")
    got = fragments.comparable(rows, "k", F.upper("t"), "id").where("text <> ''")
    assert [tuple(r) for r in got.collect()] == [(1, "ONE TWO THREE FOUR FIVE")]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("upper(") == 1


def test_fuzzy_top_is_brute_force(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcd") for _ in range(4))
    corpus = [(i, " ".join(word() for _ in range(8))) for i in range(60)] + [(100 + i, word() * (i % 3 + 1)) for i in range(30)]
    queries = [(i, corpus[i * 7][1][3:22].replace("a", "b", i % 2)) for i in range(8)] + [(50 + i, t[-14:] + "d" * (i % 3)) for i, (_, t) in enumerate(corpus[:12])]
    queries += [(80, corpus[5][1]), (81, "a" + corpus[9][1][:12]), (82, "ab")]
    got = fragments.fuzzy_top(spark.createDataFrame(queries, "query_id long, text string"), spark.createDataFrame([*corpus, (99, None), (98, "")], "corpus_id long, text string"), block=3)
    wanted = set()
    for q, text in queries:
        best = sorted(((-brute_ratio(text, t), c) for c, t in corpus))[:3]
        wanted |= {(q, c, round(-s, 6), k + 1) for k, (s, c) in enumerate(best) if -s >= 80}
    assert {(r.query_id, r.corpus_id, round(r.score, 6), r["rank"]) for r in got.collect()} == wanted


def test_fuzzy_join_is_brute_force(spark):
    """Texts of all lengths in many blocks; equal texts on both sides, of which the smallest ids are the best."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcd") for _ in range(4))
    texts = [" ".join(word() for _ in range(rng.randint(1, 9))) for _ in range(40)]
    texts[0] = "uvwx yzuv wxyz uwyv xxuu"
    corpus = [(i, texts[i % 40]) for i in range(60)] + [(60 + i, texts[0]) for i in range(5)] + [(80, texts[1] + " " + texts[2]), (81, None), (82, ""), (None, texts[3])]
    asked = [t[:21].replace("a", "b", i % 2) for i, t in enumerate(texts)] + [texts[0], texts[0], texts[5] + "d", "ab", ""]
    got = fragments.fuzzy_join(spark.createDataFrame([(t,) for t in asked], "text string"), spark.createDataFrame(corpus, "corpus_id long, text string"), block=9).collect()
    wanted = set()
    for text in set(asked) - {""}:
        best = sorted((-brute_ratio(text, t), c) for c, t in corpus if t and c is not None)[:3]
        wanted |= {(text, c, round(-s, 6), k + 1) for k, (s, c) in enumerate(best) if -s >= 80}
    assert {(r.text, r.corpus_id, round(r.score, 6), r["rank"]) for r in got} == wanted and len(got) == len(wanted)
    assert [(c, k) for t, c, _, k in sorted(wanted, key=lambda x: x[3]) if t == texts[0]] == [(0, 1), (40, 2), (60, 3)]


def test_fuzzy_top_reads_every_layer(spark, tmp_path):
    text = "alpha beta gamma delta epsilon zeta eta"
    layers = ["hadith", "tafsir", "fatwa", None]
    documents = [(i, layer, " ".join([text, *["theta"] * i])) for i, layer in enumerate(layers)]
    spark.createDataFrame([(1, text)], "item_id long, text string").write.parquet(f"{tmp_path}/eval_item.parquet")
    for left_out in range(4):  # the three best of each choice of layers
        spark.createDataFrame([d for d in documents if d[0] != left_out], "doc_id long, layer string, text string").write.parquet(f"{tmp_path}/documents.parquet", "overwrite")
        got = {(r.query_id, r.corpus_id, r.score) for r in text_queries.j14_fuzzy_top(spark, str(tmp_path)).collect()}
        assert got == {(1, i, 100.0) for i in range(4) if i != left_out}


def test_lemmatize(spark):
    rows = spark.createDataFrame([("والكتاب",), ("والكتاب",), (None,), ("من",)], "w string")
    got = {r.w: r.candidates for r in lemmatize.lemmatize(rows, "w").collect()}
    assert got["من"] == ["من"] and "كتاب" in got["والكتاب"] and len(got) == 2
