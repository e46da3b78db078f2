import pytest
from pyspark.sql import functions as F

from qirtas.functions import citations as c
from qirtas.functions import normalize as n


def one(spark, expression, value):
    return spark.createDataFrame([(value,)], "x string").select(expression(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("function", "given", "wanted"),
    [
        (n.normalize_key, "  الْإِسْلَامُ ", "الاسلام"),
        (n.normalize_key, "رحمـة", "رحمه"),
        (n.normalize_key, "هدى ", "هدي"),
        (n.normalize_key, None, None),
        (n.normalize_matn, " مِنْ \n إلى ", "من إلى"),
        (n.normalize_matn, None, ""),
        (n.normalize_ar, "قال رسول الله صلى الله عليه وسلم سُؤَال ة", "قال رسول الله سوال ه"),
        (n.normalize_ar, "رضي الله عنها قال", "ا قال"),  # the shorter phrase stands first and wins
        (n.normalize_ar, "", ""),
        (n.norm_alef, "إأآا", "اااا"),
        (n.strip_verse_number, "نور ١٢", "نور"),
        (n.dedup_key, "غُنُوض2", "غنوض"),
        (n.dedup_key, "2", ""),
        (n.normalize_nomor, " 8.0 ", "8"),
        (n.normalize_nomor, "12.7", "12"),
        (n.normalize_nomor, "1e3", "1000"),
        (n.normalize_nomor, "١٢", "12"),
        (n.normalize_nomor, "12d", "12d"),
        (n.normalize_nomor, "inf", "inf"),
        (n.normalize_nomor, "1e300", "1e300"),
        (n.normalize_nomor, None, "None"),
        (n.to_int, "٣٤", 34),
        (n.to_int, "x", None),
        (n.norm_id, " Kitab  #1 ", "Kitab 1"),
        (n.drop_brace_numbers, "a{١, 2}b{x1}", "a b{x1}"),
        (n.drop_reference_prefix, "Sahih 12 : text 3: x", "text 3: x"),
        (n.trim_fragment, " «a: b».", "a: b"),
        (n.is_yes, " Yes\n", True),
        (n.tokenize, "مِنْ  (نور٢). 12 a-b", ["مِن", "نور", "a-b"]),
        (n.tokenize, None, []),
        (n.key_list, "1:1,,1:2,", ["1:1", "1:2"]),
        (c.split_citations, "a، b,, c", ["a", "b", "c"]),
        (c.footnote_entries, "(١) a\r\r(¬٢)  b\rc", ["a", "b", "c"]),
    ],
)
def test_functions(spark, function, given, wanted):
    assert one(spark, function, given) == wanted


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ("رواه البخاري (١٢)", ("hadith_with_number", "Bukhari", 12)),
        ("البخاري ( 7 )", ("hadith_with_number", "Bukhari", 7)),
        ("البخاري (3/4)", ("hadith_no_number", "Bukhari", None)),
        ("البخاري (٥-٦)", ("hadith_no_number", "Bukhari", None)),
        ("البخاري (1 2)", ("hadith_no_number", "Bukhari", None)),
        ("أحمد (٩)", ("hadith_no_number", None, None)),
        ("متفق عليه", ("hadith_no_number", None, None)),
        ("سورة البقرة مسلم (1)", ("quran", None, None)),
        ("مسلم والبخاري (1)", ("hadith_with_number", "Bukhari", 1)),
        ("x", ("other", None, None)),
    ],
)
def test_classify(spark, given, wanted):
    assert tuple(one(spark, c.classify, given)) == wanted


def test_verse_reference(spark):
    assert tuple(one(spark, c.parse_verse_reference, "سورة آل عمران الآية ١٢")) == ("آل عمران", 12)
    assert tuple(one(spark, c.parse_verse_reference, "سورة آل عمران ١٢")) == (None, None)
