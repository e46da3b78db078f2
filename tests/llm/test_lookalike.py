import pytest
from pyspark.sql import functions as F

from qirtas.llm import lookalike

SAME = [
    ("ﻻ", "لا"), ("ﻣﻦ", "من"), ("２", "2"), ("ａ", "a"), ("a b", "a b"), ("a b", "a b"), ("a　b", "a b"), ("م​ن", "من"), ("م­ن", "من"), ("﻿من⁠", "من"),
    ("إلی", "إلى"), ("بَیْت", "بَيْت"), ("بییت", "بييت"), ("کتاب", "كتاب"), ("سورۃ", "سورة"), ("ہو", "هو"), ("أ", "أ"), ("إ", "إ"), ("آ", "آ"), ("ؤ", "ؤ"), ("یٔ", "ئ"),
    ("مَّ", "مَّ"), ("é", "é"), ("ا͏َّ", "اَّ"), ("", ""), ("۱۲", "١٢"),
]
DIFFERENT = [("من", "مـن"), ("على", "علي"), ("سورة", "سوره"), ("مِن", "من"), ("١", "٢"), ("1", "١"), ("a,b", "a.b"), ("أن", "ان"), ("a  b", "a b"), ("ﷺ", "صلى الله عليه وسلم"), ("۴", "٤"), ("x²", "x2")]


@pytest.fixture(scope="module")
def form(spark):
    every = sorted({x for pair in SAME + DIFFERENT for x in pair})
    rows = lookalike.canonical(spark.createDataFrame([(x,) for x in every], "value string")).collect()
    return {r.value: r.canonical for r in rows}


@pytest.mark.parametrize(("a", "b"), SAME)
def test_same(form, a, b):
    assert form[a] == form[b]


@pytest.mark.parametrize(("a", "b"), DIFFERENT)
def test_different(form, a, b):
    assert form[a] != form[b]


def test_fixed_point(spark, form):
    again = lookalike.canonical(spark.createDataFrame([(x,) for x in form.values()], "value string")).collect()
    assert all(r.value == r.canonical for r in again)


def test_pairs(spark):
    rows = [
        ("f", 1, "", "من"), ("f", 2, "", "ﻣﻦ"), ("f", 3, "", "من"), ("f", 4, "", "مـن"), ("f", 5, "", None), ("f", None, "", "من"), ("g", 6, "", "ﻣﻦ"),
        ("w", 7, "1:1", "لا"), ("w", 8, "1:1", "ﻻ"), ("w", 9, "1:2", "ﻻ"), ("w", 10, None, "ﻻ"), ("f", 11, "", ""), ("f", 12, "", "​"), ("f", 2, "", "ﻣﻦ"),
    ]
    values = spark.createDataFrame(rows, "field_name string, key long, place string, value string").withColumn("look", F.lit(1))
    got = lookalike.lookalike_pairs(values)
    assert {tuple(r) for r in got.collect()} == {("f", 1, 2), ("f", 2, 3), ("w", 7, 8), ("f", 11, 12)}
    assert got.count() == 4
    assert lookalike.lookalike_pairs(values.limit(0)).collect() == []


def test_long_value(spark):
    rows = lookalike.canonical(spark.createDataFrame([("ﻣﻦ " * 50_000,)], "value string")).first()
    assert rows.canonical == "من " * 50_000


def test_pairs_of_large_groups(spark):
    """Many copies of one form and few of another: only rows of different forms meet."""
    rows = [("f", k, "", "abc") for k in range(300)] + [("f", 1_000 + k, "", "ab\u200bc") for k in range(3)] + [("f", 2_000, "", "\uff41bc"), ("f", 2_000, "", "abc"), ("g", 1, "", "abc"), ("f", 3_000, "x", "ab\u200bc")]
    frame = spark.createDataFrame(rows, "field_name string, key long, place string, value string").withColumns({"canonical": F.lit("x"), "look_a": F.lit(1), "form_a": F.lit(2)})
    true = {("f", min(a, b), max(a, b)) for _, a, p, v in rows for _, b, q, w in rows if a != b and p == q and v != w and "x" not in (p, q)}
    for spread in (7, 10_000):
        got = [tuple(r) for r in lookalike.lookalike_pairs(frame, spread).collect()]
        assert len(got) == len(set(got)) and set(got) == {t for t in true if t[0] == "f"}
