"""Footnote citations: splitting, classes, scripture references. Native expressions, tested in a fixed order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from qirtas.functions.normalize import ARABIC_DIGITS, WHITE, strip, to_int

# A collection's keyword and name; the first keyword found decides.
COLLECTIONS = (
    ("البخاري", "Bukhari"), ("مسلم", "Muslim"), ("الترمذي", "Tirmizi"),
    ("أبو داود", "AbuDaud"), ("أبي داود", "AbuDaud"),
    ("النسائي", "Nesai"), ("ابن ماجه", "IbnMaja"),
)
# Keywords of collections outside the corpus, of an agreed report, of a chapter and of a verse.
OUTSIDE = ("أحمد", "الدارمي", "مالك", "موطأ")
AGREED, CHAPTER, VERSE = "متفق عليه", "سورة", "الآية"
_NUMBER = "\\(([\\x{0660}-\\x{0669}\\p{Nd}\\s\\x{001C}-\\x{001F}/\\-\\x{2013}]+)\\)"
_VERSE_REFERENCE = f"{CHAPTER}{WHITE}+([\\x{{0600}}-\\x{{06FF}}]+(?:{WHITE}+[\\x{{0600}}-\\x{{06FF}}]+){{0,2}}?){WHITE}+{VERSE}{WHITE}+([\\x{{0660}}-\\x{{0669}}]+)"


def split_citations(c: Column) -> Column:
    """C01. Pieces between Arabic and ASCII commas, stripped, without empty ones."""
    return F.filter(F.transform(F.split(c, "[،,]"), lambda x: strip(x)), lambda x: x != "")


def collection_of(c: Column) -> Column:
    """S13. The collection of the first keyword in table order that the text contains."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for keyword, name in COLLECTIONS:
        out = out.when(F.contains(c, F.lit(keyword)), F.lit(name))
    return out


def classify(c: Column) -> Column:
    """C02. struct(category, collection, number).

    A chapter keyword makes it scripture. Else a collection, an outside keyword or the agreed phrase makes it a report; its number is
    the first bracketed group, if that is one run of digits and no range. With a known collection and a number it
    is ``hadith_with_number``, otherwise ``hadith_no_number``; everything else is ``other``.
    """
    collection = collection_of(c)
    outside = F.lit(False)
    for keyword in (*OUTSIDE, AGREED):
        outside = outside | F.contains(c, F.lit(keyword))
    group = F.regexp_extract(c, "(?U)" + _NUMBER, 1)
    digits = strip(F.translate(group, ARABIC_DIGITS, "0123456789"))
    number = F.when(~group.rlike("[/\\-\\x{2013}]") & digits.rlike("^[0-9]+$"), digits.try_cast("int"))
    known = collection.isNotNull() & number.isNotNull()
    category = F.when(F.contains(c, F.lit(CHAPTER)), "quran").when(known, "hadith_with_number").when(collection.isNotNull() | outside, "hadith_no_number").otherwise("other")
    report = category.startswith("hadith")
    return F.struct(category.alias("category"), F.when(report, collection).alias("collection"), F.when(category == "hadith_with_number", number).alias("number"))


def parse_verse_reference(c: Column) -> Column:
    """C03. struct(name, verse) of a scripture citation; both null where it has not the form."""
    fits = c.rlike("(?U)" + _VERSE_REFERENCE)
    name = F.when(fits, strip(F.regexp_extract(c, "(?U)" + _VERSE_REFERENCE, 1)))
    return F.struct(name.alias("name"), F.when(fits, to_int(F.regexp_extract(c, "(?U)" + _VERSE_REFERENCE, 2))).alias("verse"))


def footnote_entries(c: Column) -> Column:
    """C04. The lines (parted by carriage returns) of a footnote block, without their leading markers and without empty ones."""
    lines = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "\r"), lambda x: strip(x)), lambda x: x != "")
    return F.transform(lines, lambda x: strip(F.regexp_replace(x, f"^\\(\\x{{00AC}}?[\\x{{0660}}-\\x{{0669}}]+\\){WHITE}*", "")))
