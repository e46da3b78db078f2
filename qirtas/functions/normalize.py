"""Normalisers and cleaners as Column -> Column functions; all stay inside the JVM.

The code points below are fixed values: results are specified by them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks removed by the key and commentary normalisers.
MARKS = "\\x{064B}-\\x{065F}\\x{0670}\\x{06D6}-\\x{06ED}"
# Marks removed by the search normaliser.
SEARCH_MARKS = "\\x{064B}-\\x{0652}\\x{0670}\\x{0640}"
TATWEEL = "ـ"
ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"
# Honorific phrases that the search normaliser blanks out; the first that fits at a place wins.
HONORIFICS = (
    "صلى الله عليه وسلم", "صلى اللّه عليه وسلم",
    "رضي الله عنه", "رضي الله عنها", "رضي الله عنهم", "رضي الله عنهما",
    "عليه السلام", "عليه الصلاة والسلام",
    "رحمه الله", "عز وجل", "تبارك وتعالى", "سبحانه وتعالى", "جل جلاله",
)
# Letters that the key normaliser, the search normaliser and the alef normaliser replace, and what by.
KEY_FOLD = "إأآىة", "ااايه"
SEARCH_FOLD = "أإآىةؤئء", "ااايهوي"
ALEF_FOLD = "إأآ", "ااا"

# Answers that mean yes.
YES = "y", "yes"
# What is trimmed from both ends of a fragment.
EDGES = ' :،."«»﴾﴿'
WHITE = "(?U)[\\s\\x{001C}-\\x{001F}]"


def strip(c: Column) -> Column:
    """Strip every kind of Unicode white space from both ends."""
    return F.regexp_replace(c, f"{WHITE}+$|^{WHITE}+", "")


def squeeze(c: Column) -> Column:
    """Runs of white space become one space; ends are stripped."""
    return F.trim(F.regexp_replace(c, f"{WHITE}+", " "))


def normalize_key(c: Column) -> Column:
    """N01. Marks and tatweel go, alef forms, alef maqsura and teh marbuta are folded, ends are stripped. Null stays null."""
    bare = F.regexp_replace(c, f"[{MARKS}\\x{{0640}}]", "")
    return strip(F.translate(bare, *KEY_FOLD))


def normalize_matn(c: Column) -> Column:
    """N02. Marks go and white space is collapsed; letters and tatweel stay. Null becomes the empty string."""
    return squeeze(F.regexp_replace(F.coalesce(c, F.lit("")), f"[{MARKS}]", ""))


def _without_honorifics(c: Column) -> Column:
    return F.regexp_replace(c, "|".join(HONORIFICS), " ")


def normalize_ar(c: Column) -> Column:
    """N03. The search form: honorifics and marks go, letters incl. hamza carriers are folded. Null becomes the empty string."""
    x = _without_honorifics(F.coalesce(c, F.lit("")))
    x = _without_honorifics(F.regexp_replace(x, f"[{SEARCH_MARKS}]", ""))
    return squeeze(F.translate(x, *SEARCH_FOLD))


def norm_alef(c: Column) -> Column:
    """N04. Every alef form becomes the bare alef."""
    return F.translate(c, *ALEF_FOLD)


def strip_verse_number(c: Column) -> Column:
    """N05. Arabic-Indic digits go, wherever they stand; ends are stripped."""
    return strip(F.translate(c, ARABIC_DIGITS, ""))


def strip_homonym_suffix(c: Column) -> Column:
    """N06. ASCII digits at the end go."""
    return F.regexp_replace(c, "[0-9]+$", "")


def dedup_key(c: Column) -> Column:
    """N06 then N01: the key under which words of several sources are one."""
    return normalize_key(strip_homonym_suffix(c))


def to_int(c: Column) -> Column:
    """N08. Arabic-Indic or ASCII digits as int; null where it is no number."""
    return F.translate(c, ARABIC_DIGITS, "0123456789").try_cast("int")


def normalize_nomor(c: Column) -> Column:
    """N07. One trailing ".0" goes, numbers are cut to whole ones; what is no finite number stays as it is; null is the text None."""
    x = F.regexp_replace(strip(c), "\\.0$", "")
    ascii_ = F.translate(x, ARABIC_DIGITS, "0123456789")
    number = F.when(ascii_.rlike("^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$"), ascii_.try_cast("double"))
    return F.coalesce(number.try_cast("bigint").cast("string"), x, F.lit("None"))


def norm_id(c: Column) -> Column:
    """N09. The sign # goes, white space is collapsed."""
    return squeeze(F.regexp_replace(c, "#", ""))


def drop_brace_numbers(c: Column) -> Column:
    """N11. Braces that hold nothing but numbers and their separators become one space."""
    return F.regexp_replace(c, "(?U)\\{[\\p{Nd}\\s\\x{0640}\\-\\x{2013},\\x{060C}]+\\}", " ")


def drop_reference_prefix(c: Column) -> Column:
    """N12. A leading reference of up to 28 other characters, digits and a colon goes, once."""
    return F.regexp_replace(c, "(?U)^[^\\p{Nd}\\n]{0,28}\\p{Nd}+\\s*:\\s*", "")


def trim_fragment(c: Column) -> Column:
    """N18. Spaces, colons, commas, dots, quotation marks and ornate brackets go from both ends; apostrophes stay."""
    return F.regexp_replace(c, f"^[{EDGES}]+|[{EDGES}]+$", "")


def range_bounds(c: Column) -> tuple[Column, Column]:
    """N15. "a-b" or "n" as two ints."""
    parts = F.split(c, "-")
    low = F.get(parts, 0).try_cast("int")
    return low, F.coalesce(F.get(parts, 1).try_cast("int"), low)


def is_yes(c: Column) -> Column:
    """N17. Whether an answer means yes."""
    return F.lower(strip(c)).isin(*YES)


# What is trimmed from the edges of a token, written out so that it means the same in every engine.
EDGE = "(?:[^\\p{L}\\p{N}_]|\\p{Nd})"


def tokenize(c: Column) -> Column:
    """C09. Split on white space, trim edges that are no letters, drop what is empty. Null gives an empty array."""
    words = F.split(F.coalesce(c, F.lit("")), f"{WHITE}+")
    return F.filter(F.transform(words, lambda w: F.regexp_replace(w, f"^{EDGE}+|{EDGE}+$", "")), lambda w: w != "")


def key_list(c: Column) -> Column:
    """C10. A comma list as an array without empty entries."""
    return F.filter(F.split(c, ","), lambda x: x != "")
