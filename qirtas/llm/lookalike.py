"""Visually identical text with different characters: one consistent form of every value, and the pairs it makes equal.

DuckDB runs inside the Arrow partitions. Its SQL maps compatibility forms (presentation forms, full-width
letters and digits, kinds of space), removes characters that do not show, maps look-alike letters and
composes accents with ``nfc_normalize``. The maps come from Unicode's own decompositions by rule; only the
look-alikes, which Unicode does not relate, are listed.

Defined results: null stays null; the empty string stays empty; tabs and runs of several spaces stay
as they are; letters, dots, hamza, vowel signs, tatweel, digit values and punctuation keep apart what they keep apart
on screen. Values of any length are mapped whole. Empty tables give no rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qirtas.llm.tables import connect, read
from qirtas.operators.skew import salted_join
from qirtas.shared import write_shared

SPREAD = 10_000
# Characters without a shape of their own (soft hyphen, joiners, marks of direction, selectors, byte order mark).
INVISIBLE = [(0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFF9, 0xFFFB), (0xE0001, 0xE007F), (0xE0100, 0xE01EF)]
# Letters that look like the second of their pair in every place.
LOOKALIKE = {"ک": "ك", "ۃ": "ة", "ہ": "ه", "ە": "ه", "۰": "٠", "۱": "١", "۲": "٢", "۳": "٣", "۷": "٧", "۸": "٨", "۹": "٩"}
LOOKALIKE |= dict(zip("АВЕКМНОРСТХаеорсухіјѕΑΒΕΖΗΙΚΜΝΟΡΤΥΧο", "ABEKMHOPCTXaeopcyxijsABEZHIKMNOPTYXo"))
_SHAPES = {"<initial>", "<medial>", "<final>", "<isolated>", "<wide>", "<narrow>", "<noBreak>"}
_MARKS = "\\x{064B}-\\x{065F}\\x{0670}"


def _compatibility() -> dict[str, str]:
    """Every character whose decomposition changes only its shape or width, kinds of single space, and Latin ligatures."""
    out = {}
    for code in [*range(0xA0, 0xD800), *range(0xF900, 0x10000)]:
        char = chr(code)
        kind = unicodedata.decomposition(char).split(" ")[0]
        plain = unicodedata.normalize("NFKC", char)
        if 0xFDF0 <= code <= 0xFDFF or (len(plain) > 1 and " " in plain):
            continue  # word signs and marks on a blank have a shape of their own
        if kind in _SHAPES or (kind == "<compat>" and (unicodedata.category(char) == "Zs" and plain == " " or 0xFB00 <= code <= 0xFB06)):
            out[char] = plain
    return out | {chr(c): " " for c in (0x2000, 0x2001)}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _class(ranges: list[tuple[int, int]]) -> str:
    return "".join(f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges)


def _ranges(chars: str) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for code in sorted(map(ord, chars)):
        if out and out[-1][1] == code - 1:
            out[-1] = (out[-1][0], code)
        else:
            out.append((code, code))
    return out


def canonical_sql(column: str) -> str:
    """A DuckDB expression for the consistent form of ``column``.

    The long maps are applied only to values that hold one of their characters. Farsi yeh has dots
    only where it joins the next letter, so there it is yeh and elsewhere alef maqsura; either with a hamza above is yeh with hamza.
    """
    maps = _compatibility()
    single = {k: v for k, v in maps.items() if len(v) == 1} | LOOKALIKE
    several = {k: v for k, v in maps.items() if len(v) > 1}
    long = ", ".join(f"{_quoted(k)}: {_quoted(v)}" for k, v in several.items())
    x = f"regexp_replace({column}, '[{_class(INVISIBLE)}]', '', 'g')"
    x = f"CASE WHEN regexp_matches({column}, '[{_class(_ranges(''.join(several)))}]') THEN array_to_string(list_transform(string_split({x}, ''), lambda c: coalesce((MAP {{{long}}})[c], c)), '') ELSE {x} END"
    x = f"translate({x}, {_quoted(''.join(single))}, {_quoted(''.join(single.values()))})"
    joined = "([\\x{0622}-\\x{064A}\\x{066E}-\\x{06D3}\\x{06D5}])"
    for _ in range(2):  # a yeh that ends one match may begin the next
        x = f"regexp_replace({x}, 'ی([{_MARKS}]*){joined}', 'ي\\1\\2', 'g')"
    x = f"replace({x}, 'ی', 'ى')"
    x = f"regexp_replace({x}, 'ى([\\x{{064B}}-\\x{{0652}}\\x{{0670}}]*)\\x{{0654}}', 'ي\\1\u0654', 'g')"
    touched = _class(_ranges("".join(single) + "".join(several) + "یٔ") + INVISIBLE)
    return f"nfc_normalize(CASE WHEN regexp_matches({column}, '[{touched}]') THEN {x} ELSE {column} END)"


def canonical(values: DataFrame, column: str = "value") -> DataFrame:
    """``values`` with the consistent form of ``column`` in a new last column ``canonical``."""
    query = f"SELECT *, {canonical_sql(chr(34) + column + chr(34))} AS canonical FROM batch"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        link = connect()
        for batch in batches:
            link.register("batch", pa.Table.from_batches([batch]))
            yield from link.sql(query).to_arrow_table().combine_chunks().to_batches()
            link.unregister("batch")

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in values.schema.fields)
    return values.mapInArrow(run, schema + ", canonical string")


def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field_name, key, place, value): place parts the values that may be compared, and is empty but for word occurrences."""

    def of(table: str, name: str, key: str, column: str, place: str = "''") -> DataFrame:
        return read(spark, sf_dir, table).select(F.lit(name).alias("field_name"), F.col(key).alias("key"), F.expr(place).alias("place"), F.col(column).alias("value"))

    parts = of("lemma", "lemma.text", "lemma_id", "text"), of("root", "root.arabic_trilateral", "root_id", "arabic_trilateral"), of("hadith", "hadith.arabic_matn", "hadith_id", "arabic_matn")
    out = of("word_occurrence", "word_occurrence.surface_form", "occ_id", "surface_form", "location")
    for part in parts:
        out = out.union(part)
    return out


def lookalike_pairs(values: DataFrame, spread: int = SPREAD) -> DataFrame:
    """(field_name, key_a, key_b), key_a < key_b, of rows in one place whose values differ as stored but look the same.

    A look whose rows are all stored alike is told by the least and greatest digest of its stored forms and goes no further. In the others
    the distinct forms are paired, and only rows of two different forms meet; the rows of a form are spread over salts, one for
    each ``spread`` of them. Rows without place, key or value are no cases.
    """
    looks = canonical(values.where("key is not null and value is not null and place is not null").select("field_name", "key", "place", "value"))
    on, form = ["field_name", "look_a", "look_b"], ["form_a", "form_b"]
    look = [F.xxhash64("place", "canonical", F.lit(k)).alias(n) for k, n in enumerate(on[1:])]
    digest = write_shared(looks.select("field_name", *look, *(F.xxhash64("value", F.lit(k)).alias(n) for k, n in enumerate(form)), "key"), "looks")
    stored = F.struct(*form)
    kinds = digest.groupBy(*on).agg(F.min(stored).alias("lo"), F.max(stored).alias("hi"), F.count(F.lit(1)).alias("n")).where("lo <> hi")
    mixed = write_shared(salted_join(digest, kinds.select(*on, "n"), on, "n", "key"), "mixed")
    salts = F.ceil(F.col("k") / spread).cast("int")
    forms = mixed.groupBy(*on, *form).agg(F.count(F.lit(1)).alias("k")).withColumn("salts", salts)
    rows = salted_join(mixed, forms, [*on, *form], "k", "key", "inner").withColumn("salt", F.pmod(F.xxhash64("key"), "salts").cast("int")).drop("salts")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    other = forms.select(*on, *(F.col(c).alias(f"other_{c}") for c in (*form, "salts")))
    pairs = forms.join(other, on).where(stored < F.struct(*(f"other_{c}" for c in form))).withColumn("salt", every("salts"))
    left = rows.join(pairs.drop("k", "salts"), [*on, *form, "salt"]).select(*on, *(F.col(f"other_{c}").alias(c) for c in form), F.col("key").alias("one"), every("other_salts").alias("salt"))
    met = left.join(rows, [*on, *form, "salt"]).where("one <> key")
    return met.select("field_name", F.least("one", "key").alias("key_a"), F.greatest("one", "key").alias("key_b")).distinct()
