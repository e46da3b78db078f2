"""Paged books to items: headings found page by page, carried over page borders, footnotes handed out in order.

All of it is expressions. A page is cut where a heading begins; the number carried into a page comes from a window over one small row a
page, so that the texts are never sorted by book.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qirtas.functions.citations import footnote_entries
from qirtas.functions.normalize import WHITE, strip, to_int

# The forms of an item's heading and of a footnote marker. Both capture the number.
def heading(white: str) -> str:
    """The pattern of a heading, with a class of white space."""
    return f"(?:السؤال(?:ان)?{white}+[^\\n]+?{white}+من{white}+)?(?:ال)?فتوى{white}+رقم{white}*\\(([٠-٩]+)\\){white}*(?:\\(¬?[٠-٩]+\\){white}*)?:?{white}*(?:س|الحمد|فقد|السؤال)"


HEADING = heading(WHITE)
MARKER = "\\(¬?([٠-٩]+)\\)"
# characters that no text holds: where a heading begins, and where its number ends
_CUT, _END = "\ufdd0", "\ufdd1"


def page_segments(body: Column) -> Column:
    """array<struct<seg, heading, n_markers, text>>: what stands before the first heading (seg 0, no heading; left out where it is empty), and each
    heading with what follows. The brackets of a heading's own number are no marker."""
    pieces = F.split(F.regexp_replace(F.coalesce(body, F.lit("")), HEADING, f"{_CUT}$1{_END}$0"), _CUT)

    def of(piece: Column, at: Column) -> Column:
        opened = at > 0
        text = F.when(opened, F.substring_index(piece, _END, -1)).otherwise(piece)
        number = F.when(opened, to_int(F.substring_index(piece, _END, 1)))
        return F.struct(at.cast("int").alias("seg"), number.alias("heading"), (F.regexp_count(text, F.lit(MARKER)) - opened.cast("int")).alias("n_markers"), text.alias("text"))

    found = F.transform(pieces, of)
    return F.filter(found, lambda x: (x["seg"] > 0) | (x["text"] != "") | (F.size(pieces) == 1))


def segments(pages: DataFrame) -> DataFrame:
    """C05, C06, O03-O05. Pages (book, sequence_num, body, footnotes) -> (book, sequence_num, seg, number, n_markers, text, entries, mismatch).

    A segment without heading belongs to the last heading before it in the book. Entries are handed out in order, to each
    segment as many as it has markers; ``mismatch`` tells that the page has more or fewer entries than markers.
    """
    key = ["book", "sequence_num"]
    ready = pages.select(F.col("book").cast("string").alias("book"), F.col("sequence_num").cast("long").alias("sequence_num"), page_segments(F.col("body")).alias("segs"), footnote_entries(F.col("footnotes")).alias("notes"))
    last = ready.groupBy(*key).agg(F.max(F.try_element_at("segs", F.lit(-1))["heading"]).alias("heading"))
    carried = last.select(*key, F.last("heading", ignorenulls=True).over(Window.partitionBy("book").orderBy("sequence_num").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    counts = F.transform("segs", lambda x: x["n_markers"])
    total = F.aggregate(counts, F.lit(0), lambda n, x: n + x)
    rows = ready.join(carried, key).select(*key, "carried", "notes", counts.alias("counts"), (F.size("notes") != total).alias("mismatch"), F.posexplode("segs").alias("i", "s"))
    before = F.aggregate(F.slice("counts", F.lit(1), F.col("i")), F.lit(0), lambda n, x: n + x)
    entries = F.when(F.col("s.n_markers") > 0, F.slice("notes", before + 1, F.col("s.n_markers"))).otherwise(F.array().cast("array<string>"))
    return rows.select(*key, "s.seg", F.coalesce("s.heading", "carried").alias("number"), "s.n_markers", strip(F.col("s.text")).alias("text"), entries.alias("entries"), "mismatch")


def items(found: DataFrame) -> DataFrame:
    """C07, C08, A07, O14. (item_id, book, number, text, entries, n_entries, first_page) of each item; a number seen again goes on with the same item."""
    at = F.struct("sequence_num", "seg")
    texts = F.array_sort(F.collect_list(F.when(F.col("text") != "", F.struct("sequence_num", "seg", "text"))))
    notes = F.array_sort(F.collect_list(F.when(F.size("entries") > 0, F.struct("sequence_num", "seg", "entries"))))
    grouped = found.where("number is not null").groupBy("book", "number").agg(texts.alias("t"), notes.alias("e"), F.min(at).alias("at"))
    flat = F.flatten(F.transform("e", lambda x: x["entries"]))
    return grouped.select(
        F.concat_ws(":", "book", F.col("number").cast("string")).alias("item_id"), "book", "number",
        F.array_join(F.transform("t", lambda x: x["text"]), "\n").alias("text"), flat.alias("entries"), F.size(flat).alias("n_entries"), F.col("at.sequence_num").alias("first_page"),
    )
