"""HTML pages to text and records, on the standard library's parser inside Arrow-batched UDFs."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qirtas.functions.normalize import drop_brace_numbers, drop_reference_prefix, squeeze

_HIDDEN, _VOID = {"script", "style"}, {"br", "img", "hr", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}


class Node:
    """An element: tag, attributes, and children that are elements or strings."""

    __slots__ = ("attributes", "children", "parent", "tag")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Node | str] = []

    def strings(self):
        for child in self.children:
            if isinstance(child, str):
                yield child
            elif child.tag not in _HIDDEN:
                yield from child.strings()

    def text(self, separator: str = "") -> str:
        """The text nodes below; with a separator each is stripped, empty ones are left out and the rest joined."""
        return separator.join(s for s in map(str.strip, self.strings()) if s) if separator else "".join(self.strings()).strip()

    def below(self):
        for child in self.children:
            if isinstance(child, Node):
                yield child
                yield from child.below()

    def find(self, tag: str | None = None, css: str | None = None):
        """Descendants with a tag and a class."""
        return (n for n in self.below() if (tag is None or n.tag == tag) and (css is None or css in n.attributes.get("class", "").split()))


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def _rows(*fields: tuple[str, T.DataType]) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(*f) for f in fields]))


@F.pandas_udf(T.StringType())
def visible_text(html: pd.Series) -> pd.Series:
    """X03. Stripped text nodes joined by a space; comments, scripts and styles do not show. Null stays null."""
    return html.map(lambda x: parse(x).text(" "), na_action="ignore")


def clean_html(c: Column) -> Column:
    """N10. Visible text without brace numbers, white space collapsed; null where nothing is left."""
    return F.nullif(squeeze(drop_brace_numbers(visible_text(F.nullif(c, F.lit(""))))), F.lit(""))


def last_page(c: Column) -> Column:
    """C15, A09. The greatest page number in the pagination links, 1 where there is none."""
    numbers = F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("page_haditses=([0-9]+)"), 1), lambda x: x.cast("int"))
    return F.coalesce(F.array_max(numbers), F.lit(1))


def derived_total(last: Column, per_page: Column, on_last: Column) -> Column:
    """A11. Rows of all pages but the last, and those on the last; a page holds 10 where the first shows none."""
    return (last - 1) * F.when(per_page == 0, 10).otherwise(per_page) + on_last


@F.pandas_udf(_rows(("number", T.IntegerType()), ("name_id", T.StringType()), ("name_ar", T.StringType())))
def chapters(html: pd.Series) -> pd.Series:
    """H01, O02. Cards of a book's page by number; cards without a number in their id are left out, missing names are empty."""

    def of(page: str | None):
        out = []
        for card in parse(page or "").find("div", "card"):
            name = card.attributes.get("id", "")
            if name.startswith("kitab") and re.fullmatch(r"\s*[+-]?\d+\s*", name.replace("kitab", "")):
                first = lambda **k: next((n.text() for n in card.find(**k)), "")  # noqa: B023, E731
                out.append({"number": int(name.replace("kitab", "")), "name_id": first(tag="a", css="text-id"), "name_ar": first(css="text-ar")})
        return sorted(out, key=lambda x: x["number"])

    return html.map(of)


@F.pandas_udf(_rows(*((name, T.StringType()) for name in ("title", "arabic", "translation", "grade"))))
def raw_records(html: pd.Series) -> pd.Series:
    """H02, H03. The records of a page: heading, first two paragraphs, and the text beside the label Grade."""

    def of(page: str | None):
        out = []
        for block in parse(page or "").find(css="hadits"):
            title = next((n.text() for n in block.find("h2")), "")
            # paragraphs are counted within their own parent
            places: dict[int, str] = {}
            for n in block.find("p"):
                k = [c for c in n.parent.children if isinstance(c, Node) and c.tag == "p"].index(n)
                places.setdefault(k, n.text())
            label = next((n for n in block.below() if " ".join("".join(c for c in n.children if isinstance(c, str)).split()) == "Grade"), None)
            grade = re.sub(r"^\s*Grade\s*", "", label.parent.text(" ")).strip() if label is not None else ""
            out.append({"title": title, "arabic": places.get(0, ""), "translation": places.get(1, ""), "grade": grade})
        return out

    return html.map(of)


def records(c: Column) -> Column:
    """The records of a page with reference prefixes removed."""
    return F.transform(raw_records(c), lambda r: F.struct(r["title"].alias("title"), F.trim(drop_reference_prefix(r["arabic"])).alias("arabic"), F.trim(drop_reference_prefix(r["translation"])).alias("translation"), r["grade"].alias("grade")))


@F.pandas_udf(T.StringType())
def heading(html: pd.Series) -> pd.Series:
    """H04. The text of the page's heading, empty where there is none."""

    def of(page: str | None):
        for box in parse(page or "").find("div", "heading"):
            for n in box.find("h1", "text-id"):
                return n.text()
        return ""

    return html.map(of)


def heading_or(c: Column, kind: str, number: Column) -> Column:
    return F.coalesce(F.nullif(heading(c), F.lit("")), F.concat_ws(" ", F.lit(kind), number.cast("string")))
