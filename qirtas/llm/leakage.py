"""Evaluation texts leaking into training text, by a generalised suffix automaton.

The test items are normalised to words and go into one suffix automaton, whose states know the items that hold
them. Training text is normalised the same way and streamed through it: at every word the automaton has the
longest run of words, ending there, that stands in some item. Runs of ``least`` words (8) or more are leaks. A
word that no item holds ends every run, so only stretches of known words long enough for a leak are walked.

Items are a query set: they come to the driver in blocks of ``BLOCK`` words and the rest of an item (an automaton of about 2 states a word, some 500
bytes each). Each block's automaton is sent to the executors and the corpus is streamed through it; with more than one block
the corpus is read once a block, its hits are written to the shared folder, and the automaton is dropped before the next is built, so that driver and
executors never hold more than one. Items of more than ``MOST`` words in all are refused: that many readings of the corpus
call for a join instead. Nothing of the corpus is gathered or shuffled but the hits.

Defined results: null and empty texts, and items shorter than ``least`` words, match nothing; an item that is
repeated under another id is reported for each id; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qirtas.functions.normalize import KEY_FOLD, MARKS, TATWEEL
from qirtas.llm.vectors import as_array, words_of
from qirtas.shared import write_shared

LEAST, BLOCK, MOST = 8, 200_000, 4_000_000
_FOLD = dict(zip(*KEY_FOLD))


def normalized(texts: pa.Array) -> pa.Array:
    """Lower case, the key normaliser's marks and letters, and one space for everything other than letters and digits."""
    texts = pc.utf8_lower(pc.fill_null(as_array(texts), ""))
    texts = pc.replace_substring_regex(texts, f"[{MARKS}{TATWEEL}]+", "")
    for letter in sorted(set(_FOLD.values())):
        texts = pc.replace_substring_regex(texts, "[" + "".join(k for k, v in _FOLD.items() if v == letter) + "]", letter)
    return pc.replace_substring_regex(texts, "[^\\p{L}\\p{Nd}]+", " ")


class Automaton:
    """A suffix automaton of several sequences of word numbers, each followed by an end mark of its own."""

    def __init__(self, sequences: list[tuple[int, list[int]]], least: int = LEAST) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.least = [-1], [0], least
        last = 0
        for number, (_, words) in enumerate(sequences):
            for word in [*words, -1 - number]:
                last = self._extend(word, last)
        self.items: list[set[int]] = [set() for _ in self.next]
        for item, words in sequences:
            state = 0
            for word in words:
                state = self.next[state][word]
                up = state
                while up > 0 and self.length[up] >= least and item not in self.items[up]:
                    self.items[up].add(item)
                    up = self.link[up]

    def _new(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _extend(self, word: int, last: int) -> int:
        new = self._new(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            to = self.next[at][word]
            if self.length[to] == self.length[at] + 1:
                self.link[new] = to
            else:
                copy = self._new(self.length[at] + 1, self.link[to], dict(self.next[to]))
                while at >= 0 and self.next[at].get(word) == to:
                    self.next[at][word] = copy
                    at = self.link[at]
                self.link[to] = self.link[new] = copy
        return new

    def hits(self, words: list[int]) -> Iterator[tuple[int, int, int]]:
        """(item, last word's place, length) for every place at which a run of ``least`` words ends that the item holds.
        The length is the longest match there with any item."""
        state = length = 0
        for at, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            if length >= self.least:
                up = state
                while self.length[self.link[up]] >= self.least:
                    up = self.link[up]
                for item in self.items[up]:
                    yield item, at, length


def _blocks(items: DataFrame, least: int, block: int) -> Iterator[tuple[dict[str, int], Automaton]]:
    """One after the other, the word numbers and the automaton of every block of items."""
    rows = items.select(F.col("item_id").cast("long"), "text").where("item_id is not null and text is not null").toLocalIterator()
    ids: dict[str, int] = {}
    held: list[tuple[int, list[int]]] = []
    size = total = 0
    for item, text in rows:
        words = normalized(pa.array([text]))[0].as_py().split()
        if len(words) < least:
            continue
        held.append((item, [ids.setdefault(w, len(ids)) for w in words]))
        size, total = size + len(words), total + len(words)
        if total > MOST:
            raise ValueError(f"the items have more than {MOST} words")
        if size >= block:
            yield ids, Automaton(held, least)
            ids, held, size = {}, [], 0
    if held:
        yield ids, Automaton(held, least)


def leaks(documents: DataFrame, items: DataFrame, least: int = LEAST, block: int = BLOCK) -> DataFrame:
    """(item_id, doc_id, first_word, n_words, n_shared, longest, runs): each leak once, with the document's words (normalised),
    how many of them lie in runs shared with the item, where the first begins, the longest match in it, and all its runs as
    [first word, word behind the last]."""
    context = documents.sparkSession.sparkContext
    found = held = None
    for built in _blocks(items, least, block):
        if held is not None:  # there is more than one block
            part = write_shared(_streamed(documents, held), "leaks")
            found = part if found is None else found.union(part)
            held.destroy()
        held = context.broadcast(built)
    last = _streamed(documents, held if held is not None else context.broadcast(({}, Automaton([], least))))
    found = last if found is None else found.union(last)
    best = F.max(F.struct("n_shared", "longest", (-F.col("first_word")).alias("back"), "n_words", "runs"))
    return found.groupBy("item_id", "doc_id").agg(best.alias("b")).select("item_id", "doc_id", (-F.col("b.back")).alias("first_word"), "b.n_words", "b.n_shared", "b.longest", "b.runs")


def _streamed(documents: DataFrame, shared: Broadcast) -> DataFrame:
    schema = "item_id long, doc_id long, first_word int, n_words int, n_shared int, longest int, runs array<array<int>>"

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, codes, ends = words_of(normalized(batch.column(1)), " ")
            out: list[tuple[int, ...]] = []
            ids, automaton = shared.value
            known = np.fromiter((ids.get(w, -1) for w in words.to_pylist()), np.int64, len(words))[codes] if len(words) else codes
            border = np.zeros(len(known) + 1, bool)
            border[ends[:-1]] = border[ends[1:]] = True
            inside = known >= 0
            first = np.flatnonzero(inside & (border[:-1] | ~np.concatenate([[False], inside[:-1]])))
            after = np.flatnonzero(inside & (border[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
            long = after - first >= automaton.least
            found: dict[tuple[int, int], list[list[int]]] = {}
            for a, b in zip(first[long].tolist(), after[long].tolist()):
                row = -1
                for item, at, length in automaton.hits(known[a:b].tolist()):
                    row = int(np.searchsorted(ends, a, side="right")) - 1 if row < 0 else row
                    end = a + at + 1 - int(ends[row])
                    begin = end - automaton.least
                    runs = found.setdefault((item, row), [])
                    if runs and begin <= runs[-1][1]:
                        runs[-1][1] = end
                    else:
                        runs.append([begin, end])
            for (item, row), runs in found.items():
                sizes = [b - a for a, b in runs]
                out.append((item, row, runs[0][0], int(ends[row + 1] - ends[row]), sum(sizes), max(sizes), runs))
            if out:
                columns = list(zip(*out))
                arrays = [pa.array(columns[0], pa.int64()), as_array(batch.column(0)).take(pa.array(columns[1])).cast(pa.int64()), *(pa.array(c, pa.int32()) for c in columns[2:-1]), pa.array(columns[-1], pa.list_(pa.list_(pa.int32())))]
                yield pa.RecordBatch.from_arrays(arrays, names=["item_id", "doc_id", "first_word", "n_words", "n_shared", "longest", "runs"])

    return documents.where("doc_id is not null and text is not null").select("doc_id", "text").mapInArrow(stream, schema)


def removal(documents: DataFrame, found: DataFrame, coverage: float = 0.5, length: int = LEAST) -> DataFrame:
    """(doc_id, n_items, covered, action, spans): what is to be removed, as (first_word, n_words) of the normalised document.

    The runs of all items are merged where they overlap or touch. A document of which they cover ``coverage`` or more goes whole
    ('document'); of others every merged run of ``length`` words or more goes ('runs'). The automaton has no runs under ``LEAST`` words.
    """
    runs = found.select("doc_id", "item_id", "n_words", F.explode("runs").alias("run")).select("doc_id", "item_id", "n_words", F.get("run", F.lit(0)).alias("a"), F.get("run", F.lit(1)).alias("b"))
    n_items, n_words = F.countDistinct("item_id").alias("n_items"), F.max("n_words").alias("n_words")
    sorted_runs = F.array_sort(F.collect_set(F.struct("a", "b"))).alias("runs")  # at most one for each word of the document and item

    def add(merged: Column, run: Column) -> Column:
        last = F.try_element_at(merged, F.lit(-1))
        longer = F.concat(F.slice(merged, F.lit(1), F.size(merged) - 1), F.array(F.struct(last["a"].alias("a"), F.greatest(last["b"], run["b"]).alias("b"))))
        return F.when((F.size(merged) > 0) & (run["a"] <= F.try_element_at(merged, F.lit(-1))["b"]), longer).otherwise(F.concat(merged, F.array(run)))

    rows = runs.groupBy("doc_id").agg(n_items, n_words, sorted_runs)
    rows = rows.withColumn("runs", F.aggregate("runs", F.array().cast("array<struct<a:int,b:int>>"), add))
    rows = rows.withColumn("covered", F.aggregate("runs", F.lit(0), lambda n, r: n + r["b"] - r["a"]) / F.col("n_words"))
    whole = F.col("covered") >= coverage
    span = lambda first, n: F.struct(first.cast("int").alias("first_word"), n.cast("int").alias("n_words"))
    long = F.transform(F.filter("runs", lambda r: r["b"] - r["a"] >= length), lambda r: span(r["a"], r["b"] - r["a"]))
    spans = F.when(whole, F.array(span(F.lit(0), F.col("n_words")))).otherwise(long)
    return rows.select("doc_id", "n_items", F.round("covered", 6).alias("covered"), F.when(whole, "document").otherwise("runs").alias("action"), spans.alias("spans"))


def normalized_text(text: str) -> list[str]:
    """The same normalisation in plain Python, for tests."""
    kept = "".join(_FOLD.get(c, c) for c in text.lower() if not ("ً" <= c <= "ٟ" or c in "ٰـ" or "ۖ" <= c <= "ۭ"))
    return "".join(c if unicodedata.category(c)[0] == "L" or unicodedata.category(c) == "Nd" else " " for c in kept).split()
