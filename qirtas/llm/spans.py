"""Long exact spans shared between records, by MinHash banding over paragraphs.

A paragraph is every run of ``span`` consecutive words (12). Its word shingles of five give one MinHash value,
and that value is its only band: a band of one row is the tuning with full recall, since equal paragraphs have
equal shingles and so always the same minimum. Neighbouring paragraphs mostly share their minimum, so that a
record sends one row for about every fourth or fifth word. Paragraphs whose bands meet another record are verified exactly
(all words, by two independent 64-bit hashes of the whole window), and the verified ones are joined
to maximal spans. ``clusters`` joins the records that share spans to components, and ``removal`` lists what may go: of every shared
paragraph the copy in the first record of its component stays.

Verification is equality of the whole paragraph, which is a Jaccard similarity of 1 and an edit distance of 0: the problem asks
for spans that are the same word for word.

Defined results: null texts and texts of fewer than ``span`` words share nothing; a record delivered twice is one
record; repeats inside one record alone are not shared; empty tables give no rows; extra columns of the
input are ignored. Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qirtas.llm.vectors import as_array, list_array, mix, rolling, signed, starts_within, word_hashes, words_of
from qirtas.operators.skew import salted_join
from qirtas.shared import write_shared

SPAN, SHINGLE = 12, 5
_BANDS = "rec_table string, rec_key string, band long, first_word int, hash_a array<long>, hash_b array<long>"


def bands(records: DataFrame, span: int = SPAN, shingle: int = SHINGLE) -> DataFrame:
    """One row for each run of neighbouring paragraphs with the same MinHash: the band, the first paragraph's
    place, and two hashes of each of its paragraphs."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, codes, ends = words_of(batch.column(2))
            at = starts_within(ends, span)
            if not len(at):
                continue
            a, b = (word_hashes(words, seed)[codes] for seed in (1, 2))
            shingles, width = mix(rolling(a, shingle)), span - shingle + 1
            low = shingles[: len(a) - span + 1].copy()
            for j in range(1, width):
                np.minimum(low, shingles[j : j + len(low)], out=low)
            row = np.searchsorted(ends, at, side="right") - 1
            low = low[at]
            new = np.ones(len(at), bool)
            new[1:] = (row[1:] != row[:-1]) | (low[1:] != low[:-1])
            first = np.flatnonzero(new)
            offsets = np.append(first, len(at))
            rows = pa.array(row[first])
            yield pa.RecordBatch.from_arrays(
                [
                    as_array(batch.column(0)).take(rows),
                    as_array(batch.column(1)).take(rows),
                    pa.array(signed(low[first])),
                    pa.array((at[first] - ends[row[first]]).astype(np.int32)),
                    list_array(signed(rolling(a, span)[at]), offsets, pa.int64()),
                    list_array(signed(rolling(b, span)[at]), offsets, pa.int64()),
                ],
                names=["rec_table", "rec_key", "band", "first_word", "hash_a", "hash_b"],
            )

    return records.select("rec_table", "rec_key", "text").mapInArrow(sketch, _BANDS)


def _in_two_records(rows: DataFrame, *key: str) -> DataFrame:
    """Keys found in two or more records, with the number of their rows; a partial aggregation comes before the shuffle."""
    record = F.struct("rec_table", "rec_key")
    seen = rows.groupBy(*key).agg(F.min(record).alias("lo"), F.max(record).alias("hi"), F.count(F.lit(1)).alias("n"))
    return seen.where("lo < hi").select(*key, "n")


def shared_windows(records: DataFrame, span: int = SPAN, shingle: int = SHINGLE) -> DataFrame:
    """(rec_table, rec_key, first_word, hash_a, hash_b) of every paragraph that stands in another record too."""
    table = write_shared(bands(records, span, shingle), "bands")
    meeting = salted_join(table, _in_two_records(table, "band"), ["band"], "n", "rec_key")
    paired = F.arrays_zip("hash_a", "hash_b")
    each = meeting.select("rec_table", "rec_key", "first_word", F.posexplode(paired).alias("i", "w"))
    windows = write_shared(each.select("rec_table", "rec_key", (F.col("first_word") + F.col("i")).alias("first_word"), "w.hash_a", "w.hash_b"), "windows")
    return salted_join(windows, _in_two_records(windows, "hash_a", "hash_b"), ["hash_a", "hash_b"], "n", "rec_key")


def spans(windows: DataFrame, span: int = SPAN) -> DataFrame:
    """Maximal runs of words covered by shared windows: (rec_table, rec_key, span_start, span_len)."""
    order = Window.partitionBy("rec_table", "rec_key").orderBy("first_word")
    before = F.lag("first_word").over(order)
    opened = F.when(before.isNull() | (F.col("first_word") > before + span), 1).otherwise(0)
    runs = windows.select("rec_table", "rec_key", "first_word").withColumn("opened", opened)
    runs = runs.withColumn("run", F.sum("opened").over(order))
    start, end = F.min("first_word"), F.max("first_word")
    return runs.groupBy("rec_table", "rec_key", "run").agg(start.cast("int").alias("span_start"), (end + span - start).cast("int").alias("span_len")).drop("run")


def shared_spans(records: DataFrame, span: int = SPAN, shingle: int = SHINGLE) -> DataFrame:
    return spans(shared_windows(records, span, shingle), span)


def report(records: DataFrame, found: DataFrame) -> DataFrame:
    """For each record: its words, how many of them are shared, the share, the number of spans and the longest."""
    words = F.size(F.filter(F.split("text", "[ \n]+"), lambda w: w != ""))
    sizes = records.groupBy("rec_table", "rec_key").agg(F.max(words).alias("n_words"))
    per = found.groupBy("rec_table", "rec_key").agg(F.sum("span_len").alias("shared_words"), F.count(F.lit(1)).alias("n_spans"), F.max("span_len").alias("longest"))
    joined = sizes.join(per, ["rec_table", "rec_key"], "left").na.fill(0, ["shared_words", "n_spans", "longest"])
    return joined.withColumn("shared_part", F.round(F.when(F.col("n_words") > 0, F.col("shared_words") / F.col("n_words")).otherwise(0.0), 6))


def clusters(windows: DataFrame, rounds: int = 50) -> DataFrame:
    """Components of records that share paragraphs: (rec_table, rec_key, cluster).

    Each shared paragraph links its records to the smallest of them (a star, never all pairs). Labels then
    spread by large-star and small-star steps until nothing changes; each step is written to the shared folder.
    """
    rec = F.concat_ws(":", "rec_table", "rec_key")
    members = windows.select(rec.alias("v"), "hash_a", "hash_b")
    hub = members.groupBy("hash_a", "hash_b").agg(F.min("v").alias("u"), F.count(F.lit(1)).alias("n"))
    edges = salted_join(members, hub, ["hash_a", "hash_b"], "n", "v", "inner").select("u", "v").distinct()
    edges = write_shared(edges, "links")
    nodes = edges.select("v").distinct()
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u <> v")
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).withColumn("m", F.least("m", "u"))
        large = salted_join(both.where("v > u"), low, ["u"], "n", "v", "inner").select(F.col("m").alias("u"), "v").distinct()
        down = large.union(large.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("v < u")
        least = down.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        small = salted_join(down, least, ["u"], "n", "v", "inner").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b").union(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
        after = write_shared(small.select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), "links")
        same = after.count() == edges.where("u <> v").count() and after.join(edges, ["u", "v"], "left_anti").isEmpty()
        edges = after
        if same:
            break
    else:
        raise RuntimeError(f"labels still changed after {rounds} rounds")
    label = nodes.join(edges.groupBy("v").agg(F.min("u").alias("cluster")), "v", "left").withColumn("cluster", F.coalesce("cluster", "v"))
    return label.select(F.substring_index("v", ":", 1).alias("rec_table"), F.expr("substring(v, locate(':', v) + 1)").alias("rec_key"), "cluster")


def removal(windows: DataFrame, span: int = SPAN) -> DataFrame:
    """(rec_table, rec_key, cluster, span_start, span_len) of the words that may be removed so that every shared paragraph stays once.

    Of a paragraph the copy in its first record stays (by rec_table, then rec_key as text); the others go, but for words that
    lie in a paragraph of which this record holds the copy that stays.
    """
    key = ["rec_table", "rec_key"]
    rec = F.concat_ws(":", *key)
    first = windows.groupBy("hash_a", "hash_b").agg(F.min(rec).alias("first"), F.count(F.lit(1)).alias("n"))
    judged = write_shared(salted_join(windows, first, ["hash_a", "hash_b"], "n", "rec_key", "inner").withColumn("stays", rec == F.col("first")), "judged")

    def edges(stays: bool, go: int, stay: int) -> DataFrame:
        found = spans(judged.where(F.col("stays") == stays), span)
        ends = F.array(F.struct(F.col("span_start").alias("at"), F.lit(1).alias("d")), F.struct((F.col("span_start") + F.col("span_len")).alias("at"), F.lit(-1).alias("d")))
        return found.select(*key, F.inline(ends)).select(*key, "at", (F.col("d") * go).alias("go"), (F.col("d") * stay).alias("stay"))

    both = edges(False, 1, 0).union(edges(True, 0, 1)).groupBy(*key, "at").agg(F.sum("go").alias("go"), F.sum("stay").alias("stay"))
    order = Window.partitionBy(*key).orderBy("at")
    swept = both.select(*key, "at", F.sum("go").over(order).alias("go"), F.sum("stay").over(order).alias("stay"), F.lead("at").over(order).alias("until"))
    out = swept.where("go > 0 and stay = 0").select(*key, F.col("at").alias("span_start"), (F.col("until") - F.col("at")).cast("int").alias("span_len"))
    return out.join(clusters(windows), key).select(*key, "cluster", "span_start", "span_len")
