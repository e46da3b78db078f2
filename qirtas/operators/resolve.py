"""Entity resolution: dictionaries of several sources merged under one key, dense ids, majority links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qirtas.functions.normalize import dedup_key, strip_homonym_suffix
from qirtas.graph import first_per, last_per
from qirtas.shared import write_shared


def dense_ids(rows: DataFrame, order: Sequence[str], name: str, start: int = 0) -> DataFrame:
    """O07-O09. Consecutive numbers in the order of ``order``, which must be total.

    Rows are sorted by range; each range is numbered by itself and moved by the rows of the ranges before it
    (one number a partition comes to the driver), so that no task sees more than its own range.
    """
    ranged = rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    table = write_shared(ranged, "ranges")
    before, offset = {}, start
    for part, n in sorted((r["_part"], r["count"]) for r in table.groupBy("_part").count().collect()):
        before[part], offset = offset, offset + n
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    if not before:
        return rows.withColumn(name, F.lit(None).cast("long"))
    moved = F.create_map(*(F.lit(x) for kv in before.items() for x in kv))[F.col("_part")]
    return table.withColumn(name, (within + moved).cast("long")).drop("_part")


def next_ids(rows: DataFrame, existing: DataFrame, key: str, order: Sequence[str], name: str) -> DataFrame:
    """O08, O09, E07. Rows whose key is not in ``existing`` get ids after its greatest."""
    top = existing.agg(F.coalesce(F.max(name) + 1, F.lit(0))).first()[0]
    new = first_per(rows, [key], order).join(existing.select(key).distinct(), key, "left_anti")
    return dense_ids(new, order, name, int(top))


def merge_roots(sources: Sequence[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """E01. Sources (old_id, text, english) in order of precedence -> (roots, id map).

    Roots: root_id, arabic_trilateral, english_trilateral. Map: source_rank, old_id, root_id. The first row of a
    key gives the spelling; within a source rows count by ascending old_id. A null key is a key.
    """
    rows = _ranked(sources, "old_id", "text", "english").withColumn("key", dedup_key(F.col("text")))
    winner = first_per(rows.select("key", "source_rank", "old_id", "text", "english"), ["key"], ["source_rank", "old_id"])
    roots = dense_ids(winner, ["source_rank", "old_id"], "root_id")
    ids = rows.join(roots.select(F.col("key").alias("_key"), "root_id"), F.col("key").eqNullSafe(F.col("_key"))).select("source_rank", "old_id", "root_id")
    return roots.select("root_id", F.col("text").alias("arabic_trilateral"), F.col("english").alias("english_trilateral")), ids


def merge_lemmas(sources: Sequence[DataFrame], enriching: int) -> tuple[DataFrame, DataFrame]:
    """E02. Sources (old_id, text, pos, frequency, source) in order of precedence -> (lemmas, id map).

    The first row of a key gives the text; if that is the ``enriching`` source, trailing digits go. The first row of that
    source sets pos, frequency and source. Ids are dense in the order of first appearance.
    """
    rows = _ranked(sources, "old_id", "text", "pos", "frequency", "source").withColumn("key", dedup_key(F.col("text")))
    ends = F.struct("source_rank", "old_id")
    richer = F.col("source_rank") == enriching
    extra = F.struct("pos", "frequency", "source")
    per = rows.groupBy("key").agg(F.min(ends).alias("at"), F.min_by("text", ends).alias("text"), F.min_by(F.when(richer, extra), F.when(richer, F.col("old_id"))).alias("extra"))
    flat = per.select("key", "at.source_rank", "at.old_id", "text", "extra.pos", "extra.frequency", "extra.source")
    lemmas = dense_ids(flat, ["source_rank", "old_id"], "lemma_id")
    ids = rows.join(lemmas.select(F.col("key").alias("_key"), "lemma_id"), F.col("key").eqNullSafe(F.col("_key"))).select("source_rank", "old_id", "lemma_id")
    text = F.when(F.col("source_rank") == enriching, strip_homonym_suffix(F.col("text"))).otherwise(F.col("text"))
    return lemmas.select("lemma_id", text.alias("text"), "pos", "frequency", "source"), ids


def _ranked(sources: Sequence[DataFrame], *columns: str) -> DataFrame:
    out = None
    for rank, rows in enumerate(sources):
        part = rows.select(F.lit(rank).alias("source_rank"), *columns)
        out = part if out is None else out.union(part)
    return out


def inferred_edges(lemma_words: DataFrame, root_words: DataFrame, place: str, order: Sequence[str], to_lemma: DataFrame, to_root: DataFrame) -> DataFrame:
    """E04, J13. (lemma_id, root_id, votes, n_values): the root that stands most often with a lemma.

    lemma_words and root_words (place, old_id, order...) give one lemma and one root a place, the last of each; to_lemma and to_root map old ids.
    """
    lemmas = last_per(lemma_words, [place], order).select(place, "old_id").join(to_lemma, "old_id").select(place, "lemma_id")
    roots = last_per(root_words, [place], order).select(place, "old_id").join(to_root, "old_id").select(place, "root_id")
    return majority(lemmas.join(roots, place), "lemma_id", "root_id", place)


def majority(rows: DataFrame, key: str, value: str, first: str) -> DataFrame:
    """A05, E04. (key, value, votes, n_values): the most frequent value of a key; of equals the one met first by ``first``, then the least."""
    votes = rows.groupBy(key, value).agg(F.count(F.lit(1)).alias("votes"), F.min(first).alias("_first"))
    best = F.min_by(F.struct(value, "votes"), F.struct((-F.col("votes")).alias("v"), "_first", value)).alias("_best")
    return votes.groupBy(key).agg(best, F.count(F.lit(1)).alias("n_values")).select(key, "_best.*", "n_values")
