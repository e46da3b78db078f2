"""Lookups and matches of the loaders: last-wins maps, unique matches, fallbacks, interval expansion, null-safe remaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qirtas.graph import last_per


def last_wins_lookup(rows: DataFrame, table: DataFrame, on: Sequence[str], order: Sequence[str], how: str = "left") -> DataFrame:
    """J01-J03. Join with a table of which the last row a key counts."""
    return rows.join(last_per(table, on, order).drop(*(c for c in order if c not in on)), list(on), how)


def unique_match(rows: DataFrame, index: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    """J06. ``rows`` with ``value`` where the key has exactly one value in ``index``, else null; several hits and none are not told apart."""
    once = index.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"), F.min(value).alias(value)).where("_n = 1").drop("_n")
    return rows.join(once, list(on), "left")


def match_outcomes(matched: DataFrame, value: str, pair: Sequence[str]) -> DataFrame:
    """A12. (outcome, n): linked pairs, repeats of a linked pair, and rows without a match."""
    hits = matched.where(F.col(value).isNotNull())
    per_pair = hits.groupBy(*pair).agg(F.count(F.lit(1)).alias("n"))
    linked = per_pair.agg(F.count(F.lit(1)).alias("linked"), (F.coalesce(F.sum("n"), F.lit(0)) - F.count(F.lit(1))).alias("duplicate"))
    skipped = matched.agg(F.count_if(F.col(value).isNull()).alias("skipped"))
    return linked.join(F.broadcast(skipped)).select(F.inline(F.array(*(F.struct(F.lit(k).alias("outcome"), F.col(k).cast("long").alias("n")) for k in ("linked", "duplicate", "skipped")))))


def fallback_lookup(rows: DataFrame, names: DataFrame, key: str, value: str, fold) -> DataFrame:
    """J09. ``value`` by the exact name, else by the folded one. ``fold`` maps a Column; folded names must be unique."""
    exact = names.select(F.col(key).alias("_exact"), F.col(value).alias("_v1"))
    folded = names.select(fold(F.col(key)).alias("_folded"), F.col(value).alias("_v2"))
    both = rows.join(exact, F.col(key) == F.col("_exact"), "left").withColumn("_f", fold(F.col(key))).join(folded, F.col("_f") == F.col("_folded"), "left")
    return both.withColumn(value, F.coalesce("_v1", "_v2")).drop("_exact", "_folded", "_f", "_v1", "_v2")


def fold_collisions(names: DataFrame, key: str, fold) -> DataFrame:
    """C14, D10. Folded names that stand for more than one name."""
    return names.groupBy(fold(F.col(key)).alias("folded")).agg(F.countDistinct(key).alias("n_names")).where("n_names > 1")


def expand_ranges(rows: DataFrame, low: Column, high: Column, name: str) -> DataFrame:
    """J04. One row for each whole number of an interval, so that a range lookup becomes an equi join."""
    return rows.withColumn("_lo", low).withColumn("_hi", high).where("_lo <= _hi").withColumn(name, F.explode(F.sequence("_lo", "_hi"))).drop("_lo", "_hi")


def null_safe_remap(rows: DataFrame, mapping: DataFrame, key: str, value: str, strict: bool = True) -> DataFrame:
    """J11. Old keys to new ones where a null key is a key. With ``strict`` a key without a target raises when rows are read."""
    right = mapping.select(F.col(key).alias("_key"), F.col(value).alias(value), F.lit(True).alias("_hit"))
    out = rows.join(right, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    if strict:
        hit = F.when(F.col("_hit"), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("no new key for "), F.coalesce(F.col(key).cast("string"), F.lit("null")))).cast("boolean"))
        return out.where(hit).drop("_hit")
    return out.where("_hit").drop("_hit")


def not_seen(rows: DataFrame, seen: DataFrame, on: Sequence[str]) -> DataFrame:
    """J16, J17. Rows whose key was not seen before, once each."""
    return rows.join(seen.select(*on).distinct(), list(on), "left_anti").dropDuplicates(list(on))


def merge_sides(blocks: DataFrame, side: DataFrame, order: Sequence[str]) -> DataFrame:
    """J15, A07. (block_key, text): for each block (block_key, keys array) the side's texts of its keys, in the order of the keys.

    ``side`` is (key, group_key, text) and its last row a key by ``order`` counts. Every group counts once, at its first key; null texts are left
    out; texts are joined by a blank line; a block without any text has null.
    """
    exploded = blocks.select("block_key", F.posexplode("keys").alias("pos", "key"))
    hits = exploded.join(last_per(side, ["key"], order).select("key", "group_key", "text"), "key")
    firsts = hits.groupBy("block_key", "group_key").agg(F.min_by("text", "pos").alias("text"), F.min("pos").alias("pos"))
    listed = F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("pos", "text"))))
    texts = firsts.groupBy("block_key").agg(F.array_join(F.transform(listed, lambda x: x["text"]), "\n\n").alias("text"), F.count("text").alias("_n"))
    return blocks.select("block_key").distinct().join(texts, "block_key", "left").select("block_key", F.when(F.col("_n") > 0, F.col("text")).alias("text"))
