"""D01-D11. Checks that return rows, and guards that raise."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def within(actual: Column, expected: Column, tolerance: float = 0.1) -> Column:
    """D02. Whether a count lies within a part of the expected one; an expectation of 0 always passes."""
    return F.when(expected == 0, True).otherwise(F.abs(actual - expected) <= tolerance * expected)


def check_counts(counts: DataFrame, expected: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """D01, D04. Counts (name, n) against expectations (name, expected): (name, n, expected, ok); what is not there counts 0."""
    both = expected.join(counts.select("name", "n"), "name", "left").na.fill(0, ["n"])
    return both.select("name", "n", "expected", within(F.col("n"), F.col("expected"), tolerance).alias("ok") if tolerance else (F.col("n") == F.col("expected")).alias("ok"))


def coverage(rows: DataFrame, column: str, whole: DataFrame, key: str) -> DataFrame:
    """D03, A02. (covered, total, part): how many distinct keys of ``whole`` the rows name."""
    total = whole.select(F.countDistinct(key).alias("total"))
    covered = rows.select(F.col(column).alias(key)).join(whole.select(key).distinct(), key, "left_semi").agg(F.countDistinct(key).alias("covered"))
    return covered.join(F.broadcast(total)).select("covered", "total", F.round(F.col("covered") / F.col("total"), 6).alias("part"))


def conserved(parts: Sequence[DataFrame], whole: DataFrame) -> DataFrame:
    """D05. (sum_of_parts, whole, ok): nothing was lost or made in a union."""
    one = lambda rows, name: rows.agg(F.count(F.lit(1)).alias(name))
    total = None
    for part in parts:
        total = one(part, "n") if total is None else total.union(one(part, "n"))
    return total.agg(F.sum("n").alias("sum_of_parts")).join(F.broadcast(one(whole, "whole"))).withColumn("ok", F.col("sum_of_parts") == F.col("whole"))


def shrunk(merged: DataFrame, sources: Sequence[DataFrame]) -> DataFrame:
    """D06. (merged, naive, ok): merging joined at least two rows."""
    return conserved(sources, merged).select(F.col("whole").alias("merged"), F.col("sum_of_parts").alias("naive"), (F.col("whole") < F.col("sum_of_parts")).alias("ok"))


def ratio(rows: DataFrame, condition: Column, by: Sequence[str] = ()) -> DataFrame:
    """D08, A04. (by..., total, hits, part)."""
    hits = F.count_if(condition)
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), hits.alias("hits"), F.round(hits / F.count(F.lit(1)), 6).alias("part"))


def missing_properties(rows: DataFrame, properties: Sequence[str]) -> DataFrame:
    """D07. (property, n, n_missing): how many rows lack a property that each must have."""
    counts = rows.agg(F.count(F.lit(1)).alias("n"), *(F.count_if(F.col(p).isNull()).alias(p) for p in properties))
    return counts.select("n", F.inline(F.array(*(F.struct(F.lit(p).alias("property"), F.col(p).alias("n_missing")) for p in properties)))).select("property", "n", "n_missing")


def require_rows(tables: dict[str, DataFrame]) -> None:
    """D09. Raise unless every table has a row."""
    if empty := [name for name, rows in tables.items() if rows.isEmpty()]:
        raise ValueError(f"nothing in {', '.join(empty)}; load it first")


def require_unique(collisions: DataFrame, what: str) -> None:
    """D10. Raise if there is any collision."""
    if found := collisions.take(3):
        raise ValueError(f"{what} is not unique: {found}")


def require_known(given: Iterable[str], known: Iterable[str]) -> None:
    """D11, U04. Raise on a name that is not known."""
    if unknown := sorted(set(given) - set(known)):
        raise ValueError(f"unknown: {', '.join(unknown)}")
