"""References to records that do not exist: missing, deleted, or loaded only after the record that refers to them.

References are first aggregated per key and period, before anything is shuffled by key. Keys with very many
references (heavy ones, at most ``references / heavy`` in number) are checked against the broadcast part of the target
table that holds them; the remaining keys meet the targets in a shuffled join. Both parts together give
every orphan key with its kind, and those few keys are joined back to the references to list them.

Defined results: null references are no cases; rows with one child key are one child, dated by the
earliest of them; rows with one target key are one target, loaded at the earliest of them and deleted if any of them is;
empty tables give no rows (every reference into an empty table is missing); extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qirtas.operators.skew import HEAVY, salted_join
from qirtas.shared import write_shared


def dated_by_child(rows: DataFrame, key: str, *columns: str, loaded: str = "loaded_at", heavy: int = HEAVY) -> DataFrame:
    """Distinct (key, columns...) with the earliest ``loaded`` of the key in all its rows. Null keys are left out."""
    rows = rows.where(F.col(key).isNotNull())
    earliest = rows.groupBy(key).agg(F.min(loaded).alias(loaded), F.count(F.lit(1)).alias("_n"))
    return salted_join(rows.select(key, *columns).distinct(), earliest, [key], "_n", columns[0], "inner", heavy)


def references(rows: DataFrame, field: str, kind, child: str, target, loaded: str = "loaded_at") -> DataFrame:
    """Distinct (ref_field, child_key, target_kind, target_key, child_at) of one referring field.

    ``target`` is a Column, or an array Column of several targets; ``kind`` a Column or the name of the target table.
    """
    kind = kind if not isinstance(kind, str) else F.lit(kind)
    wide = rows.select(F.col(child).cast("string").alias("child_key"), kind.alias("target_kind"), target.alias("target_key"), F.col(loaded).alias("child_at"))
    if dict(wide.dtypes)["target_key"].startswith("array"):
        wide = wide.withColumn("target_key", F.explode("target_key"))
    wide = wide.withColumn("target_key", F.col("target_key").cast("string")).where("child_key is not null and target_key is not null")
    each = wide.groupBy("child_key", "target_kind", "target_key").agg(F.min("child_at").alias("child_at"))
    return each.select(F.lit(field).alias("ref_field"), "child_key", "target_kind", "target_key", "child_at")


def targets(rows: DataFrame, kind: str, key: str, loaded: str = "loaded_at", deleted: str | None = "deleted_at") -> DataFrame:
    """(target_kind, target_key, target_at, is_deleted): one row a key."""
    gone = F.bool_or(F.col(deleted).isNotNull()) if deleted else F.lit(False)
    grouped = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("target_key")).agg(F.min(loaded).alias("target_at"), gone.alias("is_deleted"))
    return grouped.select(F.lit(kind).alias("target_kind"), "target_key", "target_at", "is_deleted")


ON = ["ref_field", "target_kind", "target_key"]


def periods(refs: DataFrame) -> DataFrame:
    """References counted per key and month, with their first and last time: what is shuffled by key instead of the references."""
    month = F.date_format("child_at", "yyyy-MM").alias("child_month")
    return refs.groupBy(*ON, month).agg(F.count(F.lit(1)).alias("n"), F.min("child_at").alias("first"), F.max("child_at").alias("last"))


def orphan_keys(counted: DataFrame, known: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """(ref_field, target_kind, target_key, orphan_kind, target_at, n): keys with at least one orphan reference, from ``periods``."""
    on = ON[1:]
    keys = counted.groupBy(*ON).agg(F.sum("n").alias("n"), F.min("first").alias("first"))
    light, hot = keys.where(F.col("n") < heavy), keys.where(F.col("n") >= heavy)
    hot_targets = known.join(F.broadcast(hot.select(*on).distinct()), on, "left_semi")
    parts = light.join(known, on, "left").union(hot.join(F.broadcast(hot_targets), on, "left"))
    kind = F.when(F.col("is_deleted").isNull(), "missing").when(F.col("is_deleted"), "deleted").when(F.col("target_at") > F.col("first"), "late")
    return parts.withColumn("orphan_kind", kind).where("orphan_kind is not null").select(*ON, "orphan_kind", "target_at", "n")


def orphans(refs: DataFrame, known: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """(ref_field, child_key, target_key, orphan_kind, child_at) of every orphan reference."""
    found = salted_join(refs, orphan_keys(periods(refs), known, heavy), ON, "n", "child_key", "inner", heavy)
    late = (F.col("orphan_kind") != "late") | (F.col("target_at") > F.col("child_at"))
    return found.where(late).select("ref_field", "child_key", "target_key", "orphan_kind", "child_at")


def per_period(refs: DataFrame, known: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """(ref_field, child_month, orphan_kind, n_references, n_targets) of all orphan references.

    A month's references to a key are orphans all or none, but where the target came between the first and the last of
    them; only those references are counted one by one.
    """
    counted = write_shared(periods(refs), "periods")
    judged = write_shared(counted.join(orphan_keys(counted, known, heavy).drop("n"), ON), "judged")
    whole = (F.col("orphan_kind") != "late") | (F.col("target_at") > F.col("last"))
    split = judged.where(~whole & (F.col("target_at") > F.col("first")))
    month = F.date_format("child_at", "yyyy-MM")
    on = [*ON, "child_month"]
    each = salted_join(refs.withColumn("child_month", month), split.select(*on, "orphan_kind", "target_at", "n"), on, "n", "child_key", "inner", heavy)
    late = each.where("target_at > child_at").groupBy(*on, "orphan_kind").agg(F.count(F.lit(1)).alias("n"))
    both = judged.where(whole).select(*on, "orphan_kind", "n").union(late.select(*on, "orphan_kind", "n"))
    # one row a key and month on either side
    return both.groupBy("ref_field", "child_month", "orphan_kind").agg(F.sum("n").alias("n_references"), F.count(F.lit(1)).alias("n_targets"))
