"""The project's references: word occurrences, tafsir verse lists and related-hadith links, against hadith, tafsir, lemma and ayah."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qirtas.operators.references import dated_by_child, orphans, per_period, references, targets
from qirtas.shared import write_shared


def _word_references(words: DataFrame) -> DataFrame:
    """References of word_occurrence. A location delivered again is one child, dated by its earliest delivery whatever it refers to.

    After the first aggregation a location has at most one row a lemma and source, so the window's groups are bounded by the lemma table.
    """
    each = words.where("location is not null").groupBy("location", "source", "top_lemma_id").agg(F.min("loaded_at").alias("loaded_at"))
    each = each.withColumn("loaded_at", F.min("loaded_at").over(Window.partitionBy("location")))
    last = F.length(F.substring_index("location", ":", -1))
    parent = F.when(F.contains("location", F.lit(":")), F.substring(F.col("location"), F.lit(1), F.length("location") - last - 1))
    both = F.array(
        F.struct(F.lit("word_occurrence.location").alias("ref_field"), F.col("source").alias("target_kind"), parent.alias("target_key")),
        F.struct(F.lit("word_occurrence.top_lemma_id").alias("ref_field"), F.lit("lemma").alias("target_kind"), F.col("top_lemma_id").cast("string").alias("target_key")),
    )
    rows = each.select(F.col("location").alias("child_key"), F.col("loaded_at").alias("child_at"), F.inline(both)).where("target_key is not null and target_kind is not null")
    return rows.groupBy("ref_field", "child_key", "target_kind", "target_key").agg(F.min("child_at").alias("child_at"))


def all_references(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    tafsir, related = read("tafsir"), dated_by_child(read("related_hadith"), "link_id", "tafsir_id", "hadith_id")
    entries = F.filter(F.transform(F.split("ayah_keys", ","), lambda x: F.trim(x)), lambda x: x != "")
    refs = _word_references(read("word_occurrence")).select("ref_field", "child_key", "target_kind", "target_key", "child_at")
    refs = refs.union(references(dated_by_child(tafsir, "tafsir_id", "ayah_keys"), "tafsir.ayah_keys", "ayah", "tafsir_id", entries))
    refs = refs.union(references(related, "related_hadith.tafsir_id", "tafsir", "link_id", F.col("tafsir_id")))
    refs = refs.union(references(related, "related_hadith.hadith_id", "hadith", "link_id", F.col("hadith_id")))
    known = targets(read("hadith"), "hadith", "hadith_id").union(targets(tafsir, "tafsir", "tafsir_id"))
    known = known.union(targets(read("lemma"), "lemma", "lemma_id")).union(targets(read("ayah"), "ayah", "verse_key"))
    return write_shared(refs, "references"), write_shared(known, "targets")


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orphans(*all_references(spark, sf_dir))
    return rows.withColumn("child_month", F.date_format("child_at", "yyyy-MM")).drop("child_at")


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return per_period(*all_references(spark, sf_dir))


FOUND_SQL = """
WITH wo AS (
  SELECT location, source, top_lemma_id, min(loaded_at) OVER (PARTITION BY location) AS child_at FROM word_occurrence WHERE location IS NOT NULL
), ta AS (
  SELECT tafsir_id, ayah_keys, min(loaded_at) OVER (PARTITION BY tafsir_id) AS child_at FROM tafsir WHERE tafsir_id IS NOT NULL
), rh AS (
  SELECT link_id, tafsir_id, hadith_id, min(loaded_at) OVER (PARTITION BY link_id) AS child_at FROM related_hadith WHERE link_id IS NOT NULL
), refs AS (
  SELECT DISTINCT 'word_occurrence.location' AS ref_field, location AS child_key, source AS kind, regexp_extract(location, '^(.*):[^:]*$', 1) AS target_key, child_at FROM wo
  UNION ALL SELECT DISTINCT 'word_occurrence.top_lemma_id', location, 'lemma', CAST(top_lemma_id AS VARCHAR), child_at FROM wo WHERE top_lemma_id IS NOT NULL
  UNION ALL SELECT DISTINCT 'tafsir.ayah_keys', tafsir_id, 'ayah', trim(k), child_at FROM (SELECT tafsir_id, child_at, unnest(string_split(ayah_keys, ',')) AS k FROM ta) WHERE trim(k) <> ''
  UNION ALL SELECT DISTINCT 'related_hadith.tafsir_id', CAST(link_id AS VARCHAR), 'tafsir', tafsir_id, child_at FROM rh WHERE tafsir_id IS NOT NULL
  UNION ALL SELECT DISTINCT 'related_hadith.hadith_id', CAST(link_id AS VARCHAR), 'hadith', CAST(hadith_id AS VARCHAR), child_at FROM rh WHERE hadith_id IS NOT NULL
), known AS (
  SELECT 'hadith' AS kind, CAST(hadith_id AS VARCHAR) AS target_key, min(loaded_at) AS target_at, bool_or(deleted_at IS NOT NULL) AS gone FROM hadith GROUP BY hadith_id
  UNION ALL SELECT 'tafsir', tafsir_id, min(loaded_at), bool_or(deleted_at IS NOT NULL) FROM tafsir GROUP BY tafsir_id
  UNION ALL SELECT 'lemma', CAST(lemma_id AS VARCHAR), min(loaded_at), bool_or(deleted_at IS NOT NULL) FROM lemma GROUP BY lemma_id
  UNION ALL SELECT 'ayah', verse_key, min(loaded_at), bool_or(deleted_at IS NOT NULL) FROM ayah GROUP BY verse_key
), judged AS (
  SELECT ref_field, child_key, refs.target_key, child_at,
    CASE WHEN known.target_key IS NULL THEN 'missing' WHEN gone THEN 'deleted' WHEN target_at > child_at THEN 'late' END AS orphan_kind
  FROM refs LEFT JOIN known ON refs.kind = known.kind AND refs.target_key = known.target_key
)"""
FOUND_ORACLE = FOUND_SQL + " SELECT ref_field, child_key, target_key, orphan_kind, strftime(child_at AT TIME ZONE 'UTC', '%Y-%m') AS child_month FROM judged WHERE orphan_kind IS NOT NULL"
MONTHLY_ORACLE = FOUND_SQL + """ SELECT ref_field, strftime(child_at AT TIME ZONE 'UTC', '%Y-%m') AS child_month, orphan_kind, count(*) AS n_references, count(DISTINCT target_key) AS n_targets
FROM judged WHERE orphan_kind IS NOT NULL GROUP BY ALL"""
