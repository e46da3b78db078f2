"""T01-T04. Resumable ingest: a file stream, each key once across runs, valid rows and quarantine written per batch exactly once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qirtas.sources.files import split_valid


def stream_files(spark: SparkSession, path: str, schema: str, kind: str = "parquet", files_per_batch: int = 1_000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(kind).load(path)


def once_per_key(stream: DataFrame, keys: Sequence[str], watermark: str | None = None, delay: str = "1 day") -> DataFrame:
    """T02. The first row of every key. Without a watermark every key is remembered for good; with one (a timestamp column), for ``delay``."""
    if watermark:
        return stream.withWatermark(watermark, delay).dropDuplicatesWithinWatermark(list(keys))
    return stream.dropDuplicates(list(keys))


def ingest(stream: DataFrame, good: str, quarantine: str, checkpoint: str, checks: Sequence[tuple[Column, str]] = ()) -> None:
    """T01, T03. Take up what is new and stop. The checkpoint knows the work done, so a second run goes on where the first ended.

    Each batch writes to a folder of its own number, so that a batch that is repeated after a failure replaces itself.
    """

    def write(batch: DataFrame, number: int) -> None:
        kept, bad = split_valid(batch, checks)
        kept.write.mode("overwrite").parquet(f"{good}/batch={number}")
        if checks:
            bad.write.mode("overwrite").parquet(f"{quarantine}/batch={number}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def completed_units(rows: DataFrame, unit: str, loaded: str = "loaded") -> DataFrame:
    """H07, T03. (unit, completed, n): a unit is done only if each of its pages was loaded."""
    return rows.groupBy(unit).agg(F.bool_and(loaded).alias("completed"), F.count(F.lit(1)).alias("n"))


def until_last_page(pages: DataFrame, unit: str, page: str, last: str) -> DataFrame:
    """H06. Pages of a unit up to the greatest last page that their navigation (column ``last``) names."""
    named = pages.groupBy(unit).agg(F.max(last).alias("_last"))
    return pages.join(named, unit).where(F.col(page) <= F.col("_last")).drop("_last")


def until_nothing_new(pages: DataFrame, unit: str, page: str, key: str) -> DataFrame:
    """H05. Rows (unit, page, key) of pages before the first one of a unit that brings no key unseen on earlier pages, or is not there; first sight of a key only."""
    first = pages.where(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(unit, key).agg(F.min(page).alias(page))
    fresh = first.groupBy(unit, page).agg(F.count(F.lit(1)).alias("n"))
    numbered = fresh.groupBy(unit).agg(F.sort_array(F.collect_list(page)).alias("with_new"), F.min(page).alias("start"))
    # pages run from 1; the first gap in the pages with something new ends the unit
    last = F.size(F.filter("with_new", lambda x: F.array_position("with_new", x) == x))
    return first.join(numbered.select(unit, last.alias("last")), unit).where(F.col(page) <= F.col("last")).drop("last")
