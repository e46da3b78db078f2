"""S14-S16, S18. Pages that were fetched elsewhere, as tables (url, html): attempts, failures, and where things are read from and written to.

Nothing here opens a connection: the fetching side delivers one row for each attempt, with a null or blank ``html`` where it failed.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRIES = 3


def read_fetched(spark: SparkSession, path: str) -> DataFrame:
    """S14. (url, attempt, html) of every attempt."""
    return spark.read.parquet(path).select("url", "attempt", "html")


def loaded_pages(attempts: DataFrame, tries: int = TRIES) -> DataFrame:
    """S16. (url, html, attempt, loaded): of each url the first of its first ``tries`` attempts that succeeded; ``loaded`` is false, and html null, where none did."""
    worked = (F.col("attempt") <= tries) & F.coalesce(F.trim("html") != "", F.lit(False))
    first = F.min_by(F.when(worked, F.struct("html", "attempt")), F.when(worked, F.col("attempt"))).alias("_first")
    rows = attempts.groupBy("url").agg(first)
    return rows.select("url", "_first.html", "_first.attempt", F.col("_first").isNotNull().alias("loaded"))


def until_failure(pages: DataFrame, unit: str, page: str, loaded: str = "loaded") -> DataFrame:
    """S15. Pages of a unit before the first that was not loaded."""
    failed = pages.where(~F.col(loaded)).groupBy(unit).agg(F.min(page).alias("_failed"))
    return pages.join(failed, unit, "left").where(F.col("_failed").isNull() | (F.col(page) < F.col("_failed"))).drop("_failed")


@dataclass(frozen=True)
class Settings:
    """S18. Where a job reads and writes, from environment variables; a missing one that has no default is an error."""

    sources: str
    graph: str
    checkpoints: str
    name: str = "corpus"
    partitions: int = 200

    @staticmethod
    def from_environment(env: Mapping[str, str], prefix: str = "QIRTAS_") -> Settings:
        missing = [prefix + n for n in ("SOURCES", "GRAPH", "CHECKPOINTS") if not env.get(prefix + n)]
        if missing:
            raise ValueError(f"not set: {', '.join(missing)}")
        return Settings(env[prefix + "SOURCES"], env[prefix + "GRAPH"], env[prefix + "CHECKPOINTS"], env.get(prefix + "NAME") or "corpus", int(env.get(prefix + "PARTITIONS") or 200))

    def apply(self, spark: SparkSession) -> None:
        """Session settings that the job needs; a checkpoint folder that the cluster names stays."""
        if not spark.conf.get("spark.checkpoint.dir", None):
            spark.conf.set("spark.checkpoint.dir", self.checkpoints)
        spark.conf.set("spark.sql.shuffle.partitions", str(self.partitions))
