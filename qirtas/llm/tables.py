"""The project's tables as inputs of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def connect():
    """A DuckDB connection for one Python worker: one thread, bounded memory, and what exceeds it in Spark's own local folder."""
    import os
    import tempfile

    import duckdb

    folder = (os.environ.get("SPARK_LOCAL_DIRS") or tempfile.gettempdir()).split(",")[0]
    return duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": f"{folder}/duckdb-{os.getpid()}"})


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arabic_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rec_table, rec_key, text) of every hadith and tafsir row with Arabic text; rows delivered twice stand twice."""
    hadith = read(spark, sf_dir, "hadith").select(F.lit("hadith").alias("rec_table"), F.col("hadith_id").cast("string").alias("rec_key"), F.col("arabic_matn").alias("text"))
    tafsir = read(spark, sf_dir, "tafsir").select(F.lit("tafsir").alias("rec_table"), F.col("tafsir_id").alias("rec_key"), F.col("text_arabic").alias("text"))
    return hadith.union(tafsir).where("text is not null and rec_key is not null")
