"""S03-S13, W06-W09. Files: pages, CSV with a byte order mark, key sets, progress logs, small registries, append and quarantine sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qirtas.functions.normalize import strip


def read_pages(spark: SparkSession, path: str, book: str) -> DataFrame:
    """S03. The pages of a book; their order lives in sequence_num, not in the scan."""
    return spark.read.parquet(path).withColumn("book", F.lit(book))


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """S04, S05. CSV with a header; quotes are doubled inside quotes, lines may break there, a byte order mark is skipped. With a schema a bad value fails."""
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
    return (reader.schema(schema).option("mode", "FAILFAST") if schema else reader).csv(path)


def seen_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """S06. Distinct keys of rows written before."""
    return rows.select(*keys).distinct()


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """S07. (key) of every line of a progress log that is not blank."""
    return spark.read.text(path).select(strip(F.col("value")).alias("key")).where("key <> ''").distinct()


def mark_done(units: DataFrame, path: str) -> None:
    """W09. Add the units (one string column) to a progress log, one a line."""
    units.write.mode("append").text(path)


def decode_scalar(c: Column) -> Column:
    """S09. A scalar that was sent as JSON: strings lose their quotes, null and the empty string become null, what is no JSON stays as it is."""
    decoded = F.when(c.rlike('^".*"$'), F.from_json(F.concat(F.lit('{"v":'), c, F.lit("}")), "v string")["v"])
    return F.when((c == "") | (c == "null"), F.lit(None)).otherwise(F.coalesce(decoded, c))


def registry(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """S12. A small fixed table."""
    return spark.createDataFrame(list(rows), schema)


def catalog_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """S11. (table_name, n) of parquet tables; counts come from the files' footers."""
    out = None
    for name, path in paths.items():
        part = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = part if out is None else out.union(part)
    return out


def append_csv(rows: DataFrame, path: str, mark: bool = True) -> None:
    """W06, W07. Add rows to a folder of CSV files, each with its header and, with ``mark``, a byte order mark before it."""
    first, *rest = rows.columns
    rows = rows.toDF("\ufeff" + first, *rest) if mark else rows
    rows.write.mode("append").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def split_valid(rows: DataFrame, checks: Sequence[tuple[Column, str]]) -> tuple[DataFrame, DataFrame]:
    """P16, W08. (valid rows, quarantined rows with ``reason``): the first check that does not hold gives the reason."""
    reason = F.when(F.lit(False), F.lit(None).cast("string"))
    for holds, why in checks:
        reason = reason.when(~F.coalesce(holds, F.lit(False)), F.lit(why))
    judged = rows.withColumn("reason", reason)
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null")


def has_arabic(c: Column) -> Column:
    return c.rlike("[\\x{0600}-\\x{06FF}]")


def has_latin(c: Column) -> Column:
    return c.rlike("[A-Za-z]")
