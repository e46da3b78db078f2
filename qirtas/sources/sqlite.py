"""S01, S02, S11. SQLite tables as a Python data source: ``spark.read.format("sqlite").option("path", ...)``.

Options: ``path``, and ``query`` or ``table``; with ``partition_column`` and ``partitions`` a table is read in ranges of that whole-number column.
Filters on single columns are handed to SQLite.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructField, StructType

_SIGNS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
# by the affinity rules of SQLite, the first that fits
_TYPES = (("INT", LongType()), ("CHAR", StringType()), ("TEXT", StringType()), ("CLOB", StringType()), ("REAL", DoubleType()), ("FLOA", DoubleType()), ("DOUB", DoubleType()), ("BLOB", BinaryType()))


def _name(text: str) -> str:
    return '"' + text.replace('"', '""') + '"'


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


class Range(InputPartition):
    def __init__(self, condition: str, values: tuple) -> None:
        super().__init__(None)
        self.condition, self.values = condition, values


class SqliteReader(DataSourceReader):
    def __init__(self, options, schema: StructType) -> None:
        self.options, self.schema, self.filters = dict(options), schema, []

    def _from(self) -> str:
        return f"({self.options['query']})" if "query" in self.options else _name(self.options["table"])

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, (IsNull, IsNotNull)) and len(f.attribute) == 1:
                self.filters.append((f"{_name(f.attribute[0])} IS {'NOT ' * isinstance(f, IsNotNull)}NULL", ()))
            elif type(f) in _SIGNS and len(f.attribute) == 1 and isinstance(f.value, (int, float, str)):
                self.filters.append((f"{_name(f.attribute[0])} {_SIGNS[type(f)]} ?", (f.value,)))
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        column, parts = self.options.get("partition_column"), int(self.options.get("partitions", 1))
        if not column or parts < 2:
            return [Range("1", ())]
        with _open(self.options["path"]) as link:
            low, high = link.execute(f"SELECT min({_name(column)}), max({_name(column)}) FROM {self._from()}").fetchone()
        if low is None:
            return [Range("1", ())]
        step = max(1, -(-(high - low + 1) // parts))
        ranges = [Range(f"{_name(column)} >= ? AND {_name(column)} < ?", (x, x + step)) for x in range(low, high + 1, step)]
        return [*ranges, Range(f"{_name(column)} IS NULL", ())]

    def read(self, partition: Range) -> Iterator[tuple]:
        where = [partition.condition, *(c for c, _ in self.filters)]
        values = [*partition.values, *(v for _, vs in self.filters for v in vs)]
        columns = ", ".join(_name(f.name) for f in self.schema.fields)
        with _open(self.options["path"]) as link:
            yield from link.execute(f"SELECT {columns} FROM {self._from()} WHERE {' AND '.join(where)}", values)


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> StructType:
        """Declared types where a table is read; for a query, the types of its first row."""
        with _open(self.options["path"]) as link:
            if "table" in self.options:
                found = [(r[1], next((t for k, t in _TYPES if k in (r[2] or "").upper()), StringType())) for r in link.execute(f"PRAGMA table_info({_name(self.options['table'])})")]
            else:
                cursor = link.execute(self.options["query"])
                first = cursor.fetchone() or [None] * len(cursor.description)
                kinds = {int: LongType(), float: DoubleType(), bytes: BinaryType()}
                found = [(d[0], kinds.get(type(v), StringType())) for d, v in zip(cursor.description, first)]
        return StructType([StructField(n, t) for n, t in found])

    def reader(self, schema: StructType) -> SqliteReader:
        return SqliteReader(self.options, schema)


def read_sqlite(spark: SparkSession, path: str, table_or_query: str, schema: str | None = None, **options) -> DataFrame:
    spark.dataSource.register(SqliteSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format("sqlite").option("path", path).option("query" if " " in table_or_query.strip() else "table", table_or_query).options(**options)
    return (reader.schema(schema) if schema else reader).load()


def sqlite_catalog(path: str) -> list[tuple[str, int]]:
    """S11. Tables and their rows."""
    with _open(path) as link:
        names = [r[0] for r in link.execute("SELECT name FROM sqlite_master WHERE type = 'table' ORDER BY name")]
        return [(n, link.execute(f"SELECT count(*) FROM {_name(n)}").fetchone()[0]) for n in names]
