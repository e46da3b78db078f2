"""A property graph as DataFrames: one a node label, one an edge type and pair of labels.

A Graph is a value. Every change returns a new Graph whose tables are lazy plans over the old ones; nothing
runs before a count or a save. Edges to nodes that do not exist are never written, and ``edge_outcome`` tells how many that were.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qirtas.functions.normalize import YES
from qirtas.operators import quality

EdgeKey = tuple[str, str, str]


def last_per(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` of every key; null keys are keys. A partial aggregation, no window."""
    return _pick(rows, keys, order, F.max_by)


def first_per(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the least ``order`` of every key."""
    return _pick(rows, keys, order, F.min_by)


def _pick(rows: DataFrame, keys: Sequence[str], order: Sequence[str], by) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    if not rest:
        return rows.distinct()
    chosen = by(F.struct(*rest), F.struct(*order)).alias("_row")
    return rows.groupBy(*keys).agg(chosen).select(*keys, "_row.*").select(*rows.columns)


def confirmed(answer: str) -> bool:
    """N17. Whether an answer means yes."""
    return answer.strip().lower() in YES


def resilient(write: Callable[[int], None], tries: int = 5, wait: Callable[[float], None] = time.sleep) -> int:
    """W05. Call ``write(attempt)`` until it ends well, at most ``tries`` times, waiting 2, 4, 8 ... and at most 30 seconds between; the attempts
    it took. ``write`` must replace what an attempt before it left behind."""
    for attempt in range(tries):
        try:
            write(attempt)
            return attempt + 1
        except Exception:
            if attempt + 1 == tries:
                raise
            wait(min(2 ** (attempt + 1), 30))
    raise ValueError("no tries")


@dataclass(frozen=True)
class Graph:
    nodes: dict[str, DataFrame] = field(default_factory=dict)
    edges: dict[EdgeKey, DataFrame] = field(default_factory=dict)
    keys: dict[str, str] = field(default_factory=dict)
    writable: bool = True

    def _guard(self) -> None:
        if not self.writable:
            raise ValueError("this graph may only be read")

    # writing

    def create_nodes(self, label: str, rows: DataFrame, key: str) -> Graph:
        """Add nodes; existing ones of the label stay (rows are added, not merged)."""
        self._guard()
        old = self.nodes.get(label)
        return replace(self, nodes=self.nodes | {label: rows if old is None else old.unionByName(rows, allowMissingColumns=True)}, keys=self.keys | {label: key})

    def _ends(self, label: str, name: str) -> DataFrame:
        return self.nodes[label].select(F.col(self.keys[label]).alias(name))

    def resolve(self, rows: DataFrame, source: str, target: str) -> DataFrame:
        """Edge rows whose two ends exist; an end that stands twice multiplies the edge."""
        return rows.join(self._ends(source, "src_key"), "src_key").join(self._ends(target, "dst_key"), "dst_key").select(*rows.columns)

    def create_edges(self, kind: str, source: str, target: str, rows: DataFrame) -> Graph:
        self._guard()
        return self._with_edges((kind, source, target), self.resolve(rows, source, target))

    def _with_edges(self, key: EdgeKey, rows: DataFrame) -> Graph:
        old = self.edges.get(key)
        return replace(self, edges=self.edges | {key: rows if old is None else old.unionByName(rows, allowMissingColumns=True)})

    def edge_outcome(self, source: str, target: str, rows: DataFrame) -> DataFrame:
        """(given, written, dropped) of edge rows, in one row."""
        ends = [self._ends(label, name).distinct().withColumn(f"has_{name}", F.lit(True)) for label, name in ((source, "src_key"), (target, "dst_key"))]
        both = rows.join(ends[0], "src_key", "left").join(ends[1], "dst_key", "left")
        ok = F.count_if(F.coalesce("has_src_key", F.lit(False)) & F.coalesce("has_dst_key", F.lit(False)))
        return both.agg(F.count(F.lit(1)).alias("given"), ok.alias("written"), (F.count(F.lit(1)) - ok).alias("dropped"))

    def merge_edges(self, kind: str, source: str, target: str, rows: DataFrame) -> Graph:
        """Add edges that are not there yet; a pair of ends is one edge. An existing edge keeps its properties; of several new ones the least row stands."""
        self._guard()
        new = self.resolve(rows, source, target).withColumn("_new", F.lit(1))
        old = self.edges.get((kind, source, target))
        both = new if old is None else old.withColumn("_new", F.lit(0)).unionByName(new, allowMissingColumns=True)
        ends = ["src_key", "dst_key"]
        kept = first_per(both, ends, ["_new", *(c for c in both.columns if c not in [*ends, "_new"])]).drop("_new")
        return replace(self, edges=self.edges | {(kind, source, target): kept})

    def merge_edges_set(self, kind: str, source: str, target: str, rows: DataFrame, order: Sequence[str], keyed_by: Sequence[str] = ()) -> Graph:
        """Upsert: of edges with the same ends (and the same ``keyed_by`` properties) the last by ``order`` sets the rest."""
        self._guard()
        new = self.resolve(rows, source, target).withColumn("_new", F.lit(1))
        old = self.edges.get((kind, source, target))
        both = new if old is None else new.unionByName(old.withColumn("_new", F.lit(0)), allowMissingColumns=True)
        kept = last_per(both, ["src_key", "dst_key", *keyed_by], ["_new", *order]).drop("_new")
        return replace(self, edges=self.edges | {(kind, source, target): kept})

    def delete_nodes(self, label: str, doomed: DataFrame) -> Graph:
        """Remove the nodes whose key stands in the only column of ``doomed``, with every edge that touches them."""
        self._guard()
        gone = doomed.select(F.col(doomed.columns[0]).alias("_gone")).distinct()
        keep = lambda rows, name: rows.join(gone, F.col(name) == F.col("_gone"), "left_anti")
        edges = dict(self.edges)
        for (kind, source, target), rows in self.edges.items():
            if source == label:
                rows = keep(rows, "src_key")
            if target == label:
                rows = keep(rows, "dst_key")
            edges[kind, source, target] = rows
        return replace(self, nodes=self.nodes | {label: keep(self.nodes[label], self.keys[label])}, edges=edges)

    def delete_scope(self, hops: Sequence[EdgeKey], scope: Column) -> Graph:
        """Delete the nodes from which a chain of edges leads to a node that fits ``scope``: the first hop's sources go, and their edges."""
        label = hops[-1][2]
        reached = self.nodes[label].where(scope).select(F.col(self.keys[label]).alias("k"))
        for hop in reversed(hops):
            reached = self.edges[hop].join(reached, F.col("dst_key") == F.col("k"), "left_semi").select(F.col("src_key").alias("k"))
        return self.delete_nodes(hops[0][1], reached)

    def orphans(self, label: str, by: Sequence[EdgeKey]) -> DataFrame:
        """Nodes of ``label`` that none of the edge tables ``by`` touches."""
        used = reduce(DataFrame.union, [self.edges[k].select(F.col("src_key" if k[1] == label else "dst_key").alias("_used")) for k in by])
        return self.nodes[label].join(used, F.col(self.keys[label]) == F.col("_used"), "left_anti")

    def drop_orphans(self, label: str, by: Sequence[EdgeKey]) -> Graph:
        return self.delete_nodes(label, self.orphans(label, by).select(self.keys[label]))

    def create_under(self, label: str, rows: DataFrame, key: str, kind: str, parent: str, parent_key: str) -> Graph:
        """Nodes and their edge to a parent in one step: rows whose ``parent_key`` is no node of ``parent`` are not written. Parent keys must be unique."""
        ends = self._ends(parent, parent_key)
        quality.require_unique(ends.groupBy(parent_key).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), f"the key of {parent}")
        held = rows.join(ends, parent_key, "left_semi")
        edges = held.select(F.col(key).alias("src_key"), F.col(parent_key).alias("dst_key"))
        return self.create_nodes(label, held.drop(parent_key), key)._with_edges((kind, label, parent), edges)

    def clear(self, *labels: str, answer: str | None = None) -> Graph:
        """Without the nodes of ``labels`` (of all, if none is named) and every edge that touches them. An ``answer`` that is not yes leaves all as it is."""
        self._guard()
        if answer is not None and not confirmed(answer):
            return self
        gone = set(labels or self.nodes)
        return replace(self, nodes={k: v for k, v in self.nodes.items() if k not in gone}, edges={k: v for k, v in self.edges.items() if not gone & {k[1], k[2]}})

    # reading

    def match(self, kind: str, source: str, target: str, source_columns: Sequence[str] = (), target_columns: Sequence[str] = (), edge_columns: Sequence[str] = (), source_where: dict | None = None, target_where: dict | None = None) -> DataFrame:
        """One hop: src_key, dst_key, the edge's columns, and those of both ends as s_... and t_...; ends may be bound to property values."""
        rows = self.edges[kind, source, target].select("src_key", "dst_key", *edge_columns)
        for label, name, prefix, wanted, equal in ((source, "src_key", "s_", source_columns, source_where), (target, "dst_key", "t_", target_columns, target_where)):
            end = self.nodes_where(label, **(equal or {})).select(F.col(self.keys[label]).alias(name), *(F.col(c).alias(prefix + c) for c in wanted))
            rows = rows.join(end, name)
        return rows

    def nodes_where(self, label: str, **equal) -> DataFrame:
        """Nodes whose properties have the given values."""
        rows = self.nodes[label]
        for name, value in equal.items():
            rows = rows.where(F.col(name) == F.lit(value))
        return rows

    def star(self, *hops: EdgeKey) -> DataFrame:
        """Several patterns that share a node: (k, k0, k1, ...), the source of all hops and the target of each."""
        rows = None
        for i, hop in enumerate(hops):
            part = self.edges[hop].select(F.col("src_key").alias("k"), F.col("dst_key").alias(f"k{i}"))
            rows = part if rows is None else rows.join(part, "k")
        return rows

    def chain(self, *hops: EdgeKey) -> DataFrame:
        """Several hops head to tail: the keys k0, k1, ... of every path."""
        rows = self.edges[hops[0]].select(F.col("src_key").alias("k0"), F.col("dst_key").alias("k1"))
        for i, hop in enumerate(hops[1:], 1):
            rows = rows.join(self.edges[hop].select(F.col("src_key").alias(f"k{i}"), F.col("dst_key").alias(f"k{i + 1}")), f"k{i}")
        return rows

    def edges_of(self, kind: str) -> DataFrame:
        """All edges of a type, whatever they connect: kind, labels, and keys as strings."""
        parts = [rows.select(F.lit(k).alias("kind"), F.lit(s).alias("source_label"), F.lit(t).alias("target_label"), F.col("src_key").cast("string").alias("src_key"), F.col("dst_key").cast("string").alias("dst_key")) for (k, s, t), rows in self.edges.items() if k == kind]
        return reduce(DataFrame.union, parts)

    def reverse(self, kind: str, source: str, target: str, new_kind: str, **constants) -> Graph:
        """The edges turned round under another type; ``constants`` become properties."""
        turned = self.edges[kind, source, target].withColumnsRenamed({"src_key": "_k", "dst_key": "src_key"}).withColumnRenamed("_k", "dst_key")
        rows = turned.withColumns({k: F.lit(v) for k, v in constants.items()}) if constants else turned
        return replace(self, edges={k: v for k, v in self.edges.items() if k != (kind, source, target)} | {(new_kind, target, source): rows})

    def rename_edges(self, kind: str, source: str, target: str, new_kind: str, **constants) -> Graph:
        rows = self.edges[kind, source, target]
        rows = rows.withColumns({k: F.lit(v) for k, v in constants.items()}) if constants else rows
        return replace(self, edges={k: v for k, v in self.edges.items() if k != (kind, source, target)} | {(new_kind, source, target): rows})

    def rename_properties(self, label: str, names: dict[str, str], **constants) -> Graph:
        """A label's nodes with other names of properties, and with constant ones."""
        rows = self.nodes[label].withColumnsRenamed(names)
        rows = rows.withColumns({k: F.lit(v) for k, v in constants.items()}) if constants else rows
        return replace(self, nodes=self.nodes | {label: rows}, keys=self.keys | {label: names.get(self.keys[label], self.keys[label])})

    def copy_from(self, other: Graph, labels: Sequence[str], edges: Sequence[EdgeKey] = ()) -> Graph:
        """Nodes and edges of another graph, one to one; edges are matched with the nodes that are here."""
        out = self
        for label in labels:
            out = out.create_nodes(label, other.nodes[label], other.keys[label])
        for key in edges:
            out = out.create_edges(*key, other.edges[key])
        return out

    def counts(self) -> DataFrame:
        """(what, name, n): one row a label and an edge type with its labels."""
        parts = [rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit("node").alias("what"), F.lit(label).alias("name"), "n") for label, rows in self.nodes.items()]
        parts += [rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit("edge"), F.lit(":".join(key)), "n") for key, rows in self.edges.items()]
        return reduce(DataFrame.union, parts)

    # files

    def save(self, path: str, overwrite: bool = False, records_per_file: int = 0, answer: str | None = None, indexed: bool = False, tries: int = 1) -> None:
        """Write every table below ``path``; an existing graph is replaced only with ``overwrite``, or with an ``answer`` that means yes.

        ``indexed`` sorts every table by its key, so that the statistics of the files find a key; a table that fails is written again, ``tries`` times in all.
        """
        self._guard()
        overwrite = overwrite or (answer is not None and confirmed(answer))
        for name, rows in [*((f"nodes/{k}", v) for k, v in self.nodes.items()), *((f"edges/{'-'.join(k)}", v) for k, v in self.edges.items())]:
            if indexed:
                key = self.keys[name.removeprefix("nodes/")] if name.startswith("nodes/") else "src_key"
                rows = rows.repartitionByRange(key).sortWithinPartitions(key)
            writer = rows.write.option("maxRecordsPerFile", records_per_file) if records_per_file else rows.write

            def write(attempt: int, writer=writer, name=name) -> None:
                writer.mode("overwrite" if overwrite or attempt else "error").parquet(f"{path}/{name}")

            resilient(write, tries)

    @staticmethod
    def load(spark: SparkSession, path: str, labels: dict[str, str], edges: Sequence[EdgeKey], writable: bool = True) -> Graph:
        nodes = {label: spark.read.parquet(f"{path}/nodes/{label}") for label in labels}
        return Graph(nodes, {k: spark.read.parquet(f"{path}/edges/{'-'.join(k)}") for k in edges}, dict(labels), writable)

    @staticmethod
    def empty(spark: SparkSession, labels: Sequence[str], edges: Sequence[EdgeKey] = ()) -> Graph:
        """Labels and edge types with their schemas and no rows."""
        from qirtas import schema

        nodes = {k: spark.createDataFrame([], schema.node_schema(k)) for k in labels}
        return Graph(nodes, {k: spark.createDataFrame([], schema.edge_schema(*k)) for k in edges}, {k: schema.NODES[k][0] for k in labels})
