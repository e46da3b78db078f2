"""Frequency of every distinct value or term, by suffix sorting.

Every term starts a suffix of its record: itself and the terms that follow, cut to ``SIGMA`` (3). Records are read in stretches of
neighbouring places, where equal suffixes are added up and every suffix is marked that brings a prefix (of one, two or three
terms) to its record for the first time; so the records of a prefix are a sum as well, and no sets of records are kept. Suffixes are
then routed by their first term, sorted in reverse lexicographic order, and read once with a stack: it holds the open prefixes of the
current suffix with their occurrences and records, and a prefix is popped and reported when a suffix comes that does not begin
with it. Terms are the prefixes of one term, n-grams those of any length. A first term that makes up a share of the
suffixes is spread over as large a share of the partitions; the partial counts are added up at the end.

Defined results: null and blank terms are left out and end a suffix; an occurrence is a distinct location, however often it is delivered;
of a location delivered with several terms each counts once, and the first delivery stands in suffixes of two or more; a record is a distinct
parent key, existing or not; a location whose last part is no whole number (from 0 on) has no neighbours, so it counts as a term
only; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qirtas.llm.vectors import as_array
from qirtas.operators.skew import salted_join
from qirtas.shared import write_shared

SIGMA, RARE, COMMON, STRETCH, HELD = 3, 2, 0.05, 4096, 100_000
_NO_PLACE = -2


def parent_key(location: Column) -> Column:
    """Everything before the last colon; null where there is none."""
    last = F.substring_index(location, ":", -1)
    return F.when(F.contains(location, F.lit(":")), F.substring(location, F.lit(1), F.length(location) - F.length(last) - 1))


def _first(*keys: np.ndarray) -> np.ndarray:
    """Whether each row is the first with its keys (whole numbers, from 0 on)."""
    out = np.zeros(len(keys[0]), bool)
    out[np.unique(_code(*keys), return_index=True)[1]] = True
    return out


def _code(*keys: np.ndarray) -> np.ndarray:
    """One number for each combination of keys, numbered anew after each so that none overflows."""
    code = keys[0].astype(np.int64)
    for key in keys[1:]:
        code = np.unique(code, return_inverse=True)[1] * (int(key.max(initial=0)) + 1) + key
    return code


def _changed(*columns: np.ndarray) -> np.ndarray:
    out = np.zeros(len(columns[0]), bool)
    if len(out):
        out[0] = True
        for c in columns:
            out[1:] |= c[1:] != c[:-1]
    return out


def _numbers(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    coded = as_array(column).dictionary_encode()
    return coded.dictionary, pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)


def suffixes(rows: DataFrame, fields: list[str], sigma: int, first_only: bool, stretch: int = STRETCH, held: int = HELD) -> DataFrame:
    """(field, t0, ..., n, new0, ..., salt, rec) of ``rows`` (rec, several, stretch, at, place and ``fields``), sorted by stretch of a record.

    ``n`` occurrences in the stretch; ``newK`` of them bring the prefix of K + 1 terms to their record. Of a record of ``several``
    stretches that cannot be told, so its rows carry ``rec`` and no such mark. ``first_only`` leaves out later deliveries of a place.
    """
    terms, news = [f"t{k}" for k in range(sigma)], [f"new{k}" for k in range(sigma)]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "field string, " + "".join(f"{t} string, " for t in terms) + "n long, " + "".join(f"{t} long, " for t in news) + "salt int, rec string"

    def of_field(name: str, table: pa.Table, group: np.ndarray, at: np.ndarray, place: np.ndarray) -> pa.RecordBatch | None:
        words, code = _numbers(table.column(name))
        known = np.flatnonzero(code >= 0)
        if not len(known):
            return None
        kept = known[_first(place[known], code[known])]
        g, a, t = group[kept], at[kept], code[kept]
        placed = a != _NO_PLACE
        head = np.flatnonzero(placed & _changed(g, a))  # the first delivery of each place
        chain = np.full((sigma, len(kept)), -1, np.int64)
        chain[0] = t
        follows = np.zeros(len(head), bool)
        follows[:-1] = (g[head[1:]] == g[head[:-1]]) & (a[head[1:]] == a[head[:-1]] + 1)
        before = t[head]
        for k in range(1, sigma):
            after = np.full(len(head), -1, np.int64)
            after[:-1] = np.where(follows[:-1], before[1:], -1)
            chain[k, head] = before = after
        own = ~placed | (a // stretch == table.column("stretch").to_numpy()[kept])
        if first_only:
            alone = np.zeros(len(kept), bool)
            alone[head] = True
            own &= alone | (~placed & _changed(place[kept]))
        own = np.flatnonzero(own)
        if not len(own):
            return None
        g, chain = g[own], chain[:, own] + 1  # 0 is no term
        several = table.column("several").to_numpy(zero_copy_only=False)[kept[own]]
        new = np.zeros((sigma, len(own)), np.int64)
        for k in range(sigma):
            there = np.flatnonzero((chain[k] > 0) & ~several)
            new[k, there] = _first(g[there], *chain[: k + 1, there]) if len(there) else 0
        _, at_first, to = np.unique(_code(*chain, np.where(several, g + 1, 0)), return_index=True, return_inverse=True)
        total = lambda x: np.bincount(to, x, len(at_first)).astype(np.int64)
        lead = chain[0, at_first]
        salts = np.ceil(parts * np.bincount(lead)[lead] / len(lead)).astype(np.int64)
        numbers = [pa.array(np.where(c > 0, c - 1, 0), mask=c == 0) for c in chain[:, at_first]]
        recs = as_array(table.column("rec")).take(pa.array(kept[own[at_first]]))
        columns = [
            pa.array([name] * len(lead)), *(words.take(x) for x in numbers), pa.array(total(np.ones(len(own)))), *(pa.array(total(x)) for x in new),
            pa.array((np.arange(len(lead)) % salts).astype(np.int32)), pc.if_else(pa.array(several[at_first]), recs, pa.scalar(None, pa.string())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["field", *terms, "n", *news, "salt", "rec"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chunk(table: pa.Table, last: bool) -> tuple[list[pa.RecordBatch], pa.Table]:
            """The suffixes of the whole stretches in ``table``, and the rows of its last one, of which more may come."""
            rec, part = _numbers(table.column("rec"))[1], table.column("stretch").to_numpy()
            group = np.cumsum(_changed(rec, part)) - 1
            at = pc.fill_null(as_array(table.column("at")), _NO_PLACE).to_numpy(zero_copy_only=False).astype(np.int64)
            place = np.cumsum(_changed(group, at, _numbers(table.column("place"))[1])) - 1
            whole = table.num_rows if last else int(np.searchsorted(group, group[-1]))
            done = [b for name in fields if whole and (b := of_field(name, table.slice(0, whole), group[:whole], at[:whole], place[:whole])) is not None]
            rest = np.arange(whole, table.num_rows)
            if len(rest) >= held // 2:  # deliveries that say nothing new
                rest = rest[_first(place[rest], *(_numbers(table.column(name))[1][rest] + 1 for name in fields))]
            return done, table.take(pa.array(rest))

        waiting: list[pa.RecordBatch] = []
        n = 0
        limit = held
        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                n += batch.num_rows
            if n >= limit:
                out, rest = chunk(pa.Table.from_batches(waiting).combine_chunks(), False)
                waiting, n = rest.to_batches(), rest.num_rows
                limit = max(held, 2 * n)
                yield from out
        if n:
            yield from chunk(pa.Table.from_batches(waiting).combine_chunks(), True)[0]

    return rows.mapInArrow(run, schema)


def prefix_counts(routed: DataFrame, sigma: int, depths: int) -> DataFrame:
    """(field, terms, occurrences, records) of every prefix of up to ``depths`` terms of the suffixes, by a stack over their reverse order."""
    terms = [f"t{k}" for k in range(sigma)]
    ordered = routed.repartition("field", "t0", "salt").sortWithinPartitions("field", *(F.desc_nulls_last(t) for t in terms)).select("field", *terms, "n", *(f"new{k}" for k in range(sigma)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple | None] = [None] * depths  # (field, terms, occurrences, records) of the open prefix of each length
        last: tuple | None = None

        def popped(depth: int) -> list[tuple]:
            out, stack[depth] = ([stack[depth]] if stack[depth] else []), None
            return out

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = pa.string(), pa.list_(pa.string()), pa.int64(), pa.int64()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["field", "terms", "occurrences", "records"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [as_array(batch.column(k)) for k in range(sigma + 1)]
            n = batch.column(sigma + 1).to_numpy()
            codes = [_numbers(c)[1] for c in columns]
            begins = np.zeros(batch.num_rows, bool)
            for depth in range(depths):
                for k in (0, 1) if depth == 0 else (depth + 1,):
                    begins[1:] |= codes[k][1:] != codes[k][:-1]
                    begins[0] |= last is None or last[k] != columns[k][0].as_py()
                starts = np.flatnonzero(begins)
                new = batch.column(sigma + 2 + depth).to_numpy()
                until = int(starts[0]) if len(starts) else batch.num_rows
                if until and stack[depth]:  # the open prefix goes on
                    field, words, a, b = stack[depth]
                    stack[depth] = field, words, a + int(n[:until].sum()), b + int(new[:until].sum())
                if not len(starts):
                    continue
                closed = popped(depth)
                sums = [np.add.reduceat(x, starts) for x in (n, new)]
                there = np.flatnonzero(codes[depth + 1][starts] >= 0)  # a suffix of fewer terms has no prefix of this length
                inner = there[there < len(starts) - 1]
                heads = [c.take(pa.array(starts[inner])) for c in columns[: depth + 2]]
                if len(inner):
                    flat = pa.concat_arrays(heads[1:]).take(pa.array(np.arange(len(inner) * (depth + 1)).reshape(depth + 1, -1).T.reshape(-1)))
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(inner) + 1) * (depth + 1), pa.int32()), flat)
                    yield pa.RecordBatch.from_arrays([heads[0], lists, pa.array(sums[0][inner]), pa.array(sums[1][inner])], names=["field", "terms", "occurrences", "records"])
                if len(there) and there[-1] == len(starts) - 1:
                    at = int(starts[-1])
                    stack[depth] = columns[0][at].as_py(), [c[at].as_py() for c in columns[1 : depth + 2]], int(sums[0][-1]), int(sums[1][-1])
                if closed:
                    yield batch_of(closed)
            last = tuple(c[batch.num_rows - 1].as_py() for c in columns)
        if rest := [row for depth in range(depths) for row in popped(depth)]:
            yield batch_of(rest)

    return ordered.mapInArrow(read, "field string, terms array<string>, occurrences long, records long")


def _placed(occurrences: DataFrame) -> DataFrame:
    """Occurrences with the parts of their location: rec, place, and at, the place as a whole number from 0 on."""
    place = F.substring_index("location", ":", -1)
    at = place.try_cast("int")
    return occurrences.where("location is not null").select(
        F.coalesce(parent_key(F.col("location")), F.lit("")).alias("rec"), place.alias("place"), F.when(at >= 0, at).alias("at"), "loaded_at", "occ_id",
        F.when(~F.col("surface_norm").rlike("(?U)^\\s*$"), F.col("surface_norm")).alias("surface_norm"), F.col("top_lemma_id").cast("string").alias("lemma"),
    )


def counts(occurrences: DataFrame, fields: list[str], depths: int, sigma: int = SIGMA, first_only: bool = False, several: bool | None = None, stretch: int = STRETCH) -> DataFrame:
    """(field, terms, occurrences, records) of every prefix of up to ``depths`` terms. ``several``: whether a record has more than one
    stretch, looked up here if not given. Places without a number are stretches of their own, by hash."""
    rows = _placed(occurrences).select("rec", "place", "at", "loaded_at", "occ_id", *fields)
    several = bool(rows.agg(F.max(_beyond(stretch))).first()[0]) if several is None else several
    own = F.when(F.col("at").isNull(), -1 - F.pmod(F.xxhash64("place"), F.lit(64))).otherwise(F.floor(F.col("at") / stretch)).cast("int")
    if several:
        # records of more than one stretch; the first places of a stretch are read with the one before too
        long = rows.where(_beyond(stretch)).groupBy("rec").agg(F.count(F.lit(1)).alias("k"), F.lit(True).alias("several"))
        rows = salted_join(rows, long, ["rec"], "k", "place", "left").withColumn("several", F.coalesce("several", F.lit(False)))
        also = F.when((own > 0) & (F.pmod("at", F.lit(stretch)) < sigma - 1), F.array(own, own - 1)).otherwise(F.array(own))
        rows = rows.withColumn("stretch", F.explode(also))
    else:
        rows = rows.withColumns({"several": F.lit(False), "stretch": F.lit(0)})
    ordered = rows.repartition("rec", "stretch").sortWithinPartitions("rec", "stretch", "at", "place", "loaded_at", "occ_id").select("rec", "several", "stretch", "at", "place", *fields)
    found = suffixes(ordered, fields, sigma, first_only, stretch)
    if several:
        found = write_shared(found, "suffixes")
    parts = prefix_counts(found, sigma, depths)
    if several:
        terms = [F.col(f"t{k}") for k in range(sigma)]
        prefixes = F.array(*(F.when(terms[k].isNotNull(), F.array(*terms[: k + 1])) for k in range(depths)))
        more = found.where("rec is not null").select("field", F.explode(F.array_compact(prefixes)).alias("terms"), "rec").distinct()
        parts = parts.union(more.groupBy("field", "terms").agg(F.lit(0).cast("long").alias("occurrences"), F.count(F.lit(1)).alias("records")))
    return parts.groupBy("field", "terms").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))


def _beyond(stretch: int) -> Column:
    """Whether a row lies outside the first stretch of its record."""
    return F.col("at").isNull() | (F.col("at") >= stretch)


def term_counts(occurrences: DataFrame, sigma: int = SIGMA, several: bool | None = None, stretch: int = STRETCH) -> DataFrame:
    """(field, term, occurrences, records) of every surface_norm and every top_lemma_id (field 'lemma')."""
    found = counts(occurrences, ["surface_norm", "lemma"], 1, sigma, False, several, stretch)
    return found.select("field", F.get("terms", F.lit(0)).alias("term"), "occurrences", "records")


def ngram_counts(occurrences: DataFrame, sigma: int = SIGMA, least: int = 1, stretch: int = STRETCH) -> DataFrame:
    """(terms, occurrences, records) of every run of up to ``sigma`` neighbouring words that occurs ``least`` times, by default all of them.

    The words of a record are in the order of their places; of a place delivered more than once the first delivery stands.
    """
    found = counts(occurrences, ["surface_norm"], sigma, sigma, True, None, stretch)
    return found.where(F.col("occurrences") >= least).select("terms", "occurrences", "records")


def marks(occurrences: DataFrame, lemmas: DataFrame, rare: int = RARE, common: float = COMMON) -> DataFrame:
    """(field_name, term, mark): terms in at most ``rare`` records, in more than ``common`` of all records, and lemmas
    whose stored frequency is not the number of their locations (none counts as 0). Lemmas are those of the lemma table."""
    records = _placed(occurrences).groupBy("rec").agg(F.max(_beyond(STRETCH)).alias("beyond"))
    total, several = records.agg(F.count(F.lit(1)), F.max("beyond")).first()
    found = term_counts(occurrences, several=bool(several))
    known = lemmas.where("lemma_id is not null").groupBy(F.col("lemma_id").cast("string").alias("term")).agg(F.min("frequency").alias("least"), F.max("frequency").alias("most"))
    # one pass gives both fields: every term meets the lemma table, and lemmas that never occur count 0
    known = known.select(F.lit("lemma").alias("field"), "term", "least", "most", F.lit(True).alias("known"))
    rows = found.join(known, ["field", "term"], "full").na.fill(0, ["occurrences", "records"]).where("field <> 'lemma' or known")
    several = F.array_compact(
        F.array(
            F.when(F.col("records").between(1, rare), F.lit("rare")),
            F.when(F.col("records") > common * total, F.lit("common")),
            F.when((F.col("least") != F.col("occurrences")) | (F.col("most") != F.col("occurrences")), F.lit("stale")),
        )
    )
    return rows.select(F.col("field").alias("field_name"), "term", F.explode(several).alias("mark"))
