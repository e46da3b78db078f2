"""Filling containers of fixed capacity with texts, by bulk-synchronous best fit.

Sizes are whole numbers up to the capacity, so documents of one size, and containers with one gap, are interchangeable:
the sorted documents are runs of equal size, the sorted gaps runs of equal room. Each superstep takes all
documents of the next smaller size at once. A successor sweep gives them the smallest gaps that hold them, in
the order of their ranks; a gap taken by one rank is closed to the next, which moves to the following gap; gaps are updated
and the step repeats until no gap holds this size, whereupon the ranks left over open new containers. The sweeps, and so the supersteps, need only
the number of documents of each size, at most ``capacity`` numbers whatever the data, and therefore run on the driver; what is distributed is the
range-sort that gives every document its rank within its size, and looking up its container by that rank.

Defined results: a text larger than the capacity is divided into full pieces and a rest, every other text stays whole.
A null size is computed from the text (UTF-8 bytes and one end mark); rows without size and text have nothing to place
and give no row; sizes below 1 count as 1; repeated rows are texts of their own; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CAPACITY, RANKED = 2048, 1_000_000
Plan = dict[int, tuple[list[int], list[int], list[int]]]


def sweep(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[Plan, int]:
    """For each size the first rank, first container and filled room of every run of its documents; and the number of containers."""
    plan: Plan = {}
    free: dict[int, deque[tuple[int, int]]] = defaultdict(deque)  # gap -> runs (first container, how many)
    order: list[int] = []  # gaps that have runs, sorted
    opened = 0

    def add(gap: int, run: tuple[int, int]) -> None:
        if gap not in free or not free[gap]:
            insort(order, gap)
        free[gap].append(run)

    for size in sorted(counts, reverse=True):
        left, rank = counts[size], 0
        ranks: list[int] = []
        firsts: list[int] = []
        filled: list[int] = []

        def place(first: int, n: int, gap: int, each: int) -> None:
            """``each`` documents of this size into each of ``n`` containers with this gap."""
            nonlocal left, rank
            for k in range(each):
                ranks.append(rank)
                firsts.append(first)
                filled.append(capacity - gap + k * size)
                rank += n
            left -= n * each
            if gap > each * size:
                add(gap - each * size, (first, n))

        while left:
            at = bisect_left(order, size)
            if at == len(order):
                gap, n = capacity, -(-left // (capacity // size))
                first, opened = opened, opened + n
            else:
                gap = order[at]
                first, n = free[gap].popleft()
                if not free[gap]:
                    order.pop(at)
            # the smallest gap stays the smallest while it holds another document of this size
            each = gap // size
            full = min(n, left // each)
            if full:
                place(first, full, gap, each)
            if full < n and left:
                place(first + full, 1, gap, left)
                full += 1
            if full < n:
                add(gap, (first + full, n - full))
        plan[size] = ranks, firsts, filled
    return plan, opened


def pieces(documents: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, token_start, size): one row a text, several where it exceeds the capacity. The text is read only where a size is missing."""
    sized = documents.where("n_tokens is not null").select("doc_id", F.col("n_tokens").cast("long").alias("n"))
    unsized = documents.where("n_tokens is null and text is not null").select("doc_id", (F.octet_length("text") + 1).cast("long").alias("n"))
    rows = sized.union(unsized).withColumn("n", F.greatest("n", F.lit(1)))
    last = F.expr(f"(n - 1) div {capacity}")
    rows = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last))).withColumn("token_start", F.col("piece") * capacity)
    return rows.select("doc_id", F.col("piece").cast("int").alias("piece"), "token_start", F.least(F.col("n") - F.col("token_start"), F.lit(capacity)).cast("int").alias("size"))


def pack(documents: DataFrame, capacity: int = CAPACITY, ranked: int = RANKED) -> DataFrame:
    """(doc_id, piece, token_start, size, container, at): every piece in one container, beginning at token ``at`` of it.

    Ranks are given in buckets of about ``ranked`` documents of one size, so no task sorts more, however many documents share a size.
    """
    rows = pieces(documents, capacity)
    buckets = rows.groupBy("size").agg(F.ceil(F.count(F.lit(1)) / ranked).alias("buckets"))
    rows = rows.join(F.broadcast(buckets), "size")  # at most ``capacity`` rows
    rows = rows.select("doc_id", "piece", "token_start", "size", F.pmod(F.xxhash64("doc_id", "piece"), F.col("buckets")).cast("int").alias("bucket"))
    counted = rows.groupBy("size", "bucket").agg(F.count(F.lit(1)).alias("n")).collect()  # at most capacity + rows / ranked
    totals: dict[int, int] = defaultdict(int)
    before: dict[tuple[int, int], int] = {}
    for size, key, n in sorted(counted):
        before[size, key] = totals[size]
        totals[size] += n
    plan, _ = sweep(totals, capacity)
    arrays = {size: tuple(np.array(x, np.int64) for x in runs) for size, runs in plan.items()}
    shared = documents.sparkSession.sparkContext.broadcast((before, arrays))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("size", "bucket").orderBy("doc_id", "piece")) - 1)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, plans = shared.value
        for batch in batches:
            size, key, rank = (batch.column(n).to_numpy() for n in ("size", "bucket", "rank"))
            container, at = np.zeros(len(size), np.int64), np.zeros(len(size), np.int32)
            # rows come by size and bucket
            begins = np.flatnonzero(np.append(True, (size[1:] != size[:-1]) | (key[1:] != key[:-1]))) if len(size) else []
            for i, until in zip(begins, [*begins[1:], len(size)]):
                ranks, firsts, filled = plans[int(size[i])]
                r = rank[i:until] + starts[int(size[i]), int(key[i])]
                k = np.searchsorted(ranks, r, side="right") - 1
                container[i:until], at[i:until] = firsts[k] + r - ranks[k], filled[k]
            kept = [batch.column(n) for n in ("doc_id", "piece", "token_start", "size")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(container), pa.array(at)], names=["doc_id", "piece", "token_start", "size", "container", "at"])

    return ranked.mapInArrow(look_up, f"doc_id {dict(documents.dtypes)['doc_id']}, piece int, token_start long, size int, container long, at int")


def invariants(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, n_pieces, tokens, largest, n_overfull, n_misplaced) of each text in a filling: its pieces, their sum and the largest, how many of them lie
    in a container that holds more than ``capacity``, and how many do not begin where the piece before ends (or at 0)."""
    container = Window.partitionBy("container")  # at most ``capacity`` pieces
    ends = F.lag(F.col("at") + F.col("size")).over(container.orderBy("at"))
    rows = packed.select("doc_id", "size", F.sum("size").over(container).alias("used"), (F.col("at") != F.coalesce(ends, F.lit(0))).alias("misplaced"))
    return rows.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_pieces"), F.sum("size").alias("tokens"), F.max("size").alias("largest"), F.count_if(F.col("used") > capacity).alias("n_overfull"), F.count_if("misplaced").alias("n_misplaced")
    )


def summary(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(containers, least_possible, tokens, unused, unused_part) of a filling."""
    each = packed.groupBy("container").agg(F.sum("size").alias("used"))
    total = each.agg(F.count(F.lit(1)).alias("containers"), F.coalesce(F.sum("used"), F.lit(0)).alias("tokens"))
    unused = F.col("containers") * capacity - F.col("tokens")
    return total.select("containers", F.ceil(F.col("tokens") / capacity).alias("least_possible"), "tokens", unused.alias("unused"), F.round(unused / F.greatest(F.col("containers") * capacity, F.lit(1)), 6).alias("unused_part"))
