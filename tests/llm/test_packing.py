from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from qirtas.llm import packing


def check(rows, sizes, capacity):
    """Every piece once, no container over its capacity, pieces side by side, texts whole unless they are too large."""
    held, of = defaultdict(list), defaultdict(list)
    for r in rows:
        held[r.container].append((r["at"], r.size))
        of[r.doc_id].append((r.token_start, r.size))
    for parts in held.values():
        end = 0
        for at, size in sorted(parts):
            assert at == end
            end += size
        assert end <= capacity
    assert sorted(held) == list(range(len(held)))
    got = defaultdict(int)
    for doc, parts in of.items():
        got[doc] = sum(s for _, s in parts)
        assert all(s == capacity for _, s in sorted(parts)[:-1])
    assert dict(got) == sizes
    return len(held)


def test_pack(spark):
    rows = [(i, (i * 37) % 90 + 1, "x") for i in range(500)] + [(1_000, 250, "x"), (1_001, 100, None), (1_002, 200, ""), (1_003, None, "abc"), (1_004, None, None), (1_005, 0, ""), (1_006, -5, None)]
    frame = spark.createDataFrame(rows, "doc_id long, n_tokens int, text string").selectExpr("*", "'x' as size", "0 as bucket", "0 as container")
    sizes = {d: max(1, n if n is not None else len(t) + 1) for d, n, t in rows if n is not None or t is not None}
    out = packing.pack(frame, 100)
    n = check(out.collect(), sizes, 100)
    summary = packing.summary(out, 100).first()
    assert summary.containers == n and summary.least_possible <= n <= summary.least_possible * 1.02 + 1
    assert summary.unused == n * 100 - sum(sizes.values())


def test_repeated_rows_and_empty(spark):
    frame = spark.createDataFrame([(1, 60, "x")] * 3, "doc_id long, n_tokens int, text string")
    assert sorted(r.container for r in packing.pack(frame, 100).collect()) == [0, 1, 2]
    assert packing.pack(frame.limit(0), 100).collect() == []
    assert tuple(packing.summary(packing.pack(frame.limit(0), 100), 100).first()) == (0, 0, 0, 0, 0.0)


def one_by_one(sizes, capacity):
    """Best fit, largest first, on single documents."""
    gaps: list[int] = []
    for size in sorted(sizes, reverse=True):
        fits = [g for g in gaps if g >= size]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - size)
        else:
            gaps.append(capacity - size)
    return sorted(gaps)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=80))
def test_sweep_is_best_fit(sizes):
    counts = {s: sizes.count(s) for s in sizes}
    plan, opened = packing.sweep(counts, 30)
    assert opened == len(one_by_one(sizes, 30))
    used = defaultdict(int)
    for size, (ranks, firsts, filled) in plan.items():
        for k, start in enumerate(ranks):
            stop = ranks[k + 1] if k + 1 < len(ranks) else counts[size]
            for i in range(stop - start):
                # the rest of a run that opens containers fills them again later
                used[firsts[k] + i] += size
    assert sorted(30 - u for u in used.values()) == one_by_one(sizes, 30)


def test_invariants(spark):
    schema = "doc_id long, piece int, token_start long, size int, container long, at int"
    rows = [(1, 0, 0, 6, 0, 0), (2, 0, 0, 4, 0, 6), (3, 0, 0, 10, 1, 0), (3, 1, 10, 2, 2, 0), (4, 0, 0, 9, 2, 2), (5, 0, 0, 1, 3, 4)]
    got = {tuple(r) for r in packing.invariants(spark.createDataFrame(rows, schema), 10).collect()}
    assert got == {(1, 1, 6, 6, 0, 0), (2, 1, 4, 4, 0, 0), (3, 2, 12, 10, 1, 0), (4, 1, 9, 9, 1, 0), (5, 1, 1, 1, 0, 1)}
