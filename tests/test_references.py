import random
from collections import Counter, defaultdict
from datetime import datetime

from pyspark.sql import functions as F

from qirtas.operators.references import orphans, per_period, references, targets


def at(day):
    return datetime(2024, 1, 1 + day)


def tables(spark):
    child = spark.createDataFrame(
        [(1, "a", at(5)), (1, "a", at(9)), (2, "b", at(5)), (3, "c", at(5)), (4, "d", at(5)), (5, None, at(5)), (6, "e", at(5)), (None, "a", at(1)), (7, "f", None)],
        "id long, t string, loaded_at timestamp",
    ).withColumn("target_at", F.lit(1))
    target = spark.createDataFrame([("a", at(7), None), ("a", at(8), None), ("b", at(1), None), ("b", at(2), at(3)), ("c", at(6), None), ("e", at(5), None), (None, at(1), None), ("f", at(1), None)], "k string, loaded_at timestamp, deleted_at timestamp")
    refs = references(child, "x.t", "target", "id", F.col("t"))
    return refs, targets(target, "target", "k")


def test_kinds(spark):
    refs, known = tables(spark)
    for heavy in (1, 2, 10**6):
        got = {(r.child_key, r.target_key, r.orphan_kind) for r in orphans(refs, known, heavy).collect()}
        assert got == {("1", "a", "late"), ("2", "b", "deleted"), ("3", "c", "late"), ("4", "d", "missing")}


def test_empty_tables(spark):
    refs, known = tables(spark)
    assert orphans(refs.limit(0), known).collect() == []
    assert {r.orphan_kind for r in orphans(refs, known.limit(0)).collect()} == {"missing"}
    assert per_period(refs.limit(0), known).collect() == []


def test_periods(spark):
    """Months that lie before a target, behind it, or hold its time."""
    rng = random.Random(3)
    day = lambda: datetime(2024, rng.randrange(1, 7), rng.randrange(1, 28))
    child = [(i, rng.choice(["hot"] * 5 + [f"t{k}" for k in range(30)]), day()) for i in range(600)]
    target = [(f"t{k}", day(), day() if k % 7 == 0 else None) for k in range(2, 30)] + [("hot", datetime(2024, 3, 15), None)]
    refs = references(spark.createDataFrame(child, "id long, t string, loaded_at timestamp"), "x.t", "target", "id", F.col("t"))
    known = targets(spark.createDataFrame(target, "k string, loaded_at timestamp, deleted_at timestamp"), "target", "k")
    at, n, keys = {k: (t, d) for k, t, d in target}, Counter(), defaultdict(set)
    for _, key, t in child:
        kind = "missing" if key not in at else "deleted" if at[key][1] else "late" if at[key][0] > t else None
        if kind:
            n[t.strftime("%Y-%m"), kind] += 1
            keys[t.strftime("%Y-%m"), kind].add(key)
    for heavy in (3, 10**6):
        got = {(r.child_month, r.orphan_kind): (r.n_references, r.n_targets) for r in per_period(refs, known, heavy).collect()}
        assert got == {k: (n[k], len(keys[k])) for k in n}
