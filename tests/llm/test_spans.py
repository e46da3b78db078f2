import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from qirtas.llm import spans


def brute(rows, span=12):
    words = {(t, k): [w for w in re.split("[ \n]+", x) if w] for t, k, x in rows if x is not None and k is not None}
    holders = defaultdict(set)
    for key, w in words.items():
        for i in range(len(w) - span + 1):
            holders[tuple(w[i : i + span])].add(key)
    out = set()
    for (t, k), w in words.items():
        shared = [False] * len(w)
        for i in range(len(w) - span + 1):
            if len(holders[tuple(w[i : i + span])]) > 1:
                shared[i : i + span] = [True] * span
        start = None
        for i, s in enumerate([*shared, False]):
            if s and start is None:
                start = i
            if not s and start is not None:
                out.add((t, k, start, i - start))
                start = None
    return out


def corpus():
    rng = random.Random(3)
    word = lambda n: f"w{rng.randrange(n)}"
    pool = [[word(40) for _ in range(30)] for _ in range(4)]
    rows = []
    for i in range(60):
        w = [word(500) for _ in range(rng.randrange(0, 40))]
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(pool)
            a = rng.randrange(0, 18)
            w += p[a : a + rng.randrange(8, 20)]
        rows.append((rng.choice(["hadith", "tafsir"]), str(i), rng.choice([" ", "\n", " \n "]).join(w)))
    long = " ".join(word(10**6) for _ in range(30_000))
    rows += [("hadith", "L1", long), ("tafsir", "L2", "x " + long)]
    rows += [("hadith", "c1", "a " * 40), ("hadith", "c2", "a " * 13), ("tafsir", "n", None), ("tafsir", "e", ""), ("tafsir", None, "a " * 40)]
    return rows + rows[:5]  # delivered twice


def test_spans_are_brute_force(spark):
    rows = spark.createDataFrame(corpus(), "rec_table string, rec_key string, text string").where("text is not null and rec_key is not null").withColumn("band", F.lit(1)).withColumn("hash_a", F.lit("x"))
    got = spans.shared_spans(rows)
    assert {tuple(r) for r in got.collect()} == brute(corpus())
    assert got.count() == len(brute(corpus()))
    report = {(r.rec_table, r.rec_key): r for r in spans.report(rows, got).collect()}
    assert report["hadith", "L1"].shared_part == 1.0 and report["tafsir", "e"].shared_part == 0.0
    assert report["tafsir", "L2"].shared_words == 30_000


def test_one_record_alone_and_empty(spark):
    rows = spark.createDataFrame([("hadith", "1", "a " * 50), ("hadith", "1", "a " * 50)], "rec_table string, rec_key string, text string")
    assert spans.shared_spans(rows).collect() == []
    assert spans.shared_spans(rows.limit(0)).collect() == []


def test_clusters(spark):
    text = [" ".join(f"{c}{i}" for i in range(15)) for c in "abcd"]
    rows = [("t", "1", text[0]), ("t", "2", text[0] + " " + text[1]), ("t", "3", text[1] + " " + text[2]), ("t", "4", text[2]), ("t", "5", text[3]), ("u", "6", text[3]), ("u", "7", "alone")]
    got = spans.clusters(spans.shared_windows(spark.createDataFrame(rows, "rec_table string, rec_key string, text string")))
    assert {(r.rec_key, r.cluster) for r in got.collect()} == {(k, "t:1") for k in "1234"} | {("5", "t:5"), ("6", "t:5")}


def test_clusters_of_a_chain(spark):
    pieces = [" ".join(f"{c}_{i}" for i in range(12)) for c in range(40)]
    rows = [("t", f"{k:02}", pieces[k] + " " + pieces[k + 1]) for k in range(39)]
    got = spans.clusters(spans.shared_windows(spark.createDataFrame(rows, "rec_table string, rec_key string, text string")))
    assert {r.cluster for r in got.collect()} == {"t:00"} and got.count() == 39


@pytest.mark.parametrize("span", [6, 12])
def test_other_spans(spark, span):
    rows = spark.createDataFrame([r for r in corpus() if r[1] and r[2] is not None], "rec_table string, rec_key string, text string")
    assert {tuple(r) for r in spans.shared_spans(rows, span).collect()} == brute(corpus(), span)


def test_removal(spark):
    """Every shared paragraph stays in one record, and only shared words go."""
    rng = random.Random(21)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    common = [fresh(30) for _ in range(6)]
    texts = {}
    for r in range(40):
        parts = [fresh(rng.randrange(0, 15))]
        for _ in range(rng.randrange(1, 4)):
            c = rng.choice(common)
            a = rng.randrange(0, 12)
            parts += [c[a : a + rng.randrange(10, 18)], fresh(rng.randrange(0, 4))]
        texts["hadith", str(r)] = sum(parts, [])
    rows = [(*k, " ".join(w)) for k, w in texts.items()]
    windows = spans.shared_windows(spark.createDataFrame(rows, "rec_table string, rec_key string, text string"))
    gone = {k: set() for k in texts}
    for r in spans.removal(windows).collect():
        gone[r.rec_table, r.rec_key] |= set(range(r.span_start, r.span_start + r.span_len))
    holders = {}
    for k, w in texts.items():
        for i in range(len(w) - 11):
            holders.setdefault(tuple(w[i : i + 12]), []).append((k, i))
    shared = {p: h for p, h in holders.items() if len({k for k, _ in h}) > 1}
    first = {p: min((k for k, _ in h), key=lambda k: ":".join(k)) for p, h in shared.items()}
    true = {k: set() for k in texts}
    stay = {k: set() for k in texts}
    for p, h in shared.items():
        for k, i in h:
            (stay if k == first[p] else true)[k] |= set(range(i, i + 12))
    assert gone == {k: true[k] - stay[k] for k in texts} and any(gone.values())
    clusters = {(r.rec_table, r.rec_key): r.cluster for r in spans.clusters(windows).collect()}
    assert all(clusters[k] for k, w in gone.items() if w)
    assert spans.removal(windows.limit(0)).collect() == []
