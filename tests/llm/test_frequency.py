import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from qirtas.llm import frequency, queries

SCHEMA = "occ_id long, location string, surface_norm string, top_lemma_id long, loaded_at timestamp"


def words():
    rng = random.Random(1)
    rows = []
    for i in range(3_000):
        rec, pos = rng.randrange(60), rng.randrange(40)
        term = rng.choice(["hot"] * 30 + [f"t{k}" for k in range(40)] + [None, "", "  "])
        rows.append((i, rng.choice([f"{rec}:{pos}", f"b_e:{rec}:{pos}"]), term, rng.choice([None, 1, 1, 2, rng.randrange(50)]), None))
    return [*rows, (9_001, "5:1", "hot", 1, None), (9_001, "5:1", "hot", 1, None), (9_002, None, "hot", 1, None), (9_003, "nocolon", "odd", 3, None)]


def brute(rows, pick):
    places, records = defaultdict(set), defaultdict(set)
    for _, location, *rest in rows:
        term = pick(rest)
        if term is not None and term.strip() and location is not None:
            places[term].add(location)
            records[term].add(location.rpartition(":")[0] if ":" in location else None)
    return {t: (len(places[t]), len(records[t])) for t in places}


def test_counts(spark):
    rows = [r for r in words() if r[1] != "nocolon"]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"field": F.lit("x"), "rec": F.lit("y"), "term": F.lit(1)})
    got = {(r.field, r.term): (r.occurrences, r.records) for r in frequency.term_counts(frame).collect()}
    assert {t: v for (f, t), v in got.items() if f == "surface_norm"} == brute(rows, lambda r: r[0])
    assert {t: v for (f, t), v in got.items() if f == "lemma"} == brute(rows, lambda r: None if r[1] is None else str(r[1]))


def test_small_batches(spark, monkeypatch):
    """Groups that run over the borders of Arrow batches and of the rows held at once."""
    monkeypatch.setattr(frequency, "HELD", 20)
    monkeypatch.setattr(frequency.suffixes, "__defaults__", (frequency.STRETCH, 20))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        test_counts(spark)
        test_ngrams(spark)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_stretches(spark):
    """Records of several stretches: their records are counted without repeats."""
    rows = [r for r in words() if r[1] != "nocolon"]
    frame = spark.createDataFrame(rows, SCHEMA)
    for stretch in (3, 16):
        got = {(r.field, r.term): (r.occurrences, r.records) for r in frequency.term_counts(frame, stretch=stretch).collect()}
        assert {t: v for (f, t), v in got.items() if f == "surface_norm"} == brute(rows, lambda r: r[0])
        assert {t: v for (f, t), v in got.items() if f == "lemma"} == brute(rows, lambda r: None if r[1] is None else str(r[1]))


def test_odd_places(spark):
    """Places that are no whole numbers have no neighbours; a later delivery counts as a term, and stands in no n-gram."""
    rows = [(1, "a:1", "x", None, None), (2, "a:2", "y", None, None), (3, "a:2", "z", None, None), (4, "a:v", "y", None, None), (5, "a:-1", "x", None, None), (6, "a:02", "y", None, None), (7, "b:3", "x", None, None), (8, "b:5", "y", None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert {(r.term, r.occurrences, r.records) for r in frequency.term_counts(frame).collect()} == {("x", 3, 2), ("y", 4, 2), ("z", 1, 1)}
    got = {tuple(r.terms): (r.occurrences, r.records) for r in frequency.ngram_counts(frame).collect()}
    # places 2 and 02 are one place of the order
    assert got == {("x",): (3, 2), ("y",): (3, 2), ("x", "y"): (1, 1)}


def test_ngrams(spark):
    rng = random.Random(2)
    texts = {f"r{i}": [rng.choice("abc") for _ in range(rng.randrange(1, 30))] for i in range(40)} | {"long": [rng.choice("abc") for _ in range(9_000)]}
    rows = [(i, f"{r}:{p}", w, None, None) for i, (r, p, w) in enumerate((r, p, w) for r, t in texts.items() for p, w in enumerate(t, 1))]
    frame = spark.createDataFrame(rows, SCHEMA)
    count, held = Counter(), defaultdict(set)
    for r, t in texts.items():
        for k in (1, 2, 3):
            for i in range(len(t) - k + 1):
                count[tuple(t[i : i + k])] += 1
                held[tuple(t[i : i + k])].add(r)
    for stretch in (4096, 1_000, 7):
        got = {tuple(r.terms): (r.occurrences, r.records) for r in frequency.ngram_counts(frame, 3, 2, stretch).collect()}
        assert got == {g: (n, len(held[g])) for g, n in count.items() if n >= 2}, stretch


def test_ngrams_that_occur_once(spark, tmp_path):
    words = {"a": "x y z", "b": "x y", "c": "x"}
    rows = [(i, f"{r}:{p}", w, None, None) for i, (r, p, w) in enumerate((r, p, w) for r, t in words.items() for p, w in enumerate(t.split(), 1))]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/word_occurrence.parquet")
    got = {tuple(r) for r in queries.p3_ngrams(spark, str(tmp_path)).collect()}
    assert got == {("x", 1, 3, 3, False), ("y", 1, 2, 2, True), ("z", 1, 1, 1, True), ("x y", 2, 2, 2, True), ("y z", 2, 1, 1, True), ("x y z", 3, 1, 1, True)}


def test_marks(spark):
    rows = [(i, f"{i}:1", "all", 1, None) for i in range(40)] + [(100, "1:2", "few", 2, None), (101, "1:2", "few", 2, None), (102, "2:2", "few", 2, None)]
    lemmas = spark.createDataFrame([(1, 40), (2, 3), (3, 0), (4, 7), (5, None), (None, 1)], "lemma_id long, frequency long")
    got = {tuple(r) for r in frequency.marks(spark.createDataFrame(rows, SCHEMA), lemmas).collect()}
    assert got == {("surface_norm", "all", "common"), ("surface_norm", "few", "rare"), ("lemma", "1", "common"), ("lemma", "2", "rare"), ("lemma", "2", "stale"), ("lemma", "4", "stale")}


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert frequency.term_counts(none).collect() == []
    assert frequency.ngram_counts(none).collect() == []
    assert frequency.marks(none, spark.createDataFrame([(1, None)], "lemma_id long, frequency long")).collect() == []


def test_hot_terms_spread(spark):
    """A first term that makes up a third of the suffixes gets a share of the partitions; counts stay whole."""
    rows = [(i, f"{i // 20}:{i % 20}", "hot" if i % 3 == 0 else f"t{i % 101}", None, None) for i in range(6_000)]
    frame = spark.createDataFrame(rows, SCHEMA)
    placed = frequency._placed(frame).selectExpr("rec", "false AS several", "0 AS stretch", "at", "place", "surface_norm").repartition(1).sortWithinPartitions("rec", "at")
    found = frequency.suffixes(placed, ["surface_norm"], 3, False)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salts = {r.t0: r.n for r in found.groupBy("t0").agg(F.countDistinct("salt").alias("n")).collect()}
    assert salts["hot"] == -(-parts // 3) and salts["t1"] == 1
    assert {r.term: r.occurrences for r in frequency.term_counts(frame).where("term = 'hot'").collect()} == {"hot": 2_000}
