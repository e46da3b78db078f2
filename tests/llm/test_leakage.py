import random

from pyspark.sql import functions as F

from qirtas.llm import leakage


def brute(docs, items, least=8):
    grams = {}
    for i, t in items:
        w = leakage.normalized_text(t or "")
        for k in range(len(w) - least + 1):
            grams.setdefault(tuple(w[k : k + least]), set()).add(i)
    out = set()
    for d, t in docs:
        w = leakage.normalized_text(t or "")
        for k in range(len(w) - least + 1):
            out |= {(i, d) for i in grams.get(tuple(w[k : k + least]), ())}
    return out


def data():
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(12)}"
    items = [(i, " ".join(word() for _ in range(20 if i in (3, 5) else rng.randrange(5, 30)))) for i in range(40)]
    items += [(100, items[0][1]), (101, None), (102, ""), (103, "too short"), (104, "الْإِسْلَامُ هدى ورحمة للعالمين كلهم في كل زمان ومكان")]
    docs = []
    for d in range(80):
        w = [word() if rng.random() < 0.7 else f"x{rng.randrange(99)}" for _ in range(30)]
        part = rng.choice(items[:40])[1].split()
        a = rng.randrange(len(part))
        docs.append((d, " ".join(w + part[a : a + 12] + w[:5])))
    docs += [(200, None), (201, ""), (202, "- الاسلام، هدي (ورحمه) للعالمين: كلهم في كلِّ زمان ومكان!"), (203, items[3][1].upper().replace(" ", ", ")), (204, "z " * 100_000 + items[5][1])]
    return docs, items


def test_leaks_are_brute_force(spark):
    docs, items = data()
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"item_id": F.lit(1), "n_words": F.lit("x")})
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    for block in (10**6, 60):
        got = leakage.leaks(d, i, block=block)
        assert {(r.item_id, r.doc_id) for r in got.collect()} == brute(docs, items)
        assert got.count() == len(brute(docs, items))
    assert (104, 202) in brute(docs, items)
    whole = got.where("doc_id = 203 and item_id = 3").first()
    assert (whole.first_word, whole.n_shared) == (0, whole.n_words)
    actions = {r.doc_id: r.action for r in leakage.removal(d, got).collect()}
    assert actions[203] == "document" and actions[204] == "runs"


def test_removal_merges_items(spark):
    w = lambda a, b, name="w": " ".join(f"{name}{i}" for i in range(a, b))
    items = [(1, w(0, 30)), (2, w(0, 30, "v")), (3, w(20, 40))]
    docs = [
        (1, f"{w(0, 10)} {w(0, 20, 'x')} {w(5, 15)} {w(0, 30, 'y')}"),  # two runs of one item
        (2, f"{w(0, 30)} {w(0, 30, 'v')} {w(0, 40, 'x')}"),  # items of 30, 30 and 10 %
        (3, f"{w(0, 30, 'x')} {w(15, 40)} {w(0, 45, 'y')}"),  # runs of two items that overlap
        (4, f"{w(0, 10)} {w(0, 20, 'x')} {w(0, 8, 'v')} {w(0, 30, 'y')}"),
    ]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = leakage.leaks(d, i, block=10)
    got = {r.doc_id: (r.n_items, r.covered, r.action, [tuple(x) for x in r.spans]) for r in leakage.removal(d, found).collect()}
    assert got == {
        1: (1, round(20 / 70, 6), "runs", [(0, 10), (30, 10)]),
        2: (3, 0.6, "document", [(0, 100)]),
        3: (2, 0.25, "runs", [(30, 25)]),
        4: (2, round(18 / 68, 6), "runs", [(0, 10), (30, 8)]),
    }
    cut = {r.doc_id: [tuple(x) for x in r.spans] for r in leakage.removal(d, found, length=10).collect()}
    assert cut[4] == [(0, 10)] and cut[2] == [(0, 100)]


def test_empty(spark):
    docs, items = data()
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert leakage.leaks(d.limit(0), i).collect() == []
    assert leakage.leaks(d, i.limit(0)).collect() == []
