import random

from pyspark.sql import functions as F

from qirtas.llm import alignment


def corpus(n=400, seed=4):
    """Records in an invented language with a word-for-word translation; sentences dropped, joined, added and moved."""
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}{c}" for a in "كبتسر" for b in "فقمنل" for c in "دذزحخ"]
    other = {w: f"tr{i}x" for i, w in enumerate(vocabulary)}
    weights = [1 / (i + 3) for i in range(len(vocabulary))]
    rows, truth = [], set()
    for r in range(n):
        source = [rng.choices(vocabulary, weights, k=rng.randrange(5, 10)) for _ in range(rng.randrange(2, 6))]
        target = [([i], [other[w] for w in s]) for i, s in enumerate(source)]
        kind = rng.randrange(5)
        if kind == 1:
            target.pop(rng.randrange(len(target)))
        elif kind == 2:
            k = rng.randrange(len(target) - 1)
            (a, x), (b, y) = target[k : k + 2]
            target[k : k + 2] = [(a + b, x + y)]
        elif kind == 3:
            target.insert(rng.randrange(len(target) + 1), ([], [other[w] for w in rng.choices(vocabulary, weights, k=6)]))
        elif kind == 4:
            rng.shuffle(target)
        rows.append(("hadith", str(r), "ar-id", ". ".join(" ".join(s) for s in source) + ".", ".\n ".join(" ".join(t) for _, t in target) + "!"))
        truth |= {(str(r), i, j) for j, (of, _) in enumerate(target) for i in of}
    return rows, truth


SCHEMA = "rec_table string, rec_key string, lang_pair string, arabic string, other string"


def test_recovers_the_pairs(spark):
    rows, truth = corpus()
    odd = [("hadith", "n1", "ar-id", None, "a b."), ("hadith", "n2", "ar-id", "كفد.", None), ("hadith", "n3", "ar-id", " ", ""), ("hadith", None, "ar-id", "كفد", "x"), ("hadith", "n4", "ar-id", "...", "!!"), rows[0]]
    frame = spark.createDataFrame(rows + odd, SCHEMA).withColumns({"block": F.lit("x"), "concept": F.lit("y"), "score": F.lit(0)})
    out = alignment.align(frame, block=20_000)
    got = [(r.rec_key, r.ar_sent, r.tr_sent) for r in out.collect()]
    assert len(got) == len(set(got))
    hit = len(set(got) & truth)
    assert hit / len(truth) > 0.95 and hit / len(got) > 0.95


def test_blocks_do_not_matter(spark):
    rows, _ = corpus(150, 8)
    frame = spark.createDataFrame(rows, SCHEMA)
    one, many, grouped = ({tuple(r)[:5] for r in alignment.align(frame, block=b, group=g).collect()} for b, g in ((10**6, 64), (4_000, 64), (4_000, 3)))
    assert one == many == grouped


def test_empty_and_long(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert alignment.align(frame).collect() == []
    rows, _ = corpus(60)
    long = ("tafsir", "long", "ar-id", ". ".join(r[3] for r in rows), ". ".join(r[4] for r in rows))
    got = alignment.align(spark.createDataFrame([*rows, long], SCHEMA)).where("rec_key = 'long'").count()
    assert got > 60


def test_sentences():
    assert alignment.sentences("a. b!\n\n c؟ d? .") == ["a", " b", " c", " d"]
