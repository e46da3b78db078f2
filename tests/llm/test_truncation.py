import random

from pyspark.sql import functions as F

from qirtas.llm import truncation

SCHEMA = "doc_id long, text string, source string"


def corpus():
    rng = random.Random(6)
    words = [f"{a}{b}{c}{'en' * (1 + ord(b) % 3)}" for a in "bdfgklm" for b in "aeiou" for c in "npqrst"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows, cut = [], set()

    def add(source, body, is_cut=False):
        rows.append((len(rows), body, source))
        if is_cut:
            cut.add(len(rows) - 1)

    for _ in range(150):
        add("plain", text(rng.randrange(20, 60)) + rng.choice([".", ".»", "?", "!"]))
    for _ in range(6):
        add("plain", text(40)[: rng.randrange(120, 200)].rstrip(), True)
    for _ in range(60):
        add("limited", text(60)[:300].strip("."), True)
        add("limited", text(30) + ".")
    for k in range(60):
        add("open", text(rng.randrange(20, 60)))
        add("refs", text(25) + f". ({k}:{k + 3})")
        add("thanks", text(rng.randrange(20, 60)) + ". many thanx")
    add("refs", text(30), True)
    add("thanks", text(25) + " bapen", True)
    add("open", text(30) + " zzqwr", False)  # begins no word
    add("open", text(30) + " kipe", True)
    base = text(80)
    add("plain", base + ".")
    add("open", " ".join(base.split()[:72]), True)  # a near-copy goes on
    add("open", base)
    add("dots", text(20) + "...", True)
    add("dots", text(20) + "…", True)
    add("dots", text(20) + ".")
    return rows, cut


def test_cases(spark):
    rows, cut = corpus()
    odd = [(9_000, None, "plain"), (9_001, "  ", "plain"), (9_002, "one.", None), (None, "x", "plain")]
    frame = spark.createDataFrame(rows + odd, SCHEMA).withColumns({"word": F.lit("x"), "ending": F.lit("y"), "bands": F.lit(1)})
    flagged = truncation.scored(frame)
    got = {r.doc_id for r in flagged.where("reason is not null").collect()}
    # text cut at a length may end right behind a word that is complete; those of the limited source are all flagged
    assert got == cut, (got - cut, cut - got)
    reasons = {r.doc_id: r.reason for r in flagged.collect()}
    assert len(reasons) == len(rows) + 1
    assert {reasons[d] for d in cut} == {"open", "limit", "mark", "copy", "fragment"}
    share = {r.source: (r.n_docs, r.n_cut) for r in truncation.cut_share(flagged).collect()}
    assert share["limited"] == (120, 60) and share[""] == (1, 0)


def test_copy_in_a_band_with_a_longer_text(spark, monkeypatch):
    rng = random.Random(8)
    words = lambda n: " ".join("".join(rng.choice("bdfgklmaeiou") for _ in range(7)) for _ in range(n))
    base = words(100)
    rows = [(0, base, "open"), (1, f"{base} {words(10)}", "open")] + [(k, f"{base} {words(30)}", "open") for k in range(2, 200)]
    rows += [(500 + k, words(40), "open") for k in range(20)]
    for spread in (truncation.SPREAD, 4):
        monkeypatch.setattr(truncation, "SPREAD", spread)
        reasons = {r.doc_id: r.reason for r in truncation.scored(spark.createDataFrame(rows, SCHEMA)).collect()}
        assert [d for d, reason in reasons.items() if reason == "copy"] == [0]


def test_empty(spark):
    assert truncation.scored(spark.createDataFrame([], SCHEMA)).collect() == []


def test_ends_early():
    w = list(range(100, 160))
    assert truncation.ends_early(w[:55], w)
    assert truncation.ends_early([*w[:54], 7], w)
    assert not truncation.ends_early(w, w)
    assert not truncation.ends_early(w, w[:55])
    assert not truncation.ends_early(w[:20], w)  # too unlike
    assert not truncation.ends_early(w[:3], w)


def test_ends_early_aligns():
    w = list(range(100, 160))
    assert truncation.ends_early([*w[:52], 7, *w[53:55]], w)  # a changed word before the last two
    assert truncation.ends_early([*w[:53], 7, w[54]], w)
    assert truncation.ends_early([*w[:52], 7, w[53], 8], w)  # and a broken last word
    assert truncation.ends_early([*w[:52], *w[53:55]], w)  # a word left out
    assert truncation.ends_early([*w[:52], 7, *w[52:54]], w)  # a word more
    assert not truncation.ends_early([*w[:57], 7, *w[58:]], w)
    assert not truncation.ends_early([*w[:53], 7, 8], w)  # an end of its own
    assert not truncation.ends_early([*w[:53], 7, w[58]], w)  # a chance match far on
    assert not truncation.ends_early(w, [*w[:52], 7, *w[53:55]])


def test_recall_of_near_copies(spark):
    """Families of nested texts, the shortest of which is cut: every cut text with a near-copy that goes on is to be found."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("bdfgklmaeiou") for _ in range(rng.randrange(4, 12)))
    for sizes in ((72, 86), (72, 86, 92), (72, 86, 102), (72, 80, 84, 88, 93)):
        rows = []
        for k in range(300):
            base = [word() for _ in range(max(sizes))]
            rows += [(10 * k + i, " ".join(base[:n]), "lists") for i, n in enumerate(sizes)]
        reasons = {r.doc_id: r.reason for r in truncation.scored(spark.createDataFrame(rows, SCHEMA)).collect()}
        found = sum(reasons[10 * k] == "copy" for k in range(300))
        assert found >= 297, (sizes, found)


def test_families_with_one_end(spark, monkeypatch):
    """Alike texts with the same last words are not paired with each other; those that are cut, or that repeat these words, still are."""
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("bdfgklmaeiou") for _ in range(rng.randrange(4, 12)))
    base = [word() for _ in range(90)]

    def version(k, n=90, end=()):  # one word of its own
        return " ".join([*base[:40], f"own{k}x", *base[41:n], *end])
    rows = [(k, version(k), "lists") for k in range(120)]
    rows += [(200, version(200, 80), "lists"), (201, version(201, 85), "lists"), (202, version(202, 90, ["more", "of", "it"]), "lists"), (203, version(203, 90, ["again", *base[88:]]), "lists")]
    sizes = []
    before = truncation.ends_early
    monkeypatch.setattr(truncation, "write_shared", lambda df, name, w=truncation.write_shared: (sizes.append(w(df, name).count()) if name == "pairs" else None) or w(df, name))
    documents = spark.createDataFrame(rows, SCHEMA)
    table = truncation.write_shared(truncation.sketches(documents), "sketches")
    found = {r.doc_id for r in table.join(truncation.cut_copies(table, documents), ["text_a", "text_b"]).collect()}
    words = {d: t.split() for d, t, _ in rows}
    true = {a for a in words if any(before(words[a], words[b]) for b in words if a != b)}
    assert found == true and {200, 201, 0, 119} <= true and not {202, 203} & true
    assert sizes[0] < 124 * 8  # of 124 * 123


def test_begun(spark):
    rng = random.Random(10)
    long = "".join(rng.choice("ab") for _ in range(5_000))
    words = {"k": 3, "ka": 1, "kata": 5, "katakan": 2, "x": 1, long: 4, long[:40]: 2, long[:16] + "z": 1, "b" * 20: 1}
    asked = ["k", "ka", "kata", "x", "nowhere", "", long[:33], long[:17], long[:16], "b" * 19, "b" * 20]
    vocabulary = spark.createDataFrame(list(words.items()), "word string, n long")
    got = dict(map(tuple, truncation.begun(spark.createDataFrame([(w,) for w in asked], "last_word string"), vocabulary).collect()))
    true = {a: sum(n for w, n in words.items() if a and w.startswith(a) and w != a) for a in asked}
    assert {a: got.get(a, 0) for a in asked} == true


def test_limits(spark):
    rng = random.Random(11)
    rows = [("s", n, 1) for n in range(100, 900)] * 2 + [("s", 512, 1)] * 14 + [("t", rng.randrange(100, 900), 1) for _ in range(40)]
    frame = spark.createDataFrame(rows, "source string, n_chars int, x int")
    assert [(r.source, r.n_chars) for r in truncation.limits(frame, "n_chars").collect()] == [("s", 512)]


def test_copies_share_the_verdict(spark):
    rng = random.Random(12)
    text = lambda n: " ".join(rng.choice(["kata", "lima", "dari", "buku", "teman", "jalan"]) for _ in range(n))
    cut = text(30) + " jal"
    rows = [(k, text(30) + ".", "a") for k in range(200)] + [(1_000 + k, cut, "a") for k in range(20)] + [(2_000, cut + " kata.", None)]
    got = {r.doc_id: r.reason for r in truncation.scored(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {d for d, r in got.items() if r} == {1_000 + k for k in range(20)}
