"""Text cut off by field limits: near-copies that end early, and the terminality of closing words.

Near-copies come from MinHash banding over shingles of five words (12 bands of 4 rows), verified by exact
Jaccard similarity of 0.8 or more; of a verified pair the copy whose alignment ends while the other goes on
is cut. Records without such a copy are scored by their closing word. A text that ends in a closing mark is complete, and one that
ends in an ellipsis is not. For every other text two chances are compared, that a complete text of its source ends in this
word and that a text cut at any place does::

    terminality = ln( habit / chance + open * whole )

``habit``   lower bound (99 %) of the share of the source's texts, besides this one, that end in the word
``chance``  share of the word in all running text, and of the longer words it begins: what a cut at any place leaves behind
``open``    share of the source's texts that end without a mark and in no word of habit: whether open ends are usual there
``whole``   1 if the word stands inside texts; else 1/2 to the number of words it begins: a broken word is no end

All four are counted over all documents. A length at which open texts of the source pile up speaks against the end: by the logarithm of the
likelihood ratio of so many texts with exactly this length, against the lengths around it, which is taken off. Below ``ln(LEAST)`` the end is no end.

Defined results: null and blank texts are not cut; a null source is a source of its own; exact copies are
compared once and all share the verdict; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qirtas.llm.vectors import as_array, mix, rolling, signed, word_hashes, words_of
from qirtas.operators.skew import salted_join
from qirtas.shared import write_shared

SHINGLE, ALIKE, BANDS, ROWS = 5, 0.8, 12, 4
BUCKET, SPREAD, SALTS = 1.3, 1_000, 64  # a bucket is wider than 1 / ALIKE
LEAST, AROUND, SURE = 0.3, 20, 1_000  # least ratio of the chances; lengths around; how much likelier a limit must be
_CLOSED = re.compile(r"(?<!\.\.)[.!?؟]['\"»”’)\]}]*$")
_OPEN_ENDED = re.compile(r"(…|\.\.\.)['\"»”’)\]}]*$")
_PUNCTUATION = "[.!?؟،,;:؛»«\"'()\\[\\]{}…“”]+"
_MULTIPLIERS = np.random.default_rng(12).integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SKETCH = "word string, n long, doc_id long, source string, text_a long, text_b long, n_chars int, n_bytes int, n_grams int, closed boolean, open_ended boolean, last_word string, tail long, own_end boolean, bands array<long>"
_ANCHORS = [*range(1, 17), *(2**k for k in range(5, 21))]


def _bands(codes_hash: np.ndarray, ends: np.ndarray) -> tuple[list[np.ndarray | None], list[int]]:
    """The band values of each text, or None where it has fewer words than a shingle, and its number of distinct shingles."""
    sizes = np.diff(ends)
    out: list[np.ndarray | None] = [None] * len(sizes)
    distinct = [0] * len(sizes)
    enough = np.flatnonzero(sizes >= SHINGLE)
    if not len(enough):
        return out, distinct
    grams = mix(rolling(codes_hash, SHINGLE))
    # reduceat takes [first, last] pairs; every second result is that of a text
    edges = np.empty(2 * len(enough), np.int64)
    edges[0::2], edges[1::2] = ends[enough], ends[enough] + sizes[enough] - SHINGLE + 1
    padded = np.append(grams, np.uint64(2**64 - 1))
    low = np.empty((BANDS * ROWS, len(enough)), np.uint64)
    for k, m in enumerate(_MULTIPLIERS):
        x = padded * m
        x ^= x >> np.uint64(29)
        low[k] = np.minimum.reduceat(x, edges)[0::2]
    for b in range(BANDS):
        key = np.full(len(enough), b + 1, np.uint64)
        for r in range(ROWS):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + low[b * ROWS + r])
        low[b] = key
    for i, row in enumerate(enough):
        out[row] = signed(low[:BANDS, i].copy())
        distinct[row] = len(np.unique(grams[edges[2 * i] : edges[2 * i + 1]]))
    return out, distinct


def _tails(codes: np.ndarray, of_words: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Of each text a digest of its last two words, and whether neither stands anywhere before in it. No such text goes on behind the end of
    another one with the same last two words."""
    tails, own = np.zeros(len(ends) - 1, np.uint64), np.zeros(len(ends) - 1, bool)
    two = np.flatnonzero(np.diff(ends) > 1)
    if len(two):
        tails[two] = of_words[ends[two + 1] - 1] * np.uint64(0x9E3779B97F4A7C15) + of_words[ends[two + 1] - 2]
    for i, a, b in zip(two.tolist(), ends[two].tolist(), ends[two + 1].tolist()):
        own[i] = not (codes[a : b - 1] == codes[b - 1]).any() and not (codes[a : b - 2] == codes[b - 2]).any()
    return pa.array(signed(mix(tails))), pa.array(own)


def sketches(documents: DataFrame) -> DataFrame:
    """One row a document, with what the rest needs of it, and one row for each distinct word of a task with its count. Numbers are one word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split(" ")[0] for f in _SKETCH.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.string(), pa.int64(), pa.bool_(), pa.list_(pa.int64())]
        vocabulary: Counter[str] = Counter()
        for batch in batches:
            texts = pc.utf8_rtrim_whitespace(as_array(batch.column(2)))
            plain = pc.replace_substring_regex(pc.replace_substring_regex(texts, _PUNCTUATION, ""), "\\s+", " ")
            words, codes, ends = words_of(plain, " ")
            hashes, named = word_hashes(words), pc.replace_substring_regex(words, "\\p{Nd}+", "0").to_pylist()
            for code, n in zip(*(x.tolist() for x in np.unique(codes, return_counts=True))):
                vocabulary[named[code]] += n
            ending = [(t.rsplit(None, 1) or [""])[-1] for t in texts.to_pylist()]
            last = [named[codes[b - 1]] if b > a else "" for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            of_words = hashes[codes] if len(codes) else np.zeros(0, np.uint64)
            bands, distinct = _bands(of_words, ends)
            tails, own_ends = _tails(codes, of_words, ends)
            two = [np.array([xxhash.xxh3_64_intdigest(t, seed) for t in plain.to_pylist()], np.uint64) for seed in (3, 4)]
            full = as_array(batch.column(2))
            columns = [
                pa.nulls(len(ending), pa.string()), pa.nulls(len(ending), pa.int64()),
                as_array(batch.column(0)).cast(pa.int64()), as_array(batch.column(1)), pa.array(signed(two[0])), pa.array(signed(two[1])),
                pc.utf8_length(full).cast(pa.int32()), pc.binary_length(full).cast(pa.int32()), pa.array(distinct, pa.int32()),
                pa.array([bool(_CLOSED.search(e)) for e in ending], pa.bool_()), pa.array([bool(_OPEN_ENDED.search(e)) for e in ending], pa.bool_()),
                pa.array(last, pa.string()), tails, own_ends, pa.array(bands, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        found = list(vocabulary.items())
        for at in range(0, len(found), 20_000):
            some = found[at : at + 20_000]
            columns = [pa.array([w for w, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64()), *(pa.nulls(len(some), k) for k in kinds[2:])]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = documents.where("doc_id is not null and trim(text) <> ''")
    return rows.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), "text").mapInArrow(run, _SKETCH)


def _blocks(a: list, b: list) -> list[tuple[int, int, int]]:
    """The matching blocks (place in a, place in b, size) of two texts, in order."""
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    rest = SequenceMatcher(None, a[same:], b[same:], autojunk=False).get_matching_blocks()[:-1]
    return [(0, 0, same)] * (same > 0) + [(i + same, j + same, n) for i, j, n in rest]


def ends_early(a: list, b: list) -> bool:
    """Whether ``a`` and ``b`` are near-copies and ``a`` stops, at most one broken word after the last matched block, where ``b`` goes on.

    A last block of one or two words counts where it is shifted against the block before by no more words than it has; else it is a chance match.
    """
    if len(a) < SHINGLE or len(b) < SHINGLE:
        return False
    of_a, of_b = ({tuple(x[i : i + SHINGLE]) for i in range(len(x) - SHINGLE + 1)} for x in (a, b))
    both = len(of_a & of_b)
    if both < ALIKE * (len(of_a) + len(of_b) - both):
        return False
    blocks = _blocks(a, b)
    while len(blocks) > 1:
        (i, j, n), (at, on, size) = blocks[-2:]
        if size >= 3 or abs((at - i - n) - (on - j - n)) <= size:
            break
        blocks.pop()
    at, on, size = blocks[-1]
    rest = len(a) - at - size
    return rest <= 1 and len(b) - on - size > rest


def cut_copies(table: DataFrame, documents: DataFrame) -> DataFrame:
    """(text_a, text_b) digests of unclosed texts that a near-copy continues; their texts are read again from ``documents``.

    Of exact copies the one with the least doc_id stands for all. Every unclosed text is compared with every other text of its bands whose
    number of distinct shingles allows a similarity of ``ALIKE``. Such texts lie in the same or the next bucket of sizes; the texts of a
    bucket are spread over salts, one for each ``SPREAD`` texts of the band. Texts with the commonest last two words of a bucket do not
    meet those of them that have these two words nowhere else, which cannot go on behind them: a family of alike texts with one
    end is not paired with itself.
    """
    text = ["text_a", "text_b"]
    texts = table.where("doc_id is not null").groupBy(*text).agg(F.min("doc_id").alias("rep"), F.bool_and("closed").alias("closed"), *(F.any_value(c).alias(c) for c in ("n_grams", "tail", "own_end", "bands")))
    texts = write_shared(texts.where("bands is not null"), "texts")
    one = texts.select("rep", "n_grams", "closed", "tail", "own_end", F.explode("bands").alias("band"))
    shared = one.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("closed")).alias("n_open")).where("n > 1 and n_open > 0")
    shared = shared.select("band", "n", F.least(F.lit(SALTS), F.ceil(F.col("n") / SPREAD)).cast("int").alias("salts"))
    bucket = F.floor(F.log("n_grams") / np.log(BUCKET)).cast("int")
    members = write_shared(salted_join(one, shared, ["band"], "n", "rep", "inner").withColumn("bucket", bucket), "members")
    if members.isEmpty():
        return texts.select(*text).limit(0)
    place = ["band", "bucket"]
    tails = members.groupBy(*place, "tail").agg(F.count_if("own_end").alias("k"), F.count(F.lit(1)).alias("n"))
    common = write_shared(tails.groupBy(*place).agg(F.max_by("tail", "k").alias("common"), F.sum("n").alias("n")), "tails")
    same = F.col("tail") == F.col("common")
    near = F.array(*(F.col("bucket") + k for k in (-1, 0, 1)))
    every = F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
    open_ones = salted_join(members.where("not closed").withColumn("bucket", F.explode(near)), common, place, "n", "rep", "inner")
    open_ones = open_ones.select(*place, every.alias("salt"), "rep", "n_grams", same.alias("same"))
    others = salted_join(members, common, place, "n", "rep", "inner")
    others = others.select(*place, F.pmod(F.xxhash64("rep"), "salts").cast("int").alias("salt"), F.col("rep").alias("center"), F.col("n_grams").alias("n_other"), (same & F.col("own_end")).alias("ends_here"))
    like = F.least("n_grams", "n_other") >= ALIKE * F.greatest("n_grams", "n_other") - 1e-9
    met = open_ones.join(others.where("not ends_here"), [*place, "salt"]).drop("same", "ends_here")
    met = met.union(open_ones.where("not same").join(others.where("ends_here"), [*place, "salt"]).drop("same", "ends_here"))
    pairs = write_shared(met.where((F.col("rep") != F.col("center")) & like).select("rep", "center").distinct(), "pairs")
    if pairs.isEmpty():
        return texts.select(*text).limit(0)
    ids = write_shared(pairs.select(F.explode(F.array("rep", "center")).alias("doc_id")).distinct(), "ids")
    members = write_shared(documents.select("doc_id", F.col("text").alias("words")).join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "texts")
    both = pairs
    for key, other, name in (("rep", "center", "text"), ("center", "rep", "other")):
        counted = pairs.groupBy(F.col(key).alias("doc_id")).agg(F.count(F.lit(1)).alias("k")).join(members, "doc_id").select(F.col("doc_id").alias(key), "k", F.col("words").alias(name))
        both = salted_join(both, counted, [key], "k", other, "inner")
    both = both.select("rep", "text", "other")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (pc.replace_substring_regex(pc.replace_substring_regex(as_array(batch.column(k)), _PUNCTUATION, ""), "\\s+", " ").to_pylist() for k in (1, 2))
            yield batch.select(["rep"]).filter(pa.array([ends_early(*([w for w in t.split(" ") if w] for t in pair)) for pair in zip(a, b)], pa.bool_()))

    found = both.mapInArrow(verify, "rep long").distinct()
    return texts.join(found, "rep", "left_semi").select(*text)


def limits(open_texts: DataFrame, measure: str) -> DataFrame:
    """(source, ``measure``, k, at_...) of the lengths at which so many open texts of a source end that it is no chance.

    ``k`` texts with one length are compared with the ``AROUND`` lengths on either side: at_... is the logarithm of the likelihood ratio, as far as
    it exceeds that of ``SURE`` times the number of lengths looked at. The window runs over distinct lengths of a source, which its longest text bounds.
    """
    at = open_texts.groupBy("source", measure).agg(F.count(F.lit(1)).alias("k"))
    source = Window.partitionBy("source")
    near = F.sum("k").over(source.orderBy(measure).rangeBetween(-AROUND, AROUND))
    usual = (near - F.col("k") + 1) / F.lit(2.0 * AROUND + 1)
    rows = at.withColumns({"usual": usual, "looked_at": F.count(F.lit(1)).over(source)})
    ratio = F.col("k") * F.ln(F.col("k") / F.col("usual")) - (F.col("k") - F.col("usual"))
    found = rows.where(F.col("k") > F.col("usual")).withColumn("excess", ratio - F.ln(F.col("looked_at") * SURE)).where("excess > 0")
    return found.select("source", measure, "k", F.col("excess").alias(f"at_{measure}"))


def begun(words: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(last_word, begun): how many words of running text each of the distinct ``words`` begins, without itself.

    A word of the vocabulary meets them by some of its beginnings only: those of 1 to 16 characters, then of 32, 64 and so on,
    so that what is sent grows with the length of a word. A longer one is looked up by the greatest such beginning and then compared.
    """
    length = F.length("word")
    starts = F.filter(F.array(*map(F.lit, _ANCHORS)), lambda k: k < length)
    parts = vocabulary.where("length(word) > 1").select("word", "n", F.explode(starts).alias("k")).withColumn("anchor", F.substring(F.col("word"), F.lit(1), F.col("k")))
    own = F.array_max(F.filter(F.array(*map(F.lit, _ANCHORS)), lambda k: k <= F.length("last_word")))
    wanted = words.where("last_word <> ''").withColumn("k", own).withColumn("anchor", F.substring(F.col("last_word"), F.lit(1), F.col("k")))
    exact = parts.groupBy("anchor").agg(F.sum("n").alias("begun")).hint("merge").join(wanted.where("k = length(last_word)").select("anchor", "last_word"), "anchor").select("last_word", "begun")
    longer = wanted.where("k < length(last_word)").select("anchor", "k", "last_word")
    met = parts.where("k >= 16").hint("merge").join(longer, ["anchor", "k"]).where(F.startswith("word", "last_word") & (F.col("word") != F.col("last_word")))
    return exact.union(met.groupBy("last_word").agg(F.sum("n").alias("begun")))


def _at_least(count: Column) -> Column:
    """Lower bound (99 %) of the expectation of a Poisson count."""
    bound = count * F.pow(F.greatest(F.lit(0.0), 1 - 1 / (9 * count) - 2.326 / (3 * F.sqrt(count))), F.lit(3.0))
    return F.when(count > 0, bound).otherwise(0.0)


def terminality(docs: DataFrame, open_texts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(source, last_word, k, terminality, habitual, whole) of the closing words of the open texts of each source."""
    in_source = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.count_if("closed").alias("n_closed"))
    counted = (F.col("at_limit") == 0) & ~F.col("open_ended")
    pairs = open_texts.groupBy("source", "last_word").agg(F.count(F.lit(1)).alias("k"), F.count_if(counted).alias("k_free"), F.sum(F.when(counted, F.col("copies")).otherwise(0)).alias("n_free"))
    pairs = write_shared(pairs, "closings")
    words = pairs.select("last_word").distinct()
    at_end = docs.groupBy("last_word").agg(F.count(F.lit(1)).alias("n_end"))
    total = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    of_words = words.join(vocabulary.withColumnRenamed("word", "last_word").hint("merge"), "last_word", "left").join(at_end.hint("merge"), "last_word", "left").join(begun(words, vocabulary).hint("merge"), "last_word", "left")
    inside = F.greatest(F.coalesce("n", F.lit(0)) - F.coalesce("n_end", F.lit(0)), F.lit(0))
    starts = F.coalesce("begun", F.lit(0))
    of_words = of_words.join(F.broadcast(total))  # one row
    of_words = of_words.select("last_word", ((inside + 0.5 + starts) / F.greatest("total", F.lit(1))).alias("chance"), F.when(inside > 0, 1.0).otherwise(0.5 / F.greatest(starts.cast("double"), F.lit(0.5))).alias("whole"))
    rated = pairs.join(of_words.hint("merge"), "last_word").join(in_source, "source")
    rated = write_shared(rated.withColumn("rate", _at_least((F.col("k_free") - 1).cast("double")) / F.col("n_docs") / F.col("chance")), "rated")
    usual_open = rated.groupBy("source").agg((F.sum(F.when(F.col("rate") < 1, F.col("n_free")).otherwise(0)) / F.greatest(F.max("n_closed") + F.sum("n_free"), F.lit(1))).alias("open"))
    score = F.ln(F.col("rate") + F.col("open") * F.col("whole") + 1e-9)
    return rated.join(usual_open, "source").select("source", "last_word", "k", score.alias("terminality"), (F.col("rate") >= 1).alias("habitual"), (F.col("whole") == 1).alias("whole"))


def judged(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sketches of documents, and one row a text without closing mark: its copies, what is known of its end and length, and ``reason``.

    'mark' - it ends in an ellipsis; else the score is below ln(LEAST), and 'limit' - open texts of its source pile up at its length; 'open' - its
    closing word is no end of a text of this source; 'fragment' - and it is a broken word. Near-copies are not looked at.
    """
    table = write_shared(sketches(documents), "sketches")
    docs = table.where("doc_id is not null")
    vocabulary = write_shared(table.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")), "vocabulary")
    one = [F.min(c).alias(c) for c in ("n_chars", "n_bytes", "open_ended", "last_word")]
    texts = docs.where("not closed").groupBy("source", "text_a", "text_b").agg(F.count(F.lit(1)).alias("copies"), *one)
    texts = write_shared(texts, "open")
    placed = texts
    for measure in ("n_chars", "n_bytes"):
        placed = salted_join(placed, limits(texts, measure), ["source", measure], "k", "text_a", "left")
    at_limit = F.greatest(F.coalesce("at_n_chars", F.lit(0.0)), F.coalesce("at_n_bytes", F.lit(0.0)))
    placed = write_shared(placed.select("source", "text_a", "text_b", "copies", "open_ended", "last_word", at_limit.alias("at_limit")), "placed")
    ends = terminality(docs, placed, vocabulary)
    scored_texts = salted_join(placed, ends, ["source", "last_word"], "k", "text_a", "inner")
    scored_texts = scored_texts.withColumn("score", F.col("terminality") - F.col("at_limit"))
    no_end = F.col("score") < float(np.log(LEAST))
    reason = F.when(F.col("open_ended"), "mark").when(no_end & (F.col("at_limit") > 0), "limit").when(no_end & F.col("whole"), "open").when(no_end, "fragment")
    return table, docs, scored_texts.withColumn("reason", reason)


def scored(documents: DataFrame) -> DataFrame:
    """(doc_id, source, closed, score, reason): reason tells why a document counts as cut, or is null.

    Besides the reasons of ``judged``, 'copy': a near-copy goes on, and the text does not close by a habit of its source.
    """
    table, docs, texts = judged(documents)
    copies = cut_copies(table, documents).withColumn("copy", F.lit(True))
    text = ["text_a", "text_b"]
    found = texts.join(copies, text, "left")
    goes_on = F.coalesce("copy", F.lit(False)) & ~F.col("habitual")
    reason = F.when(F.col("reason").isin("mark", "limit"), F.col("reason")).when(goes_on, "copy").otherwise(F.col("reason"))
    return of_documents(docs, found.withColumn("reason", reason))


def of_documents(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc_id, source, closed, score, reason) of every document, from what is known of the open texts; copies of a hot text are spread."""
    text = ["source", "text_a", "text_b"]
    verdicts = texts.select(*text, "copies", "score", "reason")
    open_docs = salted_join(docs.where("not closed").select("doc_id", *text), verdicts, text, "copies", "doc_id", "inner")
    closed = docs.where("closed").select("doc_id", "source", "closed", F.lit(None).cast("double").alias("score"), F.lit(None).cast("string").alias("reason"))
    return open_docs.select("doc_id", "source", F.lit(False).alias("closed"), "score", "reason").union(closed)


def cut_share(flagged: DataFrame) -> DataFrame:
    """(source, n_docs, n_cut, cut_part) of each source."""
    cut = F.count_if(F.expr("reason is not null"))
    return flagged.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), cut.alias("n_cut"), F.round(cut / F.count(F.lit(1)), 6).alias("cut_part"))
