"""Sentence alignment in bilingual records, by similarities to shared paired-document concepts.

A concept is a bundle of paired records (records hashed to ``CONCEPTS`` bundles), so it has a text in either
language. A word is represented by how far its records lie in each bundle above expectation; a word and its
translation occur in the same records and so have nearly the same representation although they share no letter. Of it the
``KEPT`` concepts count that say most. A sentence is the sum of its words, weighted by rarity; its own record's bundle is left out, for that
says nothing about which sentence of the record it renders, and again the strongest concepts are kept. Within each record a sparse cosine join
in SQL, on record and concept, compares the sentences, and windows of up to three neighbours merged against single ones; mutual
best spans above a threshold are the alignment, in any order.

Word statistics cover all records. Records lie in blocks of about ``BLOCK`` characters. A word sends one row of counts for each block that
holds it; the rows of up to ``GROUP`` blocks meet in one task, so a word that stands in every block is added up in two steps, and
every block gets the representations of its own vocabulary. Nothing that grows with the data is broadcast or gathered. A record is
never divided, since a sentence may be rendered anywhere in it: the join within one record grows with the product of its sentences.

Defined results: records with a null or blank text on one side give no rows; sentences without counterpart give no row;
records delivered twice are one; texts of any length are compared whole; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qirtas.llm.leakage import normalized
from qirtas.llm.tables import connect, read
from qirtas.llm.vectors import as_array, list_array, words_of
from qirtas.operators.skew import salted_join
from qirtas.shared import write_shared

CONCEPTS, BLOCK, MERGED, LEAST = 256, 2_500_000, 3, 0.25
KEPT, STRONG, GROUP = 128, 128, 64
ENDS = re.compile("[.!?؟\n]")
_PREFIX = re.compile("^(?:[وب](?=..[^ ]))?(?:ال(?=...))?")


def bilingual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rec_table, rec_key, lang_pair, arabic, other) of hadith and tafsir."""

    def of(table: str, key: str, pair: str, arabic: str, other: str) -> DataFrame:
        return read(spark, sf_dir, table).select(F.lit(table).alias("rec_table"), F.col(key).cast("string").alias("rec_key"), F.lit(pair).alias("lang_pair"), F.col(arabic).alias("arabic"), F.col(other).alias("other"))

    rows = of("hadith", "hadith_id", "ar-id", "arabic_matn", "terjemah_id")
    rows = rows.union(of("tafsir", "tafsir_id", "ar-id", "text_arabic", "text_indonesia"))
    return rows.union(of("tafsir", "tafsir_id", "ar-en", "text_arabic", "text_english"))


def sentences(text: str) -> list[str]:
    """Pieces between the marks . ! ? ؟ and line feeds that are not blank."""
    return [s for s in ENDS.split(text) if s.strip()]


def _stems(words: pa.Array) -> list[str]:
    """Words without the article and the one-letter particles written together with them; other scripts stay as they are."""
    return [_PREFIX.sub("", w) if "ء" <= w[:1] <= "ي" else w for w in words.to_pylist()]


def _terms(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct stems, number of every word's stem, offsets of the texts)."""
    # words written in other forms of their letters are the same words
    texts = pc.utf8_normalize(pc.replace_substring_regex(as_array(texts), "[\\p{Cf}\\x{034F}]", ""), "NFKC")
    for form, letter in (("ی", "ي"), ("ک", "ك"), ("ۃ", "ة"), ("ہ", "ه"), ("ە", "ه")):
        texts = pc.replace_substring(texts, form, letter)
    words, codes, ends = words_of(normalized(texts), " ")
    ids: dict[str, int] = {}
    to = np.fromiter((ids.setdefault(s, len(ids)) for s in _stems(words)), np.int64, len(words))
    return list(ids), to[codes] if len(codes) else codes, ends


_KEY = ["lang_pair", "side", "word"]
_COUNTS = "lang_pair string, side int, word string, block int, concepts array<smallint>, counts array<int>"


def _occurrences(table: DataFrame, concepts: int) -> DataFrame:
    """For each word of a block, in how many of the block's records of each concept it stands; several rows where a block has several batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column("block").to_numpy().astype(np.int64)
            concept = batch.column("concept").to_numpy().astype(np.int64)
            pairs = as_array(batch.column("lang_pair")).dictionary_encode()
            pair = pairs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            blocks, of_block = np.unique(block, return_inverse=True)
            for side, name in enumerate(("arabic", "other")):
                stems, codes, ends = _terms(batch.column(name))
                if not len(codes):
                    continue
                row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
                once = np.unique(codes * np.int64(len(ends)) + row)
                code, row = once // len(ends), once % len(ends)
                key = ((code * len(pairs.dictionary) + pair[row]) * len(blocks) + of_block[row]) * concepts + concept[row]
                key, n = np.unique(key, return_counts=True)
                word = key // concepts
                first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
                offsets, word = np.append(first, len(key)), word[first]
                yield pa.RecordBatch.from_arrays(
                    [
                        pairs.dictionary.take(pa.array(word // len(blocks) % len(pairs.dictionary))),
                        pa.array(np.full(len(first), side, np.int32)),
                        pa.array(stems, pa.string()).take(pa.array(word // len(blocks) // len(pairs.dictionary))),
                        pa.array(blocks[word % len(blocks)].astype(np.int32)),
                        list_array((key % concepts).astype(np.int16), offsets, pa.int16()),
                        list_array(n.astype(np.int32), offsets, pa.int32()),
                    ],
                    names=["lang_pair", "side", "word", "block", "concepts", "counts"],
                )

    return table.mapInArrow(run, _COUNTS)


def _added(rows: DataFrame, key: list[str], concepts: int, schema: str, make: Callable[[tuple, np.ndarray, list], list[tuple]]) -> DataFrame:
    """Rows (key..., block, concepts, counts) added up by key; ``make`` gives the output rows from a key, its counts and its blocks."""
    names = [f.split(" ")[0] for f in schema.split(", ")]
    kinds = {"string": pa.string(), "int": pa.int32(), "float": pa.float32(), "binary": pa.binary(), "array<smallint>": pa.list_(pa.int16()), "array<int>": pa.list_(pa.int32())}
    types = [kinds[f.split(" ")[1]] for f in schema.split(", ")]
    k = len(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        total, blocks = np.zeros(concepts), []
        out: list[tuple] = []
        batch_of = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = list(zip(*(as_array(batch.column(i)).to_pylist() for i in range(k))))
            block = batch.column(k).to_pylist()
            lists = as_array(batch.column(k + 1))
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            concept, n = lists.flatten().to_numpy(zero_copy_only=False), as_array(batch.column(k + 2)).flatten().to_numpy(zero_copy_only=False)
            starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
            for i, until in zip(starts, [*starts[1:], len(keys)]):
                if keys[i] != held:
                    if held is not None:
                        out += make(held, total, blocks)
                    held, blocks, total = keys[i], [], np.zeros(concepts)
                total += np.bincount(concept[ends[i] : ends[until]], n[ends[i] : ends[until]], concepts)
                blocks += dict.fromkeys(b for b in block[i:until] if not blocks or b != blocks[-1])
            if len(out) > 5_000:
                yield batch_of()
                out.clear()
        if held is not None:
            out += make(held, total, blocks)
        if out:
            yield batch_of()

    return rows.repartition(*key).sortWithinPartitions(*key, "block").select(*key, "block", "concepts", "counts").mapInArrow(run, schema)


def _represented(words: DataFrame, sizes: dict[tuple[str, int], int], concepts: int, kept: int, blocks: int, group: int = GROUP) -> DataFrame:
    """(block, lang_pair, side, word, weight, among, vector): the strongest concepts of every word (one bit a concept, one byte for
    each that is kept), once for each block that holds it."""
    totals = {pair: np.zeros(concepts) for pair, _ in sizes}
    for (pair, concept), n in sizes.items():
        totals[pair][concept] = n
    shared = words.sparkSession.sparkContext.broadcast(totals)  # language pairs x concepts

    def vector(key: tuple, counts: np.ndarray) -> tuple | None:
        size = shared.value[key[0]]
        total, df = max(size.sum(), 1), counts.sum()
        rest = counts - df * size / total
        top = np.abs(rest).max()
        if top <= 0 or df <= 1:
            return None
        among = np.zeros(concepts, bool)
        among[np.argpartition(-np.abs(rest), min(kept, concepts) - 1)[:kept]] = True
        return float(np.log(total / df)), np.packbits(among).tobytes(), np.round(rest[among] * (127 / top)).astype(np.int8).tobytes()

    if blocks <= group:
        each = lambda key, counts, held: [(b, *key, *v) for v in [vector(key, counts)] if v for b in held]
        return _added(words, _KEY, concepts, "block int, lang_pair string, side int, word string, weight float, among binary, vector binary", each)
    # first the sums of up to ``group`` blocks, then of those sums
    parted = words.withColumn("part", (F.col("block") / group).cast("int"))

    def some(key: tuple, counts: np.ndarray, held: list) -> list[tuple]:
        at = np.flatnonzero(counts)
        return [(*key, 0, at.tolist(), counts[at].astype(int).tolist(), held)]

    schema = "lang_pair string, side int, word string, part int, block int, concepts array<smallint>, counts array<int>, blocks array<int>"
    sums = write_shared(_added(parted, [*_KEY, "part"], concepts, schema, some), "sums")
    one = lambda key, counts, held: [(*key, *v) for v in [vector(key, counts)] if v]
    whole = _added(sums, _KEY, concepts, "lang_pair string, side int, word string, weight float, among binary, vector binary", one)
    whole = whole.join(sums.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("k")), _KEY)
    rows = salted_join(sums.select(*_KEY, "part", "blocks"), whole, _KEY, "k", "part", "inner")
    return rows.select(F.explode("blocks").alias("block"), *_KEY, "weight", "among", "vector")


def _join_sql(merged: int, least: float) -> str:
    """Cosines of single sentences by a join on record and concept; those of merged windows, which lie in the record by their norm, follow from sums of the products."""
    windows = ["SELECT rec, i AS i0, i AS i1, j AS j0, j AS j1, product FROM single"]
    for k in range(1, merged):
        for own, other in ("ij", "ji"):
            over = f"OVER (PARTITION BY rec, {other} ORDER BY {own} RANGE BETWEEN CURRENT ROW AND {k} FOLLOWING)"
            last = {"i": ("i + %d" % k if own == "i" else "i"), "j": ("j + %d" % k if own == "j" else "j")}
            windows.append(f"SELECT rec, i, {last['i']}, j, {last['j']}, sum(product) {over} FROM single")
    return f"""
    WITH single AS (
      SELECT a.rec, a.place AS i, b.place AS j, sum(a.w * b.w) AS product FROM ar a JOIN tr b ON a.rec = b.rec AND a.concept = b.concept GROUP BY a.rec, a.place, b.place
    ), s AS (
      SELECT w.rec, i0, i1, j0, j1, product / (a.norm * b.norm) AS score
      FROM ({' UNION ALL '.join(windows)}) w
      JOIN ar_norm a ON w.rec = a.rec AND i0 = a.lo AND i1 = a.hi JOIN tr_norm b ON w.rec = b.rec AND j0 = b.lo AND j1 = b.hi
      WHERE a.norm > 0 AND b.norm > 0 AND product / (a.norm * b.norm) >= {least}
    ), ranked AS (
      SELECT *, max(score) OVER (PARTITION BY rec, i0, i1) AS best_a, max(score) OVER (PARTITION BY rec, j0, j1) AS best_b FROM s
    ), spans AS (
      SELECT * FROM ranked WHERE score = best_a AND score = best_b
    )
    SELECT rec, i, j, max(score) AS score
    FROM (SELECT rec, score, i, unnest(range(j0, j1 + 1)) AS j FROM (SELECT rec, score, j0, j1, unnest(range(i0, i1 + 1)) AS i FROM spans))
    GROUP BY rec, i, j"""


def _norms(record: np.ndarray, at: np.ndarray, vectors: np.ndarray, merged: int) -> pa.Table:
    """(rec, lo, hi, norm) of every sentence and of every merge of up to ``merged`` neighbours in a record."""
    square = np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64)
    parts, total = [], np.zeros(len(record))
    for k in range(min(merged, len(record))):
        # the square of a longer window: that of the one before, the new sentence's, and its products with the others
        n = len(record) - k
        total = total[:n] + square[k:]
        for d in range(1, k + 1):
            total = total + 2 * np.einsum("ij,ij->i", vectors[k - d : k - d + n], vectors[k:], dtype=np.float64)
        same = record[:n] == record[k:]
        parts.append((record[:n][same], at[:n][same], at[k:][same], np.sqrt(np.maximum(total[same], 0))))
    return pa.table(dict(zip(("rec", "lo", "hi", "norm"), (np.concatenate(x) for x in zip(*parts)))) if parts else {k: pa.array([], t) for k, t in (("rec", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("norm", pa.float64()))})


def _sums(vectors: np.ndarray, rows: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The sum of the vectors of every sentence: word by word over all sentences that are long enough, longest first."""
    sizes = np.diff(ends)
    order = np.argsort(-sizes, kind="stable")
    starts, long = ends[:-1][order], np.searchsorted(-sizes[order], -np.arange(1, (sizes.max(initial=0)) + 1), side="right")
    total = np.zeros((len(sizes), vectors.shape[1]), np.float32)
    for k, n in enumerate(long.tolist()):
        total[:n] += vectors[rows[starts[:n] + k]]
    out = np.empty_like(total)
    out[order] = total
    return out


def _strongest(vectors: np.ndarray, kept: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``kept`` greatest entries of every row; the others become 0 in place."""
    size, least = np.abs(vectors), vectors.shape[1] - kept
    among = size > 0
    if least > 0 and len(vectors):
        among &= size >= np.partition(size, least, axis=1)[:, least : least + 1]
        vectors *= among
    at = np.flatnonzero(among)
    return at // vectors.shape[1], at % vectors.shape[1]


def _align_block(texts: pa.Table, words: pa.Table, concepts: int, strong: int, merged: int, least: float) -> pa.Table:
    empty = pa.schema([("rec_table", pa.string()), ("rec_key", pa.string()), ("lang_pair", pa.string()), ("ar_sent", pa.int32()), ("tr_sent", pa.int32()), ("score", pa.float64())]).empty_table()
    if not texts.num_rows or not words.num_rows:
        return empty
    keys = texts.select(["rec_table", "rec_key", "lang_pair"]).to_pylist()
    named = {(p, s, w): k for k, (p, s, w) in enumerate(zip(*(words.column(c).to_pylist() for c in ("lang_pair", "side", "word"))))}
    bits = np.frombuffer(b"".join(words.column("among").to_pylist()), np.uint8).reshape(words.num_rows, -1)
    vectors = np.zeros((words.num_rows, concepts), np.float32)
    vectors[np.unpackbits(bits, axis=1, count=concepts).astype(bool)] = np.frombuffer(b"".join(words.column("vector").to_pylist()), np.int8)
    vectors *= (words.column("weight").to_numpy() / np.linalg.norm(vectors, axis=1)).astype(np.float32)[:, None]
    vectors = np.vstack([vectors, np.zeros((1, concepts), np.float32)])
    concept = texts.column("concept").to_numpy()
    tables = {}
    for side, (name, table) in enumerate((("arabic", "ar"), ("other", "tr"))):
        split = [sentences(t) for t in texts.column(name).to_pylist()]
        ends = np.append(0, np.cumsum([len(s) for s in split]))
        stems, codes, of_sentence = _terms(pa.array([s for x in split for s in x], pa.string()))
        record = np.repeat(np.arange(len(split)), np.diff(ends))
        pair_of = np.array([k["lang_pair"] for k in keys])
        rows = np.full(len(codes), len(vectors) - 1)
        sentence = np.repeat(np.arange(len(of_sentence) - 1), np.diff(of_sentence))
        for pair in set(pair_of.tolist()):
            to = np.array([named.get((pair, side, s), len(vectors) - 1) for s in stems], np.int64)
            mine = (pair_of == pair)[record[sentence]] if len(codes) else np.zeros(0, bool)
            rows[mine] = to[codes[mine]]
        total = _sums(vectors, rows, of_sentence)
        total[np.arange(len(record)), concept[record]] = 0
        at = np.arange(len(record)) - ends[record]
        row, column = _strongest(total, strong)
        tables[table] = pa.table({"rec": record[row].astype(np.int32), "place": at[row].astype(np.int32), "concept": column.astype(np.int16), "w": total[row, column]})
        tables[f"{table}_norm"] = _norms(record, at, total, merged)
    link = connect()
    for table, rows in tables.items():
        link.register(table, rows)
    found = link.sql(_join_sql(merged, least)).to_arrow_table()
    link.close()
    rec = found.column("rec").combine_chunks()
    kept = texts.select(["rec_table", "rec_key", "lang_pair"]).take(rec)
    for name, column in (("ar_sent", "i"), ("tr_sent", "j")):
        kept = kept.append_column(name, found.column(column).cast(pa.int32()))
    return kept.append_column("score", found.column("score").cast(pa.float64()))


def align(rows: DataFrame, concepts: int = CONCEPTS, block: int = BLOCK, merged: int = MERGED, least: float = LEAST, kept: int = KEPT, strong: int = STRONG, group: int = GROUP) -> DataFrame:
    """(rec_table, rec_key, lang_pair, ar_sent, tr_sent, score) of the sentences that render each other."""
    rows = rows.where("rec_key is not null and trim(arabic) <> '' and trim(other) <> ''")
    size = rows.agg(F.sum(F.length("arabic") + F.length("other"))).first()[0] or 0
    blocks = max(1, -(-size // block))
    of = F.xxhash64("rec_table", "rec_key")
    placed = rows.select(F.pmod(of, F.lit(blocks)).cast("int").alias("block"), F.pmod(F.shiftright(of, 20), F.lit(concepts)).cast("int").alias("concept"), "rec_table", "rec_key", "lang_pair", "arabic", "other")
    placed = placed.dropDuplicates(["rec_table", "rec_key", "lang_pair"])
    table = write_shared(placed.repartition(2 * blocks, "block").sortWithinPartitions("block", "rec_key"), "pairs")
    sizes = {(r[0], r[1]): r[2] for r in table.groupBy("lang_pair", "concept").count().collect()}  # language pairs x concepts
    words = _represented(_occurrences(table, concepts), sizes, concepts, kept, blocks, group)
    names = ["rec_table", "rec_key", "lang_pair", "ar_sent", "tr_sent", "score"]

    def run(texts: pa.Table, vocabulary: pa.Table) -> pa.Table:
        return _align_block(texts, vocabulary, concepts, strong, merged, least)

    # one partition for about every block, whatever the session's number of shuffle partitions
    both = table.repartition(2 * blocks, "block").groupBy("block").cogroup(words.repartition(2 * blocks, "block").groupBy("block"))
    return both.applyInArrow(run, "rec_table string, rec_key string, lang_pair string, ar_sent int, tr_sent int, score double").select(*names)
