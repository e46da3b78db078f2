"""Quoted fragments of a commentary, cleaned comparison texts, and fuzzy scores between them."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qirtas.functions.normalize import WHITE, normalize_ar, trim_fragment
from qirtas.shared import write_shared

# Where trailing remarks begin, and what ends a leading chain.
REMARKS = "(?s)(قال أبو عيسى|وفي الباب|قال أبو داود|رواه|أخرجه|هذا حديث).*$"
CHAIN = "(?s)^.*?(?:قال رسول الله|قال النبي|عن النبي[^:]{0,30}?قال|أنه قال|يقول)(?U:\\s)*[:؛]?(?U:\\s)*"
# Triggers with the quotation after them and before them, and the marks at which a fragment stops or starts.
FORWARD = (("QALA_RASUL", "قال رسول الله"), ("QALA_NABI", "قال النبي"), ("AN_NABI_QALA", "عن النبي[^.﴿]{0,40}?قال"))
BACKWARD = (("RAWAHU", "رواه"), ("AKHRAJA", "أخرجه"))
STOP = "رواه|أخرجه|قال أبو|وفي الباب|هذا حديث|\\.|﴿|»"
START = "قال رسول الله|قال النبي|عن النبي|أنه قال|يقول|:|«|﴾"
NOISE = "من طريق|من حديث|في مسنده|في سننه|في صحيحه|في معجمه|إسناد|رجاله|الحافظ|برقم"
REACH, LEAST_WORDS = 400, 5
_CUT = "\ufdd0"  # a character that no text holds


def clean_matn(c: Column) -> Column:
    """C11. Without trailing remarks and leading chain, in the search form. Null becomes empty."""
    return normalize_ar(F.regexp_replace(F.regexp_replace(c, REMARKS, ""), CHAIN, ""))


def n_words(c: Column) -> Column:
    """P12. Words between white space."""
    return F.size(F.filter(F.split(c, f"{WHITE}+"), lambda w: w != ""))


def extract_fragments(c: Column) -> Column:
    """C12, C13, P13, N18. array<struct<label, fragment>>: trimmed pieces of at least five words after or before a trigger, without those of source remarks.

    The text is cut at every trigger; of what follows (or precedes) ``REACH`` characters are looked at, and no more parts than could make them up.
    """
    text = F.coalesce(c, F.lit(""))
    after = [_pieces(text, label, trigger, f"$0{_CUT}", _behind) for label, trigger in FORWARD]
    before = [_pieces(text, label, trigger, f"{_CUT}$0", _ahead) for label, trigger in BACKWARD]
    return F.concat(*after, *before)


def _behind(parts: Column, i: Column) -> Column:
    """What follows cut ``i``, up to where a quotation stops."""
    near = F.substring(F.array_join(F.slice(parts, i + 2, F.lit(REACH)), ""), 1, REACH)
    return F.get(F.split(near, STOP, 2), F.lit(0))


def _ahead(parts: Column, i: Column) -> Column:
    """What precedes cut ``i``, from where a quotation last starts."""
    near = F.slice(parts, F.greatest(i + 2 - F.lit(REACH), F.lit(1)), F.least(i + 1, F.lit(REACH)))
    return F.element_at(F.split(F.substring(F.array_join(near, ""), -REACH, REACH), START), -1)


def _pieces(text: Column, label: str, trigger: str, cut: str, near: Callable[[Column, Column], Column]) -> Column:
    parts = F.split(F.regexp_replace(text, trigger, cut), _CUT)
    found = F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda _, i: trim_fragment(near(parts, i)))
    kept = F.filter(found, lambda x: (n_words(x) >= LEAST_WORDS) & ~x.rlike(NOISE))
    return F.transform(kept, lambda x: F.struct(F.lit(label).alias("label"), x.alias("fragment")))


def comparable(rows: DataFrame, key: str, text: Column, name: str) -> DataFrame:
    """P12. (``name``, text) of the rows with at least five words. The text is made once: a filter is not moved below an explode, where it would make it again."""
    return rows.select(F.col(key).alias(name), F.explode(F.array(text)).alias("text")).where(n_words(F.col("text")) >= LEAST_WORDS)


# Similarity of the best window


def _lcs(rows: dict[str, int], width: int, other: str) -> int:
    """Length of the longest common subsequence, bit-parallel over the first string's positions."""
    full = (1 << width) - 1
    state = full
    for char in other:
        hit = state & rows.get(char, 0)
        state = ((state + hit) | (state - hit)) & full
    return width - state.bit_count()


def _positions(text: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, char in enumerate(text):
        out[char] = out.get(char, 0) | 1 << i
    return out


def partial_ratio(a: str, b: str, least: float = 0.0) -> float:
    """0 to 100: the best 200 * common / (both lengths) of the shorter string with any window of the longer, the shorter's
    length or cut at an end. Scores under ``least`` may come out as 0. Two empty strings give 100, one gives 0."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 100.0 if not b else 0.0
    best = 0.0
    for short, long in [(a, b), (b, a)] if len(a) == len(b) else [(a, b)]:
        m, n = len(short), len(long)
        rows = _positions(short)
        # windows cut off at an end: one pass gives the common length with every beginning, one with every end
        for bits, text in ((rows, long), (_positions(short[::-1]), long[::-1])):
            full = state = (1 << m) - 1
            for width, char in enumerate(text[:m], 1):
                hit = state & bits.get(char, 0)
                state = ((state + hit) | (state - hit)) & full
                best = max(best, 200 * (m - state.bit_count()) / (m + width))
        # whole windows: moving on by one place adds at most one common letter, so places that cannot be better are passed over
        start = 1
        while start < n - m:
            common = _lcs(rows, m, long[start : start + m])
            best = max(best, 100 * common / m)
            needed = max(math.floor(best * m / 100 + 1e-9) + 1, math.ceil(least * m / 100 - 1e-9))
            start += max(1, needed - common)
    return best if best >= least else 0.0


# Pairs that can reach a score, many at once

WORD, EVERY, CELLS = 64, 4, 32_768  # letters in a number, columns between two looks at the distance, numbers worked on at once
LETTERS = 10_000_000  # of the texts that are looked at at once
SHARE, FILL = 0.9, 70  # of a short string's letters looked at first, and letters of a group that are aimed at


def near_pairs(shorts: list[str], longs: list[str], least: float) -> np.ndarray:
    """Two rows of places: every pair of a short and a long string, the first no longer than the second, that may score ``least``, and few others.

    A score of ``least`` means that so few letters are to be left out of the short string m and of a window of the long one, at most
    2 m (1 - least / 100) of both. That is also so for what the two hold of any group of letters, and for each piece of
    the short string against its best place in the long one: the numbers for several groups and pieces add up to no more than the whole distance. Each
    piece takes the bits of one number, so that numpy moves many pairs on by one letter in a few calls. Pairs
    that pass with a few groups of rarer letters are looked at again with all letters.
    """
    (chars, at, lengths), (text, text_at, text_lengths) = _laid(shorts), _laid(longs)
    order, text_order = np.argsort(lengths, kind="stable"), np.argsort(text_lengths, kind="stable")
    sizes, text_sizes = lengths[order], text_lengths[text_order]
    number = np.zeros(0x110000, np.intp)  # of a letter in its group; 0 elsewhere
    found, start = [np.zeros((2, 0), np.intp)], 0
    while start < len(order):  # strings of about the same length
        end = min(int(np.searchsorted(sizes, sizes[start] * 1.3, "right")), start + 1_024)
        own = order[start:end]
        most = 2 * (1 - least / 100) * sizes[start:end] + 1e-9
        letters, places = np.concatenate([chars[at[i] : at[i + 1]] for i in own]), np.repeat(np.arange(len(own)), sizes[start:end])
        masks = [_masks(number, group, letters, places, len(own)) for group in _groups(letters, int(sizes[end - 1]))]
        wide = sum(m.shape[1] * m.shape[2] for _, m, _ in masks) // len(masks)
        maybe, s = [], int(np.searchsorted(text_sizes, sizes[start]))
        while s < len(text_order):
            e = min(len(text_order), s + max(1, CELLS // wide))
            longer = text_order[s:e]
            flat, rows = np.concatenate([text[text_at[i] : text_at[i + 1]] for i in longer]), np.repeat(np.arange(e - s), text_sizes[s:e])
            apart = np.zeros((e - s, len(own)), np.int32)
            for group, bits, filled in masks:
                columns, alive, turn = _columns(number, group, flat, rows, np.arange(e - s))
                by_letter = bits.reshape(len(bits), -1)
                fewest = _fewest(lambda c, out, by_letter=by_letter: by_letter.take(c, axis=0, out=out, mode="clip"), columns, alive, by_letter.shape[1])
                apart[turn] += _distance(fewest.reshape(e - s, *bits.shape[1:]), filled).sum(axis=2, dtype=np.int32)
            i, j = np.nonzero((apart <= most) & (text_sizes[s:e, None] >= sizes[start:end]))
            maybe.append(np.stack([j, longer[i]]))
            s = e
        found.append(_nearer(number, own, letters, places, most, np.concatenate(maybe, axis=1), (text, text_at, text_lengths)) if maybe else found[0])
        start = end
    return np.concatenate(found, axis=1)


def _nearer(number: np.ndarray, own: np.ndarray, letters: np.ndarray, places: np.ndarray, most: np.ndarray, maybe: np.ndarray, longs: tuple) -> np.ndarray:
    """Of the pairs ``maybe`` (place in ``own``, long string) those near with all letters, as pairs of strings."""
    text, text_at, text_lengths = longs
    maybe = maybe[:, np.argsort(text_lengths[maybe[1]], kind="stable")]
    every = np.unique(letters)
    _, bits, filled = _masks(number, every, letters, places, len(own))
    pieces, by_pair = bits.shape[2], bits.reshape(-1, bits.shape[2])
    kept, step = [np.zeros((2, 0), np.intp)], max(1, CELLS // pieces)
    for s in range(0, maybe.shape[1], step):
        j, t = maybe[:, s : s + step]
        strings, row = np.unique(t, return_inverse=True)
        flat, rows = np.concatenate([text[text_at[i] : text_at[i + 1]] for i in strings]), np.repeat(np.arange(len(strings)), text_lengths[strings])
        columns, alive, turn = _columns(number, every, flat, rows, row)
        j, t = j[turn], t[turn]
        fewest = _fewest(lambda c, out, j=j: by_pair.take(c * len(own) + j[: len(c)], axis=0, out=out, mode="clip"), columns, alive, pieces)
        near = _distance(fewest, filled[j]).sum(axis=1, dtype=np.int32) <= most[j]
        kept.append(np.stack([own[j[near]], t[near]]))
    return np.concatenate(kept, axis=1)


def _laid(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All letters, where each text begins, and its length."""
    lengths = np.fromiter(map(len, texts), np.intp, len(texts))
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), np.concatenate([[0], np.cumsum(lengths)]), lengths


def _groups(letters: np.ndarray, longest: int) -> list[np.ndarray]:
    """The rarer letters in up to three groups, each with about as many letters of a string."""
    each, counts = np.unique(letters, return_counts=True)
    n = min(3, max(1, math.ceil(SHARE * longest / FILL)))
    rare = np.argsort(counts, kind="stable")
    rare = rare[: max(1, int(np.searchsorted(np.cumsum(counts[rare]), max(SHARE * len(letters), 1), "right")))]
    load, out = [0] * n, [[] for _ in range(n)]
    for i in rare[::-1]:
        g = load.index(min(load))
        load[g] += int(counts[i])
        out[g].append(each[i])
    return [np.array(x) for x in out if x]


def _ranked(number: np.ndarray, group: np.ndarray, flat: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The letters of ``flat`` that are in ``group``: number of the letter, row, place in the row; and how many each row has."""
    number[group] = np.arange(1, len(group) + 1)
    code = number[flat]
    number[group] = 0
    kept = np.flatnonzero(code)
    code, row = code[kept], rows[kept]
    count = np.bincount(row, minlength=n)
    return code, row, np.arange(len(row)) - (np.cumsum(count) - count)[row], count


def _masks(number: np.ndarray, group: np.ndarray, letters: np.ndarray, places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The group, its bits (letter, string, piece) in the upper end of every number, and the letters in each piece."""
    code, row, place, count = _ranked(number, group, letters, places, n)
    pieces = max(1, -(-int(np.quantile(count, 0.5) * 0.9) // WORD))
    size = np.minimum(-(-count // pieces), WORD)  # what goes beyond is left out
    piece, bit = np.divmod(place, np.maximum(size, 1)[row])
    filled = np.clip(count[:, None] - size[:, None] * np.arange(pieces), 0, size[:, None])
    ok = piece < pieces
    code, row, piece, bit = code[ok], row[ok], piece[ok], bit[ok]
    bits = np.zeros((len(group) + 1, n, pieces), np.uint64)
    np.bitwise_or.at(bits, (code, row, piece), np.left_shift(np.uint64(1), (WORD - filled[row, piece] + bit).astype(np.uint64)))
    return group, bits, filled


def _columns(number: np.ndarray, group: np.ndarray, flat: np.ndarray, rows: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row for each place, a column for each text ``wanted``, the longest first: number of the letter in the group, 0 behind the end. With how many texts go
    on at every ``EVERY``th place, and where each stood in ``wanted``."""
    code, row, place, count = _ranked(number, group, flat, rows, int(wanted.max(initial=-1)) + 1)
    out = np.zeros((-(-int(count.max(initial=0)) // EVERY) * EVERY, len(count)), np.intp)
    out[place, row] = code
    sizes = count[wanted]
    turn = np.argsort(-sizes, kind="stable")
    return out[:, wanted[turn]], np.searchsorted(-sizes[turn], -np.arange(0, len(out), EVERY)), turn


def _fewest(look_up: Callable[[np.ndarray, np.ndarray], object], columns: np.ndarray, alive: np.ndarray, wide: int) -> np.ndarray:
    """Least number of set bits at every ``EVERY``th column. A bit is set where the distance grows by one from a letter of the piece to the next, else it
    falls by one; that it may begin anywhere in the text comes from the one carried in at every second column."""
    shape, one = (columns.shape[1], wide), np.uint64(1)
    states, hits, rests = np.full(shape, ~np.uint64(0)), np.empty(shape, np.uint64), np.empty(shape, np.uint64)
    fewest, counts = np.full(shape, WORD, np.uint8), np.empty(shape, np.uint8)
    for at, k in zip(range(0, len(columns), EVERY), alive.tolist()):
        state, hit, rest, best, ones = states[:k], hits[:k], rests[:k], fewest[:k], counts[:k]
        for j in range(at, at + EVERY):
            look_up(columns[j, :k], hit)
            np.bitwise_and(state, hit, out=hit)
            np.subtract(state, hit, out=rest)
            np.add(state, hit, out=state)
            if not j & 1:
                np.add(state, one, out=state)
            np.bitwise_or(state, rest, out=state)
        np.minimum(best, np.bitwise_count(state, out=ones), out=best)
    return fewest


def _distance(fewest: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """At least so many letters are to be left out: less one for the beginning, and one for each column up to the nearest that was looked at."""
    return np.maximum(2 * fewest.astype(np.int32) - 2 * WORD + filled - 1 - EVERY // 2, 0)


def _matches(asked: Sequence[str], texts: Sequence[str], least: float) -> Iterator[tuple[int, int, float]]:
    """(place in ``asked``, place in ``texts``, score) of all pairs that score ``least``."""
    near = {(q, t) for q, t in near_pairs(asked, texts, least).T.tolist()} | {(q, t) for t, q in near_pairs(texts, asked, least).T.tolist()}
    for q, t in sorted(near):
        value = partial_ratio(asked[q], texts[t], least)
        if value >= least:
            yield q, t, value


def fuzzy_top(queries: DataFrame, corpus: DataFrame, k: int = 3, least: float = 80.0, block: int = 10_000) -> DataFrame:
    """J14, O10, O11, P15. (query_id, corpus_id, score, rank): the ``k`` best matches of every query, those under ``least`` left out afterwards.

    ``queries`` (query_id, text) is a given set and goes to the executors as a whole, where ``block`` of them are looked at at once; the corpus
    (corpus_id, text) is read once and never gathered. ``near_pairs`` drops only pairs that score less than ``least``. Ties go to the smaller corpus_id.
    """
    rows = [(q, t) for q, t in queries.where("query_id is not null and text <> ''").select("query_id", "text").toLocalIterator()]
    kind = {n: dict(df.dtypes)[n] for df, n in ((queries, "query_id"), (corpus, "corpus_id"))}
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "corpus_id")
    return _scores(rows, corpus, least, kind, block).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _scores(rows: list[tuple], corpus: DataFrame, least: float, kind: dict[str, str], block: int) -> DataFrame:
    shared = corpus.sparkSession.sparkContext.broadcast(rows)

    def scored(ids: list, texts: list[str]) -> Iterator[tuple]:
        for at in range(0, len(shared.value), block):
            queries, asked = zip(*shared.value[at : at + block])
            for q, t, value in _matches(asked, texts, least):
                yield queries[q], ids[t], value

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts = [], []
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                ids += batch.column(0).to_pylist()
                texts += batch.column(1).to_pylist()
            if texts and (batch is None or sum(map(len, texts)) >= LETTERS):
                if found := list(scored(ids, texts)):
                    columns = list(zip(*found))
                    yield pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(columns[1]), pa.array(columns[2], pa.float64())], names=["query_id", "corpus_id", "score"])
                ids, texts = [], []

    wanted = corpus.where("corpus_id is not null and text <> ''").select("corpus_id", "text")
    # the texts of a file, or of a shuffle that was put together by size, would be scored by few tasks
    wanted = wanted.repartition(2 * corpus.sparkSession.sparkContext.defaultParallelism)
    return wanted.mapInArrow(score, f"query_id {kind['query_id']}, corpus_id {kind['corpus_id']}, score double")


def fuzzy_join(queries: DataFrame, corpus: DataFrame, k: int = 3, least: float = 80.0, block: int = 20_000) -> DataFrame:
    """J14, O10, O11, P15 for queries that grow with the data. (text, corpus_id, score, rank): as ``fuzzy_top``, for every distinct text of ``queries`` (text).

    Equal texts are scored once; of a text's corpus_id only the ``k`` smallest can be among the best. Both sides are cut into blocks of
    about ``block`` texts, and each task scores a block of queries against a block of the corpus.
    """
    cores = corpus.sparkSession.sparkContext.defaultParallelism
    asked = write_shared(queries.where("text <> ''").select("text").distinct(), "asked")
    same = Window.partitionBy("text").orderBy("corpus_id")
    known = corpus.where("corpus_id is not null and text <> ''").select("corpus_id", "text").withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= k)
    known = write_shared(known, "known")
    height = max(1, -(-asked.count() // block))
    width = max(1, -(-known.where("_n = 1").count() // block), -(-2 * cores // height))

    own = lambda n: F.pmod(F.xxhash64("text"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    sides = [asked.select("text", F.lit(True).alias("asks"), own(height).alias("i"), every(width).alias("j"))]
    sides += [known.where("_n = 1").select("text", F.lit(False).alias("asks"), every(height).alias("i"), own(width).alias("j"))]
    parts = [side.select("text", "asks", (F.col("i") * width + F.col("j")).cast("int").alias("part")) for side in sides]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: tuple[list[str], list[str]] = [], []
        for batch in batches:
            for text, asks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                texts[asks].append(text)
        for known, asked in itertools.product(*(list(_portions(side)) for side in texts)):
            if found := [(asked[q], known[t], value) for q, t, value in _matches(asked, known, least)]:
                columns = list(zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.float64())], names=["text", "found", "score"])

    pairs = parts[0].union(parts[1]).repartitionById(height * width, "part").mapInArrow(score, "text string, found string, score double")
    hits = pairs.join(known.select("corpus_id", F.col("text").alias("found")), "found")
    order = Window.partitionBy("text").orderBy(F.desc("score"), "corpus_id")
    return hits.select("text", "corpus_id", "score", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k)


def _portions(texts: list[str]) -> Iterator[list[str]]:
    """``LETTERS`` letters at once, or little more."""
    out, n = [], 0
    for text in texts:
        out.append(text)
        n += len(text)
        if n >= LETTERS:
            yield out
            out, n = [], 0
    if out:
        yield out
