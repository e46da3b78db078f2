"""Whole Arrow batches of text as numpy arrays: words, their hashes, and rolling windows over them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_ODD = np.uint64(0x9E3779B97F4A7C15)


def as_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def words_of(texts: pa.Array, separators: str = " \n") -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of each text: (distinct words, code of every word, offsets of the texts). Null texts have no words."""
    texts = pc.fill_null(as_array(texts), "")
    for other in separators[1:]:
        texts = pc.replace_substring(texts, other, separators[0])
    lists = pc.split_pattern(texts, separators[0])
    flat = lists.flatten()
    if not len(flat):
        return pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    coded = as_array(flat.dictionary_encode())
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), out=ends[1:])
    blank = pc.index(coded.dictionary, "").as_py()
    if blank >= 0:
        keep = codes != blank
        ends = np.concatenate([[0], np.cumsum(keep)])[ends]
        codes = codes[keep]
    return coded.dictionary, codes, ends


def word_hashes(words: pa.Array, seed: int = 0) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words.to_pylist()), np.uint64, len(words))


def rolling(x: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hash of every ``size`` neighbours of ``x``; shorter by ``size - 1``."""
    if len(x) < size:
        return np.zeros(0, np.uint64)
    n = len(x) - size + 1
    out = x[:n].copy()
    for j in range(1, size):
        out *= _ODD
        out += x[j : j + n]
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them, so that their order is random."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def starts_within(ends: np.ndarray, size: int) -> np.ndarray:
    """Positions at which a window of ``size`` fits into its own text."""
    total = int(ends[-1])
    if total < size:
        return np.zeros(0, np.int64)
    room = np.repeat(ends[1:], np.diff(ends))[: total - size + 1]
    return np.flatnonzero(np.arange(total - size + 1) + size <= room)


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
