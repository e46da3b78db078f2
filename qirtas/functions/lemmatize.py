"""X01. A pluggable lemmatiser; the default strips affixes by rule."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

Lemmatizer = Callable[[str], list[str]]
PROCLITIC = "^(?:[وف])?(?:[بكل])?(?:ال)?"
ENCLITIC = "(?:هما|كما|هم|كم|هن|نا|ها|ه|ك|ي|ون|ين|ات|ان)$"
MARKS = "[\u064b-\u065f\u0670\u0640]"  # vowel signs and tatweel


def affix_stripper(word: str) -> list[str]:
    """Candidates from most to least stripped, each of three letters or more, the word itself last."""
    bare = re.sub(MARKS, "", word)
    stem = re.sub(PROCLITIC, "", bare)
    out = [x for x in (re.sub(ENCLITIC, "", stem), stem) if len(x) >= 3]
    return list(dict.fromkeys([*out, bare])) if bare else []


def lemmatize(words: DataFrame, column: str, using: Lemmatizer = affix_stripper) -> DataFrame:
    """(column, candidates) of every distinct word: each word is analysed once, however often it stands."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(candidates=batch[column].map(using))

    return words.select(column).where(f"`{column}` is not null").distinct().mapInPandas(run, f"`{column}` string, candidates array<string>")
