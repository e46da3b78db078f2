"""Joins against a key table whose probe side may hold a few very frequent keys.

``keys`` carries the number of probe rows of each key, and is written to the shared folder. Keys with ``heavy`` rows or more are at most
``rows / heavy`` in number. Where there is none (a glance at the table's statistics tells), the join is a plain one. Otherwise the ``MOST``
most frequent are listed, so the list that is broadcast is bounded at any size (some 60 MB at its fullest, beyond 10^12 rows; a key that
it leaves out has no more than a 10^6th of the rows). The probe rows of listed keys are spread over ``salts`` partitions, and their single
key row is repeated once a salt. Every other key is joined in one place. Key tables of more than ``SMALL`` rows are never broadcast,
however small their files are. No row is dropped and the probe side is read once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qirtas.shared import write_shared

HEAVY, MOST, SMALL = 1_000_000, 1_000_000, 10_000
SALTS = 64


def salted_join(probe: DataFrame, keys: DataFrame, on: Sequence[str], count: str, spread: str, how: str = "left_semi", heavy: int = HEAVY, salts: int = SALTS) -> DataFrame:
    """Join ``probe`` with ``keys`` (one row a key, ``count`` = its probe rows) on the columns ``on``.

    ``spread`` is the probe column whose hash picks the salt. Null keys match nothing. Extra columns of
    ``keys`` other than ``count`` come along for inner and left joins.
    """
    on = list(on)
    keys = write_shared(keys, "keys")
    hot = keys.where(F.col(count) >= heavy)
    large = keys.count() > SMALL  # from the footers
    side = lambda rows: rows.hint("merge") if large else rows
    if hot.isEmpty():
        return probe.join(side(keys.drop(count)), on, how)
    listed = write_shared(hot.orderBy(F.desc(count), *on).limit(MOST).select(*on, F.lit(True).alias("_hot")), "hot")
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    flagged = probe.join(F.broadcast(listed), on, "left").withColumn("_salt", salt).drop("_hot")
    each = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    spread_keys = keys.join(F.broadcast(listed), on, "left").withColumn("_salt", F.explode(each)).drop(count, "_hot")
    return flagged.join(side(spread_keys), [*on, "_salt"], how).drop("_salt")
