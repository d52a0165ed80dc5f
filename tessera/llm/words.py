"""Words of a text, as column expressions.

A word is a run of ``[^\\x20\\x09-\\x0D]`` (anything but ASCII space, tab, newline, vertical tab,
form feed and carriage return).  A NULL text has no words.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str | Column) -> Column:
    """Array of the words in order; repeats kept."""
    col = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(col, F.lit("")), GAP), "")


def n_words(text: str | Column) -> Column:
    """Number of words (long)."""
    return F.size(words(text)).cast("long")


def need(df, *names: str) -> None:
    """Raise ValueError if ``df`` lacks one of the columns."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {df.columns}")


def fresh(df, stem: str) -> str:
    """A column name that ``df`` does not use."""
    name = stem
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def aside(df):
    """``df`` under column names that an operator's own ones never meet, and the columns that give the
    caller's names back."""
    names = [f"__{i}" for i in range(len(df.columns))]
    return df.toDF(*names), [F.col(n).alias(c) for n, c in zip(names, df.columns)]


def least_hashes(df, limit: int, *keys: str):
    """The ``limit`` rows with the smallest hashes of their (distinct) keys.

    A cut on the hash first leaves about twice as many rows, so that tasks do not each send ``limit``
    rows to be merged.
    """
    n, h = df.count(), F.xxhash64(*keys)
    if n > 2 * limit:
        df = df.where(h < F.lit(-(1 << 63) + int((1 << 64) * (2 * limit / n))))
    return df.orderBy(h, *keys).limit(limit)
