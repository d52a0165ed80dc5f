"""Review-text analytics: cleaning, tokens minus stop-words, word frequencies, counts per
category/aspect/sentiment, top words per group.

Reviews arrive as one row per (review, category, aspect, sentiment), so the same text repeats;
each analytic deduplicates on its own key before tokenising (as the reference does) and counts on
the undeduplicated rows where the reference does.  Tokenising is ``explode(split(...))`` in the
JVM; frequencies are partial-aggregated, so a very common word is pre-counted in every task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import clean_text, token_array
from tessera.operators.aggregate import count_by, word_frequency
from tessera.operators.filters import filter_eq, having
from tessera.operators.joins import exclude_values
from tessera.operators.rank import top_n, top_n_per_group


def cleaned(reviews: DataFrame, dedup_keys: Sequence[str], *, text: str = "review",
            out: str = "clean_text") -> DataFrame:
    """DISTINCT ``dedup_keys`` rows (which must include ``text``) with the cleaned text."""
    keys = [k for k in dedup_keys if k != text]
    return reviews.select(*dedup_keys).distinct() \
        .select(*keys, clean_text(text).alias(out))


def tokens(reviews: DataFrame, stop_words: Sequence[str] | DataFrame | None, *,
           dedup_keys: Sequence[str] = ("id", "review"), text: str = "review",
           keep: Sequence[str] | None = None, word: str = "word") -> DataFrame:
    """(keep..., word) for every non-empty token of the cleaned, deduplicated texts, minus
    stop-words (exact match on the whole token)."""
    keep = list(keep) if keep is not None else [k for k in dedup_keys if k != text]
    c = cleaned(reviews, dedup_keys, text=text)
    toks = c.select(*keep, F.explode(token_array("clean_text")).alias(word)) \
        .where((F.col(word).isNotNull()) & (F.col(word) != ""))
    if stop_words is None:
        return toks
    return exclude_values(toks, word, stop_words)


def frequent_words(toks: DataFrame, min_freq: int = 500, *, word: str = "word") -> DataFrame:
    """Words occurring more than ``min_freq`` times."""
    return having(word_frequency(toks, word), "freq", min_freq, strict=True)


def count_per(reviews: DataFrame, key: str | Sequence[str], *, id_col: str = "id",
              name: str = "n_comments") -> DataFrame:
    """Comments per key over the *undeduplicated* rows; rows with a NULL id do not count."""
    return count_by(reviews, key, id_col, name)


def sentiment_count(reviews: DataFrame, value: str, *, aspect: str = "aspect",
                    sentiment: str = "sentiment", id_col: str = "id",
                    name: str = "n_comments") -> DataFrame:
    """Comments with ``sentiment == value`` per aspect."""
    return count_per(filter_eq(reviews, sentiment, value), aspect, id_col=id_col, name=name)


def most_common(counts: DataFrame, *, key: str = "aspect", name: str = "n_comments") -> DataFrame:
    """The key with the largest count (ties: smallest key)."""
    return top_n(counts, [F.col(name).desc(), F.col(key).asc()], 1)


def top_words(reviews: DataFrame, stop_words: Sequence[str] | DataFrame | None, *,
              group: str = "category", dedup_keys: Sequence[str] = ("id", "review", "category"),
              text: str = "review", sentiment: str | None = None, sentiment_value: str | None = None,
              n: int = 5) -> DataFrame:
    """Top ``n`` words per group by frequency (ties: alphabetical).

    With ``sentiment_value`` only rows of that sentiment count (dedup keys should then include the
    sentiment column, as in the reference).
    """
    src = reviews if sentiment_value is None else filter_eq(reviews, sentiment, sentiment_value)
    keep = [group] + ([sentiment] if sentiment_value is not None else [])
    toks = tokens(src, stop_words, dedup_keys=dedup_keys, text=text, keep=keep)
    freq = word_frequency(toks, "word", keys=keep)
    return top_n_per_group(freq, group, [F.col("freq").desc(), F.col("word").asc()], n)
