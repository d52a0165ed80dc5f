"""Driver-table queries for the review-text analytics.

reviews = documents (id = doc_id, review = text, category = source, aspect = lang) and, for
sentiment, documents ⋈ labels (quality 1 -> positive, 0 -> negative).  Every query reads all
documents and whole texts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.aggregate import count_by, word_frequency
from tessera.operators.filters import having
from tessera.plans import reviews as RV
from tessera.plans import testbed as tb
from tessera.plans.registry import register

STOP_SQL = "(" + ", ".join(f"'{w}'" for w in tb.stop_words()) + ")"
CLEAN_SQL = (r"trim(regexp_replace(regexp_replace(lower(text), '[^\p{L}\p{N}\s]', ' ', 'g'), "
             r"'\s+', ' ', 'g'))")
MIN_FREQ = 500


def _docs(spark, sf):
    return tb.table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("review"),
        F.col("source").alias("category"), F.col("lang").alias("aspect"))


def _labelled(spark, sf):
    return tb.labelled_docs(spark, sf).select(
        F.col("doc_id").alias("id"), F.col("text").alias("review"),
        F.col("source").alias("category"), F.col("lang").alias("aspect"), "sentiment")


def _tok_sql(keys: str, dedup: str, source: str = "documents", where: str = "") -> str:
    """Tokens of the deduplicated cleaned texts, minus stop-words."""
    return f"""toks AS (
  SELECT {keys}, word FROM (
    SELECT {keys}, unnest(string_split({CLEAN_SQL}, ' ')) AS word
    FROM (SELECT DISTINCT {dedup} FROM {source} {where}))
  WHERE word <> '' AND word NOT IN {STOP_SQL})"""


LABELLED = """(SELECT d.doc_id, d.text, d.lang, d.source,
         CASE WHEN l.quality = 1 THEN 'positive' WHEN l.quality = 0 THEN 'negative' END AS sentiment
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


@register("text_clean", f"SELECT doc_id AS id, {CLEAN_SQL} AS clean_text FROM (SELECT DISTINCT doc_id, text FROM documents)")
def text_clean(spark, sf):
    return RV.cleaned(_docs(spark, sf), ["id", "review"])


@register("tokenize", f"""
SELECT id, word FROM (
  SELECT doc_id AS id, unnest(string_split({CLEAN_SQL}, ' ')) AS word
  FROM (SELECT DISTINCT doc_id, text FROM documents)) WHERE word <> ''""")
def tokenize(spark, sf):
    return RV.tokens(_docs(spark, sf), None)


@register("review_tokens", f"WITH {_tok_sql('doc_id', 'doc_id, text')} SELECT doc_id AS id, word FROM toks")
def review_tokens(spark, sf):
    return RV.tokens(_docs(spark, sf), tb.stop_words())


@register("word_frequency", f"""
WITH {_tok_sql('doc_id', 'doc_id, text')} SELECT word, count(*) AS freq FROM toks GROUP BY word""")
def word_frequency_q(spark, sf):
    return word_frequency(RV.tokens(_docs(spark, sf), tb.stop_words()))


@register("frequent_words", f"""
WITH {_tok_sql('doc_id', 'doc_id, text')}
SELECT word, count(*) AS freq FROM toks GROUP BY word HAVING count(*) > {MIN_FREQ}""")
def frequent_words(spark, sf):
    return RV.frequent_words(RV.tokens(_docs(spark, sf), tb.stop_words()), MIN_FREQ)


@register("having_threshold", """
SELECT o_custkey AS customer_id, count(*) AS n_orders FROM orders GROUP BY o_custkey
HAVING count(*) >= 10""")
def having_threshold(spark, sf):
    od = tb.table(spark, sf, "orders").select(F.col("o_custkey").alias("customer_id"))
    return having(count_by(od, "customer_id", name="n_orders"), "n_orders", 10)


@register("count_by_category", """
SELECT source AS category, count(doc_id) AS n_comments FROM documents GROUP BY source""")
def count_by_category(spark, sf):
    return RV.count_per(_docs(spark, sf), "category")


@register("count_by_aspect", """
SELECT lang AS aspect, count(doc_id) AS n_comments FROM documents GROUP BY lang""")
def count_by_aspect(spark, sf):
    return RV.count_per(_docs(spark, sf), "aspect")


@register("count_by_key", """
SELECT o_orderpriority AS priority, count(o_orderkey) AS n_orders FROM orders GROUP BY 1""")
def count_by_key(spark, sf):
    od = tb.table(spark, sf, "orders").select(F.col("o_orderpriority").alias("priority"), "o_orderkey")
    return count_by(od, "priority", "o_orderkey", "n_orders")


@register("aspect_sentiment_count", f"""
SELECT source AS category, sentiment, count(doc_id) AS n_comments FROM {LABELLED} GROUP BY 1, 2""")
def aspect_sentiment_count(spark, sf):
    return RV.count_per(_labelled(spark, sf), ["category", "sentiment"])


def _most(sentiment: str) -> str:
    return f"""
SELECT source AS category, count(doc_id) AS n_comments FROM {LABELLED}
WHERE sentiment = '{sentiment}' GROUP BY 1 ORDER BY n_comments DESC, category ASC LIMIT 1"""


@register("most_negative_aspect", _most("negative"))
def most_negative_aspect(spark, sf):
    counts = RV.sentiment_count(_labelled(spark, sf), "negative", aspect="category")
    return RV.most_common(counts, key="category")


@register("most_positive_aspect", _most("positive"))
def most_positive_aspect(spark, sf):
    counts = RV.sentiment_count(_labelled(spark, sf), "positive", aspect="category")
    return RV.most_common(counts, key="category")


@register("top_1", """
SELECT source AS category, count(doc_id) AS n_comments FROM documents GROUP BY 1
ORDER BY n_comments DESC, category ASC LIMIT 1""")
def top_1(spark, sf):
    return RV.most_common(RV.count_per(_docs(spark, sf), "category"), key="category")


@register("count_by_composite_key", f"""
WITH {_tok_sql('lang, sentiment', 'doc_id, text, lang, sentiment', LABELLED)}
SELECT lang AS aspect, sentiment, word, count(*) AS freq FROM toks GROUP BY 1, 2, 3""")
def count_by_composite_key(spark, sf):
    toks = RV.tokens(_labelled(spark, sf), tb.stop_words(),
                     dedup_keys=["id", "review", "aspect", "sentiment"], keep=["aspect", "sentiment"])
    return word_frequency(toks, "word", keys=["aspect", "sentiment"])


def _top_sql(keys: str, dedup: str, source: str, where: str = "") -> str:
    return f"""
WITH {_tok_sql(keys, dedup, source, where)},
f AS (SELECT {keys}, word, count(*) AS freq FROM toks GROUP BY {keys}, word),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY freq DESC, word ASC) AS rn FROM f)
SELECT lang AS aspect, {'sentiment, ' if 'sentiment' in keys else ''}word, freq FROM r WHERE rn <= 5"""


@register("top_words_by_category", _top_sql("lang", "doc_id, text, lang", "documents"))
def top_words_by_category(spark, sf):
    return RV.top_words(_docs(spark, sf), tb.stop_words(), group="aspect",
                        dedup_keys=["id", "review", "aspect"])


@register("top_words_by_sentiment",
          _top_sql("lang, sentiment", "doc_id, text, lang, sentiment", LABELLED,
                   "WHERE sentiment = 'positive'"))
def top_words_by_sentiment(spark, sf):
    return RV.top_words(_labelled(spark, sf), tb.stop_words(), group="aspect",
                        dedup_keys=["id", "review", "aspect", "sentiment"],
                        sentiment="sentiment", sentiment_value="positive")


@register("top_n_per_group", """
SELECT customer_id, order_id, total_price FROM (
  SELECT o_custkey AS customer_id, o_orderkey AS order_id, o_totalprice AS total_price,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey ASC) AS rn
  FROM orders) WHERE rn <= 3""")
def top_n_per_group(spark, sf):
    from tessera.operators.rank import top_n_per_group as top_op
    od = tb.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").alias("total_price"))
    return top_op(od, "customer_id", [F.col("total_price").desc(), F.col("order_id").asc()], 3)
