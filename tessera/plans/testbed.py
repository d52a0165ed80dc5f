"""Stand-ins for the reference entities built from the driver tables (``sf_dir/*.parquet``).

Each helper returns a lazy DataFrame over the *whole* table(s); column pruning and filters reach
the parquet scan because every helper is a projection/join, never a collect.

Mapping (see README):
* rating: ``lineitem ⋈ orders`` — user = o_custkey, movie = l_partkey, rating = l_quantity,
  ts = epoch seconds of o_orderdate; the two rating "files" are l_linestatus 'O' and 'F'.
* movies: ``part`` — title = p_name, labels = words of p_name.
* order lines: ``lineitem`` — product = l_partkey, seller = l_suppkey, ordinal = l_linenumber,
  gross = l_extendedprice + l_tax.
* reviews: ``events`` — review/order id = event_id, score = ``$.k`` of props.
* review text: ``documents`` (+ ``labels``: quality 1 -> positive, 0 -> negative).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import clean_text, token_array
from tessera.functions.time import epoch_seconds
from tessera.operators.joins import exclude_values
from tessera.sources.tables import union_sources

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# The stop-word list used with the documents table (the most frequent words there),
# deliberately with a duplicate, a CR ending and a blank entry, like a hand-kept word file.
STOP_WORDS = ["the", "of", "de", "and", "to", "in", "la", "a", "der", "is", "the", "is\r", ""]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stop_words() -> list[str]:
    """The stop-word list after CR stripping, blank removal and DISTINCT (order kept)."""
    return [w for w in dict.fromkeys(s.replace("\r", "") for s in STOP_WORDS) if w]


def ratings(spark: SparkSession, sf_dir: str, statuses: tuple[str, ...] = ()) -> DataFrame:
    """(user, movie, rating, ts, status) — one row per lineitem with its order's customer/date.

    ``statuses`` unions the rating "files" of those line statuses (each a pushed-down slice) before
    the one join with orders.
    """
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("movie"),
        F.col("l_quantity").alias("rating"), F.col("l_linestatus").alias("status"))
    if statuses:
        li = union_sources(*[li.where(F.col("status") == s) for s in statuses])
    od = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user"),
        epoch_seconds("o_orderdate").alias("ts"))
    return li.join(od, "order_id", "inner").drop("order_id")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem in canonical order-line names."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"), F.col("l_linenumber").alias("item_ordinal"),
        F.col("l_extendedprice").alias("price"), F.col("l_tax").alias("freight"),
        F.col("l_shipdate").alias("delivered_ts"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("purchase_ts"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"))


def score_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(review_id, order_id, score_text): the review score is the text of ``$.k`` in props."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").alias("review_id"), F.col("event_id").alias("order_id"),
                     F.get_json_object("props", "$.k").alias("score"))


def clean_docs(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """DISTINCT (doc_id, text[, extra]) with the cleaned text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", *extra).distinct()
    return docs.select("doc_id", *extra, clean_text("text").alias("clean_text"))


def doc_tokens(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = (),
               drop_stop_words: bool = True) -> DataFrame:
    """(doc_id, [extra], word) for every token of the cleaned distinct texts."""
    cleaned = clean_docs(spark, sf_dir, extra)
    toks = cleaned.select("doc_id", *extra, F.explode(token_array("clean_text")).alias("word")) \
        .where(F.col("word") != "")
    return exclude_values(toks, "word", stop_words()) if drop_stop_words else toks


def labelled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents ⋈ labels with sentiment text: quality 1 -> positive, 0 -> negative."""
    lab = table(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "positive").when(F.col("quality") == 0, "negative")
        .alias("sentiment"), "quality", "toxic")
    return table(spark, sf_dir, "documents").join(lab, "doc_id", "inner")
