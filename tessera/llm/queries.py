"""One query per operator, over whole driver tables: key -> (spark, sf_dir) -> DataFrame, and the
DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (chat, crf, decontam, hyperminhash, jaccard, licenses, manifest, mix, rules, search,
                         spans, tokens, urls)
from tessera.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_chat_format")
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations written as raw transcripts, and parsed back; the model learns from the roles
    of four fifths of them."""
    blocks = chat.as_transcript(table(spark, sf_dir, "conversations"))
    return chat.format_transcripts(blocks, chat.not_held_out())


@query("op2_token_ids")
def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def token_digests(docs: DataFrame) -> DataFrame:
    """Write the block file of ``docs`` to the shared folder and digest what is read back."""
    spark = docs.sparkSession
    out = scratch_dir(spark, "tokens")
    tokens.write_tokens(docs, out, tokens.default_tokenizer())
    return tokens.read_digests(spark, out)


RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"),
         ("org/fr/", "allow")]


@query("op3_url_filter")
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return urls.judge_urls(pages, RULES).drop("url", "html")


@query("op6_quality_rules")
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(table(spark, sf_dir, "documents"), trusted_ids(spark, sf_dir))
    return judged.select("doc_id", "quality.*")


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that a label marks as good: the trusted target of the quality rules."""
    return table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


@query("op7_mix_sources", mix.SQL)
def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix.report(mix.mix_sources(docs))


@query("op9_jaccard_join")
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its class, its copies' least id, and its number of links."""
    found = jaccard.similar_classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "copy_id", "n_links")


@query("op10_decontaminate")
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each occurrence of a benchmark item in a document."""
    return decontam.find_items(table(spark, sf_dir, "documents"),
                               table(spark, sf_dir, "benchmark"))


@query("op4_sentence_spans")
def op4_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stretch of a document that non-first repeats of sentence runs cover."""
    return spans.repeated_regions(table(spark, sf_dir, "documents"), both_ends=True)


@query("op5_quality_crf")
def op5_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of held-out documents are never read."""
    docs = table(spark, sf_dir, "documents")
    model = crf.fit(docs, table(spark, sf_dir, "labels").where(~crf.held_out()))
    return crf.score(docs, model).select(
        "doc_id", crf.held_out().alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op8_license_scan")
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line of a document that a licence family is predicted for."""
    docs = table(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.fit(docs))


@query("op13_merkle_manifest", manifest.SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof in the manifest, and whether the tampered copy still folds to the
    root."""
    return manifest.audit(table(spark, sf_dir, "documents"))


@query("op12_lexical_search", search.SQL)
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    index = search.build_index(table(spark, sf_dir, "documents"))
    return search.search(index, table(spark, sf_dir, "benchmark"))


@query("op11_hyperminhash", hyperminhash.SQL)
def op11_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near copies of every document."""
    return hyperminhash.components(table(spark, sf_dir, "documents"))
