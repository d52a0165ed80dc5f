"""Quality rules: base counts of each text, and a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over ``buckets`` hash buckets of word 1- and 2-grams: one from
trusted texts, one from the whole raw corpus.  A text's score is the mean log ratio of its n-grams;
it is kept where the score reaches the threshold and no base rule fails it.  A fifth of the trusted
texts (by id hash) is held out of the target counts; the threshold lies ``SPREAD`` times the distance
from the median to the first percentile of their scores below that median.  All trusted texts count:
they are joined once and written, one aggregation over them and the corpus fills both multinomials, and
the percentiles are exact ones from the places of range-partitioned scores.  Only column functions are used; the ratio table (``buckets`` numbers)
and that threshold are all that reaches the driver.

Defined results: a NULL or empty text has no words, fails the base rules and scores 0; repeated rows
are judged alike; an empty table gives an empty result; without any trusted text all scores are 0.
Extra columns are kept; ``words`` are those of :mod:`tessera.llm.words`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.words import fresh, need, words
from tessera.operators.rank import exact_percentiles
from tessera.session import ensure_checkpoint_dir, scratch_dir

BUCKETS = 1 << 16
SPREAD = 3.0
#: Threshold (nats per n-gram) where no trusted text is held out.
THRESHOLD = -0.1
SYMBOLS = "[#*$%&|<>]"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def n_dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda a: (F.size(a) - F.size(F.array_distinct(a))).cast("long"))


def n_repeat_words(word: Column, width: int = 8) -> Column:
    """Words that lie in a ``width``-word window found twice or more in the text."""
    def of_windows(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(
            F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
            of_sorted))

    def of_sorted(s: Column) -> Column:
        def again(e: Column, k: Column) -> Column:
            same = [F.coalesce(F.get(s, k + d)["h"] == e["h"], F.lit(False)) for d in (-1, 1)]
            return F.when(same[0] | same[1], e["i"])
        return let(F.sort_array(F.array_compact(F.transform(s, again))), covered)

    def covered(at: Column) -> Column:
        new = F.transform(at, lambda p, k: F.least(
            F.lit(width), F.coalesce(F.get(at, k + 1) - p, F.lit(width))))
        return F.aggregate(new, F.lit(0), lambda a, x: a + x)

    return F.when(F.size(word) <= width, F.lit(0)).otherwise(let(window_hashes(word, width), of_windows))


def window_hashes(word: Column, width: int) -> Column:
    """A hash of every run of ``width`` words: those of half the width are paired, so each doubling costs
    one hash a word."""
    def paired(h: Column, by: int) -> Column:
        return let(h, lambda a: F.transform(F.slice(a, by + 1, F.greatest(F.size(a) - by, F.lit(0))),
                                            lambda x, i: F.xxhash64(F.get(a, i), x)))
    out, have = F.transform(word, lambda x: F.xxhash64(x)), 1
    while have < width:
        step = min(have, width - have)  # the last two may overlap
        out, have = paired(out, step), have + step
    return out


def ngram_buckets(word: Column, buckets: int) -> Column:
    """Hash bucket of each word and of each pair of neighbours."""
    def bucket(*cols: Column) -> Column:
        return F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int")
    pairs = F.transform(F.slice(word, 2, F.greatest(F.size(word) - 1, F.lit(0))),
                        lambda x, i: bucket(F.get(word, i), x))
    return F.concat(F.transform(word, lambda x: bucket(x)), pairs)


def trusted_texts(docs: DataFrame, trusted_ids: DataFrame) -> DataFrame:
    """``text, held`` of all trusted documents; ``held`` is a fifth of the documents by id hash.

    The join is the same at every size: both sides are shuffled by id, and nothing is broadcast.
    """
    known = trusted_ids.where("doc_id IS NOT NULL").select("doc_id").distinct()
    held = F.pmod(F.xxhash64(F.lit("held"), "doc_id"), F.lit(5)) == 0
    return docs.join(known.hint("merge"), "doc_id", "left_semi").select("text", held.alias("held"))


def bucket_counts(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, raw, good``: counts over the texts of both; pre-aggregated in each task."""
    texts = docs.select("text", F.lit(False).alias("target")).unionAll(
        target.select("text", F.lit(True)))
    grams = texts.select("target", F.explode(
        let(words("text"), lambda w: ngram_buckets(w, buckets))).alias("bucket"))
    return grams.groupBy("bucket").agg(F.count_if(~F.col("target")).alias("raw"),
                                       F.count_if("target").alias("good"))


def ratio_table(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> Column:
    """Array of ``buckets`` log ratios, target over raw, both with add-one smoothing."""
    both = (docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
            .join(bucket_counts(docs, target, buckets), "bucket", "left").na.fill(0))
    row = both.agg(
        F.sum("raw").alias("n_raw"), F.sum("good").alias("n_good"),
        F.transform(F.sort_array(F.collect_list(F.struct("bucket", "raw", "good"))),
                    lambda x: F.log(x["good"] + F.lit(1.0)) - F.log(x["raw"] + F.lit(1.0)))
        .alias("ratio"))
    shift = F.log((F.col("n_raw") + F.lit(float(buckets))) / (F.col("n_good") + F.lit(float(buckets))))
    table = F.when(F.col("n_good") > 0, F.transform("ratio", lambda x: x + shift)).otherwise(
        F.array_repeat(F.lit(0.0), buckets))
    ensure_checkpoint_dir(docs.sparkSession)
    return row.select(table.alias("ratio")).checkpoint(eager=True).scalar()  # counted once


def mean_ratio(word: Column, ratio: Column, buckets: int) -> Column:
    """Mean log ratio of a text's n-grams; 0 without words."""
    return let(ngram_buckets(word, buckets), lambda b: F.aggregate(
        b, F.lit(0.0), lambda a, x: a + F.get(ratio, x)) / F.greatest(F.size(b), F.lit(1)))


def held_out_threshold(held: DataFrame, ratio: Column, buckets: int = BUCKETS,
                       spread: float = SPREAD) -> float:
    """Threshold from the scores of all held-out trusted texts."""
    scores = held.withColumn("__ratio", ratio).select(let(words("text"), lambda w: mean_ratio(
        w, F.col("__ratio"), buckets)).alias("score"))
    low, mid = exact_percentiles(scores, [], "score", {"low": 0.01, "mid": 0.5}).first()
    return THRESHOLD if mid is None else mid - spread * (mid - low)


def judge(docs: DataFrame, trusted_ids: DataFrame, buckets: int = BUCKETS,
          threshold: float | None = None, name: str = "quality") -> DataFrame:
    """``docs`` with a struct column ``name``, in place of one that it has: base counts, ``score``, ``base_failed``, ``kept``.

    ``trusted_ids`` holds ``doc_id`` of trusted documents.
    ``threshold`` overrides the held-out one.
    """
    need(docs, "doc_id", "text")
    plain = docs.select("doc_id", "text")
    # Joined once and written: the counts and the held-out scores read it.
    out = scratch_dir(docs.sparkSession, "trusted-texts")
    trusted_texts(plain, trusted_ids).write.option("compression", "zstd").parquet(out)
    trusted = docs.sparkSession.read.parquet(out)
    ratio = ratio_table(plain, trusted.where("NOT held"), buckets)
    if threshold is None:
        threshold = held_out_threshold(trusted.where("held"), ratio, buckets)
    text = F.coalesce(F.col("text"), F.lit(""))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            n_repeat_words(w).cast("long").alias("n_repeat_words"),
            mean_ratio(w, F.col(fresh(docs, "__ratio")), buckets).alias("score"))

    def verdict(r: Column) -> Column:
        failed = (r["n_words"] < 20) | (100 * r["n_repeat_words"] > 30 * r["n_words"])
        return F.struct(
            r["n_words"].alias("n_words"), r["word_chars"].alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            n_dup_lines(text).alias("n_dup_lines"), r["n_repeat_words"].alias("n_repeat_words"),
            r["score"].alias("score"), failed.alias("base_failed"),
            (~failed & (r["score"] >= F.lit(threshold))).alias("kept"))

    # One expression, so that a filter on a field of it works it out once.
    quality = let(let(words("text"), of_words), verdict)
    own = fresh(docs, "__ratio")
    return docs.withColumn(own, ratio).withColumn(name, quality).drop(own)
