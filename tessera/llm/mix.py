"""Mixing sources to target weights.

Tokens (words) are summed per source, a target is derived for each source from its weight, and the
repetition rate of a source is target / size.  Each document is emitted ``floor(rate)`` times plus
one copy more with probability ``rate - floor(rate)``; the draw is a hash of the seed and the
document id, so reruns and retried tasks agree.

Defined results: a NULL source is a source of its own, last in order; a NULL or empty text has size
0 and is emitted like any other document; rows that repeat a document id share its draw; a source
without words has target 0 and rate 0 (its documents are not emitted); an empty table gives an empty
result.  Extra columns are kept; the columns that the operator adds at the end (``size``,
``source_size``, ``target``, ``rate``, ``copies``) take another name (``_`` is appended) where the table
has a column of that name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.words import aside, fresh, n_words, need
from tessera.operators.rank import global_rank
from tessera.session import ensure_checkpoint_dir

#: Bytes of the per-source table up to which it is broadcast; a larger one is joined by shuffle.
BROADCAST_BYTES = 16 << 20
ADDED = ("size", "source_size", "target", "rate", "copies")


def source_targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), budget: float = 1.5,
                   max_repeat: float = 2.0) -> tuple[DataFrame, int]:
    """``source, source_size, target`` from rows ``source, size``, and a bound of its bytes.

    Sources in code point order (NULL last) take ``weights`` in turn and share ``budget`` times
    the sum of all sizes.  A target stops at ``max_repeat`` times its source's size; the excess is
    shared again by weight until no target is above.  Only scalars reach the driver.
    """
    spark = sizes.sparkSession
    ensure_checkpoint_dir(spark)
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    pick = F.array(*[F.lit(float(w)) for w in weights])
    ranked = global_rank(per, [F.col("source").isNull(), F.col("source")], "rank")
    ranked = ranked.select("source", "source_size", F.element_at(
        pick, (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")).alias("weight"))
    ranked = ranked.checkpoint(eager=True)
    cap = F.lit(float(max_repeat)) * F.col("source_size")
    total, bound = ranked.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)),
        F.coalesce(F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) + 64), F.lit(0))).first()
    share, capped = None, -1
    while True:
        # Sources over their cap at the present share hold their cap; the others split the rest.
        over = F.lit(False) if share is None else F.col("weight") * F.lit(share) >= cap
        held, weight, n = ranked.agg(
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)),
            F.coalesce(F.sum(over.cast("long")), F.lit(0))).first()
        if n == capped or not weight:
            break
        share, capped = (budget * total - held) / weight, n
    line = F.least(F.col("weight") * F.lit(share or 0.0), cap)
    return ranked.select("source", "source_size", line.alias("target")), bound


def mix_sources(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), budget: float = 1.5,
                max_repeat: float = 2.0, seed: str = "mix") -> DataFrame:
    """``docs`` with ``size, source_size, target, rate, copies`` (see :func:`added`), one row per input
    row."""
    need(docs, "doc_id", "text", "source")
    own, back = aside(docs)
    at = {c: F.col(own.columns[docs.columns.index(c)]) for c in ("doc_id", "text", "source")}
    sized = own.select("*", at["doc_id"].alias("doc_id"), at["source"].alias("source"),
                       n_words(at["text"]).alias("size"))
    targets, nbytes = source_targets(sized.select("source", "size"), weights, budget, max_repeat)
    side = targets.withColumnRenamed("source", "__source")
    side = F.broadcast(side) if nbytes <= BROADCAST_BYTES else side
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    mixed = (sized.join(side, F.col("source").eqNullSafe(F.col("__source")), "left")
             .withColumn("rate", rate)
             .withColumn("copies", (F.floor("rate") + (draw(seed) < F.col("rate") - F.floor("rate"))
                                    .cast("long")).cast("long")))
    return mixed.select(*back, *[F.col(n).alias(fresh(docs, n)) for n in ADDED])


def added(mixed: DataFrame) -> dict[str, str]:
    """Names in a result of :func:`mix_sources` of the columns that it added: its last ones."""
    return dict(zip(ADDED, mixed.columns[-len(ADDED):]))


def draw(seed: str):
    """A number in [0, 1) from the seed and the document id: 60 bits of an MD5."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("double") / F.lit(float(1 << 60))


def emit_copies(mixed: DataFrame) -> DataFrame:
    """Each row ``copies`` times, without the columns that :func:`mix_sources` added."""
    copies = F.col(added(mixed)["copies"])
    copy = fresh(mixed, "copy")
    out = mixed.where(copies > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), copies)))
    return out.select(mixed.columns[:-len(ADDED)])


def report(mixed: DataFrame) -> DataFrame:
    """Per document: its size, its source's size and target, and the words that the mix takes."""
    name = added(mixed)
    return mixed.select("doc_id", *[F.col(name[n]).alias(n) for n in ("size", "source_size", "target")],
                        (F.col(name["size"]) * F.col(name["copies"])).alias("taken"))


SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
per AS (
  SELECT source, sum(size) AS s,
         CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]
              AS DOUBLE) AS w
  FROM sized GROUP BY source),
cum AS (
  SELECT *, 1.5 * sum(s) OVER () AS t,
         coalesce(sum(2.0 * s) OVER lower, 0) AS held, sum(w) OVER () - coalesce(sum(w) OVER lower, 0)
           AS w_left
  FROM per
  WINDOW lower AS (ORDER BY 2.0 * s / w, source NULLS LAST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
flagged AS (SELECT *, (2.0 * s / w) * w_left + held <= t AS capped FROM cum),
share AS (
  SELECT (any_value(t) - coalesce(sum(2.0 * s) FILTER (capped), 0)) /
         sum(w) FILTER (NOT capped) AS x FROM flagged),
target AS (
  SELECT source, CAST(s AS BIGINT) AS source_size,
         CAST(least(w * x, 2.0 * s) AS DOUBLE) AS target
  FROM flagged, share),
rated AS (
  SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15)
              AS BIGINT) AS DOUBLE) / 1152921504606846976.0 AS u
  FROM sized JOIN target ON sized.source IS NOT DISTINCT FROM target.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT)
         AS taken
FROM rated
"""
