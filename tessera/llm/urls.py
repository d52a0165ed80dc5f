"""URL filters: host and path rules, and decisions that follow redirects to aliases.

A rule ``host/path`` fits its host and all subdomains if the URL's path starts with the rule's path;
the longest fitting rule wins (of two equally long ones the allowing, then the lesser).  Pages joined
by redirect or canonical-link edges are aliases: a page without a rule of its own is allowed where
some alias is allowed by a rule, else blocked where some alias is blocked, else allowed.  Only column
functions are used.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up
to ``?``, ``#`` or the end.  URLs that differ in the case of scheme and host only are one alias.  Targets
of links are resolved against the page's URL (``/b``, ``//host/b``, ``?q``, ``../b``), without their
fragment; ``&amp;`` and its like are undone.  Defined results: a NULL URL or one without ``://`` has empty
host and path, no rule fits, and its relative links lead nowhere; repeated rows are judged alike; an empty
table gives an empty result; extra columns are kept, and an added column (``host, path, rule, verdict``)
takes another name (``_`` is appended) where the table has a column of that name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.components import connected_components
from tessera.llm.rules import let
from tessera.llm.words import aside, fresh, need
from tessera.session import ensure_checkpoint_dir

ADDED = ("host", "path", "rule", "verdict")
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ATTR = r"""\s*=\s*["']?\s*([^"'\s>]+)"""


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(after_scheme(url), F.lit("")), r"^[^/?#]*", 0)
    return F.translate(host, _UP, _LOW)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(after_scheme(url), F.lit("")), r"(?s)^[^/?#]*([^?#]*)", 1)


def alias_of(url: Column) -> Column:
    """The URL with scheme and host (A-Z) in lower case; one without ``://`` as it is."""
    head = F.regexp_extract(url, r"^.*?://[^/?#]*", 0)
    return F.concat(F.translate(head, _UP, _LOW), F.substring(url, F.length(head) + 1, F.length(url)))


def unescape(value: Column) -> Column:
    """Character references that occur in URLs undone, ``&amp;`` last."""
    for code, char in (("quot|#0*34|#x0*22", '"'), ("apos|#0*39|#x0*27", "'"), ("lt|#0*60|#x0*3c", "<"),
                       ("gt|#0*62|#x0*3e", ">"), ("#0*47|#x0*2f", "/"), ("amp|#0*38|#x0*26", "&")):
        value = F.regexp_replace(value, f"(?i)&(?:{code});", char)
    return value


def _without_dots(path: Column) -> Column:
    """A path (from its first ``/`` on) without the segments ``.`` and ``..``."""
    def step(done: Column, part: Column) -> Column:
        up = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(part == "..", up).when(part == ".", done).otherwise(F.concat(done, F.array(part)))

    parts = F.split(F.substring(path, 2, F.length(path)), "/")
    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    tail = F.when(path.rlike(r"/\.\.?$"), F.lit("/")).otherwise(F.lit(""))
    clean = F.regexp_replace(F.concat(F.lit("/"), F.array_join(kept, "/"), tail), "^/+$", "/")
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), clean).otherwise(path)


def resolve(url: Column, target: Column) -> Column:
    """The URL that ``target`` leads to from ``url``, without fragment; NULL if it leads to none."""
    def absolute(full: Column) -> Column:
        bare = F.regexp_extract(full, r"(?s)^[^#]*", 0)
        head = F.regexp_extract(bare, r"^[^/?]*?://[^/?]*", 0)
        path = F.regexp_extract(F.substring(bare, F.length(head) + 1, F.length(bare)), r"(?s)^[^?]*", 0)
        rest = F.substring(bare, F.length(head) + F.length(path) + 1, F.length(bare))
        return F.when(head != "", alias_of(F.concat(head, _without_dots(path), rest)))

    site = F.regexp_extract(url, r"^[^/?#]*?://[^/?#]*", 0)
    path = F.when(path_of(url) == "", F.lit("/")).otherwise(path_of(url))
    folder = F.regexp_extract(path, "(?s)^.*/", 0)
    scheme = F.regexp_extract(url, "^[^/?#]*?:(?=//)", 0)
    full = (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
            .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
            .when((site == "") | (target == ""), F.lit(None).cast("string"))
            .when(target.startswith("//"), F.concat(scheme, target))
            .when(target.startswith("/"), F.concat(site, target))
            .when(target.startswith("?"), F.concat(site, path, target))
            .when(target.startswith("#"), url)
            .otherwise(F.concat(site, folder, target)))
    return let(full, absolute)


def link_edges(pages: DataFrame) -> DataFrame:
    """``src, dst`` of canonical links and refresh redirects found in ``html``, and of each URL
    with a fragment to the URL without it."""
    html, url = F.coalesce(F.col("html"), F.lit("")), F.col("url")
    tag = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
    canonical = F.regexp_extract(F.regexp_extract(html, tag, 0), r"(?is)\bhref" + _ATTR, 1)
    refresh = F.regexp_extract(
        F.regexp_extract(html, r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>", 0),
        r"(?is)\burl" + _ATTR, 1)
    bare = F.when(F.instr(url, "#") > 0, F.substring_index(url, "#", 1))
    found = pages.where(url.isNotNull()).select(url.alias("url"), F.explode(F.array_compact(F.array(
        F.nullif(canonical, F.lit("")), F.nullif(refresh, F.lit("")), bare))).alias("target"))
    return found.select(alias_of(F.col("url")).alias("src"),
                        resolve(F.col("url"), unescape(F.col("target"))).alias("dst")).where("src <> dst")


def rule_table(spark, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """``rule_host, rule_path, rule, allow, rank`` of ``(rule, verdict)`` pairs; a greater rank is a
    rule that wins."""
    order = sorted({(len(r), v == "allow", tuple(-ord(c) for c in r), r) for r, v in rules})
    rows = [(r.partition("/")[0].lower(), "/" + r.partition("/")[2], r, allow, i)
            for i, (_, allow, _, r) in enumerate(order)]
    return spark.createDataFrame(rows, "rule_host string, rule_path string, rule string, "
                                       "allow boolean, rank int")


def match_rules(pages: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """``pages`` with ``host, path, rule, allow`` (the last two NULL where no rule fits).

    The rules are the caller's list, so their table is bounded and broadcast.  Rules are looked up
    once per distinct host; pages meet their host's few rules by a join on the host, which Spark can
    split where one host has very many pages.
    """
    ensure_checkpoint_dir(pages.sparkSession)
    spark = pages.sparkSession
    keyed = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    hosts = keyed.select("host").where("host <> ''").distinct()
    labels = F.split("host", r"\.")
    tails = hosts.select("host", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("rule_host"))
    fitting = tails.join(F.broadcast(rule_table(spark, rules)), "rule_host").groupBy(
        F.col("host").alias("__host")).agg(F.collect_list(F.struct(
            "rank", "rule_path", "rule", "allow")).alias("__rules")).checkpoint(eager=True)
    best = F.array_max(F.filter("__rules", lambda r: F.col("path").startswith(r["rule_path"])))
    return (keyed.join(fitting, F.col("host") == F.col("__host"), "left")
            .withColumn("__best", best).withColumn("rule", F.col("__best.rule"))
            .withColumn("allow", F.col("__best.allow")).drop("__host", "__rules", "__best"))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]],
               edges: DataFrame | None = None) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict`` added.

    ``edges`` (``src, dst`` URLs) are redirects and canonical links; by default those found in the
    pages themselves.
    """
    need(pages, "url")
    spark = pages.sparkSession
    ensure_checkpoint_dir(spark)
    if edges is None:
        need(pages, "html")
        edges = link_edges(pages)
    edges = edges.select(alias_of(F.col("src")).alias("src"), alias_of(F.col("dst")).alias("dst"))
    edges = edges.distinct().checkpoint(eager=True)
    ends = edges.select(F.col("src").alias("url")).unionAll(edges.select(F.col("dst").alias("url")))
    members = connected_components(edges).withColumnRenamed("node", "url")
    ruled = match_rules(ends.distinct(), rules).select("url", F.col("allow").alias("own"))
    spread = (members.join(ruled, "url", "left").groupBy("component").agg(
        F.coalesce(F.max("own"), F.lit(None).cast("boolean")).alias("any_allow"),
        F.coalesce(F.min("own"), F.lit(None).cast("boolean")).alias("none_blocks")))
    verdicts = members.join(spread, "component").select(
        F.col("url").alias("__url"),
        F.when(F.col("any_allow"), True).otherwise(F.col("none_blocks")).alias("__alias"))
    own, back = aside(pages)
    matched = match_rules(own.withColumn("url", F.col(own.columns[pages.columns.index("url")])), rules)
    ok = F.coalesce("allow", "__alias", F.lit(True))
    judged = (matched.withColumn("__key", alias_of(F.col("url")))
              .join(verdicts, F.col("__key") == F.col("__url"), "left")
              .withColumn("verdict", F.when(ok, "allow").otherwise("block")))
    return judged.select(*back, *[F.col(n).alias(fresh(pages, n)) for n in ADDED])
