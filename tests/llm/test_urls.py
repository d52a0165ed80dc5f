"""URL filter against a brute-force version, and components against union-find."""

import re
from html import unescape
from urllib.parse import urljoin

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import urls
from tessera.llm.components import connected_components
from tessera.llm.queries import QUERIES, RULES

from ..conftest import SF_SMALL


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return lower, re.match(r"[^?#]*", rest[len(host):])[0]


def own_rule(url, rules):
    host, path = parts(url)
    fit = [(len(r), v == "allow", r) for r, v in rules
           if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
           and path.startswith("/" + r.split("/", 1)[1])]
    return max(fit)[1:] if fit else None


def classes(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {x: find(x) for x in list(root)}


def brute(pages, edges, rules):
    comp = classes(edges)
    out = []
    for page_id, url in pages:
        own = own_rule(url, rules)
        if own is not None:
            ok = own[0]
        else:
            group = [own_rule(u, rules) for u, c in comp.items() if url in comp and c == comp[url]]
            marks = {g[0] for g in group if g}
            ok = True in marks or False not in marks
        out.append((page_id, *parts(url), own[1] if own else None, "allow" if ok else "block"))
    return sorted(out, key=repr)


def test_whole_table(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet")
             .select("page_id", "url").collect()]
    got = QUERIES["op3_url_filter"](spark, SF_SMALL)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    edges = [(u, u.split("#")[0]) for _, u in pages if "#" in u]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(pages, edges, RULES)


def test_aliases_and_edge_rows(spark):
    rows = [(1, "http://a.example.com/x", '<link rel="canonical" href="http://evil.net/y">'),
            (2, "http://b.example.com/x", "<META http-equiv=refresh content='0; url=http://evil.net/y'>"),
            (3, "http://c.example.com/x", '<link href="http://www.example.net/en/1" rel="canonical">'),
            (4, "http://evil.net/y", '<link rel="canonical" href="http://d.example.com/z">'),
            (5, "http://d.example.com/z#frag", ""), (6, None, None), (7, "no scheme", "x"),
            (8, "HTTP://WWW.Example.NET/en/?q#f", None), (9, "http://e.example.com/de/", ""),
            (9, "http://e.example.com/de/", ""), (10, "http://net", ""), (11, "x://", ""),
            (12, "http://www.example.net/en/1", "<link rel=canonical href=http://evil.net/y>")]
    pages = spark.createDataFrame([(*r, 5) for r in rows],
                                  "page_id long, url string, html string, size int")
    edges = [(rows[i][1], t) for i, t in ((0, "http://evil.net/y"), (1, "http://evil.net/y"),
             (2, "http://www.example.net/en/1"), (3, "http://d.example.com/z"),
             (4, "http://d.example.com/z"))]
    for use in (rows[:-1], rows):
        all_edges = edges + ([(rows[-1][1], "http://evil.net/y")] if len(use) == len(rows) else [])
        all_edges.append((rows[7][1], rows[7][1].split("#")[0]))
        got = urls.judge_urls(pages.where(f"page_id <= {use[-1][0]}"), RULES)
        assert got.columns == ["page_id", "url", "html", "size", "host", "path", "rule", "verdict"]
        assert sorted((tuple(r) for r in got.drop("url", "html", "size").collect()), key=repr) \
            == brute([r[:2] for r in use], all_edges, RULES)
    assert urls.judge_urls(pages.limit(0), RULES).count() == 0
    clash = urls.judge_urls(pages.withColumnRenamed("size", "Host").withColumn("verdict", F.lit("x"))
                            .withColumn("__best", F.lit(2)), RULES)
    assert clash.columns == ["page_id", "url", "html", "Host", "verdict", "__best", "host_", "path", "rule",
                             "verdict_"]
    assert sorted((tuple(r)[:1] + tuple(r)[6:] for r in clash.collect()), key=repr) == brute(
        [r[:2] for r in rows], all_edges, RULES)
    assert {(r.Host, r.verdict, r["__best"]) for r in clash.collect()} == {(5, "x", 2)}


def test_targets_are_resolved(spark):
    base = "HTTP://Www.Example.org/a/b/c?x=1#f"
    cases = ["/d", "//Other.net/e", "?page=2&amp;ref=x", "d", "../d/./e", "../../../d", "..", ".", "#g", "",
             "mailto:x@y.z", "https://Z.org/Q?a=B#h", "http://z.org", "d/../e?u=/../v", "&#x2F;d",
             "http://z.org?u=a/../b", "javascript:go('http://z.org')"]
    df = spark.createDataFrame([(c,) for c in cases], "target string")
    got = [r[0] for r in df.select(urls.resolve(F.lit(base), urls.unescape(F.col("target")))).collect()]
    site = "http://www.example.org"
    for case, found in zip(cases, got):
        if case in ("", "mailto:x@y.z") or case.startswith("javascript"):
            assert found is None
            continue
        want = urljoin(site + "/a/b/c?x=1", unescape(case)).split("#")[0]
        head = re.match("[^/]*//[^/?]*", want)[0]
        assert found == head.lower() + want[len(head):], case
    assert df.select(urls.resolve(F.lit("no scheme"), F.col("target")).alias("t")).where(
        "t IS NOT NULL").count() == 3


def test_blocks_reach_aliases_through_relative_and_escaped_links(spark):
    rows = [(1, "http://evil.net/p?page=2&ref=x", ""),
            (2, "http://a.org/1", '<link rel="canonical" href="//EVIL.net/p?page=2&amp;ref=x">'),
            (3, "http://a.org/x/2", "<meta http-equiv=refresh content='0; url=../1'>"),
            (4, "http://A.org/x/y/3?q", '<link rel=canonical href="/x/2">'), (5, "http://a.org/4", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in urls.judge_urls(pages, RULES).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow"}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=0, max_size=40))
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "src long, dst long")
    got = connected_components(df).collect()
    assert {r.node: r.component for r in got} == classes(edges)
    assert len(got) == len({r.node for r in got})


def test_components_of_a_long_chain(spark):
    df = spark.range(300).selectExpr("id AS src", "id + 1 AS dst")
    assert connected_components(df).select("component").distinct().count() == 1
