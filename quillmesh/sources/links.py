"""Links of captured responses: HTML anchors, sitemaps and robots files."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urldefrag, urljoin, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: relations of resources that are not pages, and schemes that can be followed
RESOURCE_RELS = ["stylesheet", "icon", "apple-touch-icon", "apple-touch-icon-precomposed", "mask-icon", "preload", "manifest"]
FOLLOWED_SCHEMES = ["http", "https", "file", ""]
XML_TYPES = ["application/xml", "text/xml"]
PAGINATION = "next"

_ANCHOR = r'(?i)<a\s[^>]*?href="([^"]*)"'


def anchor_hrefs(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """``key, position, href``: anchors by regular expression, first of equal ones, in page order.

    The fast path for plain double-quoted attributes; ``links`` parses exactly.
    """
    found = F.array_distinct(F.transform(F.regexp_extract_all(F.col(html), F.lit(_ANCHOR), F.lit(1)), F.trim))
    return pages.select(key, F.posexplode(found).alias("position", "href"))


class _Anchors(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, frozenset[str]]] = []

    def handle_starttag(self, tag, attrs):
        given = dict(attrs)
        if tag in ("a", "link") and given.get("href"):
            self.found.append((given["href"].strip(), frozenset((given.get("rel") or "").split())))

    handle_startendtag = handle_starttag


def html_links(content: bytes, base: str) -> Iterator[tuple[str, bool, bool]]:
    parser = _Anchors()
    parser.feed(content.decode("utf-8", "replace"))
    seen = set()
    for href, rels in parser.found:
        try:
            url = urldefrag(urljoin(base, href)).url
            allowed = urlsplit(url).scheme in FOLLOWED_SCHEMES
        except ValueError:
            continue
        if url and allowed and url not in seen:
            seen.add(url)
            yield url, PAGINATION in rels, bool(rels & set(RESOURCE_RELS))


def sitemap_links(content: bytes) -> Iterator[str]:
    """Trimmed texts of ``loc`` elements of any namespace; none if there is a DTD or an error."""
    upper = content.upper()
    if b"<!DOCTYPE" in upper or b"<!ENTITY" in upper:
        return
    try:
        root = ET.fromstring(content)
    except ET.ParseError:
        return
    for element in root.iter():
        if isinstance(element.tag, str) and element.tag.rpartition("}")[2] == "loc" and (element.text or "").strip():
            yield element.text.strip()


def robots_links(content: bytes) -> Iterator[str]:
    for line in content.decode("utf-8", "replace").splitlines():
        name, colon, rest = line.partition(":")
        if colon and name.strip().lower() == "sitemap" and rest.strip():
            yield rest.strip()


def _joined(base: str, found: Iterator[str]) -> Iterator[tuple[str, bool, bool]]:
    for link in found:
        try:
            yield urljoin(base, link), False, False
        except ValueError:
            continue


def response_links(content: bytes | None, content_type: str | None, url: str) -> Iterator[tuple[str, bool, bool]]:
    """(link, is_pagination, is_resource) of one response, by its type or path."""
    kind = (content_type or "").split(";")[0].strip().lower()
    if kind == "text/html":
        yield from html_links(content or b"", url)
    elif kind in XML_TYPES:
        yield from _joined(url, sitemap_links(content or b""))
    elif urlsplit(url).path.rstrip("/").endswith("/robots.txt"):
        yield from _joined(url, robots_links(content or b""))


class ResponseLinks:
    """The table function ``response_links(content, content_type, url)``: ``position, link,
    is_pagination, is_resource`` of one response. Null content or url has no links."""

    def eval(self, content: bytes | None, content_type: str | None, url: str | None):
        if content is not None and url is not None:
            for position, link in enumerate(response_links(bytes(content), content_type, url)):
                yield position, *link


def register_links(spark: SparkSession) -> str:
    """Make the table function known to SQL and return its name; it goes with LATERAL."""
    function = F.udtf(ResponseLinks, returnType="position int, link string, is_pagination boolean, is_resource boolean", useArrow=True)
    spark.udtf.register("response_links", function)
    return "response_links"


def lateral_links(captured: DataFrame, *keys: str) -> DataFrame:
    """``keys, position, link, is_pagination, is_resource`` of captured responses (url, content_type,
    content, and the keys): each response joined to its links."""
    spark = captured.sparkSession
    named = captured.select(*keys, F.col("url").alias("__url"), F.col("content_type").alias("__type"), F.col("content").cast("binary").alias("__content"))
    own = "".join(f"c.`{k}`, " for k in keys)
    return spark.sql(f"SELECT {own}l.* FROM {{rows}} c, LATERAL {register_links(spark)}(c.__content, c.__type, c.__url) l", rows=named)


def links(captured: DataFrame) -> DataFrame:
    """``url, position, link, is_pagination, is_resource`` of captured responses (url, final_url,
    content_type, content), whose links start from the final URL."""
    rows = captured.select(F.col("url").alias("requested"), F.coalesce(F.when(F.col("final_url") != "", F.col("final_url")), "url").alias("url"), "content_type", "content")
    return lateral_links(rows, "requested").withColumnRenamed("requested", "url")
