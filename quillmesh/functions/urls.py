"""URL and naming expressions. All are Spark columns, so they stay in generated code."""

from __future__ import annotations

import mimetypes
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: scheme, authority, path, query, fragment (RFC 3986, appendix B)
_PARTS = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#([\s\S]*))?$"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, _PARTS, group)


def scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def domain(url: Column) -> Column:
    """Lower-case authority, with port and user if given."""
    return F.lower(_part(url, 2))


def path(url: Column) -> Column:
    return _part(url, 3)


def _rebuilt(url: Column, where: Column) -> Column:
    start = F.when(scheme(url) != "", F.concat(scheme(url), F.lit(":"))).otherwise("")
    host = F.when(domain(url) != "", F.concat(F.lit("//"), domain(url))).otherwise("")
    query = F.when(_part(url, 4) != "", F.concat(F.lit("?"), _part(url, 4))).otherwise("")
    return F.concat(start, host, where, query)


def normalise_simple(url: Column) -> Column:
    """Lower-case scheme and host, no fragment; an empty path becomes "/"."""
    return _rebuilt(url, F.when(path(url) == "", F.lit("/")).otherwise(path(url)))


def normalise_wave(url: Column) -> Column:
    """As ``normalise_simple``, but an empty path stays empty: the two crawl modes differ in this."""
    return _rebuilt(url, path(url))


def seeds(url: Column) -> Column:
    """A root and, for web roots, its robots.txt and sitemap.xml, as an array."""
    root = F.concat(scheme(url), F.lit("://"), _part(url, 2))
    more = F.array(url, F.concat(root, F.lit("/robots.txt")), F.concat(root, F.lit("/sitemap.xml")))
    return F.when(scheme(url).isin("http", "https"), more).otherwise(F.array(url))


def site_id(url: Column) -> Column:
    """A name for folders: the host, else the path; odd characters become underscores."""
    local = F.regexp_replace(F.regexp_replace(path(url), "^/+|/+$", ""), "/", "_")
    name = F.when(domain(url) != "", domain(url)).when(local != "", local).otherwise("local")
    safe = F.regexp_replace(F.regexp_replace(name, "[^a-zA-Z0-9_.-]", "_"), "^[._]+|[._]+$", "")
    return F.when(safe == "", "unknown_site").otherwise(safe)


def stored_category(content_type: Column, url: Column) -> Column:
    """Folder of a raw file: html, json, pdf or other, by type or by the URL's suffix."""
    kind = F.trim(F.split_part(F.lower(F.coalesce(content_type, F.lit(""))), F.lit(";"), F.lit(1)))
    bare = F.split_part(F.lower(F.coalesce(url, F.lit(""))), F.lit("?"), F.lit(1))
    out = F.when(kind.contains("html") | bare.endswith(".html") | bare.endswith(".htm"), "html")
    return out.when(kind.contains("json") | bare.endswith(".json"), "json").when(kind.contains("pdf") | bare.endswith(".pdf"), "pdf").otherwise("other")


def viewed_category(content_type: Column, raw_location: Column) -> Column:
    """Category in the viewer: also xml; by type or folder. Differs from ``stored_category``."""
    kind, place = F.lower(F.coalesce(content_type, F.lit(""))), F.lower(F.coalesce(raw_location, F.lit("")))
    out = F.when(kind.contains("html") | place.contains("/html/"), "html")
    for name in ("pdf", "json"):
        out = out.when(kind.contains(name) | place.contains(f"/{name}/"), name)
    return out.when(kind.contains("xml") | kind.contains("rss") | place.contains("/xml/"), "xml").otherwise("other")


# fixed values: file extensions of content types
EXTENSIONS = {
    "application/pdf": ".pdf",
    "text/html": ".html",
    "text/plain": ".txt",
    "application/xml": ".xml",
    "text/xml": ".xml",
    "application/json": ".json",
    "text/csv": ".csv",
    "image/png": ".png",
    "image/jpeg": ".jpg",
}


@cache
def _registered() -> dict[str, str]:
    """The extension that the standard library gives each registered type."""
    known = mimetypes.MimeTypes()
    return {kind: found for kind in sorted(set(known.types_map[True].values())) if (found := known.guess_extension(kind))}


def _by_type(table: dict[str, str], content_type: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), content_type)


def extension(content_type: Column) -> Column:
    return F.coalesce(_by_type(_registered() | EXTENSIONS, content_type), F.lit(".bin"))


def viewed_extension(content_type: Column, raw_location: Column) -> Column:
    """Suffix of a file in the viewer, without a dot: by category, then text, then the type's own."""
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    category = viewed_category(content_type, raw_location)
    own = F.substring(_by_type(_registered(), kind), 2, 100)
    return F.when(category != "other", category).when(kind.contains("plain") | kind.contains("text"), "txt").otherwise(F.coalesce(own, F.lit("data")))


def viewed_folder(suffix: Column) -> Column:
    """Folder of an exported file, by its suffix."""
    return F.when(suffix.isin("html", "htm"), "html").when(suffix.isin("xml", "rss", "atom"), "xml").when(suffix.isin("pdf", "json"), suffix).otherwise("other")


def source_kind(url: Column) -> Column:
    """How a source is read, by its scheme: "http", "file", or null where no reader exists."""
    named = F.lower(scheme(url))
    return F.when(named.isin("http", "https"), "http").when(named.isin("file", ""), "file")


def file_name(url: Column, checksum: Column, suffix: Column) -> Column:
    """At most 60 characters of the path, "index" for an empty one, the checksum's start without URL."""
    trimmed = F.regexp_replace(path(url), "^/+|/+$", "")
    slug = F.when(url.isNull() | (url == ""), F.substring(checksum, 1, 12)).when(trimmed == "", "index")
    return F.concat(slug.otherwise(F.substring(F.regexp_replace(trimmed, "[^a-zA-Z0-9_-]", "_"), 1, 60)), F.lit("."), suffix)


def resolve(base: Column, href: Column) -> Column:
    """An absolute link from a page's URL and a reference, without fragment. Dot segments at the
    reference's start are resolved, deeper ones are left to the exact parser in sources.links."""
    root = F.concat(scheme(base), F.lit("://"), _part(base, 2))
    bare = F.regexp_replace(F.trim(href), "#[\\s\\S]*$", "")
    folder = F.regexp_replace(path(base), "[^/]*$", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    same = F.concat(root, path(base), F.when(_part(base, 4) != "", F.concat(F.lit("?"), _part(base, 4))).otherwise(""))
    return (
        F.when(bare == "", same)
        .when(scheme(bare) != "", bare)
        .when(bare.startswith("//"), F.concat(scheme(base), F.lit(":"), bare))
        .when(bare.startswith("/"), F.concat(root, bare))
        .when(bare.startswith("?"), F.concat(root, path(base), bare))
        .otherwise(F.concat(root, folder, F.regexp_replace(bare, "^(\\./)+", "")))
    )


def redacted(text: Column) -> Column:
    """Without user and password of URLs."""
    # fixed value: what counts as credentials
    return F.regexp_replace(text, r"(://)[^/@\s]+:[^/@\s]+@", "$1")
