"""The registered queries of the library proper, each with the same result as DuckDB SQL.

The tables at hand have no crawl of their own, so each operator runs on the nearest stand-in:
``pages`` for captured artifacts, ``documents`` and their lines for evidence, ``embeddings`` for
vectors (those with an id divisible by 100 are the dictionary side), ``events`` for the attempt
ledger (error: RATE_LIMITED, signup: TIMEOUT, others: SUCCESS) and ``conversations`` for event trees.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions import text as tx
from quillmesh.functions import urls
from quillmesh.operators import artifacts, evidence, exports, graph, ledger, pools, retrieval, sampling
from quillmesh.sources.links import anchor_hrefs
from quillmesh.storage import materialize
from quillmesh.streaming import ledger as ledger_stream

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        _QUERIES[query.__name__] = query
        if sql is not None:
            _ORACLE[query.__name__] = sql
        return query

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- retrieval ----------------------------------------------------------------------------------

K = 10
_COSINE = "round(list_cosine_similarity(q.embedding::DOUBLE[], t.embedding::DOUBLE[]), 9)"
_RANKED = """
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, target_id) AS rank, target_id, round(s, 6) AS similarity
  FROM (SELECT q.vec_id AS query_id, t.vec_id AS target_id, {cosine} AS s
        FROM embeddings q JOIN embeddings t ON q.vec_id <> t.vec_id AND {side}.vec_id % 100 = 0)
  QUALIFY rank <= 10)
"""
_TO_TARGETS = _RANKED.format(cosine=_COSINE, side="q")
_TO_DICTIONARY = _RANKED.format(cosine=_COSINE, side="t")


def _vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    every = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return every.where("vec_id % 100 = 0"), every


def _types(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias(name), F.col("label").alias("evidence_type"))


@register(f"WITH {_TO_TARGETS} SELECT * FROM ranked")
def vector_topk_query_to_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary vectors against all vectors."""
    few, every = _vectors(spark, sf_dir)
    return retrieval.top_k(few, every, K, few="queries")


@register(f"WITH {_TO_DICTIONARY} SELECT * FROM ranked")
def vector_topk_target_to_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors against the dictionary's."""
    few, every = _vectors(spark, sf_dir)
    return retrieval.top_k(every, few, K, few="targets")


@register(
    f"""WITH {_TO_DICTIONARY}, n AS (SELECT e.label AS evidence_type, target_id, count(*) AS hits FROM ranked JOIN embeddings e ON e.vec_id = query_id GROUP BY ALL)
    SELECT *, row_number() OVER (PARTITION BY evidence_type ORDER BY hits DESC, target_id) AS place FROM n QUALIFY place <= 10"""
)
def topk_hit_frequency_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.hit_frequency(vector_topk_target_to_query(spark, sf_dir), _types(spark, sf_dir, "query_id"))


@register(
    f"""WITH {_TO_TARGETS} SELECT e.label AS evidence_type, count(*) AS hits, round(100 * count(*) / sum(count(*)) OVER (), 4) AS share_pct
    FROM ranked JOIN embeddings e ON e.vec_id = target_id GROUP BY e.label"""
)
def topk_type_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.type_share(vector_topk_query_to_target(spark, sf_dir), _types(spark, sf_dir, "target_id"))


@register(
    """SELECT vec_id, round(n, 6) AS norm, round(embedding[1]::DOUBLE / n, 6) AS first_component
    FROM (SELECT *, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS n FROM embeddings)"""
)
def vector_l2_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = retrieval.require_dimension(table(spark, sf_dir, "embeddings"), "embedding", 64)
    squares = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return rows.select("vec_id", F.round(F.sqrt(squares), 6).alias("norm"), F.round(F.get(retrieval.l2_normalised(F.col("embedding")), F.lit(0)), 6).alias("first_component"))


@register("SELECT len(embedding)::INTEGER AS dimension, count(*) AS vectors, count(*) FILTER (len(embedding) <> 64) AS rejected FROM embeddings GROUP BY 1")
def vector_dimension_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.size("embedding")
    return table(spark, sf_dir, "embeddings").groupBy(size.alias("dimension")).agg(F.count(F.lit(1)).alias("vectors"), F.count_if(size != 64).alias("rejected"))


@register(
    """SELECT sum(n)::BIGINT AS n_rows, count(*) AS n_distinct, coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS rows_in_groups,
    (sum(n) - count(*))::BIGINT AS extra_rows, round((sum(n) - count(*)) / sum(n), 6) AS extra_rate FROM (SELECT count(*) AS n FROM documents GROUP BY text)"""
)
def duplicate_text_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.duplicate_rate(table(spark, sf_dir, "documents"))


@register("SELECT sha256(text) AS text_sha256, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY text HAVING count(*) > 1 ORDER BY n DESC, first_id LIMIT 20")
def duplicate_text_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.duplicate_leaderboard(table(spark, sf_dir, "documents"))


_FIRST_HALF = "list_cosine_similarity(q.embedding[1:32]::DOUBLE[], t.embedding[1:32]::DOUBLE[])"


@register(
    f"""WITH b AS (SELECT q.vec_id AS query_id, t.vec_id AS target_id, {_COSINE} AS whole, round({_FIRST_HALF}, 9) AS half FROM embeddings q JOIN embeddings t ON q.vec_id <> t.vec_id AND q.vec_id % 100 = 0),
    w AS (SELECT query_id, target_id FROM b QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY whole DESC, target_id) = 1),
    h AS (SELECT query_id, target_id FROM b QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY half DESC, target_id) = 1)
    SELECT query_id, w.target_id AS best_whole, h.target_id AS best_half, w.target_id = h.target_id AS agree FROM w JOIN h USING (query_id)"""
)
def representation_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best hit by two representations: the vector, and its first half."""
    few, every = _vectors(spark, sf_dir)
    half = lambda rows: rows.withColumn("embedding", F.slice("embedding", 1, 32))
    whole = retrieval.top_k(few, every, 1).select("query_id", F.col("target_id").alias("best_whole"))
    part = retrieval.top_k(half(few), half(every), 1).select("query_id", F.col("target_id").alias("best_half"))
    return whole.join(part, "query_id").withColumn("agree", F.col("best_whole") == F.col("best_half"))


# --- samples ------------------------------------------------------------------------------------


@register(
    """WITH g AS (SELECT lang, count(*) AS size FROM documents WHERE lang IS NOT NULL GROUP BY lang),
    e AS (SELECT *, sum(size) OVER () AS total, least(30, sum(size) OVER ()) AS want FROM g),
    b AS (SELECT *, (size * want) // total AS base, (size * want) % total AS part FROM e),
    o AS (SELECT *, row_number() OVER (ORDER BY base < size DESC, part DESC, lang) AS p, want - sum(base) OVER () AS remaining FROM b),
    t AS (SELECT lang, size, base + (p <= remaining)::BIGINT AS take FROM o),
    s AS (SELECT lang, size, take, unnest(range(0, take::BIGINT)) AS i FROM t),
    r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS at FROM documents)
    SELECT r.doc_id, r.lang FROM r JOIN s ON r.lang = s.lang AND r.at = (s.i * s.size) // s.take"""
)
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thirty documents in proportion to languages."""
    return sampling.stratified(table(spark, sf_dir, "documents").select("doc_id", "lang"), 30, "lang", ["doc_id"])


@register(
    """WITH r AS (SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_partkey) - 1 AS pos, count(*) OVER () AS n FROM part)
    SELECT p_partkey, p_name FROM r WHERE pos IN (SELECT (i * n) // least(20, n) FROM (SELECT DISTINCT n FROM r), range(0, 20) t(i) WHERE i < least(20, n))"""
)
def evenly_spaced_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.evenly_spaced(table(spark, sf_dir, "part").select("p_partkey", "p_name"), 20, ["p_partkey"])


# --- artifacts ----------------------------------------------------------------------------------


@register("SELECT sha256(html) AS sha256, min(page_id) AS first_id, count(*) AS copies, max(strlen(html)) AS byte_size FROM pages GROUP BY html")
def content_address_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return artifacts.content_groups(table(spark, sf_dir, "pages"), "page_id", "html")


@register("SELECT DISTINCT sha256(text) AS sha256 FROM documents WHERE text NOT IN (SELECT text FROM documents JOIN labels USING (doc_id))")
def existing_content_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents not worked on yet; labelled documents are those that were."""
    docs = table(spark, sf_dir, "documents").select("doc_id", tx.sha256_text(F.col("text")).alias("sha256"))
    done = docs.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    return artifacts.absent(docs.select("sha256").distinct(), done, "sha256")


@register(
    """SELECT user_id, event_type, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"""
)
def latest_wins_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", "ts")
    return artifacts.latest(rows, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


_HOST = r"regexp_extract(url, '^[^:/?#]+://([^/?#]*)', 1)"
_PATH = r"regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1)"
_QUERY = r"CASE WHEN regexp_extract(url, '\?([^#]+)', 1) <> '' THEN '?' || regexp_extract(url, '\?([^#]+)', 1) ELSE '' END"
_SCHEME = r"lower(regexp_extract(url, '^([^:/?#]+):', 1))"


@register(f"SELECT page_id, {_SCHEME} || '://' || lower({_HOST}) || CASE {_PATH} WHEN '' THEN '/' ELSE {_PATH} END || {_QUERY} AS normal_url FROM pages")
def url_normalise_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", urls.normalise_simple(F.col("url")).alias("normal_url"))


@register(f"SELECT page_id, {_SCHEME} || '://' || lower({_HOST}) || {_PATH} || {_QUERY} AS normal_url FROM pages")
def url_normalise_wave(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", urls.normalise_wave(F.col("url")).alias("normal_url"))


@register(f"SELECT lower({_HOST}) AS domain, count(*) AS pages FROM pages GROUP BY 1")
def url_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").groupBy(urls.domain(F.col("url")).alias("domain")).agg(F.count(F.lit(1)).alias("pages"))


@register(
    f"""SELECT page_id, unnest([url, {_SCHEME} || '://' || {_HOST} || '/robots.txt', {_SCHEME} || '://' || {_HOST} || '/sitemap.xml']) AS seed FROM pages"""
)
def seed_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.explode(urls.seeds(F.col("url"))).alias("seed"))


@register(
    f"""WITH p AS (SELECT page_id, lower({_HOST}) AS host FROM pages), root AS (SELECT host FROM p ORDER BY page_id LIMIT 1)
    SELECT page_id, p.host = root.host AS accepted, CASE WHEN p.host = root.host THEN 'acquisition' ELSE 'discovery' END AS event_type FROM p, root"""
)
def same_host_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages on the first page's host, and the rejected others."""
    pages = table(spark, sf_dir, "pages").select("page_id", urls.domain(F.col("url")).alias("host"))
    root = pages.agg(F.min_by("host", "page_id").alias("root"))
    same = F.col("host") == F.col("root")
    return pages.join(F.broadcast(root)).select("page_id", same.alias("accepted"), F.when(same, "acquisition").otherwise("discovery").alias("event_type"))


@register(
    rf"""SELECT page_id, coalesce(nullif(regexp_replace(regexp_replace(lower({_HOST}), '[^a-zA-Z0-9_.-]', '_', 'g'), '^[._]+|[._]+$', '', 'g'), ''), 'unknown_site') AS site_id FROM pages"""
)
def site_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", urls.site_id(F.col("url")).alias("site_id"))


_TYPES = "[NULL, 'text/html; charset=utf-8', 'application/json', 'application/pdf', 'application/rss+xml', 'text/plain']"
_TYPED = f"SELECT *, ({_TYPES})[(page_id % 6 + 1)::INTEGER] AS content_type, strlen(html) AS byte_size FROM pages"


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with content types of all kinds by turns: the pages themselves are all HTML."""
    kinds = F.array(*map(F.lit, (None, "text/html; charset=utf-8", "application/json", "application/pdf", "application/rss+xml", "text/plain")))
    rows = table(spark, sf_dir, "pages")
    return rows.withColumn("content_type", F.get(kinds, F.col("page_id") % 6)).withColumn("byte_size", F.octet_length("html").cast("long"))


@register(
    f"""SELECT page_id, CASE WHEN k LIKE '%html%' OR u LIKE '%.html' OR u LIKE '%.htm' THEN 'html' WHEN k LIKE '%json%' OR u LIKE '%.json' THEN 'json'
    WHEN k LIKE '%pdf%' OR u LIKE '%.pdf' THEN 'pdf' ELSE 'other' END AS category
    FROM (SELECT page_id, coalesce(lower(content_type), '') AS k, split_part(lower(url), '?', 1) AS u FROM ({_TYPED}))"""
)
def artifact_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(spark, sf_dir).select("page_id", urls.stored_category(F.col("content_type"), F.col("url")).alias("category"))


@register(
    f"""WITH c AS (SELECT byte_size, CASE WHEN k LIKE '%html%' THEN 'html' WHEN k LIKE '%pdf%' THEN 'pdf' WHEN k LIKE '%json%' THEN 'json'
    WHEN k LIKE '%xml%' OR k LIKE '%rss%' THEN 'xml' ELSE 'other' END AS category FROM (SELECT *, coalesce(content_type, '') AS k FROM ({_TYPED})))
    SELECT category, count(*) AS artifacts, sum(byte_size)::BIGINT AS bytes FROM c GROUP BY 1 UNION ALL SELECT 'ALL', count(*), sum(byte_size)::BIGINT FROM c"""
)
def viewer_category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return artifacts.category_counts(_typed(spark, sf_dir), urls.viewed_category(F.col("content_type"), F.lit("")))


@register(
    rf"""SELECT page_id, CASE WHEN trim({_PATH}, '/') = '' THEN 'index' ELSE substr(regexp_replace(trim({_PATH}, '/'), '[^a-zA-Z0-9_-]', '_', 'g'), 1, 60) END || '.html' AS file_name FROM pages"""
)
def derived_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = urls.file_name(F.col("url"), tx.sha256_text(F.col("html")), F.lit("html"))
    return table(spark, sf_dir, "pages").select("page_id", name.alias("file_name"))


@register("SELECT page_id, url FROM pages WHERE contains(lower(url), 'example.org') OR contains(sha256(html), 'example.org')")
def artifact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("source_url"), F.lit("").alias("raw_location"), tx.sha256_text(F.col("html")).alias("checksum"), F.lit("text/html").alias("content_type"))
    return artifacts.search(rows, "Example.org", "html").select("page_id", F.col("source_url").alias("url"))


@register(
    r"""SELECT page_id, strlen(html) - strlen(b) AS script_bytes, strlen(v) AS visible_bytes, strlen(v) < 200 AND strlen(html) - strlen(b) > 0.4 * strlen(html) AS is_shell
    FROM (SELECT page_id, html, b, regexp_replace(regexp_replace(b, '<[^>]+>', '', 'g'), '^\s+|\s+$', '', 'g') AS v
          FROM (SELECT page_id, html, regexp_replace(html, '<script[\s\S]*?</script>', '', 'gi') AS b FROM pages))"""
)
def spa_shell_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    bare = F.regexp_replace("html", r"(?i)<script[\s\S]*?</script>", "")
    visible = F.regexp_replace(F.regexp_replace(bare, r"<[^>]+>", ""), r"^\s+|\s+$", "")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        (F.octet_length("html") - F.octet_length(bare)).cast("long").alias("script_bytes"),
        F.octet_length(visible).cast("long").alias("visible_bytes"),
        tx.is_shell(F.col("html"), F.lit("text/html")).alias("is_shell"),
    )


_HREFS = r"""h AS (SELECT page_id, url, trim(href) AS href, min(i) AS i
  FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '<a\s[^>]*?href="([^"]*)"', 1, 'i')) AS href, generate_subscripts(regexp_extract_all(html, '<a\s[^>]*?href="([^"]*)"', 1, 'i'), 1) AS i FROM pages)
  GROUP BY ALL)"""


@register(f"WITH {_HREFS} SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS position, href FROM h")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = anchor_hrefs(table(spark, sf_dir, "pages").select("page_id", "html"))
    return found.withColumn("position", F.col("position").cast("long"))


@register(f"WITH {_HREFS} SELECT DISTINCT page_id, {_SCHEME} || '://' || {_HOST} || href AS link FROM h")
def page_links_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = pages.select("page_id", "url", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(r'(?i)<a\s[^>]*?href="([^"]*)"'), F.lit(1)))).alias("href"))
    return found.select("page_id", urls.resolve(F.col("url"), F.col("href")).alias("link")).where(urls.scheme(F.col("link")).isin("http", "https", "file", "")).distinct()


@register(
    rf"""WITH RECURSIVE {_HREFS}, e AS (SELECT 'p' || page_id AS src, 'l' || href AS dst FROM h UNION ALL SELECT 'l' || href, 'p' || page_id FROM h),
    r AS (SELECT 'p' || min(page_id) AS node, 0 AS depth FROM pages UNION SELECT e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.node WHERE r.depth < 3)
    SELECT node, min(depth)::INTEGER AS depth FROM r GROUP BY node"""
)
def bfs_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and link targets within three steps of the first page (pages share targets)."""
    found = anchor_hrefs(table(spark, sf_dir, "pages").select("page_id", "html"))
    pages, targets = F.concat(F.lit("p"), F.col("page_id")), F.concat(F.lit("l"), F.col("href"))
    out = materialize(found.select(pages.alias("src"), targets.alias("dst")), "edges")
    edges = out.unionByName(out.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    root = table(spark, sf_dir, "pages").agg(F.concat(F.lit("p"), F.min("page_id")).alias("node"))
    return graph.reach(edges, root, 3)


@register(
    """WITH RECURSIVE e AS (SELECT conv_id AS run_id, turn AS event_id, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS parent FROM conversations),
    r AS (SELECT run_id, event_id, 0 AS depth, event_id::VARCHAR AS path FROM e WHERE parent IS NULL
          UNION ALL SELECT e.run_id, e.event_id, r.depth + 1, r.path || '/' || e.event_id FROM e JOIN r ON e.run_id = r.run_id AND e.parent = r.event_id)
    SELECT run_id, event_id, depth::INTEGER AS depth, path FROM r"""
)
def event_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation as a chain of events."""
    from pyspark.sql import Window

    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("run_id"), F.col("turn").alias("event_id"))
    parent = F.lag("event_id").over(Window.partitionBy("run_id").orderBy("event_id"))
    found = graph.lineage(materialize(rows.withColumn("parent_event_id", parent), "events"))
    return found.withColumn("path", F.array_join(F.transform("path", lambda x: x.cast("string")), "/"))


@register(
    f"""WITH p AS (SELECT page_id, url, lower({_HOST}) AS host FROM pages), f AS (SELECT host, min(page_id) AS first_page, arg_min(url, page_id) AS first_url FROM p GROUP BY host)
    SELECT page_id, CASE WHEN page_id <> first_page THEN first_page END AS discovered_by, CASE WHEN page_id <> first_page THEN first_url END AS discovered_from FROM p JOIN f USING (host)"""
)
def discovering_artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page with the page that led to it: the first of its host, which itself has none."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", urls.domain(F.col("url")).alias("host"))
    first = pages.groupBy("host").agg(F.min("page_id").alias("first_page"), F.min_by("url", "page_id").alias("first_url"))
    other = F.col("page_id") != F.col("first_page")
    return pages.join(first, "host").select("page_id", F.when(other, F.col("first_page")).alias("discovered_by"), F.when(other, F.col("first_url")).alias("discovered_from"))


@register(
    """SELECT s.source, coalesce(e.events, 0) AS events, coalesce(e.succeeded, 0) AS succeeded, e.last_event FROM (SELECT DISTINCT source FROM documents) s
    LEFT JOIN (SELECT source, count(*) AS events, count(*) FILTER (quality = 1) AS succeeded, max(doc_id) AS last_event FROM documents JOIN labels USING (doc_id) GROUP BY source) e
    ON e.source IS NOT DISTINCT FROM s.source"""
)
def artifact_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artifacts (sources) with their events (labelled documents), also those without any."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    events = docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    labelled = F.col("quality").isNotNull()
    return events.groupBy("source").agg(F.count_if(labelled).alias("events"), F.count_if(F.col("quality") == 1).alias("succeeded"), F.max(F.when(labelled, F.col("doc_id"))).alias("last_event"))


# --- ledger -------------------------------------------------------------------------------------

_ATTEMPTS = """a AS (SELECT *, row_number() OVER (PARTITION BY run_id, url ORDER BY occurred_at, attempt_id) - 1 AS retry_number FROM (
  SELECT cast(cast(ts AS DATE) AS VARCHAR) AS run_id, 'https://d' || (user_id % 20) || '.example/' || user_id AS url, 'd' || (user_id % 20) || '.example' AS domain,
         ts AS occurred_at, event_id AS attempt_id, CASE event_type WHEN 'error' THEN 'RATE_LIMITED' WHEN 'signup' THEN 'TIMEOUT' ELSE 'SUCCESS' END AS final_result,
         CASE event_type WHEN 'view' THEN 'browser' ELSE 'http' END AS acquisition_method FROM events))"""
_STREAKS = """i AS (SELECT *, sum((final_result = 'SUCCESS')::INTEGER) OVER (PARTITION BY domain ORDER BY occurred_at, attempt_id) AS island FROM a),
s AS (SELECT *, sum((final_result <> 'SUCCESS')::INTEGER) OVER (PARTITION BY domain, island ORDER BY occurred_at, attempt_id) AS streak,
             sum((final_result = 'RATE_LIMITED')::INTEGER) OVER (PARTITION BY domain, island ORDER BY occurred_at, attempt_id) AS limited FROM i)"""
_LAST = """l AS (SELECT run_id, url, arg_max(final_result, (occurred_at, attempt_id)) AS final_result FROM a GROUP BY ALL)"""


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    domain = F.concat(F.lit("d"), F.col("user_id") % 20, F.lit(".example"))
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("date").cast("string").alias("run_id"),
        F.concat(F.lit("https://"), domain, F.lit("/"), F.col("user_id")).alias("url"),
        domain.alias("domain"),
        F.col("ts").alias("occurred_at"),
        F.col("event_id").alias("attempt_id"),
        F.when(F.col("event_type") == "error", "RATE_LIMITED").when(F.col("event_type") == "signup", "TIMEOUT").otherwise("SUCCESS").alias("final_result"),
        F.when(F.col("event_type") == "view", "browser").otherwise("http").alias("acquisition_method"),
    )


@register(
    f"""WITH {_ATTEMPTS}, {_STREAKS}, {_LAST}, u AS (SELECT run_id, count(*) AS attempted, count(*) FILTER (final_result = 'SUCCESS') AS acquired FROM l GROUP BY 1),
    f AS (SELECT run_id, count(*) FILTER (retry_number > 0) AS retries, count(*) FILTER (final_result = 'RATE_LIMITED') AS rate_limited,
      count(*) FILTER (final_result = 'SUCCESS' AND acquisition_method = 'browser') AS browser_pages, count(*) FILTER (streak IN (1, 2)) AS proxy_failures FROM s GROUP BY 1)
    SELECT u.*, f.* EXCLUDE (run_id), attempted - acquired AS failed, CASE acquired WHEN 0 THEN 'FAILED' WHEN attempted THEN 'SUCCESS' ELSE 'PARTIAL' END AS status FROM u JOIN f USING (run_id)"""
)
def ledger_run_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day is a run; each domain's streak of failures stands for its proxy's health."""
    # streaks first: their ranges are cut by a sample of what lies before them
    rows = ledger.with_retry_numbers(ledger.failure_streaks(_attempts(spark, sf_dir)))
    return ledger.run_rollup(materialize(rows.withColumnRenamed("health", "proxy_status"), "attempts"))


@register(f"WITH {_ATTEMPTS}, {_LAST} SELECT run_id, final_result, count(*) AS urls FROM l GROUP BY ALL")
def ledger_state_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.state_counts(_attempts(spark, sf_dir))


@register(
    f"""WITH {_ATTEMPTS}, {_LAST}, n AS (SELECT run_id, count(*) AS n, count(*) FILTER (final_result = 'SUCCESS') AS ok FROM l GROUP BY 1)
    SELECT run_id, CASE ok WHEN 0 THEN 'FAILED' WHEN n THEN 'SUCCESS' ELSE 'PARTIAL' END AS status FROM n"""
)
def ledger_run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls_by_run = ledger.last_results(_attempts(spark, sf_dir)).groupBy("run_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("final_result") == "SUCCESS").alias("ok"))
    return urls_by_run.select("run_id", ledger.run_status(F.col("n"), F.col("ok")).alias("status"))


@register(f"WITH {_ATTEMPTS} SELECT run_id, url, count(*) AS attempts, arg_max(final_result, (retry_number, occurred_at, attempt_id)) AS last_result FROM a GROUP BY ALL")
def ledger_url_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.url_history(ledger.with_retry_numbers(_attempts(spark, sf_dir)))


@register(f"WITH {_ATTEMPTS}, {_STREAKS} SELECT attempt_id, domain, limited::BIGINT AS streak, least(60.0, 1.0 * power(2.0, limited - 1))::DOUBLE AS backoff_seconds FROM s WHERE final_result = 'RATE_LIMITED'")
def ledger_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.backoff(_attempts(spark, sf_dir)).select("attempt_id", "domain", "streak", "backoff_seconds")


@register(
    f"""WITH RECURSIVE {_ATTEMPTS}, o AS (SELECT domain, final_result = 'SUCCESS' AS ok, row_number() OVER (PARTITION BY domain ORDER BY occurred_at, attempt_id) AS n FROM a WHERE final_result IN ('SUCCESS', 'RATE_LIMITED')),
    r AS (SELECT domain, 0::BIGINT AS n, 8 AS c, 0 AS streak, 0 AS down, 0 AS up FROM (SELECT DISTINCT domain FROM o)
      UNION ALL SELECT r.domain, o.n, CASE WHEN NOT o.ok THEN greatest(1, c // 2) WHEN streak + 1 >= 5 AND c < 8 THEN c + 1 ELSE c END,
        CASE WHEN NOT o.ok OR (streak + 1 >= 5 AND c < 8) THEN 0 ELSE streak + 1 END, down + (NOT o.ok AND c > 1)::INTEGER, up + (o.ok AND streak + 1 >= 5 AND c < 8)::INTEGER
      FROM r JOIN o ON o.domain = r.domain AND o.n = r.n + 1)
    SELECT domain, arg_max(c, n)::BIGINT AS concurrency, max(down)::BIGINT AS reductions, max(up)::BIGINT AS restorations FROM r GROUP BY domain"""
)
def ledger_adaptive_concurrency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.adaptive_concurrency(_attempts(spark, sf_dir))


@register(
    f"""WITH {_ATTEMPTS}, {_STREAKS} SELECT domain, max(streak)::BIGINT AS longest, count(*) FILTER (streak = 3 AND final_result <> 'SUCCESS') AS quarantines,
    count(*) FILTER (final_result <> 'SUCCESS') AS failures FROM s GROUP BY domain"""
)
def ledger_failure_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.col("final_result") != "SUCCESS"
    rows = ledger.failure_streaks(_attempts(spark, sf_dir))
    return rows.groupBy("domain").agg(F.max("streak").alias("longest"), F.count_if(failed & (F.col("streak") == ledger.UNHEALTHY_AFTER)).alias("quarantines"), F.count_if(failed).alias("failures"))


@register(
    f"""WITH {_ATTEMPTS}, p AS (SELECT *, lag(final_result) OVER (PARTITION BY domain ORDER BY occurred_at, attempt_id) AS before FROM a)
    SELECT attempt_id, domain FROM p WHERE final_result = 'SUCCESS' AND before <> 'SUCCESS'"""
)
def ledger_recoveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.recoveries(_attempts(spark, sf_dir)).select("attempt_id", "domain")


@register(f"WITH {_ATTEMPTS} SELECT run_id, url, attempt_id FROM a WHERE retry_number = 2")
def ledger_announce_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.announced(ledger.with_retry_numbers(_attempts(spark, sf_dir))).select("run_id", "url", "attempt_id")


_STATUSES = [200, 429, 401, 403, 408, 404, 500, 302]


@register(
    f"""SELECT CASE WHEN f = 0 AND event_type = 'signup' THEN 'TIMEOUT' WHEN st = 429 THEN 'RATE_LIMITED' WHEN st IN (401, 403) THEN 'ACCESS_DENIED' WHEN st = 408 THEN 'TIMEOUT'
    WHEN st = 404 THEN 'NOT_FOUND' WHEN st >= 400 THEN 'NETWORK_ERROR' ELSE 'SUCCESS' END AS outcome,
    CASE WHEN f = 0 AND event_type = 'signup' THEN 'connect_timeout' WHEN st >= 400 THEN 'http_' || st END AS detail, count(*) AS attempts
    FROM (SELECT event_type, event_id % 3 AS f, ({_STATUSES})[((floor(value)::BIGINT % 8 + 8) % 8 + 1)::INTEGER] AS st FROM events) GROUP BY ALL"""
)
def http_outcome_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A status for each event by its value; every third signup had none."""
    status = F.get(F.array(*map(F.lit, _STATUSES)), F.pmod(F.floor("value"), F.lit(8)).cast("int"))
    failure = F.when((F.col("event_id") % 3 == 0) & (F.col("event_type") == "signup"), "timeout")
    rows = table(spark, sf_dir, "events").select(status.alias("status"), failure.alias("failure"))
    pair = (F.col("status"), F.col("failure"))
    return rows.groupBy(ledger.outcome(*pair).alias("outcome"), ledger.outcome_detail(*pair).alias("detail")).agg(F.count(F.lit(1)).alias("attempts"))


@register(
    """SELECT date_trunc('hour', ts)::TIMESTAMP AS start, count(*) AS attempts, count(*) FILTER (event_type IS NULL OR event_type NOT IN ('error', 'signup')) AS successes
    FROM events WHERE ts IS NOT NULL GROUP BY ALL"""
)
def ledger_progress_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger read as a stream of files; each batch writes the whole progress so far, so that no
    window stays open and no row is late, and the last batch's table is the result."""
    from quillmesh.storage import new_path

    stream = ledger_stream.read_events(spark, f"{sf_dir}/events.parquet*")
    attempts = stream.select(F.col("ts").cast("timestamp").alias("occurred_at"), F.when(F.col("event_type").isin("error", "signup"), "FAILED").otherwise("SUCCESS").alias("final_result"))
    out, state = new_path(spark, "progress"), new_path(spark, "progress-state")
    last = []

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/{batch}")
        last[:] = [f"{out}/{batch}"]

    run = ledger_stream.progress(attempts, "1 hour", None).writeStream.foreachBatch(write).option("checkpointLocation", state).outputMode("complete").trigger(availableNow=True).start()
    run.awaitTermination()
    schema = "start timestamp, attempts long, successes long"
    return spark.read.schema(schema).parquet(*last) if last else spark.createDataFrame([], schema)


# --- evidence -----------------------------------------------------------------------------------

_LINES = r"""w AS (SELECT doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS line, line_no FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents)),
n AS (SELECT * FROM w WHERE line <> '')"""
_HEADED = f"""{_LINES}, m AS (SELECT doc_id, median(length(line)) AS m FROM n GROUP BY 1),
g AS (SELECT n.*, length(line) >= 1.5 * m AS is_heading FROM n JOIN m USING (doc_id)),
c AS (SELECT *, last_value(CASE WHEN is_heading THEN line END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section FROM g)"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents, blank ones included; a stripped line's length stands for its height."""
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("artifact_id"), F.lit(1).alias("page_number"), F.posexplode(F.split("text", "\n")).alias("line_no", "text"))
    return rows.withColumn("text", tx.stripped(F.col("text"))).withColumn("height", F.length("text").cast("double"))


@register(
    rf"""WITH {_LINES}, v AS (SELECT doc_id, line_no, 'line ' || line_no || ': ' || line AS t FROM w)
    SELECT doc_id, line_no, trim(split_part(t, ':', 1)) AS claim, md5(regexp_replace(substr(t, instr(t, ':') + 1), '^\s+|\s+$', '', 'g')) AS value_md5 FROM v"""
)
def claim_value_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines numbered as claims, since the texts have no colon of their own."""
    t = F.concat(F.lit("line "), F.col("line_no"), F.lit(": "), F.col("text"))
    return _lines(spark, sf_dir).select(F.col("artifact_id").alias("doc_id"), F.col("line_no").cast("long").alias("line_no"), tx.claim(t).alias("claim"), F.md5(tx.value(t)).alias("value_md5"))


@register(f"WITH {_HEADED} SELECT doc_id, count(*) AS lines, count(*) FILTER (is_heading) AS headings FROM c GROUP BY 1")
def heading_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = evidence.headings(_lines(spark, sf_dir))
    return rows.groupBy(F.col("artifact_id").alias("doc_id")).agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("is_heading")).alias("headings"))


@register(f"WITH {_HEADED} SELECT doc_id, line_no, md5(section) AS section_md5 FROM c")
def section_carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = evidence.sections(evidence.headings(_lines(spark, sf_dir)))
    return rows.select(F.col("artifact_id").alias("doc_id"), F.col("line_no").cast("long").alias("line_no"), F.md5("section").alias("section_md5"))


@register(
    f"""WITH {_HEADED} SELECT doc_id, line_no, md5(CASE WHEN is_heading OR coalesce(section, '') = '' THEN line ELSE section || ': ' || line END) AS canonical_md5
    FROM c"""
)
def canonical_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = evidence.text_evidence(_lines(spark, sf_dir))
    return rows.select(F.col("artifact_id").alias("doc_id"), F.col("line_no").cast("long").alias("line_no"), F.md5("canonical_text").alias("canonical_md5"))


@register(
    f"""WITH {_HEADED} SELECT doc_id, 1::BIGINT AS page_count, count(*) AS text_count, count(*) FILTER (is_heading) AS heading_count
    FROM c GROUP BY 1"""
)
def extraction_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.extraction_metadata(evidence.text_evidence(_lines(spark, sf_dir))).withColumnRenamed("artifact_id", "doc_id")


@register(
    """SELECT d.doc_id, d.source, s.first_doc, l.quality FROM documents d JOIN (SELECT source, min(doc_id) AS first_doc FROM documents GROUP BY 1) s ON d.source = s.source
    JOIN labels l ON l.doc_id = d.doc_id"""
)
def evidence_provenance_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence (documents) with its artifact (source) and provenance (labels)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    sources = docs.groupBy("source").agg(F.min("doc_id").alias("first_doc"))
    return docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id").join(sources, "source").select("doc_id", "source", "first_doc", "quality")


@register(
    """SELECT lang AS evidence_type, count(*) AS n FROM documents GROUP BY 1"""
)
def evidence_count_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy(F.col("lang").alias("evidence_type")).agg(F.count(F.lit(1)).alias("n"))


# --- exports ------------------------------------------------------------------------------------


@register(
    f"""WITH {_ATTEMPTS}, d AS (SELECT run_id, url, bool_or(final_result = 'SUCCESS') AS ok FROM a GROUP BY ALL)
    SELECT d.run_id, count(*) AS discovered, count(*) FILTER (ok) AS acquired_urls, count(*) FILTER (NOT ok) AS rejected_urls, any_value(n.acquired) AS acquired
    FROM d JOIN (SELECT run_id, count(*) FILTER (final_result = 'SUCCESS') AS acquired FROM a GROUP BY 1) n USING (run_id) GROUP BY d.run_id"""
)
def export_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    attempts = _attempts(spark, sf_dir)
    by_url = attempts.groupBy("run_id", "url").agg(F.bool_or(F.col("final_result") == "SUCCESS").alias("ok"), F.count_if(F.col("final_result") == "SUCCESS").alias("n"))
    return by_url.groupBy("run_id").agg(F.count(F.lit(1)).alias("discovered"), F.count_if("ok").alias("acquired_urls"), F.count_if(~F.col("ok")).alias("rejected_urls"), F.sum("n").alias("acquired"))


@register(
    f"""SELECT coalesce(content_type, 'unknown') AS content_type, count(*) AS artifacts, sum(byte_size)::BIGINT AS bytes, count(DISTINCT sha256(html)) AS contents FROM ({_TYPED}) GROUP BY 1"""
)
def manifest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _typed(spark, sf_dir).select(F.coalesce("content_type", F.lit("unknown")).alias("content_type"), "byte_size", tx.sha256_text(F.col("html")).alias("sha"))
    contents = rows.groupBy("content_type", "sha").agg(F.count(F.lit(1)).alias("n"), F.sum("byte_size").alias("b"))
    return contents.groupBy("content_type").agg(F.sum("n").alias("artifacts"), F.sum("b").alias("bytes"), F.count(F.lit(1)).alias("contents"))


@register(
    f"""WITH {_LINES}, u AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) SELECT unnest(['checksum is not sha-256', 'byte size is negative', 'source url is empty', 'claim is empty', 'value is empty', 'canonical text is empty']) AS rule,
    unnest([0, 0, (SELECT count(*) FILTER (coalesce(url, '') = '') FROM pages), (SELECT count(*) FILTER (line = '') FROM u), (SELECT count(*) FILTER (line = '') FROM u), (SELECT count(*) FILTER (line = '') FROM u)])::BIGINT AS rows"""
)
def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.col("url").alias("source_url"), tx.sha256_text(F.col("html")).alias("checksum"), F.octet_length("html").alias("byte_size"))
    rows = _lines(spark, sf_dir).select(tx.claim(F.col("text")).alias("claim"), tx.value(F.col("text")).alias("value"), F.col("text").alias("canonical_text"))
    return artifacts.violations(pages, rows)


@register(
    r"""SELECT page_id, regexp_replace('https://user' || page_id || ':pw@' || substr(url, instr(url, '://') + 3), '(://)[^/@\s]+:[^/@\s]+@', '\1') AS shown FROM pages"""
)
def credential_redaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page URLs with credentials put in, shown without."""
    secret = F.concat(F.lit("https://user"), F.col("page_id"), F.lit(":pw@"), F.substring_index("url", "://", -1))
    return table(spark, sf_dir, "pages").select("page_id", urls.redacted(secret).alias("shown"))


@register(
    r"""SELECT doc_id, CASE WHEN length(t) > 160 THEN substr(t, 1, 159) || '…' ELSE t END AS shown FROM (SELECT doc_id, regexp_replace(replace(text, chr(10), ' '), '^\s+|\s+$', '', 'g') AS t FROM documents)"""
)
def truncated_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", tx.shortened(F.col("text")).alias("shown"))


# --- events, runs and reports -------------------------------------------------------------------

_EVENTS = """x AS (SELECT cast(cast(ts AS DATE) AS VARCHAR) AS run_id, event_id, CASE event_type WHEN 'view' THEN 'discovery' WHEN 'signup' THEN 'completion' WHEN 'purchase' THEN 'extraction' ELSE 'acquisition' END AS event_type,
  CASE WHEN event_type = 'error' OR (event_type = 'view' AND value < 5) THEN 'failed' ELSE 'succeeded' END AS status,
  CASE WHEN event_type = 'error' OR (event_type = 'view' AND value < 5) THEN 'event ' || event_id END AS error_message, CASE WHEN event_type <> 'view' THEN user_id END AS artifact_id FROM events)"""


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of crawls: views stand for discoveries (rejected below 5), signups for completions of a
    run (a day), purchases for extractions, errors for failed acquisitions, users for artifacts."""
    kind = F.col("event_type")
    failed = F.coalesce((kind == "error") | ((kind == "view") & (F.col("value") < 5)), F.lit(False))
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("date").cast("string").alias("run_id"),
        "event_id",
        F.when(kind == "view", "discovery").when(kind == "signup", "completion").when(kind == "purchase", "extraction").otherwise("acquisition").alias("event_type"),
        F.when(failed, "failed").otherwise("succeeded").alias("status"),
        F.when(failed, F.concat(F.lit("event "), F.col("event_id"))).alias("error_message"),
        F.when(kind != "view", F.col("user_id")).alias("artifact_id"),
    )


@register(f"WITH {_EVENTS} SELECT event_type, status, count(*) AS events, min(event_id) AS first_event FROM x GROUP BY ALL")
def event_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).groupBy("event_type", "status").agg(F.count(F.lit(1)).alias("events"), F.min("event_id").alias("first_event"))


@register(f"WITH {_EVENTS} SELECT CASE event_type WHEN 'acquisition' THEN 0 ELSE 1 END AS branch, event_id, error_message FROM x WHERE status = 'failed' AND event_type IN ('acquisition', 'discovery')")
def failed_and_rejected_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.failed_and_rejected(_events(spark, sf_dir)).select("branch", "event_id", "error_message")


@register(f"WITH {_EVENTS} SELECT DISTINCT artifact_id FROM x WHERE event_type = 'acquisition' AND status = 'succeeded' AND artifact_id IS NOT NULL")
def exported_artifact_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.exported_artifacts(_events(spark, sf_dir))


@register(
    f"""WITH {_EVENTS}, l AS (SELECT run_id, arg_max(event_id, event_id) FILTER (status = 'failed' OR event_type = 'completion') AS event_id FROM x GROUP BY 1)
    SELECT l.run_id, CASE WHEN x.event_id IS NULL THEN 'running' WHEN x.event_type = 'completion' THEN x.status ELSE 'failed' END AS status, CASE WHEN x.event_type <> 'completion' THEN x.error_message END AS error_message
    FROM l LEFT JOIN x ON x.event_id = l.event_id"""
)
def run_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of a run's status: the last failure, or the completion after it."""
    return ledger.run_states(_events(spark, sf_dir))


@register(f"WITH {_ATTEMPTS}, d AS (SELECT run_id, url, bool_or(final_result = 'SUCCESS') AS ok FROM a GROUP BY ALL) SELECT run_id, count(*) AS discovered, count(*) FILTER (ok) AS acquired, count(*) FILTER (NOT ok) AS rejected FROM d GROUP BY 1")
def crawl_result_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = _attempts(spark, sf_dir).select("run_id", "url", (F.col("final_result") == "SUCCESS").alias("acquired"))
    return ledger.crawl_counts(visits)


@register(f"WITH {_ATTEMPTS} SELECT final_result, attempt_id, url FROM a WHERE final_result <> 'SUCCESS'")
def failures_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.failures(_attempts(spark, sf_dir)).select("final_result", "attempt_id", "url")


@register(f"WITH {_ATTEMPTS} SELECT final_result, count(*) AS failures FROM a WHERE final_result <> 'SUCCESS' GROUP BY 1")
def failures_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.failure_counts(_attempts(spark, sf_dir))


@register(
    f"""WITH {_ATTEMPTS}, u AS (SELECT url, count(*) AS attempts, count(*) FILTER (final_result = 'RATE_LIMITED') AS limited FROM a GROUP BY 1),
    s AS (SELECT url, attempts, nullif(limited, 0) AS limited FROM u)
    SELECT 'ascending' AS direction, * FROM (FROM s ORDER BY limited ASC NULLS LAST, url LIMIT 50) UNION ALL SELECT 'descending', * FROM (FROM s ORDER BY limited DESC NULLS LAST, url LIMIT 50)"""
)
def sources_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of the table of sources, sorted by a column with nulls in both directions."""
    limited = F.count_if(F.col("final_result") == "RATE_LIMITED")
    rows = _attempts(spark, sf_dir).groupBy("url").agg(F.count(F.lit(1)).alias("attempts"), F.nullif(limited, F.lit(0)).alias("limited"))
    up, down = (ledger.sorted_by(rows, "limited", descending, ("url",)).limit(50) for descending in (False, True))
    return up.select(F.lit("ascending").alias("direction"), "*").unionByName(down.select(F.lit("descending").alias("direction"), "*"))


@register(
    f"""WITH {_ATTEMPTS}, e AS (SELECT *, final_result = 'SUCCESS' AND acquisition_method = 'http' AND attempt_id % 3 = 0 AS up FROM a),
    r AS (SELECT run_id, url, occurred_at, attempt_id, retry_number, 0 AS step, acquisition_method, CASE WHEN up THEN 'PENDING_RETRY' ELSE final_result END AS final_result FROM e
          UNION ALL SELECT run_id, url, occurred_at, attempt_id, retry_number, 1, 'browser', CASE WHEN attempt_id % 2 = 0 THEN 'SUCCESS' ELSE 'BROWSER_ERROR' END FROM e WHERE up)
    SELECT run_id, url, count(*) AS attempts, arg_max(final_result, (occurred_at, attempt_id, step)) AS final_result, max(retry_number) AS retries FROM r GROUP BY ALL"""
)
def browser_escalation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third HTTP success had dynamic content; of the browser attempts every other succeeded. The
    last attempt of a URL decides, the browser's after the HTTP attempt of the same retry number."""
    third, even = F.col("attempt_id") % 3 == 0, F.col("attempt_id") % 2 == 0
    rows = ledger.escalated(ledger.with_retry_numbers(_attempts(spark, sf_dir)), third, F.when(even, "SUCCESS").otherwise("BROWSER_ERROR"))
    return rows.groupBy("run_id", "url").agg(F.count(F.lit(1)).alias("attempts"), F.max_by("final_result", F.struct("occurred_at", "attempt_id", "step")).alias("final_result"), F.max("retry_number").cast("long").alias("retries"))


@register(
    """WITH h AS (SELECT conv_id AS key, turn AS hop, 'https://' || role || '.example/' || conv_id || '/' || turn AS url, CASE WHEN length(text) % 2 = 0 THEN 301 ELSE 302 END AS status FROM conversations)
    SELECT key, count(*) AS hops, string_agg(status || ' ' || url, ' > ' ORDER BY hop, url, status) AS chain, arg_max(url, (hop, url, status)) AS final_url FROM h GROUP BY key"""
)
def redirect_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation as hops of a redirect."""
    hops = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("key"),
        F.col("turn").alias("hop"),
        F.concat(F.lit("https://"), "role", F.lit(".example/"), "conv_id", F.lit("/"), "turn").alias("url"),
        F.when(F.length("text") % 2 == 0, 301).otherwise(302).alias("status"),
    )
    shown = F.array_join(F.transform("redirect_chain", lambda h: F.concat(h["status"].cast("string"), F.lit(" "), h["url"])), " > ")
    return ledger.redirect_chains(hops).select("key", F.size("redirect_chain").cast("long").alias("hops"), shown.alias("chain"), "final_url")


@register("SELECT event_id, json_extract(props, '$.k')::BIGINT AS k, json_object('event_id', event_id, 'k', json_extract(props, '$.k')::BIGINT)::VARCHAR AS again FROM events")
def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties read from JSON and written again, nulls included."""
    rows = table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))
    return rows.withColumn("again", F.to_json(F.struct("event_id", "k"), {"ignoreNullFields": "false"}))


@register(f"SELECT page_id, coalesce(lower(trim(split_part(content_type, ';', 1))) IN ('text/html', 'application/pdf'), FALSE) AS allowed FROM ({_TYPED})")
def allowed_content_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = artifacts.content_type(F.col("content_type"), F.encode("html", "utf-8"))
    return _typed(spark, sf_dir).select("page_id", artifacts.is_allowed(kind, ["text/html", "application/pdf"]).alias("allowed"))


@register(
    f"""WITH s AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN 'file:///data/' || page_id WHEN 2 THEN 'data/' || page_id ELSE 'ftp://h/' || page_id END AS source FROM pages)
    SELECT page_id, CASE WHEN source LIKE 'http%' THEN 'http' WHEN source LIKE 'ftp%' THEN NULL ELSE 'file' END AS kind FROM s"""
)
def source_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of four schemes by turns, and what reads them."""
    turn, page = F.col("page_id") % 4, F.col("page_id").cast("string")
    source = F.when(turn == 0, F.col("url")).when(turn == 1, F.concat(F.lit("file:///data/"), page)).when(turn == 2, F.concat(F.lit("data/"), page)).otherwise(F.concat(F.lit("ftp://h/"), page))
    return table(spark, sf_dir, "pages").select("page_id", urls.source_kind(source).alias("kind"))


@register("SELECT page_id, url FROM pages WHERE sha256(html) = (SELECT sha256(html) FROM pages ORDER BY page_id DESC LIMIT 1) ORDER BY page_id LIMIT 1")
def artifact_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page with the content of the last one, found by checksum."""
    rows = table(spark, sf_dir, "pages").select("page_id", "url", tx.sha256_text(F.col("html")).alias("sha256"))
    last = rows.orderBy(F.desc("page_id")).limit(1).collect()
    return artifacts.find(rows, ["page_id"], sha256=last[0].sha256 if last else None).drop("sha256")


@register(f"WITH {_ATTEMPTS} SELECT attempt_id, url, retry_number FROM a WHERE run_id = (SELECT max(run_id) FROM a)")
def attempts_of_last_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ledger.with_retry_numbers(_attempts(spark, sf_dir))
    last = rows.agg(F.max("run_id")).first()[0]
    return ledger.of_run(rows, last).select("attempt_id", "url", F.col("retry_number").cast("long").alias("retry_number"))


_POOL = """p AS (SELECT domain, final_result, row_number() OVER (PARTITION BY domain ORDER BY occurred_at, attempt_id) AS n FROM a),
r AS (SELECT DISTINCT domain, 0::BIGINT AS n, 0::BIGINT AS minted, 0::BIGINT AS cur, []::BIGINT[] AS ids, []::BIGINT[] AS fails, NULL::BIGINT AS session, NULL::VARCHAR AS health FROM p
  UNION ALL
  SELECT domain, n, minted, CASE WHEN bad >= 3 THEN 0 ELSE nextcur END,
    CASE WHEN bad >= 3 THEN list_concat(ids[1:slot - 1], ids[slot + 1:]) ELSE ids END,
    CASE WHEN bad >= 3 THEN list_concat(fails[1:slot - 1], fails[slot + 1:]) ELSE list_concat(list_append(fails[1:slot - 1], bad), fails[slot + 1:]) END,
    ids[slot], CASE WHEN bad >= 3 THEN 'retired' ELSE 'healthy' END
  FROM (SELECT *, CASE WHEN final_result = 'SUCCESS' THEN 0 WHEN final_result = 'NOT_FOUND' THEN fails[slot] ELSE fails[slot] + 1 END AS bad
    FROM (SELECT r.domain, p.n, p.final_result, CASE WHEN len(ids) < 4 THEN minted + 1 ELSE minted END AS minted,
            CASE WHEN len(ids) < 4 THEN cur ELSE (cur + 1) % 4 END AS nextcur,
            CASE WHEN len(ids) < 4 THEN list_append(ids, minted) ELSE ids END AS ids, CASE WHEN len(ids) < 4 THEN list_append(fails, 0) ELSE fails END AS fails,
            CASE WHEN len(ids) < 4 THEN len(ids) + 1 ELSE cur % 4 + 1 END AS slot
          FROM r JOIN p ON p.domain = r.domain AND p.n = r.n + 1)))"""


@register(f"WITH RECURSIVE {_ATTEMPTS}, {_POOL} SELECT domain, count(*) AS attempts, count(DISTINCT session) AS sessions, count(*) FILTER (health = 'retired') AS retired, sum(session * n)::BIGINT AS signature FROM r WHERE n > 0 GROUP BY 1")
def session_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions used by each domain; the signature adds up session times place over all attempts."""
    attempts = _attempts(spark, sf_dir)
    from pyspark.sql import Window

    places = attempts.select("attempt_id", F.row_number().over(Window.partitionBy("domain").orderBy("occurred_at", "attempt_id")).alias("n"))
    rows = pools.session_assignments(attempts).join(places, "attempt_id")
    return rows.groupBy("domain").agg(F.count(F.lit(1)).alias("attempts"), F.count_distinct("session").alias("sessions"), F.count_if(F.col("session_health") == "retired").alias("retired"), F.sum(F.col("session") * F.col("n")).alias("signature"))


@register(
    f"""WITH RECURSIVE {_ATTEMPTS}, p AS (SELECT run_id, final_result = 'SUCCESS' AS ok, row_number() OVER (PARTITION BY run_id ORDER BY occurred_at, attempt_id) AS n FROM a),
    r AS (SELECT DISTINCT run_id, 0::BIGINT AS n, 0 AS nxt, 0 AS f0, 0 AS f1, 0 AS f2, NULL::INTEGER AS proxy FROM p
      UNION ALL
      SELECT run_id, n, CASE WHEN slot IS NULL THEN nxt ELSE (slot + 1) % 3 END, CASE WHEN slot = 0 THEN CASE WHEN ok THEN 0 ELSE f0 + 1 END ELSE f0 END,
        CASE WHEN slot = 1 THEN CASE WHEN ok THEN 0 ELSE f1 + 1 END ELSE f1 END, CASE WHEN slot = 2 THEN CASE WHEN ok THEN 0 ELSE f2 + 1 END ELSE f2 END, slot
      FROM (SELECT r.* EXCLUDE (n, proxy), p.n, p.ok, CASE WHEN [f0, f1, f2][nxt + 1] < 3 THEN nxt WHEN [f0, f1, f2][(nxt + 1) % 3 + 1] < 3 THEN (nxt + 1) % 3 WHEN [f0, f1, f2][(nxt + 2) % 3 + 1] < 3 THEN (nxt + 2) % 3 END AS slot
            FROM r JOIN p ON p.run_id = r.run_id AND p.n = r.n + 1))
    SELECT run_id, coalesce(proxy, -1)::BIGINT AS proxy, count(*) AS attempts FROM r WHERE n > 0 GROUP BY ALL"""
)
def proxy_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts of each of three proxies in a run; -1 is a direct connection, once all are quarantined."""
    rows = pools.proxy_assignments(_attempts(spark, sf_dir), 3)
    return rows.groupBy("run_id", F.coalesce("proxy", F.lit(-1)).alias("proxy")).agg(F.count(F.lit(1)).alias("attempts"))
