"""Registered queries of small operators: formats, classifications, counts and variants. They are added
to the catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions import text as tx
from quillmesh.functions import urls
from quillmesh.operators import artifacts, evidence, exports, ledger, retrieval
from quillmesh.plans.catalogue import _ATTEMPTS, _TYPED, _attempts, _typed, register, table
from quillmesh.storage import new_path


@register("SELECT cast(cast(ts AS DATE) AS VARCHAR) AS run_id, event_type AS decision_type, count(*) AS decisions FROM events GROUP BY ALL")
def decision_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("ts").cast("date").cast("string").alias("run_id"), F.col("event_type").alias("decision_type"))
    return ledger.decision_counts(rows)


@register(f"SELECT page_id, CASE content_type WHEN 'application/json' THEN '.json' WHEN 'application/pdf' THEN '.pdf' WHEN 'text/plain' THEN '.txt' ELSE '.bin' END AS extension FROM ({_TYPED})")
def file_extensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(spark, sf_dir).select("page_id", urls.extension(F.col("content_type")).alias("extension"))


_SHOWN = "regexp_replace(printf('%.1f', round({0}, 1)), '\\.0$', '')"


@register(
    f"""WITH s AS (SELECT o_orderkey, o_orderkey * o_orderkey * 7 AS n FROM orders)
    SELECT o_orderkey, CASE WHEN n = 0 THEN '0 B' WHEN n >= 1073741824 THEN {_SHOWN.format('n / 1073741824.0')} || ' GB' WHEN n >= 1048576 THEN {_SHOWN.format('n / 1048576.0')} || ' MB'
      WHEN n >= 1024 THEN {_SHOWN.format('n / 1024.0')} || ' KB' ELSE n || ' B' END AS shown FROM s"""
)
def byte_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes from nothing to gigabytes, made of order keys."""
    return table(spark, sf_dir, "orders").select("o_orderkey", tx.byte_text(F.col("o_orderkey") * F.col("o_orderkey") * 7).alias("shown"))


@register("SELECT o_orderkey, (o_totalprice / 100)::INTEGER // 60 || 'm ' || (o_totalprice / 100)::INTEGER % 60 || 's' AS shown FROM (SELECT o_orderkey, floor(o_totalprice / 100) * 100 AS o_totalprice FROM orders)")
def duration_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices in hundreds as seconds."""
    return table(spark, sf_dir, "orders").select("o_orderkey", tx.duration_text(F.col("o_totalprice") / 100).alias("shown"))


@register("""SELECT page_id, md5(replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#39;')) AS escaped_md5, md5(replace(html, '</', '<\\/')) AS in_script_md5 FROM pages""")
def escaped_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    return table(spark, sf_dir, "pages").select("page_id", F.md5(tx.html_escaped(html)).alias("escaped_md5"), F.md5(tx.json_in_html(html)).alias("in_script_md5"))


@register("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE '.' || lpad((microsecond(ts) % 1000000)::VARCHAR, 6, '0') END || '+00:00' AS stamp FROM events")
def iso_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.regexp_replace(tx.iso_text(F.col("ts").cast("timestamp")), "Z$", "+00:00").alias("stamp"))


@register("SELECT page_id, CASE WHEN starts_with(url, 'https://') THEN substr(url, 8) ELSE url END AS place FROM pages")
def portable_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What lies below a folder, here below https:/, loses it."""
    return table(spark, sf_dir, "pages").select("page_id", exports.portable_path(F.col("url"), F.lit("https://")).alias("place"))


_DECLARED = "CASE page_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'no number' WHEN 2 THEN '999999999' ELSE strlen(html)::VARCHAR END"


@register(f"SELECT page_id FROM pages WHERE coalesce(try_cast({_DECLARED} AS BIGINT), 0) <= 6000 AND strlen(html) <= 6000")
def bounded_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages within a limit by their declared length, if that is a number, and by their actual one."""
    size = F.octet_length("html")
    declared = F.when(F.col("page_id") % 4 == 1, "no number").when(F.col("page_id") % 4 == 2, "999999999").when(F.col("page_id") % 4 == 3, size.cast("string"))
    rows = table(spark, sf_dir, "pages").select("page_id", declared.alias("content_length"), F.encode("html", "utf-8").alias("content"))
    return artifacts.within_limit(rows, 6000).select("page_id")


@register(
    """SELECT CASE WHEN page_id % 2 = 0 THEN 'acquisition_failed' WHEN page_id % 3 = 0 THEN 'unsupported_content' WHEN page_id % 5 = 0 THEN 'duplicate_content' WHEN page_id % 7 = 0 THEN 'extraction_failed' ELSE 'acquired' END AS outcome,
    count(*) AS pages FROM pages GROUP BY 1"""
)
def url_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = lambda n: F.col("page_id") % n == 0
    return table(spark, sf_dir, "pages").groupBy(ledger.page_outcome(~by(2), ~by(3), by(5), ~by(7)).alias("outcome")).agg(F.count(F.lit(1)).alias("pages"))


@register(
    f"""WITH {_ATTEMPTS}, n AS (SELECT run_id, count(*) AS n, count(*) FILTER (final_result = 'SUCCESS') AS ok, max(attempt_id) % 2 = 1 AS interrupted FROM a GROUP BY 1)
    SELECT run_id, CASE WHEN interrupted THEN 'INTERRUPTED' WHEN ok = 0 THEN 'FAILED' WHEN ok = n THEN 'SUCCESS' ELSE 'PARTIAL' END AS status FROM n"""
)
def interrupted_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs whose last attempt has an odd number were interrupted."""
    runs = _attempts(spark, sf_dir).groupBy("run_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("final_result") == "SUCCESS").alias("ok"), (F.max("attempt_id") % 2 == 1).alias("interrupted"))
    return runs.select("run_id", ledger.run_status(F.col("n"), F.col("ok"), F.col("interrupted")).alias("status"))


@register("SELECT o_custkey, sum(o_orderkey)::DOUBLE / nullif(count(*) FILTER (o_orderstatus = 'F'), 0) AS a_unit FROM orders GROUP BY 1")
def time_per_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys stand for times; without units there is no ratio."""
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sum("o_orderkey").alias("t"), F.count_if(F.col("o_orderstatus") == "F").alias("n"))
    return rows.select("o_custkey", tx.per_unit(F.col("t"), F.col("n")).alias("a_unit"))


@register("SELECT l_orderkey, l_linenumber, printf('x0=%.2f,y0=%.2f,x1=%.2f,y1=%.2f', l_linenumber * 0.25::DOUBLE, l_orderkey::DOUBLE, l_linenumber + 0.5::DOUBLE, l_orderkey + 0.75::DOUBLE) AS place FROM lineitem")
def location_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", evidence.location(line * 0.25, key.cast("double"), line + 0.5, key + 0.75).alias("place"))


@register(
    """SELECT CASE WHEN r.n = 0 THEN 'none' ELSE r.events END AS events, s.source FROM (SELECT DISTINCT source FROM documents) s
    JOIN (SELECT source, count(l.doc_id) AS n, string_agg(d.doc_id || ':' || quality, ',' ORDER BY d.doc_id) FILTER (l.doc_id IS NOT NULL) AS events FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY source) r ON r.source IS NOT DISTINCT FROM s.source"""
)
def artifact_event_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each artifact (source) with its events (labelled documents) in order, also those without any."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    events = F.array_sort(F.collect_list(F.when(F.col("quality").isNotNull(), F.struct("doc_id", "quality"))))
    shown = F.array_join(F.transform("events", lambda e: F.concat(e["doc_id"], F.lit(":"), e["quality"])), ",")
    return docs.groupBy("source").agg(events.alias("events")).select(F.when(F.size("events") == 0, "none").otherwise(shown).alias("events"), "source")


@register(
    """SELECT CASE WHEN props IS NULL THEN NULL WHEN json_type(props, '$.k') IN ('UBIGINT', 'BIGINT') THEN 'OBJECT<k: BIGINT>' ELSE json_type(props, '$.k') END AS shape, count(*) AS events, sum(json_extract(props, '$.k')::BIGINT)::BIGINT AS k,
    count(*) FILTER (json_extract_string(props, '$.missing') IS NULL) AS missing FROM events GROUP BY 1"""
)
def source_rows_as_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties of any shape kept as a variant: types stay what they are, absent fields are null."""
    rows = table(spark, sf_dir, "events").select(F.try_parse_json("props").alias("v"))
    k, absent = F.variant_get("v", "$.k", "bigint"), F.variant_get("v", "$.missing", "string").isNull()
    return rows.groupBy(F.schema_of_variant("v").alias("shape")).agg(F.count(F.lit(1)).alias("events"), F.sum(k).alias("k"), F.count_if(absent).alias("missing"))


@register("SELECT count(*) AS n_rows, count(DISTINCT page_id) AS ids, sum(CASE WHEN starts_with(raw_location, 'raw/') THEN 1 ELSE 0 END)::BIGINT AS below FROM (SELECT page_id, 'raw/' || page_id AS raw_location FROM pages)")
def handed_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artifacts handed to the next program as JSON lines, read back."""
    rows = table(spark, sf_dir, "pages").select(F.col("page_id").alias("artifact_id"), F.col("url").alias("source_url"), F.concat(F.lit("/runs/1/raw/"), "page_id").alias("raw_location"), F.lit("s").alias("session_id"))
    path = new_path(spark, "handed-over")
    exports.hand_off(rows, "/runs/1", path)
    back = spark.read.json(path)
    if "session_id" in back.columns:
        raise AssertionError("sessions stay behind")
    return back.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("artifact_id").alias("ids"), F.count_if(F.startswith("raw_location", F.lit("raw/"))).alias("below"))


@register(
    """WITH s AS (SELECT q.vec_id AS query_id, t.vec_id AS target_id, round(list_cosine_similarity(q.embedding::DOUBLE[], t.embedding::DOUBLE[]), 9) AS s FROM embeddings q JOIN embeddings t ON q.vec_id <> t.vec_id AND q.vec_id % 100 = 0),
    r AS (SELECT query_id, target_id, round(s, 6) AS s FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY s.s DESC, target_id) <= 3)
    SELECT query_id, 'hashed-64' AS model_identifier, 3::BIGINT AS top_k, string_agg(target_id, ',' ORDER BY s DESC, target_id) AS targets, round(sum(1 - s), 5) AS distances FROM r GROUP BY query_id"""
)
def retrieval_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked hits written as JSON lines with model and k, read back."""
    every = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    path = new_path(spark, "retrieval")
    exports.write_retrieval({"few_to_all": retrieval.top_k(every.where("vec_id % 100 = 0"), every, 3)}, path, "hashed-64", 3)
    back = spark.read.json(f"{path}/few_to_all")
    targets = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "target_id"))), lambda x: x["target_id"].cast("string")), ",")
    return back.groupBy("query_id", "model_identifier", "top_k").agg(targets.alias("targets"), F.round(F.sum("distance"), 5).alias("distances"))
