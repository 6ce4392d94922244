"""Ledger tables, run states, pools, files and packages on literal rows."""

import json

import pytest
from pyspark.sql import functions as F

from quillmesh.functions import text as tx
from quillmesh.operators import artifacts, exports, ledger, pools
from quillmesh.sources import files

ATTEMPT = "run_id int, url string, domain string, occurred_at long, attempt_id long, final_result string, acquisition_method string"


def attempts(spark, results, domain="d"):
    rows = [(1, f"http://{domain}/{i}", domain, i, i, r, "http") for i, r in enumerate(results)]
    return spark.createDataFrame(rows, ATTEMPT)


def test_ledger_appends_and_ordered_reads(spark, tmp_path):
    path = str(tmp_path / "attempts")
    rows = attempts(spark, ["SUCCESS", "TIMEOUT"])
    ledger.append(rows.where("attempt_id = 1"), path)
    ledger.append(rows.where("attempt_id = 0"), path)
    ledger.append(rows.withColumn("run_id", F.lit(2)), path)
    assert [r.attempt_id for r in ledger.of_run(spark.read.parquet(path), 1).collect()] == [0, 1]
    with pytest.raises(ValueError, match="the table at"):
        ledger.append(rows.drop("domain"), path)


def test_sessions_are_retired_and_minted(spark):
    """Four sessions, then turns; the one that fails three times goes and the turn starts anew."""
    results = ["SUCCESS"] * 4 + ["TIMEOUT", "SUCCESS", "SUCCESS", "SUCCESS"] * 3 + ["SUCCESS", "NOT_FOUND", "SUCCESS"]
    got = [(r.session, r.session_health) for r in pools.session_assignments(attempts(spark, results)).orderBy("attempt_id").collect()]
    assert [s for s, _ in got[:12]] == [0, 1, 2, 3] * 3
    assert got[12] == (0, "retired")  # its third failure in a row
    # a fifth session fills the pool, and the turn begins at the oldest again
    assert [s for s, _ in got[13:]] == [4, 1, 2, 3, 4, 1]


def test_proxies_skip_quarantine(spark):
    results = ["TIMEOUT", "SUCCESS"] * 3 + ["SUCCESS", "SUCCESS"] + ["TIMEOUT"] * 4
    got = [(r.proxy, r.proxy_health) for r in pools.proxy_assignments(attempts(spark, results), 2).orderBy("attempt_id").collect()]
    assert got[:6] == [(0, "unhealthy"), (1, "healthy"), (0, "unhealthy"), (1, "healthy"), (0, "quarantined"), (1, "healthy")]
    assert got[6:] == [(1, "healthy"), (1, "healthy"), (1, "unhealthy"), (1, "unhealthy"), (1, "quarantined"), (None, None)]
    assert pools.proxy_assignments(attempts(spark, ["SUCCESS"]), 0).first().proxy is None


def test_escalation_keeps_the_retry_number(spark):
    rows = ledger.with_retry_numbers(attempts(spark, ["SUCCESS", "TIMEOUT"]))
    got = [(r.attempt_id, r.step, r.acquisition_method, r.final_result, r.failure_classification, r.adaptive_decision, r.retry_number) for r in ledger.escalated(rows, F.lit(True), F.lit("SUCCESS")).orderBy("attempt_id", "step").collect()]
    assert got == [(0, 0, "http", "PENDING_RETRY", "escalated_to_browser", "method_escalated", 0), (0, 1, "browser", "SUCCESS", None, None, 0), (1, 0, "http", "TIMEOUT", None, None, 0)]


def test_redirects_keep_their_order(spark):
    hops = spark.createDataFrame([("k", 1, "http://b", 302), ("k", 0, "http://a", 301)], "key string, hop int, url string, status int")
    chain = ledger.redirect_chains(hops)
    assert chain.first().final_url == "http://b"
    assert [tuple(r) for r in ledger.redirect_hops(chain).collect()] == [("k", 0, "http://a", 301), ("k", 1, "http://b", 302)]


def test_run_states(spark):
    rows = [(1, 1, "acquisition", "failed", "x"), (1, 2, "completion", "succeeded", None), (2, 1, "completion", "succeeded", None), (2, 3, "extraction", "failed", "y"), (3, 1, "acquisition", "succeeded", None)]
    df = spark.createDataFrame(rows, "run_id int, event_id int, event_type string, status string, error_message string")
    assert sorted(tuple(r) for r in ledger.run_states(df).collect()) == [(1, "succeeded", None), (2, "failed", "y"), (3, "running", None)]


def test_sorts_put_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 7)], "id int, v int")
    assert [r.id for r in ledger.sorted_by(df, "v").collect()] == [2, 3, 1]
    assert [r.id for r in ledger.sorted_by(df, "v", descending=True).collect()] == [3, 2, 1]
    assert [(r.final_result, r.failures) for r in ledger.failure_counts(attempts(spark, ["A", "B", "B", "SUCCESS"])).collect()] == [("B", 2), ("A", 1)]
    assert [r.attempt_id for r in ledger.failures(attempts(spark, ["B", "A", "SUCCESS", "B"])).collect()] == [1, 0, 3]


def test_crawl_counts(spark):
    df = spark.createDataFrame([(1, "a", True), (1, "a", False), (1, "b", False)], "run_id int, url string, acquired boolean")
    assert tuple(ledger.crawl_counts(df).first()) == (1, 2, 1, 1)


def test_lookups(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x")], "id int, sha string")
    assert artifacts.find(df, ["id"], sha="x").first().id == 1 and artifacts.find(df, ["id"], sha="y").isEmpty()
    with pytest.raises(LookupError):
        artifacts.find(df, ["id"], required=True, sha="y")


def test_files_beyond_the_limit_are_rows_with_an_error(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_bytes(b"abc")
    (tmp_path / "in" / "b").write_bytes(b"x" * 50)
    got = {r.source_url[-1]: r for r in files.read_files(spark, str(tmp_path / "in"), 10).collect()}
    assert bytes(got["a"].content) == b"abc" and got["a"].error_message is None
    assert got["b"].content is None and got["b"].error_message == "file size 50 exceeds the 10-byte limit"


def test_table_stats(spark, tmp_path):
    spark.range(10).repartition(2).write.parquet(str(tmp_path / "t"))
    row = files.table_stats({"t": spark.read.parquet(str(tmp_path / "t"))}).first()
    assert (row.table, row.rows, row.files) == ("t", 10, 2) and row.bytes > 0


def test_json_is_safe_in_html(spark):
    assert spark.range(1).select(tx.json_in_html(F.lit('{"a":"</script>"}'))).first()[0] == '{"a":"<\\/script>"}'


def test_source_packages(spark, tmp_path):
    rows = spark.createDataFrame([(1, "s1", "text/html", "/raw/s1"), (2, "s2", "application/pdf", "/raw/s2")], "artifact_id long, sha256 string, content_type string, raw_location string")
    events = spark.createDataFrame([(12, "acquisition", "succeeded", 1, "u2"), (11, "acquisition", "succeeded", 1, "u1"), (13, "extraction", "failed", 1, "u1"), (14, "acquisition", "failed", None, "u3"), (15, "discovery", "failed", None, "u4"), (16, "acquisition", "succeeded", 2, "u5")], "event_id long, event_type string, status string, artifact_id long, source_url string")
    evidence = spark.createDataFrame([(1, "text", "c")], "artifact_id long, evidence_type string, claim string")
    raw = spark.createDataFrame([("s1", b"<p>")], "checksum string, content binary")
    got = {r.artifact_id: r for r in exports.write_sources(rows, events, evidence, raw, str(tmp_path / "out")).collect()}
    assert [json.loads(e)["source_url"] for e in got[1].source_urls] == ["u1", "u2"] and len(got[1].extraction_events) == 1
    assert got[1].original_artifact.filename == "original.html" and got[1].extraction_status == "succeeded"
    assert tuple(got[2].original_artifact) == (False, None, "raw artifact file not found at /raw/s2") and got[2].evidence_count == 0
    assert (tmp_path / "out" / "source" / "artifact_id=2").is_dir() and spark.read.parquet(str(tmp_path / "out" / "original")).count() == 1
    assert [r.event_id for r in exports.failed_and_rejected(events).collect()] == [14, 15]
    assert [r.artifact_id for r in exports.exported_artifacts(events).collect()] == [1, 2]


def test_retrieval_files(spark, tmp_path):
    hits = spark.createDataFrame([(1, 2, 9, 0.5), (1, 1, 8, 0.75)], "query_id long, rank int, target_id long, similarity double")
    exports.write_retrieval({"evidence_to_kpi_A": hits, "kpi_to_evidence_B": hits}, str(tmp_path), "m", 10)
    rows = spark.read.json(str(tmp_path / "evidence_to_kpi_A")).orderBy("rank").collect()
    assert [(r["rank"], r.distance, r.model_identifier, r.top_k) for r in rows] == [(1, 0.25, "m", 10), (2, 0.5, "m", 10)]
    assert spark.read.json(str(tmp_path / "kpi_to_evidence_B")).count() == 2
