"""Stored tables, budgets, packages and raw files: what is there after repeats, failures and writers at once."""

import glob
import gzip
import hashlib
import json
import os
import random
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quillmesh.operators import packages, running, stored
from quillmesh.plans import state
from quillmesh.sources import links, raw_files

# --- budgets ------------------------------------------------------------------------------------


@pytest.mark.parametrize("runs,whole", [(1, True), (1, False), (7, True), (7, False)])
def test_budgets_of_one_run_and_of_several(spark, runs, whole):
    rng = random.Random(runs)
    rows = [(rng.choice([None, *range(1, runs)]) if runs > 1 else 0, i, rng.choice([0, 0, 1, 5, None])) for i in range(500)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "run long, at long, size long").repartition(5)
    got = {(r["at"]): (r.used_size, r.accepted) for r in running.within_budget(df, ["run"], ["at"], "size", 40, whole=whole).collect()}
    used = {}
    for run, at, size in sorted(rows, key=lambda r: r[1]):
        before = used.get(run, 0)
        used[run] = before + (size or 0)
        assert got[at] == (used[run], used[run] <= 40 if whole else before < 40)
    assert len(got) == 500


def test_running_sums_without_keys_are_the_work_of_several_tasks(spark):
    rows = spark.range(10_000).select("id", (F.col("id") % 3).alias("a"), F.lit(2).alias("b"))
    got = running.running_sums(rows, [], ["id"], ["a", "b"])
    assert got.where("used_b <> 2 * (id + 1)").count() == 0
    assert got.agg(F.max("used_a")).first()[0] == sum(i % 3 for i in range(10_000))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so little would be put together
    try:
        got = running.running_sums(rows, [], ["id"], ["a", "b"])
        assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 1
        assert got.where("used_b <> 2 * (id + 1)").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert running.running_sums(rows.limit(0), ["a"], ["id"], ["b"]).count() == 0


# --- upserts ------------------------------------------------------------------------------------

KPIS = "code string, version long, text string"


def files_by_bucket(path):
    return {Path(p).name: {(f, os.stat(f).st_mtime_ns) for f in glob.glob(f"{p}/*.parquet")} for p in glob.glob(f"{path}/bucket_of_*")}


def test_upserts_rewrite_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "kpis")
    put = lambda rows: stored.upsert(spark.createDataFrame(rows, KPIS), path, ["code"], ["version"], buckets=16)
    want = {f"k{i}": (1, "first") for i in range(200)}
    assert put([(k, *v) for k, v in want.items()] + [("k0", 0, "older change of the same batch")]) == list(range(16))
    for changes in ([("k7", 2, "second")], [("k7", 1, "last write wins, whatever its version"), ("new", 1, "x")], [(None, 1, "null is a key")], [(None, 1, "null is a key")]):
        before = files_by_bucket(path)
        touched = put(changes)
        after = files_by_bucket(path)
        assert 1 <= len(touched) <= 2
        assert {b for b in after if before.get(b) != after[b]} == {f"bucket_of_16={t}" for t in touched}
        want |= {k: (v, t) for k, v, t in changes}
        assert {r.code: (r.version, r.text) for r in stored.read_table(spark, path).collect()} == want
        assert stored.read_table(spark, path).count() == len(want)
    assert put([]) == []


def test_upserts_refuse_other_tables(spark, tmp_path):
    path = str(tmp_path / "kpis")
    stored.upsert(spark.createDataFrame([("a", 1, "x")], KPIS), path, ["code"], ["version"], buckets=4)
    with pytest.raises(ValueError, match="doesn't have 8 buckets"):
        stored.upsert(spark.createDataFrame([("a", 1, "x")], KPIS), path, ["code"], ["version"], buckets=8)
    with pytest.raises(ValueError, match="has"):
        stored.upsert(spark.createDataFrame([("a", 1)], "code string, version long"), path, ["code"], ["version"], buckets=4)
    assert stored.read_table(spark, path).count() == 1


# --- appends ------------------------------------------------------------------------------------

ATTEMPTS = "attempt_id long, result string"


def attempts(spark, *rows):
    return spark.createDataFrame(list(rows), ATTEMPTS)


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert stored.append_once(attempts(spark, (1, "A"), (2, "B")), path, "w", 0, ["attempt_id"])
    assert not stored.append_once(attempts(spark, (1, "A"), (2, "B")), path, "w", 0, ["attempt_id"])
    # the number is taken, whatever it holds now
    assert not stored.append_once(attempts(spark, (9, "Z")), path, "w", 0, ["attempt_id"])
    # of rows that another writer has stored only the new ones are added
    assert stored.append_once(attempts(spark, (2, "B"), (3, None), (3, None)), path, "v", 0, ["attempt_id"])
    assert not stored.append_once(attempts(spark, (2, "B")), path, "v", 1, ["attempt_id"])
    assert sorted(tuple(r) for r in stored.read_ledger(spark, path).collect()) == [(1, "A"), (2, "B"), (3, None)]


def test_stored_rows_are_immutable(spark, tmp_path):
    path = str(tmp_path / "ledger")
    stored.append_once(attempts(spark, (1, "A"), (2, None)), path, "w", 0, ["attempt_id"])
    for changed in ((1, "B"), (1, None), (2, "A")):
        with pytest.raises(ValueError, match="never changed"):
            stored.append_once(attempts(spark, changed, (5, "new")), path, "w", 1, ["attempt_id"])
    with pytest.raises(ValueError, match="different rows"):
        stored.append_once(attempts(spark, (7, "A"), (7, "B")), path, "w", 1, ["attempt_id"])
    with pytest.raises(ValueError, match="has"):
        stored.append_once(spark.createDataFrame([(8, 1)], "attempt_id long, result long"), path, "w", 1, ["attempt_id"])
    with pytest.raises(ValueError, match="name of a writer"):
        stored.append_once(attempts(spark, (8, "A")), path, "../w", 1, ["attempt_id"])
    assert stored.read_ledger(spark, path).count() == 2


def test_writers_at_once_keep_out_of_each_others_way(spark, tmp_path):
    path = str(tmp_path / "ledger")
    stored.append_once(attempts(spark, (0, "first")), path, "start", 0, ["attempt_id"])
    jobs = [(w, b, attempts(spark, *[(100 * w + 10 * b + i + 1, f"{w}") for i in range(5)])) for w in range(3) for b in range(2)]
    with ThreadPoolExecutor(6) as pool:
        assert all(pool.map(lambda j: stored.append_once(j[2], path, f"writer{j[0]}", j[1], ["attempt_id"]), jobs))
    rows = stored.read_ledger(spark, path).collect()
    assert len(rows) == 31 and len({r.attempt_id for r in rows}) == 31


def test_a_stream_that_lost_its_checkpoint_adds_nothing_twice(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "ledger")
    schema = "attempt_id long, result string"

    def run(checkpoint):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(source))
        stored.ledger_sink(stream, path, "crawl", str(tmp_path / checkpoint), ["attempt_id"]).trigger(availableNow=True).start().awaitTermination()

    source.mkdir()
    for i in range(3):
        (source / f"{i}.json").write_text("".join(f'{{"attempt_id": {10 * i + j}, "result": "r"}}\n' for j in range(4)))
    run("c1")
    assert stored.read_ledger(spark, path).count() == 12
    run("c2")  # all batches again
    assert stored.read_ledger(spark, path).count() == 12
    (source / "3.json").write_text('{"attempt_id": 99, "result": "late"}\n')
    run("c1")
    assert stored.read_ledger(spark, path).count() == 13


# --- packages -----------------------------------------------------------------------------------


@pytest.fixture()
def crawl(spark):
    runs = spark.createDataFrame([(1, "http://a/", "succeeded", None), (2, "http://b/", "failed", "disk full")], "run_id long, root_source_url string, status string, error_message string")
    events = [(1, 1, "acquisition", "succeeded", "http://a/1", None, 10), (1, 2, "extraction", "succeeded", "http://a/1", None, 10), (1, 3, "acquisition", "succeeded", "http://a/2", None, 11), (1, 4, "acquisition", "failed", "http://a/3", "timeout", None), (1, 5, "discovery", "failed", "http://x/", "off-host", None), (1, 6, "acquisition", "succeeded", "http://a/1", None, 10), (2, 7, "acquisition", "succeeded", "http://b/1", None, 12)]
    events = spark.createDataFrame(events, "run_id long, event_id long, event_type string, status string, source_url string, error_message string, artifact_id long")
    rows = spark.createDataFrame([(10, "text/html"), (11, None), (12, "text/html")], "artifact_id long, content_type string")
    evidence = spark.createDataFrame([(10, "a: 1"), (10, "b: 2"), (12, "c")], "artifact_id long, claim string")
    return runs, events, rows, evidence


def test_a_package_has_one_manifest(spark, tmp_path, crawl):
    m = packages.export_run(1, *crawl, str(tmp_path)).first()
    assert (m.run.id, m.run.root_source_url, m.run.status, m.run.error_message) == (1, "http://a/", "succeeded", None) and m.exported_at
    assert m.summary.asDict() == {"resources_discovered": 4, "resources_acquired": 3, "resources_rejected_or_failed": 2, "distinct_sources_exported": 2, "extraction_succeeded": 1, "extraction_no_evidence": 1, "evidence_total": 2, "artifacts_by_type": {"text/html": 1, "unknown": 1}}
    sources = {r.artifact_id: r for r in spark.read.json(f"{tmp_path}/run-1/sources").collect()}
    assert [u.event_id for u in sources[10].source_urls] == [1, 6] and sources[11].extraction_status == "no_evidence" and set(sources) == {10, 11}
    assert spark.read.json(f"{tmp_path}/run-1/evidence").count() == 2
    assert [r.event_id for r in spark.read.json(f"{tmp_path}/run-1/rejected").orderBy("branch", "event_id").collect()] == [4, 5]
    assert sorted(os.listdir(tmp_path)) == ["run-1"]


def test_a_repeated_export_replaces_the_package(spark, tmp_path, crawl):
    packages.export_run(1, *crawl, str(tmp_path))
    (tmp_path / "run-1" / "stray").write_text("x")
    packages.export_run(1, *crawl, str(tmp_path))
    assert sorted(os.listdir(tmp_path)) == ["run-1"] and not (tmp_path / "run-1" / "stray").exists()


def test_a_failed_export_leaves_what_was_there(spark, tmp_path, crawl, monkeypatch):
    runs, events, rows, evidence = crawl
    packages.export_run(1, *crawl, str(tmp_path))
    before = packages.read_manifest(spark, f"{tmp_path}/run-1").first().exported_at
    broken = evidence.withColumn("claim", F.raise_error(F.lit("no disk")))
    with pytest.raises(Exception, match="no disk"):
        packages.export_run(1, runs, events, rows, broken, str(tmp_path))
    assert sorted(os.listdir(tmp_path)) == ["run-1"] and packages.read_manifest(spark, f"{tmp_path}/run-1").first().exported_at == before
    with pytest.raises(Exception, match="no disk"):
        packages.export_run(2, runs, events, rows, broken, str(tmp_path))
    assert sorted(os.listdir(tmp_path)) == ["run-1"]
    with pytest.raises(LookupError):
        packages.export_run(3, *crawl, str(tmp_path))


def test_evidence_of_a_package_takes_little_disk(spark, tmp_path, crawl):
    runs, events, rows, _ = crawl
    evidence = spark.range(200_000).select((F.lit(10) + F.col("id") % 2).alias("artifact_id"), (F.col("id") * 7).alias("claim")).repartition(6)
    m = packages.export_run(1, runs, events, rows, evidence, str(tmp_path)).first()
    files = sorted((tmp_path / "run-1" / "evidence").glob("part-*"))
    assert m.summary.evidence_total == 200_000 and spark.read.json(f"{tmp_path}/run-1/evidence").distinct().count() == 200_000
    assert len(files) == 6 and sum(f.stat().st_size for f in files) < 10 * 200_000
    for f in files:
        own = [json.loads(line)["artifact_id"] for line in gzip.decompress(f.read_bytes()).splitlines()]
        assert own == sorted(own)


def test_evidence_is_neither_shuffled_nor_written_at_length(spark, tmp_path, crawl):
    """Claims that many artifacts share take less than a byte a line, and no join deals them out anew,
    whatever its statistics say."""
    runs, _, _, _ = crawl
    events = spark.range(400).selectExpr("1L AS run_id", "id AS event_id", "'acquisition' AS event_type", "'succeeded' AS status", "concat('u', id) AS source_url", "cast(null AS string) AS error_message", "id AS artifact_id")
    rows = spark.range(500).select(F.col("id").alias("artifact_id"), F.lit("text/html").alias("content_type"))
    evidence = spark.range(500, numPartitions=5).select((F.col("id") * 7 % 500).alias("artifact_id"), F.explode(F.expr("transform(sequence(1, 900), i -> i * 7919 % 100003)")).alias("claim"))
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        m = packages.export_run(1, runs, events, rows, evidence, str(tmp_path), packages.ZSTD).first()
    finally:
        spark.conf.set(setting, before)
    files = sorted((tmp_path / "run-1" / "evidence").glob("part-*"))
    assert len(files) == 5 and sum(f.stat().st_size for f in files) < 360_000
    found = spark.read.json(f"{tmp_path}/run-1/evidence")
    assert m.summary.evidence_total == found.count() == found.distinct().count() == spark.read.text(f"{tmp_path}/run-1/evidence").count() == 360_000
    assert found.agg(F.max("artifact_id")).first()[0] == 399


def test_pairs_of_evidence_are_whole_in_any_number_of_parts(spark, monkeypatch):
    monkeypatch.setattr(state, "EVIDENCE_A_TASK", 1000)
    own, claims = (spark.range(n).select(F.col("id").alias(key), (F.col("id") % 3).alias("nation")) for n, key in ((60, "artifact_id"), (3000, "c_custkey")))
    found = state._evidence(own, claims)
    assert found.distinct().count() == found.count() == 60_000 and found.where("artifact_id % 3 <> nation OR c_custkey % 3 <> nation").isEmpty()
    assert found.groupBy(F.spark_partition_id()).count().count() > 3
    assert state._evidence(own.limit(0), claims).isEmpty()


# --- raw files ----------------------------------------------------------------------------------


def test_raw_files_round_trip(spark, tmp_path):
    contents = [b"", b"\x00\xff" * 1000, "é".encode(), b"{}", b"%PDF-1.4"]
    kinds = ["text/html", None, "text/html", "application/json", "application/pdf"]
    rows = [(f"http://a/{i % 5}", kinds[i % 5], contents[i % 5]) for i in range(20)] + [("http://a/none", "text/html", None)]
    df = spark.createDataFrame(rows, "source_url string, content_type string, content binary").repartition(4)
    raw_files.write_files(df, str(tmp_path / "raw"))
    got = {(r.category, r.checksum): bytes(r.content) for r in raw_files.read_files(spark, str(tmp_path / "raw")).collect()}
    folder = ["html", "other", "html", "json", "pdf"]
    assert got == {(folder[i], hashlib.sha256(c).hexdigest()): c for i, c in enumerate(contents) if c}
    assert (tmp_path / "raw" / "html" / f"{hashlib.sha256(b'').hexdigest()}.raw").read_bytes() == b""
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "raw").rglob("*.raw")}
    assert all(hashlib.sha256(p.read_bytes()).hexdigest() == p.stem for p in files)
    more = df.unionByName(spark.createDataFrame([("http://a/x", "text/html", b"new")], df.schema))
    raw_files.write_files(more, str(tmp_path / "raw"))
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "raw").rglob("*.raw")}
    assert files.items() <= after.items() and len(after) == len(files) + 1
    assert not list((tmp_path / "raw").glob(".staging*"))


@pytest.mark.parametrize("category,checksum,content", [("html", "../../escape", b"x"), ("../up", hashlib.sha256(b"x").hexdigest(), b"x"), ("html", hashlib.sha256(b"y").hexdigest(), b"x"), ("html", None, b"x")])
def test_an_aborted_write_leaves_no_file(spark, tmp_path, category, checksum, content):
    good = [("html", hashlib.sha256(str(i).encode()).hexdigest(), str(i).encode()) for i in range(8)]
    spark.dataSource.register(raw_files.RawFiles)
    df = spark.createDataFrame([*good, (category, checksum, content)], "category string, checksum string, content binary").repartition(3)
    with pytest.raises(Exception, match="checksum"):
        df.write.format("raw_files").mode("append").save(str(tmp_path / "raw"))
    assert not [p for p in tmp_path.rglob("*") if p.is_file()]


def test_damaged_raw_files_are_noticed(spark, tmp_path):
    raw_files.write_files(spark.createDataFrame([("u", "text/html", b"abc")], "source_url string, content_type string, content binary"), str(tmp_path))
    next(tmp_path.rglob("*.raw")).write_bytes(b"abd")
    with pytest.raises(Exception, match="damaged"):
        raw_files.read_files(spark, str(tmp_path)).collect()


# --- links --------------------------------------------------------------------------------------


def test_links_as_a_table_function(spark):
    html = '<a href=" /one#x ">1</a><A HREF=\'/one\'>again</A><link rel="next" href="?p=2"><link rel="icon stylesheet" href="i.ico"/><a href="mailto:a@b">m</a><a href="//other/x">o</a><a name="y">n</a><a href="/%zz&amp;b">e</a>'
    sitemap = '<u:urlset xmlns:u="x"><u:url><u:loc> /s1 </u:loc></u:url><u:loc/></u:urlset>'
    rows = [(1, "http://h/d/", "text/html; charset=utf-8", html), (2, "http://h/sitemap.xml", "application/xml", sitemap), (3, "http://h/robots.txt", "text/plain", "User-agent: *\nSITEMAP: http://h/a:b\nSitemap:"), (4, "http://h/", "text/html", None), (5, None, "text/html", html), (6, "http://h/x", "application/xml", "<!DOCTYPE x><loc>/no</loc>"), (7, "http://h/y", "text/xml", "<loc>broken")]
    df = spark.createDataFrame(rows, "id long, url string, content_type string, content string")
    got = [tuple(r) for r in links.lateral_links(df, "id").orderBy("id", "position").collect()]
    assert got == [
        (1, 0, "http://h/one", False, False),
        (1, 1, "http://h/d/?p=2", True, False),
        (1, 2, "http://h/d/i.ico", False, True),
        (1, 3, "http://other/x", False, False),
        (1, 4, "http://h/%zz&b", False, False),
        (2, 0, "http://h/s1", False, False),
        (3, 0, "http://h/a:b", False, False),
    ]
    name = links.register_links(spark)
    assert spark.sql(f"SELECT count(*) FROM {name}(CAST('<a href=x>' AS BINARY), 'text/html', 'http://h/')").first()[0] == 1
