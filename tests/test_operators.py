"""Ledger, crawl, evidence, retrieval and artifact operators on literal tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quillmesh.operators import artifacts, evidence, graph, ledger, retrieval, sampling

ATTEMPT = "run_id int, url string, domain string, occurred_at timestamp, attempt_id long, final_result string, retry_number int, acquisition_method string, proxy_status string"


def attempts(spark, rows):
    """(url, retry, result) rows in order, one second apart."""
    start = dt.datetime(2024, 1, 1)
    full = [(1, u, "d", start + dt.timedelta(seconds=i), i, r, n, "http", None) for i, (u, n, r) in enumerate(rows)]
    return spark.createDataFrame(full, ATTEMPT)


@pytest.mark.parametrize(
    "rows,want",
    [
        ([("/ok", 0, "SUCCESS"), ("/denied", 0, "ACCESS_DENIED")], (2, 1, 1, 0, 0, "PARTIAL")),
        ([("/x", 0, "RATE_LIMITED"), ("/x", 1, "SUCCESS")], (1, 1, 0, 1, 1, "SUCCESS")),
        ([("/f", 0, "RATE_LIMITED"), ("/f", 1, "RATE_LIMITED"), ("/f", 2, "RATE_LIMITED"), ("/f", 3, "SUCCESS")], (1, 1, 0, 3, 3, "SUCCESS")),
        ([("/f", 0, "TIMEOUT")], (1, 0, 1, 0, 0, "FAILED")),
    ],
)
def test_rollup(spark, rows, want):
    r = ledger.run_rollup(attempts(spark, rows)).first()
    assert (r.attempted, r.acquired, r.failed, r.retries, r.rate_limited, r.status) == want


def test_interrupt_overrides(spark):
    got = spark.range(1).select(ledger.run_status(F.lit(1), F.lit(1), F.lit(True)), ledger.run_status(F.lit(0), F.lit(0))).first()
    assert tuple(got) == ("INTERRUPTED", "FAILED")


def test_backoff_doubles_and_resets(spark):
    rows = [("/", i, "RATE_LIMITED") for i in range(8)] + [("/", 8, "TIMEOUT"), ("/", 9, "SUCCESS"), ("/", 10, "RATE_LIMITED")]
    got = [r.backoff_seconds for r in ledger.backoff(attempts(spark, rows)).orderBy("attempt_id").collect()]
    assert got == [1, 2, 4, 8, 16, 32, 60, 60, 1]


def test_health_and_recovery(spark):
    rows = [("/", i, r) for i, r in enumerate(["TIMEOUT", "NOT_FOUND", "TIMEOUT", "TIMEOUT", "SUCCESS", "SUCCESS", "TIMEOUT"])]
    got = [r.health for r in ledger.failure_streaks(attempts(spark, rows)).orderBy("attempt_id").collect()]
    assert got == ["unhealthy", "unhealthy", "unhealthy", "quarantined", "healthy", "healthy", "unhealthy"]
    assert [r.attempt_id for r in ledger.recoveries(attempts(spark, rows)).collect()] == [4]
    assert [r.attempt_id for r in ledger.announced(attempts(spark, rows)).collect()] == [2]


@pytest.mark.parametrize(
    "policy,results,want",
    [
        (dict(start=8), "L", (4, 1, 0)),
        (dict(start=1), "L", (1, 0, 0)),
        (dict(start=8, restore=3), "LSSS", (5, 1, 1)),
        (dict(start=8), "SSSSSSS", (8, 0, 0)),
        (dict(start=8, restore=2), "LSLS", (2, 2, 0)),
    ],
)
def test_adaptive_concurrency(spark, policy, results, want):
    rows = attempts(spark, [("/", 0, {"L": "RATE_LIMITED", "S": "SUCCESS"}[c]) for c in results] + [("/", 0, "TIMEOUT")])
    r = ledger.adaptive_concurrency(rows, ledger.ConcurrencyPolicy(**policy)).first()
    assert (r.concurrency, r.reductions, r.restorations) == want


def test_concurrency_of_a_hot_domain_is_folded_in_parts(spark):
    import random

    rng, policy = random.Random(1), ledger.ConcurrencyPolicy()
    rows = [("/", 0, rng.choice(["SUCCESS"] * 6 + ["RATE_LIMITED"])) for _ in range(3000)]
    at = (policy.start - 1) * policy.restore
    down = 0
    for _, _, r in rows:
        down += bool(r == "RATE_LIMITED" and policy.reduced[at])
        at = (policy.succeeded if r == "SUCCESS" else policy.limited)[at]
    got = ledger.adaptive_concurrency(attempts(spark, rows)).first()
    assert (got.concurrency, got.reductions) == (at // policy.restore + 1, down)


def test_outcomes(spark):
    rows = [(429, None, "RATE_LIMITED"), (403, None, "ACCESS_DENIED"), (408, None, "TIMEOUT"), (404, None, "NOT_FOUND"), (500, None, "NETWORK_ERROR"), (200, None, "SUCCESS"), (None, "timeout", "TIMEOUT"), (None, "unreachable", "NETWORK_ERROR"), (200, "oversize", "BLOCKED")]
    df = spark.createDataFrame(rows, "s int, f string, want string")
    assert all(r.want == r.got for r in df.withColumn("got", ledger.outcome(F.col("s"), F.col("f"))).collect())


SITE = {
    "/": ["/about", "/docs/", "/report.pdf", "/", "http://off-host.invalid/elsewhere"],
    "/about": ["/", "/docs/"],
    "/docs/": ["/docs/page1"],
    "/docs/page1": [("/docs/page2", True)],
    "/docs/page2": [],
    "/sitemap-only.html": [],
    "/robots.txt": ["/sitemap.xml"],
    "/sitemap.xml": ["/sitemap-only.html"],
    "/report.pdf": [],
}


def crawled(spark, **options):
    at = lambda p: p if "://" in p else f"http://site{p}"
    captured = spark.createDataFrame([(at(p), 200) for p in SITE], "url string, http_status int")
    rows = [(at(p), i, at(x if isinstance(x, str) else x[0]), not isinstance(x, str), False) for p, xs in SITE.items() for i, x in enumerate(xs)]
    found = spark.createDataFrame(rows, "url string, position int, link string, is_pagination boolean, is_resource boolean")
    return {r.url.removeprefix("http://site"): r for r in graph.crawl(captured, found, "http://site/", **options).collect()}


def test_crawl_reaches_the_site_once(spark):
    got = crawled(spark, most_depth=3)
    assert {u for u, r in got.items() if r.outcome == "acquired"} == set(SITE)
    assert got["http://off-host.invalid/elsewhere"].outcome == "off_host"
    assert got["/docs/page1"].parent == "http://site/docs/"


@pytest.mark.parametrize("mode,depth,there,missing", [("simple", 2, ["/docs/page1", "/docs/page2"], []), ("simple", 1, ["/docs/"], ["/docs/page1", "/docs/page2"]), ("wave", 2, ["/docs/page1"], ["/docs/page2"]), ("wave", 3, ["/docs/page2"], [])])
def test_crawl_depth_and_pagination(spark, mode, depth, there, missing):
    got = crawled(spark, most_depth=depth, mode=mode)
    assert all(u in got for u in there) and not any(u in got for u in missing)
    assert ("http://off-host.invalid/elsewhere" in got) == (mode == "simple")


def test_crawl_budget(spark):
    simple = crawled(spark, most_depth=3, most_artifacts=2)
    assert sum(r.outcome == "acquired" for r in simple.values()) == 2 and any(r.outcome == "over_budget" for r in simple.values())
    assert len(crawled(spark, most_depth=3, most_artifacts=2, mode="wave")) == 2


def test_lineage(spark):
    rows = [(1, 10, None), (1, 11, 10), (1, 12, 11), (1, 13, 10), (1, 20, 99), (1, 21, 20), (2, 30, None), (3, 1, 2), (3, 2, 1), (3, 3, 1)]
    df = spark.createDataFrame(rows, "run_id int, event_id long, parent_event_id long")
    assert graph.lineage(df).where("run_id = 3").count() == 0
    chain = spark.range(40).selectExpr("1 AS run_id", "id AS event_id", "nullif(id, 0) - 1 AS parent_event_id")
    assert max(r.depth for r in graph.lineage(chain).collect()) == 39
    got = [(r.event_id, r.depth) for r in graph.lineage(df).where("run_id = 1").orderBy("path").collect()]
    assert got == [(10, 0), (11, 1), (12, 2), (13, 1)]


def lines(spark):
    rows = [(1, 1, 0, "Quarterly Report", 72.0, 754.0, 300.0, 730.0), (1, 1, 1, "Metric", 72.0, 692.0, 120.0, 680.0), (1, 1, 2, "Value", 240.0, 692.0, 280.0, 680.0), (1, 1, 3, "Revenue", 72.0, 667.0, 120.0, 655.0), (1, 1, 4, "120", 240.0, 667.0, 260.0, 655.0), (1, 1, 5, "Margin", 72.0, 642.0, 120.0, 630.0), (1, 1, 6, "30", 240.0, 642.0, 255.0, 630.0), (1, 2, 0, "KPI: 42", 72.0, 700.0, 120.0, 688.0)]
    df = spark.createDataFrame(rows, "artifact_id long, page_number int, line_no int, text string, l double, t double, r double, b double")
    return df.withColumn("height", F.col("t") - F.col("b"))


def test_tables_headings_and_sections(spark):
    r = evidence.tables(lines(spark)).collect()
    assert len(r) == 1 and r[0].headers == ["Metric", "Value"] and r[0].rows == [["Revenue", "120"], ["Margin", "30"]]
    assert r[0].section == "Quarterly Report" and r[0].location == "x0=72.00,y0=692.00,x1=280.00,y1=630.00"
    rows = {(r.page_number, r.line_no): r for r in evidence.text_evidence(lines(spark)).collect()}
    assert rows[1, 0].role == "heading" and rows[2, 0].canonical_text == "Quarterly Report: KPI: 42" and rows[2, 0].value == "42"
    assert (r[0].claim, r[0].value, r[0].supporting_context) == ("Table", "Metric | Value", "Metric | Value\nRevenue | 120\nMargin | 30")
    assert rows[1, 1].location == "x0=72.00,y0=692.00,x1=120.00,y1=680.00"
    bitmaps = spark.createDataFrame([(1, 3, 0, 1.0, 9.0, 5.0, 2.0), (1, 1, 0, 1.0, 9.0, 5.0, 2.0)], "artifact_id long, page_number int, bitmap_no int, l double, t double, r double, b double")
    seen = {r.page_number: r for r in evidence.visuals(bitmaps, lines(spark)).collect()}
    assert seen[3].section == "Quarterly Report" and seen[3].location == "x0=1.00,y0=9.00,x1=5.00,y1=2.00"
    assert (seen[1].claim, seen[1].value, seen[1].supporting_context) == ("Embedded image", "bitmap", "Embedded image on page 1")
    meta = evidence.extraction_metadata(evidence.text_evidence(lines(spark)), evidence.tables(lines(spark)), bitmaps).first()
    assert (meta.page_count, meta.text_count, meta.heading_count, meta.table_count, meta.visual_count) == (2, 8, 1, 1, 2)


def test_blank_lines_count_nowhere(spark):
    rows = [(1, 1, 0, "  ", 50.0), (1, 1, 1, "", 50.0), (1, 1, 2, " Title ", 20.0), (1, 1, 3, "a: b", 10.0), (1, 1, 4, "c", 10.0)]
    df = spark.createDataFrame(rows, "artifact_id long, page_number int, line_no int, text string, height double")
    got = {r.line_no: (r.role, r.section, r.supporting_context) for r in evidence.text_evidence(df).collect()}
    assert got == {2: ("heading", "Title", "Title"), 3: ("text", "Title", "a: b"), 4: ("text", "Title", "c")}


@pytest.mark.parametrize(
    "cells,rows",
    [
        # 10, 7, 4: the third is within reach of the second, but not of the first
        ([(10.0, 0.0, 0), (7.0, 5.0, 1), (4.0, 0.0, 2)], [[0, 1], [2]]),
        ([], []),
        # from left to right, and by line where they stand at one place
        ([(5.0, 9.0, 0), (5.0, 1.0, 3), (5.0, 1.0, 2), (5.0, 4.0, 1)], [[2, 3, 1, 0]]),
        # of equal heights the first line begins the row
        ([(-1.5, 0.0, 7), (-1.5, 0.0, 3), (-5.5, 0.0, 1), (-5.6, 0.0, 0)], [[1, 3, 7], [0]]),
    ],
)
def test_table_rows(spark, cells, rows):
    df = spark.createDataFrame([([(c, n, x, 0.0, 0.0, 0.0, "") for c, x, n in cells],)], f"cells array<{evidence._CELL}>")
    assert [[c.line_no for c in row] for row in df.select(evidence.table_rows(F.col("cells")).alias("x")).first().x] == rows


def test_uneven_and_single_rows_are_no_table(spark):
    boxes = lambda rows: [(1, 1, n, f"c{n}", float(x), 100.0 - 10 * row, x + 5.0, 95.0 - 10 * row, 5.0) for n, (row, x) in enumerate(rows)]
    schema = "artifact_id long, page_number int, line_no int, text string, l double, t double, r double, b double, height double"
    for rows, n in (([(0, 1), (0, 50), (1, 1), (1, 50), (1, 90)], 0), ([(0, 1), (0, 50), (1, 1)], 0), ([(0, 1), (0, 50), (1, 1), (2, 1), (2, 50)], 1)):
        assert evidence.tables(spark.createDataFrame(boxes(rows), schema)).count() == n


def test_stripped_takes_white_space_of_any_kind(spark):
    from quillmesh.functions.text import WHITE_SPACE, stripped

    assert set(WHITE_SPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}
    texts = [f"{w}a{w}b{w}" for w in WHITE_SPACE] + ["", WHITE_SPACE, "\u200b x \u200b", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", stripped(F.col("t")).alias("s")).collect()
    assert all(r.s == (r.t.strip() if r.t is not None else None) for r in got)


@pytest.mark.parametrize("odd,error", [([1.0, float("nan")], "finite"), ([1.0, None], "finite"), ([float("inf"), 0.0], "finite"), ([1.0], "dimensions"), ([1.0, 2.0, 3.0], "dimensions")])
@pytest.mark.parametrize("few", ["queries", "targets"])
def test_odd_vectors_are_errors(spark, odd, error, few):
    schema = "vec_id long, embedding array<float>"
    good, bad = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], schema), spark.createDataFrame([(5, [1.0, 0.0]), (6, odd)], schema)
    for queries, targets in ((good, bad), (bad, good)):
        with pytest.raises(Exception, match=error):
            retrieval.top_k(queries, targets, 2, few=few).collect()


def test_top_k_of_sides_too_large_for_a_broadcast(spark, monkeypatch):
    rng = __import__("random").Random(3)
    vectors = spark.createDataFrame([(i, [rng.random() for _ in range(8)]) for i in range(300)], "vec_id long, embedding array<double>")
    want = sorted(map(tuple, retrieval.top_k(vectors, vectors, 4).collect()))
    monkeypatch.setattr(retrieval, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(retrieval, "BLOCK_BYTES", 2000)
    assert sorted(map(tuple, retrieval.top_k(vectors, vectors, 4).collect())) == want


def test_times_come_from_the_pass_itself(spark):
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(6)], "vec_id long, embedding array<double>")
    written = []
    times = retrieval.timed(retrieval.top_k(vectors, vectors, 3), lambda rows: written.extend(rows.collect()))
    assert (times["queries"], times["rows"]) == (6, 18) and len(written) == 18 and times["ms_per_query"] == pytest.approx(1000 * times["seconds"] / 6)
    assert retrieval.timed(retrieval.top_k(vectors.limit(0), vectors, 3), lambda rows: rows.collect())["ms_per_query"] is None


def test_retrieval_ranks_and_zero_vectors(spark):
    e0 = [1.0] + [0.0] * 3
    targets = spark.createDataFrame([(1, e0), (2, [0.0, 1.0, 0.0, 0.0]), (3, [-1.0, 0.0, 0.0, 0.0]), (4, [0.0] * 4), (5, None)], "vec_id long, embedding array<float>")
    query = spark.createDataFrame([(100, e0)], "vec_id long, embedding array<float>")
    for few in ("queries", "targets"):
        got = [(r.rank, r.target_id, r.similarity) for r in retrieval.top_k(query, targets, 4, few=few).orderBy("rank").collect()]
        assert got == [(1, 1, 1.0), (2, 2, 0.0), (3, 4, 0.0), (4, 3, -1.0)]
    with pytest.raises(Exception, match="dimensions"):
        retrieval.require_dimension(query, "embedding", 8).collect()


def test_retrieval_in_blocks(spark, tables, monkeypatch):
    every = spark.read.parquet(f"{tables}/embeddings.parquet").select("vec_id", "embedding")
    few = every.where("vec_id < 40")
    whole = sorted(map(tuple, retrieval.top_k(few, every, 3).collect()))
    monkeypatch.setattr(retrieval, "BLOCK_BYTES", 7 * 64 * 8)
    for sent in (retrieval.BROADCAST_BYTES, 0):
        monkeypatch.setattr(retrieval, "BROADCAST_BYTES", sent)
        monkeypatch.setattr(retrieval, "SCORES_TOGETHER", 30)
        assert sorted(map(tuple, retrieval.top_k(few, every, 3).collect())) == whole and len(whole) == 120


def test_samples(spark):
    rows = [(i, "text") for i in range(90)] + [(90 + i, "table") for i in range(8)] + [(98, "visual"), (99, "visual")]
    df = spark.createDataFrame(rows, "id long, kind string")
    got = sampling.stratified(df, 30, "kind", ["id"]).groupBy("kind").count().collect()
    assert {r.kind: r["count"] for r in got} == {"text": 27, "table": 2, "visual": 1}
    assert sampling.stratified(df.limit(5), 30, "kind", ["id"]).count() == 5
    assert sampling.stratified(df.limit(0), 30, "kind", ["id"]).count() == 0
    codes = spark.createDataFrame([(f"A{i:03}",) for i in range(1, 230)], "code string")
    got = sorted(r.code for r in sampling.evenly_spaced(codes, 20, ["code"]).collect())
    assert len(got) == 20 and got[0] == "A001" and got == [f"A{i * 229 // 20 + 1:03}" for i in range(20)]


def test_artifacts(spark):
    rows = [(1, "k", "first"), (2, "k", "second"), (3, "j", "other")]
    df = spark.createDataFrame(rows, "id long, sha string, ref string")
    assert sorted(tuple(r) for r in artifacts.first_seen(df, "sha", ["id"]).collect()) == [(1, "k", "first"), (3, "j", "other")]
    changed = artifacts.upsert(df.limit(1), spark.createDataFrame([(9, "k", "new")], df.schema), ["sha"], ["id"])
    assert [r.ref for r in changed.collect()] == ["new"]
    kinds = spark.createDataFrame([("text/html; x", b"a"), (None, b"%PDF-1"), ("application/octet-stream", b"?")], "k string, c binary")
    assert [r[0] for r in kinds.select(artifacts.content_type(F.col("k"), F.col("c"))).collect()] == ["text/html", "application/pdf", "application/octet-stream"]
    sized = spark.createDataFrame([("99", b"a"), ("bad", b"a"), ("1", b"a" * 20)], "content_length string, content binary")
    assert artifacts.within_limit(sized, 10).count() == 1


def test_streamed_concurrency(spark, tmp_path):
    from quillmesh.streaming.ledger import concurrency_changes

    rows = attempts(spark, [("/", 0, r) for r in ["RATE_LIMITED"] + ["SUCCESS"] * 5])
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    run = concurrency_changes(stream).writeStream.format("memory").queryName("changes").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    run.awaitTermination()
    assert [(r.before, r.after) for r in spark.table("changes").collect()] == [(8, 4), (4, 5)]


@pytest.mark.parametrize("few", ["queries", "targets"])
def test_top_k_meets_no_pairs_of_blocks_where_one_side_is_sent(spark, few):
    vectors = spark.range(300).select(F.col("id").alias("vec_id"), F.array(*[F.sin(F.col("id") * (i + 1)) for i in range(4)]).alias("embedding"))
    plan = retrieval.top_k(vectors, vectors, 2, few=few)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and plan.count("MapInPandas") == 1


@pytest.mark.parametrize("few", ["queries", "targets"])
def test_a_search_holds_no_more_for_more_rows(few):
    import tracemalloc
    from types import SimpleNamespace

    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(3)
    sent = SimpleNamespace(value=(np.arange(2000), retrieval._unit(rng.normal(size=(2000, 16)))))
    held = {}
    for batches in (4, 40):
        frames = (pd.DataFrame({"vec_id": np.arange(1000) + 1000 * i, "embedding": list(rng.normal(size=(1000, 16)))}) for i in range(batches))
        tracemalloc.start()
        rows = sum(len(pdf) for pdf in retrieval._search_sent(frames, sent, "vec_id", "embedding", 3, few))
        held[batches] = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows == 3 * (2000 if few == "queries" else 1000 * batches)
    assert held[40] < 1.2 * held[4] and held[40] < 60e6
