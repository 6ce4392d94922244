"""Hand-off, viewer files, outcomes, stamps and the embedding slot."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from quillmesh.functions import text as tx
from quillmesh.operators import exports, ledger, retrieval


def test_hand_off_hides_sessions(spark, tmp_path):
    rows = spark.createDataFrame([(1, "http://a", "/runs/r1/raw/html/x.raw", "s1"), (2, "http://b", "/elsewhere/y.raw", "s2")], "artifact_id long, source_url string, raw_location string, session_id string")
    got = exports.hand_off(rows, "/runs/r1/", str(tmp_path / "out"))
    assert got.columns == ["artifact_id", "source_url", "raw_location"]
    assert sorted(r.raw_location for r in spark.read.json(str(tmp_path / "out")).collect()) == ["/elsewhere/y.raw", "raw/html/x.raw"]


def test_viewer_files_overwrite(spark):
    rows = spark.createDataFrame([(1, "http://a/x", "text/html", "", "c1"), (2, "http://b/x", "text/html", "", "c2"), (3, "http://a/", "application/pdf", "", "c3"), (4, "http://a/a", "text/plain", "", "c4"), (5, "http://a/b", "image/png", "", "c5"), (6, "http://a/c", None, "", "c6"), (7, "http://a/d", "application/rss+xml", "", "c7")], "artifact_id long, source_url string, content_type string, raw_location string, checksum string")
    assert {tuple(r) for r in exports.viewer_files(rows).collect()} == {("html/x.html", "c2"), ("pdf/index.pdf", "c3"), ("other/a.txt", "c4"), ("other/b.png", "c5"), ("other/c.data", "c6"), ("xml/d.xml", "c7")}


def test_outcomes_and_decisions(spark):
    rows = [(False, True, False, True, "acquisition_failed"), (True, False, False, True, "unsupported_content"), (True, True, True, True, "duplicate_content"), (True, True, False, False, "extraction_failed"), (True, True, False, True, "acquired")]
    df = spark.createDataFrame(rows, "a boolean, b boolean, c boolean, d boolean, want string")
    assert all(r.want == r.got for r in df.withColumn("got", ledger.page_outcome(*map(F.col, "abcd"))).collect())
    decisions = spark.createDataFrame([(1, "concurrency_reduced"), (1, "concurrency_reduced"), (1, "session_retired")], "run_id int, decision_type string")
    assert {(r.decision_type, r.decisions) for r in ledger.decision_counts(decisions).collect()} == {("concurrency_reduced", 2), ("session_retired", 1)}


def test_stamps_and_ratios(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 2, 3, 4, 5)), (2, dt.datetime(2024, 1, 2, 3, 4, 5, 600))], "i int, t timestamp")
    got = [r[0] for r in df.orderBy("i").select(tx.iso_text(F.col("t"))).collect()]
    assert [g[:19] for g in got] == ["2024-01-02T03:04:05"] * 2 and got[0][19] in "+-" and got[1][19:26] == ".000600"
    assert spark.range(1).select(tx.per_unit(F.lit(9.0), F.lit(0)), tx.per_unit(F.lit(9.0), F.lit(3))).first()[:] == (None, 3.0)


def test_embedding_slot(spark):
    def one_hot(texts):
        return [[3.0 if i == hashlib.sha256(t.encode()).digest()[0] % 8 else 0.0 for i in range(8)] for t in texts]

    rows = spark.createDataFrame([(i, f"text {i % 5}") for i in range(20)] + [(99, None)], "evidence_id long, text string")
    got = {r.evidence_id: r for r in retrieval.embed(rows, one_hot, 8, batch=3).collect()}
    assert set(got) == set(range(20)) and all(sum(x * x for x in r.embedding) == pytest.approx(1) for r in got.values())
    assert got[1].embedding == got[6].embedding and got[1].embedded_text_checksum == hashlib.sha256(b"text 1").hexdigest()
    with pytest.raises(Exception, match="dimensions"):
        retrieval.embed(rows, one_hot, 4).collect()
