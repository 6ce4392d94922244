"""The pipeline's stages against brute force, each on its own input."""

import brute
from pyspark.sql import functions as F

from test_llm_operators import frame, odd_rows, prose  # noqa: F401


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages(spark, tables):
    import corpus_pipeline as p
    from quillmesh.storage import materialize

    assert [name for name, _ in p.STAGES] == ["quality classifier", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "packing"]
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    good, passed = p.keep_quality(spark, docs, tables), None
    trusted = {r.doc_id for r in spark.read.parquet(f"{tables}/labels.parquet").where("quality = 1 AND toxic = 0").collect()}
    good = materialize(good, "good")
    kept = texts(good)
    assert len(trusted & set(kept)) >= 0.98 * len(trusted) and good.columns == docs.columns

    once = materialize(p.drop_copies(spark, good, tables), "once")
    largest = {}
    for i, t in kept.items():
        largest[t] = max(i, largest.get(t, i))
    assert texts(once) == {i: t for t, i in largest.items()} and once.columns == docs.columns

    apart = materialize(p.drop_near_copies(spark, once, tables), "apart")
    linked = brute.components(texts(once), 5, 80, 100)
    assert set(texts(apart)) == {i for i, (_, c) in linked.items() if c == i} and apart.columns == docs.columns

    clean = materialize(p.drop_benchmark(spark, apart, tables), "clean")
    passages = [" ".join(r.text.split()) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    leaks = {i for i, t in texts(apart).items() if any(x in " ".join(t.split()) for x in passages)}
    gone = set(texts(apart)) - set(texts(clean))
    assert leaks <= gone and len(gone) <= len(leaks) + 2 and clean.columns == docs.columns

    packed = p.pack(spark, clean, tables)
    passed = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()
    assert {r.doc_id for r in passed} == set(texts(clean)) and all(r.n == r.t for r in passed)


def test_run_is_all_stages(spark, tables):
    import corpus_pipeline as p

    rows = p.run(spark, tables)
    assert rows.columns[:4] == ["doc_id", "start", "length", "ids_crc32"] and rows.count() > 0 and p.ORACLE_SQL is None


def test_odd_rows_pass(spark, odd_rows, tables):  # noqa: F811
    import corpus_pipeline as p

    docs = frame(spark, odd_rows)
    once = p.drop_copies(spark, docs, tables)
    assert once.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in once.collect()]
    assert len(rows) == len(set(rows)) == len({t or "" for _, t, _ in odd_rows})
    assert {i for i, _ in rows} >= {51, 90} and not {i for i, _ in rows} & {50}
    for stage in (p.drop_near_copies, p.drop_benchmark, p.keep_quality):
        out = stage(spark, docs, tables)
        assert out.columns == docs.columns and out.count() <= len(odd_rows)
        assert stage(spark, docs.limit(0), tables).count() == 0


def test_near_copies_go_by_id_and_text(spark, tables):
    import corpus_pipeline as p

    one, two = prose(1, 80), prose(2, 80)
    rows = [(1, one, "en"), (2, one + " x", "en"), (2, two, "en"), (3, two.upper(), "en"), (None, two, "en"), (1, one + " y", "de")]
    left = {(r.doc_id, r.text) for r in p.drop_near_copies(spark, frame(spark, rows), tables).collect()}
    # of {1, 2, 1} one row of id 1 stays, of {2, 3, null} the row of id 2
    assert (2, two) in left and len(left) == 2 and {i for i, _ in left} == {1, 2}
