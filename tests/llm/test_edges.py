"""Paths of the operators that small tables don't take: shuffles instead of broadcasts, overfull ranges,
large records, texts of megabytes."""

import hashlib
import zlib
from collections import Counter

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string"
PARAGRAPH = " ".join(f"word{i % 977}" for i in range(60_000))


def long_texts(spark):
    rows = [(1, PARAGRAPH, "en"), (2, PARAGRAPH, "en"), (3, PARAGRAPH + " end", "de"), (4, "x" * 2_000_000, "en"), (5, None, None), (6, "short one", "en")]
    return rows, spark.createDataFrame(rows, DOCS)


def test_many_repeated_texts_meet_by_a_shuffle(spark, monkeypatch):
    from quillmesh.llm import exact_dedup, texts

    for module in (exact_dedup, texts):
        monkeypatch.setattr(module, "small_side", lambda df, limit=0: df)
    rows = [(i, f"text {i % 40}" if i % 3 else f"own {i}") for i in range(300)] + [(7, "text 7"), (7, "text 7"), (None, "text 7"), (8, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    want = Counter((i, max(x for x in groups[t or ""] if x is not None), len(groups[t or ""])) for i, t in rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.exact_duplicates(docs).collect()) == want
    found = texts.distinct_texts(docs, "doc_id", "text")
    joined = found.prints.join(found.classes, "h").join(found.texts, "key").select("doc", "text", "rows")
    assert Counter(map(tuple, joined.collect())) == Counter((i, t or "", len(groups[t or ""])) for i, t in rows)


def test_overfull_ranges_are_divided(spark, monkeypatch):
    """A sample that saw only a corner of the keys: its ranges are cut again until none is overfull."""
    from quillmesh.llm import sharding

    rows = spark.range(20_000).select("id", F.xxhash64("id").alias("k"), (F.col("id") % 50 + 1).alias("size"))
    total, ranges, calls, sample = rows.agg(F.sum("size")).first()[0], 40, [], sharding._sample

    def blind(inside, expected, size):
        calls.append(expected)
        return sample(inside.where("id < 30") if len(calls) == 1 else inside, expected, size)

    monkeypatch.setattr(sharding, "_sample", blind)
    got = sharding.split_ranges(rows, ranges, total)
    sizes = [r.b for r in got.groupBy("r").agg(F.sum("size").alias("b")).collect()]
    assert len(calls) > 1 and sum(sizes) == total and max(sizes) <= 3 * total / ranges
    edges = got.groupBy("r").agg(F.min("k").alias("a"), F.max("k").alias("b")).orderBy("r").collect()
    assert all(x.b <= y.a for x, y in zip(edges, edges[1:]))


def test_records_of_every_size_class(spark, tmp_path):
    from quillmesh.llm.warc import SIZE_CLASSES, read_warc, write_warc

    sizes = [0, 999, 1000, *(s + d for s in SIZE_CLASSES for d in (-1, 0, 1)), 6_000_000]
    # a nested record in each payload, which is no record of the archive
    nested = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    pages = [(i, f"http://a/{i}", (nested * (s // len(nested) + 1))[:s]) for i, s in enumerate(sizes)]
    pages += [(100 + i, f"http://b/{i}", h) for i, (_, _, h) in enumerate(pages)]
    write_warc(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4), str(tmp_path / "w"), records_per_file=64)
    got = read_warc(spark, str(tmp_path / "w")).collect()
    want = sorted((i, len(h), hashlib.sha1(h.encode()).hexdigest(), "revisit" if i < 100 and len(h) >= 1000 else "response") for i, _, h in pages)
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type) for r in got) == want


def test_texts_of_megabytes_in_exact_operators(spark):
    import numpy as np
    import public_tokenizers
    from quillmesh.llm import brown, exact_dedup, packing, quality, sharding
    from tokenizers import Tokenizer

    rows, docs = long_texts(spark)
    assert {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_duplicates(docs).collect()} == {1: (2, 2), 2: (2, 2), 3: (3, 1), 4: (4, 1), 5: (5, 1), 6: (6, 1)}
    sharded = sharding.shard_by_bytes(docs).collect()
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in sharded) == [(i, len(t or "") + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows]
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = packing.pack_documents(docs.where("doc_id IN (1, 5, 6)")).collect()
    for i in (1, 5, 6):
        ids = exact.encode(rows[i - 1][1] or "", add_special_tokens=False).ids + [1]
        own = sorted((r.start, r.length, r.ids_crc32) for r in pieces if r.doc_id == i)
        assert [c for _, _, c in own] == [zlib.crc32(np.array(ids[a : a + n], "<u4").tobytes()) for a, n, _ in own] and sum(n for _, n, _ in own) == len(ids)
    scored = {r.doc_id: r.n_tokens for r in brown.class_model_scores(docs).collect()}
    assert scored == {1: 60_001, 2: 60_001, 3: 60_002, 4: 2, 5: 1, 6: 3}
    judged = quality.quality(docs, spark.createDataFrame([(1, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int"))
    assert judged.count() == 6


def test_short_passages_among_words_of_other_passages(spark):
    """A short passage word for word, in a window that is full of other passages' words."""
    import random

    from quillmesh.llm.decontaminate import contaminated

    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(900)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([16, 18, 40])))) for i in range(120)]
    docs = [(i, " ".join([*rng.choices(vocabulary, k=60), *text.split(), *rng.choices(vocabulary, k=60)]), "en") for i, text in items]
    clean = [(1000 + i, " ".join(rng.choices(vocabulary, k=140)), "en") for i in range(60)]
    found = {(r.doc_id, r.item_id) for r in contaminated(spark.createDataFrame(docs + clean, DOCS), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert found == {(i, i) for i, _ in items}


def test_block_values_are_not_written_for_texts_of_their_own(spark):
    """Sketch joins write little beside their input: what no other text shares goes by one shuffle."""
    import os
    import random

    from quillmesh import storage
    from quillmesh.llm.sketch_join import near_duplicates

    rng = random.Random(11)
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(1000)), "en") for i in range(300)] + [(900, "one two three four", "en")]
    docs = spark.createDataFrame([*rows, (901, rows[0][1] + " end", "en")], DOCS).repartition(4)
    folder = os.path.join(storage.shared_folder(spark).removeprefix("file://"), "quillmesh")
    size = lambda: sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names)
    before = size()
    found = near_duplicates(docs, k=5, num=80, den=100)
    assert size() - before < 0.15 * sum(len(t) for _, t, _ in rows)
    assert {r.doc_id: r.component_id for r in found.collect()} == {i: i for i, _, _ in rows} | {901: 0}


def test_near_copies_meet_without_broadcasts(spark, monkeypatch):
    """More pairs, dropped rows and texts than are broadcast, and a text that is compared with many others."""
    import random

    import corpus_pipeline
    from quillmesh import storage
    from quillmesh.llm import sketch_join

    rng = random.Random(3)
    rows = []
    for i in range(60):
        words = [f"w{rng.randrange(10**5)}" for _ in range(90)]
        rows += [(i * 100 + j, " ".join([*words, *(f"n{rng.randrange(10**6)}" for _ in range(j % 4))]), "en") for j in range(1 + i % 7 if i else 50)]
    docs = spark.createDataFrame([*rows, (None, rows[0][1], "en")], DOCS).repartition(3)
    want = {tuple(r) for r in sketch_join.near_duplicates(docs, k=5, num=80, den=100).collect()}
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()}
    monkeypatch.setattr(storage, "BROADCAST_ROWS", 5)
    monkeypatch.setattr(storage.small_side, "__defaults__", (5,))
    monkeypatch.setattr(sketch_join, "BROADCAST_ROWS", 5)
    monkeypatch.setattr(sketch_join, "TEXTS_A_PART", 7)
    assert {tuple(r) for r in sketch_join.near_duplicates(docs, k=5, num=80, den=100).collect()} == want
    assert kept == {i * 100 for i in range(60)} == {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()}
