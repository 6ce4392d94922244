"""Tables in the shared folder."""

import os

import pytest
from pyspark.sql import functions as F

from quillmesh import storage
from quillmesh.storage import clearing, materialize, new_path, sifted, without


def test_spent_tables_are_removed(spark):
    outside, kept = materialize(spark.range(3)), new_path(spark, "kept")
    with clearing(spark):
        inside = materialize(spark.range(5), "inside")
        with clearing(spark):
            inner = materialize(inside, "inner")
            assert inner.count() == 5
        assert not os.path.exists(inner.inputFiles()[0].removeprefix("file://")) and inside.count() == 5
        place = os.path.dirname(inside.inputFiles()[0].removeprefix("file://"))
        inside.write.parquet(kept)
    assert not os.path.exists(place) and spark.read.parquet(kept).count() == 5 and outside.count() == 3
    with pytest.raises(ZeroDivisionError), clearing(spark):
        place = os.path.dirname(materialize(spark.range(2)).inputFiles()[0].removeprefix("file://"))
        1 / 0  # noqa: B018
    assert not os.path.exists(place)


def test_shuffles_of_written_tables_are_removed(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {name for top in folders for _, _, names in os.walk(top) for name in names if name.startswith("shuffle_")}
    setting, before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None), files()
    rows = spark.range(10_000).select(F.xxhash64("id").alias("x")).repartition(5, "x")
    tables = [materialize(rows.groupBy(F.col("x") % 7).count()), materialize(rows)]
    assert not files() - before and [t.count() for t in tables] == [13, 10_000]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == setting


@pytest.mark.parametrize("most", [1 << 26, 1 << 16])
def test_rows_are_sifted_and_taken_away(spark, monkeypatch, most):
    monkeypatch.setattr(storage, "FILTER_BITS", most)
    monkeypatch.setattr(storage, "BROADCAST_ROWS", 10)
    rows = spark.range(30_000).select(F.when(F.col("id") != 5, F.col("id")).alias("id"), (F.col("id") % 3).alias("kind"))
    side = materialize(rows.where("id IS NULL OR id % 4 = 0").select(F.col("id").alias("other"), "kind"))
    may, others = sifted(rows, F.col("id"), side, F.col("other"))
    assert may.count() + others.count() == 30_000 and others.where("id IS NULL OR id % 4 = 0").isEmpty()
    assert may.count() < (10_000 if most > 1 << 20 else 20_000)
    same = F.col("id").eqNullSafe(F.col("other")) & (rows["kind"] == F.lit(1))
    left = without(rows, side.drop("kind"), same, F.col("id"), F.col("other"))
    assert sorted(map(tuple, left.collect()), key=repr) == sorted(map(tuple, rows.where("kind <> 1 OR id IS NOT NULL AND id % 4 <> 0").collect()), key=repr)
