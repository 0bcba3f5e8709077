"""Scratch tables live under the session's checkpoint directory."""

from __future__ import annotations

from sylvan.session import drop_path, ensure_checkpoint_dir, materialize_at, scratch_path


def test_checkpoint_dir_is_stable_and_scratch_is_under_it(spark):
    first = ensure_checkpoint_dir(spark)
    assert ensure_checkpoint_dir(spark) == first
    assert scratch_path(spark, "t").startswith(first.rstrip("/") + "/tables/t-")


def test_materialize_round_trip_and_drop(spark):
    df = spark.range(100)
    back, path = materialize_at(df, "roundtrip")
    assert back.count() == 100 and back.rdd.getNumPartitions() >= 1
    drop_path(spark, path)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)
