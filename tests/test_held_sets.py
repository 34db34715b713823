import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from stayscope.session import shared_folder
from stayscope.sources import held_sets
from stayscope.sources.held_sets import bucket_versions, load, read_set, remove_old_versions

SCHEMA = "key string, at int, body string"


def rows_of(df):
    return sorted(tuple(r) for r in df.select("key", "at", "body").collect())


def files_of(folder):
    """Files that hold rows, with their time of writing."""
    place = f"{folder.removeprefix('file:')}/rows"
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(place) for f in names if f.endswith(".parquet")}


def test_loads_equal_the_last_write_of_each_key(spark):
    folder, rng, want = shared_folder(spark), random.Random(2), {}
    for turn in range(4):
        batch = [(f"k{rng.randrange(120)}", rng.randrange(5), f"{turn}:{i}", rng.random() < 0.2) for i in range(90)]
        best = {}
        for key, at, body, gone in batch:
            best[key] = max(best.get(key, (at, body, gone)), (at, body, gone))
        for key, (at, body, gone) in best.items():
            want.pop(key, None) if gone else want.__setitem__(key, (key, at, body))
        df = spark.createDataFrame(batch, f"{SCHEMA}, gone boolean").repartition(3)
        told = load(df, folder, "key", ["at", "body"], deleted_col="gone", buckets=16)
        assert told["version"] == turn and told["rows"] == len(want)
        assert rows_of(read_set(spark, folder)) == sorted(want.values())


def test_untouched_buckets_keep_their_files(spark):
    folder = shared_folder(spark)
    load(spark.createDataFrame([(f"k{i}", 1, "a") for i in range(200)], SCHEMA), folder, "key", ["at"], buckets=32)
    before = files_of(folder)
    told = load(spark.createDataFrame([("k7", 2, "b"), ("k7", 1, "c"), ("new", 1, "d")], SCHEMA), folder, "key", ["at"])
    after = files_of(folder)
    assert told["buckets"] <= 2 and told["rows"] == 201
    assert before.items() <= after.items() and 1 <= len(after) - len(before) <= 4
    assert ("k7", 2, "b") in rows_of(read_set(spark, folder))
    # A load reads the buckets it touches: the others' folders are not in the scan.
    now = bucket_versions(spark, folder)
    one = held_sets._held(spark, folder, spark.read.parquet(f"{folder}/schema").schema, now.filter("bucket = 3"))
    assert "PartitionFilters: [" in plan_of(one) and len(one.inputFiles()) >= 1
    assert one.select("_bucket").distinct().count() == 1


def test_a_load_that_dies_leaves_the_set_as_it_was(spark, monkeypatch):
    folder = shared_folder(spark)
    load(spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], SCHEMA), folder, "key", ["at"], buckets=4)
    pinned = read_set(spark, folder)
    plain = held_sets.write_table

    def dying(df, target, *more):
        if "/versions/" in target:
            raise OSError("lost")
        return plain(df, target, *more)

    monkeypatch.setattr(held_sets, "write_table", dying)
    with pytest.raises(OSError):
        load(spark.createDataFrame([("a", 2, "z"), ("c", 1, "w")], SCHEMA), folder, "key", ["at"])
    assert rows_of(read_set(spark, folder)) == [("a", 1, "x"), ("b", 1, "y")]
    monkeypatch.setattr(held_sets, "write_table", plain)
    told = load(spark.createDataFrame([("b", 2, "v")], SCHEMA), folder, "key", ["at"])
    assert told == {"version": 1, "rows": 2, "buckets": 1}
    assert rows_of(read_set(spark, folder)) == [("a", 1, "x"), ("b", 2, "v")]
    # Readers of the old version go on with it.
    assert rows_of(pinned) == rows_of(read_set(spark, folder, version=0)) == [("a", 1, "x"), ("b", 1, "y")]


def test_half_written_version_table_is_not_read(spark):
    folder = shared_folder(spark)
    load(spark.createDataFrame([("a", 1, "x")], SCHEMA), folder, "key", ["at"], buckets=2)
    os.makedirs(f"{folder.removeprefix('file:')}/versions/v1")
    assert rows_of(read_set(spark, folder)) == [("a", 1, "x")]
    assert load(spark.createDataFrame([("a", 3, "y")], SCHEMA), folder, "key", ["at"])["version"] == 1
    assert rows_of(read_set(spark, folder)) == [("a", 3, "y")]


def test_old_versions_go(spark):
    folder = shared_folder(spark)
    for turn in range(3):
        load(spark.createDataFrame([(f"k{i}", turn, "x") for i in range(turn, 20)], SCHEMA), folder, "key", ["at"], buckets=8)
    want = rows_of(read_set(spark, folder))
    assert remove_old_versions(spark, folder) > 0
    assert rows_of(read_set(spark, folder)) == want and len(want) == 20
    assert remove_old_versions(spark, folder) == 0


def test_a_key_with_most_rows_and_odd_batches(spark):
    folder = shared_folder(spark)
    hot = spark.range(20000).select(F.lit("hot").alias("key"), F.col("id").cast("int").alias("at"), F.lit("x").alias("body"))
    assert load(hot, folder, "key", ["at"], buckets=4)["rows"] == 1
    assert load(hot.limit(0), folder, "key", ["at"]) == {"version": 1, "rows": 1, "buckets": 0}
    assert rows_of(read_set(spark, folder)) == [("hot", 19999, "x")]
    gone = hot.limit(1).withColumn("gone", F.lit(True))
    assert load(gone, folder, "key", ["at"], deleted_col="gone")["rows"] == 0
    assert rows_of(read_set(spark, folder)) == []
    with pytest.raises(Exception, match="no key"):
        load(spark.createDataFrame([(None, 1, "x")], SCHEMA), folder, "key", ["at"])
    with pytest.raises(ValueError, match="columns"):
        load(spark.createDataFrame([("a", 1)], "key string, at int"), folder, "key", ["at"])
    with pytest.raises(ValueError, match="no set"):
        read_set(spark, shared_folder(spark))
