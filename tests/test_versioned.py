"""Tables replaced as a whole, the board of several loads, and the curve of bounded size."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stayscope.operators import metrics
from stayscope.plans.board import add_to_board, board, held_board
from stayscope.session import shared_folder
from stayscope.sources.versioned import last_version, read_version, remove_versions, replace_tables

REVIEWS = "review_date timestamp, rating double, sentiment int, region string, city string, name string"


def ids(df):
    return sorted(r.id for r in df.collect())


def test_a_write_that_fails_half_way_leaves_the_old_tables(spark):
    folder = shared_folder(spark)
    assert last_version(spark, folder) is None
    with pytest.raises(ValueError):
        read_version(spark, folder, "a")
    replace_tables(spark, folder, {"a": spark.range(3), "b": spark.range(1)})
    old = read_version(spark, folder, "a")
    broken = spark.range(9).withColumn("id", F.when(F.col("id") == 8, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        replace_tables(spark, folder, {"a": spark.range(9), "b": broken})
    assert ids(read_version(spark, folder, "a")) == [0, 1, 2] and ids(read_version(spark, folder, "b")) == [0]
    version = replace_tables(spark, folder, {"a": read_version(spark, folder, "a").filter("id > 0"), "b": spark.range(2)})
    assert version == last_version(spark, folder) == 2
    assert ids(read_version(spark, folder, "a")) == [1, 2] and ids(old) == [0, 1, 2]
    assert ids(read_version(spark, folder, "a", 0)) == [0, 1, 2]
    assert remove_versions(spark, folder) == 2
    assert ids(read_version(spark, folder, "a")) == [1, 2]
    with pytest.raises(ValueError):
        read_version(spark, folder, "a", 1)


def shown(charts):
    return {name: sorted(map(str, df.collect())) for name, df in charts.items()}


def test_board_after_loads_is_that_of_all_rows(spark):
    rows = [(datetime(2020, 1 + n % 5, 1 + n % 28, n % 24), float(n % 6), n % 2, None if n % 7 == 0 else f"R{n % 8}", f"C{n % 13}", "x")
            for n in range(200)] + [(None, 1.0, 1, "R1", "C1", "x")] * 3
    table = spark.createDataFrame(rows, REVIEWS)
    folder = shared_folder(spark)
    for n, part in enumerate([rows[:70], [], rows[70:90], rows[90:]]):
        add_to_board(spark.createDataFrame(part, REVIEWS), folder, f"load {n}")
    version = last_version(spark, folder)
    assert add_to_board(spark.createDataFrame(rows[:70], REVIEWS), folder, "load 0") == version
    for low, high in (("2020-01-01", "2020-12-31"), ("2020-02-10", "2020-04-03")):
        assert shown(held_board(spark, folder, low, high)) == shown(board(table, low, high))
    first = board(spark.createDataFrame(rows[:70], REVIEWS), "2020-01-01", "2020-12-31")
    assert shown(held_board(spark, folder, "2020-01-01", "2020-12-31", version=0)) == shown(first)
    with pytest.raises(ValueError):
        held_board(spark, folder, "2020-01-01 10:00:00", "2020-12-31")


def test_old_rows_are_not_read_by_a_load(spark):
    folder = shared_folder(spark)
    old, new = f"{folder}/old", f"{folder}/new"
    row = (datetime(2020, 1, 1), 1.0, 1, "R", "C", "x")
    for path in (old, new):
        spark.createDataFrame([row], REVIEWS).write.parquet(path)
    add_to_board(spark.read.parquet(old), f"{folder}/board", "old")
    spark.read.parquet(new).write.mode("overwrite").parquet(old)  # other files now: a plan over the old ones would fail
    add_to_board(spark.read.parquet(new), f"{folder}/board", "new")
    assert read_version(spark, f"{folder}/board", "counts").first().reviews == 2


@pytest.mark.parametrize("points", [1, 7, 100, 5000])
def test_curve_of_bounded_size(spark, points):
    rows = [(n * 7 % 3 == 0, round(n * 37 % 1000 / 7, 1) if n % 4 else 3.0) for n in range(2000)]
    df = spark.createDataFrame([(int(a), 1.0, b) for a, b in rows], "sentiment int, prediction double, score double")
    whole = {(r.score, r.tp, r.fp, r.tpr, r.fpr) for r in metrics.roc(df).collect()}
    found = {tuple(r) for r in metrics.roc_bounded(df, points=points).collect()}
    assert found <= whole and len(found) <= points
    every = sorted(tp + fp for _, tp, fp, _, _ in whole)
    places = [0] + sorted(tp + fp for _, tp, fp, _, _ in found)
    assert places[-1] == 2000
    for a, b in zip(places, places[1:]):
        assert b - min(n for n in every if n > a) < 2000 / points
    assert points < 5000 or found == whole


def test_curve_without_rows_or_a_class(spark):
    schema = "sentiment int, prediction double, score double"
    assert metrics.roc_bounded(spark.createDataFrame([], schema)).count() == 0
    one = metrics.roc_bounded(spark.createDataFrame([(1, 1.0, 0.5), (1, 1.0, None), (None, 1.0, 0.1)], schema)).collect()
    assert [tuple(r) for r in one] == [(0.5, 1, 0, 1.0, None)]
