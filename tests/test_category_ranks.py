import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stayscope.operators.category_ranks import add_frequency_index, frequency_ranks
from stayscope.operators.features import category_index


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(6)
    values = [rng.choice(["hot", f"v{rng.randrange(900)}", "é", "", None]) for _ in range(4000)]
    return values, spark.createDataFrame(list(enumerate(values)), "id int, value string").repartition(5)


def test_ranks_by_count_then_value_over_several_ranges(spark, rows):
    values, df = rows
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = frequency_ranks(df, "value")
        got = sorted((r["index"], r.value, r.rows) for r in found.collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    counts = Counter(v for v in values if v is not None)
    want = sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))
    assert got == [(i, v, n) for i, (v, n) in enumerate(want)] and len(got) > 500


def test_equals_the_indexer_of_the_model_pipeline(rows):
    _, df = rows
    mine = {r.id: r.value_index for r in add_frequency_index(df, "value").collect()}
    theirs = {r.id: r.value_index for r in category_index(df, "value").collect()}
    assert mine == theirs and len(mine) == 4000


def test_unseen_values_null_and_no_rows(spark, rows):
    _, df = rows
    ranks = frequency_ranks(df.filter("value in ('hot', 'v1', 'v2')"), "value")
    other = spark.createDataFrame([("hot", 1), ("unseen", 2), (None, 3)], "value string, rows int")
    got = {r.rows: r.place for r in add_frequency_index(other, "value", "place", ranks).collect()}
    assert got[1] == 0.0 and got[2] == got[3] == ranks.count()
    assert add_frequency_index(df.limit(0), "value").count() == 0
    assert frequency_ranks(df.limit(0), "value").count() == 0
    assert add_frequency_index(df.select(F.lit(None).cast("string").alias("value")), "value").filter("value_index <> 0").isEmpty()
