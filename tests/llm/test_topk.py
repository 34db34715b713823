import math
import random

import numpy as np
import pytest

from stayscope.llm import topk_tiles

SCHEMA = "vec_id bigint, embedding array<float>, rank int"


def brute(rows, k):
    plain = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v, *_ in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in plain if i % 20 == 0}):
        asks = min(v for i, v in plain if i == q)
        scores = sorted((-sum(a * b for a, b in zip(asks, v)), i) for i, v in plain if i != q and len(v) == len(asks))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return out


def search(spark, rows, k):
    vectors = topk_tiles.quantised(spark.createDataFrame(rows, SCHEMA).repartition(3))
    return sorted(map(tuple, topk_tiles.top_k(vectors.filter("vec_id % 20 = 0"), vectors, k).collect()))


@pytest.mark.parametrize("sizes", [(2048, 8192, 16, 256), (3, 7, 2, 2)])
def test_matches_brute_force_with_ties_and_copies(spark, monkeypatch, sizes):
    for name, size in zip(("TILE", "SHARD", "FAN", "STRIPE"), sizes):
        monkeypatch.setattr(topk_tiles, name, size)
    random.seed(3)
    rows = [(i, [random.choice([-1.0, -0.3, 0.0, 0.51, 1.0]) for _ in range(4)], 0) for i in range(150)]
    rows += [(500 + i, [0.5, 0.5, 0.5, 0.5], 1) for i in range(60)]  # a very common vector
    rows += [rows[3], rows[20], (40, [9.0, 9.0, 9.0, 9.0], 0)]  # repeated rows, a shared id
    rows += [(700, None, 0), (701, [None, 1.0, 1.0, 1.0], 0), (702, [float("nan")] * 4, 0), (None, [1.0] * 4, 0),
             (703, [float("inf")] * 4, 0), (720, [1.0, 2.0], 0), (721, [1.0, 1.0], 0), (740, [], 0)]
    assert search(spark, rows, 10) == brute(rows, 10)


def test_large_components(spark):
    rows = [(i, [1e7 + i, -3e6], 0) for i in range(0, 60, 5)]
    assert search(spark, rows, 5) == brute(rows, 5)
    with pytest.raises(Exception, match="beyond 64 bits"):
        search(spark, [(i, [1e12, 1.0], 0) for i in range(3)], 5)


def test_empty_table(spark):
    assert search(spark, [], 5) == []


@pytest.mark.parametrize("waves", [1, 4, 1000])
def test_groups_of_shards_follow_the_tasks_and_change_nothing(spark, monkeypatch, waves):
    for name, size in (("TILE", 3), ("SHARD", 5), ("FAN", 6), ("WAVES", waves)):
        monkeypatch.setattr(topk_tiles, name, size)
    random.seed(8)
    rows = [(i, [random.choice([-1.0, 0.2, 0.9]) for _ in range(3)], 0) for i in range(130)]
    rows += [(1000 + i, [0.9, 0.9, 0.9], 0) for i in range(40)] + [rows[0], rows[20]]
    assert search(spark, rows, 4) == brute(rows, 4)
