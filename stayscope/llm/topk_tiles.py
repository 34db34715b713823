"""Exact top-k by inner product: tiled matrix products and merged top lists.

Vectors are packed into blocks: tiles of queries and shards of candidates. Each
tile meets each shard once, through a join on the numbers of tile and group of
shards. A task multiplies sub-tiles, selects each query's best k of a sub-tile,
and merges them into the tile's running list; the lists of a tile over a group
of shards are one row set, and a last merge per query joins the groups.

The cells of tile and group form a grid: every candidate is copied once per
tile, every query once per group. Tiles are as large as a task may hold, and
groups, whose shards stream through it, as large as leave work for all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stayscope.llm.batches import bound_batches

TILE = 16_384
SHARD = 8192
#: Shards of a group at most: a task's work stays bounded, and so does what a lost executor costs.
FAN = 64
#: Cells asked for per shuffle partition, where there are enough shards.
WAVES = 4
#: Queries whose products with a shard are held at once.
STRIPE = 256

_PACKED = "dim int, block int, ids array<bigint>, kind string, data binary"


def quantised(vectors: DataFrame, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and v: each component times the scale, rounded down, as double.

    Left out: rows without an id, null vectors, and vectors that hold a null
    or a component that is not finite.
    """
    rows = vectors.select(
        vectors[id_col].cast("bigint").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("x")
    )
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & finite).select(
        "vec_id", F.transform("x", lambda c: F.floor(c * scale).cast("double")).alias("v")
    )


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of each query.

    Both inputs have vec_id and v (whole numbers as double), as `quantised`
    gives them. Candidates with the query's own id take no part; ties go to
    the smaller vec_id; all are returned if there are fewer than k. Only
    vectors of equal length are compared. Repeated candidates are each ranked;
    of queries that share an id the smallest vector asks. Scores beyond 64
    bits raise.
    """
    spark = candidates.sparkSession
    bound_batches(spark)
    asked = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    many_tiles, many_shards = _count(asked, TILE), _count(candidates, SHARD)
    cells_asked = WAVES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    fan = max(1, min(FAN, many_shards * many_tiles // cells_asked))
    many_fans = -(-many_shards // fan)
    tiles = _blocks(asked, many_tiles)
    shards = _blocks(candidates.select("vec_id", "v"), many_shards).withColumn("fan", F.floor(F.col("block") / fan).cast("int"))
    # Each tile goes to every group of shards, each shard to every tile: N x tiles + Q x groups rows in all.
    left = tiles.select(
        "dim", F.col("block").alias("tile"), F.col("ids").alias("q_ids"), F.col("kind").alias("q_kind"),
        F.col("data").alias("q_data"), F.explode(F.sequence(F.lit(0), F.lit(many_fans - 1))).alias("fan"),
    )
    right = shards.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(many_tiles - 1))))
    cells = left.join(right, ["dim", "tile", "fan"]).select(
        "dim", "tile", "fan", "q_ids", "q_kind", "q_data", "ids", "kind", "data"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, lists = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                now = tuple(row.column(c)[0].as_py() for c in ("dim", "tile", "fan"))
                if now != key and lists is not None:
                    yield _rows(q_ids, lists)
                    lists = None
                key, q_ids = now, row.column("q_ids").flatten().to_numpy()
                q, c = _matrix(row, "q_"), _matrix(row, "")
                lists = _merge(lists, _best(q_ids, q, row.column("ids").flatten().to_numpy(), c, k), k)
        if lists is not None:
            yield _rows(q_ids, lists)

    best = cells.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def _count(rows: DataFrame, size: int) -> int:
    return max(1, -(-rows.count() // size))


def _blocks(rows: DataFrame, blocks: int) -> DataFrame:
    """Rows dealt by a hash of their id into `blocks` blocks, each one row in the smallest integer type.

    Copies of one id would meet in one block, so the hash takes the vector as well.
    """
    dealt = rows.select(
        F.size("v").alias("dim"), F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int").alias("block"), "vec_id", "v"
    )

    def pack(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("vec_id")
        flat = table.column("v").combine_chunks().flatten().to_numpy()
        largest = np.abs(flat).max(initial=0)
        if largest >= 2.0**63:
            raise ValueError("a component beyond 64 bits")
        kind = next(t for t in ("int8", "int16", "int32", "int64") if largest < 2.0 ** (8 * np.dtype(t).itemsize - 1))
        one = np.array([0, table.num_rows], dtype=np.int32)
        return pa.table({
            "dim": table.column("dim").slice(0, 1), "block": table.column("block").slice(0, 1),
            "ids": pa.ListArray.from_arrays(one, table.column("vec_id").combine_chunks()),
            "kind": pa.array([kind]), "data": pa.array([flat.astype(kind).tobytes()], pa.binary()),
        })

    return dealt.groupBy("dim", "block").applyInArrow(pack, _PACKED)


def _matrix(row: pa.RecordBatch, side: str) -> np.ndarray:
    flat = np.frombuffer(row.column(f"{side}data")[0].as_buffer(), dtype=row.column(f"{side}kind")[0].as_py())
    return flat.reshape(len(row.column(f"{side}ids").flatten()), row.column("dim")[0].as_py())


def _largest(matrix: np.ndarray) -> float:
    """The largest absolute component; no copy of the matrix is made."""
    return max(-float(matrix.min(initial=0)), float(matrix.max(initial=0)))


def _best(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Query numbers, candidate ids and scores of each query's best k in a shard, whose ids ascend."""
    dim = q.shape[1]
    bound = dim * _largest(q) * _largest(c)
    if bound >= 2.0**63:
        raise ValueError("scores beyond 64 bits")
    # Products below 2^53 are exact in double, where the fast product is.
    kind = np.float64 if bound < 2.0**53 else np.int64
    c = np.ascontiguousarray(c.astype(kind).T)
    low = np.searchsorted(ids, q_ids, side="left")
    high = np.searchsorted(ids, q_ids, side="right")
    out = []
    for begin in range(0, len(q), STRIPE):
        scores = q[begin:begin + STRIPE].astype(kind) @ c
        own = np.zeros(scores.shape, dtype=bool)
        for i in np.flatnonzero(high[begin:begin + STRIPE] > low[begin:begin + STRIPE]).tolist():
            own[i, low[begin + i]:high[begin + i]] = True
        least = -np.inf if kind is np.float64 else np.iinfo(np.int64).min
        scores[own] = least
        n = scores.shape[1]
        if n > k:
            threshold = np.partition(scores, n - k, axis=1)[:, n - k]
            row, col = np.nonzero((scores >= threshold[:, None]) & ~own)
        else:
            row, col = np.nonzero(~own)
        out.append(_first_k(row + begin, ids[col], scores[row, col].astype(np.int64), k))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 3


def _first_k(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    order = np.lexsort((ids, -scores, query))
    query, ids, scores = query[order], ids[order], scores[order]
    place = np.arange(len(query)) - np.searchsorted(query, query, side="left")
    keep = place < k
    return query[keep], ids[keep], scores[keep]


def _merge(a: tuple | None, b: tuple, k: int) -> tuple:
    if a is None:
        return b
    return _first_k(*(np.concatenate(x) for x in zip(a, b)), k)


def _rows(q_ids: np.ndarray, lists: tuple) -> pa.RecordBatch:
    query, ids, scores = lists
    return pa.RecordBatch.from_arrays(
        [pa.array(q_ids[query], pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())],
        names=["query_id", "vec_id", "score"],
    )
