"""Vector top-k by cosine: exact, and by locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stayscope.functions.vectors import dot, unit
from stayscope.operators.keyword_search import top_k

#: Every row is copied once per block of questions, so blocks are large; products are made a stripe at a time.
QUESTION_BLOCK = 8192
SHARD_ROWS = 16_384
#: Questions whose products with a shard are held at once.
STRIPE = 256
#: Fast products differ from sums in fixed order by less than this.
PRODUCT_ERROR = 1e-9


def _hit_schema(vectors: DataFrame, questions: DataFrame, id_col: str, query_col: str) -> T.StructType:
    return T.StructType([
        T.StructField("query_id", questions.schema[query_col].dataType),
        T.StructField("doc_id", vectors.schema[id_col].dataType),
        T.StructField("score", T.DoubleType()),
    ])


def _parts(rows: DataFrame, size: int) -> int:
    return max(1, -(-rows.count() // size))


def _units(table: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the rows whose vector is not zero, and these vectors at length one."""
    vectors = table.column(column).combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(vectors) == 0:
        return np.empty(0, np.int64), np.empty((0, 0))
    if len(flat) % len(vectors) or len(set(np.diff(vectors.offsets.to_numpy()))) > 1:
        raise ValueError("rows have vectors of different length")
    matrix = flat.reshape(len(vectors), -1)
    lengths = np.sqrt((matrix * matrix).sum(axis=1))
    keep = np.flatnonzero(lengths > 0)
    return keep, np.ascontiguousarray(matrix[keep] / lengths[keep, None])


def _best_of_cell(k: int, schema: pa.Schema):
    """Function from a shard of rows and a block of questions to the best k per question.

    A fast product finds the rows that can be among the best; these are scored
    again by sums in one fixed order, so copies of a vector tie exactly.
    """
    def score(rows: pa.Table, asked: pa.Table) -> pa.Table:
        at, matrix = _units(rows, "_v")
        asked_at, questions = _units(asked, "_v")
        if not len(at) or not len(asked_at):
            return schema.empty_table()
        if matrix.shape[1] != questions.shape[1]:
            raise ValueError("questions and rows have vectors of different length")
        ids = rows.column("_id").to_numpy()[at]
        order = np.argsort(ids, kind="stable")
        at, matrix = at[order], matrix[order]
        depth = min(k, len(at))
        found: list[tuple[int, np.ndarray, np.ndarray]] = []
        for begin in range(0, len(asked_at), STRIPE):
            rough = questions[begin:begin + STRIPE] @ matrix.T
            floor = np.partition(rough, len(at) - depth, axis=1)[:, len(at) - depth] - PRODUCT_ERROR
            for q, products in enumerate(rough, begin):
                near = np.flatnonzero(products >= floor[q - begin])
                exact = (matrix[near] * questions[q]).sum(axis=1)
                best = np.argsort(-exact, kind="stable")[:depth]
                found.append((asked_at[q], at[near[best]], exact[best]))
        sizes = [len(x[1]) for x in found]
        return pa.table([
            asked.column("_id").take(pa.array(np.repeat([x[0] for x in found], sizes))),
            rows.column("_id").take(pa.array(np.concatenate([x[1] for x in found]))),
            pa.array(np.concatenate([x[2] for x in found])),
        ], schema=schema)

    return score


def knn_topk(
    vectors: DataFrame,
    questions: DataFrame,
    k: int = 5,
    candidates: int | None = None,
    id_col: str = "doc_id",
    query_col: str = "query_id",
    vector_col: str = "embedding",
    block: int = QUESTION_BLOCK,
    shard: int = SHARD_ROWS,
    **hashing,
) -> DataFrame:
    """query_id, doc_id, score, rank: the k nearest rows by cosine.

    Exact unless `candidates` is given. Rows are dealt into shards and
    questions into blocks by a hash of their ids; every shard meets every
    block in one task of one plan, which multiplies their matrices and keeps k
    rows per question. A zero vector points nowhere: it is no hit and has none.

    With `candidates`, see `knn_lsh`.
    """
    if candidates is not None:
        return knn_lsh(vectors, questions, k, candidates, id_col, query_col, vector_col, **hashing)
    schema = _hit_schema(vectors, questions, id_col, query_col)
    value = F.col(vector_col).cast("array<double>").alias("_v")
    rows = vectors.select(F.col(id_col).alias("_id"), value).na.drop()
    asked = questions.select(F.col(query_col).alias("_id"), value).na.drop()
    shards, blocks = _parts(rows, shard), _parts(asked, block)

    def dealt(table: DataFrame, parts: int, own: str, other_parts: int, other: str) -> DataFrame:
        """The rows with their own part, repeated for each part of the other side."""
        placed = table.withColumn(own, F.pmod(F.xxhash64("_id"), F.lit(parts)).cast("int"))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(other_parts - 1))))

    left = dealt(rows, shards, "_shard", blocks, "_block").groupBy("_shard", "_block")
    right = dealt(asked, blocks, "_block", shards, "_shard").groupBy("_shard", "_block")
    scored = left.cogroup(right).applyInArrow(_best_of_cell(k, to_arrow_schema(schema)), schema)
    return top_k(scored, k).select("query_id", "doc_id", "score", "rank")


@lru_cache(maxsize=8)
def planes(dims: int, count: int) -> np.ndarray:
    """Random hyperplanes with components 1 and -1, the same everywhere: dims x count."""
    signs = [[1.0 if md5(f"{h}:{d}".encode()).hexdigest()[0] < "8" else -1.0 for h in range(count)] for d in range(dims)]
    return np.array(signs).reshape(dims, count)


def _band_keys(table: DataFrame, id_col: str, vector_col: str, out: str, bands: int, per_band: int) -> DataFrame:
    """The id, `_band` and `_key` of every vector that is not zero: the sides of the band's planes it lies on."""
    kind = table.schema[id_col].dataType
    schema = T.StructType([T.StructField(out, kind), T.StructField("_keys", T.ArrayType(T.LongType()))])
    arrow = to_arrow_schema(schema)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, matrix = _units(pa.table(batch), "_v")
            if len(at):
                above = matrix @ planes(matrix.shape[1], bands * per_band) > 0
                place = above.reshape(len(at), bands, per_band) @ (1 << np.arange(per_band))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(at) + 1, dtype=np.int32) * bands), pa.array(place.ravel().astype(np.int64))
                )
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), lists], schema=arrow)

    rows = table.select(F.col(id_col), F.col(vector_col).cast("array<double>").alias("_v")).na.drop()
    return rows.mapInArrow(keys, schema).select(out, F.posexplode("_keys").alias("_band", "_key"))


def lsh_candidates(
    vectors: DataFrame, questions: DataFrame, candidates: int, id_col: str = "doc_id", query_col: str = "query_id",
    vector_col: str = "embedding", bands: int = 24, per_band: int = 6,
) -> DataFrame:
    """query_id, doc_id: for each question at most `candidates` rows, those that share most bands with it.

    Ids and keys travel, no vectors; a row none of whose keys a question has
    is dropped in the join. Rows that share equally many bands go by id.
    """
    of_rows = _band_keys(vectors, id_col, vector_col, "doc_id", bands, per_band)
    of_questions = _band_keys(questions, query_col, vector_col, "query_id", bands, per_band)
    shared = of_rows.join(of_questions, ["_band", "_key"]).groupBy("query_id", "doc_id").agg(F.count("*").alias("score"))
    return top_k(shared, candidates).select("query_id", "doc_id")


def knn_lsh(
    vectors: DataFrame,
    questions: DataFrame,
    k: int = 5,
    candidates: int = 100,
    id_col: str = "doc_id",
    query_col: str = "query_id",
    vector_col: str = "embedding",
    bands: int = 24,
    per_band: int = 6,
) -> DataFrame:
    """Approximate nearest rows: the k best of at most `candidates` rows per question.

    Vectors are hashed by the sides of random hyperplanes they lie on,
    `per_band` planes to a band; see `lsh_candidates` for which rows are
    offered. Only these are scored, exactly, so `candidates` bounds the work
    on vectors. More bands find more, more planes per band offer fewer. A
    question that shares bands with fewer than k rows gets fewer than k.
    """
    offered = lsh_candidates(vectors, questions, candidates, id_col, query_col, vector_col, bands, per_band)

    def pointed(df: DataFrame, old_id: str, new_id: str, out: str) -> DataFrame:
        return df.select(F.col(old_id).alias(new_id), unit(F.col(vector_col).cast("array<double>")).alias(out))

    scored = (
        offered.join(pointed(vectors, id_col, "doc_id", "_v"), "doc_id")
        .join(pointed(questions, query_col, "query_id", "_q"), "query_id")
        .select("query_id", "doc_id", dot(F.col("_v"), F.col("_q")).alias("score"))
    )
    return top_k(scored, k).select("query_id", "doc_id", "score", "rank")


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: the share of exact hits that were found."""
    shared = exact.select("query_id", "doc_id").join(
        found.select("query_id", "doc_id").withColumn("_hit", F.lit(1)), ["query_id", "doc_id"], "left"
    )
    return shared.agg((F.count("_hit") / F.count(F.lit(1))).alias("recall"))
