"""An inverted file of vectors: coarse cells, residual codes, exact scores at the end.

Vectors are filed under the nearest of some centres. In its cell a vector is
held as a byte per dimension of what its centre leaves, with the length of the
rounding error, so a rough score comes with bounds. A search reads the cells
nearest to a question, keeps what the bounds do not rule out, and scores these
rows by their whole vectors. With `exact` it goes on to every cell whose
members could still be among the best.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, isqrt

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stayscope.functions.vectors import dot, unit
from stayscope.operators.keyword_search import top_k
from stayscope.operators.lookup import lookup_join
from stayscope.operators.vector_search import _units
from stayscope.session import shared_folder
from stayscope.sources.files import write_table

#: Centres are fitted on at most about so many rows, chosen by a hash of the id; every row is filed.
SAMPLE_ROWS = 200_000
#: The centres go to every task, as do the questions of one block.
CENTRE_BYTES = 64 << 20
BLOCK_BYTES = 64 << 20
#: Questions of a block times cells: each task is told which question asks which cell.
BLOCK_CELLS = 8 << 20
#: Candidates that a task holds; beyond, it drops what later bounds rule out and hands on the rest.
HELD_CANDIDATES = 1 << 20
#: Of the cells, the share that a question asks: enough for vectors nearly unrelated to each other. Others need less.
SHARE = 0.6
#: Rows and questions whose rough scores are held at once.
TILE = 1 << 21
#: Rough scores are sums in single precision: they differ from the true ones by less than this beside the bound.
SLACK = 1e-5


@dataclass
class VectorIndex:
    """cells: doc_id, cell, twin (a hash of the vector), code, scale, error. centres: cell, centre, rows, least (cosine to it)."""

    vectors: DataFrame
    cells: DataFrame
    centres: DataFrame

    @staticmethod
    def read(spark: SparkSession, folder: str, vectors: DataFrame, id_col: str = "doc_id",
             vector_col: str = "embedding") -> "VectorIndex":
        """An index written before, beside the vectors it was built from."""
        rows = vectors.select(F.col(id_col).alias("doc_id"), F.col(vector_col).cast("array<double>").alias("_v"))
        return VectorIndex(rows, spark.read.parquet(f"{folder}/cells"), spark.read.parquet(f"{folder}/centres"))


def _pointing(vector: Column) -> Column:
    """The vector is there and is not zero."""
    return vector.isNotNull() & F.exists(vector, lambda x: x != 0)


def fit_centres(rows: DataFrame, cells: int | None, seed: int) -> np.ndarray:
    """Unit centres of a sample of `_v`: as many as the root of the rows, within CENTRE_BYTES, unless given."""
    pointed = rows.filter(_pointing(F.col("_v")))
    n = pointed.count()
    if not n:
        return np.empty((0, 0))
    dims = pointed.select(F.size("_v")).first()[0]
    cells = min(cells or isqrt(n - 1) + 1, CENTRE_BYTES // (8 * dims))
    sample = pointed
    if n > SAMPLE_ROWS:
        share = round(SAMPLE_ROWS / n * (1 << 30))
        sample = pointed.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share)
    model = KMeans(k=cells, seed=seed, maxIter=10, distanceMeasure="cosine").fit(
        sample.select(array_to_vector(unit(F.col("_v"))).alias("features"))
    )
    centres = np.array(model.clusterCenters())
    return centres / np.linalg.norm(centres, axis=1, keepdims=True)


def _filed(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """Every vector that is not zero, in the cell of its nearest centre."""
    schema = T.StructType([
        T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("cell", T.IntegerType()),
        T.StructField("twin", T.LongType()), T.StructField("code", T.BinaryType()),
        T.StructField("scale", T.FloatType()), T.StructField("error", T.FloatType()),
        T.StructField("near", T.DoubleType()),
    ])
    arrow = to_arrow_schema(schema)
    sent = rows.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for begin in range(0, batch.num_rows, max(1, TILE // len(known))):
                part = batch.slice(begin, max(1, TILE // len(known)))
                at, matrix = _units(pa.table(part), "_v")
                if not len(at):
                    continue
                near = matrix @ known.T
                cell = near.argmax(axis=1)
                rest = matrix - known[cell]
                scale = np.maximum(np.abs(rest).max(axis=1) / 127, 1e-12).astype(np.float32)
                code = np.rint(rest / scale[:, None]).clip(-127, 127).astype(np.int8)
                error = np.linalg.norm(rest - scale[:, None].astype(np.float64) * code, axis=1)
                taken = pa.array(at)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(taken), pa.array(cell, pa.int32()), part.column("twin").take(taken),
                    pa.array([row.tobytes() for row in code], pa.binary()), pa.array(scale),
                    pa.array(np.nextafter(error.astype(np.float32), np.float32(4))), pa.array(near.max(axis=1)),
                ], schema=arrow)

    return rows.na.drop().withColumn("twin", F.xxhash64("_v")).select("doc_id", "_v", "twin").mapInArrow(run, schema)


def write_vector_index(
    vectors: DataFrame, folder: str, cells: int | None = None, id_col: str = "doc_id", vector_col: str = "embedding",
    seed: int = 7,
) -> VectorIndex:
    """Fit the centres, file every row, write the index and return the one that reads it.

    The rows are dealt by ranges of cell and vector, so a cell with a third of
    all rows lies in several files, and a search reads the row groups of its
    cells only.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("doc_id"), F.col(vector_col).cast("array<double>").alias("_v"))
    centres = fit_centres(rows, cells, seed)
    order = ["cell", "twin", "doc_id"]
    filed = _filed(rows, centres) if len(centres) else _filed(rows.limit(0), np.zeros((1, 1)))
    write_table(filed.repartitionByRange(*order).sortWithinPartitions(*order), f"{folder}/cells")
    held = spark.read.parquet(f"{folder}/cells").groupBy("cell").agg(
        F.count(F.lit(1)).alias("rows"), F.min("near").alias("least"))
    table = spark.createDataFrame([(i, c) for i, c in enumerate(centres.tolist())], "cell int, centre array<double>")
    write_table(table.join(held, "cell"), f"{folder}/centres")
    return VectorIndex.read(spark, folder, vectors, id_col, vector_col)


@dataclass
class _Block:
    """Questions of one pass, and for each cell that is asked the questions that ask it."""

    questions: np.ndarray
    centres: dict[int, np.ndarray]
    asked: dict[int, np.ndarray]
    k: int


class _Kept:
    """Of each question, the rows of a task that its bounds do not rule out."""

    def __init__(self, block: _Block):
        self.block = block
        self.lower = np.full((len(block.questions), block.k), -np.inf, dtype=np.float32)
        self.found: list[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, cell: int, ids: pa.Array, codes: np.ndarray, scale: np.ndarray, error: np.ndarray) -> None:
        asked = self.block.asked[cell]
        step = max(1, TILE // len(ids))
        for begin in range(0, len(asked), step):
            who = asked[begin:begin + step]
            questions = self.block.questions[who]
            rough = (questions @ codes.T) * scale + (questions @ self.block.centres[cell])[:, None]
            low, high = rough - error - np.float32(SLACK), rough + error + np.float32(SLACK)
            both = np.concatenate([self.lower[who], low], axis=1)
            self.lower[who] = np.partition(both, both.shape[1] - self.block.k, axis=1)[:, -self.block.k:]
            q, row = np.nonzero(high >= self.lower[who].min(axis=1)[:, None])
            if len(q):
                self.found.append((who[q].astype(np.int32), ids.take(pa.array(row)), low[q, row], high[q, row]))
                self.held += len(q)

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        floor = self.lower.min(axis=1)
        for question, ids, low, high in self.found:
            stays = np.flatnonzero(high >= floor[question])
            if len(stays):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(question[stays], pa.int32()), ids.take(pa.array(stays)), pa.array(low[stays]), pa.array(high[stays])],
                    schema=schema,
                )
        self.found, self.held = [], 0


def _candidates(cells: DataFrame, block: _Block) -> DataFrame:
    """question (its number), doc_id, low and high: what each task keeps of the cells that are asked."""
    schema = T.StructType([
        T.StructField("question", T.IntegerType()), T.StructField("doc_id", cells.schema["doc_id"].dataType),
        T.StructField("low", T.FloatType()), T.StructField("high", T.FloatType()),
    ])
    arrow = to_arrow_schema(schema)
    sent = cells.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, twin, before = _Kept(sent.value), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            # Of equal vectors, which stand together, the first k by id are enough.
            twins = batch.column("twin").to_numpy()
            begins = np.flatnonzero(np.append(True, twins[1:] != twins[:-1]))
            nth = np.arange(len(twins)) - np.repeat(begins, np.diff(np.append(begins, len(twins))))
            first = len(twins) if len(begins) < 2 else begins[1]
            nth[:first] += before if twins[0] == twin else 0
            twin, before = twins[-1], nth[-1] + 1
            part = batch.filter(pa.array(nth < sent.value.k))
            cell = part.column("cell").to_numpy()
            cuts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else []
            for begin, end in zip(cuts, [*cuts[1:], len(cell)]):
                if int(cell[begin]) in sent.value.asked:
                    run_of = part.slice(begin, end - begin)
                    codes = np.frombuffer(b"".join(run_of.column("code").to_pylist()), dtype=np.int8)
                    kept.add(int(cell[begin]), run_of.column("doc_id"), codes.reshape(end - begin, -1).astype(np.float32),
                             run_of.column("scale").to_numpy(), run_of.column("error").to_numpy())
                    if kept.held > HELD_CANDIDATES:
                        yield from kept.batches(arrow)
        yield from kept.batches(arrow)

    named = cells.filter(F.col("cell").isin(sorted(block.asked)))
    return named.select("doc_id", "cell", "twin", "code", "scale", "error").mapInArrow(run, schema)


def _best(index: VectorIndex, block: _Block, names: DataFrame, k: int) -> DataFrame:
    """query_id, doc_id, score, rank of the best rows of the cells that are asked; exact among these."""
    found = _candidates(index.cells, block)
    lower = top_k(found.select(F.col("question").alias("query_id"), "doc_id", F.col("low").alias("score")), k)
    floor = lower.filter(F.col("rank") == k).select(F.col("query_id").alias("question"), F.col("score").alias("floor"))
    near = found.join(F.broadcast(floor), "question", "left").filter("floor is null or high >= floor")
    near = near.join(F.broadcast(names), "question").select("query_id", "doc_id", "_q")
    scored = lookup_join(index.vectors, near, ["doc_id"]).select(
        "query_id", "doc_id", dot(unit(F.col("_v")), F.col("_q")).alias("score"))
    return top_k(scored, k).select("query_id", "doc_id", "score", "rank")


def _probes(share: float, cells: int) -> int:
    return min(cells, max(1, ceil(share * cells)))


def _blocks(questions: DataFrame, dims: int, cells: int = 1) -> Iterator[tuple[list, np.ndarray]]:
    """Ids and unit vectors of the questions that point somewhere, at most BLOCK_BYTES and BLOCK_CELLS at a time."""
    ids, vectors = [], []
    most = max(1, min(BLOCK_BYTES // (8 * dims), BLOCK_CELLS // cells))
    for row in questions.filter(_pointing(F.col("_v"))).toLocalIterator():
        if len(row._v) != dims:
            raise ValueError("questions and rows have vectors of different length")
        vector = np.array(row._v)
        ids.append(row.query_id)
        vectors.append(vector / np.sqrt((vector * vector).sum()))
        if len(ids) >= most:
            yield ids, np.array(vectors)
            ids, vectors = [], []
    if ids:
        yield ids, np.array(vectors)


def knn_cells(
    index: VectorIndex, questions: DataFrame, k: int = 5, share: float = SHARE, exact: bool = False,
    query_col: str = "query_id", vector_col: str = "embedding",
) -> DataFrame:
    """query_id, doc_id, score, rank: the k nearest rows by cosine, of that share of the cells, the nearest to each question.

    No candidate of these cells is lost: the bounds of the codes decide which
    rows are scored by their vectors, however many these are. With `exact`,
    the cells that are left are asked too, where the angle from question to
    centre, less the widest of the cell, allows a better row than the k-th
    found; the result is then that of `knn_topk`.

    The questions are a query set in blocks of BLOCK_BYTES, sent to the tasks
    that scan the cells; the cells are not shuffled. A zero vector points
    nowhere: it is no hit and has none. Equal scores go by id.
    """
    spark = questions.sparkSession
    held = sorted(index.centres.toLocalIterator(), key=lambda r: r.cell)
    asked = questions.select(F.col(query_col).alias("query_id"), F.col(vector_col).cast("array<double>").alias("_v"))
    empty = spark.createDataFrame([], T.StructType([
        asked.schema["query_id"], index.cells.schema["doc_id"],
        T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType()),
    ]))
    if not held:
        return empty
    cells, centres = np.array([r.cell for r in held]), np.array([r.centre for r in held])
    widest = np.arccos(np.clip([r.least for r in held], -1, 1))
    kind = T.StructType([T.StructField("question", T.IntegerType()), asked.schema["query_id"],
                         T.StructField("_q", T.ArrayType(T.DoubleType()))])
    out = []
    for ids, matrix in _blocks(asked, centres.shape[1], len(cells)):
        names = spark.createDataFrame([(i, x, v) for i, (x, v) in enumerate(zip(ids, matrix.tolist()))], kind)
        near = matrix @ centres.T
        chosen = np.zeros(near.shape, dtype=bool)
        most = _probes(share, len(cells))
        np.put_along_axis(chosen, np.argpartition(-near, most - 1, axis=1)[:, :most], True, axis=1)

        def pass_over(which: np.ndarray) -> DataFrame:
            columns = [j for j in range(len(cells)) if which[:, j].any()]
            block = _Block(matrix.astype(np.float32), {int(cells[j]): centres[j].astype(np.float32) for j in columns},
                           {int(cells[j]): np.flatnonzero(which[:, j]).astype(np.int32) for j in columns}, k)
            return _best(index, block, names, k)

        hits = pass_over(chosen)
        if exact and most < len(cells):
            folder = shared_folder(spark)
            write_table(hits, f"{folder}/probed")
            hits = spark.read.parquet(f"{folder}/probed")
            reached = np.full(len(ids), -np.inf)
            place = {x: i for i, x in enumerate(ids)}
            # A row per question of the block.
            for row in hits.filter(F.col("rank") == k).select("query_id", "score").toLocalIterator():
                reached[place[row.query_id]] = row.score
            angle = np.arccos(np.clip(near, -1, 1)) - widest
            more = ~chosen & (np.cos(np.maximum(angle, 0)) + SLACK >= reached[:, None])
            if more.any():
                both = hits.drop("rank").unionByName(pass_over(more).drop("rank"))
                hits = top_k(both, k).select("query_id", "doc_id", "score", "rank")
        out.append(hits)
    found = out[0] if out else empty
    for hits in out[1:]:
        found = found.unionByName(hits)
    return found


def rows_read(index: VectorIndex, questions: DataFrame, share: float = SHARE, query_col: str = "query_id",
              vector_col: str = "embedding") -> DataFrame:
    """query_id and rows: how many rows the nearest cells of each question hold."""
    centres = index.centres.select("cell", "centre", "rows")
    asked = questions.select(F.col(query_col).alias("query_id"), F.col(vector_col).cast("array<double>").alias("_q"))
    # The centres are a bounded table that is sent to every task anyway.
    near = asked.join(F.broadcast(centres.groupBy().agg(F.collect_list(F.struct("cell", "centre", "rows")).alias("all"))))
    scored = F.transform("all", lambda c: F.struct((-dot(c["centre"], F.col("_q"))).alias("far"), c["rows"].alias("rows")))
    first = F.slice(F.array_sort(scored), 1, F.greatest(F.lit(1), F.ceil(F.size("all") * share)).cast("int"))
    return near.select("query_id", F.aggregate(first, F.lit(0).cast("bigint"), lambda a, c: a + c["rows"]).alias("rows"))
