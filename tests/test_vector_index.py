import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from stayscope.operators import vector_index
from stayscope.operators.vector_index import VectorIndex, knn_cells, rows_read, write_vector_index
from stayscope.operators.vector_search import knn_topk, recall
from stayscope.session import shared_folder

ROWS = "doc_id bigint, embedding array<double>"
ASKED = "query_id bigint, embedding array<double>"


def hits(df):
    return sorted((r.query_id, r["rank"], r.doc_id, round(r.score, 9)) for r in df.collect())


@pytest.fixture(scope="module")
def space(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + 0.3 * rng.normal(size=16)).tolist()) for i in range(600)]
    copied = rows[0][1]
    rows += [(1000 + i, copied) for i in range(300)] + [(2000, None), (2001, [0.0] * 16), (2002, (2 * np.array(copied)).tolist())]
    asked = [(1, copied), (2, [0.0] * 16), (3, None)] + [(10 + i, (centres[i] + rng.normal(size=16)).tolist()) for i in range(8)]
    vectors = spark.createDataFrame(rows, ROWS).repartition(4)
    return vectors, spark.createDataFrame(asked, ASKED), write_vector_index(vectors, shared_folder(spark))


@pytest.mark.parametrize("share", [0.01, 0.3, 1.0])
def test_exact_equals_all_pairs(space, share):
    vectors, asked, index = space
    assert hits(knn_cells(index, asked, 5, share, exact=True)) == hits(knn_topk(vectors, asked, 5))


def test_more_neighbours_than_copies_and_than_rows(space):
    vectors, asked, index = space
    few = asked.filter("query_id < 12")
    assert hits(knn_cells(index, few, 400, 0.1, exact=True)) == hits(knn_topk(vectors, few, 400))
    assert hits(knn_cells(index, few, 2000, 1.0)) == hits(knn_topk(vectors, few, 2000))


def test_close_vectors_need_few_cells(space):
    vectors, asked, index = space
    near = vectors.filter("doc_id % 7 = 0").select(F.col("doc_id").alias("query_id"), "embedding")
    exact = knn_topk(vectors, near, 5)
    assert recall(knn_cells(index, near, 5, 0.1), exact).first().recall >= 0.9
    share = rows_read(index, near, 0.1).agg(F.avg("rows")).first()[0] / vectors.count()
    assert share < 0.4


def test_tiles_and_blocks_change_nothing(space, monkeypatch):
    vectors, asked, index = space
    want = hits(knn_cells(index, asked, 5, 0.3))
    monkeypatch.setattr(vector_index, "BLOCK_BYTES", 16 * 8 * 3)
    assert hits(knn_cells(index, asked, 5, 0.3)) == want


def test_index_files_every_row_once_and_reads_back(spark, space):
    vectors, asked, index = space
    assert index.cells.count() == 901 and index.centres.agg(F.sum("rows")).first()[0] == 901
    folder = shared_folder(spark)
    write_vector_index(vectors, folder, cells=7)
    again = VectorIndex.read(spark, folder, vectors)
    assert 1 < again.centres.count() <= 7
    assert hits(knn_cells(again, asked, 5, exact=True)) == hits(knn_topk(vectors, asked, 5))


def test_cells_are_skipped_by_the_scan_and_not_shuffled(space):
    vectors, asked, index = space
    block = vector_index._Block(np.ones((1, 16), np.float32), {3: np.ones(16, np.float32)}, {3: np.array([0])}, 5)
    plan = plan_of(vector_index._candidates(index.cells, block))
    assert "PushedFilters: [IsNotNull(cell), EqualTo(cell,3)]" in plan or "In(cell, [3])" in plan
    assert "Exchange" not in plan


def test_no_rows_no_questions_other_dimensions_text_ids(spark, space):
    vectors, asked, index = space
    assert knn_cells(index, asked.limit(0)).count() == 0
    empty = write_vector_index(vectors.limit(0), shared_folder(spark))
    assert knn_cells(empty, asked).count() == 0 and empty.cells.count() == 0
    with pytest.raises(ValueError, match="different length"):
        knn_cells(index, spark.createDataFrame([(1, [1.0, 2.0])], ASKED)).count()
    named = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [2.0, 0.0])], "doc_id string, embedding array<float>")
    found = knn_cells(write_vector_index(named, shared_folder(spark)), spark.createDataFrame([("q", [1.0, 1.0])], ASKED.replace("bigint", "string")))
    assert [(r.query_id, r.doc_id, r["rank"]) for r in sorted(found.collect(), key=lambda r: r["rank"])] == [("q", "a", 1), ("q", "b", 2)]


def test_recall_of_the_given_vectors_at_the_query_s_settings(spark):
    """Vectors nearly unrelated to each other, every twentieth as question."""
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    asked = vectors.filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    index = write_vector_index(vectors, shared_folder(spark), id_col="vec_id")
    exact = knn_topk(vectors, asked, id_col="vec_id")
    assert recall(knn_cells(index, asked), exact).first().recall >= 0.9
    assert rows_read(index, asked).agg(F.avg("rows")).first()[0] < 0.7 * vectors.count()


def test_many_cells_and_candidates_are_held_in_bounded_parts(spark, space, monkeypatch):
    """Questions times cells bound a block, and a task hands candidates on before it holds too many."""
    vectors, asked, index = space
    monkeypatch.setattr(vector_index, "BLOCK_CELLS", 2 * index.centres.count())
    monkeypatch.setattr(vector_index, "HELD_CANDIDATES", 10)
    pointed = asked.select("query_id", F.col("embedding").alias("_v"))
    sizes = [len(ids) for ids, _ in vector_index._blocks(pointed, 16, index.centres.count())]
    assert sizes == [2, 2, 2, 2, 1]
    assert hits(knn_cells(index, asked, 5, 1.0)) == hits(knn_topk(vectors, asked, 5))
