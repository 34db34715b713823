"""A batch of typed questions, answered by keywords and by vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stayscope.functions.text import is_blank
from stayscope.operators.embedding import DIMS, HASHED, add_vectors, encoder_of
from stayscope.operators.keyword_search import (
    KeywordIndex, bm25_topk, compare_hits, hydrate, write_keyword_index,
)
from stayscope.operators.vector_search import knn_topk

HIT_FIELDS = ["hotel_name", "review_full_text", "rating"]


def build_search(documents: DataFrame, folder: str, id_col: str = "doc_id",
                 text_col: str = "review_full_text") -> KeywordIndex:
    """The keyword index of a document set, written to `folder`."""
    return write_keyword_index(documents, id_col, text_col, folder)


def index_documents(spark: SparkSession, documents_folder: str, index_folder: str) -> KeywordIndex:
    """The index of the stored keyword set, written once and asked as often as needed."""
    return build_search(spark.read.parquet(f"{documents_folder}/keyword_documents"), index_folder)


def encode_questions(
    questions: DataFrame, text_col: str = "text", encoder=None, dims: int = DIMS, encoder_name: str | None = None
) -> DataFrame:
    """Questions that are not blank, with a vector from the rows' encoder."""
    asked = questions.filter(~is_blank(F.col(text_col)))
    return add_vectors(asked, text_col, "embedding", encoder, dims, encoder_name)


def check_same_space(vectors: DataFrame, dims: int, encoder_name: str) -> None:
    """Refuse questions encoded otherwise than the rows: by another encoder or in other dimensions."""
    held = encoder_of(vectors)
    if held != encoder_name:
        raise ValueError(f"rows were encoded by {held!r}, the questions by {encoder_name!r}")
    row = vectors.filter("embedding is not null").select(F.size("embedding")).first()
    if row and row[0] != dims:
        raise ValueError(f"rows have {row[0]} dimensions, the questions {dims}")


def answer_questions(
    index: KeywordIndex,
    vectors: DataFrame,
    questions: DataFrame,
    k: int = 5,
    candidates: int | None = None,
    encoder=None,
    dims: int = DIMS,
    encoder_name: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Keyword hits, vector hits, and both compared.

    `questions` has query_id and text; `vectors` has doc_id and embedding,
    made by the encoder that is given here, under the same name.
    """
    check_same_space(vectors, dims, HASHED if encoder is None else encoder_name or "")
    by_words = bm25_topk(index, questions, k)
    asked = encode_questions(questions, "text", encoder, dims, encoder_name)
    by_meaning = knn_topk(vectors, asked, k, candidates)
    return by_words, by_meaning, compare_hits(by_words, by_meaning, k)


def search_documents(
    spark: SparkSession, documents_folder: str, index_folder: str, questions: DataFrame, k: int = 5,
    candidates: int | None = None, encoder=None, dims: int = DIMS, encoder_name: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """`answer_questions` over the stored index and vectors; hits come with name, text and rating."""
    documents = spark.read.parquet(f"{documents_folder}/keyword_documents")
    vectors = spark.read.parquet(f"{documents_folder}/vector_documents").select("doc_id", "embedding")
    by_words, by_meaning, compared = answer_questions(
        KeywordIndex.read(spark, index_folder), vectors, questions, k, candidates, encoder, dims, encoder_name
    )
    shown = [hydrate(hits, documents, "doc_id", HIT_FIELDS) for hits in (by_words, by_meaning)]
    return shown[0], shown[1], compared
