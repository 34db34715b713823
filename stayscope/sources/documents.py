"""The two keyed document sets behind search: text only, and text with vector."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stayscope.functions.keys import doc_key, iso_date, nan_to_null
from stayscope.operators.upsert import keep_last_by_key
from stayscope.sources.contracts import CLEAN_REVIEWS, require_columns
from stayscope.sources.files import write_table


def keyed_documents(df: DataFrame, order_cols: list[str] | None = None) -> DataFrame:
    """One document per key, dates as ISO text, missing numbers as null.

    The key is a digest of name, date and text. Of documents that share a key
    the last by `order_cols` stays; without them, the last by all other columns.
    """
    require_columns(df, ["hotel_name", "review_date", "review_full_text", "rating"])
    shaped = (
        df.withColumn("review_date", iso_date(F.col("review_date")))
        .withColumn("rating", nan_to_null(F.col("rating")))
        .withColumn("doc_id", doc_key("hotel_name", "review_date", "review_full_text"))
    )
    if order_cols is None:
        order_cols = [c for c in ("rating", "city", "province", "sentiment", "region", "division")
                      if c in df.columns]
    return keep_last_by_key(shaped, "doc_id", order_cols)


def write_document_sets(df: DataFrame, folder: str, order_cols: list[str] | None = None) -> dict[str, int]:
    """Write both sets from the executors and check their row counts.

    The vector set is written first and the keyword set is read back from it,
    so the keys are worked out once and both sets hold the same documents.
    """
    spark = df.sparkSession
    fields = ["doc_id"] + CLEAN_REVIEWS.fieldNames() + ["embedding"]
    documents = keyed_documents(df, order_cols).select(fields)
    with_vectors = write_table(documents, f"{folder}/vector_documents")
    text_only = spark.read.parquet(f"{folder}/vector_documents").drop("embedding")
    without_vectors = write_table(text_only, f"{folder}/keyword_documents")
    if with_vectors != without_vectors:
        raise RuntimeError(f"document sets differ: {with_vectors} and {without_vectors} rows")
    return {"vector_documents": with_vectors, "keyword_documents": without_vectors}
