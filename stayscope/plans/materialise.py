"""Document sets and relational copies of the vector table."""

from __future__ import annotations

from pyspark.sql import SparkSession

from stayscope.sources.contracts import VECTOR_REVIEWS, check_contract, conform
from stayscope.sources.documents import write_document_sets
from stayscope.sources.files import read_catalog, read_csv
from stayscope.sources.relational import write_relational_copies


def materialise(
    spark: SparkSession,
    vectors_path: str,
    documents_folder: str,
    jdbc_options: dict | None = None,
    reviews_path: str | None = None,
    catalog_path: str | None = None,
) -> dict[str, int]:
    """Contract check, both document sets, then the relational copies if asked for."""
    reviews = check_contract(conform(spark.read.parquet(vectors_path), VECTOR_REVIEWS), VECTOR_REVIEWS)
    written = write_document_sets(reviews, documents_folder)
    if jdbc_options:
        written |= write_relational_copies(
            read_csv(spark, reviews_path), read_catalog(spark, catalog_path), reviews, jdbc_options
        )
    return written
