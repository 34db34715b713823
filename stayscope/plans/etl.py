"""Raw files to the clean table, and on request to the vector table."""

from __future__ import annotations

from pyspark.sql import SparkSession

from stayscope.operators.cleaning import clean_reviews
from stayscope.operators.embedding import DIMS, generate_vectors
from stayscope.operators.language import default_language_model
from stayscope.sources.files import load_data, write_table


def run_etl(
    spark: SparkSession,
    reviews_path: str,
    catalog_path: str,
    clean_path: str,
    vectors_path: str | None = None,
    language_model=None,
    encoder=None,
    dims: int = DIMS,
    encoder_name: str | None = None,
) -> dict[str, int]:
    """Row counts of what was written.

    The vectors are made from the table just written, so cleaning runs once.
    """
    reviews, states = load_data(spark, reviews_path, catalog_path)
    model = language_model or default_language_model(spark)
    written = {"clean": write_table(clean_reviews(reviews, states, language_model=model), clean_path)}
    if vectors_path:
        written["vectors"] = generate_vectors(spark, clean_path, vectors_path, encoder, dims, encoder_name)
    return written
