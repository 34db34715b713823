"""From raw reviews and the state catalog to the clean review table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stayscope.functions.text import full_text, sentiment
from stayscope.operators.language import add_language
from stayscope.operators.lookup import lookup_join
from stayscope.sources.contracts import (
    CATALOG_COLUMNS, CLEAN_REVIEWS, REVIEW_COLUMNS, require_columns,
)

PROJECTED = {
    "name": "hotel_name",
    "city": "city",
    "province": "province",
    "reviews.date": "review_date",
    "reviews.rating": "rating",
    "reviews.text": "review_text",
    "reviews.title": "review_title",
    "reviews.username": "username",
}


def project_reviews(reviews: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The eight used columns under plain names, plus those in `keep`."""
    require_columns(reviews, REVIEW_COLUMNS + (keep or []))
    columns = [F.col(f"`{old}`").alias(new) for old, new in PROJECTED.items()]
    return reviews.select(columns + [F.col(f"`{name}`") for name in keep or []])


def in_rating_range(rating: str = "rating", low: float = 1, high: float = 5):
    """1 to 5 inclusive; null, NaN and text that is no number fail."""
    return F.col(rating).try_cast("double").between(low, high)


def project_catalog(states: DataFrame, allow_repeats: bool = False) -> DataFrame:
    """Code, region and division, one row per code.

    A repeated code would multiply reviews, so it raises unless asked for.
    """
    require_columns(states, CATALOG_COLUMNS)
    catalog = states.select(
        F.col("`State Code`").alias("province"),
        F.col("Region").alias("region"),
        F.col("Division").alias("division"),
    )
    if not allow_repeats:
        repeated = (
            catalog.filter(F.col("province").isNotNull())
            .groupBy("province").count().filter("count > 1").limit(5).collect()
        )
        if repeated:
            raise ValueError(f"catalog codes repeat: {[row.province for row in repeated]}")
    return catalog


def enrich(reviews: DataFrame, catalog: DataFrame) -> DataFrame:
    """Region and division by province; reviews of unknown provinces leave."""
    return lookup_join(reviews, catalog, ["province"], "inner")


def clean_reviews(
    reviews: DataFrame,
    states: DataFrame,
    lang_col: str | None = None,
    language_model=None,
    language: str = "en",
    allow_repeats: bool = False,
) -> DataFrame:
    """The clean review table, nine columns in a fixed order.

    Reviews need a text, a rating from 1 to 5, a known province and the wanted
    language; exact copies over all eight used columns leave. The language is
    taken from `lang_col` where the input has one, else told by
    `language_model`.

    Every test that needs no other row runs before the copies are removed, the
    one shuffle of the job, and the language model runs after it.
    """
    if lang_col is None and language_model is None:
        raise ValueError("give a language column or a language model")
    catalog = project_catalog(states, allow_repeats)
    rows = project_reviews(reviews, [lang_col] if lang_col else None)
    if lang_col:
        rows = rows.filter(F.col(f"`{lang_col}`") == language).drop(lang_col)
    rows = rows.filter(F.col("review_text").isNotNull() & in_rating_range())
    rows = lookup_join(rows, catalog.select("province"), ["province"], "left_semi")
    rows = rows.dropDuplicates()
    rows = lookup_join(rows, catalog, ["province"], "inner")
    rows = rows.withColumn(
        "review_full_text", full_text(F.col("review_title"), F.col("review_text"))
    )
    if not lang_col:
        rows = add_language(rows, language_model, "review_full_text", "_lang")
        rows = rows.filter(F.col("_lang") == language)
    rating = F.col("rating").try_cast("double")
    rows = rows.withColumn("rating", rating).withColumn("sentiment", sentiment(F.col("rating")))
    return rows.select(CLEAN_REVIEWS.fieldNames())
