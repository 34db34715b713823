"""All charts of the board from one date-filtered table, or from counts that loads add to."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from stayscope.operators.charts import (
    positive_share, rating_histogram, region_split, reviews_per_period, top_cities, within_dates,
)
from stayscope.session import shared_folder
from stayscope.sources.files import write_table
from stayscope.sources.versioned import last_version, read_version, replace_tables

KEYS = ("review_date", "rating", "sentiment", "region", "city")


def board(reviews: DataFrame, low, high, folder: str | None = None) -> dict[str, DataFrame]:
    """The five charts of the reviews from `low` to `high`.

    Reviews are read once, into counts per month, rating, sentiment, region
    and city. The counts are written to `folder`, or to the shared folder, and
    every chart is made from them.
    """
    folder = folder or shared_folder(reviews.sparkSession)
    month = F.date_trunc("MONTH", F.col("review_date")).alias("review_date")
    counted = (
        within_dates(reviews, low, high)
        .groupBy(month, "rating", "sentiment", "region", "city")
        .agg(F.count(F.lit(1)).alias("reviews"))
    )
    write_table(counted, folder)
    return _charts(reviews.sparkSession.read.schema(counted.schema).parquet(folder))


def _charts(counts: DataFrame) -> dict[str, DataFrame]:
    return {
        "rating_histogram": rating_histogram(counts, weight="reviews"),
        "region_topn_other": region_split(counts, weight="reviews"),
        "reviews_per_month": reviews_per_period(counts, weight="reviews"),
        "positive_share": positive_share(counts, weight="reviews"),
        "top_cities": top_cities(counts, weight="reviews"),
    }


def add_to_board(reviews: DataFrame, folder: str, load: str) -> int:
    """Add the reviews of a load to the counts of a folder, which begin with the first load. Returns the version.

    The counts are per day, so that any range of days can be shown. Only the
    new reviews are read; their counts are added to the held ones, a table that
    grows with days and places, not with reviews. Counts and the names of the
    loads change together, so a load that is run again, after it died or by
    mistake, counts once. Reviews without a date are on no board and not counted.
    """
    spark = reviews.sparkSession
    new = (
        reviews.filter(F.col("review_date").isNotNull())
        .groupBy(F.date_trunc("DAY", "review_date").alias("review_date"), *KEYS[1:])
        .agg(F.count(F.lit(1)).alias("reviews"))
    )
    names = spark.createDataFrame([(load,)], "load string")
    version = last_version(spark, folder)
    if version is None:
        return replace_tables(spark, folder, {"counts": new, "loads": names})
    loads = read_version(spark, folder, "loads", version)
    if not loads.filter(F.col("load") == load).isEmpty():
        return version
    both = read_version(spark, folder, "counts", version).unionByName(new)
    counts = both.groupBy(*KEYS).agg(F.sum("reviews").alias("reviews"))
    return replace_tables(spark, folder, {"counts": counts, "loads": loads.unionByName(names).coalesce(1)})


def held_board(
    spark: SparkSession, folder: str, low: date | str, high: date | str, version: int | None = None
) -> dict[str, DataFrame]:
    """The five charts of all loads from the day `low` to the day `high`, as of the newest or a given version."""
    for day in (low, high):
        if isinstance(day, datetime) or isinstance(day, str) and len(day.strip()) != 10:
            raise ValueError(f"the counts are per day; {day} is none")
    return _charts(within_dates(read_version(spark, folder, "counts", version), low, high))
