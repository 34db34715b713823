"""The aggregate tables behind the review board.

Each chart counts the reviews once, into a table of a few rows, and does the
rest on that table. Buckets without reviews are kept with count 0. `weight`
names a column that says how many reviews a row stands for, where the input
has been counted before.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

OTHER = "Other"
#: Empty buckets that one row of a gap is written out to.
RUN = 10_000
#: Calendar units with their length in seconds, that of a month and a year rounded down.
UNITS = {
    "SECOND": 1, "MINUTE": 60, "HOUR": 3600, "DAY": 86_400, "WEEK": 604_800, "MONTH": 2_419_200, "YEAR": 31_536_000,
}
LABEL_NAMES = {0: "negative", 1: "positive"}


def within_dates(df: DataFrame, low, high, date_col: str = "review_date") -> DataFrame:
    """Reviews from `low` to `high`, both included; a null date leaves.

    A `high` without a time of day, a date or its ISO text, includes that
    whole day; one with a time is taken as given.
    """
    day = isinstance(high, date) and not isinstance(high, datetime) or isinstance(high, str) and len(high.strip()) == 10
    when, last = F.col(date_col), F.lit(high)
    upper = when < F.date_add(last.cast("date"), 1) if day else when <= last
    return df.filter((when >= F.lit(low)) & upper)


def _reviews(weight: str | None, name: str = "count") -> Column:
    return (F.sum(weight) if weight else F.count(F.lit(1))).alias(name)


def sentiment_by_region(df: DataFrame) -> DataFrame:
    """region, sentiment, count."""
    return df.groupBy("region", "sentiment").agg(_reviews(None)).orderBy("region", "sentiment")


def sentiment_pivot(by_region: DataFrame) -> DataFrame:
    """region, negative, positive: one row per region, missing counts 0."""
    wide = by_region.groupBy("region").pivot("sentiment", list(LABEL_NAMES)).agg(F.sum("count"))
    return wide.na.fill(0).withColumnsRenamed({str(k): v for k, v in LABEL_NAMES.items()})


def rating_histogram(
    df: DataFrame, width: float = 1.0, column: str = "rating", weight: str | None = None
) -> DataFrame:
    """bucket, count: lower bound of each bucket from the least to the greatest value."""
    step = F.floor(F.col(column) / F.lit(float(width))).cast("bigint")
    rated = df.filter(F.col(column).isNotNull())
    counted = rated.groupBy(step.alias("step")).agg(_reviews(weight))
    return _with_empty(counted, "step", F.lit).select(
        (F.col("step") * F.lit(float(width))).alias("bucket"), "count"
    )


def fitting_width(df: DataFrame, column: str = "rating", most: int = 50) -> float:
    """The least of 1, 2 and 5 times a power of ten that gives at most `most` buckets; 1 without values.

    Reads the least and the greatest value. Infinite and NaN values take no part.
    """
    value = F.col(column).cast("double")
    finite = df.filter(value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf")))
    low, high = finite.agg(F.min(value), F.max(value)).first()
    if most < 2:
        raise ValueError("at least two buckets")
    if low is None or low == high:
        return 1.0
    power = math.floor(math.log10((high - low) / most)) - 1
    while True:
        for width in (1 * 10.0**power, 2 * 10.0**power, 5 * 10.0**power):
            if math.floor(high / width) - math.floor(low / width) < most:
                return width
        power += 1


def fitting_unit(df: DataFrame, column: str = "review_date", most: int = 100) -> str:
    """The shortest unit of `UNITS` with at most `most` periods from the first to the last review; else the longest.

    Periods are counted by the unit's length in `UNITS`, those at both ends included.
    """
    at = F.unix_micros(F.to_timestamp_ltz(F.col(column).cast("timestamp")))
    low, high = df.agg(F.min(at), F.max(at)).first()
    span = 0 if low is None else (high - low) // 1_000_000
    return next((unit for unit, seconds in UNITS.items() if span // seconds + 2 <= most), list(UNITS)[-1])


def reviews_per_period(
    df: DataFrame, unit: str = "MONTH", column: str = "review_date", weight: str | None = None
) -> DataFrame:
    """period, count: every calendar period between the first and the last review."""
    start = F.date_trunc(unit, F.col(column)).cast("timestamp_ntz")
    dated = df.filter(F.col(column).isNotNull())
    counted = dated.groupBy(start.alias("period")).agg(_reviews(weight))
    return _with_empty(counted, "period", lambda n: F.expr(f"interval {n} {unit}")).select("period", "count")


def _with_empty(counted: DataFrame, key: str, stride: Callable[[int], Column]) -> DataFrame:
    """The counts, and 0 for each key between two that occur.

    Each row also fills the gap up to the next one, so the input is read once.
    The window runs over the counted keys, not over reviews. A gap is first cut
    into runs, which are dealt out and then written out, so a wide one is
    neither one array nor one task.
    """
    following = counted.withColumn("_next", F.lead(key).over(Window.orderBy(key)))
    last = F.coalesce(F.col("_next") - stride(1), F.col(key))
    runs = following.select("count", F.col(key).alias("_key"), last.alias("_last")).select(
        "count", "_key", "_last", F.explode(F.sequence("_key", "_last", stride(RUN))).alias("_from")
    )
    dealt = runs.repartition("_key", "_from")
    until = F.least(F.col("_from") + stride(RUN) - stride(1), F.col("_last"))
    keys = dealt.select("count", "_key", F.explode(F.sequence("_from", until, stride(1))).alias(key))
    return keys.select(key, F.when(F.col(key) == F.col("_key"), F.col("count")).otherwise(F.lit(0)).alias("count"))


def region_split(df: DataFrame, n: int = 5, weight: str | None = None) -> DataFrame:
    """region, sentiment, count within the n largest regions; the rest is `Other`.

    Reviews without a region are left out, and regions of equal size go by name.
    """
    counted = df.filter(F.col("region").isNotNull()).groupBy("region", "sentiment").agg(_reviews(weight))
    largest = (
        counted.groupBy("region").agg(F.sum("count").alias("_n"))
        .orderBy(F.col("_n").desc(), "region").limit(n)
    )
    return _top_or_other(counted, largest, "region").groupBy("region", "sentiment").agg(
        F.sum("count").alias("count")
    )


def _top_or_other(counted: DataFrame, largest: DataFrame, key: str) -> DataFrame:
    """Keys outside `largest`, which has n rows, become `Other`."""
    names = largest.select(F.col(key), F.lit(True).alias("_top"))
    joined = counted.join(F.broadcast(names), key, "left")
    return joined.withColumn(key, F.when(F.col("_top"), F.col(key)).otherwise(F.lit(OTHER))).drop("_top")


def positive_share(df: DataFrame, weight: str | None = None) -> DataFrame:
    """sentiment, count, percent of all reviews."""
    counted = df.groupBy("sentiment").agg(_reviews(weight))
    whole = Window.partitionBy()
    return counted.withColumn("percent", 100 * F.col("count") / F.sum("count").over(whole))


def top_cities(df: DataFrame, n: int = 10, exact: bool = True, weight: str | None = None) -> DataFrame:
    """city, ratings, median_rating of the n cities with most ratings, and `Other`.

    The median of `Other` is that of its ratings, not of the cities' medians.
    Ratings are counted per city and value first, so the median weighs values
    by their counts and a large city is no large group. `exact=False` is for
    ratings that take very many values.
    """
    rated = df.filter(F.col("city").isNotNull() & F.col("rating").isNotNull())
    counted = rated.groupBy("city", "rating").agg(_reviews(weight, "ratings"))
    largest = (
        counted.groupBy("city").agg(F.sum("ratings").alias("_n"))
        .orderBy(F.col("_n").desc(), "city").limit(n)
    )
    if exact:
        median = F.percentile("rating", 0.5, F.col("ratings"))
        return _top_or_other(counted, largest, "city").groupBy("city").agg(
            F.sum("ratings").alias("ratings"), median.alias("median_rating")
        )
    if weight:
        raise ValueError("the approximate median needs one row per review")
    return _top_or_other(rated.select("city", "rating"), largest, "city").groupBy("city").agg(
        F.count("rating").alias("ratings"), F.percentile_approx("rating", 0.5).alias("median_rating")
    )
