"""Review-shaped views over the test tables.

The test tables hold no hotel reviews, so documents, orders, customers and
nations are put together into raw reviews, and nations and regions into the
state catalog.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stayscope.functions.text import sentiment
from stayscope.operators.cleaning import enrich, in_rating_range, project_catalog


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def _buyers(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with customer and nation; the rating is the leading digit of the priority."""
    return (
        table(spark, folder, "orders")
        .join(table(spark, folder, "customer"), F.col("c_custkey") == F.col("o_custkey"))
        .join(table(spark, folder, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
        .withColumn("stars", F.substring("o_orderpriority", 1, 1).cast("double"))
    )


def raw_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Raw review columns plus doc_id and lang."""
    joined = documents(spark, folder).join(
        _buyers(spark, folder), F.col("doc_id") == F.col("o_orderkey")
    )
    return joined.select(
        F.col("source").alias("name"),
        F.col("n_name").alias("city"),
        F.col("n_name").alias("province"),
        F.col("o_orderdate").alias("reviews.date"),
        F.col("stars").alias("reviews.rating"),
        F.col("text").alias("reviews.text"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("reviews.title"),
        F.col("c_name").alias("reviews.username"),
        "doc_id",
        "lang",
    )


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Twenty of the nations as states, so that the join drops reviews."""
    joined = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return joined.filter("n_nationkey < 20").select(
        F.col("n_name").alias("State"),
        F.col("n_name").alias("State Code"),
        F.col("r_name").alias("Region"),
        F.concat_ws(" ", "r_name", (F.col("n_nationkey") % 2).cast("string")).alias("Division"),
    )


def rated_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Every order as a review without text, cleaned and enriched: the charts' input."""
    rows = _buyers(spark, folder).select(
        F.col("n_name").alias("city"),
        F.col("n_name").alias("province"),
        F.col("o_orderdate").alias("review_date"),
        F.col("stars").alias("rating"),
    ).filter(in_rating_range())
    enriched = enrich(rows, project_catalog(catalog(spark, folder)))
    return enriched.withColumn("sentiment", sentiment(F.col("rating")))


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a quality label, under the names of the model table."""
    return documents(spark, folder).join(table(spark, folder, "labels"), "doc_id").select(
        "doc_id",
        F.col("text").alias("review_full_text"),
        F.col("quality").alias("sentiment"),
        F.col("source").alias("region"),
        F.col("lang").alias("division"),
    )


def ruled_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """A quality label and a prediction made by a rule on the text's length."""
    return table(spark, folder, "labels").join(
        table(spark, folder, "documents").select("doc_id", "n_chars"), "doc_id"
    ).select(
        F.col("quality").alias("sentiment"),
        F.when(F.col("n_chars") > 2000, 1.0).otherwise(0.0).alias("prediction"),
    )


def scored_events(spark: SparkSession, folder: str) -> DataFrame:
    """Event value as the score of being an error."""
    return table(spark, folder, "events").select(
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("sentiment"),
        F.col("value").alias("score"),
    )


def questions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def class_centres(spark: SparkSession, folder: str) -> DataFrame:
    """The mean vector of each label: one question per class, over the whole table."""
    entries = table(spark, folder, "embeddings").select(
        "label", F.posexplode("embedding").alias("dim", "x")
    )
    means = entries.groupBy("label", "dim").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("dim", "x"))), lambda e: e["x"]).alias("embedding")
    ).select(F.col("label").cast("bigint").alias("query_id"), "embedding")
