"""Relational copies through Spark's JDBC sink.

Connection settings come from the caller: nothing is kept in the source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from stayscope.sources.contracts import CLEAN_REVIEWS, column_types, conform, dots_to_underscores, plain_names
from stayscope.sources.files import typed_reviews


def write_relational(
    df: DataFrame,
    table: str,
    options: dict,
    contract=None,
    truncate: bool = False,
    connections: int = 16,
) -> int:
    """Replace `table` and return its row count.

    `connections` bounds how many tasks write at the same time, whatever the
    number of partitions. With `truncate` the table and its declared types
    stay; without it the table is dropped and made anew. The number of rows
    sent is compared with the number of rows the table then holds.
    """
    settings = {"batchsize": "10000", "isolationLevel": "READ_COMMITTED", **options}
    settings.update(dbtable=table, numPartitions=str(connections), truncate=str(truncate).lower())
    if contract is not None:
        settings["createTableColumnTypes"] = column_types(contract)
    seen = Observation()
    sent = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    sent.write.format("jdbc").mode("overwrite").options(**settings).save()
    rows = int(seen.get["rows"])
    held = count_relational(df.sparkSession, table, options)
    if held != rows:
        raise RuntimeError(f"table {table} holds {held} rows after {rows} were sent")
    return rows


def count_relational(spark: SparkSession, table: str, options: dict) -> int:
    """Row count of a table, taken by the database itself."""
    query = f"SELECT COUNT(*) AS n FROM {table}"
    reader = spark.read.format("jdbc").options(**options).option("query", query)
    return int(reader.load().first()[0])


def write_relational_copies(
    raw_reviews: DataFrame, catalog: DataFrame, reviews: DataFrame, options: dict
) -> dict[str, int]:
    """The two sources under plain names, and the joined table without vectors under its declared types.

    Ratings and dates of the raw reviews are stored as numbers and times; a
    value that is none becomes null.
    """
    joined = conform(reviews, CLEAN_REVIEWS)
    return {
        "hotels_raw": write_relational(dots_to_underscores(typed_reviews(raw_reviews)), "hotels_raw", options),
        "states": write_relational(plain_names(catalog), "states", options),
        "hotel_reviews": write_relational(joined, "hotel_reviews", options, contract=CLEAN_REVIEWS),
    }
