"""CSV and Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from stayscope.sources.contracts import CATALOG_COLUMNS, REVIEW_COLUMNS, require_columns


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A CSV file or folder with a header; every column is text.

    Names come from the header of the first file, so no pass over the data is
    needed to infer types; callers cast by name. A file whose header has other
    names, or another order, raises. Quoted fields may hold line breaks and
    doubled quotes. Such files cannot be split, so a large export should come
    as many files; pass `multi_line=False` for a file known to hold one record
    per line and it is read in splits.
    """
    options = {"header": True, "multiLine": multi_line, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    names = spark.read.options(**options).csv(path).schema
    return spark.read.options(**options, enforceSchema=False).schema(names).csv(path)


def typed_reviews(raw: DataFrame) -> DataFrame:
    """Raw reviews with the rating as double and the date as timestamp; all other columns as they are.

    A rating that is not a number becomes null instead of failing the job, and
    so does a date that is not one.
    """
    typed = {"reviews.rating": "double", "reviews.date": "timestamp"}
    return raw.select([
        F.col(f"`{name}`").try_cast(typed[name]).alias(name) if name in typed else F.col(f"`{name}`")
        for name in raw.columns
    ])


def read_reviews(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Raw reviews: the eight used columns, typed."""
    raw = require_columns(read_csv(spark, path, multi_line), REVIEW_COLUMNS)
    return typed_reviews(raw).select([F.col(f"`{name}`") for name in REVIEW_COLUMNS])


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The state catalog."""
    return require_columns(read_csv(spark, path, multi_line=False), CATALOG_COLUMNS).select(
        [F.col(f"`{name}`") for name in CATALOG_COLUMNS]
    )


def load_data(spark: SparkSession, reviews_path: str, catalog_path: str) -> tuple[DataFrame, DataFrame]:
    """Both inputs of the cleaning job."""
    return read_reviews(spark, reviews_path), read_catalog(spark, catalog_path)


def write_table(df: DataFrame, target: str, fmt: str = "parquet", options: dict | None = None) -> int:
    """Overwrite `target` and return the number of rows written.

    The count rides on the write itself. The observed node is the last one
    before the sink, where a task that is run twice is still counted once.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").options(**(options or {})).format(fmt).save(target)
    return int(seen.get["rows"])


CSV_TEXT = {
    "header": "true", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def write_csv(df: DataFrame, target: str) -> int:
    """CSV files that `read_csv` gives back unchanged, line breaks and blanks included."""
    return write_table(df, target, "csv", CSV_TEXT)


def write_report(df: DataFrame, target: str) -> int:
    """One CSV file with a header, for aggregates of a few rows."""
    return write_table(df.coalesce(1), target, "csv", {"header": "true"})


def read_report(spark: SparkSession, target: str, schema: str) -> DataFrame:
    """A folder written by `write_report`."""
    return spark.read.schema(schema).csv(target, header=True)
