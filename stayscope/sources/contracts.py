"""Table contracts: one StructType per table, checked at every job boundary."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F, types as T

# The names and order of the tables' columns.
REVIEW_COLUMNS = [
    "name", "city", "province", "reviews.date", "reviews.rating",
    "reviews.text", "reviews.title", "reviews.username",
]
CATALOG_COLUMNS = ["State", "State Code", "Region", "Division"]

CLEAN_REVIEWS = T.StructType([
    T.StructField("hotel_name", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("province", T.StringType()),
    T.StructField("review_date", T.TimestampType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("review_full_text", T.StringType()),
    T.StructField("sentiment", T.IntegerType()),
    T.StructField("region", T.StringType()),
    T.StructField("division", T.StringType()),
])

VECTOR_REVIEWS = T.StructType(
    CLEAN_REVIEWS.fields + [T.StructField("embedding", T.ArrayType(T.FloatType()))]
)

MODEL_COLUMNS = ["review_full_text", "sentiment", "region", "division"]

METRICS = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("f1", T.DoubleType()),
    T.StructField("auc_roc", T.DoubleType()),
])


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Raise before any action when a needed column is missing."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing required column(s): {', '.join(missing)}")
    return df


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Exactly the contract's columns, in its order and with its types; what is noted on a column stays."""
    require_columns(df, contract.fieldNames())
    return df.select([
        F.col(f"`{field.name}`").cast(field.dataType).alias(field.name, metadata=df.schema[field.name].metadata)
        for field in contract.fields
    ])


def check_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Raise when names, order or types differ from the contract."""
    found = [(field.name, field.dataType.simpleString()) for field in df.schema.fields]
    wanted = [(field.name, field.dataType.simpleString()) for field in contract.fields]
    if found != wanted:
        raise ValueError(f"table does not meet its contract: {found} instead of {wanted}")
    return df


def column_types(contract: T.StructType) -> str:
    """The contract as a column list for a relational table."""
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in contract.fields)


def _renamed(df: DataFrame, new_names: list[str]) -> DataFrame:
    seen: dict[str, str] = {}
    for old, new in zip(df.columns, new_names):
        if new.lower() in seen:
            raise ValueError(f"columns {seen[new.lower()]!r} and {old!r} both become {new!r}")
        seen[new.lower()] = old
    return df.toDF(*new_names)


def dots_to_underscores(df: DataFrame) -> DataFrame:
    """`reviews.text` becomes `reviews_text`."""
    return _renamed(df, [name.replace(".", "_") for name in df.columns])


def plain_names(df: DataFrame) -> DataFrame:
    """Trimmed, lower-case names with underscores for blanks."""
    return _renamed(df, [re.sub(" ", "_", name.strip()).lower() for name in df.columns])
