"""Model features: weighted words and one-hot categories."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    HashingTF, IDF, OneHotEncoder, StopWordsRemover, StringIndexer, Tokenizer, VectorAssembler,
)
from pyspark.sql import DataFrame, functions as F

from stayscope.functions.keys import hash_percent
from stayscope.sources.contracts import require_columns

WIDTH = 2 ** 15
# The first word stages, up to the hashed counts, need no fitting.
WORD_COUNT_STAGES = 3
LABEL_SOURCES = ("rating", "reviews.rating")


def drop_incomplete(df: DataFrame, columns: list[str]) -> DataFrame:
    """Only the listed columns, and only rows where none is null."""
    return require_columns(df, columns).select(columns).na.drop(subset=columns)


def split_by_hash(
    df: DataFrame, key_cols: list[str] | None = None, train_percent: int = 80
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, told apart by a hash of the key.

    A row's side depends on its values alone, so it is the same in any layout
    of the data and when a task runs again. Rows with equal keys stay on one
    side.
    """
    percent = hash_percent(*(key_cols or df.columns))
    return df.filter(percent < train_percent), df.filter(percent >= train_percent)


def split_at_random(df: DataFrame, train_percent: int = 80, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by seeded draws of Spark's `randomSplit`.

    The draws go by partition: the sides are the same again only for the same
    rows in the same layout, and equal rows may part. Use `split_by_hash`
    where the split must hold.
    """
    train, test = df.randomSplit([train_percent / 100, 1 - train_percent / 100], seed)
    return train, test


def word_stages(text_col: str, width: int = WIDTH) -> list:
    """Lower-cased tokens, without English stop words, counted and weighted."""
    return [
        Tokenizer(inputCol=text_col, outputCol="words"),
        StopWordsRemover(inputCol="words", outputCol="filtered_words"),
        HashingTF(inputCol="filtered_words", outputCol="raw_features", numFeatures=width),
        IDF(inputCol="raw_features", outputCol="tfidf_features"),
    ]


def category_stages(category_cols: list[str]) -> list:
    """Categories by falling frequency, one-hot; an unseen value gives zeros."""
    indexers = [
        StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="keep") for c in category_cols
    ]
    encoder = OneHotEncoder(
        inputCols=[f"{c}_index" for c in category_cols], outputCols=[f"{c}_ohe" for c in category_cols]
    )
    return indexers + [encoder]


def build_stages(
    text_col: str = "review_full_text",
    category_cols: tuple[str, ...] = ("region", "division"),
    width: int = WIDTH,
) -> Pipeline:
    """The feature stages as one Pipeline with output column `features`.

    Without category columns only the text is used. The rating is refused: the
    label is made from it.
    """
    leaks = [c for c in (text_col, *category_cols) if c in LABEL_SOURCES]
    if leaks:
        raise ValueError(f"{leaks[0]!r} is what the label is made from, not a feature")
    stages = word_stages(text_col, width)
    blocks = ["tfidf_features"]
    if category_cols:
        stages += category_stages(list(category_cols))
        blocks += [f"{c}_ohe" for c in category_cols]
    return Pipeline(stages=stages + [VectorAssembler(inputCols=blocks, outputCol="features")])


def category_index(df: DataFrame, category_col: str) -> DataFrame:
    """The category's index column `<name>_index` added to the rows."""
    indexer = category_stages([category_col])[0]
    return indexer.fit(df).transform(df)


def long_vector(df: DataFrame, keep: list[str], vector_col: str, value: str = "value") -> DataFrame:
    """keep, slot, value: one row per non-zero entry of a vector column.

    Entries of a sparse vector are read as they are stored, so the cost goes by
    the entries and not by the width.
    """
    plain = df.select(*keep, F.unwrap_udt(vector_col).alias("_v"))
    stored = F.arrays_zip(F.col("_v.indices").alias("slot"), F.col("_v.values").alias(value))
    dense = F.transform("_v.values", lambda x, i: F.struct(i.alias("slot"), x.alias(value)))
    entries = F.when(F.col("_v.type") == 0, stored).otherwise(dense)
    return plain.select(*keep, F.inline(entries)).filter(F.col(value) != 0)
