"""Text vectors: a built-in hashed encoder, and any batch encoder of the caller."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from stayscope.functions.text import words
from stayscope.functions.vectors import unit
from stayscope.sources.files import write_table

DIMS = 384
INNER_BATCH = 64
#: Name of the built-in encoder, kept with its vectors.
HASHED = "hashed words"
#: Encoders that this worker process has loaded.
_LOADED: dict[str, Callable] = {}


def hashed_vectors(df: DataFrame, text_col: str, out_col: str, dims: int = DIMS) -> DataFrame:
    """Signed word counts in `dims` slots, at length one.

    Words are counted in twice as many slots, and the second half counts
    against the first: a word has a place and a sign. A text without words
    gets the zero vector. The vector depends on its own row alone.
    """
    columns = [F.col(f"`{c}`") for c in df.columns if c != out_col]
    counted = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=2 * dims).transform(
        df.withColumn("_words", words(F.coalesce(F.col(text_col), F.lit(""))))
    )
    halves = counted.withColumn("_slots", vector_to_array("_counts"))
    folded = F.zip_with(
        F.slice("_slots", 1, dims), F.slice("_slots", dims + 1, dims), lambda plus, minus: plus - minus
    )
    return halves.select(*columns, unit(folded).cast("array<float>").alias(out_col))


def loaded(name: str, load: Callable[[], Callable]) -> Callable:
    """The encoder of this name, loaded on its first use in the process."""
    if name not in _LOADED:
        _LOADED[name] = load()
    return _LOADED[name]


def batch_encoder(load: Callable[[], Callable[[list[str]], np.ndarray]], dims: int, inner_batch: int = INNER_BATCH):
    """A vectorised function from text to vector around the caller's encoder.

    `load` runs once per worker process and returns a function from a list of
    texts to a matrix with one row per text; the worker keeps it for its later
    tasks. Rows are brought to length one.
    """
    name = uuid.uuid4().hex

    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = loaded(name, load)
        for texts in batches:
            listed = texts.tolist()
            rows = []
            for at in range(0, len(listed), inner_batch):
                matrix = np.asarray(encoder(listed[at:at + inner_batch]), dtype=np.float64)
                if matrix.ndim != 2 or matrix.shape[1] != dims:
                    raise ValueError(f"the encoder gave shape {matrix.shape}, not (n, {dims})")
                lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
                scaled = np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)
                rows.extend(scaled.astype(np.float32))
            yield pd.Series(rows, dtype=object)

    # Spark reads the input and output kinds from the annotations as types.
    encode.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(encode, "array<float>")


def named(df: DataFrame, column: str, encoder_name: str) -> DataFrame:
    """The rows with the encoder's name in the vector column's metadata, which Parquet keeps."""
    return df.withColumn(column, F.col(column).alias(column, metadata={"encoder": encoder_name}))


def encoder_of(vectors: DataFrame, column: str = "embedding") -> str | None:
    """The name of the encoder that made the vectors, if it was kept."""
    return vectors.schema[column].metadata.get("encoder")


def add_vectors(
    df: DataFrame,
    text_col: str = "review_full_text",
    out_col: str = "embedding",
    encoder: Callable | None = None,
    dims: int = DIMS,
    encoder_name: str | None = None,
) -> DataFrame:
    """A vector column for a text column; a null text is encoded as an empty one.

    The encoder's name stays with the column. A caller's encoder should be
    given one; without it the vectors can be asked by an unnamed encoder only.
    """
    if encoder is None:
        return named(hashed_vectors(df, text_col, out_col, dims), out_col, HASHED)
    text = F.coalesce(F.col(text_col), F.lit(""))
    return named(df.withColumn(out_col, batch_encoder(encoder, dims)(text)), out_col, encoder_name or "")


def generate_vectors(
    spark, input_path: str, output_path: str, encoder: Callable | None = None, dims: int = DIMS,
    encoder_name: str | None = None,
) -> int:
    """Clean Parquet in, Parquet with vectors out; returns the row count."""
    made = add_vectors(spark.read.parquet(input_path), encoder=encoder, dims=dims, encoder_name=encoder_name)
    return write_table(made, output_path)
