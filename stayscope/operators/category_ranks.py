"""Categories numbered by falling frequency, however many there are."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stayscope.operators.lookup import lookup_join
from stayscope.session import shared_folder
from stayscope.sources.files import write_table


def frequency_ranks(df: DataFrame, category_col: str) -> DataFrame:
    """The category's values with their `rows` and their `index` from 0: the most frequent first, ties by value.

    Nulls have no index. The counts are dealt by ranges of (rows, value), each
    range numbers its own, and what lies in the ranges before is added. No
    value passes through the driver, only a number per range.
    """
    spark = df.sparkSession
    counted = df.groupBy(F.col(category_col).alias("value")).agg(F.count(F.lit(1)).alias("rows")).filter("value is not null")
    order = [F.col("rows").desc(), F.col("value")]
    ranged = counted.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("range", F.spark_partition_id())
    schema = T.StructType([*ranged.schema.fields, T.StructField("nth", T.LongType())])
    arrow = to_arrow_schema(schema)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = 0
        for batch in batches:
            nth = pa.array(range(begin, begin + batch.num_rows), pa.int64())
            begin += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, nth], schema=arrow)

    # Written, as the ranges must be the same for the numbers and for the sums before them.
    folder = shared_folder(spark)
    write_table(ranged.mapInArrow(numbered, schema), folder)
    held = spark.read.parquet(folder)
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # A row per range.
    sizes = held.groupBy("range").agg(F.count(F.lit(1)).alias("size"))
    offsets = sizes.select("range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    return held.join(F.broadcast(offsets), "range").select("value", "rows", (F.col("offset") + F.col("nth")).alias("index"))


def add_frequency_index(df: DataFrame, category_col: str, index_col: str | None = None, ranks: DataFrame | None = None) -> DataFrame:
    """The rows with the index of their category as a double, `<name>_index`.

    `ranks` are those of other rows, as `frequency_ranks` gives them; without
    it those of these rows. A value that has no rank, and null, get the index
    after the last.
    """
    ranks = frequency_ranks(df, category_col) if ranks is None else ranks
    last = ranks.agg(F.count(F.lit(1)).cast("double").alias("n")).scalar()
    known = ranks.select(F.col("value").alias(category_col), F.col("index").cast("double").alias("_index"))
    joined = lookup_join(df, known, [category_col], "left")
    name = index_col or f"{category_col}_index"
    return joined.select(*df.columns, F.coalesce("_index", last).alias(name))
