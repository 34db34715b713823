"""One large CSV file with quoted line breaks, read by many tasks.

Spark reads such a file in one task, as a line break inside quotes looks like
the end of a record. Here it is read as lines, in splits. Whether a split
begins inside quotes follows from the number of quotes before it, so one
number per split is counted first. Then every split cuts its lines into
records; what a record has in the next splits is put behind it, and the
records are parsed by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stayscope.session import shared_folder
from stayscope.sources.files import write_table

#: Splits of all files, of each of which the driver and every task hold a name and a bit.
MOST_SPLITS = 1_000_000
WHOLE, HEAD, TAIL = "whole", "head", "tail"
RECORDS = "file string, start bigint, kind string, first boolean, record string"
_RECORDS = pa.schema([("file", pa.string()), ("start", pa.int64()), ("kind", pa.string()), ("first", pa.bool_()), ("record", pa.string())])
OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, start (of the split) and line, each split's lines in their order."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("line"),
    )


def quoted_splits(lines: DataFrame) -> set[tuple[str, int]]:
    """The splits that begin inside quotes: those with an odd number of quotes before them in their file."""
    quotes = F.char_length("line") - F.char_length(F.replace("line", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = counted.withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    found = inside.filter("inside = 1").select("file", "start").limit(MOST_SPLITS + 1).collect()
    if len(found) > MOST_SPLITS:
        raise ValueError("too many splits: raise spark.sql.files.maxPartitionBytes")
    return {(r.file, r.start) for r in found}


class _Cutter:
    """Cuts the lines of splits, one after another, into records."""

    def __init__(self, inside: set[tuple[str, int]]):
        self.inside, self.split = inside, None
        self.out: list[tuple] = []

    def begin(self, split: tuple[str, int]) -> None:
        self.end()
        self.split, self.held = split, []
        self.quoted = split in self.inside
        self.kind = HEAD if self.quoted else WHOLE
        self.first = split[1] == 0

    def add(self, line: str, quotes: int) -> None:
        self.held.append(line)
        self.quoted ^= quotes & 1
        if not self.quoted:
            self.put(self.kind)
            self.kind = WHOLE

    def put(self, kind: str) -> None:
        text = "\n".join(self.held).removesuffix("\r")
        # An empty line between records is none.
        if text or kind != WHOLE:
            self.out.append((*self.split, kind, self.first, text))
            self.first = False
        self.held = []

    def end(self) -> None:
        if self.split and self.held:
            self.put(HEAD if self.kind == HEAD else TAIL)

    def taken(self, kinds: tuple[str, ...]) -> pa.RecordBatch:
        rows = [r for r in self.out if r[2] in kinds]
        self.out = []
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_RECORDS)], schema=_RECORDS)


def _cut(lines: DataFrame, inside: set[tuple[str, int]], kinds: tuple[str, ...]) -> DataFrame:
    """The records of these kinds: whole ones; the head of a split that ends an earlier record; the tail that a later split ends."""
    sent = lines.sparkSession.sparkContext.broadcast(inside)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _Cutter(sent.value)
        for batch in batches:
            counts = pc.count_substring(batch.column("line"), '"').to_pylist()
            columns = (batch.column(c).to_pylist() for c in ("file", "start", "line"))
            for file, start, line, quotes in zip(*columns, counts):
                if (file, start) != cutter.split:
                    cutter.begin((file, start))
                cutter.add(line, quotes)
            yield cutter.taken(kinds)
        cutter.end()
        yield cutter.taken(kinds)

    return lines.mapInArrow(run, RECORDS)


def _put_together(parts: DataFrame) -> DataFrame:
    """Records of several splits: each tail with the heads of the splits behind it, up to the next tail."""
    order = F.struct("start", F.when(F.col("kind") == HEAD, 0).otherwise(1).alias("place"))
    before = Window.partitionBy("file").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    tail = F.when(F.col("kind") == TAIL, F.col("start"))
    owned = parts.select("file", "start", "kind").withColumn("owner", F.last(tail, ignorenulls=True).over(before))
    joined = parts.join(owned, ["file", "start", "kind"])
    ordered = F.array_sort(F.collect_list(F.struct("start", "record")))
    return joined.groupBy("file", "owner").agg(F.max("first").alias("first"), ordered.alias("parts")).select(
        "file", F.col("owner").alias("start"), "first", F.array_join(F.col("parts.record"), "\n").alias("record"))


def read_large_csv(spark: SparkSession, path: str) -> DataFrame:
    """What `read_csv` gives, for a file or folder with a header, where a file may be read by many tasks.

    Fields are text; quoted ones may hold commas, line breaks and doubled
    quotes. A quote stands only around a field, or doubled inside one: the
    number of quotes tells where records end. Lines end in a line feed, with
    or without a carriage return; empty lines are skipped. Files whose header
    has other names, or another order, raise.

    The lines are scanned once for the quotes of each split and once for what
    crosses splits, which is written to the shared folder; the records are
    cut where they are read, without a shuffle.
    """
    lines = _lines(spark, path)
    inside = quoted_splits(lines)
    folder = shared_folder(spark)
    write_table(_cut(lines, inside, (HEAD, TAIL)), f"{folder}/parts")
    across = _put_together(spark.read.parquet(f"{folder}/parts"))
    whole = _cut(lines, inside, (WHOLE,)).select("file", "start", "first", "record")
    records = whole.unionByName(across)
    names = spark.read.options(header=True, multiLine=True, **OPTIONS).csv(path).columns
    fields = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    parsed = records.select("first", F.from_csv("record", fields, {**OPTIONS, "multiLine": "true"}).alias("row"))
    wanted = F.array(*(F.lit(n) for n in names))
    found = F.array(*(F.col("row")[n] for n in names))
    # The first record of a file is its header; it is checked where it is read.
    other = F.when(found == wanted, F.lit(False)).otherwise(F.raise_error(F.lit("a file has another header")))
    return parsed.filter(F.when(F.col("first"), other).otherwise(F.lit(True))).select("row.*")
