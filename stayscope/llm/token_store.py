"""Token ids in files of directly addressable codes.

File format: a Parquet folder with one row per segment. Texts stand in
ascending order of their id, over `part` and `segment`; a segment holds whole
texts and closes once it has SEGMENT_TOKENS ids or more.

- `part`, `segment`: int, the order of the segments
- `doc_ids`: array of long, `sizes`: array of int, ids of each text with its end id
- `n_tokens`: long, all ids of the segment
- `levels`: array of struct. An id is split into chunks of WIDTH bits, lowest
  first; level k holds the k-th chunk of every id that has one.
  - `chunks`: one byte per id on this level
  - `more`: a bitmap, lowest bit first, padded to 64 bits: does the id go on?
  - `ranks`: unsigned 32-bit numbers, little-endian: the ones before each block
    of 512 bits. The place of an id on the next level is the number of ones
    before its bit, so that any token is read without decoding its neighbours.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stayscope.llm.batches import bound_batches, keyed_texts, slices
from stayscope.llm.library_bpe import library_of

SEGMENT_TOKENS = 1 << 18
WIDTH = 8
BLOCK = 512
#: Texts encoded at once in a task, beside a sort that fills the executor's heap.
SLICE_BYTES = 1 << 18

LEVELS = pa.list_(pa.struct([("chunks", pa.binary()), ("more", pa.binary()), ("ranks", pa.binary())]))
SEGMENTS = pa.schema([
    ("part", pa.int32()), ("segment", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())),
    ("n_tokens", pa.int64()), ("levels", LEVELS),
])
SEGMENTS_DDL = (
    "part int, segment int, doc_ids array<bigint>, sizes array<int>, n_tokens bigint, "
    "levels array<struct<chunks: binary, more: binary, ranks: binary>>"
)


def pack(ids: np.ndarray) -> list[dict[str, bytes]]:
    """The levels of a sequence of ids."""
    levels, values = [], ids.astype(np.uint32)
    while len(values):
        rest = values >> np.uint32(WIDTH)
        more = rest > 0
        bits = np.packbits(more, bitorder="little")
        bits = np.pad(bits, (0, -len(bits) % 8))
        words = np.bitwise_count(np.pad(bits, (0, -len(bits) % (BLOCK // 8))).view(np.uint64))
        ones = words.reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint32)
        ranks = np.cumsum(ones, dtype=np.uint32) - ones
        levels.append({"chunks": values.astype(np.uint8).tobytes(), "more": bits.tobytes(), "ranks": ranks.tobytes()})
        values = rest[more]
    return levels


def unpack(levels: list[dict[str, bytes]]) -> np.ndarray:
    """All ids of a segment."""
    if not levels:
        return np.empty(0, np.uint32)
    out = np.frombuffer(levels[0]["chunks"], np.uint8).astype(np.uint32)
    at = np.arange(len(out))
    for k, level in enumerate(levels):
        if k:
            out[at] |= np.frombuffer(level["chunks"], np.uint8).astype(np.uint32) << np.uint32(WIDTH * k)
        more = np.unpackbits(np.frombuffer(level["more"], np.uint8), count=len(at), bitorder="little")
        at = at[more.astype(bool)]
    return out


def look_up(levels: list[dict[str, bytes]], places: np.ndarray) -> np.ndarray:
    """The ids at some places of a segment, through the rank directories alone."""
    out = np.zeros(len(places), dtype=np.uint32)
    live, at = np.arange(len(places)), places.astype(np.int64)
    for k, level in enumerate(levels):
        out[live] |= np.frombuffer(level["chunks"], np.uint8)[at].astype(np.uint32) << np.uint32(WIDTH * k)
        words = np.frombuffer(level["more"], np.uint64)
        word, bit = at // 64, (at % 64).astype(np.uint64)
        goes_on = (words[word] >> bit & np.uint64(1)).astype(bool)
        live, at, word, bit = live[goes_on], at[goes_on], word[goes_on], bit[goes_on]
        if not len(live):
            break
        block = at // BLOCK
        rank = np.frombuffer(level["ranks"], np.uint32)[block].astype(np.int64)
        rank += np.bitwise_count(words[word] & ((np.uint64(1) << bit) - np.uint64(1)))
        for back in range(1, BLOCK // 64):
            earlier = word - back
            inside = earlier >= block * (BLOCK // 64)
            rank += np.where(inside, np.bitwise_count(words[np.maximum(earlier, 0)]), 0)
        at = rank
    return out


def write_store(
    docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode every text, append the end id, and write the files described above.

    The texts are dealt by ranges of their id, so every task writes a run of
    the order. A null or empty text holds its end id only; rows without an id
    come first; rows that share an id follow each other by a hash of the text.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        content = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, special, known = library_of(content.value)
        part, segment, held = TaskContext.get().partitionId(), 0, []
        for batch in batches:
            for piece in slices(batch, limit=SLICE_BYTES):
                ids, bounds = known.encode_column(piece.column("text"), encode, special)
                # The end id goes in behind each text.
                ids = np.insert(ids, bounds[1:], end_id)
                held.append((piece.column("doc_id"), np.diff(bounds) + 1, ids))
                if sum(len(x[2]) for x in held) >= SEGMENT_TOKENS:
                    yield _segment(part, segment, held)
                    segment, held = segment + 1, []
        if held:
            yield _segment(part, segment, held)

    texts = keyed_texts(docs, id_col, text_col)
    ordered = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(run, SEGMENTS_DDL).write.parquet(folder)


def _segment(part: int, segment: int, held: list) -> pa.RecordBatch:
    doc_ids = pa.concat_arrays([x[0] for x in held])
    sizes = np.concatenate([x[1] for x in held]).astype(np.int32)
    ids = np.concatenate([x[2] for x in held])
    one = np.array([0, len(doc_ids)], dtype=np.int32)
    return pa.RecordBatch.from_arrays([
        pa.array([part], pa.int32()), pa.array([segment], pa.int32()),
        pa.ListArray.from_arrays(one, doc_ids), pa.ListArray.from_arrays(one, pa.array(sizes)),
        pa.array([len(ids)], pa.int64()), pa.array([pack(ids)], LEVELS),
    ], schema=SEGMENTS)


def directory(spark: SparkSession, folder: str) -> DataFrame:
    """part, segment, n_tokens, start: where each segment begins among all ids.

    Totals per part come first, so the running sum over all parts has a row
    per writing task only.
    """
    segments = spark.read.schema(SEGMENTS_DDL).parquet(folder).select("part", "segment", "n_tokens")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("held")).select(
        "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("part_start")
    )
    within = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    return segments.withColumn("inside", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(parts, "part").select(
        "part", "segment", "n_tokens", (F.col("part_start") + F.col("inside")).alias("start")
    )


def _texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each segment: the texts' ids, their places among all token ids, their bounds within the segment, the token ids."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            ids = unpack(row.column("levels")[0].as_py()).astype(np.int32)
            ends = np.concatenate(([0], np.cumsum(row.column("sizes").flatten().to_numpy())))
            yield row.column("doc_ids").flatten(), row.column("start")[0].as_py() + ends[:-1], ends, ids


def _placed(spark: SparkSession, folder: str) -> DataFrame:
    """doc_ids, sizes, levels and start of every segment."""
    segments = spark.read.schema(SEGMENTS_DDL).parquet(folder).drop("n_tokens")
    placed = segments.join(directory(spark, folder).drop("n_tokens"), ["part", "segment"])
    return placed.select("doc_ids", "sizes", "levels", "start")


def read_store(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start and ids (array of int, with the end id) of every text in the files."""
    bound_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, start, ends, ids in _texts_of(batches):
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([doc_ids, pa.array(start, pa.int64()), lists], names=["doc_id", "start", "ids"])

    return _placed(spark, folder).mapInArrow(run, "doc_id bigint, start bigint, ids array<int>")


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """`digests` of `read_store`, in the worker that reads a segment: no second worker beside it is sent the ids."""
    bound_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, start, ends, ids in _texts_of(batches):
            yield _digested(doc_ids, pa.array(start, pa.int64()), ends, ids)

    return _placed(spark, folder).mapInArrow(run, DIGESTS_DDL)


def tokens_at(spark: SparkSession, folder: str, places: DataFrame, place_col: str = "place") -> DataFrame:
    """place and token_id for each asked place among all ids; a place outside is left out.

    Places meet segments through cells of SEGMENT_TOKENS ids, and only the
    asked codes are read, through the rank directories.
    """
    bound_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                asked = row.column("places").flatten().to_numpy()
                ids = look_up(row.column("levels")[0].as_py(), asked - row.column("start")[0].as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asked, pa.int64()), pa.array(ids.astype(np.int32))], names=["place", "token_id"]
                )

    cells = directory(spark, folder).withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("start") / SEGMENT_TOKENS), F.floor((F.col("start") + F.col("n_tokens") - 1) / SEGMENT_TOKENS)
    )))
    asked = places.select(places[place_col].cast("bigint").alias("place")).dropna().distinct()
    asked = asked.withColumn("cell", F.floor(F.col("place") / SEGMENT_TOKENS))
    # Places are distinct, so a segment's list is never longer than the segment.
    found = asked.join(cells, "cell").filter("place >= start and place < start + n_tokens")
    lists = found.groupBy("part", "segment", "start").agg(F.collect_list("place").alias("places"))
    segments = spark.read.schema(SEGMENTS_DDL).parquet(folder).select("part", "segment", "levels")
    return lists.join(segments, ["part", "segment"]).select("places", "start", "levels").mapInArrow(
        run, "place bigint, token_id int"
    )


DIGESTS_DDL = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def _digested(doc_ids: pa.Array, start: pa.Array, bounds: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    values = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
    sums = [zlib.crc32(values[4 * a:4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    return pa.RecordBatch.from_arrays(
        [doc_ids, start, pa.array(np.diff(bounds), pa.int64()), pa.array(sums, pa.int64())],
        names=["doc_id", "start", "n_tokens", "ids_crc32"],
    )


def digests(stored: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (over little-endian unsigned 32-bit ids) of what `read_store` returns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            yield _digested(batch.column("doc_id"), batch.column("start"), lists.offsets.to_numpy(), lists.values.to_numpy())

    return stored.mapInArrow(run, DIGESTS_DDL)
