"""Token counts of texts, from counts made once per distinct pre-token.

1. Tasks tally the pre-tokens of their texts; partial tallies are summed, which
   gives every distinct pre-token of the table with its frequency.
2. The library counts the tokens of each distinct pre-token once.
3. Each text's pre-token frequencies are joined to these counts and summed. The
   most frequent pre-tokens, as many as fit in TABLE_BYTES, are joined where
   the text is; the others by a shuffle of (text, pre-token, frequency).

No text's ids are ever made.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from stayscope.llm.batches import bound_batches, keyed_texts, slices
from stayscope.llm.known import KnownPieces
from stayscope.llm.library_bpe import library_of, special_strings
from stayscope.llm.pretokens import cut
from stayscope.session import shared_folder

#: What may be sent to every task: 12 bytes for each pre-token.
TABLE_BYTES = 64 << 20
ENTRY_BYTES = 12
#: Pre-tokens tallied in a task before they are handed on.
TALLIED = 400_000


def distinct_pieces(texts: DataFrame, special: tuple[bytes, ...]) -> DataFrame:
    """hash, piece (binary) and freq of every distinct pre-token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, found, freq = KnownPieces(2 * TALLIED), [], np.zeros(0, np.int64)

        def flush() -> pa.RecordBatch:
            # The keys in the order in which the pieces were met.
            keys = np.empty(known.count, dtype=np.uint64)
            used = known.places >= 0
            keys[known.places[used]] = known.keys[used]
            return pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(found, pa.binary()), pa.array(freq)],
                names=["hash", "piece", "freq"],
            )

        for batch in batches:
            for part in slices(batch):
                pieces = cut(part.column("text"), special)

                def met(which: np.ndarray) -> list[np.ndarray]:
                    found.extend(pieces.bytes_of(which))
                    return [np.empty(0, np.int32)] * len(which)

                at = known.find(pieces.hashes)
                new = np.flatnonzero(at < 0)
                if len(new):
                    distinct, sample = np.unique(pieces.hashes[new], return_index=True)
                    if known.count + len(distinct) > TALLIED and known.count:
                        yield flush()
                        known, found, freq = KnownPieces(max(2 * TALLIED, len(pieces.hashes))), [], np.zeros(0, np.int64)
                        distinct, sample = np.unique(pieces.hashes, return_index=True)
                        new = np.arange(len(pieces.hashes))
                    known.add(distinct, met(new[sample]))
                    at = known.find(pieces.hashes)
                freq = np.concatenate((freq, np.zeros(known.count - len(freq), np.int64)))
                freq += np.bincount(at, minlength=known.count)
        if known.count:
            yield flush()

    tallied = texts.select("text").mapInArrow(run, "hash bigint, piece binary, freq bigint")
    return tallied.groupBy("hash", "piece").agg(F.sum("freq").alias("freq"))


def count_pieces(distinct: DataFrame, tokenizer: str) -> DataFrame:
    """The same rows with n_tokens, asked of the library once per row."""
    content = distinct.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, _, _ = library_of(content.value)
        for batch in batches:
            sizes = [len(ids) for ids in encode(batch.column("piece").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sizes, pa.int32())], names=["hash", "piece", "freq", "n_tokens"]
            )

    return distinct.mapInArrow(run, "hash bigint, piece binary, freq bigint, n_tokens int")


def frequent_table(counted: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Hashes and token counts of the most frequent pre-tokens within the limit, and whether that is all.

    The cut is at a power of two of the frequency, found from a histogram with
    a row per power. Pre-tokens that share a hash are left to the shuffle.
    """
    power = F.floor(F.log2("freq")).cast("int")
    histogram = sorted(counted.groupBy(power.alias("power")).count().collect(), reverse=True)
    held, least, every = 0, 64, True
    for bucket, count in histogram:
        if (held + count) * ENTRY_BYTES > limit:
            every = False
            break
        held, least = held + count, bucket
    if not held:
        return np.empty(0, np.uint64), np.empty(0, np.int32), not histogram
    table = counted.filter(power >= least).select("hash", "n_tokens").toArrow()
    hashes = table["hash"].to_numpy().view(np.uint64)
    order = np.argsort(hashes, kind="stable")
    hashes, sizes = hashes[order], table["n_tokens"].to_numpy()[order]
    shared = np.zeros(len(hashes), dtype=bool)
    same = hashes[1:] == hashes[:-1]
    shared[1:] |= same
    shared[:-1] |= same
    if not every:
        # A rarer pre-token may have the hash of a frequent one.
        rare = counted.filter(power < least).select("hash")
        both = counted.filter(power >= least).select("hash").join(rare, "hash", "left_semi").distinct()
        shared |= np.isin(hashes, np.array([r[0] for r in both.collect()], dtype=np.int64).view(np.uint64))
    return hashes[~shared], sizes[~shared], every and not shared.any()


def token_counts(
    docs: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text",
    table_bytes: int = TABLE_BYTES,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more tokens than the limit) of every text.

    A null or empty text has no bytes and no tokens. Repeated rows are each
    counted, a null id stays null, other columns are left behind. Special
    strings in a text are single tokens, as the library's default has it.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = f.read()
    special = special_strings(tokenizer)
    texts = keyed_texts(docs, id_col, text_col)
    folder = shared_folder(spark)
    count_pieces(distinct_pieces(texts, special), tokenizer).write.parquet(f"{folder}/pieces")
    counted = spark.read.parquet(f"{folder}/pieces")
    hashes, sizes, every = frequent_table(counted, table_bytes)
    joined = _join_where_texts_are(spark, texts, special, hashes, sizes)
    if not every:
        joined.write.parquet(f"{folder}/texts")
        joined = _join_the_rest(spark.read.parquet(f"{folder}/texts"), counted)
    return joined.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _join_where_texts_are(
    spark: SparkSession, texts: DataFrame, special: tuple[bytes, ...], hashes: np.ndarray, sizes: np.ndarray
) -> DataFrame:
    """doc_id, text_key, n_bytes, n_tokens of the frequent pre-tokens, and the others with their frequency."""
    table = spark.sparkContext.broadcast((hashes, sizes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = table.value
        known = KnownPieces()
        for batch in batches:
            for part in slices(batch):
                pieces = cut(part.column("text"), special)

                def look_up(which: np.ndarray) -> list[np.ndarray]:
                    asked = pieces.hashes[which]
                    at = np.minimum(np.searchsorted(keys, asked), max(len(keys) - 1, 0))
                    found = np.full(len(which), -1, dtype=np.int32)
                    if len(keys):
                        hit = keys[at] == asked
                        found[hit] = values[at[hit]]
                    return np.split(found, np.arange(1, len(found)))

                at = known.places_of(pieces.hashes, look_up)
                count = known.ids[known.begin[at]].astype(np.int64)
                sums = np.concatenate(([0], np.cumsum(np.maximum(count, 0))))
                first = pieces.first
                rest = _others(pieces, np.flatnonzero(count < 0), first)
                size = np.append(pieces.starts, len(pieces.raw))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"),
                     pa.array(size[first[1:]] - size[first[:-1]], pa.int64()),
                     pa.array(sums[first[1:]] - sums[first[:-1]], pa.int64()), rest],
                    names=["doc_id", "text_key", "n_bytes", "n_tokens", "rest"],
                )

    keyed = texts.withColumn("text_key", F.xxhash64("text"))
    return keyed.mapInArrow(
        run, "doc_id bigint, text_key bigint, n_bytes bigint, n_tokens bigint, "
        "rest array<struct<piece: binary, freq: bigint>>"
    )


def _others(pieces, which: np.ndarray, first: np.ndarray) -> pa.Array:
    """For each text, its pre-tokens outside the table with their frequency."""
    kind = pa.list_(pa.struct([("piece", pa.binary()), ("freq", pa.int64())]))
    if not len(which):
        return pa.array([[]] * (len(first) - 1), kind)
    text = np.searchsorted(first, which, side="right") - 1
    out: list[Counter] = [Counter() for _ in range(len(first) - 1)]
    for k, piece in zip(text.tolist(), pieces.bytes_of(which)):
        out[k][piece] += 1
    return pa.array([[{"piece": p, "freq": n} for p, n in c.items()] for c in out], kind)


def _join_the_rest(joined: DataFrame, counted: DataFrame) -> DataFrame:
    """Add the tokens of the pre-tokens that were not in the table.

    Rows are told apart by id and a hash of the text; rows equal in both are
    copies, summed once and given the sum each.
    """
    one = joined.dropDuplicates(["doc_id", "text_key", "n_bytes"])
    parts = one.select("doc_id", "text_key", "n_bytes", F.inline("rest"))
    sums = parts.join(counted.select("piece", F.col("n_tokens").alias("each")), "piece").groupBy(
        "doc_id", "text_key", "n_bytes"
    ).agg(F.sum(F.col("freq") * F.col("each")).alias("more"))
    sums = sums.toDF("id_", "key_", "bytes_", "more")
    there = F.expr("doc_id <=> id_ and text_key = key_ and n_bytes = bytes_")
    return joined.drop("rest").join(sums, there, "left").select(
        "doc_id", "n_bytes", (F.col("n_tokens") + F.coalesce("more", F.lit(0))).alias("n_tokens")
    )
