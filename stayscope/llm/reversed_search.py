"""Ranked lexical search turned round: the items' index goes to the documents.

The terms of a block of items form an inverted index that every task is given.
Each document's counts of these terms stream through it once, adding to the
scores of the items that hold them, and a heap per item keeps the best
documents of the task. The heaps of all tasks are merged by rank.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stayscope.llm.batches import bound_batches, keyed_texts
from stayscope.llm.components import kept
from stayscope.session import shared_folder

#: Items searched in one pass over the documents, as bytes of their texts; more of them make more passes.
BLOCK_BYTES = 8 << 20
#: A longer text is cut into words part by part.
PART_BYTES = 1 << 20
#: Scores held at once in a task: documents times items.
CELLS = 1 << 21

#: Fixed by the definition of a term: digits, letters and every byte of a character outside ASCII; A-Z to a-z.
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


def terms(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists that bound the memory of very long texts."""
    raw = text.encode("utf-8", "surrogatepass").translate(_TABLE)
    begin = 0
    while len(raw) - begin > PART_BYTES:
        end = raw.find(b" ", begin + PART_BYTES)
        if end < 0:
            break
        yield raw[begin:end].split()
        begin = end
    yield raw[begin:].split()


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items as (id, different terms), in blocks of at most BLOCK_BYTES of text (or one item).

    Rows of equal id and text are one item. Items without a term are left out.
    """
    rows = items.select(items[id_col].cast("bigint").alias("item_id"), items[text_col].cast("string").alias("text"))
    block, held = [], 0
    for row in rows.filter("text is not null").distinct().orderBy("item_id", "text").toLocalIterator():
        asked = sorted({t for part in terms(row.text) for t in part})
        size = len(row.text.encode("utf-8", "surrogatepass"))
        if block and held + size > BLOCK_BYTES:
            yield block
            block, held = [], 0
        if asked:
            block.append((row.item_id, asked))
            held += size
    if block:
        yield block


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms, with repeats), terms (numbers in the vocabulary) and tfs of every text."""
    content = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = content.value
        for batch in batches:
            sizes, found, tfs = [], [], []
            ends = np.zeros(batch.num_rows + 1, dtype=np.int32)
            for i, text in enumerate(batch.column("text").to_pylist()):
                size, counted = 0, {}
                for part in terms(text):
                    size += len(part)
                    for t in map(number.get, part):
                        if t is not None:
                            counted[t] = counted.get(t, 0) + 1
                sizes.append(size)
                found.extend(counted.keys())
                tfs.extend(counted.values())
                ends[i + 1] = len(found)
            bounds = pa.array(ends)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(bounds, pa.array(found, pa.int32())),
                pa.ListArray.from_arrays(bounds, pa.array(tfs, pa.int64())),
            ], names=["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>")


@dataclass
class ItemIndex:
    """For each term its weight and the items that hold it; and the numbers of documents and of terms."""

    weight: np.ndarray
    first: np.ndarray
    items: np.ndarray
    n_items: int
    n_docs: int
    n_terms: int

    @staticmethod
    def of(block: list[list[int]], df: np.ndarray, n_docs: int, n_terms: int) -> "ItemIndex":
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)
        held = np.array([t for item in block for t in item], dtype=np.int64)
        owner = np.repeat(np.arange(len(block)), [len(item) for item in block])
        order = np.argsort(held, kind="stable")
        first = np.searchsorted(held[order], np.arange(len(df) + 1))
        return ItemIndex(weight, first, owner[order], len(block), n_docs, n_terms)

    def scores(self, doc: np.ndarray, n: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Documents x items, from the counts (document, term, tf) and each document's n."""
        m = 10 + 90 * n * self.n_docs // self.n_terms
        part = self.weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
        many = self.first[term + 1] - self.first[term]
        out = np.zeros(len(n) * self.n_items, dtype=np.int64)
        begin = 0
        # A slice of counts at a time, so that the places to add to stay few.
        while begin < len(term):
            end = max(begin + 1, int(np.searchsorted(np.cumsum(many[begin:]), CELLS)) + begin)
            take = many[begin:end]
            place = np.arange(int(take.sum())) - np.repeat(np.cumsum(take) - take, take)
            item = self.items[np.repeat(self.first[term[begin:end]], take) + place]
            np.add.at(out, np.repeat(doc[begin:end], take) * self.n_items + item, np.repeat(part[begin:end], take))
            begin = end
        return out.reshape(len(n), self.n_items)


class Heaps:
    """For each item the k best (score, smaller id first; rows without an id last)."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.heaps: list[list[tuple[int, int, int]]] = [[] for _ in range(n_items)]
        self.floor = np.ones(n_items, dtype=np.int64)

    def offer(self, scores: np.ndarray, ids: list[int | None]) -> None:
        for row, item in zip(*(x.tolist() for x in np.nonzero(scores >= self.floor))):
            name, heap = ids[row], self.heaps[item]
            entry = (int(scores[row, item]), int(name is not None), -(name or 0))
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.k:
                self.floor[item] = heap[0][0]

    def rows(self) -> pa.RecordBatch:
        found = [(i, e[0], -e[2] if e[1] else None) for i, heap in enumerate(self.heaps) for e in heap]
        item, score, doc = zip(*found) if found else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())],
            names=["item", "doc_id", "score"],
        )


def _best_of_tasks(counts: DataFrame, index: ItemIndex, k: int) -> DataFrame:
    """item, doc_id, score: the k best documents of every task."""
    content = counts.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = content.value
        heaps, step = Heaps(known.n_items, k), max(1, CELLS // known.n_items)
        for batch in batches:
            for begin in range(0, batch.num_rows, step):
                part = batch.slice(begin, step)
                lists = part.column("terms")
                many = np.diff(lists.offsets.to_numpy())
                heaps.offer(known.scores(
                    np.repeat(np.arange(len(many)), many), part.column("n").to_numpy(),
                    lists.flatten().to_numpy().astype(np.int64), part.column("tfs").flatten().to_numpy(),
                ), part.column("doc_id").to_pylist())
        yield heaps.rows()

    return counts.mapInArrow(run, "item int, doc_id bigint, score bigint")


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k best documents of every item, scores above 0 only.

    A term is a run of ASCII letters, digits and characters outside ASCII; only
    A-Z are lower-cased. The score is an integer sum over the item's different
    terms of weight times saturated frequency (see `ItemIndex`), so it does not
    depend on the order of anything. Ties go to the smaller doc_id.

    Null and empty texts have no terms. Items of equal id and text are one;
    items that share only the id are ranked apart and both returned. Repeated
    documents are ranked each; one without an id counts like any other and
    comes last among equal scores. Other columns are left behind. Without
    items, or documents with terms, the result is empty.

    The items are a query set in blocks of BLOCK_BYTES. Per block the documents
    are cut into terms once; only the counts of asked terms are written to the
    shared folder, and the statistics and scores are taken from them.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    folder = shared_folder(spark)
    texts = keyed_texts(docs, id_col, text_col)
    ranked = []
    for turn, block in enumerate(item_blocks(items, item_id_col, item_text_col)):
        number = {t: i for i, t in enumerate(sorted({t for _, asked in block for t in asked}))}
        counts = kept(term_counts(texts, number), f"{folder}/counts{turn}")
        n_docs, n_terms = counts.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            continue
        df = np.zeros(len(number), dtype=np.int64)
        # At most a row per term of the block.
        for row in counts.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
            df[row.term] = row["count"]
        index = ItemIndex.of([[number[t] for t in asked] for _, asked in block], df, n_docs, n_terms)
        best = _best_of_tasks(counts, index, k)
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        names = spark.createDataFrame(
            [(i, item_id) for i, (item_id, _) in enumerate(block)], "item int, item_id bigint"
        )
        merged = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        ranked.append(merged.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not ranked:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    out = ranked[0]
    for more in ranked[1:]:
        out = out.unionByName(more)
    return out
