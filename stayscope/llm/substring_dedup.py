"""Removal of word sequences that occur in an earlier document, by suffix trees.

A window is L consecutive words. Its prefix is the run of PREFIX words with the
least hash among those inside it, so equal windows have equal prefixes.
Neighbouring windows with one prefix form a segment, the suffixes of which are
filed under that prefix:

1. Prefixes that occur in one document only are dropped: nothing below them
   repeats.
2. Equal segments are one leaf label: only the copy in the smallest document
   goes on, the others are repeats as a whole.
3. The different segments of a prefix go to one task, which builds the subtree
   of their suffixes to depth L, level by level. Internal nodes at that depth
   are the repeats; a suffix below a node with a smaller document repeats it.
4. A prefix with more than GROUP segments, or GROUP_WORDS words in them, would
   not fit: it is lengthened.
   Its segments are cut again by the least run of more words, half of what
   is missing to a whole window at a time, and go through 1 to 4 again. A
   prefix as long as the window is a node by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stayscope.llm.batches import bound_batches, keyed_texts, run_hashes, slices, span_hashes, text_bytes, word_spans
from stayscope.llm.components import kept
from stayscope.session import shared_folder

LENGTH = 50
PREFIX = 8
#: Segments of one prefix in a subtree, and their words: a text of one repeated phrase is a single long segment.
GROUP = 256
GROUP_WORDS = 1_000_000
#: Words of the subtrees that are built at once.
TREE_WORDS = 300_000
#: Texts handled at once in a task: their words take several arrays of 64-bit numbers.
SLICE = 512 << 10
ALL = 2**31 - 1


@dataclass
class Segments:
    """The segments of a slice of texts, in text order; `first` has the first word of each text (with the end)."""

    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray
    begin: np.ndarray  # first window of a segment, as a word number
    count: np.ndarray  # its windows
    prefix: np.ndarray
    label: np.ndarray  # hash of its words
    row: np.ndarray

    def body(self, k: int, length: int) -> bytes:
        a, b = self.starts[self.begin[k]], self.ends[self.begin[k] + self.count[k] + length - 2]
        return self.raw[a:b].tobytes()


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of `width` values."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def segments_of(column: pa.Array, length: int, prefix: int) -> Segments:
    raw, bounds = text_bytes(column)
    starts, ends, first = word_spans(raw, bounds)
    hashes = span_hashes(raw, starts, ends)
    none = np.empty(0, np.int64)
    if len(hashes) < length:
        return Segments(raw, starts, ends, first, hashes, none, none, none.view(np.uint64), none.view(np.uint64), none)
    n = len(hashes) - prefix + 1
    at = np.arange(n)
    least = _least(run_hashes(hashes, at, at + prefix), length - prefix + 1)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(first))[:len(least)]
    valid = np.flatnonzero(np.arange(len(least)) + length <= first[row + 1])
    if not len(valid):
        return Segments(raw, starts, ends, first, hashes, none, none, none.view(np.uint64), none.view(np.uint64), none)
    least, row = least[valid], row[valid]
    new = np.ones(len(valid), dtype=bool)
    new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(valid)))
    begin = valid[head]
    # Where the prefix is the whole window, all windows of a segment are equal: one node, however many.
    label = run_hashes(hashes, begin, begin + count + length - 1) if prefix < length else least[head]
    return Segments(raw, starts, ends, first, hashes, begin, count, least[head], label, row[head])


def repeated_suffixes(words: np.ndarray, bounds: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """For each word: does the run of `length` words from here occur in a segment of a smaller document?

    `words` are hashes, segment after segment; `docs` has a document per
    segment. The suffix tree's nodes are named level by level: the node at
    depth 2d above a suffix is given by those at depth d above it and above
    the suffix d words on. A suffix that is alone below its node has no
    internal node further down and is left out.
    """
    n = len(words)
    segment = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    room = bounds[segment + 1] - np.arange(n)
    node = np.full(n, -1, dtype=np.int64)
    alive, names = _shared(np.arange(n), words)
    node[alive] = names
    depth = 1
    while depth < length and len(alive):
        step = min(depth, length - depth)
        alive = alive[room[alive] >= depth + step]
        alive = alive[node[alive + step] >= 0]
        alive, names = _shared(alive, node[alive] * n + node[alive + step])
        node = np.full(n, -1, dtype=np.int64)
        node[alive] = names
        depth += step
    out = np.zeros(n, dtype=bool)
    if len(alive):
        own = docs[segment[alive]]
        order = np.lexsort((own, names))
        smallest = np.empty(names.max() + 1, dtype=np.int64)
        head = np.ones(len(order), dtype=bool)
        head[1:] = names[order][1:] != names[order][:-1]
        smallest[names[order][head]] = own[order][head]
        out[alive] = smallest[names] < own
    return out


def _shared(at: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places whose key another place has, and a number for each such key."""
    _, names, counts = np.unique(keys, return_inverse=True, return_counts=True)
    several = counts[names] > 1
    return at[several], names[several]


def _runs(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return zip(edges[::2].tolist(), edges[1::2].tolist())


def _segment_rows(texts: DataFrame, length: int, prefix: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                s = segments_of(part.column("text"), length, prefix)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.prefix.view(np.int64)), pa.array(s.label.view(np.int64)),
                     part.column("doc_id").take(pa.array(s.row)), pa.array(s.count, pa.int32())],
                    names=["prefix", "label", "doc_id", "windows"],
                )

    return texts.mapInArrow(run, "prefix bigint, label bigint, doc_id bigint, windows int")


def _sizes(leaves: DataFrame, length: int) -> DataFrame:
    """prefix and fits, for each prefix with several different segments: do they fit in one subtree?"""
    words = F.sum(F.col("windows").cast("bigint") + (length - 1))
    sizes = leaves.groupBy("prefix").agg(F.count("*").alias("n"), words.alias("words")).filter("n > 1")
    return sizes.select("prefix", ((F.col("n") <= GROUP) & (F.col("words") <= GROUP_WORDS)).alias("fits"))


def _asked(part: pa.RecordBatch, s: Segments) -> Iterator[tuple[int, int]]:
    """Segment number and row of each asked segment, once per text."""
    lists = part.column("labels")
    for row in range(part.num_rows):
        wanted = set(lists[row].as_py())
        a, b = np.searchsorted(s.row, [row, row + 1]).tolist()
        for k in range(a, b):
            label = int(s.label[k].astype(np.int64))
            if label in wanted:
                wanted.discard(label)
                yield k, row


PIECE = "doc_id bigint, label bigint, offset int, prefix bigint, text string"
MARK = "doc_id bigint, label bigint, low int, high int"
MARK_ARROW = pa.schema([("doc_id", pa.int64()), ("label", pa.int64()), ("low", pa.int32()), ("high", pa.int32())])


def _pieces(texts: DataFrame, asked: DataFrame, length: int, prefix: int) -> DataFrame:
    """The asked segments with their words: doc_id, label, offset (0), prefix, text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                s = segments_of(part.column("text"), length, prefix)
                found = list(_asked(part, s))
                which = np.array([k for k, _ in found], dtype=np.int64)
                rows = pa.array([r for _, r in found], pa.int64())
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(rows), pa.array(s.label[which].view(np.int64)),
                    pa.array(np.zeros(len(which), np.int32)), pa.array(s.prefix[which].view(np.int64)),
                    pa.array([s.body(k, length).decode() for k, _ in found], pa.string()),
                ], names=["doc_id", "label", "offset", "prefix", "text"])

    return texts.join(asked, "doc_id").select("doc_id", "text", "labels").mapInArrow(cut, PIECE)


def _subtree_marks(pieces: DataFrame, length: int) -> DataFrame:
    """doc_id, label, low, high: the repeated windows of segments, from the subtrees of their prefixes."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("prefix", "label", "doc_id", "offset", "text"))):
                if row[0] != last and size >= TREE_WORDS:
                    yield _marks(held, length)
                    held, size = [], 0
                held.append(row)
                # A word takes two bytes at least.
                size, last = size + len(row[4]) // 2, row[0]
        if held:
            yield _marks(held, length)

    return pieces.repartition("prefix").sortWithinPartitions("prefix").mapInArrow(build, MARK)


def _marks(rows: list[tuple], length: int) -> pa.RecordBatch:
    raw, limits = text_bytes(pa.array([r[4] for r in rows], pa.large_string()))
    starts, ends, first = word_spans(raw, limits)
    docs = np.array([r[2] for r in rows], dtype=np.int64)
    repeated = repeated_suffixes(span_hashes(raw, starts, ends), first, docs, length)
    out = [
        {"doc_id": doc_id, "label": label, "low": offset + a, "high": offset + b}
        for k, (_, label, doc_id, offset, _) in enumerate(rows) for a, b in _runs(repeated[first[k]:first[k + 1]])
    ]
    return pa.RecordBatch.from_pylist(out, MARK_ARROW)


def _cut_again(pieces: DataFrame, length: int, prefix: int) -> DataFrame:
    """Pieces under longer prefixes; `part` is the hash of a new piece, `offset` still counts from its first segment."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                s = segments_of(part.column("text"), length, prefix)
                rows = pa.array(s.row)
                offset = part.column("offset").to_numpy()[s.row] + (s.begin - s.first[s.row])
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(rows), part.column("label").take(rows),
                    pa.array(offset, pa.int32()), pa.array(s.prefix.view(np.int64)),
                    pa.array([s.body(k, length).decode() for k in range(len(s.row))], pa.string()),
                    pa.array(s.label.view(np.int64)), pa.array(s.count, pa.int32()),
                ], names=["doc_id", "label", "offset", "prefix", "text", "part", "windows"])

    return pieces.select("doc_id", "label", "offset", "text").mapInArrow(cut, PIECE + ", part bigint, windows int")


def _lengthened(pieces: DataFrame, length: int, prefix: int, folder: str) -> tuple[list[DataFrame], DataFrame]:
    """Marks of pieces under a longer prefix, and the pieces whose prefix is still too frequent."""
    again = kept(_cut_again(pieces, length, prefix), f"{folder}/again")
    leaves = again.groupBy("prefix", "part").agg(F.min("doc_id").alias("least"), F.max("windows").alias("windows"))
    first = again.join(leaves.drop("windows"), ["prefix", "part"])
    copies = first.filter("doc_id > least").select(
        "doc_id", "label", F.col("offset").alias("low"), (F.col("offset") + F.col("windows")).alias("high")
    )
    sized = first.filter("doc_id = least").join(_sizes(leaves, length), "prefix")
    sized = sized.select("doc_id", "label", "offset", "prefix", "text", "fits")
    trees = _subtree_marks(sized.filter("fits").drop("fits"), length)
    return [copies, trees], kept(sized.filter("not fits").drop("fits"), f"{folder}/frequent")


def repeat_marks(texts: DataFrame, length: int, prefix: int, folder: str) -> DataFrame:
    """doc_id and marks: for segments by label, the windows from low to high (not itself) that repeat."""
    every = kept(_segment_rows(texts, length, prefix), f"{folder}/segments")
    several = every.groupBy("prefix").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high")
    shared = kept(every.join(several.select("prefix"), "prefix", "left_semi"), f"{folder}/shared")
    leaves = shared.groupBy("prefix", "label").agg(F.min("doc_id").alias("least"), F.max("windows").alias("windows"))
    leaves = kept(leaves, f"{folder}/leaves")
    copies = shared.join(leaves.drop("windows"), ["prefix", "label"]).filter("doc_id > least").select(
        "doc_id", "label", F.lit(0).alias("low"), F.lit(ALL).alias("high")
    )
    sized = leaves.join(_sizes(leaves, length), "prefix").select(F.col("least").alias("doc_id"), "label", "fits")

    def lists(rows: DataFrame) -> DataFrame:
        return rows.groupBy("doc_id").agg(F.collect_set("label").alias("labels"))

    few, many = sized.filter("fits"), sized.filter("not fits")
    marks = [copies, _subtree_marks(_pieces(texts, lists(few), length, prefix), length)]
    # Written first, so that Spark knows their size and sends few of them to the texts.
    asked = kept(lists(many), f"{folder}/asked")
    frequent = kept(_pieces(texts, asked, length, prefix), f"{folder}/frequent")
    while prefix < length and not frequent.isEmpty():
        prefix += max(1, (length - prefix + 1) // 2)
        more, frequent = _lengthened(frequent, length, prefix, f"{folder}/{prefix}")
        marks += more
    return reduce(DataFrame.unionAll, marks).groupBy("doc_id").agg(
        F.collect_list(F.struct("label", "low", "high")).alias("marks")
    )


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, prefix: int = PREFIX, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, text, kept_text, n_words, n_removed and spans (begin, end in words) of every text.

    Words are runs without the six ASCII white-space characters. Removed is
    each word covered by a window that also starts in a document with a
    smaller id; windows are judged on the input. `kept_text` has the other
    words with one space between. A null text has no words; rows without an id
    are returned whole and no other text repeats them; rows that share an id
    are one document; other columns are left behind.
    """
    if not 0 < prefix <= length:
        raise ValueError("the prefix must fit in a window")
    spark = docs.sparkSession
    bound_batches(spark)
    rows = keyed_texts(docs, id_col, text_col)
    texts = rows.filter("doc_id is not null")
    marks = repeat_marks(texts, length, prefix, shared_folder(spark))
    none = F.lit(None).cast("array<struct<label: bigint, low: int, high: int>>")
    marked = texts.join(marks, "doc_id", "left").select("doc_id", "text", "marks").unionAll(
        rows.filter("doc_id is null").select("doc_id", "text", none.alias("marks"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                yield _kept(part, length, prefix)

    return marked.mapInArrow(
        run, "doc_id bigint, text string, kept_text string, n_words bigint, n_removed bigint, "
        "spans array<struct<begin: bigint, end: bigint>>"
    )


def _kept(part: pa.RecordBatch, length: int, prefix: int) -> pa.RecordBatch:
    s = segments_of(part.column("text"), length, prefix)
    covered = np.zeros(len(s.hashes) + 1, dtype=np.int32)
    marks = part.column("marks")
    for row in range(part.num_rows):
        own = marks[row].as_py()
        if not own:
            continue
        by_label: dict[int, list[tuple[int, int]]] = {}
        for mark in own:
            by_label.setdefault(mark["label"], []).append((mark["low"], mark["high"]))
        a, b = np.searchsorted(s.row, [row, row + 1]).tolist()
        for k in range(a, b):
            for low, high in by_label.get(int(s.label[k].astype(np.int64)), ()):
                begin = int(s.begin[k])
                covered[begin + low] += 1
                covered[begin + min(high, int(s.count[k])) - 1 + length] -= 1
    removed = np.cumsum(covered[:-1]) > 0
    kept_texts, spans, counts = [], [], []
    for row, text in enumerate(part.column("text").to_pylist()):
        a, b = int(s.first[row]), int(s.first[row + 1])
        words = text.encode().split()
        gone = removed[a:b]
        if gone.any():
            words = [w for w, g in zip(words, gone.tolist()) if not g]
        kept_texts.append(b" ".join(words).decode())
        spans.append([{"begin": x, "end": y} for x, y in _runs(gone)])
        counts.append((b - a, int(gone.sum())))
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id"), part.column("text"), pa.array(kept_texts, pa.string()),
         pa.array([c[0] for c in counts], pa.int64()), pa.array([c[1] for c in counts], pa.int64()),
         pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))],
        names=["doc_id", "text", "kept_text", "n_words", "n_removed", "spans"],
    )


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of what `remove_repeats` returns."""
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
