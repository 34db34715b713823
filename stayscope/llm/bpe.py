"""Byte-level BPE: texts to token ids and back, by merging in padded matrices.

The distinct pre-tokens of a batch are dealt by length into padded matrices of
ids. In each round every row merges its leftmost pair of lowest rank; the rank
is looked up in a hash table of pairs. Rows with nothing left to merge leave
the matrix, and its width shrinks with the longest row.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stayscope.llm.batches import bound_batches, keyed_texts, mixed, slices
from stayscope.llm.known import KnownPieces

#: Longer pre-tokens are merged alone with a heap: a matrix takes a round per merge.
WIDEST = 256
#: Cells of a matrix.
MATRIX_CELLS = 500_000
#: Ids decoded at once.
DECODED_IDS = 250_000
NONE = np.int32(2**31 - 1)

_held: dict[str, "Ranks"] = {}
_known: dict[str, KnownPieces] = {}
_pieces: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


class Ranks:
    """The vocabulary of a ranks file (`base64 rank` lines) with a hash table of its pairs."""

    def __init__(self, content: bytes):
        pairs = [line.split() for line in content.splitlines() if line.strip()]
        self.rank = {base64.b64decode(a): int(b) for a, b in pairs}
        self.pieces = [b""] * (max(self.rank.values()) + 1)
        for piece, rank in self.rank.items():
            self.pieces[rank] = piece
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], dtype=np.int32)
        left, right, merged = [], [], []
        for piece, rank in self.rank.items():
            for k in range(1, len(piece)):
                a, b = self.rank.get(piece[:k]), self.rank.get(piece[k:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        self._fill(np.array(left, np.uint64) << np.uint64(32) | np.array(right, np.uint64), np.array(merged, np.int32))

    def _fill(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Open addressing: pairs whose slot is taken try the next one, all at once."""
        self.mask = np.uint64((1 << max(4, int(len(keys) * 4).bit_length())) - 1)
        self.keys = np.full(int(self.mask) + 1, 2**64 - 1, dtype=np.uint64)
        self.values = np.full(int(self.mask) + 1, NONE, dtype=np.int32)
        slot = mixed(keys) & self.mask
        left = np.arange(len(keys))
        while len(left):
            free = left[self.keys[slot[left]] == np.uint64(2**64 - 1)]
            _, winner = np.unique(slot[free], return_index=True)
            won = free[winner]
            self.keys[slot[won]] = keys[won]
            self.values[slot[won]] = values[won]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + np.uint64(1)) & self.mask
        self.empty = np.uint64(2**64 - 1)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The id that each pair merges into, NONE if it is no pair."""
        key = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
        slot = mixed(key) & self.mask
        out = self.values[slot]
        there = self.keys[slot]
        miss = np.flatnonzero((there != key) & (there != self.empty))
        out[there != key] = NONE
        while len(miss):
            slot[miss] = (slot[miss] + np.uint64(1)) & self.mask
            there = self.keys[slot[miss]]
            hit = there == key[miss]
            out[miss[hit]] = self.values[slot[miss[hit]]]
            miss = miss[~hit & (there != self.empty)]
        return out

    def encode(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of each piece."""
        out: list[np.ndarray] = [None] * len(pieces)
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        whole = np.fromiter((self.rank.get(p, -1) for p in pieces), dtype=np.int64, count=len(pieces))
        for i in np.flatnonzero(whole >= 0).tolist():
            out[i] = whole[i:i + 1].astype(np.int32)
        for i in np.flatnonzero((whole < 0) & (sizes > WIDEST)).tolist():
            out[i] = self._merge_long(pieces[i])
        rest = np.flatnonzero((whole < 0) & (sizes <= WIDEST))
        rest = rest[np.argsort(sizes[rest], kind="stable")]
        begin = 0
        while begin < len(rest):
            # Rows up to a quarter longer than the shortest share a matrix of bounded size.
            width = int(sizes[rest[begin]] * 5 // 4)
            end = int(np.searchsorted(sizes[rest], width, side="right"))
            end = min(end, begin + max(1, MATRIX_CELLS // max(width, 1)))
            self._merge_rows(pieces, rest[begin:end], out)
            begin = end
        return out

    def _merge_rows(self, pieces: list[bytes], which: np.ndarray, out: list) -> None:
        rows = [pieces[i] for i in which.tolist()]
        size = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
        width = int(size.max())
        if not width:
            for i in which.tolist():
                out[i] = np.empty(0, np.int32)
            return
        flat = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), dtype=np.uint8)
        ids = self.byte[flat].reshape(len(rows), width)
        column = np.arange(width)
        ranks = np.full((len(rows), width), NONE, dtype=np.int32)
        if width > 1:
            pair = self.merged(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), width - 1)
            ranks[:, :-1] = np.where(column[1:] < size[:, None], pair, NONE)
        while True:
            best = ranks.argmin(axis=1)
            row = np.arange(len(which))
            rank = ranks[row, best]
            done = rank == NONE
            if done.any():
                for k in np.flatnonzero(done).tolist():
                    out[which[k]] = ids[k, :size[k]].copy()
                live = ~done
                if not live.any():
                    return
                which, size, best, rank = which[live], size[live], best[live], rank[live]
                width = int(size.max())
                ids, ranks = ids[live][:, :width], ranks[live][:, :width]
                row, column = np.arange(len(which)), np.arange(width)
            # Close the gap: what stands right of the merged pair moves one place to the left.
            keep = column[None, :-1] <= best[:, None]
            ids[:, :-1] = np.where(keep, ids[:, :-1], ids[:, 1:])
            ranks[:, :-1] = np.where(keep, ranks[:, :-1], ranks[:, 1:])
            ranks[:, -1] = NONE
            ids[row, best] = rank
            size = size - 1
            right = best + 1 < size
            ranks[row, best] = NONE
            if right.any():
                r, c = row[right], best[right]
                ranks[r, c] = self.merged(ids[r, c], ids[r, c + 1])
            left = best > 0
            if left.any():
                r, c = row[left], best[left]
                ranks[r, c - 1] = self.merged(ids[r, c - 1], ids[r, c])

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """One long piece: the same merges in the same order, from a heap of (rank, place)."""
        ids = self.byte[np.frombuffer(piece, dtype=np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = self.merged(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32)).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(pairs) if r != NONE]
        heapq.heapify(heap)

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n:
                a, b = ids[i], ids[after[i]]
                r = self.rank.get(self.pieces[a] + self.pieces[b])
                if r is not None:
                    heapq.heappush(heap, (r, i, a, b))

        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = r, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return np.array([x for x in ids if x >= 0], dtype=np.int32)


def ranks_of(content: bytes) -> Ranks:
    """The vocabulary, made once per worker."""
    key = str(hash(content))
    if key not in _held:
        _held[key] = Ranks(content)
    return _held[key]


def pieces_of(content: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What each id stands for: sizes, begins and all bytes, made once per worker. Decoding needs no pairs."""
    key = str(hash(content))
    if key not in _pieces:
        rank = {int(b): base64.b64decode(a) for a, b in (line.split() for line in content.splitlines() if line.strip())}
        pieces = [rank.get(i, b"") for i in range(max(rank) + 1)]
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        begin = np.concatenate(([0], np.cumsum(sizes)))
        _pieces[key] = sizes, begin, np.frombuffer(b"".join(pieces), dtype=np.uint8)
    return _pieces[key]


def known_of(content: bytes) -> KnownPieces:
    """What the worker has met so far with this vocabulary, in this task or an earlier one."""
    return _known.setdefault(str(hash(content)), KnownPieces())


def encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every text.

    Each match of the public pattern is encoded on its own, without special
    tokens. A null or empty text has no ids; a null id stays null; repeated
    rows are each encoded; other columns are left behind. The ranks file is
    read by the driver and sent to the tasks: its size is that of the
    vocabulary, whatever the data.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    with open(ranks_path, "rb") as f:
        content = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, known = ranks_of(content.value), known_of(content.value)
        for batch in batches:
            for part in slices(batch):
                ids, bounds = known.encode_column(part.column("text"), ranks.encode)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], names=["doc_id", "ids"])

    return keyed_texts(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, ids and decoded (binary): the bytes that the ids stand for.

    Null ids give empty bytes. An id outside the vocabulary raises.
    """
    spark = encoded.sparkSession
    bound_batches(spark)
    with open(ranks_path, "rb") as f:
        content = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, begin, flat = pieces_of(content.value)
        for batch in batches:
            for part in _id_slices(batch):
                lists = part.column("ids")
                bounds = lists.offsets.to_numpy().astype(np.int64)
                ids = lists.values.to_numpy()[bounds[0]:bounds[-1]]
                if len(ids) and (ids.min() < 0 or ids.max() >= len(sizes)):
                    raise ValueError("an id outside the vocabulary")
                ends = np.concatenate(([0], np.cumsum(sizes[ids])))
                shift = np.repeat(begin[ids] - ends[:-1], sizes[ids])
                shift += np.arange(int(ends[-1]))
                out = pa.Array.from_buffers(
                    pa.large_binary(), len(lists),
                    [None, pa.py_buffer(ends[bounds - bounds[0]]), pa.py_buffer(flat[shift])],
                ).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists, out], names=["doc_id", "ids", "decoded"])

    narrow = encoded.select(
        encoded[id_col].cast("bigint").alias("doc_id"),
        F.coalesce(encoded[ids_col], F.array().cast("array<int>")).alias("ids"),
    )
    return narrow.mapInArrow(run, "doc_id bigint, ids array<int>, decoded binary")


def _id_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Cut a batch between rows after about DECODED_IDS ids."""
    ends = batch.column("ids").offsets.to_numpy()
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(ends, ends[begin] + DECODED_IDS, side="right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of what `decode` returns."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
