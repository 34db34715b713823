"""Near-duplicates by SimHash fingerprints and BK-trees.

Distinct fingerprints are dealt into shards by the pieces that a close one must
share: the 64 bits are cut into radius + 4 pieces, of which a fingerprint
within the radius leaves four whole, so each choice of four pieces names a
shard. A shard holds at most 2^(free bits) fingerprints whatever the table,
and its BK-tree stands in one task. Every member asks the tree, following only
the edges within the radius. Links become stars to the smallest document of a
shard's local component, and connected components put the shards together.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from stayscope.llm.batches import bound_batches, keyed_texts, slices, unsigned_hex
from stayscope.llm.components import components, kept
from stayscope.session import shared_folder

#: Queries and tree nodes that meet at once in a task.
FRONTIER = 2_000_000
SEED = 42
#: Pieces that a shard's members share.
SHARED = 4


def hashes_of(text: str, shingle: int) -> np.ndarray:
    """The hash of every run of words; of the whole sequence if there are fewer; none without words."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    runs = zip(*(words[i:] for i in range(shingle))) if len(words) >= shingle else [words]
    return np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(SEED)), dtype=np.uint64)


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (64 bits as a long) of every text.

    A-Z are lower-cased; words are runs without the six ASCII white-space
    characters. A bit is 1 if set in over half of the shingles' hashes. A
    text without words, or null, has the fingerprint 0.
    """
    return _prints(keyed_texts(docs, id_col, text_col), shingle)


def _prints(texts: DataFrame, shingle: int) -> DataFrame:
    """The rows with fp in place of their text."""
    bound_batches(texts.sparkSession)
    names = [c for c in texts.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                hashes = [hashes_of(text, shingle) for text in part.column("text").to_pylist()]
                sizes = np.array([len(h) for h in hashes])
                out = np.zeros(len(hashes), dtype=np.uint64)
                full = np.flatnonzero(sizes)
                if len(full):
                    flat = np.concatenate(hashes).astype("<u8")
                    bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    begin = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
                    ones = np.add.reduceat(bits, begin, axis=0, dtype=np.int32)
                    most = (2 * ones > sizes[full, None]).astype(np.uint8)
                    out[full] = np.packbits(most, axis=1, bitorder="little").copy().view("<u8").ravel()
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array(out.view(np.int64))], names=[*names, "fp"]
                )

    return texts.mapInArrow(run, ", ".join(f"{c} bigint" for c in [*names, "fp"]))


def shard_masks(radius: int) -> list[int]:
    """For each shard family, the bits that its members share."""
    pieces = radius + SHARED
    cuts = [64 * i // pieces for i in range(pieces + 1)]
    masks = [sum(1 << b for b in range(x, y)) for x, y in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in combinations(masks, SHARED)]


def link_stars(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """Links a, b of documents (node) with distinct fingerprints (fp) at most `radius` bits apart.

    Of every local component of a shard the links to its smallest document are
    given, not all pairs; together they connect what the pairs connect.
    """
    signed = [m - (1 << 64) if m >> 63 else m for m in shard_masks(radius)]
    keys = F.array(*(F.struct(F.lit(i).alias("family"), F.col("fp").bitwiseAND(F.lit(m)).alias("shard"))
                     for i, m in enumerate(signed)))
    dealt = distinct.select("node", "fp", F.inline(keys))
    dealt = dealt.repartition("family", "shard").sortWithinPartitions("family", "shard", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            now = [batch.column(c).to_numpy() for c in ("family", "shard", "node", "fp")]
            held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            # The last shard may go on in the next batch.
            last = np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))
            end = int(last[-1]) + 1 if len(last) else 0
            if end:
                yield _stars([x[:end] for x in held], radius)
                held = [x[end:] for x in held]
        if held is not None and len(held[0]):
            yield _stars(held, radius)

    return dealt.mapInArrow(run, "a bigint, b bigint")


def _stars(columns: list[np.ndarray], radius: int) -> pa.RecordBatch:
    family, shard, node, fp = columns
    begins = np.ones(len(node), dtype=bool)
    begins[1:] = (family[1:] != family[:-1]) | (shard[1:] != shard[:-1])
    group = np.cumsum(begins) - 1
    several = np.bincount(group)[group] > 1
    node, group = node[several], group[several]
    prints = fp[several].astype(np.int64).view(np.uint64)
    label = np.arange(len(node))
    tree = BKForest(prints, group)
    for a, b in tree.links(radius):
        label = _joined(label, a, b)
    # Members stand in the order of their documents, so the smallest place is the smallest document.
    away = np.flatnonzero(label != np.arange(len(label)))
    return pa.RecordBatch.from_arrays(
        [pa.array(node[away], pa.int64()), pa.array(node[label[away]], pa.int64())], names=["a", "b"]
    )


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after uniting the components of each link's ends; a label is a component's smallest place."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        low, high = np.minimum(x, y)[apart], np.maximum(x, y)[apart]
        np.minimum.at(label, high, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


class BKForest:
    """One BK-tree per group of distinct fingerprints, built and searched level by level.

    The first of a group is its root; the others go to the child at their
    distance to the root, where the first is again the parent of the rest.
    """

    def __init__(self, prints: np.ndarray, group: np.ndarray):
        n = len(prints)
        self.prints = prints
        self.root = np.searchsorted(group, group)
        parent, edge = np.full(n, -1), np.zeros(n, dtype=np.int64)
        rest = np.flatnonzero(self.root != np.arange(n))
        above = self.root[rest]
        while len(rest):
            gap = np.bitwise_count(prints[rest] ^ prints[above]).astype(np.int64)
            order = np.lexsort((rest, gap, above))
            rest, above, gap = rest[order], above[order], gap[order]
            first = np.ones(len(rest), dtype=bool)
            first[1:] = (above[1:] != above[:-1]) | (gap[1:] != gap[:-1])
            parent[rest[first]], edge[rest[first]] = above[first], gap[first]
            child = rest[first][np.cumsum(first) - 1]
            rest, above = rest[~first], child[~first]
        nodes = np.flatnonzero(parent >= 0)
        key = parent[nodes] * 128 + edge[nodes]
        order = np.argsort(key)
        self.key, self.child = key[order], nodes[order]

    def links(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of places at most the radius apart, a bounded number of queries at a time."""
        n = len(self.prints)
        if not n:
            return
        size = np.bincount(self.root, minlength=n)[self.root]
        lots = np.cumsum(size) // FRONTIER
        ends = np.flatnonzero(np.append(lots[1:] != lots[:-1], True)) + 1
        for begin, end in zip([0, *ends.tolist()], ends.tolist()):
            query = np.arange(begin, end)
            at = self.root[query]
            while len(query):
                gap = np.bitwise_count(self.prints[query] ^ self.prints[at]).astype(np.int64)
                near = (gap <= radius) & (query != at)
                if near.any():
                    yield query[near], at[near]
                low = np.searchsorted(self.key, at * 128 + np.maximum(gap - radius, 0), side="left")
                high = np.searchsorted(self.key, at * 128 + np.minimum(gap + radius, 127), side="right")
                many = high - low
                total = int(many.sum())
                place = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(total)
                query, at = np.repeat(query, many), self.child[place]


def near_duplicates(
    docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable over links, itself included) of every text.

    Texts link if their fingerprints differ in at most `radius` bits; equal
    ones, and texts without words, do so too. Rows without an id link with
    none, and their component_id is null. Repeated rows are each returned;
    other columns are left behind.
    """
    folder = shared_folder(docs.sparkSession)
    prints = kept(fingerprints(docs, shingle, id_col, text_col), f"{folder}/prints")
    distinct = kept(
        prints.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")), f"{folder}/distinct"
    )
    found = components(link_stars(distinct, radius), f"{folder}/links")
    named = distinct.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component"))
    component = F.when(F.col("doc_id").isNotNull(), F.col("component"))
    return prints.join(named, "fp", "left").select("doc_id", "fp", component.alias("component_id"))


def copy_groups(
    docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, text_key (a hash of the text) and group of every row that has an id.

    The groups are those of `near_duplicates`, but rows of one id and different
    texts are rows of their own: groups are worked out over the fingerprints
    alone, and a group is named by one of them.
    """
    folder = shared_folder(docs.sparkSession)
    texts = keyed_texts(docs, id_col, text_col).filter("doc_id is not null").withColumn("text_key", F.xxhash64("text"))
    prints = kept(_prints(texts, shingle), f"{folder}/prints")
    distinct = kept(prints.select(F.col("fp").alias("node"), "fp").distinct(), f"{folder}/distinct")
    found = components(link_stars(distinct, radius), f"{folder}/links").withColumnRenamed("node", "fp")
    return prints.join(found, "fp", "left").select("doc_id", "text_key", F.coalesce("component", "fp").alias("group"))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of what `near_duplicates` returns."""
    return found.select("doc_id", unsigned_hex(F.col("fp")).alias("fingerprint"), "component_id")
