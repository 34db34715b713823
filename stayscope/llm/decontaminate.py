"""Benchmark items that stand in training texts, up to a number of edits.

Both sides are reduced to lower-case words with one space between. An item of
m characters may differ by k = m // EDIT_SHARE edits. It is split into k + 1
pieces; k edits leave at least one piece whole (pigeonhole), so an automaton
over all pieces finds every candidate place. Each is verified by Myers'
bit-parallel edit distance over the window that the item could fill.

An item of fewer than LEAST_CHARS characters is its own only piece, without edits
and at word bounds. Inside a longer text it says little: such a hit is `weak`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from stayscope.llm.batches import bound_batches, keyed_texts

#: One edit is allowed for so many characters.
EDIT_SHARE = 16
#: Shorter items say little inside a text.
LEAST_CHARS = 20
#: Items sent to the tasks at once; more of them make more passes over the texts.
BLOCK_BYTES = 512 << 10

_WORD = re.compile(r"[^\W_]+")
#: Scripts written without spaces: a word may begin or end at any of their letters.
_UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]")
_made: dict[int, "Items"] = {}


def plain(text: str) -> str:
    return " ".join(_WORD.findall(text)).lower()


def distance_in(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """Least edit distance of the pattern to any part of the text, and where that part ends (the first such).

    Myers' algorithm: the column of the dynamic programme is held as two bit
    vectors of vertical differences. None if the distance exceeds `most`.
    """
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, last = (1 << m) - 1, 1 << m - 1
    up, down, score = full, 0, m
    best, end = (m, 0) if m <= most else (most + 1, -1)
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        vertical = eq | down
        diagonal = (((eq & up) + up) ^ up) | eq
        plus = down | ~(diagonal | up) & full
        minus = up & diagonal
        if plus & last:
            score += 1
        elif minus & last:
            score -= 1
        plus = plus << 1 & full
        minus = minus << 1 & full
        up = minus | ~(vertical | plus) & full
        down = plus & vertical
        if score < best:
            best, end = score, j + 1
            if not best:
                break
    return (best, end) if best <= most else None


def _word_bound(text: str, at: int) -> bool:
    """Does a word of the reduced text begin or end here?"""
    sides = text[at - 1:at + 1] if at else ""
    return len(sides) < 2 or " " in sides or bool(_UNSPACED.search(sides))


@dataclass
class Items:
    """Reduced items with their pieces in an automaton."""

    texts: dict[int, str]

    def __post_init__(self) -> None:
        self.budget: dict[int, int] = {}
        found: dict[str, list[tuple[int, int]]] = {}
        for item, text in self.texts.items():
            if not text:
                continue
            k = self.budget[item] = len(text) // EDIT_SHARE if len(text) >= LEAST_CHARS else 0
            cuts = [len(text) * i // (k + 1) for i in range(k + 2)]
            for a, b in zip(cuts, cuts[1:]):
                found.setdefault(text[a:b], []).append((item, a))
        self.automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, distance, begin, end) in a reduced text: the closest place of each item, the first of equal ones."""
        out: dict[int, tuple[int, int, int]] = {}
        if not self.budget:
            return []
        seen: dict[int, set[int]] = {}
        for last, (size, places) in self.automaton.iter(text):
            for item, offset in places:
                diagonal, k = last + 1 - size - offset, self.budget[item]
                if item in out and not out[item][0]:
                    continue
                if diagonal in seen.setdefault(item, set()):
                    continue
                seen[item].add(diagonal)
                pattern = self.texts[item]
                if len(pattern) < LEAST_CHARS:
                    if _word_bound(text, diagonal) and _word_bound(text, last + 1):
                        out[item] = (0, diagonal, last + 1)
                    continue
                begin = max(0, diagonal - k)
                window = text[begin:diagonal + len(pattern) + k]
                hit = distance_in(pattern, window, k)
                if hit and (item not in out or hit[0] < out[item][0]):
                    end = begin + hit[1]
                    back = distance_in(pattern[::-1], text[max(0, end - len(pattern) - k):end][::-1], hit[0])
                    out[item] = (hit[0], end - back[1], end)
        return [(i, *x) for i, x in sorted(out.items())]


def _raw_span(text: str, begin: int, end: int) -> tuple[int, int]:
    """The part of the original text whose words hold a part of the reduced text."""
    at, first, last = 0, None, 0
    for word in _WORD.finditer(text):
        size = len(word[0].lower())
        if first is None and at + size > begin:
            first = word.start()
        if at >= end:
            break
        last = word.end()
        at += size + 1
    return first or 0, last


HITS = "array<struct<item_id: bigint, distance: int, begin: int, end: int, weak: boolean>>"
_HIT = pa.list_(pa.struct([
    ("item_id", pa.int64()), ("distance", pa.int32()), ("begin", pa.int32()), ("end", pa.int32()), ("weak", pa.bool_()),
]))


def _search(texts: DataFrame, items: dict[int, str]) -> DataFrame:
    content = texts.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(frozenset(content.value.items()))
        if key not in _made:
            _made.clear()
            _made[key] = Items(content.value)
        known = _made[key]
        for batch in batches:
            hits = []
            for text in batch.column("text").to_pylist():
                reduced = plain(text)
                hits.append([
                    dict(zip(("begin", "end"), _raw_span(text, a, b))) | {
                        "item_id": i, "distance": d,
                        "weak": len(known.texts[i]) < LEAST_CHARS and len(reduced) > len(known.texts[i]),
                    }
                    for i, d, a, b in known.find(reduced)
                ])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(hits, _HIT)],
                names=["doc_id", "text_key", "hits"],
            )

    return texts.mapInArrow(run, f"doc_id bigint, text_key bigint, hits {HITS}")


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[dict[int, str]]:
    """Reduced items in blocks of at most BLOCK_BYTES (or one item), read one after another.

    Rows without an id or a text are left out. Items that share an id are all
    searched, and reported under it.
    """
    rows = items.select(items[id_col].cast("bigint").alias("item_id"), items[text_col].cast("string").alias("text"))
    rows = rows.dropna().distinct().orderBy("item_id", "text")
    block, held = {}, 0
    for row in rows.toLocalIterator():
        text = plain(row.text)
        if held and (held + len(text.encode()) > BLOCK_BYTES or row.item_id in block):
            yield block
            block, held = {}, 0
        block[row.item_id] = text
        held += len(text.encode())
    if block:
        yield block


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """doc_id, text_key and hits (item_id, distance, begin, end in the text, weak) of every text.

    Each item is reported at its closest place. A hit of an item below LEAST_CHARS is weak unless it is the whole text. A null or empty text has no
    hits; repeated rows are each searched; a null id stays null; other columns
    are left behind. `text_key` is a hash of the text.

    The items are a query set against all texts, in blocks of BLOCK_BYTES: one
    block is one pass without a shuffle; hits of several blocks are put together per row.
    """
    bound_batches(docs.sparkSession)
    texts = keyed_texts(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    found = None
    for block in item_blocks(items, item_id_col, item_text_col):
        one = _search(texts, block)
        if found is None:
            found = one
            continue
        # Copies of a row have equal hits, so one of them stands for all.
        more = one.filter(F.size("hits") > 0).groupBy("doc_id", "text_key").agg(F.first("hits").alias("more"))
        more = more.toDF("id_", "key_", "more")
        found = found.join(more, F.expr("doc_id <=> id_ and text_key = key_"), "left").select(
            "doc_id", "text_key", F.concat("hits", F.coalesce("more", F.array().cast(HITS))).alias("hits")
        )
    if found is None:
        found = texts.select("doc_id", "text_key", F.array().cast(HITS).alias("hits"))
    return found


def strong(hits: Column) -> Column:
    """The hits that are not weak."""
    return F.filter(hits, lambda hit: ~hit["weak"])


def digests(found: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_items, item_ids (ascending) and least_distance of what `contamination` returns.

    These are of the hits that are not weak; n_weak counts the items with weak hits only.
    """
    told = found.withColumn("sure", strong(F.col("hits")))
    return told.select(
        "doc_id",
        (F.size("sure") > 0).alias("contaminated"),
        F.size(F.array_distinct("sure.item_id")).cast("bigint").alias("n_items"),
        F.array_sort(F.array_distinct("sure.item_id")).alias("item_ids"),
        F.array_min("sure.distance").alias("least_distance"),
        F.size(F.array_except("hits.item_id", "sure.item_id")).cast("bigint").alias("n_weak"),
    )
