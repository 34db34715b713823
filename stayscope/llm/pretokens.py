"""The pieces of byte-level BPE pre-tokenisation, for whole batches of texts at once.

The rule is the public pattern
`'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`.
Its matches are found from the classes of neighbouring characters: a piece is a
run of one class with at most one space before it; a run of white space gives
its last character away, to the next piece if it is a space and else as a piece
of its own; a lone apostrophe takes an English ending with it.
"""

from __future__ import annotations

import re
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex

from stayscope.llm.batches import span_hashes, text_bytes

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE, LETTER, NUMBER, OTHER = range(4)

_classes: list[np.ndarray] = []


def classes() -> np.ndarray:
    """The class of each code point, worked out once per worker.

    Letters and numbers follow the same Unicode tables as the pattern's engine.
    """
    if not _classes:
        every = "".join(map(chr, [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]))
        table = np.full(sys.maxunicode + 1, OTHER, dtype=np.uint8)
        for kind, pattern in ((SPACE, r"\s+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
            for run in regex.finditer(pattern, every):
                skip = 0x800
                a, b = (x + skip if x >= 0xD800 else x for x in (run.start(), run.end() - 1))
                table[a:b + 1] = kind
        table[0xD800:0xE000] = OTHER
        _classes.append(table)
    return _classes[0]


@dataclass
class Pieces:
    """Pieces in text order: byte spans, hashes, and the first piece of each text (with the end)."""

    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def bytes_of(self, which: np.ndarray) -> list[bytes]:
        whole = self.raw.tobytes()
        return [whole[a:b] for a, b in zip(self.starts[which].tolist(), self.ends[which].tolist())]


def cut(column: pa.Array, special: tuple[bytes, ...] = ()) -> Pieces:
    """The pieces of every text; occurrences of a special string are pieces of their own."""
    raw, bounds = text_bytes(column)
    lead = (raw & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    n = len(points)
    at = np.append(at, len(raw))
    edges = np.searchsorted(at, bounds)
    wall = np.zeros(n + 1, dtype=bool)
    wall[edges] = True
    kind = classes()[points]
    held = _special_spans(raw, bounds, at, special)
    for a, b in held:
        wall[a] = wall[b] = True
    starts_run = wall[:-1].copy()
    starts_run[1:] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(starts_run)
    run_end = np.append(run[1:], n)
    begins = np.zeros(n + 1, dtype=bool)
    begins[run] = True
    blank = kind[run] == SPACE
    # A run of white space followed by something within the same text gives its last character away.
    gives = blank & (run_end < n) & ~wall[run_end]
    last = run_end[gives] - 1
    begins[last] = True
    begins[last[points[last] == 32] + 1] = False
    _endings(points, kind, wall, run, run_end, begins)
    for a, b in held:
        begins[a + 1:b] = False
        begins[a] = True
        begins[b] = True
    starts = np.flatnonzero(begins[:n])
    ends = np.append(starts[1:], n) if len(starts) else starts
    first = np.searchsorted(starts, edges)
    return Pieces(raw, at[starts], at[ends], span_hashes(points, starts, ends), first)


def _special_spans(raw, bounds, at, special) -> list[tuple[int, int]]:
    """Leftmost and longest occurrences within one text, as character spans."""
    if not special:
        return []
    pattern = re.compile(b"|".join(re.escape(x) for x in sorted(special, key=len, reverse=True)))
    whole, found, i = raw.tobytes(), [], 0
    while hit := pattern.search(whole, i):
        text = np.searchsorted(bounds, hit.start(), side="right") - 1
        if hit.end() <= bounds[text + 1]:
            found.append(tuple(np.searchsorted(at, hit.span()).tolist()))
            i = hit.end()
        else:
            i = hit.start() + 1
    return found


#: Fixed values of the pattern: the English endings after an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def _endings(points, kind, wall, run, run_end, begins) -> None:
    """Split an ending from the letters after it, where a piece is one apostrophe."""
    n = len(points)
    lone = run[(points[run] == 39) & (run_end - run == 1)]
    lone = lone[begins[lone] & (lone + 1 < n)]
    lone = lone[~wall[lone + 1]]
    for ending in ENDINGS:
        hit = lone[lone + len(ending) < n]
        for k, letter in enumerate(ending, 1):
            hit = hit[points[hit + k] == ord(letter)]
            hit = hit[~wall[hit + k]]
        begins[hit + 1] = False
        begins[hit + 1 + len(ending)] |= True
