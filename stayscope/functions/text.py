"""Text expressions: full text, words, term counts, labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

WORD_BREAK = r"[^\p{L}\p{N}]+"
NOT_LETTERS = r"[^\p{L}]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def full_text(title: Column, text: Column) -> Column:
    """Title and text with a blank between; a null title leaves the text alone."""
    return F.concat_ws(" ", title, text)


def sentiment(rating: Column) -> Column:
    """1 from four stars on, else 0."""
    return F.when(rating >= 4, F.lit(1)).otherwise(F.lit(0))


def is_blank(text: Column) -> Column:
    """Null, empty, or white space only."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")) == ""


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), WORD_BREAK), lambda word: word != "")


def term_counts(tokens: Column) -> Column:
    """Array of (term, tf), one per different word, worked out inside the row.

    The words are sorted and each run of equal words is measured, so counting
    needs no shuffle and takes n log n steps for n words.
    """
    def runs(ordered: Column) -> Column:
        begins = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )
        return let(begins, lambda starts: F.transform(
            starts,
            lambda at, n: F.struct(
                F.get(ordered, at).alias("term"),
                (F.coalesce(F.get(starts, n + 1), F.size(ordered)) - at).alias("tf"),
            ),
        ))

    empty = F.array().cast("array<struct<term:string,tf:int>>")
    return F.when(F.size(tokens) > 0, let(F.sort_array(tokens), runs)).otherwise(empty)


def letters(text: Column) -> Column:
    """Lower-cased letters, a single blank between words and at both ends.

    A text without letters gives one blank.
    """
    padded = F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" "))
    return F.regexp_replace(padded, NOT_LETTERS, " ")
