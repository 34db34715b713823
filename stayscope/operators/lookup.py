"""Joins with a lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup_join(facts: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join a large table with a lookup table on columns named alike; inner, left or left_semi.

    The way is left to Spark: below its size threshold, known beforehand or
    measured while the query runs, the lookup table is broadcast; beyond it both
    sides are shuffled, and a hot key's rows are split over as many tasks as
    their size asks for.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"lookup_join does not do {how!r} joins")
    return facts.join(lookup, on, how)
