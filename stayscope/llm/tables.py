"""Tables that are sent to every task, within a bound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def most_frequent(counted: DataFrame, rows: int, freq_col: str = "freq") -> tuple[Column | None, bool]:
    """Which rows to send: the most frequent, at most `rows` of them; and whether that is all.

    The cut is at a power of two of the frequency, found from a histogram with
    a row per power. None if not even the highest power fits.
    """
    power = F.floor(F.log2(F.greatest(F.col(freq_col), F.lit(1)))).cast("int")
    histogram = sorted(counted.groupBy(power.alias("power")).count().collect(), reverse=True)
    held, least = 0, None
    for bucket, count in histogram:
        if held + count > rows:
            return (None if least is None else power >= least), False
        held, least = held + count, bucket
    return F.lit(True), True
