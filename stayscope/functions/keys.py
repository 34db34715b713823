"""Document keys, dates and missing values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def iso_date(date: Column) -> Column:
    """`2001-08-01T00:00:00`; a missing date stays null."""
    return F.date_format(date.try_cast("timestamp"), ISO_FORMAT)


def nan_to_null(number: Column) -> Column:
    """NaN becomes null, all else stays."""
    return F.when(~F.isnan(number), number)


def doc_key(*names: str) -> Column:
    """MD5 over the fields joined by a bar; a null field reads `None`."""
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("None")) for name in names]
    return F.md5(F.concat_ws("|", *fields))


def hash_percent(*names: str) -> Column:
    """0 to 99, decided by the values alone and thus by no layout of the data."""
    text = F.concat_ws("|", *[F.coalesce(F.col(n).cast("string"), F.lit("None")) for n in names])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 100
