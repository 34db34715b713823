"""Bounded Arrow batches of texts, and word and hash arrays over their bytes."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BATCH_BYTES = 4 << 20
#: Texts handled at once in a task; a longer text is handled alone.
SLICE_BYTES = 1 << 20
#: The words' separators: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = b" \t\n\x0b\x0c\r"

_MULTIPLIER = 0x9E3779B97F4A7C15
_ROOT = 0xD1342543DE82EF95
_MASK = (1 << 64) - 1


def ship_package(spark: SparkSession) -> None:
    """Give the tasks this package, as `--py-files` would, once per context."""
    context = spark.sparkContext
    if getattr(context, "_llm_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    name = Path(tempfile.mkdtemp(prefix="package-"), "package.zip")
    with zipfile.ZipFile(name, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(name))
    context._llm_shipped = True


def bound_batches(spark: SparkSession) -> None:
    """Let Arrow batches end at BATCH_BYTES, so that long texts cannot fill a worker.

    The setting is the session's own and only ever lowered. The tasks are given
    this package as well.
    """
    ship_package(spark)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch())
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under the names doc_id and text; a null text is empty.

    All other columns are left behind, so their names cannot clash.
    """
    return docs.select(
        docs[id_col].cast("bigint").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins (with the end)."""
    column = column.fill_null("") if column.null_count else column
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset:]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[bounds[0]:bounds[-1]], bounds - bounds[0]


def slices(batch: pa.RecordBatch, name: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch between rows so that the texts of each part stay below the limit."""
    if not batch.num_rows:
        return
    column = batch.column(name)
    column = column.fill_null("") if column.null_count else column
    sizes = np.asarray(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin, held = 0, 0
    for row, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(begin, row - begin)
            begin, held = row, 0
        held += size
    yield batch.slice(begin)


_powers: dict[str, np.ndarray] = {}


def _power(root: int, count: int) -> np.ndarray:
    """The first `count` powers of a number modulo 2^64, kept for the worker's next slice."""
    held = _powers.get(str(root))
    if held is None or len(held) < count:
        size = max(count, 1 << 16)
        out = np.full(size, root, dtype=np.uint64)
        out[0] = 1
        held = np.cumprod(out, dtype=np.uint64)
        if size <= 2 * SLICE_BYTES:
            _powers[str(root)] = held
    return held[:count]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over the whole range (finaliser of a public generator)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of symbols, whatever its place."""
    if "symbols" not in _powers:
        _powers["symbols"] = mixed((np.arange(0x110000, dtype=np.uint64) + np.uint64(1)) * np.uint64(_MULTIPLIER))
    return _sums_of_runs(_powers["symbols"].take(symbols), starts, ends)


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of 64-bit hashes, whatever its place."""
    return _sums_of_runs(mixed(values), starts, ends)


def _sums_of_runs(table: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes from running sums; `table` is overwritten."""
    table *= _power(_ROOT, len(table))
    sums = np.zeros(len(table) + 1, dtype=np.uint64)
    np.cumsum(table, out=sums[1:])
    out = sums[ends]
    out -= sums[starts]
    out *= _power(pow(_ROOT, -1, 1 << 64), len(table) + 1)[starts]
    out += (ends - starts).astype(np.uint64)
    return mixed(out)


_BLANK = np.zeros(256, dtype=bool)
_BLANK[list(BLANKS)] = True


def word_spans(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word, and for each text the number of its first word (with the end)."""
    inside = ~_BLANK[raw]
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[bounds] = True
    before = np.empty(len(raw), dtype=bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(raw), dtype=bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def unsigned_hex(column: Column) -> Column:
    """The 16 lower-case hex digits of a 64-bit number."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))
