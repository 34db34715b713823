"""Language identification by compression with a dictionary per language.

Each language has a raw-content zstandard dictionary made of sample texts. A
text is encoded with every dictionary; the language with the smallest code
wins. A narrow margin means that the codes cannot tell, and may be rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, functions as F

from stayscope.llm.batches import bound_batches, keyed_texts

#: Bytes of a language's dictionary.
DICTIONARY_BYTES = 32 << 10
#: Sampled in expectation for a dictionary; the sample of a language is bounded by it, whatever the table.
SAMPLE_BYTES = 4 * DICTIONARY_BYTES
#: Longer texts are not sampled.
SAMPLED_TEXT_BYTES = 64 << 10
#: A text is encoded in chunks, so that the dictionary tells as much at its end as at its start.
CHUNK_BYTES = 4 << 10
UNDECIDED = "und"

_NO_LETTER = regex.compile(r"\P{L}+")
_made: dict[str, list] = {}


def letters_only(text: str | None) -> bytes:
    """Lower-case words of letters with a space between, in UTF-8."""
    return _NO_LETTER.sub(" ", (text or "").lower()).strip().encode()


def fit_dictionaries(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text") -> dict[str, bytes]:
    """A dictionary per language from a bounded sample of the labelled texts.

    Rows without a language or a letter are left out, equal texts count once.
    Texts of one language are drawn by their hash with the probability that
    gives SAMPLE_BYTES; the text of smallest hash is always drawn. What is
    collected grows with the number of languages only. The languages come in
    the order of their bytes of distinct text, largest first.
    """
    rows = labelled.select(
        labelled[lang_col].cast("string").alias("lang"), labelled[text_col].cast("string").alias("text")
    ).filter("lang is not null and text rlike '\\\\p{L}'").filter(F.octet_length("text") <= SAMPLED_TEXT_BYTES)
    rows = rows.withColumn("draw", F.xxhash64("text").bitwiseAND(F.lit((1 << 63) - 1)))
    distinct = rows.groupBy("lang", "draw").agg(F.max(F.octet_length("text")).alias("size"))
    sizes = distinct.groupBy("lang").agg(F.sum("size").alias("bytes"), F.min("draw").alias("least")).collect()
    if not sizes:
        return {}
    bounds = [(r.lang, max(r.least, min((1 << 63) - 1, (1 << 63) * SAMPLE_BYTES // max(1, r.bytes)))) for r in sizes]
    spark = labelled.sparkSession
    limits = F.broadcast(spark.createDataFrame(bounds, "lang string, bound bigint"))
    drawn = rows.join(limits, "lang").filter("draw <= bound").dropDuplicates(["lang", "draw"])
    out: dict[str, bytes] = {}
    for row in sorted(drawn.select("lang", "draw", "text").collect(), key=lambda r: (r.lang, r.draw)):
        held = out.get(row.lang, b"")
        if len(held) < DICTIONARY_BYTES:
            out[row.lang] = held + b"\n" + letters_only(row.text)
    common = sorted(sizes, key=lambda r: (-r.bytes, r.lang))
    return {r.lang: out[r.lang][-DICTIONARY_BYTES:] for r in common}


def _coders(dictionaries: dict[str, bytes]) -> list:
    """The compressors, made once per worker. Their search finds matches of three bytes, as syllables need."""
    key = str(hash(tuple(dictionaries.items())))
    if key not in _made:
        made = []
        for lang in dictionaries:
            settings = zstandard.ZstdCompressionParameters(
                window_log=18, hash_log=16, chain_log=16, search_log=3, min_match=3, target_length=32,
                strategy=zstandard.STRATEGY_LAZY2, write_content_size=False, write_checksum=False,
                write_dict_id=False,
            )
            content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(compression_params=settings)
            made.append(zstandard.ZstdCompressor(compression_params=settings, dict_data=content))
        _made.clear()
        _made[key] = made
    return _made[key]


def code_sizes(coders: list, text: bytes) -> np.ndarray:
    """Bytes of the text's code under each dictionary."""
    chunks = [text[i:i + CHUNK_BYTES] for i in range(0, len(text), CHUNK_BYTES)]
    return np.array([sum(len(coder.compress(c)) for c in chunks) for coder in coders], dtype=np.int64)


def identify(
    docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = 0.0, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, lang_pred, score and margin of every text.

    `margin` is the share by which the runner-up's code is longer; below
    `min_margin` the answer is rejected, and so is a null text or one without
    letters: lang_pred is then `und`. `score` is the winner's part when each
    byte more halves a language's weight, 0 without letters. Equal codes go to
    the dictionary given first. Repeated rows are each answered; a null id stays null;
    other columns are left behind. Without dictionaries all is `und`.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    names = list(dictionaries)
    content = spark.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = _coders(content.value)
        for batch in batches:
            langs, scores, margins = [], [], []
            for text in batch.column("text").to_pylist():
                plain = letters_only(text)
                if not plain or not names:
                    langs.append(UNDECIDED)
                    scores.append(0.0)
                    margins.append(0.0)
                    continue
                sizes = code_sizes(coders, plain)
                best = int(sizes.argmin())
                others = np.delete(sizes, best)
                margin = float(others.min() / sizes[best] - 1) if len(others) else 1.0
                langs.append(names[best] if margin >= min_margin else UNDECIDED)
                scores.append(float(1 / np.exp2(np.maximum(sizes[best] - sizes, -1000.0)).sum()))
                margins.append(margin)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores), pa.array(margins)],
                names=["doc_id", "lang_pred", "score", "margin"],
            )

    return keyed_texts(docs, id_col, text_col).mapInArrow(
        run, "doc_id bigint, lang_pred string, score double, margin double"
    )
