"""Language of a text, by letter trigrams and naive Bayes.

The model is trained on text whose language is known and then applied as a
column. Tasks cut batches of texts into trigrams as arrays of numbers; the slots
are those of `HashingTF`, so stored models stay as they are. A model with bounds says `unknown` for text that is
unlike every language it has learned. `seed_texts` gives a little text in seven
languages for callers who have no labelled text of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import HashingTF, NGram
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stayscope.functions.text import letters
from stayscope.operators.seed_text import SEED_TEXT
from stayscope.session import shared_folder
from stayscope.sources.files import write_table

UNKNOWN = "unknown"
TRIGRAM_SLOTS = 2 ** 18
#: Rows that a language's counts are dealt into for the fit.
PARTS = 64
#: Trigrams of a language's average that are added to each text before it is held against the bound.
PAD = 20.0
#: Letters that are cut into trigrams at once.
SLICE_LETTERS = 1 << 20


@dataclass
class LanguageModel:
    """A fitted trigram model and its languages, in the order of its labels.

    `bounds` may hold (average, bound) of a language: what a trigram of its texts
    adds to the log-likelihood on average, and the least mean a text may have.
    """

    stages: PipelineModel
    languages: list[str]
    bounds: dict[str, tuple[float, float]] = field(default_factory=dict)

    def save(self, folder: str) -> None:
        self.stages.write().overwrite().save(f"{folder}/stages")
        spark = SparkSession.getActiveSession()
        rows = [(place, lang, *self.bounds.get(lang, (None, None))) for place, lang in enumerate(self.languages)]
        kinds = "place int, lang string, average double, bound double"
        spark.createDataFrame(rows, kinds).write.mode("overwrite").parquet(f"{folder}/languages")

    @staticmethod
    def load(spark: SparkSession, folder: str) -> "LanguageModel":
        rows = [row.asDict() for row in spark.read.parquet(f"{folder}/languages").orderBy("place").collect()]
        bounds = {row["lang"]: (row["average"], row["bound"]) for row in rows if row.get("bound") is not None}
        return LanguageModel(PipelineModel.load(f"{folder}/stages"), [row["lang"] for row in rows], bounds)


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint32(by)) | (x >> np.uint32(32 - by))


def _murmur(rows: np.ndarray) -> np.ndarray:
    """MurmurHash3 (32 bit, seed 42) of rows of bytes, as signed numbers."""
    n, length = rows.shape
    c1, c2 = np.uint32(0xCC9E2D51), np.uint32(0x1B873593)

    def mixed(k: np.ndarray) -> np.ndarray:
        return _rotated(k * c1, 15) * c2

    h, whole = np.full(n, 42, dtype=np.uint32), length - length % 4
    blocks = np.ascontiguousarray(rows[:, :whole]).view("<u4")
    for i in range(whole // 4):
        h = _rotated(h ^ mixed(blocks[:, i]), 13) * np.uint32(5) + np.uint32(0xE6546B64)
    tail = np.zeros(n, dtype=np.uint32)
    for i in range(whole, length):
        tail |= rows[:, i].astype(np.uint32) << np.uint32(8 * (i - whole))
    h ^= mixed(tail)
    h ^= np.uint32(length)
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return (h ^ (h >> np.uint32(16))).view(np.int32)


def _slots_of(trigrams: np.ndarray, slots: int) -> np.ndarray:
    """The slot of each trigram, given as three times 21 bits: that of `HashingTF` for its letters with blanks between."""
    mask = (1 << 21) - 1
    pieces = [f"{chr(t >> 42)} {chr(t >> 21 & mask)} {chr(t & mask)}".encode() for t in trigrams.tolist()]
    lengths, out = np.array([len(p) for p in pieces], dtype=np.int64), np.empty(len(pieces), dtype=np.int64)
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        rows = np.frombuffer(b"".join(pieces[i] for i in at), dtype=np.uint8).reshape(len(at), length)
        out[at] = _murmur(rows).astype(np.int64) % slots
    return out


def _slices(texts: list[str]) -> Iterator[slice]:
    """Runs of texts of about SLICE_LETTERS letters."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > SLICE_LETTERS:
            yield slice(begin, i)
            begin, held = i, 0
        held += len(text)
    if texts:
        yield slice(begin, len(texts))


def _cut(texts: list[str], slots: int) -> tuple[np.ndarray, np.ndarray]:
    """For each trigram of the texts the number of its text, and its slot."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4").astype(np.int64)
    of = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    if len(codes) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    inside = of[2:] == of[:-2]
    trigrams = ((codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:])[inside]
    known, place = np.unique(trigrams, return_inverse=True)
    return of[:-2][inside], _slots_of(known, slots)[place]


def _fold(text: Column, folds: int) -> Column:
    """Where a text is held out: by its hash, so that copies are held out together."""
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(folds)).cast("int")


def _labelled(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """_text, lang: the rows that hold letters and a known language."""
    rows = df.select(F.col(text_col).alias("_text"), F.col(lang_col).alias("lang"))
    return rows.na.drop().filter(F.col("_text").rlike(r"\p{L}"))


def _language_counts(labelled: DataFrame, slots: int, folds: int) -> DataFrame:
    """lang, fold, slot, n: trigrams per language, fold and slot; the slot -1 counts the texts."""
    rows = labelled.select(
        "lang", _fold(F.col("_text"), folds).alias("fold"), letters(F.col("_text")).alias("_letters"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_letters").to_pylist()
            keys = np.array([f"{fold} {lang}" for lang, fold in zip(*(batch.column(c).to_pylist() for c in ("lang", "fold")))])
            for part in _slices(texts):
                named, key = np.unique(keys[part], return_inverse=True)
                of, slot = _cut(texts[part], slots)
                # The slot -1 comes first.
                counted = np.concatenate([key * (slots + 1), key[of] * (slots + 1) + slot + 1])
                cell, n = np.unique(counted, return_counts=True)
                fold, lang = zip(*(name.split(" ", 1) for name in named.tolist()))
                at = cell // (slots + 1)
                yield pa.RecordBatch.from_arrays([
                    pa.array(lang, pa.string()).take(pa.array(at)), pa.array([int(f) for f in fold], pa.int32()).take(pa.array(at)),
                    pa.array(cell % (slots + 1) - 1, pa.int32()), pa.array(n.astype(np.float64)),
                ], names=["lang", "fold", "slot", "n"])

    counted = rows.mapInArrow(run, "lang string, fold int, slot int, n double")
    return counted.groupBy("lang", "fold", "slot").agg(F.sum("n").alias("n"))


def _word_stages(slots: int) -> list:
    return [
        NGram(n=3, inputCol="_characters", outputCol="_trigrams"),
        HashingTF(inputCol="_trigrams", outputCol="_counts", numFeatures=slots),
    ]


def fit_language_model(
    df: DataFrame, text_col: str, lang_col: str, slots: int = TRIGRAM_SLOTS,
    refuse: float | None = None, folds: int = 4,
) -> LanguageModel:
    """Train on rows with a text and a known language; no shuffle of text.

    Trigrams are counted per language and slot, which spreads over the tasks
    however few the languages are. The counts of a language are then dealt
    into PARTS rows by slot, each weighing its part of the language's texts:
    to the classifier these are the same sums as those over all texts.

    With `refuse`, a small share such as 0.005, the model gets bounds: each text
    is scored for its own language by a model of the other folds, from the same
    counts, and about this share of a language's own texts lies below its bound.
    A language whose texts all lie in one fold has no bound and is never refused.
    """
    labelled, folder = _labelled(df, text_col, lang_col), shared_folder(df.sparkSession)
    write_table(_language_counts(labelled, slots, 1 if refuse is None else folds), folder)
    counts = df.sparkSession.read.parquet(folder)
    model = _fit_counts(counts, slots)
    if refuse is not None:
        model.bounds = _held_out_bounds(labelled, counts, slots, folds, refuse)
    return model


def _fit_counts(counts: DataFrame, slots: int) -> LanguageModel:
    """A model of the counts of all folds given."""
    counts = counts.groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    texts = {row.lang: row.n for row in counts.filter("slot = -1").collect()}
    languages = sorted(texts)
    if not languages:
        raise ValueError("no text with a known language to train on")
    weights = F.create_map(*[F.lit(x) for lang in languages for x in (lang, texts[lang] / PARTS)])
    places = F.create_map(*[F.lit(x) for place, lang in enumerate(languages) for x in (lang, float(place))])
    weighed = counts.filter("slot >= 0").select(
        places[F.col("lang")].alias("_label"), weights[F.col("lang")].alias("_weight"), "slot", "n"
    )
    dealt = weighed.groupBy("_label", "_weight", F.pmod("slot", F.lit(PARTS)).alias("_part")).agg(
        F.array_sort(F.collect_list(F.struct("slot", (F.col("n") / F.col("_weight")).alias("n")))).alias("_entries")
    )
    vector = F.udf(lambda entries: Vectors.sparse(slots, [(e[0], e[1]) for e in entries]), VectorUDT())
    # A part without trigrams still has its share of the texts.
    every = counts.sparkSession.createDataFrame(
        [(float(place), texts[lang] / PARTS, part) for place, lang in enumerate(languages) for part in range(PARTS)],
        "_label double, _weight double, _part long",
    )
    none = F.array().cast("array<struct<slot: int, n: double>>")
    rows = every.join(dealt.drop("_weight"), ["_label", "_part"], "left").select(
        "_label", "_weight", vector(F.coalesce("_entries", none)).alias("_counts")
    )
    bayes = NaiveBayes(
        featuresCol="_counts", labelCol="_label", predictionCol="_place", weightCol="_weight",
        rawPredictionCol="", probabilityCol="", smoothing=1.0, modelType="multinomial",
    )
    return LanguageModel(PipelineModel([*_word_stages(slots), bayes.fit(rows)]), languages)


def _likely(df: DataFrame, model: LanguageModel, text_col: str) -> DataFrame:
    """Adds _letters, _place, _log, an array by place, and _n, the trigrams of the text."""
    bayes = model.stages.stages[-1]
    priors, weights = bayes.pi.toArray(), np.ascontiguousarray(bayes.theta.toArray())
    sent = df.sparkSession.sparkContext.broadcast((priors, weights))

    def score(letter_batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        start, held = sent.value
        for batch in letter_batches:
            logs, sizes, texts = [], [], batch.tolist()
            for part in _slices(texts):
                many = part.stop - part.start
                of, slot = _cut(texts[part], held.shape[1])
                sums = [np.bincount(of, of_lang[slot], many) + p for of_lang, p in zip(held, start)]
                logs.extend(np.stack(sums, axis=1))
                sizes.append(np.bincount(of, minlength=many))
            best = [int(log.argmax()) for log in logs]
            yield pd.DataFrame({"_log": logs, "_n": np.concatenate(sizes or [[]]).astype(np.int32), "_place": np.array(best, dtype=np.float64)})

    told = F.pandas_udf(score, "_log array<double>, _n int, _place double")
    scored = df.withColumn("_letters", letters(F.col(text_col))).withColumn("_told", told("_letters"))
    return scored.select("*", "_told._log", "_told._n", "_told._place").drop("_told")


def _padded_mean(log: Column, n: Column, average: Column) -> Column:
    """Mean log-likelihood of a trigram; short texts are drawn towards the average."""
    return (log + PAD * average) / (n + PAD)


def _held_out_bounds(
    labelled: DataFrame, counts: DataFrame, slots: int, folds: int, refuse: float
) -> dict[str, tuple[float, float]]:
    """(average, bound) per language, each text scored by the model of the other folds.

    The quantile is exact up to 100,000 different scores a language and
    approximate by a hundred-thousandth of the rows beyond.
    """
    parts = []
    for fold in range(folds):
        others = counts.filter(F.col("fold") != fold)
        if others.isEmpty():
            continue
        model = _fit_counts(others, slots)
        own = F.array_position(F.array(*[F.lit(x) for x in model.languages]), F.col("lang")) - 1
        held = _likely(labelled.filter(_fold(F.col("_text"), folds) == fold), model, "_text")
        parts.append(held.select("lang", "_n", F.get("_log", own.cast("int")).alias("_log")).filter("_log is not null"))
    if not parts:
        return {}
    folder = shared_folder(labelled.sparkSession)
    write_table(reduce(DataFrame.unionByName, parts), folder)
    scores = labelled.sparkSession.read.parquet(folder)
    averages = scores.groupBy("lang").agg((F.sum("_log") / F.sum("_n")).alias("average"))
    means = scores.join(F.broadcast(averages), "lang").withColumn(
        "mean", _padded_mean(F.col("_log"), F.col("_n"), F.col("average")))
    found = means.groupBy("lang", "average").agg(F.percentile_approx("mean", refuse, 100_000).alias("bound"))
    return {row.lang: (row.average, row.bound) for row in found.collect()}


def add_language(
    df: DataFrame, model: LanguageModel, text_col: str, out_col: str = "lang"
) -> DataFrame:
    """The text's language code; `unknown` for a text without letters.

    A model with bounds also says `unknown` where the text's mean log-likelihood
    in the most likely language is below that language's bound.

    A filter on the new column stays above it: the optimizer would otherwise
    move the whole model below earlier joins and duplicate removal, and there
    it would read far more rows. The task number, which is never negative,
    keeps it in place, as Spark moves no filter past such a column.
    """
    names = F.array(*[F.lit(name) for name in model.languages])
    place = F.col("_place").cast("int")
    unread = (F.col("_letters") == " ") | (F.spark_partition_id() < 0)
    scored = _likely(df, model, text_col)
    if model.bounds:
        none = (0.0, None)  # a null bound refuses nothing
        average, bound = (
            F.get(F.array(*[F.lit(model.bounds.get(x, none)[i]).cast("double") for x in model.languages]), place)
            for i in (0, 1)
        )
        mean = _padded_mean(F.get("_log", place), F.col("_n"), average)
        unread = unread | F.coalesce(mean < bound, F.lit(False))
    told = F.when(unread, F.lit(UNKNOWN)).otherwise(F.get(names, place))
    return scored.select([F.col(f"`{c}`") for c in df.columns if c != out_col] + [told.alias(out_col)])


def seed_texts(spark: SparkSession) -> DataFrame:
    """Built-in labelled text: `lang`, `text`."""
    rows = [(lang, text) for lang, texts in SEED_TEXT.items() for text in texts]
    return spark.createDataFrame(rows, "lang string, text string")


def default_language_model(spark: SparkSession) -> LanguageModel:
    """A model from the built-in text, for callers without labelled text."""
    return fit_language_model(seed_texts(spark), "text", "lang")
