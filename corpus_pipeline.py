"""From raw documents to token ids: five stages, each over all that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stayscope.llm import bpe, decontaminate, kneser_ney, simhash_bktree, substring_dedup
from stayscope.session import shared_folder


def _text_key() -> Column:
    """The hash of the text by which the operators name a row beside its id."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def _of_rows(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Join documents with rows that have doc_id, text_key and perhaps more; a null id equals a null id."""
    named = rows.withColumnsRenamed({"doc_id": "id_", "text_key": "key_"})
    return docs.withColumn("text_key", _text_key()).join(named, F.expr("doc_id <=> id_ and text_key = key_"), how)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model of the trusted ones does not reject."""
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1 and toxic = 0").select("doc_id")
    verdicts = kneser_ney.judge(docs, trusted, quantile=0.995, folds=4, word_quantile=0.995)
    kept = verdicts.filter("keep").select("doc_id", "text_key").distinct()
    return _of_rows(docs, kept, "left_semi").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (SimHash of 3-word shingles, 2 bits) the row of smallest id and text, once.

    A row is named by its id and text; rows without an id all stay.
    """
    found = simhash_bktree.copy_groups(docs, shingle=3, radius=2)
    first = found.groupBy("group").agg(F.min(F.struct("doc_id", "text_key")).alias("row")).select("row.*")
    kept = _of_rows(docs, first, "left_semi").dropDuplicates(["doc_id", "text_key"])
    return kept.select(docs.columns).unionByName(docs.filter("doc_id is null"))


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of earlier documents; a text of which nothing is left goes.

    An untouched text stays as it is; of another the words left stand with one
    space between, and n_chars counts them.
    """
    found = substring_dedup.remove_repeats(docs, length=50)
    touched = found.filter("n_removed > 0").select(
        "doc_id", F.xxhash64("text").alias("text_key"), "kept_text"
    ).dropDuplicates(["doc_id", "text_key"])
    joined = _of_rows(docs, touched, "left").filter("kept_text is null or kept_text <> ''")
    changed = {
        "n_chars": F.when(F.col("kept_text").isNull(), F.col("n_chars")).otherwise(F.char_length("kept_text")),
        "text": F.coalesce("kept_text", "text"),
    }
    return joined.select(*(changed[c].cast(kind).alias(c) if c in changed else F.col(c) for c, kind in docs.dtypes))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands; a short item inside a longer text does not count."""
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    bad = found.filter(F.size(decontaminate.strong(F.col("hits"))) > 0).select("doc_id", "text_key").distinct()
    return _of_rows(docs, bad, "left_anti").select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the bytes they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(bpe.decode(bpe.encode(docs, path), path))


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring),
    ("decontaminate", decontaminated),
    ("byte_bpe", tokens),
]

#: SQL cannot express the language model's and the tokenizer's stage; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written to the shared folder and read again."""
    folder = shared_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
