import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stayscope.llm import kneser_ney
from stayscope.llm.queries import op10_kneser_ney
from tests.llm.test_kneser_ney import SCHEMA, brute, ngrams, table

FOLDER = "/root/testdata/sf0.1"


@pytest.mark.parametrize("table_bytes", [1 << 20, 900, 0])
def test_thresholds_are_of_held_out_scores(spark, table_bytes):
    rows, trusted = table(), set(range(0, 50))
    docs = spark.createDataFrame(rows, SCHEMA)
    folds = {r.doc_id: r.fold for r in docs.select("doc_id", F.expr("pmod(xxhash64(text), 3)").alias("fold")).collect()}
    ids = spark.createDataFrame([(i,) for i in trusted], "id bigint")
    out = kneser_ney.judge(docs.repartition(3), ids, quantile=0.9, table_bytes=table_bytes, folds=3)
    held = {}
    for f in range(3):
        for r, x in zip(rows, brute(rows, {i for i in trusted if folds[i] != f})):
            if r[0] in trusted and folds[r[0]] == f:
                held[r[0]] = r[2], *x
    cuts = {}
    for lang in ("aa", "bb"):
        own = [(t, n) for g, t, n in held.values() if g == lang]
        mean = sum(t for t, _ in own) / sum(n for _, n in own)
        # rows[3] stands twice in the table.
        scores = sorted([math.exp(-(t + 50 * mean) / (n + 50)) for t, n in own])
        cuts[lang] = scores, mean
    for r in out.collect():
        if r.lang not in cuts:
            assert r.threshold is None and r.keep == (r.score is not None)
        else:
            # Copies of a row count once more: the threshold is one of the scores near the quantile.
            scores = cuts[r.lang][0]
            assert min(abs(r.threshold / s - 1) for s in scores[int(0.9 * len(scores)) - 2:]) < 2e-2


def test_worst_word(spark):
    rows, trusted = table(), set(range(0, 50))
    ids = spark.createDataFrame([(i,) for i in trusted], "id bigint")
    docs = spark.createDataFrame(rows, SCHEMA)
    outs = [kneser_ney.judge(docs.repartition(3), ids, 0.9, table_bytes=size, folds=3, word_quantile=0.9).collect()
            for size in (1 << 20, 900, 0)]
    want = defaultdict(list)
    for out in outs:
        for r in out:
            want[r.doc_id, r.text_key, r.lang].append((r.word_score or 0, r.word_threshold or 0))
            limited = r.word_threshold is None or (r.word_score or 0) <= r.word_threshold
            assert r.keep == (r.score is not None and (r.threshold is None or r.score <= r.threshold) and limited)
    for found in want.values():
        assert all(math.isclose(x, y, rel_tol=1e-4) for one in found for x, y in zip(one, found[0]))
    # A single word: its n-grams are those of the text, the end included.
    word = next(r for r in outs[0] if r.doc_id == 204)
    total, n = brute(rows, trusted)[[r[0] for r in rows].index(204)]
    assert n == len(ngrams("z")) and math.isclose(word.word_score, math.exp(-total / (n + 2)), rel_tol=1e-4)


def test_one_fold_is_refused(spark):
    with pytest.raises(ValueError, match="one fold"):
        kneser_ney.judge(spark.createDataFrame(table(), SCHEMA), spark.createDataFrame([(1,)], "id bigint"), folds=1)


def test_trusted_documents_left_out_are_kept(spark):
    """A fifth of the trusted documents is neither counted nor seen by the threshold."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    trusted = spark.read.parquet(f"{FOLDER}/labels.parquet").filter("quality = 1 and toxic = 0").select("doc_id")
    out_ids = trusted.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    found = kneser_ney.judge(docs, trusted.join(out_ids, "doc_id", "left_anti"), 0.995, folds=4).join(out_ids, "doc_id")
    assert found.agg(F.avg(F.col("keep").cast("int"))).first()[0] >= 0.985


def test_toxic_documents_in_fluent_text(spark):
    judged = op10_kneser_ney(spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id")
    share = {(r.lang == "en", r.quality, r.toxic): r.kept for r in judged.groupBy(
        F.expr("if(lang = 'en', lang, '')").alias("lang"), "quality", "toxic").agg(F.avg(F.col("keep").cast("int")).alias("kept")).collect()}
    # The toxic documents of the other languages hold no insult, only more of certain word stems.
    assert share[True, 1, 1] < 0.02 and share[True, 1, 0] > 0.99 and share[False, 1, 0] > 0.99
    assert share[True, 0, 0] < 0.1
