import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayscope.llm import language_zstd
from stayscope.llm.queries import op5_language_zstd

SCHEMA = "doc_id bigint, text string, lang string, score string"


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    found = op5_language_zstd(spark, folder)
    assert found.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    told = found.join(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id")
    assert told.count() == 10000
    by = {r.held_out: r for r in told.groupBy("held_out").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.min("score").alias("low"),
        F.max("score").alias("high"), F.count("*").alias("n"),
    ).collect()}
    assert by[True].right > 0.99 and by[True].n > 2400
    assert 0 <= by[True].low and by[True].high <= 1


def test_edges(spark):
    rows = [(i, t * 20, lang, "x") for i, (t, lang) in enumerate([
        ("the river ran over the stones ", "en"), ("der fluss rann über die steine ", "de"), ("ohne sprache ", None)])]
    rows += [(7, None, "en", None), (8, "12 -- !!", "de", None), (9, "", "fr", None), (None, "the stones ran over", "en", None)]
    rows += [(10, "über die steine " * 20000, None, None), (11, "the stones", None, None), (11, "the stones", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    made = language_zstd.fit_dictionaries(docs)
    assert sorted(made) == ["de", "en"]
    assert max(map(len, made.values())) <= language_zstd.DICTIONARY_BYTES
    out = {(r.doc_id, r.lang_pred) for r in language_zstd.identify(docs, made).collect()}
    assert {(7, "und"), (8, "und"), (9, "und"), (None, "en"), (10, "de"), (11, "en"), (0, "en"), (1, "de")} <= out
    assert language_zstd.identify(docs, made).count() == len(rows)


@pytest.mark.parametrize("text", ["½", "② ⅓", "Ⅷ ⁵", "_ 12 ३", "\u0301", "é½"])
def test_number_signs_are_no_letters(spark, text):
    docs = spark.createDataFrame([(1, text, None, None)], SCHEMA)
    made = {"en": b"the river ran over the stones", "de": b"der fluss rann"}
    got = language_zstd.identify(docs, made).first().lang_pred
    assert (got == "und") == (not any(c.isalpha() for c in text))


def test_every_answer_against_a_plain_loop(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    made = language_zstd.fit_dictionaries(docs)
    coders = language_zstd._coders(made)
    rows = docs.select("doc_id", "text").collect()
    want = {}
    for row in rows:
        words = "".join(c if c.isalpha() else " " for c in (row.text or "").lower()).split()
        code = " ".join(words).encode()
        sizes = [sum(len(coder.compress(code[i:i + 4096])) for i in range(0, len(code), 4096)) for coder in coders]
        want[row.doc_id] = list(made)[int(np.argmin(sizes))] if re.search("[a-z]", " ".join(words)) else "und"
    assert {r.doc_id: r.lang_pred for r in language_zstd.identify(docs, made).collect()} == want


def test_narrow_margin_is_rejected(spark):
    docs = spark.createDataFrame([(1, "qqqq zzzz", None, None), (2, "the river ran over", None, None)], SCHEMA)
    made = {"aa": b"the river ran over the stones", "bb": b"der fluss rann"}
    out = {r.doc_id: r.lang_pred for r in language_zstd.identify(docs, made, min_margin=0.1).collect()}
    assert out == {1: "und", 2: "aa"}


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "words", None, None)], SCHEMA)
    assert language_zstd.fit_dictionaries(docs) == {}
    assert [r.lang_pred for r in language_zstd.identify(docs, {}).collect()] == ["und"]
    assert language_zstd.identify(docs.limit(0), {"en": b"a"}).count() == 0
