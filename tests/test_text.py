"""Word counting, keys, the split, and the language model."""

import hashlib
from collections import Counter

from conftest import SMALL
from pyspark.sql import functions as F

from stayscope.functions.keys import doc_key, iso_date, nan_to_null
from stayscope.functions.text import is_blank, letters, term_counts, words
from stayscope.operators.features import split_at_random, split_by_hash
from stayscope.operators.language import (
    LanguageModel, add_language, default_language_model, fit_language_model,
)

TEXTS = [
    "The room, the ROOM and the view!", "", "   ", "éàü Éàü 123 123 x", "one", "a-b-a-b-a", None,
    "... !!! ...", "日本 日本 語",
]


def test_term_counts_equal_a_plain_count(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, text string")
    rows = df.select("id", words(F.col("text")).alias("w"), term_counts(words(F.col("text"))).alias("c"))
    for row in rows.collect():
        assert {e.term: e.tf for e in row.c or []} == dict(Counter(row.w or []))


def test_term_counts_over_whole_test_texts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", words(F.col("text")).alias("w"))
    counted = docs.select("doc_id", F.inline(term_counts(F.col("w"))))
    exploded = docs.select("doc_id", F.explode("w").alias("term")).groupBy("doc_id", "term").count()
    assert counted.exceptAll(exploded.withColumn("tf", F.col("count").cast("int")).drop("count")).isEmpty()
    assert counted.count() == exploded.count()


def test_blank_and_letters(spark):
    df = spark.createDataFrame([("  \n\t",), ("",), (None,), ("12 !",), ("Ab1c",)], "t string")
    rows = df.select(is_blank(F.col("t")).alias("b"), letters(F.col("t")).alias("l")).collect()
    assert [r.b for r in rows] == [True, True, True, False, False]
    assert [r.l for r in rows] == [" ", " ", " ", " ", " ab c "]


def test_keys_dates_and_nan(spark):
    df = spark.createDataFrame(
        [("H", "2001-08-01 10:20:30", "text", 1.0), ("H", None, None, float("nan"))],
        "h string, d string, t string, x double",
    ).withColumn("d", iso_date(F.col("d")))
    rows = df.select("d", doc_key("h", "d", "t").alias("k"), nan_to_null(F.col("x")).alias("x")).collect()
    assert rows[0].d == "2001-08-01T10:20:30" and rows[1].d is None
    assert rows[0].k == hashlib.md5(b"H|2001-08-01T10:20:30|text").hexdigest()
    assert rows[1].k == hashlib.md5(b"H|None|None").hexdigest()
    assert rows[0].x == 1.0 and rows[1].x is None


def test_split_is_the_same_in_any_layout(spark):
    df = spark.range(1000).withColumn("text", F.concat(F.lit("t"), "id"))
    train, test = split_by_hash(df)
    again, _ = split_by_hash(df.repartition(7))
    first = {r.id for r in train.collect()}
    assert first == {r.id for r in again.collect()}
    assert 750 < len(first) < 850 and len(first) + test.count() == 1000


def test_language_of_empty_and_symbol_texts(spark, seed_model):
    df = spark.createDataFrame([("",), (None,), ("123 !!",), ("The staff was nice and the room clean",)], "t string")
    told = [r.lang for r in add_language(df, seed_model, "t").collect()]
    assert told == ["unknown", "unknown", "unknown", "en"]


def test_seed_model_tells_its_languages_apart(spark, seed_model):
    rows = [
        ("en", "We loved the rooftop bar but the towels were thin and old"),
        ("de", "Wir mochten die Bar auf dem Dach, aber die Handtücher waren alt und dünn"),
        ("fr", "Nous avons aimé le bar sur le toit mais les serviettes étaient vieilles"),
        ("es", "Nos gustó el bar de la azotea pero las toallas eran viejas y finas"),
        ("it", "Ci è piaciuto il bar sul tetto ma gli asciugamani erano vecchi e sottili"),
        ("pt", "Gostamos do bar no terraço mas as toalhas eram velhas e finas"),
        ("nl", "We vonden de bar op het dak leuk maar de handdoeken waren oud en dun"),
    ]
    df = spark.createDataFrame(rows, "lang string, t string")
    told = add_language(df, seed_model, "t", "told").collect()
    assert [r.told for r in told] == [r.lang for r in told]


def test_trained_model_on_held_out_documents_and_after_loading(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    train, test = split_by_hash(docs, ["doc_id"])
    model = fit_language_model(train, "text", "lang")
    model.save(str(tmp_path / "model"))
    loaded = LanguageModel.load(spark, str(tmp_path / "model"))
    told = add_language(test, loaded, "text", "told")
    right = told.agg(F.avg((F.col("told") == F.col("lang")).cast("int"))).first()[0]
    assert right >= 0.95
    first = add_language(test, model, "text", "told")
    assert first.exceptAll(told).isEmpty()


def test_seed_model_is_the_same_each_time(spark, seed_model):
    again = default_language_model(spark)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("text")
    one = add_language(docs, seed_model, "text")
    assert one.exceptAll(add_language(docs, again, "text")).isEmpty()


def test_a_language_never_learned_is_refused(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    train, test = split_by_hash(docs, ["doc_id"])
    for left_out in ("es", "de"):
        model = fit_language_model(train.filter(F.col("lang") != left_out), "text", "lang", refuse=0.005)
        told = add_language(test, model, "text", "told")
        share = F.avg((F.col("told") == "unknown").cast("int"))
        assert told.filter(F.col("lang") == left_out).agg(share).first()[0] >= 0.95
        assert told.filter(F.col("lang") != left_out).agg(share).first()[0] <= 0.03
        right = told.filter((F.col("lang") != left_out) & (F.col("told") != "unknown"))
        assert right.agg(F.avg((F.col("told") == F.col("lang")).cast("int"))).first()[0] >= 0.95
    model.save(str(tmp_path / "model"))
    loaded = LanguageModel.load(spark, str(tmp_path / "model"))
    assert loaded.bounds == model.bounds and set(model.bounds) == {"en", "es", "fr"}
    assert told.exceptAll(add_language(test, loaded, "text", "told")).isEmpty()


def test_bounds_with_one_text_and_with_odd_texts(spark):
    few = spark.createDataFrame(
        [("en", "only one text of this language"), ("de", "ein Text"), ("de", "noch ein anderer Text hier"), (None, "x")],
        "lang string, text string")
    model = fit_language_model(few, "text", "lang", refuse=0.01)
    assert "en" not in model.bounds  # its one text leaves no other to be scored by
    odd = spark.createDataFrame([(None,), ("",), ("12 !",), ("a",), ("word " * 20000,)], "text string")
    told = [r.lang for r in add_language(odd, model, "text").collect()]
    assert told[:3] == ["unknown"] * 3 and len(told) == 5


def test_a_random_split_parts_all_rows_and_repeats_itself(spark):
    df = spark.range(2000, numPartitions=3)
    train, test = split_at_random(df, 70, seed=5)
    sides = [{r.id for r in side.collect()} for side in (train, test)]
    assert not sides[0] & sides[1] and sides[0] | sides[1] == set(range(2000))
    assert 1300 < len(sides[0]) < 1500
    assert {r.id for r in split_at_random(df, 70, seed=5)[0].collect()} == sides[0]
    assert {r.id for r in split_at_random(df, 70, seed=6)[0].collect()} != sides[0]


def test_trigrams_have_the_slots_of_the_stored_stages(spark):
    """Counted in arrays, a trigram falls where the model's own stages put it, whatever its letters' bytes."""
    from stayscope.operators import language

    texts = [" clean room ", " größe naïve ", " \u6e05\u6d01 \U00020000\U00020001 ", " ", " a ", " ab ab ab "]
    rows = spark.createDataFrame([(i, list(t)) for i, t in enumerate(texts)], "i int, _characters array<string>")
    for stage in language._word_stages(1 << 18):
        rows = stage.transform(rows)
    wanted = {r.i: {int(s): n for s, n in zip(r._counts.indices, r._counts.values)} for r in rows.collect()}
    of, slot = language._cut(texts, 1 << 18)
    found = {i: {} for i in range(len(texts))}
    for i, s in zip(of.tolist(), slot.tolist()):
        found[i][s] = found[i].get(s, 0) + 1
    assert found == wanted
