"""Vectors, keyword search and vector search, each against a plain computation."""

import math
import os
import random
import re

import numpy as np
import pytest
from conftest import SMALL, plan_of
from pyspark.sql import functions as F

from stayscope.functions.text import words
from stayscope.operators import keyword_search
from stayscope.operators.embedding import add_vectors, encoder_of, generate_vectors
from stayscope.operators.keyword_search import (
    KeywordIndex, bm25_topk, build_keyword_index, compare_hits, hydrate, write_keyword_index,
)
from stayscope.operators.lookup import lookup_join
from stayscope.operators.vector_search import knn_topk, lsh_candidates, recall
from stayscope.plans.search import answer_questions, encode_questions
from stayscope.session import shared_folder

DOCS = [
    (1, "clean room and clean bath"), (2, "dirty room"), (3, "the pool the bar the view"),
    (4, "clean room and clean bath"), (5, ""), (6, "!!"), (7, "a long walk to the clean beach and the bar"),
]
ASKED = [(1, "clean clean room"), (2, "the bar"), (3, "   "), (4, "nothing here matches"), (5, "CLEAN Bath?")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id bigint, text string").repartition(3)


@pytest.fixture(scope="module")
def asked(spark):
    return spark.createDataFrame(ASKED, "query_id bigint, text string")


def plain_bm25(docs, asked, k, k1=1.2, b=0.75):
    import re

    def cut(text):
        return [w for w in re.split(r"[\W_]+", text.lower()) if w]

    held = {i: cut(t) for i, t in docs if cut(t)}
    mean = sum(map(len, held.values())) / len(held)
    hits = {}
    for q, text in asked:
        scores = []
        for i, ws in held.items():
            score, found = 0.0, False
            for w in cut(text):
                df = sum(w in other for other in held.values())
                tf = ws.count(w)
                if tf:
                    found = True
                    idf = math.log(1 + (len(held) - df + 0.5) / (df + 0.5))
                    score += idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(ws) / mean))
            if found:
                scores.append((round(score, 6), i))
        for rank, (score, i) in enumerate(sorted(scores, key=lambda s: (-s[0], s[1]))[:k], 1):
            hits[q, i] = (score, rank)
    return hits


def as_dict(hits):
    return {(r.query_id, r.doc_id): (r.score, r["rank"]) for r in hits.collect()}


@pytest.mark.parametrize("k", [1, 2, 5])
def test_bm25_equals_a_plain_computation(docs, asked, k):
    found = as_dict(bm25_topk(build_keyword_index(docs, "doc_id", "text"), asked, k))
    wanted = plain_bm25(DOCS, ASKED, k)
    assert found.keys() == wanted.keys()
    assert all(found[key] == pytest.approx(wanted[key], abs=2e-6) for key in wanted)


def test_copies_tie_by_document(docs, asked):
    found = as_dict(bm25_topk(build_keyword_index(docs, "doc_id", "text"), asked, 2))
    assert found[1, 1][0] == found[1, 4][0] and (found[1, 1][1], found[1, 4][1]) == (1, 2)


def test_very_many_asked_terms_are_not_named_and_agree(docs, asked, monkeypatch):
    index = build_keyword_index(docs, "doc_id", "text")
    named = as_dict(bm25_topk(index, asked))
    monkeypatch.setattr(keyword_search, "NAMED_TERMS", 2)
    assert as_dict(bm25_topk(index, asked)) == named


def test_written_index_is_asked_by_term(spark, docs, asked):
    folder = shared_folder(spark)
    index = write_keyword_index(docs, "doc_id", "text", folder)
    hits = bm25_topk(index, asked)
    assert as_dict(hits) == as_dict(bm25_topk(build_keyword_index(docs, "doc_id", "text"), asked))
    scans = [part for part in plan_of(hits).split("FileScan parquet")[1:] if part.startswith(" [doc_id") and "term" in part]
    assert scans and all("PushedFilters: [" in part and "term" in part.split("PushedFilters: ")[1].split("]")[0] for part in scans)

    again = KeywordIndex.read(spark, folder)
    assert as_dict(bm25_topk(again, asked)) == as_dict(hits)
    assert again.doc_stats.count() == 5
    assert {r.term: r.df for r in again.term_stats.collect()}["clean"] == 3


def test_near_equal_scores_are_ranked_by_the_full_score(spark):
    scores = [(1, 5, 0.5000000000), (1, 4, 0.5000000004), (1, 3, 0.4999999996), (1, 9, 0.5000000004)]
    rows = spark.createDataFrame(scores, "query_id bigint, doc_id bigint, score double")
    found = {r["rank"]: r.doc_id for r in keyword_search.top_k(rows, 4).collect()}
    assert found == {1: 4, 2: 9, 3: 5, 4: 3}


@pytest.mark.parametrize("k", [1, 1000, 1001, 2500])
def test_the_best_are_cut_in_lots_first_for_every_k(spark, k):
    rows = spark.range(6000).select((F.col("id") % 2).alias("query_id"), F.col("id").alias("doc_id"), (F.col("id") % 97).cast("double").alias("score"))
    best = keyword_search.top_k(rows, k)
    plan = plan_of(best)
    assert plan.count("Window [") == 2 and "_lot" in plan
    found = [r.doc_id for r in best.filter("query_id = 1").orderBy("rank").collect()]
    assert found == sorted(range(1, 6000, 2), key=lambda i: (-(i % 97), i))[:k]


def test_lookup_join_both_ways_with_a_hot_key(spark):
    facts = spark.range(900).withColumn("key", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")))
    lookup = spark.createDataFrame([(1, "hot"), (5, "five"), (1000, "none")], "key bigint, name string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for how in ("inner", "left", "left_semi"):
        small = sorted(map(str, lookup_join(facts, lookup, ["key"], how).collect()))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            assert sorted(map(str, lookup_join(facts, lookup, ["key"], how).collect())) == small
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    with pytest.raises(ValueError):
        lookup_join(facts, lookup, ["key"], "full")


def test_hashed_vectors_have_length_one_and_384_numbers(spark):
    df = spark.createDataFrame([("a", "great clean room"), ("b", None), ("c", "?!")], "h string, review_full_text string")
    rows = {r.h: r.embedding for r in add_vectors(df).collect()}
    assert all(v is not None and len(v) == 384 for v in rows.values())
    assert np.linalg.norm(rows["a"]) == pytest.approx(1, abs=1e-6)
    assert not any(rows["b"]) and not any(rows["c"])


def test_vector_depends_on_its_row_alone(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    one = add_vectors(docs, "text").drop("text")
    other = add_vectors(docs.repartition(5, "doc_id"), "text").drop("text")
    assert one.exceptAll(other).isEmpty()


def length_encoder():
    def load():
        def encode(texts):
            assert len(texts) <= 64
            return np.array([[len(t), 1.0, 0.0] for t in texts])

        return encode

    return load


def test_batch_encoder(spark, tmp_path):
    df = spark.createDataFrame([("abc",), (None,)] * 100, "review_full_text string")
    rows = add_vectors(df, encoder=length_encoder(), dims=3).collect()
    assert len(rows) == 200
    assert rows[0].embedding == pytest.approx([3 / math.sqrt(10), 1 / math.sqrt(10), 0])
    assert rows[1].embedding == pytest.approx([0, 1, 0])
    df.write.parquet(str(tmp_path / "in"))
    assert generate_vectors(spark, str(tmp_path / "in"), str(tmp_path / "out"), length_encoder(), 3) == 200
    with pytest.raises(Exception, match="the encoder gave shape"):
        add_vectors(df, encoder=length_encoder(), dims=4).collect()


def test_encoder_is_loaded_once_per_worker(spark, tmp_path):
    places = str(tmp_path)

    def load():
        import os
        import uuid
        open(os.path.join(places, f"{os.getpid()}-{uuid.uuid4().hex}"), "w").close()
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    rows = spark.range(400).select(F.col("id").cast("string").alias("review_full_text")).repartition(24)
    made = add_vectors(rows, encoder=load, dims=2)
    assert made.filter("size(embedding) = 2").count() == made.filter("embedding[0] > 0").count() == 400
    workers = [name.split("-")[0] for name in os.listdir(places)]
    assert len(workers) == len(set(workers))


def plain_knn(rows, asked, k):
    hits = {}
    for q, v in asked:
        v = np.array(v)
        if not v.any():
            continue
        scores = [
            (round(float(np.dot(v, r) / np.linalg.norm(v) / np.linalg.norm(r)), 6), i)
            for i, r in rows if r is not None and np.any(r)
        ]
        for rank, (score, i) in enumerate(sorted(scores, key=lambda s: (-s[0], s[1]))[:k], 1):
            hits[q, i] = (score, rank)
    return hits


@pytest.fixture(scope="module")
def space(spark):
    rng = random.Random(3)
    vector = lambda: [rng.gauss(0, 1) for _ in range(8)]
    copied = vector()
    rows = [(i, copied if i % 3 == 0 else vector()) for i in range(300)]
    rows += [(300, None), (301, [0.0] * 8)]
    asked = [(1, copied), (2, vector()), (3, [0.0] * 8), (4, vector()), (5, vector())]
    schema = "doc_id bigint, embedding array<double>"
    return (
        rows, asked,
        spark.createDataFrame(rows, schema).repartition(5),
        spark.createDataFrame(asked, schema.replace("doc_id", "query_id")),
    )


@pytest.mark.parametrize("block, shard", [(1024, 16384), (2, 37)])
def test_knn_equals_a_plain_computation(space, block, shard):
    rows, asked, vectors, questions = space
    found = as_dict(knn_topk(vectors, questions, 5, block=block, shard=shard))
    wanted = plain_knn(rows, asked, 5)
    assert found.keys() == wanted.keys()
    assert all(found[key] == pytest.approx(wanted[key], abs=2e-6) for key in wanted)
    assert [i for q, i in found if q == 1] and {i for q, i in found if q == 1} == {0, 3, 6, 9, 12}


def test_knn_with_string_ids_and_fewer_rows_than_k(spark):
    vectors = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [2.0, 0.0])], "doc_id string, embedding array<float>")
    questions = spark.createDataFrame([("q", [1.0, 1.0])], "query_id string, embedding array<float>")
    rows = knn_topk(vectors, questions, 5).collect()
    assert [(r.query_id, r.doc_id, r["rank"]) for r in sorted(rows, key=lambda r: r["rank"])] == [("q", "a", 1), ("q", "b", 2)]


def test_knn_without_questions_and_with_other_dimensions(spark, space):
    _, _, vectors, questions = space
    assert knn_topk(vectors, questions.limit(0), 5).count() == 0
    other = spark.createDataFrame([(1, [1.0, 2.0])], "query_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="different length"):
        knn_topk(vectors, other, 5).collect()


def test_rows_are_read_once_whatever_the_number_of_blocks(space):
    _, _, vectors, questions = space
    plan = plan_of(knn_topk(vectors, questions, 5, block=1, shard=37))
    assert plan.count("FlatMapCoGroupsInArrow") == 1


def test_lsh_scores_no_more_than_the_candidates(space):
    _, _, vectors, questions = space
    offered = lsh_candidates(vectors, questions, 40)
    assert offered.groupBy("query_id").count().filter("count > 40").isEmpty()
    exact = {(q, i): score for (q, i), (score, _) in as_dict(knn_topk(vectors, questions, 300)).items()}
    found = as_dict(knn_topk(vectors, questions, 5, candidates=40))
    scored = {(r.query_id, r.doc_id) for r in offered.collect()}
    for q in (1, 2, 4, 5):
        best = sorted((-exact[q, i], i) for p, i in scored if p == q)[:5]
        assert [i for _, i in best] == [i for (p, i), (_, rank) in sorted(found.items(), key=lambda x: x[1][1]) if p == q]


def test_lsh_of_far_apart_hashes_gives_fewer(spark):
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [-1.0, 0.0])], "doc_id bigint, embedding array<double>")
    questions = spark.createDataFrame([(1, [2.0, 0.0])], "query_id bigint, embedding array<double>")
    assert [r.doc_id for r in knn_topk(vectors, questions, 2, candidates=10).collect()] == [1]
    assert knn_topk(vectors, questions.limit(0), 2, candidates=10).count() == 0


def test_lsh_recall_and_share_of_pairs_on_the_test_vectors(spark):
    """The vectors are nearly unrelated to each other, the hardest case: a fifth of the pairs is scored."""
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select(F.col("vec_id").alias("doc_id"), "embedding")
    questions = rows.withColumnRenamed("doc_id", "query_id")
    n = rows.count()
    offered = lsh_candidates(rows, questions, n // 5)
    assert offered.count() <= 0.2 * n * n
    exact = knn_topk(rows, questions, 5)
    assert recall(knn_topk(rows, questions, 5, candidates=n // 5), exact).first().recall >= 0.6


def test_lsh_finds_close_neighbours(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 32))
    near = [(40 * k + c, (centres[c] + 0.2 * rng.normal(size=32)).tolist()) for k in range(5) for c in range(40)]
    vectors = spark.createDataFrame(near, "doc_id bigint, embedding array<double>")
    questions = spark.createDataFrame([(c, centres[c].tolist()) for c in range(40)], "query_id bigint, embedding array<double>")
    exact = knn_topk(vectors, questions, 5)
    assert recall(knn_topk(vectors, questions, 5, candidates=20), exact).first().recall >= 0.99


def test_hydrate_and_compare(docs, asked):
    hits = bm25_topk(build_keyword_index(docs, "doc_id", "text"), asked, 2)
    shown = hydrate(hits, docs.withColumn("stars", F.lit(3.0)), "doc_id", ["text", "stars"])
    assert shown.columns == ["query_id", "doc_id", "score", "rank", "text", "stars"]
    assert shown.count() == hits.count()
    both = compare_hits(hits, hits.filter("rank = 1"), 2).collect()
    assert all(r.overlap == 0.5 for r in both)
    assert {r.vector_rank for r in both} == {1, None}


def test_questions_need_the_dimensions_of_the_rows(docs, asked):
    index = build_keyword_index(docs, "doc_id", "text")
    vectors = add_vectors(docs, "text", dims=16)
    with pytest.raises(ValueError, match="16 dimensions"):
        answer_questions(index, vectors, asked)
    words_hits, vector_hits, both = answer_questions(index, vectors, asked, k=2, dims=16)
    assert both.count() >= max(words_hits.count(), vector_hits.count())
    assert encode_questions(asked).count() == 4


def test_questions_need_the_encoder_of_the_rows(spark, docs, asked, tmp_path):
    index = build_keyword_index(docs, "doc_id", "text")
    add_vectors(docs, "text", encoder=length_encoder(), dims=384 // 128, encoder_name="lengths").write.parquet(str(tmp_path / "v"))
    vectors = spark.read.parquet(str(tmp_path / "v"))
    assert encoder_of(vectors) == "lengths" and encoder_of(add_vectors(docs, "text")) == "hashed words"
    with pytest.raises(ValueError, match="encoded by 'lengths'"):
        answer_questions(index, vectors, asked, dims=3)
    with pytest.raises(ValueError, match="'widths'"):
        answer_questions(index, vectors, asked, encoder=length_encoder(), dims=3, encoder_name="widths")
    found = answer_questions(index, vectors, asked, encoder=length_encoder(), dims=3, encoder_name="lengths")[1]
    assert found.count() > 0
    unnamed = spark.createDataFrame([(1, [0.5] * 384)], "doc_id bigint, embedding array<float>")
    with pytest.raises(ValueError, match="encoded by None"):
        answer_questions(index, unnamed, asked)


def test_words_agree_between_index_and_questions(docs):
    assert docs.select(F.explode(words(F.col("text")))).distinct().count() > 5


def test_a_posting_travels_once_however_many_questions_ask_it(spark, docs):
    """The postings are dealt by document without a question's id; the join with questions used to multiply them."""
    many = spark.createDataFrame([(q, "clean room bar the") for q in range(300)], "query_id bigint, text string")
    hits = bm25_topk(build_keyword_index(docs, "doc_id", "text"), many, 2)
    plan = plan_of(hits)
    assert re.search(r"hashpartitioning\(doc_id#", plan)
    assert not re.search(r"hashpartitioning\(query_id#\d+L?, doc_id#", plan)
    found = as_dict(hits)
    assert len(found) == 600 and len({found[q, doc] for q, doc in found if doc == 1}) <= 1
