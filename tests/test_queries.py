"""Every registered query against its SQL twin, and the whole cleaning job."""

import pytest
from conftest import SMALL
from pyspark.ml.feature import StopWordsRemover

import __spark_entry__
from checks.compare import differences, oracle_connection
from checks.oracles import ORACLES, STOP_WORDS
from checks.queries import QUERIES
from stayscope.plans.etl import run_etl
from stayscope.plans.search import index_documents, search_documents
from stayscope.plans.materialise import materialise
from stayscope.sources.contracts import CLEAN_REVIEWS, VECTOR_REVIEWS, check_contract
from stayscope.session import shared_folder
from checks import views
from stayscope.sources.files import write_csv

@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, oracle, name):
    assert differences(spark, oracle, SMALL, name) == ""


def test_entry_and_registration(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(QUERIES) == set(ORACLES)


def test_stop_words_are_those_of_spark(spark):
    assert sorted(STOP_WORDS) == sorted(StopWordsRemover.loadDefaultStopWords("english"))


def test_files_to_search(spark, seed_model):
    base = shared_folder(spark)
    raw = views.raw_reviews(spark, SMALL).drop("doc_id", "lang")
    rows = write_csv(raw, f"{base}/reviews")
    write_csv(views.catalog(spark, SMALL), f"{base}/states")
    written = run_etl(
        spark, f"{base}/reviews", f"{base}/states", f"{base}/clean", f"{base}/vectors", seed_model
    )
    assert 0 < written["clean"] <= rows and written["vectors"] == written["clean"]
    check_contract(spark.read.parquet(f"{base}/clean"), CLEAN_REVIEWS)
    check_contract(spark.read.parquet(f"{base}/vectors"), VECTOR_REVIEWS)
    sets = materialise(spark, f"{base}/vectors", f"{base}/documents")
    assert sets["vector_documents"] == sets["keyword_documents"] <= written["clean"]
    index_documents(spark, f"{base}/documents", f"{base}/index")
    by_words, by_meaning, both = search_documents(
        spark, f"{base}/documents", f"{base}/index", views.questions(spark, SMALL)
    )
    assert by_words.columns == by_meaning.columns == [
        "query_id", "doc_id", "score", "rank", "hotel_name", "review_full_text", "rating"]
    assert by_words.count() > 0 and by_meaning.count() > 0
    assert both.filter("overlap < 0 or overlap > 1").isEmpty()
