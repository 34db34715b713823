"""The jobs behind the command line, from raw files to saved results."""

from argparse import Namespace

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from checks import views
from stayscope import __main__ as jobs
from stayscope.session import shared_folder
from stayscope.sources.files import write_csv


@pytest.fixture(scope="module")
def base(spark):
    folder = shared_folder(spark)
    raw = views.raw_reviews(spark, SMALL).drop("doc_id", "lang")
    write_csv(raw, f"{folder}/reviews")
    write_csv(views.catalog(spark, SMALL), f"{folder}/states")
    views.questions(spark, SMALL).write.json(f"{folder}/questions")
    return folder


def test_jobs_in_order(spark, base, capsys):
    jobs.language(spark, Namespace(
        texts=f"{SMALL}/documents.parquet", text_col="text", lang_col="lang", model=f"{base}/language",
        refuse=None,
    ))
    jobs.etl(spark, Namespace(
        reviews=f"{base}/reviews", states=f"{base}/states", clean=f"{base}/clean", vectors=None,
        language_model=f"{base}/language",
    ))
    jobs.vectors(spark, Namespace(clean=f"{base}/clean", vectors=f"{base}/vectors"))
    jobs.documents(spark, Namespace(
        vectors=f"{base}/vectors", documents=f"{base}/documents", jdbc_options=None, reviews=None, states=None
    ))
    jobs.index(spark, Namespace(documents=f"{base}/documents", index=f"{base}/index"))
    jobs.search(spark, Namespace(
        documents=f"{base}/documents", index=f"{base}/index", questions=f"{base}/questions", hits=f"{base}/hits", k=3
    ))
    jobs.charts(spark, Namespace(clean=f"{base}/clean", charts=f"{base}/charts", low="1990-01-01", high="2010-01-01"))
    clean = spark.read.parquet(f"{base}/clean")
    expected = views.raw_reviews(spark, SMALL).filter("lang = 'en'").join(
        views.catalog(spark, SMALL), F.col("province") == F.col("`State Code`")
    )
    assert abs(clean.count() - expected.count()) <= 0.05 * expected.count()
    hits = spark.read.parquet(f"{base}/hits/vector_hits")
    assert hits.groupBy("query_id").count().filter("count > 3").isEmpty()
    out = capsys.readouterr().out
    assert '"clean"' in out and "vector_hits" in out and "top_cities" in out
