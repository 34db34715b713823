"""The registered queries: each runs over the whole tables of `folder`."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import views
from stayscope.functions.keys import doc_key, iso_date, nan_to_null
from stayscope.functions.text import full_text, sentiment
from stayscope.operators import charts, metrics
from stayscope.operators.category_ranks import add_frequency_index
from stayscope.operators.classifiers import LOGISTIC_REGRESSION, RANDOM_FOREST, train_and_score
from stayscope.operators.cleaning import (
    clean_reviews, enrich, in_rating_range, project_catalog, project_reviews,
)
from stayscope.operators.embedding import add_vectors
from stayscope.operators.features import (
    category_index, category_stages, drop_incomplete, long_vector, split_by_hash, word_stages,
)
from stayscope.operators.keyword_blocks import bm25_topk_skipping, write_block_index
from stayscope.operators.keyword_search import bm25_topk, build_keyword_index, hydrate, write_keyword_index
from stayscope.operators.language import add_language, fit_language_model
from stayscope.operators.upsert import keep_last_by_key
from stayscope.operators.vector_index import knn_cells, write_vector_index
from stayscope.operators.vector_search import knn_topk, recall
from stayscope.plans.board import add_to_board, board, held_board
from stayscope.plans.materialise import materialise
from stayscope.plans.search import answer_questions, index_documents, search_documents
from stayscope.plans.training import SHORT, train
from stayscope.session import shared_folder
from stayscope.sources.contracts import (
    CLEAN_REVIEWS, METRICS, VECTOR_REVIEWS, check_contract, conform, dots_to_underscores, plain_names,
)
from stayscope.sources.files import read_csv, read_report, write_csv, write_report, write_table
from stayscope.sources.held_sets import load, read_set
from stayscope.sources.large_csv import read_large_csv

BOARD_FROM, BOARD_TO = "1981-01-01", "2000-12-31"
EVENTS_FROM, EVENTS_TO = "2024-01-08", "2024-01-15"


def reviews_project(spark: SparkSession, folder: str) -> DataFrame:
    rows = project_reviews(views.raw_reviews(spark, folder))
    return rows.withColumn("review_date", iso_date(F.col("review_date")))


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return clean_reviews(views.raw_reviews(spark, folder), views.catalog(spark, folder), lang_col="lang")


def reviews_clean(spark: SparkSession, folder: str) -> DataFrame:
    return flagship(spark, folder).withColumn("review_date", iso_date(F.col("review_date")))


def rename_sanitised(spark: SparkSession, folder: str) -> DataFrame:
    reviews = dots_to_underscores(views.raw_reviews(spark, folder).drop("lang"))
    states = plain_names(views.catalog(spark, folder)).withColumnRenamed("state_code", "province")
    joined = enrich(reviews, states).withColumn("state_code", F.col("province"))
    return joined.withColumn("reviews_date", iso_date(F.col("reviews_date")))


def drop_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return views.documents(spark, folder).drop("doc_id").dropDuplicates()


def rating_range(spark: SparkSession, folder: str) -> DataFrame:
    rows = project_reviews(views.raw_reviews(spark, folder), ["doc_id"])
    return rows.filter(in_rating_range(low=2, high=4)).select("doc_id", "rating")


def sentiment_label(spark: SparkSession, folder: str) -> DataFrame:
    rows = project_reviews(views.raw_reviews(spark, folder), ["doc_id"])
    return rows.select("doc_id", "rating", sentiment(F.col("rating")).alias("sentiment"))


def review_text(spark: SparkSession, folder: str) -> DataFrame:
    rows = project_reviews(views.raw_reviews(spark, folder), ["doc_id"])
    text = full_text(F.col("review_title"), F.col("review_text"))
    return rows.select("doc_id", text.alias("review_full_text"))


def drop_null_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = project_reviews(views.raw_reviews(spark, folder), ["doc_id"]).join(
        views.table(spark, folder, "labels"), "doc_id", "left"
    )
    return drop_incomplete(rows, ["doc_id", "review_title", "quality"])


def enrich_join(spark: SparkSession, folder: str) -> DataFrame:
    rows = project_reviews(views.raw_reviews(spark, folder), ["doc_id"])
    catalog = project_catalog(views.catalog(spark, folder))
    return enrich(rows, catalog).select("doc_id", "province", "region", "division")


def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.table(spark, folder, "documents").select("doc_id")
    train_rows, test_rows = split_by_hash(rows, ["doc_id"])
    return train_rows.withColumn("side", F.lit("train")).unionAll(
        test_rows.withColumn("side", F.lit("test"))
    )


def nan_to_null_query(spark: SparkSession, folder: str) -> DataFrame:
    value = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return views.table(spark, folder, "events").select("event_id", nan_to_null(value).alias("value"))


def iso_date_query(spark: SparkSession, folder: str) -> DataFrame:
    return views.table(spark, folder, "orders").select(
        "o_orderkey", iso_date(F.col("o_orderdate")).alias("iso_date")
    )


def doc_key_query(spark: SparkSession, folder: str) -> DataFrame:
    rows = reviews_project(spark, folder).withColumn("title", F.col("review_title"))
    return rows.select(
        "username",
        doc_key("hotel_name", "review_date", "review_text").alias("doc_key"),
        doc_key("hotel_name", "title").alias("title_key"),
    )


def keyed_upsert(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.documents(spark, folder).select("doc_id", "lang", "source", doc_key("text").alias("key"))
    return keep_last_by_key(rows, "key", ["doc_id"])


def held_set_loads(spark: SparkSession, folder: str) -> DataFrame:
    """All documents loaded into a held set; then the French ones under another source, and the German ones taken out."""
    held = shared_folder(spark)
    rows = views.documents(spark, folder).select("doc_id", "lang", "source", doc_key("text").alias("key"))
    load(rows, held, "key", ["doc_id"], buckets=64)
    again = rows.filter(F.col("lang").isin("fr", "de")).withColumn("source", F.lit("again"))
    load(again.withColumn("gone", F.col("lang") == "de"), held, "key", ["doc_id"], deleted_col="gone")
    return read_set(spark, held)


def schema_contract(spark: SparkSession, folder: str) -> DataFrame:
    untyped = flagship(spark, folder).select(
        *[F.col(name).cast("string") for name in reversed(CLEAN_REVIEWS.fieldNames())],
        F.lit(1).alias("not_in_contract"),
    )
    typed = conform(add_vectors(untyped), VECTOR_REVIEWS)
    kept = check_contract(typed, VECTOR_REVIEWS).drop("embedding")
    return check_contract(kept, CLEAN_REVIEWS).withColumn("review_date", iso_date(F.col("review_date")))


def parquet_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    target = shared_folder(spark)
    written = write_table(views.table(spark, folder, "orders"), target)
    return spark.read.parquet(target).withColumn(
        "o_orderdate", iso_date(F.col("o_orderdate"))
    ).withColumn("written", F.lit(written).cast("bigint"))


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    target = shared_folder(spark)
    write_csv(views.documents(spark, folder), target)
    back = read_csv(spark, target)
    return back.withColumns({c: F.col(c).cast("bigint") for c in ("doc_id", "n_chars")})


def large_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The same files, read in splits although their fields hold line breaks."""
    target = shared_folder(spark)
    write_csv(views.documents(spark, folder), target)
    back = read_large_csv(spark, target)
    return back.withColumns({c: F.col(c).cast("bigint") for c in ("doc_id", "n_chars")})


def report_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    target = shared_folder(spark)
    write_report(charts.sentiment_by_region(views.rated_orders(spark, folder)), target)
    return read_report(spark, target, "region string, sentiment int, count bigint")


def reviews_clean_detected(spark: SparkSession, folder: str) -> DataFrame:
    """The clean reviews where the language is told by a model of the documents."""
    model = fit_language_model(views.documents(spark, folder), "text", "lang")
    raw = views.raw_reviews(spark, folder).drop("lang", "doc_id")
    rows = clean_reviews(raw, views.catalog(spark, folder), language_model=model)
    return rows.withColumn("review_date", iso_date(F.col("review_date")))


def language_detect(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.documents(spark, folder)
    model = fit_language_model(rows, "text", "lang")
    return add_language(rows.select("doc_id", "text"), model, "text", "detected").drop("text")


def language_refused(spark: SparkSession, folder: str) -> DataFrame:
    """All documents told by a bounded model that has never seen Spanish."""
    rows = views.documents(spark, folder)
    model = fit_language_model(rows.filter("lang <> 'es'"), "text", "lang", refuse=0.005)
    return add_language(rows.select("doc_id", "text"), model, "text", "detected").drop("text")


def _long(df: DataFrame, id_col: str, vector_col: str, value: str) -> DataFrame:
    entries = df.select(id_col, F.posexplode(vector_col).alias("dim", value)).filter(F.col(value) != 0)
    return entries.withColumn(value, F.round(F.col(value).cast("double"), 6))


def embed_hash(spark: SparkSession, folder: str) -> DataFrame:
    rows = add_vectors(views.documents(spark, folder).select("doc_id", "text"), "text")
    return _long(rows, "doc_id", "embedding", "weight")


def letter_encoder():
    """Loader of an encoder that counts the letters a to z: a stand-in for a model."""
    def load():
        def encode(texts: list[str]) -> np.ndarray:
            counts = [np.bincount(np.frombuffer(t.encode(), np.uint8), minlength=123)[97:123] for t in texts]
            return np.array(counts, dtype=np.float64).reshape(len(texts), 26)

        return encode

    return load


def embed_udf(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.documents(spark, folder).select("doc_id", "text")
    return _long(add_vectors(rows, "text", encoder=letter_encoder(), dims=26), "doc_id", "embedding", "weight")


def _index(spark: SparkSession, folder: str):
    return build_keyword_index(views.documents(spark, folder), "doc_id", "text")


def _written_index(spark: SparkSession, folder: str):
    docs = views.table(spark, folder, "documents")
    return write_keyword_index(docs, "doc_id", "text", shared_folder(spark))


def bm25_index(spark: SparkSession, folder: str) -> DataFrame:
    return _index(spark, folder).postings.drop("first")


def bm25_terms(spark: SparkSession, folder: str) -> DataFrame:
    return _index(spark, folder).term_stats


def _shown(hits: DataFrame) -> DataFrame:
    """Hits with the score as it is compared: ranks are those of the full score."""
    return hits.withColumn("score", F.round("score", 6))


def bm25(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(bm25_topk(_written_index(spark, folder), views.questions(spark, folder)))


def bm25_skipping(spark: SparkSession, folder: str) -> DataFrame:
    """The hits of `bm25_topk` from blocks with bounds; blocks that hold no hit are not scored."""
    index = write_block_index(views.table(spark, folder, "documents"), "doc_id", "text", shared_folder(spark))
    return _shown(bm25_topk_skipping(index, views.questions(spark, folder)).hits)


def knn_exact(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(knn_topk(
        views.table(spark, folder, "embeddings"), views.class_centres(spark, folder), id_col="vec_id",
        block=4, shard=200,
    ))


def knn_lsh_query(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(knn_topk(
        views.table(spark, folder, "embeddings"), views.class_centres(spark, folder),
        candidates=100, id_col="vec_id",
    ))


def _every_twentieth(spark: SparkSession, folder: str) -> DataFrame:
    return views.table(spark, folder, "embeddings").filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")


def knn_ivf(spark: SparkSession, folder: str) -> DataFrame:
    """Every twentieth vector asks the inverted file, which goes on to all cells that could hold a better row."""
    index = write_vector_index(views.table(spark, folder, "embeddings"), shared_folder(spark), id_col="vec_id")
    return _shown(knn_cells(index, _every_twentieth(spark, folder), share=0.2, exact=True))


def knn_ivf_recall(spark: SparkSession, folder: str) -> DataFrame:
    """The inverted file at its own settings beside all pairs: how many hits were asked for, and is the recall 0.9?"""
    vectors, asked = views.table(spark, folder, "embeddings"), _every_twentieth(spark, folder)
    index = write_vector_index(vectors, shared_folder(spark), id_col="vec_id")
    exact = knn_topk(vectors, asked, id_col="vec_id")
    found = recall(knn_cells(index, asked), exact)
    return exact.agg(F.countDistinct("query_id").alias("questions"), F.count("*").alias("hits")).withColumn(
        "recall_reached", F.lit(found.first().recall >= 0.9))


def search_hydrate(spark: SparkSession, folder: str) -> DataFrame:
    return hydrate(
        bm25(spark, folder), views.table(spark, folder, "documents"), "doc_id", ["source", "text", "lang"]
    )


def search_compare(spark: SparkSession, folder: str) -> DataFrame:
    index, stored = _written_index(spark, folder), shared_folder(spark)
    write_table(add_vectors(views.documents(spark, folder).select("doc_id", "text"), "text").drop("text"), stored)
    compared = answer_questions(index, spark.read.parquet(stored), views.questions(spark, folder))[2]
    return compared.withColumn("overlap", F.round("overlap", 6))


def search_answers(spark: SparkSession, folder: str) -> DataFrame:
    """The search job over stored documents, vectors and index: keyword hits with their fields."""
    base = shared_folder(spark)
    write_table(conform(add_vectors(flagship(spark, folder)), VECTOR_REVIEWS), f"{base}/vectors")
    materialise(spark, f"{base}/vectors", f"{base}/documents")
    index_documents(spark, f"{base}/documents", f"{base}/index")
    by_words = search_documents(spark, f"{base}/documents", f"{base}/index", views.questions(spark, folder))[0]
    return _shown(by_words)


def tokens_stopwords(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer, stop_words = word_stages("text")[:2]
    rows = stop_words.transform(tokenizer.transform(views.documents(spark, folder)))
    return rows.select("doc_id", F.array_join("filtered_words", "|").alias("tokens"))


def hashed_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.documents(spark, folder)
    for stage in word_stages("text")[:3]:
        rows = stage.transform(rows)
    return long_vector(rows, ["doc_id"], "raw_features", "tf")


def tfidf(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.documents(spark, folder).select("doc_id", "text")
    *plain, idf = word_stages("text")
    for stage in plain:
        rows = stage.transform(rows)
    weighted = idf.fit(rows).transform(rows)
    return long_vector(weighted, ["doc_id"], "tfidf_features", "weight").withColumn(
        "weight", F.round("weight", 6)
    )


def string_index(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.table(spark, folder, "documents").select("doc_id", "source", "lang")
    return category_index(category_index(rows, "source"), "lang")


def frequency_index(spark: SparkSession, folder: str) -> DataFrame:
    """The same indices from distributed ranks, with no label on the driver."""
    rows = views.table(spark, folder, "documents").select("doc_id", "source", "lang")
    return add_frequency_index(add_frequency_index(rows, "source"), "lang")


def one_hot(spark: SparkSession, folder: str) -> DataFrame:
    rows = string_index(spark, folder)
    encoder = category_stages(["source", "lang"])[-1]
    coded = encoder.fit(rows).transform(rows)
    parts = [
        long_vector(coded.withColumn("field", F.lit(name)), ["doc_id", "field"], f"{name}_ohe", "flag")
        for name in ("source", "lang")
    ]
    return parts[0].unionAll(parts[1])


def _predict(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The test rows, and whether prediction and score fit: this checks the rows, not the weights."""
    rows = drop_incomplete(
        views.labelled_documents(spark, folder),
        ["doc_id", "review_full_text", "sentiment", "region", "division"],
    )
    train_rows, test_rows = split_by_hash(rows, ["doc_id"])
    found = train_and_score(train_rows, test_rows, names=(name,), keep=("doc_id",))[name]
    return found.predictions.select(
        "doc_id", "sentiment",
        (F.col("prediction") == (F.col("score") > 0.5).cast("double")).alias("agrees"),
        F.col("score").between(0, 1).alias("in_range"),
    )


def lr_predict(spark: SparkSession, folder: str) -> DataFrame:
    return _predict(spark, folder, LOGISTIC_REGRESSION)


def rf_predict(spark: SparkSession, folder: str) -> DataFrame:
    return _predict(spark, folder, RANDOM_FOREST)


def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """What the training job saved, per model: do metrics, predictions, counts and winner agree?"""
    base = shared_folder(spark)
    write_table(views.labelled_documents(spark, folder), f"{base}/reviews")
    compared = train(spark, f"{base}/reviews", f"{base}/results")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in METRICS)
    saved = read_report(spark, f"{base}/results/metrics_comparison.csv", ddl)
    names, rows = metrics.METRIC_NAMES, None
    for name, short in SHORT.items():
        predictions = spark.read.parquet(f"{base}/results/predictions_{short}.parquet")
        counts = read_report(
            spark, f"{base}/results/confusion_matrix_{short}.csv", "sentiment int, prediction double, count bigint"
        )
        model = F.lit(name).alias("model")
        again = metrics.class_metrics(metrics.confusion(predictions)).select(model, *[F.col(n).alias(f"p_{n}") for n in names])
        counted = metrics.class_metrics(counts).select(model, *[F.col(n).alias(f"c_{n}") for n in names])
        total = counts.agg(F.sum("count").alias("test_rows")).select(model, "test_rows")
        near = [F.abs(F.col(n) - F.col(f"{side}_{n}")) < 1e-9 for n in names for side in ("p", "c")]
        best = compared.agg(F.max("f1").alias("best")).select(model, "best")
        outcome = metrics.of_model(compared, name).join(best, "model").select(
            "model", ((F.col("outcome") != "other") == (F.col("f1") == F.col("best"))).alias("outcome_fits")
        )
        part = (
            metrics.of_model(saved, name).join(again, "model").join(counted, "model").join(total, "model")
            .join(outcome, "model").select("model", "test_rows", F.forall(F.array(*near), lambda x: x).alias("agrees"), "outcome_fits")
        )
        rows = part if rows is None else rows.unionAll(part)
    return rows


def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion(views.ruled_predictions(spark, folder)).orderBy("sentiment", "prediction")


def confusion_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion_square(metrics.confusion(views.ruled_predictions(spark, folder)), [0.0, 1.0])


def class_metrics(spark: SparkSession, folder: str) -> DataFrame:
    found = metrics.class_metrics(metrics.confusion(views.ruled_predictions(spark, folder)))
    return found.select([F.round(name, 6).alias(name) for name in metrics.METRIC_NAMES])


def metrics_unpivot(spark: SparkSession, folder: str) -> DataFrame:
    found = class_metrics(spark, folder).withColumn("model", F.lit("rule"))
    return metrics.melt_metrics(found, metrics.METRIC_NAMES)


def roc_points(spark: SparkSession, folder: str) -> DataFrame:
    rates = {name: F.round(name, 6) for name in ("tpr", "fpr")}
    return metrics.roc(views.scored_events(spark, folder)).withColumns(rates)


def roc_bounded(spark: SparkSession, folder: str) -> DataFrame:
    rates = {name: F.round(name, 6) for name in ("tpr", "fpr")}
    return metrics.roc_bounded(views.scored_events(spark, folder), points=100).withColumns(rates)


def auc(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.auc(views.scored_events(spark, folder)).select(F.round("auc_roc", 6).alias("auc_roc"))


def sentiment_by_region(spark: SparkSession, folder: str) -> DataFrame:
    return charts.sentiment_by_region(views.rated_orders(spark, folder))


def sentiment_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return charts.sentiment_pivot(sentiment_by_region(spark, folder))


def rating_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return charts.rating_histogram(views.rated_orders(spark, folder), 0.5)


def fitting_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """Prices of all line items, in buckets of the least round width that gives at most 50."""
    rows = views.table(spark, folder, "lineitem")
    width = charts.fitting_width(rows, "l_extendedprice", 50)
    return charts.rating_histogram(rows, width, "l_extendedprice")


def fitting_periods(spark: SparkSession, folder: str) -> DataFrame:
    """Events per period of the shortest unit that gives at most 100."""
    rows = views.table(spark, folder, "events")
    counted = charts.reviews_per_period(rows, charts.fitting_unit(rows, "ts", 100), "ts")
    return counted.withColumn("period", F.date_format("period", "yyyy-MM-dd HH:mm:ss"))


def region_topn_other(spark: SparkSession, folder: str) -> DataFrame:
    return charts.region_split(views.rated_orders(spark, folder), 3)


def events_in_window(spark: SparkSession, folder: str) -> DataFrame:
    """Events carry a time of day, so the window's last day shows whether all of it is in."""
    rows = charts.within_dates(views.table(spark, folder, "events"), EVENTS_FROM, EVENTS_TO, "ts")
    return rows.select("event_id", iso_date(F.col("ts")).alias("ts"))


def _per_month(rows: DataFrame) -> DataFrame:
    return rows.withColumn("period", F.date_format("period", "yyyy-MM-dd"))


def reviews_per_month(spark: SparkSession, folder: str) -> DataFrame:
    rows = charts.within_dates(views.rated_orders(spark, folder), BOARD_FROM, BOARD_TO)
    return _per_month(charts.reviews_per_period(rows))


def positive_share(spark: SparkSession, folder: str) -> DataFrame:
    return charts.positive_share(views.rated_orders(spark, folder)).withColumn(
        "percent", F.round("percent", 6)
    )


def top_cities(spark: SparkSession, folder: str) -> DataFrame:
    return charts.top_cities(views.rated_orders(spark, folder))


def board_query(spark: SparkSession, folder: str) -> DataFrame:
    return _bars(board(views.rated_orders(spark, folder), BOARD_FROM, BOARD_TO))


def board_loads(spark: SparkSession, folder: str) -> DataFrame:
    """All orders in two loads, the second one sent twice."""
    held, rows = shared_folder(spark), views.rated_orders(spark, folder)
    second = F.month("review_date") % 2 == 0
    add_to_board(rows.filter(~second), held, "first")
    for _ in range(2):
        add_to_board(rows.filter(second), held, "second")
    return _bars(held_board(spark, held, BOARD_FROM, BOARD_TO))


def _bars(shown: dict[str, DataFrame]) -> DataFrame:
    text = {
        "rating_histogram": ("bucket", "count"),
        "region_topn_other": (F.concat_ws("/", "region", "sentiment"), "count"),
        "reviews_per_month": (F.date_format("period", "yyyy-MM-dd"), "count"),
        "positive_share": ("sentiment", F.round("percent", 6)),
        "top_cities": ("city", "median_rating"),
    }
    rows = None
    for name, (key, value) in text.items():
        part = shown[name].select(
            F.lit(name).alias("chart"),
            (F.col(key) if isinstance(key, str) else key).cast("string").alias("bar"),
            (F.col(value) if isinstance(value, str) else value).cast("double").alias("height"),
        )
        rows = part if rows is None else rows.unionAll(part)
    return rows


def materialised_sets(spark: SparkSession, folder: str) -> DataFrame:
    base = shared_folder(spark)
    vectors = conform(add_vectors(flagship(spark, folder)), VECTOR_REVIEWS)
    write_table(vectors, f"{base}/vectors")
    materialise(spark, f"{base}/vectors", f"{base}/documents")
    stored = spark.read.parquet(f"{base}/documents/keyword_documents")
    return stored.select("doc_id", "hotel_name", "city", "review_date", "rating", "sentiment", "region")


QUERIES = {
    "reviews_project": reviews_project,
    "reviews_clean": reviews_clean,
    "rename_sanitised": rename_sanitised,
    "drop_duplicates": drop_duplicates,
    "rating_range": rating_range,
    "sentiment_label": sentiment_label,
    "full_text": review_text,
    "drop_null_rows": drop_null_rows,
    "enrich_join": enrich_join,
    "hash_split": hash_split,
    "nan_to_null": nan_to_null_query,
    "iso_date": iso_date_query,
    "doc_key": doc_key_query,
    "keyed_upsert": keyed_upsert,
    "held_set_loads": held_set_loads,
    "schema_contract": schema_contract,
    "parquet_roundtrip": parquet_roundtrip,
    "csv_roundtrip": csv_roundtrip,
    "large_csv_roundtrip": large_csv_roundtrip,
    "report_roundtrip": report_roundtrip,
    "language_detect": language_detect,
    "language_refused": language_refused,
    "reviews_clean_detected": reviews_clean_detected,
    "embed_hash": embed_hash,
    "embed_udf": embed_udf,
    "bm25_index": bm25_index,
    "bm25_terms": bm25_terms,
    "bm25_topk": bm25,
    "bm25_skipping": bm25_skipping,
    "knn_exact": knn_exact,
    "knn_lsh": knn_lsh_query,
    "knn_ivf": knn_ivf,
    "knn_ivf_recall": knn_ivf_recall,
    "search_hydrate": search_hydrate,
    "search_compare": search_compare,
    "search_answers": search_answers,
    "tokens_stopwords": tokens_stopwords,
    "hashed_tf": hashed_counts,
    "tfidf": tfidf,
    "string_index": string_index,
    "frequency_index": frequency_index,
    "one_hot": one_hot,
    "lr_predict": lr_predict,
    "rf_predict": rf_predict,
    "model_comparison": model_comparison,
    "confusion_matrix": confusion_matrix,
    "confusion_pivot": confusion_pivot,
    "class_metrics": class_metrics,
    "metrics_unpivot": metrics_unpivot,
    "roc_points": roc_points,
    "roc_bounded": roc_bounded,
    "auc": auc,
    "sentiment_by_region": sentiment_by_region,
    "sentiment_pivot": sentiment_pivot,
    "rating_histogram": rating_histogram,
    "fitting_histogram": fitting_histogram,
    "fitting_periods": fitting_periods,
    "region_topn_other": region_topn_other,
    "reviews_per_month": reviews_per_month,
    "events_in_window": events_in_window,
    "positive_share": positive_share,
    "top_cities": top_cities,
    "board": board_query,
    "board_loads": board_loads,
    "materialised_sets": materialised_sets,
}
