"""Metrics, features and classifiers."""

import random

import pytest
from conftest import SMALL
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from checks import views
from stayscope.operators import classifiers, metrics
from stayscope.operators.classifiers import (
    LOGISTIC_REGRESSION, metrics_table, train_logistic_regression, train_random_forest,
)
from stayscope.operators.features import build_stages, drop_incomplete, split_by_hash
from stayscope.plans.training import train
from stayscope.session import shared_folder
from stayscope.sources.contracts import MODEL_COLUMNS
from stayscope.sources.files import read_report, write_table

CONF = "sentiment int, prediction double, count bigint"


def test_published_confusion_counts_give_the_published_metrics(spark):
    linear = spark.createDataFrame([(0, 0.0, 1102), (0, 1.0, 644), (1, 0.0, 396), (1, 1.0, 2875)], CONF)
    forest = spark.createDataFrame([(0, 0.0, 48), (0, 1.0, 1698), (1, 0.0, 1), (1, 1.0, 3270)], CONF)
    found = [[round(x, 4) for x in metrics.class_metrics(c).first()] for c in (linear, forest)]
    assert found == [[0.7927, 0.7887, 0.7927, 0.7886], [0.6614, 0.7701, 0.6614, 0.5361]]


def scored(spark, rows):
    return spark.createDataFrame(rows, "sentiment int, prediction double, score double").repartition(3)


@pytest.fixture(scope="module")
def predictions(spark):
    rng = random.Random(5)
    rows = []
    for n in range(1500):
        label = rng.random() < 0.65
        score = 0.5 if n % 3 == 0 else round(min(1.0, max(0.0, rng.gauss(0.6 if label else 0.45, 0.2))), 2)
        rows.append((int(label), float(score >= 0.5), score))
    return rows, scored(spark, rows)


def test_metrics_equal_the_evaluators(predictions):
    _, df = predictions
    found = metrics.evaluate(df)
    for name, metric in (("accuracy", "accuracy"), ("precision", "weightedPrecision"),
                         ("recall", "weightedRecall"), ("f1", "f1")):
        evaluator = MulticlassClassificationEvaluator(labelCol="sentiment", metricName=metric)
        assert found[name] == pytest.approx(evaluator.evaluate(df), abs=1e-12)
    assert found["recall"] == pytest.approx(found["accuracy"], abs=1e-12)
    exact = BinaryClassificationEvaluator(labelCol="sentiment", rawPredictionCol="raw", numBins=0)
    raw = df.withColumn("raw", array_to_vector(F.array(-F.col("score"), F.col("score"))))
    assert found["auc_roc"] == pytest.approx(exact.evaluate(raw), abs=1e-12)


@pytest.mark.parametrize("slices", [1, 2, 7, 64])
def test_roc_equals_a_plain_computation(predictions, slices):
    rows, df = predictions
    pos = sum(r[0] for r in rows)
    wanted = {
        s: (sum(1 for r in rows if r[2] >= s and r[0]), sum(1 for r in rows if r[2] >= s and not r[0]))
        for s in {r[2] for r in rows}
    }
    found = metrics.roc(df, slices=slices).collect()
    assert {r.score: (r.tp, r.fp) for r in found} == wanted and len(found) == len(wanted)
    assert all(r.tpr == pytest.approx(r.tp / pos) for r in found)


def test_one_class_only_and_no_rows(spark):
    ones = scored(spark, [(1, 1.0, 0.9), (1, 0.0, 0.2)])
    assert metrics.auc(ones).first().auc_roc is None
    assert {r.fpr for r in metrics.roc(ones).collect()} == {None}
    none = ones.limit(0)
    assert metrics.auc(none).first().auc_roc is None and metrics.roc(none).count() == 0


def test_confusion_square_has_zeros(spark):
    conf = spark.createDataFrame([(0, 1.0, 4), (1, 1.0, 6)], CONF)
    rows = {r.sentiment: (r.predicted_0, r.predicted_1) for r in metrics.confusion_square(conf, [0.0, 1.0]).collect()}
    assert rows == {0: (0, 4), 1: (0, 6)}
    assert metrics.class_metrics(conf).first().precision == pytest.approx(0.36)


def test_comparison_names_winner_and_tie(spark):
    row = {"accuracy": 0.5, "precision": 0.5, "recall": 0.5, "auc_roc": None}
    table = metrics_table(spark, [{"model": m, "f1": f, **row} for m, f in (("a", 0.5), ("b", 0.7), ("c", 0.7))])
    assert {r.model: r.outcome for r in metrics.compare_models(table).collect()} == {"a": "other", "b": "tie", "c": "tie"}
    two = metrics.compare_models(table.filter("model <> 'c'")).collect()
    assert {r.model: r.outcome for r in two} == {"a": "other", "b": "winner"}
    assert metrics.melt_metrics(table).count() == 15


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(9)
    rows = []
    for n in range(240):
        good = rng.random() < 0.6
        text = " ".join(rng.sample(["clean", "lovely", "great"] if good else ["dirty", "awful", "noisy"], 2)
                        + rng.sample(["room", "bar", "the", "desk", "pool", "view"], 3))
        rows.append((text, int(good), rng.choice("ABC"), rng.choice("xy")))
    return spark.createDataFrame(rows, "review_full_text string, sentiment int, region string, division string")


def test_feature_width_and_unseen_category(spark, labelled):
    model = build_stages(width=64).fit(labelled)
    strange = spark.createDataFrame([("clean room", "Z", "x")], "review_full_text string, region string, division string")
    row = model.transform(strange).first()
    assert row.features.size == 64 + 3 + 2
    assert row.region_ohe.numNonzeros() == 0 and row.division_ohe.numNonzeros() == 1
    text_only = build_stages(category_cols=(), width=64).fit(labelled)
    assert text_only.transform(strange).first().features.size == 64


def test_the_rating_is_no_feature():
    with pytest.raises(ValueError, match="rating"):
        build_stages(category_cols=("region", "rating"))


def test_incomplete_rows_leave(spark):
    df = spark.createDataFrame([("t", 1, None, "d"), ("t", 1, "r", "d")], "a string, b int, c string, d string")
    assert drop_incomplete(df, ["a", "b", "c"]).collect() == [("t", 1, "r")]
    with pytest.raises(ValueError, match="nope"):
        drop_incomplete(df, ["nope"])


def test_both_models_learn(labelled):
    sides = split_by_hash(labelled.dropDuplicates())
    model, predictions, found = train_logistic_regression(*sides)
    assert found["model"] == LOGISTIC_REGRESSION and found["accuracy"] >= 0.9 and found["auc_roc"] >= 0.9
    assert found["recall"] == pytest.approx(found["accuracy"])
    scored_again = model.transform(sides[1]).select("prediction")
    assert scored_again.count() == predictions.count() == sides[1].count()
    assert {"sentiment", "prediction", "probability", "rawPrediction"} <= set(predictions.columns)
    _, _, forest = train_random_forest(*sides, use_region_features=False)
    assert forest["auc_roc"] >= 0.8


def test_training_job_saves_its_results(spark):
    base = shared_folder(spark)
    write_table(views.labelled_documents(spark, SMALL).select(MODEL_COLUMNS), f"{base}/reviews")
    compared = train(spark, f"{base}/reviews", f"{base}/results")
    assert compared.count() == 2 and {r.outcome for r in compared.collect()} <= {"winner", "other", "tie"}
    saved = read_report(
        spark, f"{base}/results/metrics_comparison.csv",
        "model string, accuracy double, precision double, recall double, f1 double, auc_roc double",
    )
    assert {r.model: r.f1 for r in saved.collect()} == {r.model: r.f1 for r in compared.collect()}
    conf = read_report(spark, f"{base}/results/confusion_matrix_lr.csv", CONF)
    predicted = spark.read.parquet(f"{base}/results/predictions_lr.parquet")
    assert conf.agg(F.sum("count")).first()[0] == predicted.count()
    assert predicted.columns == ["sentiment", "prediction", "probability"]
    regions = read_report(spark, f"{base}/results/sentiment_by_region.csv", "region string, sentiment int, count bigint")
    assert regions.agg(F.sum("count")).first()[0] == spark.read.parquet(f"{base}/reviews").count()


def test_training_job_names_a_missing_column(spark, labelled):
    base = shared_folder(spark)
    write_table(labelled.drop("region"), base)
    with pytest.raises(ValueError, match="region"):
        train(spark, base, f"{base}-results")


def test_models_do_not_depend_on_the_layout(spark, labelled):
    train_rows, test_rows = split_by_hash(labelled.withColumn("n", F.monotonically_increasing_id()), ["n"])
    found = []
    for layout in (train_rows.coalesce(1), train_rows.repartition(3), train_rows.repartition(7, "review_full_text")):
        scores = {}
        for trainer in (train_random_forest, train_logistic_regression):
            _, predictions, _ = trainer(layout.drop("n"), test_rows.drop("n"))
            scores[trainer] = sorted(r.score for r in predictions.collect())
        found.append(scores)
    for other in found[1:]:
        assert other[train_random_forest] == found[0][train_random_forest]
        assert other[train_logistic_regression] == pytest.approx(found[0][train_logistic_regression], abs=1e-12)


def test_metrics_of_one_model(spark):
    rows = [{"model": m, "accuracy": 0.5, "precision": 0.5, "recall": 0.5, "f1": 0.5, "auc_roc": None} for m in ("a", "b")]
    assert [r.model for r in metrics.of_model(metrics_table(spark, rows), "b").collect()] == ["b"]
    assert metrics.of_model(metrics_table(spark, rows), "c").isEmpty()


def test_partitions_of_a_fit_follow_from_the_rows():
    at = {rows: classifiers._fit_partitions(rows) for rows in (0, 1_600_000, 1_600_001, 10**9)}
    assert at == {0: 32, 1_600_000: 32, 1_600_001: 33, 10**9: 20_000}


def test_bins_of_a_forest_bound_its_partitions():
    """A row of 33,000 features takes 132 kB of bins: 30,000 rows of a partition were 4 GB in one task."""
    for rows in (3_000, 200_000, 1_200_000):
        parts = classifiers._forest_partitions(rows, 33_000)
        assert 4 * 33_000 * rows / parts <= 513 << 20 and parts >= classifiers._fit_partitions(rows)
    assert classifiers._forest_partitions(3_000, 33_000) == classifiers.FIT_PARTITIONS
