"""Training, comparison and saved results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stayscope.operators.charts import sentiment_by_region
from stayscope.operators.classifiers import (
    LOGISTIC_REGRESSION, RANDOM_FOREST, Trained, metrics_table, train_and_score,
)
from stayscope.operators.features import drop_incomplete, split_by_hash
from stayscope.operators.metrics import compare_models, confusion
from stayscope.sources.contracts import MODEL_COLUMNS
from stayscope.sources.files import write_report, write_table

SHORT = {LOGISTIC_REGRESSION: "lr", RANDOM_FOREST: "rf"}


def save_results(model_rows: DataFrame, trained: dict[str, Trained], folder: str) -> DataFrame:
    """Write metrics, confusion counts, predictions and counts by region.

    Returns the metric table.
    """
    metrics = metrics_table(model_rows.sparkSession, [t.metrics for t in trained.values()])
    write_report(metrics, f"{folder}/metrics_comparison.csv")
    for name, found in trained.items():
        counts = confusion(found.predictions).orderBy("sentiment", "prediction")
        write_report(counts, f"{folder}/confusion_matrix_{SHORT[name]}.csv")
        write_table(
            found.predictions.select("sentiment", "prediction", "probability"),
            f"{folder}/predictions_{SHORT[name]}.parquet",
        )
    write_report(sentiment_by_region(model_rows), f"{folder}/sentiment_by_region.csv")
    return metrics


def train(spark: SparkSession, reviews_path: str, results_folder: str) -> DataFrame:
    """Both models on the stored reviews; returns their metrics and the winner by F1."""
    rows = drop_incomplete(spark.read.parquet(reviews_path), MODEL_COLUMNS)
    trained = train_and_score(*split_by_hash(rows))
    return compare_models(save_results(rows, trained, results_folder))
