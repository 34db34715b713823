"""The two sentiment classifiers on shared features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from stayscope.operators.features import WORD_COUNT_STAGES, build_stages
from stayscope.operators.metrics import evaluate
from stayscope.session import shared_folder
from stayscope.sources.contracts import METRICS
from stayscope.sources.files import write_table

LOGISTIC_REGRESSION = "Logistic Regression"
RANDOM_FOREST = "Random Forest"


def logistic_regression(label: str) -> LogisticRegression:
    return LogisticRegression(featuresCol="features", labelCol=label, maxIter=100, regParam=0.01, aggregationDepth=3)


def random_forest(label: str) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol="features", labelCol=label, numTrees=50, maxDepth=10, seed=42
    )


CLASSIFIERS = {LOGISTIC_REGRESSION: logistic_regression, RANDOM_FOREST: random_forest}

#: Partitions of a fit, at least. The forest draws its samples by partition, so the model
#: is a function of the rows and of their number of partitions, and of no layout of the data.
FIT_PARTITIONS = 32
#: Rows of a partition of a fit; a table of more rows gets more partitions.
FIT_ROWS = 50_000
#: A forest's fit keeps a bin of four bytes for every feature of every row, zeros too; so much of it is one partition.
FOREST_BYTES = 512 << 20


@dataclass
class Trained:
    """A fitted model, its stored predictions on the test rows, its metrics."""

    model: PipelineModel
    predictions: DataFrame
    metrics: dict


def positive_score(predictions: DataFrame) -> DataFrame:
    """Adds `score`, the probability of the positive class."""
    return predictions.withColumn("score", vector_to_array("probability")[1])


def _fit_partitions(rows: int) -> int:
    """How many partitions a fit of so many rows is dealt into."""
    return max(FIT_PARTITIONS, -(-rows // FIT_ROWS))


def _forest_partitions(rows: int, features: int) -> int:
    """How many partitions a forest's fit takes, so that a task reads at most about FOREST_BYTES of bins."""
    return max(_fit_partitions(rows), -(-4 * rows * features // FOREST_BYTES))


def _dealt(rows: DataFrame, label: str, partitions: int) -> DataFrame:
    """Label and features in an order that depends on their values alone."""
    place = F.xxhash64(F.col(label), F.unwrap_udt("features"))
    dealt = rows.select(label, "features", place.alias("_place")).repartition(partitions, "_place")
    return dealt.sortWithinPartitions("_place").drop("_place")


def _without_summary(model, folder: str):
    """The model as stored and loaded again.

    A model fresh from `fit` holds its training summary, and with it the
    session, and would take both along into every scoring task.
    """
    model.write().overwrite().save(folder)
    return type(model).load(folder)


def train_and_score(
    train: DataFrame,
    test: DataFrame,
    label: str = "sentiment",
    text_col: str = "review_full_text",
    category_cols: tuple[str, ...] = ("region", "division"),
    names: tuple[str, ...] = (LOGISTIC_REGRESSION, RANDOM_FOREST),
    keep: tuple[str, ...] = (),
    fit_partitions: int | None = None,
) -> dict[str, Trained]:
    """Fit the features once, then each classifier on the same feature table.

    The text is read once: its word counts are written to the shared folder,
    and weights, categories and the feature tables are made from them. Every
    pass of every classifier starts from the written features, so a lost
    executor costs no work on text. For a fit its rows are dealt by a hash of
    label and features into partitions and sorted, so equal rows give
    equal models in any layout; their number follows from that of the rows (and
    features, for the forest), or is `fit_partitions`. Predictions are computed once and written
    too, as every metric and every saved result reads them.
    """
    spark = train.sparkSession
    folder = shared_folder(spark)
    stages = build_stages(text_col, category_cols).getStages()
    counting = PipelineModel(stages[:WORD_COUNT_STAGES])
    columns = [*keep, label, *category_cols, stages[WORD_COUNT_STAGES - 1].getOutputCol()]
    for side, table in (("train", train), ("test", test)):
        write_table(counting.transform(table).select(columns), f"{folder}/{side}_counts")
    weighing = Pipeline(stages=stages[WORD_COUNT_STAGES:]).fit(spark.read.parquet(f"{folder}/train_counts"))
    # The assembler names each of its slots in the column's metadata, which
    # would travel with every task; the classifiers do not need the names.
    bare = F.col("features").alias("features", metadata={})
    written = {}
    for side in ("train", "test"):
        weighed = weighing.transform(spark.read.parquet(f"{folder}/{side}_counts"))
        written[side] = write_table(weighed.select(*keep, label, bare), f"{folder}/{side}")
    first = spark.read.parquet(f"{folder}/train").select("features").first()
    parts = dict.fromkeys(names, fit_partitions or _fit_partitions(written["train"]))
    if RANDOM_FOREST in names and first and not fit_partitions:
        parts[RANDOM_FOREST] = _forest_partitions(written["train"], first.features.size)
    trained = {}
    for name in names:
        target = f"{folder}/{name.lower().replace(' ', '_')}"
        fitted = CLASSIFIERS[name](label).fit(_dealt(spark.read.parquet(f"{folder}/train"), label, parts[name]))
        classifier = _without_summary(fitted, f"{target}_model")
        scored = positive_score(classifier.transform(spark.read.parquet(f"{folder}/test")))
        write_table(
            scored.select(*keep, label, "prediction", "probability", "rawPrediction", "score"), target
        )
        predictions = spark.read.parquet(target)
        metrics = {"model": name, **evaluate(predictions, label)}
        trained[name] = Trained(PipelineModel([*counting.stages, *weighing.stages, classifier]), predictions, metrics)
    return trained


def train_logistic_regression(train: DataFrame, test: DataFrame, use_region_features: bool = True):
    """(model, predictions, metrics) of the logistic regression alone."""
    return _train_one(LOGISTIC_REGRESSION, train, test, use_region_features)


def train_random_forest(train: DataFrame, test: DataFrame, use_region_features: bool = True):
    """(model, predictions, metrics) of the random forest alone."""
    return _train_one(RANDOM_FOREST, train, test, use_region_features)


def _train_one(name: str, train: DataFrame, test: DataFrame, use_region_features: bool):
    categories = ("region", "division") if use_region_features else ()
    found = train_and_score(train, test, category_cols=categories, names=(name,))[name]
    return found.model, found.predictions, found.metrics


def metrics_table(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """One row per model."""
    names = METRICS.fieldNames()
    return spark.createDataFrame(
        [tuple(row[n] if n == "model" or row[n] is None else float(row[n]) for n in names) for row in rows],
        METRICS,
    )
