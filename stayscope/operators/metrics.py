"""Confusion counts, weighted class metrics, ROC and area under it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

METRIC_NAMES = ["accuracy", "precision", "recall", "f1"]


def confusion(
    predictions: DataFrame, label: str = "sentiment", prediction: str = "prediction"
) -> DataFrame:
    """label, prediction, count."""
    return predictions.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("count"))


def confusion_square(
    conf: DataFrame, classes: list, label: str = "sentiment", prediction: str = "prediction"
) -> DataFrame:
    """One row per label and one column `predicted_<class>` per class; missing cells are 0."""
    wide = conf.groupBy(label).pivot(prediction, classes).agg(F.sum("count")).na.fill(0)
    return wide.select(label, *[F.col(f"`{c}`").alias(f"predicted_{int(c)}") for c in classes])


def class_metrics(
    conf: DataFrame, label: str = "sentiment", prediction: str = "prediction"
) -> DataFrame:
    """One row: accuracy, and precision, recall and F1 weighted by class size.

    Works on confusion counts alone, a few rows, so all four cost no further
    pass over the predictions. A class that is never predicted has precision 0.
    """
    hit = F.when(F.col(label) == F.col(prediction), F.col("count")).otherwise(F.lit(0))
    zero = F.lit(0).cast("bigint")
    sides = conf.select(F.inline(F.array(
        F.struct(
            F.col(label).cast("double").alias("class"), F.col("count").alias("actual"),
            zero.alias("predicted"), hit.cast("bigint").alias("hits"),
        ),
        F.struct(
            F.col(prediction).cast("double").alias("class"), zero.alias("actual"),
            F.col("count").alias("predicted"), zero.alias("hits"),
        ),
    )))
    classes = sides.groupBy("class").agg(
        F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits")
    )
    ratio = lambda top, bottom: F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))
    rates = classes.select(
        "actual", "hits",
        ratio(F.col("hits"), F.col("predicted")).alias("p"),
        ratio(F.col("hits"), F.col("actual")).alias("r"),
    )
    f1 = ratio(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r"))
    size = F.sum("actual")
    return rates.agg(
        (F.sum("hits") / size).alias("accuracy"),
        (F.sum(F.col("actual") * F.col("p")) / size).alias("precision"),
        (F.sum(F.col("actual") * F.col("r")) / size).alias("recall"),
        (F.sum(F.col("actual") * f1) / size).alias("f1"),
    )


def _ranked_scores(predictions: DataFrame, label: str, score: str, slices: int | None) -> DataFrame:
    """score, positives, negatives, and both counts summed over all higher scores.

    Rows are first counted per score. The scores are then cut into slices at
    fixed points, each slice is summed on its own, and the totals of the
    slices above are added: one row per slice is all that meets in one task.
    There are as many slices as shuffle partitions unless `slices` is given.
    `p_all` and `n_all` are the totals.
    """
    if slices is None:
        slices = int(predictions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = predictions.select(
        F.col(score).cast("double").alias("score"), F.col(label).cast("int").alias("label")
    ).na.drop()
    points = [n / slices for n in range(1, slices)]
    cuts = rows.agg(F.percentile_approx("score", points, 10_000).alias("cuts")).first()["cuts"]
    literal = F.array(*[F.lit(float(c)) for c in sorted(set(cuts or []))]).cast("array<double>")
    counted = rows.groupBy("score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg")
    ).withColumn("slice", F.size(F.filter(literal, lambda cut: cut > F.col("score"))))
    above = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.groupBy("slice").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).select(
        "slice",
        F.coalesce(F.sum("p").over(above), F.lit(0)).alias("p_above"),
        F.coalesce(F.sum("n").over(above), F.lit(0)).alias("n_above"),
        F.sum("p").over(Window.partitionBy()).alias("p_all"),
        F.sum("n").over(Window.partitionBy()).alias("n_all"),
    )
    within = Window.partitionBy("slice").orderBy(F.col("score").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return counted.join(F.broadcast(offsets), "slice").select(
        "score", "pos", "neg",
        (F.col("p_above") + F.sum("pos").over(within)).alias("tp"),
        (F.col("n_above") + F.sum("neg").over(within)).alias("fp"),
        "p_all", "n_all",
    )


def roc(
    predictions: DataFrame, label: str = "sentiment", score: str = "score", slices: int | None = None
) -> DataFrame:
    """score, tp, fp, tpr, fpr at every distinct score, counting scores at or above it.

    A rate whose class does not occur is null.
    """
    ranked = _ranked_scores(predictions, label, score, slices)
    rate = lambda count, total: F.when(total > 0, count / total)
    return ranked.select(
        "score", "tp", "fp",
        rate(F.col("tp"), F.col("p_all")).alias("tpr"),
        rate(F.col("fp"), F.col("n_all")).alias("fpr"),
    )


def roc_bounded(
    predictions: DataFrame, label: str = "sentiment", score: str = "score", points: int = 1000, slices: int | None = None
) -> DataFrame:
    """The curve of `roc` at no more than `points` of its scores, however many there are.

    The rows, highest score first, are cut into `points` equal parts, and the
    last score that ends in a part stands for it. From one point to the next it is
    one score's rows and fewer than 1/points of all. The last point is that of all
    rows. `auc` stays that of all scores.
    """
    if points < 1:
        raise ValueError("a curve has a point at least")
    ranked = _ranked_scores(predictions, label, score, slices)
    part = F.expr(f"((tp + fp - 1) * {int(points)}L) div (p_all + n_all)")
    rate = lambda count, total: F.when(total > 0, count / total)
    ends = ranked.groupBy(part.alias("part"), "p_all", "n_all").agg(
        F.min("score").alias("score"), F.max("tp").alias("tp"), F.max("fp").alias("fp")
    )
    return ends.select(
        "score", "tp", "fp",
        rate(F.col("tp"), F.col("p_all")).alias("tpr"),
        rate(F.col("fp"), F.col("n_all")).alias("fpr"),
    )


def auc(
    predictions: DataFrame, label: str = "sentiment", score: str = "score", slices: int | None = None
) -> DataFrame:
    """One row, `auc_roc`: exact, ties counted half; null when a class is missing."""
    ranked = _ranked_scores(predictions, label, score, slices)
    passed = F.col("neg") * (F.col("tp") - F.col("pos") / 2)
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.agg(F.when(pairs > 0, F.sum(passed) / pairs).alias("auc_roc"))


def evaluate(
    predictions: DataFrame, label: str = "sentiment", prediction: str = "prediction", score: str = "score"
) -> dict[str, float]:
    """All five metrics of a prediction table, as numbers."""
    row = class_metrics(confusion(predictions, label, prediction), label, prediction).first()
    found = {name: row[name] for name in METRIC_NAMES}
    found["auc_roc"] = auc(predictions, label, score).first()["auc_roc"]
    return found


def melt_metrics(metrics: DataFrame, names: list[str] | None = None) -> DataFrame:
    """model, metric, value: one row per model and metric."""
    return metrics.unpivot("model", names or METRIC_NAMES + ["auc_roc"], "metric", "value")


def of_model(table: DataFrame, model: str) -> DataFrame:
    """The rows of one model."""
    return table.filter(F.col("model") == model)


def compare_models(metrics: DataFrame, by: str = "f1") -> DataFrame:
    """The metric table with `outcome`: winner, tie, or other, by one metric."""
    best = metrics.agg(F.max(by)).scalar()
    leaders = F.sum(F.when(F.col(by) == best, 1).otherwise(0)).over(Window.partitionBy(F.col(by)))
    return metrics.withColumn(
        "outcome",
        F.when(F.col(by) != best, "other").when(leaders > 1, "tie").otherwise("winner"),
    )
