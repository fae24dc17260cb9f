"""Regression and classification metrics as table aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyalspan.operators.running import running_totals


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    error = F.col(actual) - F.col(predicted)
    return df.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
    )


def mape(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Mean absolute error relative to the actual, over rows with a positive actual."""
    relative = F.abs(F.col(actual) - F.col(predicted)) / F.abs(F.col(actual))
    return df.where(F.col(actual) > 0).agg(F.avg(relative).alias("mape"))


def value_band(df: DataFrame, actual: str, upper: float | None = None) -> DataFrame:
    """Rows with a positive actual, up to ``upper`` if given."""
    positive = df.where(F.col(actual) > 0)
    return positive if upper is None else positive.where(F.col(actual) <= upper)


def r_squared(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    error = F.col(actual) - F.col(predicted)
    spread = F.var_pop(actual) * F.count(actual)
    return df.agg((1 - F.sum(error * error) / F.nullif(spread, F.lit(0.0))).alias("r2"))


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score, from high to low: positives and negatives here and so far.

    Both ROC metrics are sums over these points, so one pass serves both.
    """
    counts = (
        df.where(F.col(score).isNotNull())
        .groupBy(score)
        .agg(F.sum(label).cast("long").alias("pos"), F.sum(1 - F.col(label)).cast("long").alias("neg"))
    )
    return running_totals(
        counts, [F.col(score).desc()], {"tp": F.col("pos"), "fp": F.col("neg")}
    )


def auc_of_points(points: DataFrame) -> DataFrame:
    wide = "decimal(18,0)"
    # Twice the number of won pairs is a whole number: each negative loses to the positives above
    # its score and ties with those at it.
    won = F.sum(F.col("neg").cast(wide) * (2 * F.col("tp") - F.col("pos")).cast(wide))
    pairs = F.max("tp_total").cast("double") * F.max("fp_total").cast("double")
    return points.agg((won.cast("double") / 2 / F.nullif(pairs, F.lit(0.0))).alias("roc_auc"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Chance that a positive scores above a negative, ties counting one half.

    Null when one class is missing.
    """
    return auc_of_points(roc_points(df, label, score))


def cutoff_of_points(points: DataFrame, score: str) -> DataFrame:
    wide = "decimal(18,0)"
    hits = F.col("tp").cast(wide) * F.col("fp_total").cast(wide)
    misses = F.col("fp").cast(wide) * F.col("tp_total").cast(wide)
    best = F.max(
        F.struct((hits - misses).alias("gain"), F.col(score).cast("double").alias("score"))
    )
    return points.agg(best.alias("best")).select(
        F.when(F.col("best.gain") > 0, F.col("best.score"))
        .otherwise(F.lit(float("inf")))
        .alias("cutoff")
    )


def youden_cutoff(df: DataFrame, label: str, score: str) -> DataFrame:
    """The score that maximises true minus false positive rate, the highest one on a tie.

    Infinity when no score does better than calling nobody positive.
    """
    return cutoff_of_points(roc_points(df, label, score), score)


def predicted_label(score: Column, cutoff: Column) -> Column:
    """1 strictly above the cutoff."""
    return (score > cutoff).cast("int")


def confusion_matrix(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Counts per (actual, predicted) with margins, labelled "All"."""

    def name(column: str) -> Column:
        return F.when(F.grouping(column) == 1, "All").otherwise(F.col(column).cast("string"))

    return (
        df.cube(actual, predicted)
        .agg(F.count(F.lit(1)).alias("n"), name(actual).alias("row"), name(predicted).alias("col"))
        .select(F.col("row").alias("alive"), F.col("col").alias("pred_alive"), "n")
    )


def classification_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy and the two averages."""

    def count(y: int, p: int) -> Column:
        return F.count(F.when((F.col(actual) == y) & (F.col(predicted) == p), 1))

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(top / F.nullif(bottom, F.lit(0)), F.lit(0.0))

    cells = df.agg(
        count(1, 1).alias("tp"), count(0, 1).alias("fp"), count(1, 0).alias("fn"), count(0, 0).alias("tn")
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    both = tp + fp + fn + tn

    def line(label: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(label).alias("label"),
            precision.cast("double").alias("precision"),
            recall.cast("double").alias("recall"),
            f1.alias("f1_score"),
            support.alias("support"),
        )

    per_class = {
        "0": (ratio(tn, tn + fn), ratio(tn, tn + fp), ratio(2 * tn, 2 * tn + fn + fp), tn + fp),
        "1": (ratio(tp, tp + fp), ratio(tp, tp + fn), ratio(2 * tp, 2 * tp + fp + fn), tp + fn),
    }
    accuracy = ratio(tp + tn, both)
    macro = [(a + b) / 2 for a, b in zip(per_class["0"][:3], per_class["1"][:3])]
    weighted = [
        ratio(a * per_class["0"][3] + b * per_class["1"][3], both)
        for a, b in zip(per_class["0"][:3], per_class["1"][:3])
    ]
    nothing = F.lit(None)
    lines = [
        line("0", *per_class["0"]),
        line("1", *per_class["1"]),
        line("accuracy", nothing, nothing, accuracy, both),
        line("macro avg", *macro, both),
        line("weighted avg", *weighted, both),
    ]
    return cells.select(F.inline(F.array(*lines)))


def f1_score(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """F1 of the positive class."""
    report = classification_report(df, actual, predicted)
    return report.where("label = '1'").select("f1_score")
