import math

import numpy as np
import pytest

from loyalspan.operators import metrics

RNG = np.random.default_rng(11)


def labels(spark, pairs):
    return spark.createDataFrame([(int(y), float(s)) for y, s in pairs], "y int, score double")


def pairwise_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def brute_cutoff(pairs):
    pos = sum(y for y, _ in pairs)
    neg = len(pairs) - pos
    best, at = 0.0, math.inf
    for cut in sorted({s for _, s in pairs}, reverse=True):
        tp = sum(1 for y, s in pairs if s >= cut and y == 1)
        fp = sum(1 for y, s in pairs if s >= cut and y == 0)
        if tp * neg - fp * pos > best:
            best, at = tp * neg - fp * pos, cut
    return at


CASES = {
    "ties": [(i % 3 == 0, round(float(RNG.normal()) + (i % 3 == 0), 1)) for i in range(300)],
    "mostly one score": [(i % 4 == 0, 0.5 if i % 3 else i / 300) for i in range(300)],
    "separated": [(1, 0.9), (1, 0.8), (0, 0.2), (0, 0.1)],
    "reversed": [(0, 0.9), (0, 0.8), (1, 0.2), (1, 0.1)],
}


@pytest.mark.parametrize("name", CASES)
def test_auc_and_cutoff(spark, name):
    df = labels(spark, CASES[name])
    assert metrics.roc_auc(df, "y", "score").first()[0] == pytest.approx(pairwise_auc(CASES[name]))
    assert metrics.youden_cutoff(df, "y", "score").first()[0] == brute_cutoff(CASES[name])


def test_auc_of_one_class_is_null(spark):
    assert metrics.roc_auc(labels(spark, [(1, 0.2), (1, 0.4)]), "y", "score").first()[0] is None


def test_report_and_confusion(spark):
    cells = {(1, 1): 5, (1, 0): 3, (0, 1): 2, (0, 0): 10}
    rows = [key for key, n in cells.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "alive int, pred int")
    report = {r["label"]: r for r in metrics.classification_report(df, "alive", "pred").collect()}
    assert report["1"]["precision"] == pytest.approx(5 / 7)
    assert report["1"]["recall"] == pytest.approx(5 / 8)
    assert report["1"]["f1_score"] == pytest.approx(10 / 15)
    assert report["0"]["support"] == 12
    assert report["accuracy"]["f1_score"] == pytest.approx(15 / 20)
    assert report["accuracy"]["precision"] is None
    assert report["macro avg"]["recall"] == pytest.approx((10 / 12 + 5 / 8) / 2)
    assert report["weighted avg"]["precision"] == pytest.approx((10 / 13 * 12 + 5 / 7 * 8) / 20)
    assert metrics.f1_score(df, "alive", "pred").first()[0] == pytest.approx(10 / 15)
    matrix = {(r[0], r[1]): r[2] for r in metrics.confusion_matrix(df, "alive", "pred").collect()}
    assert matrix[("1", "0")] == 3 and matrix[("All", "1")] == 7 and matrix[("All", "All")] == 20


def test_report_when_nothing_is_called_positive(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "alive int, pred int")
    report = {r["label"]: r for r in metrics.classification_report(df, "alive", "pred").collect()}
    assert (report["1"]["precision"], report["1"]["f1_score"]) == (0.0, 0.0)


def test_regression_metrics(spark):
    rows = [(0.0, 1.0), (2.0, 1.0), (4.0, 5.0), (300.0, 100.0)]
    df = spark.createDataFrame(rows, "y double, p double")
    row = metrics.regression_metrics(df, "y", "p").first()
    assert (row["mae"], row["mse"]) == (pytest.approx(203 / 4), pytest.approx(40003 / 4))
    assert metrics.mape(df, "y", "p").first()[0] == pytest.approx((0.5 + 0.25 + 200 / 300) / 3)
    banded = metrics.value_band(df, "y", 250.0)
    assert banded.count() == 2
    assert metrics.r_squared(banded, "y", "p").first()[0] == pytest.approx(1 - 2 / 2)
