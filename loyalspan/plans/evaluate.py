"""Evaluation of fitted models on the holdout."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalspan.functions import gamma_gamma, mbg
from loyalspan.functions.scalars import flag, missing_to_zero
from loyalspan.operators import metrics
from loyalspan.operators.deciles import decile_capture
from loyalspan.operators.outlook import with_purchases
from loyalspan.session import materialise

SPEND_BAND = 250.0  # fixed value: R squared is taken over spend up to this


@dataclass(frozen=True)
class FrequencyEvaluation:
    summary: DataFrame
    deciles: DataFrame
    report: DataFrame
    confusion: DataFrame


def frequency_predictions(training: DataFrame, model: mbg.Params) -> DataFrame:
    """Holdout prediction, purchases in the next year, chance of being alive, alive label."""
    scored = with_purchases(
        training,
        model,
        horizons={"predicted": "duration_holdout", "next_year": 365},
        x="frequency_cal",
        t_x="recency_cal",
        T="T_cal",
    )
    return scored.select(
        *training.columns,
        missing_to_zero(F.col("predicted")).alias("frequency_predicted"),
        F.round("next_year", 2).alias("purchases_next365days"),
        F.col("alive").alias("prob_alive"),
        flag(F.col("frequency_holdout") > 0).alias("alive"),
    )


def evaluate_frequency(predictions: DataFrame) -> FrequencyEvaluation:
    """All frequency metrics of ``frequency_predictions``, which is written once and reused."""
    scored = materialise(
        predictions.select(
            "frequency_holdout", "frequency_predicted", "purchases_next365days", "prob_alive", "alive"
        )
    )
    deciles = decile_capture(scored, "purchases_next365days", "frequency_holdout")
    # The third group in order, not decile number three: ties can merge groups.
    third = (
        deciles.orderBy("decile").limit(3)
        .agg(F.max("ratio_cum_actual_to_total").alias("share"), F.count("*").alias("groups"))
        .select(F.when(F.col("groups") == 3, F.col("share")).alias("share"))
    )
    points = metrics.roc_points(scored, "alive", "prob_alive")
    cutoff = metrics.cutoff_of_points(points, "prob_alive").first()["cutoff"]
    auc = metrics.auc_of_points(points).first()["roc_auc"]
    labelled = scored.withColumn(
        "pred_alive", metrics.predicted_label(F.col("prob_alive"), F.lit(cutoff))
    )
    summary = metrics.regression_metrics(scored, "frequency_holdout", "frequency_predicted").select(
        F.col("mae").alias("frequency_mae"),
        F.col("rmse").alias("frequency_rmse"),
        third.scalar().alias("captured_by_third_decile"),
        F.lit(auc).cast("double").alias("roc_auc"),
        F.lit(cutoff).alias("cutoff"),
        metrics.f1_score(labelled, "alive", "pred_alive").scalar().alias("f1_score"),
    )
    return FrequencyEvaluation(
        summary=summary,
        deciles=deciles,
        report=metrics.classification_report(labelled, "alive", "pred_alive"),
        confusion=metrics.confusion_matrix(labelled, "alive", "pred_alive"),
    )


def spend_predictions(
    training: DataFrame, model: gamma_gamma.Params, holdout_inputs: bool = False
) -> DataFrame:
    """Predicted against actual holdout spend.

    By default the prediction sees the calibration period only. ``holdout_inputs`` predicts from
    the holdout actuals themselves, a form that flatters the model.
    """
    x, m = (
        ("frequency_holdout", "monetary_value_holdout")
        if holdout_inputs
        else ("frequency_cal", "monetary_value_cal")
    )
    predicted = F.expr(gamma_gamma.expected_spend(model, f"cast({x} as double)", m))
    return training.select(
        *training.columns,
        F.col("monetary_value_holdout").alias("actual"),
        predicted.alias("predicted"),
    )


def evaluate_spend(predictions: DataFrame, band: float = SPEND_BAND) -> DataFrame:
    """One row: MAE and RMSE over all, MAPE over spenders, R squared over the value band.

    All are conditional sums of one aggregate, so the predictions are worked out once.
    """
    actual, error = F.col("actual"), F.col("actual") - F.col("predicted")
    spender = actual > 0
    banded = F.when(spender & (actual <= band), actual)
    left = F.sum(F.when(banded.isNotNull(), error * error))
    spread = F.var_pop(banded) * F.count(banded)
    return predictions.agg(
        F.avg(F.abs(error)).alias("spend_mae"),
        F.sqrt(F.avg(error * error)).alias("spend_rmse"),
        F.avg(F.when(spender, F.abs(error) / actual)).alias("spend_mape"),
        (1 - left / F.nullif(spread, F.lit(0.0))).alias("spend_r2"),
    )
