"""Training: penalty search, best fit, evaluation, gates and the final fit."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalspan.functions import gamma_gamma, mbg, pareto
from loyalspan.operators import metrics
from loyalspan.operators.fit import (
    AT_LIMIT,
    CONVERGED,
    GAMMA_GAMMA,
    MBG,
    FAILED,
    PARETO,
    UNFINISHED,
    Fit,
    fit,
    fit_purchases,
    purchase_rows,
    ready,
    spend_rows,
)
from loyalspan.operators.outlook import purchase_outlook
from loyalspan.operators.quality import THRESHOLDS, quality_gates, require_gates
from loyalspan.operators.sampling import NO_LIMIT, repeat_buyers, training_set
from loyalspan.plans.evaluate import (
    FrequencyEvaluation,
    evaluate_frequency,
    evaluate_spend,
    frequency_predictions,
    spend_predictions,
)
from loyalspan.plans import search
from loyalspan.plans.search import Journal, fingerprint, search_penalty, winner
from loyalspan.session import materialise, spread
from loyalspan.sources import registry
from loyalspan.sources.registry import create_registry, log_run, save_model
from loyalspan.sources.snapshots import FULL_SCHEMA, TRAINING_SCHEMA, read_snapshots

# The baseline penalty, the search size and its seed.
BASELINE_L2 = 0.01
TRIALS = 100
SEED = 42
ROW_COUNT = "row_count"
FIT_ROWS = "fit_rows"


def candidate_penalties(trials: int = TRIALS, seed: int = SEED) -> list[float]:
    """Seeded uniform draws on (0, 1)."""
    return [float(u) for u in np.random.default_rng(seed).uniform(0.0, 1.0, trials)]


def _with_fits(df: DataFrame, fits: Sequence[Fit]) -> DataFrame:
    """Every row once per fit, with columns trial, l2 and the fitted parameters."""
    names = list(fits[0].params)
    schema = ", ".join(f"{name}: double" for name in ["l2", *names])
    rows = [{"trial": i, "stop": f.stop, "l2": f.l2, **f.params} for i, f in enumerate(fits)]
    table = F.from_json(F.lit(json.dumps(rows)), f"array<struct<trial: int, stop: string, {schema}>>")
    return df.select("*", F.inline(table))


def _losses(
    scored: DataFrame, names: Sequence[str], squared_error: Column, rows: Column
) -> DataFrame:
    """RMSE of each trial, from sums of squared errors; null where a failed fit predicts nothing."""
    rmse = F.sqrt(F.greatest(F.sum(squared_error), F.lit(0.0)) / F.sum(rows))
    finite = F.when(~F.isnan(rmse) & (rmse < float("inf")), rmse)
    return scored.groupBy("trial", "l2", "stop", *names).agg(finite.alias("rmse"))


def frequency_histories(training: DataFrame) -> DataFrame:
    """What the trials of the purchase model need of a training table, written once.

    Customers with one history are counted together; their holdout purchases enter through sums,
    so the loss is that of the single customers.
    """
    actual = F.col("frequency_holdout")
    return ready(
        training.groupBy(
            F.col("frequency_cal").cast("double").alias("x"),
            F.col("recency_cal").cast("double").alias("t_x"),
            F.col("T_cal").cast("double").alias("T"),
            F.col("duration_holdout").cast("double").alias("ahead"),
        ).agg(
            F.count(F.lit(1)).cast("double").alias("weight"),
            F.sum(actual).alias("y"),
            F.sum(actual * actual).alias("yy"),
        )
    )


def frequency_trials(training: DataFrame, penalties: Sequence[float]) -> DataFrame:
    """MBG/NBD fitted with every penalty, with its RMSE on holdout purchases."""
    return frequency_losses(frequency_histories(training), penalties)


def frequency_losses(rows: DataFrame, penalties: Sequence[float]) -> DataFrame:
    """:func:`frequency_trials` on the rows of :func:`frequency_histories`.

    The costly part of a prediction is worked out once per frequency, tenure and trial.
    """
    fits = fit_purchases(rows, MBG, penalties)
    params = {name: name for name in mbg.NAMES}
    pairs = ["x", "T", "ahead"]
    outlook = purchase_outlook(
        _with_fits(rows.select(*pairs).distinct(), fits), params, {"if_alive": "ahead"}
    )
    alive = F.expr(mbg.probability_alive(params, "x", "t_x", "T"))
    # A customer without a history has no prediction; that counts as none expected.
    scored = rows.join(outlook, pairs).withColumn("e", F.coalesce(alive * F.col("if_alive"), F.lit(0.0)))
    squared = F.col("yy") - 2 * F.col("e") * F.col("y") + F.col("weight") * F.col("e") * F.col("e")
    return _losses(scored, mbg.NAMES, squared, F.col("weight"))


def spend_trials(
    training: DataFrame, penalties: Sequence[float], holdout_inputs: bool = False
) -> DataFrame:
    """Gamma-Gamma fitted with every penalty, with its RMSE on holdout spend."""
    return spend_losses(*spend_histories(training, holdout_inputs), penalties)


def spend_histories(training: DataFrame, holdout_inputs: bool = False) -> tuple[DataFrame, DataFrame]:
    """What the trials of the spend model need of a training table, written once: rows to fit on and sums.

    A prediction is linear in the average m given the frequency x, so all trials share sums over the
    customers of each frequency, and meet these instead of the customers.
    """
    buyers = materialise(
        repeat_buyers(training).select(
            "frequency_cal", "monetary_value_cal", "frequency_holdout", "monetary_value_holdout"
        )
    )
    kind = "holdout" if holdout_inputs else "cal"
    m, y = F.col(f"monetary_value_{kind}"), F.col("monetary_value_holdout")
    both = buyers.where(m.isNotNull() & y.isNotNull())
    sums = both.groupBy(F.col(f"frequency_{kind}").cast("double").alias("x")).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        *[F.sum(v).alias(name) for name, v in (("m1", m), ("y1", y), ("mm", m * m), ("yy", y * y), ("my", m * y))],
    )
    return ready(spend_rows(buyers)), materialise(sums)


def spend_losses(rows: DataFrame, sums: DataFrame, penalties: Sequence[float]) -> DataFrame:
    """:func:`spend_trials` on the tables of :func:`spend_histories`."""
    fits = fit(rows, GAMMA_GAMMA, penalties)
    params = {name: name for name in gamma_gamma.NAMES}
    at_zero = F.expr(gamma_gamma.expected_spend(params, "x", "0D"))
    at_one = F.expr(gamma_gamma.expected_spend(params, "x", "1D"))
    scored = _with_fits(sums, fits).withColumn("base", at_zero).withColumn("slope", at_one - at_zero)
    scored = scored.where(F.col("base").isNotNull())
    squared = F.expr(
        "yy - 2*base*y1 - 2*slope*my + n*base*base + 2*base*slope*m1 + slope*slope*mm"
    )
    return _losses(scored, gamma_gamma.NAMES, squared, F.col("n"))


def best_trial(trials: DataFrame, names: Sequence[str]) -> tuple[float, dict[str, float]]:
    """Penalty and parameters with the smallest loss, the first trial on a tie.

    Failed and unfinished fits and those without a loss take no part, whatever the size of the losses;
    it is an error if none is left.
    """
    finished = trials.where(~F.col("stop").isin(FAILED, UNFINISHED) & F.col("rmse").isNotNull())
    row = finished.agg(F.min_by(F.struct("*"), F.struct("rmse", "trial")).alias("best")).first()["best"]
    if row is None:
        raise RuntimeError("no trial of the search has come to an end")
    return row["l2"], {name: row[name] for name in names}


def pareto_predictions(training: DataFrame, model: pareto.Params) -> DataFrame:
    """Holdout purchases expected by the baseline, worked out once per distinct history."""
    keys = {"x": "frequency_cal", "t_x": "recency_cal", "T": "T_cal", "ahead": "duration_holdout"}
    rows = training.select(
        F.struct(*training.columns).alias("customer"),
        *[F.col(name).cast("double").alias(key) for key, name in keys.items()],
    )
    expected = F.expr(pareto.expected_purchases(model, "ahead", "x", "t_x", "T"))
    histories = spread(rows.select(*keys).distinct()).withColumn("frequency_predicted", expected)
    return rows.join(histories, list(keys), "left").select("customer.*", "frequency_predicted")


def _require_rows(rows: DataFrame, thresholds: Mapping[str, float], enforce: bool) -> None:
    """The row-count gate, before anything is fitted on ``rows``."""
    if enforce and ROW_COUNT in thresholds:
        count = rows.agg(F.count(F.lit(1)).cast("double").alias(ROW_COUNT))
        require_gates(quality_gates(count, {ROW_COUNT: thresholds[ROW_COUNT]}))


@dataclass(frozen=True)
class FrequencyTraining:
    l2: float
    params: dict[str, float]
    evaluation: FrequencyEvaluation
    gates: DataFrame
    final_params: dict[str, float]


@dataclass(frozen=True)
class SpendTraining:
    l2: float
    params: dict[str, float]
    evaluation: DataFrame
    gates: DataFrame
    final_params: dict[str, float]


def _with_errors(summary: DataFrame, prefix: str) -> dict[str, float]:
    """The metrics of an evaluation, with its errors also under their plain names."""
    row = summary.first().asDict()
    mae, rmse = row[f"{prefix}_mae"], row[f"{prefix}_rmse"]
    mse = None if rmse is None else rmse**2
    return {**row, **dict(zip(registry.ERRORS, (mae, mse, rmse)))}


def fit_report(fit: Fit) -> dict[str, float]:
    """How a fit ended, as metrics of the run log."""
    return {
        "fit_converged": float(fit.stop in (CONVERGED, AT_LIMIT)),
        "fit_at_bound": float(len(fit.at_bound)),
        "fit_gradient": fit.gradient,
        "fit_iterations": float(fit.iterations),
    }


def usable(fit: Fit) -> Fit:
    """The fit itself; a failed or unfinished one is an error and never saved.

    A fit at a limit or on a ridge is usable: the limit is exact, or its parameters fit alike. The run
    log tells.
    """
    if fit.stop in (FAILED, UNFINISHED):
        raise RuntimeError(f"the fit with penalty {fit.l2} is {fit.stop} after {fit.iterations} iterations")
    return fit


def _with_row_count(summary: DataFrame, rows: DataFrame) -> DataFrame:
    count = rows.agg(F.count(F.lit(1)).cast("double").alias("n"))
    return summary.withColumn("row_count", count.scalar())


def fit_baseline(training: DataFrame, l2: float = BASELINE_L2) -> Fit:
    return fit_purchases(ready(purchase_rows(training)), PARETO, [l2])[0]


def fit_final_frequency(full: DataFrame, l2: float) -> Fit:
    rows = ready(purchase_rows(full, "frequency", "recency", "T"))
    return fit_purchases(rows, MBG, [l2])[0]


def fit_final_spend(full: DataFrame, l2: float) -> Fit:
    rows = ready(spend_rows(full, "frequency", "monetary_value"))
    return fit(rows, GAMMA_GAMMA, [l2])[0]


def train_frequency(
    training: DataFrame,
    full: DataFrame,
    model_path: str,
    log_path: str,
    trained_at: datetime,
    trials: int = search.TRIALS,
    seed: int = SEED,
    thresholds: Mapping[str, float] = THRESHOLDS,
    enforce_gates: bool = True,
    journal: str | None = None,
) -> FrequencyTraining:
    """Baseline, search, evaluation and final fit of the purchase model; logs and saves each.

    With a ``journal`` the finished trials are kept there, and a run on the same rows goes on from them.

    The row-count gate holds for the training rows before the first fit and for the full rows before
    the final one.
    """
    spark = training.sparkSession
    training = materialise(training)
    _require_rows(training, thresholds, enforce_gates)
    create_registry(spark, log_path, registry.LOG_SCHEMA)

    baseline = usable(fit_baseline(training))
    errors = metrics.regression_metrics(
        pareto_predictions(training, baseline.params), "frequency_holdout", "frequency_predicted"
    ).first()
    params = {registry.MODEL_TYPE: registry.BASELINE_TYPE, registry.L2_PARAM: baseline.l2}
    log_run(spark, log_path, registry.BASELINE_RUN, params, {**errors.asDict(), **fit_report(baseline)})
    save_model(spark, model_path, registry.BASELINE_MODEL, baseline.params, trained_at)

    rows = frequency_histories(training)
    name = fingerprint(rows, model="frequency", seed=seed) if journal else ""
    best = winner(
        search_penalty(
            lambda penalties: frequency_losses(rows, penalties),
            mbg.NAMES, Journal(spark, journal, name), trials, seed=seed,
        )
    )
    l2, params = best.l2, best.params
    evaluation = evaluate_frequency(frequency_predictions(training, params))
    gates = quality_gates(_with_row_count(evaluation.summary, training), thresholds)
    log_run(
        spark, log_path, registry.BEST_FREQUENCY_RUN,
        {registry.MODEL_TYPE: registry.FREQUENCY_TYPE, registry.L2_PARAM: l2},
        {**_with_errors(evaluation.summary, "frequency"), FIT_ROWS: training.count()},
    )
    save_model(spark, model_path, registry.BEST_FREQUENCY_MODEL, params, trained_at)
    if enforce_gates:
        require_gates(gates)

    full = materialise(full)
    _require_rows(full, thresholds, enforce_gates)
    final = usable(fit_final_frequency(full, l2))
    report = {**fit_report(final), FIT_ROWS: full.count()}
    kind = {registry.MODEL_TYPE: registry.FREQUENCY_TYPE, registry.L2_PARAM: l2}
    log_run(spark, log_path, registry.FINAL_FREQUENCY_RUN, kind, report)
    save_model(spark, model_path, registry.FINAL_FREQUENCY_MODEL, final.params, trained_at)
    return FrequencyTraining(l2, params, evaluation, gates, final.params)


def train_spend(
    training: DataFrame,
    full: DataFrame,
    model_path: str,
    log_path: str,
    trained_at: datetime,
    trials: int = search.TRIALS,
    seed: int = SEED,
    thresholds: Mapping[str, float] = THRESHOLDS,
    enforce_gates: bool = True,
    holdout_inputs: bool = False,
    journal: str | None = None,
) -> SpendTraining:
    """Search, evaluation and final fit of the spend model; logs and saves each.

    A ``journal`` serves as in :func:`train_frequency`.

    The row-count gate holds as in :func:`train_frequency`, for snapshots before repeat buyers are
    taken out.
    """
    spark = training.sparkSession
    training = materialise(training)
    _require_rows(training, thresholds, enforce_gates)
    buyers = repeat_buyers(training)
    create_registry(spark, log_path, registry.LOG_SCHEMA)

    rows, sums = spend_histories(buyers, holdout_inputs)
    name = ""
    if journal:
        # The losses depend on the sums as well as on the rows of the fit.
        both = fingerprint(rows, model="spend", seed=seed), fingerprint(sums, holdout_inputs=holdout_inputs)
        name = "/".join(both)
    best = winner(
        search_penalty(
            lambda penalties: spend_losses(rows, sums, penalties),
            gamma_gamma.NAMES, Journal(spark, journal, name), trials, seed=seed,
        )
    )
    l2, params = best.l2, best.params
    evaluation = evaluate_spend(spend_predictions(buyers, params, holdout_inputs))
    gates = quality_gates(evaluation, thresholds)
    report = {**_with_errors(evaluation, "spend"), FIT_ROWS: buyers.count()}
    kind = {registry.MODEL_TYPE: registry.SPEND_TYPE, registry.L2_PARAM: l2}
    log_run(spark, log_path, registry.BEST_SPEND_RUN, kind, report)
    save_model(spark, model_path, registry.BEST_SPEND_MODEL, params, trained_at)
    if enforce_gates:
        require_gates(gates)

    full = materialise(full)
    _require_rows(full, thresholds, enforce_gates)
    full = repeat_buyers(full, "frequency")
    final = usable(fit_final_spend(full, l2))
    report = {**fit_report(final), FIT_ROWS: full.count()}
    log_run(spark, log_path, registry.FINAL_SPEND_RUN, kind, report)
    save_model(spark, model_path, registry.FINAL_SPEND_MODEL, final.params, trained_at)
    return SpendTraining(l2, params, evaluation, gates, final.params)


def run_training(
    spark: SparkSession,
    training_path: str,
    full_path: str,
    model_path: str,
    log_path: str,
    journal: str,
    period: str,
    trained_at: datetime,
    cap: int,
    suffixes: Sequence[str] | None = None,
    sample_size: int = NO_LIMIT,
    **options,
) -> tuple[FrequencyTraining, SpendTraining]:
    """Both models from the snapshot tables to the registry.

    Of both tables one snapshot is read, with the id sample and the frequency cap; ``sample_size`` limits
    the training rows only. A run that was lost goes on from the ``journal``: trials it has finished are
    not fitted again. ``options`` are those of :func:`train_frequency`.
    """
    stored = read_snapshots(spark, training_path, TRAINING_SCHEMA)
    training = materialise(training_set(stored, period, cap, suffixes, sample_size))
    stored = read_snapshots(spark, full_path, FULL_SCHEMA)
    full = materialise(training_set(stored, period, cap, suffixes, frequency="frequency"))
    paths = (model_path, log_path, trained_at)
    return (
        train_frequency(training, full, *paths, journal=journal, **options),
        train_spend(training, full, *paths, journal=journal, **options),
    )
