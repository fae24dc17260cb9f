"""The whole flow on the smallest order tables: prepare, train, evaluate, score, export."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from loyalspan.operators import rfm
from loyalspan.plans import evaluate, prepare, score, train
from loyalspan.session import scratch_path
from loyalspan.sources import registry, retail, snapshots
from loyalspan.sources.transactions import clean_transactions

FOLDER = "/root/testdata/sf0.001"
PERIOD = "2001-07-01"
AT = datetime(2001, 8, 1)

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the order tables")


@pytest.fixture(scope="module")
def flow(spark):
    paths = {name: scratch_path(spark, name) for name in ("training", "full", "models", "log", "results", "csv")}
    # Every customer counts, or too few are left on the smallest tables.
    raw = retail.transaction_header(spark, FOLDER).withColumns(
        {
            "region": F.lit("AMERICA"),
            "valid_ind": F.lit(1),
            "consumer_valid_flag": F.lit("Y"),
            "trade_flag": F.lit("N"),
        }
    )
    prepared = prepare.prepare(
        raw, retail.RULES, PERIOD, 365, paths["training"], paths["full"], start="1995-01-01"
    )
    training = snapshots.read_snapshots(spark, paths["training"], snapshots.TRAINING_SCHEMA)
    full = snapshots.read_snapshots(spark, paths["full"], snapshots.FULL_SCHEMA)
    frequency = train.train_frequency(
        training, full, paths["models"], paths["log"], AT, trials=3, enforce_gates=False
    )
    spend = train.train_spend(
        training, full, paths["models"], paths["log"], AT, trials=3, enforce_gates=False
    )
    rows = score.run_scoring(
        spark, paths["full"], paths["results"], paths["models"], PERIOD,
        export_folder=paths["csv"], written_at=AT,
    )
    return {"raw": raw, "paths": paths, "prepared": prepared, "frequency": frequency, "spend": spend, "rows": rows}


def test_prepared_tables(spark, flow):
    training = snapshots.read_snapshots(spark, flow["paths"]["training"], snapshots.TRAINING_SCHEMA)
    assert training.count() == flow["prepared"].training_rows > 100
    assert flow["prepared"].full_rows >= flow["prepared"].training_rows
    bad = "recency_cal < 0 OR recency_cal > T_cal OR frequency_cal < 0 OR monetary_value_cal < 0"
    assert training.where(bad).count() == 0
    assert training.groupBy("CustomerID").count().where("count > 1").count() == 0


def test_prepared_tables_equal_the_direct_snapshots(spark, flow):
    bought = rfm.in_period(clean_transactions(flow["raw"], retail.RULES), "1995-01-01", PERIOD)
    daily, current = rfm.daily_spend(bought), rfm.current_day(bought)
    for name, schema, direct in (
        ("training", snapshots.TRAINING_SCHEMA, rfm.training_snapshot(daily, current, PERIOD, 365)),
        ("full", snapshots.FULL_SCHEMA, rfm.full_snapshot(daily, current, PERIOD)),
    ):
        stored = snapshots.read_snapshots(spark, flow["paths"][name], schema).select(*direct.columns)
        assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, direct.collect()))


def test_training_leaves_models_and_logs(spark, flow):
    models = registry.latest_models(registry.read_models(spark, flow["paths"]["models"])).collect()
    assert {m["name"] for m in models} == {
        "clv_freq_pareto_simple", "clv_freq_best", "clv_freq_final", "clv_monetary_best", "clv_monetary_final",
    }
    runs = registry.run_table(registry.read_log(spark, flow["paths"]["log"]))
    logged = {r["run_name"]: r for r in runs.collect()}
    assert set(logged) == {
        "freq_pareto_simple", "freq_best", "freq_final", "monetary_best", "monetary_final",
    }
    # The tuned penalty is logged, not the baseline's.
    assert logged["freq_best"]["l2_penalizer_coef"] == flow["frequency"].l2 != train.BASELINE_L2
    assert logged["freq_best"]["roc_auc"] is not None
    for run in ("freq_best", "monetary_best"):
        assert logged[run]["mse"] == pytest.approx(logged[run]["rmse"] ** 2)
        assert 0 <= logged[run]["mae"] <= logged[run]["rmse"]
    texts = registry.run_texts(registry.read_log(spark, flow["paths"]["log"]), ["model_type"]).collect()
    assert {r["run_name"]: r["model_type"] for r in texts} == {
        "freq_pareto_simple": "Pareto/NBD",
        "freq_best": "Modified BG/NBD",
        "freq_final": "Modified BG/NBD",
        "monetary_best": "Gamma-Gamma",
        "monetary_final": "Gamma-Gamma",
    }


def test_evaluation_tables(flow):
    evaluation = flow["frequency"].evaluation
    capture = evaluation.deciles.orderBy("decile").collect()
    assert capture[-1]["ratio_cum_actual_to_total"] == pytest.approx(1.0)
    summary = evaluation.summary.first()
    assert 0 <= summary["roc_auc"] <= 1
    assert evaluation.confusion.where("alive = 'All' AND pred_alive = 'All'").first()["n"] == flow[
        "prepared"
    ].training_rows
    assert {r["gate"] for r in flow["frequency"].gates.collect()} == {
        "row_count", "frequency_mae", "captured_by_third_decile", "roc_auc", "f1_score",
    }
    assert {r["gate"] for r in flow["spend"].gates.collect()} == {"spend_rmse", "spend_r2"}


def test_scored_snapshot(spark, flow):
    results = snapshots.read_snapshots(spark, flow["paths"]["results"], snapshots.RESULTS_SCHEMA)
    assert results.count() == flow["rows"] == flow["prepared"].full_rows
    bad = (
        "NOT (prob_alive > 0 AND prob_alive <= 1) OR purch_1y < 0 OR purch_2y < purch_1y"
        " OR clv_1y < 0 OR clv_3y < clv_1y"
    )
    assert results.where(bad).count() == 0
    for decile in ("clv_1y_decile", "prob_alive_decile"):
        sizes = [r["count"] for r in results.groupBy(decile).count().collect()]
        assert len(sizes) == 10 and max(sizes) - min(sizes) <= 1
    exported = spark.read.option("header", True).csv(
        f"{flow['paths']['csv']}/results_2001-08-01 00-00-00.csv"
    )
    assert exported.count() == flow["rows"]
    assert exported.columns == results.columns


def test_gates_stop_a_bad_model(spark, flow):
    paths = flow["paths"]
    training = snapshots.read_snapshots(spark, paths["training"], snapshots.TRAINING_SCHEMA)
    full = snapshots.read_snapshots(spark, paths["full"], snapshots.FULL_SCHEMA)
    places = scratch_path(spark, "m"), scratch_path(spark, "l")
    with pytest.raises(AssertionError, match="row_count"):  # before anything is fitted
        train.train_spend(training, full, *places, AT, trials=2)
    errors = {gate: limit for gate, limit in train.THRESHOLDS.items() if gate != train.ROW_COUNT}
    with pytest.raises(AssertionError, match="spend_rmse"):
        train.train_spend(training, full, *places, AT, trials=2, thresholds=errors)


def test_holdout_inputs_flatter_the_model(spark, flow):
    training = snapshots.read_snapshots(spark, flow["paths"]["training"], snapshots.TRAINING_SCHEMA)
    buyers = training.where("frequency_cal > 0 AND frequency_holdout > 0")
    model = {"p": 3.0, "q": 4.0, "v": 200000.0}
    honest = evaluate.evaluate_spend(evaluate.spend_predictions(buyers, model), 250000.0).first()
    flattered = evaluate.evaluate_spend(
        evaluate.spend_predictions(buyers, model, holdout_inputs=True), 250000.0
    ).first()
    assert flattered["spend_rmse"] < honest["spend_rmse"]


def test_only_finished_trials_win(spark):
    schema = "trial int, l2 double, stop string, p double, rmse double"
    rows = [
        (0, 0.1, "converged", 3.0, 200_000.0),
        (1, 0.2, "failed", float("nan"), None),
        (2, 0.3, "unfinished", 4.0, 5.0),
        (3, 0.4, "at bound", 5.0, 150_000.0),
        (4, 0.5, "flat", 6.0, 150_000.0),
        (5, 0.6, "converged", 7.0, None),
    ]
    assert train.best_trial(spark.createDataFrame(rows, schema), ["p"]) == (0.4, {"p": 5.0})
    with pytest.raises(RuntimeError, match="no trial"):
        train.best_trial(spark.createDataFrame(rows[1:3], schema), ["p"])


def test_a_failed_trial_has_no_loss(spark):
    scored = spark.createDataFrame(
        [(0, 0.1, "converged", 1.0, 4e10, 1.0), (1, 0.2, "failed", float("nan"), float("nan"), 1.0)],
        "trial int, l2 double, stop string, p double, squared double, n double",
    )
    losses = train._losses(scored, ["p"], F.col("squared"), F.col("n"))
    assert {r["trial"]: r["rmse"] for r in losses.collect()} == {0: 200_000.0, 1: None}
