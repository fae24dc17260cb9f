"""One query per operator, over whole tables; each takes (spark, folder of the tables)."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalspan.functions import clv, gamma_gamma, mbg, pareto, registered, scalars
from loyalspan.operators import (
    deciles,
    encode,
    fit,
    lookup,
    metrics,
    quality,
    rfm,
    running,
    sampling,
    timeline,
)
from loyalspan.operators.outlook import with_purchases
from loyalspan.plans import evaluate, prepare, score, train
from loyalspan.session import materialise, scratch_path, spread
from loyalspan.sources import exports, features, registry, retail, snapshots
from loyalspan.sources.histories import HistoryStore, Mark

START = "1995-01-01"
PERIOD = "2001-07-01"
EARLIER_PERIOD = "2001-06-01"
DURATION = 365
EVENT_PERIOD = "2024-01-01"
EVENT_DURATION = 10
SUFFIXES = ("11", "12", "13")
RATE = scalars.monthly_rate_of(0.09)
WRITTEN_AT = datetime(2001, 8, 1, 10, 30)

# Fixed model parameters for the checks of formulas.
PURCHASES = {"r": 1.5, "alpha": 300.0, "a": 0.8, "b": 2.5}
BASELINE = {"r": 1.5, "alpha": 300.0, "s": 0.8, "beta": 600.0}
SPEND = {"p": 3.0, "q": 4.0, "v": 200000.0}
# Spend in these tables is a thousand times that of a shop, and so is the value band.
BAND = 250000.0
LABEL_CUTOFF = 0.8
# The training job: customers below this frequency, and a search of two batches.
JOB_CAP = 12
JOB_TRIALS = 30

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- frames shared by the queries -------------------------------------------------------------


def valid_training(spark: SparkSession, folder: str) -> DataFrame:
    daily, current = retail.valid_history(spark, folder, START, PERIOD)
    return rfm.training_snapshot(daily, current, PERIOD, DURATION)


def all_training(spark: SparkSession, folder: str) -> DataFrame:
    daily, current = retail.full_history(spark, folder, START, PERIOD)
    return rfm.training_snapshot(daily, current, PERIOD, DURATION)


def all_full(spark: SparkSession, folder: str, period: str = PERIOD) -> DataFrame:
    daily, current = retail.full_history(spark, folder, START, period)
    return rfm.full_snapshot(daily, current, period)


def two_months(spark: SparkSession, folder: str) -> str:
    """A partitioned table with the full snapshots of two months."""
    path = scratch_path(spark, "full")
    for period in (EARLIER_PERIOD, PERIOD):
        full = all_full(spark, folder, period)
        snapshots.replace_snapshot(full, path, snapshots.FULL_SCHEMA, period)
    return path


def rate_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Training customers with a plain rate forecast, to check the metrics on."""
    tenure = F.col("T_cal").cast("double")
    return all_training(spark, folder).select(
        "CustomerID",
        "frequency_holdout",
        "monetary_value_cal",
        "monetary_value_holdout",
        (F.col("frequency_cal").cast("double") / tenure * DURATION).alias("predicted"),
        (F.col("recency_cal").cast("double") / tenure).alias("score"),
        scalars.flag(F.col("frequency_holdout") > 0).alias("alive"),
    )


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    return rate_predictions(spark, folder).withColumn(
        "pred_alive", metrics.predicted_label(F.col("score"), F.lit(LABEL_CUTOFF))
    )


def purchase_events(spark: SparkSession, folder: str) -> DataFrame:
    return (
        retail.table(spark, folder, "events")
        .where("event_type = 'purchase'")
        .select(
            F.col("user_id").alias("customer_id"),
            F.col("ts").alias("sale_dt"),
            F.col("value").cast("decimal(15,2)").alias("amount"),
        )
    )


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a number of digits that both engines agree on."""
    return df.select(
        *[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def as_double(*names: str) -> list[Column]:
    return [F.col(name).cast("double").alias(name) for name in names]


# --- sources and sinks ------------------------------------------------------------------------


@query
def scan_transactions(spark, folder):
    return retail.order_lines(spark, folder).select(
        "txn_id", "customer_id", "sale_dt", *as_double("amount"), "currency", "change_code"
    )


@query
def clean_transactions(spark, folder):
    clean = retail.clean_orders(spark, folder)
    return clean.withColumn("amount", F.col("amount").cast("double"))


@query
def snapshot_schema(spark, folder):
    path = scratch_path(spark, "training")
    snapshots.create_snapshot_table(spark, path, snapshots.TRAINING_SCHEMA)
    training = valid_training(spark, folder)
    snapshots.replace_snapshot(training, path, snapshots.TRAINING_SCHEMA, PERIOD)
    stored = spark.read.parquet(path)
    counts = stored.agg(*[F.count(c).alias(c) for c in stored.columns])
    lines = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(dtype).alias("data_type"),
            F.col(name).alias("filled"),
        )
        for name, dtype in stored.dtypes
    ]
    return counts.select(F.inline(F.array(*lines)))


@query
def replace_snapshot(spark, folder):
    """Two months written, then the second replaced by its repeat buyers."""
    path = two_months(spark, folder)
    repeat = sampling.repeat_buyers(all_full(spark, folder), "frequency")
    snapshots.replace_snapshot(repeat, path, snapshots.FULL_SCHEMA, PERIOD)
    return snapshots.read_snapshots(spark, path, snapshots.FULL_SCHEMA)


@query
def period_slice(spark, folder):
    orders = retail.order_lines(spark, folder)
    sliced = features.period_slice(orders, "sale_dt", "1999-12-31", "2000-12-31")
    return sliced.select("txn_id", "customer_id", "sale_dt")


@query
def period_view(spark, folder):
    retail.order_lines(spark, folder).createOrReplaceTempView("order_lines")
    features.create_period_view(spark, "order_lines", "sale_dt", "1999-12-31", "2000-12-31")
    return spark.table("order_lines").groupBy("currency").agg(F.count("*").alias("n"))


@query
def feature_table_write(spark, folder):
    path = scratch_path(spark, "features")
    features.write_feature_table(
        all_full(spark, folder), path, ["CustomerID"], "snapshot_dt", "purchase history features"
    )
    return spark.read.parquet(path)


@query
def feature_loop(spark, folder):
    """Features written as a catalog table, found there by name, and looked up for customers."""
    table, target = f"features_{uuid.uuid4().hex}", date(2001, 7, 1)
    before = timeline.cold_start(spark, table, "snapshot_dt", target)
    features.write_feature_table(
        all_full(spark, folder), scratch_path(spark, table), ["CustomerID"], "snapshot_dt", table=table
    )
    after = timeline.cold_start(spark, table, "snapshot_dt", target)
    entities = retail.table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("CustomerID"),
        F.lit(PERIOD).cast("date").alias("snapshot_dt"),
    )
    found = lookup.feature_lookup(entities, spark.table(table), "CustomerID", "snapshot_dt")
    return found.withColumns(
        {
            "cold_before": F.lit(before),
            "cold_after": F.lit(after),
            "exists": F.lit(features.table_exists(spark, table)),
        }
    )


@query
def csv_export(spark, folder):
    full = all_full(spark, folder)
    path = exports.export_csv(full, scratch_path(spark, "csv"), "clv.customers", WRITTEN_AT)
    return spark.read.schema(full.schema).option("header", True).csv(path)


@query
def run_metadata(spark, folder):
    latest = rfm.current_day(retail.all_orders(spark, folder))
    record = latest.select(
        F.lit("AMERICA").alias("region"),
        F.lit("frequency").alias("model"),
        F.lit("models:/clv_freq_final/1").alias("model_uri"),
        F.lit("1").alias("model_version"),
        F.lit("plans/score").alias("code_path"),
        scalars.file_stamp(F.col("current_dt")).alias("inference_input_dt"),
        F.lit("c1").alias("commit_id"),
        F.lit(WRITTEN_AT.isoformat(" ")).alias("written_at"),
    )
    path = scratch_path(spark, "runs")
    exports.append_run_metadata(record, path)
    return exports.read_run_metadata(spark, path)


@query
def lineage_gap(spark, folder):
    """Regions and segments in months without an order of the top priority."""
    profiles = retail.customer_profiles(spark, folder)
    monthly = F.concat_ws("/", "channel", F.date_format("sale_dt", "yyyy-MM"))
    recorded = (
        retail.order_lines(spark, folder)
        .join(profiles, F.col("customer_id") == F.col("consumer_id"))
        .select("region", monthly.alias("model"), F.col("change_code").alias("commit_id"))
        .distinct()
    )
    path = scratch_path(spark, "runs")
    exports.append_run_metadata(recorded, path)
    expected = exports.read_run_metadata(spark, path).select("region", "model").distinct()
    return lookup.lineage_gap(expected, exports.read_run_metadata(spark, path), "1-URGENT")


@query
def model_latest(spark, folder):
    """Yearly order statistics per segment, stored as versions of a model."""
    profiles = retail.customer_profiles(spark, folder)
    yearly = (
        retail.order_lines(spark, folder)
        .join(profiles, F.col("customer_id") == F.col("consumer_id"))
        .groupBy(F.col("channel").alias("name"), F.year("sale_dt").alias("year"))
        .agg(F.count("*").cast("double").alias("orders"), F.sum("amount").cast("double").alias("spend"))
    )
    models = yearly.select(
        "name",
        (F.col("year") - 1994).cast("int").alias("version"),
        F.make_date("year", F.lit(12), F.lit(31)).cast("timestamp_ntz").alias("trained_at"),
        F.create_map(F.lit("orders"), "orders", F.lit("spend"), "spend").alias("params"),
    )
    path = scratch_path(spark, "models")
    registry.append_models(models, path)
    latest = registry.latest_models(registry.read_models(spark, path))
    return latest.select(
        "name",
        "version",
        "trained_at",
        F.col("params")["orders"].alias("orders"),
        F.col("params")["spend"].alias("spend"),
    )


@query
def metrics_log(spark, folder):
    """Forecast errors per snapshot half, logged in long form and read back as a table."""
    halves = rate_predictions(spark, folder).withColumn(
        "run_name", F.when(F.col("alive") == 1, "buyers").otherwise("others")
    )
    error = F.col("frequency_holdout") - F.col("predicted")
    wide = halves.groupBy("run_name").agg(
        F.round(F.avg(F.abs(error)), 6).alias("mae"),
        F.round(F.avg(error * error), 6).alias("mse"),
        F.count("*").cast("double").alias("rows"),
    )
    entries = wide.unpivot("run_name", ["mae", "mse", "rows"], "key", "value").select(
        "run_name", F.lit("metric").alias("kind"), "key", "value"
    )
    path = scratch_path(spark, "log")
    registry.append_log(entries, path)
    return registry.run_table(registry.read_log(spark, path), ["mae", "mse", "rows"])


# --- selection --------------------------------------------------------------------------------


@query
def txn_in_period(spark, folder):
    orders = rfm.in_period(retail.order_lines(spark, folder), START, PERIOD)
    return orders.select("txn_id", "customer_id", "sale_dt")


@query
def snapshot_slice(spark, folder):
    stored = snapshots.read_snapshots(spark, two_months(spark, folder), snapshots.FULL_SCHEMA)
    return sampling.snapshot_slice(stored, EARLIER_PERIOD)


@query
def suffix_sample(spark, folder):
    return sampling.suffix_sample(all_full(spark, folder), SUFFIXES)


@query
def training_set(spark, folder):
    return sampling.training_set(all_training(spark, folder), PERIOD, 12, SUFFIXES)


@query
def repeat_buyers(spark, folder):
    return sampling.repeat_buyers(valid_training(spark, folder))


@query
def dev_sample(spark, folder):
    return sampling.training_set(all_training(spark, folder), PERIOD, 50, sample_size=100)


@query
def clamp_nonneg(spark, folder):
    balances = retail.table(spark, folder, "customer")
    return balances.select("c_custkey", scalars.clamp_nonneg(F.col("c_acctbal")).alias("balance"))


@query
def spend_band(spark, folder):
    banded = metrics.value_band(rate_predictions(spark, folder), "monetary_value_holdout", BAND)
    return banded.select("CustomerID", "monetary_value_holdout")


@query
def inference_input(spark, folder):
    stored = snapshots.read_snapshots(spark, two_months(spark, folder), snapshots.FULL_SCHEMA)
    return sampling.inference_input(stored, "CustomerID", "snapshot_dt")


# --- joins ------------------------------------------------------------------------------------


@query
def attach_current_dt(spark, folder):
    daily, current = retail.valid_history(spark, folder, START, PERIOD)
    return rfm.attach_current_day(daily, current).select(
        "customer_id", "day", rfm.spent(daily).alias("amount"), "current_dt"
    )


@query
def first_purchase_join(spark, folder):
    orders = rfm.in_period(retail.all_orders(spark, folder), START, PERIOD)
    daily = rfm.daily_spend(orders)
    joined = rfm.attach_first_purchase(daily, rfm.first_purchase(orders))
    return joined.select("customer_id", "day", rfm.spent(daily).alias("amount"), "first_at")


@query
def calibration_holdout(spark, folder):
    history = retail.valid_history(spark, folder, START, PERIOD)
    calibration = rfm.rfm_calibration(*history, DURATION)
    return rfm.calibration_with_holdout(calibration, rfm.rfm_holdout(*history, DURATION))


@query
def feature_lookup(spark, folder):
    """The features of every customer at the later month, which a few do not have yet."""
    stored = snapshots.read_snapshots(spark, two_months(spark, folder), snapshots.FULL_SCHEMA)
    entities = retail.table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("CustomerID"),
        F.lit(PERIOD).cast("date").alias("snapshot_dt"),
    )
    return lookup.feature_lookup(entities, stored, "CustomerID", "snapshot_dt")


# --- aggregates -------------------------------------------------------------------------------


@query
def daily_spend(spark, folder):
    daily, _ = retail.valid_history(spark, folder, START, PERIOD)
    return daily.withColumn("amount", rfm.spent(daily))


@query
def daily_spend_events(spark, folder):
    daily = rfm.daily_spend(purchase_events(spark, folder))
    return daily.withColumn("amount", rfm.spent(daily))


@query
def current_dt(spark, folder):
    return retail.valid_history(spark, folder, START, PERIOD)[1]


@query
def first_purchase(spark, folder):
    return rfm.first_purchase(rfm.in_period(retail.all_orders(spark, folder), START, PERIOD))


@query
def rfm_calibration(spark, folder):
    return rfm.rfm_calibration(*retail.valid_history(spark, folder, START, PERIOD), DURATION)


@query
def rfm_holdout(spark, folder):
    return rfm.rfm_holdout(*retail.valid_history(spark, folder, START, PERIOD), DURATION)


@query
def training_snapshot(spark, folder):
    return valid_training(spark, folder)


@query
def training_snapshot_all(spark, folder):
    return all_training(spark, folder)


@query
def training_snapshot_events(spark, folder):
    bought = rfm.in_period(purchase_events(spark, folder), EVENT_PERIOD, EVENT_PERIOD)
    return rfm.training_snapshot(
        rfm.daily_spend(bought), rfm.current_day(bought), EVENT_PERIOD, EVENT_DURATION
    )


@query
def full_snapshot(spark, folder):
    return all_full(spark, folder)


@query
def repeat_spend(spark, folder):
    return rfm.repeat_spend(retail.valid_history(spark, folder, START, PERIOD)[0])


@query
def agg_col(spark, folder):
    return quality.agg_col(retail.table(spark, folder, "lineitem"), "l_quantity", F.max)


@query
def latest_ts(spark, folder):
    return quality.latest_ts(retail.table(spark, folder, "events"), "ts")


@query
def duplicate_ratio(spark, folder):
    ratio = quality.duplicate_ratio(retail.table(spark, folder, "lineitem"), "l_orderkey")
    return rounded(ratio, 9)


@query
def dedup_guarded(spark, folder):
    handler = quality.DuplicatesHandler("customer_id", threshold=0.95)
    orders = retail.order_lines(spark, folder).select(
        "customer_id", "sale_dt", "txn_id", *as_double("amount")
    )
    return handler.apply(orders)


@query
def regression_metrics(spark, folder):
    forecast = rate_predictions(spark, folder)
    return rounded(metrics.regression_metrics(forecast, "frequency_holdout", "predicted"))


@query
def mape_spenders(spark, folder):
    forecast = rate_predictions(spark, folder)
    return rounded(metrics.mape(forecast, "monetary_value_holdout", "monetary_value_cal"))


@query
def r2_band(spark, folder):
    banded = metrics.value_band(rate_predictions(spark, folder), "monetary_value_holdout", BAND)
    return rounded(metrics.r_squared(banded, "monetary_value_holdout", "monetary_value_cal"))


@query
def roc_auc(spark, folder):
    return rounded(metrics.roc_auc(rate_predictions(spark, folder), "alive", "score"), 9)


@query
def youden_cutoff(spark, folder):
    return rounded(metrics.youden_cutoff(rate_predictions(spark, folder), "alive", "score"), 9)


@query
def classification_report(spark, folder):
    report = metrics.classification_report(labelled(spark, folder), "alive", "pred_alive")
    return rounded(report, 9)


@query
def f1_score(spark, folder):
    return rounded(metrics.f1_score(labelled(spark, folder), "alive", "pred_alive"), 9)


@query
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(labelled(spark, folder), "alive", "pred_alive")


@query
def qcut_decile(spark, folder):
    cut = deciles.qcut_decile(materialise(rate_predictions(spark, folder)), "predicted")
    return cut.select("CustomerID", "decile")


@query
def decile_capture(spark, folder):
    forecast = materialise(rate_predictions(spark, folder))
    capture = deciles.decile_capture(forecast, "predicted", "frequency_holdout")
    return rounded(capture, 9)


@query
def quality_gates(spark, folder):
    """The gates on the plain rate forecast."""
    forecast = materialise(labelled(spark, folder))
    spend = metrics.regression_metrics(forecast, "monetary_value_holdout", "monetary_value_cal")
    summary = metrics.regression_metrics(forecast, "frequency_holdout", "predicted").select(
        F.col("mae").alias("frequency_mae"),
        metrics.roc_auc(forecast, "alive", "score").scalar().alias("roc_auc"),
        metrics.f1_score(forecast, "alive", "pred_alive").scalar().alias("f1_score"),
        spend.select("rmse").scalar().alias("spend_rmse"),
        forecast.agg(F.count("*").cast("double")).scalar().alias("row_count"),
    )
    return rounded(quality.quality_gates(summary), 4)


# --- ranking ----------------------------------------------------------------------------------


@query
def clv_decile(spark, folder):
    worth = all_full(spark, folder).select(
        "CustomerID", (F.col("monetary_value") * F.col("frequency")).alias("worth")
    )
    return running.ntile(materialise(worth), "worth", "CustomerID", "clv_1y_decile").select(
        "CustomerID", "clv_1y_decile"
    )


@query
def alive_decile(spark, folder):
    """Ranked by a score with heavy ties: recency as a share of tenure, to one digit."""
    share = F.round(F.col("recency") / F.nullif(F.col("T"), F.lit(0.0)), 1)
    recent = all_full(spark, folder).select("CustomerID", share.cast("double").alias("share"))
    return running.ntile(materialise(recent), "share", "CustomerID", "prob_alive_decile").select(
        "CustomerID", "prob_alive_decile"
    )


# --- scalar functions and encoding ------------------------------------------------------------


@query
def scalar_suite(spark, folder):
    orders = retail.table(spark, folder, "orders")
    day = F.to_date("o_orderdate")
    last = scalars.period_end(scalars.month_start(day))
    predictions = F.array(F.col("o_totalprice"), F.lit(None).cast("double"), F.lit(float("nan")))
    return orders.select(
        "o_orderkey",
        scalars.purchase_day("o_orderdate").alias("day"),
        last.alias("month_end"),
        F.datediff(last, day).alias("days_left"),
        scalars.month_start(day).alias("month_start"),
        F.col("o_orderkey").cast("float").alias("as_float"),
        scalars.id_suffix(F.col("o_orderpriority")).alias("suffix"),
        (F.col("o_totalprice") / F.nullif(F.col("o_orderkey") % 3, F.lit(0))).alias("guarded"),
        scalars.monthly_rate((F.col("o_orderkey") % 20) / F.lit(100.0)).alias("monthly_rate"),
        F.get(predictions, F.lit(0)).alias("first_item"),
        scalars.missing_to_zero(F.get(predictions, (F.col("o_orderkey") % 4).cast("int"))).alias("filled"),
        scalars.flag(F.col("o_totalprice") > 100000).alias("large"),
        scalars.months_before(F.col("o_orderdate"), 13).alias("earlier"),
        scalars.midnight(day).alias("midnight"),
        scalars.file_stamp(F.col("o_orderdate")).alias("stamp"),
        scalars.strip_prefix("o_orderpriority", "-").alias("stripped"),
    )


@query
def named_parameters(spark, folder):
    """A SQL template with named parameters."""
    retail.order_lines(spark, folder).createOrReplaceTempView("order_lines")
    return spark.sql(
        "SELECT customer_id, count(*) AS n FROM order_lines"
        " WHERE sale_dt BETWEEN date_sub(:last, :days) AND :last GROUP BY customer_id",
        args={"last": date(2001, 7, 31), "days": DURATION},
    )


def _priority_frames(spark, folder):
    orders = retail.table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority"
    )
    return orders.where("o_orderpriority <> '5-LOW'"), orders


@query
def one_hot_fit(spark, folder):
    known, _ = _priority_frames(spark, folder)
    kinds = {"o_orderkey": "numeric", "o_orderstatus": "categorical", "o_orderpriority": "categorical"}
    return encode.categories(known, encode.columns_of_kind(kinds, "categorical"))


@query
def one_hot(spark, folder):
    known, orders = _priority_frames(spark, folder)
    return encode.OneHot.fit(known).transform(orders)


# --- models -----------------------------------------------------------------------------------


@query
def prob_alive(spark, folder):
    full = all_full(spark, folder)
    return full.select("CustomerID", F.round(F.expr(mbg.probability_alive(PURCHASES)), 6).alias("prob_alive"))


@query
def expected_purchases(spark, folder):
    return spread(all_full(spark, folder)).select(
        "CustomerID",
        *[
            F.round(F.expr(mbg.expected_purchases(PURCHASES, days)), 6).alias(f"purch_{days}day")
            for days in clv.SCORE_HORIZONS
        ],
    )


@query
def holdout_prediction(spark, folder):
    training = materialise(all_training(spark, folder))
    predicted = evaluate.frequency_predictions(training, PURCHASES)
    return predicted.select("CustomerID", F.round("frequency_predicted", 6).alias("predicted"))


@query
def frequency_scores(spark, folder):
    scores = F.expr(clv.purchase_scores(PURCHASES))
    return spread(all_full(spark, folder)).select(
        "CustomerID",
        *[
            F.round(F.get(scores, F.lit(i)).cast("double"), 4).alias(name)
            for i, name in enumerate(("alive", "purch_30day", "purch_365day", "purch_730day"))
        ],
    )


@query
def pareto_predict(spark, folder):
    predicted = train.pareto_predictions(materialise(all_training(spark, folder)), BASELINE)
    alive = pareto.probability_alive(BASELINE, "frequency_cal", "recency_cal", "T_cal")
    return predicted.select(
        "CustomerID",
        F.round(F.expr(alive), 6).alias("prob_alive"),
        F.round("frequency_predicted", 6).alias("predicted"),
    )


@query
def expected_spend(spark, folder):
    full = all_full(spark, folder)
    return full.select("CustomerID", F.expr(gamma_gamma.expected_spend(SPEND)).alias("expected_spend"))


def _lifetime_value(spark, folder, months):
    outlook = with_purchases(
        materialise(all_full(spark, folder)),
        PURCHASES,
        horizons={},
        discounted={"purchases": (months, RATE)},
    )
    value = F.expr(gamma_gamma.expected_spend(SPEND)) * F.col("purchases")
    return outlook.select("CustomerID", F.round(value, 0).alias("clv"))


@query
def clv_12m(spark, folder):
    return _lifetime_value(spark, folder, 12)


@query
def clv_36m(spark, folder):
    return _lifetime_value(spark, folder, 36)


def _fits_frame(spark, fits):
    rows = [
        (f.l2, k, v, f.log_likelihood, f.iterations, f.stop, f.gradient, k in f.at_bound)
        for f in fits
        for k, v in f.params.items()
    ]
    return spark.createDataFrame(
        rows,
        "l2 double, parameter string, value double, log_likelihood double, iterations int,"
        " stop string, gradient double, at_bound boolean",
    )


def _likelihoods(rows, model, params):
    """The optimiser's objective at the fixed parameters and at half of them."""
    points = [[params[name] * factor for name in model.names] for factor in (1.0, 0.5)]
    values = fit.mean_log_likelihood(rows, model, points)
    return rows.sparkSession.createDataFrame(
        [(factor, round(float(value), 8)) for factor, value in zip((1.0, 0.5), values)],
        "factor double, log_likelihood double",
    )


@query
def likelihood_mbg(spark, folder):
    return _likelihoods(fit.purchase_rows(all_training(spark, folder)), fit.MBG, PURCHASES)


@query
def likelihood_pareto_nbd(spark, folder):
    return _likelihoods(fit.purchase_rows(all_training(spark, folder)), fit.PARETO, BASELINE)


@query
def likelihood_gamma_gamma(spark, folder):
    return _likelihoods(fit.spend_rows(all_training(spark, folder)), fit.GAMMA_GAMMA, SPEND)


@query
def fit_mbg(spark, folder):
    rows = fit.ready(fit.purchase_rows(all_training(spark, folder)))
    return _fits_frame(spark, fit.fit_purchases(rows, fit.MBG, [0.0, train.BASELINE_L2]))


@query
def fit_pareto_nbd(spark, folder):
    return _fits_frame(spark, [train.fit_baseline(all_training(spark, folder))])


@query
def fit_gamma_gamma(spark, folder):
    rows = fit.ready(fit.spend_rows(all_training(spark, folder)))
    return _fits_frame(spark, fit.fit(rows, fit.GAMMA_GAMMA, [0.0]))


@query
def limit_fits(spark, folder):
    """What each fit leaves behind at the limit of its model, null where its optimum is not there."""
    training = all_training(spark, folder)
    histories = fit.ready(fit.purchase_rows(training))
    fits = {
        "mbg": fit.fit_purchases(histories, fit.MBG, [train.BASELINE_L2])[0],
        "pareto_nbd": train.fit_baseline(training),
        "gamma_gamma": fit.fit(fit.ready(fit.spend_rows(training)), fit.GAMMA_GAMMA, [0.0])[0],
    }
    kept = {"mbg": ("r", "alpha"), "pareto_nbd": ("r", "alpha"), "gamma_gamma": ("p", "v")}
    rows = []
    for model, found in fits.items():
        there = found.stop == fit.AT_LIMIT
        for name in kept[model]:
            value = round(math.log(found.params[name]), 2) if there else None
            rows.append((model, name, there, value, round(found.log_likelihood, 4) if there else None))
    return spark.createDataFrame(
        rows, "model string, parameter string, at_limit boolean, ln_value double, log_likelihood double"
    )


@query
def l2_search(spark, folder):
    training = all_training(spark, folder)
    return train.frequency_trials(training, train.candidate_penalties())


@query
def l2_search_spend(spark, folder):
    training = all_training(spark, folder)
    return train.spend_trials(training, train.candidate_penalties())


@query
def final_fit(spark, folder):
    full = materialise(all_full(spark, folder))
    return _fits_frame(
        spark,
        [
            train.fit_final_frequency(full, train.BASELINE_L2),
            train.fit_final_spend(sampling.repeat_buyers(full, "frequency"), 0.0),
        ],
    )


@query
def frequency_evaluation(spark, folder):
    training = materialise(all_training(spark, folder))
    predictions = evaluate.frequency_predictions(training, PURCHASES)
    return rounded(evaluate.evaluate_frequency(predictions).summary)


@query
def monetary_evaluation(spark, folder):
    buyers = sampling.repeat_buyers(all_training(spark, folder))
    return rounded(evaluate.evaluate_spend(evaluate.spend_predictions(buyers, SPEND), BAND), 4)


@query
def monetary_evaluation_on_actuals(spark, folder):
    buyers = sampling.repeat_buyers(all_training(spark, folder))
    predictions = evaluate.spend_predictions(buyers, SPEND, holdout_inputs=True)
    return rounded(evaluate.evaluate_spend(predictions, BAND), 4)


# --- scoring ----------------------------------------------------------------------------------


@query
def udf_clv(spark, folder):
    registered.register_functions(spark, PURCHASES, SPEND, replace=True)
    spread(all_full(spark, folder)).createOrReplaceTempView("full_snapshot")
    return spark.sql(
        "SELECT CustomerID, round(clv(frequency, recency, T, monetary_value, 12, :rate), 0) AS clv"
        " FROM full_snapshot",
        args={"rate": RATE},
    )


@query
def udf_probability_alive(spark, folder):
    registered.register_functions(spark, PURCHASES, SPEND, replace=True)
    spread(all_full(spark, folder)).createOrReplaceTempView("full_snapshot")
    return spark.sql(
        """
        SELECT CustomerID, round(double(get(scores, 0)), 4) AS prob_alive,
               round(double(get(scores, 2)), 4) AS purch_1y,
               round(double(get(scores, 3)), 4) AS purch_2y
        FROM (SELECT CustomerID, probability_alive(frequency, recency, T) AS scores
              FROM full_snapshot)
        """
    )


@query
def udf_smoke(spark, folder):
    registered.register_functions(spark, PURCHASES, SPEND, replace=True)
    return rounded(exports.check_functions(spark, all_full(spark, folder), RATE), 4)


@query
def score_snapshot(spark, folder):
    return _rounded_scores(
        score.score_snapshot(materialise(all_full(spark, folder)), PURCHASES, SPEND, RATE)
    )


def _rounded_scores(scored):
    floats = ("prob_alive", "purch_1y", "purch_2y")
    return scored.select(
        "snapshot_dt",
        "CustomerID",
        "frequency",
        "recency",
        "T",
        "monetary_value",
        *[F.round(F.col(c).cast("double"), 4).alias(c) for c in floats],
        F.round("clv_1y", 0).alias("clv_1y"),
        F.round("clv_3y", 0).alias("clv_3y"),
        "clv_1y_decile",
        "prob_alive_decile",
    )


# --- the jobs ---------------------------------------------------------------------------------


@query
def prepare_job(spark, folder):
    """From raw transactions to the month's training table, read back."""
    training, full = scratch_path(spark, "training"), scratch_path(spark, "full")
    raw = retail.transaction_header(spark, folder)
    prepare.prepare(raw, retail.RULES, PERIOD, DURATION, training, full, START)
    return snapshots.read_snapshots(spark, training, snapshots.TRAINING_SCHEMA)


def monthly_history(spark: SparkSession, folder: str) -> tuple[HistoryStore, Mark]:
    """The history up to May, and June and July merged into its state."""
    store = HistoryStore(spark, scratch_path(spark, "history"), DURATION)
    for period in ("2001-05-01", EARLIER_PERIOD, PERIOD):
        orders = rfm.in_period(retail.all_orders(spark, folder), store.since(period, START), period)
        mark = store.advance(rfm.daily_spend(orders), period)
    return store, mark


@query
def training_snapshot_monthly(spark, folder):
    """The training snapshot from two monthly merges, without the history read again."""
    store, mark = monthly_history(spark, folder)
    return store.training(mark)


@query
def full_snapshot_monthly(spark, folder):
    store, mark = monthly_history(spark, folder)
    return store.full(mark)


@query
def training_job(spark, folder):
    """From the snapshot tables to saved models: the rows each was fitted on, and its version."""
    names = ("training", "full", "models", "log", "journal")
    training, full, models, log, journal = (scratch_path(spark, name) for name in names)
    snapshots.replace_snapshot(all_training(spark, folder), training, snapshots.TRAINING_SCHEMA, PERIOD)
    snapshots.replace_snapshot(all_full(spark, folder), full, snapshots.FULL_SCHEMA, PERIOD)
    train.run_training(
        spark, training, full, models, log, journal, PERIOD, WRITTEN_AT, JOB_CAP,
        trials=JOB_TRIALS, enforce_gates=False,
    )
    fitted = registry.read_log(spark, log).where(F.col("key") == train.FIT_ROWS)
    kept = registry.latest_models(registry.read_models(spark, models))
    runs = fitted.select(F.concat(F.lit("clv_"), "run_name").alias("name"), F.col("value").cast("long").alias("rows"))
    return kept.join(runs, "name").select("name", F.col("version").cast("long").alias("version"), "rows")


@query
def scoring_job(spark, folder):
    """From the month's snapshot and the saved models to the results table, read back."""
    full, results, models = (scratch_path(spark, name) for name in ("full", "results", "models"))
    snapshots.replace_snapshot(all_full(spark, folder), full, snapshots.FULL_SCHEMA, PERIOD)
    registry.save_model(spark, models, registry.FINAL_FREQUENCY_MODEL, PURCHASES, WRITTEN_AT)
    registry.save_model(spark, models, registry.FINAL_SPEND_MODEL, SPEND, WRITTEN_AT)
    score.run_scoring(spark, full, results, models, PERIOD)
    return _rounded_scores(snapshots.read_snapshots(spark, results, snapshots.RESULTS_SCHEMA))


# --- timeline ---------------------------------------------------------------------------------


@query
def timeline_of_orders(spark, folder):
    return timeline.timeline(retail.order_lines(spark, folder), "sale_dt", 12, 24)


@query
def timeline_of_events(spark, folder):
    return timeline.timeline(retail.table(spark, folder, "events"), "ts", 1, 11)


@query
def features_ready(spark, folder):
    orders = retail.order_lines(spark, folder)
    return timeline.features_ready(orders, "sale_dt", date(1995, 2, 1))


@query
def cold_start(spark, folder):
    retail.order_lines(spark, folder).createOrReplaceTempView("order_features")
    targets = [("order_features", date(1990, 1, 1)), ("order_features", date(1999, 1, 1)), ("no_such_table", date(1999, 1, 1))]
    rows = [
        (table, target, timeline.cold_start(spark, table, "sale_dt", target))
        for table, target in targets
    ]
    return spark.createDataFrame(rows, "feature_table string, target_ts date, cold_start boolean")


@query
def feature_window(spark, folder):
    times = timeline.timeline(retail.order_lines(spark, folder), "sale_dt", 12, 24)
    training = timeline.feature_window(times, 24, training=True, interactive=False, table_exists=True)
    first = timeline.feature_window(times, 24, training=False, interactive=True, table_exists=False)
    update = timeline.feature_window(times, 24, training=False, interactive=False, table_exists=True)
    return (
        training.withColumn("run", F.lit("training"))
        .unionByName(first.withColumn("run", F.lit("first interactive")))
        .unionByName(update.withColumn("run", F.lit("update")))
    )
