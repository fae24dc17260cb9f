"""Batch scoring: chance of being alive, expected purchases, lifetime value and deciles."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalspan.functions import gamma_gamma, mbg
from loyalspan.functions.scalars import clamp_nonneg, monthly_rate_of, nan_to_null
from loyalspan.operators.outlook import with_purchases
from loyalspan.operators.running import ntile
from loyalspan.operators.sampling import snapshot_slice
from loyalspan.session import materialise
from loyalspan.sources.exports import export_csv
from loyalspan.sources.registry import FINAL_FREQUENCY_MODEL, FINAL_SPEND_MODEL, load_model
from loyalspan.sources.snapshots import (
    FULL_SCHEMA,
    RESULTS_SCHEMA,
    conform,
    create_snapshot_table,
    read_snapshots,
    replace_snapshot,
)


def score_customers(
    customers: DataFrame,
    purchase_model: mbg.Params,
    spend_model: gamma_gamma.Params,
    rate: float,
) -> DataFrame:
    """Scores per customer of a full snapshot; ``rate`` is the monthly discount rate."""
    outlook = with_purchases(
        customers,
        purchase_model,
        horizons={"purch_1y": 365, "purch_2y": 730},
        discounted={"discounted_1y": (12, rate), "discounted_3y": (36, rate)},
    )
    spend = F.expr(gamma_gamma.expected_spend(spend_model, "cast(frequency as double)"))
    return outlook.select(
        *customers.columns,
        nan_to_null(F.col("alive").cast("float")).alias("prob_alive"),
        F.col("purch_1y").cast("float").alias("purch_1y"),
        F.col("purch_2y").cast("float").alias("purch_2y"),
        nan_to_null(clamp_nonneg(spend * F.col("discounted_1y"))).alias("clv_1y"),
        nan_to_null(clamp_nonneg(spend * F.col("discounted_3y"))).alias("clv_3y"),
    )


def score_snapshot(
    customers: DataFrame,
    purchase_model: mbg.Params,
    spend_model: gamma_gamma.Params,
    rate: float,
    buckets: int = 10,
) -> DataFrame:
    """The scored snapshot with deciles by value and by chance of being alive.

    Ties are broken by id, and customers without a score rank last.
    """
    scored = materialise(score_customers(customers, purchase_model, spend_model, rate))
    by_value = ntile(scored, "clv_1y", "CustomerID", "clv_1y_decile", buckets)
    by_alive = ntile(by_value, "prob_alive", "CustomerID", "prob_alive_decile", buckets)
    return conform(by_alive, RESULTS_SCHEMA)


def run_scoring(
    spark: SparkSession,
    full_path: str,
    results_path: str,
    model_path: str,
    period: str,
    annual_rate: float = 0.09,
    export_folder: str | None = None,
    table: str = "clv.results",
    written_at: datetime | None = None,
) -> int:
    """Score one month with the latest final models and replace it in the results table."""
    customers = snapshot_slice(read_snapshots(spark, full_path, FULL_SCHEMA), period)
    results = score_snapshot(
        customers,
        load_model(spark, model_path, FINAL_FREQUENCY_MODEL),
        load_model(spark, model_path, FINAL_SPEND_MODEL),
        monthly_rate_of(annual_rate),
    )
    create_snapshot_table(spark, results_path, RESULTS_SCHEMA)
    rows = replace_snapshot(results, results_path, RESULTS_SCHEMA, period)
    if export_folder is not None:
        month = snapshot_slice(read_snapshots(spark, results_path, RESULTS_SCHEMA), period)
        export_csv(month, export_folder, table, written_at or datetime.now())
    return rows
