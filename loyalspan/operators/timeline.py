"""The month-based timeline of an incremental feature load."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalspan.functions.scalars import midnight, months_before


def timeline(df: DataFrame, ts: str, targets_months: int, features_months: int) -> DataFrame:
    """One row: the latest transaction, and the end and start of the training period."""
    return (
        df.agg(midnight(F.max(ts)).alias("latest_txn_ts"))
        .withColumn("training_end_ts", months_before(F.col("latest_txn_ts"), targets_months))
        .withColumn("training_start_ts", months_before(F.col("training_end_ts"), features_months))
    )


def features_ready(features: DataFrame, ts: str, target_ts: date | datetime) -> DataFrame:
    """One row: whether the table has features from the target time or before."""
    earliest = midnight(F.min(ts))
    ready = earliest <= midnight(F.lit(target_ts))
    return features.agg(F.coalesce(ready, F.lit(False)).alias("features_ready"))


def cold_start(spark: SparkSession, table: str, ts: str, target_ts: date | datetime) -> bool:
    """True unless the feature table exists and already holds features for the target."""
    if not spark.catalog.tableExists(table):
        return True
    return not features_ready(spark.table(table), ts, target_ts).first()["features_ready"]


def feature_window(
    times: DataFrame,
    features_months: int,
    training: bool,
    interactive: bool,
    table_exists: bool,
) -> DataFrame:
    """One row: start and end of the period to compute features for.

    Training runs, and first interactive runs, stop where targets can still be observed; all
    other runs go up to the latest transaction.
    """
    if training and interactive:
        raise ValueError("a training run cannot be interactive")
    at_training_end = training or (interactive and not table_exists)
    end = F.col("training_end_ts" if at_training_end else "latest_txn_ts")
    return times.select(
        months_before(end, features_months).alias("eval_period_start"),
        end.alias("eval_period_end"),
    )
