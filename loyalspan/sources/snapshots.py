"""Monthly snapshot tables: fixed schemas and replacement of one month at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PARTITION = "snapshot_dt"

# The column names, order and types of the three tables.
TRAINING_SCHEMA = """
    snapshot_dt date, CustomerID string, frequency_cal float, recency_cal float, T_cal float,
    monetary_value_cal double, frequency_holdout double, monetary_value_holdout double,
    duration_holdout float
"""
FULL_SCHEMA = """
    snapshot_dt date, CustomerID string, frequency float, recency float, T float,
    monetary_value double
"""
RESULTS_SCHEMA = """
    snapshot_dt date, CustomerID string, frequency float, recency float, T float,
    monetary_value double, prob_alive float, purch_1y float, purch_2y float, clv_1y double,
    clv_3y double, clv_1y_decile int, prob_alive_decile int
"""


def conform(df: DataFrame, schema: str) -> DataFrame:
    """The declared columns in the declared order and types."""
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema)]
    )


def create_snapshot_table(spark: SparkSession, path: str, schema: str) -> None:
    """Create an empty partitioned table unless there is one."""
    empty = spark.createDataFrame([], StructType.fromDDL(schema))
    empty.write.mode("ignore").partitionBy(PARTITION).parquet(path)


def read_snapshots(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(StructType.fromDDL(schema)).parquet(path)


def replace_snapshot(df: DataFrame, path: str, schema: str, period: str) -> int:
    """Replace exactly the snapshot ``period`` and return the rows written.

    Other months are untouched. A row of another month fails the write before anything is
    replaced, and an empty batch empties the month.
    """
    month = F.lit(period).cast("date")
    checked = F.when(F.col(PARTITION) == month, F.col(PARTITION)).otherwise(
        F.raise_error(F.concat(F.lit(f"row outside snapshot {period}: "), F.coalesce(F.col(PARTITION).cast("string"), F.lit("null")))).cast("date")
    )
    rows = conform(df, schema).withColumn(PARTITION, checked)
    written = Observation()
    (
        rows.observe(written, F.count(F.lit(1)).alias("rows"))
        .sortWithinPartitions(PARTITION, "CustomerID")  # the write's own order comes first
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION)
        .parquet(path)
    )
    count = written.get["rows"]
    if count == 0:
        # Dynamic overwrite leaves a month alone when no row names it.
        empty = df.sparkSession.createDataFrame([], StructType.fromDDL(schema)).drop(PARTITION)
        empty.write.mode("overwrite").parquet(f"{path}/{PARTITION}={period}")
    return count
