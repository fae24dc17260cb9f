"""Exports of scored customers and the record of each run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

METADATA_SCHEMA = """
    region string, model string, model_uri string, model_version string, code_path string,
    inference_input_dt string, commit_id string, written_at string
"""


def short_name(table: str) -> str:
    """A table name without its database."""
    return table.split(".", 1)[-1]


def export_csv(
    df: DataFrame,
    folder: str,
    table: str,
    written_at: datetime,
    single_file: bool = False,
    stamp: str = "%Y-%m-%d %H-%M-%S",
) -> str:
    """Write ``<folder>/<table>_<timestamp>.csv`` with a header and return that path.

    The result is a directory of part files. ``single_file`` sends everything through one task,
    for small hand-overs only. Colons are not allowed in distributed file systems, hence the
    dashes in the time.
    """
    path = f"{folder}/{short_name(table)}_{written_at.strftime(stamp)}.csv"
    rows = df.coalesce(1) if single_file else df
    rows.write.mode("overwrite").option("header", True).csv(path)
    return path


def append_run_metadata(metadata: DataFrame, folder: str) -> None:
    """Append run records (see ``METADATA_SCHEMA``) as JSON lines."""
    metadata.write.mode("append").json(folder)


def read_run_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(METADATA_SCHEMA).json(folder)


def function_catalog(spark: SparkSession) -> DataFrame:
    """The functions a user has registered in this session."""
    return spark.sql("SHOW USER FUNCTIONS")


def save_function_catalog(spark: SparkSession, path: str) -> None:
    function_catalog(spark).write.mode("overwrite").parquet(path)


def check_functions(spark: SparkSession, customers: DataFrame, rate: float = 0.0072) -> DataFrame:
    """Run the registered scoring functions: one row with usable results and their means."""
    scored = customers.select(
        F.call_function(
            "clv",
            *[F.col(c).cast("double") for c in ("frequency", "recency", "T", "monetary_value")],
            F.lit(12),
            F.lit(rate),
        ).alias("value"),
        F.call_function(
            "probability_alive", *[F.col(c).cast("double") for c in ("frequency", "recency", "T")]
        ).alias("scores"),
    )
    alive = F.get("scores", F.lit(0))
    return scored.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count(F.when(F.col("value") >= 0, 1)).alias("usable_values"),
        F.count(F.when((alive > 0) & (alive <= 1), 1)).alias("usable_scores"),
        F.avg("value").alias("mean_value"),
        F.avg(alive.cast("double")).alias("mean_alive"),
    )
