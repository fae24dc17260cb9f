"""Fitted models and run metrics as append-only tables.

A version is claimed before it is written: the file system creates an empty file of its name for one
writer only. A writer that is lost after its claim leaves a gap in the numbers, never a number twice.
The claim is as strong as exclusive creation is on that file system (atomic on HDFS and the like).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODEL_SCHEMA = "name string, version int, trained_at timestamp_ntz, params map<string,double>"
# The names models are registered and runs are logged under.
BASELINE_MODEL, BASELINE_RUN = "clv_freq_pareto_simple", "freq_pareto_simple"
BEST_FREQUENCY_MODEL, BEST_FREQUENCY_RUN = "clv_freq_best", "freq_best"
FINAL_FREQUENCY_MODEL, FINAL_FREQUENCY_RUN = "clv_freq_final", "freq_final"
BEST_SPEND_MODEL, BEST_SPEND_RUN = "clv_monetary_best", "monetary_best"
FINAL_SPEND_MODEL, FINAL_SPEND_RUN = "clv_monetary_final", "monetary_final"
L2_PARAM = "l2_penalizer_coef"

MODEL_TYPE = "model_type"
BASELINE_TYPE, FREQUENCY_TYPE, SPEND_TYPE = "Pareto/NBD", "Modified BG/NBD", "Gamma-Gamma"
ERRORS = ("mae", "mse", "rmse")

# A number is kept as value, any other entry as text.
LOG_SCHEMA = "run_name string, kind string, key string, value double, text string"


def create_registry(spark: SparkSession, path: str, schema: str) -> None:
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def append_models(models: DataFrame, path: str) -> None:
    models.write.mode("append").parquet(path)


def read_models(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MODEL_SCHEMA).parquet(path)


def latest_models(models: DataFrame) -> DataFrame:
    """The highest version of each model; of two runs that took one number, the one trained later."""
    rest = F.struct("version", "trained_at", "params")
    return (
        models.groupBy("name")
        .agg(F.max_by(rest, F.struct("version", "trained_at")).alias("latest"))
        .select("name", "latest.*")
    )


def claim_version(spark: SparkSession, path: str, name: str, version: int) -> bool:
    """Whether this writer is the one that takes ``version`` of a model."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    claim = hadoop.Path(f"{path}/_claims/{quote(name, safe='')}/{version}")
    files = claim.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        files.create(claim, False).close()
    except Py4JJavaError as error:
        if files.exists(claim):
            return False
        raise error
    return True


def save_model(
    spark: SparkSession, path: str, name: str, params: Mapping[str, float], trained_at: datetime
) -> int:
    """Append the next version of a model that no other writer has claimed, and return its number."""
    create_registry(spark, path, MODEL_SCHEMA)
    same = read_models(spark, path).where(F.col("name") == name)
    version = (same.agg(F.max("version").alias("version")).first()["version"] or 0) + 1
    while not claim_version(spark, path, name, version):
        version += 1
    append_models(
        spark.createDataFrame([(name, version, trained_at, dict(params))], MODEL_SCHEMA), path
    )
    return version


def load_model(spark: SparkSession, path: str, name: str) -> dict[str, float]:
    """The parameters of the latest version of a model."""
    row = latest_models(read_models(spark, path).where(F.col("name") == name)).first()
    if row is None:
        raise LookupError(f"no model named {name}")
    return dict(row["params"])


def append_log(entries: DataFrame, path: str) -> None:
    entries.write.mode("append").parquet(path)


def log_run(
    spark: SparkSession,
    path: str,
    run_name: str,
    params: Mapping[str, float | str],
    metrics: Mapping[str, float | None],
) -> None:
    """Append a run; a metric without a value is kept as null."""
    entries = [("param", params), ("metric", metrics)]
    rows = [
        (run_name, kind, key, *((None, entry) if isinstance(entry, str) else (_number(entry), None)))
        for kind, values in entries
        for key, entry in values.items()
    ]
    append_log(spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1), path)


def _number(entry: float | None) -> float | None:
    return None if entry is None else float(entry)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All entries; text is null in logs written before it was kept."""
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def run_table(log: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row per run with a column per parameter or metric that is a number."""
    runs = log.where(F.col("text").isNull()).groupBy("run_name")
    pivoted = runs.pivot("key") if keys is None else runs.pivot("key", list(keys))
    return pivoted.agg(F.max("value"))


def run_texts(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per run with a column per parameter that is a text."""
    return log.groupBy("run_name").pivot("key", list(keys)).agg(F.max("text"))
