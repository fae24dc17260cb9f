"""The transaction header table and its cleaning rules."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns of a cleaned transaction.
CLEAN_COLUMNS = (
    "customer_id",
    "consumer_id",
    "brand_id",
    "sale_dt",
    "txn_id",
    "amount",
    "currency",
    "channel",
)


@dataclass(frozen=True)
class CleaningRules:
    """What a transaction has to look like to count.

    A comparison with a null column is never true, so rows with a null change code are dropped.
    """

    region: str
    currencies: tuple[str, ...] = ("USD", "CAD")
    deleted_code: str = "D"
    names: Mapping[str, str] = field(default_factory=dict)

    def predicates(self) -> dict[str, Column]:
        """One condition per column the rules look at."""
        return {
            "region": F.col("region") == self.region,
            "customer_id": F.col("customer_id").isNotNull(),
            "consumer_id": F.col("consumer_id").isNotNull(),
            "valid_ind": F.col("valid_ind") == 1,
            "consumer_valid_flag": F.col("consumer_valid_flag") == "Y",
            "trade_flag": F.col("trade_flag") == "N",
            "amount": F.col("amount") > 0,
            "currency": F.col("currency").isin(list(self.currencies)),
            "visit_ind": F.col("visit_ind") == 1,
            "change_code": F.col("change_code") != self.deleted_code,
        }

    def where(self, df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
        """Keep the rows that satisfy the rules, or only those on ``columns``."""
        predicates = self.predicates()
        for name in predicates if columns is None else columns:
            df = df.where(predicates[name])
        return df


def scan_transactions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def clean_transactions(raw: DataFrame, rules: CleaningRules) -> DataFrame:
    """Valid transactions with the eight columns later steps use.

    ``rules.names`` maps our column names to those of ``raw`` where they differ.
    """
    renamed = raw.withColumnsRenamed({theirs: ours for ours, theirs in rules.names.items()})
    return rules.where(renamed).select(*CLEAN_COLUMNS)


def create_clean_view(raw: DataFrame, rules: CleaningRules, name: str) -> None:
    clean_transactions(raw, rules).createOrReplaceTempView(name)
