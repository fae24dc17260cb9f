"""Column aggregates, duplicate handling and quality gates."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The thresholds a run has to pass.
THRESHOLDS = {
    "row_count": 300000.0,
    "frequency_mae": 0.5,
    "captured_by_third_decile": 0.8,
    "roc_auc": 0.80,
    "f1_score": 0.40,
    "spend_rmse": 20.0,
    "spend_r2": 0.70,
}
UPPER_BOUNDS = ("frequency_mae", "spend_rmse")


def agg_col(df: DataFrame, column: str, func: Callable[[Column], Column]) -> DataFrame:
    """One row, ``agg_col``: any aggregate of one column."""
    return df.agg(func(F.col(column)).alias("agg_col"))


def latest_ts(df: DataFrame, ts: str) -> DataFrame:
    return agg_col(df, ts, F.max)


def duplicate_ratio(df: DataFrame, key: str) -> DataFrame:
    """Share of rows beyond the first of their id. Null ids count as one id; 0 when empty."""
    ids = F.countDistinct(key) + F.max(F.col(key).isNull().cast("int"))
    rows = F.count(F.lit(1))
    ratio = 1 - ids.cast("double") / F.nullif(rows, F.lit(0))
    return df.agg(
        rows.alias("total_rows"),
        F.coalesce(ids, F.lit(0)).cast("long").alias("unique_ids"),
        F.coalesce(ratio, F.lit(0.0)).alias("duplicate_ratio"),
    )


class DuplicatesHandler:
    """Drops repeated ids, or refuses to if there are too many of them."""

    def __init__(self, key: str, threshold: float = 0.01):
        self.key = key
        self.threshold = threshold

    def check(self, df: DataFrame) -> None:
        row = duplicate_ratio(df, self.key).first()
        if row["duplicate_ratio"] > self.threshold:
            raise ValueError(
                f"duplicates exceed {self.threshold}: "
                f"{row['total_rows']} rows, {row['unique_ids']} ids"
            )

    def apply(self, df: DataFrame) -> DataFrame:
        """One row per id: the smallest by its other columns, in column order.

        A minimum is combined before the shuffle, so one heavily repeated id stays cheap.
        """
        self.check(df)
        rest = [c for c in df.columns if c != self.key]
        if not rest:
            return df.distinct()
        kept = df.groupBy(self.key).agg(F.min(F.struct(*rest)).alias("_kept"))
        return kept.select(
            *[F.col(self.key) if c == self.key else F.col(f"_kept.{c}").alias(c) for c in df.columns]
        )


def quality_gates(metrics: DataFrame, thresholds: Mapping[str, float] = THRESHOLDS) -> DataFrame:
    """Each metric of a one-row frame against its threshold: (gate, value, threshold, passed)."""
    gates = [
        F.struct(
            F.lit(gate).alias("gate"),
            F.col(gate).cast("double").alias("value"),
            F.lit(float(limit)).alias("threshold"),
            F.coalesce(
                F.col(gate) < limit if gate in UPPER_BOUNDS else F.col(gate) > limit, F.lit(False)
            ).alias("passed"),
        )
        for gate, limit in thresholds.items()
        if gate in metrics.columns
    ]
    return metrics.select(F.inline(F.array(*gates)))


def require_gates(gates: DataFrame) -> None:
    """Raise if any gate failed."""
    failed = gates.where(~F.col("passed")).collect()
    if failed:
        raise AssertionError(
            "; ".join(f"{g['gate']}={g['value']} against {g['threshold']}" for g in failed)
        )
