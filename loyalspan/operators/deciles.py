"""Quantile bins and the share of actual value they capture."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loyalspan.operators.running import quantiles


def qcut_decile(df: DataFrame, value: str, out: str = "decile", bins: int = 10) -> DataFrame:
    """``bins`` minus the quantile bin of ``value``, highest values first.

    Bins are closed on the right and equal edges are merged, so with heavy ties there are fewer
    bins, numbered down from ``bins``. Null and NaN get no bin. ``df`` is read twice, so a costly
    one should be materialised.
    """
    edges = quantiles(df, value, [i / bins for i in range(bins + 1)])
    distinct = sorted({edge for edge in edges if edge is not None})
    below = sum((F.when(F.col(value) > edge, 1).otherwise(0) for edge in distinct), F.lit(0))
    known = F.col(value).isNotNull() & ~F.isnan(value)
    return df.withColumn(out, F.when(known, bins - F.greatest(below - 1, F.lit(0))))


def decile_capture(df: DataFrame, predicted: str, actual: str, bins: int = 10) -> DataFrame:
    """Share of all ``actual`` value held by each decile of ``predicted`` and those above it."""
    per_decile = (
        qcut_decile(df, predicted, bins=bins)
        .where(F.col("decile").isNotNull())
        .groupBy("decile")
        .agg(F.sum(actual).alias("actual"))
    )
    ordered = Window.orderBy("decile")  # at most ``bins`` rows
    upto = F.sum("actual").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    everything = F.sum("actual").over(
        ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    ratio = upto / F.nullif(everything, F.lit(0.0))
    return per_decile.select("decile", ratio.alias("ratio_cum_actual_to_total"))
