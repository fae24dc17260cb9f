"""Row selection: snapshot slices, id-suffix samples, training extracts, scoring lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalspan.functions.scalars import id_suffix

NO_LIMIT = -1


def snapshot_slice(snapshots: DataFrame, period: str) -> DataFrame:
    """One snapshot; on a table partitioned by ``snapshot_dt`` only that partition is read."""
    return snapshots.where(F.col("snapshot_dt") == F.lit(period).cast("date"))


def suffix_sample(df: DataFrame, suffixes: Sequence[str], key: str = "CustomerID") -> DataFrame:
    """The customers whose id ends in one of ``suffixes`` (all of one width)."""
    widths = {len(suffix) for suffix in suffixes}
    if len(widths) != 1:
        raise ValueError("suffixes must be given, and all of one width")
    return df.where(id_suffix(key, widths.pop()).isin(list(suffixes)))


def below_frequency(df: DataFrame, cap: int, frequency: str = "frequency_cal") -> DataFrame:
    return df.where(F.col(frequency) < cap)


def repeat_buyers(df: DataFrame, frequency: str = "frequency_cal") -> DataFrame:
    return df.where(F.col(frequency) > 0)


def dev_sample(df: DataFrame, size: int, key: str = "CustomerID") -> DataFrame:
    """The first ``size`` rows by id, so that repeated runs agree; -1 keeps every row."""
    return df if size == NO_LIMIT else df.orderBy(key).limit(size)


def training_set(
    snapshots: DataFrame,
    period: str,
    cap: int,
    suffixes: Sequence[str] | None = None,
    sample_size: int = NO_LIMIT,
    frequency: str = "frequency_cal",
) -> DataFrame:
    """The rows a model is fitted on: one snapshot, an id sample and a frequency cap."""
    rows = below_frequency(snapshot_slice(snapshots, period), cap, frequency)
    if suffixes is not None:
        rows = suffix_sample(rows, suffixes)
    return dev_sample(rows, sample_size)


def inference_input(features: DataFrame, key: str, ts: str) -> DataFrame:
    """The ids present at the latest timestamp of a feature table, with that timestamp."""
    latest = features.agg(F.max(ts).alias("latest"))
    return features.where(F.col(ts) == latest.scalar()).select(key, ts)
