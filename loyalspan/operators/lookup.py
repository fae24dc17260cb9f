"""Joins between entities and their feature or metadata rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def feature_lookup(entities: DataFrame, features: DataFrame, key: str, ts: str) -> DataFrame:
    """The features of each (id, timestamp), null where that exact moment has none."""
    return entities.join(features, [key, ts], "left")


def lineage_gap(
    expected: DataFrame, metadata: DataFrame, commit_id: str, keys: Sequence[str] = ("region", "model")
) -> DataFrame:
    """Expected models without a metadata record of the wanted commit."""
    recorded = metadata.where(F.col("commit_id") == commit_id)
    return expected.join(recorded, list(keys), "left_anti")


def require_lineage(gap: DataFrame, commit_id: str) -> None:
    missing = gap.first()
    if missing is not None:
        raise ValueError(f"no record of commit {commit_id} for {missing.asDict()}")
