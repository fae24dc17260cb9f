"""One-hot encoding with the columns fixed at fit time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def columns_of_kind(feature_types: Mapping[str, str], kind: str) -> list[str]:
    """Feature names of one kind ("categorical", "numeric", ...), in their given order."""
    return [name for name, declared in feature_types.items() if declared == kind]


def categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct non-null values of each column: (column, value), from one scan."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return df.select(F.inline(pairs)).where("value IS NOT NULL").distinct()


@dataclass(frozen=True)
class OneHot:
    """``<column>_<value>`` indicator columns in the order seen at fit time."""

    kept: tuple[str, ...]
    values: tuple[tuple[str, str], ...]

    @classmethod
    def fit(
        cls, df: DataFrame, columns: Sequence[str] | None = None, max_columns: int = 10_000
    ) -> "OneHot":
        """Learn the categories; string columns by default.

        Every category becomes a column, so a dictionary too large for a schema is an error.
        """
        if columns is None:
            columns = [name for name, dtype in df.dtypes if dtype == "string"]
        kept = tuple(c for c in df.columns if c not in columns)
        if not columns:
            return cls(kept, ())
        found = categories(df, columns).limit(max_columns + 1).collect()
        if len(found) > max_columns:
            raise ValueError(f"more than {max_columns} categories in {list(columns)}")
        order = {c: i for i, c in enumerate(columns)}
        pairs = sorted(((r["column"], r["value"]) for r in found), key=lambda p: (order[p[0]], p[1]))
        return cls(kept, tuple(pairs))

    @property
    def columns(self) -> list[str]:
        return [*self.kept, *[f"{column}_{value}" for column, value in self.values]]

    def transform(self, df: DataFrame) -> DataFrame:
        """Indicators for known values; unseen values and nulls are 0 everywhere."""
        present = set(df.columns)
        kept = [F.col(c) if c in present else F.lit(0).alias(c) for c in self.kept]
        indicators = [
            (
                F.coalesce((F.col(column).cast("string") == value).cast("int"), F.lit(0))
                if column in present
                else F.lit(0)
            ).alias(f"{column}_{value}")
            for column, value in self.values
        ]
        return df.select(*kept, *indicators)
