"""Feature tables and period slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalspan.session import materialise


def period_slice(df: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    """Rows after ``start`` and up to and including ``end``."""
    return df.where((F.col(ts) > F.lit(start)) & (F.col(ts) <= F.lit(end)))


def create_period_view(spark: SparkSession, source: str, ts: str, start: str, end: str) -> None:
    """Slice the table or view ``source`` into a temp view under its short name."""
    sliced = spark.sql(
        "SELECT * FROM IDENTIFIER(:source)"
        " WHERE IDENTIFIER(:ts) > :start AND IDENTIFIER(:ts) <= :end",
        args={"source": source, "ts": ts, "start": start, "end": end},
    )
    sliced.createOrReplaceTempView(source.split(".")[-1])


def write_feature_table(
    df: DataFrame, path: str, keys: Sequence[str], ts: str, description: str = "", table: str = ""
) -> None:
    """Overwrite a feature table after checking that (keys, timestamp) is unique.

    The input is worked out once: what is checked is what is written. With ``table`` the folder is
    also a table of the catalog, where later runs find it by name.
    """
    df = materialise(df)
    repeated = df.groupBy(*keys, ts).count().where("count > 1").first()
    if repeated is not None:
        raise ValueError(f"repeated feature key: {repeated.asDict()}")
    described = df
    if description:
        metadata = {**df.schema[ts].metadata, "comment": description}
        described = df.withMetadata(ts, metadata)
    described.write.mode("overwrite").parquet(path)
    if table and not table_exists(df.sparkSession, table):
        df.sparkSession.catalog.createTable(table, path=path, source="parquet", schema=described.schema)
    elif table:
        df.sparkSession.catalog.refreshTable(table)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)
