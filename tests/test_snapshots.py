from datetime import date

import pytest

from loyalspan.session import scratch_path
from loyalspan.sources import snapshots as sn


def rows(spark, month, *ids):
    data = [(date.fromisoformat(month), i, 1.0, 2.0, 3.0, 4.0) for i in ids]
    return spark.createDataFrame(data, sn.FULL_SCHEMA)


def stored(spark, path):
    table = sn.read_snapshots(spark, path, sn.FULL_SCHEMA)
    return sorted((str(r["snapshot_dt"]), r["CustomerID"]) for r in table.collect())


def test_replaces_one_month_only(spark):
    path = scratch_path(spark, "t")
    sn.create_snapshot_table(spark, path, sn.FULL_SCHEMA)
    assert stored(spark, path) == []
    assert sn.replace_snapshot(rows(spark, "2020-01-01", "a", "b"), path, sn.FULL_SCHEMA, "2020-01-01") == 2
    sn.replace_snapshot(rows(spark, "2020-02-01", "a"), path, sn.FULL_SCHEMA, "2020-02-01")
    sn.replace_snapshot(rows(spark, "2020-02-01", "c"), path, sn.FULL_SCHEMA, "2020-02-01")
    assert stored(spark, path) == [("2020-01-01", "a"), ("2020-01-01", "b"), ("2020-02-01", "c")]


def test_empty_batch_empties_the_month(spark):
    path = scratch_path(spark, "t")
    for month in ("2020-01-01", "2020-02-01"):
        sn.replace_snapshot(rows(spark, month, "a"), path, sn.FULL_SCHEMA, month)
    assert sn.replace_snapshot(rows(spark, "2020-02-01"), path, sn.FULL_SCHEMA, "2020-02-01") == 0
    assert stored(spark, path) == [("2020-01-01", "a")]


def test_foreign_rows_fail_and_change_nothing(spark):
    path = scratch_path(spark, "t")
    sn.replace_snapshot(rows(spark, "2020-01-01", "a"), path, sn.FULL_SCHEMA, "2020-01-01")
    mixed = rows(spark, "2020-01-01", "b").union(rows(spark, "2020-02-01", "b"))
    with pytest.raises(Exception, match="row outside snapshot"):
        sn.replace_snapshot(mixed, path, sn.FULL_SCHEMA, "2020-01-01")
    assert stored(spark, path) == [("2020-01-01", "a")]


def test_slice_reads_one_partition(spark):
    from loyalspan.operators.sampling import snapshot_slice

    path = scratch_path(spark, "t")
    sn.replace_snapshot(rows(spark, "2020-01-01", "a"), path, sn.FULL_SCHEMA, "2020-01-01")
    table = sn.read_snapshots(spark, path, sn.FULL_SCHEMA)
    plan = snapshot_slice(table, "2020-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_dt" in plan


def test_written_files_are_sorted_by_customer(spark, tmp_path):
    rows = [("2024-01-01", str(i * 7919 % 1000), 1.0, 1.0, 1.0, 1.0) for i in range(1000)]
    frame = spark.createDataFrame(rows, "d string, CustomerID string, frequency double, recency double, T double, monetary_value double")
    frame = frame.withColumn("snapshot_dt", frame.d.cast("date")).repartition(3)
    path = str(tmp_path / "sorted")
    sn.replace_snapshot(frame, path, sn.FULL_SCHEMA, "2024-01-01")
    files = sorted((tmp_path / "sorted").rglob("*.parquet"))
    assert files
    for file in files:
        ids = [r.CustomerID for r in spark.read.parquet(str(file)).collect()]
        assert ids == sorted(ids)
