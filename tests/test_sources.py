from datetime import date, datetime

import pytest

from loyalspan.functions import registered
from loyalspan.session import scratch_path
from loyalspan.sources import exports, features, registry


def test_model_versions(spark):
    path = scratch_path(spark, "models")
    at = datetime(2024, 1, 1)
    assert registry.save_model(spark, path, "m", {"r": 1.0}, at) == 1
    assert registry.save_model(spark, path, "m", {"r": 2.0}, at) == 2
    assert registry.save_model(spark, path, "n", {"p": 3.0}, at) == 1
    assert registry.load_model(spark, path, "m") == {"r": 2.0}
    latest = registry.latest_models(registry.read_models(spark, path)).collect()
    assert sorted((r["name"], r["version"]) for r in latest) == [("m", 2), ("n", 1)]
    with pytest.raises(LookupError):
        registry.load_model(spark, path, "other")


def test_versions_claimed_by_others_are_passed_over(spark):
    path = scratch_path(spark, "models")
    at = datetime(2024, 1, 1)
    # Two writers that have read the same table: the second finds the number taken.
    assert registry.claim_version(spark, path, "a/b m", 1)
    assert not registry.claim_version(spark, path, "a/b m", 1)
    assert registry.save_model(spark, path, "a/b m", {"r": 1.0}, at) == 2
    assert registry.save_model(spark, path, "other", {"r": 1.0}, at) == 1
    registry.append_models(spark.createDataFrame([("a/b m", 1, at, {"r": 9.0})], registry.MODEL_SCHEMA), path)
    assert registry.load_model(spark, path, "a/b m") == {"r": 1.0}
    assert registry.read_models(spark, path).count() == 3


def test_models_at_a_limit_are_stored_as_they_are(spark):
    path = scratch_path(spark, "models")
    limit = {"p": 2.0, "q": float("inf"), "v": 20.0}
    registry.save_model(spark, path, "spend", limit, datetime(2024, 1, 1))
    assert registry.load_model(spark, path, "spend") == limit


def test_run_log(spark):
    path = scratch_path(spark, "log")
    registry.log_run(spark, path, "a", {"l2": 0.1, "model_type": "x"}, {"mae": 1.5})
    registry.log_run(spark, path, "b", {"l2": 0.2}, {})
    log = registry.read_log(spark, path)
    table = {r["run_name"]: r.asDict() for r in registry.run_table(log).collect()}
    assert table["a"] == {"run_name": "a", "l2": 0.1, "mae": 1.5}
    assert table["b"]["mae"] is None
    texts = registry.run_texts(log, ["model_type"]).collect()
    assert {r["run_name"]: r["model_type"] for r in texts} == {"a": "x", "b": None}


def test_logs_without_text_are_still_read(spark):
    path = scratch_path(spark, "log")
    old = spark.createDataFrame([("a", "metric", "mae", 1.5)], "run_name string, kind string, key string, value double")
    registry.append_log(old, path)
    registry.log_run(spark, path, "b", {"model_type": "x"}, {"mae": 2.5})
    table = registry.run_table(registry.read_log(spark, path)).collect()
    assert sorted((r["run_name"], r["mae"]) for r in table) == [("a", 1.5), ("b", 2.5)]


def test_csv_export(spark):
    df = spark.createDataFrame([("a", 1.5), ("b", 2.0)], "id string, v double").repartition(3)
    folder = scratch_path(spark, "csv")
    at = datetime(2024, 5, 6, 7, 8, 9)
    path = exports.export_csv(df, folder, "clv.results", at, single_file=True)
    assert path.endswith("/results_2024-05-06 07-08-09.csv")
    back = spark.read.option("header", True).schema("id string, v double").csv(path)
    assert sorted(map(tuple, back.collect())) == [("a", 1.5), ("b", 2.0)]
    assert len(back.inputFiles()) == 1


def test_run_metadata_round_trip(spark):
    folder = scratch_path(spark, "runs")
    row = ("r", "m", "models:/x/1", "1", "code", "2024-01-01 00:00:00", "c1", "2024-01-02 00:00:00")
    record = spark.createDataFrame([row], exports.METADATA_SCHEMA)
    exports.append_run_metadata(record, folder)
    exports.append_run_metadata(record, folder)
    assert [tuple(r) for r in exports.read_run_metadata(spark, folder).collect()] == [row, row]


def test_feature_table_keys(spark):
    df = spark.createDataFrame([("a", date(2020, 1, 1), 1.0), ("a", date(2020, 2, 1), 2.0)], "id string, ts date, f double")
    path = scratch_path(spark, "features")
    features.write_feature_table(df, path, ["id"], "ts", "notes")
    stored = spark.read.parquet(path)
    assert stored.count() == 2
    assert stored.schema["ts"].metadata["comment"] == "notes"
    with pytest.raises(ValueError, match="repeated"):
        features.write_feature_table(df.union(df), path, ["id"], "ts")


def test_period_slice_is_half_open(spark):
    days = [date(2020, 1, d) for d in (1, 2, 3, 4)]
    df = spark.createDataFrame([(d,) for d in days], "ts date")
    df.createOrReplaceTempView("days")
    kept = features.period_slice(df, "ts", "2020-01-01", "2020-01-03")
    assert [r["ts"].day for r in kept.orderBy("ts").collect()] == [2, 3]
    features.create_period_view(spark, "days", "ts", "2020-01-01", "2020-01-03")
    assert spark.table("days").count() == 2


def test_function_catalog(spark):
    registered.register_functions(
        spark, {"r": 1.0, "alpha": 10.0, "a": 0.5, "b": 2.0}, {"p": 3.0, "q": 4.0, "v": 60.0}, True
    )
    path = scratch_path(spark, "functions")
    exports.save_function_catalog(spark, path)
    names = {r["function"].split(".")[-1] for r in spark.read.parquet(path).collect()}
    assert {"clv", "probability_alive"} <= names
    customers = spark.createDataFrame(
        [(1.0, 2.0, 3.0, 4.0)], "frequency double, recency double, T double, monetary_value double"
    )
    checked = exports.check_functions(spark, customers).first()
    assert tuple(checked)[:3] == (1, 1, 1) and checked.mean_value > 0 and 0 < checked.mean_alive < 1
