from datetime import date, datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from loyalspan.functions import scalars
from loyalspan.operators import encode, lookup, quality, sampling, timeline


def ids(spark, *values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "id string, v int")


def test_duplicate_ratio(spark):
    row = quality.duplicate_ratio(ids(spark, "a", "a", "b", None, None), "id").first()
    assert (row["total_rows"], row["unique_ids"]) == (5, 3)
    assert row["duplicate_ratio"] == pytest.approx(0.4)
    empty = quality.duplicate_ratio(ids(spark).where("false"), "id").first()
    assert tuple(empty) == (0, 0, 0.0)


def test_duplicates_handler_thresholds(spark):
    many = [str(i) for i in range(99)]
    at_limit = ids(spark, *many, "0")
    kept = quality.DuplicatesHandler("id", 0.0101).apply(at_limit)
    assert kept.count() == 99
    assert kept.columns == ["id", "v"]
    assert kept.where("id = '0'").first()["v"] == 0
    with pytest.raises(ValueError, match="duplicates exceed"):
        quality.DuplicatesHandler("id", 0.005).apply(at_limit)
    assert quality.DuplicatesHandler("id").apply(ids(spark).where("false")).count() == 0


def test_dedup_of_one_hot_id(spark):
    hot = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"),
        F.col("id").alias("v"),
    )
    kept = quality.DuplicatesHandler("id", 0.5).apply(hot)
    assert kept.count() == 2001
    assert kept.where("id = 'hot'").first()["v"] == 0
    assert "partial_min" in kept._jdf.queryExecution().executedPlan().toString()


def test_gates(spark):
    summary = spark.createDataFrame([(0.4, 0.7, None)], "frequency_mae double, roc_auc double, f1_score double")
    rows = {r["gate"]: r["passed"] for r in quality.quality_gates(summary).collect()}
    assert rows == {"frequency_mae": True, "roc_auc": False, "f1_score": False}
    with pytest.raises(AssertionError, match="roc_auc"):
        quality.require_gates(quality.quality_gates(summary))
    quality.require_gates(quality.quality_gates(summary, {"frequency_mae": 0.5}))


def test_one_hot_matches_pandas(spark):
    train = pd.DataFrame({"n": [1, 2, 3], "c": ["x", "y", "x"], "d": ["p", "p", "q"]})
    test = pd.DataFrame({"n": [4, 5, 6], "c": ["y", "new", None], "d": ["p", "q", "other"]})
    encoder = encode.OneHot.fit(spark.createDataFrame(train))
    expected = pd.get_dummies(train, columns=["c", "d"]).columns
    assert encoder.columns == list(expected)
    ours = encoder.transform(spark.createDataFrame(test)).orderBy("n").toPandas()
    theirs = pd.get_dummies(test, columns=["c", "d"]).reindex(columns=expected, fill_value=0)
    assert (ours.astype(int).values == theirs.astype(int).values).all()
    with pytest.raises(ValueError, match="categories"):
        encode.OneHot.fit(spark.createDataFrame(train), max_columns=3)


def test_one_hot_of_a_missing_column(spark):
    encoder = encode.OneHot.fit(ids(spark, "a", "b"))
    row = encoder.transform(spark.createDataFrame([(7,)], "v int")).first()
    assert row.asDict() == {"v": 7, "id_a": 0, "id_b": 0}


def test_columns_of_kind():
    kinds = {"a": "numeric", "b": "categorical", "c": "numeric"}
    assert encode.columns_of_kind(kinds, "numeric") == ["a", "c"]


def test_timeline_clamps_to_month_ends(spark):
    df = spark.createDataFrame([(date(2024, 3, 31),), (date(2023, 1, 1),)], "ts date")
    row = timeline.timeline(df, "ts", 1, 12).first()
    assert tuple(row) == (datetime(2024, 3, 31), datetime(2024, 2, 29), datetime(2023, 2, 28))
    timed = spark.createDataFrame([(datetime(2024, 3, 31, 13, 5),)], "ts timestamp_ntz")
    assert timeline.timeline(timed, "ts", 1, 1).first()[1] == datetime(2024, 2, 29, 13, 5)


def test_cold_start(spark):
    df = spark.createDataFrame([("a", date(2020, 5, 1))], "id string, ts date")
    df.createOrReplaceTempView("some_features")
    df.where("false").createOrReplaceTempView("no_features")
    assert not timeline.cold_start(spark, "some_features", "ts", date(2020, 5, 1))
    assert timeline.cold_start(spark, "some_features", "ts", date(2020, 4, 30))
    assert timeline.cold_start(spark, "no_features", "ts", date(2020, 5, 1))
    assert timeline.cold_start(spark, "missing_features", "ts", date(2020, 5, 1))


def test_feature_window_conditions(spark):
    df = spark.createDataFrame([(date(2024, 6, 30),)], "ts date")
    times = timeline.timeline(df, "ts", 3, 6)

    def window(**flags):
        return tuple(timeline.feature_window(times, 6, **flags).first())

    training_end = (datetime(2023, 9, 30), datetime(2024, 3, 30))
    latest = (datetime(2023, 12, 30), datetime(2024, 6, 30))
    assert window(training=True, interactive=False, table_exists=True) == training_end
    assert window(training=False, interactive=True, table_exists=False) == training_end
    assert window(training=False, interactive=True, table_exists=True) == latest
    assert window(training=False, interactive=False, table_exists=False) == latest
    with pytest.raises(ValueError):
        window(training=True, interactive=True, table_exists=True)


def test_inference_input_and_lookup(spark):
    features = spark.createDataFrame(
        [("a", date(2020, 1, 1), 1.0), ("a", date(2020, 2, 1), 2.0), ("b", date(2020, 2, 1), 3.0)],
        "id string, ts date, f double",
    )
    entities = sampling.inference_input(features, "id", "ts")
    assert sorted(map(tuple, entities.collect())) == [("a", date(2020, 2, 1)), ("b", date(2020, 2, 1))]
    wanted = spark.createDataFrame([("a", date(2020, 1, 1)), ("b", date(2020, 1, 1))], "id string, ts date")
    found = {r["id"]: r["f"] for r in lookup.feature_lookup(wanted, features, "id", "ts").collect()}
    assert found == {"a": 1.0, "b": None}


def test_lineage_gap(spark):
    schema = "region string, model string"
    expected = spark.createDataFrame([("r", "f"), ("r", "m")], schema)
    recorded = spark.createDataFrame([("r", "f", "c1"), ("r", "m", "c0")], schema + ", commit_id string")
    gap = lookup.lineage_gap(expected, recorded, "c1")
    assert [tuple(r) for r in gap.collect()] == [("r", "m")]
    with pytest.raises(ValueError, match="c1"):
        lookup.require_lineage(gap, "c1")
    lookup.require_lineage(gap.where("false"), "c1")


def test_training_set_options(spark):
    rows = [(date(2020, 1, 1), f"{i:03d}", float(i)) for i in range(100)]
    table = spark.createDataFrame(rows, "snapshot_dt date, CustomerID string, frequency_cal float")
    assert sampling.training_set(table, "2020-01-01", 50).count() == 50
    assert sampling.training_set(table, "2020-02-01", 50).count() == 0
    picked = sampling.training_set(table, "2020-01-01", 50, ("11", "12"), sample_size=1)
    assert [r["CustomerID"] for r in picked.collect()] == ["011"]
    with pytest.raises(ValueError):
        sampling.suffix_sample(table, ("1", "12"))


def test_scalars(spark):
    df = spark.createDataFrame(
        [("db.table.x", -1.0), ("plain", float("nan")), (None, None)], "name string, v double"
    )
    rows = df.select(
        scalars.strip_prefix("name").alias("name"),
        scalars.clamp_nonneg(F.col("v")).alias("clamped"),
        scalars.missing_to_zero(F.col("v")).alias("filled"),
        scalars.nan_to_null(F.col("v")).alias("nulled"),
    ).collect()
    assert [r["name"] for r in rows] == ["table.x", "plain", None]
    assert rows[0]["clamped"] == 0.0 and rows[1]["clamped"] != rows[1]["clamped"]
    assert rows[2]["clamped"] is None
    assert [r["filled"] for r in rows] == [-1.0, 0.0, 0.0]
    assert [r["nulled"] for r in rows] == [-1.0, None, None]
    assert scalars.monthly_rate_of(0.09) == 0.007207
    rate = spark.range(1).select(scalars.monthly_rate(F.lit(0.09))).first()[0]
    assert rate == 0.007207
