import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from loyalspan.operators import deciles, running

RNG = np.random.default_rng(3)


@pytest.fixture(scope="module")
def tied(spark):
    """A third of all scores equal, with nulls and negatives."""
    scores = [None if i % 50 == 0 else 7.0 if i % 3 == 0 else float(RNG.normal()) for i in range(1003)]
    return spark.createDataFrame(
        [(f"{i:05d}", s) for i, s in enumerate(scores)], "id string, score double"
    ).repartition(5)


@pytest.mark.parametrize("buckets", [10, 7])
def test_ntile_equals_the_window_function(tied, buckets):
    expected = F.ntile(buckets).over(Window.orderBy(F.desc_nulls_last("score"), "id"))
    both = running.ntile(tied, "score", "id", "ours", buckets).withColumn("theirs", expected)
    assert both.where("ours <> theirs").count() == 0
    assert both.agg(F.countDistinct("ours")).first()[0] == buckets


@pytest.mark.parametrize("rows", [1, 4, 10, 11])
def test_ntile_on_few_rows(spark, rows):
    few = spark.createDataFrame([(str(i), float(i)) for i in range(rows)], "id string, score double")
    expected = F.ntile(10).over(Window.orderBy(F.desc("score"), "id"))
    both = running.ntile(few, "score", "id", "ours").withColumn("theirs", expected)
    assert both.where("ours <> theirs").count() == 0


def test_running_totals_follow_the_global_order(tied):
    totals = running.running_totals(
        tied.where("score is not null"), [F.asc("score"), F.asc("id")], {"n": F.lit(1), "s": F.col("score")}
    ).toPandas().sort_values(["score", "id"])
    assert list(totals["n"]) == list(range(1, len(totals) + 1))
    assert np.allclose(totals["s"], totals["score"].cumsum())
    assert (totals["n_total"] == len(totals)).all()


def test_quantiles_match_numpy(tied):
    probabilities = [0.0, 0.1, 0.33, 0.5, 0.99, 1.0]
    values = tied.where("score is not null").toPandas()["score"]
    assert np.allclose(running.quantiles(tied, "score", probabilities), np.quantile(values, probabilities))


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "score double")
    assert running.quantiles(empty, "score", [0.5]) == [None]


def test_qcut_matches_pandas_with_ties(tied):
    frame = deciles.qcut_decile(tied, "score").toPandas()
    expected = 10 - pd.qcut(frame["score"], 10, labels=False, duplicates="drop")
    known = frame["score"].notna()
    assert (frame.loc[known, "decile"].astype(int) == expected[known].astype(int)).all()
    assert frame.loc[~known, "decile"].isna().all()


def test_decile_capture_matches_pandas(spark):
    predicted = np.round(RNG.gamma(1.0, 2.0, 800), 1)
    actual = RNG.poisson(predicted).astype(float)
    frame = pd.DataFrame({"predicted": predicted, "actual": actual})
    ours = deciles.decile_capture(spark.createDataFrame(frame), "predicted", "actual")
    ours = ours.toPandas().sort_values("decile")
    ordered = frame.sort_values("predicted", ascending=False).copy()
    ordered["decile"] = 10 - pd.qcut(ordered["predicted"], 10, labels=False, duplicates="drop")
    ordered["running"] = ordered["actual"].cumsum()
    expected = ordered.groupby("decile")["running"].last() / ordered["actual"].sum()
    assert list(ours["decile"]) == list(expected.index)
    assert np.allclose(ours["ratio_cum_actual_to_total"], expected)
    assert ours["ratio_cum_actual_to_total"].iloc[-1] == pytest.approx(1.0)


def test_ntile_places_a_null_key_before_its_ties(spark):
    rows = [(1.0, None if i == 0 else i) for i in range(20)]
    frame = spark.createDataFrame(rows, "score double, id int")
    got = {r.id: r.bucket for r in running.ntile(frame, "score", "id", "bucket").collect()}
    wanted = frame.selectExpr("id", "ntile(10) OVER (ORDER BY score DESC, id) AS bucket").collect()
    assert got == {r.id: r.bucket for r in wanted}
