from datetime import date, datetime, timedelta
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from loyalspan.operators import rfm
from loyalspan.sources.transactions import CLEAN_COLUMNS, CleaningRules, clean_transactions

SCHEMA = "customer_id string, sale_dt timestamp_ntz, amount "
# The latest purchase is on 31 July, so with ten days of holdout the cut is 21 July.
EDGES = [
    ("late", datetime(2020, 7, 31, 23, 59), "5.00"),
    ("late", datetime(2020, 7, 1, 8), "10.00"),
    ("late", datetime(2020, 7, 1, 20), "2.50"),
    ("late", datetime(2020, 7, 11), "7.00"),
    ("late", datetime(2020, 7, 13), "8.00"),
    ("cut", datetime(2020, 7, 20), "3.00"),
    ("cut", datetime(2020, 7, 21), "4.00"),
    ("cut", datetime(2020, 7, 22), "6.00"),
    ("new", datetime(2020, 7, 25), "9.00"),
    ("once", datetime(2020, 7, 2), "1.00"),
    (None, datetime(2020, 7, 3), "1.00"),
    ("late", datetime(2020, 8, 1), "99.00"),
]


@pytest.fixture(scope="module", params=["decimal(12,2)", "decimal(18,2)", "double"])
def edges(spark, request):
    number = float if request.param == "double" else Decimal
    rows = [(c, ts, number(a)) for c, ts, a in EDGES]
    transactions = spark.createDataFrame(rows, SCHEMA + request.param)
    return rfm.in_period(transactions, "2020-01-01", "2020-07-01")


def by_customer(df, key="CustomerID"):
    return {row[key]: row for row in df.collect()}


def test_training_snapshot_edges(edges):
    snapshot = rfm.training_snapshot(
        rfm.daily_spend(edges), rfm.current_day(edges), "2020-07-01", 10
    )
    rows = by_customer(snapshot)
    assert set(rows) == {"late", "cut", "once"}
    late = rows["late"]
    assert late["snapshot_dt"] == date(2020, 7, 1)
    assert (late["frequency_cal"], late["recency_cal"], late["T_cal"]) == (2.0, 12.0, 20.0)
    assert late["monetary_value_cal"] == 7.5
    assert (late["frequency_holdout"], late["monetary_value_holdout"]) == (1.0, 5.0)
    cut = rows["cut"]
    assert (cut["frequency_cal"], cut["recency_cal"], cut["T_cal"]) == (0.0, 0.0, 1.0)
    assert cut["monetary_value_cal"] == 0.0
    assert (cut["frequency_holdout"], cut["monetary_value_holdout"]) == (2.0, 5.0)
    once = rows["once"]
    assert (once["frequency_holdout"], once["monetary_value_holdout"]) == (0.0, 0.0)
    assert once["duration_holdout"] == 10.0


def test_one_pass_equals_the_joined_form(edges):
    daily, current = rfm.daily_spend(edges), rfm.current_day(edges)
    joined = rfm.calibration_with_holdout(
        rfm.rfm_calibration(daily, current, 10), rfm.rfm_holdout(daily, current, 10)
    )
    snapshot = rfm.training_snapshot(daily, current, "2020-07-01", 10)
    columns = ["frequency", "recency", "T", "monetary_value"]
    one_pass = snapshot.select(
        "CustomerID",
        *[F.col(f"{c}_cal").alias(c) for c in columns],
        "frequency_holdout",
        "monetary_value_holdout",
    )
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, one_pass.collect()))


def test_full_snapshot_edges(edges):
    snapshot = rfm.full_snapshot(rfm.daily_spend(edges), rfm.current_day(edges), "2020-07-01")
    rows = by_customer(snapshot)
    assert set(rows) == {"late", "cut", "new", "once"}
    assert (rows["late"]["frequency"], rows["late"]["recency"], rows["late"]["T"]) == (3, 30, 30)
    assert rows["late"]["monetary_value"] == pytest.approx(20 / 3)
    assert (rows["new"]["frequency"], rows["new"]["recency"], rows["new"]["T"]) == (0, 0, 6)


def test_repeat_spend_leaves_out_the_first_day(edges):
    rows = by_customer(rfm.repeat_spend(rfm.daily_spend(edges)), "customer_id")
    assert rows["late"]["repeat_spend"] == 20.0
    assert rows["once"]["repeat_spend"] == 0.0


def test_cleaning_rules(spark):
    good = {
        "region": "r", "customer_id": "c", "consumer_id": 1, "brand_id": 2, "sale_dt": date(2020, 1, 1),
        "txn_id": 1, "amount": 5.0, "currency": "USD", "channel": "web", "valid_ind": 1,
        "consumer_valid_flag": "Y", "trade_flag": "N", "visit_ind": 1, "change_code": "I",
    }
    bad = [
        {"region": "x"}, {"customer_id": None}, {"consumer_id": None}, {"valid_ind": 0},
        {"consumer_valid_flag": "N"}, {"trade_flag": "Y"}, {"amount": 0.0}, {"amount": -1.0},
        {"currency": "EUR"}, {"visit_ind": 0}, {"change_code": "D"}, {"change_code": None},
    ]
    rows = [good] + [{**good, **change} for change in bad]
    schema = (
        "region string, customer_id string, consumer_id int, brand_id int, sale_dt date, txn_id int,"
        " amount double, currency string, channel string, valid_ind int, consumer_valid_flag string,"
        " trade_flag string, visit_ind int, change_code string"
    )
    raw = spark.createDataFrame(rows, schema)
    kept = clean_transactions(raw, CleaningRules("r"))
    assert kept.columns == list(CLEAN_COLUMNS)
    assert kept.count() == 1
    renamed = raw.withColumnRenamed("amount", "net_total")
    assert clean_transactions(renamed, CleaningRules("r", names={"amount": "net_total"})).count() == 1


def test_rollup_plan_combines_before_the_shuffle(edges):
    plan = rfm.daily_spend(edges)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan


def test_money_is_exact(spark):
    rows = [("a", date(2020, 1, 1), Decimal("0.10"))] * 1000 + [("a", date(2020, 1, 1), Decimal("9999999999999.99"))]
    df = spark.createDataFrame(rows, "customer_id string, sale_dt date, amount decimal(15,2)")
    daily = rfm.daily_spend(df)
    assert dict(daily.dtypes)["amount"] == "bigint"
    assert daily.select(rfm.spent(daily)).first()[0] == 10000000000099.99


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_snapshots_equal_a_pandas_walk(spark, seed):
    """Random histories with one customer holding a third of all purchases."""
    rng = np.random.default_rng(seed)
    rows = [
        (
            "hot" if rng.random() < 0.33 else f"c{rng.integers(60)}",
            datetime(2020, 1, 1) + timedelta(days=int(rng.integers(200)), hours=int(rng.integers(24))),
            Decimal(int(rng.integers(1, 10_000))) / 100,
        )
        for _ in range(600)
    ]
    df = spark.createDataFrame(rows, SCHEMA + "decimal(12,2)").repartition(7)
    daily, current = rfm.daily_spend(df), rfm.current_day(df)
    ours = by_customer(rfm.training_snapshot(daily, current, "2020-07-01", 60))
    full = by_customer(rfm.full_snapshot(daily, current, "2020-07-01"))

    spend = {}
    for customer, ts, amount in rows:
        days = spend.setdefault(customer, {})
        days[ts.date()] = days.get(ts.date(), 0) + amount
    latest = max(ts for _, ts, _ in rows).date()
    cut = latest - timedelta(days=60)
    assert set(full) == set(spend)
    assert set(ours) == {c for c, days in spend.items() if min(days) < cut}
    for customer, days in spend.items():
        first = min(days)
        repeat = [float(v) for d, v in days.items() if d != first]
        assert full[customer]["frequency"] == len(days) - 1
        assert full[customer]["T"] == (latest - first).days
        assert full[customer]["monetary_value"] == pytest.approx(np.mean(repeat) if repeat else 0)
        if customer not in ours:
            continue
        before = {d: v for d, v in days.items() if d < cut}
        after = [float(v) for d, v in days.items() if d >= cut]
        repeat = [float(v) for d, v in before.items() if d != first]
        row = ours[customer]
        assert row["frequency_cal"] == len(before) - 1
        assert row["recency_cal"] == (max(before) - first).days
        assert row["T_cal"] == (cut - first).days
        assert row["monetary_value_cal"] == pytest.approx(np.mean(repeat) if repeat else 0)
        assert row["frequency_holdout"] == len(after)
        assert row["monetary_value_holdout"] == pytest.approx(np.mean(after) if after else 0)
